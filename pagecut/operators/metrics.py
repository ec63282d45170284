"""Quality metrics as DataFrame aggregates.

Everything is computed on the executors: counts per ``(label, prediction)``
pair (at most ``k^2`` rows, map-side combined) feed the class-level reports;
ROC and AUC pre-aggregate per distinct score and then use ``running_sums``,
which keeps a global ordering parallel.  Zero denominators give 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecut.operators.prefix import running_sums
from pagecut.session import materialize, materialize_counted


def ratio(num: Column, den: Column) -> Column:
    """Zero-guarded ratio: ``num / den`` or 0 when ``den`` is 0 or null."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def harmonic(p: Column, r: Column) -> Column:
    return F.when((p + r) > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))


def threshold(score: Column, t: float = 0.5) -> Column:
    """Strict decision threshold: ``int(score > t)``."""
    return (score > F.lit(t)).cast("int")


def _rows(count: str | None) -> Column:
    """Number of rows, or of rows that ``count`` says a row stands for."""
    return F.sum(count) if count else F.count(F.lit(1))


def pair_counts(df: DataFrame, label: str, prediction: str, count: str | None = None) -> DataFrame:
    return df.groupBy(label, prediction).agg(_rows(count).alias("count"))


def pair_table(df: DataFrame, label: str = "label", prediction: str = "prediction", count: str | None = None) -> DataFrame:
    """``(label, prediction, count)`` computed in one pass over the data and
    written to the shared scratch folder, so every report derived from it reuses
    the single aggregate instead of re-scanning the data, whatever the number
    of classes.  ``count`` names a column of rows counted before."""
    return materialize(pair_counts(df, label, prediction, count), "pairs")


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: Sequence | None = None, count: str | None = None) -> DataFrame:
    """All ``k x k`` cells ``(label, prediction, count)``, zeros included.

    The grid is the result's own size: every class that occurs (or of ``classes``)
    against every other, made from a table of classes."""
    pairs = pair_table(df, label, prediction, count)
    ltype, ptype = df.schema[label].dataType, df.schema[prediction].dataType
    if classes is not None:
        values = df.sparkSession.createDataFrame([(c,) for c in classes], ["class"]).distinct()
    else:
        values = pairs.select(F.col(label).alias("class")).union(pairs.select(prediction)).where("class is not null").distinct()
    grid = values.select(F.col("class").cast(ltype).alias(label)).crossJoin(values.select(F.col("class").cast(ptype).alias(prediction)))
    return grid.join(pairs, [label, prediction], "left") \
        .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction", count: str | None = None) -> DataFrame:
    """``(class, tp, n_pred, support, precision, recall, f1)`` per class,
    from the pair table (one pass over ``df``)."""
    pairs = pair_table(df, label, prediction, count)
    by_label = pairs.groupBy(F.col(label).alias("class")).agg(
        F.sum("count").alias("support"),
        F.sum(F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(0)).alias("tp"))
    by_pred = pairs.groupBy(F.col(prediction).alias("class")).agg(F.sum("count").alias("n_pred"))
    c = by_label.join(by_pred, "class", "full_outer").na.fill(0, ["support", "tp", "n_pred"])
    p = ratio(F.col("tp"), F.col("n_pred"))
    r = ratio(F.col("tp"), F.col("support"))
    return c.select("class", F.col("tp").cast("bigint"), F.col("n_pred").cast("bigint"),
                    F.col("support").cast("bigint"), p.alias("precision"), r.alias("recall"),
                    harmonic(p, r).alias("f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          count: str | None = None) -> DataFrame:
    """Rows per class, then ``accuracy``, ``macro avg``, ``weighted avg``:
    ``(row, precision, recall, f1, support)``; the accuracy row carries the
    accuracy in ``f1`` and nulls in precision and recall."""
    pc = per_class(df, label, prediction, count)
    classes = pc.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1",
                        "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"),
                 F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), ratio(F.col("tp"), F.col("n")).alias("f1"),
                     F.col("n").alias("support"))
    macro = tot.select(F.lit("macro avg"), "mp", "mr", "mf", "n")
    weighted = tot.select(F.lit("weighted avg"), ratio(F.col("wp"), F.col("n")),
                          ratio(F.col("wr"), F.col("n")), ratio(F.col("wf"), F.col("n")), "n")
    return classes.union(acc).union(macro).union(weighted)


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, weightedPrecision, weightedRecall, f1 (weighted F1),
    as ``MulticlassClassificationEvaluator`` reports them."""
    pc = per_class(df, label, prediction).where(F.col("support") > 0)
    return pc.agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        ratio(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("weightedPrecision"),
        ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("weightedRecall"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"))


def accuracy_summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, errors, total, error_rate (percent)."""
    wrong = (F.col(label) != F.col(prediction)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("total"), F.sum(wrong).cast("bigint").alias("errors")) \
        .select(ratio(F.col("total") - F.col("errors"), F.col("total")).alias("accuracy"),
                "errors", "total", (F.lit(100.0) * ratio(F.col("errors"), F.col("total"))).alias("error_rate"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision and recall of class 1."""
    y, p = F.col(label), F.col(prediction)
    s = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(((y == 1) & (p == 1)).cast("int")).alias("tp"),
               F.sum(((y == 0) & (p == 1)).cast("int")).alias("fp"),
               F.sum(((y == 1) & (p == 0)).cast("int")).alias("fn"),
               F.sum((y == p).cast("int")).alias("ok"))
    return s.select(ratio(F.col("ok"), F.col("n")).alias("accuracy"),
                    ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def log_loss(df: DataFrame, label: str, prob: Column, eps: float = 1e-7) -> DataFrame:
    """Binary cross-entropy with ``p`` clipped to ``[eps, 1 - eps]``."""
    p = F.least(F.greatest(prob.cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))


def _score_counts(df: DataFrame, label: str, score: str, count: str | None = None) -> tuple[DataFrame, int, int, int]:
    """(positives and negatives per distinct score, their totals, number of scores): written once,
    the totals are taken from there."""
    rows = F.col(count) if count else F.lit(1).cast("long")
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, rows).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) != 1, rows).otherwise(0)).alias("neg"))
    table, seen = materialize_counted(counts, "scores", p=F.sum("pos"), q=F.sum("neg"), n=F.count(F.lit(1)))
    return table, int(seen["p"] or 0), int(seen["q"] or 0), int(seen["n"] or 0)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              strategy: str = "auto", drop_intermediate: bool = False, count: str | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score, plus the start
    ``(+inf, 0, 0)``.  Running true/false positive counts by descending score
    come from ``running_sums`` over the per-score counts (no single-task
    window); totals are one scalar aggregate.

    ``drop_intermediate`` removes points collinear with both neighbours (the
    first and last score points are kept; the start is added afterwards).  Neighbours are found by equi-joins on a
    running point index, not by a global ``lag``/``lead``."""
    counts, P, N, n_scores = _score_counts(df, label, score, count)
    ranked = running_sums(counts.withColumn("__desc", -F.col("score")),
                          {"tp": F.col("pos"), "fp": F.col("neg"), "__i": F.lit(1)}, ["__desc"],
                          strategy=strategy, max_rows=n_scores)
    if drop_intermediate:
        pts0 = ranked.select("score", "tp", "fp", "__i")
        prev = pts0.select((F.col("__i") + 1).alias("__i"), F.col("tp").alias("tp_p"), F.col("fp").alias("fp_p"))
        nxt = pts0.select((F.col("__i") - 1).alias("__i"), F.col("tp").alias("tp_n"), F.col("fp").alias("fp_n"))
        j = pts0.join(prev, "__i", "left").join(nxt, "__i", "left")
        bend = ((F.col("tp_n") - 2 * F.col("tp") + F.col("tp_p")) != 0) | \
               ((F.col("fp_n") - 2 * F.col("fp") + F.col("fp_p")) != 0)
        ranked = j.where(F.col("tp_p").isNull() | F.col("tp_n").isNull() | bend)
    pts = ranked.select(F.col("score").alias("threshold"),
                        (F.col("fp") / F.lit(N) if N else F.lit(None).cast("double")).alias("fpr"),
                        (F.col("tp") / F.lit(P) if P else F.lit(None).cast("double")).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.union(pts)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", strategy: str = "auto",
            count: str | None = None) -> DataFrame:
    """Exact ROC AUC, ties counted half (equals the trapezoid under ``roc_curve``).

    ``AUC = sum_s neg(s) * (pos(>s) + pos(s) / 2) / (P * N)``."""
    counts, _, _, n_scores = _score_counts(df, label, score, count)
    ranked = running_sums(counts.withColumn("__desc", -F.col("score")), {"cum_pos": F.col("pos")},
                          ["__desc"], strategy=strategy, max_rows=n_scores)
    s = ranked.agg(F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))).alias("u"),
                   F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return s.select(ratio(F.col("u"), F.col("P").cast("double") * F.col("N")).alias("auc"),
                    F.col("P").cast("bigint").alias("positives"), F.col("N").cast("bigint").alias("negatives"))


def class_distribution(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(kind, class, count)`` for actual and predicted classes."""
    a = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("count")) \
        .select(F.lit("actual").alias("kind"), "class", "count")
    p = df.groupBy(F.col(prediction).alias("class")).agg(F.count(F.lit(1)).alias("count")) \
        .select(F.lit("predicted").alias("kind"), "class", "count")
    return a.union(p)


def error_rows(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Misclassified rows, with whatever metadata columns ``df`` carries."""
    return df.where(F.col(label) != F.col(prediction))


def error_table(df: DataFrame, label: str, prediction: str, confidence: str, bundle: str,
                page: str) -> DataFrame:
    """Misclassified pages in the error-analysis layout: ``True_Label,
    Predicted_Label, Confidence, PDF_Name, Page_Number``; metadata travels
    with the rows, so no positional join is needed."""
    # fixed names: the columns of the error table
    return error_rows(df, label, prediction).select(
        F.col(label).cast("int").alias("True_Label"), F.col(prediction).cast("int").alias("Predicted_Label"),
        F.col(confidence).cast("float").alias("Confidence"), F.col(bundle).cast("string").alias("PDF_Name"),
        F.col(page).cast("int").alias("Page_Number"))


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``order`` (top-k; the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def eval_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                score: str = "score", count: str | None = None) -> DataFrame:
    """One nested record: ``model_performance{accuracy, auc_roc, total_samples,
    error_rate}`` (error rate as a fraction) and ``class_distribution{actual,
    predicted}`` (class -> count maps, so the record has a field for each class).

    The parts are one-row aggregates of the pair and score tables, put side by side."""
    pairs = pair_table(df, label, prediction, count)  # accuracy and class counts come from the one aggregate
    wrong = F.when(F.col(label) != F.col(prediction), F.col("count")).otherwise(0)
    # the report's error rate is a fraction (the printed rate is a percentage)
    total = pairs.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("n"), F.coalesce(F.sum(wrong), F.lit(0)).alias("wrong"))

    def classes(column: str, name: str) -> DataFrame:
        per = pairs.groupBy(F.col(column).cast("string").alias("class")).agg(F.sum("count").alias("n"))
        per = per.where("class is not null")
        return per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "n")))).alias(name))

    side = total.crossJoin(roc_auc(df, label, score, count=count)).crossJoin(classes(label, "actual")) \
        .crossJoin(classes(prediction, "predicted"))  # one row each
    performance = F.struct(ratio(F.col("n") - F.col("wrong"), F.col("n")).alias("accuracy"), F.col("auc").alias("auc_roc"),
                           F.col("n").alias("total_samples"), ratio(F.col("wrong"), F.col("n")).alias("error_rate"))
    return side.select(performance.alias("model_performance"), F.struct("actual", "predicted").alias("class_distribution"))


#: Bits of a page: it is in the predicted set, in the true set.
IN_PRED, IN_TRUE = 1, 2


def match_flags(pages: DataFrame, in_pred: Column, in_true: Column, keys: Sequence[str]) -> DataFrame:
    """``(keys, in_pred, in_true)`` of every key that is in either set, from one scan.

    Each row is tagged with the sets it belongs to and the tags of a key are
    put together: one shuffle of partial aggregates, no join, repeated rows count once.
    """
    tag = F.when(in_pred, IN_PRED).otherwise(0).bitwiseOR(F.when(in_true, IN_TRUE).otherwise(0))
    bits = pages.select(*keys, tag.alias("__tag")).where("__tag > 0").groupBy(*keys).agg(F.bit_or("__tag").alias("__tag"))
    return bits.select(*keys, (F.col("__tag").bitwiseAND(IN_PRED) > 0).alias("in_pred"),
                       (F.col("__tag").bitwiseAND(IN_TRUE) > 0).alias("in_true"))


def match_sets(pred: DataFrame, true: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``match_flags`` of two key sets that come from different tables."""
    keys = list(keys)
    both = pred.select(*keys, F.lit(True).alias("__pred")).unionByName(true.select(*keys, F.lit(False).alias("__pred")))
    return match_flags(both, F.col("__pred"), ~F.col("__pred"), keys)


def prf_of(matches: DataFrame, bundle: str) -> DataFrame:
    """Per bundle: tp, fp, fn, precision, recall, f1 of matched pages."""
    s = matches.groupBy(bundle).agg(
        F.sum((F.col("in_pred") & F.col("in_true")).cast("long")).alias("tp"),
        F.sum((F.col("in_pred") & ~F.col("in_true")).cast("long")).alias("fp"),
        F.sum((~F.col("in_pred") & F.col("in_true")).cast("long")).alias("fn"))
    p = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.select(bundle, "tp", "fp", "fn", p.alias("precision"), r.alias("recall"),
                    harmonic(p, r).alias("f1"))


def set_prf(pred: DataFrame, true: DataFrame, bundle: str, page: str) -> DataFrame:
    """``prf_of`` predicted vs true pages of different tables."""
    return prf_of(match_sets(pred, true, [bundle, page]), bundle)


def class_weights_balanced(df: DataFrame, label: str) -> DataFrame:
    """``n / (k * n_c)`` per class (scikit-learn's "balanced")."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()  # over the k class rows only
    return c.select(label, "n_c", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))
                    .alias("weight"))


def class_weights_ratio(df: DataFrame, label: str) -> DataFrame:
    """``{0: 1, 1: n0 / n1}`` for a 0/1 label."""
    s = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("n0"),
               F.sum((F.col(label) == 1).cast("long")).alias("n1"))
    return s.select(F.explode(F.array(
        F.struct(F.lit(0).alias(label), F.lit(1.0).alias("weight")),
        F.struct(F.lit(1).alias(label), ratio(F.col("n0"), F.col("n1")).alias("weight")))).alias("w")) \
        .select("w.*")


def weight_column(df: DataFrame, weights: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Attach per-class weights as a ``weightCol`` (k rows: broadcast is bounded)."""
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(name))), label, "left")
