"""Quality reports on the metric fixture: labelled documents with
``label = quality``, ``score = n_chars``, ``prediction = n_chars > 500``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagecut.functions.formats import metric_text, percent_text
from pagecut.operators import metrics as M
from pagecut.plans import standins as S
from pagecut.plans.catalog.common import r6
from pagecut.plans.jobs import evaluate, evaluate_whole
from pagecut.session import scratch_path
from pagecut.sinks import write_csv
from pagecut.sources.tables import table

N_EXAMPLES = 5  # the reference's default number of examples


def _fx(spark, root):
    return S.doc_predictions(spark, root)


def q_confusion_matrix(spark, root):
    return M.confusion_matrix(_fx(spark, root))


def q_classification_report(spark, root):
    r = M.classification_report(_fx(spark, root))
    return r.select("row", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), F.col("support").cast("bigint").alias("support"))


def q_accuracy(spark, root):
    a = M.accuracy_summary(_fx(spark, root))
    return a.select(r6("accuracy").alias("accuracy"), "errors", "total", r6("error_rate").alias("error_rate"))


def q_weighted_metrics(spark, root):
    w = M.weighted_metrics(_fx(spark, root))
    return w.select(*[r6(c).alias(c) for c in w.columns])


def q_binary_metrics(spark, root):
    b = M.binary_metrics(_fx(spark, root))
    return b.select(*[r6(c).alias(c) for c in b.columns])


def q_roc_curve(spark, root, strategy="auto"):
    c = M.roc_curve(_fx(spark, root), strategy=strategy)
    return c.select(r6("threshold").alias("threshold"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


def q_roc_curve_chunked(spark, root):
    return q_roc_curve(spark, root, strategy="chunked")


def q_roc_auc(spark, root):
    a = M.roc_auc(_fx(spark, root))
    return a.select(r6("auc").alias("auc"), "positives", "negatives")


def q_error_rows(spark, root):
    return M.error_rows(_fx(spark, root)).select("doc_id", "label", "prediction", "score")


def q_error_examples(spark, root):
    return M.first_rows(M.error_rows(_fx(spark, root)), N_EXAMPLES, ["doc_id"]) \
        .select("doc_id", "label", "prediction", "score")


def q_prediction_examples(spark, root):
    return M.first_rows(_fx(spark, root), N_EXAMPLES, ["doc_id"]).select("doc_id", "label", "prediction")


def q_class_distribution(spark, root):
    return M.class_distribution(_fx(spark, root))


def _flat_report(rep):
    mp, cd = "model_performance", "class_distribution"
    return rep.select(r6(f"{mp}.accuracy").alias("accuracy"), r6(f"{mp}.auc_roc").alias("auc_roc"),
                      F.col(f"{mp}.total_samples").alias("total_samples"),
                      r6(f"{mp}.error_rate").alias("error_rate"),
                      *[F.coalesce(F.col(f"{cd}.{k}")[str(c)], F.lit(0)).cast("bigint").alias(f"{k}_{c}")
                        for k in ("actual", "predicted") for c in (0, 1)])


def q_eval_report(spark, root):
    return _flat_report(M.eval_report(_fx(spark, root)))


def q_job_evaluate(spark, root):
    out = scratch_path(spark, "evaluation")
    evaluate(_fx(spark, root), out_dir=out)
    return _flat_report(spark.read.json(f"{out}/report"))


def q_job_evaluate_whole(spark, root):
    """All parts of the evaluation as they come back from its folder, one kind of row for each."""
    found = evaluate_whole(_fx(spark, root), out_dir=scratch_path(spark, "evaluation"))
    none = F.lit(None).cast("double")

    def part(df, name, key, key2, a, b, c, n):
        cells = dict(key=key, key2=key2, a=a, b=b, c=c, n=n)
        kinds = dict(key="string", key2="string", a="double", b="double", c="double", n="bigint")
        return df.select(F.lit(name).alias("part"), *[(r6(v.cast("double")) if kinds[k] == "double" else v.cast(kinds[k])).alias(k)
                                                      for k, v in cells.items()])

    col, text = F.col, F.lit(None).cast("string")
    seen = spark.createDataFrame([(found.n_rows, found.n_errors)], "n long, wrong long")
    return part(found.confusion, "confusion", col("label"), col("prediction"), none, none, none, col("count")) \
        .union(part(found.classes, "class", col("row"), text, col("precision"), col("recall"), col("f1"), col("support"))) \
        .union(part(found.roc, "roc", text, text, col("threshold"), col("fpr"), col("tpr"), F.lit(None))) \
        .union(part(found.errors, "error", col("doc_id"), F.concat_ws(">", "label", "prediction"), col("score"), none, none, F.lit(1))) \
        .union(part(seen, "seen", text, text, col("wrong"), none, none, col("n")))


def q_csv_roundtrip(spark, root):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, root, "labels"), path)
    return spark.read.option("header", True).schema("doc_id bigint, quality int, toxic int").csv(path)


def q_metric_strings(spark, root):
    a = M.accuracy_summary(_fx(spark, root))
    return a.select(metric_text(F.col("accuracy")).alias("accuracy_text"),
                    percent_text(F.col("error_rate")).alias("error_rate_text"))


QUERIES = {
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "accuracy": q_accuracy,
    "weighted_metrics": q_weighted_metrics,
    "binary_metrics": q_binary_metrics,
    "roc_curve": q_roc_curve,
    "roc_curve_chunked": q_roc_curve_chunked,
    "roc_auc": q_roc_auc,
    "error_rows": q_error_rows,
    "error_examples": q_error_examples,
    "prediction_examples": q_prediction_examples,
    "class_distribution": q_class_distribution,
    "eval_report": q_eval_report,
    "job_evaluate": q_job_evaluate,
    "job_evaluate_whole": q_job_evaluate_whole,
    "csv_roundtrip": q_csv_roundtrip,
    "metric_strings": q_metric_strings,
}

_FX = """(SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
                 CAST(d.n_chars > 500 AS INTEGER) AS prediction
          FROM labels l JOIN documents d USING (doc_id))"""

_PC = f"""(SELECT c AS class,
              sum(CASE WHEN label = c THEN 1 ELSE 0 END) AS support,
              sum(CASE WHEN label = c AND prediction = c THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN prediction = c THEN 1 ELSE 0 END) AS n_pred
           FROM {_FX} f, (SELECT label AS c FROM {_FX} UNION SELECT prediction FROM {_FX}) cls GROUP BY c)"""

_PCM = f"""(SELECT class, support, tp, n_pred,
               CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS p,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM {_PC})"""

_PCF = f"(SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM {_PCM})"

_ACC = f"""(SELECT count(*) AS total, CAST(sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END) AS BIGINT) AS errors
           FROM {_FX})"""

_COUNTS = f"""(SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM {_FX} GROUP BY score)"""

_AUC = f"""(SELECT sum(neg * (cum_pos - pos / 2.0)) / (sum(pos) * sum(neg)) AS auc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
           FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   AS cum_pos FROM {_COUNTS}))"""

_DIST = f"""(SELECT 'actual' AS kind, label AS class, count(*) AS count FROM {_FX} GROUP BY label
            UNION ALL SELECT 'predicted', prediction, count(*) FROM {_FX} GROUP BY prediction)"""

_REPORT = f"""
    SELECT round((a.total - a.errors) / a.total, 6) AS accuracy, round(u.auc, 6) AS auc_roc,
           a.total AS total_samples, round(a.errors / a.total, 6) AS error_rate,
           (SELECT coalesce(sum(count), 0)::BIGINT FROM {_DIST} WHERE kind = 'actual' AND class = 0) AS actual_0,
           (SELECT coalesce(sum(count), 0)::BIGINT FROM {_DIST} WHERE kind = 'actual' AND class = 1) AS actual_1,
           (SELECT coalesce(sum(count), 0)::BIGINT FROM {_DIST} WHERE kind = 'predicted' AND class = 0) AS predicted_0,
           (SELECT coalesce(sum(count), 0)::BIGINT FROM {_DIST} WHERE kind = 'predicted' AND class = 1) AS predicted_1
    FROM {_ACC} a, {_AUC} u"""

SQL = {
    "confusion_matrix": f"""
        SELECT g.label, g.prediction, coalesce(c.n, 0) AS count
        FROM (SELECT a.c AS label, b.c AS prediction FROM
                (SELECT label AS c FROM {_FX} UNION SELECT prediction FROM {_FX}) a,
                (SELECT label AS c FROM {_FX} UNION SELECT prediction FROM {_FX}) b) g
        LEFT JOIN (SELECT label, prediction, count(*) AS n FROM {_FX} GROUP BY ALL) c
          ON g.label = c.label AND g.prediction = c.prediction""",
    "classification_report": f"""
        SELECT CAST(class AS VARCHAR) AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
               CAST(support AS BIGINT) AS support FROM {_PCF}
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM {_PCF}
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
          FROM {_PCF}
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
          round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
          CAST(sum(support) AS BIGINT) FROM {_PCF}""",
    "accuracy": f"""SELECT round((total - errors) / total, 6) AS accuracy, errors, total,
                           round(100.0 * errors / total, 6) AS error_rate FROM {_ACC}""",
    "weighted_metrics": f"""
        SELECT round(sum(tp) / sum(support), 6) AS accuracy,
               round(sum(p * support) / sum(support), 6) AS weightedPrecision,
               round(sum(r * support) / sum(support), 6) AS weightedRecall,
               round(sum(f * support) / sum(support), 6) AS f1
        FROM {_PCF} WHERE support > 0""",
    "binary_metrics": f"""
        SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               round(CASE WHEN sum(prediction) > 0
                     THEN sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) / sum(prediction)
                     ELSE 0.0 END, 6) AS precision,
               round(CASE WHEN sum(label) > 0
                     THEN sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) / sum(label)
                     ELSE 0.0 END, 6) AS recall
        FROM {_FX}""",
    "roc_curve": f"""
        SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
        UNION ALL
        SELECT round(score, 6),
               round(sum(neg) OVER w / (SELECT sum(neg) FROM {_COUNTS}), 6),
               round(sum(pos) OVER w / (SELECT sum(pos) FROM {_COUNTS}), 6)
        FROM {_COUNTS} WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "roc_auc": f"SELECT round(auc, 6) AS auc, positives, negatives FROM {_AUC}",
    "error_rows": f"SELECT doc_id, label, prediction, score FROM {_FX} WHERE label <> prediction",
    "error_examples": f"""SELECT doc_id, label, prediction, score FROM {_FX} WHERE label <> prediction
                          ORDER BY doc_id LIMIT {N_EXAMPLES}""",
    "prediction_examples": f"SELECT doc_id, label, prediction FROM {_FX} ORDER BY doc_id LIMIT {N_EXAMPLES}",
    "class_distribution": f"SELECT * FROM {_DIST}",
    "eval_report": _REPORT,
    "job_evaluate": _REPORT,
    "csv_roundtrip": "SELECT doc_id, quality, toxic FROM labels",
    "metric_strings": f"""SELECT printf('%.4f', (total - errors) / total) AS accuracy_text,
                                 printf('%.2f%%', 100.0 * errors / total) AS error_rate_text FROM {_ACC}""",
}

SQL["roc_curve_chunked"] = SQL["roc_curve"]

SQL["job_evaluate_whole"] = f"""
    SELECT 'confusion' AS part, CAST(label AS VARCHAR) AS key, CAST(prediction AS VARCHAR) AS key2, CAST(NULL AS DOUBLE) AS a,
           CAST(NULL AS DOUBLE) AS b, CAST(NULL AS DOUBLE) AS c, CAST(count AS BIGINT) AS n FROM ({SQL["confusion_matrix"]})
    UNION ALL SELECT 'class', row, NULL, precision, recall, f1, support FROM ({SQL["classification_report"]})
    UNION ALL SELECT 'roc', NULL, NULL, threshold, fpr, tpr, NULL FROM ({SQL["roc_curve"]})
    UNION ALL SELECT 'error', CAST(doc_id AS VARCHAR), label || '>' || prediction, score, NULL, NULL, 1 FROM ({SQL["error_rows"]})
    UNION ALL SELECT 'seen', NULL, NULL, errors, NULL, NULL, total FROM {_ACC}"""
