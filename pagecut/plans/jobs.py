"""Composite jobs: the public workflow of the engine.

prepare -> label -> train -> predict -> split, plus evaluate and tune.  Each
job takes DataFrames (and paths for what it writes) and returns DataFrames.
Only small, bounded results reach the driver (metric rows, per-class counts,
the 27-point tuning grid); wide inputs are written once to the shared scratch
folder and re-read instead of being recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.ml import models
from pagecut.operators import labels as L
from pagecut.operators import metrics as M
from pagecut.operators.pages import text_page_features
from pagecut.operators.sampling import fold_column, oversample_minority, split_hash
from pagecut.operators.segments import segment_pages, segment_ranges, write_segments
from pagecut.session import materialize, materialize_counted
from pagecut.sinks import write_csv, write_json, write_lines, write_parquet


def prepare_corpus(docs: DataFrame, bundle: str, text: str, out_path: str | None = None,
                   min_chars: int = 20) -> DataFrame:
    """Text bundles -> ``page_features`` (``pdf_name, page_number, path,
    features``), written once to Parquet; returns pages per bundle with the
    number of pages that have features."""
    from pagecut.functions.paths import page_path
    from pagecut.operators.pages import text_to_pages

    pages = text_to_pages(docs, bundle, text)
    feats = pages.select(F.col(bundle).alias("pdf_name"), "page_number",
                         page_path("pages", F.col(bundle), F.col("page_number")).alias("path"),
                         text_page_features(F.col("page_text"), min_chars).alias("features"))
    if out_path:
        write_parquet(feats, out_path)
        feats = docs.sparkSession.read.parquet(out_path)
    return feats.groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_pages"),
                                         F.count("features").alias("n_with_features"))


def label_pages(pages: DataFrame, targets: DataFrame, keys: Sequence[str] = ("bundle", "page_number")
                ) -> tuple[DataFrame, DataFrame]:
    """Attach first-page labels (default 0); returns labelled pages and the
    class distribution."""
    labelled = L.attach_labels(pages, targets, keys)
    return labelled, labelled.groupBy("label").agg(F.count(F.lit(1)).alias("count"))


@dataclass
class TrainResult:
    model: object
    metrics: dict
    test_predictions: DataFrame
    #: Of a training from a label store: expected pages without an image, bundles without any.
    missing_pages: DataFrame | None = None
    missing_bundles: DataFrame | None = None


def train(rows: DataFrame, id_col: str, label: str, features: str = "features",
          model_path: str | None = None, oversample: bool = True, classifier=None,
          test_percent: int = 20, seed: int = 42, class_weights: str | None = None) -> TrainResult:
    """Split by id hash first, then fit scaler + classifier on the training
    part only (oversampling the minority there), evaluate on the held-out part.

    ``class_weights`` (``"balanced"`` or ``"ratio"``) weights the classes
    through the classifier's ``weightCol`` instead of oversampling.  Rows with
    null features are dropped (an undecodable page cannot train).
    """
    data = rows.where(F.col(features).isNotNull()).select(id_col, F.col(label).cast("int").alias("label"),
                                                          features)
    data = split_hash(data, id_col, test_percent, seed)
    # features are computed once: every later pass (counts, fit iterations,
    # scoring) reads the written table
    data = models.to_vector(materialize(data, "train-input"), features)
    tr = data.where(F.col("split") == "train")
    te = data.where(F.col("split") == "test")
    if class_weights:
        weights = (M.class_weights_balanced if class_weights == "balanced" else M.class_weights_ratio)(tr, "label")
        tr = M.weight_column(tr, weights, "label")
        clf = classifier if classifier is not None else models.logistic(weight="weight")
    else:
        clf = classifier if classifier is not None else models.logistic()
    # the scaler sees each training row once, before any row is repeated
    sc = models.scaler().fit(tr)
    if oversample and not class_weights:
        tr = oversample_minority(tr, "label", id_col, seed=seed)
    model = models.joined(sc, clf.fit(sc.transform(tr)))
    pred = model.transform(te)
    metrics = models.evaluate_all(pred)
    if model_path:
        models.save_model(model, model_path)
    return TrainResult(model, metrics, pred)


def score_pages(pages: DataFrame, model_path: str, features: str = "features",
                threshold: float | None = None) -> DataFrame:
    """Pages with ``p_first`` (probability of a first page) and ``prediction``
    from a saved pipeline; ``threshold`` replaces the model's own cut with
    the strict ``p_first > threshold``."""
    from pyspark.ml.functions import vector_to_array
    model = models.load_model(model_path)
    scored = model.transform(models.to_vector(pages.where(F.col(features).isNotNull()), features))
    scored = scored.withColumn("p_first", vector_to_array("probability")[1])
    if threshold is not None:
        scored = scored.withColumn("prediction", M.threshold(F.col("p_first"), threshold).cast("double"))
    return scored.drop("features_vector", "scaled_features", "rawPrediction", "probability")


def predict_first_pages(pages: DataFrame, model_path: str, keys: Sequence[str], features: str = "features",
                        paths_out: str | None = None, path_col: str | None = None,
                        threshold: float | None = None) -> DataFrame:
    """Score pages with a saved pipeline and keep predicted first pages,
    ordered by bundle and page number; optionally write their paths."""
    scored = score_pages(pages, model_path, features, threshold)
    firsts = scored.where(F.col("prediction") == 1).select(*keys, *([path_col] if path_col else []))
    # scored once: the sort samples its input, and the lines and the caller read it again
    firsts = materialize(firsts, "firsts").orderBy(*keys)
    if paths_out and path_col:
        write_lines(firsts, path_col, paths_out)
    return firsts


def split_bundles(pages: DataFrame, keys: Sequence[str], order: Sequence[str], is_first: Column,
                  out_path: str | None = None, number: bool = True, include_leading: bool = False,
                  strategy: str = "auto") -> tuple[DataFrame, DataFrame]:
    """Cut bundles at first pages: per-page segment ids and per-segment ranges.

    With ``number=False`` the pages are already numbered and ``order[0]`` is
    the page-number column.  With ``out_path`` every segment is written so it
    can be read on its own (``write_segments``): the cut runs once, in the write, and
    pages and ranges come from the written table.
    """
    seg = segment_pages(pages, keys, order, is_first, number=number, include_leading=True,
                        strategy=strategy)
    page_col = "page_number" if number else order[0]
    kept = seg if include_leading else seg.where(F.col("segment_id") > 0)
    if not out_path:
        # our own numbering has no gaps; given page numbers (file names) may
        return kept, segment_ranges(seg, keys, page_col, contiguous=number)
    write_segments(kept, out_path, keys, page_col, layout="in_place")
    written = pages.sparkSession.read.schema(kept.schema).parquet(out_path)
    # a bundle's last segment runs to its end, so the highest page written tells its length
    total = written.groupBy(*keys).agg((F.max(page_col) + 1).cast("int").alias("total_pages"))
    return written, segment_ranges(written, keys, page_col, total, contiguous=number)


@dataclass
class Evaluation:
    """Everything that is said about one set of predictions."""
    report: DataFrame
    confusion: DataFrame
    classes: DataFrame
    roc: DataFrame
    errors: DataFrame
    n_rows: int
    n_errors: int


def evaluate_whole(pred: DataFrame, out_dir: str | None = None, label: str = "label", prediction: str = "prediction",
                   score: str = "score", bundle: str | None = None, page: str | None = None) -> Evaluation:
    """Report, confusion matrix, per-class report, ROC curve and error rows from one pass over ``pred``.

    The pass writes the flat columns once (scoring a model
    again for each metric would be the expensive part); one aggregate of the written table by
    label, prediction and score then feeds every metric.  With ``out_dir`` the parts
    are written there: ``errors`` (CSV), ``report`` (JSON), ``confusion``, ``classes``, ``roc`` (Parquet)
    and come back as read from there.  With ``bundle`` and ``page`` the error table has the
    error-analysis layout (``error_table``)."""
    from pyspark.sql import types as T
    flat = [f.name for f in pred.schema.fields
            if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType))]
    wrong = F.col(label) != F.col(prediction)
    rows, seen = materialize_counted(pred.select(*flat), "predictions", n=F.count(F.lit(1)),
                                      wrong=F.coalesce(F.sum(wrong.cast("long")), F.lit(0)))
    counts = materialize(rows.groupBy(label, prediction, score).agg(F.count(F.lit(1)).alias("n_rows")), "counts")
    errors = M.error_table(rows, label, prediction, score, bundle, page) if bundle and page else M.error_rows(rows, label, prediction)
    found = Evaluation(M.eval_report(counts, label, prediction, score, "n_rows"),
                       M.confusion_matrix(counts, label, prediction, count="n_rows"),
                       M.classification_report(counts, label, prediction, "n_rows"),
                       M.roc_curve(counts, label, score, count="n_rows"), errors, seen["n"], seen["wrong"])
    if out_dir:
        spark = pred.sparkSession
        write_csv(found.errors, f"{out_dir}/errors")
        found.errors = spark.read.option("header", True).schema(found.errors.schema).csv(f"{out_dir}/errors")
        write_json(found.report, f"{out_dir}/report")
        for name in ("confusion", "classes", "roc"):
            write_parquet(getattr(found, name), f"{out_dir}/{name}")
            setattr(found, name, spark.read.parquet(f"{out_dir}/{name}"))
    return found


def evaluate(pred: DataFrame, out_dir: str | None = None, label: str = "label",
             prediction: str = "prediction", score: str = "score", bundle: str | None = None,
             page: str | None = None) -> DataFrame:
    """The report record of ``evaluate_whole`` (accuracy, AUC, total, error rate, class distribution)."""
    return evaluate_whole(pred, out_dir, label, prediction, score, bundle, page).report


@dataclass
class TuneResult:
    model: object
    grid: DataFrame
    held_out_auc: float
    held_out: DataFrame


def tune(rows: DataFrame, id_col: str, label: str, features: str = "features",
         model_path: str | None = None, parallelism: int = 4, seed: int = 42,
         test_percent: int = 20, method: str = "joint") -> TuneResult:
    """Hash split, scaler fitted on the training part, 3-fold cross-validation (hash folds) of
    the 27 settings there, the best setting fitted on the whole training part and
    scored on the held-out part.

    ``method``: ``joint`` takes all settings and folds through one pass per iteration,
    ``separate`` fits each with Spark ML, ``parallelism`` at a time (see
    ``models.cross_validated``).  Returns the best model, the grid table, the
    held-out area under ROC (binned evaluator, as the reference reports it) and the held-out predictions."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    data = rows.where(F.col(features).isNotNull()).select(
        id_col, F.col(label).cast("int").alias("label"), features)
    data = models.to_vector(data, features).withColumn("fold", fold_column(F.col(id_col), models.CV_FOLDS, seed))
    data = split_hash(data, id_col, test_percent, seed)
    sc = models.scaler().fit(data.where(F.col("split") == "train"))
    # every pass reads the scaled table: compute it once
    scaled = materialize(sc.transform(data).select(id_col, "label", "fold", "split", "scaled_features",
                                                   vector_to_array("scaled_features").alias("scaled")), "tune-input")
    train_part = scaled.where(F.col("split") == "train")
    found = models.cross_validated(train_part, "label", "fold", "scaled" if method == "joint" else "scaled_features", method, parallelism)
    table = models.grid_table(found, rows.sparkSession)
    top = max(found, key=lambda f: sum(f[1]))[0]
    fitted = models.logistic(max_iter=top.maxIter, reg=top.regParam, elastic=top.elasticNetParam).fit(train_part)
    held_out = fitted.transform(scaled.where(F.col("split") == "test"))
    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(held_out)
    best = models.joined(sc, fitted)
    if model_path:
        models.save_model(best, model_path)
    return TuneResult(best, table, auc, held_out)


def image_pages(spark, root: str, size: tuple[int, int] = (224, 224)) -> DataFrame:
    """Page images ``<root>/<bundle>/page_<i>.png`` -> ``(pdf_name, page_number,
    path, features)``; the page number comes from the file name (gaps are
    kept), undecodable images get null features.

    Every file is read once into a table under the scratch folder, where plain PNGs are decoded; if
    others are found, Spark's ``image`` source decodes them.
    """
    from pagecut.functions.image import image_features, plain_png_features_udf
    from pagecut.functions.paths import basename, page_number_from_path
    from pagecut.sources.files import few_tasks, read_images

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    plain = few_tasks(files.select(F.col("_metadata.file_path").alias("origin"), "content")) \
        .select("origin", plain_png_features_udf(*size)(F.col("content")).alias("features"))
    found = materialize(plain, "images")
    others = found.where("features is null").select("origin")
    if not others.isEmpty():
        img = few_tasks(read_images(spark, root).select(F.col("_metadata.file_path").alias("origin"), "image")) \
            .select("origin", image_features(F.col("image"), *size).alias("features"))
        found = found.where("features is not null").unionByName(materialize(img.join(others, "origin", "left_semi"), "images"))
    # the sources give URIs: names come back as they are in the store ("+" stays), local ones as the image source writes them
    path = F.url_decode(F.replace(F.regexp_replace("origin", "^file:/(?=[^/])", "file:///"), F.lit("+"), F.lit("%2B")))
    folder = F.element_at(F.split(path, "/"), -2)
    return found.select(folder.alias("pdf_name"), page_number_from_path(basename(path)).alias("page_number"), path.alias("path"), "features")


def train_from_store(spark, store_path: str, images_root: str, model_path: str | None = None,
                     size: tuple[int, int] = (224, 224), **train_args) -> TrainResult:
    """The training job: for every bundle in the label store, pages
    ``0 .. total_pages-1`` whose image exists are labelled (1 when listed as a
    first page), turned into features and used to train."""
    targets = L.read_store_targets(spark, store_path)
    totals = L.read_store_totals(spark, store_path)
    expected = L.expected_pages(totals, "bundle")
    # every image is decoded once; presence, labels and features come from the written table
    pages = image_pages(spark, images_root, size).withColumnRenamed("pdf_name", "bundle")
    keys = ["bundle", "page_number"]
    labelled = L.attach_labels(expected, targets).join(pages, keys, "inner")
    result = train(labelled.withColumn("page_id", F.concat_ws("/", "bundle", F.col("page_number").cast("string"))),
                   "page_id", "label", model_path=model_path, **train_args)
    result.missing_pages = L.expected_missing(expected, pages, keys)
    result.missing_bundles = totals.select("bundle").join(pages.select("bundle"), "bundle", "left_anti")
    return result


def predict_from_images(spark, images_root: str, model_path: str, paths_out: str | None = None,
                        size: tuple[int, int] = (224, 224)) -> DataFrame:
    """The prediction job: score every page image, keep predicted first
    pages in (bundle, page number) order, optionally write their paths."""
    pages = image_pages(spark, images_root, size)
    return predict_first_pages(pages, model_path, ["pdf_name", "page_number"], paths_out=paths_out,
                               path_col="path")


def predict_and_split(pages: DataFrame, model_path: str, bundle: str = "pdf_name",
                      page: str = "page_number", features: str = "features",
                      threshold: float | None = None, out_path: str | None = None
                      ) -> tuple[DataFrame, DataFrame]:
    """The end of the workflow: predict first pages with a saved model, then
    cut every bundle at them.  All pages are kept (an unscorable page is
    never a first page); returns per-page segment ids and segment ranges."""
    # the features may come from decoding images: computed once, read twice
    pages = materialize(pages.select(bundle, page, features), "pages")
    scored = score_pages(pages, model_path, features, threshold).select(bundle, page, "prediction")
    unscored = pages.where(F.col(features).isNull()).select(bundle, page, F.lit(0.0).alias("prediction"))
    # the narrow scored table is written once; the cut reads it several times
    every = materialize(scored.unionByName(unscored), "scored-pages")
    return split_bundles(every, [bundle], [page], F.col("prediction") == 1, out_path=out_path, number=False)


def prepare_images(spark, images_root: str, out_path: str, size: tuple[int, int] = (224, 224)) -> DataFrame:
    """Preparation job for page images: decode every page once into the
    ``page_features`` table (``pdf_name, page_number, path, features``) at
    ``out_path``; returns pages per bundle with the number that decoded."""
    write_parquet(image_pages(spark, images_root, size), out_path)
    feats = spark.read.parquet(out_path)
    return feats.groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_pages"),
                                         F.count("features").alias("n_with_features"))
