"""Training, tuning, prediction and model storage on ``embeddings`` (label
``y``), image decoding and augmentation, and the streaming page split.
These are checked on rows and by property tests (``tests/test_ml.py``), except
the streaming split, whose output equals the batch split."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagecut.functions.image import augment_udf, image_2d_udf, png_udf
from pagecut.ml import models
from pagecut.ml.network import DenseNetwork, fit_dense
from pagecut.ml.registry import ModelRegistry
from pagecut.operators import labels as L
from pagecut.operators import metrics as M
from pagecut.operators.sampling import split_hash
from pagecut.plans import standins as S
from pagecut.plans.jobs import (image_pages, predict_and_split, predict_first_pages, predict_from_images,
                                prepare_images, score_pages, train, train_from_store, tune)
from pagecut.session import materialize, path_status, scratch_path
from pagecut.sinks.files import committed, write_binary_files
from pagecut.sources.files import read_images
from pagecut.sources.tables import table
from pagecut.streaming import page_stream, write_page_stream


def _checked(spark, res, least_area=0.8, recheck=True, **more):
    """What must hold for a fitted model: each metric of the held-out part in its range, the area above ``least_area``.

    The number of held-out rows is drawn by hash, so it is checked by value; the metrics
    are recomputed by Spark ML's own evaluators and must agree (``recheck``)."""
    again = models.evaluator_metrics(res.test_predictions) if recheck else res.metrics
    rows = [(k, bool(0 <= v <= 1), bool(v > least_area) if k == "areaUnderROC" else True, bool(abs(v - again[k]) < 1e-9), True)
            for k, v in res.metrics.items()] + [(k, True, True, True, bool(v)) for k, v in more.items()]
    n = res.test_predictions.count()
    found = spark.createDataFrame(rows, "metric string, in_range boolean, learnt boolean, agrees boolean, holds boolean") \
        .withColumn("n_test", F.lit(n).cast("bigint"))
    return found if recheck else found.drop("agrees")


def _rows(spark, root):
    return S.embedding_rows(spark, root).select("vec_id", "y", F.col("embedding").alias("features"))


def q_train_lr(spark, root):
    return _checked(spark, train(_rows(spark, root), "vec_id", "y"))


def q_train_mlp(spark, root):
    return _checked(spark, train(_rows(spark, root), "vec_id", "y", classifier=models.mlp(64, (16,))))


def q_job_train(spark, root):
    path = scratch_path(spark, "model")
    res = train(_rows(spark, root), "vec_id", "y", model_path=path)
    return _checked(spark, res, recheck=False, model_saved=path_status(spark, path) is not None)


def q_model_roundtrip(spark, root):
    path = scratch_path(spark, "model")
    res = train(_rows(spark, root), "vec_id", "y", model_path=path)
    reloaded = models.load_model(path)
    test = res.test_predictions.select("vec_id", "features_vector",
                                       vector_to_array("probability")[1].alias("p_fit"))
    again = reloaded.transform(test).select("vec_id", "p_fit", vector_to_array("probability")[1].alias("p_loaded"))
    return again.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p_fit") - F.col("p_loaded"))).alias("max_abs_diff"))


def q_job_predict(spark, root):
    """Predicted first pages against the scores: every page, whether it is predicted as its score says."""
    path = scratch_path(spark, "model")
    train(_rows(spark, root), "vec_id", "y", model_path=path)
    pages = _rows(spark, root).withColumn("bundle", F.lit("embeddings")).withColumn("page_number", F.col("vec_id"))
    lines = scratch_path(spark, "first-pages")
    firsts = predict_first_pages(pages.withColumn("path", F.col("vec_id").cast("string")), path, ["bundle", "page_number"],
                                 paths_out=lines, path_col="path").select("page_number", F.lit(True).alias("first"))
    listed = spark.read.text(lines).select(F.col("value").cast("bigint").alias("page_number"), F.lit(True).alias("listed"))
    scored = score_pages(pages, path).select("bundle", "page_number", "p_first")
    every = scored.join(firsts, "page_number", "left").join(listed, "page_number", "left")
    first = F.coalesce("first", F.lit(False))
    return every.select("bundle", "page_number", (first == (F.col("p_first") > 0.5)).alias("as_scored"),
                        (first == F.coalesce("listed", F.lit(False))).alias("as_listed"))


def q_training_history(spark, root):
    """The loss by iteration: numbered without a gap, falling, and its last value the one of the last iteration."""
    res = train(_rows(spark, root), "vec_id", "y")
    h = models.history_table(res.model, spark)
    before = F.lag("value").over(Window.partitionBy("metric").orderBy("iteration"))  # one row an iteration
    last = models.last_per_metric(models.drop_validation_metrics(h)).first()
    steps = h.withColumn("before", before)
    return steps.groupBy("metric").agg((F.max("iteration") == F.count(F.lit(1)) - 1).alias("gapless"), F.min("iteration").alias("begins"),
                                       F.coalesce(F.bool_and(F.col("value") <= F.col("before")), F.lit(True)).alias("falls"),
                                       (F.min_by("value", -F.col("iteration")) == F.lit(last["value"])).alias("last_is_last"))


def q_train_dense(spark, root):
    """A dense network from 8 partitions and from one: the same weights, resumed in between, better than its begin."""
    rows = split_hash(_rows(spark, root), "vec_id", 20, 42)
    rows = materialize(rows, "dense")
    learn, valid = rows.where("split = 'train'"), rows.where("split = 'test'")
    last, best, history = fit_dense(learn.repartition(8), iterations=30, valid=valid.repartition(3), label="y")
    path = scratch_path(spark, "network")
    half, _, _ = fit_dense(learn.coalesce(1), iterations=18, valid=valid, label="y")
    half.save(spark, path)
    again, _, rest = fit_dense(learn.coalesce(1), iterations=12, valid=valid, label="y", start=DenseNetwork.load(spark, path))
    scored = best.transform(valid, "features", "score").select(F.col("y").alias("label"), "score")
    seen = {(i, m): v for i, m, v in history}
    apart = float(np.abs(last.flat() - again.flat()).max())
    # the validation part of the small tables has too few positives for a bound on the area itself
    return scored.agg(F.count(F.lit(1)).alias("n_valid")).select(
        "n_valid", F.lit(len({i for i, _ in seen})).alias("n_measured"), F.lit(apart < 1e-6).alias("same_weights"),
        F.lit(max(abs(v - seen[i, m]) for i, m, v in rest) < 1e-6).alias("same_history"),
        F.lit(seen[30, "loss"] < 0.5 * seen[0, "loss"]).alias("learnt"),
        F.lit(M.roc_auc(scored).first()["auc"] > 0.8).alias("separates"))


def q_best_model(spark, root):
    """Three strengths of regularisation: published with their areas, the best promoted, reloaded and compared."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    fitted = {}
    for reg in (0.5, 0.01, 0.1):
        res = train(_rows(spark, root), "vec_id", "y", classifier=models.logistic(reg=reg))
        version = registry.publish(lambda path: models.save_model(res.model, path, overwrite=False), res.metrics, f"reg_{reg}")
        fitted[version] = res
    top = registry.best("areaUnderROC")
    registry.promote(top)
    res = fitted[registry.current()]
    test = res.test_predictions.select("vec_id", "features_vector", vector_to_array("probability")[1].alias("p_fit"))
    again = models.load_model(registry.path()).transform(test).select("p_fit", vector_to_array("probability")[1].alias("p_loaded"))
    most = max(r.metrics["areaUnderROC"] for r in fitted.values())
    return again.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p_fit") - F.col("p_loaded"))).alias("max_abs_diff"),
                     F.lit(registry.versions().select("version").distinct().count()).alias("n_versions"),
                     F.lit(res.metrics["areaUnderROC"] == most).alias("is_best"))


def q_job_tune(spark, root):
    """The grid with its folds: what is drawn by hash is checked by value, the areas and their ranks by what must hold."""
    path = scratch_path(spark, "tuned")
    res = tune(_rows(spark, root), "vec_id", "y", model_path=path)
    kept = F.lit(path_status(spark, path) is not None)
    n = table(spark, root, "embeddings").count() - res.held_out.count()
    least_rank = F.rank().over(Window.orderBy(F.col("avg_auc").desc()))  # 27 rows
    return res.grid.select("regParam", "elasticNetParam", "maxIter", F.lit(n).cast("bigint").alias("n_train"), kept.alias("saved"),
                           F.col("avg_auc").between(0.5, 1.0).alias("area_in_range"),
                           (F.col("is_best") == (F.col("rank") == 1)).alias("best_is_first"), (F.col("rank") >= least_rank).alias("ranked"))


def q_cv_best_model(spark, root):
    """Best grid point of the 3-fold CV and its held-out area under ROC, from
    the evaluator (binned, as the reference) and exact (``numBins=0``)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    res = tune(_rows(spark, root), "vec_id", "y")
    binned = res.held_out_auc
    exact = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(res.held_out)
    top = res.grid.where("is_best").first()
    fine = 0.5 <= top["avg_auc"] <= 1 and abs(binned - exact) < 0.01 and exact > 0.8
    grid = {(g.regParam, g.elasticNetParam, g.maxIter) for g in models.param_grid()}
    n = res.held_out.count()
    return spark.createDataFrame([((top["regParam"], top["elasticNetParam"], top["maxIter"]) in grid, fine, n)],
                                 "in_grid boolean, areas_agree boolean, n_held_out bigint")


def _image_dir(spark, root):
    """Embeddings written as 8 x 8 PNG files ``img_<vec_id>.png``."""
    px = S.embedding_rows(spark, root).select("vec_id", S.pixels(F.col("embedding")).alias("px"))
    files = px.select(F.format_string("img_%d.png", "vec_id").alias("name"),
                      png_udf(S.IMG_H, S.IMG_W)(F.col("px")).alias("png"))
    path = scratch_path(spark, "images")
    write_binary_files(files, "name", "png", path)
    return path


def _bundle_images(spark, root):
    """Embeddings as page images of 10 bundles (``label_<label>``), pages
    numbered by ``vec_id``; first pages are those with ``y = 1``."""
    from pagecut.operators.pages import number_pages
    e = S.embedding_rows(spark, root)
    pages = number_pages(e.withColumn("bundle", F.format_string("label_%d", "label")), ["bundle"], ["vec_id"])
    return pages.select("bundle", "page_number", "vec_id", "y", S.pixels(F.col("embedding")).alias("px"))


def _write_bundle_images(spark, root):
    pages = _bundle_images(spark, root)
    img_root = scratch_path(spark, "pageimages")
    # a file costs the same however small it is: rows are dealt out evenly, not by their bytes
    dealt = pages.repartition(4 * spark.sparkContext.defaultParallelism, "bundle", "page_number")
    files = dealt.select(F.format_string("%s/page_%d.png", "bundle", "page_number").alias("name"),
                         png_udf(S.IMG_H, S.IMG_W)(F.col("px")).alias("png"))
    write_binary_files(files, "name", "png", img_root)
    store = scratch_path(spark, "labelstore")
    L.write_label_store(L.build_label_store(pages, "bundle", "page_number", F.col("y") == 1), store)
    return img_root, store


def q_verify_written(spark, root):
    """Page images against the sink's own list: every 50th page has no image, label 9 has none at all."""
    pages = _bundle_images(spark, root)
    lost = (F.col("vec_id") % 50 == 0) | (F.col("bundle") == "label_9")
    files = pages.select(F.format_string("%s/page_%d.png", "bundle", "page_number").alias("name"),
                         F.when(~lost, png_udf(S.IMG_H, S.IMG_W)(F.col("px"))).alias("png"))
    path = scratch_path(spark, "pageimages")
    write_binary_files(files, "name", "png", path)
    found = L.verify_written(pages.select("bundle", "page_number"), committed(spark, path), "bundle", "page_number")
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("bundle", "block", "n_expected", "n_written", listed("paths"), listed("missing_pages"),
                        listed("unexpected_pages"), "bundle_missing")


def q_image_pages(spark, root):
    img_root, _ = _write_bundle_images(spark, root)
    p = image_pages(spark, img_root, (S.IMG_H, S.IMG_W))
    return p.select("pdf_name", "page_number", F.size("features").alias("n_features"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double")) * F.lit(255.0))
                    .cast("bigint").alias("pixel_sum"))


def q_job_prepare_images(spark, root):
    img_root, _ = _write_bundle_images(spark, root)
    return prepare_images(spark, img_root, scratch_path(spark, "page-features"), (S.IMG_H, S.IMG_W))


def q_job_train_images(spark, root):
    img_root, store = _write_bundle_images(spark, root)
    path = scratch_path(spark, "model")
    res = train_from_store(spark, store, img_root, path, size=(S.IMG_H, S.IMG_W))
    return _checked(spark, res, 0.6, model_saved=path_status(spark, path) is not None, nothing_missing=res.missing_pages.isEmpty())


def q_job_predict_images(spark, root):
    """First pages from images against the scores of the same images, page by page."""
    img_root, store = _write_bundle_images(spark, root)
    model = scratch_path(spark, "model")
    train_from_store(spark, store, img_root, model, size=(S.IMG_H, S.IMG_W))
    firsts = predict_from_images(spark, img_root, model, scratch_path(spark, "firstpages"), size=(S.IMG_H, S.IMG_W))
    scored = score_pages(image_pages(spark, img_root, (S.IMG_H, S.IMG_W)), model).select("pdf_name", "page_number", "p_first")
    every = scored.join(firsts.select("pdf_name", "page_number", F.lit(True).alias("first")), ["pdf_name", "page_number"], "left")
    return every.select("pdf_name", "page_number", (F.coalesce("first", F.lit(False)) == (F.col("p_first") > 0.5)).alias("as_scored"))


def q_job_predict_split(spark, root):
    """Train on the page images, predict first pages, cut the bundles: what the cut must cover, by bundle."""
    img_root, store = _write_bundle_images(spark, root)
    model = scratch_path(spark, "model")
    train_from_store(spark, store, img_root, model, size=(S.IMG_H, S.IMG_W))
    pages = materialize(image_pages(spark, img_root, (S.IMG_H, S.IMG_W)), "page-features")
    cut, ranges = predict_and_split(pages, model, out_path=scratch_path(spark, "segments"))
    firsts = score_pages(pages, model).where("prediction = 1").groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_first"), F.min("page_number").alias("lead"))
    cuts = ranges.groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_segments"), F.min("start_page").alias("start"), F.sum("n_pages").alias("covered"),
                                          F.max("end_page").alias("stop"))
    kept = cut.groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_kept"))
    every = pages.groupBy("pdf_name").agg(F.count(F.lit(1)).alias("n_pages"))
    for other in (firsts, cuts, kept):
        every = every.join(other, "pdf_name", "left")
    none = F.col("n_first").isNull() & F.col("n_segments").isNull() & F.col("n_kept").isNull()
    return every.select("pdf_name", "n_pages", (none | (F.col("n_segments") == F.col("n_first"))).alias("a_segment_a_first_page"),
                        (none | ((F.col("start") == F.col("lead")) & (F.col("stop") == F.col("n_pages")))).alias("from_first_to_end"),
                        (none | ((F.col("covered") == F.col("n_pages") - F.col("lead")) & (F.col("n_kept") == F.col("covered")))).alias("covers_the_rest"))


def q_train_weighted(spark, root):
    return _checked(spark, train(_rows(spark, root), "vec_id", "y", class_weights="balanced"))


def q_image_features_2d(spark, root):
    img = read_images(spark, _image_dir(spark, root))
    f = img.select(F.col("image.origin").alias("origin"), image_2d_udf(4, 4)(F.col("image")).alias("f"))
    total = F.aggregate(F.flatten("f"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return f.select(F.regexp_extract("origin", r"img_(\d+)\.png$", 1).cast("bigint").alias("vec_id"),
                    F.size("f").alias("rows"), F.size(F.col("f")[0]).alias("cols"),
                    F.round(total * F.lit(255.0)).cast("bigint").alias("level_sum"))


def q_augment_full(spark, root):
    px = S.embedding_rows(spark, root).select("vec_id", S.pixels(F.col("embedding")).cast("array<double>").alias("px"))
    run = augment_udf(S.IMG_H, S.IMG_W, variants=2)
    return px.mapInPandas(lambda it: run(it, "vec_id", "px"), "vec_id long, variant long, px array<double>") \
        .select("vec_id", "variant", F.posexplode("px").alias("pixel", "value")) \
        .select("vec_id", "variant", "pixel", F.round("value", 4).alias("value"))


def q_stream_bundle_to_pages(spark, root):
    schema = table(spark, root, "documents").schema
    # one file, or on a cluster a folder of part files
    whole = path_status(spark, f"{root}/documents.parquet").isDirectory()
    source, pattern = (f"{root}/documents.parquet", "*.parquet") if whole else (root, "documents.parquet")
    pages = page_stream(spark, source, schema, "doc_id", "text", pattern=pattern)
    sink = scratch_path(spark, "stream-pages")
    q = write_page_stream(pages, sink, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(sink).select("doc_id", "page_number", "page_text")


QUERIES = {
    "train_lr": q_train_lr,
    "train_mlp": q_train_mlp,
    "job_train": q_job_train,
    "model_roundtrip": q_model_roundtrip,
    "job_predict": q_job_predict,
    "training_history": q_training_history,
    "train_dense": q_train_dense,
    "best_model": q_best_model,
    "job_tune": q_job_tune,
    "cv_best_model": q_cv_best_model,
    "verify_written": q_verify_written,
    "image_pages": q_image_pages,
    "job_prepare_images": q_job_prepare_images,
    "job_train_images": q_job_train_images,
    "job_predict_images": q_job_predict_images,
    "job_predict_split": q_job_predict_split,
    "train_weighted": q_train_weighted,
    "image_features_2d": q_image_features_2d,
    "augment_full": q_augment_full,
    "stream_bundle_to_pages": q_stream_bundle_to_pages,
}

_MEAN2X2 = """(SELECT vec_id, (px[(2 * (i // 4)) * 8 + 2 * (i % 4) + 1] + px[(2 * (i // 4)) * 8 + 2 * (i % 4) + 2]
                  + px[(2 * (i // 4) + 1) * 8 + 2 * (i % 4) + 1] + px[(2 * (i // 4) + 1) * 8 + 2 * (i % 4) + 2]) / 4.0 AS m
               FROM (SELECT vec_id, list_transform(embedding,
                       lambda x: least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.6) * 200) AS INTEGER)))) AS px
                     FROM embeddings), range(0, 16) t(i))"""

_AUGMENTED = """
    WITH image AS (SELECT vec_id, list_transform(embedding, lambda x: least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.6) * 200) AS INTEGER)))) AS px
                   FROM embeddings),
    drawn AS (SELECT vec_id, px, v, list_transform(range(0, 5), lambda k:
                  2 * (('0x' || substr(md5('42:' || vec_id || ':' || v || ':' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE) - 1) AS u
              FROM image, range(0, 2) r(v)),
    turned AS (SELECT vec_id, v, px, i, radians(u[1] * 10) AS t, 1 + u[2] * 0.1::DOUBLE AS zy, 1 + u[3] * 0.1::DOUBLE AS zx,
                      i // 8 - 3.5::DOUBLE - u[4] * 0.1::DOUBLE * 8 AS dy, i % 8 - 3.5::DOUBLE - u[5] * 0.1::DOUBLE * 8 AS dx
               FROM drawn, range(0, 64) q(i)),
    source AS (SELECT vec_id, v, px, i, least(7.0::DOUBLE, greatest(0.0::DOUBLE, (dy * cos(t) - dx * sin(t)) * zy + 3.5::DOUBLE)) AS sy,
                      least(7.0::DOUBLE, greatest(0.0::DOUBLE, (dy * sin(t) + dx * cos(t)) * zx + 3.5::DOUBLE)) AS sx FROM turned),
    corner AS (SELECT *, floor(sy)::BIGINT AS y, floor(sx)::BIGINT AS x, least(floor(sy)::BIGINT + 1, 7) AS y1, least(floor(sx)::BIGINT + 1, 7) AS x1 FROM source)
    SELECT vec_id, v AS variant, CAST(i AS INTEGER) AS pixel,
           round((px[8 * y + x + 1] * (1 - (sx - x)) + px[8 * y + x1 + 1] * (sx - x)) * (1 - (sy - y))
                 + (px[8 * y1 + x + 1] * (1 - (sx - x)) + px[8 * y1 + x1 + 1] * (sx - x)) * (sy - y), 4) AS value
    FROM corner"""

_TEST = """(SELECT count(*) FROM embeddings
            WHERE ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 < 20)"""

_TRAINED = f"""SELECT m AS metric, true AS in_range, true AS learnt, true AS agrees, true AS holds, {_TEST} AS n_test
    FROM (VALUES ('accuracy'), ('weightedPrecision'), ('weightedRecall'), ('f1'), ('areaUnderROC')) t(m)"""
_ONE = "UNION ALL SELECT '{0}', true, true, true, true, " + _TEST
# held-out pages of the image bundles are drawn by bundle and page
_IMAGES = """(SELECT 'label_' || label AS bundle, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS page FROM embeddings)"""
_IMAGE_TEST = f"""(SELECT count(*) FROM {_IMAGES} WHERE ('0x' || substr(md5(bundle || '/' || page || ':42'), 1, 8))::BIGINT % 100 < 20)"""

SQL = {
    "train_lr": _TRAINED,
    "train_mlp": _TRAINED,
    "train_weighted": _TRAINED,
    "job_train": f"SELECT * EXCLUDE (agrees) FROM ({_TRAINED} {_ONE.format('model_saved')})",
    "job_train_images": (_TRAINED + " " + _ONE.format("model_saved") + " " + _ONE.format("nothing_missing")).replace(_TEST, _IMAGE_TEST),
    "job_predict": "SELECT 'embeddings' AS bundle, vec_id AS page_number, true AS as_scored, true AS as_listed FROM embeddings",
    "job_predict_images": f"SELECT bundle AS pdf_name, CAST(page AS INTEGER) AS page_number, true AS as_scored FROM {_IMAGES}",
    "job_predict_split": f"""SELECT bundle AS pdf_name, count(*) AS n_pages, true AS a_segment_a_first_page, true AS from_first_to_end,
        true AS covers_the_rest FROM {_IMAGES} GROUP BY bundle""",
    "training_history": "SELECT 'loss' AS metric, true AS gapless, 0 AS begins, true AS falls, true AS last_is_last",
    "cv_best_model": f"SELECT true AS in_grid, true AS areas_agree, {_TEST} AS n_held_out",
    "train_dense": f"""SELECT {_TEST} AS n_valid, 31 AS n_measured, true AS same_weights, true AS same_history, true AS learnt, true AS separates""",
    "best_model": f"""SELECT {_TEST} AS n, CAST(0.0 AS DOUBLE) AS max_abs_diff, CAST(3 AS INTEGER) AS n_versions, true AS is_best""",
    "augment_full": _AUGMENTED,
    "verify_written": """
        SELECT bundle, CAST(page // 1024 AS INTEGER) AS block, count(*) AS n_expected, count(*) FILTER (NOT lost) AS n_written,
               coalesce(string_agg(bundle || '/page_' || page || '.png', ',' ORDER BY page) FILTER (NOT lost), '') AS paths,
               coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (lost), '') AS missing_pages, '' AS unexpected_pages,
               bundle = 'label_9' AS bundle_missing
        FROM (SELECT 'label_' || label AS bundle, vec_id % 50 = 0 OR label = 9 AS lost,
                     row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS page FROM embeddings)
        GROUP BY bundle, page // 1024""",
    "job_tune": """
        SELECT CAST(r AS DOUBLE) AS regParam, CAST(e AS DOUBLE) AS elasticNetParam, CAST(i AS INTEGER) AS maxIter,
               (SELECT count(*) FROM embeddings WHERE ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 >= 20) AS n_train,
               true AS saved, true AS area_in_range, true AS best_is_first, true AS ranked
        FROM (VALUES (0.01), (0.1), (0.5)) reg(r), (VALUES (0.0), (0.5), (1.0)) net(e), (VALUES (10), (20), (50)) iter(i)""",
    # the held-out part is the md5 bucket < 20; a reloaded model must give the same probabilities
    "model_roundtrip": """SELECT count(*) AS n, CAST(0.0 AS DOUBLE) AS max_abs_diff FROM embeddings
        WHERE ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 < 20""",
    "image_features_2d": f"""SELECT vec_id, 4 AS rows, 4 AS cols, CAST(sum(round_even(m, 0)) AS BIGINT) AS level_sum
        FROM {_MEAN2X2} GROUP BY vec_id""",
    "job_prepare_images": """
        SELECT 'label_' || CAST(label AS VARCHAR) AS pdf_name, count(*) AS n_pages, count(*) AS n_with_features
        FROM embeddings GROUP BY label""",
    "image_pages": """
        SELECT 'label_' || CAST(label AS VARCHAR) AS pdf_name,
               CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS page_number,
               64 AS n_features,
               CAST(list_sum(list_transform(embedding,
                 lambda x: least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.6) * 200) AS INTEGER)))))
                 AS BIGINT) AS pixel_sum
        FROM embeddings""",
    "stream_bundle_to_pages": """
        SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS page_number, unnest(parts) AS page_text
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""",
}
