"""Embeddings as page features: 64 floats per page (also an 8 x 8 image),
counting label ``label = 0`` and learnable label ``y``."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pagecut.functions import arrays as A
from pagecut.functions.image import pixel_features_udf, png_udf, resize_udf
from pagecut.ml import models
from pagecut.operators import metrics as M
from pagecut.operators.sampling import fold_column, oversample_minority, split_exact, split_hash, split_stratified
from pagecut.plans import standins as S
from pagecut.plans.catalog.common import r6
from pagecut.session import scratch_path
from pagecut.sinks.files import write_binary_files
from pagecut.sources.files import read_images
from pagecut.sources.tables import table

H, W = S.IMG_H, S.IMG_W
WEIGHTS = [1.0] * S.Y_DIMS + [0.0] * (64 - S.Y_DIMS)
BIAS = -S.Y_CUT


def _rows(spark, root):
    return S.embedding_rows(spark, root)


def _px(spark, root):
    return _rows(spark, root).select("vec_id", S.pixels(F.col("embedding")).alias("px"))


def _exploded(df, col, value="value", rnd=True):
    out = df.select("vec_id", F.posexplode(col).alias("pos", "__v"))
    v = F.col("__v").cast("double")
    return out.select("vec_id", F.col("pos").cast("int").alias("pos"), (r6(v) if rnd else F.col("__v")).alias(value))


def q_project_label_features(spark, root):
    e = _rows(spark, root).select("vec_id", "label", F.col("embedding").alias("features"))
    return e.select("vec_id", "label", F.size("features").alias("n_features"),
                    r6(A.array_sum(F.col("features"))).alias("feature_sum"))


def q_with_column(spark, root):
    e = _rows(spark, root).withColumn("dim_sum", r6(A.array_sum(F.col("embedding"))))
    return e.select("vec_id", "label", "dim_sum", "label_zero")


def q_filter_minority(spark, root):
    return _rows(spark, root).where(F.col("label_zero") == 1).select("vec_id", "label")


def q_row_count(spark, root):
    return table(spark, root, "embeddings").agg(F.count(F.lit(1)).alias("n"))


def q_label_distribution(spark, root):
    return table(spark, root, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("count"))


def q_label_totals(spark, root):
    e = _rows(spark, root)
    return e.agg(F.sum("label_zero").cast("bigint").alias("positives"),
                 (F.count(F.lit(1)) - F.sum("label_zero")).cast("bigint").alias("negatives"),
                 F.sum("y").cast("bigint").alias("y_positives"),
                 (F.count(F.lit(1)) - F.sum("y")).cast("bigint").alias("y_negatives"))


def q_class_weights_balanced(spark, root):
    w = M.class_weights_balanced(_rows(spark, root), "label_zero")
    return w.select(F.col("label_zero").alias("label"), "n_c", r6("weight").alias("weight"))


def q_class_weights_ratio(spark, root):
    w = M.class_weights_ratio(_rows(spark, root), "label_zero")
    return w.select(F.col("label_zero").alias("label"), r6("weight").alias("weight"))


def q_feature_shape(spark, root):
    e = table(spark, root, "embeddings")
    return e.agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.size("embedding")).alias("min_dim"),
                 F.max(F.size("embedding")).alias("max_dim"))


def q_image_normalise(spark, root):
    return _exploded(_px(spark, root), A.normalise(F.col("px")))


def q_image_rescale_pm1(spark, root):
    return _exploded(_px(spark, root), A.rescale_pm1(F.col("px")))


def q_array_flatten(spark, root):
    return _exploded(_px(spark, root), A.flatten2d(A.reshape(F.col("px"), H, W)), "pixel", rnd=False)


def q_array_reshape(spark, root):
    img = _px(spark, root).select("vec_id", A.reshape(F.col("px"), H, W).alias("img"))
    rows = img.select("vec_id", F.posexplode("img").alias("row", "r"))
    return rows.select("vec_id", F.col("row").cast("int").alias("row"),
                       F.posexplode("r").alias("col", "pixel")).withColumn("col", F.col("col").cast("int"))


def q_array_channel(spark, root):
    p = _px(spark, root).select("vec_id", A.add_channel(F.col("px")).alias("one"),
                                A.repeat_channels(F.col("px"), 3).alias("three"))
    z = p.select("vec_id", F.posexplode(F.arrays_zip("one", "three")).alias("pos", "z"))
    return z.select("vec_id", F.col("pos").cast("int").alias("pos"), F.size("z.one").alias("one_size"),
                    F.size("z.three").alias("three_size"),
                    F.aggregate("z.three", F.lit(0), lambda a, x: a + x).alias("three_sum"))


def q_array_vector_roundtrip(spark, root):
    e = _rows(spark, root).select("vec_id", vector_to_array(array_to_vector(F.col("embedding"))).alias("a"))
    return _exploded(e, F.col("a"))


def q_image_gray(spark, root):
    px = F.col("px")
    g = _px(spark, root).select("vec_id", A.rgb_to_gray(px, A.rotate(px, 1), A.rotate(px, 2)).alias("g"))
    out = g.select("vec_id", F.posexplode("g").alias("pos", "gray"))
    return out.select("vec_id", F.col("pos").cast("int").alias("pos"), F.round("gray", 4).alias("gray"))


def q_image_resize(spark, root):
    px = _px(spark, root).withColumn("px", F.col("px").cast("array<double>"))
    return _exploded(px.select("vec_id", resize_udf(H, W, H // 2, W // 2)(F.col("px")).alias("r")), F.col("r"))


def q_image_features(spark, root):
    px = _px(spark, root)
    f = px.select("vec_id", pixel_features_udf(H, W, H // 2, W // 2)(F.col("px")).alias("f"))
    return _exploded(f, F.col("f"))


def _shift(variant: str, axis: str):
    key = F.concat(F.col("vec_id").cast("string"), F.lit(f":42:{axis}"), F.col(variant).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(3) - F.lit(1)


def q_augment_shift(spark, root):
    v = _px(spark, root).withColumn("variant", F.explode(F.array(F.lit(0), F.lit(1))))
    s = v.select("vec_id", "variant",
                 A.shift_nearest(F.col("px"), H, W, _shift("variant", "dx"), _shift("variant", "dy")).alias("img"))
    out = s.select("vec_id", "variant", F.posexplode("img").alias("pos", "pixel"))
    return out.withColumn("pos", F.col("pos").cast("int"))


def _vectors(spark, root):
    return models.to_vector(_rows(spark, root), "embedding")


def q_scaler_moments(spark, root):
    m = models.scaler().fit(_vectors(spark, root))
    mo = models.scaler_moments(m, spark)
    return mo.select("dim", r6("mean").alias("mean"), r6("std").alias("std"))


def q_scaled_features(spark, root):
    v = _vectors(spark, root)
    scaled = models.scaler().fit(v).transform(v)
    return _exploded(scaled.select("vec_id", vector_to_array("scaled_features").alias("s")), F.col("s"))


def q_split_hash(spark, root):
    return split_hash(table(spark, root, "embeddings"), "vec_id").select("vec_id", "split")


def q_split_exact(spark, root):
    return split_exact(table(spark, root, "embeddings").select("vec_id"), "vec_id").select("vec_id", "split")


def q_split_exact_chunked(spark, root):
    ids = table(spark, root, "embeddings").select("vec_id")
    return split_exact(ids, "vec_id", strategy="chunked").select("vec_id", "split")


def q_split_stratified(spark, root):
    e = table(spark, root, "embeddings").select("vec_id", "label")
    return split_stratified(e, "vec_id", "label").select("vec_id", "label", "split")


def q_oversample_minority(spark, root):
    e = _rows(spark, root).select("vec_id", "y")
    return oversample_minority(e, "y", "vec_id").select("vec_id", "y", F.col("copy").cast("int").alias("copy"))


def q_union_balanced(spark, root):
    e = _rows(spark, root).select("vec_id", "y")
    over = oversample_minority(e.where(F.col("y") == 1).unionByName(e.where(F.col("y") == 0)), "y", "vec_id")
    major = over.where(F.col("y") == 0)
    minor = over.where(F.col("y") == 1)
    return major.unionByName(minor).groupBy("y").agg(F.count(F.lit(1)).alias("n_rows"))


def q_linear_score(spark, root):
    e = _rows(spark, root)
    s = models.linear_score(F.col("embedding"), WEIGHTS, BIAS)
    return e.select("vec_id", r6(s).alias("score"), M.threshold(s, 0.5).alias("prediction"))


def q_batch_inference(spark, root):
    e = _rows(spark, root)
    fn = models.batch_predict_udf(models.numpy_linear_model(WEIGHTS, BIAS, 64), "double", batch_size=256,
                                  input_tensor_shapes=[[64]])
    return e.select("vec_id", r6(fn(F.col("embedding"))).alias("score"))


def q_cv_folds(spark, root):
    return table(spark, root, "embeddings").select("vec_id", fold_column(F.col("vec_id")).alias("fold"))


def q_scan_images(spark, root):
    px = _px(spark, root)
    files = px.select(F.format_string("img_%d.png", "vec_id").alias("name"), png_udf(H, W)(F.col("px")).alias("png"))
    path = scratch_path(spark, "images")
    write_binary_files(files, "name", "png", path)
    img = read_images(spark, path)
    feats = pixel_features_udf(H, W, H, W)(F.col("pixels"))
    decoded = img.select(F.col("image.origin").alias("origin"), F.col("image.height").alias("height"),
                         F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"),
                         F.transform(F.sequence(F.lit(1), F.length("image.data")),
                                     lambda i: F.conv(F.hex(F.substring("image.data", i, 1)), 16, 10)
                                     .cast("int")).alias("pixels"))
    out = decoded.select(F.regexp_extract("origin", r"img_(\d+)\.png$", 1).cast("bigint").alias("vec_id"),
                         "height", "width", "n_channels",
                         F.round(F.aggregate(feats, F.lit(0.0), lambda a, x: a + x.cast("double")) * F.lit(255.0))
                         .cast("bigint").alias("pixel_sum"))
    return out


QUERIES = {
    "project_label_features": q_project_label_features,
    "with_column": q_with_column,
    "filter_minority": q_filter_minority,
    "row_count": q_row_count,
    "label_distribution": q_label_distribution,
    "label_totals": q_label_totals,
    "class_weights_balanced": q_class_weights_balanced,
    "class_weights_ratio": q_class_weights_ratio,
    "feature_shape": q_feature_shape,
    "image_normalise": q_image_normalise,
    "image_rescale_pm1": q_image_rescale_pm1,
    "array_flatten": q_array_flatten,
    "array_reshape": q_array_reshape,
    "array_channel": q_array_channel,
    "array_vector_roundtrip": q_array_vector_roundtrip,
    "image_gray": q_image_gray,
    "image_resize": q_image_resize,
    "image_features": q_image_features,
    "augment_shift": q_augment_shift,
    "scaler_moments": q_scaler_moments,
    "scaled_features": q_scaled_features,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "split_exact_chunked": q_split_exact_chunked,
    "split_stratified": q_split_stratified,
    "oversample_minority": q_oversample_minority,
    "union_balanced": q_union_balanced,
    "linear_score": q_linear_score,
    "batch_inference": q_batch_inference,
    "cv_folds": q_cv_folds,
    "scan_images": q_scan_images,
}

_Y = "CAST(list_sum(list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE))) > 0.45 AS INTEGER)"
_E = f"(SELECT vec_id, embedding, label, CAST(label = 0 AS INTEGER) AS label_zero, {_Y} AS y FROM embeddings)"
_PX = """(SELECT vec_id, list_transform(embedding,
             lambda x: least(255, greatest(0, CAST(floor((CAST(x AS DOUBLE) + 0.6) * 200) AS INTEGER)))) AS px
          FROM embeddings)"""
_PXE = f"(SELECT vec_id, CAST(generate_subscripts(px, 1) - 1 AS INTEGER) AS pos, unnest(px) AS p FROM {_PX})"
_EE = """(SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                 CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""
_H = "('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '{}'), 1, 8))::BIGINT"


def _mean2x2():
    a = "px[(2 * (i // 4)) * 8 + 2 * (i % 4) + 1]"
    b = "px[(2 * (i // 4)) * 8 + 2 * (i % 4) + 2]"
    c = "px[(2 * (i // 4) + 1) * 8 + 2 * (i % 4) + 1]"
    d = "px[(2 * (i // 4) + 1) * 8 + 2 * (i % 4) + 2]"
    return f"""(SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST({a} + {b} + {c} + {d} AS DOUBLE) / 4.0 AS m
               FROM {_PX}, range(0, 16) t(i))"""


_Y_OS = f"""(SELECT e.vec_id, e.y,
                CASE WHEN e.y = 1 THEN CAST(floor(k.ratio) AS INTEGER)
                       + CASE WHEN CAST({_H.format(':42:os')} AS DOUBLE) / 4294967296.0 < k.ratio - floor(k.ratio)
                              THEN 1 ELSE 0 END
                     ELSE 1 END AS copies
             FROM {_E} e, (SELECT sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) / sum(y) AS ratio FROM {_E}) k)"""

SQL = {
    "project_label_features": f"""SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_features,
        round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS feature_sum FROM embeddings""",
    "with_column": f"""SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS dim_sum,
        label_zero FROM {_E}""",
    "filter_minority": "SELECT vec_id, label FROM embeddings WHERE label = 0",
    "row_count": "SELECT count(*) AS n FROM embeddings",
    "label_distribution": "SELECT label, count(*) AS count FROM embeddings GROUP BY label",
    "label_totals": f"""SELECT CAST(sum(label_zero) AS BIGINT) AS positives, CAST(count(*) - sum(label_zero) AS BIGINT) AS negatives,
        CAST(sum(y) AS BIGINT) AS y_positives, CAST(count(*) - sum(y) AS BIGINT) AS y_negatives FROM {_E}""",
    "class_weights_balanced": f"""SELECT label, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight
        FROM (SELECT label_zero AS label, count(*) AS n_c FROM {_E} GROUP BY label_zero)""",
    "class_weights_ratio": f"""SELECT 0 AS label, 1.0 AS weight UNION ALL
        SELECT 1, round(sum(CASE WHEN label_zero = 0 THEN 1 ELSE 0 END) / sum(label_zero), 6) FROM {_E}""",
    "feature_shape": """SELECT count(*) AS n_rows, CAST(min(len(embedding)) AS INTEGER) AS min_dim,
        CAST(max(len(embedding)) AS INTEGER) AS max_dim FROM embeddings""",
    "image_normalise": f"SELECT vec_id, pos, round(CAST(CAST(p / 255.0 AS FLOAT) AS DOUBLE), 6) AS value FROM {_PXE}",
    "image_rescale_pm1": f"""SELECT vec_id, pos, round(CAST(CAST(p / 127.5 - 1.0 AS FLOAT) AS DOUBLE), 6) AS value
        FROM {_PXE}""",
    "array_flatten": f"SELECT vec_id, pos, p AS pixel FROM {_PXE}",
    "array_reshape": f"SELECT vec_id, pos // 8 AS row, pos % 8 AS col, p AS pixel FROM {_PXE}",
    "array_channel": f"SELECT vec_id, pos, 1 AS one_size, 3 AS three_size, 3 * p AS three_sum FROM {_PXE}",
    "array_vector_roundtrip": f"SELECT vec_id, pos, round(x, 6) AS value FROM {_EE}",
    "image_gray": f"""SELECT vec_id, CAST(i AS INTEGER) AS pos,
        round(CAST(0.299 AS DOUBLE) * px[i + 1] + CAST(0.587 AS DOUBLE) * px[(i + 1) % 64 + 1]
              + CAST(0.114 AS DOUBLE) * px[(i + 2) % 64 + 1], 4) AS gray
        FROM {_PX}, range(0, 64) t(i)""",
    "image_resize": f"SELECT vec_id, pos, round(m, 6) AS value FROM {_mean2x2()}",
    "image_features": f"""SELECT vec_id, pos, round(CAST(CAST(round_even(m, 0) / 255.0 AS FLOAT) AS DOUBLE), 6) AS value
        FROM {_mean2x2()}""",
    "augment_shift": f"""
        SELECT vec_id, variant, CAST(i AS INTEGER) AS pos,
               px[least(7, greatest(0, i // 8 - dy)) * 8 + least(7, greatest(0, i % 8 - dx)) + 1] AS pixel
        FROM (SELECT vec_id, px, variant,
                ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42:dx' || CAST(variant AS VARCHAR)), 1, 8))::BIGINT % 3 - 1 AS dx,
                ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':42:dy' || CAST(variant AS VARCHAR)), 1, 8))::BIGINT % 3 - 1 AS dy
              FROM {_PX}, (SELECT unnest([0, 1]) AS variant)), range(0, 64) t(i)""",
    "scaler_moments": f"SELECT pos AS dim, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM {_EE} GROUP BY pos",
    "scaled_features": f"""
        SELECT e.vec_id, e.pos, round(CASE WHEN s.sd = 0 THEN 0.0 ELSE (e.x - s.m) / s.sd END, 6) AS value
        FROM {_EE} e JOIN (SELECT pos, avg(x) AS m, stddev_samp(x) AS sd FROM {_EE} GROUP BY pos) s USING (pos)""",
    "split_hash": f"""SELECT vec_id, CASE WHEN {_H.format(':42')} % 100 < 20 THEN 'test' ELSE 'train' END AS split
        FROM embeddings""",
    "split_exact": f"""SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY {_H.format(':42')}, vec_id)
                                        <= (count(*) OVER () * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS split
        FROM embeddings""",
    "split_stratified": f"""SELECT vec_id, label,
          CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {_H.format(':42')}, vec_id)
                    <= (count(*) OVER (PARTITION BY label) * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS split
        FROM embeddings""",
    "oversample_minority": f"SELECT vec_id, y, CAST(unnest(range(0, copies)) AS INTEGER) AS copy FROM {_Y_OS}",
    "union_balanced": f"SELECT y, sum(copies)::BIGINT AS n_rows FROM {_Y_OS} GROUP BY y",
    "linear_score": f"""SELECT vec_id, round(1.0 / (1.0 + exp(-(s - 0.45))), 6) AS score,
          CAST(1.0 / (1.0 + exp(-(s - 0.45))) > 0.5 AS INTEGER) AS prediction
        FROM (SELECT vec_id, list_sum(list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE))) AS s FROM embeddings)""",
    "batch_inference": """SELECT vec_id, round(1.0 / (1.0 + exp(-(s - 0.45))), 6) AS score
        FROM (SELECT vec_id, list_sum(list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE))) AS s FROM embeddings)""",
    "cv_folds": f"SELECT vec_id, CAST({_H.format(':42:fold')} % 3 AS INTEGER) AS fold FROM embeddings",
    "scan_images": f"""SELECT vec_id, 8 AS height, 8 AS width, 1 AS n_channels, CAST(sum(p) AS BIGINT) AS pixel_sum
        FROM {_PXE} GROUP BY vec_id""",
}

SQL["split_exact_chunked"] = SQL["split_exact"]
