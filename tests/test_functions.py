import os

import numpy as np
from pyspark.sql import functions as F

from pagecut.functions import arrays as A
from pagecut.functions import paths as P
from pagecut.functions.image import encode_png_gray, image_features, resize_bilinear
from pagecut.functions.udfs import null_on_error
from pagecut.session import scratch_path
from pagecut.sources.files import read_images


def test_path_functions(spark):
    df = spark.createDataFrame([("data/a.pdf.pdf/page_10.png",), ("data/a.pdf.pdf/page_2.png",)], "p string")
    folder = F.element_at(F.split("p", "/"), 2)
    got = df.select(P.basename(F.col("p")).alias("b"), P.strip_extension(folder).alias("s"),
                    P.strip_all(folder).alias("r"), P.page_number_from_path(F.col("p")).alias("n"))
    out = got.orderBy("n").collect()
    assert [r["n"] for r in out] == [2, 10]                # numeric, not by file name
    assert out[0]["s"] == "a.pdf" and out[0]["r"] == "a"   # splitext vs replace differ


def test_reshape_flatten_roundtrip(spark):
    df = spark.createDataFrame([(list(range(12)),)], "a array<int>")
    r = df.select(A.reshape(F.col("a"), 3, 4).alias("m")).first()["m"]
    assert r == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]
    assert df.select(A.flatten2d(A.reshape(F.col("a"), 3, 4))).first()[0] == list(range(12))


def test_bilinear_half_pixel():
    img = np.arange(16, dtype=float).reshape(4, 4)
    out = resize_bilinear(img, 2, 2)
    assert np.allclose(out, img.reshape(2, 2, 2, 2).mean(axis=(1, 3)))
    up = resize_bilinear(np.array([[0.0, 4.0]]), 1, 4)
    assert np.allclose(up, [[0.0, 1.0, 3.0, 4.0]])


def test_png_decode_valid_and_corrupt(spark):
    d = scratch_path(spark, "png")
    local = d[len("file:"):] if d.startswith("file:") else d
    os.makedirs(local)
    px = (np.arange(64).reshape(8, 8) * 4).astype(np.uint8)
    with open(os.path.join(local, "page_0.png"), "wb") as fh:
        fh.write(encode_png_gray(px))
    with open(os.path.join(local, "page_1.png"), "wb") as fh:
        fh.write(b"\x89PNG not really")
    imgs = read_images(spark, d)
    got = {os.path.basename(r["o"]): r for r in imgs.select(
        F.col("image.origin").alias("o"), F.col("image.height").alias("h"),
        image_features(F.col("image"), 4, 4).alias("f")).collect()}
    assert got["page_1.png"]["h"] == -1 and got["page_1.png"]["f"] is None
    f = np.array(got["page_0.png"]["f"]).reshape(4, 4)
    exp = np.rint(px.astype(float).reshape(4, 2, 4, 2).mean(axis=(1, 3))) / 255.0
    assert np.allclose(f, exp, atol=1e-6)
    assert read_images(spark, d, drop_invalid=True).count() == 1


def test_null_on_error(spark):
    @null_on_error("int")
    def parse(v):
        return int(v)
    df = spark.createDataFrame([("1",), ("x",)], "s string")
    out = sorted(df.select(parse(F.col("s")).alias("r")).select("r.value", "r.error").collect(),
                 key=lambda r: r["value"] is None)
    assert out[0]["value"] == 1 and out[0]["error"] is None
    assert out[1]["value"] is None and "ValueError" in out[1]["error"]
