import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from pagecut.functions.image import augment_udf
from pagecut.ml import models
from pagecut.operators import metrics as M
from pagecut.session import get_spark, scratch_path
from pagecut.sources.files import binary_to_pages, list_files
from pagecut.sources.frames import frame, squares


def test_session_is_reused(spark):
    assert get_spark() is spark


def test_smoke_frames(spark):
    df = frame(spark, [("p-07", 12), ("p-19", 3), ("p-23", 6), ("p-31", 0)], ["part", "stock"])
    assert dict(df.dtypes)["stock"] == "bigint"
    assert df.groupBy().avg("stock").first()[0] == 5.25
    assert [r["square"] for r in squares(spark, 1, 6).collect()] == [1, 4, 9, 16, 25]


def test_roc_drop_intermediate(spark):
    data = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (1, 0.4)]
    df = spark.createDataFrame(data, "label int, score double")
    full = rows(M.roc_curve(df), "threshold")
    slim = sorted(r["threshold"] for r in M.roc_curve(df, drop_intermediate=True).collect())
    # (fp, tp): 0.9 (0,1), 0.8 (0,2), 0.7 (0,3), 0.6 (1,3), 0.5 (2,3), 0.4 (2,4);
    # 0.8 and 0.6 are collinear with their neighbours; first score point kept
    assert slim == [0.4, 0.5, 0.7, 0.9, float("inf")]
    assert len(full) == 7


def test_history_helpers_and_best_model(spark):
    h = spark.createDataFrame([(0, "loss", 3.0), (1, "loss", 2.0), (1, "val_loss", 2.5)],
                              "iteration int, metric string, value double")
    assert {r["metric"] for r in models.drop_validation_metrics(h).collect()} == {"loss"}
    last = {r["metric"]: r["value"] for r in models.last_per_metric(h).collect()}
    assert last == {"loss": 2.0, "val_loss": 2.5}
    key, m = models.best_model({"a": "A", "b": "B"}, {"a": 0.7, "b": 0.9})
    assert (key, m) == ("b", "B")


def test_binary_bundles_to_pages(spark):
    d = scratch_path(spark, "bundles")
    local = d[len("file:"):] if d.startswith("file:") else d
    import os
    os.makedirs(local)
    for name, body in {"a.pdf": b"p0|p1|p2", "b.pdf": b"q0", "bad.pdf": b"", "torn.pdf": b"!", "note.txt": b"x"}.items():
        with open(os.path.join(local, name), "wb") as fh:
            fh.write(body)
    files = list_files(spark, d, "*.pdf", with_content=True)

    def splitter(content: bytes):
        if content in (b"", b"!"):
            raise ValueError("cannot open")
        return content.split(b"|")
    pages = binary_to_pages(files, splitter)
    got = rows(pages, "pdf_name", "page_number")
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]
    told = binary_to_pages(files, splitter, report_errors=True).where("error is not null").collect()
    assert [(r["pdf_name"], r["page_number"], r["error"]) for r in told] == [("torn", None, "ValueError: cannot open")]  # an empty file is not listed with content


def test_augmentation_is_deterministic():
    run = augment_udf(8, 8, variants=3)
    pdf = pd.DataFrame({"id": [1, 2], "px": [list(np.arange(64.0)), list(np.arange(64.0)[::-1])]})
    a = pd.concat(run(iter([pdf]), "id", "px"))
    b = pd.concat(run(iter([pdf]), "id", "px"))
    assert len(a) == 6 and all(x == y for x, y in zip(a["px"], b["px"]))
    # bilinear resampling of an image stays within its value range
    assert min(a["px"].iloc[0]) >= 0.0 and max(a["px"].iloc[0]) <= 63.0
    # images of another size and missing ones keep their rows
    odd = pd.DataFrame({"id": [3, 4], "px": [[1.0, 2.0], None]})
    out = pd.concat(run(iter([odd]), "id", "px"))
    assert list(out["id"]) == [3, 3, 3, 4, 4, 4] and out["px"].isna().all()


def test_image_features_in_slices_and_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from pagecut.functions import image
    monkeypatch.setattr(image, "SLICE_BYTES", 4 * 6 * 3)  # three images a slice
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        c = (1, 3, 4)[i % 3]
        px = rng.integers(0, 256, (3 + i % 4, 5, c), dtype=np.uint8)
        h, data = (-1, b"") if i % 7 == 0 else (px.shape[0], px.tobytes())
        rows.append((i, ("f", h, 5, c, 0, bytearray(data)) if i != 11 else None))
    df = spark.createDataFrame(rows, "id int, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>").repartition(2)
    flat = df.select("id", image.image_features(F.col("image"), 2, 3).alias("f")).where("f is not null")
    assert flat._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = {r.id: r.f for r in flat.collect()}
    assert set(got) == {i for i in range(40) if i % 7 and i != 11}
    for i, f in got.items():
        _, h, w, c, _, data = rows[i][1]
        px = np.frombuffer(bytes(data), np.uint8).reshape(h, w, c)
        gray = px[..., 0] if c == 1 else image.gray_u8(px[..., 2::-1][..., :3])
        want = np.clip(np.rint(image.resize_bilinear(gray, 2, 3)), 0, 255) / 255
        assert np.allclose(f, want.ravel(), atol=1e-6)
    square = {r.id: r.f for r in df.select("id", image.image_2d_udf(2, 3)(F.col("image")).alias("f")).collect()}
    assert square[0] is None and all([x for row in square[i] for x in row] == f for i, f in got.items())


def test_training_reports_missing_pages(spark):
    from pyspark.sql import functions as F

    from conftest import SF_MID
    from pagecut.operators import labels as L
    from pagecut.plans.catalog import ml as catalog
    from pagecut.plans.jobs import train_from_store
    root, store = catalog._write_bundle_images(spark, SF_MID)
    more = spark.createDataFrame([("label_0", [0], 60), ("ghost", [1], 2)], "bundle string, target_pages array<int>, total_pages int")
    L.write_label_store(more, store, mode="append")
    res = train_from_store(spark, store, root, size=(8, 8))
    assert {(r.bundle, r.page_number) for r in res.missing_pages.where(F.col("bundle") == "ghost").collect()} == {("ghost", 0), ("ghost", 1)}
    assert [r.bundle for r in res.missing_bundles.collect()] == ["ghost"]
    assert res.missing_pages.where("bundle = 'label_0'").count() == 60 - 50


def _png(px, kinds, extra=b""):
    """A PNG of 8-bit samples whose row y is stored by filter ``kinds[y]`` (0 as it is, 1 left, 2 above); ``extra`` chunks before the data."""
    import struct
    import zlib
    h, w, c = px.shape
    flat, lines = px.reshape(h, w * c), []
    for y, kind in enumerate(kinds):
        before = {0: np.zeros(w * c, np.uint8), 1: np.concatenate([np.zeros(c, np.uint8), flat[y, :-c]]), 2: flat[y - 1] if y else np.zeros(w * c, np.uint8)}[kind]
        lines.append(bytes([kind]) + (flat[y] - before).tobytes())
    chunk = lambda tag, body: struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))
    data = zlib.compress(b"".join(lines))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if c == 1 else 2, 0, 0, 0)) + (chunk(b"tEXt", extra) if extra else b"")
            + chunk(b"IDAT", data[:20]) + chunk(b"IDAT", data[20:]) + chunk(b"IEND", b""))


def test_image_pages_equal_the_image_source(spark):
    """Plain PNGs, others, broken files and odd names: the features that Spark's own source gives."""
    from pyspark.sql import functions as F

    from pagecut.functions.image import image_features, plain_png
    from pagecut.plans.jobs import image_pages
    from pagecut.session import scratch_path
    from pagecut.sinks.files import write_binary_files
    from pagecut.sources.files import few_tasks, read_images
    rng = np.random.default_rng(5)
    files, n_plain = [], 0
    for i in range(150):
        px = rng.integers(0, 256, (4 + i % 3, 5, (1, 3)[i % 2]), dtype=np.uint8)
        data = _png(px, [(i + y) % 3 if i % 5 else 0 for y in range(len(px))], b"Title\0x" if i % 11 == 3 else b"")
        if i % 13 == 6:
            data = data[:-9] if i % 2 else data[:50] + b"?" + data[51:]
        elif i % 11 != 3:
            assert (plain_png(data).reshape(px.shape) == px).all()
        n_plain += plain_png(data) is not None
        files.append((f"{('a', 'b c', 'd+e%20f')[i % 3]}/page_{i}.png", data))
    assert 0 < n_plain < 150 and plain_png(b"") is None and plain_png(b"\x89PNG\r\n\x1a\n") is None
    root = scratch_path(spark, "mixed")
    write_binary_files(spark.createDataFrame(files, "n string, c binary").repartition(4), "n", "c", root)
    want = {r.o.rsplit("_", 1)[1]: r.f for r in read_images(spark, root).select(
        F.col("image.origin").alias("o"), image_features(F.col("image"), 3, 4).alias("f")).collect()}
    got = image_pages(spark, root, (3, 4)).collect()
    assert {f"{r.page_number}.png": r.features for r in got} == want and len(got) == 150
    assert sorted(r.path for r in got) == sorted(f"file://{root.removeprefix('file:')}/{n}" for n, _ in files)
    assert all(r.path.split("/")[-2] == r.pdf_name for r in got)
    scan = read_images(spark, root)
    assert scan.rdd.getNumPartitions() > 3 and few_tasks(scan.coalesce(3)).rdd.getNumPartitions() == 3


def test_first_pages_are_scored_once(spark):
    """What is written, sorted and returned comes from one table of the predicted pages, not from scoring again."""
    from pyspark.sql import functions as F

    from pagecut.plans.jobs import predict_first_pages, score_pages, train
    from pagecut.session import scratch_path
    rows = spark.range(400).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"), F.array(
        (F.col("id") % 4).cast("float"), (F.col("id") % 7).cast("float")).alias("features"))
    path, lines = scratch_path(spark, "model"), scratch_path(spark, "lines")
    train(rows, "id", "y", model_path=path)
    pages = rows.withColumn("path", F.col("id").cast("string"))
    firsts = predict_first_pages(pages, path, ["id"], paths_out=lines, path_col="path")
    plan = firsts._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan and "Range" not in plan and "firsts" in "".join(firsts.inputFiles())
    want = sorted(r.id for r in score_pages(pages, path).where("prediction = 1").collect())
    assert [r.id for r in firsts.collect()] == want and sorted(int(r.value) for r in spark.read.text(lines).collect()) == want and want
