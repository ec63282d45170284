from pyspark.sql import functions as F

from conftest import rows
from pagecut.operators.segments import (read_segment, segment_pages, segment_range_join, segment_ranges,
                                        write_segments)
from pagecut.session import scratch_path


def _bundle(spark, n, firsts, name="b"):
    return spark.createDataFrame([(name, i, i in firsts) for i in range(n)], "bundle string, pos int, f boolean")


def _seg(spark, df, **kw):
    return segment_pages(df, ["bundle"], ["pos"], F.col("f"), **kw)


def test_reference_cut(spark):
    # boundaries 0, 3, 5 of a 7-page bundle: [0,3) [3,5) [5,7)
    seg = _seg(spark, _bundle(spark, 7, {0, 3, 5}), include_leading=True)
    r = segment_ranges(seg, ["bundle"])
    assert rows(r, "segment_id", "start_page", "end_page", "segment_name") == [
        (1, 0, 3, "segment_1"), (2, 3, 5, "segment_2"), (3, 5, 7, "segment_3")]


def test_no_boundary_no_segment(spark):
    df = _bundle(spark, 5, set())
    assert _seg(spark, df).count() == 0
    lead = _seg(spark, df, include_leading=True)
    assert {r["segment_id"] for r in lead.collect()} == {0}


def test_leading_pages_dropped_and_adjacent_and_last(spark):
    seg = _seg(spark, _bundle(spark, 6, {2, 3, 5}), include_leading=True)
    kept = seg.where("segment_id > 0")
    assert rows(kept, "page_number", "segment_id") == [(2, 1), (3, 2), (4, 2), (5, 3)]
    r = segment_ranges(seg, ["bundle"])
    assert rows(r, "segment_id", "start_page", "end_page") == [(1, 2, 3), (2, 3, 5), (3, 5, 6)]


def test_segments_disjoint_and_cover(spark):
    import random
    rnd = random.Random(3)
    data = []
    for b in range(20):
        n = rnd.randint(1, 60)
        data += [(f"b{b}", i, rnd.random() < 0.2) for i in range(n)]
    df = spark.createDataFrame(data, "bundle string, pos int, f boolean")
    seg = _seg(spark, df, include_leading=True, strategy="chunked")
    r = segment_ranges(seg, ["bundle"]).collect()
    by = {}
    for x in r:
        by.setdefault(x["bundle"], []).append((x["start_page"], x["end_page"]))
    for b, spans in by.items():
        spans.sort()
        for (s1, e1), (s2, e2) in zip(spans, spans[1:]):
            assert e1 == s2
        pages = [p for p in data if p[0] == b]
        first = min(i for _, i, f in pages if f)
        assert spans[0][0] == first and spans[-1][1] == len(pages)
    # window form == binned range-join form
    ranges = segment_ranges(seg, ["bundle"])
    j = segment_range_join(seg.drop("segment_id"), ranges, ["bundle"], bin_size=4)
    assert rows(j, "bundle", "page_number", "segment_id") == rows(
        seg.where("segment_id > 0"), "bundle", "page_number", "segment_id")


def test_write_and_read_segment(spark):
    seg = _seg(spark, _bundle(spark, 9, {1, 4}))
    for layout in ("clustered", "folders"):
        path = scratch_path(spark, "segtest")
        write_segments(seg, path, ["bundle"], layout=layout)
        got = read_segment(spark, path, {"bundle": "b"}, 2)
        assert sorted(r["page_number"] for r in got.collect()) == [4, 5, 6, 7, 8]


def test_ranges_with_gaps_use_next_start(spark):
    # pages 0, 1, 4, 5, 9 present; boundaries at 1 and 5; total 12
    df = spark.createDataFrame([("b", p, p in (1, 5)) for p in (0, 1, 4, 5, 9)],
                               "bundle string, page_number int, f boolean")
    seg = segment_pages(df, ["bundle"], ["page_number"], F.col("f"), number=False, include_leading=True)
    totals = spark.createDataFrame([("b", 12)], "bundle string, total_pages int")
    r = segment_ranges(seg, ["bundle"], total_pages=totals, contiguous=False)
    assert rows(r, "segment_id", "start_page", "end_page", "n_pages") == [(1, 1, 5, 2), (2, 5, 12, 2)]
    assert rows(segment_ranges(seg, ["bundle"], contiguous=False), "end_page") == [(5,), (10,)]


def test_split_bundles_with_given_page_numbers_keeps_gaps(spark):
    from pagecut.plans.jobs import split_bundles
    df = spark.createDataFrame([("b", p, p in (1, 5)) for p in (0, 1, 2, 5, 9)],
                               "bundle string, page_number int, f boolean")
    _, r = split_bundles(df, ["bundle"], ["page_number"], F.col("f"), number=False)
    # segment 1 runs to the next first page (5), not to its last present page + 1 (3)
    assert rows(r, "segment_id", "start_page", "end_page") == [(1, 1, 5), (2, 5, 10)]
