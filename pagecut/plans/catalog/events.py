"""Events as bundles: ``user_id`` bundles, pages ordered by ``(ts, event_id)``,
first page = ``signup``; scores ``value / 500`` with label ``error``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagecut.functions.formats import ISO_FORMAT, RUN_TAG_FORMAT
from pagecut.operators.metrics import log_loss, threshold
from pagecut.operators.pages import number_pages
from pagecut.operators.segments import segment_pages, segment_range_join, segment_ranges
from pagecut.plans import standins as S
from pagecut.plans.catalog.common import r6
from pagecut.plans.jobs import split_bundles
from pagecut.session import scratch_path

KEYS = ["user_id"]
ORDER = ["ts", "event_id"]


def q_segment_pages(spark, root, strategy="auto"):
    seg = segment_pages(S.events(spark, root), KEYS, ORDER, S.is_signup(), strategy=strategy)
    return seg.select("event_id", "user_id", "page_number", "segment_id")


def q_segment_pages_chunked(spark, root):
    return q_segment_pages(spark, root, strategy="chunked")


def q_page_numbering(spark, root):
    return number_pages(S.events(spark, root), KEYS, ORDER).select("event_id", "user_id", "page_number")


def _all_numbered(spark, root):
    return segment_pages(S.events(spark, root), KEYS, ORDER, S.is_signup(), include_leading=True)


def q_segment_ranges(spark, root):
    r = segment_ranges(_all_numbered(spark, root), KEYS)
    return r.select("user_id", "segment_id", "segment_name", "start_page", "end_page",
                    F.col("n_pages").cast("bigint").alias("n_pages"), "total_pages")


def q_segment_range_join(spark, root):
    numbered = _all_numbered(spark, root)
    ranges = segment_ranges(numbered, KEYS)
    j = segment_range_join(numbered.drop("segment_id"), ranges, KEYS)
    return j.select("event_id", "user_id", "page_number", "segment_id")


def q_predicted_first_pages(spark, root):
    n = number_pages(S.events(spark, root), KEYS, ORDER)
    return n.where(S.is_signup()).select("user_id", "page_number").orderBy("user_id", "page_number")


def q_segment_documents(spark, root):
    path = scratch_path(spark, "segments")
    split_bundles(S.events(spark, root).select("event_id", "ts", "user_id", "event_type"),
                  KEYS, ORDER, S.is_signup(), out_path=path)
    back = spark.read.parquet(path)
    return back.groupBy("user_id", "segment_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.min_by("event_id", "page_number").alias("first_event_id"),
        F.max_by("event_id", "page_number").alias("last_event_id"))


def q_job_split_written(spark, root):
    """Ranges as the written segments give them."""
    _, ranges = split_bundles(S.events(spark, root), KEYS, ORDER, S.is_signup(), out_path=scratch_path(spark, "segments"))
    return ranges.select("user_id", "segment_id", "segment_name", "start_page", "end_page",
                         F.col("n_pages").cast("bigint").alias("n_pages"), "total_pages")


def q_job_split(spark, root):
    _, ranges = split_bundles(S.events(spark, root), KEYS, ORDER, S.is_signup())
    return ranges.select("user_id", "segment_id", "segment_name", "start_page", "end_page",
                         F.col("n_pages").cast("bigint").alias("n_pages"), "total_pages")


def q_threshold_predictions(spark, root):
    e = S.events(spark, root)
    score = F.col("value") / F.lit(S.SCORE_SCALE)
    return e.select("event_id", r6(score).alias("score"), threshold(score, 0.5).alias("prediction"))


def q_log_loss(spark, root):
    e = S.events(spark, root).withColumn("y", (F.col("event_type") == "error").cast("int"))
    out = log_loss(e, "y", F.col("value") / F.lit(S.SCORE_SCALE))
    return out.select(r6("log_loss").alias("log_loss"), "n")


def q_iso_timestamp(spark, root):
    return S.events(spark, root).select("event_id", F.date_format("ts", ISO_FORMAT).alias("ts_iso"))


def q_run_tag(spark, root):
    return S.events(spark, root).select("event_id", F.date_format("ts", RUN_TAG_FORMAT).alias("run_tag"))


def q_event_props(spark, root):
    e = S.events(spark, root)
    return e.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


QUERIES = {
    "segment_pages": q_segment_pages,
    "segment_pages_chunked": q_segment_pages_chunked,
    "page_numbering": q_page_numbering,
    "segment_ranges": q_segment_ranges,
    "segment_range_join": q_segment_range_join,
    "predicted_first_pages": q_predicted_first_pages,
    "segment_documents": q_segment_documents,
    "job_split": q_job_split,
    "job_split_written": q_job_split_written,
    "threshold_predictions": q_threshold_predictions,
    "log_loss": q_log_loss,
    "iso_timestamp": q_iso_timestamp,
    "run_tag": q_run_tag,
    "event_props": q_event_props,
}

_NUMBERED = """
  SELECT event_id, user_id,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS page_number,
    CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS segment_id
  FROM events"""

_SEGMENT_PAGES = f"SELECT event_id, user_id, page_number, segment_id FROM ({_NUMBERED}) WHERE segment_id > 0"

_RANGES = f"""
WITH n AS ({_NUMBERED}),
seg AS (SELECT user_id, segment_id, min(page_number) AS start_page, count(*) AS n_pages
        FROM n WHERE segment_id > 0 GROUP BY user_id, segment_id),
tot AS (SELECT user_id, CAST(max(page_number) + 1 AS INTEGER) AS total_pages FROM n GROUP BY user_id)
SELECT s.user_id, s.segment_id, 'segment_' || CAST(s.segment_id AS VARCHAR) AS segment_name, s.start_page,
       CAST(coalesce(lead(s.start_page) OVER (PARTITION BY s.user_id ORDER BY s.segment_id), t.total_pages)
            AS INTEGER) AS end_page,
       CAST(s.n_pages AS BIGINT) AS n_pages, t.total_pages
FROM seg s JOIN tot t USING (user_id)"""

SQL = {
    "segment_pages": _SEGMENT_PAGES,
    "segment_pages_chunked": _SEGMENT_PAGES,
    "page_numbering": f"SELECT event_id, user_id, page_number FROM ({_NUMBERED})",
    "segment_ranges": _RANGES,
    "segment_range_join": _SEGMENT_PAGES,
    "predicted_first_pages": f"""
        SELECT n.user_id, n.page_number FROM ({_NUMBERED}) n JOIN events e USING (event_id)
        WHERE e.event_type = 'signup' ORDER BY 1, 2""",
    "segment_documents": f"""
        SELECT user_id, segment_id, count(*) AS n_pages, arg_min(event_id, page_number) AS first_event_id,
               arg_max(event_id, page_number) AS last_event_id
        FROM ({_SEGMENT_PAGES}) GROUP BY user_id, segment_id""",
    "job_split": _RANGES,
    "job_split_written": _RANGES,
    "threshold_predictions": """
        SELECT event_id, round(value / 500.0, 6) AS score, CAST(value / 500.0 > 0.5 AS INTEGER) AS prediction
        FROM events""",
    "log_loss": """
        SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss, count(*) AS n FROM (
          SELECT CAST(event_type = 'error' AS DOUBLE) AS y,
                 least(greatest(value / 500.0, 1e-7), 1 - 1e-7) AS p FROM events)""",
    "iso_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_iso FROM events",
    "run_tag": "SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') AS run_tag FROM events",
    "event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
}
