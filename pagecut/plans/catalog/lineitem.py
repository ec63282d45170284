"""Lineitem as bundles with gaps and duplicates: bundle ``l_orderkey``, page
``l_linenumber - 1``; predicted first pages = returned lines, true = open."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pagecut.ml.models import assemble
from pagecut.operators import labels as L
from pagecut.operators.metrics import match_flags, prf_of
from pagecut.operators.profile import quality_profile
from pagecut.plans import standins as S
from pagecut.plans.catalog.common import r6
from pagecut.sources.tables import table

KEYS = ["l_orderkey", "page_number"]
PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _expected(spark, root):
    li = table(spark, root, "lineitem")
    totals = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("total_pages"))
    return L.expected_pages(totals, "l_orderkey")


def _present(spark, root):
    return S.line_pages(spark, root).select(*KEYS).distinct()


def q_expected_present(spark, root):
    return L.expected_present(_expected(spark, root), _present(spark, root), KEYS)


def q_expected_missing(spark, root):
    return L.expected_missing(_expected(spark, root), _present(spark, root), KEYS)


def q_match_predictions(spark, root):
    p = S.line_pages(spark, root)
    return match_flags(p, S.is_predicted(), S.is_true(), KEYS)


def q_pages_intersect(spark, root):
    p = S.line_pages(spark, root)
    return S.predicted_lines(p).intersect(S.true_lines(p))


def q_pages_except(spark, root):
    p = S.line_pages(spark, root)
    pred, true = S.predicted_lines(p), S.true_lines(p)
    return pred.subtract(true).withColumn("side", F.lit("fp")) \
        .union(true.subtract(pred).withColumn("side", F.lit("fn")))


def q_bundle_prf(spark, root):
    p = S.line_pages(spark, root)
    m = prf_of(match_flags(p, S.is_predicted(), S.is_true(), KEYS), "l_orderkey")
    return m.select("l_orderkey", "tp", "fp", "fn", r6("precision").alias("precision"),
                    r6("recall").alias("recall"), r6("f1").alias("f1"))


def q_quality_profile(spark, root):
    prof = quality_profile(table(spark, root, "lineitem"), PROFILE_COLS)
    return prof.select("col_name", "count", "null_count",
                       *[r6(c).alias(c) for c in ["mean", "stddev", "min", "p25", "p50", "p75", "max"]])


def q_assemble_numeric(spark, root):
    li = table(spark, root, "lineitem")
    a = assemble(li, PROFILE_COLS).withColumn("__a", vector_to_array("features_vector"))
    return a.select("l_orderkey", "l_linenumber", *[r6(F.col("__a")[i]).alias(f"f{i}") for i in range(4)])


QUERIES = {
    "expected_present": q_expected_present,
    "expected_missing": q_expected_missing,
    "match_predictions": q_match_predictions,
    "pages_intersect": q_pages_intersect,
    "pages_except": q_pages_except,
    "bundle_prf": q_bundle_prf,
    "quality_profile": q_quality_profile,
    "assemble_numeric": q_assemble_numeric,
}

_EXPECTED = """(SELECT l_orderkey, CAST(unnest(range(0, total)) AS INTEGER) AS page_number
               FROM (SELECT l_orderkey, max(l_linenumber) AS total FROM lineitem GROUP BY l_orderkey)
               WHERE total > 0)"""
_PRESENT = "(SELECT DISTINCT l_orderkey, CAST(l_linenumber - 1 AS INTEGER) AS page_number FROM lineitem)"
_PRED = "(SELECT DISTINCT l_orderkey, CAST(l_linenumber - 1 AS INTEGER) AS page_number FROM lineitem WHERE l_returnflag = 'R')"
_TRUE = "(SELECT DISTINCT l_orderkey, CAST(l_linenumber - 1 AS INTEGER) AS page_number FROM lineitem WHERE l_linestatus = 'O')"
_MATCH = f"""(SELECT coalesce(p.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(p.page_number, t.page_number) AS page_number,
                 p.l_orderkey IS NOT NULL AS in_pred, t.l_orderkey IS NOT NULL AS in_true
              FROM {_PRED} p FULL OUTER JOIN {_TRUE} t ON p.l_orderkey = t.l_orderkey AND p.page_number = t.page_number)"""


def _profile_sql(c: str) -> str:
    return f"""SELECT '{c}' AS col_name, count({c}) AS count, count(*) - count({c}) AS null_count,
                 round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min,
                 round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
                 round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem"""


SQL = {
    "expected_present": f"""SELECT e.l_orderkey, e.page_number FROM {_EXPECTED} e
        WHERE EXISTS (SELECT 1 FROM {_PRESENT} p WHERE p.l_orderkey = e.l_orderkey AND p.page_number = e.page_number)""",
    "expected_missing": f"""SELECT e.l_orderkey, e.page_number FROM {_EXPECTED} e
        WHERE NOT EXISTS (SELECT 1 FROM {_PRESENT} p WHERE p.l_orderkey = e.l_orderkey AND p.page_number = e.page_number)""",
    "match_predictions": f"SELECT * FROM {_MATCH}",
    "pages_intersect": f"SELECT * FROM {_PRED} INTERSECT SELECT * FROM {_TRUE}",
    "pages_except": f"""SELECT *, 'fp' AS side FROM ({_PRED} EXCEPT SELECT * FROM {_TRUE})
        UNION ALL SELECT *, 'fn' AS side FROM ({_TRUE} EXCEPT SELECT * FROM {_PRED})""",
    "bundle_prf": f"""
        WITH s AS (SELECT l_orderkey,
                     CAST(sum(CASE WHEN in_pred AND in_true THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                     CAST(sum(CASE WHEN in_pred AND NOT in_true THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                     CAST(sum(CASE WHEN in_true AND NOT in_pred THEN 1 ELSE 0 END) AS BIGINT) AS fn
                   FROM {_MATCH} GROUP BY l_orderkey),
        m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM s)
        SELECT l_orderkey, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall,
               round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM m""",
    "quality_profile": " UNION ALL ".join(_profile_sql(c) for c in PROFILE_COLS),
    "assemble_numeric": """SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS f0, round(l_extendedprice, 6) AS f1,
                                  round(l_discount, 6) AS f2, round(l_tax, 6) AS f3 FROM lineitem""",
}
