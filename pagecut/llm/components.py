"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecut.llm.common import store


def _rewire(pairs: DataFrame, keep) -> DataFrame:
    """Link every neighbour of ``u`` that ``keep`` accepts to the least node around ``u``.

    The least node comes from a partial aggregate; the join with the edges
    is a plain equi-join, so a hub's edges are split by adaptive skew joins
    and never gathered in one group.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph whose edges are the two columns of ``edges``.

    Returns (node, component): one row for each node that has an edge to
    another node, ``component`` being the smallest node reachable.  Loops,
    repeated edges and edges with a null end count for nothing; no edges
    give no rows.  Each round rewires edges towards smaller nodes, so the
    edge count never grows; it is written to the shared folder, and its count
    and checksum (one row) decide whether another round is needed.
    """
    a, b = edges.columns
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, seen = store(e, "edges"), None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the least node around u
        large = _rewire(both, F.col("v") > F.col("u")).where("u != v").distinct()
        # small star: u and its smaller neighbours move to the least of them
        small = _rewire(large, F.col("v") != F.col("m")).unionByName(
            large.groupBy("u").agg(F.min("v").alias("v"))).where("u != v").distinct()
        e = store(small, "edges")
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = tuple(mark)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
