"""Exact duplicates by a distributed content sort.

Rows are range-partitioned by sampled splitters on the text without blanks
(a bounded prefix, then its digest, then the order of preference), so
even a group of copies that fills many partitions is spread evenly.  Each
partition sorts externally, equal texts become neighbours, and one pass compares
each text with the one before it in full.  Only the first and last
text of a partition are compared across partitions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecut.llm.common import BLANK, chosen, keyed, store

#: Characters of the normalised text that a splitter holds.
PREFIX = 48


def sorted_runs(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """The rows of ``docs`` (columns ``carry``) in content order, stored, each with its run of equal texts.

    ``_part`` and ``_run`` name the run, ``_at`` is the row's place in it (0: the row preferred), ``_n`` and
    ``_head`` its size and first id, ``_sha`` the digest.  The first and the last row of a partition
    (``_ends``: 1, 2, or 3 for both) hold their normalised text in ``_edge``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.regexp_replace("_text", BLANK, "")
    ties = [F.col("_len").desc(), F.col("_id").asc_nulls_last()]
    rows = docs.select(text.alias("_text"), F.col(id_col).alias("_id"), F.struct(*carry).alias("_row")) \
        .withColumn("_norm", norm) \
        .select("_text", "_id", "_row", F.length("_text").cast("long").alias("_len"),
                F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"), F.substring("_norm", 1, PREFIX).alias("_pre"))
    rows = rows.repartitionByRange("_pre", "_sha", *ties).sortWithinPartitions("_pre", "_sha", *ties)
    rows = rows.select("_id", "_sha", F.spark_partition_id().alias("_part"), "_row", norm.alias("_norm"))
    names = ["_id", "_sha", "_part", "_row"]
    schema = T.StructType([*(rows.schema[c] for c in names), *T._parse_datatype_string(
        "_run long, _at long, _n long, _ends int, _edge string"), T.StructField("_head", rows.schema["_id"].dataType)])

    def number(batches):
        # slices of the run that is open: without its texts, so a long run stays narrow
        held, run, size, before, head = [], -1, 0, None, None

        def close(last: bool):
            at = 0
            for n, b in enumerate(held):
                ends, edges = [0] * len(b), [None] * len(b)
                if run == 0 and n == 0:
                    ends[0], edges[0] = 1, before
                if last and n == len(held) - 1:
                    ends[-1], edges[-1] = ends[-1] + 2, before
                made = [(run, pa.int64()), (size, pa.int64())]
                runs, sizes = (pa.array([x] * len(b), t) for x, t in made)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, runs, pa.array(range(at, at + len(b)), pa.int64()), sizes, pa.array(ends, pa.int32()),
                     pa.array(edges, pa.string()), pa.array([head] * len(b), b.schema.field("_id").type)], schema.names)
                at += len(b)

        for b in batches:
            narrow, texts = b.select(names), b.column("_norm").to_pylist()
            begins = [i for i, t in enumerate(texts) if t != (texts[i - 1] if i else before)]
            edges = [*begins, len(texts)]
            if texts and edges[0]:  # the open run goes on
                held.append(narrow.slice(0, edges[0]))
                size += edges[0]
            for a, z in zip(edges, edges[1:]):
                if held:
                    yield from close(False)
                held, run, size, before, head = [narrow.slice(a, z - a)], run + 1, z - a, texts[a], b.column("_id")[a].as_py()
        if held:
            yield from close(True)

    return store(rows.mapInArrow(number, schema), "sorted")


def _across(rows: DataFrame) -> DataFrame:
    """(_part, _run, head, n, goes_on): runs that share their group with a run of another partition; stored.

    Two narrow rows a partition are compared in one task by digest; only where
    neighbours agree their texts are fetched and compared in full.
    """
    ends = rows.where("_ends > 0").select("_part", "_run", "_sha", "_n", F.col("_head").alias("head"), "_ends").repartition(1)
    run = F.struct("_run", "_sha", "_n", "head")
    parts = ends.groupBy("_part").agg(F.max_by(run, F.when(F.col("_ends").isin(1, 3), 1)).alias("first"),
                                      F.max_by(run, F.when(F.col("_ends").isin(2, 3), 1)).alias("last"))
    by_part = Window.orderBy("_part")
    parts = store(parts.withColumn("before", F.lag(F.struct("_part", "last")).over(by_part)), "edges")
    alike = parts.where("before.last._sha = first._sha").select("_part", F.col("before._part").alias("before"))
    text = rows.where("_ends > 0").select("_part", "_ends", "_edge")
    pair = F.broadcast(alike.select(F.col("_part").alias("pair"), "_part", F.lit(1).alias("side"))
                       .unionByName(alike.select(F.col("_part").alias("pair"), F.col("before").alias("_part"), F.lit(2).alias("side"))))
    same = text.join(pair, "_part").where("_ends in (side, 3)").groupBy("pair") \
        .agg((F.min("_edge") == F.max("_edge")).alias("goes_on")).where("goes_on").select(F.col("pair").alias("_part"), "goes_on")
    chain = parts.join(F.broadcast(same), "_part", "left").repartition(1)
    # a partition that is one single run which goes on passes its group along
    begun = F.when(F.col("goes_on") & (F.col("last._run") == 0), None).otherwise(F.struct("_part", "last._run", "last.head", "last._n"))
    chain = chain.withColumn("tail", F.last(begun, ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))).where("goes_on")
    whole = Window.partitionBy("tail._part")
    total = chain.select("_part", "tail", (F.sum("first._n").over(whole) + F.col("tail._n")).alias("n"))
    rest = total.select("_part", F.lit(0).cast("long").alias("_run"), F.col("tail.head").alias("head"), "n", F.lit(True).alias("goes_on"))
    begin = total.select("tail._part", "tail._run", "tail.head", "n", F.lit(False).alias("goes_on")).distinct()
    return store(rest.unionByName(begin), "across")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when identical without the six ASCII blanks; a null text
    is empty.  Of equal texts the row with the most code points stays, then
    the smallest id, nulls last; of rows equal in both, one stays (they differ in
    nothing that is read here).  No row is dropped.  An empty table gives no rows;
    other columns are ignored.
    """
    rows = sorted_runs(docs, id_col, text_col, [id_col])
    across = F.broadcast(_across(rows).withColumn("more", F.lit(True)))  # at most two rows for each partition
    return rows.join(across, ["_part", "_run"], "left").select(
        F.col("_id").alias("id"), F.when(F.col("more"), F.col("head")).otherwise(F.col("_head")).alias("keep_id"),
        F.coalesce("n", "_n").alias("group_size"), ((F.col("_at") == 0) & ~F.coalesce("goes_on", F.lit(False))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns of ``docs`` (see ``exact_groups``)."""
    named = keyed(docs)
    rows = named.select(F.col("_doc")[id_col].alias("_id"), F.col("_doc")[text_col].alias("_text"), "_key")
    rows = sorted_runs(rows, "_id", "_text", ["_key"])
    again = F.broadcast(_across(rows).where("goes_on").select("_part", "_run"))  # at most one row for each partition
    return chosen(named, rows.where("_at = 0").join(again, ["_part", "_run"], "left_anti").select("_row._key"))
