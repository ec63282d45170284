"""Mixing sources to target weights by weighted fair queueing.

Every document offers copies of itself; a copy's virtual finish time is the
running total of its source's words in shuffled order, divided by the source's
target.  Copies are taken in global order of finish time until the budget is
spent.  Running totals use ranges: totals of small ranges of the shuffled
order (or of finish time) come from partial aggregates, and rows are only ordered
inside one range, so no source and no sort lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagecut.llm.common import keyed, n_words, store

#: Ranges of the shuffled order within a source; finish times are cut into as many per unit, then each into as many again.
RANGES = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """(source, source_size, target): one row for each source.

    Sources in code point order, null last, take the weights in turn and
    share ``share`` of all words; a target stops at ``cap`` times its
    source's size and the excess goes to the others by weight.  The windows
    run over one narrow row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("most", cap * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.coalesce(F.sum("most").over(earlier), F.lit(0))
    open_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0))
    # the level at which sources fill, if all before this one in the order are full
    per = per.withColumn("level", (share * F.sum("source_size").over(everything) - full) / open_w)
    per = per.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"])
    return per.select("source", "source_size", F.least(F.col("level") * F.col("w"), F.col("most").cast("double")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``mix_sizes`` for documents; a null text has size 0."""
    return mix_sizes(docs.select(F.col(id_col).alias("id"), F.lit(0).cast("long").alias("row"),
                                 F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")), **options)


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2,
              seed: str = "mix") -> DataFrame:
    """(id, row, size, source_size, target, copies) for every row (id, row, source, size) of ``docs``.

    ``copies`` (0 to ``cap``) says how often the mix takes the document;
    words taken in all stay within the budget.  A null source is a source of
    its own; the shuffle is a digest of seed and id (null: empty), so reruns
    agree; rows with the same id are ordered by size, then row.  Documents of size 0
    and sources without words take nothing.  An empty table gives no
    rows.  Only built-in functions are used.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = docs.withColumn("h", F.conv(F.substring(key, 1, 15), 16, 10).cast("long"))
    rows = store(rows.withColumn("part", F.floor(F.col("h") / (2 ** 60 // RANGES))), "sizes")
    goal = targets(rows.select("source", "size"), weights, share, cap)
    starts = rows.groupBy("source", "part").agg(F.sum("size").alias("s"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("s").over(before), F.lit(0)))
    starts = starts.alias("a").join(goal.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))) \
        .select("a.source", "part", "start", "source_size", "target")
    within = Window.partitionBy("source", "part").orderBy("h", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within)).alias("a") \
        .join(starts.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.part") == F.col("b.part"))) \
        .select("id", "row", "size", "source_size", "target", "h", (F.col("start") + F.col("upto")).alias("upto"))
    finish = [F.when(F.col("size") > 0, (F.col("upto") + k * F.col("source_size")) / F.col("target")) for k in range(cap)]
    rows = store(rows.withColumn("finish", F.array(*finish)), "finish")

    last = _cut(rows, goal, cap)
    taken = [_order(F.col("finish")[k], F.lit(k), F.col("h"), F.col("size")) <= last for k in range(cap)] if last is not None else []
    copies = sum((F.when((F.col("size") > 0) & t, 1).otherwise(0) for t in taken), F.lit(0))
    return rows.select("id", "row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def _order(finish, copy, h, size):
    return F.struct(finish.alias("f"), copy.cast("int").alias("k"), h.alias("h"), size.alias("s"))


def _cut(rows: DataFrame, goal: DataFrame, cap: int):
    """The place in the order of finish times of the last copy taken, as a literal; None if none is.

    Narrows the cut down range by range: each step sums the ranges of the
    one before (a bounded table), only the last orders single copies.
    """
    budget = goal.agg(F.sum("target")).first()[0]
    if not budget:
        return None
    queue = rows.where("size > 0").select(F.explode(F.array(*(
        _order(F.col("finish")[k], F.lit(k), F.col("h"), F.col("size")) for k in range(cap)))).alias("c")).select("c.*")
    far = 8 * RANGES  # later finish times share the last range; the cut is there only if no source can use its share
    coarse = F.least(F.floor(F.col("f") * RANGES), F.lit(far))
    fine = F.least(F.floor(F.col("f") * RANGES * RANGES), F.lit(far * RANGES))
    low = 0
    queue = queue.withColumns({"coarse": coarse, "fine": fine})
    for name in ("coarse", "fine"):
        sums = queue.groupBy(name).agg(F.sum("s").alias("s"))
        upto = F.sum("s").over(Window.orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
        at = sums.withColumn("upto", low + upto).where(F.col("upto") > F.lit(budget)).orderBy(name).first()
        if at is None:  # everything fits
            return _literal(queue.agg(F.max(F.struct("f", "k", "h", "s"))).first()[0])
        low = at["upto"] - at["s"]
        rest, queue = queue.where(F.col(name) < at[name]), queue.where(F.col(name) == at[name])
        before = rest if name == "coarse" else before.unionByName(rest)
    order = Window.orderBy("f", "k", "h", "s").rowsBetween(Window.unboundedPreceding, 0)
    last = queue.withColumn("upto", low + F.sum("s").over(order)).where(F.col("upto") <= F.lit(budget)) \
        .agg(F.max(F.struct("f", "k", "h", "s"))).first()[0]
    if last is None:
        last = before.agg(F.max(F.struct("f", "k", "h", "s"))).first()[0]
    return None if last is None else _literal(last)


def _literal(row):
    return _order(F.lit(row["f"]), F.lit(row["k"]), F.lit(row["h"]).cast("long"), F.lit(row["s"]).cast("long"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with the columns of ``docs``."""
    rows = keyed(docs)
    doc = F.col("_doc")
    plan = mix_sizes(rows.select(doc[id_col].alias("id"), F.col("_key").alias("row"), doc[source_col].alias("source"),
                                 n_words(doc[text_col]).alias("size")), **options)
    plan = plan.where("copies > 0").select(F.col("row").alias("_key"), "copies")
    return rows.join(plan.hint("shuffle_hash"), "_key") \
        .select("_doc", F.explode(F.sequence(F.lit(1), "copies"))).select("_doc.*")
