"""Hard negatives by threshold joins over an inverted index with norm bounds.

Rows are dealt into shards of a bounded size; every shard meets every anchor, a
batch of anchors at a time, so neither side is ever held as a whole.  In a
shard the dimensions form blocks, each block with a posting list of the rows
that need it: a row is left out of its leading blocks as long as the norm of
what it has there, times the norm of the anchor, cannot reach the threshold.
Partial scores are accumulated over the posting lists, pairs are dropped by
the norms of what remains, and the survivors are scored in whole numbers.
Thresholds are lowered, for the anchors that need it, until their windows are full.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecut.llm.common import keyed, store

#: Rows of a shard, anchors compared with it at once, dimensions of a block, pairs scored at once.
SHARD_ROWS, ANCHORS, BLOCK, PAIRS = 8192, 128, 8, 1 << 16
#: Thresholds of the rounds: for positives as shares of (anchor's norm x mean norm), for negatives as places in the window.
POSITIVE_ROUNDS, NEGATIVE_ROUNDS = (0.5, 0.3, 0.15, None), (0.75, 0.4, 0.0)
#: Largest squared norm of a vector: a hundred times any score fits a long.
MAX_SQUARE = float(1 << 55)


class SuffixIndex:
    """Postings of one shard by blocks of dimensions, and the norms of the leading blocks."""

    def __init__(self, x: np.ndarray):
        self.exact, self.x = x, x.astype(np.float64)
        self.edges = [*range(0, x.shape[1], BLOCK), x.shape[1]]
        self.lead = self._lead(self.x)

    def _lead(self, x: np.ndarray) -> np.ndarray:
        """Norms of the dimensions before each edge."""
        squares = np.concatenate([np.zeros((len(x), 1)), np.cumsum(x * x, axis=1)], axis=1)
        return np.sqrt(squares[:, self.edges])

    def search(self, asked: np.ndarray, t: np.ndarray):
        """(anchor, row, score) of all pairs that score ``t`` of the anchor or more."""
        q = asked.astype(np.float64)
        lead, blocks = self._lead(q), len(self.edges) - 1
        norm = lead[:, -1]
        sure = np.where((t > 0) & (norm > 0), t / np.maximum(norm, 1e-300), -np.inf).min()
        # blocks that a row leaves out: what it has there cannot reach any threshold asked
        left_out = (self.lead[:, 1:] * (1 + 1e-9) < sure).sum(axis=1)
        order = np.argsort(left_out, kind="stable")
        left_out, x, x_lead = left_out[order], self.x[order], self.lead[order]
        cut = blocks // 4
        acc = np.zeros((len(q), len(x)))
        for k in range(blocks - 1, cut - 1, -1):
            posted = np.searchsorted(left_out, k, side="right")
            dims = slice(self.edges[k], self.edges[k + 1])
            acc[:, :posted] += q[:, dims] @ x[:posted, dims].T
        rest = np.maximum(left_out, cut)
        slack = 1e-9 * norm * x_lead[:, -1].max(initial=0) + 0.5
        bound = acc + lead[:, rest] * x_lead[np.arange(len(x)), rest]
        anchor, row = np.nonzero((bound >= (t - slack)[:, None]) & (left_out < blocks))
        row, score = order[row], np.empty(len(row), np.int64)
        for lo in range(0, len(row), PAIRS):
            s = slice(lo, lo + PAIRS)
            score[s] = np.einsum("pd,pd->p", asked[anchor[s]], self.exact[row[s]])
        keep = score >= t[anchor]
        return anchor[keep], row[keep], score[keep]


def _first(group: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each group; equal groups stand together."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    at = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
    return np.flatnonzero(at < k)


def _matrix(column: pa.Array, width: int = 1) -> np.ndarray:
    """The lists of a column as rows of a matrix, filled up with zeros."""
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(size.max(initial=0)))
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class _Shard:
    """The rows of one shard with their index."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        column = lambda c: rows.column(c).chunk(0)
        self.index, self.id = SuffixIndex(_matrix(column("v"))), column("id")
        self.no_id, self.id_value = self.id.is_null().to_numpy(zero_copy_only=False), self.id.fill_null(0).to_numpy()
        self.label, self.file, self.row = (column(c).to_numpy() for c in ("label", "file", "row"))

    def best(self, asked: pa.RecordBatch, keep: int, other: bool) -> pa.RecordBatch:
        """For each anchor and window the best ``keep`` rows."""
        index = self.index
        q = _matrix(asked.column("v"), index.exact.shape[1])[:, :index.exact.shape[1]]  # a shorter shard has zeros there
        label, file, row, t = (asked.column(c).to_numpy() for c in ("label", "file", "row", "t"))
        i, j, score = index.search(q, t)
        same = label[i] == self.label[j]
        fits = ~same if other else same & ~((file[i] == self.file[j]) & (row[i] == self.row[j]))
        i, j, score = i[fits], j[fits], score[fits]
        order = np.lexsort((self.id_value[j], self.no_id[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        windows, out = asked.column("windows").to_pylist(), []
        for k in range(max(map(len, windows))):
            place, least, most = (np.array([w[k][c] if k < len(w) else none for w in windows], np.int64)
                                  for c, none in (("place", 0), ("least", 1), ("most", 0)))
            fit = np.flatnonzero((score >= least[i]) & (score <= most[i]))
            best = fit[_first(i[fit], keep)]
            out.append((i[best], j[best], score[best], place[i[best]]))
        i, j, score, place = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(file[i]), pa.array(row[i]), pa.array(place.astype(np.int32)), self.id.take(pa.array(j)), pa.array(score)],
            ["file", "row", "place", "id", "score"])


def _scan(rows: DataFrame, asks: DataFrame, shards: int, keep: int, other: bool) -> DataFrame:
    """(file, row, place, id, score): for every anchor and window the best ``keep`` rows of each shard.

    ``asks`` holds anchors with their threshold ``t`` and ``windows`` (place, least and
    greatest score).  ``other``: rows of another label, else of the same one.
    """
    spread = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("ask", F.lit(True))
    table = rows.select("shard", "file", "row", "id", "label", "v", F.lit(False).alias("ask"))
    both = table.unionByName(spread.select("shard", "file", "row", "id", "label", "v", "ask", "t", "windows"), allowMissingColumns=True)
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", "ask")

    def run(batches):
        now, held, shard = None, [], None
        for batch in batches:
            number, ask = batch.column("shard").to_numpy(), batch.column("ask").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((number[1:] != number[:-1]) | (ask[1:] != ask[:-1])) + 1 if len(ask) else []
            for a, z in zip([0, *edges], [*edges, batch.num_rows]):
                if a < z and number[a] != now:
                    now, held, shard = number[a], [], None
                if a < z and not ask[a]:
                    held.append(batch.slice(a, z - a))
                elif a < z and held:
                    shard = shard or _Shard(held)
                    for lo in range(a, z, ANCHORS):
                        yield shard.best(batch.slice(lo, min(ANCHORS, z - lo)), keep, other)

    best = Window.partitionBy("file", "row", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return both.mapInArrow(run, "file long, row long, place int, id long, score long") \
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | str = "label", scale: int = 256, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), one row for each negative.

    A component x counts as floor(scale * x); a score is the inner product of
    such vectors.  An anchor (a row where ``anchors`` holds) has its best ``positives``
    other rows of the same label, and for each of them the best ``negatives`` rows
    of other labels whose score is ``low`` to ``high`` percent of the positive's.
    Higher scores come first, then smaller ids, null ids last.

    Rows with a null label or vector, or a null or non-finite component, take no
    part, nor do vectors whose squared norm, scaled, exceeds 2^55.  Labels are whole numbers.  Dimensions
    that a shorter vector lacks count as zero.  Rows that repeat an id are rows of their own, so the
    copies of an anchor are its positives and anchors themselves.  An empty table gives no rows; other
    columns are ignored.
    """
    spark = vectors.sparkSession
    value = lambda x: F.floor(x.cast("double") * scale)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(value(x).cast("double"), F.lit(2.0)))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = keyed(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"),
                                 (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                                 F.coalesce(anchors, F.lit(False)).alias("anchor")))
    rows = named.select("_doc.*", "_key.file", "_key.row").where(F.col("label").isNotNull() & finite) \
        .withColumn("square", square).where(F.col("square") <= MAX_SQUARE)
    rows = rows.select("id", "label", "anchor", "file", "row", F.sqrt("square").alias("norm"),
                       F.transform("vector", lambda x: value(x).cast("int")).alias("v"))
    rows = store(rows, "vectors")
    n, mean = rows.agg(F.count("*"), F.coalesce(F.avg("norm"), F.lit(0.0))).first()
    shards = max(1, -(-n // SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("file", "row"), F.lit(shards)).cast("int"))
    per_label = rows.groupBy("label").agg(F.least(F.count("*") - 1, F.lit(positives)).alias("need"))
    asks = store(rows.where("anchor").join(per_label, "label").where("need > 0").drop("shard", "anchor"), "anchors")

    # the best of the anchor's own label, below ever lower thresholds
    every = F.array(F.struct(F.lit(0).alias("place"), F.lit(-1 << 62).alias("least"), F.lit(1 << 62).alias("most")))
    found, open_, key = [], asks, ["file", "row"]
    for share in POSITIVE_ROUNDS:
        t = F.lit(float("-inf")) if share is None else F.col("norm") * (share * mean)
        best = store(_scan(rows, open_.withColumn("t", t).withColumn("windows", every), shards, positives, False), "positives")
        done = best.groupBy(key).agg(F.count("*").alias("n")).join(asks.select(*key, "need"), key).where("n >= need").select(key)
        found.append(best.join(done, key, "left_semi"))
        open_ = open_.join(done, key, "left_anti")
        if open_.isEmpty():
            break
    windows = reduce(DataFrame.unionByName, found).select(
        *key, F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = lambda c: F.expr(f"({c} - pmod({c}, 100)) div 100")
    windows = store(windows.withColumns({"least": -share(f"(-{low} * positive_score)"), "most": share(f"({high} * positive_score)")}), "windows")

    # the best of other labels in each window, from the window's top down to its foot
    found, open_ = [], windows.where("least <= most")
    for depth in NEGATIVE_ROUNDS:
        least = F.col("least") + F.ceil((F.col("most") - F.col("least")) * depth)
        per = open_.groupBy(key).agg(F.min(least).cast("double").alias("t"), F.collect_list(
            F.struct("place", least.alias("least"), F.col("most"))).alias("windows"))
        best = store(_scan(rows, asks.join(per, key), shards, negatives, True), "negatives")
        full = best.groupBy(*key, "place").agg(F.count("*").alias("n")).where(F.col("n") >= (negatives if depth else 0)).drop("n")
        found.append(best.join(full, [*key, "place"], "left_semi"))
        open_ = open_.join(full, [*key, "place"], "left_anti")
        if open_.isEmpty():
            break
    ids = asks.select(*key, F.col("id").alias("anchor_id"))
    return reduce(DataFrame.unionByName, found).select(*key, "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(windows, [*key, "place"]).join(ids, key) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
