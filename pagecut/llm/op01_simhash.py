"""SimHash near-duplicate groups through a sharded vantage-point tree.

A vantage-point tree over a bounded sample splits the space of 64-bit
fingerprints by Hamming distance.  Every distinct fingerprint is a *member* of
exactly one leaf shard.  Where a fingerprint lies outside a ball but within
``max_bits`` of its surface, the triangle bound cannot exclude a partner
inside, so it also visits the inner shard as a *guest*; all other branches
are pruned.  (The reverse copy is not needed: a pair split by a ball
surface meets where its outer end visits.)  Each shard goes on splitting with
vantage points of its own and compares exactly at the bottom.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecut.llm.common import chosen, keyed, store
from pagecut.llm.components import connected_components

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20  # bytes of text cut into words at once
_CELLS = 1 << 22  # distances held at once in a shard


def _word_blocks(data: bytes):
    """The words of ``data``, a bounded stretch of text at a time."""
    at = 0
    while at < len(data):
        cut = _BLANK.search(data, min(at + _BLOCK, len(data)))
        end = cut.start() if cut else len(data)
        yield data[at:end].split()  # bytes.split() cuts at the six ASCII blanks
        at = end + 1


def simhash(data: bytes, shingle: int) -> int:
    """Fingerprint of a UTF-8 text: a bit is 1 if set in over half the shingle hashes."""
    counts, n, held = np.zeros(64, np.int64), 0, []
    for words in _word_blocks(data.lower()):  # bytes.lower() changes A-Z only
        held += words
        if len(held) >= shingle:
            hashes = np.fromiter(map(_hash, map(b" ".join, zip(*(held[j:] for j in range(shingle))))), np.uint64)
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(hashes)
            held = held[len(held) - shingle + 1:]
    if not n:
        return _hash(b" ".join(held)) if held else 0
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): one row for each document, ``fp`` the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t.as_py() or b"", shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def bits_apart(a, b):
    return np.bitwise_count(a ^ b).astype(np.int16)


def _vantage(points: np.ndarray, max_bits: int, tries: int = 8):
    """Vantage point and radius (median distance) with the fewest points at the ball's surface."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(int)]:
        d = bits_apart(points, v)
        r = int(np.median(d))
        near = np.count_nonzero(np.abs(d - r) <= max_bits) - 0.5 * np.count_nonzero(d > r)
        if best is None or near < best[0]:
            best = near, v, r
    return best[1], best[2]


def build_tree(sample: np.ndarray, depth: int, max_bits: int):
    """Heap-ordered arrays (vantage points, radii) of a tree of 2**depth leaves."""
    vantage, radius = np.zeros(2 ** depth - 1, np.uint64), np.full(2 ** depth - 1, 64, np.int16)
    todo = {0: np.sort(sample)} if depth else {}
    while todo:
        node, points = todo.popitem()
        if len(points):
            vantage[node], radius[node] = _vantage(points, max_bits)
        inner = bits_apart(points, vantage[node]) <= radius[node]
        if 2 * node + 2 < len(vantage):
            todo[2 * node + 1], todo[2 * node + 2] = points[inner], points[~inner]
    return vantage, radius


def route(fps: np.ndarray, vantage: np.ndarray, radius: np.ndarray, max_bits: int):
    """(leaf, guest, fp): the member row of each fingerprint and its guest rows at ball surfaces."""
    node, guest = np.zeros(len(fps), np.int64), np.zeros(len(fps), bool)
    while len(node) and node[0] < len(vantage):
        d, r = bits_apart(fps, vantage[node]), radius[node]
        inner = np.where(guest, d <= r + max_bits, d <= r)
        outer = np.where(guest, d > r - max_bits, d > r)
        visit = ~guest & (d > r) & (d <= r + max_bits)
        fps = np.concatenate([fps[inner], fps[outer], fps[visit]])
        guest = np.concatenate([guest[inner], guest[outer], np.ones(visit.sum(), bool)])
        node = np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2, 2 * node[visit] + 1])
    return node - len(vantage), guest, fps


def forest(a: np.ndarray, b: np.ndarray):
    """Links (a, b) reduced to one link from each node to the least node of its group."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(nodes))
            return nodes[moved], nodes[label[moved]]
        label = new


def shard_links(members: np.ndarray, guests: np.ndarray, max_bits: int, leaf: int = 384):
    """Spanning links of all pairs within ``max_bits`` among members and between guests and members."""
    out_a, out_b, held = [], [], 0
    todo = [(members, guests)]
    while todo:
        m, g = todo.pop()
        if len(m) == 0:
            continue
        if len(m) > leaf:
            v, r = _vantage(m, max_bits)
            d, dg = bits_apart(m, v), bits_apart(g, v)
            if 0 < np.count_nonzero(d <= r) < len(m):
                visit = m[(d > r) & (d <= r + max_bits)]
                todo.append((m[d <= r], np.concatenate([g[dg <= r + max_bits], visit])))
                todo.append((m[d > r], g[dg > r - max_bits]))
                continue
        step = max(1, _CELLS // len(m))
        for rows in (m, g):
            for lo in range(0, len(rows), step):
                i, j = np.nonzero(bits_apart(rows[lo:lo + step, None], m[None, :]) <= max_bits)
                a, b = rows[lo + i], m[j]
                a, b = a[a != b], b[a != b]
                if len(a):
                    out_a, out_b, held = [*out_a, a], [*out_b, b], held + len(a)
                if held > _CELLS:  # keep what a shard holds in proportion to its nodes
                    a, b = forest(np.concatenate(out_a), np.concatenate(out_b))
                    out_a, out_b, held = [a], [b], 0
    return forest(np.concatenate(out_a), np.concatenate(out_b)) if out_a else (members[:0], members[:0])


def link_fingerprints(fps: DataFrame, max_bits: int = 2, leaf_rows: int = 8192, max_depth: int = 17,
                      sample_per_leaf: int = 16) -> DataFrame:
    """(a, b): links that join the distinct fingerprints of column ``fp`` into their groups.

    The tree is fitted on a sample of at most ``sample_per_leaf * 2 **
    max_depth`` fingerprints; all of them are routed and compared.  Links span each
    shard's groups (at most one for each fingerprint that a shard sees), so copies
    of one text never expand into pairs.
    """
    n = fps.count()
    depth = min(max_depth, max(0, int(np.ceil(np.log2(max(1, n) / leaf_rows)))))
    want = sample_per_leaf * 2 ** depth
    sample = np.array([r[0] for r in fps.sample(min(1.0, want / max(n, 1)), seed=1).collect()], np.int64).view(np.uint64)
    vantage, radius = build_tree(sample, depth, max_bits)

    def send(batches):
        for b in batches:
            leaf, guest, fp = route(b.column(0).to_numpy().view(np.uint64), vantage, radius, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(guest), pa.array(fp.view(np.int64))],
                                             ["leaf", "guest", "fp"])

    def compare(shard: pa.Table) -> pa.Table:
        fp = shard["fp"].to_numpy().view(np.uint64)
        guest = shard["guest"].to_numpy(zero_copy_only=False)
        a, b = shard_links(fp[~guest], fp[guest], max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    shards = fps.select("fp").mapInArrow(send, "leaf long, guest boolean, fp long")
    return shards.groupBy("leaf").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  A null text is empty; texts without words have
    fingerprint zero and link like any other.  Rows with a null id get the group's
    smallest id (null if the group has none); repeated ids give a row each.
    Other columns are ignored; an empty table gives no rows.
    """
    docs = store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = docs.groupBy("fp").agg(F.min("id").alias("low"))
    links = link_fingerprints(fps.select("fp"), max_bits)
    roots = connected_components(links)
    groups = fps.join(roots.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("fp", "low", F.coalesce("component", "fp").alias("root"))
    lows = groups.groupBy("root").agg(F.min("low").alias("component_id"))
    named = groups.join(lows, "root").select("fp", "component_id")
    return docs.join(named, "fp").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns.

    The row with the smallest id stays, nulls last; of rows with the same id, one
    chosen by its place in the files.
    """
    rows = keyed(docs)
    own = F.struct(F.col("_doc")[id_col].isNull().alias("none"), F.col("_doc")[id_col].alias("id"), F.col("_key").alias("key"))
    groups = near_duplicates(rows.select(own.alias("_id"), F.col("_doc")[text_col].alias("_text")), "_id", "_text", **options)
    return chosen(rows, groups.where(F.col("id") == F.col("component_id")).select(F.col("id.key").alias("_key")))
