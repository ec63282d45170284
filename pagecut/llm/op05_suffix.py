"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Every ``length``-byte window of a text has an *anchor*: its leftmost place of
least hash among the ``GRAM``-byte strings in it.  Equal windows have equal
anchors, so suffixes need to be compared at anchors only, and only where the
anchor's hash occurs twice in the corpus.  A suffix at an anchor is
written as the bytes after the anchor, then the bytes before it in reverse, as
far as the windows that share the anchor reach.

Each task sorts its suffixes and keeps one of equal ones, so hot passages
shrink before they travel; the sorted run is cut at sampled splitters and exchanged
front-coded (common prefix with the suffix before, rest).  Each range merges
its runs in a loser tree that compares two suffixes only beyond the prefix
they are known to share with the last one out.  Neighbours with a common
prefix of a whole gram form a group, inside which windows are compared in full.

A gram that spans sampled splitters is cut over ranges, and a group of more than
``GROUP`` suffixes is passed on piece by piece: each piece compares its own
windows, and the first of each travel by a 128-bit digest, so a hot gram is
decided by as many tasks as it has distinct windows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagecut.llm.common import store

GRAM = 32
#: Documents that the splitters are fitted on, and anchors of each.
SAMPLE_DOCS, SAMPLE_ANCHORS = 2000, 32
#: Suffixes of one gram that are compared at once.
GROUP = 1 << 13
#: Bytes of text for each range of suffixes, at most.
RANGE = 1 << 26
_BLOCK = 1 << 19  # bytes of a text whose anchors are sought at once
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    n = len(data) - 7
    eight = np.empty(n, np.uint64)
    for i in range(min(8, n)):
        eight[i::8] = np.frombuffer(padded[i:].tobytes()[:(len(padded) - i) // 8 * 8], "<u8")[:len(eight[i::8])]
    m = len(data) - GRAM + 1
    h = eight[:m] * _ODD[0]
    for k in (1, 2, 3):
        part = eight[8 * k:8 * k + m] * _ODD[k]
        h ^= part ^ (part >> np.uint64(29 + k))
        h *= _ODD[k - 1]
    h ^= h >> np.uint64(32)
    h *= _ODD[0]
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes, length: int):
    """(hashes, places, first windows, last windows) of the anchors of ``text``, in order."""
    data, out = np.frombuffer(text, np.uint8), []
    grams = length - GRAM + 1
    for lo in range(0, max(0, len(data) - length + 1), _BLOCK):
        part = data[lo:lo + _BLOCK + length - 1]
        h = gram_hashes(part)
        # leftmost place of least hash: compare the upper bits, then the place
        low = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while 2 * step <= grams:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if grams > step:
            low = np.minimum(low[:len(low) - (grams - step)], low[grams - step:])
        place = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        out.append((h[place[first]], place[first] + lo, first + lo, last + lo))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    # an anchor whose windows lie on both sides of a block border stands twice, each time with its own windows
    return tuple(np.concatenate(x) for x in zip(*out))


def pack(place, first, last):
    """One long for an anchor: its place and how far before it its first and last window begin."""
    return (place << 14) | ((place - first) << 7) | (place - last)


def unpack(packed):
    place = packed >> 14
    return place, place - (packed >> 7 & 127), place - (packed & 127)


def prefix_lengths(strings: list[bytes]) -> list[int]:
    """Common prefix of each string with the one before it (0 for the first)."""
    if not strings:
        return []
    width = max(map(len, strings))
    grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)
    differs = grid[1:] != grid[:-1]
    size = np.where(differs.any(1), differs.argmax(1), width)
    return [0, *(min(int(s), len(a), len(b)) for s, a, b in zip(size, strings, strings[1:]))]


def front_code(run: list[tuple]) -> bytes:
    """A sorted run [(suffix, doc, key, first)] as bytes: their number and the length, then all compressed."""
    strings = [r[0] for r in run]
    same = prefix_lengths(strings)
    rest = [s[n:] for s, n in zip(strings, same)]
    ids = np.array([r[1:4] for r in run], np.int64)
    data = b"".join([np.array(same, "<u2").tobytes(), np.array(list(map(len, rest)), "<u2").tobytes(), ids.tobytes(), *rest])
    return len(run).to_bytes(4, "little") + len(data).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)


def front_decode(data: bytes):
    """(prefix shared with the one before, suffix, (doc, key, first)) of each entry."""
    n, size = (int.from_bytes(data[i:i + 4], "little") for i in (0, 4))
    data, at, text = pa.decompress(data[8:], size, "zstd", asbytes=True), 28 * n, b""
    same = np.frombuffer(data, "<u2", n)
    size = np.frombuffer(data, "<u2", n, 2 * n)
    ids = np.frombuffer(data, "<i8", 3 * n, 4 * n).reshape(-1, 3).tolist()
    for s, k, i in zip(same.tolist(), size.tolist(), ids):
        text = text[:s] + data[at:at + k]
        at += k
        yield s, text, tuple(i)


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that share ``start`` bytes."""
    most = min(len(a), len(b))
    lo, step = start, 16
    while lo < most and a[lo:lo + step] == b[lo:lo + step]:
        lo = min(most, lo + step)
    while lo < most and a[lo] == b[lo]:
        lo += 1
    return min(lo, most)


def merge_runs(runs):
    """(prefix shared with the entry before, suffix, ids) over all runs in order, by a loser tree.

    ``heads[i]`` is run i's next entry and ``same[i]`` the prefix that it is known
    to share with the last entry out (for losers: with the entry that beat
    them).  Of two heads the one with the longer known prefix is smaller; with
    equal prefixes bytes are compared from there on.
    """
    runs = [iter(r) for r in runs]
    heads = [next(r, None) for r in runs]
    width = 1
    while width < len(runs):
        width *= 2
    heads += [None] * (width - len(runs))
    same = [0] * width

    def play(a: int, b: int):
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if same[a] != same[b]:
            return (a, b) if same[a] > same[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        n = common_prefix(x, y, same[a])
        first, second = (a, b) if x[n:n + 1] <= y[n:n + 1] else (b, a)
        same[second] = n
        return first, second

    losers = [0] * width
    level = list(range(width))
    node = width
    while len(level) > 1:
        node //= 2
        nxt = []
        for i in range(0, len(level), 2):
            win, losers[node + i // 2] = play(level[i], level[i + 1])
            nxt.append(win)
        level = nxt
    top = level[0]
    while heads[top] is not None:
        yield same[top], heads[top][1], heads[top][2]
        heads[top] = next(runs[top], None) if top < len(runs) else None
        same[top] = heads[top][0] if heads[top] else 0
        at = (top + width) // 2
        while at:
            top, losers[at] = play(top, losers[at])
            at //= 2


def repeated_in_group(group: dict, length: int, firsts: list | None = None):
    """(key, start, end) stretches of a group's suffixes whose windows occur earlier in it.

    ``group`` maps a suffix (with its extent) to the earliest (doc, key,
    first window); all its suffixes share the anchor's gram.  Windows that don't
    occur earlier are added to ``firsts`` as (digest, doc, key, start).
    """
    seen = set()
    for suffix, (doc, key, first) in sorted(group.items(), key=lambda x: x[1]):
        after, before = suffix[-2], suffix[-1]  # bytes before the anchor of the last and the first window
        text = suffix[-3:length - after - 1:-1] + suffix[:length - after] if before else suffix[:length - after]
        start = None
        for i in range(before - after + 1):
            window = (before - i, text[i:i + length])
            if window in seen:
                start = i if start is None else start
            else:
                seen.add(window)
                if firsts is not None:
                    digest = hashlib.blake2b(bytes((window[0],)) + window[1], digest_size=16).digest()
                    firsts.append((digest, doc, key, first + i))
                if start is not None:
                    yield key, first + start, first + i - 1 + length
                    start = None
        if start is not None:
            yield key, first + start, first + before - after + length


def suffix_of(text: bytes, packed: int, length: int):
    """(suffix with its extent, first window, last window) at a packed anchor."""
    place, first, last = unpack(packed)
    return text[place:last + length] + text[first:place][::-1] + bytes((place - last, place - first)), first, last


def squeeze(batches):
    """Rows (doc, key, text) with the text compressed, its length before it: texts travel twice."""
    for b in batches:
        packed = [len(t).to_bytes(4, "little") + pa.compress(t, "zstd", asbytes=True) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["doc", "key", "text"])


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)


def keep_rest(text: bytes, spans):
    """(kept bytes, bytes removed, runs removed) after removing [start, end) spans of a text."""
    parts, at, removed, n = [], 0, 0, 0
    for start, end in sorted(spans):
        if start > at or (start == at and not n):
            n += 1
            parts.append(text[at:start])
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    parts.append(text[at:])
    return b"".join(parts), removed, n


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                     ranges: int | None = None) -> DataFrame:
    """(id, kept binary, n_bytes, n_removed, n_spans) for every row of ``docs``.

    Removes each byte covered by a ``length``-byte string that also starts
    earlier (smaller id, nulls last, or same document, earlier start), judged on the
    input.  A null text is empty.  Rows with the same id are ordered by a
    digest of id and text; rows equal in both are one document and get the same result
    each.  An empty table gives no rows.  ``length`` may be 64 to 128.
    """
    spark = docs.sparkSession
    if not GRAM * 2 <= length <= 128:
        raise ValueError("length must be from 64 to 128")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text.cast("binary").alias("text"),
                       F.xxhash64(F.col(id_col), text).alias("key"))

    # splitters between ranges of suffixes
    n, n_bytes = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = ranges or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_bytes // RANGE)

    def some(batches):
        for b in batches:
            found = []
            for t in b.column(0):
                data = t.as_py()
                spots = pack(*anchors(data, length)[1:]).tolist()
                found += [suffix_of(data, p, length)[0] for p in spots[::max(1, len(spots) // SAMPLE_ANCHORS)][:SAMPLE_ANCHORS]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["suffix"])

    sample = rows.select("text").sample(min(1.0, SAMPLE_DOCS / max(n, 1)), seed=7).mapInArrow(some, "suffix binary")
    sampled = sorted(bytes(r[0]) for r in sample.collect())
    quantiles = {sampled[len(sampled) * i // ranges] for i in range(1, ranges)} if sampled else set()
    # a gram with several quantiles is cut between them; elsewhere ranges begin with a gram
    shares = Counter(q[:GRAM] for q in quantiles)
    cut_grams = {gram for gram, k in shares.items() if k > 1}
    splitters = sorted({q if q[:GRAM] in cut_grams else q[:GRAM] for q in quantiles})

    # anchors whose hash occurs twice; of a hash that a task meets again, only the first place is counted elsewhere
    def find(batches):
        held = []
        for b in batches:
            for key, value in zip(b.column(1).to_pylist(), b.column(0)):
                h, place, first, last = anchors(value.as_py(), length)
                if len(h):
                    held.append((h, np.full(len(h), key, np.int64), pack(place, first, last)))
        if not held:
            return
        h, key, place = (np.concatenate(x) for x in zip(*held))
        _, at, n_same = np.unique(h, return_index=True, return_counts=True)
        seen = np.full(len(h), 2, np.int32)
        spread = (key.view(np.uint64) ^ place.view(np.uint64) * _ODD[1]) * _ODD[2]  # repeats are decided here; they travel alone
        spread[at], seen[at] = h[at], np.minimum(n_same, 2)
        for lo in range(0, len(h), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(spread[s].view(np.int64)), pa.array(key[s]), pa.array(place[s]),
                                              pa.array(seen[s])], ["h", "key", "place", "seen"])

    found = rows.select("text", "key").mapInArrow(find, "h long, key long, place long, seen int")
    again = found.withColumn("seen", F.sum("seen").over(Window.partitionBy("h"))).where("seen > 1")
    places = again.groupBy("key").agg(F.collect_set("place").alias("places"))

    # sorted runs, front-coded, cut at the splitters; what repeats inside a task needs no exchange
    def sort_run(batches):
        run, marks, n_run = {}, [], TaskContext.get().partitionId()

        def flush():
            cut, ordered = {}, sorted((s, *ids) for s, ids in run.items())
            for entry in ordered:
                cut.setdefault(bisect_left(splitters, entry[0]), []).append(entry)
            out = [(r, n_run, front_code(part)) for r, part in cut.items()]
            per = 1 + len(marks) // max(1, ranges)
            out += [(i // per % ranges, -1, np.array(marks[i:i + per], np.int64).tobytes()) for i in range(0, len(marks), per)]
            run.clear()
            marks.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))],
                                              ["part", "run", "data"]) if out else None

        size = 0
        for b in batches:
            for doc, key, value, spots in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                data, doc = unsqueeze(value.as_py()), (1 << 63) - 1 if doc is None else doc
                for p in sorted(spots.as_py()):
                    suffix, first, last = suffix_of(data, p, length)
                    here, there = (doc, key, first), run.get(suffix)
                    if there is None or here < there:
                        run[suffix] = here
                        size += len(suffix)
                        here = there
                    if here is not None and here != run[suffix]:
                        marks.append((here[1], here[2], here[2] + last - first + length))
            if size > 1 << 26:  # a task with more than this writes several runs
                if (out := flush()) is not None:
                    yield out
                size = 0
        if (out := flush()) is not None:
            yield out

    texts = rows.select("doc", "key", "text").mapInArrow(squeeze, "doc long, key long, text binary")
    runs = texts.join(places.hint("shuffle_hash"), "key").select("doc", "key", "text", "places") \
        .mapInArrow(sort_run, "part int, run int, data binary")

    def merge(shard: pa.Table) -> pa.Table:
        parts = list(zip(shard["run"].to_pylist(), shard["data"].to_pylist()))
        out = [np.frombuffer(d, np.int64).reshape(-1, 3) for r, d in parts if r < 0]
        made, group, pieces, spread = [], {}, [], False

        def close():
            if spread and group:
                pieces.append(front_code([(s, *ids) for s, ids in group.items()]))
            elif len(group) > 1:
                made.extend(repeated_in_group(group, length))
            group.clear()

        for same, suffix, ids in merge_runs([front_decode(d) for r, d in parts if r >= 0]):
            if same < GRAM:
                close()
                spread = suffix[:GRAM] in cut_grams
            there = group.get(suffix)
            if there is None:
                if len(group) >= GROUP:  # equal suffixes follow each other, so those held are complete
                    spread = True
                    close()
                group[suffix] = ids
            else:  # the same suffix from two runs: the later one is covered
                low, high = min(there, ids), max(there, ids)
                group[suffix] = low
                if low != high:
                    made.append((high[1], high[2], high[2] + suffix[-1] - suffix[-2] + length))
        close()
        out.append(np.array(made, np.int64).reshape(-1, 3))
        key, start, end = np.concatenate(out).T
        table = pa.table({"key": key, "start": start, "end": end, "piece": pa.nulls(len(key), pa.binary())})
        if not pieces:
            return table
        none = pa.nulls(len(pieces), pa.int64())
        return pa.concat_tables([table, pa.table({"key": none, "start": none, "end": none, "piece": pa.array(pieces, pa.binary())})])

    merged = store(runs.groupBy("part").applyInArrow(merge, "key long, start long, end long, piece binary"), "spans")

    # pieces of grams that no one task decides: what repeats in a piece is covered, the first of each window is compared by digest
    def windows(batches):
        for b in batches:
            for value in b.column(0):
                firsts, group = [], {suffix: ids for _, suffix, ids in front_decode(value.as_py())}
                sure = [(b"%d %d" % (key, start), None, key, start, end) for key, start, end in repeated_in_group(group, length, firsts)]
                found = sure + [(*f, f[3] + length) for f in firsts]
                for lo in range(0, len(found), 1 << 16):
                    cols = zip(zip(*found[lo:lo + (1 << 16)]), (pa.binary(), *[pa.int64()] * 4))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in cols], ["window", "doc", "key", "start", "end"])

    pieces = merged.where("piece is not null").select("piece").repartition(ranges)
    pieces = pieces.mapInArrow(windows, "window binary, doc long, key long, start long, end long")
    here = F.struct("doc", "key", "start")
    least = F.min(F.when(F.col("doc").isNotNull(), here)).over(Window.partitionBy("window"))
    later = pieces.withColumn("least", least).where(F.col("doc").isNull() | (F.col("least") < here))
    spans = merged.where("piece is null").select("key", "start", "end").unionByName(later.select("key", "start", "end"))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cover(batches):
        for b in batches:
            out = []
            for value, found in zip(b.column(1), b.column(2)):
                data = unsqueeze(value.as_py())
                kept, removed, n_spans = keep_rest(data, [(s["start"], s["end"]) for s in found.as_py() or ()])
                out.append((kept, len(data), removed, n_spans))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                             ["id", "kept", "n_bytes", "n_removed", "n_spans"])

    return texts.join(spans.hint("shuffle_hash"), "key", "left").select("doc", "text", "spans") \
        .mapInArrow(cover, "id long, kept binary, n_bytes long, n_removed long, n_spans long")
