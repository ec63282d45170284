"""Cross-tokenizer alignment with an associative monoid of fragments.

Tokenizer A is a byte-level BPE, B a sentence-piece BPE with byte fallback; both
read a text with one blank in front.  A place between a word and a single blank
is a sure break: both tokenizers end a token there whatever stands around.  A byte range
of a document becomes a fragment: an open prefix up to its first sure break, the
closed groups behind it, and an open suffix after the last.  Two neighbours compose by
closing what their suffix and prefix make together.  Very long documents are cut into
byte-range chunks that spread over the tasks, and their fragments are
composed in a tree; other documents are one fragment.  Groups of equal stretches are
worked out once in a block of documents.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecut.llm.common import keyed, store
from pagecut.llm.op13_words import Vocabulary
from pagecut.llm.packing import gather, pack_numbers, unpack_numbers

#: Bytes of a chunk, fragments composed at once, bytes of a block, stretches remembered and learnt at once,
#: blocks that share a copy of the counts.
CHUNK, FAN, BLOCK_BYTES, STRETCHES, LEARN, SHARED = 1 << 16, 8, 1 << 22, 150_000, 1 << 15, 1024
#: A blank between two characters that are no blanks; U+2581 is B's sign for a blank.
_BREAK = re.compile("(?<=[^\\s▁]) (?=\\S)")


def cut(data: bytes, left: bool, right: bool) -> tuple[bytes, list[str], bytes | None]:
    """(open prefix, closed stretches, open suffix) of a byte range; no suffix if it holds no sure place.

    ``left`` and ``right`` say whether the range begins and ends at a sure break;
    an end that is sure leaves nothing open.
    """
    a, z = 0, len(data)
    while not left and a < z and data[a] & 0xC0 == 0x80:  # the rest of a character that began before
        a += 1
    if not right:
        lead = z
        while lead > max(a, z - 4):  # a character that ends beyond
            lead -= 1
            if data[lead] & 0xC0 != 0x80:
                n = data[lead]
                z = lead if lead + (1 if n < 0x80 else 2 if n < 0xE0 else 3 if n < 0xF0 else 4) > z else z
                break
    first, *rest = _BREAK.split(data[a:z].decode())
    parts = [first, *(" " + p for p in rest)]
    head = b"" if left else data[:a] + parts.pop(0).encode()
    if right:
        return head, [p for p in parts if p], b""
    if not parts:  # no sure place
        return head + data[z:], [], None
    tail = parts.pop().encode() + data[z:]
    return head, parts, tail


class Aligner:
    """Groups and links of stretches of text; stretches met before are remembered up to a bound."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        vocabulary = Vocabulary(path_a)
        ranks = {p: i for i, p in vocabulary.pieces.items() if i not in vocabulary.added.values()}
        if (np.diff(vocabulary.made[np.argsort(vocabulary.rank)]) <= 0).any():
            raise ValueError("the merges of tokenizer A must stand in the order of their ids")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        in_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        in_a = [vocabulary.pieces.get(i, b"") for i in range(max(vocabulary.pieces) + 1)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (in_a, in_b)]
        self.length = [np.fromiter(map(len, x), np.int64, len(x)) for x in (in_a, in_b)]
        # an id in digits with the sign behind it: , inside a list, | after A's, ; after B's
        self.digits = [pa.array([b"%d%s" % (i, s) for i in range(len(x)) for s in signs], pa.large_binary())
                       for x, signs in ((in_a, (b",", b"|")), (in_b, (b",", b";")))]
        self.digits = pa.concat_arrays(self.digits)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, 1 if the bytes differ
        self.text = pa.array([], pa.large_binary())
        self.link_start, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def numbers(self, stretches: list[str]) -> np.ndarray:
        """The places of stretches in the tables."""
        new = [s for s in dict.fromkeys(stretches) if s not in self.known]
        for lo in range(0, len(new), LEARN):
            self._learn(new[lo:lo + LEARN])
        return np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))

    def _learn(self, new: list[str]) -> None:
        data = [s.encode() for s in new]
        size = np.fromiter(map(len, data), np.int64, len(data))
        tokens = [self.a.encode_ordinary(s) for s in new], self.b.encode([s[1:] for s in new], num_threads=1)
        count = [np.fromiter(map(len, t), np.int64, len(t)) for t in tokens]
        ids = [np.fromiter((i for t in x for i in t), np.int64, n.sum()) for x, n in zip(tokens, count)]
        fits = np.ones(len(new), bool)
        for x, n, length in zip(ids, count, self.length):
            fits &= np.add.reduceat(np.r_[length[x], 0], np.minimum(np.cumsum(n) - n, len(x))) * (n > 0) == size
        of = np.repeat(np.arange(len(new)), size)
        (a, b) = (x[np.repeat(fits, n)] for x, n in zip(ids, count))
        source = np.frombuffer(b"".join(d for d, f in zip(data, fits) if f), np.uint8)
        differs = np.zeros(len(new), np.int64)
        differs[~fits] = 1
        for x, pieces in zip((a, b), self.bytes):
            bad = _flat(pieces.take(pa.array(x))) != source
            differs[of[np.repeat(fits, size)][bad]] = 1
        # groups end where both end a token; a link is a stretch between neighbouring ends of either
        end_a, end_b = np.cumsum(self.length[0][a]), np.cumsum(self.length[1][b])
        ends, common = np.union1d(end_a, end_b), np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        upto = np.cumsum(np.where(fits, size, 0))
        per = lambda places: np.bincount(np.searchsorted(upto, places), minlength=len(new))
        links = a[np.searchsorted(end_a, ends)] << 32 | b[np.searchsorted(end_b, ends)]
        sums = np.stack([count[0] * fits, count[1] * fits, per(common), per(ends), differs], axis=1)
        # a,a|b;a|b,b; in the order of groups, A before B
        code = np.empty(len(a) + len(b), np.int64)
        last = lambda group: np.r_[group[1:] != group[:-1], True][:len(group)]
        code[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + last(group_a)
        code[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 2 * (len(self.length[0]) + b) + last(group_b)
        shown = self.digits.take(pa.array(code))
        stops = np.r_[0, np.cumsum((count[0] + count[1]) * fits)]
        offsets = np.frombuffer(shown.buffers()[1], np.int64)[stops] if len(shown) else np.zeros(len(new) + 1, np.int64)
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(offsets), shown.buffers()[2]])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.sums, self.text = np.concatenate([self.sums, sums]), pa.concat_arrays([self.text, text])
        self.link_start = np.concatenate([self.link_start, self.link_start[-1] + np.cumsum(sums[:, 3])])
        self.links = np.concatenate([self.links, links])

    def measure(self, stretches: list[list[str]]):
        """For each list of stretches its sums, its groups as text, and (list, pair, times) of all links."""
        if len(self.known) > STRETCHES:
            self.forget()
        at = self.numbers([s for x in stretches for s in x])
        owner = np.repeat(np.arange(len(stretches)), [len(x) for x in stretches])
        sums = np.stack([np.bincount(owner, c, len(stretches)).astype(np.int64) for c in self.sums[at].T], axis=1) \
            if len(at) else np.zeros((len(stretches), 5), np.int64)
        text = self.text.take(pa.array(at))
        flat = _flat(text).tobytes()
        ends = np.r_[0, np.cumsum(np.bincount(owner, _lengths(text), len(stretches)).astype(np.int64))]
        each, times = np.unique(owner << 32 | at, return_counts=True)
        who, unit = each >> 32, each & 0xffffffff
        n = np.diff(self.link_start)[unit]
        pairs = gather(self.links, self.link_start[unit], n)
        return sums, [flat[a:z] for a, z in zip(ends, ends[1:])], (np.repeat(who, n), pairs, np.repeat(times, n))


def _lengths(array: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(array.buffers()[1], np.int64)[:len(array) + 1]) if len(array) else np.zeros(0, np.int64)


def _flat(array: pa.Array) -> np.ndarray:
    """The bytes of a fresh binary array, one value after the other."""
    return np.frombuffer(array.buffers()[2], np.uint8)[:int(_lengths(array).sum())] if len(array) else np.zeros(0, np.uint8)


def total(owner: np.ndarray, pairs: np.ndarray, times: np.ndarray):
    """(owner, place in ``distinct``, times, distinct): one row for each owner and pair."""
    distinct, at = np.unique(pairs, return_inverse=True)
    each, back = np.unique(owner << 32 | at, return_inverse=True)
    return each >> 32, each & 0xffffffff, np.bincount(back, times, len(each)).astype(np.int64), distinct


@lru_cache(maxsize=1)
def aligner(*paths: str) -> Aligner:
    return Aligner(*paths)


_CLOSED = "sums array<long>, groups binary, pairs array<long>, times array<long>"


def _fragment(a: Aligner, parts: list[tuple[bytes, list[str], bytes | None]]):
    """Arrow columns (head, tail, sums, groups, pairs, times) of freshly cut fragments."""
    sums, groups, (owner, pairs, times) = a.measure([p[1] for p in parts])
    owner, at, times, distinct = total(owner, pairs, times)
    edge = np.searchsorted(owner, np.arange(len(parts) + 1))
    cells = [(p[0], p[2], s.tolist(), g, distinct[at[x:y]].tolist(), times[x:y].tolist())
             for p, s, g, x, y in zip(parts, sums, groups, edge, edge[1:])]
    return cells


def compose(a: Aligner, left: tuple, right: tuple) -> tuple:
    """The fragment of two neighbouring byte ranges; cells are (head, tail, sums, groups, pairs, times)."""
    open_left, open_right = left[1] is not None, right[1] is not None
    head, units, tail = cut((left[1] if open_left else left[0]) + right[0], open_left, open_right)
    (middle,) = _fragment(a, [(head, units, tail)])
    _, pairs, times, distinct = total(np.zeros(len(left[4]) + len(middle[4]) + len(right[4]), np.int64),
                                      np.array([*left[4], *middle[4], *right[4]], np.int64), np.array([*left[5], *middle[5], *right[5]], np.int64))
    return (left[0] if open_left else head, right[1] if open_right else tail,
            [x + y + z for x, y, z in zip(left[2], middle[2], right[2])], left[3] + middle[3] + right[3],
            distinct[pairs].tolist(), times.tolist())


def long_documents(rows: DataFrame, paths: tuple[str, str, str], n_chunks) -> DataFrame:
    """(id, closed groups) of documents in several chunks: fragments spread over tasks, composed in a tree."""
    most = rows.agg(F.max(n_chunks)).first()[0] or 0
    data = F.concat(F.lit(" "), "text").cast("binary")
    ranges = F.transform(F.sequence(F.lit(0), n_chunks - 1), lambda i: F.struct(
        i.cast("long").alias("at"), F.substring(data, i * CHUNK + 1, F.lit(CHUNK)).alias("data"), (i == n_chunks - 1).alias("last")))
    chunks = rows.select("id", "file", "row", F.explode(ranges).alias("c")).select("id", "file", "row", "c.*") \
        .repartition("file", "row", "at")
    id_field = rows.schema["id"]
    schema = T.StructType([id_field, *T._parse_datatype_string("file long, row long, at long, head binary, tail binary, " + _CLOSED)])
    names = schema.names

    def fragments(batches):
        a = aligner(*paths)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                cells = _fragment(a, [cut(d, at == 0, last) for d, at, last in zip(*(part.column(c).to_pylist() for c in ("data", "at", "last")))])
                yield _rows([part.column(c) for c in names[:4]], cells, names)

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        cells = list(zip(*(group.column(c).to_pylist() for c in names[4:])))
        while len(cells) > 1:
            cells = [compose(aligner(*paths), *cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
        first = group.slice(0, 1)
        made = _rows([first.column("id").chunk(0), first.column("file").chunk(0), first.column("row").chunk(0),
                      pa.array([first.column("at")[0].as_py() // FAN])], cells, names)
        return pa.Table.from_batches([made])

    found = chunks.mapInArrow(fragments, schema)
    while most > 1:
        found = found.groupBy("file", "row", F.expr(f"at div {FAN}").alias("up")).applyInArrow(merge, schema)
        most = -(-most // FAN)
    return store(found, "long")


def _rows(first: list[pa.Array], cells: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([*first, *(pa.array(c, k) for c, k in zip(zip(*cells), kinds))], names)


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row of ``docs``.

    ``path_a`` names a byte-level BPE vocabulary (JSON), ``path_b`` a sentence-piece model, ``pattern`` A's
    word splitter.  ``groups`` lists the ids between common token ends, as ``a1,a2|b1;a3|b2,b3``; with
    ``digest`` it is their SHA-256.  A link is an A token and a B token whose bytes overlap; the count of
    an id pair is the number of documents that hold it linked, ``count_sum`` adds it up over the links
    and ``n_best`` counts the links whose count is the highest of their A id.

    A text that is null or empty, or that either tokenizer does not give back byte by byte, has
    no tokens: zeros and the empty string.  Rows that repeat an id are documents of their own.  An
    empty table gives no rows; other columns are ignored.
    """
    paths = (path_a, path_b, pattern)
    named = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("_doc.*", "_key.*")
    n_chunks = F.ceil((F.octet_length("text") + 1) / CHUNK).cast("int")
    is_long = F.coalesce(n_chunks > 1, F.lit(False))
    short = named.where(~is_long).select("id", F.when(F.col("text") != "", F.concat(F.lit(" "), "text").cast("binary")).alias("head"))
    whole = short.unionByName(long_documents(named.where(is_long), paths, n_chunks).drop("file", "row", "at", "tail"), allowMissingColumns=True)
    id_type = whole.schema["id"].dataType
    schema = T.StructType([*T._parse_datatype_string("block long, place int, a int, b int, docs long"), T.StructField("ids", T.ArrayType(id_type)),
                           *T._parse_datatype_string("sums binary, groups array<string>, links binary")])

    def blocks(batches):
        a, task, n_blocks, held, size = aligner(*paths), TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            arrow_id = b.column("id").type
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "head", "sums", "groups", "pairs", "times"))):
                held.append(row)
                size += len(row[1] or b"") + len(row[3] or b"")
                if size >= BLOCK_BYTES:
                    yield from _block(a, (task << 32) + n_blocks, held, arrow_id, digest, schema.names)
                    held, size, n_blocks = [], 0, n_blocks + 1
        if held:
            yield from _block(a, (task << 32) + n_blocks, held, arrow_id, digest, schema.names)

    found = store(whole.mapInArrow(blocks, schema), "aligned")
    linked = found.where("place is not null").select("block", "place", "a", "b", "docs")
    counts = linked.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    counts = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best"))
    # a common pair stands in every block: some blocks share a copy of its count
    copies = -(-max(1, found.select("block").distinct().count()) // SHARED)
    linked = linked.drop("docs").withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)))
    counts = linked.select("copy", "a", "b").distinct().join(counts, ["a", "b"])
    linked = linked.join(counts, ["copy", "a", "b"]).select("block", F.lit(0).alias("kind"), "place", "count", "is_best")
    parts = linked.unionByName(found.where("place is null").select("block", F.lit(1).alias("kind"), "ids", "sums", "groups", "links"), allowMissingColumns=True)
    parts = parts.repartition("block").sortWithinPartitions("block", "kind")
    out = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def finish(batches):
        now, place, count, is_best = None, [], [], []
        for b in batches:
            block, kind = b.column("block").to_numpy(), b.column("kind").to_numpy()
            edges = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1 if len(block) else []
            for a, z in zip([0, *edges], [*edges, b.num_rows]):
                if a < z and block[a] != now:
                    now, place, count, is_best, table = block[a], [], [], [], None
                if a < z and kind[a] == 0:
                    part = b.slice(a, z - a)
                    for x, c in ((place, "place"), (count, "count"), (is_best, "is_best")):
                        x.append(part.column(c).to_numpy(zero_copy_only=False))
                    continue
                if table is None:
                    table = np.zeros((2, sum(map(len, place))), np.int64)
                    if place:
                        table[:, np.concatenate(place)] = np.concatenate(is_best), np.concatenate(count)
                for i in range(a, z):
                    ids, groups = (b.column(c).slice(i, 1).flatten() for c in ("ids", "groups"))
                    sums = unpack_numbers(b.column("sums")[i].as_py()).astype(np.int64).reshape(5, -1)
                    at, times = unpack_numbers(b.column("links")[i].as_py()).astype(np.int64).reshape(2, -1)
                    edge = np.r_[0, np.cumsum(sums[4])]
                    running = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(table[:, at] * times, axis=1)], axis=1)
                    made = running[:, edge[1:]] - running[:, edge[:-1]]
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (*sums[:4], *made)), groups], out)

    longs = ", ".join(f"{c} long" for c in out[1:-1])
    return parts.mapInArrow(finish, f"id {id_type.simpleString()}, {longs}, groups string")


def _block(a: Aligner, block: int, rows: list[tuple], arrow_id: pa.DataType, digest: bool, names: list[str]):
    """The rows of one block: its distinct pairs with their documents, then its documents."""
    sums, groups, (owner, pairs, times) = a.measure([cut(r[1], True, True)[1] if r[2] is None and r[1] else [] for r in rows])
    more = [(n, r) for n, r in enumerate(rows) if r[2] is not None]
    for n, r in more:  # composed before
        sums[n], groups[n] = r[2], r[3]
    owner = np.concatenate([owner, *(np.full(len(r[4]), n) for n, r in more)])
    pairs, times = (np.concatenate([x, *(np.array(r[k], np.int64) for _, r in more)]) for x, k in ((pairs, 4), (times, 5)))
    good = sums[:, 4] == 0
    sums[~good] = 0
    keep = good[owner]
    owner, at, times, distinct = total(owner[keep], pairs[keep], times[keep])
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(arrow_id), pa.binary(), pa.list_(pa.string()), pa.binary()]
    shown = [g[:-1] if ok else b"" for g, ok in zip(groups, good)]
    shown = [(hashlib.sha256(g).hexdigest() if digest else g.decode()) if g else "" for g in shown]
    n = len(distinct)
    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(np.arange(n), pa.int32()), pa.array(distinct >> 32, pa.int32()),
                                      pa.array(distinct & 0xffffffff, pa.int32()), pa.array(np.bincount(at, minlength=n)),
                                      *(pa.nulls(n, k) for k in kinds[5:])], names)
    sums[:, 4] = np.bincount(owner, minlength=len(rows))
    edge = np.r_[0, np.cumsum(sums[:, 4])]
    step = 2048
    for lo in range(0, len(rows), step):
        s, links = slice(lo, lo + step), slice(edge[lo], edge[min(lo + step, len(rows))])
        cells = [[r[0] for r in rows[s]]], [pack_numbers(sums[s].T.ravel())], [shown[s]], [pack_numbers(np.concatenate([at[links], times[links]]))]
        yield pa.RecordBatch.from_arrays([pa.array([block]), *(pa.nulls(1, k) for k in kinds[1:5]), *(pa.array(c, k) for c, k in zip(cells, kinds[5:]))], names)
