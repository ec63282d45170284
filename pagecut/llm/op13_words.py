"""BPE encoding and decoding through a table of distinct words.

Documents are split into words in blocks of neighbouring documents; a block
lists its distinct words and each document becomes the numbers of its words.
The words of all blocks meet in the shards of one word table, where every
distinct word is encoded once, all words of a batch at a time.  The ids go back
to the blocks and are joined by position.  For decoding the vocabulary, whose size
is fixed, is dealt to every partition of blocks and joined with their ids there.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagecut.llm.op07_count import byte_alphabet
from pagecut.llm.packing import gather, pack_numbers, pack_words, unpack_numbers, unpack_words

#: Characters of a block, words of a row, bytes of words that are merged together, bytes from which a word is merged alone.
BLOCK_CHARS, ROW_WORDS, BATCH_BYTES, LONG_WORD = 1 << 24, 1 << 18, 1 << 21, 4096
_NONE = np.int32(2 ** 31 - 1)


class Vocabulary:
    """A byte-level BPE vocabulary file: pieces, merges and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte, ids = byte_alphabet(), spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_bytes = {t.encode(): i for t, i in self.added.items()}
        self.pieces = {i: bytes(byte[c] for c in t) for t, i in ids.items() if t not in self.added}
        self.pieces |= {i: t.encode() for t, i in self.added.items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        a, b, made = (np.array(x, np.int64) for x in zip(*((ids[x], ids[y], ids[x + y]) for x, y in pairs)))
        order = np.argsort(a << 32 | b)
        self.keys, self.rank, self.made = (a << 32 | b)[order], order.astype(np.int32), made[order].astype(np.int32)
        born = np.full(max(self.pieces) + 1, -1)
        born[made] = np.arange(len(made))
        #: All places of a pair can be merged at once if no merge makes a pair of an earlier rank.
        self.at_once = len(set(made.tolist())) == len(made) and bool((np.maximum(born[a], born[b]) < np.arange(len(made))).all())
        self.first = np.zeros(256, np.int32)
        for c, value in byte.items():
            self.first[value] = ids[c]

    @cached_property
    def merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(rank, merged id) by pair."""
        return {(k >> 32, k & 0xffffffff): (r, m) for k, r, m in zip(*(x.tolist() for x in (self.keys, self.rank, self.made)))}

    def table(self, spark: SparkSession) -> DataFrame:
        """(tokens, pieces): all ids and what they stand for, in one row of fixed size."""
        return spark.createDataFrame([(list(self.pieces), [bytearray(p) for p in self.pieces.values()])],
                                     "tokens array<int>, pieces array<binary>")

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs of ids; ``_NONE`` without a merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], _NONE), self.made[at]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids); an added token stands for itself."""
        out, held, size = [np.zeros(0, np.int32)] * len(words), [], 0
        for n, word in enumerate(words):
            if (token := self.added_bytes.get(word)) is not None:
                out[n] = np.array([token], np.int32)
                continue
            if len(word) >= LONG_WORD:
                out[n] = self._merge_long(word)
                continue
            held.append(n)
            size += len(word)
            if size >= BATCH_BYTES:
                self._merge_batch(words, held, out)
                held, size = [], 0
        self._merge_batch(words, held, out)
        return np.fromiter(map(len, out), np.int64, len(out)), np.concatenate(out) if out else np.zeros(0, np.int32)

    def _merge_batch(self, words: list[bytes], held: list[int], out: list) -> None:
        """Merge in all words at once: in each step every word's leftmost pair of least rank."""
        data = np.frombuffer(b"".join(words[n] for n in held), np.uint8)
        size = np.fromiter((len(words[n]) for n in held), np.int64, len(held))
        ids, word = self.first[data], np.repeat(np.arange(len(held)), size)
        done_ids, done_word = [], []
        rank, made = self._ranks(ids, word, np.arange(len(ids)))
        while len(ids):
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            n = np.diff(np.r_[begin, len(ids)])
            best = np.minimum.reduceat(rank, begin)
            over = np.repeat(best == _NONE, n)
            if over.any():
                done_ids.append(ids[over])
                done_word.append(word[over])
                left = ~over
                ids, word, rank, made = ids[left], word[left], rank[left], made[left]
                best, n = best[best != _NONE], n[best != _NONE]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(best, n))
            # of pairs that overlap every second one merges; without ``at_once`` only the first of a word
            joint = np.r_[False, (np.diff(at) == 1) & (word[at[1:]] == word[at[:-1]])]
            run = np.maximum.accumulate(np.where(joint, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not self.at_once:
                at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            ids[at] = made[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            ids, word, rank, made, at = ids[stay], word[stay], rank[stay], made[stay], place[at]
            again = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[again], made[again] = self._ranks(ids, word, again)
        if done_ids:
            ids, word = np.concatenate(done_ids), np.concatenate(done_word)
            order = np.argsort(word, kind="stable")
            cut = np.searchsorted(word[order], np.arange(1, len(held)))
            for n, part in zip(held, np.split(ids[order], cut)):
                out[n] = part

    def _ranks(self, ids, word, at):
        """(rank, merged id) of the pairs that begin at the places ``at``."""
        after = np.minimum(at + 1, len(ids) - 1)
        rank, made = self._look_up(ids[at], ids[after])
        return np.where((word[after] == word[at]) & (after > at), rank, _NONE), made

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for one long word, with a heap of pairs."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        merges = self.merges
        heap = sorted((merges[p][0], i, merges[p][1], *p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges)
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = m, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (pair := (ids[k], ids[after[k]])) in merges:
                    rank, made = merges[pair]
                    heapq.heappush(heap, (rank, k, made, *pair))
        return np.array([i for i in ids if i >= 0], np.int32)


class _Numbering(dict):
    """Numbers of words in the order they are met."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def split_words(docs: DataFrame, pattern: str, added: list[str], parts: int) -> DataFrame:
    """Blocks of documents as word numbers, and their distinct words.

    A row without ``shard`` holds documents: ``ids``, their numbers of words (``aux``) and the numbers of those
    words in the block (``data``).  A row with ``shard`` holds those words of the block that
    belong there (``data``) and their numbers (``aux``, as differences).  ``home`` deals blocks
    to partitions, ``to`` deals the rows of this table.
    """
    kind = docs.schema["id"].dataType

    def run(batches):
        words_of = regex.compile(pattern).findall
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        task, n_blocks = TaskContext.get().partitionId(), 0
        known, held, size = _Numbering(), [], 0

        def flush():
            numbers = np.concatenate([n for _, n in held])
            by_count = np.argsort(-np.bincount(numbers, minlength=len(known)), kind="stable")  # common words get small numbers
            new = np.empty(len(known), np.int64)
            new[by_count] = np.arange(len(known))
            block, rows, at = (task << 32) + n_blocks, [], 0
            home = (task + n_blocks * 1_000_003) % parts
            while at < len(held):
                z, n = at, 0
                while z < len(held) and (z == at or n + len(held[z][1]) <= ROW_WORDS):
                    n += len(held[z][1])
                    z += 1
                rows.append((block, home, home, None, [i for i, _ in held[at:z]], pack_numbers(np.array([len(w) for _, w in held[at:z]])),
                             pack_numbers(new[np.concatenate([w for _, w in held[at:z]])])))
                at = z
            names = list(known)
            names = [names[i] for i in by_count]
            shard = np.fromiter((crc32(w.encode()) % parts for w in names), np.int64, len(names))
            order = np.argsort(shard, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                if len(part):
                    rows.append((block, home, to := int(shard[part[0]]), to, None, pack_numbers(np.diff(part, prepend=0)), pack_words([names[i] for i in part])))
            kinds = pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(id_type), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema.names)

        for b in batches:
            id_type = b.column(0).type
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                words, text = [], text.as_py() or ""
                for n, part in enumerate(cut(text) if cut else [text]):
                    words += [part] if n % 2 else words_of(part)
                held.append((i, np.fromiter(map(known.__getitem__, words), np.int64, len(words))))
                size += len(text)
                if size >= BLOCK_CHARS:
                    yield flush()
                    known, held, size, n_blocks = _Numbering(), [], 0, n_blocks + 1
        if held:
            yield flush()

    schema = T.StructType([*T._parse_datatype_string("block long, home int, to int, shard int"), T.StructField("ids", T.ArrayType(kind)),
                           *T._parse_datatype_string("aux binary, data binary")])
    return docs.mapInArrow(run, schema)


def encode_words(split: DataFrame, encoder: Callable[[], Callable], parts: int) -> DataFrame:
    """The rows of ``split_words`` with ids in the place of words: ``data`` holds their numbers of ids, then the ids.

    ``encoder()`` is called in each task; what it returns takes a list of distinct words and
    returns (number of ids of each, all ids).
    """
    def run(batches):
        encode, now = encoder(), None
        for b in batches:
            shards = b.column("shard").to_pylist()
            if shards and shards[-1] is None:  # documents stand first and pass
                yield b
                continue
            made = []
            for shard, data in zip(shards, b.column("data").to_pylist()):
                if shard is None:
                    made.append(data)
                    continue
                if shard != now:
                    now, known = shard, {}
                    size, flat = np.zeros(0, np.int64), np.zeros(0, np.int32)
                words = unpack_words(data)
                new = [w for w in words if w not in known]
                known.update(zip(new, range(len(known), len(known) + len(new))))
                n, ids = encode(new)
                size, flat = np.concatenate([size, n]), np.concatenate([flat, ids])
                begin = np.cumsum(size) - size
                at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                made.append(pack_numbers(np.concatenate([size[at], gather(flat, begin[at], size[at])])))
            yield b.set_column(b.schema.get_field_index("data"), "data", pa.array(made, pa.binary()))

    # each word has one shard, each shard one task
    return split.repartitionById(parts, F.col("to")).sortWithinPartitions("shard").mapInArrow(run, split.schema)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False) -> DataFrame:
    """(id, ids array<int>, decoded binary) for every row of ``docs``.

    ``path`` names a byte-level BPE vocabulary (JSON) that every executor can read, ``pattern`` the expression that
    splits texts into words.  The contents of added tokens inside a text are those tokens, as in the library's
    default.  With ``digest`` the columns are (id, n_tokens, ids_sha256 of the ids as little-endian 32-bit
    numbers, decoded_sha256).  A null or empty text has no ids and decodes to no bytes.  Repeated ids
    give a row each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    encoded = encode_words(split_words(rows, pattern, sorted(vocabulary.added), parts), lambda: Vocabulary(path).encode, parts)
    pieces = vocabulary.table(spark).select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("home"), "tokens", "pieces")
    both = encoded.select("home", "block", "shard", "ids", "aux", "data").unionByName(pieces, allowMissingColumns=True)
    # in each partition the vocabulary, then block by block the words and the documents
    both = both.repartitionById(parts, F.col("home")).sortWithinPartitions("home", F.col("block").asc_nulls_first(), F.col("shard").asc_nulls_last())

    def run(batches):
        now, join, vocabulary = None, None, None
        for b in batches:
            columns = [b.column(c) for c in ("block", "shard", "ids", "aux", "data", "tokens", "pieces")]
            for i in range(b.num_rows):
                block, shard, ids, aux, data, tokens, pieces = (c[i] for c in columns)
                if (block := block.as_py()) is None:
                    now, vocabulary = None, (tokens.values.to_numpy(), pieces.values)
                    continue
                if block != now:
                    now, join = block, _Block(*vocabulary)
                aux, data = unpack_numbers(aux.as_py()).astype(np.int64), unpack_numbers(data.as_py())
                if shard.is_valid:
                    join.add_words(aux, data)
                else:
                    yield join.documents(ids.values, aux, data, digest)

    kind = rows.schema["id"].dataType.simpleString()
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    return both.mapInArrow(run, f"id {kind}, {made}")


class _Block:
    """Ids of one block's words, to be joined with its documents by position, and the pieces of all ids."""

    def __init__(self, tokens: np.ndarray, pieces: pa.Array):
        self.words, self.pieces = [], pieces.cast(pa.large_binary())
        self.place = np.zeros(int(tokens.max()) + 1, np.int32)
        self.place[tokens] = np.arange(len(tokens))

    def add_words(self, gaps: np.ndarray, data: np.ndarray) -> None:
        self.words.append((np.cumsum(gaps), data[:len(gaps)].astype(np.int64), data[len(gaps):].astype(np.int32)))

    def _close(self) -> None:
        number, size, self.flat = (np.concatenate(c) for c in zip((np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),), *self.words))
        self.size, self.begin = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        self.size[number], self.begin[number] = size, np.cumsum(size) - size
        self.words = None

    def documents(self, names: pa.Array, n_words: np.ndarray, numbers: np.ndarray, digest: bool) -> pa.RecordBatch:
        if self.words is not None:
            self._close()
        size = self.size[numbers]
        ids = gather(self.flat, self.begin[numbers], size)
        upto = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_words)])]
        pieces = self.pieces.take(pa.array(self.place[ids]))
        decoded = memoryview(pieces.buffers()[2] or b"")
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[upto] if len(pieces) else upto
        if not digest:
            texts = [decoded[a:z].tobytes() for a, z in zip(ends, ends[1:])]
            return pa.RecordBatch.from_arrays(
                [names, pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32())), pa.array(texts, pa.binary())],
                ["id", "ids", "decoded"])
        sha = lambda data, cuts: [hashlib.sha256(data[a:z]).hexdigest() for a, z in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [names, pa.array(np.diff(upto)), pa.array(sha(memoryview(ids.astype("<u4").tobytes()), 4 * upto)), pa.array(sha(decoded, ends))],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
