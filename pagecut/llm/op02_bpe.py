"""Byte-level BPE encoding and decoding with recursive DuckDB queries.

Texts are split into words block by block; the distinct words of all blocks are dealt
to partitions, and each partition keeps the merge table and the vocabulary in a DuckDB
database in memory.  A recursive query makes token-position rows of every word at once, joins
neighbours with the merge table and contracts in each word the leftmost pair of least rank,
until no pair merges; a word leaves the recursion when it reaches its fixpoint.  The ids
go back to their blocks.  There a join with the vocabulary and an ordered aggregate
decode the ids of each distinct word, and documents take ids and bytes by position.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecut.llm.op13_words import encode_words, split_words
from pagecut.llm.packing import gather, unpack_numbers

#: Bytes of words in one recursive query, ids decoded at once.
QUERY_BYTES, DECODE_IDS = 1 << 19, 1 << 20
#: Longer words (in bytes) are merged with a heap: the recursion would make a row for each byte and step.
LONG_WORD = 400

# a merge and its position are packed as one number, so the least one is the leftmost pair of least rank
_ENCODE = """
WITH RECURSIVE step(w, ids, done) AS (
    SELECT w, list(id ORDER BY pos), false FROM start GROUP BY w
  UNION ALL
    (WITH token AS (SELECT w, generate_subscripts(ids, 1) AS pos, unnest(ids) AS id, unnest(ids[2:]) AS next FROM step WHERE NOT done),
          best AS (SELECT w, min((merged << 9) | pos) AS best FROM token JOIN merges ON ab = ((id::BIGINT << 16) | next) GROUP BY w)
     SELECT s.w, CASE WHEN best IS NULL THEN ids
                      ELSE list_concat(list_append(ids[:(best & 511) - 1], (best >> 9)::INT), ids[(best & 511) + 2:]) END, best IS NULL
     FROM step s LEFT JOIN best b ON s.w = b.w WHERE NOT done))
SELECT w, ids FROM step WHERE done"""

_DECODE = """
SELECT piece, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY piece"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        merges = pa.table({"ab": pa.array([a << 16 | b for a, b, _ in pairs], pa.int64()), "merged": pa.array([m for _, _, m in pairs], pa.int64())})
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        self.db.execute("CREATE TABLE merges AS FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS FROM vocabulary")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)

    def _recurse(self, words: list[bytes]) -> list[np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), size),
                          "pos": (np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32),
                          "id": self.byte[data]})
        self.db.register("start", start)
        found = self.db.sql(_ENCODE).to_arrow_table().sort_by("w")
        self.db.unregister("start")
        ids = found["ids"].combine_chunks()
        flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
        return [flat[a:b].astype(np.int32) for a, b in zip(at, at[1:])]

    def _heap(self, word: bytes) -> np.ndarray:
        """The same merges for one long word, with a heap of pairs."""
        part = [word[i:i + 1] for i in range(len(word))]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        rank = lambda i: self.ranks.get(part[i] + part[after[i]]) if after[i] < len(part) else None
        heap = [(r, i, part[i] + part[i + 1]) for i in range(len(part) - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if part[i] is None or after[i] >= len(part) or part[i] + part[after[i]] != joined:
                continue
            j = after[i]
            part[i], part[j], after[i] = joined, None, after[j]
            if after[i] < len(part):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k, part[k] + part[after[k]]))
        return np.array([self.ranks[p] for p in part if p is not None], np.int32)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each distinct word, all ids)."""
        ids, held, size = [None] * len(words), [], 0

        def recurse():
            for n, found in zip(held, self._recurse([words[n] for n in held]) if held else ()):
                ids[n] = found

        for n, word in enumerate(words):
            if word in self.ranks:  # a word that is a token is that token
                ids[n] = np.array([self.ranks[word]], np.int32)
            elif len(word) > LONG_WORD:
                ids[n] = self._heap(word)
            else:
                held.append(n)
                size += len(word)
                if size > QUERY_BYTES:
                    recurse()
                    held, size = [], 0
        recurse()
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.concatenate(ids) if ids else np.zeros(0, np.int32)

    def decode(self, size: np.ndarray, flat: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids."""
        out, upto, first = [], np.cumsum(size), 0
        while first < len(size):
            begin = upto[first] - size[first]
            last = max(first + 1, int(np.searchsorted(upto, begin + DECODE_IDS, side="right")))
            n = size[first:last]
            self.db.register("tokens", pa.table({"piece": np.repeat(np.arange(len(n), dtype=np.int32), n),
                                                 "pos": np.arange(n.sum(), dtype=np.int32), "id": flat[begin:upto[last - 1]]}))
            found = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("tokens")
            part = [b""] * len(n)
            for piece, data in zip(found["piece"].to_pylist(), found["bytes"].to_pylist()):
                part[piece] = data
            out += part
            first = last
        return out


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(path)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded binary) for every row of ``docs``.

    ``path`` names a rank file that every executor can read (base64 token and
    rank on each line), ``pattern`` the expression that splits texts into
    words; special tokens are ordinary text.  A null or empty text has no ids
    and decodes to no bytes.  Repeated ids give a row each; an empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = encode_words(split_words(rows, pattern, [], parts), lambda: codec(path).encode, parts)
    blocks = encoded.select("home", "block", "shard", "ids", "aux", "data").repartitionById(parts, F.col("home")) \
        .sortWithinPartitions("block", F.col("shard").asc_nulls_last())

    def run(batches):
        now, words, table = None, [], None
        for b in batches:
            for block, shard, ids, aux, data in zip(*(b.column(c) for c in ("block", "shard", "ids", "aux", "data"))):
                if block.as_py() != now:
                    now, words, table = block.as_py(), [], None
                aux, data = unpack_numbers(aux.as_py()).astype(np.int64), unpack_numbers(data.as_py())
                if shard.is_valid:  # the numbers of words (as differences), their numbers of ids, the ids
                    words.append((np.cumsum(aux), data[:len(aux)].astype(np.int64), data[len(aux):].astype(np.int32)))
                    continue
                if table is None:
                    table, words = _Words(codec(path), words), None
                yield table.documents(ids.values, aux, data)

    return blocks.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded binary")


class _Words:
    """Ids and bytes of one block's distinct words, by number."""

    def __init__(self, codec: Codec, words: list[tuple[np.ndarray, ...]]):
        number, size, flat = (np.concatenate(c) for c in zip((np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),), *words))
        order = np.argsort(number)
        self.size = size[order]
        self.flat = gather(flat, (np.cumsum(size) - size)[order], self.size)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = pa.array(codec.decode(self.size, self.flat), pa.large_binary())

    def documents(self, names: pa.Array, n_words: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        words = np.concatenate([[0], np.cumsum(n_words)])
        size, text = self.size[numbers], self.bytes.take(pa.array(numbers))
        upto = np.concatenate([[0], np.cumsum(size)])[words]
        ids = gather(self.flat, self.begin[numbers], size)
        ends = np.frombuffer(text.buffers()[1], np.int64)[words] if len(text) else words
        decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(np.ascontiguousarray(ends)), text.buffers()[2] or pa.py_buffer(b"")])
        return pa.RecordBatch.from_arrays(
            [names, pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32())), decoded.cast(pa.binary())], ["id", "ids", "decoded"])


def digests(encoded: DataFrame) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of ``bpe_round_trip``'s rows."""
    return encoded.select(
        "id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
