"""Token counts by a compiled finite-state transducer.

The byte-level BPE of a word is run as a deterministic transducer: each byte
moves to a state and adds the change in the number of tokens that the word
so far encodes to.  A state holds what the rest of the word can still alter:
the longest suffix that begins a token, and for each place in it the last
token and the count there.  The next last token is the one suffix that follows
the token before it without a merge across the two.  States and transitions are
compiled when first met and kept in a bounded table.

Long texts are cut into chunks; a chunk's state map is its count between
the first and the last sure word break, with the open text at both ends as
symbolic entry and exit states.  Maps compose associatively, pair by pair.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a chunk; states and words kept.
CHUNK, STATES, WORDS = 1 << 16, 150_000, 150_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level vocabularies: printable Latin-1 stands for itself."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer(dict):
    """Token count of a word: ``self[word]``; words met are kept up to a bound."""

    def __init__(self, merges: dict[tuple[bytes, bytes], int], tokens: set[bytes]):
        super().__init__()
        self.merges, self.tokens = merges, tokens
        self.begins = {t[:i] for t in tokens for i in range(1, len(t))}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self._clear()

    def _clear(self):
        self.names: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, tuple[int, int]] = {}
        self._name((b"", (b"",), (0,)))

    def _name(self, state: tuple) -> int:
        at = self.names.setdefault(state, len(self.states))
        if at == len(self.states):
            self.states.append(state)
        return at

    def merge(self, data: bytes) -> list[bytes]:
        """Plain BPE, to compile with: merge the leftmost pair of least rank."""
        part = [data[i:i + 1] for i in range(len(data))]
        while len(part) > 1:
            rank, i = min((self.merges.get(p, 1 << 60), i) for i, p in enumerate(zip(part, part[1:])))
            if rank == 1 << 60:
                break
            part[i:i + 2] = [part[i] + part[i + 1]]
        return part

    def _follows(self, last: bytes, token: bytes) -> bool:
        """Whether ``token`` can come right after ``last`` (empty: begin a word)."""
        key = last, token
        if key not in self.fits:
            if len(self.fits) > 2 * STATES:
                self.fits.clear()
            self.fits[key] = self.merge(last + token) == ([last, token] if last else [token])
        return self.fits[key]

    def _compile(self, at: int, byte: int) -> tuple[int, int]:
        """The move from a state over a byte: (state, change of the count)."""
        open_, lasts, counts = self.states[at]
        text = open_ + bytes((byte,))
        # lasts[i], counts[i]: at the place i bytes before the end of ``open_``
        for size in range(len(text), 0, -1):
            token = text[len(text) - size:]
            if token in self.tokens and self._follows(lasts[size - 1], token):
                break
        gain = counts[size - 1] + 1
        while text and text not in self.begins:
            text = text[1:]
        keep = len(text)
        lasts, counts = (token, *lasts[:keep]), (0, *(c - gain for c in counts[:keep]))
        return self._name((text, lasts, counts)), gain

    def __missing__(self, word: str) -> int:
        if len(self.states) > STATES:
            self._clear()
        at, n, moves = 0, 0, self.moves
        for byte in word.encode():
            key = at << 8 | byte
            move = moves.get(key)
            if move is None:
                move = moves[key] = self._compile(at, byte)
            at = move[0]
            n += move[1]
        self[word] = n
        return n


class Counter:
    """Token counts of texts, as the tokenizer file ``path`` gives them."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = byte_alphabet()
        raw = lambda s: bytes(byte[c] for c in s)
        added = [t["content"] for t in spec["added_tokens"]]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        vocabulary = {raw(t) for t in spec["model"]["vocab"] if t not in added}
        self.words = Transducer({(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}, vocabulary)
        self.split = regex.compile(pattern).findall
        special = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
        self.special = regex.compile(special).split if special else lambda text: [text]
        self.breaks = regex.compile(r"(?<=\S)(?=\s)")

    def plain(self, text: str) -> int:
        """Tokens of a stretch that ends at sure breaks; a special token counts one and splits the text."""
        parts = self.special(text)
        return sum(sum(map(self.words.__getitem__, self.split(p))) for p in parts) + len(parts) - 1

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(entry text, count between, exit text) of a chunk; no count if it holds no sure break."""
        first = self.breaks.search(chunk)
        if not first:
            return chunk, None, ""
        last = first.start()
        for m in self.breaks.finditer(chunk, max(first.start(), len(chunk) - 4096)):
            last = m.start()
        return chunk[:first.start()], self.plain(chunk[first.start():last]), chunk[last:]

    def compose(self, a, b):
        """The map of two neighbouring chunks."""
        if a[1] is None or b[1] is None:
            joined = a[2] + b[0] if a[1] is not None else a[0] + b[0]
            whole = self.chunk_map(joined)  # their border may be a sure break
            if a[1] is None and b[1] is None:
                return whole
            if whole[1] is None:
                return (a[0], a[1], joined) if a[1] is not None else (joined, b[1], b[2])
            if a[1] is not None:
                return a[0], a[1] + self.plain(whole[0]) + whole[1], whole[2]
            return whole[0], whole[1] + self.plain(whole[2]) + b[1], b[2]
        return a[0], a[1] + self.plain(a[2] + b[0]) + b[1], b[2]

    def count(self, text: str) -> int:
        if len(self.words) > WORDS:
            self.words.clear()
        if len(text) <= CHUNK:
            return self.plain(text)
        maps = [self.chunk_map(text[i:i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # a scan, pair by pair
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        entry, n, exit_ = maps[0]
        return self.plain(entry) + (n or 0) + self.plain(exit_)


@lru_cache(maxsize=1)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of ``docs``.

    ``path`` names the tokenizer's file, readable by every executor.  A null
    or empty text has 0 bytes and tokens.  Added special tokens inside a
    text count one each.  Repeated ids give a row each; an empty table gives no
    rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        c = counter(path, pattern)
        for b in batches:
            counts = [c.count(t.as_py()) for t in b.column(1)]
            sizes = pc.binary_length(b.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
