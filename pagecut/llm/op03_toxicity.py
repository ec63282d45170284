"""Toxicity by noisy-channel deobfuscation.

A character language model (trigrams) is counted over all texts.  Stretches that
look disguised (symbols or digits among letters, letters set apart, long
repetitions) become lattices: each sign may stand for itself or a letter
it imitates, a separator may vanish or be a word border, a repetition may shrink
to one or two.  Viterbi decoding under the model picks the likeliest reading,
and the restored words are scored: a word, or a stem of four to six letters that
it begins with, tells by its share of toxic texts among the labelled texts
that hold it; the strongest words are combined by noisy-or.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecut.llm.common import BLANK, let

#: Letters of the model; every other letter is one class, everything else the word border.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßœ"
_OTHER, _SIZE = len(LETTERS) + 1, len(LETTERS) + 2
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
#: The letters that a sign imitates.
IMITATES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
            "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "h"}
_SIGNS = "[" + re.escape("".join(IMITATES)) + "]"
_EDGE = "[0-9@$]"  # signs that may also begin or end a disguised word; others are punctuation there
_SEPARATORS = " ._*~-"
_SEP = "[" + re.escape(_SEPARATORS) + "]"
_L = r"[^\W\d_]"
#: Disguised stretches: single signs set apart; a letter three times or more; signs among letters.
SUSPICIOUS = re.compile(
    rf"(?<!\S)(?:{_L}|{_SIGNS})(?:{_SEP}(?:{_L}|{_SIGNS})){{2,}}(?!\w)"
    rf"|(?<!\w)(?=\w*?(?P<r>{_L})(?P=r){{2}})\w+"
    rf"|(?<!\w)(?:{_EDGE}{{1,2}}+{_L}++|{_L}++{_SIGNS}{{1,2}}+{_L}++)(?:{_SIGNS}{{1,2}}+{_L}++)*+{_EDGE}?(?!\w)")
#: Found in every text with a disguised stretch; most texts have none and are left as they are.
_HINT = re.compile(rf"{_L}{_SIGNS}{{1,2}}{_L}|(?<!\w){_EDGE}{_L}|({_L})\1\1|(?<!\S)\S{_SEP}\S{_SEP}\S(?!\w)")
_WORD = re.compile(r"[^\W\d_]+")
#: Costs (log probability) of the channel: imitate, drop a separator, keep it as a border, shrink a repetition.
_IMITATE, _DROP, _BORDER, _SHRINK = -1.0, -0.1, -1.5, -0.5
STEMS = (4, 5, 6)
#: Longest stretch whose reading is remembered.
REMEMBER = 80


def _table() -> np.ndarray:
    """Class of every code point of the basic plane."""
    table = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        if chr(c).isalpha():
            table[c] = _CODE.get(chr(c).lower(), _OTHER)
    return table


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    return _table()


def trigram_counts(text: str) -> np.ndarray:
    """Counts of class trigrams of a text, flat."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4")
    c = _classes()[np.minimum(points, 0xFFFF)].astype(np.int32)
    codes = (c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:]
    return np.bincount(codes, minlength=_SIZE ** 3)


def language_model(docs: DataFrame) -> np.ndarray:
    """Smoothed log probability of each class after two others, from all texts.

    The counts reach the driver as at most one row for each trigram of the
    fixed alphabet (``_SIZE ** 3``), whatever the size of the input.
    """
    def run(batches):
        total, held, size = np.zeros(_SIZE ** 3, np.int64), [], 0
        for b in batches:
            for t in b.column(0):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size > 1 << 20:
                    total += trigram_counts(" ".join(held))
                    held, size = [], 0
        total += trigram_counts(" ".join(held))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect()
    n = np.zeros(_SIZE ** 3)
    for gram, count in rows:
        n[gram] = count
    return smooth(n)


def smooth(counts: np.ndarray) -> np.ndarray:
    """Trigrams interpolated with bigrams and single classes, as logarithms."""
    three = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
    two, one = three.sum(0), three.sum((0, 1)) + 1
    p1 = one / one.sum()
    p2 = (two + 2 * p1) / (two.sum(1, keepdims=True) + 2)
    p3 = (three + 2 * p2[None]) / (three.sum(2, keepdims=True) + 2)
    return np.log(p3)


class Restorer:
    """Decodes disguised stretches; readings met are kept up to a bound."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[str, str] = {}

    def _lattice(self, s: str) -> list[list[tuple[str, float]]]:
        """Readings of each sign or repetition: (letters, cost); a blank is a word border."""
        runs, out = [m.group() for m in re.finditer(r"(.)\1*", s, re.S)], []
        apart = all(c in _SEPARATORS for c in s[1::2]) and len(s) > 4
        for run in runs:
            c, n = run[0], len(run)
            if c in _SEPARATORS and (apart or c not in IMITATES):
                out.append([("", _DROP * n), (" ", _BORDER)])
            elif c in IMITATES:
                out.append([(x * k, _IMITATE * n) for x in IMITATES[c] for k in {1, n} if n < 3] or [(" ", 0.0)])
                out[-1].append((" ", -6.0))
            elif n >= 3:
                out.append([(c, _SHRINK), (c + c, _SHRINK)])
            else:
                out.append([(run, 0.0)])
        return out

    def read(self, stretch: str) -> str:
        """The likeliest reading of a stretch (lower case)."""
        if stretch in self.known:
            return self.known[stretch]
        if len(self.known) > 200_000:
            self.known.clear()
        best = {(0, 0): (0.0, None)}  # last two classes -> (score, reading as a chain of its pieces)
        for options in self._lattice(stretch):
            new: dict = {}
            for (a, b), (score, text) in best.items():
                for letters, cost in options:
                    x, y, s = a, b, score + cost
                    for c in letters:
                        z = _CODE.get(c, _OTHER) if c != " " else 0
                        s += self.model[x][y][z]
                        x, y = y, z
                    if (x, y) not in new or s > new[x, y][0]:
                        new[x, y] = (s, (text, letters))
            best = new
        (a, b), (_, chain) = max(best.items(), key=lambda e: (e[1][0] + self.model[e[0][0]][e[0][1]][0], e[0]))
        pieces = []
        while chain:
            chain, letters = chain
            pieces.append(letters)
        found = "".join(reversed(pieces))
        if len(stretch) <= REMEMBER:
            self.known[stretch] = found
        return found

    def restore(self, text: str) -> str:
        """``text`` in lower case with every disguised stretch replaced by its reading."""
        def put(m):
            s = m.group()
            return self.read(s) if sum(c.isalpha() for c in s) >= 2 else s

        text = text.lower()
        return SUSPICIOUS.sub(put, text) if _HINT.search(text) else text


def words(restored: str) -> set[str]:
    return set(_WORD.findall(restored))


def features(word: str) -> list[str]:
    """A word and the stems (with a star) that it begins with."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, max_labelled: int = 50_000, min_docs: int = 5,
          min_share: float = 0.6, max_words: int = 20_000) -> dict[str, float]:
    """Weight (0 to 1) of each telling word or stem.

    ``labels`` (id, toxic) holds the labelled ids that may be learnt from; at
    most ``max_labelled`` of them, chosen by digest, are used, so the join
    broadcasts a table of proven size; of near copies one counts.  A word or stem tells if at least
    ``min_docs`` toxic texts hold it and its smoothed share of toxic texts reaches
    ``min_share``; the ``max_words`` with most toxic texts are kept.  The weight
    is 0 for a share of one half and 1 for a share of one.
    """
    labels = labels.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    some = labels.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    rows = docs.where("text is not null").join(F.broadcast(some), "id")
    # rows that repeat an id count as one: the least of their texts
    rows = rows.groupBy("id").agg(F.min("text").alias("text"), F.max(F.col("toxic").cast("int")).alias("toxic"))
    # near copies of a text say no more than the text: of those that agree in a least shingle hash, one is learnt from
    hashes = [let(F.split(F.lower("text"), BLANK + "+"), lambda ws: F.array_min(F.transform(
        ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2), F.lit(k))))).alias(f"s{k}") for k in range(3)]
    ids = rows.select("id", "toxic", *hashes)
    for k in range(3):
        rest = [c for c in ids.columns if c not in ("toxic", f"s{k}")]
        ids = ids.groupBy("toxic", f"s{k}").agg(F.min(F.struct(*rest)).alias("m")).select("toxic", "m.*")
    rows = rows.join(F.broadcast(ids.select("id")), "id").select("text", "toxic")

    def run(batches):
        r = Restorer(model)
        for b in batches:
            for t, toxic in zip(b.column(0), b.column(1).to_pylist()):
                text = t.as_py()
                found = pa.array(sorted({f for w in words(r.restore(text)) for f in features(w)}), pa.string())
                yield pa.RecordBatch.from_arrays([found, pa.array([toxic] * len(found), pa.int32())], ["word", "toxic"])

    counts = rows.mapInArrow(run, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("t"), F.count("*").alias("n")).where(F.col("t") >= min_docs)
    share = F.col("t") / (F.col("n") + 3)  # rare words regress to no evidence
    told = counts.where(share >= min_share).orderBy(F.desc("t"), "word").limit(max_words)
    told = {r["word"]: r for r in told.select("word", "t", (2 * share - 1).alias("weight")).collect()}
    # a stem that owes at least half its toxic texts to one telling word adds nothing to that word
    owed = {stem for w, r in told.items() if w[-1] != "*" for stem in features(w)[1:]
            if stem in told and 2 * r["t"] >= told[stem]["t"]}
    return {w: r["weight"] for w, r in told.items() if w not in owed}


def score_text(restored: str, weights: dict[str, float], base: float = 0.01, strongest: int = 5) -> float:
    """Noisy-or of the strongest telling words over a base rate."""
    get = weights.get
    found = [max(get(w, 0), get(w[:4] + "*", 0), get(w[:5] + "*", 0), get(w[:6] + "*", 0)) for w in words(restored)]
    return 1 - (1 - base) * math.prod(1 - x for x in sorted(found, reverse=True)[:strongest])


def scored(docs: DataFrame, labels: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc struct<columns>, score) for every row of ``docs``.

    ``labels`` has (id, toxic).  Scores lie between 0 and 1; a null or empty
    text gets the base rate.  Without labelled texts every score is the base
    rate.  Repeated ids give a row each; an empty table gives no rows.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = language_model(named)
    weights = train(named, labels, model, **options)
    rows = docs.select(F.struct(*columns).alias("doc"), F.col(text_col).alias("text"))
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((model, weights))  # a fixed alphabet's table and at most max_words words

    def run(batches):
        model, weights = shared.value
        r = Restorer(model)
        for b in batches:
            out = [score_text(r.restore(t.as_py() or ""), weights) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], ["doc", "score"])

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def held_out(id_col) -> "F.Column":
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def learnable(labels: DataFrame) -> DataFrame:
    """(id, toxic) of the label rows that may be learnt from."""
    return labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
