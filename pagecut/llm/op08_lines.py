"""Quality rules from line frequency across documents.

Each document's lines are normalised and hashed; a line that stands in too
many documents of one host (column ``source`` here) is boilerplate and is
removed, and a document that loses most of its words this way is rejected.  The
plain rules (word count, repeated 8-word windows) come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecut.llm.common import BLANK, WORD, let, store

SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _item(array: Column, at: Column) -> Column:
    return F.get(array, at)


def repeat_words(words: Column, window: int = 8) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes.
    Only a text with a repeated window pays for sorting the windows and
    measuring the union of the repeated ones.
    """
    def count(starts: Column) -> Column:
        # union of [start, start + window): each start adds what lies beyond the end reached so far
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, s: F.struct(
            (a["n"] + window - F.greatest(a["end"] - s, F.lit(0))).alias("n"), (s + window).alias("end")))["n"]

    def repeated(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda o: F.array_sort(F.array_compact(F.transform(o, lambda s, j: F.when(
            (s["h"] == _item(o, j - 1)["h"]) | (s["h"] == _item(o, j + 1)["h"]), s["i"])))))
        return count(starts)

    def from_hashes(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - window),
                              lambda i: F.xxhash64(*(_item(hashes, i + k) for k in range(window))))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(repeated(w)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(hashes, from_hashes)).otherwise(0)


def line_hash(line: Column) -> Column:
    """Hash of a normalised line."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), BLANK + "+", " ")))


def _measure(text: Column) -> Column:
    """All per-document figures, and (hash, words) of each line that holds a word."""
    def line_figures(lines: Column) -> Column:
        normal = F.transform(lines, lambda x: F.struct(line_hash(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("n")))
        return F.struct((F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"), normal.alias("all"))

    def word_figures(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n"), repeat_words(words).cast("long").alias("repeat"))

    return F.struct(
        F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(words_of(text), word_figures).alias("words"),
        let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)), line_figures).alias("lines"))


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 min_words: int = 20, max_repeat_pct: int = 30, min_docs: int = 20, min_left: float = 0.4,
                 remaining: bool = False) -> DataFrame:
    """Figures and verdict for every row of ``docs``; with ``remaining`` also the text without the removed lines.

    Returns id, the base figures, ``n_removed_words`` (words of removed
    lines), ``base_failed`` and ``kept``.  A
    normalised line (lower case, blanks squeezed) is removed when it
    stands in more than ``min_docs`` distinct documents of the host, however many
    documents the host has; a document is depleted, and rejected,
    when less than ``min_left`` of its words is left.  Null texts are empty; a
    null host is a host of its own; repeated ids are documents of their own;
    an empty table gives no rows.  Only built-in functions are used.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.col(host_col).alias("host"), _measure(text).alias("m"), *([text.alias("text")] if remaining else []))
    rows = rows.select("row", "id", "host", *(["text"] if remaining else []), "m.word_chars", "m.n_symbols", F.col("m.words.n").alias("n_words"),
                       F.col("m.words.repeat").alias("n_repeat_words"), F.col("m.lines.dup").alias("n_dup_lines"),
                       F.col("m.lines.all").alias("lines"))
    rows = store(rows, "measures")
    # a document counts once for a line: its lines are made distinct before they are exploded
    lines = rows.select("row", "host", F.explode(F.array_distinct("lines.h")).alias("h"))
    often = lines.groupBy("host", "h").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    hits = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.h", "l.n").alias("a") \
        .join(often.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.h") == F.col("b.h")), "left_semi")
    # the distinct removed lines of one document, at most as many as it has
    gone = [F.collect_set("h").alias("gone")] if remaining else []
    lost = hits.groupBy("row").agg(F.sum("n").cast("long").alias("n_removed_words"), *gone)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words")
    return rows.join(lost, "row", "left").na.fill(0, ["n_removed_words"]).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
        failed.alias("base_failed"), (~failed & left).alias("kept"), *([_without(F.col("text"), F.col("gone")).alias("text")] if remaining else []))


def _without(text: Column, gone: Column) -> Column:
    """``text`` without its lines whose hash is in ``gone``; blank lines stay."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~(x.rlike(WORD) & F.array_contains(gone, line_hash(x))))
    return F.when(gone.isNull(), text).otherwise(F.array_join(lines, "\n"))
