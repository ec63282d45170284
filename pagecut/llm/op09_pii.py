"""Personal data: four base patterns, and identifiers found from their contexts by bootstrapping.

Base spans (email, ip, card, phone) are seeds.  Identifier-like tokens (a
digit or ``@`` inside) stand in contexts, the *lexical patterns*: the word
before a token, the two words before, the word after, and the key in front of a
value inside it (``user=``).  A word beside may itself be such a token.  Over
the graph of patterns and instances, a pattern's confidence is the mean
confidence of its instances, and an instance's grows with its patterns';
after a few rounds, tokens of high confidence that no base span covers are added as
kind ``id``.  Built-in functions only.

The expressions avoid group repetition, on which Java's matcher recurses:
characters that would end a match are first replaced one for one, which
keeps every position, and plain character runs then match the same spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecut.llm.common import BLANK, let, store

KINDS = ("email", "ip", "card", "phone", "id")
#: Stands for a character that a match may not cross; texts that hold it get another that is in no pattern.
MARK, OTHER = "\ue000", "\ue001"
_LOCAL = f"[A-Za-z0-9._%+{MARK}-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: The last two words, or the only one, at the end of a text; the first word of one.
LAST_WORDS = r"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++)?[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+$"
NEXT_WORD = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"
#: Punctuation around a token.
HEAD = r"^[\"'(\[<{]*+"
TAIL = r"(?<![.,;:!?)\]>}\"'])[.,;:!?)\]>}\"']++$"


def _found(text: Column) -> Column:
    """Every match of every kind: (kind, its number, characters since the match before, text before, text after, match).

    The texts beside it are those of tokens only; each is cut to what two words need.
    """
    clean = F.translate(text, MARK, OTHER)
    dots = F.regexp_replace(clean, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", MARK)
    seps = F.regexp_replace(clean, r"(?<=[0-9])[\x20-](?![0-9])", MARK)
    sources = ((clean.contains("@"), dots, EMAIL), (clean.contains("."), clean, IP), (F.lit(True), seps, CARD),
               (clean.contains("+"), clean, PHONE), (F.lit(True), clean, TOKEN))

    def beside(kind: int, gaps: Column, ms: Column, k: Column) -> tuple[Column, Column]:
        if kind < 4:
            return F.lit(""), F.lit("")
        tail = lambda a, i: F.coalesce(F.substring(F.get(a, i), -80, 80), F.lit(""))
        head = lambda a, i: F.coalesce(F.substring(F.get(a, i), 1, 80), F.lit(""))
        # the gap may hold no word: the word beside is then the token before or after
        return F.concat(tail(ms, k - 2), tail(gaps, k - 1), tail(ms, k - 1), tail(gaps, k)), F.concat(head(gaps, k + 1), head(ms, k + 1))

    def one(kind: int, where: Column, source: Column, pattern: str) -> Column:
        def places(gaps: Column, ms: Column) -> Column:
            def place(m: Column, k: Column) -> Column:
                left, right = beside(kind, gaps, ms, k)
                return F.struct(F.lit(kind).alias("kind"), k.alias("k"), F.length(gaps[k]).alias("gap"),
                                F.regexp_extract(left, LAST_WORDS, 0).alias("left"),
                                F.regexp_extract(right, NEXT_WORD, 1).alias("right"), m.alias("m"))
            return F.transform(ms, place)

        found = let(source, lambda t: let(F.split(t, pattern, -1), lambda gaps: let(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda ms: places(gaps, ms))))
        none = F.array().cast("array<struct<kind:int,k:int,gap:int,left:string,right:string,m:string>>")
        return F.coalesce(F.when(where, found), none)

    return F.when(text.rlike("[0-9@]"), F.concat(*(one(i, *s) for i, s in enumerate(sources))))


def _luhn(digits: Column) -> Column:
    """Whether a number of at most 19 digits passes the Luhn test."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(20):
        d = F.substring(padded, 20 - i, 1).cast("int")
        total = total + (d if i % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return total % 10 == 0


def _passes(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    small = F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    return F.when(kind == 1, small).when(kind == 2, n.between(12, 19) & F.when(n.between(12, 19), _luhn(digits)).otherwise(False)) \
        .when(kind == 3, n.between(9, 15)).otherwise(True)


def _patterns(left: Column, right: Column, token: Column) -> Column:
    """Lexical patterns of a token: the word or two words before it, the word after, and the key that a value in it follows."""
    word = F.regexp_extract(F.lower(left), r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)
    two = F.regexp_replace(F.trim(F.regexp_replace(F.lower(left), BLANK + "+", " ")), "^[^ ]+$", "")
    after = F.lower(right)
    key = F.regexp_extract(F.lower(token), r"^([a-z_.-]{2,40}[=:])", 1)
    return F.array_compact(F.array(
        F.when(word != "", F.concat(F.lit("word "), word)), F.when(two != "", F.concat(F.lit("words "), two)),
        F.when(after != "", F.concat(F.lit("after "), after)), F.when(key != "", F.concat(F.lit("key "), key))))


def discover(tokens: DataFrame, rounds: int = 3, min_instances: int = 5, min_confidence: float = 0.8) -> DataFrame:
    """Tokens (row, start, end, token, left, right, seed) that their patterns make identifiers, as (row, start, end).

    A pattern needs ``min_instances`` distinct instances to count; its
    confidence is the sum of theirs over their number plus one.
    """
    tokens = tokens.withColumn("inst", F.xxhash64(F.lower("token")))
    edges = tokens.select("inst", "seed", F.explode(_patterns(F.col("left"), F.col("right"), F.col("token"))).alias("p"))
    edges = edges.groupBy(F.xxhash64("p").alias("p"), "inst").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    edges = store(edges, "graph")
    seeds = edges.groupBy("inst").agg(F.max("seed").alias("seed"))
    scored = seeds.withColumn("conf", F.col("seed"))
    for i in range(rounds):
        by_pattern = edges.select("p", "inst").join(scored.select("inst", "conf"), "inst").groupBy("p") \
            .agg(F.sum("conf").alias("s"), F.count("*").alias("n")) \
            .where(F.col("n") >= min_instances).select("p", (F.col("s") / (F.col("n") + 1)).alias("pc"))
        # 1 - product of (1 - confidence), as a sum of logarithms
        by_inst = edges.select("p", "inst").join(by_pattern, "p").groupBy("inst") \
            .agg(F.sum(F.log1p(-F.least("pc", F.lit(0.999999)))).alias("l"))
        scored = seeds.join(by_inst, "inst", "left").select(
            "inst", "seed", F.greatest("seed", 1 - F.exp(F.coalesce("l", F.lit(0.0)))).alias("conf"))
        scored = store(scored, f"scored{i}")
    sure = scored.where((F.col("seed") == 0) & (F.col("conf") >= min_confidence)).select("inst")
    return tokens.where(~F.col("seed")).join(sure, "inst", "left_semi").select("row", "start", "end")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then
    kind; the digest covers the base spans.  A null text is empty: no spans.
    Repeated ids give a row each; an empty table gives no rows.
    """
    rows = store(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                             _found(F.col(text_col)).alias("found")), "matches")
    m = rows.where("size(found) > 0").select("row", F.explode("found").alias("f")).select("row", "f.*")
    upto = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("end", F.sum(F.col("gap") + F.length("m")).over(upto)).withColumn("start", F.col("end") - F.length("m"))
    base_or_token = F.when(F.col("kind") == 4, True).otherwise(_passes(F.col("kind"), F.col("m")))
    m = m.where(base_or_token)
    # tokens without the punctuation around them
    token = F.col("kind") == 4
    head = F.length(F.regexp_extract("m", HEAD, 0))
    m = m.withColumn("token", F.when(token, F.regexp_replace(F.regexp_replace("m", HEAD, ""), TAIL, ""))) \
        .withColumn("start", F.when(token, F.col("start") + head).otherwise(F.col("start"))) \
        .withColumn("end", F.when(token, F.col("start") + F.length("token")).otherwise(F.col("end")))
    m = store(m.where((F.col("kind") < 4) | (F.length("token") > 0)).select("row", "kind", "start", "end", "token", "left", "right"), "places")
    earlier = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.when(F.col("kind") < 4, F.col("end"))).over(earlier)
    after = F.min(F.when(F.col("kind") < 4, F.col("start"))).over(later)
    tokens = m.withColumn("seed", F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))).where(token)
    extra = discover(tokens, **options).select("row", F.lit(4).alias("kind"), "start", "end")

    spans = m.where("kind < 4").select("row", "kind", "start", "end").unionByName(extra)
    spans = spans.groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    return rows.select("row", "id").join(spans, "row", "left").select(
        "id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(F.coalesce(shown(F.filter("s", lambda s: s["kind"] < 4)), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(shown(F.col("s")), F.lit("")).alias("spans"))
