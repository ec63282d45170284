"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagecut.llm import op01_simhash as op01, op02_bpe as op02, op03_toxicity as op03, op04_exact as op04
from pagecut.llm import op05_suffix as op05, op06_mix as op06, op07_count as op07, op08_lines as op08
from pagecut.llm import op09_pii as op09, op10_urls as op10
from pagecut.llm.queries import COUNTING, ENCODING, P
from test_queries import brute_components, brute_fingerprint, check_pii

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, fp int, row int, _row int, h string, kept string, copies int, size string, text_sha256 int, part int")
LONG = "Ab c " * 60_000
TEXTS = [(1, "One two three four", "a"), (2, None, "a"), (3, "", None), (4, "One two three four", "b"), (4, "One two three four", "b"),
         (None, "one  two three four ", "a"), (5, LONG, None), (6, "x" * 70_000, "c"), (7, " \n\t ", "c"), (8, "a@b.c " * 3000, "a"),
         (None, None, None), (9, "1 " * 30_000 + "4111 1111 1111 1111", "a"), (10, "é漢\U0001f642 <|endoftext|> 'll", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, s, None, "clash", 1, 2, 3, "h", "k", 9, "s", 4, 5) for i, t, s in TEXTS], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


RUNS = {
    "op1": op01.near_duplicates, "op4": op04.exact_groups, "op5": op05.dedup_substrings, "op6": op06.mix, "op8": op08.line_quality,
    "op9": op09.personal_data, "op2": lambda d: op02.digests(op02.bpe_round_trip(d, ENCODING, P.PATTERN)),
    "op7": lambda d: op07.token_counts(d, COUNTING, P.PATTERN),
    "op3": lambda d: op03.scored(d, d.select(F.col("doc_id").alias("id"), F.lit(1).alias("toxic")), ["doc_id"]),
    "stage4": op04.drop_duplicates, "stage1": op01.drop_near_duplicates, "stage6": op06.take,
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(empty, name):
    assert RUNS[name](empty).collect() == []


@pytest.mark.parametrize("name", [n for n in RUNS if n.startswith("op")])
def test_a_row_for_every_row(docs, name):
    found = RUNS[name](docs)
    ids = [r.doc.doc_id if name == "op3" else r.id for r in found.collect()]
    assert Counter(ids) == Counter(i for i, _, _ in TEXTS)


def test_simhash_values(docs):
    got = op01.near_duplicates(docs).collect()
    want = [brute_fingerprint(t) for _, t, _ in TEXTS]
    assert Counter((r.id, r.fp % 2 ** 64) for r in got) == Counter((i, f) for (i, _, _), f in zip(TEXTS, want))
    group = brute_components(list(enumerate(want)))
    least = {g: min((TEXTS[i][0] for i in group if group[i] == g and TEXTS[i][0] is not None), default=None) for g in group.values()}
    assert Counter((r.fp % 2 ** 64, r.component_id) for r in got) == Counter((f, least[group[i]]) for i, f in enumerate(want))


def test_simhash_shards_against_all_pairs(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    near = np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)) for _ in range(6))])
    near = np.unique(near)
    vantage, radius = op01.build_tree(near[::7], 4, 2)
    leaf, guest, fp = op01.route(near, vantage, radius, 2)
    assert sorted(fp[~guest]) == sorted(near)
    links = [op01.shard_links(fp[(leaf == s) & ~guest], fp[(leaf == s) & guest], 2, leaf=40) for s in range(16)]
    frame = spark.createDataFrame([(int(a.view(np.int64)), int(b.view(np.int64))) for x, y in links for a, b in zip(x, y)], "a long, b long")
    from pagecut.llm.components import connected_components
    got = {r.node: r.component for r in connected_components(frame).collect()}
    signed = [int(x) for x in near.view(np.int64)]
    want = brute_components(sorted((x, x % 2 ** 64) for x in signed))
    assert {x: got.get(x, x) for x in signed} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    from pagecut.llm.components import connected_components
    rows = [(i, i + 1) for i in range(300)] + [(5000, 1000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + i] for i in range(1, 200)} == {1000} and got[5000] == 1000


def test_exact_values(docs):
    got = op04.exact_groups(docs).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, _ in TEXTS]
    size = Counter(norm)
    assert sum(r.kept for r in got) == len(size)
    same = [r for r in got if r.id == 4]
    assert all(r.group_size == 3 and r.keep_id == 1 for r in same)  # "one  two ..." differs in case
    blank = [r for r in got if r.id == 3]
    assert blank[0].group_size == 4 and blank[0].keep_id == 7  # the longest blank text stays
    assert op04.drop_duplicates(docs).count() == len(size)


def test_exact_group_across_partitions(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.concat(F.lit("t "), "id")).alias("text"))
    got = op04.exact_groups(rows.repartition(16))
    assert got.where("kept").count() == 1001 and got.where("group_size = 2000 and keep_id = 1").count() == 2000
    assert op04.drop_duplicates(rows).count() == 1001


def test_exact_groups_over_many_partitions(spark):
    """Runs that fill whole partitions, end in them and begin in them; digests of neighbours that agree or not."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = F.when(F.col("id") % 2 == 0, "same text").when(F.col("id") % 5 == 0, "an other").otherwise(F.concat(F.lit("t "), F.col("id") % 40))
        rows = spark.range(4000).select(F.col("id").alias("doc_id"), text.alias("text"))
        stored = op04.sorted_runs(rows, "doc_id", "text", ["doc_id"])
        assert stored.where("_run = 0 and _ends = 1").count() > 2 and stored.select("_part").distinct().count() > 4
        got = {r.id: r for r in op04.exact_groups(rows).collect()}
        by = {}
        for r in rows.collect():
            by.setdefault(r.text, []).append(r.doc_id)
        for ids in by.values():
            assert all((got[i].keep_id, got[i].group_size, got[i].kept) == (min(ids), len(ids), i == min(ids)) for i in ids)
        assert sorted(r.doc_id for r in op04.drop_duplicates(rows).collect()) == sorted(map(min, by.values()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def brute_removed(rows, length):
    seen, out = set(), []
    for doc, text in rows:
        covered = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if text[i:i + length] in seen:
                covered[i:i + length] = b"\1" * length
            seen.add(text[i:i + length])
        out.append((doc, bytes(t for t, c in zip(text, covered) if not c), sum(covered),
                    len(re.findall(b"\1+", bytes(covered)))))
    return out


def test_suffix_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(6)] + ["ab" * 150, " " * 260, "z" * 99]
    texts = []
    for i in range(120):
        parts = [rng.choice(passages)[rng.randint(0, 30):] if rng.random() < 0.6 else " ".join(word() for _ in range(rng.randint(1, 60)))
                 for _ in range(rng.randint(0, 5))]
        texts.append((i, "".join(parts)))
    frame = spark.createDataFrame(rng.sample(texts, len(texts)), "doc_id long, text string").repartition(7)
    got = sorted((r.id, bytes(r.kept), r.n_removed, r.n_spans) for r in op05.dedup_substrings(frame).collect())
    assert got == brute_removed([(i, t.encode()) for i, t in texts], 100)


def test_suffix_spreads_a_hot_gram(spark, monkeypatch):
    rng, plain, most = random.Random(5), op05.repeated_in_group, 40

    def bounded(group, *rest):
        assert len(group) <= most, f"{len(group)} suffixes of one gram in one task"
        return plain(group, *rest)

    monkeypatch.setattr(op05, "GROUP", most, raising=False)
    monkeypatch.setattr(op05, "repeated_in_group", bounded)
    line = "Licensed for any use, but without any warranty."
    around = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    edges = [around(60) for _ in range(3)]
    texts = [(i, around(rng.randint(0, 90)) + rng.choice(edges + [around(60)]) + line + rng.choice(edges + [around(60)]) + around(90))
             for i in range(400)]
    want = brute_removed([(i, t.encode()) for i, t in texts], 100)
    for ranges in (1, 40):  # one range holds the gram, many cut it
        frame = spark.createDataFrame(rng.sample(texts, len(texts)), "doc_id long, text string").repartition(5)
        got = sorted((r.id, bytes(r.kept), r.n_removed, r.n_spans) for r in op05.dedup_substrings(frame, ranges=ranges).collect())
        assert got == want


def test_mix_keeps_to_its_budget(docs, spark):
    got = op06.mix(docs).collect()
    assert all(r.copies == 0 for r in got if r.size == 0) and max(r.copies for r in got) <= 2
    assert sum(r.size * r.copies for r in got) <= 1.5 * sum(r.size for r in got)
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.pmod("id", F.lit(7))).alias("source"),
                                    F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    by = {}
    for r in op06.mix(rows).collect():
        by.setdefault(r.target, []).append(r.size * r.copies)
    assert all(abs(sum(v) - t) <= 100 for t, v in ((t, v) for t, v in by.items()) if t * len(by) > 0 and len(v) < 1000)


def test_line_rules(spark):
    text = lambda i: f"Shared  header Line\nword{i} " + " ".join(f"w{i}x{j}" for j in range(40))
    only = "Shared header line\n" * 30
    rows = [(i, text(i), "h") for i in range(60)] + [(100, only, "h"), (101, only, "other"), (102, "a b c d e f g h " * 9, "h")]
    got = {r.id: r for r in op08.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and got[0].n_removed_words == 3
    assert not got[100].kept and got[100].n_removed_words == 90 and got[100].n_dup_lines == 29
    assert got[102].base_failed and got[102].n_repeat_words == 72


def test_remaining_text(spark):
    own = lambda i: f"\n\n own {i} line \r\n" + " ".join(f"w{i}x{j}" for j in range(30))
    rows = [(i, f"SHARED \t header{own(i)}\nshared header", "h", "t") for i in range(25)] + [(90, "shared header", "other", "t"), (91, None, None, "t")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, gone string")
    got = {r.id: r for r in op08.line_quality(frame, remaining=True).collect()}
    assert all(got[i].text == own(i)[1:] and got[i].n_removed_words == 4 and got[i].kept for i in range(25))
    assert got[90].text == "shared header" and got[91].text == ""
    assert {r.id: r.kept for r in op08.line_quality(frame).collect()} == {i: r.kept for i, r in got.items()}


def test_line_limit_is_alike_in_hosts_of_any_size(spark):
    own = lambda i: f"own {i} " + " ".join(f"w{i}x{j}" for j in range(25))
    often, seldom = " ".join(f"often{j}" for j in range(30)), " ".join(f"seldom{j}" for j in range(30))
    rows = [(i, own(i), "big") for i in range(3000)] + [(i, own(i), "small") for i in range(3000, 3100)]
    for at, host in ((10_000, "big"), (20_000, "small")):
        rows += [(at + i, f"{often}\n{own(at + i)}", host) for i in range(20)] + [(at + 20, often, host)]
        rows += [(at + 30 + i, f"{seldom}\n{own(at + i)}", host) for i in range(20)]
    got = {r.id: r for r in op08.line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for at in (10_000, 20_000):  # 21 documents of 3,061 and of 161 hold the line; 20 hold the other
        assert got[at].n_removed_words == 30 and got[at].kept and got[at + 30].n_removed_words == 0
        assert got[at + 20].n_removed_words == 30 and not got[at + 20].base_failed and not got[at + 20].kept


PII = ["mail a.b+c@x-y.co.uk, .a@b.c..d @x a@b a..b@c.d.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.002.3.4 1.2.3", "+1 (555) 010-9999 +12 +1--2--3--4--5--6--7--8--9 x",
       "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 1234567890123456789012", "a@b.com_x@y.com z@q.w.@e.r", None, "", "é漢 a@b.c \U0001f642 1.2.3.4 x@y.z", "+" * 50 + "1" * 40,
       "4111\ue0001111\ue0001111\ue0001111 +1555\ue0000109\ue000999 a\ue000b@c.d", "a@b" + ".c" * 20_000, "1 " * 20_000 + "1", "1." * 20_000, "x" * 50_000 + "@"]


def test_pii_values(spark):
    got = {r.id: r for r in op09.personal_data(spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")).collect()}
    check_pii([got[i] for i in range(len(PII))], PII)


def test_pii_discovers_by_context(spark):
    rows = [f"please contact user{i}@mail.com now" for i in range(40)] + ["please contact @handle_77 now", "chapter 12 begins", "chapter 13 ends"]
    got = {r.id: r.spans for r in op09.personal_data(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got[40] == "id:15:25" and got[41] == "" and got[0].startswith("email:15:")


def test_pii_discovers_behind_words_with_digits(spark):
    mail = [f"md5 user{i}@mail.com end" for i in range(40)]
    rows = mail + ["sum md5 9f3a77 end", "acct 0044 AB12 end", "chapter 12 begins", "chapter 13 ends"]
    got = {r.id: r.spans for r in op09.personal_data(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert "id:8:14" in got[40] and got[42] == got[43] == ""
    assert "id:10:14" in got[41]  # by the word after


def test_urls(spark):
    page = lambda target: f'<head><link href="{target}" rel="canonical"></head>'
    rows = [(1, "http://a.example.com/en/1", None), (2, "http://b.org/x", page("http://a.example.com/en/1")), (3, "http://c.org/", '<meta http-equiv="refresh" content="0; url=http://b.org/x">'),
            (4, "HTTP://Example.com:80/en/2", None), (5, "http://d.net/fr/1?utm_source=q#z", None), (6, None, "x"), (7, "no scheme", page("/q")), (8, "http://www.example.com/en/", page("http://a.example.com/en/3")),
            (9, "http://e.org/1", page("http://www.example.com/en/")), (10, "http://f.org", None), (1, "http://a.example.com/en/1", None)]
    got = op10.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    v = {r.id: (r.rule, r.verdict) for r in got}
    assert len(got) == len(rows)
    assert v[1] == ("example.com/en/", "block") and v[2] == (None, "block") and v[3] == (None, "block") and v[4] == (None, "block")
    assert v[5] == ("net/fr/", "block") and v[6] == v[7] == v[10] == (None, "allow") and v[8] == ("www.example.com/en/", "allow")
    assert v[9] == (None, "allow")  # an explicit allow in the component takes precedence
    assert op10.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_url_targets(spark):
    page = lambda target: f'<link rel="canonical" href="{target}">'
    at = "http://h.example.org/a/b/c.html?x=1#top"
    want = {"page2.html": "http://h.example.org/a/b/page2.html", "../x": "http://h.example.org/a/x", "./y/../z": "http://h.example.org/a/b/z",
            "../../../up": "http://h.example.org/up", "?id=3": "http://h.example.org/a/b/c.html?id=3", "/q?a=1&amp;b=2": "http://h.example.org/q?a=1&b=2",
            "//other.org/p": "http://other.org/p", "https://s.org/r?u=..": "https://s.org/r?u=..", "mailto:a@b.c": None, "#frag": None, "..": "http://h.example.org/a/",
            "?u=http://x.y/": "http://h.example.org/a/b/c.html?u=http://x.y/", "d/e?r=/../f": "http://h.example.org/a/b/d/e?r=/../f"}
    rows = spark.createDataFrame([(t, at, page(t)) for t in want], "t string, url string, html string")
    got = {r.t: r.to for r in rows.select("t", op10.link_target(F.col("html"), F.col("url"))[1].alias("to")).collect()}
    assert got == want
    bare = spark.createDataFrame([("http://h.org", page("p")), ("http://h.org?q", page("?id=3"))], "url string, html string")
    assert [r[0] for r in bare.select(op10.link_target(F.col("html"), F.col("url"))[1]).collect()] == ["http://h.org/p", "http://h.org?id=3"]
    # a relative redirect takes on the block of the page it names, also with clashing columns and repeated urls
    rows = [(1, "http://example.com/en/bad.html", None), (2, "http://b.org/x/y.html", '<meta http-equiv="refresh" content="0; url=../go?a=1&amp;b=2">'),
            (3, "http://b.org/go?a=1&b=2", page("http://example.com/en/bad.html"))]
    got = op10.judge(spark.createDataFrame([(*r, "h", 1, "v") for r in rows * 2], "page_id long, url string, html string, host string, node int, verdict string")).collect()
    assert len(got) == 6 and {r.verdict for r in got} == {"block"}


def test_toxic_words_count_once_for_repeated_ids(spark):
    import numpy as np
    model = op03.smooth(np.zeros(op03._SIZE ** 3))
    base = [(i, f"plain words number{i} here{i} now{i}") for i in range(20)] + [(100 + i, f"awful nasty text{i} lines{i} end{i}") for i in range(10)]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in base], "id long, toxic int")
    once, often = (op03.train(spark.createDataFrame(rows, "id long, text string"), labels, model)
                   for rows in (base, base + [base[20]] * 5 + [base[0]] * 3))
    assert once == often and "nasty" in once


def test_long_stretches_are_read_whole():
    import numpy as np
    text = "you are an idiot and a loser so stupid what a pathetic clown in the hall " * 50
    r = op03.Restorer(op03.smooth(op03.trigram_counts(text).astype(np.float64)))
    spaced = " ".join("youareanidiotandaloser" * 9)
    assert op03.words(r.restore(spaced)) <= {"you", "are", "an", "idiot", "and", "a", "loser"} and len(r.restore(spaced).split()) == 63


def test_counts_of_chunked_texts():
    from tokenizers import Tokenizer
    t, c, rng = Tokenizer.from_file(COUNTING), op07.Counter(COUNTING, P.PATTERN), random.Random(2)
    for text in [LONG, "x" * 200_000, " " * 150_000, "".join(rng.choice(["a ", "b", "\n", " ", "'ll", "<|endoftext|>", "é"]) for _ in range(90_000))]:
        assert c.count(text) == len(t.encode(text, add_special_tokens=False).ids)


def test_restoring():
    import numpy as np
    text = "you are an idiot and a loser so stupid what a pathetic clown in the hall " * 50
    r = op03.Restorer(op03.smooth(op03.trigram_counts(text).astype(np.float64)))
    for seen, meant in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("l0ser", "loser"), ("looooser", "loser"), ("$tupid", "stupid"), ("p@thetic", "pathetic"), ("c.l.o.w.n", "clown")):
        assert op03.words(r.restore(f"the {seen}, then")) >= {meant}
    assert r.restore("The hall, 1999!") == "the hall, 1999!"


def test_suffix_texts_travel_compressed():
    import pyarrow as pa

    from pagecut.llm.op05_suffix import squeeze, unsqueeze
    texts = [b"", "wörter ".encode() * 200, bytes(range(256))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, None, 3], pa.int64()), pa.array([7, 8, 9], pa.int64()), pa.array(texts, pa.binary())], ["doc", "key", "text"])
    (out,) = squeeze([batch])
    assert out.column(0).to_pylist() == [1, None, 3] and out.column(1).to_pylist() == [7, 8, 9]
    packed = out.column(2).to_pylist()
    assert [unsqueeze(p) for p in packed] == texts and len(packed[1]) < 100
