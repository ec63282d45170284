"""Alignment, hard negatives and the word table against brute force, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagecut.llm import op11_align as op11, op12_negatives as op12, op13_words as op13
from pagecut.llm.op07_count import byte_alphabet
from pagecut.llm.queries import COUNTING, PIECES, QUERIES

SF_SMALL = "/root/testdata/sf0.001"
LONG = "Ab c " * 40_000
TEXTS = [(1, "One two three four"), (2, None), (3, ""), (4, "One two three four"), (4, "One two three four"), (None, "x" * 70_000),
         (5, LONG), (6, " \n\t "), (7, "é漢\U0001f642 <|endoftext|><|endoftext|> 'll \r\n x\0y"), (8, "tail  　 a▁b"), (9, " a  b "),
         (10, "漢字かな交じり文" * 9000), (11, "▁"), (12, "a ▁ b")]
SCHEMA = "doc_id long, text string, id string, ids int, block int, file int, row int, data string, kind int, _doc int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, "d", 5, 6) for i, t in TEXTS], SCHEMA).cache()


# alignment -----------------------------------------------------------------

TOKENS = Tokenizer.from_file(COUNTING)
PIECE = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_align(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text."""
    plain, byte, found, docs_with = Tokenizer.from_file(COUNTING), byte_alphabet(), [], Counter()
    plain.encode_special_tokens = True
    in_a = {i: bytes(byte[c] for c in t) for t, i in plain.get_vocab().items() if i != 50256}
    in_b = lambda i: bytes([int(PIECE.id_to_piece(i)[3:5], 16)]) if PIECE.is_byte(i) else PIECE.id_to_piece(i).replace("▁", " ").encode()

    def ranges(ids, piece):
        at = 0
        for i in ids:
            yield at, (at := at + len(piece(i))), i

    for text in texts:
        a = list(ranges(plain.encode(" " + (text or ""), add_special_tokens=False).ids, in_a.get))
        b = list(ranges(PIECE.encode(text or ""), in_b))
        if not text or any(b"".join(p(i) for _, _, i in x) != (" " + text).encode() for x, p in ((a, in_a.get), (b, in_b))):
            found.append(None)
            continue
        ends, groups, links, i, j = sorted({z for _, z, _ in a} & {z for _, z, _ in b}), [], [], 0, 0
        for end in ends:
            x, y = [], []
            while i < len(a) and a[i][1] <= end:
                x.append(a[i])
                i += 1
            while j < len(b) and b[j][1] <= end:
                y.append(b[j])
                j += 1
            groups.append("|".join(",".join(str(t) for _, _, t in side) for side in (x, y)))
            links += [(t, u) for p, q, t in x for r, s, u in y if p < s and r < q]
        found.append((len(a), len(b), ";".join(groups), len(groups), links))
        docs_with.update(set(links))
    top = defaultdict(int)
    for (t, _), n in docs_with.items():
        top[t] = max(top[t], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], f[3], len(f[4]), sum(docs_with[x] == top[x[0]] for x in f[4]), sum(docs_with[x] for x in f[4]), f[2]) for f in found]


def check_align(frame, rows):
    got = Counter((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)
                  for r in op11.align(frame, COUNTING, PIECES, P.PATTERN).collect())
    assert got == Counter((i, *w) for (i, _), w in zip(rows, brute_align([t for _, t in rows])))


def test_align_edges(docs):
    check_align(docs, TEXTS)


def test_align_composes_fragments_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(op11, "CHUNK", 40)
    monkeypatch.setattr(op11, "FAN", 3)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcéß漢\U0001f642., \n ") for _ in range(rng.choice([1, 3, 9, 60])))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 80)))) for i in range(60)]
    check_align(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_align_blocks_share_counts(spark, monkeypatch):
    monkeypatch.setattr(op11, "BLOCK_BYTES", 200)
    monkeypatch.setattr(op11, "SHARED", 2)
    monkeypatch.setattr(op11, "STRETCHES", 20)
    rows = [(i, f"the cat {i % 7} sat, unbelievably{i}") for i in range(100)]
    check_align(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_fragments_are_associative():
    a = op11.Aligner(COUNTING, PIECES, P.PATTERN)
    rng = random.Random(9)
    for _ in range(60):
        data = (" " + "".join(rng.choice(["ab", " ", "é", "漢", "\n", ". ", "cd e"]) for _ in range(rng.randint(3, 40)))).encode()
        x, y = sorted(rng.sample(range(1, len(data)), 2))
        parts = op11._fragment(a, [op11.cut(data[:x], True, False), op11.cut(data[x:y], False, False), op11.cut(data[y:], False, True)])
        left, right = op11.compose(a, op11.compose(a, *parts[:2]), parts[2]), op11.compose(a, parts[0], op11.compose(a, *parts[1:]))
        (whole,) = op11._fragment(a, [op11.cut(data, True, True)])
        assert left == right == whole


def test_op11(spark):
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in QUERIES["op11_align"](spark, SF_SMALL).collect()}
    want = brute_align([d["text"] for d in docs])
    assert got == {d["doc_id"]: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for d, w in zip(docs, want)}


# hard negatives ------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives=10):
    """Result rows for (vec_id, vector, label) with anchors at ids divisible by 100."""
    fine = [(i, [int(np.floor(256 * x)) for x in v], c) for i, v, c in rows
            if c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, place = Counter(), lambda p: (-p[1], p[0] is None, p[0] or 0)
    for n, (i, v, c) in enumerate(fine):
        if i is None or i % 100:
            continue
        score = [(j, sum(x * y for x, y in zip(v, w)), d) for m, (j, w, d) in enumerate(fine) if m != n]
        for p in sorted((s for s in score if s[2] == c), key=place)[:positives]:
            fit = sorted((s for s in score if s[2] != c and 30 * p[1] <= 100 * s[1] <= 90 * p[1]), key=place)[:negatives]
            out.update((i, p[0], k, s[0], p[1], s[1]) for k, s in enumerate(fit, 1))
    return out


def check_negatives(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, "n") for r in rows], "vec_id long, embedding array<double>, label int, file int, id int, norm string")
    got = Counter(tuple(r) for r in op12.hard_negatives(frame, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_negatives(rows)
    return got


def test_negatives_edges(spark):
    inf, nan = float("inf"), float("nan")
    v = lambda *x: [float(y) for y in x]
    rows = [(0, v(1, 0.5), 1), (0, v(1, 0.5), 1), (1, v(1, 0.4), 1), (2, v(0.5, 0.3), 2), (3, v(0.5, 0.3), 2), (3, v(0.5, 0.3), 2), (None, v(0.5, 0.3), 2),
            (4, None, 2), (5, v(1, 0), None), (6, [None, 1.0], 2), (7, v(inf, 1), 2), (8, v(nan, 1), 2), (9, [], 2), (10, v(0.6), 3), (11, v(0.4, 0.2, 9), 3),
            (100, v(-1, 0), 4), (12, v(1, 0), 4), (13, v(-0.5, 0), 5), (200, v(0, 0), 6), (14, v(1, 1), 6), (300, v(3, 3), 7), (400, [], 8), (15, [], 8), (None, v(2, 2), 1)]
    assert check_negatives(spark, rows)
    assert op12.hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), F.col("vec_id") % 100 == 0).collect() == []


def test_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op12, "SHARD_ROWS", 100)
    monkeypatch.setattr(op12, "ANCHORS", 2)
    rng = np.random.default_rng(3)
    copy = rng.normal(size=20) / 4
    rows = []
    for i in range(900):
        vector = copy if i % 3 == 0 else rng.normal(size=20) / 4 + (copy if i % 5 == 0 else 0)
        rows.append((i, [float(x) for x in vector], int(rng.integers(0, 4)) if i % 50 else 9))
    check_negatives(spark, rows)


def test_index_finds_every_pair_above_the_threshold():
    rng = np.random.default_rng(8)
    x, q = (np.floor(256 * rng.normal(size=(n, 64)) / 8).astype(np.int64) for n in (700, 30))
    score = q @ x.T
    for share in (0.9, 0.5, 0.2, 0.0, -np.inf):
        t = share * np.sqrt((q * q).sum(axis=1)) * 256 if share > -np.inf else np.full(len(q), share)
        i, j, s = op12.SuffixIndex(x).search(q, t)
        want = score >= t[:, None]
        assert want.sum() == len(i) and want[i, j].all() and (s == score[i, j]).all()


# word table ----------------------------------------------------------------

def test_words_edges(docs):
    got = Counter((r.id, tuple(r.ids), bytes(r.decoded)) for r in op13.bpe_round_trip(docs, COUNTING, P.PATTERN).collect())
    want = [tuple(TOKENS.encode(t or "", add_special_tokens=False).ids) for _, t in TEXTS]
    assert got == Counter((i, w, TOKENS.decode(w, skip_special_tokens=False).encode()) for (i, _), w in zip(TEXTS, want))


def test_words_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(op13, "BLOCK_CHARS", 300)
    monkeypatch.setattr(op13, "ROW_WORDS", 5)
    rows = [(i, f"the cat {i % 7} sat<|endoftext|> unbelievably{i}" * (i % 4)) for i in range(100)]
    got = {r.id: (tuple(r.ids), bytes(r.decoded).decode()) for r in op13.bpe_round_trip(spark.createDataFrame(rows, "doc_id long, text string"), COUNTING, P.PATTERN).collect()}
    assert got == {i: (tuple(TOKENS.encode(t).ids), t) for i, t in rows}


def test_word_merges_agree():
    v, rng = op13.Vocabulary(COUNTING), random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 5, 40, 900, 6000]))).encode() for _ in range(300)] + [b"a" * 5000, "漢".encode() * 1500, b""]
    size, ids = v.encode(words)
    parts = np.split(ids, np.cumsum(size)[:-1])
    for word, part in zip(words, parts):
        assert part.tolist() == TOKENS.encode(word.decode()).ids
        if 0 < len(word) < 1000:
            assert v._merge_long(word).tolist() == part.tolist()
    v.at_once = False
    assert (v.encode(words[:50])[1] == np.concatenate(parts[:50])).all()


def test_op13(spark):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_words"](spark, SF_SMALL).collect()}
    sha, want = lambda b: hashlib.sha256(b).hexdigest(), {}
    for d in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist():
        ids = TOKENS.encode(d["text"] or "", add_special_tokens=False).ids
        want[d["doc_id"]] = len(ids), sha(np.array(ids, "<u4").tobytes()), sha(TOKENS.decode(ids, skip_special_tokens=False).encode())
    assert got == want


# byte-level BPE by recursive queries ---------------------------------------

def test_recursive_merges_agree(docs, monkeypatch):
    import tiktoken

    from pagecut.llm import op02_bpe as op02
    from pagecut.llm.queries import ENCODING
    plain, rng = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=op02.read_ranks(ENCODING), special_tokens={}), random.Random(12)
    got = Counter((r.id, tuple(r.ids), bytes(r.decoded)) for r in op02.bpe_round_trip(docs, ENCODING, P.PATTERN).collect())
    assert got == Counter((i, tuple(plain.encode_ordinary(t or "")), (t or "").encode()) for i, t in TEXTS)
    monkeypatch.setattr(op02, "QUERY_BYTES", 3000)
    monkeypatch.setattr(op02, "DECODE_IDS", 50)
    codec = op02.Codec(ENCODING)
    word = lambda: "".join(rng.choice("abcdeé漢'.,") for _ in range(rng.choice([1, 4, 30, 130, 399, 401, 900])))
    words = [word() for _ in range(200)]
    size, ids = codec.encode([w.encode() for w in words])
    ranks = [plain._core_bpe.encode_single_piece(w.encode()) for w in words]
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == ranks
    assert codec.decode(size, ids) == [w.encode() for w in words]


@pytest.mark.parametrize("run", [lambda d: op11.align(d, COUNTING, PIECES, P.PATTERN), lambda d: op13.bpe_round_trip(d, COUNTING, P.PATTERN)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
