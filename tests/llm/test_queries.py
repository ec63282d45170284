"""The registered queries against brute-force versions on whole small tables."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import pyarrow.parquet as pq
import public_tokenizers as P
import pytest
import xxhash

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()


def run(spark, name):
    from pagecut.llm.queries import QUERIES
    return QUERIES[name](spark, SF_SMALL)


def brute_fingerprint(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=2):
    """{id: smallest id} for [(id, fingerprint)] by comparing all pairs."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(fps):
        for j, b in fps[:n]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in fps}


def test_op1(spark, docs):
    fps = [(d["doc_id"], brute_fingerprint(d["text"])) for d in docs]
    component = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op1_simhash").collect()}
    assert got == {i: (f"{f:016x}", component[i]) for i, f in fps}
    assert len(set(component.values())) < len(fps)


def test_op2(spark, docs):
    import hashlib

    import tiktoken

    from pagecut.llm.op02_bpe import read_ranks
    ranks = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op2_bpe").collect()}
    want = {}
    for d in docs:
        ids = e.encode_ordinary(d["text"] or "")
        want[d["doc_id"]] = len(ids), sha(",".join(map(str, ids)).encode()), sha((d["text"] or "").encode())
    assert got == want


def test_op3_separates_held_out_documents(spark):
    from pagecut.llm.queries import QUERIES
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_MID}/labels.parquet").to_pylist()}
    got = QUERIES["op3_toxicity"](spark, SF_MID).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for r in got)
    seen = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    right = Counter(seen)
    assert right[1, 1] >= 0.6 * (right[1, 1] + right[0, 1]) and right[1, 0] <= 0.05 * right[0, 0]


def test_op7(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op7_count").collect()}
    want = {}
    for d in docs:
        n = len(t.encode(d["text"] or "", add_special_tokens=False).ids)
        want[d["doc_id"]] = len((d["text"] or "").encode()), n, n > 512
    assert got == want


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    """Base spans of a text: [(start, kind number, end)]."""
    def luhn(s):
        digits = [int(c) for c in reversed(s)]
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0

    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))
                    or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def check_pii(got, texts):
    import hashlib
    names = list(PATTERNS)
    for row, text in zip(got, texts):
        base = brute_spans(text or "")
        shown = [f"{names[k]}:{a}:{z}" for a, k, z in base]
        assert row.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest(), text
        n = Counter(k for _, k, _ in base)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [n[k] for k in range(4)]
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("id:")] == shown
        for s in (s for s in spans if s.startswith("id:")):
            a, z = map(int, s.split(":")[1:])
            assert re.search("[0-9@]", text[a:z]) and not re.search(r"\s", text[a:z])
            assert all(z <= x or a >= y for x, _, y in base)


def test_op9(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op9_pii").collect()}
    check_pii([got[d["doc_id"]] for d in docs], [d["text"] for d in docs])


def brute_pipeline(docs, restored_score):
    """Rows that the stages before the mix keep, by plain Python."""
    docs = [d for d in docs if restored_score(d["text"]) < 0.3]
    best = {}
    for d in sorted(docs, key=lambda d: (-len(d["text"] or ""), d["doc_id"])):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]", "", d["text"] or ""), d)
    docs = list(best.values())
    component = brute_components([(d["doc_id"], brute_fingerprint(d["text"])) for d in docs])
    return [d for d in docs if component[d["doc_id"]] == d["doc_id"]]


def test_pipeline(spark, docs, tmp_path):
    """Every stage against brute force on its own input; the mix and the encoding on theirs."""
    import duckdb

    import corpus_pipeline as cp
    from pagecut.llm.common import store, table
    from pagecut.llm.sql import MIX_CTES

    frame, kept = table(spark, SF_SMALL, "documents"), {}
    columns = frame.columns
    for name, stage in cp.STAGES:
        frame = store(stage(spark, frame, SF_SMALL), "test")
        kept[name] = frame.toPandas()
        if name != cp.STAGES[-1][0]:
            assert frame.columns == columns
    scored = {r.doc_id: r.score for r in run(spark, "op3_toxicity").collect()}
    by_text = {d["text"]: scored[d["doc_id"]] for d in docs}
    want = brute_pipeline(docs, by_text.__getitem__)
    assert sorted(kept["SimHash near-dedup"].doc_id) == sorted(d["doc_id"] for d in want)
    con = duckdb.connect()
    con.register("docs_in", kept["SimHash near-dedup"])
    mixed = con.sql(f"WITH {MIX_CTES.replace('DOCS', 'docs_in')} SELECT doc_id, copies FROM taken").fetchall()
    assert Counter(kept["mixing sources to target weights"].doc_id) == dict(mixed)
    assert Counter(kept["byte-level BPE encoding and decoding"].doc_id) == dict(mixed)
    whole = {r.doc_id: r.ids_sha256 for r in run(spark, "op2_bpe").collect()}
    last = kept["byte-level BPE encoding and decoding"]
    assert all(whole[i] == s for i, s in zip(last.doc_id, last.ids_sha256))
