"""Clustering, source divergence and piece coding against plain counterparts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from loomspan.llm import divergence, lloyd, sentencepieces
from tests.llm.helpers import none, odd, odd_rows, prose


def _lloyd(rows, k=16, dims=64, scale=64, rounds=3):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [v for _, v in first[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in set(own):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, d in last:
        inertia[j] += d
    shas = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), shas[j]) for i, j, d in last), key=repr)


def _vectors(n, seed=0):
    rng = random.Random(seed)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(64)]) for i in range(n)]
    bad = [None, [], [0.5] * 63, [0.5] * 65, [None] * 64, [float("nan")] + [0.1] * 63, [float("inf")] + [0.1] * 63, [1e300] + [0.1] * 63]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("n", [0, 1, 9, 120])
def test_lloyd_equals_plain_form(spark, n):
    """Ties, repeated rows, one id for several vectors, no id, other lengths, fewer rows than centroids."""
    rows = _vectors(n)
    rows += rows[: n // 3] + [(i, [-x for x in v]) for i, v in rows[: n // 4]] + [(None, v) for _, v in rows[:2] if n]
    rows += [(2000 + i, [0.25] * 64) for i in range(n // 2)]
    table = spark.createDataFrame([(i, v, 1, "x", 5) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string, n long").repartition(5)
    got = lloyd.report(*lloyd.lloyd(table))
    plain = [(i, v) for i, v in rows if v is None or not any(x is not None and abs(x) == 1e300 for x in v)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _lloyd(plain)


def test_lloyd_keeps_empty_centroids_and_large_ids(spark):
    rows = [((1 << 60) + i, [float(i % 2)] * 64) for i in range(40)]  # two places for 16 centroids
    got = lloyd.report(*lloyd.lloyd(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))).collect()
    assert sorted(map(tuple, got)) == _lloyd(rows)
    assert {r.vec_id for r in got} == {i for i, _ in rows}


TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _audit(rows, kept_docs, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(low))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= kept_docs]
        count = {s: Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        count[None] = Counter(t for d in own for t in d[2])
        p = {}
        for s, c in count.items():
            size = sum(c[t] for t in kept) + 5 * len(kept)
            p[s] = {t: 1 + (10**9 * (c[t] + 5)) // size for t in kept}
        for s in set(count) - {None}:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in set(count) - {None, s}]
            terms = [(p[s][t] - p[None][t], t) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (v, t) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def _docs(seed=1, n=300):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "été", "ÉTÉ", "中文", "x1y", "don't", "a-b", "GAMMA", " nbsp", "🙂", "Straße", "İ"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for _ in range(n)]
    return rows + [("en", "hot", "alpha alpha")] * 150 + [("xx", "one", "few"), ("xx", "two", None), ("yy", "one", ""), ("en", "none", "1 2 3"), ("en", "long", "alpha " * 50000)]


def test_audit_equals_plain_form(spark):
    """Nulls as empty, groups without terms, languages without kept terms, hot groups, repeated rows, ties, clashing names."""
    rows = _docs()
    docs = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "lang string, source string, text string, n long, term string, number long").repartition(7)
    got = divergence.audit(docs, 30, 7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _audit(rows, 30, 7)


def test_audit_in_small_parts(spark, monkeypatch):
    """Texts cut into many parts and buckets, sources into many blocks, give the same."""
    rows = _docs(2, 200)
    for name, value in {"PART_BYTES": 50, "COMPARE": 7, "BUCKET_ROWS": 3, "MOST_BUCKET_ROWS": 5, "BLOCK": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    # Tasks read the module anew, so what they do is also called here.
    groups, texts = np.zeros(len(rows), np.int64), __import__("pyarrow").array([r[2] for r in rows])
    terms, _, column, n, docs = divergence.matrix(texts, groups)
    low = [TERM.findall((r[2] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for r in rows]
    assert {terms[c].decode(): x for c, x in zip(column, n, strict=True)} == Counter(t for d in low for t in d)
    assert {terms[c].decode(): x for c, x in zip(column, docs, strict=True)} == Counter(t for d in low for t in set(d))
    got = divergence.audit(spark.createDataFrame(rows, "lang string, source string, text string"), 5, 50)
    assert sorted(map(tuple, got.collect())) == _audit(rows, 5, 50)


def test_terms_that_share_a_hash_are_told_apart():
    import pyarrow as pa

    texts = pa.array(["ab cd ab", None, "", "xyz cd", "q"])
    held = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    bounds = np.frombuffer(held.buffers()[1], np.int64)
    data = np.frombuffer(held.buffers()[2], np.uint8)
    letters, starts, ends = divergence.boundaries(data, bounds)
    for digest in (None, lambda b: 7, len):
        terms, number = divergence.grouped(letters, starts, ends, digest)
        assert [terms[i] for i in number] == [b"ab", b"cd", b"ab", b"xyz", b"cd", b"q"]
        assert len(set(terms)) == len(terms)


def test_shares_are_exact():
    count, size = np.array([0, 1, 10**12, 3 * 10**14]), np.array([5, 10**15, 10**13 + 7, 10**15 - 1])
    assert divergence.shares(count, size).tolist() == [1 + 10**9 * (c + 5) // s for c, s in zip(count.tolist(), size.tolist(), strict=True)]


def test_audit_takes_odd_and_no_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in odd_rows()]
    assert sorted(map(tuple, divergence.audit(odd(spark), 2, 50).collect())) == _audit(rows, 2, 50)
    assert divergence.audit(none(spark)).count() == 0


def _library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=sentencepieces.default_model())


def _strange(n=3000):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "中文", "🙂", "\x00", "́", "<s>", "</s>", "<unk>", "<0x41>", "the ", " ing", "\r\n", "﷽", "ﬁ", " ", "　", "hello"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(n)]


def test_pieces_equal_the_library(spark):
    texts = [*_strange(), None, "", " ", "▁", "x" * 300_000, prose(4, 40_000), "word " * 50_000, " " * 1000]
    library = _library()
    rows = [(i, t, "ids", 1) for i, t in enumerate(texts)] + [(None, "null id", "ids", 1), (5, texts[5], "ids", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in sentencepieces.round_trip(docs).collect())
    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode(t or "")
        want[(i, tuple(ids), library.decode(ids))] += 1
    assert got == want
    coded = sentencepieces.encode(docs.filter("doc_id < 500"))
    assert {(r.doc_id, r.decoded) for r in sentencepieces.decode(coded).collect()} == {(i, d) for i, _, d in want if i is not None and i < 500}


def test_small_tables_and_whole_texts_give_the_same():
    texts, library = _strange(500), _library()
    want = library.encode(texts)
    for own in (sentencepieces.Coder(sentencepieces.default_model(), 5, 10**9), sentencepieces.Coder(sentencepieces.default_model(), 10**9, 40)):
        assert own.apart
        for apart in (True, False):
            own.apart = apart
            for a in range(0, 500, 50):
                ids, starts = own.encode(texts[a : a + 50])
                assert [ids[x:y].tolist() for x, y in zip(starts, starts[1:], strict=False)] == want[a : a + 50]


def test_piece_query(spark, small):
    library = _library()
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in sentencepieces.op13_sentencepieces(spark, small).collect()}
    want = set()
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == want
    empty = sentencepieces.digests(sentencepieces.round_trip(none(spark)))
    assert empty.count() == 0 and sentencepieces.digests(sentencepieces.round_trip(odd(spark))).count() == len(odd_rows())
