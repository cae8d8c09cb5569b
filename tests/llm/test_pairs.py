"""Joins and searches on pairs: components, n-gram Jaccard join, KD-tree search, fuzzy lines."""

import random

import numpy as np
import pytest
import xxhash

from loomspan.llm import jaccard, lines, topk
from loomspan.llm.components import components
from loomspan.llm.scratch import Scratch
from tests.llm.helpers import none, odd, odd_rows, prose, union_find, words


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 90)]
    expected = union_find({x for e in links for x in e}, links)
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {i: r for i, r in expected.items() if any(i in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def shingles(text):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_brute(rows):
    named = [(i, shingles(t)) for i, t in rows if i is not None and shingles(t)]
    links = [(a, b) for x, (a, s) in enumerate(named) for b, t in named[:x] if 100 * len(s & t) >= 80 * len(s | t)]
    root = union_find({i for i, _ in rows if i is not None}, links)
    return sorted((str(i), len(shingles(t)), str(root.get(i))) for i, t in rows)


def variants(seed, n, edits):
    rng, base = random.Random(seed), prose(seed, 120).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = "q%d" % rng.randrange(10**6)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small_blocks", [False, True])
def test_jaccard_is_exact(spark, monkeypatch, small_blocks):
    if small_blocks:  # many frequent shingles, and tiles in a grid of blocks
        monkeypatch.setattr(jaccard, "FREQUENT", 3)
        monkeypatch.setattr(jaccard, "BLOCK", 7)
    passage = prose(77, 70)
    texts = variants(1, 40, 6) + variants(2, 30, 3) + [prose(100 + i, 40) + " " + passage for i in range(30)] + [prose(300 + i, 6) for i in range(10)] + ["a B c", "A b C", "a b", ""]
    rows = list(enumerate(texts)) + [(500, texts[0]), (501, None)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == jaccard_brute(rows)


def test_jaccard_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.jaccard_components(odd(spark)).collect())
    assert got == jaccard_brute(rows)
    assert jaccard.jaccard_components(none(spark)).count() == 0


def test_tree_and_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in rng.integers(-3, 4, (400, 6)) / 256]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000, None), (1001, [None] * 6), (1050, [float("nan")] * 6), (None, vectors[0]), (1100, [0.5, 0.25]), (1150, [0.5, 0.25]), (1101, [1.0, 1.0]), (0, vectors[0]), (1102, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(table, shard_rows=64).collect()}
    clean = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            clean[i] = [int(np.floor(256 * x)) for x in v]
    expected = {}
    for q in clean:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(clean[q], v, strict=True)), i) for i, v in clean.items() if i != q and len(v) == len(clean[q]))
            expected |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scored[:5])}
    assert got == expected
    assert topk.top_k(table.limit(0)).count() == 0


def test_top_k_of_odd_vectors(spark, monkeypatch):
    """Vectors beyond the integers take no part; columns of names that the operator makes fall away; queries in several blocks give the same."""
    rng = random.Random(12)
    rows = [(i, [float(rng.randint(-9, 9)) for _ in range(4)], "v", 1, 2.0, 3) for i in range(300)] + [(1000, [1e300, 1.0, 1.0, 1.0], "v", 1, 2.0, 3), (1050, [1e9, 0.0, 0.0, 0.0], "v", 1, 2.0, 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, shard int, score double, rank int")
    plain = {tuple(r) for r in topk.top_k(table).collect()}
    assert {q for q, *_ in plain} == {0, 50, 100, 150, 200, 250} and not {i for _, _, i, _ in plain} & {1000, 1050}
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    assert {tuple(r) for r in topk.top_k(table, shard_rows=40).collect()} == plain


def py_simhash(ws):
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in ws]
    return sum(1 << b for b in range(63) if 2 * sum(x >> b & 1 for x in h) > len(h))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def lines_brute(rows):
    import re

    def norm(line):
        return re.sub(r"[^a-z]+", " ", line.lower()).strip()

    places = [(i, p, norm(x)) for i, t in rows if t is not None for p, x in enumerate(t.split("\n"))]
    places = [(i, p, x) for i, p, x in places if len(x.split()) >= 3]
    names = sorted({x for _, _, x in places})
    sims = {x: py_simhash(x.split()) for x in names}
    links = []
    for a in range(len(names)):
        for b in range(a):
            x, y = names[a], names[b]
            if min(len(x.split()), len(y.split())) >= 5 and bin(sims[x] ^ sims[y]).count("1") <= 3 and distance(x, y) <= 0.1 * max(len(x), len(y)) + 1e-9:
                links.append((a, b))
    root = union_find(range(len(names)), links)
    number = {x: root[i] for i, x in enumerate(names)}
    first = {}
    for i, p, x in places:
        first[number[x]] = min(first.get(number[x], (i, p)), (i, p))
    gone = {}
    for i, p, x in places:
        if (i, p) != first[number[x]]:
            gone.setdefault(i, set()).add(p)
    return {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get(i, ())) for i, t in rows}, links


def test_fuzzy_lines(spark):
    rng = random.Random(4)
    base = [prose(600 + i, 60) for i in range(6)]

    def edited(line):
        w = line.split()
        at = rng.randrange(len(w))
        w[at] = w[at][:-1] + rng.choice("xyz") if rng.random() < 0.7 else w[at]
        return " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)

    rows = [(i, "\n".join([edited(rng.choice(base)), prose(i + 5000, 8), "Page %d of the book" % i, "ab cd"])) for i in range(70)] + [(900, None), (901, ""), (902, "\n\n")]
    expected, links = lines_brute(rows)
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert links and got == expected


def test_simhash_of_long_lines(spark):
    from pyspark.sql import functions as F

    texts = [prose(i, n) for i, n in enumerate((1, 2, 60, 255, 256, 700))]
    got = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("k", F.xxhash64("t"))
    sims = {r.k: r.sim for r in lines.simhashes(got.select("k", F.size(F.split("t", " ")).alias("n"), F.col("t").alias("norm"))).collect()}
    assert all(sims[r.k] == py_simhash(r.t.split(" ")) for r in got.collect())


def test_edit_distance_of_long_lines(spark):
    rng, rows = random.Random(5), []
    for i in range(60):
        a = prose(i, rng.choice((3, 120, 300))).split(" ")
        b = list(a)
        for _ in range(rng.choice((0, 1, 3, 20))):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice((0, 1, 1))] = [] if rng.random() < 0.3 and len(b) > 2 else ["new" + str(at)]
        rows.append((i, i, " ".join(a), " ".join(b), rng.choice((0, 1, 5, 30, 150))))
    pairs = spark.createDataFrame(rows, "a long, b long, norm_a string, norm_b string, most int")
    plain = {r.a: r.close for r in pairs.selectExpr("a", "levenshtein(norm_a, norm_b) <= most as close").collect()}
    got = {r.a: r.close for r in lines._judged(pairs).collect()}
    assert got == plain and len(set(got.values())) == 2


def test_a_pair_is_read_once(spark, capsys):
    """Nothing but the bounded distance, which gives unlike lines up early, runs over a short pair's texts; no function is interpreted piece by piece."""
    pairs = spark.createDataFrame([(1, 2, "abcd " * 20, "abcd " * 19 + "abce ", 10), (1, 3, "abcd " * 20, "efgh " * 20, 10)], "a long, b long, norm_a string, norm_b string, most int")
    judged = lines._judged(pairs)
    judged.explain()
    plan = capsys.readouterr().out
    assert "levenshtein" in plan and "regexp_extract_all" not in plan and plan.count("levenshtein(norm_a") == 1
    assert {r.b: r.close for r in judged.collect()} == {2: True, 3: False}


def test_fuzzy_lines_odd_rows(spark):
    rows = lines.dedup_lines(odd(spark)).collect()
    assert len(rows) == len(odd_rows())
    by = {r.doc_id: r for r in rows}
    assert by[2].n_removed == 1 and by[0].n_removed == 0 and by[3].text is None and by[6].n_removed == 0
    assert [r.n_removed for r in rows if r.doc_id == 9] == [0, 0]
    assert set(odd(spark).columns) <= set(rows[0].asDict())
    assert lines.dedup_lines(none(spark)).count() == 0


def test_short_lines_with_typos(spark):
    """Of pairs that differ by single letters, at most as many as the similarity allows, all but a tenth are found."""
    rng, rows, wanted = random.Random(8), [], {}
    for n in (6, 8, 10, 15, 20):
        for i in range(100):
            line = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 8))) for _ in range(n))
            most = int(0.1 * len(line) + 1e-9)
            edits = 1 if i % 2 else rng.randint(1, most)
            other = list(line)
            for _ in range(edits):
                at = rng.randrange(len(other))
                other[at : at + 1] = rng.choice(("", "q", "q" + other[at]))
            other = " ".join("".join(other).split())
            if other != line and distance(line, other) <= 0.1 * max(len(line), len(other)) + 1e-9:
                wanted[len(rows) + 1] = (n, i % 2)
                rows += [(len(rows), line), (len(rows) + 1, other)]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), by_words=True).collect()}
    assert not any(got[i] for i in got if i not in wanted)
    share = {kind: [got[i] for i in wanted if wanted[i] == kind] for kind in set(wanted.values())}
    print({k: (sum(v), len(v)) for k, v in sorted(share.items())})
    assert all(sum(v) >= 0.9 * len(v) for v in share.values()), {k: (sum(v), len(v)) for k, v in sorted(share.items())}


def _changed(rng, line, share):
    """A line with one letter changed, or with that share of its letters."""
    at = [i for i, c in enumerate(line) if c != " "]
    other = list(line)
    for i in rng.sample(at, max(1, int(share * len(at)))):
        other[i] = rng.choice("qvwxz")
    return "".join(other)


def test_long_lines_with_typos(spark):
    """The same by length and share of changed letters; whatever is within the similarity, most is found."""
    rng, rows, wanted = random.Random(9), [], {}
    for n in (25, 30, 60, 100):
        for share in (0, 0.02, 0.05, 0.09):
            for _ in range(50):
                line = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice((2, 3, 3, 4, 4, 5, 5, 6, 7, 8)))) for _ in range(n))
                wanted[len(rows) + 1] = (n, share)
                rows += [(len(rows), line), (len(rows) + 1, _changed(rng, line, share))]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), by_words=True).collect()}
    assert not any(got[i] for i in got if i not in wanted)
    share = {kind: sum(got[i] for i in wanted if wanted[i] == kind) for kind in set(wanted.values())}
    print(sorted(share.items()))
    assert all(n >= 45 for n in share.values()), sorted(share.items())


def test_crowded_keys(spark, monkeypatch):
    """Unlike lines around one phrase, with pairs that differ in scattered letters among them: found though the phrase's keys are crowded."""
    monkeypatch.setattr(lines, "CROWD", 4)
    rng, rows, wanted = random.Random(10), [], set()
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice((3, 4, 5, 6, 7))))
    for i in range(120):
        line = " ".join([word() for _ in range(15)] + ["wonderful", "phrases", "everywhere", "repeated"] + [word() for _ in range(15)])
        rows.append((len(rows), line))
        if i % 3 == 0:
            wanted.add(len(rows))
            rows.append((len(rows), _changed(rng, line, 0.06)))
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), by_words=True).collect()}
    assert not any(got[i] for i in got if i not in wanted)
    assert sum(got[i] for i in wanted) >= 0.9 * len(wanted)


def test_crowds_lose_no_line(spark, monkeypatch):
    """Pairs that share no key but those of a phrase that all lines hold, with one letter changed in every word of their own: each is found."""
    monkeypatch.setattr(lines, "CROWD", 4)
    rng, rows, wanted = random.Random(12), [], set()
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    phrase = [word() for _ in range(40)]
    for _ in range(40):
        own = [word() for _ in range(20)]
        wanted.add(len(rows) + 1)
        rows += [(len(rows), " ".join(own + phrase)), (len(rows) + 1, " ".join([w[:2] + rng.choice("qvwxz") + w[3:] for w in own] + phrase))]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), by_words=True).collect()}
    assert {i for i in got if got[i]} == wanted


def test_letters_bound_the_distance(spark):
    from pyspark.sql import functions as F

    rng, rows = random.Random(11), []
    for _ in range(300):
        a = "".join(rng.choice("etaoinsrhldcumxyz ") for _ in range(rng.choice((0, 3, 40, 700))))
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(("", "e", "te", "z"))
        rows.append((a, "".join(b) if rng.random() < 0.8 else "e" * rng.randint(0, 900)))
    df = spark.createDataFrame(rows, "a string, b string")
    x, y = lines.letter_counts(F.col("a")), lines.letter_counts(F.col("b"))
    d = F.levenshtein("a", "b")
    got = df.select(lines._letters_near(x, y, d).alias("at"), lines._letters_near(x, y, d - 1).alias("below"), "a", "b").collect()
    assert all(r["at"] for r in got)
    plain = [max(sum(max(0, min(r.a.count(c), 255) - min(r.b.count(c), 255)) for c in lines.COUNTED), sum(max(0, min(r.b.count(c), 255) - min(r.a.count(c), 255)) for c in lines.COUNTED)) for r in got]
    far = df.select(*[lines._letters_near(x, y, F.lit(k)).alias(f"n{k}") for k in (0, 1, 5, 30)]).collect()
    assert [tuple(r) for r in far] == [tuple(p <= k for k in (0, 1, 5, 30)) for p in plain]


def test_pairs_are_verified_in_rounds(spark, monkeypatch):
    """However many pairs there are, the texts of a round hold about the letters of all lines; the same pairs are found as in one round."""
    from pyspark.sql import functions as F

    base = prose(5, 30).lower().replace(".", "")
    texts = [base[:i] + "z" + base[i + 1 :] for i in range(5)] + [prose(900 + i, 30).lower().replace(".", "") for i in range(3)]
    table = spark.createDataFrame(list(enumerate(texts)), "k long, norm string")
    pairs = spark.createDataFrame([(a, b) for b in range(8) for a in range(b)], "a long, b long")

    class Watched(Scratch):
        def table(self, df):
            out = super().table(df)
            if "norm_a" in out.columns:
                held.append(out.agg(F.sum(F.length("norm_a") + F.length("norm_b"))).first()[0] or 0)
            return out

    found = []
    for least in (1 << 40, 100):
        monkeypatch.setattr(lines, "ROUND_LETTERS", least)
        held = []
        found.append(sorted(tuple(r) for r in lines.verified(pairs, table, Watched(spark, "t"), 0.9).collect()))
        rounds = held
    whole = sum(map(len, texts))
    assert found[0] == found[1] and {(a, b) for b in range(5) for a in range(b)} <= set(found[0])
    assert len(rounds) > 1 and max(rounds) < 3 * whole < sum(rounds)


def test_lines_with_a_phrase_elsewhere_are_not_verified(spark, monkeypatch):
    """Unlike lines of one length that share a phrase at different places can't be similar by it: no text of such pairs is compared; copies with typos are found."""
    rng, rows, wanted = random.Random(13), [], set()
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    phrase = [word() for _ in range(8)]
    for i in range(40):
        own = [word() for _ in range(24)]
        line = " ".join(phrase + own if i % 2 else own + phrase)
        rows.append((len(rows), line))
        if i % 4 < 2:
            wanted.add(len(rows))
            rows.append((len(rows), _changed(rng, line, 0.04)))
    plain, compared = lines.verified, set()

    def watched(pairs, texts, scratch, similarity):
        texts_by = {r.k: r.norm for r in texts.select("k", "norm").collect()}
        compared.update((texts_by[r.a], texts_by[r.b]) for r in pairs.select("a", "b").collect())
        return plain(pairs, texts, scratch, similarity)

    monkeypatch.setattr(lines, "verified", watched)
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), by_words=True).collect()}
    begins = {text: i % 2 for i, text in enumerate(text for n, text in rows if n not in wanted)}
    assert {i for i in got if got[i]} == wanted
    assert compared and all(begins[a] == begins[b] for a, b in compared if a in begins and b in begins)
