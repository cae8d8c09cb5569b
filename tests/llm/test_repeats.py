"""Repeated sentences and repeated strings against plain counting."""

import hashlib
import random
import re
from collections import Counter

import pytest

from loomspan.llm import runlength, spans
from tests.llm.helpers import none, odd, odd_rows, prose


def sentences_of(text):
    """(start, end, words) of every piece of a text up to a mark of an end before white space, or a line's end; written without the module."""
    out, a = [], 0
    for m in re.finditer(r"[.!?]+[\"')\]]*\s+|\n\s*", text):
        out.append((a, m.end()))
        a = m.end()
    if a < len(text) or not out:
        out.append((a, len(text)))
    return [(x, y, text[x:y].lower().split()) for x, y in out]


def runs_of(text):
    """Runs of sentences that count, as (first, last, words): from each sentence on, and back from each where no other run ends."""
    full = [(i, w) for i, (_, _, w) in enumerate(sentences_of(text)) if w]
    counts = lambda k, n: k >= 3 and n >= 20 or k >= 2 and n >= 30
    runs = set()
    for i in range(len(full)):
        j = next((j for j in range(i + 1, len(full) + 1) if counts(j - i, sum(len(w) for _, w in full[i:j]))), None)
        if j:
            runs.add((i, j))
    ends = {j for _, j in runs}
    for j in range(1, len(full) + 1):
        i = next((i for i in range(j - 1, -1, -1) if counts(j - i, sum(len(w) for _, w in full[i:j]))), None)
        if i is not None and j not in ends:
            runs.add((i, j))
    return [(full[i][0], full[j - 1][0], tuple(x for _, w in full[i:j] for x in w)) for i, j in runs]


def spans_brute(rows):
    """Removed sentences of each row: those under a run whose words came before, by id and place."""
    first = {}
    for i, t in rows:
        for a, _, words in runs_of(t or ""):
            first[words] = min(first.get(words, (i, a)), (i, a))
    return [(i, {x for a, b, words in runs_of(t or "") if (i, a) > first[words] for x in range(a, b + 1)}) for i, t in rows]


def test_one_long_sentence_is_no_span(spark):
    long_ = " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(45)) + "."
    rows = [(i, f"{prose(700 + i, 6)} {long_}") for i in range(4)] + [(9, f"{long_} {long_}"), (10, f"{long_} {long_}")]
    got = {r.doc_id: r.n_removed for r in spans.remove_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 9: 0, 10: 2}
    assert spans.spans(long_) == [] and spans.spans("a b c.\n" + long_)[0][:2] == (0, 1)


@pytest.mark.parametrize("seed", range(2))
def test_spans_equal_plain_form(spark, seed):
    rng = random.Random(seed)
    sentence = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 18))).capitalize() + rng.choice([". ", "! ", "?\n", "\n\n", ".) ", " "])
    pool = [[sentence() for _ in range(rng.randint(1, 6))] for _ in range(12)]
    cut = lambda p: p[rng.randint(0, 1) : len(p) - rng.randint(0, 1)]
    text = lambda: "".join("".join(cut(rng.choice(pool))) if rng.random() < 0.4 else sentence() for _ in range(rng.randint(0, 8)))
    rows = [(i, text()) for i in range(150)] + [(200, None), (201, ""), (202, " \n ")]
    got = {r.doc_id: r for r in spans.remove_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    removed = 0
    for (i, lost), (_, t) in zip(spans_brute(rows), rows, strict=True):
        kept = None if t is None else "".join(t[a:b] for k, (a, b, _) in enumerate(sentences_of(t)) if k not in lost)
        assert got[i].text == kept and got[i].n_removed == len(lost), i
        removed += len(lost)
    assert removed > 60


def test_sentence_spans(spark):
    passages = [prose(40 + i, 60) for i in range(4)]
    rng = random.Random(8)
    rows = [(i, " ".join(x for x in (prose(200 + i, 50), rng.choice(passages) if i % 3 else "", prose(900 + i, 30)) if x)) for i in range(60)]
    rows += [(100, rows[0][1]), (101, prose(1, 12)), (102, prose(1, 12))]
    got = {r.doc_id: r for r in spans.remove_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, lost), (_, text) in zip(spans_brute(rows), rows, strict=True):
        ends = spans.sentence_ends(text)
        assert got[i].text == "".join(text[a:b] for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) if k not in lost)
        assert got[i].n_removed == len(lost)
    assert got[100].n_removed == got[100].n_sentences and got[0].n_removed == 0
    seen = [i for i, t in rows if passages[0] in t]
    assert all(passages[0] not in got[i].text for i in seen[1:]) and passages[0] in got[seen[0]].text


def test_spans_cover_every_sentence_of_a_passage():
    for seed in range(30):
        passage = prose(seed, 70)
        inside = spans.spans(passage)
        assert {i for a, b, *_ in inside for i in range(a, b + 1)} == set(range(len([x for x in spans.sentence_ends(passage)])))


def test_spans_odd_rows(spark):
    rows = spans.remove_spans(odd(spark)).collect()
    assert len(rows) == len(odd_rows())
    by = {r.doc_id: r for r in rows}
    assert by[2].n_removed == by[2].n_sentences > 0 and by[0].n_removed == 0 and by[3].text is None and by[3].n_sentences == 0
    assert [r.n_removed for r in rows if r.doc_id == 9] == [0, 0]
    assert [r.n_removed == r.n_sentences for r in rows if r.doc_id is None and r.text is not None] == [True]
    assert spans.remove_spans(none(spark)).count() == 0


@pytest.mark.parametrize("length", [3, 5, 9])
def test_index_finds_all_repeats(length):
    rng = random.Random(length)
    for trial in range(60):
        texts = [bytes(rng.choice(b"ab" if trial % 2 else b"abcdef") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 6))]
        seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        expected = [{i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1} for t in texts]
        got = runlength.RunLengthIndex(texts).repeats(length)
        assert [{i for a, b in r for i in range(a, b + 1)} for r in got] == expected


def repeats_brute(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        n = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((str(i), len(t), sum(gone), n, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def result(frame):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


@pytest.mark.parametrize("crowd", [4096, 3])
def test_repeats_are_exact(spark, monkeypatch, crowd):
    monkeypatch.setattr(runlength, "CROWD", crowd)  # 3: frequent passages are split down to whole windows
    passage, shorter = prose(1, 100), prose(2, 55)
    rng = random.Random(6)
    rows = [(i, prose(100 + i, 60) + rng.choice([passage, shorter, passage[:405], passage[100:]]) + prose(500 + i, 50)) for i in range(40)]
    rows += [(50, rows[3][1]), (51, "ab" * 400), (52, "a" * 401), (53, "a" * 400), (54, rows[4][1][:399]), (55, "é" * 300), (56, prose(7, 30) * 4)]
    assert result(runlength.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == repeats_brute(rows)


def test_repeats_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(runlength, "CHUNK", 5000)  # the long text in several parts
    rows = [r[:2] for r in odd_rows()]
    assert result(runlength.remove_repeats(odd(spark))) == repeats_brute(rows)
    assert runlength.remove_repeats(none(spark)).count() == 0


def test_index_of_a_periodic_text_stays_small():
    import tracemalloc

    tracemalloc.start()
    found = runlength.RunLengthIndex([b"abcdefghij" * 200_000]).repeats(400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [[(0, 1_999_600)]] and peak < 100e6, peak
