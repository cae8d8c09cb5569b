"""Awkward documents and plain counterparts of what the operators compute."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, n string, doc long, tag int, root long, score string, ids string, own string, label string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n=80):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(words))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, one id for two texts, clashing names."""
    long_ = prose(99, 30000)
    texts = [(0, prose(0)), (1, prose(1)), (2, prose(0)), (3, None), (4, ""), (5, " \t\n "), (6, long_), (7, "x"), (8, "1 2 3 !!"), (None, prose(1)), (None, None), (9, prose(9)), (9, prose(9)), (10, prose(10)), (10, prose(11)), (11, "été 中文 <|endoftext|>  two  spaces\n\n")]
    rest = ("zz", "s1", "s0", None)
    return [(i, t, ["en", "fr", None][j % 3], rest[j % 4], None if j % 4 == 0 else len(t or ""), j, "n", 7, 7, 7, "s", "i", "o", "l", "r") for j, (i, t) in enumerate(texts)]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def union_find(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
