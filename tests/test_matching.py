"""Source relationships, nearest rows, fragments, choices that exclude each other: against plain forms."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import clusters
from loomspan.operators import matching as M
from loomspan.operators.relational import relationship_id

FIELDS = "id string, url string, sku string, sheet string, `row` int, cell string, sample_type string"


def _plain_source(row, sources, made):
    """The cascade for one row: (resolution, id)."""
    text = lambda v: " ".join(str(v if v is not None else "").split())
    ids = {text(s["id"]) for s in sources if text(s["id"])}
    if text(row["id"]) and text(row["id"]) not in ids:
        return "unknown_id", None
    own = text(row["id"]) or made
    if own in ids:
        return "id", own
    of_url = [s for s in sources if text(s["url"]) and text(s["url"]) == text(row["url"])]
    found = [s for s in of_url if text(s["sku"]) and text(s["sku"]) == text(row["sku"])] or of_url
    agree = [
        s for s in found
        if all(not text(row[f]) or text(row[f]) == text(s[f]) for f in M.BLANKS) and (not text(row["color"]) or not s["color"] or text(row["color"]) in s["color"])
    ]
    if len(agree) == 1:
        return "exact", agree[0]["id"]
    if len(found) == 1:
        return "sole", found[0]["id"]
    return ("ambiguous" if found else "none"), None


@pytest.mark.parametrize("seed", range(3))
def test_relationships_against_plain_form(spark, seed):
    rng = random.Random(seed)
    some = lambda *x: rng.choice([None, "", *x, *x])
    sources = [dict(id=f"s{i}", url=some("u1", "u2", "u3"), sku=some("k1", "k2"), sheet=some("A", "B"), row=rng.choice([None, 1, 2]), cell=some("J"), sample_type=some("成衣"), color=rng.choice([None, [], ["红"], ["红", "蓝"]]), order_no=f"o{i}") for i in range(14)]
    rows = [dict(id=rng.choice([None, None, "", "s1", "zz"]), url=some("u1", "u2", "u3", "u4"), sku=some("k1", "k2"), sheet=some("A", "B"), row=rng.choice([None, 1, 2]), cell=some("J"), sample_type=some("成衣"), color=some("红", "绿"), n=i) for i in range(300)]
    rows += [dict(rows[0], n=300)] * 2
    names = [*[f.split()[0].strip("`") for f in FIELDS.split(", ")], "color"]
    s = spark.createDataFrame([tuple(x[n] for n in [*names, "order_no"]) for x in sources], FIELDS + ", color array<string>, order_no string")
    r = spark.createDataFrame([tuple(x[n] for n in [*names, "n"]) for x in rows], FIELDS + ", color string, n int")
    got = M.resolve_relationships(r, s, "w").collect()
    assert len(got) == len(rows)
    by_id = {x["id"]: x for x in sources}
    seen = set()
    for g in got:
        row = rows[min(g.n, 300)]
        resolution, hit = _plain_source(row, sources, "")
        assert (g.resolution, g.resolved) == (resolution, hit), row
        seen.add(resolution)
        for f in ("sku", "sheet", "cell"):
            assert (g[f] or "") == (row[f] or (by_id[hit][f] if hit else "") or "")
    assert seen == {"unknown_id", "id", "exact", "sole", "ambiguous", "none"}


def test_own_fields_make_the_id(spark):
    made = spark.range(1).select(relationship_id(*[F.lit(x) for x in ("w", "A", "2", "J2", "u", "k", "红", "成衣")]).alias("i")).first().i
    s = spark.createDataFrame([(made, "u", "k", "A", 2, "J2", "成衣", ["红"]), ("x", "u", "k", "A", 2, "J2", "成衣", ["红"])], FIELDS + ", color array<string>")
    r = spark.createDataFrame([(None, "u", "k", "A", 2, "J2", "成衣", "红"), (None, "u", "k", "A", 2, "J2", "成衣", "蓝")], FIELDS + ", color string")
    got = {x.color: (x.resolution, x.resolved, x.id) for x in M.resolve_relationships(r, s, "w").collect()}
    assert got == {"红": ("id", made, made), "蓝": ("ambiguous", None, None)}
    assert M.resolve_relationships(r.limit(0), s).count() == 0 and {x.resolution for x in M.resolve_relationships(r, s.limit(0)).collect()} == {"none"}


@pytest.mark.parametrize("bucket", [None, 0.7, 5.0])
def test_nearest_rows_against_all_pairs(spark, bucket):
    rng = random.Random(6)
    left = [(i, rng.choice("ab") if i % 50 else None, round(rng.uniform(-9, 9) * 4) / 4 if i % 31 else None) for i in range(300)]
    right = [(rng.choice("abc"), round(rng.uniform(-9, 9) * 4) / 4, j) for j in range(40)] + [("a", None, 99)]
    got = M.nearest_rows(spark.createDataFrame(left, "i int, k string, x double"), spark.createDataFrame(right, "k string, y double, j int"), ["k"], "x", "y", ["y", "j"], ["i"], ["j"], bucket).collect()
    assert len(got) == len(left)
    for r in got:
        able = [(abs(y - r.x), -y, j, y) for k, y, j in right if k == r.k and y is not None] if r.x is not None else []
        best = min(able, key=lambda t: (round(t[0], 9), *t[1:]), default=None)
        assert (r.y, r.j) == ((best[3], best[2]) if best else (None, None)), r


def test_fragments_of_cells(spark):
    rng = random.Random(7)
    blocks = [(c, i, rng.choice([0.9, 0.88, 0.86, 0.8, 0.5, round(rng.random(), 3)]), rng.choice(["甲", "乙", "", None])) for c in "abc" for i in range(30)] + [("d", 0, None, "x")]
    got = {}
    for r in M.merged_fragments(spark.createDataFrame(blocks, "c string, i int, y double, t string"), ["c"], "y", "t", 0.028, "i").collect():
        got.setdefault(r.c, []).append((round(r.y, 9), r.text))
    for c in "abc":
        want = []
        for _, _, y, t in sorted((b for b in blocks if b[0] == c), key=lambda b: (-b[2], b[1])):
            if want and abs(want[-1][0] - y) < 0.028:
                want[-1] = ((want[-1][0] + y) / 2, want[-1][1] + (t or ""))
            else:
                want.append((y, t or ""))
        assert got[c] == [(round(y, 9), t) for y, t in want]
    assert "d" not in got


def test_labels_hold_for_the_next_result(spark):
    blocks = [("a", 0, 0.9, "棉"), ("a", 1, 0.8, "4-5"), ("a", 2, 0.7, "羊毛 3"), ("a", 3, 0.6, "（检出限"), ("a", 4, 0.5, "5）"), ("a", 5, 0.4, "2"), ("a", 6, 0.3, "腈纶"), ("b", 0, None, "（x"), ("c", 0, 0.1, None)]
    got = M.labelled_results(spark.createDataFrame(blocks, "c string, i int, y double, t string"), ["c"], "y", "t", "i").collect()
    assert sorted((r.c, -r.y, r.text, r.material) for r in got) == [("a", -0.8, "4-5", "棉"), ("a", -0.7, "3（检出限5）", "羊毛"), ("a", -0.4, "2", ""), ("b", 0.0, "（x", ""), ("c", -0.1, "", "")]


def _picks(rows, excluded):
    used, out = set(), {}
    for g in sorted({r[0] for r in rows}):
        own = sorted({(o, k) for gg, k, o in rows if gg == g})
        first = {}
        for o, k in own:
            first.setdefault(k, o)
        keys = sorted(first, key=lambda k: (first[k], k))
        free = [k for k in keys if k not in used]
        best = [k for k in free if k not in excluded]
        out[g] = ((best or free or keys)[0], bool(best))
        used.add(out[g][0])
    return out


@pytest.mark.parametrize("block", [1000, 5, 1])
def test_unique_picks_equal_the_sequence(spark, block):
    rng = random.Random(block)
    rows = [(f"g{rng.randint(0, 30):02}", f"k{rng.randint(0, 24)}", rng.randint(0, 9)) for _ in range(200)] + [(f"g{i:02}", "k1", 0) for i in range(31)]
    got = M.unique_picks(spark.createDataFrame([*rows, (None, "k", 1), ("g01", None, 1)], "g string, k string, o int"), "g", "k", "o", ["k2", "k3"], block).collect()
    assert {r.g: (r.k, r.preferred) for r in got} == _picks(rows, {"k2", "k3"}) and len(got) == len({r[0] for r in rows})


def _similar(a, b, ratio=clusters.LEAST_RATIO):
    import difflib

    return min(len(a), len(b)) >= clusters.LEAST_CONTAINED and (a in b or b in a) or difflib.SequenceMatcher(None, a, b).ratio() >= ratio


def test_similar_pairs_lose_none(spark):
    rng = random.Random(9)
    names = {"".join(rng.choice("甲乙丙丁戊己") for _ in range(rng.randint(1, 9))) for _ in range(250)} | {"耐摩擦色牢度", "耐磨擦色牢度", "耐摩擦色牢度干", "甲醛", "甲醛含量检测", "", "a"}
    got = {(r.a, r.b) for r in clusters.similar_pairs(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == {(a, b) for a in names for b in names if a < b and a and _similar(a, b)} and len(got) > 30


def test_groups_equal_the_sequence(spark):
    rng = random.Random(10)
    names = sorted({"".join(rng.choice("甲乙丙丁") for _ in range(rng.randint(2, 7))) for _ in range(200)})
    leader = {}
    for n in names:
        leader[n] = next((x for x in names if x < n and leader.get(x) == x and _similar(x, n)), n)
    got = clusters.fuzzy_groups(spark.createDataFrame([(n, 1) for n in names], "name string, n int")).collect()
    assert {r.name: r.leader for r in got} == leader


def test_sources_are_shuffled_once_by_what_rows_say(spark, capsys):
    """What is counted of the sources goes by the fields that a row says alone, and without their ids; coloured and plain sources count as before."""
    from loomspan.operators.matching import resolve_relationships

    kind = "id string, url string, sku string, sheet string, row string, cell string, sample_type string, color string"
    sources = spark.createDataFrame([("s1", "u", "k", "a", "1", "x", "t", "红"), ("s2", "u", "k", "b", "1", "x", "t", "红，蓝"), ("s3", "u", "k", "b", "2", "x", "t", ""), ("s4", "v", "", "a", "1", "x", "t", "")], kind)
    rows = [("", "u", "k", "a", "", "", "", "红"), ("", "u", "k", "b", "", "", "", "蓝"), ("", "u", "k", "a", "", "", "", "蓝"), ("", "u", "k", "a", "", "", "", ""), ("", "v", "z", "q", "", "", "", ""), ("s3", "w", "", "", "", "", "", ""), ("s9", "u", "", "", "", "", "", "")]
    told = resolve_relationships(spark.createDataFrame(rows, kind), sources)
    told.explain()
    shuffled = [line for line in capsys.readouterr().out.split("\n") if "Exchange hashpartitioning(" in line and "said" in line]
    assert shuffled and not any("sample_type" in line or "cell" in line for line in shuffled)
    got = [(r.resolution, r.resolved, r.n_candidates) for r in told.orderBy("url", "sheet", "color", "id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("exact", "s1", 3), ("ambiguous", None, 3), ("ambiguous", None, 3), ("exact", "s1", 3), ("sole", "s4", 1), ("id", "s3", 0), ("unknown_id", None, 3)]))
