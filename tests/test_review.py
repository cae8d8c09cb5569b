"""Review operators and item functions: every query against its SQL, and the rules on small cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loomspan.functions import items as I
from loomspan.operators import review as V
from loomspan.plans import review_queries as Q


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"create view {name[:-8]} as select * from read_parquet('{small}/{name}')")
    return con


def rows(data):
    return sorted(tuple(str(x) for x in r) for r in data)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, small, duck, name):
    frame = Q.QUERIES[name](spark, small)
    found = duck.execute(Q.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(frame.columns)
    got = rows(frame.select(*names).collect())
    assert got == rows(found.fetchall()) and got


def each(spark, data, *columns):
    found = spark.createDataFrame([(i, x) for i, x in enumerate(data)], "i int, c string").select("i", *columns).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in found]


def test_item_names(spark):
    c = F.col("c")
    given = ["1. pH值 GB/T 7573", "甲醛含量(mg/kg) ≤75", "耐摩擦色牢度（级）--干摩", "Brand要求 3", "12、缝子纰裂—", "●", None, "", "铅 < 90", "A/-/-B"]
    assert each(spark, given, I.item_name(c, ["Brand"])) == ["pH值", "甲醛含量", "耐摩擦色牢度-干摩", "", "缝子纰裂", "", "", "", "铅", "A/-B"]
    assert each(spark, ["3) 沾色", "—", "棉布 ISO 105", None], I.item_part(c)) == ["沾色", "", "棉布", ""]
    assert each(spark, ["变色", "沾色（棉）", "沾色 x", "聚酯纤维", "羊毛", "毛羽", "", None], I.sub_item(c)) == [True, True, False, True, True, False, False, False]
    assert [tuple(x) for x in each(spark, ["断裂强力(N)", "克重 (g/m²)", "面料（里布）", None], I.trailing_unit(c))] == [("断裂强力", "N"), ("克重", "g/m²"), ("面料(里布)", ""), ("", "")]


def test_item_details_and_limits(spark):
    c = F.col("c")
    assert each(spark, ["甲醛（面料）(mg/kg)[袖 口]（面料）(其他)", "x(n)", None], I.item_detail(c)) == ["面料；袖口", "", ""]
    assert each(spark, [" 变色 4  沾色 3-4 ", None], I.result_detail(c)) == ["变色\n4\n沾色\n3-4", ""]
    assert each(spark, ["检出限：5 mg/kg；LOQ=0.5％, lod 5mg/kg", "无", None], I.detection_limits(c, c)) == ["5mg/kg\n0.5%", "", ""]
    assert each(spark, ["耐溼摩擦性能测试", "Brand甲醛含量"], I.grouping_form(c, ["Brand"])) == ["耐湿摩擦", "甲醛"]
    assert each(spark, ["檢", "检", None], I.needs_review(c)) == [True, False, False]
    assert each(spark, [" 有 ", "无", None], I.international(c, F.lit(None).cast("string"))) == ["是", "否", "否"]


def test_fill_gaps_prefers_the_first_cache(spark):
    cache = lambda *r: spark.createDataFrame(list(r), "u string, p string, at int")
    caches = [cache(("a", "old", 1), ("a", "new", 2), ("b", None, 3), (None, "x", 4)), cache(("a", "z", 1), ("b", "first", 1), ("b", "second", 2)), cache(("c", "only", 1))]
    assert sorted(tuple(r) for r in V.fill_gaps(caches, "u", F.col("p").isNotNull(), ["at"]).collect()) == [("a", "new", 2), ("b", "first", 1), ("c", "only", 1)]
    empty = cache(("a", None, 1)).filter("false")
    assert V.fill_gaps([empty, empty], "u", F.lit(True), ["at"]).count() == 0


def test_judgements(spark):
    data = [("x", "s", "同意", ""), ("x", "s", "同意", "own"), ("x", "s", "排除", "own"), ("x", "s", "不同意", ""), ("x", "s", "拆分", "own"), ("x", "s", " free ", None), ("x", "s", None, None), (" ", "s", "同意", "")]
    sheet = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, candidate string, suggested string, judgement string, confirm string")
    got = {r.i: (r.state, r.unified) for r in V.judged(sheet).collect()}
    assert got == {0: ("confirmed", "s"), 1: ("confirmed", "own"), 2: ("excluded", None), 4: ("confirmed", "own"), 5: ("confirmed", "free"), 6: ("blank", None)}


def test_confirmed_rules(spark):
    data = [("u", "b", 5, "r2", "e1"), ("u", "a", 5, "r1", "e2"), ("u", "c", 9, None, "e3"), ("u", "a", None, "r1", "e4"), ("v", "z", 1, "", "e5")]
    got = {r.unified: tuple(r)[1:] for r in V.confirmed_rules(spark.createDataFrame(data, "unified string, candidate string, n int, reason string, example string")).collect()}
    assert got == {"u": ("c、a、b", "r1；r2", "e3<br>e2<br>e1"), "v": ("z", V.DEFAULT_REASON, "e5")}


def test_rule_position(spark):
    assert each(spark, ["b", "a", "other", None], V.rule_position(F.col("c"), ["a", "b"])) == [2, 1, 3, 3]
