"""Every query over the driver tables against its SQL, and the operators' rules on small cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loomspan.functions import text as T
from loomspan.operators import clusters, matching
from loomspan.operators import relational as R
from loomspan.plans import relational_queries as Q
from loomspan.streaming import resume


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
    assert rows(frame.select(*names).collect()) == rows(found.fetchall())


def test_overview_plan_combines_before_the_shuffle(spark, small):
    plan = Q.QUERIES["overview_rollup"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "CartesianProduct" not in plan


def values(spark, kind, data, *columns):
    return [tuple(r) for r in spark.createDataFrame([(x,) for x in data], f"c {kind}").select(*columns).collect()]


def test_text_functions(spark):
    c = F.col("c")
    assert [x for (x,) in values(spark, "string", ["", "0", "a,b", "123", None], T.invalid_sku(c))] == [True, True, True, False, True]
    assert values(spark, "string", ["红,蓝；红", None], T.split_colours(c)) == [(["红", "蓝"],), ([T.NO_COLOUR],)]
    assert values(spark, "string", ["见 http://a/b.pdf；http://c/d.;http://a/b.pdf"], T.split_urls(c)) == [(["http://a/b.pdf", "http://c/d"],)]
    assert values(spark, "string", ["x123456789012y 1234567890123"], T.sku_tokens(c)) == [(["123456789012"],)]
    days = values(spark, "string", ["2026.06.12", "2026-02-31", "2024年2月29", "none"], T.calendar_date(c))
    assert [str(x) for (x,) in days] == ["2026-06-12", "None", "2024-02-29", "None"]
    assert values(spark, "string", ["苯 71-43-2, 2026-06-1 137-17-7"], T.cas_numbers(c)) == [(["71-43-2", "137-17-7"],)]
    assert [x for (x,) in values(spark, "string", ["不通过", "未通过", "符合", "不 合格", "-"], T.result_verdict(c))] == ["不合格", "不合格", "合格", "不合格", "-"]
    assert [x for (x,) in values(spark, "string", ["16.3", "见附表1", "N.D.", "不考核", "≥15"], T.concrete_result(c))] == [True, False, True, False, True]
    assert [x for (x,) in values(spark, "int", [1, 26, 27, 52, 53], T.column_letter(c))] == ["A", "Z", "AA", "AZ", "BA"]
    assert values(spark, "string", ["●ｐＨ值：", "檢測"], T.item_text(c)) == [("pH值",), ("检测",)]
    assert [x for (x,) in values(spark, "string", ["是", "YES", "0", None], T.truthy(c))] == [True, True, False, None]
    assert [x for (x,) in values(spark, "string", ["http://h/a%20b/R1.pdf?x=1"], T.url_stem(c))] == ["R1"]


def test_relationship_ids_tell_fields_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("a ", " b"), (None, "ab")], "x string, y string")
    ids = [r.i for r in df.select(R.relationship_id(F.col("x"), F.col("y")).alias("i")).collect()]
    assert ids[0] == ids[2] and len(set(ids)) == 3 and all(len(i) == 24 for i in ids)


DETAIL = "report string, method string, requirement string, result string, verdict string"


def test_prefer_detail(spark):
    data = [("r1", "", "", "", "合格"), ("r1", "GB 1", "≥15.5", "16.3", "合格"), ("r2", "", "", "", "合格"), ("r1", "GB 1", "", "见附表1", "合格"), ("r1", "", "", "不考核", "合格"), ("r1", "GB 2", "", "", "合格")]
    df = spark.createDataFrame(data, DETAIL)
    concrete = T.concrete_result(F.col("result"))
    detailed = concrete & ((F.col("method") != "") | (F.col("requirement") != ""))
    kept = R.prefer_detail(df, ["report"], concrete, detailed, F.col("method"), F.col("verdict"), F.col("result").rlike("不考核"))
    assert rows(kept.collect()) == rows([data[i] for i in (1, 2, 4, 5)])
    assert rows(R.prefer_detail(kept, ["report"], concrete, detailed, F.col("method"), F.col("verdict"), F.col("result").rlike("不考核")).collect()) == rows(kept.collect())


def test_keep_first_is_stable_and_idempotent(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), ("b", 1, None)], "k string, o int, v string")
    once = R.keep_first(df, ["k"], ["o"])
    assert rows(once.collect()) == rows([("a", 1, "y"), (None, 3, "z"), ("b", 1, None)]) == rows(R.keep_first(once, ["k"], ["o"]).collect())


def test_resume_states(spark):
    c = spark.createDataFrame([(False, False, 3), (False, False, 0), (False, True, 2), (False, True, 0), (True, False, 0)], "m boolean, f boolean, n int")
    got = [r.s for r in c.select(resume.attempt_status(F.col("m"), F.col("f"), F.col("n")).alias("s")).collect()]
    assert got == ["succeeded", "partial", "partial", "retryable_failed", "retryable_failed"]
    work = spark.createDataFrame([("a", "v1"), ("b", "v2"), ("c", "v1"), ("d", "v1"), ("e", "v1")], "url string, version string")
    state = spark.createDataFrame([("a", "v1", "succeeded"), ("b", "v1", "succeeded"), ("c", "v1", "partial"), ("d", "v1", "permanent_failed")], "url string, version string, status string")
    assert rows(resume.pending(work, state, "url", ["version"]).collect()) == rows([("b", "v2", "changed"), ("e", "v1", "new")])
    assert rows(resume.pending(work, state, "url", ["version"], True).collect()) == rows([("b", "v2", "changed"), ("c", "v1", "retry"), ("e", "v1", "new")])


def test_keep_best(spark):
    kind = "url string, version string, status string, n_rows int"
    old = spark.createDataFrame([("a", "1", "succeeded", 5), ("b", "1", "partial", 9), ("c", "1", "partial", 2), ("d", "0", "succeeded", 9)], kind)
    new = spark.createDataFrame([("a", "1", "partial", 9), ("b", "1", "partial", 3), ("c", "1", "partial", 2), ("d", "1", "partial", 1), ("e", "1", "succeeded", 1)], kind)
    best = resume.keep_best(old, new, "url", ["version"])
    assert rows(best.collect()) == rows([("a", "1", "succeeded", 5), ("b", "1", "partial", 9), ("c", "1", "partial", 2), ("d", "1", "partial", 1), ("e", "1", "succeeded", 1)])
    assert rows(resume.keep_best(best, best, "url", ["version"]).collect()) == rows(best.collect())


def test_seed_and_fuzzy_groups(spark):
    names = spark.createDataFrame([("耐摩擦色牢度", 3), ("耐干摩擦色牢度", 2), ("甲醛含量", 4), ("甲醛", 1), ("单独", 1)], "name string, n int")
    found = clusters.seed_groups(names, [("甲醛", ["甲醛"]), ("单", ["单独"])])
    assert rows(found.select("group", "name").collect()) == rows([("甲醛", "甲醛含量"), ("甲醛", "甲醛")])
    assert rows(clusters.label_groups(found).collect()) == rows([("甲醛", "甲醛", 5, 2)])
    leaders = dict(map(tuple, clusters.fuzzy_groups(names).collect()))
    assert leaders["耐干摩擦色牢度"] == leaders["耐摩擦色牢度"] and leaders["单独"] == "单独"


def test_greedy_pick_uses_a_key_once(spark):
    df = spark.createDataFrame([("g1", "a", 1), ("g1", "b", 2), ("g2", "a", 1), ("g2", "c", 3), ("g3", "a", 1), ("g4", "x", 1)], "g string, k string, o int")
    got = {r.g: (r.k, r.preferred) for r in matching.unique_picks(df, "g", "k", "o", ["x"]).collect()}
    assert got == {"g1": ("a", True), "g2": ("c", True), "g3": ("a", False), "g4": ("x", False)}
