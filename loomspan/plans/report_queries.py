"""Queries of what lines and headers of reports say, over texts derived from the driver tables; the SQL holds what each text means."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions import linewise as L
from loomspan.operators import line_items as I
from loomspan.operators import metadata as M
from loomspan.plans.item_queries import values
from loomspan.plans.relational_queries import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _pick(options, at):
    return F.get(F.array(*[F.lit(o) for o in options]), at.cast("int"))


#: line, verdict, result for pH值, item that no alias stands for
LINES = (
    ("1 甲醛 GB/T 2912.1 ≤20 未检出 符合", "符合", "未检出", "甲醛"), ("镉 = 0.25 mg/kg 符合", "符合", "0.25", "镉"), ("2,4,5-三甲基苯胺 137-17-7 N.D. ≤20 符合", "符合", "未检出", "三甲基苯胺"), ("pH值 5.8 合格", "符合", "5.8", "pH值"),
    ("pH值 温度 20 不符合", "不符合", "", "pH值温度"), ("耐水 ≥3 4-5 符合", "符合", "4-5", ""), ("异味 无异味 合格", "符合", "无异味", "异味无异味"), ("样品等级 合格品", "符合", "", ""), ("耗氧量 ≤ 5.6 0.8mg/kg 通过", "符合", "0.8mg/kg", "耗氧量"),
    ("3 气味 2024 不合格", "不符合", "", "气味"), ("蓬松度 实测 16.6", "实测", "16.6", "蓬松度实测"), ("说明", "", "", ""), ("见附表 合格", "符合", "", ""), ("沾色 级 ≥3 4 合格", "符合", "4", ""),
)


@query(f"""SELECT l_orderkey, l_linenumber, verdict, result, name FROM lineitem JOIN (VALUES {values((i, *x[1:]) for i, x in enumerate(LINES))}) v(i, verdict, result, name) ON i = (l_partkey + l_linenumber) % {len(LINES)}""")
def line_readings(spark, sf_dir):
    """Verdict, result and unknown item of a line."""
    line = _pick([x[0] for x in LINES], (F.col("l_partkey") + F.col("l_linenumber")) % len(LINES))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("line"))
    return rows.select("l_orderkey", "l_linenumber", L.line_verdict(F.col("line")).alias("verdict"), L.line_result(F.col("line"), F.lit("pH值")).alias("result"), L.line_item(F.col("line"), ["耐水"]).alias("name"))


@query(f"""WITH RECURSIVE rows AS (SELECT l_suppkey AS k, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS n,
    CASE (l_partkey + l_orderkey) % 150 WHEN 0 THEN 'open' WHEN 1 THEN 'close' WHEN 2 THEN 'one' ELSE 'line' END AS kind FROM lineitem),
  walk AS (SELECT k, CAST(0 AS BIGINT) AS n, 0 AS left_, false AS kept FROM (SELECT DISTINCT k FROM rows)
    UNION ALL SELECT r.k, r.n, CASE r.kind WHEN 'open' THEN {L.REACH} WHEN 'close' THEN 0 WHEN 'one' THEN w.left_ ELSE greatest(w.left_ - 1, 0) END, r.kind = 'one' OR r.kind = 'line' AND w.left_ > 0 FROM walk w JOIN rows r ON r.k = w.k AND r.n = w.n + 1)
  SELECT k, n FROM walk WHERE kept""")
def item_lists(spark, sf_dir):
    """Lines that belong to a list of items, in the order of their document."""
    seq = F.row_number().over(W.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")).cast("long")
    at = (F.col("l_partkey") + F.col("l_orderkey")) % 150
    line = F.when(at == 0, "序号 检验项目 单项判定").when(at == 1, "备注 ——").when(at == 2, "检测项目 耐水").otherwise("丙")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), seq.alias("n"), line.alias("line"))
    return I.item_lines(lines, ["k"], ["n"]).select("k", "n")


@query("""WITH t AS (SELECT l_partkey AS k, l_linenumber AS page, CASE l_suppkey % 3 WHEN 0 THEN l_linenumber || ' 甲醛 ≤20 ' || CAST(l_quantity AS INTEGER) || ' 符合' WHEN 1 THEN '甲醛含量 符合' ELSE 'pH值 ' || CAST(l_quantity AS INTEGER) || ' 合格' END AS line,
    CASE WHEN l_suppkey % 3 = 2 THEN 'pH值' ELSE '甲醛含量' END AS item, CASE l_suppkey % 3 WHEN 0 THEN '甲醛' WHEN 1 THEN '甲醛含量' ELSE 'pH值' END AS alias, CASE WHEN l_suppkey % 3 = 1 THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS result FROM lineitem)
  SELECT k, item, b.alias AS alias, b.result AS result, b.page AS page, b.line AS line FROM (SELECT k, item, max(struct_pack(p := CASE WHEN result <> '' THEN 5 ELSE 0 END + CASE WHEN regexp_matches(line, '^[0-9]') THEN 2 ELSE 0 END - length(line) / 500.0::DOUBLE,
    page := page, line := line, alias := alias, verdict := '符合', result := result)) AS b FROM t GROUP BY 1, 2)""")
def best_item_lines(spark, sf_dir):
    """The best line of each item of a document."""
    n = F.col("l_quantity").cast("int").cast("string")
    line = F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit(" 甲醛 ≤20 "), n, F.lit(" 符合"))).when(F.col("l_suppkey") % 3 == 1, "甲醛含量 符合").otherwise(F.concat(F.lit("pH值 "), n, F.lit(" 合格")))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("page"), line.alias("line"))
    return I.best_lines(lines, ["k"], [("甲醛含量", ["甲醛含量", "甲醛"]), ("pH值", ["pH值"])]).select("k", "item", "alias", "result", "page", "line")


#: text of a report, its number, date, state of the date, institution, marks
REPORTS = (
    ("报告编号：AB123456\n签发日期：2026-01-10\n某某检测技术有限公司", "AB123456", "2026-01-10", "已识别", "某某检测技术有限公司", "待复核", "待复核"),
    ("通过CMA资质认定\nCNAS L1968\n报告签发日期：2026-02-31；出具日期：2026-02-28", "R", "2026-02-28", "已识别", "未识别", "有", "有"),
    ("未获得CMA 认可\n检测日期 2026.06.10；复检 检测日期 2026.06.12 检测类别", "R", "2026-06-12", "已识别", "未识别", "未发现", "待复核"), ("委托方\n浙江某某检测技术有限公司\n报告签发日期：2026-02-31", "R", None, "待复核", "未识别", "待复核", "待复核"),
)


@query(f"""SELECT o_orderkey, CASE WHEN number = 'R' THEN 'R' || o_orderkey ELSE number END AS report_no, CAST(issued AS DATE) AS report_issue_date, state AS report_issue_date_status, institution, cma AS cma_mark, cnas AS cnas_mark
  FROM orders JOIN (VALUES {values((i, *x[1:]) for i, x in enumerate(REPORTS))}) v(i, number, issued, state, institution, cma, cnas) ON i = o_custkey % {len(REPORTS)}""")
def report_metadata(spark, sf_dir):
    """What the report of each order says of itself; every third has its header recognised."""
    orders = table(spark, sf_dir, "orders")
    url = F.col("o_orderkey").cast("string")
    missing = {n: F.lit(None).cast("string") for n in ("header_native_text", "header_ocr_text", "header_parse_error", "ocr_error")}
    documents = orders.select(
        url.alias("url"), F.concat(F.lit("R"), url).alias("report_no"), F.lit("native").alias("text_source"), *[c.alias(n) for n, c in missing.items()], F.lit(False).alias("header_parse_attempted"),
        F.lit("已完成").alias("header_parse_status"), F.lit(False).alias("ocr_attempted"),
    )
    pages = orders.select(url.alias("url"), F.lit(1).alias("page"), _pick([x[0] for x in REPORTS], F.col("o_custkey") % len(REPORTS)).alias("text"))
    blocks = orders.limit(0).select(url.alias("url"), F.lit(1).alias("page"), F.lit(0).alias("ord"), F.lit("").alias("text"), *[F.lit(0.0).alias(n) for n in ("confidence", "x", "mid_x", "mid_y", "width")], F.lit(False).alias("header"))
    told = M.report_metadata(documents, pages, blocks)
    return told.select(F.col("url").cast("long").alias("o_orderkey"), "report_no", "report_issue_date", "report_issue_date_status", "institution", "cma_mark", "cnas_mark")
