"""Queries of delivery: work lists, state after a run that was cut off, delivery rules, over records derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import inspection, validation
from loomspan.plans.relational_queries import table
from loomspan.streaming import recovery

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("""WITH f AS (SELECT 'u' || l_partkey AS url, min(struct_pack(s := l_returnflag, r := l_orderkey)) AS seen FROM lineitem WHERE l_suppkey % 7 <> 0 GROUP BY 1)
  SELECT url, CAST(row_number() OVER (ORDER BY seen, url) AS INTEGER) AS report_index FROM f""")
def work_list(spark, sf_dir):
    """Distinct links numbered by their first appearance, without one task that sorts them all."""
    lines = table(spark, sf_dir, "lineitem")
    reason = F.when(F.col("l_suppkey") % 7 == 0, inspection.INVALID_SKU).otherwise("")
    return inspection.work_list(lines.select(F.concat(F.lit("u"), F.col("l_partkey").cast("string")).alias("url"), F.col("l_returnflag").alias("source_sheet"), F.col("l_orderkey").alias("source_row"), reason.alias("invalid_reason")))


@query("""WITH files AS (SELECT l_partkey AS k, arg_max(struct_pack(s := CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN 'succeeded' ELSE 'partial' END, h := l_suppkey), struct_pack(o := l_orderkey, n := l_linenumber, p := l_suppkey)) AS f
    FROM lineitem WHERE l_suppkey % 3 <> 0 AND l_linestatus = 'F' AND l_partkey % 5 <> 0 GROUP BY 1),
  state AS (SELECT p_partkey AS k, 'succeeded' AS s, CAST(p_size AS VARCHAR) AS h FROM part WHERE p_partkey % 2 = 0)
  SELECT 'u' || coalesce(state.k, files.k) AS url, CASE WHEN files.k IS NOT NULL THEN coalesce(files.f.s, 'retryable_failed') ELSE state.s END AS status, CASE WHEN files.k IS NOT NULL THEN '2' ELSE '1' END AS parser_version,
    CASE WHEN files.k IS NOT NULL THEN CAST(files.f.h AS VARCHAR) ELSE state.h END AS pdf_sha256, CAST(CASE WHEN state.k IS NOT NULL THEN 4 ELSE 1 END AS INTEGER) AS attempts FROM state FULL JOIN files ON state.k = files.k""")
def recovered_state(spark, sf_dir):
    """State rows merged with what result files say; the last file of a link counts, unreadable ones and those of another parser don't."""
    lines = table(spark, sf_dir, "lineitem")
    url = F.concat(F.lit("u"), F.col("l_partkey").cast("string"))
    files = lines.filter("l_linestatus = 'F'").select(
        url.alias("url"), F.when(F.col("l_returnflag") == "R", F.lit(None)).when(F.col("l_returnflag") == "A", "succeeded").otherwise("partial").alias("status"), F.when(F.col("l_suppkey") % 3 == 0, "1").otherwise("2").alias("parser_version"),
        F.col("l_suppkey").cast("string").alias("pdf_sha256"), F.timestamp_seconds(F.col("l_orderkey")).alias("modified"), F.format_string("%05d-%09d", F.col("l_linenumber").cast("int"), F.col("l_suppkey").cast("int")).alias("file"),
        F.when(F.col("l_partkey") % 5 == 0, "broken").alias("corrupt"),
    )
    state = table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("url"), F.lit("succeeded").alias("status"), F.lit("1").alias("parser_version"), F.col("p_size").cast("string").alias("pdf_sha256"), F.lit(4).alias("attempts"))
    return recovery.recovered_state(state, files, "2", ["pdf_sha256"])


@query("""WITH r AS (SELECT CASE l_linenumber % 4 WHEN 0 THEN '异常' WHEN 3 THEN '报告信息/表格原文' ELSE '检测结果明细' END AS kind, CASE WHEN l_suppkey % 10 = 0 THEN 'none' ELSE 's' || l_orderkey END AS id, 'u' || l_orderkey AS url,
    CASE WHEN l_suppkey % 50 = 1 THEN '' ELSE 'k' || l_orderkey END AS sku, CASE WHEN l_discount = 0 THEN '' ELSE '甲醛' END AS item, CASE WHEN l_tax = 0 THEN '--' ELSE '甲醛含量' END AS parent, CASE WHEN l_returnflag = 'R' THEN '待确认归属' ELSE '自动归并' END AS status,
    l_linestatus = 'F' AS inc, l_linenumber % 4 AS m, l_orderkey AS o, l_quantity FROM lineitem),
  s AS (SELECT 's' || o_orderkey AS id, 'u' || o_orderkey AS url, 'k' || o_orderkey AS sku, CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'F' THEN '已解析' ELSE '下载失败' END AS status FROM orders WHERE o_orderkey % 9 <> 0),
  d AS (SELECT 'u' || o_orderkey AS url, CASE WHEN o_custkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status FROM orders WHERE o_orderkey % 11 <> 0),
  t AS (SELECT r.*, s.id AS known, s.status AS own, s.id IS NULL OR r.sku <> s.sku AS lost FROM r LEFT JOIN s ON s.id = r.id WHERE m <> 3)
  SELECT 'V-1 blank item' AS rule, true AS blocking, count(*) AS n FROM r WHERE m IN (1, 2) AND item = '' UNION ALL SELECT 'V-2 unconfirmed in overview', true, count(*) FROM r WHERE inc AND status = '待确认归属'
  UNION ALL SELECT 'V-3 parent name', true, count(*) FROM r WHERE parent = '--' UNION ALL SELECT 'V-4 unstructured raw row', true, count(*) FROM r WHERE m = 3 AND l_quantity > 45
  UNION ALL SELECT 'V-5 CAS number missing', true, count(*) FROM r WHERE l_quantity < 3 UNION ALL SELECT 'V-6 detection limit missing', true, count(*) FROM r WHERE l_quantity = 10 UNION ALL SELECT 'V-10 institution pending', true, count(*) FROM r WHERE m IN (1, 2) AND o % 100 = 0
  UNION ALL SELECT 'V-7 structured trace', true, count(*) FROM t WHERE m <> 0 AND (lost OR sku = '') UNION ALL SELECT 'V-8 exception trace', true, count(*) FROM t WHERE m = 0 AND lost
  UNION ALL SELECT 'V-9 process unfinished', true, count(*) FROM t WHERE (o % 13 = 0 OR (m <> 0 AND coalesce(own, '') = '')) AND url IN (SELECT url FROM d WHERE status = 'ok')
  UNION ALL SELECT 'V-11 mark value', true, count(*) FROM orders WHERE o_custkey % 20 = 0 UNION ALL SELECT 'V-12 issue date', true, count(*) FROM orders WHERE o_custkey % 30 = 1 UNION ALL SELECT 'V-13 mark evidence', true, count(*) FROM orders WHERE o_custkey % 40 = 2
  UNION ALL SELECT 'V-14 institution blank', true, count(*) FROM orders WHERE o_custkey % 50 = 3
  UNION ALL SELECT 'V-15 failure without exception', true, count(DISTINCT url) FROM d WHERE status = 'failed' AND url NOT IN (SELECT url FROM r WHERE m = 0) UNION ALL SELECT 'V-16 download without record', true, count(DISTINCT url) FROM d WHERE url NOT IN (SELECT url FROM r)
  UNION ALL SELECT 'V-17 record without download', true, count(DISTINCT url) FROM r WHERE url NOT IN (SELECT url FROM d) UNION ALL SELECT 'V-18 relationship without id', true, 0
  UNION ALL SELECT 'V-19 relationship not covered', true, count(*) FROM s WHERE id NOT IN (SELECT id FROM r WHERE m <> 3) UNION ALL SELECT 'V-20 metadata missing', true, 0
  UNION ALL SELECT 'V-21 relationship unfinished', true, count(*) FROM s WHERE status <> '已解析' AND url IN (SELECT url FROM d WHERE status = 'ok') UNION ALL SELECT 'V-22 ' || x || ' empty', true, 0 FROM (VALUES ('records'), ('structured records'), ('relationships'), ('downloads')) e(x)
  UNION ALL SELECT 'V-23 failed downloads', false, count(*) FROM d WHERE status = 'failed'""")
def delivery_rules(spark, sf_dir):
    """How many rows break each rule of delivery."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    tag = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    blank = {c: F.lit("") for c in ("color", "source_sheet", "source_row", "source_cell", "sample_type")} | {"color": F.lit("红")}
    m, q = F.col("l_linenumber") % 4, F.col("l_quantity")
    raw = F.when((m == 3) & (q > 45), "12 | 甲醛 | GB/T 2912.1 | 符合").when(q < 3, "苯 71-43-2 号").when(q == 10, "检出限：5").otherwise("原文")
    records = lines.select(
        F.when(m == 0, "异常").when(m == 3, validation.RAW_TABLE).otherwise("检测结果明细").alias("record_type"), F.when(F.col("l_suppkey") % 10 == 0, "none").otherwise(tag("s", "l_orderkey")).alias("source_relationship_id"), tag("u", "l_orderkey").alias("url"),
        F.when(F.col("l_suppkey") % 50 == 1, "").otherwise(tag("k", "l_orderkey")).alias("sku"), *[c.alias(n) for n, c in blank.items()], F.when(F.col("l_discount") == 0, "").otherwise("甲醛").alias("raw_item"), F.when(F.col("l_tax") == 0, "--").otherwise("甲醛含量").alias("parent"),
        F.when(F.col("l_returnflag") == "R", "待确认归属").otherwise("自动归并").alias("status"), F.when(F.col("l_linestatus") == "F", "是").otherwise("否").alias("include"), F.when(F.col("l_orderkey") % 13 == 0, "部分").otherwise("").alias("process_status"),
        F.when(F.col("l_orderkey") % 100 == 0, validation.PENDING_NAME).otherwise("某机构").alias("institution"), raw.alias("raw_row"), F.lit("").alias("cas_number"), F.lit("").alias("detection_limit"),
    )
    status = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", "已解析").otherwise("下载失败")
    sources = orders.filter("o_orderkey % 9 <> 0").select(tag("s", "o_orderkey").alias("source_relationship_id"), tag("u", "o_orderkey").alias("url"), tag("k", "o_orderkey").alias("sku"), *[c.alias(n) for n, c in blank.items()], status.alias("process_status"))
    downloads = orders.filter("o_orderkey % 11 <> 0").select(tag("u", "o_orderkey").alias("url"), F.when(F.col("o_custkey") % 4 == 0, "failed").otherwise("ok").alias("status"), F.lit("").alias("error"))
    every = lambda n, r: F.col("o_custkey") % n == r
    metadata = orders.select(
        tag("u", "o_orderkey").alias("url"), F.when(every(50, 3), "").otherwise("某机构").alias("institution"), F.when(every(20, 0), "？").when(every(40, 2), "未发现").otherwise("有").alias("cma_mark"), F.lit("有").alias("cnas_mark"), F.lit("").alias("cma_evidence"), F.lit("").alias("cnas_evidence"),
        F.lit("").alias("issue_date"), F.lit("未发现").alias("date_status"), F.when(every(30, 1), "").otherwise("无").alias("date_reason"),
    )
    return validation.validate(records, sources, downloads, metadata)


@query("""WITH d AS (SELECT 'k' || l_suppkey AS sku, 'u' || l_orderkey AS url, CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE 'R' || l_orderkey END AS report_no, CASE l_linenumber % 3 WHEN 0 THEN '成衣' WHEN 1 THEN '面料' ELSE '' END AS sample_type,
    CASE WHEN l_returnflag = 'R' THEN '不合格' WHEN l_returnflag = 'A' THEN '合格' ELSE '-' END AS verdict, CASE WHEN l_partkey % 9 = 0 THEN '' ELSE 'p' || (l_partkey % 40) END AS parent, CASE l_partkey % 4 WHEN 0 THEN '基础检测' WHEN 1 THEN '功能性检测' WHEN 2 THEN '其他' ELSE '待分类' END AS class,
    CASE WHEN l_tax = 0 THEN '待复核' ELSE '自动归并' END AS status, l_linestatus = 'F' AS inc FROM lineitem),
  e AS (SELECT 'k' || l_suppkey AS sku, 'x' || l_orderkey AS url, '' AS report_no, '' AS sample_type, '不通过' AS verdict FROM lineitem WHERE l_quantity = 1 AND l_suppkey % 2 = 0),
  rows AS (SELECT sku, url, report_no, sample_type, verdict, CASE WHEN inc AND status <> '待复核' AND parent <> '' THEN parent END AS parent, CASE WHEN inc AND status <> '待复核' AND parent <> '' THEN class END AS class, status = '待复核' AS pending, false AS error FROM d
    UNION ALL SELECT sku, url, report_no, sample_type, verdict, NULL, NULL, false, true FROM e)
  SELECT sku, count(DISTINCT nullif(report_no, '')) AS n_reports, count(DISTINCT url) AS n_files, count(DISTINCT parent) AS n_parents, count(DISTINCT CASE WHEN class = '基础检测' THEN parent END) AS n_basic, count(DISTINCT CASE WHEN class = '功能性检测' THEN parent END) AS n_functional,
    count(DISTINCT nullif(sample_type, '')) AS n_samples, CASE WHEN bool_or(regexp_matches(verdict, '不合格|不通过')) THEN '不合格' WHEN bool_or(verdict = '合格') THEN '合格' ELSE '' END AS verdict, count(*) FILTER (pending) AS n_pending, count(DISTINCT CASE WHEN error THEN url END) AS n_error_files FROM rows GROUP BY sku""")
def inspection_overview(spark, sf_dir):
    """One row a product: reports, files, parents by class, samples, verdict, what is pending and what failed."""
    lines = table(spark, sf_dir, "lineitem")
    tag = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    part = F.col("l_partkey")
    details = lines.select(
        tag("k", F.col("l_suppkey")).alias("sku"), tag("u", F.col("l_orderkey")).alias("url"), F.when(F.col("l_orderkey") % 5 == 0, "").otherwise(tag("R", F.col("l_orderkey"))).alias("report_no"),
        F.when(F.col("l_linenumber") % 3 == 0, "成衣").when(F.col("l_linenumber") % 3 == 1, "面料").otherwise("").alias("sample_type"), F.when(F.col("l_returnflag") == "R", "不合格").when(F.col("l_returnflag") == "A", "合格").otherwise("-").alias("verdict"),
        F.when(part % 9 == 0, "").otherwise(tag("p", part % 40)).alias("parent"), F.when(part % 4 == 0, inspection.BASIC).when(part % 4 == 1, inspection.FUNCTIONAL).when(part % 4 == 2, inspection.OTHER).otherwise(inspection.OPEN).alias("class"),
        F.when(F.col("l_tax") == 0, "待复核").otherwise("自动归并").alias("status"), (F.col("l_linestatus") == "F").alias("include"),
    )
    failed = lines.filter("l_quantity = 1 AND l_suppkey % 2 = 0").select(tag("k", F.col("l_suppkey")).alias("sku"), tag("x", F.col("l_orderkey")).alias("url"), F.lit("").alias("report_no"), F.lit("").alias("sample_type"), F.lit("不通过").alias("verdict"))
    return inspection.overview(details, failed)
