"""Queries of the review operators over the driver tables, with the SQL that each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import items as I
from loomspan.operators import review as V
from loomspan.operators import relational as R
from loomspan.plans.relational_queries import table
from loomspan.streaming import resume

QUERIES, SQL = {}, {}
RULES = ["PROMO", "ECONOMY"]
_SHEET = """SELECT p_partkey, p_name AS candidate, p_type AS suggested, p_brand AS reason, p_size AS n, p_brand || ' ' || CAST(p_partkey AS VARCHAR) AS example,
  CASE WHEN p_size < 10 THEN '同意' WHEN p_size < 20 THEN '排除' WHEN p_size < 25 THEN '不同意' WHEN p_size < 30 THEN '拆分' WHEN p_size < 35 THEN p_type || ' own' ELSE '' END AS judgement,
  CASE WHEN p_name LIKE 'cold%' THEN 'cold things' ELSE '' END AS confirm FROM part"""
_JUDGED = f"""SELECT *, CASE WHEN state = 'confirmed' THEN CASE WHEN confirm <> '' THEN confirm WHEN judgement = '同意' THEN suggested ELSE judgement END END AS unified FROM (
  SELECT *, CASE WHEN judgement = '排除' THEN 'excluded' WHEN confirm <> '' OR judgement NOT IN ('', '不同意', '拆分') THEN 'confirmed' WHEN judgement = '' THEN 'blank' END AS state FROM ({_SHEET})) WHERE state IS NOT NULL"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _sheet(spark, sf_dir):
    size, kind = F.col("p_size"), F.col("p_type")
    answer = F.when(size < 10, V.AGREE).when(size < 20, V.EXCLUDE).when(size < 25, V.NO_RULE[0]).when(size < 30, V.NO_RULE[1]).when(size < 35, F.concat(kind, F.lit(" own"))).otherwise("")
    confirm = F.when(F.col("p_name").startswith("cold"), "cold things").otherwise("")
    example = F.concat_ws(" ", "p_brand", F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("candidate"), kind.alias("suggested"), F.col("p_brand").alias("reason"), size.alias("n"), example.alias("example"), answer.alias("judgement"), confirm.alias("confirm"))


@query(f"SELECT p_partkey, state, unified FROM ({_JUDGED})")
def judgement_split(spark, sf_dir):
    return V.judged(_sheet(spark, sf_dir)).select("p_partkey", "state", "unified")


@query(f"""WITH c AS (SELECT * FROM ({_JUDGED}) WHERE state = 'confirmed'),
  a AS (SELECT unified, string_agg(candidate, '、' ORDER BY m, candidate) AS aliases FROM (SELECT unified, candidate, min(-n) AS m FROM c GROUP BY 1, 2) GROUP BY 1),
  r AS (SELECT unified, string_agg(reason, '；' ORDER BY m, cand, reason) AS reasons FROM (SELECT unified, reason, -n AS m, candidate AS cand, row_number() OVER (PARTITION BY unified, reason ORDER BY -n, candidate) AS k FROM c) WHERE k = 1 GROUP BY 1),
  e AS (SELECT unified, string_agg(example, '<br>' ORDER BY k) AS examples FROM (SELECT unified, example, row_number() OVER (PARTITION BY unified ORDER BY -n, candidate, example) AS k FROM c) WHERE k <= 3 GROUP BY 1)
  SELECT unified, aliases, reasons, examples FROM a JOIN r USING (unified) JOIN e USING (unified)""")
def confirmed_rules(spark, sf_dir):
    return V.confirmed_rules(V.judged(_sheet(spark, sf_dir)).filter("state = 'confirmed'"))


@query("""SELECT l_partkey, l_orderkey, l_linenumber, l_returnflag FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END,
  CASE WHEN l_returnflag = 'R' THEN -l_orderkey ELSE l_orderkey END, CASE WHEN l_returnflag = 'R' THEN -l_linenumber ELSE l_linenumber END) AS k FROM lineitem
  WHERE l_returnflag IN ('R', 'A', 'N') AND l_partkey IS NOT NULL AND l_quantity >= 10) WHERE k = 1""")
def fill_gaps(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    caches = [t.filter(F.col("l_returnflag") == flag) for flag in "RAN"]
    return V.fill_gaps(caches, "l_partkey", F.col("l_quantity") >= 10, ["l_orderkey", "l_linenumber"]).drop("l_quantity")


@query("""SELECT l_returnflag, count(*) AS records, count(DISTINCT l_partkey) AS keys, count(DISTINCT CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40) THEN l_partkey END) AS excluded_keys
  FROM lineitem GROUP BY 1""")
def candidate_counts(spark, sf_dir):
    excluded = table(spark, sf_dir, "part").filter("p_size > 40").select(F.col("p_partkey").alias("l_partkey"))
    return V.candidate_counts(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_partkey", excluded)


@query("""SELECT p_type, count(*) AS n, count(*) FILTER (WHERE p_name LIKE '% widget') AS n_child, count(*) FILTER (WHERE p_size < 5) AS n_short,
  CAST(count(*) FILTER (WHERE p_name LIKE '% widget') AS DOUBLE) / count(*) AS child_ratio FROM part GROUP BY 1""")
def child_ratio(spark, sf_dir):
    return V.child_ratio(table(spark, sf_dir, "part"), ["p_type"], F.col("p_name").like("% widget"), F.col("p_size") < 5)


@query("""SELECT p_type, p_name, CAST(CASE p_type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 ELSE 3 END AS INTEGER) AS position, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY 3, 1, 4 DESC, 2""")
def rule_order(spark, sf_dir):
    counted = table(spark, sf_dir, "part").groupBy("p_type", "p_name").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("position", V.rule_position(F.col("p_type"), RULES).cast("int")).orderBy("position", "p_type", F.desc("n"), "p_name")


@query("""SELECT p_brand, p_type, n, CAST(sum(n) OVER (PARTITION BY p_brand) AS BIGINT) AS total FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)""")
def group_total_order(spark, sf_dir):
    return V.by_group_total(table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")), "p_brand", "n")


@query("SELECT p_name AS name, count(*) AS n FROM part WHERE contains(p_name, 'widget') OR contains(p_name, 'cold') GROUP BY 1")
def noise_names(spark, sf_dir):
    return V.noise_names(table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n")), ["widget", "cold"])


@query("SELECT page_id, sha1(url) || '.pdf' AS sha1_name, substr(sha256(url), 1, 20) || '.pdf' AS sha256_name FROM pages")
def file_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", *[c.alias(n) for n, c in V.file_names(F.col("url")).items()])


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem ORDER BY 1, 2")
def distinct_pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct().orderBy("l_suppkey", "l_returnflag")


@query(r"""SELECT doc_id, array_to_string(list_distinct_in_order, '；') AS detail FROM (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_in_order FROM (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[（(［\[]([^）)\]］]+)[）)］\]]', 1), lambda x: regexp_replace(x, '\s+', '', 'g')),
  lambda x: x <> '' AND x <> '其他' AND NOT regexp_full_match(x, '(?i)(?:%|/|g|kg|mg/kg|cm|mm|根/m²|根/m2|级|个|N)')) AS l FROM documents))""")
def bracket_details(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", I.item_detail(F.col("text")).alias("detail"))


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax) AS k FROM lineitem),
  p AS (SELECT * FROM t WHERE k = 1 AND l_linestatus = 'F'), c AS (SELECT * FROM t WHERE k = 1 AND l_linestatus = 'O')
  SELECT coalesce(c.l_orderkey, p.l_orderkey) AS l_orderkey, CASE WHEN c.l_orderkey IS NULL THEN p.l_linenumber WHEN p.l_orderkey IS NULL OR p.l_tax <> c.l_tax OR c.l_returnflag = 'A' THEN c.l_linenumber
  WHEN p.l_returnflag = 'A' OR p.l_quantity > c.l_quantity THEN p.l_linenumber ELSE c.l_linenumber END AS l_linenumber FROM p FULL JOIN c ON p.l_orderkey = c.l_orderkey""")
def keep_best_result(spark, sf_dir):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax"]
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", *order, F.when(F.col("l_returnflag") == "A", "succeeded").otherwise("partial").alias("status"), F.col("l_quantity").alias("n_rows"))
    firsts = R.keep_first(t, ["l_orderkey", "l_linestatus"], order)
    old, new = (firsts.filter(F.col("l_linestatus") == s).drop("l_linestatus") for s in "FO")
    return resume.keep_best(old, new, "l_orderkey", ["l_tax"]).select("l_orderkey", "l_linenumber")
