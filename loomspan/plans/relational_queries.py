"""Queries over the driver tables, one for each row operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import clusters
from loomspan.operators import relational as R

FAMILIES = [("fastener", ["bolt", "rod"]), ("drive", ["gear", "gizmo"]), ("ring", ["ring"])]
ANCHORS = [("low", 5.0), ("middle", 25.0), ("upper", 35.0), ("high", 45.0)]
PRIORITY = [("^1-", "immediate"), ("^2-", "soon"), ("URGENT|HIGH", "raised"), ("NOT SPECIFIED", "unknown")]
QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""SELECT l_orderkey, l_linenumber, 'src-' || substr(sha256(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
  CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag)), 1, 20) AS relationship_id FROM lineitem""")
def relationship_id(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return t.select("l_orderkey", "l_linenumber", R.relationship_id(*[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")]).alias("relationship_id"))


@query("""SELECT page_id, url, CAST(min(position) AS INTEGER) AS position FROM (SELECT page_id, unnest(l) AS url, generate_subscripts(l, 1) - 1 AS position
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages)) GROUP BY page_id, url""")
def explode_links(spark, sf_dir):
    return R.explode_matches(table(spark, sf_dir, "pages"), ["page_id"], "html", 'href="([^"]+)"', 1, "url")


@query("""SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no,
  regexp_replace(unnest(l), '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g') AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE line <> ''""")
def explode_lines(spark, sf_dir):
    return R.explode_lines(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@query("SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS value FROM part WHERE p_name <> '' UNION SELECT p_partkey, 'unlabelled' FROM part WHERE coalesce(p_name, '') = ''")
def split_values(spark, sf_dir):
    return R.explode_split(table(spark, sf_dir, "part"), ["p_partkey"], "p_name", " ", "unlabelled")


@query("""SELECT o_orderkey, c_mktsegment, l_linenumber FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey""")
def fanout_relationships(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    out = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return out.select("o_orderkey", "c_mktsegment", "l_linenumber")


@query("""SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey) = 1) ON o_custkey = c_custkey""")
def first_match_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey"))
    return R.first_match(table(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("""WITH c AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'),
  n AS (SELECT l_partkey, count(*) AS n, min(l_suppkey) AS sole FROM c GROUP BY 1)
  SELECT l.l_orderkey, l.l_partkey, CASE WHEN c.l_suppkey IS NOT NULL THEN 'exact' WHEN n.n = 1 THEN 'sole' WHEN n.n > 1 THEN 'ambiguous' ELSE 'missing' END AS resolution,
  coalesce(c.l_suppkey, CASE WHEN n.n = 1 THEN n.sole END) AS resolved, CAST(coalesce(n.n, 0) AS BIGINT) AS n_candidates
  FROM lineitem l LEFT JOIN n ON n.l_partkey = l.l_partkey LEFT JOIN c ON c.l_partkey = l.l_partkey AND c.l_suppkey = l.l_suppkey""")
def source_cascade(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("hint"))
    candidates = lines.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    return R.resolve_source(rows, candidates, ["l_partkey"], "hint", "l_suppkey").drop("hint")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_scope(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("doc_id", "lang")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_uncovered(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("""SELECT CASE WHEN o_orderkey IS NULL THEN 'unknown' WHEN o_orderstatus IS NOT DISTINCT FROM l_linestatus THEN 'same' ELSE 'different' END AS identity, count(*) AS n
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' GROUP BY 1""")
def identity_check(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'"), table(spark, sf_dir, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    same = F.struct(F.col("o_orderstatus").alias("status")).eqNullSafe(F.struct(F.col("l_linestatus").alias("status")))
    identity = F.when(F.col("o_orderkey").isNull(), "unknown").when(same, "same").otherwise("different")
    return joined.groupBy(identity.alias("identity")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'bolt') THEN 'fastener' WHEN contains(lower(p_name), 'rod') THEN 'fastener' WHEN contains(lower(p_name), 'gear') THEN 'drive'
  WHEN contains(lower(p_name), 'gizmo') THEN 'drive' WHEN contains(lower(p_name), 'ring') THEN 'ring' END AS standard FROM part""")
def alias_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", R.alias_of(F.col("p_name"), FAMILIES).alias("standard"))


@query("""SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '^1-') THEN 'immediate' WHEN regexp_matches(o_orderpriority, '^2-') THEN 'soon'
  WHEN regexp_matches(o_orderpriority, 'URGENT|HIGH') THEN 'raised' WHEN regexp_matches(o_orderpriority, 'NOT SPECIFIED') THEN 'unknown' ELSE 'other' END AS handling FROM orders""")
def ordered_regex_rules(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", R.ordered_rules(F.col("o_orderpriority"), PRIORITY, "other").alias("handling"))


@query("""SELECT l_orderkey, l_linenumber, arg_min(name, struct_pack(d := abs(l_quantity - x), i := i)) AS anchor FROM lineitem, (VALUES (0, 'low', 5.0::DOUBLE), (1, 'middle', 25.0::DOUBLE),
  (2, 'upper', 35.0::DOUBLE), (3, 'high', 45.0::DOUBLE)) a(i, name, x) GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate""")
def nearest_anchor(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", R.nearest_anchor(F.col("l_quantity"), ANCHORS).alias("anchor"))


@query("""SELECT event_id, CAST(floor((us + lag(us) OVER w) / 2) AS BIGINT) AS lower, CAST(floor((us + lead(us) OVER w) / 2) AS BIGINT) AS upper
  FROM (SELECT event_id, user_id, epoch_us(ts) AS us FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)""")
def interval_assign(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return R.midpoint_bounds(events, ["user_id"], ["us", "event_id"], "us").select("event_id", "lower", "upper")


@query("""SELECT a.event_id, (SELECT arg_min(b.event_id, struct_pack(t := b.ts, e := b.event_id)) FROM events b WHERE b.event_type = 'purchase' AND b.user_id = a.user_id
  AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR AND abs(b.value - a.value) <= 20) AS hit FROM events a WHERE a.event_type = 'click'""")
def spatial_theta(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    left = events.filter("event_type = 'click'").select("event_id", "user_id", "value", "ts")
    right = events.filter("event_type = 'purchase'").select(F.col("event_id").alias("hit"), "user_id", F.col("value").alias("other"), F.col("ts").alias("at"))
    near = F.expr("at >= ts and at <= ts + interval 6 hours and abs(other - value) <= 20")
    hours = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 3.6e9
    return R.first_in_range(left, right, ["user_id"], near, ["event_id"], ["at", "hit"], ["hit"], (hours("ts"), hours("ts") + 6, hours("at"), 6)).select("event_id", "hit")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text
  ROWS UNBOUNDED PRECEDING) AS asked FROM conversations""")
def fill_down(spark, sf_dir):
    asked = F.when(F.col("role") == "user", F.col("text"))
    return R.fill_down(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"], asked, "asked").select("conv_id", "turn", "asked")


@query("""SELECT event_id, segment, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id, segment ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried
  FROM (SELECT *, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM events)""")
def reset_fill(spark, sf_dir):
    carried = F.when(F.col("event_type") == "purchase", F.col("value"))
    return R.reset_fill(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", carried, "carried").select("event_id", "segment", "carried")


@query("SELECT doc_id, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(coalesce(text, '')), lang ORDER BY doc_id) = 1")
def keep_first_dedupe(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    return R.keep_first(keyed, ["digest", "lang"], ["doc_id"]).select("doc_id", "lang", "n_chars")


@query("""WITH m AS (SELECT *, l_discount > 0 AS concrete, l_discount > 0 AND l_tax > 0 AS detailed FROM lineitem),
  g AS (SELECT *, bool_or(detailed) OVER p AS any_d, list(CASE WHEN detailed THEN l_linestatus END) OVER p AS methods FROM m WINDOW p AS (PARTITION BY l_partkey, l_returnflag))
  SELECT l_orderkey, l_linenumber, l_partkey FROM g WHERE NOT (any_d AND NOT concrete AND l_returnflag <> '' AND NOT l_quantity > 45 AND list_contains(methods, l_linestatus))""")
def prefer_detail(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    concrete = F.col("l_discount") > 0
    kept = R.prefer_detail(t, ["l_partkey", "l_returnflag"], concrete, concrete & (F.col("l_tax") > 0), F.col("l_linestatus"), F.col("l_returnflag"), F.col("l_quantity") > 45)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT l_partkey, max_by(l_orderkey, k) AS best_order, max_by(l_linenumber, k) AS best_line FROM (SELECT *, struct_pack(score := l_extendedprice, o := l_orderkey, n := l_linenumber) AS k
  FROM lineitem) GROUP BY l_partkey""")
def best_match(spark, sf_dir):
    key = F.struct("l_extendedprice", "l_orderkey", "l_linenumber")
    best = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max(key).alias("k"))
    return best.select("l_partkey", F.col("k.l_orderkey").alias("best_order"), F.col("k.l_linenumber").alias("best_line"))


@query("""SELECT event_type, count(*) AS n, array_to_string((list(event_id ORDER BY event_id))[1:5], ',') AS examples FROM events GROUP BY event_type""")
def count_with_examples(spark, sf_dir):
    return R.count_with_examples(table(spark, sf_dir, "events"), ["event_type"], "event_id", ["event_id"], 5)


@query("""SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY seen) AS joined FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS seen FROM orders GROUP BY 1, 2) GROUP BY 1""")
def ordered_distinct_join(spark, sf_dir):
    return R.ordered_distinct_join(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("SELECT l_partkey, l_suppkey, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1")
def conflict_items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count_distinct("l_returnflag").alias("n_values")).filter("n_values > 1")


@query("""SELECT c_custkey, count(DISTINCT o_orderkey) AS n_reports, count(DISTINCT l_partkey) AS n_items, count(DISTINCT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN l_partkey END) AS n_basic,
  count(DISTINCT CASE WHEN p_type = 'PROMO' THEN l_partkey END) AS n_functional, CASE WHEN bool_or(l_returnflag = 'R') THEN 'fail' WHEN bool_or(l_returnflag = 'A') THEN 'pass' ELSE '' END AS verdict,
  count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS n_pending FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def overview_rollup(spark, sf_dir):
    customer, orders, lines, part = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "part"))
    joined = customer.select("c_custkey").join(orders, customer.c_custkey == orders.o_custkey, "left").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    joined = joined.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    of_type = lambda *x: F.when(F.col("p_type").isin(*x), F.col("l_partkey"))
    flag = lambda x: F.coalesce(F.col("l_returnflag") == x, F.lit(False))
    # First one row for each item of a report: what is left to count distinctly is small, and no Expand is needed.
    per = joined.groupBy("c_custkey", "o_orderkey", "l_partkey").agg(F.first("p_type").alias("p_type"), F.max(flag("R")).alias("failed"), F.max(flag("A")).alias("passed"), F.count_if(F.col("l_linestatus") == "O").alias("pending"))
    return per.groupBy("c_custkey").agg(
        F.count_distinct("o_orderkey").alias("n_reports"), F.count_distinct("l_partkey").alias("n_items"), F.count_distinct(of_type("ECONOMY", "STANDARD")).alias("n_basic"),
        F.count_distinct(of_type("PROMO")).alias("n_functional"), R.roll_up_verdict(F.col("failed"), F.col("passed")).alias("verdict"), F.sum("pending").alias("n_pending"),
    )


@query("SELECT event_type, 'k' AS stat, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS n FROM events GROUP BY 1")
def stat_merge(spark, sf_dir):
    value = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf_dir, "events").select("event_type", F.lit("k").alias("stat"), value.alias("v")).groupBy("event_type", "stat").agg(F.sum("v").alias("n"))


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity >= 10)")
def universal_filter(spark, sf_dir):
    return R.all_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey"], F.col("l_quantity") >= 10)


@query("""SELECT doc_id, CAST((CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 3 ELSE 0 END) + (CASE WHEN regexp_matches(text, '[0-9]') THEN 2 ELSE 0 END) + (CASE WHEN contains(text, '!!') THEN 2 ELSE 0 END)
  + (CASE WHEN length(text) > 3000 THEN 2 ELSE 0 END) + (CASE WHEN contains(text, ' the ') THEN 1 ELSE 0 END) AS INTEGER) AS score FROM documents WHERE score >= 4""")
def evidence_score(spark, sf_dir):
    t = F.col("text")
    score = R.evidence_score([(t.rlike("(?i)licen[sc]e"), 3), (t.rlike("[0-9]"), 2), (t.contains("!!"), 2), (F.length(t) > 3000, 2), (t.contains(" the "), 1)])
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("score")).filter("score >= 4")


@query("""WITH l AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, trim(unnest(l)) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
  e AS (SELECT *, last_value(CASE WHEN length(line) < 40 THEN line_no WHEN contains(line, '!!') THEN -1 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS o FROM l WHERE line <> '')
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no FROM e WHERE o >= 0 AND line_no > o AND line_no - o <= 3""")
def section_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line", F.trim("line")).filter("line <> ''")
    return R.section_lines(lines, ["doc_id"], "line_no", F.length("line") < 40, F.col("line").contains("!!"), 3).select("doc_id", "line_no")


@query("""SELECT p_partkey, CASE WHEN coalesce(p_name, '') = '' THEN 'empty' WHEN length(p_name) > 40 THEN 'long' WHEN regexp_matches(p_name, '[0-9]') THEN 'digit' WHEN regexp_matches(p_name, '^(old|hot) ') THEN 'prefix'
  WHEN regexp_matches(p_name, '(ring|rod)$') THEN 'suffix' ELSE 'valid' END AS rule FROM part""")
def valid_name(spark, sf_dir):
    name = F.coalesce("p_name", F.lit(""))
    rule = F.when(name == "", "empty").when(F.length(name) > 40, "long").when(name.rlike("[0-9]"), "digit").when(name.rlike("^(old|hot) "), "prefix").when(name.rlike("(ring|rod)$"), "suffix").otherwise("valid")
    return table(spark, sf_dir, "part").select("p_partkey", rule.alias("rule"))


@query("""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) AS stem FROM pages""")
def url_parts(spark, sf_dir):
    u = F.col("url")
    path = F.regexp_extract(u, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.lower(F.regexp_extract(u, "^([A-Za-z]+)://", 1)).alias("scheme"), F.lower(F.regexp_extract(u, "^[A-Za-z]+://([^/?#]*)", 1)).alias("host"), path.alias("path"), F.regexp_extract(path, "([^/]*)$", 1).alias("stem"))


@query("""SELECT p_partkey, CASE WHEN starts_with(p_name, 'small ') THEN 'small' WHEN starts_with(p_name, 'large ') THEN 'large' WHEN starts_with(p_name, 'red ') THEN 'red' ELSE p_name END AS parent,
  CASE WHEN regexp_matches(p_name, '^(small|large|red) ') THEN regexp_replace(p_name, '^(small|large|red) ', '') ELSE '' END AS child FROM part""")
def item_parent_child(spark, sf_dir):
    from loomspan.operators.rewrite import longest_beginning

    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    families = spark.createDataFrame([(x, i, x) for i, x in enumerate(["small", "large", "red"])], "beginning string, place int, family string")
    told = longest_beginning(part, "p_name", families, " ", ["family"])
    inside = F.coalesce(F.col("rest") != "", F.lit(False))  # a name that is the family's alone has no child
    return told.select("p_partkey", F.when(inside, F.col("family")).otherwise(F.col("p_name")).alias("parent"), F.when(inside, F.expr("substring(rest, 2)")).otherwise("").alias("child"))


@query("""WITH c AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS priority, l_shipdate AS d FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01')
  SELECT o_orderkey, CAST(f.d AS DATE) AS issued, CAST(f.priority AS INTEGER) AS priority FROM orders LEFT JOIN (SELECT l_orderkey, priority, max(d) AS d FROM c GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY priority) = 1) f ON f.l_orderkey = o_orderkey""")
def date_priority(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_shipdate < timestamp_ntz '2001-01-01 00:00:00'")
    rank = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    latest = lines.groupBy(F.col("l_orderkey").alias("o_orderkey"), rank.alias("priority")).agg(F.max("l_shipdate").alias("d"))
    return R.first_match(table(spark, sf_dir, "orders").select("o_orderkey"), latest, ["o_orderkey"], ["priority"], ["d", "priority"]).select("o_orderkey", F.col("d").cast("date").alias("issued"), "priority")


@query("""WITH k AS (SELECT o_orderkey, lpad(CAST(o_orderkey * 37 AS VARCHAR), 8, '1') AS digits FROM orders WHERE length(CAST(o_orderkey * 37 AS VARCHAR)) <= 8)
  SELECT o_orderkey, CAST(digits[1:1] AS INTEGER) * 7 AS w, CAST((CAST(digits[1:1] AS INTEGER) * 7 + CAST(digits[2:2] AS INTEGER) * 6 + CAST(digits[3:3] AS INTEGER) * 5 + CAST(digits[4:4] AS INTEGER) * 4
  + CAST(digits[5:5] AS INTEGER) * 3 + CAST(digits[6:6] AS INTEGER) * 2 + CAST(digits[7:7] AS INTEGER)) % 10 = CAST(digits[8:8] AS INTEGER) AS BOOLEAN) AS valid FROM k""")
def cas_checksum(spark, sf_dir):
    from loomspan.functions.text import cas_valid

    raw = (F.col("o_orderkey") * 37).cast("string")
    t = table(spark, sf_dir, "orders").filter(F.length(raw) <= 8).select("o_orderkey", F.lpad(raw, 8, "1").alias("digits"))
    cas = F.concat_ws("-", F.substring("digits", 1, 5), F.substring("digits", 6, 2), F.substring("digits", 8, 1))
    return t.select("o_orderkey", (F.substring("digits", 1, 1).cast("int") * 7).alias("w"), cas_valid(cas).alias("valid"))


@query("""SELECT c_custkey, c_mktsegment, CAST(turn AS INTEGER) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('7:' || c_custkey)) AS turn FROM customer)
  WHERE turn <= 6 ORDER BY turn, c_mktsegment LIMIT 25""")
def stratified_sample(spark, sf_dir):
    return R.stratified_sample(table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", 6, 25, "7").select("c_custkey", "c_mktsegment", "turn")


@query("""WITH RECURSIVE k AS (SELECT p_brand, p_name, min(p_partkey) AS o FROM part GROUP BY 1, 2), g AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS i FROM (SELECT DISTINCT p_brand FROM part)),
  lists AS (SELECT i, g.p_brand, list(p_name ORDER BY o, p_name) AS names FROM g JOIN k ON k.p_brand = g.p_brand GROUP BY 1, 2),
  walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS p_brand, CAST(NULL AS VARCHAR) AS p_name, CAST([] AS VARCHAR[]) AS used, false AS preferred
    UNION ALL SELECT i, p_brand, p_name, list_append(used, p_name), preferred FROM (
      SELECT l.i, l.p_brand, w.used, coalesce(list_filter(l.names, lambda n: NOT list_contains(w.used, n) AND n <> 'small ring')[1], list_filter(l.names, lambda n: NOT list_contains(w.used, n))[1], l.names[1]) AS p_name,
        len(list_filter(l.names, lambda n: NOT list_contains(w.used, n) AND n <> 'small ring')) > 0 AS preferred FROM walk w JOIN lists l ON l.i = w.i + 1))
  SELECT p_brand, p_name, preferred FROM walk WHERE i > 0""")
def greedy_unique_pick(spark, sf_dir):
    from loomspan.operators.matching import unique_picks

    return unique_picks(table(spark, sf_dir, "part"), "p_brand", "p_name", "p_partkey", ["small ring"])


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F', o_orderkey) = 1""")
def manifest_merge(spark, sf_dir):
    return R.merge_manifests(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderstatus") == "F", ["o_orderkey"])


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN d.doc_id % 5 = 0 THEN 'changed' WHEN l.quality = 1 THEN 'done' WHEN l.toxic = 1 THEN 'permanent' ELSE 'retry' END AS state
  FROM documents d LEFT JOIN labels l USING (doc_id) WHERE NOT (l.doc_id IS NOT NULL AND d.doc_id % 5 <> 0 AND (l.quality = 1 OR l.toxic = 1))""")
def pending_work(spark, sf_dir):
    from loomspan.streaming.resume import decide

    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("known"), "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id").join(labels, F.col("doc_id") == F.col("known"), "left")
    status = F.when(F.col("quality") == 1, "succeeded").when(F.col("toxic") == 1, "permanent_failed").otherwise("partial")
    state = decide(F.col("known").isNotNull(), F.col("doc_id") % 5 == 0, status)
    return docs.select("doc_id", state.alias("state")).filter(~F.col("state").isin("done", "permanent"))


@query("""SELECT 'both' AS side, CAST(k AS INTEGER) AS k FROM (SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0) UNION ALL
  SELECT 'customer only', CAST(k AS INTEGER) FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) UNION ALL
  SELECT 'nation', n_nationkey FROM nation""")
def union_except_intersect(spark, sf_dir):
    nation, customer, supplier = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    both = supplier.select(F.col("s_nationkey").alias("k")).intersect(customer.filter("c_acctbal < 0").select("c_nationkey"))
    only = customer.select(F.col("c_nationkey").alias("k")).exceptAll(customer.limit(0).select("c_nationkey")).distinct().join(supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")), "k", "left_anti")
    named = lambda df, side: df.select(F.lit(side).alias("side"), F.col("k").cast("int").alias("k"))
    return named(both, "both").unionByName(named(only, "customer only")).unionByName(named(nation.select(F.col("n_nationkey").alias("k")), "nation"))


@query("""SELECT user_id, count(CASE WHEN event_type = 'view' THEN 1 END) AS view, count(CASE WHEN event_type = 'click' THEN 1 END) AS click, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase,
  count(CASE WHEN event_type = 'signup' THEN 1 END) AS signup, count(CASE WHEN event_type = 'error' THEN 1 END) AS error FROM events GROUP BY 1""")
def wide_pivot(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", ["view", "click", "purchase", "signup", "error"]).agg(F.count(F.lit(1))).na.fill(0)


@query("""SELECT 'documents_blank' AS metric, count(*) AS n FROM documents WHERE coalesce(trim(text), '') = '' UNION ALL SELECT 'documents_length_differs', count(*) FROM documents WHERE n_chars <> length(text)
  UNION ALL SELECT 'labels_without_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'documents_without_label', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL SELECT 'pages_unsafe_url', count(*) FROM pages WHERE NOT regexp_matches(url, '^https?://[^/]+') UNION ALL SELECT 'labels_out_of_range', count(*) FROM labels WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1)""")
def validation_metrics(spark, sf_dir):
    docs, labels, pages = (table(spark, sf_dir, t) for t in ("documents", "labels", "pages"))
    return R.metrics([
        ("documents_blank", docs.filter(F.trim(F.coalesce("text", F.lit(""))) == "")), ("documents_length_differs", docs.filter(F.col("n_chars") != F.length("text"))),
        ("labels_without_document", labels.join(docs, "doc_id", "left_anti")), ("documents_without_label", docs.join(labels, "doc_id", "left_anti")),
        ("pages_unsafe_url", pages.filter(~F.col("url").rlike("^https?://[^/]+"))), ("labels_out_of_range", labels.filter("quality not in (0, 1) or toxic not in (0, 1)")),
    ])


@query()
def fuzzy_groups(spark, sf_dir):
    names = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return clusters.fuzzy_groups(names)


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(replace(replace(lower(text), '!!', '!'), 'th', 'z'), '[^a-z0-9! ]+', ' ', 'g'), ' +', ' ', 'g')) AS clean FROM documents""")
def normalize_text(spark, sf_dir):
    from loomspan.functions.text import replaced

    text = replaced(F.lower("text"), [("!!", "!"), ("th", "z")])
    return table(spark, sf_dir, "documents").select("doc_id", F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z0-9! ]+", " "), " +", " ")).alias("clean"))


@query()
def locale_order(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name", F.collate("n_name", "zh_Hans_CHN").alias("c")).orderBy("c").select("n_name")


@query("""SELECT l_orderkey, arg_max(l_suppkey, struct_pack(s := ok, n := q, c := cand, k := l_linenumber, p := l_suppkey)) AS kept FROM (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_returnflag = 'A' AS INTEGER) AS ok,
  l_quantity AS q, CAST(l_linestatus = 'F' AS INTEGER) AS cand FROM lineitem) GROUP BY 1""")
def keep_best(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", F.struct((F.col("l_returnflag") == "A").cast("int").alias("s"), F.col("l_quantity").alias("n"), (F.col("l_linestatus") == "F").cast("int").alias("c"), "l_linenumber", "l_suppkey").alias("rank"))
    return t.groupBy("l_orderkey").agg(F.max_by("l_suppkey", "rank").alias("kept"))
