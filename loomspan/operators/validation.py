"""Delivery checks: each a DataFrame of violations, counted in one long table; and the state they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import text as T

#: Kinds of records, states, and the patterns that raw text is searched for.
STRUCTURED, EXCEPTIONAL, RAW_TABLE = ("检测结果明细", "检测项目"), ("异常", "下载异常", "解析异常"), "报告信息/表格原文"
DONE = ("已解析", "已解析（OCR）", "succeeded", "success", "complete", "completed")
DOWNLOADED, PENDING_NAME = ("ok", "cached", "downloaded"), "机构名称待确认"
MARKS, DATES = ("有", "未发现", "待复核"), ("已识别", "未发现", "待复核")
COMPLETE, PARTLY, REFUSED = "完整通过", "部分完成", "校验失败"
CAS = r"(?<!\d)(\d{2,7}-\d{2}-\d)(?!\d)"
LIMIT = r"(?i)(?:报告限|检出限|检测限|定量限|LOD|LOQ)\s*[：:=]?\s*[<>≤≥＜＞]?\s*\d"
STANDARD, OUTCOME = r"(?i)(?:GB|FZ|ISO|QB|AATCC|EN)[/T\s]*\d", "符合|合格|通过"
IDENTITY = ("url", "sku", "color", "source_sheet", "source_row", "source_cell", "sample_type")


def text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def confirmed(status: Column) -> Column:
    return (status == "已确认") | status.startswith("自动归并") | status.startswith("自动归入") | (status == "自动新增")


def own_rules(table: str) -> list[tuple[str, bool, Column]]:
    """(rule, blocking, what breaks it) of the rules that a row of ``records``, ``sources``, ``downloads`` or ``metadata`` breaks by itself."""
    kind = text("record_type")
    structured = kind.isin(*STRUCTURED)
    raw = F.concat_ws(" ", F.nullif(text("raw_item"), F.lit("")), F.nullif(text("raw_row"), F.lit("")))
    # A check digit tells a number from a date; white space is kept, so that neighbours don't grow together.
    has_cas = F.exists(F.regexp_extract_all(raw, F.lit(CAS), 1), T.cas_valid)
    date, date_state, reason = text("issue_date"), text("date_status"), text("date_reason")
    unproven = lambda m, e: F.coalesce(F.col(m).isin("未发现", "待复核"), F.lit(False)) & (text(e) == "")
    rules = {
        "records": [
            ("V-1 blank item", structured & ((text("raw_item") == "") | (text("parent") == ""))),
            ("V-2 unconfirmed in overview", T.truthy(text("include")) & ~confirmed(text("status"))),
            ("V-3 parent name", (text("parent") != "") & (~T.semantic(text("parent")) | text("parent").rlike(r"[\p{Cc}\p{Co}]"))),
            ("V-4 unstructured raw row", (kind == RAW_TABLE) & text("raw_row").rlike(r"^\d+\s*\|") & text("raw_row").rlike(STANDARD) & text("raw_row").rlike(OUTCOME)),
            ("V-5 CAS number missing", has_cas & (text("cas_number") == "")),
            ("V-6 detection limit missing", raw.rlike(LIMIT) & (text("detection_limit") == "")),
            ("V-10 institution pending", structured & (text("institution") == PENDING_NAME)),
        ],
        "metadata": [
            ("V-11 mark value", ~F.coalesce(F.col("cma_mark").isin(*MARKS) & F.col("cnas_mark").isin(*MARKS), F.lit(False))),
            ("V-12 issue date", ~date_state.isin(*DATES) | ((date == "") & (reason == "")) | ((date_state != DATES[0]) & (reason == ""))),
            ("V-13 mark evidence", unproven("cma_mark", "cma_evidence") | unproven("cnas_mark", "cnas_evidence")),
            ("V-14 institution blank", text("institution").isin("", PENDING_NAME)),
        ],
        "sources": [("V-18 relationship without id", text("source_relationship_id") == "")],
        "downloads": [("V-23 failed downloads", ~F.coalesce(F.col("status").isin(*DOWNLOADED), F.lit(False)))],
    }
    return [(rule, rule != "V-23 failed downloads", F.coalesce(broken, F.lit(False))) for rule, broken in rules[table]]


def joint_rules(records: DataFrame, sources: DataFrame, downloads: DataFrame, metadata: DataFrame) -> list[tuple[str, bool, DataFrame]]:
    """(rule, blocking, rows that break it) of the rules that compare tables."""
    kind = text("record_type")
    exceptional = records.filter(kind.isin(*EXCEPTIONAL))
    good = downloads.filter(F.col("status").isin(*DOWNLOADED) & (text("url") != "")).select("url").distinct()
    failed = downloads.filter(~F.coalesce(F.col("status").isin(*DOWNLOADED), F.lit(False)))
    own = sources.select(F.col("source_relationship_id").alias("known_id"), F.struct(*[text(c).alias(c) for c in IDENTITY]).alias("known"), F.col("process_status").alias("known_status")).filter("known_id <> ''").dropDuplicates(["known_id"])
    both = records.filter(kind.isin(*STRUCTURED, *EXCEPTIONAL))
    # Rules of trace and of process look at the same source of a record: joined once.
    traced = both.join(own, F.col("source_relationship_id") == F.col("known_id"), "left")
    same = F.col("known").eqNullSafe(F.struct(*[text(c).alias(c) for c in IDENTITY]))
    lost = F.col("known_id").isNull() | ~same
    blank = (text("sku") == "") | (text("color") == "") | (text("url") == "")
    process = text("process_status")
    unfinished = traced.filter(((process != "") & ~process.isin(*DONE)) | ((process == "") & kind.isin(*STRUCTURED) & (F.coalesce("known_status", F.lit("")) == ""))).join(good, "url", "left_semi")
    covered = both.filter("source_relationship_id <> ''").select(F.col("source_relationship_id")).distinct()
    urls = records.filter(text("url") != "").select("url").distinct()
    return [
        ("V-7 structured trace", True, traced.filter(kind.isin(*STRUCTURED) & (lost | blank))),
        ("V-8 exception trace", True, traced.filter(kind.isin(*EXCEPTIONAL) & lost)),
        ("V-9 process unfinished", True, unfinished),
        ("V-15 failure without exception", True, failed.select("url").distinct().join(exceptional.select("url").distinct(), "url", "left_anti").filter("url <> ''")),
        ("V-16 download without record", True, downloads.select("url").distinct().filter("url <> ''").join(urls, "url", "left_anti")),
        ("V-17 record without download", True, urls.join(downloads.select("url").distinct(), "url", "left_anti")),
        ("V-19 relationship not covered", True, sources.select("source_relationship_id").filter("source_relationship_id <> ''").distinct().join(covered, "source_relationship_id", "left_anti")),
        ("V-20 metadata missing", True, good.join(metadata.select("url").distinct(), "url", "left_anti")),
        ("V-21 relationship unfinished", True, sources.join(good, "url", "left_semi").filter(~process.isin(*DONE))),
    ]


def _none(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).filter("n = 0")


def violations(records: DataFrame, sources: DataFrame, downloads: DataFrame, metadata: DataFrame) -> list[tuple[str, bool, DataFrame]]:
    """(rule, blocking, rows that break it).

    records: record_type, source_relationship_id, IDENTITY, raw_item, parent, status, include, process_status, institution, raw_row, cas_number,
    detection_limit. sources: source_relationship_id, IDENTITY, process_status. downloads: url, status, error. metadata: url, institution,
    cma_mark, cnas_mark, cma_evidence, cnas_evidence, issue_date, date_status, date_reason. A CAS number counts only with its check digit."""
    tables = {"records": records, "metadata": metadata, "sources": sources, "downloads": downloads}
    own = [(rule, blocking, df.filter(broken)) for name, df in tables.items() for rule, blocking, broken in own_rules(name)]
    structured = records.filter(text("record_type").isin(*STRUCTURED))
    empty = [(f"V-22 {what} empty", True, _none(df)) for what, df in (("records", records), ("structured records", structured), ("relationships", sources), ("downloads", downloads))]
    return [*own, *joint_rules(records, sources, downloads, metadata), *empty]


def _counted(df: DataFrame, table: str) -> DataFrame:
    """rule, blocking, n of a table's own rules, and whether the table is empty: one pass."""
    rules = own_rules(table)
    empty = {"records": "records", "sources": "relationships", "downloads": "downloads"}.get(table)
    counts = [F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)]
    one = df.agg(F.count(F.lit(1)).alias("_all"), F.count_if(text("record_type").isin(*STRUCTURED)).alias("_structured") if table == "records" else F.lit(1).cast("long").alias("_structured"), *counts)
    found = [F.struct(F.lit(rule).alias("rule"), F.lit(blocking).alias("blocking"), F.col(f"_{i}").alias("n")) for i, (rule, blocking, _) in enumerate(rules)]
    if empty:
        found.append(F.struct(F.lit(f"V-22 {empty} empty").alias("rule"), F.lit(True).alias("blocking"), (F.col("_all") == 0).cast("long").alias("n")))
    if table == "records":
        found.append(F.struct(F.lit("V-22 structured records empty").alias("rule"), F.lit(True).alias("blocking"), (F.col("_structured") == 0).cast("long").alias("n")))
    return one.select(F.explode(F.array(*found)).alias("r")).select("r.*")


def validate(records: DataFrame, sources: DataFrame, downloads: DataFrame, metadata: DataFrame) -> DataFrame:
    """rule, blocking, n: one pass over each table for the rules of its own rows, and one small job for each rule that compares tables."""
    tables = {"records": records, "metadata": metadata, "sources": sources, "downloads": downloads}
    out = None
    parts = [_counted(df, name) for name, df in tables.items()]
    parts += [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), F.lit(blocking).alias("blocking"), "n") for rule, blocking, rows in joint_rules(records, sources, downloads, metadata)]
    for one in parts:
        out = one if out is None else out.unionAll(one)
    return out


def delivery_state(metrics: DataFrame, allow_partial: bool = False) -> str:
    """COMPLETE, PARTLY (failed downloads, where allowed) or REFUSED; only the first permits delivery."""
    r = metrics.agg(F.coalesce(F.sum(F.when(F.col("blocking"), F.col("n"))), F.lit(0)).alias("blocked"), F.coalesce(F.sum(F.when(~F.col("blocking"), F.col("n"))), F.lit(0)).alias("failed")).first()
    if r["blocked"] or (r["failed"] and not allow_partial):
        return REFUSED
    return PARTLY if r["failed"] else COMPLETE


def failure_reasons(downloads: DataFrame) -> DataFrame:
    """Failed downloads by the part of their error before the first colon, 80 characters of it."""
    error = text("error")
    reason = F.when(error == "", F.coalesce(F.nullif(text("status"), F.lit("")), F.lit("unknown"))).otherwise(F.substring(F.substring_index(error, ":", 1), 1, 80))
    return downloads.filter(~F.coalesce(F.col("status").isin(*DOWNLOADED), F.lit(False))).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
