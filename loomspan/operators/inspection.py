"""From source rows to stable relationships, details, overview and exceptions of inspection reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import text as T
from loomspan.operators.relational import explode_lines, numbered, ordered_distinct_join, relationship_id, roll_up_verdict

#: Names that a source column goes by, the first that is there counts.
HEADERS = {
    "sku": ("商品编码", "SKU", "货号", "款号"), "color": ("颜色", "色号"), "url": ("检测报告", "报告链接", "PDF链接"), "season": ("季节", "季度"),
    "subcategory": ("小类",), "sample_type": ("样品类型", "样品"), "order_no": ("报告单号", "委托单号"), "overall_result": ("综合判定", "判定结果"), "modified_time": ("修改时间", "更新时间"),
}
REQUIRED = ("sku", "url")
#: Why a record can't be worked on, and which mappings count in the overview.
INVALID_SKU, NO_LINK = "SKU无效", "无PDF链接"
NOT_ELIGIBLE = ("待确认归属", "待复核", "解析残片")
BASIC, FUNCTIONAL, OTHER, OPEN = "基础检测", "功能性检测", "其他", "待分类"
FAIL_WORDS, PASS_WORDS, FAILED, PASSED = "不符合|不合格|不通过|未通过", "符合|合格|通过", "不合格", "合格"


def resolve_headers(columns: Sequence[str], required: Sequence[str] = REQUIRED) -> dict[str, str]:
    """Logical name -> column, by the first alias that is there; a missing required one is refused."""
    found = {name: next((a for a in aliases if a in columns), None) for name, aliases in HEADERS.items()}
    lost = [name for name in required if not found[name]]
    if lost:
        raise ValueError(f"no column for {', '.join(lost)}; there are {', '.join(columns)}")
    return {k: v for k, v in found.items() if v}


def source_records(sheet: DataFrame, season: str = "all") -> DataFrame:
    """Rows of a sheet (with source_sheet, source_row) under their logical names, repeated headers and other seasons left out,
    and invalid_reason: empty for those that can be worked on."""
    names = resolve_headers(sheet.columns)
    cells = [T.cell_text(F.col(f"`{names[k]}`")).alias(k) if k in names else F.lit("").alias(k) for k in HEADERS]
    rows = sheet.select("source_sheet", "source_row", *cells).filter(F.col("sku") != names["sku"])
    if season != "all":
        rows = rows.filter(F.col("season") == season)
    urls = T.split_urls(F.col("url"))
    reason = F.when(T.invalid_sku(F.col("sku")), INVALID_SKU).when(F.size(urls) == 0, NO_LINK).otherwise("")
    return rows.select("source_sheet", "source_row", *[k for k in HEADERS if k not in ("url", "color")], F.col("url").alias("url_text"), urls.alias("urls"), T.split_colours(F.col("color")).alias("colors"), reason.alias("invalid_reason"))


def relationships(records: DataFrame, workbook: str = "") -> DataFrame:
    """Record x link x colour with a stable id; a record without a link keeps one row for each colour."""
    rows = records.withColumn("url", F.explode(F.when(F.size("urls") == 0, F.array(F.lit(""))).otherwise(F.col("urls")))).withColumn("color", F.explode("colors"))
    fields = [F.lit(workbook), F.col("source_sheet"), F.col("source_row"), F.coalesce(F.col("source_cell"), F.lit("")) if "source_cell" in records.columns else F.lit(""), F.col("url"), F.col("sku"), F.col("color"), F.col("sample_type")]
    return rows.select(relationship_id(*fields).alias("source_relationship_id"), *[c for c in rows.columns if c not in ("urls", "colors", "url_text")])


def work_list(rows: DataFrame) -> DataFrame:
    """Distinct links with the order of their first appearance as report index, from 1."""
    firsts = rows.filter("url <> '' and invalid_reason = ''").groupBy("url").agg(F.min(F.struct("source_sheet", "source_row")).alias("at"))
    return numbered(firsts, ["at", "url"], "report_index").select("url", F.col("report_index").cast("int").alias("report_index"))


def scope(rows: DataFrame, skus: Sequence[str] | None) -> DataFrame:
    """Rows of the requested SKUs; a malformed or unknown request is refused rather than widened."""
    if skus is None:
        return rows
    asked = list(dict.fromkeys(x.strip() for x in skus))
    known = {r["sku"] for r in rows.filter(F.col("sku").isin(asked)).select("sku").distinct().collect()}  # no more than were asked for
    if not asked or any(not x for x in asked) or set(asked) - known:
        raise ValueError(f"unknown SKUs: {sorted(set(asked) - known)}")
    return rows.filter(F.col("sku").isin(asked))


def verdict_of(*values: Column) -> Column:
    joined = F.concat_ws(" ", *[F.coalesce(v, F.lit("")) for v in values])
    return F.when(joined.rlike(FAIL_WORDS), FAILED).when(joined.rlike(PASS_WORDS), PASSED).otherwise("")


def classify(parent: Column, explicit: Column, functional_terms: Sequence[str], default: str = OPEN) -> Column:
    """An explicit class, else functional if the name holds one of the terms, else the default."""
    hit = F.lit(False)
    for term in functional_terms:
        hit = hit | F.contains(parent, F.lit(term))
    return F.when(F.coalesce(explicit, F.lit("")) != "", explicit).when(hit, FUNCTIONAL).otherwise(default)


def overview(details: DataFrame, exceptions: DataFrame) -> DataFrame:
    """One row per SKU. details: sku, url, report_no, parent, class, status, include, verdict, sample_type; exceptions: sku, url, report_no, sample_type, verdict.

    Parents count only if the row is included and its status is eligible; exceptions add reports, links, samples and verdicts."""
    eligible = F.col("include") & ~F.col("status").isin(*NOT_ELIGIBLE) & (F.col("parent") != "")
    own = details.select("sku", "url", "report_no", "sample_type", "verdict", F.when(eligible, F.col("parent")).alias("parent"), F.when(eligible, F.col("class")).alias("class"), F.col("status").isin(*NOT_ELIGIBLE).cast("long").alias("pending"), F.lit(False).alias("error"))
    bad = exceptions.select("sku", "url", "report_no", "sample_type", "verdict", F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("class"), F.lit(0).cast("long").alias("pending"), F.lit(True).alias("error"))
    rows = own.unionByName(bad)
    failed, passed = F.coalesce(F.col("verdict").rlike(FAIL_WORDS), F.lit(False)), F.coalesce(F.col("verdict").rlike(PASS_WORDS), F.lit(False))
    # A product is judged once, not with each of its rows: of an aggregate, as Spark would move a filter by the key itself before the grouping.
    said = rows.groupBy("sku", "verdict").agg(F.sum("pending").alias("pending"))
    totals = said.groupBy("sku").agg(roll_up_verdict(failed, passed, (FAILED, PASSED, "")).alias("verdict"), F.sum("pending").alias("n_pending"), F.max("sku").alias("named")).filter(~T.invalid_sku(F.col("named")))
    # Each value once, with what is asked of it: distinct counts side by side would shuffle every row whole, once for each of them.
    value = lambda kind, c, one=F.lit(False), two=F.lit(False): F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"), F.coalesce(one, F.lit(False)).alias("one"), F.coalesce(two, F.lit(False)).alias("two"))
    values = F.array(value("report", "report_no"), value("file", "url", F.col("error")), value("parent", "parent", F.col("class") == BASIC, F.col("class") == FUNCTIONAL), value("sample", "sample_type"))
    once = rows.select("sku", F.inline(values)).filter("value <> ''").groupBy("sku", "kind", "value").agg(F.max("one").alias("one"), F.max("two").alias("two"))
    number = lambda kind, which=F.lit(True): F.count_if((F.col("kind") == kind) & which)
    counts = once.groupBy(F.col("sku").alias("of")).agg(
        number("report").alias("n_reports"), number("file").alias("n_files"), number("parent").alias("n_parents"), number("parent", F.col("one")).alias("n_basic"), number("parent", F.col("two")).alias("n_functional"),
        number("sample").alias("n_samples"), number("file", F.col("one")).alias("n_error_files"),
    )
    n = lambda name: F.coalesce(name, F.lit(0).cast("long")).alias(name)
    before = [n(c) for c in ("n_reports", "n_files", "n_parents", "n_basic", "n_functional", "n_samples")]
    return totals.join(counts, F.col("sku").eqNullSafe(F.col("of")), "left").select("sku", *before, "verdict", "n_pending", n("n_error_files"))


def item_mapping(details: DataFrame, order: str) -> DataFrame:
    """First row of each (institution, raw_item, parent, child)."""
    key = ["institution", "raw_item", "parent", "child"]
    return details.groupBy(*key).agg(F.min_by("status", order).alias("status"), F.min(order).alias(order))


def display_value(parent: Column, child: Column, result: Column, verdict: Column) -> Column:
    """Result of a pass; result and verdict of a failure; prefixed by the child; null for a pass without a result."""
    value = F.when(verdict == FAILED, F.concat_ws("｜", F.when(result != "", result), verdict)).otherwise(F.when(result != "", result))
    return F.when(child != "", F.concat(child, F.lit("："), value)).otherwise(value)


def summary(details: DataFrame, order: str) -> DataFrame:
    """(sku, color, parent) -> display: distinct values in order of appearance, each with its reports' number where there are several; and conflict."""
    value = display_value(F.col("parent"), F.col("child"), F.col("result"), F.col("verdict"))
    rows = details.withColumn("value", value).filter("value is not null")
    per = rows.groupBy("sku", "color", "parent", "value").agg(F.count_distinct("report_no").alias("n"), F.min("report_no").alias("one"), F.min(order).alias(order))
    shown = per.withColumn("value", F.when(F.col("n") > 1, F.format_string("%s（%d份报告）", "value", "n")).otherwise(F.concat_ws(": ", F.when(F.col("one") != "", F.col("one")), F.col("value"))))
    joined = ordered_distinct_join(shown, ["sku", "color", "parent"], "value", order, "\n", "display")
    return joined.join(per.groupBy("sku", "color", "parent").agg((F.count_distinct("value") > 1).alias("conflict")), ["sku", "color", "parent"])


def processing_status(rows: Column, ocr: Column, page_errors: Column, download_failed: Column, file_missing: Column, chars: Column, ocr_failed: Column, has_page: Column, has_table: Column, rejected: Column, header: Column) -> Column:
    """Outcome of a document's extraction, the first that holds."""
    some = rows > 0
    return (
        F.when(some & ocr, "已解析（OCR）").when(some & page_errors, "部分解析").when(some, "已解析").when(download_failed, "下载失败").when(file_missing, "文件缺失")
        .when((chars < 300) & ocr_failed, "OCR失败").when((chars < 300) & ocr, "OCR未识别项目").when(chars < 300, "需OCR").when(~has_page, "无候选页").when(~has_table, "无表格")
        .when(rejected > 0, "项目名均被排除").when(~header, "表头未匹配").otherwise("未识别")
    )


def page_evidence(text: Column) -> Column:
    """Score of a page by five kinds of evidence; pages of fewer than 20 characters score 0, unknown ones are kept by the caller."""
    t = T.compact(text)
    kinds = ((r"检测项目|检验项目|测试项目|项目名称", 3), (r"技术要求|标准值|限值|要求", 2), (r"检测结果|实测值|测试结果|结果", 2), (r"单项判定|判定|结论", 2), (r"(?:GB|FZ|ISO|AATCC)[/T\s]*\d", 1))
    score = sum((F.when(t.rlike(p), F.lit(w)).otherwise(F.lit(0)) for p, w in kinds), F.lit(0))
    return F.when(F.length(t) < 20, 0).otherwise(score)


def detail_lines(documents: DataFrame) -> DataFrame:
    """(url, page, line_no, line) of documents given as (url, page, text)."""
    return explode_lines(documents, ["url", "page"], "text")
