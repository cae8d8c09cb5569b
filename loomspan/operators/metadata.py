"""What a report says of itself: number, date, institution, marks with their evidence, codes; one row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import extract as X
from loomspan.functions.text import compact

#: States of the header and of a mark, and the texts of a mark's evidence.
DONE, NO_OCR, FAILED_HEADER = "已完成", "OCR未启用", "失败"
PRESENT, ABSENT, REVIEW = "有", "未发现", "待复核"
MARKS = ("CMA", "CNAS")
UNKNOWN_INSTITUTION = "未识别"
#: Labels that are printed with blanks between their characters, and those of codes.
SPACED = ("货号", "款号", "版单号", "面料编号", "物料编号", "料号")
CODE_LABELS, PLATE_LABELS, MATERIAL_LABELS = r"(?:报告内)?货号|款号", "版单号", "面料编号|物料编号|料号"
PLATE_STOPS = ("面料编号", "物料编号", "料号", "年/季度", "年季度", "码段/号型", "使用用途", "批次号", "颜色", "样品描述", "判定标准")
PLATE = r"[A-Za-z0-9]+(?:\s*[-/_]\s*[A-Za-z0-9]+|\s+\d[A-Za-z0-9]*)*"


def mark_text(text: Column, mark: str) -> Column:
    """Whether the mark stands in a text as a word of its own."""
    return F.coalesce(text, F.lit("")).rlike(rf"(?i)(?<![A-Z0-9]){mark}(?![A-Z0-9])")


def mark_evidence(d: Column, mark: str) -> Column:
    """Struct of state and note of a mark, by a ladder of evidence on a document's texts: full, top, header_ocr, number and token (CMA only), source, header_*, has_blocks, ocr_*."""
    full, top = F.coalesce(d["full"], F.lit("")), F.coalesce(d["top"], F.lit(""))
    number = F.coalesce(d["number"], F.lit("")) if mark == "CMA" else F.lit("")
    on_top = (number != "") | X.states_mark(top, mark)
    scope = F.when((F.coalesce(d["header_ocr"], F.lit("")) != "") & mark_text(d["header_ocr"], mark), "首页顶部报告头OCR").when(on_top, "顶部区域OCR").when(d["source"] == "vision_ocr", "OCR全文").otherwise("PDF原生文本")
    seen = F.substring(F.when(on_top, top).otherwise(F.regexp_replace(F.substring(full, 1, 500), r"(?U)\s+", " ")), 1, 180)
    denied = full.rlike(rf"(?i)(?:未|不|暂未).{{0,12}}{mark}|{mark}.{{0,12}}(?:未授权|不适用|未获得)")
    status, error, ocr_error = (F.coalesce(d[n], F.lit("")) for n in ("header_status", "header_error", "ocr_error"))
    text = lambda *x: F.concat(*[v if isinstance(v, Column) else F.lit(v) for v in x])
    answer = lambda state, *note: F.struct(F.lit(state).alias("state"), text(state, "｜", *note).alias("note"))
    return (
        F.when(number != "", answer(PRESENT, "首页顶部报告头OCR识别到CMA组合证据：图形字母识别为", F.coalesce(d["token"], F.lit("")), "，其下方同水平位置识别到资质编号", number))
        .when(on_top | X.states_mark(full, mark), answer(PRESENT, scope, f"识别到{mark}标识证据：", seen))
        .when(F.coalesce(d["header_attempted"], F.lit(False)) & (error != ""), answer(REVIEW, f"{mark}未在文本中识别，首页顶部报告头OCR失败：", error))
        .when(status == NO_OCR, answer(REVIEW, f"{mark}未在原生文本中识别，且首页顶部报告头OCR未启用"))
        .when(denied & (status == DONE), answer(ABSENT, f"仅识别到{mark}未授权/未获得/不适用说明，首页报告头也无强标识证据"))
        .when(status == DONE, answer(REVIEW, f"首页顶部报告头OCR已完成，但未获得{mark}强文字或图章组合证据，不能据此确认未出现"))
        .when(F.coalesce(d["has_blocks"], F.lit(False)), answer(ABSENT, f"PDF原生文本、OCR全文及每页顶部区域均未识别到{mark}标识"))
        .when(F.coalesce(d["ocr_attempted"], F.lit(False)) & (ocr_error != ""), answer(REVIEW, f"{mark}未在文本中识别，且OCR失败：", ocr_error))
        .otherwise(answer(REVIEW, "PDF原生文本/缓存文本未识别到", f"{mark}标识，且未完成有效顶部图像检查"))
    )


def spaced_labels(text: Column) -> Column:
    """Labels without the blanks between their characters."""
    for label in SPACED:
        text = F.regexp_replace(text, r"(?U)" + r"\s*".join(label), label)
    return text


def codes(text: Column, labels: str) -> Column:
    """Distinct codes behind a label: letters, digits and joints, at least one digit or joint."""
    return X.labelled_values(text, labels)


def plates(text: Column) -> Column:
    """Codes behind 版单号 on its line, up to the next label or the first Chinese word."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n"), lambda x: F.contains(x, F.lit(PLATE_LABELS)))
    behind = F.transform(lines, lambda x: F.regexp_replace(F.regexp_extract(x, rf"(?U){PLATE_LABELS}\s*[:：]?\s*(.*)$", 1), f"(?:{'|'.join(PLATE_STOPS)}).*$", ""))
    return F.array_distinct(F.filter(F.transform(behind, lambda x: compact(F.regexp_extract(x, f"^({PLATE})", 1))), lambda x: x != ""))


def top_texts(documents: DataFrame, blocks: DataFrame) -> DataFrame:
    """url, top: header texts of the document and what is recognised in the top band of its pages, from left to right."""
    band = X.top_band(blocks).filter("trim(text) <> ''").groupBy("url", "page").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("x", F.lit(0.0)).alias("x"), F.trim("text").alias("text")))).alias("t"))
    line = F.concat(F.lit("第"), F.col("page").cast("string"), F.lit("页顶部："), F.array_join(F.transform("t", lambda b: b["text"]), " "))
    lines = band.groupBy("url").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", line.alias("line")))), lambda b: b["line"]), "\n").alias("bands"))
    head = lambda label, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
    joined = documents.select("url", "header_native_text", "header_ocr_text").join(lines, "url", "left")
    return joined.select("url", F.concat_ws("\n", head("首页顶部原生文本：", "header_native_text"), head("首页顶部报告头：", "header_ocr_text"), "bands").alias("top"))


def report_metadata(documents: DataFrame, pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per document.

    documents: url, report_no, text_source, header_native_text, header_ocr_text, header_parse_attempted, header_parse_status, header_parse_error, ocr_attempted, ocr_error;
    pages: url, page, text; blocks: url, page, ord, text, confidence, x, mid_x, mid_y, width, header (of the first page's head). A document without pages or blocks has what is left; of
    several rows of one url the least counts."""
    own = documents.groupBy("url").agg(F.min(F.struct(*[c for c in documents.columns if c != "url"])).alias("d")).select("url", "d.*")
    texts = pages.groupBy("url").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))), lambda p: p["text"]), "\n").alias("full"))
    heads = X.mark_numbers(blocks.filter("header"), ("url",)).select("url", "number", F.col("mark").alias("token"))
    seen = blocks.groupBy("url").agg(F.lit(True).alias("has_blocks"))
    header_pages = own.select("url", F.lit(0).alias("page"), F.concat_ws("\n", "header_native_text", "header_ocr_text").alias("text")).filter("text <> ''")
    named = X.institutions(header_pages).withColumnRenamed("institution", "_header").join(X.institutions(pages).withColumnRenamed("institution", "_body"), "url", "full_outer")
    out = own
    for side in (texts, top_texts(own, blocks), heads, seen, X.issue_dates(pages), named):
        out = out.join(side, "url", "left")
    d = F.struct("full", "top", F.col("header_ocr_text").alias("header_ocr"), "number", "token", F.col("text_source").alias("source"), F.col("header_parse_attempted").alias("header_attempted"), F.col("header_parse_status").alias("header_status"),
                 F.col("header_parse_error").alias("header_error"), "has_blocks", "ocr_attempted", "ocr_error")
    out = out.withColumn("_d", d).withColumn("_labelled", spaced_labels(F.coalesce("full", F.lit(""))))
    marks = [mark_evidence(F.col("_d"), m) for m in MARKS]
    return out.select(
        "url", X.report_number(F.col("full"), F.coalesce("report_no", F.lit(""))).alias("report_no"), F.col("issue_date").alias("report_issue_date"), F.coalesce("status", F.lit(X.NOT_FOUND)).alias("report_issue_date_status"),
        F.col("label").alias("report_issue_date_label"), F.col("reason").alias("report_issue_date_reason"), F.coalesce("_header", "_body", F.lit(UNKNOWN_INSTITUTION)).alias("institution"),
        F.when(F.col("_header").isNotNull(), "首页顶部报告头").when(F.col("_body").isNotNull(), "报告全文或重复页脚文本").otherwise(UNKNOWN_INSTITUTION).alias("institution_source"),
        *[marks[i][f].alias(f"{m.lower()}_{n}") for i, m in enumerate(MARKS) for f, n in (("state", "mark"), ("note", "evidence"))],
        codes(F.col("_labelled"), CODE_LABELS).alias("report_product_codes"), plates(F.col("_labelled")).alias("plate_numbers"), codes(F.col("_labelled"), MATERIAL_LABELS).alias("material_numbers"),
    )


def header_state(documents: DataFrame, pages: DataFrame, version: str) -> DataFrame:
    """Adds ``header_step`` to documents (url, header_parser_version, header_parse_status, header_native_text, header_ocr_blocks, path, ocr_enabled): what their header still needs.

    done: read by this version and neither failed nor waiting for recognition; resolved: the page text says enough; blocks: recognised blocks are there; disabled; render: its first page has to be
    recognised; failed: there is no file. ``header_native_text`` is filled from the first 35 lines of the first page."""
    first = pages.groupBy("url").agg(F.min_by("text", "page").alias("_first"), F.array_join(F.collect_list("text"), "\n").alias("_all"))
    told = documents.join(first, "url", "left")
    native = F.when(F.coalesce("header_native_text", F.lit("")) != "", F.col("header_native_text")).otherwise(F.array_join(F.slice(F.split(F.coalesce("_first", F.lit("")), r"\r\n|\n|\r"), 1, 35), "\n"))
    told = told.withColumn("header_native_text", native)
    named = X.institutions(told.select("url", F.lit(0).alias("page"), F.col("header_native_text").alias("text"))).withColumnRenamed("institution", "_named")
    told = told.join(named, "url", "left")
    enough = F.col("_named").isNotNull() & mark_text(F.col("_all"), "CMA") & mark_text(F.col("_all"), "CNAS")
    done = F.coalesce(F.col("header_parse_attempted"), F.lit(False)) & (F.coalesce("header_parser_version", F.lit("")) == version) & ~F.coalesce("header_parse_status", F.lit("")).isin(FAILED_HEADER, NO_OCR)
    step = (
        F.when(done, "done").when(enough, "resolved").when(F.coalesce("header_ocr_blocks", F.lit(0)) > 0, "blocks").when(~F.coalesce("ocr_enabled", F.lit(False)), "disabled")
        .when(F.coalesce("path", F.lit("")) == "", "failed").otherwise("render")
    )
    return told.select(*documents.columns, step.alias("header_step"))
