"""What report headers say: numbers, dates, marks and institutions, from pages and recognised blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions.text import compact

#: States, labels by priority, and the words of institutions.
FOUND, NOT_FOUND, REVIEW = "已识别", "未发现", "待复核"
MARKED = "有"
DATE_LABELS = (("报告签发日期", r"(?:报告)?签发日期"), ("出具日期", r"(?:出具日期|Date\s+of\s+Issue)"), ("报告日期", r"报告日期"), ("检测日期", r"(?:样品)?(?:检测日期|检验日期)"))
NEXT_LABEL = (
    r"(?:报告)?签发日期|出具日期|Date\s+of\s+Issue|报告日期|样品日期|收样日期|送样日期|来样日期|接收日期|收件日期|生产日期|委托日期|有效期|截止日期"
    r"|(?:样品)?(?:检测日期|检验日期)|(?:检测|检验|测试)(?:开始|结束)日期"
)
DATE = r"20\s*\d{2}\s*[年./-]\s*\d{1,2}\s*[月./-]\s*\d{1,2}\s*日?"
REPORT_NUMBERS = (r"报告[编編]号\s*[：:]?\s*([A-Z0-9-]{6,})", r"(TTTS[-–—]?WT\d{8,})", r"\b(W0\d{10,})\b", r"\b(W\d{8,})\b", r"\b(TNL\d{8,}[A-Z]?)\b", r"\b((?=[A-Z0-9_-]*\d)[A-Z]{2,8}[-_]?[A-Z0-9-]{6,})\b")
NOT_NUMBERS = ("INSPECTION", "REPORT", "CATEGORY", "SAMPLENAME")
INSTITUTION_TERMS = ("检测", "检验", "测试", "试验", "实验室", "认证", "计量", "质量技术服务", "质检")
INSTITUTION_SUFFIXES = ("检测实验室", "检验实验室", "质量中心检测部", "检验检测中心", "质量检验中心", "纤维检验中心", "检测中心", "检验中心", "测试中心", "研究院有限公司", "集团有限公司", "股份有限公司", "有限公司", "研究院", "实验室", "中心检测部")
INSTITUTION_EXCLUSIONS = ("委托单位", "委托方", "送检单位", "受检单位", "被检单位", "申请单位", "申请人", "客户", "生产单位", "生产者", "标称生产企业", "供应商", "制造商", "附设机构", "分包机构", "分包实验室", "未经", "复制报告", "无效", "本中心批准")
MARK_TOKENS = ("CMA", "MA", "MMA")
TOP_BAND, LEAST_MARK, LEAST_NUMBER, LEAST_OVERLAP, MOST_APART, MOST_BELOW = 0.68, 0.25, 0.8, 0.25, 0.04, 0.15


def report_number(text: Column, fallback: Column, brands: Sequence[str] = ()) -> Column:
    """The first pattern that gives a number, on the text and then without white space; else a fallback that holds a digit. ``brands``: names in capitals that are no numbers."""
    tries, no_numbers = [], [*NOT_NUMBERS, *brands]
    for source in (F.coalesce(text, F.lit("")), compact(text)):
        for pattern in REPORT_NUMBERS:
            all_ = F.transform(F.regexp_extract_all(source, F.lit("(?i)" + pattern), 1), lambda x: F.translate(compact(x), "—–", "--"))
            first = F.get(all_, 0)
            tries.append(F.when(first.isNotNull() & ~F.upper(first).isin(*no_numbers), first))
    other = compact(fallback)
    usable = other.rlike(r"\d") & ~other.rlike("(?i)^[0-9a-f]{32,64}$") & ~F.upper(other).isin("", *brands)
    return F.coalesce(*tries, F.when(usable, other), F.lit(""))


def _calendar(token: Column) -> Column:
    part = lambda i: F.regexp_extract(token, r"(20\s*\d{2})\s*[年./-]\s*(\d{1,2})\s*[月./-]\s*(\d{1,2})", i)
    return F.try_to_date(F.concat_ws("-", F.regexp_replace(part(1), r"\s+", ""), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0")), "yyyy-MM-dd")


def _candidates(text: Column, label: str) -> Column:
    """Dates that follow a label: up to 100 characters, to the next label, and not beyond what ends the first date's phrase.

    Array of (token, date); of a range the end counts."""
    split = F.split(F.coalesce(text, F.lit("")), "(?i)" + label)
    windows = F.transform(F.slice(split, 2, F.greatest(F.size(split) - 1, F.lit(0))), lambda x: F.get(F.split(F.substring(x, 1, 100), "(?i)" + NEXT_LABEL, 2), 0))
    # Behind the first date a separator or a further label of a date ends the phrase.
    ended = F.transform(windows, lambda x: F.regexp_replace(x, rf"(?is)^(.*?{DATE})(.*?)(?:[；;。\n]|[一-鿿]{{1,12}}日期\s*[:：]?).*$", "$1$2"))
    tokens = F.flatten(F.transform(ended, lambda x: F.regexp_extract_all(x, F.lit(rf"({DATE}(?:\s*(?:至|到|~|～|-|—)\s*{DATE})?)"), 1)))
    last = F.transform(tokens, lambda x: F.regexp_extract(x, rf"({DATE})$", 1))
    return F.transform(last, lambda x: F.struct(F.regexp_replace(x, r"\s+", "").alias("token"), _calendar(x).alias("date")))


def issue_dates(pages: DataFrame) -> DataFrame:
    """pages: url, page, text. One row per url: issue_date, status, label, reason.

    Labels by priority; the first page first, the others only if it has no valid date under the label; of several valid
    dates the latest. Without any, invalid ones leave the date open for review."""
    labels = F.array(*[F.struct(F.lit(i).alias("priority"), F.lit(name).alias("label"), _candidates(F.col("text"), pattern).alias("found")) for i, (name, pattern) in enumerate(DATE_LABELS)])
    first = F.col("page") == F.min("page").over(W.partitionBy("url"))
    rows = pages.withColumn("later", (~first).cast("int")).select("url", "page", "later", F.explode(labels).alias("l"))
    rows = rows.select("url", "page", "later", "l.priority", "l.label", F.explode("l.found").alias("c")).select("url", "page", "later", "priority", "label", "c.token", "c.date")
    valid = rows.filter("date is not null").groupBy("url", "priority", "label", "later").agg(F.max("date").alias("date"), F.min_by("page", F.struct(F.negative(F.unix_date("date")), "page")).alias("page"), F.count_distinct("date").alias("n"))
    best = valid.groupBy("url").agg(F.min_by(F.struct("date", "label", "page", "n", "later"), F.struct("priority", "later")).alias("b"))
    bad = rows.filter("date is null").groupBy("url").agg(F.min_by("label", F.struct("priority", "later", "page")).alias("bad_label"), F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("priority", "later", "page", "token"))), lambda x: x["token"])), "；").alias("bad"))
    out = pages.select("url").distinct().join(best, "url", "left").join(bad, "url", "left")
    rejected = F.concat(F.lit("非法日历日期："), F.col("bad"))
    reason = (
        F.when(F.col("b.n") > 1, F.concat(F.lit(FOUND), F.lit("｜同一优先级出现多个日期，采用较晚日期")))
        .when(F.col("b").isNotNull(), F.concat(F.lit(FOUND), F.lit("｜"), F.when(F.col("b.later") == 0, "首页").otherwise("全文"), F.lit("第"), F.col("b.page").cast("string"), F.lit("页"), F.col("b.label")))
        .when(F.col("bad").isNotNull(), F.concat(F.lit(REVIEW), F.lit("｜日期字段仅包含非法日期候选："), rejected))
        .otherwise(F.lit(NOT_FOUND + "｜首页及全文未找到日期"))
    )
    status = F.when(F.col("b").isNotNull(), FOUND).when(F.col("bad").isNotNull(), REVIEW).otherwise(NOT_FOUND)
    return out.select("url", F.col("b.date").alias("issue_date"), status.alias("status"), F.coalesce("b.label", "bad_label", F.lit("")).alias("label"), reason.alias("reason"))


def top_band(blocks: DataFrame, least: float = TOP_BAND) -> DataFrame:
    return blocks.filter(F.coalesce("mid_y", F.lit(0.0)) >= least)


def mark_numbers(blocks: DataFrame, by: tuple[str, ...] = ("url", "page")) -> DataFrame:
    """First mark in block order with the first 12-digit number aligned below it: by, mark, number. blocks: by, ord, text, confidence, mid_x, mid_y, width."""
    token = F.regexp_replace(F.upper(F.coalesce("text", F.lit(""))), "[^A-Z]", "")
    marks = blocks.filter(token.isin(*MARK_TOKENS) & (F.col("confidence") >= LEAST_MARK)).select(*by, F.col("ord").alias("m_ord"), F.col("text").alias("mark"), F.col("mid_x").alias("mx"), F.col("mid_y").alias("my"), F.coalesce("width", F.lit(0.0)).alias("mw"))
    digits = F.filter(F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?<!\d)((?:\d[\s._-]*){10,12})(?!\d)"), 1), lambda x: F.regexp_replace(x, r"\D", "")), lambda x: F.length(x) == 12)
    numbers = blocks.filter(F.col("confidence") >= LEAST_NUMBER).select(*by, F.col("ord").alias("n_ord"), F.col("mid_x").alias("nx"), F.col("mid_y").alias("ny"), F.coalesce("width", F.lit(0.0)).alias("nw"), F.posexplode(digits).alias("n_pos", "number"))
    overlap = F.greatest(F.lit(0.0), F.least(F.col("mx") + F.col("mw") / 2, F.col("nx") + F.col("nw") / 2) - F.greatest(F.col("mx") - F.col("mw") / 2, F.col("nx") - F.col("nw") / 2))
    beside = F.when((F.col("mw") > 0) & (F.col("nw") > 0), overlap / F.nullif(F.least("mw", "nw"), F.lit(0.0)) >= LEAST_OVERLAP).otherwise(F.abs(F.col("mx") - F.col("nx")) <= MOST_APART)
    below = (F.col("my") - F.col("ny")).between(0, MOST_BELOW)
    joined = marks.join(numbers, list(by)).filter(beside & below)
    return joined.groupBy(*by).agg(F.min_by(F.struct("mark", "number"), F.struct("m_ord", "n_ord", "n_pos")).alias("hit")).select(*by, "hit.mark", "hit.number")


def states_mark(text: Column, mark: str) -> Column:
    """The mark stands in the text and is not denied within 18 characters before or 24 behind."""
    near = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?is)((?:^|.{{0,17}}[^A-Za-z0-9]){mark}(?:[^A-Za-z0-9].{{0,23}}|$))"), 1)
    denied = rf"(?i)(?:未|不|暂未).{{0,12}}{mark}|{mark}.{{0,12}}(?:未授权|不适用|未获得)"
    return F.exists(near, lambda x: ~x.rlike(denied))


def labelled_values(text: Column, labels: str, value: str = r"[A-Za-z0-9]+(?:\s*[-/_]\s*[A-Za-z0-9]+)*") -> Column:
    """Distinct values behind a label, without white space, in order."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?:{labels})\s*[：:]?\s*({value})"), 1)
    return F.array_distinct(F.transform(found, compact))


def institutions(pages: DataFrame) -> DataFrame:
    """url -> institution: of first-page lines that name a testing institution, and neither it nor the line before says that it is
    somebody else's, the one with the longest legal form, most frequent, first."""
    first = pages.withColumn("f", F.min("page").over(W.partitionBy("url"))).filter("page = f")
    lines = first.select("url", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.withColumn("before", F.lag("line").over(W.partitionBy("url").orderBy("at")))
    name = F.regexp_extract(compact(F.col("line")), rf"([一-鿿（）()]{{2,40}}(?:{"|".join(INSTITUTION_SUFFIXES)}))", 1)
    ours = ~F.col("line").rlike("|".join(INSTITUTION_EXCLUSIONS)) & ~F.coalesce(F.col("before").rlike(rf"(?:{"|".join(INSTITUTION_EXCLUSIONS)})\s*[：:]?\s*$"), F.lit(False))
    named = lines.filter(ours).withColumn("institution", name).filter(F.col("institution").rlike("|".join(INSTITUTION_TERMS)))
    counted = named.groupBy("url", "institution").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at"))
    legal = F.when(F.col("institution").rlike("有限公司$"), 2).when(F.col("institution").rlike("(?:研究院|中心)$"), 1).otherwise(0)
    return counted.groupBy("url").agg(F.max_by("institution", F.struct(legal, F.length("institution"), "n", F.negative("at"))).alias("institution"))
