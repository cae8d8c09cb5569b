"""Items and results read from single lines of a report, as column expressions and rule tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspan.functions.item_rules import Rule, literal
from loomspan.functions.text import squeeze
from loomspan.operators.rewrite import rewritten

#: Wording of a verdict, and results that are words.
VERDICTS, FAILED, PASSED, MEASURED = "不符合|不合格|符合|合格|通过", "不符合", "符合", "实测"
WORD_RESULTS = ("无异味", "无缺陷", "没有此项", "无明显变化")
NOT_FOUND, NOT_FOUND_FORM = "未检出", r"(?i)未检出|N\.?D\.?"
NUMBERED = r"(?U)^\s*\d{1,3}[.)、]?\s+"
THRESHOLD = "[≥≤≧≦<>～~]"
CITED = r"(?iU)(?:GB|FZ|QB|Q|ISO|AATCC|ASTM)[/\sA-Z.-]*\d[\d.:-]*"
VALUE = r"((?<![A-Za-z])[-+]?\d+(?:\.\d+)?(?:-\d+(?:\.\d+)?)?(?:%|cm|mm|mg/kg|N|g|级|根/m²)?)"
#: Items whose only number is their result, and wording that makes it something else.
DIRECT_ITEMS = ("pH值", "蓬松度", "绒子含量", "充绒量", "钻绒值", "胀破强度", "抗起毛球", "掉纤维程度")
NOT_DIRECT = r"(?i)标准|方法|温度|时间|次数|℃|V\d"
#: Wording of lines that name no item.
NOISE = (
    "报告编号", "报告日期", "委托单位", "样品名称", "商标", "地址", "电话", "检测日期", "收样日期", "检验结论", "二维码", "检验类别", "检测类别", "委托送样", "委托检测", "到样日期", "样品状态", "样品等级", "产品等级",
    "安全类别", "序号", "检测方法", "标准值", "实测值", "单项判定", "单项评价", "报告检测结果", "不确定度", "符合性判定", "符合性声明", "规定限值", "检测结果与符合性", "年份/季节", "样品信息", "产品信息", "见下表", "见下列",
    "检测類別", "委託检测", "樣品狀態", "所检项目", "所檢項目", "本报告", "本報告", "检验检测结论", "检验结果", "检测结果", "实测结果", "定量限", "型号", "规格", "年份", "季节", "样品描述", "产品名称", "产品号型",
    "执行的产品标准", "友情提醒", "声明", "备注", "符合检验要求", "符合检测要求", "整體評價",
)
SEE_TABLE = r"见下(?:\([^)]*\)|（[^）]*）)?表|见附表|详见.*表"
#: Where a name in a line ends.
STANDARD_BEGINS = r"(?iU)\b(?:GB|FZ|QB|ISO|AATCC|ASTM|SN|EN|JIS)[/\sA-Z.-]*\d.*$"
REQUIREMENT_WORDS = ("客户要求", "采购内控标准", "Q/", "≤", "≥", "<", ">", "＝", "=", "未检出", "mg/kg", "cm", "mm", "级")
NOT_NAMES = ("序号", "类别", "检测项目", "单项判定", "备注", "标准要求", "实测结果", "检验结论", "沾色", "变色", "色牢度")
SINGLE_NAMES, LONGEST = ("铅", "镉", "汞", "砷", "铬", "镍"), 28
#: Lines that open a list of items, name one, or end the list, and how many lines a list goes on.
OPENS = r"(?U)(?:序号\s*)?(?:检验|检测|测试)(?:项目|項目)|检验项目汇总|检测项目汇总|检测结果|檢測結果"
ONE_ITEM, NOT_ONE = r"(?U)^(?:检验|检测|测试)(?:项目|項目)\s+(.{2,60})$", ("汇总", "见附页", "见数据页")
CLOSES = ("判定依据", "检验依据", "检测依据", "检测结论", "检验结论", "备注", "声明", "注意事项", "签发日期", "批准", "审核", "编制")
ENDS_PAGE = r"(?iU)^(?:第\s*\d+\s*页|报告编号|样品照片|以下空白|—以下空白|DECLARATION)"
REACH = 120


def line_verdict(line: Column) -> Column:
    """不符合, 符合, 实测 or nothing."""
    return F.when(line.rlike("不符合|不合格"), FAILED).when(line.rlike("符合|合格|通过"), PASSED).when(line.rlike(MEASURED), MEASURED).otherwise("")


def _before_verdict(line: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(F.coalesce(line, F.lit("")), VERDICTS, 2), 1), NUMBERED, "")


def line_result(line: Column, item: Column) -> Column:
    """The measured result of a line: not found, a word, the last number behind a threshold, or the only number of an item that has no other. Years and long numbers are none."""
    before = _before_verdict(line)
    numbers = F.regexp_extract_all(F.regexp_replace(before, CITED, " "), F.lit(VALUE), 1)

    def usable(token: Column) -> Column:
        plain = F.regexp_replace(token, r"[^\d.]", "")
        year = plain.rlike(r"^\d+$") & F.coalesce(plain.try_cast("long").between(1900, 2100), F.lit(False))
        return ~((plain != "") & year) & (F.length(plain) < 7)

    left = F.filter(numbers, usable)
    word = F.lit(None).cast("string")
    for phrase in reversed(WORD_RESULTS):
        word = F.when(F.contains(before, F.lit(phrase)), F.lit(phrase)).otherwise(word)
    direct = item.isin(*DIRECT_ITEMS) & (F.size(left) == 1) & ~before.rlike(NOT_DIRECT)
    return (
        F.when(before.rlike(NOT_FOUND_FORM), NOT_FOUND).when(word.isNotNull(), word).when(F.size(left) == 0, "")
        .when(before.rlike(THRESHOLD), F.when(F.size(left) >= 2, F.element_at(left, -1)).otherwise("")).when(direct, F.element_at(left, 1)).otherwise("")
    )


def line_item(line: Column, known: Sequence[str] = (), brands: Sequence[str] = ()) -> Column:
    """The name of an item that a line judges and that no known alias stands for; empty where there is none."""
    words = literal([*REQUIREMENT_WORDS, *brands])
    cuts = (
        Rule(r"(?U)^\s*\d{1,3}[.)、]?\s*"), Rule(STANDARD_BEGINS), Rule(r"\[[^\]]{1,20}\]|（[^）]{1,20}）|\([^)]{1,20}\)"), Rule(r"\b\d{2,7}-\d{2,7}-\d{1,7}\b", " "), Rule(rf"(?i)(?:{words}|N\.?D\.?).*$"), Rule(r"[/／:：].*$"), Rule(r"(?U)^\s+|\s+$"),
        Rule(r"(?U)^[\d\s,，.、'\"-]+"), Rule(r"(?U)[\d\s,，.、'\"%_-]+$"), Rule(r"[^A-Za-z\x{4e00}-\x{9fff}]+"), Rule("(?:等级|级)$"),
    )
    text = F.coalesce(line, F.lit(""))
    name = rewritten(F.element_at(F.split(text, VERDICTS, 2), 1), cuts)["text"]
    bare = F.lower(F.regexp_replace(text, r"(?U)\s+", ""))
    aliased = bare.rlike(literal([a.lower().replace(" ", "") for a in known])) if known else F.lit(False)
    skipped = aliased | (line_verdict(text) == "") | ~text.rlike(r"[\x{4e00}-\x{9fff}]") | text.rlike(literal(NOISE)) | text.rlike(SEE_TABLE)
    good = F.length(name).between(1, LONGEST) & ((F.length(name) > 1) | name.isin(*SINGLE_NAMES)) & ~name.isin(*NOT_NAMES) & name.rlike(r"[\x{4e00}-\x{9fff}]")
    return F.when(~skipped & good, name).otherwise("")


def report_line(text: Column) -> Column:
    return squeeze(text)
