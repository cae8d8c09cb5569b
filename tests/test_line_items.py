"""Lines of item lists, results and names in them, and what a report says of itself."""

import random
import re

from pyspark.sql import functions as F

from loomspan.functions import linewise as L
from loomspan.operators import line_items, metadata

CANDIDATES = {
    "(级) 2008, A(1), 符合": "", "（Cd）,mg/kg 2006(测定低限 ≤0.1 未检出 符合": "", "--- cm ≤0.4 符合": "", "干摩擦 ≥ 4 4-5 符合": "", "镉 = 0.25 mg/kg 符合": "镉", "沾色 级 ≥3 4 合格": "", "2,4,5-三甲基苯胺 137-17-7 N.D. ≤20 符合": "三甲基苯胺",
    "序号 检验项目 检测方法 标准值 实测值 单项判定": "", "检验类别 委托送样 到样日期 2026-06-29 样品状态 符合检验要求": "", "除非委托方要求，本报告检测结果及符合性判定不考虑测量结果的不确定度。": "", "标准（称）值 实测值 单项判定": "", "年份/季节 26Q4 产品等级 合格品": "",
    "样品等级 合格品": "", "缝子纰裂 客户要求 合格": "", "防泼水性能（拒水性）（洗前） Q/某 600—2024 合格": "", "残脂率 某牌(G)-2/0872020-2026V1.0 符合": "", "水分率 GB 1 合格": "水分率", "耗氧量 ≤ 5.6 0.8 符合": "耗氧量", "无判定": "", "abc 符合": "", None: "",
}
KNOWN = ["干摩", "纰裂", "防泼水性能", "残脂率"]


def test_names_in_lines(spark):
    df = spark.createDataFrame([(c,) for c in CANDIDATES], "line string")
    got = {r.line: r.name for r in df.select("line", L.line_item(F.col("line"), KNOWN, ["某牌"]).alias("name")).collect()}
    assert got == CANDIDATES
    counted = {(r.name, r.n) for r in line_items.candidate_items(df.unionAll(df), KNOWN, ["某牌"]).collect()}
    assert counted == {("镉", 2), ("三甲基苯胺", 2), ("水分率", 2), ("耗氧量", 2)}


def test_results_in_lines(spark):
    cases = {
        ("1 甲醛 GB/T 2912.1 ≤20 未检出 符合", "甲醛含量"): "未检出", ("异味 无异味 合格", "异味"): "无异味", ("耐水 ≥3 4-5 符合", "耐水色牢度"): "4-5", ("耐水 ≥3 符合", "耐水色牢度"): "", ("3 pH值 GB/T 7573 5.8 符合", "pH值"): "5.8", ("pH值 温度 20 符合", "pH值"): "",
        ("残脂率 5.8 符合", "残脂率"): "", ("蓬松度 2024 16.6cm 合格", "蓬松度"): "16.6cm", ("蓬松度 12345678 合格", "蓬松度"): "", ("N.D. 合格", "x"): "未检出", ("", ""): "",
    }
    df = spark.createDataFrame(list(cases), "line string, item string")
    assert {(r.line, r.item): r.r for r in df.select("line", "item", L.line_result(F.col("line"), F.col("item")).alias("r")).collect()} == cases


def test_lists_of_items(spark):
    lines = ["检测项目 耐贮存色牢度", "判定依据 某牌-毛针织服装V2.0 采购内控标准：V2.0", "本报告检验检测结论是根据检验检测依据/判定依据仅对所检项目得出的", "序号 检验项目 判定依据 单项判定", "1 异味 GB 31701—2015 合格", "2 附件锐利性 GB 31701—2015 合格", "备注 ——", "3 后来 合格"]
    df = spark.createDataFrame([("u", i, x) for i, x in enumerate(lines)], "url string, n int, line string")
    assert sorted(r.n for r in line_items.item_lines(df, ["url"], ["n"]).collect()) == [0, 4, 5]


def test_lists_equal_the_walk(spark):
    rng = random.Random(2)
    kinds = ["检测结果", "检测项目 耐水", "检测项目汇总", "备注", "第 1 页", "甲", "乙 合格", "丙"]
    rows = [(u, i, rng.choice(kinds if rng.random() < 0.1 else kinds[5:])) for u in "abc" for i in range(500)]
    want = set()
    for u in "abc":
        open_, left = False, 0
        for _, i, x in (r for r in rows if r[0] == u):
            if re.search(r"^(检验|检测|测试)项目\s+(.{2,60})$", x):
                want.add((u, i))
            elif re.search("检测项目|检测结果", x):
                open_, left = True, 120
            elif x in ("备注", "第 1 页"):
                open_ = False
            elif open_ and left > 0:
                want.add((u, i))
                left -= 1
    got = line_items.item_lines(spark.createDataFrame(rows, "url string, n int, line string"), ["url"], ["n"]).collect()
    assert {(r.url, r.n) for r in got} == want and len(want) > 300


def test_best_line_of_each_item(spark):
    rows = [("u", 1, "1 甲醛 ≤20 未检出 符合"), ("u", 1, "甲醛 符合"), ("u", 2, "1 甲醛 ≤20 未检出 符合"), ("u", 2, "pH值 5.8 合格"), ("u", 3, "PH值 说明"), ("v", 1, "耐水 ≥3 4 不合格")]
    rules = [("甲醛含量", ["甲醛含量", "甲醛"]), ("pH值", ["pH值"]), ("耐水色牢度", ["耐水"])]
    got = line_items.best_lines(spark.createDataFrame(rows, "url string, page int, line string"), ["url"], rules).collect()
    assert {(r.url, r.item): (r.alias, r.verdict, r.result, r.page) for r in got} == {("u", "甲醛含量"): ("甲醛", "符合", "未检出", 2), ("u", "pH值"): ("pH值", "符合", "5.8", 2), ("v", "耐水色牢度"): ("耐水", "不符合", "4", 1)}


DOCS = "url string, report_no string, text_source string, header_native_text string, header_ocr_text string, header_parse_attempted boolean, header_parse_status string, header_parse_error string, ocr_attempted boolean, ocr_error string"
BLOCKS = "url string, page int, ord int, text string, confidence double, x double, mid_x double, mid_y double, width double, header boolean"


def test_what_reports_say(spark):
    plain = dict(report_no=None, text_source="native", header_native_text=None, header_ocr_text=None, header_parse_attempted=None, header_parse_status=None, header_parse_error=None, ocr_attempted=None, ocr_error=None)
    docs = {
        "a": {}, "b": dict(header_ocr_text="某某检测技术有限公司 CNAS L1", header_parse_status="已完成"), "c": dict(header_parse_attempted=True, header_parse_error="坏"), "d": dict(header_parse_status="OCR未启用"), "e": dict(header_parse_status="已完成"),
        "f": dict(header_parse_status="已完成"), "g": {}, "h": dict(ocr_attempted=True, ocr_error="慢"), "i": dict(text_source="vision_ocr"), "j": {},
    }
    texts = {"a": "报告编号：AB123456\n货 号：X-1 版 单 号：426FZ- BS-925 年/季度：2026\n面料编号：M 7\n签发日期：2026-01-10\n某某检测技术有限公司", "b": "x", "c": "x", "d": "x", "e": "未获得CMA 认可", "f": "x", "g": "x", "h": "x", "i": "通过CMA资质认定", "j": "x"}
    blocks = [("g", 1, 0, "页", 0.9, 0.1, 0.1, 0.2, 0.1, False), ("j", 1, 0, "MA", 0.3, 0.16, 0.169, 0.762, 0.087, True), ("j", 1, 1, "240020349903", 1.0, 0.16, 0.169, 0.69, 0.097, True), ("b", 2, 0, "CMA", 0.9, 0.5, 0.5, 0.9, 0.1, False)]
    got = metadata.report_metadata(
        spark.createDataFrame([(u, *(plain | d).values()) for u, d in docs.items()], DOCS), spark.createDataFrame([(u, 1, t) for u, t in texts.items()], "url string, page int, text string"), spark.createDataFrame(blocks, BLOCKS)
    ).collect()
    by = {r.url: r for r in got}
    assert len(got) == len(docs)
    a = by["a"]
    assert (a.report_no, str(a.report_issue_date), a.institution, a.institution_source) == ("AB123456", "2026-01-10", "某某检测技术有限公司", "报告全文或重复页脚文本")
    assert (a.report_product_codes, a.plate_numbers, a.material_numbers) == (["X-1"], ["426FZ-BS-925"], ["M"])
    assert by["b"].institution_source == "首页顶部报告头" and by["b"].report_issue_date_status == "未发现"
    assert {u: (r.cma_mark, r.cnas_mark) for u, r in by.items()} == {
        "a": ("待复核", "待复核"), "b": ("有", "有"), "c": ("待复核", "待复核"), "d": ("待复核", "待复核"), "e": ("未发现", "待复核"), "f": ("待复核", "待复核"), "g": ("未发现", "未发现"), "h": ("待复核", "待复核"), "i": ("有", "待复核"), "j": ("有", "未发现"),
    }
    assert "组合证据" in by["j"].cma_evidence and by["j"].cma_evidence.endswith("240020349903") and "顶部区域OCR" in by["b"].cma_evidence and "首页顶部报告头OCR识别到CNAS" in by["b"].cnas_evidence
    assert "失败：坏" in by["c"].cma_evidence and "未启用" in by["d"].cma_evidence and "仅识别到CMA" in by["e"].cma_evidence and "不能据此" in by["f"].cma_evidence and "OCR失败：慢" in by["h"].cma_evidence and "OCR全文识别到CMA" in by["i"].cma_evidence


def test_plates(spark):
    cases = {
        "版单号：426FZ-BS-925 年/季度：2026/Q4 颜色：黄绿色调00334": ["426FZ-BS-925"], "版单号：426FZ- BS-925 特殊补充字段": ["426FZ-BS-925"], "版单号：125FB-UZ-801 面料编号：202134731AD 批次号：": ["125FB-UZ-801"], "版单号：125FB-UZ-801面料编号：—": ["125FB-UZ-801"],
        "版单号：A1 中文说明": ["A1"], "版单号：ABC 中文说明": ["ABC"], "版单号：ABC- 中文说明": ["ABC"], "版单号：AB.12+CD(3)中文说明": ["AB"], "版单号：AB 12/3下一字段": ["AB12/3"], "x": [], None: [],
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert {r.t: r.p for r in df.select("t", metadata.plates(F.col("t")).alias("p")).collect()} == cases


def test_what_a_header_needs(spark):
    kind = "url string, header_parser_version string, header_parse_attempted boolean, header_parse_status string, header_native_text string, header_ocr_blocks int, path string, ocr_enabled boolean"
    rows = [("a", "2", True, "已完成", None, 0, "p", True), ("b", "1", True, "已完成", None, 3, "p", True), ("c", "2", True, "失败", None, 0, "p", True), ("d", None, None, None, "某某检测技术有限公司", 0, None, False), ("e", None, None, None, None, 0, None, False), ("f", None, None, None, None, 0, None, True)]
    pages = spark.createDataFrame([("d", 1, "CMA 1 CNAS 2"), ("c", 1, "\n".join(map(str, range(40))))], "url string, page int, text string")
    got = {r.url: r for r in metadata.header_state(spark.createDataFrame(rows, kind), pages, "2").collect()}
    assert {u: r.header_step for u, r in got.items()} == {"a": "done", "b": "blocks", "c": "render", "d": "resolved", "e": "disabled", "f": "failed"}
    assert got["c"].header_native_text.split("\n") == [str(i) for i in range(35)]
