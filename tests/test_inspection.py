"""Header extraction, source relationships, overview, validation, workbooks and tables of inspection reports."""

import pytest
from pyspark.sql import functions as F

from loomspan.functions import extract as X
from loomspan.operators import grid, inspection, validation
from loomspan.sources import tables, xlsx


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_issue_dates(spark):
    pages = [
        ("a", 1, "检测日期 2026.06.10；复检 检测日期 2026.06.12 完"), ("b", 1, "报告签发日期：2026-02-31"), ("c", 1, "报告签发日期：2024-02-29"), ("d", 1, "报告签发日期：2026-01-10；样品日期：2026-02-31"),
        ("e", 1, "报告签发日期：2026-02-31；出具日期：2026-02-28"), ("f", 1, "签发日期 委托检验 2024-11-25 2024-11-28 完"), ("g", 1, "签发日期：2026-02-31"), ("g", 2, "签发日期：2026-02-28"), ("h", 1, "无"), ("i", 1, "检测日期：2025-01-02 至 2025-01-09"),
    ]
    got = {r.url: (str(r.issue_date or ""), r.status, r.label) for r in X.issue_dates(spark.createDataFrame(pages, "url string, page int, text string")).collect()}
    assert got["a"] == ("2026-06-12", "已识别", "检测日期") and got["b"][:2] == ("", "待复核") and got["c"] == ("2024-02-29", "已识别", "报告签发日期")
    assert got["d"][0] == "2026-01-10" and got["e"] == ("2026-02-28", "已识别", "出具日期") and got["f"][0] == "2024-11-28" and got["g"][0] == "2026-02-28"
    assert got["h"] == ("", "未发现", "") and got["i"][0] == "2025-01-09"


def test_mark_numbers(spark):
    kind = "url string, page int, ord int, text string, confidence double, mid_x double, mid_y double, width double"
    cases = {
        "aligned": [("MA", 1.0, 0.60, 0.79, None), ("220011349576", 1.0, 0.604, 0.69, None)], "apart": [("MA", 1.0, 0.20, 0.79, None), ("220011349576", 1.0, 0.80, 0.69, None)],
        "faint": [("MA", 0.30, 0.169, 0.662, 0.087), ("240020349903", 1.0, 0.169, 0.568, 0.097)], "spaced": [("MMA", 0.30, 0.724, 0.822, 0.055), ("2300 1134 9614", 1.0, 0.725, 0.740, 0.061)],
        "token": [("MRA", 1.0, 0.6, 0.79, None), ("220011349576", 1.0, 0.6, 0.69, None)], "phone": [("MA", 1.0, 0.6, 0.79, None), ("13800138000", 1.0, 0.6, 0.69, None)],
        "nowhere": [("MA", 1.0, None, None, None), ("220011349576", 1.0, None, None, None)], "beside": [("MA", 1.0, 0.50, 0.79, 0.02), ("220011349576", 1.0, 0.58, 0.69, 0.02)],
    }
    data = [(name, 1, i, t, c, x, y, w) for name, blocks in cases.items() for i, (t, c, x, y, w) in enumerate(blocks)]
    got = {r.url: r.number for r in X.mark_numbers(spark.createDataFrame(data, kind)).collect()}
    assert got == {"aligned": "220011349576", "faint": "240020349903", "spaced": "230011349614"}


def test_numbers_marks_and_institutions(spark):
    df = spark.createDataFrame([("报告编号：AB12-3456", "x"), ("REPORT nothing", "W123"), ("", "d" * 32)], "t string, f string")
    assert [r.n for r in df.select(X.report_number(F.col("t"), F.col("f")).alias("n")).collect()] == ["AB12-3456", "W123", ""]
    said = spark.createDataFrame([("本报告有 CNAS L1234 标志",), ("未获得 CNAS 认可",), ("XCNASX",), (None,)], "t string")
    assert [r.m for r in said.select(X.states_mark(F.col("t"), "CNAS").alias("m")).collect()] == [True, False, False, False]
    pages = [("a", 1, "委托单位：\n某某服饰检测有限公司\n国家纺织品检验中心\n国家纺织品检验中心"), ("b", 1, "申请人 某检测有限公司")]
    assert rows(X.institutions(spark.createDataFrame(pages, "url string, page int, text string"))) == [("a", "国家纺织品检验中心")]


def sheet(spark):
    data = [("书", 2, "111122223333", "红,蓝", "http://h/1.pdf;http://h/2.pdf", "春"), ("书", 3, "商品编码", "颜色", "检测报告", "季节"), ("书", 4, "0", "", "http://h/1.pdf", "春"), ("书", 5, "444455556666", "", "", "夏"), ("书", 6, "777788889999", "", "http://h/1.pdf", "夏")]
    return spark.createDataFrame(data, "source_sheet string, source_row int, `商品编码` string, `颜色` string, `检测报告` string, `季节` string")


def test_source_relationships(spark):
    records = inspection.source_records(sheet(spark))
    assert sorted((r.source_row, r.invalid_reason) for r in records.collect()) == [(2, ""), (4, "SKU无效"), (5, "无PDF链接"), (6, "")]
    made = inspection.relationships(records)
    assert made.count() == 4 + 1 + 1 + 1 and made.select("source_relationship_id").distinct().count() == 7
    assert rows(inspection.work_list(made)) == [("http://h/1.pdf", "1"), ("http://h/2.pdf", "2")]
    assert inspection.source_records(sheet(spark), "春").count() == 2
    assert inspection.scope(made, ["111122223333"]).count() == 4
    with pytest.raises(ValueError):
        inspection.scope(made, ["111122223333", "1"])
    with pytest.raises(ValueError):
        inspection.resolve_headers(["颜色"])


def test_overview(spark):
    details = spark.createDataFrame(
        [("s", "u1", "r1", "甲醛", "基础检测", "已确认", True, "合格", "大货"), ("s", "u2", "r2", "防水", "功能性检测", "自动新增", True, "不通过", "大货"), ("s", "u1", "r1", "谜", "待分类", "待复核", True, "合格", ""), ("s", "u1", "r1", "其它", "待分类", "已确认", True, "", ""), ("0", "u", "r", "x", "", "已确认", True, "", "")],
        "sku string, url string, report_no string, parent string, class string, status string, include boolean, verdict string, sample_type string",
    )
    bad = spark.createDataFrame([("s", "u3", "r3", "", ""), ("t", "u4", "", "", "")], "sku string, url string, report_no string, sample_type string, verdict string")
    got = {r.sku: tuple(r)[1:] for r in inspection.overview(details, bad).collect()}
    assert got == {"s": (3, 3, 3, 1, 1, 1, "不合格", 1, 1), "t": (0, 1, 0, 0, 0, 0, "", 0, 1)}


RECORD = "record_type string, source_relationship_id string, url string, sku string, color string, source_sheet string, source_row string, source_cell string, sample_type string, raw_item string, parent string, status string, include string, process_status string, institution string, raw_row string, cas_number string, detection_limit string"
SOURCE = "source_relationship_id string, url string, sku string, color string, source_sheet string, source_row string, source_cell string, sample_type string, process_status string"
DOWNLOAD, META = "url string, status string, error string", "url string, institution string, cma_mark string, cnas_mark string, cma_evidence string, cnas_evidence string, issue_date string, date_status string, date_reason string"
GOOD = ("检测结果明细", "id1", "u", "s", "c", "表", "2", "", "大货", "甲醛", "甲醛", "已确认", "true", "已解析", "某检测中心", "", "", "")


def check(spark, records=(GOOD,), sources=(("id1", "u", "s", "c", "表", "2", "", "大货", "已解析"),), downloads=(("u", "ok", ""),), metadata=(("u", "某检测中心", "有", "未发现", "x", "y", "2026-01-01", "已识别", ""),)):
    m = validation.validate(*(spark.createDataFrame(list(d), k) for d, k in ((records, RECORD), (sources, SOURCE), (downloads, DOWNLOAD), (metadata, META))))
    return m, {r.rule.split()[0] for r in m.collect() if r.n}


def changed(**kw):
    names = [c.split()[0] for c in RECORD.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, GOOD, strict=True))


def test_validation(spark):
    metrics, broken = check(spark)
    assert not broken and validation.delivery_state(metrics) == "完整通过"
    assert check(spark, [changed(source_relationship_id="other")])[1] == {"V-7", "V-19"}
    assert "V-7" in check(spark, [changed(source_row="3")])[1]
    assert "V-2" in check(spark, [changed(status="待复核")])[1] and "V-3" in check(spark, [changed(parent="--")])[1]
    assert "V-5" in check(spark, [changed(raw_item="苯 71-43-2")])[1] and "V-5" not in check(spark, [changed(raw_item="日期 2026-06-1")])[1]
    assert "V-6" in check(spark, [changed(raw_item="检出限：0.1")])[1] and "V-9" in check(spark, [changed(process_status="partial")])[1]
    failed = (("u", "ok", ""), ("v", "failed", "SSLError: x"))
    metrics, broken = check(spark, downloads=failed)
    assert {"V-15", "V-16", "V-23"} <= broken and validation.delivery_state(metrics, True) == "校验失败"
    covered = [GOOD, changed(record_type="下载异常", source_relationship_id="id2", url="v", raw_item="", parent="")]
    both = (("id1", "u", "s", "c", "表", "2", "", "大货", "已解析"), ("id2", "v", "s", "c", "表", "2", "", "大货", "下载失败"))
    metrics, broken = check(spark, [covered[0], changed(record_type="下载异常", source_relationship_id="id2", url="v", raw_item="", parent="", status="", include="", process_status="")], both, failed)
    assert broken == {"V-23"} and validation.delivery_state(metrics) == "校验失败" and validation.delivery_state(metrics, True) == "部分完成"
    assert rows(validation.failure_reasons(spark.createDataFrame(list(failed), DOWNLOAD))) == [("SSLError", "1")]


def test_each_rule_counts_its_own_rows(spark):
    source, meta = ("id1", "u", "s", "c", "表", "2", "", "大货", "已解析"), ("u", "某检测中心", "有", "未发现", "x", "y", "2026-01-01", "已识别", "")
    page = {"record_type": "报告信息/表格原文", "include": ""}
    records = [GOOD, changed(raw_item=" "), changed(institution="机构名称待确认"), changed(**page, raw_row="1 | 甲醛 | GB/T 2912 | 合格"), changed(**page, raw_row="甲醛 合格"), changed(**page, url="x")]
    records.append(changed(record_type="异常", source_relationship_id="id9", include="", process_status=""))
    metadata = [meta, meta[:2] + ("有？",) + meta[3:], meta[:6] + ("", "未发现", ""), meta[:6] + ("", "未发现", "none printed"), meta[:5] + ("",) + meta[6:], ("u", "") + meta[2:]]
    sources = [source, (None,) + source[1:], ("id3",) + source[1:8] + ("partial",)]
    metrics = check(spark, records, sources, [("u", "ok", ""), ("w", "ok", "")], metadata)[0]
    assert {r.rule.split()[0]: r.n for r in metrics.collect() if r.n} == {f"V-{i}": 1 for i in (1, 4, 8, 10, 11, 12, 13, 14, 16, 17, 18, 19, 20, 21)}
    assert [r.n for r in check(spark, [], sources)[0].collect() if r.rule in ("V-22 records empty", "V-22 structured records empty")] == [1, 1]


def test_grid_carry(spark):
    table = [["检测项目", "要求", "结果", "单项判定"], ["甲醛", "≤75", "20", "合格"], ["", "", "30", "合格"], ["成分", "", "", "符合"], ["羽绒", "", "83.9", ""], ["绒丝", "", "2", ""], ["色牢度", "≥3", "4-5", "不符合"]]
    got = grid.table_rows(spark.createDataFrame([("u", 1, "1", i, r) for i, r in enumerate(table)], "url string, page int, table string, row int, cells array<string>")).orderBy("row").collect()
    assert [(r.parent, r.child, r.result, r.verdict) for r in got] == [("甲醛", "", "20", "合格"), ("甲醛", "", "30", "合格"), ("成分", "", "", "符合"), ("成分", "羽绒", "83.9", "符合"), ("成分", "绒丝", "2", "符合"), ("色牢度", "", "4-5", "不符合")]
    assert grid.header_columns(["", "", "标准（称）值", "实测值", "单项判定"])["item"] == [0] and grid.header_columns(["a", "b"]) == {}
    assert grid.joined_verdict(["项目", "不", "符", "合"], 3) == "不符合" and grid.joined_verdict(["项目", "合格"], 1) == "合格"


def test_blocks_to_lines_and_bands(spark):
    blocks = spark.createDataFrame([("u", 1, 0, "b", 0.5, 0.901, 0.02), ("u", 1, 1, "a", 0.1, 0.9, 0.02), ("u", 1, 2, "c", 0.1, 0.8, 0.02), ("u", 1, 3, "x", None, None, None)], "url string, page int, ord int, text string, mid_x double, mid_y double, height double")
    assert [r.line for r in grid.blocks_to_lines(blocks).orderBy("line_no").collect()] == ["a b", "c"]
    anchors = spark.createDataFrame([("u", 1, 1, 0.9), ("u", 1, 2, 0.8)], "url string, page int, seq int, y double")
    assert sorted((r.text, r.seq) for r in grid.band_rows(blocks, anchors).collect()) == [("a", 1), ("b", 1), ("c", 2)]


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    xlsx.write_xlsx(path, [("第一", ["商品编码", "颜色"], [["111122223333", "红 & <蓝>"], [None, ""], ["x", "y"]]), ("二", ["a"], [["1"]])])
    with pytest.raises(FileExistsError):
        xlsx.write_xlsx(path, [])
    df = xlsx.read_xlsx(spark, path)
    assert [tuple(r) for r in df.orderBy("source_row").collect()] == [("111122223333", "红 & <蓝>", "第一", 2), ("x", "y", "第一", 4)]
    assert [tuple(r) for r in xlsx.read_xlsx(spark, path, "二").collect()] == [("1", "二", 2)]
    xlsx.export_frames(str(tmp_path / "out.xlsx"), [("明细", df)])
    assert xlsx.read_xlsx(spark, str(tmp_path / "out.xlsx")).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"records": [{"a": "1"}, {"a": "2", "b": 3}]}')
    assert rows(tables.read_envelope(spark, str(tmp_path / "e.json"), "records", "a string, b int")) == [("1", "None"), ("2", "3")]
    files = spark.createDataFrame([("a", b"%PDF-1.7" + b"x" * 2000), ("b", b"<html>" * 500), ("c", b"%PDF-")], "path string, content binary")
    assert {r.path: r.problem for r in tables.pdf_checks(files).collect()} == {"a": None, "b": "not a PDF", "c": "too small"}
    once = tables.replace_section("# t", "rules", "- a")
    assert tables.replace_section(once, "rules", "- a") == once and tables.replace_section(once, "rules", "- b").count("BEGIN") == 1

    def fetcher(url):
        if "bad" in url:
            raise TimeoutError("late")
        return b"ok"

    got = tables.fetch(spark.createDataFrame([("http://a",), ("http://bad",)], "url string"), fetcher, 2)
    assert sorted((r.url, r.status, r.error) for r in got.collect()) == [("http://a", "downloaded", ""), ("http://bad", "failed", "TimeoutError: late")]
    tables.write_new(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_new(spark.range(3), str(tmp_path / "t"))


def test_source_counts_are_not_broadcast(spark):
    """Tables that grow with the sources are merged: several of them broadcast at once don't fit a driver."""
    from loomspan.operators.matching import resolve_relationships

    names = "id string, url string, sku string, sheet string, row string, cell string, sample_type string, color string"
    sources = spark.createDataFrame([("s1", "u", "k", "A", "1", "", "", "红"), ("s2", "u", "k", "B", "2", "", "", "")], names)
    rows = spark.createDataFrame([("", "u", "k", "A", "", "", "", ""), ("", "u", "", "", "", "", "", "蓝"), ("x", "u", "", "", "", "", "", "")], names)
    told = resolve_relationships(rows, sources)
    assert told._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") == 5
    assert sorted((r.resolution, r.resolved or "") for r in told.collect()) == [("exact", "s1"), ("exact", "s2"), ("unknown_id", "")]


def test_overview_counts_each_value_once(spark):
    """Products with and without values, errors and invalid names; the plan shuffles no row once for each count."""
    from loomspan.operators import inspection

    names = "sku string, url string, report_no string, parent string, class string, status string, include boolean, verdict string, sample_type string"
    rows = [("k1", "u1", "R1", "p1", inspection.BASIC, "自动归并", True, "合格", "成衣"), ("k1", "u1", "R1", "p1", inspection.FUNCTIONAL, "自动归并", True, "-", "成衣"), ("k1", "u2", "", "p2", inspection.BASIC, "自动归并", False, None, None)]
    rows += [("k2", "", None, "", None, "自动归并", None, "", ""), ("0", "u1", "R1", "p1", None, "自动归并", True, "合格", ""), (None, "u1", "R1", "p1", None, "自动归并", True, "合格", "")]
    bad = spark.createDataFrame([("k1", "u2", "R9", "", "不通过"), ("k3", "u3", "", "", "")], "sku string, url string, report_no string, sample_type string, verdict string")
    told = inspection.overview(spark.createDataFrame(rows, names), bad)
    got = {r.sku: (r.n_reports, r.n_files, r.n_parents, r.n_basic, r.n_functional, r.n_samples, r.verdict, r.n_pending, r.n_error_files) for r in told.collect()}
    assert got == {"k1": (2, 2, 1, 1, 1, 1, "不合格", 0, 1), "k2": (0, 0, 0, 0, 0, 0, "", 0, 0), "k3": (0, 1, 0, 0, 0, 0, "", 0, 1)}
    assert "Expand" not in told._jdf.queryExecution().optimizedPlan().toString()
