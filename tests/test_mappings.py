"""Confirmed names, exclusions, earlier rows, records of either form."""

import json

from loomspan.sources import mappings as M
from loomspan.sources import xlsx


def test_confirmed_items(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    head = [M.ITEM, M.CONFIRMED, M.JUDGEMENT]
    xlsx.write_xlsx(path, [("别的", head, [["甲", "乙", ""]]), (M.SHEETS[0], head, [["旧名", " 新名 ", ""], ["排", "x", "排除"], ["", "x", ""], ["空", "", ""], ["旧名", "后名", "同意"]]), (M.SHEETS[1], head[:2], [["旧名", "末名"], ["单", "双"]])])
    assert {r.item: r.confirmed for r in M.confirmed_items(spark, path).collect()} == {"旧名": "末名", "单": "双"}
    assert M.confirmed_items(spark, str(tmp_path / "absent.xlsx")).count() == 0
    other = str(tmp_path / "other.xlsx")
    xlsx.write_xlsx(other, [(M.SHEETS[0], ["x"], [["1"]])])
    assert M.confirmed_items(spark, other).count() == 0


def test_exclusions(spark, tmp_path):
    forms = {"a": ["111122223333", "x 444455556666 y", 5], "b": {"skus": ["777788889999"]}, "c": {"selected_skus": ["000011112222"]}, "d": {"skus": [], "selected_skus": ["123412341234"]}, "e": 7, "f": {"other": ["999999999999"]}}
    for name, value in forms.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    got = {r.sku for r in M.excluded_skus(spark, *[str(tmp_path / f"{n}.json") for n in forms]).collect()}
    assert got == {"111122223333", "444455556666", "777788889999", "000011112222", "123412341234"}


def test_rows_of_earlier_runs(spark, tmp_path):
    rows = [{"item": "甲", "page": 1, "n": 2}, {"item": "甲", "page": 1, "n": 1}, {"item": None, "page": 1, "n": 3}, {"page": 1, "n": 4}, {"item": "乙", "page": 1, "n": 5}]
    (tmp_path / "rows.jsonl").write_text("\n".join([*map(json.dumps, rows), "", "{broken"]))
    got = M.item_rows(spark, str(tmp_path / "rows.jsonl"), "item string, page int, n int", ["item", "page"]).collect()
    assert {(r.item, r.page, r.n) for r in got} == {("甲", 1, 1), (None, 1, 3), ("乙", 1, 5)}


def test_records_of_either_form(spark):
    details = spark.createDataFrame([("s1", "k", "甲", "甲醛含量", "自动归并", True, "x")], "source_relationship_id string, sku string, raw_item string, standard_item string, status string, include_horizontal boolean, extra string")
    errors = spark.createDataFrame([("s2", "k", "下载失败")], "source_relationship_id string, sku string, type string")
    got = {r.sourceRelationshipId: r for r in M.canonical(details, errors).collect()}
    assert (got["s1"].recordType, got["s1"].parentItem, got["s1"].includeInOverview, got["s1"].sourceProductCode) == (M.DETAIL, "甲醛含量", "true", "k")
    assert (got["s2"].recordType, got["s2"].rawItem) == (M.EXCEPTION, None)
    back = M.legacy(M.canonical(details)).first()
    assert (back.record_type, back.sku, back.standard_item) == (M.DETAIL, "k", "甲醛含量")
    tables = M.rule_tables(spark)
    assert tables["families"].filter("family = 'pH值'").count() == 1 and tables["rewrites"].count() > 60 and tables["aliases"].count() == 30
