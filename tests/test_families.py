"""Item names to standard forms and families, and the parents that rows take from their report."""

import random

import pytest

from loomspan.functions import item_rules as R
from loomspan.operators import context, families, rewrite

#: raw name -> (standard form, parent, child)
NAMES = {
    "材质鉴别[帮面]": ("材质鉴定[帮面]", "材质鉴定", "帮面"),
    "材质鉴定（帮面）": ("材质鉴定(帮面)", "材质鉴定", "帮面"),
    "残脂率(%)": ("残脂率", "残脂率", ""),
    "残脂率": ("残脂率", "残脂率", ""),
    "三甲基苯胺": ("三甲基苯胺", "可分解致癌芳香胺染料", "三甲基苯胺"),
    "二氨基甲苯(DAT)": ("二氨基甲苯(DAT)", "可分解致癌芳香胺染料", "二氨基甲苯(DAT)"),
    "联苯胺(BZ)": ("联苯胺(BZ)", "可分解致癌芳香胺染料", "联苯胺(BZ)"),
    "PH值（其他）": ("pH值", "pH值", ""),
    "pH值-面料": ("pH值-面料", "pH值", "面料"),
    "ＰＨ值": ("pH值", "pH值", ""),
    "耐酸汗渍色牢度-变色": ("耐汗渍色牢度（酸汗）-变色", "耐汗渍色牢度", "酸汗-变色"),
    "耐碱汗渍": ("耐汗渍色牢度（碱汗）", "耐汗渍色牢度", "碱汗"),
    "耐汗渍色牢度": ("耐汗渍色牢度", "耐汗渍色牢度", ""),
    "耐湿摩擦": ("耐摩擦色牢度-湿摩", "耐摩擦色牢度", "湿摩"),
    "耐干摩擦色牢度": ("耐摩擦色牢度-干摩", "耐摩擦色牢度", "干摩"),
    "湿擦": ("耐摩擦色牢度-湿摩", "耐摩擦色牢度", "湿摩"),
    "干摩擦色牢度-里料": ("干摩擦色牢度-里料", "耐摩擦色牢度", "干摩-里料"),
    "纤维含量[面料]-里布": ("纤维含量[面料]-里布", "纤维含量", "面料-里布"),
    "纤维含量(面料)": ("纤维含量(面料)", "纤维含量", "面料"),
    "纤维成分及含量": ("纤维含量", "纤维含量", ""),
    "甲醛": ("甲醛含量", "甲醛含量", ""),
    "起毛起球": ("抗起毛球", "抗起毛球", ""),
    "面料起毛起球": ("抗起毛球", "抗起毛球", ""),
    "耐水色牢-度": ("耐水色牢度", "耐水色牢度", ""),
    "缝子-程度": ("缝子程度", "缝子程度", ""),
    "水洗后外观质量-外观": ("水洗后外观质量外观", "水洗后外观质量外观", ""),
    "重金属总量-铅": ("重金属总量-铅", "重金属总量", "铅"),
    "六价铬(Cr)": ("六价铬(Cr)", "重金属", "六价铬(Cr)"),
    "N-亚硝基二甲胺": ("N-亚硝基二甲胺", "N-亚硝基胺", "N-亚硝基二甲胺"),
    "N-亚硝基胺": ("N-亚硝基胺", "N-亚硝基胺", ""),
    "邻苯二甲酸二丁酯": ("邻苯二甲酸二丁酯", "邻苯二甲酸酯", "邻苯二甲酸二丁酯"),
    "邻苯二甲酸酯": ("邻苯二甲酸酯", "邻苯二甲酸酯", ""),
    "总和(DINP+DNOP+DIDP)": ("邻苯二甲酸酯-总和(DINP+DNOP+DIDP)", "邻苯二甲酸酯", "总和(DINP+DNOP+DIDP)"),
    "产品标识-鞋号": ("产品标识-鞋号", "标识标签", "鞋号"),
    "标识*": ("标识标签", "标识标签", ""),
    "附件锐利尖端": ("附件锐利尖端", "锐利尖端和锐利边缘", "锐利尖端"),
    "帽口绳带": ("帽口绳带", "绳带要求", "帽口绳带"),
    "沾色-棉": ("沾色-棉", "色牢度项目待确认", "沾色-棉"),
    "锦纶-里": ("锦纶-里", "纤维含量", "锦纶-里"),
    "面料": ("面料", "检测子项待确认", "面料"),
    "自由端不得": ("自由端不得", "解析残片待确认", "自由端不得"),
    "水洗后外观质量-外观平整": ("洗后外观", "洗后外观", ""),
    "抗静电性能-电荷面密度[洗前]其余": ("抗静电性能-电荷面密度[洗前]", "抗静电性能", "电荷面密度[洗前"),
    "透气率(方法": ("透气率", "透气性能", ""),
    "蓬松度（洗": ("蓬松度(洗", "蓬松度", "洗"),
    "绒丝+羽丝": ("绒丝+羽丝含量", "绒丝+羽丝含量", ""),
    "水分率": ("水分率", "水分率", ""),
    "": ("", "", ""),
    " ・◆ ": (None, None, None),
    None: ("", "", ""),
}


def test_names_have_their_family(spark):
    rows = [(i, n) for i, n in enumerate(NAMES)]
    names = spark.createDataFrame(rows, "i int, item string")
    got = {r["i"]: (r["standard"], r["base_parent"], r["base_child"]) for r in families.described(names, "item").collect()}
    want = {i: NAMES[n] for i, n in rows if NAMES[n][0] is not None}
    # An open bracket becomes a hyphen at the end of the rewrite.
    want[[n for _, n in rows].index("蓬松度（洗")] = ("蓬松度-洗", "蓬松度", "洗")
    assert {i: got[i] for i in want} == want
    assert len(got) == len(rows)


def test_confirmed_names_and_brands(spark):
    names = spark.createDataFrame([("旧名",), ("蓬松度-某牌-羽绒服装",), ("甲醛含量-针织服装",), ("符合某牌标准",)], "item string")
    confirmed = spark.createDataFrame([("旧名", " 杂质 "), ("旧名", "杂质"), (None, "x"), ("y", None)], "item string, confirmed string")
    got = {r["item"]: (r["standard"], r["base_parent"]) for r in families.described(names, "item", confirmed, ["某牌"]).collect()}
    assert got == {"旧名": ("杂质含量", "杂质含量"), "蓬松度-某牌-羽绒服装": ("蓬松度", "蓬松度"), "甲醛含量-针织服装": ("甲醛含量", "甲醛含量"), "符合某牌标准": ("符合某牌标准", "解析残片待确认")}
    plain = {r["item"]: r["standard"] for r in families.described(names, "item").collect()}
    assert plain["旧名"] == "旧名" and plain["蓬松度-某牌-羽绒服装"] == "蓬松度-某牌"


def test_rules_stop_and_guard(spark):
    rules = [R.Rule("a+", "b"), R.Rule("^b$", "end", stop=True), R.Rule("b", "c", only="x"), R.Rule("end", "never"), R.Rule(r"(x)(y)?", "$1-$2")]
    rows = spark.createDataFrame([("aaa",), ("aax",), ("ay",), ("xy",), (None,)], "t string").select("t", rewrite.rewritten("t" and __import__("pyspark.sql.functions").sql.functions.col("t"), rules).alias("r")).collect()
    assert {r.t: (r.r.text, r.r.done) for r in rows} == {"aaa": ("end", True), "aax": ("cx-", False), "ay": ("by", False), "xy": ("x-y", False), None: ("", False)}


def test_longest_beginning_against_all_pairs(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ab-(") for _ in range(rng.randint(0, n)))
    texts, table = {word(9) for _ in range(300)}, {}
    for place in range(12):
        for _ in range(4):
            table.setdefault(word(4), place)
    table.pop("", None)
    got = rewrite.longest_beginning(spark.createDataFrame([(t,) for t in texts], "t string"), "t", spark.createDataFrame([(b, p, f"f{p}") for b, p in table.items()], "beginning string, place int, family string"), "-(", ["family"])
    for r in got.collect():
        fits = [(p, -len(b), b) for b, p in table.items() if r.t.startswith(b) and (len(r.t) == len(b) or r.t[len(b)] in "-(")]
        assert (r.family, r.rest) == ((f"f{min(fits)[0]}", r.t[len(min(fits)[2]) :]) if fits else (None, None)), r


def test_split_names(spark):
    cases = {"纤维含量-棉": ("纤维含量", "棉"), "a-b-c": ("a", "b-c"), "N-亚硝基": ("N-亚硝基", ""), "N-亚硝基-x": ("N-亚硝基", "x"), "2,4-二胺": ("2,4-二胺", ""), "1,2-x-y": ("1,2-x", "y"), "无": ("无", ""), "": ("", "")}
    rows = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r.t: tuple(r.r) for r in rows.select("t", families.split_name(rows.t).alias("r")).collect()}
    assert got == cases


ROLES = {
    ("沾色-棉", "4", ""): "result_dimension", ("试样的变色", "", ""): "result_dimension", ("耐水色牢度-变色", "", ""): "result_dimension", ("洗液沾色程度", "", ""): "parent_candidate",
    ("横向", "3", ""): "direction", ("横向", "", "N"): "direction", ("横向", "", ""): "parent_candidate", ("横向延伸值", "3", ""): "parent_candidate",
    ("绒子含量", "", ""): "down_component", ("杂质", "", ""): "down_component", ("聚酯纤维", "", ""): "material_or_part", ("帮面", "", ""): "parent_candidate", ("鞋帮面", "", ""): "material_or_part",
    ("要求", "", ""): "parent_candidate", ("条款", "", ""): "structural_label", ("", "", ""): "fragment", ("续下页", "", ""): "fragment", ("注：检出限为", "", ""): "fragment", ("长至膝", "", ""): "fragment", ("水分率", "", ""): "parent_candidate",
}


def test_roles(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(ROLES), "s string, r string, u string")
    got = {(r.s, r.r, r.u): r.role for r in df.withColumn("role", families.role(F.col("s"), F.col("r"), F.col("u"), F.lit(None).cast("boolean"))).collect()}
    assert got == ROLES
    assert df.select(families.role(F.col("s"), F.col("r"), F.col("u"), F.lit(True)).alias("role")).distinct().collect()[0].role == "context_fragment"


FIELDS = "url string, sku string, color string, seq long, page int, `table` string, item string, method string, result string, unit string, requirement string, context_only boolean"


def _row(seq, item, method="", table="1", page=1, result="4", context_only=False, url="u", color="c"):
    return (url, "s", color, seq, page, table, item, method, result, "", "", context_only)


def _assign(spark, rows, pages=(), **more):
    got = context.assigned(spark.createDataFrame(rows, FIELDS).repartition(5), spark.createDataFrame(list(pages), "url string, page int, text string"), **more).collect()
    return [(r.parent, r.child, r.status, r.confidence, r.include) for r in sorted(got, key=lambda r: (r.url, r.color, r.seq))], got


def test_parents_carry_on(spark):
    """A family, its dimensions, another table, a method that differs, one that is missing, fragments, directions."""
    rows = [
        _row(1, "耐皂洗色牢度", "GB/T 3921"), _row(2, "变色", "GB/T 3921"), _row(3, "沾色-棉", ""), _row(4, "沾色-毛", "GB/T 9999"), _row(5, "沾色-麻", "GB/T 3921"),
        _row(6, "沾色-棉", "", table="2"), _row(7, "续下页"), _row(8, "x", context_only=True), _row(9, "横向", ""), _row(10, "水分率"), _row(11, "横向"), _row(12, "沾色-棉", "GB/T 5713"), _row(13, "绒子含量"),
    ]
    got, _ = _assign(spark, rows)
    assert got == [
        ("耐皂洗色牢度", "", "自动归并", 100, True), ("耐皂洗色牢度", "变色", "自动归并（中置信度）", 70, True), ("耐皂洗色牢度", "沾色-棉", "自动归并（中置信度）", 70, True),
        ("耐皂洗色牢度", "沾色-毛", "自动归并（中置信度）", 70, True), ("色牢度", "具体类型未识别-沾色-麻", "自动归入领域父项", 20, True), ("色牢度", "具体类型未识别-沾色-棉", "自动归入领域父项", 20, True),
        ("解析残片", "续下页", "解析残片", 100, False), ("续行待归位", "x", "续行待归位", 0, False), ("待确认归属", "横向", "待确认归属", 20, False), ("水分率", "", "自动归并", 100, True),
        ("待确认归属", "横向", "待确认归属", 20, False), ("耐水色牢度", "沾色-棉", "自动归并（中置信度）", 50, True), ("羽绒成分测定", "绒子含量", "自动归并（中置信度）", 50, True),
    ]


def test_page_headings_give_parents(spark):
    text = "1 耐水色牢度（GB/T 5713-2013）\n表\n2 耐汗渍色牢度 GB/T 3922\n3 蓬松度(FZ/T 1)\n3 蓬松度(FZ/T 1)\n4 面料(GB 1)\r\n不是标题 GB/T 1"
    pages = spark.createDataFrame([("u", 1, text), ("u", 2, "none"), ("v", 1, None)], "url string, page int, text string")
    assert [(r.url, r.page, r.sections) for r in context.page_sections(pages).collect()] == [("u", 1, ["耐水色牢度", "耐汗渍色牢度", "蓬松度"])]
    rows = [_row(1, "试样的变色"), _row(2, "沾色-棉"), _row(3, "试样的变色"), _row(4, "沾色-棉"), _row(5, "试样的变色"), _row(6, "试样的变色", page=2)]
    got, _ = _assign(spark, rows, [("u", 1, text)])
    assert [g[:4] for g in got] == [
        ("耐水色牢度", "试样的变色", "自动归并", 100), ("耐水色牢度", "沾色-棉", "自动归并", 100), ("耐汗渍色牢度", "试样的变色", "自动归并", 100), ("耐汗渍色牢度", "沾色-棉", "自动归并", 100),
        ("耐汗渍色牢度", "试样的变色", "自动归并", 100), ("耐汗渍色牢度", "试样的变色", "自动归并（中置信度）", 70),
    ]


def test_cut_name_is_repaired_from_its_page(spark):
    rows = [_row(1, "值[面料]"), _row(2, "值[里料]"), _row(3, "值[a.c]")]
    got, _ = _assign(spark, rows, [("u", 1, "检测 ph  值 [面料] 7.1 pH值[abc]")])
    assert [g[:2] for g in got] == [("pH值", "面料"), ("值[里料]", ""), ("值[a.c]", "")]


def _machine(rows, sections):
    """The state machine row by row, on what a row says of itself."""
    held = {}
    out = {}
    for r in sorted(rows, key=lambda r: (r["url"], r["sku"], r["color"], r["seq"], r["simple"])):
        state = held.setdefault((r["url"], r["sku"], r["color"]), {"parent": "", "table": None, "method": "", "page": None, "nth": -1})
        heads = sections.get((r["url"], r["page"]), [])
        if state["page"] != r["page"]:
            state.update(page=r["page"], nth=-1, **({"parent": "", "table": None, "method": ""} if heads else {}))
        unsure = "待确认" in r["base_parent"]
        role, own = r["role"], None
        if role in ("context_fragment", "fragment") or r["base_parent"] == R.UNSURE_FRAGMENT:
            continue
        if not unsure and (role == "parent_candidate" or r["base_child"] or r["base_parent"] != r["standard"]) or r["standard"] == R.SMALL_PARTS:
            own = r["base_parent"]
        else:
            able = {"result_dimension": lambda s: "色牢度" in s or s in (R.SPLICE, R.STAIN_LIQUID), "direction": lambda s: any(w in s for w in R.DIRECTION_SECTIONS.split("|")), "down_component": lambda s: "绒" in s}.get(role, lambda s: True)
            fit = [s for s in heads if able(s)]
            own = r["hint"]
            if role == "result_dimension" and "变色" in r["simple"]:
                state["nth"] += 1
            if fit:
                there = fit[min(max(state["nth"], 0), len(fit) - 1)]
                own = own or there
            if not own and state["parent"] and state["table"] == r["table"] and (not r["method"] or not state["method"] or r["method"] == state["method"]):
                p = state["parent"]
                may = {"result_dimension": "色牢度" in p or p in (R.SPLICE, R.STAIN_LIQUID), "direction": p in R.DIRECTION_PARENTS}.get(role, role in ("material_or_part", "structural_label", "down_component"))
                own = p if may else None
            out[r["id"]] = own
        if own:
            state.update(parent=own, table=r["table"], method=r["method"])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_windows_equal_the_machine(spark, seed):
    from pyspark.sql import functions as F

    rng = random.Random(seed)
    names = ["耐皂洗色牢度", "耐水色牢度", "勾丝性能", "变色", "沾色-棉", "试样的变色", "横向", "鞋帮面", "条款", "水分率", "续下页", "缝子纰裂", "洗液沾色", "可拆卸小附件", "超出", "耐水-变色", "聚酯纤维"]
    methods = ["", "", "GB/T 1", "GB/T 2", "GB/T 3922", "GB/T 8629", None]
    rows = [(rng.choice("uv"), "s", rng.choice("cd"), i, i // 60, rng.choice(["1", "1", "1", "2", None]), rng.choice(names), rng.choice(methods), rng.choice(["4", ""]), "", "", rng.random() < 0.05) for i in range(900)]
    pages = [("u", p, "1 耐水色牢度（GB/T 5713）\n2 耐皂洗色牢度(GB/T 1)\n3 缝子纰裂(GB 3)") for p in (2, 5, 9)] + [("v", p, "1 水分率(GB 7)") for p in (1, 6)]
    df, texts = spark.createDataFrame(rows, FIELDS), spark.createDataFrame(pages, "url string, page int, text string")
    named = rewrite.over_distinct(df, "item", lambda n: families.described(n, "item").withColumnRenamed("unit", "_u"))
    sections = context.page_sections(texts)
    got = context.resolved(named, sections).withColumn("hint", F.coalesce(context.direct_parent(F.col("role"), F.col("simple"), F.col("method")), context.method_parent(F.col("method")))).collect()
    plain = [r.asDict() | {"id": r.seq, "method": r.method or ""} for r in got]
    want = _machine(plain, {(r.url, r.page): r.sections for r in sections.collect()})
    seen = {r.seq: r.parent if r.status.startswith(("自动归并", "自动归入父项")) else None for r in got}
    assert {i: seen[i] for i in want} == want
    assert len(got) == 900 and sum(v is not None for v in want.values()) > 60
