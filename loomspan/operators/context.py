"""Parent items of result rows in the order of their report: what a row says itself, what its page says, what went before.

The state that rows carry on (parent, table, method) is overwritten by every row that knows its parent, so it never reaches
further back than the last of those, or than a page that begins with headings of its own. Between two such rows the parent and the table
stay as they are and only the method moves, and it moves in a way that a count tells: a row without a method clears it, the
next one with a method sets it. So the whole machine is windows over (document, product, colour) in row order; Spark
sorts and spills them, nothing gathers a group, and no Python runs.

Nulls: missing text is empty text; a missing table equals a missing table. Rows without an order come first; rows that tie in
it are taken in the order of their item, which makes reruns agree. Columns whose names begin with ``_`` must not be in the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions import item_rules as R
from loomspan.operators.families import cleaned, described, normalized, parent_child, role, standardized
from loomspan.operators.held import small, written
from loomspan.operators.rewrite import over_distinct

#: Points of evidence.
BASE, DIRECT, SECTION, INHERITED, SHAPED, SURE = 15, 30, 80, 50, 5, 80
#: Statuses of a mapping and the texts of its evidence.
AUTO, AUTO_MEDIUM, AUTO_NEW = "自动归并", "自动归并（中置信度）", "自动新增"
AUTO_PART, AUTO_DOMAIN = "自动归入父项（子项类型未完全识别）", "自动归入领域父项"
WAITING, FRAGMENT, OPEN = "续行待归位", "解析残片", "待确认归属"
UNKNOWN_KIND = "具体类型未识别"
SAYS_WAITING, SAYS_FRAGMENT = "续行已保留，但未找到可安全附加的同表父项/子项", "文本形态为说明句、断句或OCR残片"
SAYS_ALONE, SAYS_RULE, SAYS_FAMILY = "名称本身可独立表达检测对象", "最新明确规范化规则已确定统一父项", "规范化名称已明确包含父项与子项关系"
SAYS_DIRECT, SAYS_METHOD, SAYS_SECTION, SAYS_INHERITED = "名称结构或检测方法直接指向", "检测方法指向", "同页编号检测块及其标准号指向", "继承同一检测块父项"
SAYS_SHAPED, SAYS_DOMAIN, SAYS_CHILD = "结果、单位或标准要求形态匹配", "名称语义可确定为色牢度结果维度", "可确定为依赖上文的子项，但当前报告结构未恢复父项"
SAYS_PLACEHOLDER, SAYS_NEW = "规范化结果仍为依赖上文的占位项，禁止自动新增并进入总览", "名称完整且检测对象明确，自动新增规范父项"
JOIN = "；"


def page_sections(pages: DataFrame, confirmed: DataFrame | None = None, brands: Sequence[str] = ()) -> DataFrame:
    """url, page and sections: the parents of the page's numbered headings, each once, in their order. pages: url, page, text."""
    lines = pages.select("url", "page", F.posexplode(F.split("text", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]")).alias("line_no", "line"))
    line = F.trim(F.regexp_replace("line", r"(?U)\s+", " "))
    named = lines.withColumn("heading", F.regexp_extract(line, R.HEADING, 1)).filter("heading <> ''")
    named = named.withColumn("heading", cleaned(F.regexp_replace("heading", r"[（(].*$", "")))

    def parents(names: DataFrame) -> DataFrame:
        # Families read a heading as it stands, the standard form is made of its normalised form.
        made = standardized(names.withColumn("_simple", normalized(F.col("heading"))), "_simple", confirmed, brands, "_standard")
        return parent_child(made, "heading", "_standard", brands, ("parent", "_child")).select("heading", "parent")

    told = over_distinct(named, "heading", parents).filter((F.col("parent") != "") & ~F.contains("parent", F.lit(R.UNSURE)))
    firsts = told.groupBy("url", "page", "parent").agg(F.min("line_no").alias("at"))
    return firsts.groupBy("url", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "parent"))), lambda x: x["parent"]).alias("sections"))


def method_parent(method: Column) -> Column:
    """The parent that a method's standard stands for, null if none does."""
    compact = F.translate(F.regexp_replace(F.coalesce(method, F.lit("")), r"(?U)\s+", ""), "—–", "--")
    out = F.lit(None).cast("string")
    for standard, parent in reversed(R.METHOD_PARENTS):
        out = F.when(compact.rlike(f"(?i){standard}"), F.lit(parent)).otherwise(out)
    return out


def direct_parent(role_: Column, raw: Column, method: Column) -> Column:
    """The parent that a name's wording or its method gives its role, null if neither does."""
    named = F.lit(None).cast("string")
    for pattern, parent in reversed(R.DIMENSION_PARENTS):
        named = F.when(raw.rlike(pattern), F.lit(parent)).otherwise(named)
    by_method = F.contains(F.regexp_replace(F.coalesce(method, F.lit("")), r"(?U)\s+", ""), F.lit(R.APPEARANCE_METHOD))
    return F.when(role_ == "result_dimension", named).when((role_ == "material_or_part") & by_method, R.APPEARANCE).when(role_ == "down_component", R.DOWN_FAMILY)


def compatible_sections(role_: Column, sections: Column) -> Column:
    """The sections that a role can belong to."""
    every = F.coalesce(sections, F.array().cast("array<string>"))
    return (
        F.when(role_ == "result_dimension", F.filter(every, lambda s: F.contains(s, F.lit(R.FASTNESS)) | s.isin(R.SPLICE, R.STAIN_LIQUID)))
        .when(role_ == "direction", F.filter(every, lambda s: s.rlike(R.DIRECTION_SECTIONS)))
        .when(role_ == "down_component", F.filter(every, lambda s: F.contains(s, F.lit("绒"))))
        .otherwise(every)
    )


def may_inherit(role_: Column, parent: Column) -> Column:
    """Whether a role can go on under the parent that went before."""
    return (
        F.when(role_ == "result_dimension", F.contains(parent, F.lit(R.FASTNESS)) | parent.isin(R.SPLICE, R.STAIN_LIQUID))
        .when(role_ == "direction", parent.isin(*R.DIRECTION_PARENTS))
        .otherwise(role_.isin("material_or_part", "structural_label", "down_component"))
    )


def resolved(rows: DataFrame, sections: DataFrame, key: Sequence[str] = ("url", "sku", "color"), order: str = "seq", brands: Sequence[str] = ()) -> DataFrame:
    """Adds parent, child, status, confidence, evidence, include and role to rows that have url, page, table, method, result, unit, requirement,
    context_only, and of their names simple, standard, base_parent, base_child. sections: as of ``page_sections``."""
    pages = sections.select(F.col("url").alias("_url"), F.col("page").alias("_page"), F.col("sections").alias("_sections"))
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    told = rows.join(small(pages), (F.col("url") == F.col("_url")) & F.col("page").eqNullSafe(F.col("_page")), "left").drop("_url", "_page")
    told = told.withColumn("role", role(F.col("standard"), cleaned(F.col("result")), cleaned(F.col("unit")), F.col("context_only"), brands))
    told = told.withColumn("_method", text("method")).withColumn("_headed", F.coalesce(F.size("_sections") > 0, F.lit(False)))

    unsure = F.contains("base_parent", F.lit(R.UNSURE))
    told = told.withColumn(
        "_kind",
        F.when(F.col("role") == "context_fragment", "waiting").when((F.col("role") == "fragment") | (F.col("base_parent") == R.UNSURE_FRAGMENT), "fragment")
        .when((F.col("role") == "parent_candidate") & ~unsure, "alone").when(F.col("standard") == R.SMALL_PARTS, "rule")
        .when(~unsure & ((F.col("base_child") != "") | (F.col("base_parent") != F.col("standard"))), "family").otherwise("open"),
    ).withColumn("_open", F.col("_kind") == "open")

    keys, at = list(key), [F.col(order).asc_nulls_first(), F.col("simple")]
    so_far = lambda *by: W.partitionBy(*keys, *by).orderBy(*at).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*keys).orderBy(*at)
    turned = ~F.lag("page").over(before).eqNullSafe(F.col("page")) | (F.row_number().over(before) == 1)
    told = told.withColumn("_turned", turned)
    told = told.withColumn("_leaf", F.sum(F.col("_turned").cast("int")).over(so_far()))

    # Which of the page's sections a row stands in: each change of colour begins the next one.
    change = F.col("_open") & (F.col("role") == "result_dimension") & F.contains("simple", F.lit("变色"))
    told = told.withColumn("_changes", F.sum(change.cast("int")).over(so_far("_leaf"))).withColumn("_able", compatible_sections(F.col("role"), F.col("_sections")))
    place = F.least(F.greatest(F.col("_changes") - 1, F.lit(0)), F.size("_able") - 1)
    told = told.withColumn("_section", F.when(F.col("_open") & (F.size("_able") > 0), F.get("_able", place)))
    told = told.withColumn("_direct", F.when(F.col("_open"), direct_parent(F.col("role"), F.col("simple"), F.col("_method"))))
    told = told.withColumn("_by_method", F.when(F.col("_open") & F.col("_direct").isNull(), method_parent(F.col("_method"))))
    hint = F.coalesce("_direct", "_by_method")
    told = told.withColumn("_structural", F.col("_section").isNotNull() & (hint.isNull() | (hint == F.col("_section"))))
    told = told.withColumn("_own", F.when(F.col("_kind").isin("alone", "rule", "family"), F.col("base_parent")).otherwise(F.coalesce(hint, F.when(F.col("_structural"), F.col("_section")))))

    # A row that knows its parent, or begins a page with headings, opens a stretch; its state holds for all that follow in it.
    opens = F.col("_own").isNotNull() | (F.col("_turned") & F.col("_headed"))
    told = told.withColumn("_stretch", F.sum(opens.cast("int")).over(so_far()))
    state = F.first(F.struct(F.col("_own").alias("parent"), F.col("table").alias("table"), F.col("_method").alias("method"))).over(so_far("_stretch"))
    told = told.withColumn("_state", state)
    follows = F.col("_open") & F.col("_own").isNull() & (F.col("_state.parent") != "") & F.col("table").eqNullSafe(F.col("_state.table")) & may_inherit(F.col("role"), F.col("_state.parent"))
    told = told.withColumn("_follows", F.coalesce(follows, F.lit(False)))
    told = told.withColumn("_cleared", F.sum((F.col("_follows") & (F.col("_method") == "")).cast("int")).over(so_far("_stretch")))
    set_by = F.first(F.when(F.col("_follows") & (F.col("_method") != ""), F.col("_method")), ignorenulls=True).over(so_far("_stretch", "_cleared"))
    method = F.when((F.col("_cleared") == 0) & (F.col("_state.method") != ""), F.col("_state.method")).otherwise(set_by)
    told = told.withColumn("_inherits", F.col("_follows") & ((F.col("_method") == "") | (F.col("_method") == method)))
    told = told.withColumn("_found", F.when(F.col("_open"), F.coalesce("_own", F.when(F.col("_inherits"), F.col("_state.parent")))))
    return _concluded(told, rows.columns)


def _concluded(told: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Confidence, evidence and status of each row."""
    shaped = (F.coalesce(F.col("result").cast("string"), F.lit("")) != "") | (F.coalesce(F.col("unit").cast("string"), F.lit("")) != "") | (F.coalesce(F.col("requirement").cast("string"), F.lit("")) != "")
    hinted = F.col("_direct").isNotNull() | F.col("_by_method").isNotNull()
    points = F.lit(BASE)
    for holds, weight in ((hinted, DIRECT), (F.col("_structural"), SECTION), (F.col("_inherits"), INHERITED), (shaped, SHAPED)):
        points = points + F.when(holds, F.lit(weight)).otherwise(F.lit(0))
    said = F.concat_ws(
        JOIN, F.concat(F.lit(SAYS_DIRECT), "_direct"), F.concat(F.lit(SAYS_METHOD), "_by_method"), F.when(F.col("_structural"), F.concat(F.lit(SAYS_SECTION), "_section")),
        F.when(F.col("_inherits"), F.concat(F.lit(SAYS_INHERITED), "_state.parent")), F.when(shaped, F.lit(SAYS_SHAPED)),
    )
    told = told.withColumn("_points", points).withColumn("_said", said)
    simple = cleaned(F.col("simple"))
    down = cleaned(F.col("standard"))
    for name, short in R.DOWN_CHILDREN:
        down = F.when(F.col("standard") == name, F.lit(short)).otherwise(down)
    told = told.withColumn("_child", F.when(F.col("role") == "down_component", down).otherwise(simple)).withColumn("_bare", simple)

    kind, found, sure = F.col("_kind"), F.col("_found").isNotNull(), F.col("_points") >= SURE
    vague = found & ~sure & ((F.col("_child") == "") | (F.col("role") == "structural_label"))
    unknown = F.concat_ws("-", F.lit(UNKNOWN_KIND), F.when(F.col("_child") != "", F.col("_child")))
    domain = (F.col("role") == "result_dimension") & ~found
    open_child = F.col("role").isin("direction", "material_or_part", "structural_label") & ~found
    placeholder = F.col("base_parent").isin(R.UNSURE_PART, R.UNSURE_FASTNESS, R.UNSURE_FRAGMENT)
    held_child = F.coalesce(F.when(F.col("base_child") != "", F.col("base_child")), F.col("simple"))

    def answer(parent, child, status, confidence, evidence, include) -> Column:
        as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(as_column(parent).alias("parent"), as_column(child).alias("child"), as_column(status).alias("status"), as_column(confidence).cast("int").alias("confidence"), as_column(evidence).alias("evidence"), as_column(include).alias("include"))

    base = F.col("base_parent"), F.col("base_child")
    points = F.least(F.col("_points"), F.lit(100))
    out = (
        F.when(kind == "waiting", answer(WAITING, F.col("simple"), WAITING, 0, SAYS_WAITING, False))
        .when(kind == "fragment", answer(FRAGMENT, F.col("simple"), FRAGMENT, 100, SAYS_FRAGMENT, False))
        .when(kind == "alone", answer(*base, AUTO, 100, SAYS_ALONE, True))
        .when(kind == "rule", answer(*base, AUTO, 100, SAYS_RULE, True))
        .when(kind == "family", answer(*base, AUTO, 95, SAYS_FAMILY, True))
        .when(vague, answer(F.col("_found"), unknown, AUTO_PART, points, F.col("_said"), True))
        .when(found, answer(F.col("_found"), F.col("_child"), F.when(sure, AUTO).otherwise(AUTO_MEDIUM), points, F.col("_said"), True))
        .when(domain, answer(R.FASTNESS, F.concat(F.lit(f"{UNKNOWN_KIND}-"), F.when(F.col("_bare") == "", UNKNOWN_KIND).otherwise(F.col("_bare"))), AUTO_DOMAIN, F.col("_points"), SAYS_DOMAIN, True))
        .when(open_child, answer(OPEN, F.col("_bare"), OPEN, F.col("_points"), SAYS_CHILD, False))
        .when(placeholder, answer(OPEN, cleaned(held_child), OPEN, F.col("_points"), SAYS_PLACEHOLDER, False))
        .otherwise(answer(*base, AUTO_NEW, 80, SAYS_NEW, True))
    )
    return told.withColumn("_out", out).select(*columns, "_out.*", "role")


def repaired(rows: DataFrame, pages: DataFrame, column: str = "item") -> DataFrame:
    """A name of which only ``值[material]`` is left becomes ``pH值-material`` if its page says so."""
    material = F.regexp_extract(cleaned(F.col(column)), r"^值\[([^\]]+)\]$", 1)
    told = rows.withColumn("_material", material)
    asked = told.filter("_material <> ''").select(F.col("url").alias("_url"), F.col("page").alias("_page"), F.col("_material").alias("_of")).distinct()
    texts = pages.select(F.col("url").alias("_u"), F.col("page").alias("_p"), F.col("text").alias("_text"))
    sure = asked.join(texts, (F.col("_url") == F.col("_u")) & (F.col("_page") == F.col("_p")))
    pattern = F.concat(F.lit(r"(?iU)pH\s*值\s*\[\Q"), "_of", F.lit(r"\E\]"))
    sure = sure.filter(F.rlike(F.col("_text"), pattern)).select("_url", "_page", "_of").distinct()
    sure = written(sure)
    told = told.join(small(sure), (F.col("url") == F.col("_url")) & (F.col("page") == F.col("_page")) & (F.col("_material") == F.col("_of")), "left")
    return told.select(*[F.when(F.col("_of").isNotNull(), F.concat(F.lit("pH值-"), "_of")).otherwise(F.col(c)).alias(c) if c == column else F.col(f"`{c}`") for c in rows.columns])


def assigned(rows: DataFrame, pages: DataFrame, confirmed: DataFrame | None = None, brands: Sequence[str] = (), key: Sequence[str] = ("url", "sku", "color"), order: str = "seq") -> DataFrame:
    """From raw rows (url, sku, color, seq, page, table, item, method, result, unit, requirement, context_only) and page texts (url, page, text) to parent and child.

    Adds simple, standard, parent, child, status, confidence, evidence, include, role; a unit in brackets at the end of a name fills
    a unit that is missing or holds words."""
    named = over_distinct(repaired(rows, pages), "item", lambda names: described(names.withColumnRenamed("item", "_item"), "_item", confirmed, brands).withColumnRenamed("unit", "_unit").withColumnRenamed("_item", "item"))
    out = resolved(named, written(page_sections(pages, confirmed, brands)), key, order, brands)
    wordy = (cleaned(F.col("unit")) == "") | F.coalesce(F.col("unit"), F.lit("")).rlike(r"[\x{4e00}-\x{9fff}]")
    return out.withColumn("unit", F.when((F.col("_unit") != "") & wordy, F.col("_unit")).otherwise(F.col("unit"))).drop("_unit", "base_parent", "base_child")
