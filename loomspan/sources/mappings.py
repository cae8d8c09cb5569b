"""Small inputs that people keep: confirmed names in workbooks, lists of excluded products, rows of earlier runs, records of either form, rule tables."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import item_rules as R
from loomspan.functions.text import sku_tokens
from loomspan.sources.xlsx import _sheets, read_xlsx

#: Sheets and columns of a workbook of judgements, and the judgement that leaves a name out.
SHEETS, ITEM, CONFIRMED, JUDGEMENT, EXCLUDED = ("同类项待判断", "未归组项目"), "检测项目", "确认后统一名称", "人工判断", "排除"
#: Kinds of records, what makes an item row the same as another, and names of fields in either form.
DETAIL, EXCEPTION = "检测结果明细", "异常"
ROW_KEY = ("item", "result", "verdict_raw", "report_no", "url", "sku", "color", "page")
CANONICAL = (
    ("source_relationship_id", "sourceRelationshipId"), ("source_sheet", "sourceSheet"), ("source_row", "sourceRow"), ("source_cell", "sourceCell"), ("sku", "sourceProductCode"), ("color", "color"), ("sample_type", "sampleType"), ("url", "url"), ("raw_item", "rawItem"),
    ("standard_item", "parentItem"), ("status", "mappingStatus"), ("include_horizontal", "includeInOverview"), ("cas_number", "casNumber"), ("detection_limit", "detectionLimit"),
)


def confirmed_items(spark: SparkSession, path: str) -> DataFrame:
    """item, confirmed of the two sheets of judgements, those that are there; a missing workbook or column gives no rows, an excluded name is left out.

    Where a name is confirmed twice, the second sheet's counts, and there its last row."""
    out = spark.createDataFrame([], "item string, confirmed string, sheet int, source_row int")
    present = []
    if os.path.exists(path):
        with zipfile.ZipFile(path) as book:
            present = list(_sheets(book))
    for place, sheet in enumerate(SHEETS):
        if sheet in present:
            rows = read_xlsx(spark, path, sheet)
            if ITEM in rows.columns and CONFIRMED in rows.columns:
                judgement = F.trim(F.col(JUDGEMENT)) if JUDGEMENT in rows.columns else F.lit("")
                told = rows.select(F.trim(ITEM).alias("item"), F.trim(CONFIRMED).alias("confirmed"), F.lit(place).alias("sheet"), "source_row", judgement.alias("j"))
                out = out.unionByName(told.filter(f"item <> '' AND confirmed <> '' AND j <> '{EXCLUDED}'").drop("j"))
    return out.groupBy("item").agg(F.max_by("confirmed", F.struct("sheet", "source_row")).alias("confirmed"))


def excluded_skus(spark: SparkSession, *paths: str) -> DataFrame:
    """sku of every 12-digit number in files that hold a JSON list, or an object with ``skus`` or ``selected_skus``; other files give none."""
    text = spark.read.text(list(paths), wholetext=True)
    kept = F.from_json("value", "skus array<string>, selected_skus array<string>")
    some = lambda c: F.when(F.array_size(c) > 0, c)
    listed = F.coalesce(F.from_json("value", "array<string>"), some(kept["skus"]), some(kept["selected_skus"]), F.array().cast("array<string>"))
    return text.select(F.explode(listed).alias("v")).select(F.explode(sku_tokens(F.col("v"))).alias("sku")).distinct()


def item_rows(spark: SparkSession, path: str, schema: str, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Rows of JSON lines, each key once, null equal to null: the first by file and by its text. Lines that can't be read are left out."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    names = [c for c in rows.columns if c != "_corrupt_record"]
    good = rows.withColumn("_file", F.col("_metadata.file_path")).filter("_corrupt_record IS NULL")
    rest = [c for c in names if c not in key]
    if not rest:
        return good.select(*names).distinct()
    return good.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct("_file", F.to_json(F.struct(*rest)))).alias("_r")).select(*key, "_r.*").select(*names)


def canonical(details: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Records in the later form: the details with their fields' later names and kind, and the exceptions. Fields that a table hasn't are null; its own others fall away."""

    def renamed(df: DataFrame, kind: str) -> DataFrame:
        own = [(F.col(old) if old in df.columns else F.lit(None)).cast("string").alias(new) for old, new in CANONICAL]
        return df.select(F.lit(kind).alias("recordType"), *own)

    out = renamed(details, DETAIL)
    return out if exceptions is None else out.unionByName(renamed(exceptions, EXCEPTION))


def legacy(records: DataFrame) -> DataFrame:
    """The reverse: records of the later form under the earlier names, with ``record_type``."""
    return records.select(F.col("recordType").alias("record_type"), *[F.col(new).alias(old) for old, new in CANONICAL])


def rule_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The fixed rules as tables: rewrites in their order, aliases, families with their beginnings, parents by method."""
    rewrites = [(i, stage, r.pattern, r.replacement, r.only, r.stop) for stage, rules in (("first", R.STANDARD_FIRST), ("last", R.standard_last())) for i, r in enumerate(rules)]
    return {
        "rewrites": spark.createDataFrame(rewrites, "place int, stage string, pattern string, replacement string, only string, stop boolean"),
        "aliases": spark.createDataFrame(list(R.ALIASES), "name string, standard string"),
        "families": spark.createDataFrame([(i, f, a) for i, (f, names) in enumerate(R.FAMILIES) for a in names], "place int, family string, beginning string"),
        "methods": spark.createDataFrame([(i, m, p) for i, (m, p) in enumerate(R.METHOD_PARENTS)], "place int, method string, parent string"),
    }
