"""Item names to standard forms, and those to a parent item with its child: the dimension of distinct names.

Every function works on distinct names, whose number grows far slower than the rows; rows get the result by a join.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import item_rules as R
from loomspan.functions.items import TRAILING_UNITS
from loomspan.functions.text import simplified
from loomspan.operators.rewrite import first_step, longest_beginning, rewritten


def compatible_form(c: Column) -> Column:
    """NFKC, which no built-in function makes: Arrow batches of distinct names."""

    def fold(values: pd.Series) -> pd.Series:
        import unicodedata

        return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")

    return F.pandas_udf(fold, "string")(c)


def cleaned(c: Column) -> Column:
    """Without white space and signs at either end; null is empty."""
    return rewritten(c.cast("string"), R.CLEAN)["text"]


def normalized(c: Column) -> Column:
    """Simplified, in compatible form, without invisible characters and bullets."""
    return rewritten(compatible_form(simplified(F.coalesce(c.cast("string"), F.lit("")))), R.NOISE)["text"]


def standardized(names: DataFrame, column: str, confirmed: DataFrame | None = None, brands: Sequence[str] = (), name: str = "standard") -> DataFrame:
    """Adds the standard form of normalised names and ``unit``, the unit in brackets that they ended in.

    confirmed: (item, confirmed) as people judged it, one row an item; it comes after the names with one standard form and before the rest."""
    units = R.literal(TRAILING_UNITS)
    pattern = rf"(?i)^(.*?)[(\[]\s*({units})\s*[)\]]$"
    made = names.withColumn("unit", F.regexp_extract(column, pattern, 2))
    bare = F.when(F.col("unit") != "", cleaned(F.regexp_extract(column, pattern, 1))).otherwise(F.col(column))
    made = made.withColumn("_first", rewritten(bare, R.STANDARD_FIRST))
    text = F.col("_first.text")
    if confirmed is not None:
        judged = confirmed.select(cleaned(F.col("item")).alias("_item"), cleaned(F.col("confirmed")).alias("_judged")).filter("_item <> '' AND _judged <> ''")
        judged = judged.groupBy("_item").agg(F.min("_judged").alias("_judged"))
        made = made.join(judged, text == F.col("_item"), "left")
        text = F.coalesce("_judged", text)
    last = rewritten(text, R.standard_last(brands))["text"]
    return made.select(*names.columns, "unit", F.when(F.col("_first.done"), F.col("_first.text")).otherwise(last).alias(name))


def parent_child(names: DataFrame, raw: str, full: str, brands: Sequence[str] = (), add: tuple[str, str] = ("parent", "child")) -> DataFrame:
    """Adds the parent and the child of each name: by the ladder, else by the family it begins with, else the name itself without a child."""
    cleaned_names = names.withColumn("_raw", cleaned(F.col(raw))).withColumn("_full", cleaned(F.col(full)))
    told = first_step(cleaned_names.select(*names.columns, F.col("_raw").alias("raw_"), F.col("_full").alias("full_")), _on(R.parent_steps(brands)), ("_parent", "_child"))
    spark = names.sparkSession
    rows = [(alias, place, family) for place, (family, aliases) in enumerate(R.FAMILIES) for alias in aliases]
    table = spark.createDataFrame(rows, "beginning string, place int, family string")
    table = table.groupBy("beginning").agg(F.min_by(F.struct("place", "family"), "place").alias("r")).select("beginning", "r.*")
    told = longest_beginning(told, "full_", table, R.CHILD_SIGNS, ["family"])
    told = told.withColumn("_rest", rewritten(F.col("rest"), R.CHILD)["text"])
    child = F.col("_rest")
    sweat = child
    for beginning, lead, absorbs in reversed(R.SWEAT):
        same = (child == lead) if absorbs else F.lit(False)
        sweat = F.when(F.startswith(F.col("full_"), F.lit(beginning)), F.concat(F.lit(lead), F.when((child == "") | same, F.lit("")).otherwise(F.concat(F.lit("-"), child)))).otherwise(sweat)
    child = cleaned(F.when(F.col("family") == R.SWEAT_FAMILY, sweat).otherwise(child))
    stepped = cleaned(F.regexp_replace(F.regexp_replace("_child", f"^{R.JOINT}+|{R.JOINT}+$", ""), f"{R.JOINT}+", "-"))
    by_step, by_family = F.col("_parent").isNotNull(), F.col("family").isNotNull()
    return told.select(
        *names.columns,
        F.when(by_step, F.col("_parent")).when(by_family, F.col("family")).otherwise(F.col("full_")).alias(add[0]),
        F.when(by_step, stepped).when(by_family, child).otherwise(F.lit("")).alias(add[1]),
    )


def _on(steps: Sequence[R.Step]) -> list[R.Step]:
    return [s._replace(field=f"{s.field}_") for s in steps]


def described(names: DataFrame, column: str, confirmed: DataFrame | None = None, brands: Sequence[str] = ()) -> DataFrame:
    """Of distinct raw names: simple (normalised), unit, standard, base_parent, base_child."""
    simple = names.withColumn("simple", normalized(cleaned(F.col(column))))
    return parent_child(standardized(simple, "simple", confirmed, brands), "simple", "standard", brands, ("base_parent", "base_child"))


def split_name(c: Column) -> Column:
    """Struct of parent and child at the first hyphen; a hyphen in a substance's name (after N, O, P or places) is none: there the last of several divides."""
    chemical = c.rlike(r"(?i)^(?:N|O|P|\d[\d,]*)-")
    several = F.length(c) - F.length(F.replace(c, F.lit("-"), F.lit(""))) > 1
    pattern = F.when(chemical & ~several, F.lit("(?s)^(.*)()$")).when(chemical, F.lit("(?s)^(.*)-([^-]*)$")).when(F.contains(c, F.lit("-")), F.lit("(?s)^([^-]*)-(.*)$"))
    pattern = F.coalesce(pattern, F.lit("(?s)^(.*)()$"))
    return F.struct(cleaned(F.regexp_replace(c, pattern, F.lit("$1"))).alias("parent"), cleaned(F.regexp_replace(c, pattern, F.lit("$2"))).alias("child"))


def role(standard: Column, result: Column, unit: Column, context_only: Column, brands: Sequence[str] = ()) -> Column:
    """What a name is in its row: context_fragment, fragment, down_component, parent_candidate, result_dimension, direction, material_or_part, structural_label."""
    fragments = R.literal([*R.ROLE_FRAGMENTS, *[f"符合{b}" for b in brands]])
    whole = lambda p: standard.rlike(f"^(?:{p})$")
    named = standard.rlike(R.ALONE)
    return (
        F.when(F.coalesce(context_only, F.lit(False)), "context_fragment")
        .when((standard == "") | standard.isin(*R.RUN_ON) | standard.rlike(R.LIMIT_NOTE), "fragment")
        .when(whole(R.DOWN_PART), "down_component")
        .when(standard.rlike(f"^{fragments}"), "fragment")
        .when(named & ~standard.rlike("[-—－](?:变色|沾色)"), "parent_candidate")
        .when(standard.rlike("变色|沾色"), "result_dimension")
        .when((F.length(standard) <= 6) & whole(R.DIRECTION) & ((result != "") | (unit != "")), "direction")
        .when((F.length(standard) <= 12) & ~named & ~standard.rlike("值$") & whole(R.MATERIAL), "material_or_part")
        .when(standard.isin("要求", "条款"), "structural_label")
        .otherwise("parent_candidate")
    )
