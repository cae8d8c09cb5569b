"""Lists of items in page text: which lines belong to one, and the best line of each item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions import linewise as L
from loomspan.functions.item_rules import literal


def item_lines(lines: DataFrame, by: Sequence[str], order: Sequence[str], line: str = "line") -> DataFrame:
    """Lines of a list of items: up to ``REACH`` after each heading until a line closes it; a line that names one item counts anywhere.

    The state is the last heading or closing line, so it is a window; lines are numbered within their list."""
    text = F.col(line)
    one = text.rlike(L.ONE_ITEM) & ~text.rlike(literal(L.NOT_ONE))
    opens = ~one & text.rlike(L.OPENS)
    closes = ~one & ~opens & (text.rlike(literal(L.CLOSES)) | text.rlike(L.ENDS_PAGE))
    told = lines.withColumn("_one", one).withColumn("_turn", F.when(opens, F.lit(True)).when(closes, F.lit(False)))
    so_far = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    told = told.withColumn("_open", F.last("_turn", ignorenulls=True).over(so_far)).withColumn("_list", F.sum(F.when(F.col("_turn"), 1).otherwise(0)).over(so_far))
    plain = F.col("_open") & F.col("_turn").isNull() & ~F.col("_one")
    inner = W.partitionBy(*by, "_list").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    told = told.withColumn("_nth", F.sum(F.when(plain, 1).otherwise(0)).over(inner))
    return told.filter(F.col("_one") | (plain & (F.col("_nth") <= L.REACH))).select(*lines.columns)


def best_lines(lines: DataFrame, by: Sequence[str], rules: Sequence[tuple[str, Sequence[str]]], page: str = "page", line: str = "line") -> DataFrame:
    """Of each key and standard item the best line that names it with a verdict: by columns, item, alias, verdict, result, page, line.

    A result counts 5, a number at the start 2, every 500 letters less 1; of equal ones the later page wins, then the greater line, alias, verdict and result. One pass: a line is
    given its items, and rows are combined before they are shuffled."""
    low = F.lower(F.col(line))
    table = F.array(*[F.struct(F.lit(item).alias("item"), F.array(*[F.lit(a) for a in aliases]).alias("aliases")) for item, aliases in rules])
    hits = F.filter(F.transform(table, lambda r: F.struct(r["item"].alias("item"), F.get(F.filter(r["aliases"], lambda a: F.contains(low, F.lower(a))), F.lit(0)).alias("alias"))), lambda h: h["alias"].isNotNull())
    told = lines.withColumn("verdict", L.line_verdict(F.col(line))).filter("verdict <> ''").withColumn("_hits", hits).select(*by, F.col(page).alias("page"), F.col(line).alias("line"), "verdict", F.explode("_hits").alias("h"))
    told = told.select(*by, "page", "line", "verdict", "h.item", "h.alias").withColumn("result", L.line_result(F.col("line"), F.col("item")))
    points = F.when(F.col("result") != "", 5).otherwise(0) + F.when(F.col("line").rlike(r"^\d+"), 2).otherwise(0) - F.length("line") / 500
    best = told.groupBy(*by, "item").agg(F.max(F.struct(points.alias("points"), "page", "line", "alias", "verdict", "result")).alias("b"))
    return best.select(*by, "item", "b.alias", "b.verdict", "b.result", "b.page", "b.line")


def candidate_items(lines: DataFrame, known: Sequence[str], brands: Sequence[str] = (), line: str = "line") -> DataFrame:
    """name, n of the items that lines judge and no alias stands for."""
    named = lines.select(L.line_item(F.col(line), known, brands).alias("name")).filter("name <> ''")
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
