"""Rule tables applied to columns: ordered rewrites, ladders of steps, longest known beginnings.

Rules are rows of an array that Spark folds to one constant; ``aggregate`` carries a text through them in order, so a list of any length is one expression
that holds its text once. All of it is meant for distinct values: ``over_distinct`` applies a function to those and joins the results back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions.item_rules import Rule, Step
from loomspan.operators.held import small, written


def _constant(rows: Sequence[dict]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows])


def rewritten(text: Column, rules: Sequence[Rule]) -> Column:
    """Struct of ``text`` after the rules in their order, and whether a rule ended them (``done``). Null is an empty text."""
    table = _constant([{"pattern": r.pattern, "replacement": r.replacement, "only": r.only or "", "stop": r.stop} for r in rules])

    def step(held: Column, rule: Column) -> Column:
        fits = ~held["done"] & F.rlike(held["text"], rule["pattern"]) & F.rlike(held["text"], rule["only"])
        return F.when(fits, F.struct(F.regexp_replace(held["text"], rule["pattern"], rule["replacement"]).alias("text"), rule["stop"].alias("done"))).otherwise(held)

    return F.aggregate(table, F.struct(F.coalesce(text, F.lit("")).alias("text"), F.lit(False).alias("done")), step)


def first_step(df: DataFrame, steps: Sequence[Step], names: tuple[str, str] = ("parent", "child")) -> DataFrame:
    """Adds parent and child of the first step whose pattern matches the whole of its field; null where none does."""
    fields = list(dict.fromkeys(s.field for s in steps))
    table = _constant([{"at": fields.index(s.field), "pattern": f"(?s)^(?:{s.pattern})$", "parent": s.parent, "child": s.child} for s in steps])
    values = F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])
    hits = df.withColumn("_hit", F.get(F.filter(table, lambda s: F.rlike(F.get(values, s["at"]), s["pattern"])), F.lit(0)))
    made = [F.regexp_replace(F.get(values, F.col("_hit.at")), F.col("_hit.pattern"), F.col(f"_hit.{c}")).alias(n) for c, n in zip(("parent", "child"), names, strict=True)]
    return hits.select(*df.columns, *made)


def longest_beginning(df: DataFrame, column: str, table: DataFrame, signs: str, values: Sequence[str]) -> DataFrame:
    """Adds ``values`` of the table's row whose ``beginning`` begins the text and is followed by its end or one of ``signs``, and
    ``rest``, what follows; null where there is none. Of several the least ``place`` counts, then the longest.

    Every text is cut at its end and before each sign, and the pieces are joined by equality; no text is compared with all beginnings."""
    text = F.col(column)
    cuts = df.select(text.alias("_text")).filter(F.length("_text") > 0).distinct()
    ends = F.filter(F.sequence(F.lit(1), F.length("_text")), lambda i: _cut("_text", i, signs))
    cuts = cuts.select("_text", F.explode(F.transform(ends, lambda i: F.substring(F.col("_text"), F.lit(1), i))).alias("beginning"))
    found = cuts.join(small(table), "beginning").groupBy("_text")
    best = found.agg(F.min_by(F.struct(*values, F.length("beginning").alias("_n")), F.struct("place", (-F.length("beginning")).alias("n"))).alias("_best"))
    out = df.join(small(best), text == F.col("_text"), "left")
    return out.select(*df.columns, *[F.col(f"_best.{v}").alias(v) for v in values], F.expr(f"substring(`{column}`, _best._n + 1)").alias("rest"))


def _cut(name: str, i: Column, signs: str) -> Column:
    following = F.substring(F.col(name), i + 1, F.lit(1))
    return (following == "") | (F.instr(F.lit(signs), following) > 0)


def over_distinct(df: DataFrame, column: str, function: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``function`` (one row in, one row out, keeping ``column``) over the distinct values of a column, joined back to all rows; null is one of them.

    The values are written before and after, so the rows are read twice, whatever the function does."""
    made = written(function(written(df.select(F.coalesce(F.col(column), F.lit("")).alias(column)).distinct())))
    new = [c for c in made.columns if c != column]
    told = made.select(F.col(column).alias("_value"), *new)
    return df.join(small(told), F.coalesce(F.col(column), F.lit("")) == F.col("_value"), "left").drop("_value")
