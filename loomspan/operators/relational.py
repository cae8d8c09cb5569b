"""Row operators of an inspection-record pipeline, as DataFrame compositions.

Whatever depends on order takes explicit order columns, so results don't hang on how rows are dealt to partitions.
Aggregates that Spark can combine before the shuffle are preferred to windows; a window is used only where every row
of a group must come out again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions.text import blank
from loomspan.operators.held import written


def relationship_id(*parts: Column, prefix: str = "src-") -> Column:
    """Stable id of a source relationship: a digest of its trimmed fields, missing ones as empty text."""
    fields = [F.trim(F.coalesce(p.cast("string"), F.lit(""))) for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *fields), 256), 1, 20))


def explode_matches(df: DataFrame, keys: Sequence[str], text: str, pattern: str, group: int = 1, name: str = "value") -> DataFrame:
    """Every distinct match of a pattern in a cell with its first position, from 0."""
    found = df.select(*keys, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(pattern), group)).alias("position", name))
    return found.groupBy(*keys, name).agg(F.min("position").alias("position"))


def explode_split(df: DataFrame, keys: Sequence[str], column: str, pattern: str, default: str, name: str = "value") -> DataFrame:
    """One row per distinct non-empty piece of a cell; an empty cell gives the default."""
    pieces = F.array_distinct(F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), pattern), F.trim), lambda x: x != ""))
    return df.select(*keys, F.explode(F.when(F.size(pieces) == 0, F.array(F.lit(default))).otherwise(pieces)).alias(name))


def explode_lines(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Lines of a text with their ordinal, trimmed; blank ones are left out."""
    lines = df.select(*keys, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.withColumn("line", F.regexp_replace("line", r"^[ \t\r]+|[ \t\r]+$", "")).filter("line <> ''")


def first_match(probe: DataFrame, build: DataFrame, on: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join to the first build row of each key, by the order columns."""
    first = build.groupBy(*on).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_first"))
    return probe.join(first, list(on), "left").select(*[F.col(c) for c in probe.columns], *[F.col(f"_first.{v}").alias(v) for v in values])


def resolve_source(rows: DataFrame, candidates: DataFrame, on: Sequence[str], hint: str, value: str) -> DataFrame:
    """Cascade: the hinted candidate if there is one, else the only candidate, else ambiguous or missing.

    Adds resolution (exact, sole, ambiguous, missing), resolved and n_candidates."""
    per_key = candidates.groupBy(*on).agg(F.count_distinct(value).alias("n_candidates"), F.min(value).alias("_sole"))
    known = candidates.select(*[F.col(k).alias(f"_{k}") for k in on], F.col(value).alias("_hit")).distinct()
    out = rows.join(per_key, list(on), "left")
    out = out.join(known, [*[F.col(k) == F.col(f"_{k}") for k in on], F.col(hint) == F.col("_hit")], "left")
    n = F.coalesce("n_candidates", F.lit(0).cast("long"))
    how = F.when(F.col("_hit").isNotNull(), "exact").when(n == 1, "sole").when(n > 1, "ambiguous").otherwise("missing")
    resolved = F.coalesce("_hit", F.when(n == 1, F.col("_sole")))
    return out.select(*rows.columns, how.alias("resolution"), resolved.alias("resolved"), n.alias("n_candidates"))


def alias_of(text: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Standard name of the first alias, in list order, that stands in the text; case doesn't matter."""
    low, out = F.lower(text), F.lit(None).cast("string")
    for standard, aliases in reversed(rules):
        for alias in reversed(aliases):
            out = F.when(F.contains(low, F.lit(alias.lower())), F.lit(standard)).otherwise(out)
    return out


def ordered_rules(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Value of the first pattern that a text matches."""
    out = F.lit(default)
    for pattern, value in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def nearest_anchor(value: Column, anchors: Sequence[tuple[str, float]]) -> Column:
    """Name of the anchor nearest to a value; of equally near ones the first."""
    entries = [F.struct(F.abs(value - F.lit(x)).alias("d"), F.lit(i).alias("i"), F.lit(name).alias("name")) for i, (name, x) in enumerate(anchors)]
    return F.array_min(F.array(*entries))["name"]


def midpoint_bounds(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Half-open interval of each row: from the midpoint with the row before to the midpoint with the row after (integers)."""
    w = W.partitionBy(*by).orderBy(*order)
    half = lambda other: F.floor((F.col(value) + other) / 2).cast("long")
    return df.withColumn("lower", half(F.lag(value).over(w))).withColumn("upper", half(F.lead(value).over(w)))


def first_in_range(left: DataFrame, right: DataFrame, on: Sequence[str], condition: Column, key: Sequence[str], order: Sequence[str], values: Sequence[str], within: tuple[Column, Column, Column, float] | None = None) -> DataFrame:
    """Of the right rows with equal keys that a range condition allows, the first by order; left rows without one stay.

    within: lowest and highest value that a left row allows, the right row's value, and a width. Rows then meet by stretches of that width beside their keys, so
    that a key with many rows is compared by neighbours only; the condition must imply the bounds."""
    keys = list(on)
    a, b = left, right
    if within:
        low, high, value, width = within
        stretch = lambda c: F.floor(c / F.lit(float(width)))
        a, b = left.withColumn("_s", F.explode(F.sequence(stretch(low), stretch(high)))), right.withColumn("_s", stretch(value))
        keys = [*keys, "_s"]
    hits = a.join(b, keys).filter(condition).groupBy(*key).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_first"))
    return left.join(hits, list(key), "left").select(*[F.col(c) for c in left.columns], *[F.col(f"_first.{v}").alias(v) for v in values])


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds the place of each row in the order of its columns, from 1: rows are sorted by ranges, counted in each, and moved by what lies in the ranges before."""
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_id"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    at = (F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")
    return placed.join(F.broadcast(before), part == F.col("_part")).select(*df.columns, at.alias(name))


def fill_down(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """The last value that isn't blank, up to and with the row itself."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last(blank(value), ignorenulls=True).over(w))


def reset_fill(df: DataFrame, by: Sequence[str], order: Sequence[str], reset: Column, value: Column, name: str) -> DataFrame:
    """Fill down within segments; a row that resets begins a segment."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    cut = df.withColumn("segment", F.sum(reset.cast("long")).over(w))
    inner = W.partitionBy(*by, "segment").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return cut.withColumn(name, F.last(value, ignorenulls=True).over(inner))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, whole."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*key, "_row.*").select(*df.columns)


def prefer_detail(df: DataFrame, key: Sequence[str], concrete: Column, detailed: Column, method: Column, verdict: Column, qualitative: Column) -> DataFrame:
    """Without rows that only conclude, where the group has a detailed row, unless they are qualitative exceptions or use a
    method that no detailed row uses.

    The methods of detailed rows, once each, and an empty one for each group that has any: a row that only concludes goes if its own is
    among them. One aggregate and one join by equality; rows that can't go have no join key and are not shuffled to any group."""
    bare = F.regexp_replace(F.coalesce(method, F.lit("")), r"\s+", "")
    certain = lambda c: F.coalesce(c, F.lit(False))
    concludes = ~certain(concrete) & (F.coalesce(verdict, F.lit("")) != "") & ~certain(qualitative)
    methods = F.explode(F.array_distinct(F.array(bare, F.lit("")))).alias("_known")
    known = df.filter(certain(detailed)).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)], methods).distinct()
    marked = df.withColumn("_method", F.when(concludes, bare))
    same = F.col("_method") == F.col("_known")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return marked.join(known, same, "left_anti").select(*df.columns)


def count_with_examples(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], n: int, separator: str = ",") -> DataFrame:
    """Rows of each group, and its first n values by order as text. Each value is kept with its rank before they are gathered."""
    w = W.partitionBy(*by).orderBy(*order)
    examples = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).groupBy(*by)
    examples = examples.agg(F.array_sort(F.collect_list(F.struct("_rank", F.col(value).cast("string").alias("v")))).alias("_e"))
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(examples, list(by)).select(*by, "n", F.array_join(F.transform("_e", lambda x: x["v"]), separator).alias("examples"))


def ordered_distinct_join(df: DataFrame, by: Sequence[str], value: str, order: str, separator: str = "|", name: str = "joined") -> DataFrame:
    """Distinct values of a group in the order of their first appearance, as one text."""
    firsts = df.groupBy(*by, value).agg(F.min(order).alias("_at"))
    rows = F.array_sort(F.collect_list(F.struct("_at", F.col(value).cast("string").alias("v"))))
    return firsts.groupBy(*by).agg(F.array_join(F.transform(rows, lambda x: x["v"]), separator).alias(name))


def roll_up_verdict(fail: Column, passed: Column, labels: tuple[str, str, str] = ("fail", "pass", "")) -> Column:
    """Aggregate: any failure, else any pass, else neither."""
    return F.when(F.max(fail), F.lit(labels[0])).when(F.max(passed), F.lit(labels[1])).otherwise(F.lit(labels[2]))


def all_rows(df: DataFrame, by: Sequence[str], condition: Column) -> DataFrame:
    """Keys whose every row meets the condition."""
    return df.groupBy(*by).agg(F.bool_and(condition).alias("_all")).filter("_all").select(*by)


def evidence_score(weighted: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the weights of the predicates that hold."""
    return sum((F.when(p, F.lit(w)).otherwise(F.lit(0)) for p, w in weighted), F.lit(0))


def section_lines(lines: DataFrame, by: Sequence[str], order: str, header: Column, stop: Column, reach: int) -> DataFrame:
    """Lines that follow a header within ``reach`` lines and before a stop line."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    event = F.when(header, F.col(order)).when(stop, F.lit(-1))
    marked = lines.withColumn("_open", F.last(event, ignorenulls=True).over(w))
    return marked.filter((F.col("_open") >= 0) & (F.col(order) > F.col("_open")) & (F.col(order) - F.col("_open") <= reach)).drop("_open")


def stratified_sample(df: DataFrame, stratum: str, key: str, per_stratum: int, total: int, seed: str, required: Sequence | None = None) -> DataFrame:
    """Round-robin over strata in hash order: at most per_stratum of each, total in all; required keys come first."""
    order = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)
    first = F.col(key).isin(list(required)) if required else F.lit(False)
    ranked = df.withColumn("_hash", order).withColumn("_free", ~first)
    ranked = ranked.withColumn("turn", F.row_number().over(W.partitionBy(stratum).orderBy("_free", "_hash"))).filter(F.col("turn") <= per_stratum)
    return ranked.orderBy("_free", "turn", stratum).limit(total).drop("_hash", "_free")


def merge_manifests(df: DataFrame, key: Sequence[str], failed: Column, order: Sequence[str]) -> DataFrame:
    """One row of each key: the first that didn't fail, else the first."""
    return keep_first(df.withColumn("_failed", failed), key, ["_failed", *order]).drop("_failed")


def metrics(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Long form (metric, n): how many rows each check found."""
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        out = one if out is None else out.unionAll(one)
    return out
