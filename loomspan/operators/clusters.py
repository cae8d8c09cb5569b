"""Groups of similar names: seeds, normal forms, and a greedy pass in rounds over pairs that filters which lose nothing leave."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.operators.held import small, written

LEAST_RATIO, LEAST_CONTAINED = 0.84, 4


def seed_groups(names: DataFrame, seeds: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """names (name, n): group, name, n of names that equal, contain or are contained in a seed; groups of two or more."""
    spark = names.sparkSession
    rows = [(g, s, i) for i, (g, seed) in enumerate(seeds) for s in seed]
    rules = F.broadcast(spark.createDataFrame(rows, "group string, seed string, position int"))  # a fixed list
    hit = F.expr("name = seed or contains(name, seed) or contains(seed, name)")
    first = names.filter("name <> ''").join(rules, hit).groupBy("name", "n").agg(F.min(F.struct("position", "group")).alias("g"))
    found = first.select(F.col("g.group").alias("group"), "name", "n")
    return found.join(found.groupBy("group").count().filter("count > 1").select("group"), "group")


def label_groups(members: DataFrame) -> DataFrame:
    """group -> label (shortest member), total, size."""
    return members.groupBy("group").agg(F.min_by("name", F.struct(F.length("name"), "name")).alias("label"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"))


def _tokens(names: DataFrame) -> DataFrame:
    """name, token, n: every letter of a name with how often it has stood there before, and the name's length."""
    letters = names.select("name", F.length("name").alias("n"), F.explode(F.split("name", "")).alias("letter")).filter("letter <> ''")
    counted = letters.groupBy("name", "n", "letter").agg(F.count(F.lit(1)).alias("times"))
    return counted.select("name", "n", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda i: F.concat(F.col("letter"), i.cast("string")))).alias("token"))


def similar_pairs(names: DataFrame, ratio: float = LEAST_RATIO) -> DataFrame:
    """Pairs a < b of names that are similar enough or of which one of some length contains the other. None is lost:

    matching letters can't be more than the letters two names share, so similar names share a token among the rarest few of each (prefix
    filter for 2 * shared >= ratio * letters), and their lengths can't differ beyond (2 - ratio) / ratio; a name within another shares its rarest run of
    ``LEAST_CONTAINED`` letters with it. Only what those leave is compared."""
    distinct = written(names.select("name").filter("name <> ''").distinct())
    tokens = written(_tokens(distinct))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rare = W.partitionBy("name").orderBy("df", "token")
    kept = F.col("n") - F.ceil(F.col("n") * F.lit(ratio / (2 - ratio)) - F.lit(1e-9)) + 1
    prefix = tokens.join(small(common), "token").withColumn("r", F.row_number().over(rare)).filter(F.col("r") <= kept).select("name", "n", "token")
    side = lambda df, x: df.select(F.col("name").alias(x), F.col("n").alias(f"n_{x}"), "token")
    near = side(prefix, "a").join(side(prefix, "b"), "token").filter("a < b").filter(2 * F.least("n_a", "n_b") >= ratio * (F.col("n_a") + F.col("n_b")) - 1e-9).select("a", "b")

    runs = distinct.filter(F.length("name") >= LEAST_CONTAINED).select("name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - LEAST_CONTAINED + 1), lambda i: F.substring(F.col("name"), i, F.lit(LEAST_CONTAINED))))).alias("run"))
    spread = runs.groupBy("run").agg(F.count(F.lit(1)).alias("df"))
    rarest = runs.join(small(spread), "run").groupBy("name").agg(F.min_by("run", F.struct("df", "run")).alias("run"))
    inside = rarest.select(F.col("name").alias("x"), "run").join(runs.select(F.col("name").alias("y"), "run"), "run").filter("x <> y AND contains(y, x)")
    inside = inside.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def judged(batches):
        for pdf in batches:
            same = [difflib.SequenceMatcher(None, a, b).ratio() >= ratio for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            yield pdf[same]

    # Letters counted once more, whole: an upper bound of what can match.
    shared = near.distinct().join(tokens.select(F.col("name").alias("a"), "token"), "a").join(tokens.select(F.col("name").alias("b"), "token"), ["b", "token"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"))
    able = shared.filter(2 * F.col("m") >= ratio * (F.length("a") + F.length("b")) - 1e-9).select("a", "b")
    return able.mapInPandas(judged, "a string, b string").union(inside).distinct()


def fuzzy_groups(names: DataFrame, ratio: float = LEAST_RATIO) -> DataFrame:
    """name, leader: in name order each name joins the first earlier leader that it is similar to, or leads itself. An empty name leads itself.

    Leaders are found in rounds over tables: who has no earlier undecided or leading partner leads, who has a leading one doesn't.
    Every round decides at least the first undecided name of each connected part; nothing comes to the driver but counts."""
    pairs = written(similar_pairs(names, ratio))
    every = written(names.select("name").filter("name is not null").distinct())
    decided = written(every.join(pairs.select(F.col("b").alias("name")).distinct(), "name", "left_anti").withColumn("leads", F.lit(True)))
    open_ = written(pairs)
    while not open_.isEmpty():
        leaders = decided.filter("leads").select(F.col("name").alias("a"))
        led = written(open_.join(leaders, "a").select(F.col("b").alias("name")).distinct())
        rest = open_.join(led.select(F.col("name").alias("b")), "b", "left_anti").join(decided.filter("NOT leads").select(F.col("name").alias("a")), "a", "left_anti").join(led.select(F.col("name").alias("a")), "a", "left_anti")
        # Names whose every earlier partner turned out not to lead now lead themselves.
        waiting = open_.select(F.col("b").alias("name")).distinct().join(led, "name", "left_anti")
        rest = written(rest)
        first = waiting.join(rest.select(F.col("b").alias("name")).distinct(), "name", "left_anti")
        decided = written(decided.unionByName(led.withColumn("leads", F.lit(False))).unionByName(first.withColumn("leads", F.lit(True))))
        open_ = rest
    leads = decided.filter("leads").select("name")
    first = pairs.join(leads.select(F.col("name").alias("a")), "a").groupBy(F.col("b").alias("name")).agg(F.min("a").alias("of"))
    return decided.join(first, "name", "left").select("name", F.when(F.col("leads"), F.col("name")).otherwise(F.col("of")).alias("leader"))
