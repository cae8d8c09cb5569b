"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Every document gets a rate ``min(cap, exp(lambda * size / mean size))``; ``lambda`` solves, for each source, the
convex dual of "as close in entropy to one copy of every document as the token target allows". The dual is solved
by safeguarded Newton steps, each one aggregate over a histogram of (source, size). Rates become whole copies by
adding a hash of the document and rounding down; of ``OFFSETS`` shifts of that hash each source takes the one whose
total is nearest its target. No step sorts, ranks or gathers the documents of a source.

Nulls: a null text has size 0 and is taken 0 times its size; a null source is a source of its own and the last.
A null or repeated id changes nothing but the hash: equal rows are numbered and lie evenly on the circle of hashes, so that together they are
taken as often as their rates say. No rows give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, small, with_columns, word_count

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
OFFSETS = 64
#: Rows that agree in all that tells rows apart are numbered in so many buckets.
BUCKETS = 64
STEPS, CLOSE = 60, 1e-10


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds sid, target and ceiling to one row per source (source, source_size): shares by repeating weights, none above
    ``cap`` times its source, the excess reshared by weight. That is min(ceiling, level * weight) for one common level."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = sources.withColumn("sid", F.row_number().over(order).cast("long")).withColumn("weight", F.get(w, ((F.col("sid") - 1) % len(weights)).cast("int")))
    ranked = ranked.withColumn("ceiling", F.col("source_size") * F.lit(float(cap))).withColumn("full_at", F.col("ceiling") / F.col("weight"))
    before = W.orderBy("full_at", "sid").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    ranked = ranked.withColumn("mass", F.sum("source_size").over(every) * F.lit(float(share)))
    ranked = ranked.withColumn("level", (F.col("mass") - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    ranked = ranked.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "sid", "level"))).over(every)["level"])
    target = F.when(F.col("level").isNull(), F.col("ceiling")).otherwise(F.least("ceiling", F.col("level") * F.col("weight")))
    return ranked.select("source", "sid", "source_size", "n_docs", "ceiling", target.alias("target"))


def balance(hist: DataFrame, sources: DataFrame, scratch: Scratch, cap: float = CAP) -> DataFrame:
    """Newton iterations of the dual. hist: sid, size, n. Returns sources with lam (null: every rate is at its bound)."""
    interior = (F.col("target") > 0) & (F.col("target") < F.col("ceiling") * (1 - 1e-12))
    start = sources.withColumn("mean", F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1)))
    start = start.withColumn("lam", F.when(interior, F.log(F.col("target") / F.col("source_size"))))
    state = scratch.table(start.withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double")).withColumn("done", F.col("lam").isNull()))
    for _ in range(STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(cap)), F.exp(F.col("lam") * z))
        got = hist.join(small(state.filter(~F.col("done")).select("sid", "mean", "lam")), "sid")
        got = got.groupBy("sid").agg(F.sum(F.col("n") * F.col("size") * rate).alias("f"), F.sum(F.when(rate < cap, F.col("n") * F.col("size") * z * rate).otherwise(0.0)).alias("d"))
        step = state.join(small(got), "sid", "left")
        gap = F.log(F.col("f") / F.col("target"))
        step = step.withColumn("gap", gap).withColumn("done", F.col("done") | F.coalesce(F.abs("gap") < CLOSE, F.lit(False)) | F.coalesce(F.col("hi") - F.col("lo") < 1e-13 * (1 + F.abs("lam")), F.lit(False)))
        step = step.withColumn("lo", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - F.col("gap") * F.col("f") / F.nullif(F.col("d"), F.lit(0.0))
        inside = newton.isNotNull() & (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
        other = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2).when(F.col("lo").isNull(), F.col("lam") * 2 - 1).otherwise(F.col("lam") * 2 + 1)
        step = step.withColumn("lam", F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise(other))
        after = scratch.table(step.select(*state.columns))
        scratch.drop(state)
        state = after
    return state


def _rated(docs: DataFrame, solved: DataFrame, cap: float) -> DataFrame:
    """docs (doc_id, source, size and more) with source_size, target, rate, u (a hash from 0 to 1), sid and what else ``solved`` has."""
    out = docs.join(small(solved.withColumnRenamed("source", "own")), F.col("source").eqNullSafe(F.col("own"))).drop("own")
    bound = F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    rate = F.when(F.col("lam").isNull(), bound).otherwise(F.round(F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("mean"))), 9))
    u = F.pmod(F.xxhash64("doc_id", "size", *[c for c in ("mark",) if c in docs.columns]), F.lit(1 << 32)) / F.lit(float(1 << 32))
    if "nth" in docs.columns:  # equal rows lie evenly on the circle, so that together they take what their rates say
        u = F.pmod(u + F.col("nth") / F.col("times"), F.lit(1.0))
    return out.withColumn("rate", rate).withColumn("u", u)


def _told_apart(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs with ``nth`` (from 0) and ``times`` among the rows that agree in id, source, size and mark. Which of equal rows has which number
    is of no account. They are numbered in buckets, so that a row that is repeated very often isn't sorted in one task."""
    key = [c for c in ("doc_id", "source", "size", "mark") if c in docs.columns]
    often = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    often = scratch.table(often.select(*[F.col(c).alias(f"of_{c}") for c in key], "times"))
    if often.isEmpty():
        return docs.withColumn("nth", F.lit(0).cast("long")).withColumn("times", F.lit(1).cast("long"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key])
    joined = docs.join(small(often), same, "left").drop(*[f"of_{c}" for c in key])
    once = joined.filter("times is null").withColumn("times", F.lit(1).cast("long")).withColumn("nth", F.lit(0).cast("long"))
    again = scratch.table(joined.filter("times is not null").withColumn("bucket", F.pmod(F.monotonically_increasing_id(), F.lit(BUCKETS)).cast("int")))
    hashed = F.xxhash64(*key)
    sizes = again.groupBy(hashed.alias("h"), "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("h").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sizes = sizes.select(F.col("h").alias("of_h"), F.col("bucket").alias("of_bucket"), before.alias("before"))
    again = again.withColumn("h", hashed).withColumn("own", F.row_number().over(W.partitionBy("h", "bucket").orderBy("size")) - 1)
    again = again.join(sizes, (F.col("h") == F.col("of_h")) & (F.col("bucket") == F.col("of_bucket"))).withColumn("nth", (F.col("before") + F.col("own")).cast("long"))
    return once.unionByName(again.select(*once.columns))


def _copies(shift) -> Column:
    return F.floor(F.col("rate") + F.pmod(F.col("u") + shift, F.lit(1.0))).cast("long")


def solve(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """docs: doc_id, source, size. One row per source: source_size, target, mean, lam and shift, all that rates and copies hang on."""
    scratch = Scratch(docs.sparkSession, "mix")
    by_size = scratch.table(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    sources = scratch.table(source_targets(sources, weights, share, cap))
    named = sources.select(F.col("source").alias("own"), "sid")
    hist = scratch.table(by_size.join(small(named), F.col("source").eqNullSafe(F.col("own"))).select("sid", "size", "n"))
    solved = balance(hist, sources, scratch, cap).select("source", "sid", "source_size", "target", "mean", "lam")
    rated = _rated(docs, solved, cap)
    totals = rated.groupBy("sid").agg(F.first("target").alias("target"), *[F.sum(F.col("size") * _copies(F.lit(k / OFFSETS))).alias(f"t{k}") for k in range(OFFSETS)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k / OFFSETS).alias("shift")) for k in range(OFFSETS)]))
    best = totals.select(F.col("sid").alias("best_sid"), nearest["shift"].alias("shift"))
    return scratch.table(solved.join(small(scratch.table(best)), F.col("sid") == F.col("best_sid")).drop("best_sid"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """docs: doc_id, source, size (long), and mark, a hash of whatever else tells rows apart (null if absent): rows that agree in
    all of them are rounded together. Returns each with source_size, target, rate and copies (0 to ``cap``)."""
    scratch = Scratch(docs.sparkSession, "sizes")
    docs = scratch.table(with_columns(docs, {"doc_id": "long", "source": "string", "size": "long"} | ({"mark": "long"} if "mark" in docs.columns else {})))
    docs = scratch.table(_told_apart(docs, scratch))
    out = _rated(docs, solve(docs, weights, share, cap), cap)
    return out.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), "rate", _copies(F.col("shift")).alias("copies"))


def mix_documents(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns."""
    names = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *[c.alias(n) for n, c in _sizes().items()])
    scratch = Scratch(documents.sparkSession, "sizes")
    sizes = scratch.table(documents.select(*[c.alias(n) for n, c in _sizes().items()]))
    out = _rated(_told_apart(rows, scratch), solve(_told_apart(sizes, scratch), weights, share, cap), cap).withColumn("copies", _copies(F.col("shift"))).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def _sizes() -> dict[str, Column]:
    return {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "size": word_count(F.col("text")), "mark": F.xxhash64(F.col("text"))}


def op7_source_mix(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix(documents.select(*[c.alias(n) for n, c in _sizes().items()]))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")
