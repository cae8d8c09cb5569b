"""Resumable work: what an attempt came to, what must run again, which of two results stays; also as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The states of a unit of work.
STATES = ("succeeded", "partial", "retryable_failed", "permanent_failed")


def attempt_status(missing: Column, failed: Column, n_rows: Column) -> Column:
    """Missing input can be retried; a failure is partial if it gave rows; no rows without a failure are partial too."""
    some = n_rows > 0
    return F.when(missing, "retryable_failed").when(failed & some, "partial").when(failed, "retryable_failed").when(some, "succeeded").otherwise("partial")


def decide(known: Column, changed: Column, status: Column, retry_failed: bool = True) -> Column:
    """new, changed, done, permanent, retry or waiting."""
    again = F.lit("retry" if retry_failed else "waiting")
    return F.when(~known, "new").when(changed, "changed").when(status == "succeeded", "done").when(status == "permanent_failed", "permanent").otherwise(again)


def pending(work: DataFrame, state: DataFrame, key: str, identity: Sequence[str], retry_failed: bool = False) -> DataFrame:
    """Rows of work to run: unknown ones, those whose identity columns changed, and failed ones if asked for."""
    old = state.select(F.col(key).alias("_key"), F.col("status").alias("_status"), *[F.col(c).alias(f"_{c}") for c in identity])
    joined = work.join(old, F.col(key) == F.col("_key"), "left")
    changed = F.lit(False)
    for c in identity:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    verdict = decide(F.col("_key").isNotNull(), changed, F.col("_status"), retry_failed)
    return joined.withColumn("reason", verdict).filter(F.col("reason").isin("new", "changed", "retry")).select(*work.columns, "reason")


def keep_best(previous: DataFrame, candidate: DataFrame, key: str, identity: Sequence[str]) -> DataFrame:
    """One result of each key: a candidate that succeeded, else a previous one that did, else the one with more rows, else the
    candidate. A previous result of another identity doesn't count. Both: key, identity, status, n_rows and more."""
    both = previous.withColumn("_new", F.lit(0)).unionByName(candidate.withColumn("_new", F.lit(1)))
    w = W.partitionBy(key)
    current = F.first(F.when(F.col("_new") == 1, F.struct(*identity)), ignorenulls=True).over(w)
    both = both.withColumn("_identity", current).filter((F.col("_new") == 1) | F.col("_identity").isNull() | (F.struct(*identity) == F.col("_identity")))
    good = F.col("status") == "succeeded"
    rank = F.struct(F.when(good, 1).otherwise(0).alias("ok"), F.when(good, 0).otherwise(F.col("n_rows")).alias("rows"), F.col("_new").alias("new"))
    columns = previous.columns
    return both.groupBy(key).agg(F.max_by(F.struct(*columns), rank).alias("_best")).select("_best.*").select(*columns)


def upsert_stream(stream: DataFrame, key: str, identity: Sequence[str], read: Callable[[], DataFrame], write: Callable[[DataFrame], None], checkpoint: str):
    """Streaming form of keep_best: each micro-batch is merged into the table that ``read`` gives and ``write`` replaces."""

    def merge(batch: DataFrame, _: int) -> None:
        good = F.col("status") == "succeeded"
        # Within a batch, too, a success is better than more rows.
        rank = F.struct(F.when(good, 1).otherwise(0), F.when(good, 0).otherwise(F.col("n_rows")), F.struct(*[F.col(c) for c in batch.columns if c != key]))
        best = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), rank).alias("_row")).select("_row.*")
        write(keep_best(read(), best, key, identity))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
