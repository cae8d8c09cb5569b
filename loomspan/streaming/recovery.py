"""Result files of attempts and the state that follows from them: after a run that was cut off, the files tell what was done.

Each attempt on a document is one JSON object in a file of a results folder: url, status, parser_version, identity fields, stats (a map of counts), rows. A file that can't be read is
kept apart, never an error. Everything is derived from the files by key, so doing it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.streaming.resume import keep_best

#: What makes two inputs the same, and the states whose rows count.
IDENTITY = ("pdf_sha256", "text_extractor_version", "ocr_config_version", "header_parser_version")
USABLE = ("succeeded", "partial")
UNSET = "retryable_failed"


def result_files(spark: SparkSession, folder: str, row_schema: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """url, status, parser_version, identity, stats, rows, n_rows, file, modified, corrupt (the text of what can't be read) of every result file; no folder gives no rows."""
    fields = ", ".join(f"{c} string" for c in ("url", "status", "parser_version", *identity))
    schema = f"{fields}, stats map<string, long>, rows array<struct<{row_schema}>>, _corrupt_record string"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{fields}, stats map<string, long>, rows array<struct<{row_schema}>>, n_rows int, file string, modified timestamp, corrupt string")
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json").json(folder)
    corrupt = F.coalesce("_corrupt_record", F.when(F.col("url").isNull() | (F.col("url") == ""), F.lit("no url")))
    return read.select("url", "status", "parser_version", *identity, "stats", "rows", F.coalesce(F.array_size("rows"), F.lit(0)).alias("n_rows"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), corrupt.alias("corrupt"))


def current_results(files: DataFrame, parser_version: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """One result of each url of this parser version: the one that was written last; ties go to the greater file name."""
    good = files.filter(F.col("corrupt").isNull() & (F.col("parser_version") == parser_version)).drop("corrupt")
    rest = [c for c in good.columns if c != "url"]
    return good.groupBy("url").agg(F.max_by(F.struct(*rest), F.struct("modified", "file")).alias("_last")).select("url", "_last.*")


def saved(previous: DataFrame, attempt: DataFrame, parser_version: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """The results after an attempt: of both the better one, where the previous is of the same parser and input; see ``keep_best``."""
    same = previous.filter(F.col("parser_version") == parser_version)
    return keep_best(same, attempt, "url", list(identity))


def recovered_state(state: DataFrame, files: DataFrame, parser_version: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """State rows (url, status, parser_version, identity, attempts and more) with what the files say in place of what they say themselves: a full outer merge by url.

    A file without a status means that its run was cut off. Urls that only the files know come in with one attempt; columns of the state that files don't have stay."""
    found = current_results(files, parser_version, identity)
    told = found.select(F.col("url").alias("_url"), F.coalesce("status", F.lit(UNSET)).alias("_status"), F.col("parser_version").alias("_parser_version"), *[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in identity])
    joined = state.join(told, F.col("url") == F.col("_url"), "full_outer")
    own = {"url": F.coalesce("url", "_url"), "status": F.coalesce("_status", "status"), "parser_version": F.coalesce("_parser_version", "parser_version")} | {c: F.coalesce(f"_{c}", c) for c in identity}
    if "attempts" in state.columns:
        own["attempts"] = F.coalesce("attempts", F.lit(1).cast(state.schema["attempts"].dataType))
    return joined.select(*[own[c].alias(c) if c in own else F.col(c) for c in state.columns])


def legacy_state(urls: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """State of urls that an old run listed as processed: succeeded once, by an unknown parser, so that they are tried anew by a newer one."""
    return urls.select("url").distinct().select("url", F.lit("succeeded").alias("status"), F.lit("").alias("parser_version"), *[F.lit("").alias(c) for c in identity], F.lit(1).alias("attempts"))


def result_stats(files: DataFrame, parser_version: str) -> DataFrame:
    """name, n: counts of all current results added up."""
    return current_results(files, parser_version).select(F.explode("stats").alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n"))


def rebuilt_rows(files: DataFrame, parser_version: str) -> DataFrame:
    """Rows of the results that count, each result once: a crash can neither lose nor double them."""
    return current_results(files, parser_version).filter(F.col("status").isin(*USABLE)).select("url", F.posexplode("rows").alias("at", "r")).select(F.col("url").alias("result_url"), "at", "r.*")


def unreadable(files: DataFrame) -> DataFrame:
    """file, corrupt of what couldn't be read."""
    return files.filter("corrupt IS NOT NULL").select("file", "corrupt")
