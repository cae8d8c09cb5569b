"""Files in and out: JSON envelopes, per-document results, PDF checks, new-only outputs, marked text sections."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.text import sku_tokens


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_loomspan_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="loomspan-py-"), "loomspan.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._loomspan_shipped = True


def read_envelope(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """Rows of one list in a JSON envelope; fields that aren't there are null."""
    whole = spark.read.schema(f"`{field}` array<struct<{schema}>>").option("multiLine", True).json(path)
    return whole.select(F.explode(field).alias("r")).select("r.*")


def read_results(spark: SparkSession, folder: str, schema: str, parser_version: str | None = None) -> DataFrame:
    """Per-document result files of one parser version; unreadable ones are skipped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).json(folder)
    return rows if parser_version is None else rows.filter(F.col("parser_version") == parser_version)


def excluded_skus(texts: DataFrame) -> DataFrame:
    """Distinct 12-digit numbers in any cell of column ``value``."""
    return texts.select(F.explode(sku_tokens(F.col("value"))).alias("sku")).distinct()


def pdf_checks(files: DataFrame, most_bytes: int = 100 << 20) -> DataFrame:
    """path, bytes, sha256, problem of a ``binaryFile`` frame; problem is null for a usable file."""
    size = F.length("content")
    problem = F.when(size <= 1024, "too small").when(size > most_bytes, "too large").when(F.substring("content", 1, 5) != F.lit(b"%PDF-"), "not a PDF")
    return files.select("path", size.cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"), problem.alias("problem"))


def fetch_list(urls: DataFrame, manifest: DataFrame) -> DataFrame:
    """Links whose file isn't there yet: not in the manifest with success, or with another digest than the file on disk (on_disk)."""
    usable = manifest.filter(F.col("status").isin("ok", "cached", "downloaded") & F.col("sha256").eqNullSafe(F.col("on_disk")))
    return urls.join(usable.select("url").distinct(), "url", "left_anti")


def fetch(urls: DataFrame, fetcher, parallel: int = 12) -> DataFrame:
    """url, status, error, content of links, by an injected ``fetcher(url) -> bytes``, at most ``parallel`` at a time."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for url in pdf["url"]:
                try:
                    rows.append((url, "downloaded", "", fetcher(url)))
                except Exception as error:  # a link's failure is a result
                    rows.append((url, "failed", f"{type(error).__name__}: {error}", None))
            yield pd.DataFrame(rows, columns=["url", "status", "error", "content"])

    return urls.select("url").repartition(parallel).mapInPandas(run, "url string, status string, error string, content binary")


def write_new(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Write a table where none is yet; an existing one is refused."""
    df.write.format(kind).mode("errorifexists").save(path)


def formula_errors(cells: DataFrame) -> DataFrame:
    """Cells (column value) that hold a spreadsheet error."""
    return cells.filter(F.col("value").rlike(r"#REF!|#DIV/0!|#VALUE!|#NAME\?|#N/A"))


def replace_section(text: str, name: str, body: str) -> str:
    """``text`` with the section between the marks of ``name`` replaced, or added at the end; doing it twice changes nothing."""
    begin, end = f"<!-- BEGIN {name} -->", f"<!-- END {name} -->"
    section = f"{begin}\n{body.strip()}\n{end}"
    if begin in text and end in text:
        return text[: text.index(begin)] + section + text[text.index(end) + len(end) :]
    return (text.rstrip() + "\n\n" if text.strip() else "") + section + "\n"


def to_envelope(**frames: DataFrame) -> DataFrame:
    """One row with a JSON list for each frame: for small deliveries, whose size the caller knows."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    return out


def letter_cell(column: Column, row: Column) -> Column:
    return F.concat(column, row.cast("string"))
