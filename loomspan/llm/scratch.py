"""Written tables in the shared folder, and helpers that every operator needs."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: A small side is broadcast only if a count shows that it has no more rows than this.
BROADCAST_ROWS = 20_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset (tests), a temporary one is made and set.

    A cluster without the setting is refused: a machine-local folder would lose files there.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir() or spark.conf.get("loomspan.scratch", "")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomspan-")
        spark.conf.set("loomspan.scratch", found)
    return found.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context, so that they need no path of the driver's."""
    sc = spark.sparkContext
    if getattr(sc, "_loomspan_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="loomspan-py-"), "loomspan.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._loomspan_shipped = True


class Scratch:
    """Tables of one operator call: each is written once, so a lost executor costs no recomputation."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/loomspan/{name}-{uuid.uuid4().hex}"
        self.made = 0
        self.tables: list[DataFrame] = []

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.made}"
        self.made += 1
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.tables.append(out)
        return out

    def settle(self) -> None:
        """Let go of shuffle files that only finished steps have read: the JVM finds them when it collects garbage, and
        deletes them a moment later. One local process has no need to wait for that."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.05 if re.match(r"local(\[|$)", self.spark.sparkContext.master or "") else 0.5)

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(conf).delete(path, True)

    def release(self, *kept: DataFrame) -> None:
        """Delete every table but those, and let go of finished shuffles: for the last step, which reads nothing else."""
        stay = {table._scratch_path for table in kept}
        self.drop(*[table for table in self.tables if table._scratch_path not in stay])
        self.tables = list(kept)
        self.settle()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its row count allows it; beyond that Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The named columns alone, in that order and type; extra columns, whatever their names, fall away."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()])


def word_list(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words; counted as splits, less the empty pieces at either end."""
    plain = F.coalesce(text, F.lit(""))
    pieces = F.split(plain, SPACES)
    count = F.size(pieces) - (F.element_at(pieces, 1) == "").cast("int") - ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    return F.greatest(count, F.lit(0)).cast("long")
