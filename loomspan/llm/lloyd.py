"""Plain Lloyd clustering of integer vectors.

Vectors are rounded to integers once and written. In every round the centroids are broadcast (``k`` rows, whatever the input),
``mapInPandas`` takes integer squared differences to each centroid in numpy and the lowest index of the least, and gives
one row of integer sums per centroid and partition; ``groupBy`` merges those. Sums and distances are integers throughout, so no order of
adding and no number of partitions changes a result. Only k rows reach the driver in a round.

The first centroids are the kept vectors with the smallest SHA-256 of ``<seed>:<vec_id>``; equal ids are taken in the order
of their components, null ids last. Fewer vectors than ``k`` give fewer centroids.

Nulls: a vector that is null, of another length or holds null, NaN or infinite components takes no part, and neither does
one with a rounded component beyond ``WIDEST``, whose squared distance need not fit a long. A row without an id is clustered
like any other. Repeated rows each count. Extra columns fall away. No vectors give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, ship, with_columns

K, DIMS, SCALE, ROUNDS, SEED = 16, 64, 64, 3, 1
#: 64 squares of differences of such components stay below 2**63.
WIDEST = (1 << 27) - 1
#: Components are held as big-endian numbers above zero, so that vectors sort as bytes in the order of their components.
_SHIFT = 1 << 31


def _rounded(dims: int, scale: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False))
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x)
                fits = (np.abs(x) <= WIDEST).all(1)  # false for NaN
            v = (x[fits] + _SHIFT).astype(">u4")
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fits)), pa.array([row.tobytes() for row in v], pa.binary())], ["vec_id", "v"])

    return run


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), ">u4").reshape(-1, dims).astype(np.int64) - _SHIFT


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid; ties go to the smaller number."""
    distances = np.stack([np.square(x - c).sum(1) for c in centroids])
    cluster = distances.argmin(0)
    return cluster, distances[cluster, np.arange(len(x))]


def _sums(centroids, dims: int):
    def run(frames):
        import pandas as pd

        c = centroids.value
        n, total = np.zeros(len(c), np.int64), np.zeros((len(c), dims), np.int64)
        for frame in frames:
            x = _matrix(frame["v"], dims)
            cluster, _ = nearest(x, c)
            order = cluster.argsort(kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            if len(found):
                n[found] += np.bincount(cluster, minlength=len(c))[found]
                total[found] += np.add.reduceat(x[order], starts)
        seen = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": seen.astype(np.int32), "n": n[seen]} | {f"s{j}": total[seen, j] for j in range(dims)})

    return run


def _assigned(centroids, dims: int):
    def run(frames):
        import pandas as pd

        for frame in frames:
            cluster, distance = nearest(_matrix(frame["v"], dims), centroids.value)
            yield pd.DataFrame({"id": frame["id"], "absent": frame["absent"], "cluster": cluster.astype(np.int32), "distance": distance})

    return run


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> np.ndarray:
    """The k vectors whose seeded id has the smallest hash, in that order."""
    ticket = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.withColumn("ticket", ticket).orderBy(F.col("ticket").asc_nulls_last(), "v").limit(k).collect()  # k rows
    return _matrix([row["v"] for row in rows], dims)


def lloyd(embeddings: DataFrame, k: int = K, dims: int = DIMS, scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every kept vector, as a written table, and the final centroids in their order."""
    spark = embeddings.sparkSession
    ship(spark)
    scratch = Scratch(spark, "lloyd")
    vectors = scratch.table(with_columns(embeddings, {"vec_id": "long", "embedding": "array<double>"}).mapInArrow(_rounded(dims, scale), "vec_id long, v binary"))
    centroids = first_centroids(vectors, k, dims, seed)
    sums = "cluster int, n long, " + ", ".join(f"s{j} long" for j in range(dims))
    for _ in range(rounds if len(centroids) else 0):
        held = spark.sparkContext.broadcast(centroids)
        parts = vectors.select("v").mapInPandas(_sums(held, dims), sums)
        merged = parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *[f"s{j}" for j in range(dims)])]).collect()  # k rows at most
        centroids = centroids.copy()
        for row in merged:
            centroids[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(dims)]
        held.unpersist()
    held = spark.sparkContext.broadcast(centroids)
    told = vectors.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("absent"), "v")  # a null would turn ids into floats
    assigned = told.mapInPandas(_assigned(held, dims), "id long, absent boolean, cluster int, distance long")
    return scratch.table(assigned.select(F.when(~F.col("absent"), F.col("id")).alias("vec_id"), "cluster", "distance")), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds each cluster's inertia, that of all, and a digest of its centroid."""
    spark: SparkSession = assigned.sparkSession
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows at most
    rows = [(i, inertia.get(i, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_lloyd(spark, sf_dir: str) -> DataFrame:
    return report(*lloyd(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def _sql(k: int = K, dims: int = DIMS, scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same in SQL: vectors as (row, dimension, component), one pair of steps a round."""
    steps = [
        f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "parts AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) ASC NULLS LAST, v) - 1 AS INTEGER) AS cluster, r AS own FROM kept)",
        f"m0 AS MATERIALIZED (SELECT cluster, j, x FROM c0 JOIN parts ON r = own WHERE cluster < {k})",
    ]
    for i in range(rounds + 1):
        steps.append(f"d{i} AS (SELECT p.r, m.cluster, CAST(sum((p.x - m.x) * (p.x - m.x)) AS BIGINT) AS distance FROM parts p JOIN m{i} m ON p.j = m.j GROUP BY ALL)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, cluster, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT cluster, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN parts USING (r) GROUP BY ALL)")
            steps.append(f"m{i + 1} AS MATERIALIZED (SELECT m.cluster, m.j, CASE WHEN n IS NULL THEN m.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM m{i} m LEFT JOIN s{i} s ON s.cluster = m.cluster AND s.j = m.j)")
    return f"""WITH {", ".join(steps)},
shas AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM m{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN shas USING (cluster)"""


SQL = _sql()
