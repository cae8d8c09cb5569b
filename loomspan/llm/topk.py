"""Exact top-k by inner product with KD-trees per shard.

Vectors are dealt to shards of bounded size by a hash of their id. In a shard a KD-tree halves the points at the median
of the widest side, each node with its tight bounding box. For a query q no point of a box scores above
``max(q, 0) . upper + min(q, 0) . lower``; nodes are visited best bound first until the best is below the k-th score so
far. Each query first searches one home shard; the k-th score found there goes with it to all others, so that their
search starts with it. Ties go to the smaller id, so a box is left out only if its bound is below the k-th score.

Nulls: a vector that is null, empty or holds null, NaN or infinite components takes no part, nor does one with a rounded component beyond ``WIDEST``, and so does a row without an
id. Only vectors of the query's length are its candidates. Equal rows count once. Scores are exact where sums of
products stay below 2**53, and taken in 64-bit integers beyond. No queries or no candidates give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, ship, with_columns

K, SCALE, EVERY = 5, 256, 50
#: Vectors of a shard, points of a leaf, and queries that a shard is searched for at once: its points are sent once for each such block.
SHARD, LEAF, QUERY_BLOCK = 8192, 128, 16_384
#: Components beyond this have no exact products in 64-bit integers.
WIDEST = 1 << 28


class Tree:
    """KD-tree over integer points (float64 or int64 rows): nodes as arrays, children of i at left[i] and left[i] + 1."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        start, stop, left, lower, upper = [0], [len(ids)], [], [], []
        i = 0
        while i < len(start):
            at = order[start[i] : stop[i]]
            box = points[at]
            lower.append(box.min(0))
            upper.append(box.max(0))
            if len(at) > leaf:
                axis = int((upper[-1] - lower[-1]).argmax())
                half = len(at) // 2
                order[start[i] : stop[i]] = at[np.argpartition(box[:, axis], half)]
                left.append(len(start))
                start += [start[i], start[i] + half]
                stop += [start[i] + half, stop[i]]
            else:
                left.append(-1)
            i += 1
        self.ids, self.points = ids[order], points[order]
        self.start, self.stop, self.left = start, stop, left
        self.lower, self.upper = np.array(lower), np.array(upper)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> list[tuple[int, int, int]]:
        """(query, point, score) of each query's k best, but for those below ``least`` of the query."""
        bounds = np.maximum(queries, 0) @ self.upper.T + np.minimum(queries, 0) @ self.lower.T
        out = []
        for i, query in enumerate(query_ids):
            bound, best, kth = bounds[i], [], least[i]  # best: heap of (score, -id), the worst first
            open_ = [(-bound[0], 0)]
            while open_:
                below, node = heapq.heappop(open_)
                if -below < kth:
                    break
                child = self.left[node]
                if child >= 0:
                    for x in (child, child + 1):
                        if bound[x] >= kth:
                            heapq.heappush(open_, (-bound[x], x))
                    continue
                a, b = self.start[node], self.stop[node]
                scores = self.points[a:b] @ queries[i]
                for j in np.flatnonzero(scores >= kth):
                    point = int(self.ids[a + j])
                    if point == query:
                        continue
                    entry = (int(scores[j]), -point)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    if len(best) == k:
                        kth = max(kth, best[0][0])
            out += [(int(query), -p, s) for s, p in best]
        return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(len(column), -1)


def _searcher(k: int):
    def run(points, queries):
        import pandas as pd

        columns = ["query_id", "vec_id", "score"]
        if not len(points) or not len(queries):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        x, q = _matrix(points["v"]), _matrix(queries["q"])
        if float(np.abs(x).max(initial=1)) * float(np.abs(q).max(initial=1)) * x.shape[1] < 2**53:
            x, q = x.astype(np.float64), q.astype(np.float64)
        tree = Tree(points["vec_id"].to_numpy(), x)
        least = queries["kth"].fillna(-(2.0**62)).to_numpy()
        return pd.DataFrame(tree.search(queries["query_id"].to_numpy(), q, k, least), columns=columns).astype(np.int64)

    return run


def _rounded(scale: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, dims, out = [], [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = vector.as_py()
                if vec_id is None or not values or any(x is None for x in values):
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * np.array(values, np.float64))
                if (np.abs(x) <= WIDEST).all():  # false for NaN
                    ids.append(vec_id)
                    dims.append(len(x))
                    out.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "v"])

    return run


def top_k(embeddings: DataFrame, k: int = K, scale: int = SCALE, every: int = EVERY, shard_rows: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose id ``every`` divides its k best other rows."""
    spark = embeddings.sparkSession
    ship(spark)
    scratch = Scratch(spark, "topk")
    rows = with_columns(embeddings, {"vec_id": "long", "embedding": "array<double>"}).mapInArrow(_rounded(scale), "vec_id long, dim int, v binary").distinct()
    rows = scratch.table(rows)
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    points = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    queries = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("dim").alias("q_dim"), F.col("v").alias("q"))
    blocks = max(1, -(-n // (every * QUERY_BLOCK)))
    queries = queries.withColumn("home", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(shards)).cast("int")).withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(2)), F.lit(blocks)).cast("int"))
    kind = "query_id long, vec_id long, score long"
    at_home = queries.select("q_dim", "home", "query_id", "q", F.lit(None).cast("double").alias("kth"))
    first = points.groupBy("dim", "shard").cogroup(at_home.groupBy("q_dim", "home")).applyInPandas(_searcher(k), kind)
    first = scratch.table(first)
    kth = first.groupBy("query_id").agg(F.min("score").cast("double").alias("kth"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select("query_id", "kth")
    away = queries.join(kth, "query_id", "left").withColumn("q_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("q_shard <> home")
    away = away.select("q_dim", "q_shard", F.col("block").alias("q_block"), "query_id", "q", "kth")
    dealt = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rest = dealt.groupBy("dim", "shard", "block").cogroup(away.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(_searcher(k), kind)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows for each shard
    ranked = first.union(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_kdtree_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM rows q JOIN rows p ON q.vec_id <> p.vec_id AND len(q.v) = len(p.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
