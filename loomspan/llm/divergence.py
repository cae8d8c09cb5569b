"""Audit of how far the sources of a language diverge in their terms.

Tokens: the bytes of many texts lie in one buffer; a lookup table turns each byte into its lower-cased letter or a gap, and
edges of letter runs are the boundaries. Slices are grouped by xxhash and each is compared with its group's first slice
byte by byte, so a collision costs time and never a count. Counts per text are folded to counts per (lang, source) as sorted
row-column numbers with ``reduceat``. A task sends each (lang, source, term) once for ``PART_BYTES`` of text, already added up.

All rows of a term of one language meet in one place by one shuffle; there sources are summed and the terms in fewer than
``KEPT_DOCS`` texts of the language go. What is left is written once. Pairs of sources are compared in buckets of terms: a
bucket is a CSR matrix (row: source, column: term), and for a source's dense row the divergences from all other rows come
from one ``reduceat`` over the stored entries, plus a closed form for the entries that are zero. Sums over buckets are added
by ``groupBy``. Shares are integers, floor(10**9 * ratio), so every order of adding gives the same.

Nulls: a null text, lang or source counts as an empty one. Repeated rows each count. A group without terms has every kept term
zero times; a language without kept terms has value 0 for each pair and no terms. Values that tie are ranked by the item's
bytes. Extra columns fall away. No rows give no rows. Memory of a task is some thirty times the longest text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, ship, small, with_columns

KEPT_DOCS, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of text that are tokenised and added up at once, and bytes that are compared at once.
PART_BYTES, COMPARE = 8_000_000, 1_000_000
#: Entries of a bucket of terms (more where there are many sources, up to the second), and sources a task takes as first of a pair.
BUCKET_ROWS, MOST_BUCKET_ROWS, BLOCK = 8_192, 1_000_000, 256

#: Byte -> its lower-cased letter, or 0 for all ASCII that is no letter.
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[65:91] += 32
_LETTER[[*range(65), *range(91, 97), *range(123, 128)]] = 0


def boundaries(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that lie in ``data`` one after another (text i in bounds[i]:bounds[i + 1]): lower-cased bytes, starts, ends of terms."""
    letters = _LETTER[data]
    inside = letters != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    seams = bounds[(bounds > 0) & (bounds < len(data))]  # a term never crosses texts
    first[seams] = inside[seams]
    last[seams - 1] = inside[seams - 1]
    return letters, np.flatnonzero(first), np.flatnonzero(last) + 1


def _same_bytes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: np.ndarray) -> bool:
    """Whether every slice equals that of the number given for it in ``model``."""
    lengths = ends - starts
    if (lengths != lengths[model]).any():
        return False
    reach = np.concatenate([[0], np.cumsum(lengths)])
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(reach, reach[a] + COMPARE)) - 1)
        within = np.arange(reach[b] - reach[a]) - np.repeat(reach[a:b] - reach[a], lengths[a:b])
        if (letters[np.repeat(starts[a:b], lengths[a:b]) + within] != letters[np.repeat(starts[model[a:b]], lengths[a:b]) + within]).any():
            return False
        a = b
    return True


def grouped(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest: Callable[[bytes], int] | None = None) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and for each slice the number of its own among them."""
    import xxhash

    digest, raw = digest or xxhash.xxh3_64_intdigest, letters.tobytes()
    slices = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    hashes = np.fromiter(map(digest, slices), np.uint64, len(slices))
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    if _same_bytes(letters, starts, ends, first[number]):
        return [slices[i] for i in first.tolist()], number
    told = {s: i for i, s in enumerate(dict.fromkeys(slices))}  # two terms share a hash: their bytes tell them apart
    return list(told), np.fromiter(map(told.__getitem__, slices), np.int64, len(slices))


def matrix(texts, rows: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, and sorted entries of their count matrix (row, column, occurrences, texts); text i, of an Arrow array, is in row rows[i]."""
    import pyarrow as pa

    held = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    bounds = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    letters, starts, ends = boundaries(data, bounds)
    terms, column = grouped(letters, starts, ends)
    width = max(1, len(terms))
    text = np.searchsorted(bounds, starts, "right") - 1
    entry, n = np.unique(text * width + column, return_counts=True)  # of one text
    at = rows[entry // width] * width + entry % width
    order = at.argsort(kind="stable")
    at, n = at[order], n[order]
    new = np.flatnonzero(np.diff(at, prepend=-1))
    occurrences = np.add.reduceat(n, new) if len(new) else n
    return terms, at[new] // width, at[new] % width, occurrences, np.diff(np.append(new, len(at)))


def _count(batches):
    import pyarrow as pa

    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        number = {k: i for i, k in enumerate(dict.fromkeys(names))}
        lang, source = (pa.array([k[i] for k in number], pa.string()) for i in range(2))
        rows = np.array([number[k] for k in names], np.int64)
        sizes = np.cumsum([0, *[v or 0 for v in batch.column(3).to_pylist()]])
        a = 0
        while a < len(names):
            b = max(a + 1, int(np.searchsorted(sizes, sizes[a] + PART_BYTES, "right")) - 1)
            terms, row, column, n, docs = matrix(batch.column(2).slice(a, b - a), rows[a:b])
            words = pa.array(terms, pa.binary()).cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(row)), source.take(pa.array(row)), words.take(pa.array(column)), pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])
            a = b


def kept_counts(documents: DataFrame, kept_docs: int = KEPT_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n (n in the language), first (on one row of each term of a language) of the kept terms."""
    ship(documents.sparkSession)
    texts = documents.select("lang", "source", "text", F.octet_length("text").alias("size"))
    # The sums are of (lang, source, term), and need no second shuffle as all rows of (lang, term) lie together already.
    counted = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    first = (F.row_number().over(term.orderBy("source")) == 1).cast("int").alias("first")
    return summed.select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"), first).filter(F.col("lang_docs") >= kept_docs).drop("lang_docs")


def _described(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with its number in the language, its size (tokens and smoothing), the language's, and how its pairs are dealt out."""
    groups = documents.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("first").alias("v"), F.count(F.lit(1)).alias("entries"))
    told = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").fillna(0, ["n", "lang_n", "v", "entries"])
    lang = W.partitionBy("lang")
    told = told.withColumn("number", F.row_number().over(lang.orderBy("source")) - 1).withColumn("sources", F.count(F.lit(1)).over(lang))
    room = F.least(F.greatest(F.lit(BUCKET_ROWS), F.col("sources") * F.col("sources")), F.lit(MOST_BUCKET_ROWS))
    return told.select(
        "lang", "source", "number", (F.col("n") + SMOOTH * F.col("v")).alias("size"), (F.col("lang_n") + SMOOTH * F.col("v")).alias("lang_size"),
        F.greatest(F.lit(1), F.ceil(F.col("entries") / room)).alias("buckets"), F.ceil(F.col("sources") / BLOCK).alias("blocks"),
    )


def _share(count: str, size: str) -> Column:
    return F.expr(f"1 + (CAST({count} + {SMOOTH} AS DECIMAL(20, 0)) * {UNIT}L) DIV CAST({size} AS DECIMAL(20, 0))").cast("long")


def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 5) / size), by long division in three steps that stay within 63 bits up to 10**15 tokens."""
    rest, out = count + SMOOTH, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // size
        rest = rest % size
    return 1 + out


def divergences(row: np.ndarray, column: np.ndarray, n: np.ndarray, size: np.ndarray, width: int, firsts: range) -> np.ndarray:
    """Sum over ``width`` columns of |share a - share b|, for each a of ``firsts`` (a row here) and every b (a column)."""
    order = np.lexsort((column, row))
    row, column, n = row[order], column[order], n[order]
    stored, zero = shares(n, size[row]), shares(np.zeros(len(size), np.int64), size)
    indptr = np.searchsorted(row, np.arange(len(size) + 1))
    filled = np.flatnonzero(np.diff(indptr))
    out = np.zeros((len(firsts), len(size)), np.int64)
    for i, a in enumerate(firsts):
        dense = np.full(width, zero[a])
        dense[column[indptr[a] : indptr[a + 1]]] = stored[indptr[a] : indptr[a + 1]]
        # As if all of b were zero: sums below and above its share, from sorted values.
        ranked = np.sort(dense)
        sums = np.concatenate([[0], np.cumsum(ranked)])
        below = np.searchsorted(ranked, zero)
        out[i] = zero * below - sums[below] + (sums[-1] - sums[below]) - zero * (width - below)
        # Then what b does hold.
        at = dense[column]
        if len(filled):
            out[i, filled] += np.add.reduceat(np.abs(at - stored) - np.abs(at - zero[row]), indptr[filled])
    return out


def _compared(key, terms, sources):
    import pandas as pd

    lang, _, block = key
    sources = sources.sort_values("number")
    names = sources["source"].to_numpy()
    firsts = range(block * BLOCK, min((block + 1) * BLOCK, len(names)))
    if len(terms):
        column, found = pd.factorize(terms["term"])
        value = divergences(terms["number"].to_numpy(np.int64), column, terms["n"].to_numpy(np.int64), sources["size"].to_numpy(np.int64), len(found), firsts)
    else:
        value = np.zeros((len(firsts), len(names)), np.int64)
    i, b = np.nonzero(np.arange(len(names))[None, :] > np.array(firsts)[:, None])
    return pd.DataFrame({"lang": lang, "source": names[i + firsts.start], "item": names[b], "value": value[i, b]})


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, both ways."""
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    own = groups.select("lang", "source", "number", "buckets", "blocks")
    terms = kept.select("lang", "source", "term", "n").join(own, ["lang", "source"])
    terms = terms.select("lang", F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), blocks, "number", "term", "n")
    fresh = groups.select(*[F.col(c).alias(c) for c in groups.columns])  # columns of its own, as both sides hold the groups
    every = fresh.select("lang", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "blocks", "source", "number", "size")
    every = every.select("lang", "bucket", blocks, "source", "number", "size")
    keys = ["lang", "bucket", "block"]
    parts = terms.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInPandas(_compared, "lang string, source string, item string, value long")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("way")
    return sums.select("lang", "value", ways).select("lang", "way.source", "way.item", "value")


def term_excess(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every kept term whose share in the group is above that in the language."""
    own = kept.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"])
    told = own.select("lang", "source", F.col("term").alias("item"), (_share("n", "size") - _share("lang_n", "lang_size")).alias("value"))
    return told.filter("value > 0")


def audit(documents: DataFrame, kept_docs: int = KEPT_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank; see the module."""
    scratch = Scratch(documents.sparkSession, "divergence")
    plain = with_columns(documents, {"lang": "string", "source": "string", "text": "string"}).fillna("")
    kept = scratch.table(kept_counts(plain, kept_docs))
    groups = small(scratch.table(_described(plain, kept)))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = pair_sums(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    terms = term_excess(kept, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).filter(F.col("rank") <= top)
    return pairs.union(terms)


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
counts AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
whole AS (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang),
cells AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * w.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (w.n + 5 * w.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN whole w ON w.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
