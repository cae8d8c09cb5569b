"""Long repeats by a run-length compressed Burrows-Wheeler index.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else, in the same text or another.

1. Every window of ``LENGTH`` bytes is keyed by the smallest hash of the 64-byte strings in it, so equal windows have equal
   keys wherever they are. Neighbouring windows with one key make a stretch; stretches meet by key over the whole corpus.
   Stretches of equal bytes are one, and repeated from end to end if there are two of them.
2. Keys whose stretches are all equal, none with equal windows of its own, are settled by that. The other keys' different stretches are indexed, some keys to
   a group: suffixes are sorted by prefix doubling, which gives the Burrows-Wheeler transform; only where its runs end
   are suffixes sampled and compared. Between the samples the longest match with any other place falls by one with each
   byte, so matching statistics stream along the text from the samples alone. Matches of ``LENGTH`` bytes are marked.
3. A key with very many different stretches (a frequent passage in ever new surroundings) is first split by the hashes of
   longer strings of its windows, in steps up to the whole window, until no key has that many.

Nulls: a null text is an empty one. Rows that are repeated, or share an id, are texts of their own: whatever of them is
long enough is found in the other and goes. Texts shorter than ``LENGTH`` stay whole. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, ship, with_columns
from loomspan.llm.shingles import mixed

LENGTH = 400
#: Lengths of the strings whose smallest hash is the key; the later ones are for keys with more than CROWD stretches.
GRAMS, CROWD = (64, 232, 316, 358, 379, 390, 400), 4096
#: Bytes that are indexed together, and of a long text that are keyed at a time.
GROUP_BYTES, CHUNK = 1 << 20, 1 << 21
#: Symbols that are compared at once.
COMPARED = 1 << 18
LAST_ID = (1 << 63) - 1
_BYTE = np.random.default_rng(314159).integers(1, 1 << 63, 256, np.uint64)
_BASE, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_tables = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _tables
    if len(_tables[0]) < n:
        size = max(n, 1 << 16)
        _tables = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, x, np.uint64))]) for x in (_BASE, _BACK))
    return _tables


def _sliding(values: np.ndarray, w: int, least) -> np.ndarray:
    """Minimum (or maximum) of every w neighbours."""
    padded = np.full(-(-len(values) // w) * w, np.uint64((1 << 64) - 1) if least is np.minimum else np.uint64(0))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, w)
    ahead = least.accumulate(blocks, 1).ravel()
    behind = least.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    n = len(values) - w + 1
    return least(behind[:n], ahead[w - 1 : w - 1 + n])


def stretches(data: np.ndarray, gram: int, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of a text (bytes) the runs of windows with one key: keys, first and last window, hash of the bytes they cover, and
    whether the string that gives the key stands in it twice; without that no two of its windows are equal."""
    parts = []
    for at in range(0, len(data) - length + 1, CHUNK):
        part = data[at : at + CHUNK + length - 1]
        up, back = _powers(len(part) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[part] * up[: len(part)])])
        grams = mixed((sums[gram:] - sums[:-gram]) * back[: len(sums) - gram])
        w = length - gram + 1
        keys = _sliding(grams, w, np.minimum)
        n = len(keys)
        # A string is the smallest of some window around it if it equals the largest of those windows' keys.
        around = np.concatenate([np.zeros(w - 1, np.uint64), keys, np.zeros(w - 1, np.uint64)])
        lowest = np.flatnonzero(_sliding(around, w, np.maximum) == grams)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        last = np.append(first[1:], n) - 1
        content = mixed((sums[last + length] - sums[first]) * back[first] + (last - first).astype(np.uint64))
        values, number = np.unique(grams[lowest], return_inverse=True)
        stands = np.sort(number * (len(grams) + 1) + lowest)
        own = np.searchsorted(values, keys[first]) * (len(grams) + 1)
        inner = np.searchsorted(stands, own + last + w - 1, "right") - np.searchsorted(stands, own + first, "left") > 1
        parts.append((keys[first], first + at, last + at, content, inner))
    if not parts:
        return tuple(np.zeros(0, x) for x in (np.uint64, np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class RunLengthIndex:
    """Run-compressed transform of several texts, each ended by a mark of its own, with the suffixes at its runs' ends."""

    def __init__(self, texts: list[bytes]):
        ends = np.cumsum([len(x) + 1 for x in texts])
        self.ends = ends
        k = len(texts)
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + np.int32(k)
        symbols[ends - 1] = np.arange(k)
        n = len(symbols)
        # Ranks of the suffixes by their first 2, 4, 8, ... symbols; a suffix that is alone keeps its rank. Only the last ranks are held.
        key = symbols * np.int64(k + 257)
        key[:-1] += symbols[1:] + 1
        order = np.argsort(key, kind="stable")
        change = np.flatnonzero(np.diff(key[order], prepend=-1))
        del key
        runs = np.diff(np.append(change, n))
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(change, runs)  # the place of the first suffix of the same rank
        active = np.sort(order[np.repeat(runs > 1, runs)]).astype(np.int32)
        del order, change, runs
        width = 2
        while len(active):
            behind = np.zeros(len(active), np.int32)
            inside = active < n - width
            behind[inside] = rank[active[inside] + width] + 1
            pair = np.lexsort((behind, rank[active]))
            active, behind = active[pair], behind[pair]
            del pair, inside
            r = rank[active]
            head = np.diff(r, prepend=-1) != 0
            new = head | (np.diff(behind, prepend=-1) != 0)
            del behind
            at = np.arange(len(active), dtype=np.int32)
            first = np.maximum.accumulate(np.where(head, at, 0))
            start = np.maximum.accumulate(np.where(new, at, 0))
            rank[active] = r + (start - first)
            del r, first, start, at, head
            active = active[~(new & np.append(new[1:], True))]
            width *= 2
        suffixes = np.empty(n, np.int32)
        suffixes[rank] = np.arange(n, dtype=np.int32)
        del rank
        transform = symbols[suffixes - 1]  # before the first symbol stands the last mark, which is unique too
        self.n, self.symbols = n, symbols
        self.run_heads = np.flatnonzero(transform[1:] != transform[:-1]) + 1
        self.run_symbols = transform[np.concatenate([[0], self.run_heads])]
        self.head_samples, self.end_samples = suffixes[self.run_heads].astype(np.int64), suffixes[self.run_heads - 1].astype(np.int64)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j, compared symbol by symbol.

        Marks are unique, so a comparison ends within the texts; at the ends of runs all of them together take time by n log n at most."""
        got, open_, width = np.zeros(len(i), np.int64), np.arange(len(i)), 16
        padded = np.append(self.symbols, np.full(COMPARED, -1, np.int32))
        while len(open_):
            step, rest = max(1, COMPARED // width), []
            for a in range(0, len(open_), step):
                at = open_[a : a + step]
                x, y = i[at] + got[at], j[at] + got[at]
                differ = padded[x[:, None] + np.arange(width)] != padded[y[:, None] + np.arange(width)]
                some = differ.any(1)
                got[at] += np.where(some, differ.argmax(1), width)
                rest.append(at[~some])
            open_, width = np.concatenate(rest), min(width * 4, COMPARED)
        return got

    def matching_statistics(self) -> np.ndarray:
        """At each place the length of the longest match with any other place, streamed from the sampled run ends."""
        best = np.zeros(self.n, np.int64)
        lengths = self.common(self.head_samples, self.end_samples)
        np.maximum.at(best, self.head_samples, lengths)
        np.maximum.at(best, self.end_samples, lengths)
        at = np.arange(self.n)
        return np.maximum(np.maximum.accumulate(best + at) - at, 0)

    def repeats(self, length: int) -> list[list[tuple[int, int]]]:
        """Of each text the ranges (first, last) of windows of that length that also start elsewhere."""
        long_ = self.matching_statistics() >= length
        out, start = [], 0
        for end in self.ends:
            edges = np.flatnonzero(np.diff(np.concatenate([[False], long_[start:end], [False]]).astype(np.int8)))
            out.append([(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)])
            start = end
        return out


def _keyed(length):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            docs, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for doc, tag, text in zip(docs, tags, batch.column(2).cast(pa.binary()), strict=True):
                key, first, last, content, inner = stretches(np.frombuffer(text.as_py(), np.uint8), GRAMS[0], length)
                found.append((key.view(np.int64), content.view(np.int64), np.full(len(key), doc), np.full(len(key), tag), first, last, inner))
            columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [*[np.zeros(0, np.int64)] * 6, np.zeros(0, bool)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c), k) for c, k in zip(columns, kinds, strict=True)], ["m", "c", "doc", "tag", "first", "last", "inner"])

    return run


def _fetched(length):
    """The bytes of stretches: (m, c, bytes) from a text and its list of (m, c, first, last)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for text, wanted in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
                text, rows = text.as_py(), wanted.as_py()
                columns = [[r["m"] for r in rows], [r["c"] for r in rows], [text[r["first"] : r["last"] + length] for r in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, [pa.int64(), pa.int64(), pa.binary()], strict=True)], ["m", "c", "bytes"])

    return run


def _split(gram, length):
    """Stretches by the hashes of longer strings: (m, c, bytes, of_m, of_c, at, inner); at: the first window's place in the old one."""

    def run(batches):
        import pyarrow as pa

        names, kinds = ["m", "c", "bytes", "of_m", "of_c", "at", "inner"], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        for batch in batches:
            rows = []
            for m, c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = data.as_py()
                key, first, last, content, inner = stretches(np.frombuffer(data, np.uint8), gram, length)
                key = mixed(key ^ np.int64(m).astype(np.uint64)).view(np.int64)
                rows += [(int(k), int(h), data[a : b + length], m, c, int(a), bool(x)) for k, a, b, h, x in zip(key, first, last, content.view(np.int64), inner, strict=True)]
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[i : i + 4096], strict=True), kinds, strict=True)], names)

    return run


def _indexed(length):
    def run(table):
        import pyarrow as pa

        m, c, texts = (table.column(x).to_pylist() for x in ("m", "c", "bytes"))
        keys, order = np.array(m), np.argsort(np.array(m), kind="stable")
        rows, part, held = [], [], 0
        # Keys that are whole make up an index each time GROUP_BYTES have come together.
        for x, i in enumerate(order):
            part.append(i)
            held += len(texts[i])
            if x + 1 == len(order) or (held >= GROUP_BYTES and keys[order[x + 1]] != keys[i]):
                for j, ranges in zip(part, RunLengthIndex([texts[j] for j in part]).repeats(length), strict=True):
                    rows += [(m[j], c[j], a, b) for a, b in ranges]
                part, held = [], 0
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table([pa.array(x, k) for x, k in zip(columns, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)], names=["m", "c", "a", "b"])

    return run


def _crowds(rows: DataFrame) -> DataFrame:
    """m, crowd: number of stretches of each key that has more than one, or one that may hold two equal windows."""
    return rows.groupBy("m").agg(F.count(F.lit(1)).alias("crowd"), F.max("inner").alias("inner")).filter("crowd > 1 or inner").select("m", "crowd")


def marked(documents: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """doc, tag, ranges of windows (a to b) that are repeated, of documents (doc, tag, text; none null)."""
    found = scratch.table(documents.mapInArrow(_keyed(length), "m long, c long, doc long, tag int, first int, last int, inner boolean"))
    size = F.col("last") - F.col("first")
    kinds = scratch.table(found.groupBy("m", "c", size.alias("size")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "tag", "first")).alias("at"), F.max("inner").alias("inner")))
    whole = kinds.filter("n > 1").select("m", "c", F.lit(0).alias("a"), F.col("size").alias("b"))
    open_ = kinds.join(_crowds(kinds), "m").select("m", "c", "crowd", "at.doc", "at.tag", "at.first", (F.col("at.first") + F.col("size")).alias("last"))
    wanted = open_.groupBy("doc", "tag").agg(F.collect_list(F.struct("m", "c", "first", "last")).alias("wanted"))  # as many as the text has stretches
    texts = documents.join(wanted, ["doc", "tag"]).select("text", "wanted").mapInArrow(_fetched(length), "m long, c long, bytes binary")
    texts = scratch.table(texts.dropDuplicates(["m", "c"]))
    crowded = texts.join(open_.filter(F.col("crowd") > CROWD).select("m").distinct(), "m", "left_semi")
    calm, marks = texts.join(open_.filter(F.col("crowd") > CROWD).select("m").distinct(), "m", "left_anti"), [whole]
    back = None  # rows (m, c) -> (of_m, of_c, at): where a split stretch stands in the one that it was cut from
    for gram in GRAMS[1:]:
        crowded = scratch.table(crowded)
        if crowded.isEmpty():
            break
        cut = scratch.table(crowded.mapInArrow(_split(gram, length), "m long, c long, bytes binary, of_m long, of_c long, at int, inner boolean"))
        link = cut.select("m", "c", "of_m", "of_c", "at")
        if back is not None:
            names = {"m": "of_m", "c": "of_c", "of_m": "old_m", "of_c": "old_c", "at": "old_at"}
            older = back.select(*[F.col(old).alias(new) for old, new in names.items()])
            link = link.join(older, ["of_m", "of_c"]).select("m", "c", F.col("old_m").alias("of_m"), F.col("old_c").alias("of_c"), (F.col("at") + F.col("old_at")).alias("at"))
        back = scratch.table(link)
        parts = cut.groupBy("m", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("bytes")).alias("size"), F.max("inner").alias("inner"))
        parts = scratch.table(parts)
        twice = parts.filter("n > 1").select("m", "c", F.lit(0).alias("a"), (F.col("size") - length).cast("int").alias("b"))
        crowd = scratch.table(_crowds(parts))
        unique = cut.select("m", "c", "bytes").join(crowd.select("m"), "m").dropDuplicates(["m", "c"])
        # Whole windows that are equal are one by now, whatever their number.
        most = CROWD if gram < GRAMS[-1] else LAST_ID
        settled = unique.join(crowd.filter(F.col("crowd") <= most), "m", "left_semi")
        deep = _index(scratch.table(settled), scratch, length).union(twice)
        deep = deep.join(back, ["m", "c"]).select(F.col("of_m").alias("m"), F.col("of_c").alias("c"), (F.col("a") + F.col("at")).alias("a"), (F.col("b") + F.col("at")).alias("b"))
        marks.append(scratch.table(deep))
        crowded = unique.join(crowd.filter(F.col("crowd") > most), "m", "left_semi")
    marks.append(_index(scratch.table(calm), scratch, length))
    marks = scratch.table(_union(marks))
    scratch.settle()
    hits = found.join(marks, ["m", "c"]).select("doc", "tag", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
    return hits.groupBy("doc", "tag").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))  # of disjoint or equal stretches of one text


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def _index(texts: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    total = texts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    groups = max(64, -(-total // GROUP_BYTES))
    grouped = texts.withColumn("part", F.pmod(F.xxhash64("m"), F.lit(groups)))
    # By number, as each byte takes far longer here than it took to shuffle, so small partitions must not be put together.
    tasks = int(min(groups, max(256, 8 * scratch.spark.sparkContext.defaultParallelism)))
    return scratch.table(grouped.repartition(tasks, "part").groupBy("part").applyInArrow(_indexed(length), "m long, c long, a int, b int"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, keep: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with ``keep`` also kept (bytes) and spans ([a, b) in bytes)."""
    spark = documents.sparkSession
    ship(spark)
    scratch = Scratch(spark, "repeats")
    docs = with_columns(documents, {"doc_id": "long", "text": "string"}).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.hash("text").alias("tag"), "text")
    ranges = scratch.table(marked(docs.select("doc", "tag", "text"), scratch, length).withColumnsRenamed({"doc": "of_doc", "tag": "of_tag"}))
    scratch.settle()
    joined = docs.join(ranges, (F.col("doc") == F.col("of_doc")) & (F.col("tag") == F.col("of_tag")), "left").select("doc_id", "text", "ranges")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sizes, gone, spans, digests, kept, cuts = [], [], [], [], [], []
            for text, ranges in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                text, rows = text.as_py(), sorted((r["a"], r["b"] + length) for r in ranges.as_py() or ())
                merged = []
                for a, b in rows:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                rest = b"".join(text[x:y] for x, y in zip([0, *[b for _, b in merged]], [*[a for a, _ in merged], len(text)], strict=True))
                sizes.append(len(text))
                gone.append(len(text) - len(rest))
                spans.append(len(merged))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if keep else None)
                cuts.append([{"a": a, "b": b} for a, b in merged] if keep else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            more = [pa.array(kept, pa.binary()), pa.array(cuts, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))] if keep else []
            yield pa.RecordBatch.from_arrays([*columns, *more], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"][: len(more)]])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<a:int,b:int>>" * keep
    return joined.mapInArrow(run, schema)


def op10_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every 400-byte string of every text as hexadecimal digits, cut from blocks, as reaching far into a long text takes time.
SQL = r"""WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  blocks AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 2 * (512 + 399)) AS piece FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 512)) AS pos FROM texts)),
  starts AS (SELECT doc_id, pos + i AS s, hash(substr(piece, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, pos, piece, unnest(range(0, len(piece) // 2 - 399)) AS i FROM blocks)),
  twice AS (SELECT k FROM starts GROUP BY k HAVING count(*) > 1),
  hits AS (SELECT doc_id, s, s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 AS apart FROM starts WHERE k IN (SELECT k FROM twice)),
  runs AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM (SELECT doc_id, s, sum(CAST(coalesce(apart, false) AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM hits) GROUP BY doc_id, run),
  pieces AS (SELECT r.doc_id, r.a, r.b, substr(t.h, 2 * coalesce(lag(r.b) OVER w, 0) + 1, 2 * (r.a - coalesce(lag(r.b) OVER w, 0))) AS before, t.h FROM runs r JOIN texts t ON t.doc_id = r.doc_id WINDOW w AS (PARTITION BY r.doc_id ORDER BY r.a)),
  cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM pieces GROUP BY doc_id)
SELECT t.doc_id, CAST(len(t.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, t.h))) AS kept_sha256
  FROM texts t LEFT JOIN cut ON cut.doc_id = t.doc_id"""
