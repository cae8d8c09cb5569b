"""N-gram Jaccard join: links between texts whose sets of five-word shingles have a similarity of 0.8 or more, all of them.

1. Every whole text becomes a set; equal sets become one class, named by its smallest id, and only its first goes on.
2. How many classes hold a shingle is counted over all of them: shingles are dealt out by hash, packed, and each part is
   sorted. A shingle that is frequent within one packet is sent once with its number left out, and known as frequent.
3. In the order (frequent, count, hash) two sets that are similar enough share one of the first ``n - ceil(0.8 n) + 1``
   shingles. Those in one class only match nothing, so a set whose first ones all are such drops out here.
4. A tile is the classes that share such a shingle. First every class is compared with the one most of its tiles begin
   with, which joins large groups of near copies by as many comparisons as they have members. Tiles whose classes are all
   joined by then are done. The others are compared all with all but within a group, in size bands: hashed bitmaps bound
   the overlap from above by the bits that one has and the other has not; what the bound allows is decided exactly, on
   sorted arrays, until all that is similar hangs together. So a tile gives fewer links than members. Large tiles are dealt out as a grid of pairs of blocks.
5. Components of the links, each named by its smallest id.

Nulls: a text that is null or has no word has an empty set and is linked with nothing; a row without an id takes no part
and has no component. Rows that share an id are one document, linked with all that either text is linked with. Repeated
rows come out as often as they go in. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.components import components
from loomspan.llm.scratch import Scratch, ship, small, with_columns
from loomspan.llm.shingles import bitmap, shingle_set

WORDS, PERCENT = 5, 80
#: Shingles in a part of the count, in a packet, and in how many sets of a packet a shingle is frequent.
PART, PACKET, FREQUENT = 1_000_000, 2_000_000, 64
LEAST_PARTS = 64
BLOCK = 1500
#: Ids (8 bytes) that may be broadcast to leave documents out of a pass; beyond that the pass shuffles.
BROADCAST_IDS = 500_000


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


def similar(overlap: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * overlap >= percent * (a + b - overlap)


def _raw(batch, name):
    import pyarrow as pa

    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary())


def _sets(words):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, f1, f2 = [], [], []
            for text in _raw(batch, "text"):
                x = shingle_set(text.as_py(), words)
                digest = np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(x))
                f1.append(int(digest[0]))
                f2.append(int(digest[1]))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "f1", "f2"])

    return run


def _packets(words, parts):
    """Packets of shingles by part: (part, kind, docs, sizes, counts, tokens). kind 0: to be counted; 1: frequent here; 2: of a document, frequent here."""
    step, mask = np.uint64(parts), np.uint64((1 << 48) - 1)

    def flush(docs, sets):
        sizes = np.array([len(x) for x in sets], np.int64)
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        part, token = (tokens % step).astype(np.int64), tokens // step & mask
        order = np.lexsort((token, part))
        change = np.flatnonzero(np.concatenate([[True], (np.diff(token[order]) != 0) | (np.diff(part[order]) != 0)]))
        runs = np.diff(np.append(change, len(order)))
        often = np.zeros(len(order), bool)
        often[order] = np.repeat(runs >= FREQUENT, runs)
        docs = np.array(docs, np.int64)
        heads = order[change[runs >= FREQUENT]]
        for p in np.unique(part[heads]):
            yield int(p), 1, b"", b"", b"", token[heads[part[heads] == p]].astype("<u8").tobytes()
        for kind, at in ((0, np.flatnonzero(~often)), (2, np.flatnonzero(often))):
            group = part[at] if kind == 0 else owner[at] % parts
            at = at[np.argsort(group, kind="stable")]
            group = part[at] if kind == 0 else owner[at] % parts
            cuts = np.flatnonzero(np.diff(group)) + 1
            for piece in np.split(at, cuts) if len(at) else ():
                own, first, counts = np.unique(owner[piece], return_index=True, return_counts=True)
                if kind == 0:
                    body = token[piece].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    yield int(part[piece[0]]), 0, docs[own].tobytes(), sizes[own].astype("<u4").tobytes(), counts.astype("<u4").tobytes(), body
                else:
                    key = token[piece] * step + part[piece].astype(np.uint64)
                    yield int(group[0]), 2, docs[own].tobytes(), sizes[own].astype("<u4").tobytes(), counts.astype("<u4").tobytes(), key.astype("<u8").tobytes()

    def run(batches):
        import pyarrow as pa

        def out(rows):
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            for i in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 512], strict=True), kinds, strict=True)], ["part", "kind", "docs", "sizes", "counts", "tokens"])

        docs, sets, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), _raw(batch, "text"), strict=True):
                x = shingle_set(text.as_py(), words)
                if len(x):
                    docs.append(doc)
                    sets.append(x)
                    held += len(x)
                if held >= PACKET:
                    yield from out(list(flush(docs, sets)))
                    docs, sets, held = [], [], 0
        if sets:
            yield from out(list(flush(docs, sets)))

    return run


def _counted(parts):
    """Of each document in a part the shingles that another holds too: (doc, n, keys, rank); rank: count, or all ones if frequent."""
    step = np.uint64(parts)

    def run(batches):
        import pyarrow as pa

        names, kinds = ["doc", "n", "keys", "ranks"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

        def rows(docs, sizes, counts, keys, ranks):
            ends = np.cumsum(counts)
            for i in range(0, len(docs), 4096):
                cut = [(int(e - c), int(e)) for c, e in zip(counts[i : i + 4096], ends[i : i + 4096], strict=True)]
                columns = [docs[i : i + 4096], sizes[i : i + 4096].astype(np.int64), [keys[a:b].tobytes() for a, b in cut], [ranks[a:b].tobytes() for a, b in cut]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        by_part = {}
        for batch in batches:
            for row in batch.to_pylist():
                docs, sizes, counts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["sizes"], "<u4"), np.frombuffer(row["counts"], "<u4")
                if row["kind"] == 2:
                    keys = np.frombuffer(row["tokens"], "<u8")
                    yield from rows(docs, sizes, counts, keys, np.full(len(keys), 0xFFFFFFFF, "<u4"))
                else:
                    by_part.setdefault(row["part"], ([], [], [], [], []))
                    held = by_part[row["part"]]
                    if row["kind"] == 1:
                        held[4].append(np.frombuffer(row["tokens"], "<u8"))
                    else:
                        wide = np.zeros((len(row["tokens"]) // 6, 8), np.uint8)
                        wide[:, :6] = np.frombuffer(row["tokens"], np.uint8).reshape(-1, 6)
                        for x, y in zip(held, (docs, sizes, counts, wide.view("<u8").ravel()), strict=False):
                            x.append(y)
        for part in list(by_part):
            docs, sizes, counts, tokens, often = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in by_part.pop(part))
            if not len(tokens):
                continue
            order = np.argsort(tokens, kind="stable")
            ordered = tokens[order]
            change = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            runs = np.diff(np.append(change, len(ordered)))
            rank = np.minimum(runs, 0xFFFFFFFE).astype("<u4")
            rank[np.isin(ordered[change], often)] = 0xFFFFFFFF
            ranks = np.zeros(len(tokens), "<u4")
            ranks[order] = np.repeat(rank, runs)
            shared = ranks > 1
            owner = np.repeat(np.arange(len(docs)), counts.astype(np.int64))[shared]
            used, n = np.unique(owner, return_counts=True)
            yield from rows(docs[used], sizes[used], n, tokens[shared] * step + np.uint64(part), ranks[shared])

    return run


def _prefixes(percent):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            docs, ns, keys = [], [], []
            for row in batch.to_pylist():
                n = row["n"]
                key = np.frombuffer(b"".join(row["keys"]), "<u8")
                want = prefix(n, percent) - (n - len(key))
                if want > 0:
                    rank = np.frombuffer(b"".join(row["ranks"]), "<u4")
                    first = key[np.lexsort((key, rank))[:want]]
                    docs.append(np.full(len(first), row["doc"], np.int64))
                    ns.append(np.full(len(first), n, np.int64))
                    keys.append(first.view(np.int64))
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, docs, ns)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc", "n"])

    return run


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def _within(percent):
    """Links that connect different labels in a block, no more than it takes to connect them; one call holds one (key, i, j)."""

    def folded(bits, words):
        return np.bitwise_or.reduce(bits.reshape(len(bits), -1, words), axis=1)

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("n", "ascending"), ("doc", "ascending")])
        doc, n, label, side = (table.column(c).to_numpy() for c in ("doc", "n", "label", "side"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sets = [np.frombuffer(x.as_py(), "<u8") for x in table.column("set")]
        raw = [bitmap(x) for x in sets]
        part = np.unique(label, return_inverse=True)[1]  # grows together as links are found
        words = np.array([len(x) for x in raw])
        groups = {w: np.flatnonzero(words == w) for w in np.unique(words)}
        stacked = {w: np.stack([raw[k] for k in at]) for w, at in groups.items()}
        a, b = [], []
        for w, at in groups.items():
            for v, other in groups.items():
                if v < w or v > 4 * w:
                    continue
                theirs = folded(stacked[v], w)
                for x, k in enumerate(at):
                    near = (n[other] * percent <= n[k] * 100) & (n[k] * percent <= n[other] * 100) & (part[other] != part[k])
                    near &= (other > k) if v == w else True
                    near &= (side[other] != side[k]) if i != j else True
                    y = np.flatnonzero(near)
                    if not len(y):
                        continue
                    mine = stacked[w][x]
                    only = np.bitwise_count(mine & ~theirs[y]).sum(1)  # at least so many elements are in k alone
                    extra = np.bitwise_count(theirs[y] & ~mine).sum(1)
                    most = np.minimum(n[k] - only, n[other[y]] - extra)
                    y = other[y[100 * most >= percent * (n[k] + n[other[y]] - most)]]
                    while len(y):
                        if similar(_overlap(sets[k], sets[y[0]]), int(n[k]), int(n[y[0]]), percent):
                            a.append(int(doc[k]))
                            b.append(int(doc[y[0]]))
                            part[part == part[y[0]]] = part[k]
                            y = y[part[y] != part[k]]
                        else:
                            y = y[1:]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _exact(percent):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                keep.append(similar(_overlap(x, y), len(x), len(y), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _only(documents: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents (left_semi) with or (left_anti) without these ids, in an order that a rerun repeats."""
    hinted = small(ids, BROADCAST_IDS)
    out = documents.join(hinted, "doc_id", how)
    return out if hinted is not ids else out.sortWithinPartitions("doc_id")


def sets_of(ids: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """doc, set (sorted array as bytes) of the documents with these ids (doc_id)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(t.as_py(), words).astype("<u8").tobytes() for t in _raw(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc", "set"])

    return _only(documents, ids, "left_semi").mapInArrow(run, "doc long, set binary")


def verified(pairs: DataFrame, documents: DataFrame, scratch: Scratch, words: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar, decided on sorted arrays."""
    ids = scratch.table(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    sets = sets_of(ids, documents, words)
    own = [sets.withColumnsRenamed({"doc": x, "set": f"set_{x}"}) for x in "ab"]
    joined = pairs.join(own[0], "a").join(own[1], "b").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(_exact(percent), "a long, b long").distinct()


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = documents.sparkSession
    ship(spark)
    scratch = Scratch(spark, "jaccard")
    docs = with_columns(documents, {"doc_id": "long", "text": "string"})
    sets = scratch.table(docs.mapInArrow(_sets(words), "doc_id long, n long, f1 long, f2 long"))
    named = sets.filter("doc_id is not null and n > 0")
    classes = scratch.table(named.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")))
    with_rep = named.join(classes, ["f1", "f2", "n"])
    again = scratch.table(with_rep.filter("doc_id <> rep").select("doc_id").union(sets.filter("doc_id is null or n = 0").select("doc_id").filter("doc_id is not null")).distinct().join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART))
    firsts = _only(docs.filter("doc_id is not null and text is not null"), again, "left_anti")
    packets = firsts.mapInArrow(_packets(words, parts), "part int, kind int, docs binary, sizes binary, counts binary, tokens binary")
    shared = packets.repartition(parts, "part").mapInArrow(_counted(parts), "doc long, n long, keys binary, ranks binary")
    per = shared.groupBy("doc", "n").agg(F.collect_list(F.struct("keys", "ranks")).alias("x"))  # as many as a document has shingles
    per = per.select("doc", "n", F.col("x.keys").alias("keys"), F.col("x.ranks").alias("ranks"))
    tiles = scratch.table(per.mapInArrow(_prefixes(percent), "key long, doc long, n long").distinct())
    scratch.settle()

    heads = tiles.groupBy("key").agg(F.min("doc").alias("head"), F.max("doc").alias("tail")).filter("head <> tail")
    votes = tiles.join(heads.select("key", "head"), "key").filter("doc <> head").groupBy("doc", "head").agg(F.count(F.lit(1)).alias("n"))
    stars = scratch.table(votes.groupBy("doc").agg(F.max(F.struct("n", F.negative("head").alias("h"))).alias("m")).select(F.col("doc").alias("a"), F.negative(F.col("m.h")).alias("b")))
    links = scratch.table(verified(stars, docs.filter("doc_id is not null and text is not null"), scratch, words, percent))
    scratch.settle()
    roots = components(links, scratch)
    labelled = tiles.join(roots, tiles.doc == roots.id, "left").select("key", "doc", "n", F.coalesce("root", "doc").alias("label"))
    labelled = scratch.table(labelled)
    # Tiles of the same classes are one tile: told by their number and two sums of hashes.
    open_ = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("doc")).alias("x1"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("x2")).filter("lo <> hi")
    open_ = scratch.table(open_.groupBy("m", "x1", "x2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    open_tiles = scratch.table(labelled.join(open_, "key"))
    ids = scratch.table(open_tiles.select(F.col("doc").alias("doc_id")).distinct())
    firsts = sets_of(ids, docs.filter("doc_id is not null and text is not null"), words).withColumn("n", F.expr("cast(length(set) div 8 as long)")).distinct()
    side = F.pmod(F.xxhash64("doc", F.lit(2)), F.col("blocks")).cast("int")
    grid = open_tiles.join(firsts, ["doc", "n"]).withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grid = grid.select("key", "doc", "n", "label", "set", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    more = scratch.table(grid.groupBy("key", "i", "j").applyInArrow(_within(percent), "a long, b long").distinct())
    links = scratch.table(links.union(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = components(links, scratch)
    # Rows that share an id but not their text link its classes.
    shared_ids = with_rep.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).join(classes.select(F.col("rep").alias("a")), "a")
    if not shared_ids.isEmpty():
        roots = components(links.union(shared_ids), scratch)
    named_classes = classes.join(roots, classes.rep == roots.id, "left").select("f1", "f2", "n", F.coalesce("root", "rep").alias("of"))
    out = sets.join(named_classes, ["f1", "f2", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs that share a shingle, and everything that links reach.
SQL = r"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  grams AS (SELECT DISTINCT doc_id, hash_of AS g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS hash_of FROM words)),
  sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
  common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * both_have >= 80 * (s.n + t.n - both_have)),
  edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reached AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_id, d.doc_id)) AS component_id FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
  LEFT JOIN (SELECT a, min(b) AS least_id FROM reached GROUP BY 1) m ON m.a = d.doc_id"""
