"""Best-fit packing of tokenised documents into fixed-length sequences by minimum bin slack.

Documents become pieces of at most ``MAX_LEN`` tokens; only longer ones are cut, and the first piece takes the remainder.
The packing is solved on the histogram of piece lengths, which has at most ``MAX_LEN`` rows whatever the corpus: the
longest length left opens a bin, a bitset subset-sum over the lengths still available finds the fullest way to fill it,
and that combination is taken as often as the counts allow. Pieces are then numbered within their length (by hashed
buckets, so that no length lands in one task) and take the numbered places of the plan.

Nulls: a null text is an empty one and gives one piece, the end mark alone. Repeated rows are packed each on its own;
a null id is kept as it is. No rows give no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, with_columns

MAX_LEN, END_ID = 1024, 2
#: Rows that share a length and a bucket are numbered in one task; buckets grow with the corpus beyond these.
BUCKETS, BUCKET_ROWS = 64, 100_000
CACHE = 200_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordIds(dict):
    """Ids (little-endian bytes) of a piece of text that follows a single space; None if it can't be encoded apart.

    The vocabulary's pattern never joins a space to what stands before it, unless that is white space too. So a text
    cut at single spaces encodes as its pieces do, if none is empty or has white space at an end.
    """

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes | None:
        if len(self) >= CACHE:
            self.clear()
        safe = piece and not piece[0].isspace() and not piece[-1].isspace()
        self[piece] = got = np.array(self.encode(" " + piece), "<u4").tobytes() if safe else None
        return got


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text -> ids as little-endian bytes, equal to those of the byte-level vocabulary file read by ``tokenizers``."""
    import public_tokenizers
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {x["content"] for x in model.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    words = WordIds(encode)

    def plain_ids(text: str) -> bytes:
        first, *rest = text.split(" ")
        if rest and first and not first[-1].isspace():
            try:
                return np.array(encode(first), "<u4").tobytes() + b"".join(map(words.__getitem__, rest))
            except TypeError:  # a piece that can't stand apart
                pass
        return np.array(encode(text), "<u4").tobytes()

    # Added tokens are cut out of the text first, the longest at each place, as the library does by default.
    added = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in model.get("added_tokens", [])}
    if any(x.get(flag) for x in model.get("added_tokens", []) for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take in what stands beside them are not supported")
    if not added:
        return plain_ids
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def ids(text: str) -> bytes:
        parts = cut.split(text)
        return plain_ids(text) if len(parts) == 1 else b"".join(added[p] if i % 2 else plain_ids(p) for i, p in enumerate(parts) if p)

    return ids


def pieces(documents: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; with keep_ids also ids, as little-endian 32-bit bytes."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        import pyarrow as pa

        ids = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = ids(text.as_py() or "") + end
                n = len(data) // 4
                starts = [0, *range(n % max_len or max_len, n, max_len)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    part = data[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(part), *([part] if keep_ids else [])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns = list(zip(*rows, strict=True)) or [()] * (5 + keep_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return with_columns(documents, {"doc_id": "long", "text": "string"}).mapInArrow(cut, schema)


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``; longer lengths are preferred."""
    reach, seen = 1, []
    for length in sorted((x for x in left if x <= room), reverse=True):
        count, size = min(left[length], room // length), 1
        while count:
            size = min(size, count)
            seen.append((reach, length, size))
            reach = (reach | reach << length * size) & ((1 << room + 1) - 1)
            count -= size
            size *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, size in reversed(seen):
        if not before >> total & 1:
            total -= length * size
            chosen[length] = chosen.get(length, 0) + size
    return chosen


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack: (times, {length: how often in the bin}), until every length is used up."""
    left, out = {x: n for x, n in histogram.items() if n > 0}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        bin_ = fullest({x: n for x, n in rest.items() if n}, max_len - longest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[x] // n for x, n in bin_.items())
        out.append((times, bin_))
        for x, n in bin_.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return out


def places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Of each length, rows (first number, first sequence, how often in a bin, offset), by first number."""
    rows, used, sequence = {}, {}, 0
    for times, bin_ in bins:
        offset = 0
        for length in sorted(bin_, reverse=True):
            rows.setdefault(length, []).append((used.get(length, 0), sequence, bin_[length], offset))
            used[length] = used.get(length, 0) + times * bin_[length]
            offset += length * bin_[length]
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def pack(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32 and more), each read once more."""
    spark = parts.sparkSession
    counted = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most max_len rows
    table = spark.sparkContext.broadcast(places(plan(counted, max_len)))
    buckets = max(BUCKETS, -(-sum(counted.values()) // BUCKET_ROWS))
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    # Equal rows share a bucket, so a second hash deals out rows that are repeated often.
    dealt = dealt.withColumn("bucket", F.pmod(F.col("bucket") + F.monotonically_increasing_id(), F.lit(buckets)))
    scratch = Scratch(spark, "pack")
    dealt = scratch.table(dealt)
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sizes = sizes.select(F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket"), before.alias("before"))
    names = parts.columns
    own = F.row_number().over(W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = dealt.withColumn("own", own).join(sizes, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket")))
    numbered = numbered.select(*names, (F.col("before") + F.col("own")).alias("number"))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                rows = table.value[x]
                row = rows[np.searchsorted(rows[:, 0], number[at], "right") - 1]
                q = number[at] - row[:, 0]
                sequence[at], offset[at] = row[:, 1] + q // row[:, 2], row[:, 3] + q % row[:, 2] * x
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields) + ", sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)


def pack_documents(documents: DataFrame, tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document, with its place; see the module."""
    scratch = Scratch(documents.sparkSession, "pieces")
    return pack(scratch.table(pieces(documents, tokenizer, max_len, end_id, keep_ids)), max_len)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
