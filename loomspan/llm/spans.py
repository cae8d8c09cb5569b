"""Substring dedup by sliding sentence spans.

Sentences end at ``. ! ?`` before white space or at a line's end. A span is a run of several consecutive sentences: at
least ``SENTENCES`` of them with ``LEAST_WORDS`` words together, or two that hold ``MANY_WORDS`` words. One sentence, however long, is no span. From every sentence the shortest span that starts there and the shortest that ends there are hashed
(96 bits, over their words, so that case and spacing don't matter). Spans meet by hash over the whole corpus; of equal
ones the first, by document id and place, stays, and every sentence under any other is removed.

Nulls: a null text has no sentences and stays null; null ids count as one id, the last. Rows that share an id count as
one document in the order: what stands at the same place of both is first in both, so repeated rows share their fate.
No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, ship, with_columns

SENTENCES, LEAST_WORDS, MANY_WORDS = 3, 20, 30
_END = re.compile(r"[.!?]+[\"')\]]*(?=\s)\s+|\n\s*")


def sentence_ends(text: str) -> list[int]:
    """Ends of the sentences, white space behind them included, so that they cut the text without a gap."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return ends


def spans(text: str) -> list[tuple[int, int, int, int]]:
    """(first sentence, last sentence, hash, hash) of every span. A span that ends where another ends is enough there."""
    ends = sentence_ends(text)
    words = [text[a:b].lower().split() for a, b in zip([0, *ends], ends, strict=False)]
    full = [i for i, w in enumerate(words) if w]  # white space alone is no sentence
    sizes = np.concatenate([[0], np.cumsum([len(words[i]) for i in full])]).astype(np.int64)
    n = len(full)
    if not n:
        return []
    at = np.arange(n)
    last = np.minimum(np.maximum(np.searchsorted(sizes, sizes[at] + LEAST_WORDS, "left"), at + SENTENCES), np.maximum(np.searchsorted(sizes, sizes[at] + MANY_WORDS, "left"), at + 2))
    ending = at + 1
    first = np.maximum(np.minimum(np.searchsorted(sizes, sizes[ending] - LEAST_WORDS, "right") - 1, ending - SENTENCES), np.minimum(np.searchsorted(sizes, sizes[ending] - MANY_WORDS, "right") - 1, ending - 2))
    runs = {(int(i), int(j)) for i, j in zip(at, last, strict=True) if j <= n}
    ended = {j for _, j in runs}
    runs |= {(int(i), int(j)) for i, j in zip(first, ending, strict=True) if i >= 0 and int(j) not in ended}
    joined = [" ".join(words[i]).encode("utf-8", "surrogatepass") for i in full]
    out = []
    for i, j in sorted(runs):
        h = hashlib.blake2b(b" ".join(joined[i:j]), digest_size=12).digest()
        out.append((full[i], full[j - 1], *struct.unpack("<qi", h)))
    return out


def _spans(batches):
    import pyarrow as pa

    for batch in batches:
        rows = [(doc, tag, *s) for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True) for s in spans(text.as_py())]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "tag", "first", "last", "h1", "h2"])


def repeated(documents: DataFrame) -> DataFrame:
    """doc_id, tag, ranges: sentences (first, last) to remove, of the documents (doc_id, tag, text) that have any."""
    scratch = Scratch(documents.sparkSession, "spans")
    found = scratch.table(documents.mapInArrow(_spans, "doc_id long, tag int, first int, last int, h1 long, h2 int"))  # texts are read once for it
    place = F.struct("doc_id", "first")
    firsts = found.groupBy("h1", "h2").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    others = found.join(firsts.select("h1", "h2", "at"), ["h1", "h2"]).filter(place > F.col("at"))
    ranges = F.collect_set(F.struct("first", "last"))  # at most two for each sentence of the document
    return others.groupBy("doc_id", "tag").agg(ranges.alias("ranges"))


def remove_spans(documents: DataFrame) -> DataFrame:
    """Every document with text cut, and n_sentences, n_removed, n_chars_removed, removed (list of character ranges [a, b)).

    Extra columns stay, but for those of the names made here. An id that several different texts share is told apart by text; equal rows share their fate."""
    spark = documents.sparkSession
    ship(spark)
    made = ("n_sentences", "n_removed", "n_chars_removed", "removed", "ranges", "span_doc", "span_tag")
    own = [c for c in documents.columns if c not in made]
    documents = documents.select(*[F.col(f"`{c}`") for c in own])
    tag = F.hash(F.col("text").cast("string"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    keyed = documents.filter(F.col("text").isNotNull()).select(doc.alias("doc_id"), tag.alias("tag"), F.col("text").cast("string").alias("text"))
    ranges = repeated(keyed).withColumnsRenamed({"doc_id": "span_doc", "tag": "span_tag"})
    same = (doc == F.col("span_doc")) & (tag == F.col("span_tag"))
    joined = documents.join(ranges, same, "left").drop("span_doc", "span_tag")
    at = own.index("text")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            texts, n, gone, chars, removed = [], [], [], [], []
            for text, drop in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                text, drop = text.as_py(), drop.as_py()
                ends = sentence_ends(text) if text else []
                starts = [0, *ends]
                lost = np.zeros(len(ends) + 1, bool)
                for r in drop or ():
                    lost[r["first"] : r["last"] + 1] = True
                filled = [bool(text[a:b].strip()) for a, b in zip(starts, ends, strict=False)]
                n.append(sum(filled))
                gone.append(sum(f and bool(x) for f, x in zip(filled, lost, strict=False)))
                edges = np.flatnonzero(np.diff(np.concatenate([[False], lost[: len(ends)], [False]]).astype(int)))
                cuts = [(starts[a], starts[b]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                removed.append([{"a": a, "b": b} for a, b in cuts])
                chars.append(sum(b - a for a, b in cuts))
                texts.append("".join(text[a:b] for a, b, x in zip(starts, ends, lost, strict=False) if not x) if cuts else text)
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, pa.string())
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int32()), pa.array(gone, pa.int32()), pa.array(chars, pa.int64()), pa.array(removed, kind)], [*own, "n_sentences", "n_removed", "n_chars_removed", "removed"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields) + ", n_sentences int, n_removed int, n_chars_removed long, removed array<struct<a:int,b:int>>"
    return joined.mapInArrow(cut, schema)


def op9_sentence_spans(spark, sf_dir: str) -> DataFrame:
    cut = remove_spans(with_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), {"doc_id": "long", "text": "string"}))
    return cut.select("doc_id", "n_sentences", "n_removed", "n_chars_removed", "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
