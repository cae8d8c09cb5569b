"""SentencePiece encoding and decoding by a table of distinct chunks.

A text is normalised by the library and cut before every run of whitespace markers that follows another letter. Where no
piece of the model holds a marker after another letter, no merge crosses such a cut, so a chunk (one marked word) has the
same pieces wherever it stands. Each task keeps a table of the distinct chunks it has met: new ones are segmented by the
library in one call, and a document's ids are gathered from the table by the positions of its chunks. The table is begun
anew beyond ``TABLE_CHUNKS`` entries or ``TABLE_CHARS`` letters, so memory is bounded; nothing is shuffled.

A model that is not BPE, or whose pieces or special symbols cross a cut, is applied to whole texts instead: same results.

Nulls: a null text is an empty one; an empty text has no ids and decodes to an empty text. A null id is kept, repeated rows are
coded each on their own, extra columns fall away, no rows give no rows. A text of any length is coded whole. Ids that are
null decode to an empty text.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.scratch import ship, with_columns

MARK = "▁"
#: Bounds of a task's table; a batch is coded in parts of so many letters.
TABLE_CHUNKS, TABLE_CHARS, PART_CHARS = 200_000, 8_000_000, 2_000_000
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Coder:
    """One model with its table of distinct chunks."""

    def __init__(self, path: str, table_chunks: int = TABLE_CHUNKS, table_chars: int = TABLE_CHARS):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as models

        self.library = SentencePieceProcessor(model_file=path)
        model = models.ModelProto.FromString(self.library.serialized_model_proto())
        own_symbols = any(p.type == p.USER_DEFINED for p in model.pieces)
        crossing = any(MARK in p.piece.lstrip(MARK) for p in model.pieces)
        self.apart = model.trainer_spec.model_type == model.trainer_spec.BPE and not own_symbols and not crossing
        # The same pieces without any normalising: chunks are cut out of normalised text.
        model.normalizer_spec.Clear()
        model.normalizer_spec.name = "identity"
        model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.remove_extra_whitespaces = False
        self.bare = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.most = table_chunks, table_chars
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.ends, self.chars = array("i"), array("q", [0]), 0

    def _place(self, chunks: list[str]) -> np.ndarray:
        """The number of each chunk in the table; those that are new are segmented once and added."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.places]
        for chunk, ids in zip(new, self.bare.encode(new, num_threads=1), strict=True):
            self.places[chunk] = len(self.places)
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        self.chars += sum(map(len, new))
        return np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another (int32), and where each text's ids begin, with the end as the last entry."""
        if not self.apart:
            rows = self.library.encode(texts, num_threads=1)
            return np.array([i for row in rows for i in row], np.int32), np.cumsum([0, *map(len, rows)])
        cut = [_CHUNK.findall(self.library.normalize(t)) for t in texts]
        places = self._place([c for chunks in cut for c in chunks])
        flat, ends = np.frombuffer(self.flat, np.int32) if self.flat else np.zeros(0, np.int32), np.frombuffer(self.ends, np.int64)
        starts, lengths = ends[places], ends[places + 1] - ends[places]
        begun = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(starts - begun[:-1], lengths) + np.arange(begun[-1])]
        starts = begun[np.cumsum([0, *map(len, cut)])]
        del flat, ends  # an array that is looked at can't grow
        if len(self.places) > self.most[0] or self.chars > self.most[1]:
            self._clear()
        return ids, starts

    def decode(self, rows: list[list[int]]) -> list[str]:
        return self.library.decode(rows) if rows else []


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def _parts(lengths: list[int]):
    """Ranges of rows with about ``PART_CHARS`` letters each, at least one row."""
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and held + n > PART_CHARS:
            yield start, i
            start, held = i, 0
        held += n
    if lengths:
        yield start, len(lengths)


def round_trip(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (array of int, without begin or end) and decoded (what the library makes of those ids) of every text."""
    ship(documents.sparkSession)
    path = model or default_model()

    def run(batches):
        import pyarrow as pa

        own = coder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _parts([len(t) for t in texts]):
                ids, starts = own.encode(texts[a:b])
                plain = ids.tolist()
                decoded = own.decode([plain[x:y] for x, y in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)])
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return with_columns(documents, {"doc_id": "long", "text": "string"}).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ids of every text."""
    return round_trip(documents, model).select("doc_id", "ids")


def decode(rows: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and decoded of rows with doc_id and ids; an id that is null or outside the vocabulary is refused."""
    ship(rows.sparkSession)
    path = model or default_model()

    def run(batches):
        import pyarrow as pa

        own = coder(path)
        for batch in batches:
            lists = [ids or [] for ids in batch.column(1).to_pylist()]
            for a, b in _parts([len(x) for x in lists]):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(own.decode(lists[a:b]), pa.string())], ["doc_id", "decoded"])

    return with_columns(rows, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(run, "doc_id long, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids in decimal joined by commas and of the decoded text."""
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256")
    )


def op13_sentencepieces(spark, sf_dir: str) -> DataFrame:
    return digests(round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet")))
