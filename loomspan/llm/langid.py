"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the character 1- to 3-grams of the lower-cased text, its runs of anything but letters read as one space,
hashed to ``FEATURES`` places. A feature's value is its share of the text's n-grams times its inverse document frequency,
which is counted over every training document. The weights are learned by follow-the-regularised-leader with elastic-net
penalties on a bounded sample (at most ``SAMPLE_ROWS`` documents, the first by a hash of id and text, equally many of each
language, repeated ones once); a part of the sample is set aside to fit the temperature that calibrates the scores. Prediction reads every
whole text once. Values are linear in the counts, so a text's logits are a mean of weights over its n-grams.

Nulls: a text that is null or has no letter is ``und`` with score 0; a null language or id is never learned from, and a
null id is predicted all the same. Without any language to learn, every text is ``und``. Repeated rows are predicted
each alike. No rows give no rows.
"""

from __future__ import annotations

from collections import namedtuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from loomspan.llm.scratch import ship, with_columns

FEATURES, GRAMS = 1 << 16, 3
SAMPLE_ROWS = 2400
#: A language has so many rows in the sample at least, repeated ones if it has no others.
LEAST_ROWS = 10
MOST_LANGS = 1000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 1.0, 1.0, 2e-4, 1e-3
#: Values are shares of a text, so small; this brings them to the size that the penalties are set for.
SCALE = 30.0
UNDETERMINED = "und"
Model = namedtuple("Model", "langs weights bias temperature")


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text between single spaces; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | (codes > 127)
    if (codes > 127).any():
        for c in np.unique(codes[codes > 127]):
            if not chr(c).isalpha():
                letter[codes == c] = False
    if not letter.any():
        return codes[:0]
    kept = letter.copy()
    kept[:-1] |= letter[1:]  # of other characters, only the one before a letter stays, as a space
    out = np.where(letter, codes, 32)[kept]
    return np.concatenate([[32] * int(out[0] != 32), out, [32]]).astype(np.uint32)


def grams(codes: np.ndarray, features: int = FEATURES) -> np.ndarray:
    """Hashed places of the 1- to 3-grams, in no special order."""
    mask = np.uint32(features - 1)
    found, h = [], np.zeros(len(codes), np.uint32)
    for n in range(1, GRAMS + 1):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]) * np.uint32(0x9E3779B1)
        found.append((h ^ h >> np.uint32(15)) & mask)
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def _document_frequency(batches):
    import pyarrow as pa

    df, docs = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            seen = np.bincount(grams(letter_codes(text.as_py() or "")), minlength=FEATURES) > 0
            df += seen
            docs += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], ["feature", "n"])


def _counts(batches):
    import pyarrow as pa

    for batch in batches:
        langs, at, n = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counted = np.bincount(grams(letter_codes(text.as_py())), minlength=FEATURES)
            places = np.flatnonzero(counted)
            if len(places):
                langs.append(lang)
                at.append(places.astype(np.int32).tobytes())
                n.append(counted[places].astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["lang", "places", "counts"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, features: int, epochs: int = EPOCHS, l1: float = L1) -> np.ndarray:
    """FTRL-proximal with elastic net on sparse rows (places, values, class); the last place is the bias."""
    z, n = np.zeros((features + 1, classes)), np.zeros((features + 1, classes))

    def weights(at):
        za, na = z[at], n[at]
        shrunk = np.sign(za) * np.maximum(np.abs(za) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(na)) / ALPHA + L2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i]
            w = weights(at)
            g = _softmax(x @ w)
            g[y] -= 1
            step = x[:, None] * g[None, :]
            sigma = (np.sqrt(n[at] + step * step) - np.sqrt(n[at])) / ALPHA
            z[at] += step - sigma * w
            n[at] += step * step
    return weights(np.arange(features + 1))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, most_langs: int = MOST_LANGS) -> Model:
    """labelled: doc_id, lang, text. Learns from all of them the document frequencies, from a bounded sample the weights:
    about ``sample_rows`` rows, or four of each language if that is more. The weights take ``FEATURES`` numbers a language, on the
    driver and on every worker, so more than ``most_langs`` languages are refused rather than dropped. Without labelled rows that
    have a letter there is nothing to learn, and every prediction is ``und``."""
    ship(labelled.sparkSession)
    labelled = labelled.filter("lang is not null and text is not null")
    ticket = F.xxhash64("text", F.lit(5))
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(ticket).alias("least")).orderBy(F.desc("n"), "lang").limit(most_langs + 1).collect()
    sizes, least = {r["lang"]: r["n"] for r in counted}, {r["lang"]: r["least"] for r in counted}
    langs = list(sizes)
    nothing = Model([], np.zeros((FEATURES, 1), np.float32), np.zeros(1), 1.0)
    if not langs:
        return nothing
    if len(langs) > most_langs:
        raise ValueError(f"more than {most_langs} languages: join rare ones, or raise most_langs")
    sample_rows = max(sample_rows, 4 * len(langs))
    # A threshold on the hash takes about as many rows of each language; the limit then bounds what reaches the driver.
    share = sample_rows // len(langs)
    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    part = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, share / n))) for x, n in sizes.items()], F.lit(0.0))
    # Repeated rows are drawn together and count once; the text of each language with the least hash is always among them.
    always = F.coalesce(*[F.when(F.col("lang") == x, ticket == F.lit(h)) for x, h in least.items()], F.lit(False))
    drawn = labelled.filter((unit < part) | always).select("lang", "text").distinct()
    sample = drawn.mapInArrow(_counts, "lang string, places binary, counts binary").limit(2 * sample_rows + len(langs)).collect()
    few = {x: [r for r in sample if r["lang"] == x] for x in langs}
    # Rows of a language with very few texts are repeated, so that both parts of the sample hold some.
    sample += [r for own in few.values() if 0 < len(own) < LEAST_ROWS for r in own * (-(-LEAST_ROWS // len(own)) - 1)]
    df = labelled.select("text").mapInArrow(_document_frequency, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # FEATURES + 1 rows at most
    df = {r["feature"]: r["n"] for r in df}
    docs = df.pop(-1, 0)
    idf = np.full(FEATURES, np.log(docs + 1.0) + 1)
    idf[list(df)] = np.log((docs + 1) / (np.array(list(df.values()), np.float64) + 1)) + 1
    index = {x: i for i, x in enumerate(langs)}
    rows = []
    for r in sorted(sample, key=lambda r: (bytes(r["places"]), bytes(r["counts"]), r["lang"])):
        at, n = np.frombuffer(r["places"], np.int32), np.frombuffer(r["counts"], np.int32)
        rows.append((np.append(at, FEATURES), np.append(SCALE * n / n.sum() * idf[at], 1.0), index[r["lang"]]))
    if not rows:
        return nothing
    held, kept = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    w = fit_ftrl(kept or rows, len(langs), FEATURES)
    logits, right = np.array([x @ w[at] for at, x, _ in held]), np.array([y for *_, y in held])
    loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(right)), right], 1e-12)).mean()
    temperature = min(np.exp(np.linspace(-3, 3, 121)), key=loss)
    return Model(langs, (SCALE * idf[:, None] * w[:-1]).astype(np.float32), w[-1], float(temperature))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """documents with lang_pred and score added; only text is read for them. A column of that name is replaced."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages, whatever the corpus
    documents = documents.drop("lang_pred", "score")
    at = documents.columns.index("text")

    def run(batches):
        import pyarrow as pa

        langs, weights, bias, temperature = shared.value
        for batch in batches:
            found, scores = [], []
            for text in batch.column(at):
                codes = letter_codes(text.as_py() or "")
                if not len(codes) or not langs:
                    found.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                places = grams(codes)
                counted = np.bincount(places, minlength=FEATURES) if len(places) > 8192 else None
                if counted is None:
                    total = weights[places].sum(0, dtype=np.float64)
                else:
                    used = np.flatnonzero(counted)
                    total = counted[used] @ weights[used].astype(np.float64)
                p = _softmax((total / len(places) + bias) / temperature)
                best = int(p.argmax())
                found.append(langs[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*documents.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return documents.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those not held out."""
    docs = with_columns(documents, {"doc_id": "long", "lang": "string", "text": "string"})
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op1_language(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
