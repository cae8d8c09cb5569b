"""Quality rules with risk-controlled cutoffs, with DataFrame operations only.

Measures are taken of every whole text. A rule rejects a document whose ratio is above a cutoff. Cutoffs are chosen
for each stratum (language) from labelled documents: a cutoff stands only if the exact binomial test rejects, at
``DELTA / (strata * rules)`` (Bonferroni), that the rule turns away more than ``EPSILON / rules`` of the good ones.
The grid is fixed beforehand and tested from lenient to strict, each step only if those before it passed, so the
whole grid costs one test; with probability ``1 - DELTA`` no stratum loses more than ``EPSILON`` of its good documents.
A stratum with too few labels to prove that keeps everything the base rules keep.

Nulls: a null text has no words (and fails the base rules); a null language is a stratum of its own; a document
labelled both good and bad counts as bad; null labels don't count. Repeated rows are judged alike. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.scratch import Scratch, small, with_columns, word_list

EPSILON, DELTA = 0.05, 0.05
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
SYMBOLS = "[#*$%&|<>]"
#: Ratio of each rule, and its cutoffs from lenient to strict.
RULES = {
    "symbols_per_word": ("n_symbols", (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02)),
    "repeated_share": ("n_repeat_words", (0.28, 0.25, 0.22, 0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04, 0.02)),
    "repeated_lines": ("n_dup_lines", (0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01, 0.005)),
    "mean_word_chars": ("word_chars", (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5, 6.2, 6.0)),
}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable is never expanded again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Words under windows that occur twice or more; hashes: of the window at each word, in order."""
    pairs = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    twice = lambda s: F.filter(F.transform(s, lambda e, i: F.when((F.get(s, i - 1)["x"] == e["x"]) | (F.get(s, i + 1)["x"] == e["x"]), e["i"])), F.isnotnull)
    width = lambda p: F.aggregate(F.transform(p, lambda v, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - v, F.lit(WINDOW)))), F.lit(0), lambda a, v: a + v)
    return let(pairs, lambda s: let(F.array_sort(twice(s)), width))


def repeated_words(words: Column) -> Column:
    windows = lambda w: F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW)))))
    return let(words, lambda w: let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h))))


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, lang, and the five measures of every whole text, with base_failed."""
    docs = with_columns(documents, {"doc_id": "long", "lang": "string", "text": "string"})
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.select(
        "doc_id",
        "lang",
        let(word_list(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeated"))).alias("m"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    docs = docs.select("doc_id", "lang", F.col("m.n").cast("long").alias("n_words"), F.col("m.chars").cast("long").alias("word_chars"), "n_symbols", "n_dup_lines", F.col("m.repeated").cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return docs.withColumn("base_failed", failed)


def ratio(name: str) -> Column:
    return F.col(RULES[name][0]) / F.nullif(F.col("n_words"), F.lit(0).cast("long"))


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k) for k up to n * p, exact but for rounding; null beyond, where no test at a small level passes."""
    first = n * F.log(F.lit(1 - p))
    odds = F.log(F.lit(p / (1 - p)))

    def add(s: Column, j: Column) -> Column:
        term = s["term"] + F.log((n - j + 1) / j) + odds
        total = F.greatest(s["total"], term) + F.log1p(F.exp(-F.abs(s["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))), F.struct(first.alias("term"), first.alias("total")), add)["total"]
    return F.when(k == 0, first).when(k <= n * p, summed)


def cutoffs(measured: DataFrame, labels: DataFrame, epsilon: float = EPSILON, delta: float = DELTA) -> DataFrame:
    """One row per stratum of the labelled documents: lang, and the cutoff of each rule (null: none is proven)."""
    good = with_columns(labels, {"doc_id": "long", "quality": "int"}).filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select(F.col("doc_id").alias("good_id"))
    held = measured.filter(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("good_id"))
    counts = [F.count_if(ratio(r) > c).alias(f"{r}_{i}") for r, (_, grid) in RULES.items() for i, c in enumerate(grid)]
    per = held.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *counts)
    strata = per.agg(F.count(F.lit(1)).alias("strata"))
    per = per.crossJoin(F.broadcast(strata))  # one row, by construction
    level = F.log(F.lit(delta) / (F.col("strata") * len(RULES)))
    chosen = []
    for r, (_, grid) in RULES.items():
        passed = F.array(*[F.when(log_binomial_cdf(F.col(f"{r}_{i}"), F.col("n"), epsilon / len(RULES)) <= level, F.lit(c)) for i, c in enumerate(grid)])
        chosen.append(F.array_min(passed).alias(r))
    return per.select("lang", "n", *chosen)


def judge(documents: DataFrame, labels: DataFrame, epsilon: float = EPSILON, delta: float = DELTA) -> DataFrame:
    """Every document with its measures, base_failed and kept."""
    scratch = Scratch(documents.sparkSession, "quality")
    measured = scratch.table(measures(documents))
    chosen = scratch.table(cutoffs(measured, labels, epsilon, delta).withColumnsRenamed({"lang": "stratum", "n": "n_good"}))
    judged = measured.join(small(chosen), F.col("lang").eqNullSafe(F.col("stratum")), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(ratio(r) > F.col(r), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
