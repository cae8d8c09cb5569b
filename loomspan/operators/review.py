"""Review of candidate names: caches that fill gaps, counts and orders for reviewers, and what their judgements come to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A reviewer's answers, and the reason of a rule that has none.
AGREE, EXCLUDE, NO_RULE = "同意", "排除", ("不同意", "拆分")
DEFAULT_REASON = "人工确认归并"


def fill_gaps(caches: Sequence[DataFrame], key: str, filled: Column, order: Sequence[str]) -> DataFrame:
    """One row for each key: the last row of the first cache, and where that has none the first row of the next that has one.
    Rows without a key or that are not ``filled`` don't count. All caches have the same columns."""
    rows = []
    for i, cache in enumerate(caches):
        row, at = F.struct(*cache.columns), F.struct(*order)
        pick = F.max_by(row, at) if i == 0 else F.min_by(row, at)
        usable = cache.filter(F.col(key).isNotNull() & filled)
        rows.append(usable.groupBy(F.col(key).alias("_key")).agg(pick.alias("_row")).withColumn("_cache", F.lit(i)))
    both = rows[0]
    for more in rows[1:]:
        both = both.unionByName(more)
    return both.groupBy("_key").agg(F.min_by("_row", "_cache").alias("_row")).select("_row.*")


def candidate_counts(candidates: DataFrame, by: str, key: str, excluded: DataFrame) -> DataFrame:
    """Each group's records, distinct keys, and how many of its keys are excluded. Records are counted by key before the join."""
    keys = candidates.groupBy(by, key).agg(F.count(F.lit(1)).alias("n"))
    out = excluded.select(F.col(key).alias("_key")).distinct().withColumn("_out", F.lit(1))
    joined = keys.join(out, F.col(key) == F.col("_key"), "left")
    return joined.groupBy(by).agg(F.sum("n").alias("records"), F.count(key).alias("keys"), F.count("_out").alias("excluded_keys"))


def child_ratio(rows: DataFrame, by: Sequence[str], child: Column, short: Column) -> DataFrame:
    """Rows of each group, how many of them are children and how many short terms, and the share of children."""
    n, children = F.count(F.lit(1)), F.count_if(child)
    return rows.groupBy(*by).agg(n.alias("n"), children.alias("n_child"), F.count_if(short).alias("n_short"), (children / n).alias("child_ratio"))


def rule_position(name: Column, rules: Sequence[str]) -> Column:
    """Place in the rules; names without a rule come after all of them. Sort by this and the name."""
    at = F.array_position(F.array(*[F.lit(r) for r in rules]), name)
    return F.when(at > 0, at).otherwise(len(rules) + 1)


def by_group_total(members: DataFrame, group: str, n: str) -> DataFrame:
    """members with their group's ``total``, larger groups first, and larger members first within."""
    totals = members.groupBy(F.col(group).alias("_group")).agg(F.sum(n).alias("total"))
    joined = members.join(totals, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    return joined.orderBy(F.desc("total"), group, F.desc(n))


def noise_names(names: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """names (name, n) that hold any of the keywords."""
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(F.col("name"), F.lit(word))
    return names.filter(hit)


def judged(sheet: DataFrame) -> DataFrame:
    """sheet (candidate, suggested, judgement, confirm and more) with ``state`` (excluded, confirmed or blank) and ``unified``.

    An agreement takes the suggested name, a name under confirm goes before it, and any other judgement is itself the name.
    Rows without a candidate and those that are merely disagreed with or to be split are no rule and go."""
    word = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("candidate", "judgement", "confirm")}
    answer, name = word["judgement"], word["confirm"]
    confirmed = (answer == AGREE) | (name != "") | ((answer != "") & ~answer.isin(*NO_RULE))
    state = F.when(answer == EXCLUDE, "excluded").when(confirmed, "confirmed").when(answer == "", "blank")
    unified = F.when(name != "", name).when(answer == AGREE, F.col("suggested")).otherwise(answer)
    out = sheet.filter(word["candidate"] != "").withColumns({"state": state, "unified": F.when(state == "confirmed", unified)})
    return out.filter("state is not null")


def confirmed_rules(confirmed: DataFrame, examples: int = 3) -> DataFrame:
    """confirmed (unified, candidate, n, reason, example): each unified name's aliases and reasons, the most frequent first, and its
    first examples. Aliases and reasons are made distinct before they are gathered; examples are ranked before."""
    rows = confirmed.withColumn("_n", -F.coalesce(F.col("n"), F.lit(0)))

    def joined(column, separator, name):
        first = rows.filter(F.coalesce(F.col(column), F.lit("")) != "").groupBy("unified", column).agg(F.min(F.struct("_n", "candidate")).alias("_at"))
        listed = F.array_sort(F.collect_list(F.struct("_at", F.col(column).alias("v"))))
        return first.groupBy("unified").agg(F.array_join(F.transform(listed, lambda x: x["v"]), separator).alias(name))

    w = W.partitionBy("unified").orderBy("_n", "candidate", "example")
    top = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= examples)
    shown = F.array_sort(F.collect_list(F.struct("_rank", F.col("example").alias("v"))))
    top = top.groupBy("unified").agg(F.array_join(F.transform(shown, lambda x: x["v"]), "<br>").alias("examples"))
    out = joined("candidate", "、", "aliases").join(joined("reason", "；", "reasons"), "unified", "left").join(top, "unified", "left")
    return out.select("unified", "aliases", F.coalesce("reasons", F.lit(DEFAULT_REASON)).alias("reasons"), "examples")


def file_names(url: Column) -> dict[str, Column]:
    """Names under which a linked document may be kept: SHA-1 of its address, and the first 20 digits of its SHA-256."""
    return {"sha1_name": F.concat(F.sha1(url), F.lit(".pdf")), "sha256_name": F.concat(F.substring(F.sha2(url, 256), 1, 20), F.lit(".pdf"))}
