"""Corpus profiles: counts, length summaries, lexical statistics, fertility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold, word_tokens


def counts(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Counts by several groupings in one pass; a grouping's other columns are null."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *every).agg(F.grouping_id().alias("grouping"), F.count("*").alias("records"))


def length_summary(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """count, min, mean, p50, p95, max of a whole number; percentiles are the values at floor((n - 1) q) in order.

    Values are counted first, so that a group's order is one over its distinct lengths, not over its rows.
    """
    each = df.select(*by, value.cast("long").alias("v")).where("v IS NOT NULL").groupBy(*by, "v").agg(F.count("*").alias("n"))
    rows = each.groupBy(*by).agg(
        F.sum("n").alias("count"), F.min("v").alias("min"), F.sum(F.col("v") * F.col("n")).alias("total"), F.max("v").alias("max"),
        F.sort_array(F.collect_list(F.struct("v", "n"))).alias("values"),
    )

    def at(q: float) -> Column:
        place = F.floor((F.col("count") - 1) * F.lit(q))
        found = F.aggregate(
            "values",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("v")),
            lambda a, x: F.struct(
                (a["seen"] + x["n"]).alias("seen"), F.coalesce(a["v"], F.when(a["seen"] + x["n"] > place, x["v"])).alias("v")
            ),
        )
        return found["v"]

    return rows.select(*by, "count", "min", F.round(F.col("total") / F.col("count"), 3).alias("mean"), at(0.5).alias("p50"), at(0.95).alias("p95"), "max")


def lexical_profile(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """Per group: records, characters, bytes, word tokens, distinct case-folded forms, and their ratio."""
    rows = df.select(*by, word_tokens(F.col(text)).alias("tokens"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes"))
    sizes = rows.groupBy(*by).agg(
        F.count("*").alias("records"), F.sum("chars").alias("chars"), F.sum("bytes").alias("bytes"), F.sum(F.size("tokens")).alias("word_tokens")
    )
    forms = rows.select(*by, F.explode("tokens").alias("w")).select(*by, casefold(F.col("w")).alias("w")).distinct()
    forms = forms.groupBy(*by).agg(F.count("*").alias("word_forms"))
    joined = sizes.join(forms, by, "left").withColumn("word_forms", F.coalesce("word_forms", F.lit(0)))
    ratio = F.when(F.col("word_tokens") > 0, F.round(F.col("word_forms") / F.col("word_tokens"), 6))
    return joined.withColumn("type_token_ratio", ratio)


def fertility(df: DataFrame, by: str, bytes_: Column, tokens: Column) -> DataFrame:
    """documents, bytes, tokens and bytes per token, by a column and over all (null)."""
    rows = df.select(by, bytes_.alias("b"), tokens.alias("t"))
    out = rows.rollup(by).agg(F.count("*").alias("documents"), F.sum("b").alias("bytes"), F.sum("t").alias("tokens"))
    return out.withColumn("bytes_per_token", F.when(F.col("tokens") > 0, F.col("bytes") / F.col("tokens")))


def members(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Sorted sets of each column's values per group."""
    return df.groupBy(by).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])


def agreement(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Whether a group has one value in each of the columns."""
    return df.groupBy(*by).agg(*[(F.count_distinct(c) == 1).alias(f"{c}_agrees") for c in columns])


def key_sorted(entries: Column) -> Column:
    """A map with its keys in order: equal maps are then written alike."""
    return F.map_from_entries(F.array_sort(F.map_entries(entries)))


def counted_map(df: DataFrame, column: str) -> DataFrame:
    """One row with counts: values of a column and their rows, null left out, sorted by value. For columns of few values."""
    each = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return each.agg(key_sorted(F.map_from_entries(F.collect_list(F.struct(column, "n")))).alias("counts"))
