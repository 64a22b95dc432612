"""Roll-ups of evaluation results and of run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_loss(df: DataFrame, by: list[str], loss: Column, tokens: Column) -> DataFrame:
    """Token-weighted loss and perplexity, exp of at most 20."""
    out = df.select(*by, loss.alias("l"), tokens.alias("t")).groupBy(*by).agg(F.sum("t").alias("tokens"), (F.sum(F.col("l") * F.col("t")) / F.sum("t")).alias("loss"))
    return out.withColumn("perplexity", F.exp(F.least("loss", F.lit(20.0))))


def moving_mean(df: DataFrame, by: list[str], order: list[str], value: str, steps: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(steps - 1), 0)
    return df.withColumn("moving_mean", F.avg(value).over(w))


def unknown_rate(df: DataFrame, by: list[str], unknown: Column, total: Column) -> DataFrame:
    """Mean over rows of the share of unknown tokens."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.avg(unknown / F.greatest(total, F.lit(1))).alias("unknown_rate"))


def exact_match(df: DataFrame, by: list[str], got: Column, want: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(got.eqNullSafe(want)).alias("matches"), F.count("*").alias("rows"))


def latest_status(log: DataFrame, run: str, order: list[str], fields: list[str], status: str = "status") -> DataFrame:
    """Last value of each field per run, merged over its log.

    Errors before the last ``running`` are gone; processed_tokens and consumed_tokens stand for each other; last_checkpoint is the
    last checkpoint. Aggregates by the greatest order, so that a long log is reduced before it is shuffled.
    """
    at = F.struct(*order)
    errors = [f for f in fields if f in ("error_type", "error_message", "failure_record")]
    last = lambda f: F.max(F.when(F.col(f).isNotNull(), F.struct(at.alias("at"), F.col(f).alias("v"))))
    tokens = F.coalesce(*[F.col(f) for f in ("consumed_tokens", "processed_tokens") if f in fields]) if {"consumed_tokens", "processed_tokens"} & {*fields} else F.lit(None).cast("long")
    rows = log.withColumn("__tokens", tokens)
    out = rows.groupBy(run).agg(
        *[last(f).alias(f"__{f}") for f in [status, *fields]],
        last("__tokens").alias("__all_tokens"),
        F.max(F.when(F.col(status) == "running", at)).alias("__running"),
    )
    cleared = lambda f: F.when(F.col("__running").isNull() | (F.col(f"__{f}.at") > F.col("__running")), F.col(f"__{f}.v"))
    columns = [F.col(f"__{status}.v").alias(status)]
    for f in fields:
        if f in errors:
            columns.append(cleared(f).alias(f))
        elif f in ("consumed_tokens", "processed_tokens"):
            columns.append(F.col("__all_tokens.v").alias(f))
        else:
            columns.append(F.col(f"__{f}.v").alias(f))
    if "checkpoint" in fields:
        columns.append(F.col("__checkpoint.v").alias("last_checkpoint"))
    return out.select(run, *columns)
