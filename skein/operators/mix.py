"""Token-balanced schedules over groups of rows: permutations, merge, acknowledgement, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered, placed


def _cycled(df: DataFrame, row_id: str, seed: int, epochs: int) -> DataFrame:
    """df, epochs times, with epoch and the hash of seed, epoch and row that orders it."""
    rows = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(row_id).cast("string")).cast("binary"), 256)
    return rows.withColumn("__key", key)


def permuted(df: DataFrame, group: str, row_id: str, seed: int, epochs: int) -> DataFrame:
    """df, epochs times, with epoch and pos: each epoch of a group is a permutation by hashes of seed, epoch and row."""
    return placed(_cycled(df, row_id, seed, epochs), [group, "epoch"], ["__key", row_id], "pos").drop("__key")


def schedule(df: DataFrame, group: str, row_id: str, tokens: str, weights: dict[str, float], seed: int, epochs: int, rows: int | None = None) -> DataFrame:
    """Rows in the order of a merge that always takes the group of the least progress (tokens / weight; ties: the first weight).

    Equal to sorting all rows by (progress before the row, group, position), as progress strictly grows; a row's tokens must be
    positive. ``position`` counts from 0; without ``rows`` all epochs are scheduled.
    """
    if any(w <= 0 for w in weights.values()) or abs(sum(weights.values()) - 1) > 1e-12:
        raise ValueError("weights must be positive and add up to one")
    rank = F.create_map(*[F.lit(x) for i, g in enumerate(weights) for x in (g, i)])
    share = F.create_map(*[F.lit(x) for g, w in weights.items() for x in (g, float(w))])
    pool = df.where(F.col(group).isin(*weights))
    keyed = placed(_cycled(pool, row_id, seed, epochs), [group], ["epoch", "__key", row_id], "pos", tokens).drop("__key")
    # a group's epochs are of one length
    keyed = keyed.join(pool.groupBy(group).agg(F.count("*").alias("__pool")), group).withColumn("pos", F.col("pos") - F.col("epoch") * F.col("__pool"))
    keyed = keyed.drop("__pool").withColumns({"progress": F.col("before") / share[F.col(group)], "code": rank[F.col(group)]})
    order = ["progress", "code", "epoch", "pos"]
    chosen = keyed.orderBy(*order) if rows is None else keyed.orderBy(*order).limit(rows)
    return numbered(chosen, order)


def report(scheduled: DataFrame, pool: DataFrame, group: str, tokens: str) -> DataFrame:
    """Per group: tokens, share, presentations, unique and repeated rows."""
    shown = scheduled.groupBy(group).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("presentations"))
    size = pool.groupBy(group).agg(F.count("*").alias("pool"))
    rows = size.join(shown, group, "left").fillna(0, ["tokens", "presentations"])
    total = F.sum("tokens").over(Window.partitionBy())
    unique = F.least("presentations", "pool")
    return rows.select(
        group, "tokens", F.when(total > 0, F.col("tokens") / total).otherwise(F.lit(0.0)).alias("fraction"), "presentations",
        unique.alias("unique_rows"), (F.col("presentations") - unique).alias("reused_presentations"),
    )


def imbalance(scheduled: DataFrame, group: str, tokens: str) -> DataFrame:
    """One row: difference of the groups' tokens, the most tokens of one row (its bound), and whether it keeps it."""
    each = scheduled.groupBy(group).agg(F.sum(tokens).alias("t"), F.max(tokens).alias("m"))
    out = each.agg((F.max("t") - F.min("t")).alias("imbalance"), F.max("m").alias("most_row_tokens"))
    return out.withColumn("balanced", F.col("imbalance") <= F.col("most_row_tokens"))


def acknowledged(scheduled: DataFrame, consumed: DataFrame, row_id: str) -> DataFrame:
    """One row: rows acknowledged, whether they are a prefix of the schedule, and the position to resume at.

    consumed holds (position, row_id) in delivery order from 0.
    """
    both = consumed.select("position", F.col(row_id).alias("__got")).join(scheduled.select("position", F.col(row_id).alias("__want")), "position", "left")
    out = both.agg(
        F.count("*").alias("rows"), F.max("position").alias("last"), F.coalesce(F.bool_and(F.col("__got").eqNullSafe(F.col("__want"))), F.lit(True)).alias("same")
    )
    whole = F.col("same") & ((F.col("rows") == 0) | (F.col("rows") == F.col("last") + 1))
    return out.select("rows", whole.alias("is_prefix"), F.when(whole, F.col("rows")).alias("resume_at"))


def state_reasons(state: DataFrame, pool: DataFrame, group: str, row_id: str) -> DataFrame:
    """(group, epoch, reason) of permutations that are no permutation of their pool: missing, repeated or foreign rows."""
    sizes = pool.groupBy(group).agg(F.count("*").alias("size"))
    own = pool.select(group, row_id, F.lit(True).alias("known"))
    rows = state.join(own, [group, row_id], "left").groupBy(group, "epoch").agg(
        F.count("*").alias("n"), F.count_distinct(row_id).alias("distinct"), F.count("known").alias("known"),
        F.min("pos").alias("low"), F.max("pos").alias("high"), F.count_distinct("pos").alias("places"),
    )
    reason = (
        F.when(F.col("known") < F.col("n"), "foreign").when(F.col("distinct") < F.col("n"), "repeated")
        .when(F.col("n") != F.col("size"), "missing").when((F.col("low") != 0) | (F.col("high") != F.col("n") - 1) | (F.col("places") < F.col("n")), "positions")
    )
    return rows.join(sizes, group).select(group, "epoch", reason.alias("reason")).where("reason IS NOT NULL")


def within_budget(df: DataFrame, order: list[str], tokens: str, budget: int, by: list[str] | None = None) -> DataFrame:
    """Rows up to the one that reaches the budget: training stops at a step's border."""
    return placed(df, by or [], order, "__place", tokens, "consumed_before").drop("__place").where(F.col("consumed_before") < budget)
