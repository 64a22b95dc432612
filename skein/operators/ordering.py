"""Places in a total order without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fixed(df: DataFrame) -> DataFrame:
    """df as checkpointed files in the shared folder of ``spark.checkpoint.dir``; a folder of its own in local mode only."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or "/tmp/checkpoints/skein")
    return df.checkpoint()


def placed(df: DataFrame, by: list[str], order: list[str], column: str = "position", amount: str | None = None, before: str = "before") -> DataFrame:
    """df with ``column``, a row's place in the total order of its group, and with ``amount`` its sum over the rows ahead in ``before``.

    A group is not read by one task: rows are dealt to sorted ranges of group and order, and what the ranges ahead hold (one row per
    group and range) is added. The ranges are checkpointed, as both steps must see the same ones. Null is a group of its own.
    """
    dealt = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    dealt = fixed(dealt.withColumn("__part", F.spark_partition_id()))
    dealt = dealt.withColumn("__at", F.struct("__part", *by)).drop("__part")
    rows = Window.partitionBy("__at").orderBy(*order)
    sums, ahead = {"__size": F.count("*")}, {column: "__size"}
    within = {column: F.row_number().over(rows) - 1}
    if amount is not None:
        sums["__amount"], ahead[before] = F.sum(amount), "__amount"
        within[before] = F.coalesce(F.sum(amount).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier = Window.partitionBy(*[F.col("__at")[c] for c in by]).orderBy(F.col("__at")["__part"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__at").agg(*[v.alias(n) for n, v in sums.items()])
    starts = starts.select("__at", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__before{n}") for n in sums])
    out = dealt.withColumns(within).join(starts, "__at")
    out = out.withColumns({c: F.col(c) + F.col(f"__before{n}") for c, n in ahead.items()}).withColumn(column, F.col(column).cast("long"))
    return out.drop("__at", *[f"__before{n}" for n in sums])


def numbered(df: DataFrame, order: list[str], column: str = "position") -> DataFrame:
    """df with ``column``, the place in a total order of all rows."""
    return placed(df, [], order, column)
