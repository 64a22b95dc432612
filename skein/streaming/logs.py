"""Structured Streaming counterparts: latest status, deduplication, resumable packing, acknowledged delivery."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.windows import window_ranges


def latest(stream: DataFrame, key: str, at: str, fields: list[str]) -> DataFrame:
    """Last non-null value of each field per key; state is one row per key. For update or complete output."""
    return stream.groupBy(key).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).alias(f) for f in fields], F.max(at).alias(at))


def deduplicated(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """First row per key; a key is forgotten ``delay`` behind the watermark, so that state stays bounded."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, at: str, key: str, value: str, size: str, delay: str) -> DataFrame:
    """Counts and sums per key and tumbling window; late rows beyond ``delay`` are dropped by the watermark."""
    grouped = stream.withWatermark(at, delay).groupBy(F.window(at, size), key)
    out = grouped.agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), key, "n", "total")


def token_windows(stream: DataFrame, n_tokens: str, length: int) -> DataFrame:
    """Window rows of a stream of documents: stateless, so that replay from the last commit gives the same rows."""
    return stream.withColumn("w", F.explode(window_ranges(F.col(n_tokens), length))).select(*stream.columns, "w.*")


def resumable(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there and stops; started again, it goes on behind its last commit and repeats no row."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def delivered(stream: DataFrame, checkpoint: str, deliver: Callable[[DataFrame, int], None], acknowledged: Callable[[int], bool]) -> StreamingQuery:
    """Delivers each micro-batch once: a batch that was acknowledged before a restart is not delivered again."""

    def once(batch: DataFrame, number: int) -> None:
        if not acknowledged(number):
            deliver(batch, number)

    return stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
