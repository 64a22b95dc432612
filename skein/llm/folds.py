"""Folds by document id, and bounded samples of labelled rows for the fitting of models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Every n-th fold is held out.
FOLDS = 5


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by FOLDS; rows of a null id are held out, too."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def labelled_ids(labels: DataFrame, label: Column, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` rows (__key, __label) of the fitting folds, in a pseudo-random order of ids.

    An id with several labels takes the least. Only ids and labels are read, and only the sample reaches the driver.
    """
    rows = labels.select(F.col(f"`{id_col}`").alias("__key"), label.alias("__label"))
    rows = rows.where(F.col("__label").isNotNull() & ~held_out("__key")).groupBy("__key").agg(F.min("__label").alias("__label"))
    return rows.orderBy(F.xxhash64("__key"), "__key").limit(most)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: Column, most: int, most_bytes: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[str], list]:
    """At most ``most`` whole texts of at most ``most_bytes`` each, and their labels, on the driver."""
    bounded_batches(docs.sparkSession)
    known = labelled_ids(labels, label, most, id_col)
    texts = docs.select(F.col(f"`{id_col}`").alias("__key"), F.col(f"`{text_col}`").alias("__text"))
    # the sample is bounded by ``most``; every document passes by it without a shuffle
    rows = (
        texts.where(F.col("__text").isNotNull() & (F.octet_length("__text") <= most_bytes))
        .join(F.broadcast(known), "__key")
        .select(F.xxhash64("__key").alias("o"), "__text", "__label")
        .limit(most)
        .collect()
    )
    rows.sort(key=lambda r: (r[0], r[1]))
    return [r[1] for r in rows], [r[2] for r in rows]
