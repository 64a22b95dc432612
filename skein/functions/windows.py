"""Token windows of one document each, in closed form, and what a window's row holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import arrow
from ..policy import BOS, END_OF_DOCUMENT, IGNORE, PAD, SPECIAL_IDS, VOCABULARY


def window_count(n: Column, length: int) -> Column:
    """Windows of n body tokens: the last also holds a document end, the others hold length - 1 tokens behind the start token."""
    if length < 3:
        raise ValueError("a window holds a start token, a body token and a document end at least")
    return F.when(n <= length - 2, F.lit(1)).otherwise(F.ceil((n - (length - 2)) / F.lit(length - 1)) + 1).cast("long")


def window_start(k: Column, n: Column, count: Column, length: int) -> Column:
    """Start of window k: every later window keeps a token at least."""
    return F.least(k * (length - 1), n - (count - k)).cast("long")


def window_ranges(n: Column, length: int) -> Column:
    """array<struct<chunk_index, chunk_count, token_start, token_end, final>>; none for an empty document."""
    count = window_count(n, length)
    made = F.transform(
        F.sequence(F.lit(0).cast("long"), count - 1),
        lambda k: F.struct(
            k.alias("chunk_index"),
            count.alias("chunk_count"),
            F.when(k == 0, F.lit(0).cast("long")).otherwise(window_start(k, n, count, length)).alias("token_start"),
            F.when(k == count - 1, n.cast("long")).otherwise(window_start(k + 1, n, count, length)).alias("token_end"),
            (k == count - 1).alias("final"),
        ),
    )
    return F.when(n > 0, made)


def byte_ids(text: Column, first: int = 19) -> Column:
    """Token ids of the UTF-8 bytes: byte + first."""
    arrow.bounded()

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def made() -> Iterator[tuple[object, int]]:
            for batch in batches:
                for x in batch:
                    data = x.as_buffer()
                    yield (None, 0) if data is None else (np.frombuffer(data, np.uint8).astype(np.int32) + np.int32(first), data.size)

        return arrow.in_rounds(made(), pa.list_(pa.int32()))

    return ids(F.encode(text, "UTF-8"))


def wrap(body: Column, final: Column, bos: int = BOS, end: int = END_OF_DOCUMENT) -> Column:
    return F.concat(F.array(F.lit(bos)), body, F.when(final, F.array(F.lit(end))).otherwise(F.array().cast("array<int>")))


def pad(ids: Column, length: int, pad_id: int = PAD) -> Column:
    """Right padding; a longer row is an error, never cut."""
    fits = F.size(ids) <= length
    return F.when(fits, F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(length) - F.size(ids)))).otherwise(
        F.raise_error(F.lit("a window is longer than its row")).cast("array<int>")
    )


def attention_mask(ids: Column, pad_id: int = PAD) -> Column:
    return F.transform(ids, lambda x: (x != pad_id).cast("int"))


def labels(ids: Column, pad_id: int = PAD, bos: int = BOS) -> Column:
    """The ids, or IGNORE at the first place, at start tokens, at padding and behind padding."""
    return F.transform(
        ids,
        lambda x, i: F.when((i == 0) | (x == bos) | (x == pad_id) | (F.get(ids, i - 1) == pad_id), F.lit(IGNORE)).otherwise(x),
    )


def target_count(labels_: Column) -> Column:
    """Labels that count, from the second place on."""
    return F.size(F.filter(labels_, lambda x, i: (i > 0) & (x != IGNORE))).cast("long")


def trimmed(ids: Column, longest: Column) -> Column:
    """A row cut to the longest active length of its batch."""
    return F.slice(ids, F.lit(1), longest)


def body_reject(body: Column, vocabulary: int = VOCABULARY) -> Column:
    """Why body ids may not stand in a document, or null."""
    specials = F.array(*[F.lit(i) for i in SPECIAL_IDS])
    return (
        F.when(F.size(body) == 0, "empty")
        .when(F.arrays_overlap(body, specials), "control_id")
        .when(~F.forall(body, lambda x: (x >= 0) & (x < vocabulary)), "out_of_range")
    )


def packed_reject(ids: Column, final: Column, length: int) -> Column:
    """Why a padded row breaks the contract, or null: padding only behind, a document end exactly in final windows."""
    forbidden = F.array(*[F.lit(i) for i in SPECIAL_IDS if i not in (BOS, PAD, END_OF_DOCUMENT)])
    active = F.filter(ids, lambda x: x != PAD)
    ends = F.size(F.filter(ids, lambda x: x == END_OF_DOCUMENT))
    return (
        F.when(F.size(ids) != length, "length")
        .when(F.arrays_overlap(ids, forbidden), "control_id")
        .when(F.get(ids, F.lit(0)) != BOS, "start")
        .when(ids != F.concat(active, F.array_repeat(F.lit(PAD), F.lit(length) - F.size(active))), "padding")
        .when(ends != final.cast("int"), "document_end")
        .when(final & (F.element_at(active, -1) != END_OF_DOCUMENT), "document_end")
        .when(F.size(active) - 1 - final.cast("int") < 1, "empty")
    )


def answer_labels(prefix: Column, answer: Column, length: int) -> Column:
    """Labels of a chat row: IGNORE on the prefix and on padding, the answer's ids else."""
    rest = F.lit(length) - F.size(prefix) - F.size(answer)
    return F.when(
        rest >= 0, F.concat(F.array_repeat(F.lit(IGNORE), F.size(prefix)), answer, F.array_repeat(F.lit(IGNORE), rest))
    ).otherwise(F.raise_error(F.lit("a chat row is longer than its window")).cast("array<int>"))
