"""Bounded Arrow batches of the Python functions: a worker's memory follows neither the rows of a batch nor the size of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of one Arrow batch that Spark sends, and rows of it.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20
#: What a batch returned holds at most, in ids or characters, or it is one row.
ROUND = 1 << 18


def bounded() -> None:
    """Python functions of the active session exchange small Arrow batches from now on."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def in_rounds(made: Iterable[tuple[object, int]], kind: pa.DataType) -> Iterator[pa.Array]:
    """Arrays of the values of ``made`` (value, size), each of ROUND at most in all, or of one value."""
    out, held = [], 0
    for value, size in made:
        if out and held + size > ROUND:
            yield pa.array(out, kind)
            out, held = [], 0
        out.append(value)
        held += size
    if out:
        yield pa.array(out, kind)


def each(batches: Iterable[pa.Array], make: Callable, size: Callable[[object], int], kind: pa.DataType) -> Iterator[pa.Array]:
    """What ``make`` returns for each value, where ``size`` tells how much that holds; one value is a Python object at a time."""

    def made() -> Iterator[tuple[object, int]]:
        for batch in batches:
            for x in batch:
                value = make(x.as_py())
                yield value, size(value)

    return in_rounds(made(), kind)
