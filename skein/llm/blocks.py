"""Rows that are shuffled as blocks: one row holds the packed columns of all that a task has for one bucket.

Numbers of buckets follow the counted data, so that a bucket's arrays fit a worker. A key that more rows have than fit is dealt to
a grid of cells: its rows have sides, cell (a, b) holds sides a and b, and each two rows meet in one cell at least.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "bucket bigint, kind int, block binary"
#: Rows that a worker holds before it writes blocks; keys that have a grid at most, as they are broadcast.
HELD, MOST_HOT = 1 << 20, 1 << 20

_U = np.uint64
Columns = dict[str, np.ndarray]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = h + _U(salt)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def pack(columns: Columns) -> bytes:
    """The columns' lengths and values; values in low and high halves, so that the zeros of small numbers stand together."""
    out = [np.array([len(c) for c in columns.values()], "<i8").tobytes()]
    for c in columns.values():
        halves = np.ascontiguousarray(c).view(f"<u{max(1, c.itemsize // 2)}")
        out += [halves.tobytes()] if c.itemsize == 1 else [halves[0::2].tobytes(), halves[1::2].tobytes()]
    return b"".join(out)


def unpack(data: bytes, kinds: dict[str, type]) -> Columns:
    sizes, at, out = np.frombuffer(data, "<i8", len(kinds)), 8 * len(kinds), {}
    for (name, kind), n in zip(kinds.items(), sizes.tolist()):
        wide = np.dtype(kind).itemsize
        if wide == 1:
            out[name] = np.frombuffer(data, kind, n, at)
        else:
            halves = np.empty((n, 2), f"<u{wide // 2}")
            halves[:, 0] = np.frombuffer(data, halves.dtype, n, at)
            halves[:, 1] = np.frombuffer(data, halves.dtype, n, at + n * wide // 2)
            out[name] = halves.reshape(-1).view(kind)
        at += n * wide
    return out


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first .. first + size - 1 of each, one after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def joined(held: list[Columns]) -> Columns:
    return {c: np.concatenate([x[c] for x in held]) for c in held[0]}


def order(x: Columns, names: tuple[str, ...]) -> np.ndarray:
    """Order by these columns, the first one first; columns of one value take no part."""
    keys = [x[c] for c in names if len(x[c]) and (x[c] != x[c][0]).any()]
    return np.lexsort(keys[::-1]) if keys else np.arange(len(x[names[0]]))


def dealt(x: Columns, bucket: np.ndarray, cut: Callable[[Columns, np.ndarray], Columns]) -> Iterator[tuple[int, bytes]]:
    """(bucket, block) of all buckets that have rows; ``cut`` takes the rows of some places."""
    # numbers of 16 bits are sorted by radix
    places = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[places], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(places))):
        yield int(bucket[places[a]]), pack(cut(x, places[a:b]))


def row(bucket: int, kind: int, block: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([kind], pa.int32()), pa.array([block], pa.binary())], ["bucket", "kind", "block"])


def shuffled(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """Rows of ``shuffled`` as (kind, block) pairs by bucket."""
    rows = ((b, k, block) for batch in batches for b, k, block in zip(*(c.to_pylist() for c in batch.columns)))
    for bucket, some in itertools.groupby(rows, key=lambda r: r[0]):
        yield bucket, ((k, block) for _, k, block in some)


def hot(df: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], total: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Signed 64-bit keys, sorted, that more than ``most`` of the ``total`` rows have, and the sides of their grids.

    Workers report keys that they meet a quarter as often as a key of that many rows is met on average, so that few rows are
    shuffled; a key that is just above the bound may be missed. At most MOST_HOT keys come to the driver.
    """
    most = max(most, total // MOST_HOT)
    none = np.zeros(0, np.int64)
    if total <= most:
        return none, none
    tasks = max(1, df.rdd.getNumPartitions(), total // HELD)
    least = max(1, most // (4 * tasks))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= least
            return pa.RecordBatch.from_arrays([pa.array(keys[often], pa.int64()), pa.array(times[often], pa.int64())], ["key", "n"])

        for batch in batches:
            held.append(keys_of(batch))
            n += len(held[-1])
            if n >= HELD:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    counts = df.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    table = counts.where(F.col("n") > most).orderBy("key").toArrow()
    return table["key"].to_numpy(), -(-table["n"].to_numpy() // most)


def cells(key: np.ndarray, whose: np.ndarray, hot_keys: np.ndarray, hot_sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of rows, their cells and their sides; ``whose`` is a hash that deals rows to sides. Other keys have one cell."""
    if not len(hot_keys):
        return np.arange(len(key)), np.zeros(len(key), np.int64), np.zeros(len(key), np.int32)
    at = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
    sides = np.where(hot_keys[at] == key, hot_sides[at], 1)
    side = (whose % sides.astype(_U)).astype(np.int32)
    again, other = np.repeat(np.arange(len(key)), sides), ranges(np.zeros(len(key), np.int64), sides)
    side = side[again]
    return again, (np.minimum(side, other) << 32) | np.maximum(side, other), side
