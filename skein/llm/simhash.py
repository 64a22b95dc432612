"""Operator 6: SimHash near-duplicate groups by covering locality-sensitive hashing.

A text's words are those of ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; its shingles are three words in a row, repeats
included. A fingerprint bit is set if it is set in over half of the shingles' XXH64 values (seed 42).

Covering: position i of the 64 bits has the vector (i mod 7) + 1 in GF(2)^3, and each of the seven nonzero vectors v has a mask
of the positions whose vector has inner product 1 with v. The vectors of any two positions span at most a plane, so some v is
orthogonal to both: its mask holds neither position, and every pair within radius 2 collides in that table. Masks keep 36 or
more bits. See components for what happens to crowded keys.

Near copies (``near_copies``) are texts alike in most of their shingles of five words. They are searched by 64 bits at radius 11: one
half of 32 bits holds five of the differing bits at most, and the 63 vectors of GF(2)^6 give it masks of 16 bits, or all 32. As unlike
texts come that near by chance in large tables, 64 more bits must agree too. Keys of 16 bits mean that comparisons grow with the square
of the number of different texts, at n / 65536 a text and table; ``radius`` is a parameter.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer than three
words are one shingle; repeated rows are separate rows of one group; ties of a group go to the least id, null ids last; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix
from .common import fresh, map_texts, written
from .components import grouped, signed

SEED, WIDTH, BLOCK = 42, 3, 1 << 15
#: Near copies: words of a shingle, differing bits of the first 64 and of all 128, from measured distances (see the README).
COPY_WIDTH, COPY_RADIUS, COPY_WHOLE = 5, 11, 24


def _hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """Blocks of the hashes of all shingles of a whole text."""
    words = text.encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), BLOCK):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i : i + BLOCK], ends[i : i + BLOCK])], np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def fingerprint(text: str, width: int = WIDTH) -> int:
    """64 majority bits over the shingles of a whole text."""
    n, votes = 0, np.zeros(64, np.int64)
    for h in _hashes(text, width):
        n += len(h)
        votes += _bits(h).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def long_fingerprint(text: str, width: int = COPY_WIDTH) -> int:
    """128 majority bits over the shingles of a whole text: of their hashes, and of hashes of these.

    Where as many shingles vote for a bit as against it, a hash of their sum decides, so that texts of few shingles are not alike by
    their zeros. A text without words has zero.
    """
    n, total, votes = 0, 0, np.zeros(128, np.int64)
    for h in _hashes(text, width):
        n, total = n + len(h), (total + int(h.sum(dtype=np.uint64))) % (1 << 64)
        votes += np.concatenate([_bits(h).sum(axis=0, dtype=np.int64), _bits(mix(h, 1)).sum(axis=0, dtype=np.int64)])
    if not n:
        return 0
    even = _bits(mix(np.array([total, total], np.uint64) ^ np.array([2, 3], np.uint64))).reshape(-1)
    return int.from_bytes(np.packbits(np.where(2 * votes == n, even, 2 * votes > n)).tobytes(), "big")


def covering_masks() -> list[int]:
    """Signed 64-bit masks, one for each nonzero vector of GF(2)^3."""
    return [signed(sum(1 << i for i in range(64) if ((i % 7 + 1) & v).bit_count() & 1)) for v in range(1, 8)]


def covering_halves(radius: int) -> list[int]:
    """Signed 64-bit masks for a radius of up to 11: fingerprints within it agree in some mask.

    One half of 32 bits has radius // 2 differing bits at most. Its position i has the vector (1, i) over GF(2), of radius // 2 + 1
    bits, and each nonzero vector has a mask as in covering_masks: one is orthogonal to the vectors of all differing bits. Masks keep 16
    bits of a half, or all 32.
    """
    dims = radius // 2 + 1
    if not 1 <= dims <= 6:
        raise ValueError("radius is 0 to 11")
    top = 1 << (dims - 1)
    parts = [sum(1 << i for i in range(32) if ((top | i % top) & v).bit_count() & 1) for v in range(1, 2 * top)]
    return [signed(part << at) for at in (0, 32) for part in parts]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """id_col, the columns ``more`` and fingerprint (16 lowercase hex digits)."""
    return map_texts(
        docs, [id_col, *more], text_col, "fingerprint string", lambda: lambda texts: {"fingerprint": pa.array([f"{fingerprint(t):016x}" for t in texts])}
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """As fingerprints, and component_id: the least id that is reachable over fingerprints within two bits."""
    prints = written(fingerprints(docs, id_col, text_col, more), "prints")
    return grouped(prints, covering_masks(), id_col, "fingerprint", "component_id")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    more: tuple[str, ...] = (),
    width: int = COPY_WIDTH,
    radius: int = COPY_RADIUS,
    whole: int = COPY_WHOLE,
) -> DataFrame:
    """id_col, ``more``, fingerprint (128 bits, 32 digits) and component_id, linked within ``radius`` of the first 64 bits and ``whole`` of all.

    For texts alike in most shingles rather than nearly equal: two unlike texts meet both bounds once in 10^13 pairs or so.
    """
    make = lambda: lambda texts: {"fingerprint": pa.array([f"{long_fingerprint(t, width):032x}" for t in texts])}
    prints = written(map_texts(docs, [id_col, *more], text_col, "fingerprint string", make), "prints")
    return grouped(prints, covering_halves(radius), id_col, "fingerprint", "component_id", radius, whole)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", find: Callable[..., DataFrame] = near_groups) -> DataFrame:
    """The rows of docs, with all their columns, of which those that repeat a group are gone: the row of the least id stays.

    ``find`` is near_groups or near_copies.
    Rows of equal id and text are one document and stay once; rows of a null id go unless their group has no other.
    """
    text, names = F.col(f"`{text_col}`"), docs.columns
    tie, gone_id, gone_tie = fresh([*names, "component_id"], "tie", "gone", "gone_tie")
    rows = docs.withColumn(tie, F.coalesce(F.xxhash64(text), F.lit(0)))
    groups = written(find(rows, id_col, text_col, (tie,)), "groups")
    key = F.col(f"`{id_col}`")
    gone = groups.where(~key.eqNullSafe(F.col("component_id"))).select(key.alias(gone_id), F.col(tie).alias(gone_tie)).distinct()
    left = rows.join(gone, key.eqNullSafe(F.col(gone_id)) & (F.col(tie) == F.col(gone_tie)), "left_anti")
    if not groups.groupBy(f"`{id_col}`", tie).count().where("count > 1").isEmpty():
        left = left.dropDuplicates([id_col, tie])
    return left.select(*[F.col(f"`{c}`") for c in names])
