"""Operator 9: SimHash document fingerprints, and all pairs within a Hamming radius by permuted block tables.

Terms are words and pairs of neighbouring words. A pair weighs 2, as pairs tell texts apart that share common words; a word
weighs 1 from four and 2 from eight characters on, else 0 (1 for every word where nothing else votes). Each term's hash votes
with its weight on signed bits, and a bit is set where the votes are positive. A text without words has fingerprint zero.

Search: a fingerprint is cut into blocks. Fingerprints within radius r of each other agree on all but at most r blocks, so that
one table for each choice of blocks - r blocks, keyed by them, meets every such pair. Within a key, equal fingerprints stand once;
see ``components.linked`` for keys that hold many.

Defined cases: a null text is an empty text; ties of the id are ordered by text; repeated rows are separate documents; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, map_texts, written
from .components import grouped, signed

BITS, BLOCK = 64, 1 << 15
#: Search of the query, from measured distances of near copies (see the README), and the blocks of its tables.
SEARCH_RADIUS, SEARCH_BLOCKS = 8, 10
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, from the highest on."""
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i : i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.uint32)
    return total


class SimHash:
    """Fingerprints of texts; word hashes are remembered up to a bound."""

    def __init__(self, most: int = 250_000):
        self.most, self.memo = most, {}

    def _hashes(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > self.most:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def of(self, text: str) -> int:
        words = text.split()
        if not words:
            return 0
        h = self._hashes(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        pairs = _mix(h[:-1] * np.uint64(3) + _mix(h[1:]))
        groups = [(2, pairs), (1, h[size >= 4]), (1, h[size >= 8])]
        total = sum(w * len(x) for w, x in groups)
        if not total:
            groups, total = [(1, h)], len(h)
        votes = sum(w * _set_bits(x) for w, x in groups)
        return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1 - (a ^ b).bit_count() / BITS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and fingerprint (16 lowercase hex digits) of every whole text."""

    def make():
        sim = SimHash()
        return lambda texts: {"fingerprint": pa.array([f"{sim.of(t):016x}" for t in texts])}

    return map_texts(docs, [id_col], text_col, "fingerprint string", make)


def _edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) of the following text's first."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compared(sim: SimHash, text: str, own: int, following: str, other: int) -> tuple:
    changed = _edited(text, following)
    print_ = sim.of(changed)
    return (
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        f"{own:016x}",
        f"{print_:016x}",
        likeness(own, print_),
        likeness(own, other),
    )


_FIELDS = [
    ("n_chars", "bigint", pa.int64()),
    ("edited_sha256", "string", pa.string()),
    ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()),
    ("near_edited", "double", pa.float64()),
    ("near_next", "double", pa.float64()),
]
_HEAD, _TAIL = 1, 2


def edit_distances(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see _edited.

    The following document is the next by descending id (ties by a hash of the text, null ids last); after the last comes the
    first. Documents are dealt out by id ranges and sorted once; a worker streams its range and holds two texts. The last
    document of a range waits for the first of the next one: one text of either kind per range is matched afterwards.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    order = [F.col("__id").desc_nulls_last(), F.col("__tie")]
    rows = rows.withColumn("__tie", F.xxhash64("__text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__id", "__text")
    kind = rows.schema["__id"].dataType.simpleString()
    names = [f[0] for f in _FIELDS]
    made = ", ".join(f"{n} {t}" for n, t, _ in _FIELDS)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sim, part, waiting = SimHash(), TaskContext.get().partitionId(), None
        border: list[tuple] = []
        for batch in batches:
            ids, done, which = batch.column(0), [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = sim.of(text)
                if waiting is None:
                    border.append((_HEAD, pa.concat_arrays([ids.slice(i, 1)]), text))
                else:
                    done.append(_compared(sim, waiting[1], waiting[2], text, own))
                    which.append(waiting[0])
                waiting = (ids.slice(i, 1), text, own)
            if done:
                yield _batch(pa.concat_arrays(which), [0] * len(done), part, [None] * len(done), done)
        if waiting is not None:
            border.append((_TAIL, pa.concat_arrays([waiting[0]]), waiting[1]))
            none = (None,) * len(names)
            yield _batch(pa.concat_arrays([b[1] for b in border]), [b[0] for b in border], part, [b[2] for b in border], [none] * len(border))

    def _batch(ids: pa.Array, border: list[int], part: int, texts: list, made_rows: list[tuple]) -> pa.RecordBatch:
        n = len(border)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(border, pa.int32()), pa.array([part] * n, pa.int64()), pa.array(texts, pa.string())]
            + [pa.array([r[k] for r in made_rows], f[2]) for k, f in enumerate(_FIELDS)],
            ["__id", "__border", "__part", "__text", *names],
        )

    first = written(rows.mapInArrow(stream, f"__id {kind}, __border int, __part bigint, __text string, {made}"), "edited")
    heads = first.where(F.col("__border") == _HEAD).select("__part", F.col("__text").alias("__head"))
    # one row per range: few, and each a text
    in_turn = Window.orderBy("__part")
    heads = heads.select(
        "__part",
        F.coalesce(F.lead("__head").over(in_turn), F.first("__head").over(in_turn.rowsBetween(Window.unboundedPreceding, 0))).alias("__next"),
    )
    tails = first.where(F.col("__border") == _TAIL).select("__id", "__part", "__text").join(heads, "__part").select("__id", "__text", "__next")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sim = SimHash()
        for batch in batches:
            done = [_compared(sim, t, sim.of(t), f, sim.of(f)) for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array([r[k] for r in done], f[2]) for k, f in enumerate(_FIELDS)], ["__id", *names])

    rest = tails.mapInArrow(last, f"__id {kind}, {made}")
    return first.where(F.col("__border") == 0).select("__id", *names).unionByName(rest).withColumnRenamed("__id", id_col)


def block_masks(radius: int, blocks: int) -> list[int]:
    """Signed 64-bit masks: one for each choice of blocks - radius blocks; some mask misses all differing bits of a near pair."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [signed(sum(chosen)) for chosen in combinations(parts, blocks - radius)]


def with_groups(prints: DataFrame, blocks: int = 5, id_col: str = "doc_id", radius: int = 2) -> DataFrame:
    """prints, which should be a written table, and group_id: the least id reachable over fingerprints within the radius.

    Near fingerprints are found by permuted block tables.
    """
    return grouped(prints, block_masks(radius, blocks), id_col, "fingerprint", "group_id", radius)


def near_groups(docs: DataFrame, blocks: int = 5, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """id_col, fingerprint and group_id of every text."""
    return with_groups(written(fingerprints(docs, id_col, text_col), "prints"), blocks, id_col, radius)
