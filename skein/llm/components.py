"""Near fingerprints linked into components, without all pairs of a crowded bucket.

``linked`` takes distinct 64-bit fingerprints and masks; each mask is a table keyed by fingerprint & mask. A key that one
fingerprint holds alone links nothing; two fingerprints are compared directly. Fingerprints of keys that hold three or more go
by their neighbourhoods: every one of them stands in the groups of its own value and of its 64 one-bit changes, and two stand in
a common group exactly if they differ in at most two bits. A group holds at most 65 fingerprints, whatever the data, and only
a star of links to its least member leaves it.

Other radii have no such neighbourhoods: fingerprints are dealt by key, and the members of a key are compared by Python workers.
Small keys are compared all at once; in others, and in those whose members are near each other, the search goes from each
fingerprint found to those not found yet. What is found in all keys of a bucket is joined there: each fingerprint leaves it with
one link at most, to the least one of its part, which is mostly the same one in all buckets. A key that over CELL fingerprints
have is dealt to a grid of cells, of which each two of them meet in one. Fingerprints of 128 bits are searched so by their first 64; a pair
is a link if all its bits are near as well.

``components`` is the alternation of large stars and small stars; each round is a written table, so that a lost executor costs
a round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import bounded_batches, drop_written, written

RADIUS = 2
#: Fingerprints of one cell of a key, and rows of a bucket, about.
CELL, BUCKET_ROWS = 100_000, 1 << 18
#: Members of a key that are compared all at once, links a member above which a key gives stars, comparisons at a time.
SMALL, DENSE, AT_ONCE = 512, 4, 1 << 20


def signed(x: int) -> int:
    """The signed long of 64 unsigned bits."""
    return x - (1 << 64) if x >= 1 << 63 else x


#: Fingerprints as columns of 64 bits each, and how many bits may differ in the first one, in the first two and so on.
Prints, Radii = tuple[np.ndarray, ...], tuple[int, ...]


def _within(x: Prints, y: Prints, radii: Radii) -> np.ndarray:
    differ = np.bitwise_count((x[0] ^ y[0]).view(np.uint64))
    near = differ <= radii[0]
    for a, b, radius in zip(x[1:], y[1:], radii[1:]):
        differ = differ + np.bitwise_count((a ^ b).view(np.uint64))
        near &= differ <= radius
    return near


def key_pairs(prints: Prints, radii: Radii) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j, whose links have the components of all pairs of distinct fingerprints within the radii."""
    left = np.arange(len(prints[0]))
    if len(left) <= SMALL:
        a, b = np.nonzero(np.triu(_within(tuple(p[:, None] for p in prints), tuple(p[None, :] for p in prints), radii), 1))
        if len(a) <= DENSE * len(left):
            return a, b
    froms, tos = [], []
    while len(left):
        seed, left = left[0], left[1:]
        found = [np.array([seed])]
        while found and len(left):
            new = found.pop()
            n = max(1, AT_ONCE // len(left))
            if len(new) > n:
                found.append(new[n:])
            hit = _within(tuple(p[new[:n]][:, None] for p in prints), tuple(p[left][None, :] for p in prints), radii).any(axis=0)
            if hit.any():
                found.append(left[hit])
                froms.append(np.full(int(hit.sum()), seed))
                tos.append(left[hit])
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *froms]), np.concatenate([none, *tos])


def key_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b), a < b, of one key's fingerprints of 64 bits (signed longs); see key_pairs."""
    fps = np.sort(fps)
    a, b = key_pairs((fps,), (radius,))
    return fps[a], fps[b]


def _links_of(key: np.ndarray, cell: np.ndarray, prints: Prints, radii: Radii) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of links of rows in order of key, cell and fingerprint: each group's are those of key_pairs."""
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    starts = np.flatnonzero(new)
    size = np.diff(np.append(starts, n))
    group, begins = np.repeat(np.arange(len(starts)), size), np.repeat(starts, size)
    large = size > SMALL
    links, froms, tos = np.zeros(len(starts), np.int64), [], []
    left, step = np.flatnonzero(~large[group]), 0
    while True:
        # every row with the one that stands so many places before it in its group
        step += 1
        left = left[(left - step >= begins[left]) & (links[group[left]] <= DENSE * size[group[left]])]
        if not len(left):
            break
        hit = left[_within(tuple(p[left] for p in prints), tuple(p[left - step] for p in prints), radii)]
        links += np.bincount(group[hit], minlength=len(starts))
        froms.append(hit - step)
        tos.append(hit)
    dense = large | (links > DENSE * size)
    if froms:
        froms, tos = np.concatenate(froms), np.concatenate(tos)
        plain = ~dense[group[tos]]
        yield froms[plain], tos[plain]
    for k in np.flatnonzero(dense):
        a, b = key_pairs(tuple(p[starts[k] : starts[k] + size[k]] for p in prints), radii)
        yield a + starts[k], b + starts[k]


def _numbered(prints: Prints) -> tuple[np.ndarray, Prints]:
    """Numbers of rows' fingerprints, in order, and the distinct fingerprints."""
    at = np.lexsort(prints[::-1])
    new = np.ones(len(at), bool)
    new[1:] = np.any([p[at][1:] != p[at][:-1] for p in prints], axis=0)
    number = np.empty(len(at), np.int64)
    number[at] = np.cumsum(new) - 1
    return number, tuple(p[at[new]] for p in prints)


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of the numbers below n that each is linked to, directly or not; itself if that is the least."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _near_links(fps: DataFrame, masks: list[int], radii: Radii) -> DataFrame:
    """Links (a, b) of distinct fingerprints by tables of masks of the first column; a and b are structs if there are more columns."""
    spark, names = fps.sparkSession, fps.columns
    bounded_batches(spark)
    n, wide = fps.count(), np.array(masks, np.int64)
    total = n * len(masks)
    buckets = max(1, total // BUCKET_ROWS)
    kinds = {"key": np.int64, "cell": np.int64, **{c: np.int64 for c in names}}

    def keys(x: np.ndarray) -> np.ndarray:
        """A hash of table and key, row by row; keys that share one are compared in vain."""
        table = np.arange(1, len(wide) + 1, dtype=np.uint64) << np.uint64(56)
        return blocks.mix((x[:, None] & wide[None, :]).view(np.uint64) + blocks.mix(table)[None, :]).view(np.int64).reshape(-1)

    hot = spark.sparkContext.broadcast(blocks.hot(fps, lambda batch: keys(batch.column(0).to_numpy()), total, CELL))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = max(1, blocks.HELD // len(wide))
        for batch in batches:
            for i in range(0, batch.num_rows, some):
                x = [c.to_numpy()[i : i + some] for c in batch.columns]
                key, prints = keys(x[0]), [np.repeat(c, len(wide)) for c in x]
                again, cell, _ = blocks.cells(key, blocks.mix(prints[-1].view(np.uint64), 5), *hot.value)
                rows = {"key": key[again], "cell": cell, **{c: p[again] for c, p in zip(names, prints)}}
                bucket = (blocks.mix(rows["key"].view(np.uint64) ^ blocks.mix(cell.view(np.uint64), 3), 9) % np.uint64(buckets)).astype(np.int64)
                for b, block in blocks.dealt(rows, bucket, lambda y, at: {c: y[c][at] for c in kinds}):
                    yield blocks.row(b, 0, block)

    ends = [f"{side}_{c}" for side in ("a", "b") for c in names]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in blocks.by_bucket(batches):
            x = blocks.joined([blocks.unpack(block, kinds) for _, block in some])
            at = blocks.order(x, tuple(kinds))
            prints = tuple(x[c][at] for c in names)
            number, distinct = _numbered(prints)
            found = [(number[a], number[b]) for a, b in _links_of(x["key"][at], x["cell"][at], prints, radii)]
            if found:
                least = least_linked(len(distinct[0]), *(np.concatenate(f) for f in zip(*found)))
                b = np.flatnonzero(least < np.arange(len(least)))
                yield pa.RecordBatch.from_arrays([pa.array(p[side]) for side in (least[b], b) for p in distinct], ends)

    links = blocks.shuffled(fps.mapInArrow(deal, blocks.SCHEMA)).mapInArrow(compare, ", ".join(f"{e} bigint" for e in ends)).distinct()
    return links.select(*[_node(*[F.col(f"{side}_{c}").alias(c) for c in names]).alias(side) for side in ("a", "b")])


def _node(*parts: Column) -> Column:
    """What stands for a fingerprint: its one long, or a struct of its longs."""
    return F.struct(*parts) if len(parts) > 1 else parts[0]


def linked(prints: DataFrame, masks: list[int], col: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs of fingerprints that differ in at most ``radius`` bits.

    Some mask must miss all differing bits of any such pair.
    """
    fps = prints.select(F.col(col).alias("fp"))
    if radius != RADIUS:
        return _near_links(fps, masks, (radius,))
    tables = F.array(*[F.struct(F.lit(i).cast("short").alias("t"), F.lit(m).cast("long").alias("m")) for i, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(tables).alias("x")).select("fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"))
    held = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    held = written(held, "buckets")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = held.where((F.col("n") == 2) & near).select("a", "b")
    crowded = keyed.join(held.where("n > 2").select("t", "key"), ["t", "key"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)).cast("long") for i in range(64)])
    around = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    stars = around.groupBy("mid").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    stars = stars.select(F.element_at("fps", 1).alias("a"), F.explode(F.slice("fps", F.lit(2), F.size("fps") - 1)).alias("b"))
    return pairs.unionByName(stars).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of every node that has a link."""
    state = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = digest(state)
    while last[0]:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = both.where("v < u").join(least, "u").select("u", F.col("m").alias("v"))
        large = large.unionByName(down).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = written(small.where("u <> v").distinct(), "links")
        now = digest(after)
        drop_written(state)
        state, same, last = after, now == last, now
        if same:
            break
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(
    prints: DataFrame, masks: list[int], id_col: str, print_col: str, group_col: str, radius: int = RADIUS, whole: int | None = None
) -> DataFrame:
    """The columns of prints and group_col: the least id reachable over near fingerprints (hexadecimal strings of 64 bits).

    With ``whole``, strings are of 128 bits, and near ones differ in at most ``radius`` of the first 64 and ``whole`` of all.
    Equal fingerprints stand once in the search. Null ids do not name a group unless it has no other.
    """

    def half(at: int) -> Column:
        high, low = (F.conv(F.substring(print_col, i, 8), 16, 10).cast("long") for i in (at, at + 8))
        return F.shiftleft(high, 32).bitwiseOR(low)

    halves = [half(1).alias("fp")] + ([] if whole is None else [half(17).alias("check")])
    rows = prints.withColumn("__fp", _node(*halves))
    fps = written(rows.groupBy("__fp").agg(F.min(id_col).alias("__least")), "distinct")
    if whole is None:
        links = linked(fps, masks, "__fp", radius)
    else:
        links = _near_links(fps.select("__fp.fp", "__fp.check"), masks, (radius, whole))
    roots = components(links)
    known = fps.join(roots.select(F.col("node").alias("__fp"), "root"), "__fp", "left").withColumn("root", F.coalesce("root", "__fp"))
    least = known.groupBy("root").agg(F.min("__least").alias(group_col))
    of = written(known.join(least, "root").select("__fp", group_col), "roots")
    drop_written(fps)
    return rows.join(of, "__fp").select(*prints.columns, group_col)
