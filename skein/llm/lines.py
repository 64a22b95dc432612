"""Operator 2: line deduplication by an exact set-similarity join.

A line is a piece between line feeds; its tokens are its words ``[^\\x20\\x09-\\x0D]+``, where the second of two equal words is
another token. A line goes if an earlier line, kept or not, has a Jaccard similarity of 0.8 or more. Earlier is by document id
(null first), then a hash of the text, then the line's number. Lines without words stay.

1. Word counts of the whole corpus, in hashed buckets of a fixed number, give every token a class of rarity.
2. Lines of equal token sets are one line, the earliest; the others go. Tasks combine theirs before the shuffle.
3. Prefix filter: a line's tokens are ordered by rarity; two lines that match share a token within their first
   n - ceil(0.8 n) + 1. These tokens are dealt out by token, in parts one after the other, so that their shuffle takes that share
   of the disk; a token that many lines have is dealt to a grid of cells, of which each pair of lines meets in one.
4. Within a token, lines stand by classes of sizes, and pairs within reach of each other pass the length filter, the positional filter and a filter by parity bits of both token sets (their
   difference is at least that of the bits). A line names a few of its candidates, the earliest ones; lines that have more and
   match none of those go through a join with all of theirs, so that families of near copies are not paired with each other.
5. Candidates are verified on their token sets. What is compared is 64-bit hashes of tokens.

Lines and tokens are shuffled as blocks: a row holds the packed columns of all that a task has for one bucket.

Defined cases: a null text stays null, and a null or empty text has nothing to remove; rows of equal id and text are one
document and get equal results; ids that are no whole numbers are ordered by a hash; a text or line of any length is read whole,
by one task; other columns are kept as they are, whatever their names, but those named in ``counts`` must be new; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import bounded_batches, drop_written, fresh, keyed, release, rounds, written

#: Buckets of word counts, as a power of two.
COUNT_BITS = 20
#: Lines of one cell of a token, about; candidates that a line names per token.
CELL, NAMED = 20_000, 4
#: 64-bit words of the parity bitmap of a line's tokens: long lines need long bitmaps to be told apart.
BITMAP = 4
#: Tokens of a line up to which one word, and two words of the bitmap are enough.
ONE_WORD, TWO_WORDS = 24, 64
#: Lines with fewer tokens match equal token sets only.
LEAST = 4
#: Least sizes of classes of lines: 1.25 times a size is in the next class at most.
_CLASSES = [LEAST]
while _CLASSES[-1] < 1 << 31:
    _CLASSES.append(5 * _CLASSES[-1] // 4 + 1)
_CLASSES = np.array(_CLASSES)
#: Parts of the tokens that are dealt out one after the other.
PASSES = 2
#: Lines, and tokens, of a bucket, about; what a worker holds before it writes blocks.
BUCKET_LINES, BUCKET_TOKENS, HELD_LINES = 1 << 15, 1 << 17, 1 << 17
#: Most bits of a filter of candidates, as a power of two; filters grow with the candidates up to here.
FILTER_BITS = 27
OUT_ROWS = 20_000
#: Bytes of a block of written lines, about (or one line): a batch of the reader holds READ_ROWS blocks.
BLOCK_BYTES = 1 << 17
#: Pairs that are compared at a time, about (at least one for each row that is searched).
ROUND_PAIRS = 1 << 17
#: Characters of texts that are cut into words at a time (or one text): their arrays should fit a core's cache.
ROUND = 1 << 18

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C55
_STRIDE = 2_654_435_761
#: Masks of the first 0 to 8 bytes of a little-endian number.
_HEADS = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)
REF = ["did", "tie", "ln"]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word in an array of bytes: eight bytes at a time of all words that have as many."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, size = edges[0::2], edges[1::2] - edges[0::2]
    if not len(starts):
        return starts, np.zeros(0, _U)
    eights = np.ndarray(len(data), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).data, strides=(1,))
    h = blocks.mix(_HEADS[np.minimum(size, 8)] & eights[starts], 1) + size.astype(_U)
    rest, at = np.flatnonzero(size > 8), 8
    while len(rest):
        h[rest] = blocks.mix((h[rest] * _U(_BASE)) ^ (_HEADS[np.minimum(size[rest] - at, 8)] & eights[starts[rest] + at]), 1)
        at += 8
        rest = rest[size[rest] > at]
    return starts, blocks.mix(h, 2)


def _prefix_length(size: np.ndarray) -> np.ndarray:
    return np.where(size < LEAST, 0, size - (4 * size + 4) // 5 + 1)


def _words_of(size: np.ndarray) -> np.ndarray:
    """Words of the bitmap that a line of this size has."""
    return np.where(size <= ONE_WORD, 1, np.where(size <= TWO_WORDS, 2, BITMAP))


class Lines:
    """The lines with words of some texts, and their tokens in order of rarity (classes: by word bucket)."""

    def __init__(self, texts: list[str], classes: np.ndarray):
        data = np.frombuffer("\n".join(texts).encode(), np.uint8)
        feeds = np.flatnonzero(data == 10)
        starts, h = _word_hashes(data)
        line = np.searchsorted(feeds, starts)
        rare = classes[(h >> _U(64 - COUNT_BITS)).astype(np.int64)].astype(_U)
        if len(feeds) < 1 << 20:
            order = np.argsort((line.astype(_U) << _U(44)) | (rare << _U(36)) | (h >> _U(28)))
        else:
            order = np.lexsort(((rare << _U(36)) | (h >> _U(28)), line))
        line, h = line[order], h[order]
        n = len(h)
        at = np.arange(n)
        again = np.zeros(n, bool)
        again[1:] = (line[1:] == line[:-1]) & (h[1:] == h[:-1])
        times = (at - np.maximum.accumulate(np.where(again, 0, at))).astype(_U)
        self.token = np.where(again, blocks.mix(h + times * _U(0xD6E8FEB86659FD93)), h)
        new = np.ones(n, bool)
        new[1:] = line[1:] != line[:-1]
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, n))
        held = line[self.first]
        # documents begin at the lines behind those of the texts before
        per_text = np.array([t.count("\n") + 1 for t in texts])
        begin = np.cumsum(per_text) - per_text
        self.text = np.searchsorted(begin, held, "right") - 1
        self.number = held - begin[self.text]

    def sums(self, salt: int) -> np.ndarray:
        return np.add.reduceat(blocks.mix(self.token, salt), self.first).view(np.int64)

    def bitmap(self) -> np.ndarray:
        """Words of how often the tokens of each bit occur, modulo two, lines one after the other; see _words_of."""
        words, bit = _words_of(self.size), _U(1) << (self.token >> _U(58))
        place = ((self.token >> _U(50)) & (np.repeat(words, self.size) - 1).astype(_U)).astype(np.int64)
        parts = [np.bitwise_xor.reduceat(np.where(place == w, bit, _U(0)), self.first) for w in range(BITMAP)]
        return np.stack(parts, axis=1)[np.arange(BITMAP) < words[:, None]]

    def prefixes(self) -> np.ndarray:
        """Keys (32 bits: tokens may share one, which costs comparisons only) of each line's rarest tokens, line after line."""
        place = np.arange(len(self.token)) - np.repeat(self.first, self.size)
        return (self.token[place < np.repeat(_prefix_length(self.size), self.size)] >> _U(32)).astype(np.uint32)

    def tokens(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(self.first, len(self.token)), pa.int32()), pa.array(self.token.view(np.int64)))


#: What a line is known by, and has: known is 0 where the document's id is null.
_LINE = {"s1": np.int64, "s2": np.int64, "known": np.uint8, "did": np.int64, "tie": np.int64, "ln": np.int32, "size": np.int32}
_LINES = _LINE | {"bits": np.uint64, "keys": np.uint32}


Cut = Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]]


def _cutter(x: dict[str, np.ndarray], **many: np.ndarray) -> Cut:
    """Takes the rows of some places of x; ``many``: how many values each row has of a column. Its offsets are found once for all cuts."""
    spans = {c: (np.cumsum(n) - n, n) for c, n in many.items()}

    def cut(_: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
        return {c: x[c][blocks.ranges(spans[c][0][at], spans[c][1][at]) if c in spans else at] for c in x}

    return cut


def _lines_cutter(x: dict[str, np.ndarray]) -> Cut:
    return _cutter(x, bits=_words_of(x["size"]), keys=_prefix_length(x["size"]))


def _lines_at(x: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    """The lines of these places."""
    return _lines_cutter(x)(x, at)


def _earliest(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the earliest line of each token set, and of the others, without those of repeated rows."""
    order = blocks.order(x, ("s1", "s2", "known", "did", "tie", "ln"))
    step = {c: np.concatenate([[True], x[c][order][1:] != x[c][order][:-1]])[: len(order)] for c in ("s1", "s2", "known", "did", "tie", "ln")}
    new = step["s1"] | step["s2"]
    other = ~new & (step["known"] | step["did"] | step["tie"] | step["ln"])
    return order[new], order[other]


def rarity(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Classes of rarity (0: no word; a step is an eighth of a power of two) by hashed bucket, and the number of lines, of all docs."""
    bounded_batches(docs.sparkSession)
    names, wide = ["slice", "counts", "n_lines"], 1 << COUNT_BITS - 6

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n_lines = np.zeros(1 << COUNT_BITS, np.int64), 0
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t is not None]
            for a, b in rounds(texts, ROUND):
                data = np.frombuffer("\n".join(texts[a:b]).encode(), np.uint8)
                n_lines += int(np.count_nonzero(data == 10)) + 1
                _, h = _word_hashes(data)
                np.add.at(total, (h >> _U(64 - COUNT_BITS)).astype(np.int64), 1)
        if n_lines:
            slices = [blocks.pack({"n": total[k * wide : (k + 1) * wide]}) for k in range(64)]
            yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int64()), pa.array(slices, pa.binary()), pa.array([n_lines] + [0] * 63, pa.int64())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for k, block, n in zip(*(c.to_pylist() for c in batch.columns)):
                held = total.setdefault(k, [np.zeros(wide, np.int64), 0])
                held[0] += blocks.unpack(block, {"n": np.int64})["n"]
                held[1] += n
        for k, (counts, n) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([counts.tobytes()], pa.binary()), pa.array([n], pa.int64())], names)

    kind = "slice bigint, counts binary, n_lines bigint"
    rows = docs.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(count, kind)
    # 64 rows of 2 ** COUNT_BITS counts together, whatever the corpus
    table = rows.repartition("slice").mapInArrow(add, kind).toArrow()
    counts, n_lines = np.zeros(1 << COUNT_BITS, np.int64), 0
    for k, block, n in zip(*(c.to_pylist() for c in table.columns)):
        counts[k * wide : (k + 1) * wide] = np.frombuffer(block, np.int64)
        n_lines += n
    return np.minimum(255, np.ceil(8 * np.log2(counts + 1.0))).astype(np.uint8), n_lines


def _line_table(texts: DataFrame, classes, n_lines: int) -> DataFrame:
    """Rows with a block of lines with words that are the earliest of their token sets, and a row without for each that goes."""
    buckets = max(1, n_lines // BUCKET_LINES)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            x = blocks.joined(held)
            first, other = _earliest(x)
            kept, gone = _lines_at(x, first), {c: x[c][other] for c in _LINE}
            rows = [(b, 0, block) for b, block in blocks.dealt(kept, (kept["s1"].view(_U) % _U(buckets)).astype(np.int64), _lines_cutter(kept))]
            spread = (blocks.mix(gone["did"].view(_U), 7) % _U(buckets)).astype(np.int64)
            rows += [(b, 1, block) for b, block in blocks.dealt(gone, spread, lambda y, at: {c: y[c][at] for c in _LINE})]
            for row in rows:
                yield blocks.row(*row)

        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            did, tie = batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()
            body = batch.column(2).to_pylist()
            for a, b in rounds(body, ROUND):
                x = Lines(body[a:b], classes.value)
                if not len(x.first):
                    continue
                at = x.text + a
                held.append(
                    {"s1": x.sums(1), "s2": x.sums(2), "known": known[at], "did": did[at], "tie": tie[at], "ln": x.number.astype(np.int32),
                     "size": x.size.astype(np.int32), "bits": x.bitmap(), "keys": x.prefixes()}
                )
                n += len(x.first)
                if n >= HELD_LINES:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    names = [*REF, "n_keys", "block"]

    def whole(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, words = _prefix_length(x["size"]), _words_of(x["size"])
        ends = np.cumsum(4 * keys + 8 * words + 32)
        cut, edges = _lines_cutter(x), np.flatnonzero(np.diff(ends // BLOCK_BYTES, prepend=-1))
        for i, j in zip(edges, np.append(edges[1:], len(ends))):
            block = blocks.pack(cut(x, np.arange(i, j)))
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.int32())), pa.array([keys[i:j].sum()], pa.int64()), pa.array([block], pa.binary())], names)

    def gone(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(x["did"]), OUT_ROWS):
            part = {c: x[c][i : i + OUT_ROWS] for c in _LINE}
            columns = [pa.array(part["did"], pa.int64(), mask=part["known"] == 0), pa.array(part["tie"]), pa.array(part["ln"])]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(part["did"]), pa.int64()), pa.nulls(len(part["did"]), pa.binary())], names)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in blocks.by_bucket(batches):
            held, n = [], 0
            for kind, block in some:
                x = blocks.unpack(block, _LINE if kind else _LINES)
                if kind:
                    yield from gone(x)
                    continue
                held.append(x)
                n += len(x["did"])
                if len(held) > 1 and n - len(held[0]["did"]) >= HELD_LINES:
                    x = blocks.joined(held)
                    first, other = _earliest(x)
                    yield from gone({c: x[c][other] for c in _LINE})
                    held, n = [_lines_at(x, first)], len(first)
            if held:
                x = blocks.joined(held)
                first, other = _earliest(x)
                yield from gone({c: x[c][other] for c in _LINE})
                yield from whole(_lines_at(x, first))

    return blocks.shuffled(texts.mapInArrow(deal, blocks.SCHEMA)).mapInArrow(combine, "did bigint, tie bigint, ln int, n_keys bigint, block binary")


def _unpacked(column: pa.Array) -> dict[str, np.ndarray]:
    """The lines of an array of blocks."""
    return blocks.joined([blocks.unpack(block, _LINES) for block in column.to_pylist()])


_TOKENS = {
    "key": np.uint32, "cell": np.int64, "open": np.uint8, "known": np.uint8, "did": np.int64, "tie": np.int64, "ln": np.int32, "size": np.int32, "pos": np.int32,
    "side": np.int32, "bits": np.uint64,
}


def _tokens_cutter(x: dict[str, np.ndarray]) -> Cut:
    return _cutter(x, bits=_words_of(x["size"]))


def _tokens_at(x: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return _tokens_cutter(x)(x, at)


def _line_hashes(x: dict[str, np.ndarray]) -> np.ndarray:
    return blocks.mix(x["did"].view(_U) + blocks.mix(x["tie"].view(_U) + x["ln"].astype(_U), 3), 5)


def _slot() -> Column:
    """A hash of a line's REF."""
    return F.xxhash64("did", "tie").bitwiseXOR(F.col("ln").cast("long") * _STRIDE)


def _token_blocks(distinct: DataFrame, hot, buckets: int, part: tuple[int, int] = (0, 1), only: tuple | None = None) -> DataFrame:
    """Blocks of the prefix tokens of every distinct line; with ``part`` (k, n), of the k-th of n parts of them.

    A hot token has a grid of sides ** 2 / 2 cells: a line goes to those of its side. ``only`` holds bitmaps of the lines whose
    candidates are searched, by _line_hashes, and of their keys; other keys are left out.
    """
    taken, parts = part

    def tokens(batch: pa.RecordBatch) -> tuple[dict[str, np.ndarray], np.ndarray]:
        y = _unpacked(batch.column(0))
        key, many, words, whose = y["keys"], _prefix_length(y["size"]), _words_of(y["size"]), _line_hashes(y)
        row, pos = np.repeat(np.arange(len(many)), many), blocks.ranges(np.zeros(len(many), np.int64), many)
        searched = np.ones(len(many), np.uint8)
        if only:
            searched = _in_bitmap(only[0].value, whose.view(np.int64)).astype(np.uint8)
            hit = _in_bitmap(only[1].value, _key_slots(key))
            key, row, pos = key[hit], row[hit], pos[hit]
        if parts > 1:
            # other parts' keys go first; those of a grid have cells in all parts
            hit = key % parts == taken
            if len(hot.value[0]):
                hit |= np.isin(key, hot.value[0])
            key, row, pos = key[hit], row[hit], pos[hit]
        again, cell, side = blocks.cells(key.astype(np.int64), whose[row], *hot.value)
        key, row, pos = key[again], row[again], pos[again]
        bucket = (blocks.mix((key.astype(_U) << _U(32)) ^ cell.view(_U), 9) % _U(buckets)).astype(np.int64)
        mine = np.flatnonzero((key + (cell >> 32) + (cell & 0xFFFFFFFF)) % parts == taken)
        row = row[mine]
        x = {"key": key[mine], "cell": cell[mine], "open": searched[row]} | {c: y[c][row] for c in ("known", "did", "tie", "ln", "size")}
        x |= {"pos": pos[mine].astype(np.int32), "side": side[mine], "bits": y["bits"][blocks.ranges((np.cumsum(words) - words)[row], words[row])]}
        return x, bucket[mine]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            x = blocks.joined([h[0] for h in held])
            for b, block in blocks.dealt(x, np.concatenate([h[1] for h in held]), _tokens_cutter(x)):
                yield blocks.row(b, 0, block)

        for batch in batches:
            held.append(tokens(batch))
            n += len(held[-1][1])
            if n >= blocks.HELD:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return distinct.select("block").mapInArrow(deal, blocks.SCHEMA)


def _shared(x: dict[str, np.ndarray]) -> np.ndarray:
    """Places of the rows whose key another row has, too, in order of key, cell and line; most keys are of one row."""
    at = np.argsort(x["key"])
    same = x["key"][at[1:]] == x["key"][at[:-1]]
    at = at[np.append(same, False) | np.insert(same, 0, False)] if len(at) else at
    names = ("key", "cell", "known", "did", "tie", "ln")
    return at[blocks.order({c: x[c][at] for c in names}, names)]


def _spans(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and, for each, spans (first, length) of places of earlier rows of its key and cell that it may match; what row is at a place.

    Lines that match differ by a class of sizes at most, and a token at ``pos`` of a line of ``a`` tokens is shared with matching
    lines of at most (5 a - 9 pos) / 4 tokens (its reach). Rows stand by class and reach, and by line within those.
    """
    n = len(x["key"])
    new = np.ones(n, bool)
    new[1:] = (x["key"][1:] != x["key"][:-1]) | (x["cell"][1:] != x["cell"][:-1])
    size = x["size"].astype(np.int64)
    of = np.searchsorted(_CLASSES, size, "right")
    # classes beyond its own: -1, 0 or 1
    reach = np.clip(np.searchsorted(_CLASSES, (5 * size - 9 * x["pos"]) // 4, "right") - of, -1, 1)
    wide = 3 * (len(_CLASSES) + 2)
    begin = np.cumsum(new) * wide
    group = begin + 3 * of + reach + 1
    at = np.argsort(group, kind="stable")
    place = group[at] * n + at
    later, first, length = [], [], []
    for step, reaches in ((0, (0, 1)), (-1, (1,)), (1, (-1, 0, 1))):
        j = np.flatnonzero(x["open"].astype(bool) & (reach >= step))
        for r in reaches:
            k = (begin[j] + 3 * (of[j] + step) + r + 1) * n
            lo = np.searchsorted(place, k)
            later.append(j)
            first.append(lo)
            length.append(np.searchsorted(place, k + j) - lo)
    later, first, length = (np.concatenate(c) for c in (later, first, length))
    some = np.flatnonzero(length)
    some = some[np.argsort(later[some], kind="stable")]
    return later[some], first[some], length[some], at


def _pairs(x: dict[str, np.ndarray], named: np.ndarray, most_named: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of later and earlier rows that pass the filters, of rows in order of key, cell and line.

    Later rows are open ones. ``named`` counts a row's candidates; with ``most_named``, a row that has more is not searched on, and
    at most so many of its pairs are returned.
    """
    n = len(x["key"])
    later, first, length, row_at = _spans(x)
    size, cell, side = x["size"].astype(np.int64), x["cell"], x["side"]
    rest = size - x["pos"]
    grids = cell.any()
    inner = cell >> 32 == cell & 0xFFFFFFFF
    words = _words_of(size)
    wide = np.zeros((n, BITMAP), _U)
    wide[np.arange(BITMAP) < words[:, None]] = x["bits"]
    # a bitmap of fewer words is the longer one, folded
    two = np.stack([wide[:, 0] ^ wide[:, 2], wide[:, 1] ^ wide[:, 3]], axis=1)
    one = two[:, 0] ^ two[:, 1]
    step = 1
    while True:
        if most_named is not None:
            left = np.flatnonzero(named[later] <= most_named)
            later, first, length = later[left], first[left], length[left]
        if not len(later):
            break
        # some rows of each span, the earliest first
        step = max(1, min(2 * step, ROUND_PAIRS // len(later)))
        taken = np.minimum(length, step)
        i, j = row_at[blocks.ranges(first, taken)], np.repeat(later, taken)
        left = np.flatnonzero(length > step)
        later, first, length = later[left], first[left] + step, length[left] - step
        a, b = size[i], size[j]
        need = (4 * (a + b) + 8) // 9
        ok = (5 * np.minimum(a, b) >= 4 * np.maximum(a, b)) & (np.minimum(rest[i], rest[j]) >= need)
        if grids:
            # lines of one side meet only in the cell of their own
            ok &= inner[i] | (side[i] != side[j])
        i, j, most = i[ok], j[ok], (a + b - 2 * need)[ok]
        ok = np.bitwise_count(one[i] ^ one[j]) <= most
        i, j, most = i[ok], j[ok], most[ok]
        fewer = np.minimum(words[i], words[j])
        ok = (fewer < 2) | (np.bitwise_count(two[i] ^ two[j]).sum(axis=1, dtype=np.int64) <= most)
        ok &= (fewer < BITMAP) | (np.bitwise_count(wide[i] ^ wide[j]).sum(axis=1, dtype=np.int64) <= most)
        # tokens of one line may share a key
        ok &= (x["ln"][i] != x["ln"][j]) | (x["did"][i] != x["did"][j]) | (x["tie"][i] != x["tie"][j]) | (x["known"][i] != x["known"][j])
        i, j = i[ok], j[ok]
        if not len(j):
            continue
        # a row's pairs of this round stand together
        edges = np.flatnonzero(np.diff(j, prepend=-1))
        times = np.diff(np.append(edges, len(j)))
        which = named[j] + blocks.ranges(np.ones(len(edges), np.int64), times)
        named[j[edges]] += times
        if most_named is not None:
            i, j = i[which <= most_named], j[which <= most_named]
        yield j, i


ENDS = [*REF, *[f"{c}0" for c in REF]]


def _candidates(tokens: DataFrame, most_named: int | None) -> DataFrame:
    """ENDS and more: candidates that an open line names, and whether it has more than ``most_named`` of them under some token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in blocks.by_bucket(batches):
            x = blocks.joined([blocks.unpack(block, _TOKENS) for _, block in some])
            x = _tokens_at(x, _shared(x))
            named = np.zeros(len(x["key"]), np.int64)
            found = _pairs(x, named, most_named)
            if most_named is not None:
                few = list(found)
                found = [(np.concatenate([f[0] for f in few]), np.concatenate([f[1] for f in few]))] if few else []
            for later, earlier in found:
                for k in range(0, len(later), OUT_ROWS):
                    ends = [at[k : k + OUT_ROWS] for at in (later, earlier)]
                    columns = [c for at in ends for c in (pa.array(x["did"][at], mask=x["known"][at] == 0), pa.array(x["tie"][at]), pa.array(x["ln"][at]))]
                    more = named[ends[0]] > (most_named or 0)
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(more)], [*ENDS, "more"])

    return blocks.shuffled(tokens).mapInArrow(run, "did bigint, tie bigint, ln int, did0 bigint, tie0 bigint, ln0 int, more boolean")


def _filter_bits(n: int) -> int:
    return min(FILTER_BITS, max(16, (16 * n).bit_length()))


def _bitmap(rows: DataFrame, slot: Column, bits: int):
    """A broadcast bitmap of the slots that occur; at most 2 ** (bits - 6) rows come to the driver."""
    words = rows.select(slot.bitwiseAND((1 << bits) - 1).alias("slot")).selectExpr("shiftright(slot, 6) AS w", "shiftleft(1L, CAST(slot & 63 AS int)) AS b")
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[table["w"].to_numpy()] = table["b"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(out)


def _in_bitmap(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    at = slots & (64 * len(bitmap) - 1)
    return ((bitmap[at >> 6] >> (at & 63)) & 1).astype(bool)


def _verified(pairs: DataFrame, texts: DataFrame, classes) -> DataFrame:
    """The later lines of the pairs ENDS whose token sets have a Jaccard similarity of 0.8 or more."""
    ends = pairs.select(*REF).unionByName(pairs.select(*[F.col(f"{c}0").alias(c) for c in REF])).distinct()
    bits = _filter_bits(2 * pairs.count())
    hashed = F.xxhash64("did", "tie")
    # a line's slot: its document's hash and its number
    docs_in = _bitmap(ends, hashed, bits)
    lines_in = _bitmap(ends, _slot(), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(3).to_numpy()
            hit = np.flatnonzero(_in_bitmap(docs_in.value, h))
            batch, h = batch.take(pa.array(hit)), h[hit]
            body = batch.column(2).to_pylist()
            for a, b in rounds(body, ROUND):
                x = Lines(body[a:b], classes.value)
                hit = np.flatnonzero(_in_bitmap(lines_in.value, h[x.text + a] ^ (x.number * _STRIDE)))
                if len(hit):
                    which = pa.array(x.text[hit] + a)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(which), batch.column(1).take(which), pa.array(x.number[hit], pa.int32()), x.tokens().take(pa.array(hit))],
                        [*REF, "tokens"],
                    )

    sets = texts.select("did", "tie", "text", hashed.alias("h")).mapInArrow(run, "did bigint, tie bigint, ln int, tokens array<bigint>")
    # written without the repeats of repeated documents: the joins below have plain inputs, which can be split where they are skewed
    named = written(sets.select(F.struct(*REF).alias("r"), "tokens").groupBy("r").agg(F.max("tokens").alias("tokens")), "sets")
    joined = (
        pairs.select(F.struct(*REF).alias("later"), F.struct(*[F.col(f"{c}0").alias(c) for c in REF]).alias("earlier"))
        .join(named.select(F.col("r").alias("later"), F.col("tokens").alias("x")), "later")
        .join(named.select(F.col("r").alias("earlier"), F.col("tokens").alias("y")), "earlier")
    )
    near = joined.where(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("later.*")
    near = written(near.distinct(), "near")
    drop_written(named)
    return near


def _key_slots(key: np.ndarray) -> np.ndarray:
    return blocks.mix(key.astype(_U), 13).view(np.int64)


def _all_candidates(open_: DataFrame, distinct: DataFrame, hot, buckets: int) -> DataFrame:
    """ENDS of every candidate of the lines ``open_`` (REF); other lines of their bitmap's slots add a few, which are verified, too."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {c: batch.column(i).fill_null(0).to_numpy() for i, c in enumerate(REF)}
            yield pa.RecordBatch.from_arrays([pa.array(_line_hashes(x).view(np.int64))], ["slot"])

    lines_in = _bitmap(open_.select(*REF).mapInArrow(slots, "slot bigint"), F.col("slot"), _filter_bits(open_.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column(0))
            hit = _in_bitmap(lines_in.value, _line_hashes(x).view(np.int64))
            keys = np.unique(x["keys"][np.repeat(hit, _prefix_length(x["size"]))])
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(_key_slots(keys))], ["slot"])

    keys = written(distinct.select("block").mapInArrow(run, "slot bigint").distinct(), "keys")
    keys_in = _bitmap(keys, F.col("slot"), _filter_bits(keys.count()))
    pairs = _candidates(_token_blocks(distinct, hot, buckets, only=(lines_in, keys_in)), None)
    pairs = written(pairs.select(*ENDS).distinct(), "pairs")
    drop_written(keys)
    return pairs


def _removed(texts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(did, tie, ln) of lines to remove from texts of columns did, tie and text, counted from 0; the written tables it reads."""
    spark = texts.sparkSession
    bounded_batches(spark)
    classes, n_lines = rarity(texts)
    classes = spark.sparkContext.broadcast(classes)
    lines = written(_line_table(texts, classes, n_lines), "lines")
    release(spark)
    distinct, equal = lines.where("block IS NOT NULL").select("n_keys", "block"), lines.where("block IS NULL").select(*REF)
    total = distinct.agg(F.sum("n_keys")).first()[0] or 0
    hot = blocks.hot(distinct.select("block"), lambda batch: _unpacked(batch.column(0))["keys"].astype(np.int64), total, CELL)
    hot = spark.sparkContext.broadcast(hot)
    buckets = max(1, total // (PASSES * BUCKET_TOKENS))
    parts = []
    for i in range(PASSES):
        parts.append(written(_candidates(_token_blocks(distinct, hot, buckets, (i, PASSES)), NAMED).groupBy(*ENDS).agg(F.max("more").alias("more")), "part"))
        release(spark)
    named = parts[0]
    if len(parts) > 1:
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        named = written(every.groupBy(*ENDS).agg(F.max("more").alias("more")), "pairs")
        for part in parts:
            drop_written(part)
    near = [_verified(named, texts, classes)]
    # lines that have more candidates than they named, and match none of those: all of theirs
    # (by one struct, which a null id does not keep from matching)
    found = near[0].select(F.struct(*REF).alias("r"))
    open_ = written(named.where("more").select(F.struct(*REF).alias("r")).distinct().join(found, "r", "left_anti").select("r.*"), "open")
    drop_written(named)
    if not open_.isEmpty():
        pairs = _all_candidates(open_, distinct, hot, buckets)
        near.append(_verified(pairs, texts, classes))
        drop_written(pairs)
    drop_written(open_)
    gone = equal
    for part in near:
        gone = gone.unionByName(part)
    return gone, [lines, *near]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """docs with its columns, the text without the lines that go; with ``counts``, columns of these names: lines, and removed ones."""
    text, names = F.col(f"`{text_col}`"), docs.columns
    if counts and {c.lower() for c in counts} & {c.lower() for c in names}:
        raise ValueError(f"columns {counts} are already there")
    did, tie, key, gone_col, pieces, left = fresh(names, "did", "tie", "key", "gone", "pieces", "left")
    rows = keyed(docs, id_col, text_col, did, tie)
    gone, used = _removed(rows.where(text.isNotNull()).select(F.col(did).alias("did"), F.col(tie).alias("tie"), text.alias("text")))
    gone = gone.groupBy("did", "tie").agg(F.collect_set("ln").alias(gone_col))
    gone = written(gone.select(F.struct("did", "tie").alias(key), gone_col), "gone")
    for table in used:
        drop_written(table)
    release(docs.sparkSession)
    rows = rows.withColumn(key, F.struct(F.col(did).alias("did"), F.col(tie).alias("tie")))
    # sorted on both sides at any size: what goes grows with the corpus
    joined = rows.join(gone.hint("merge"), key, "left").withColumn(pieces, F.split(text, "\n"))
    # places that stay, in order, in a projection of their own; then the pieces there
    places = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), gone_col)
    joined = joined.withColumn(left, F.when(F.col(gone_col).isNotNull(), F.transform(places, lambda i: F.get(F.col(pieces), i))))
    out = [F.coalesce(F.array_join(left, "\n"), text).alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if counts:
        out.append(F.when(text.isNull(), F.lit(0)).otherwise(F.size(pieces)).cast("long").alias(counts[0]))
        out.append(F.coalesce(F.size(gone_col), F.lit(0)).cast("long").alias(counts[1]))
    return joined.select(*out)
