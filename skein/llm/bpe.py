"""Operator 1: byte-level BPE encoding and decoding over length-bucketed padded numpy matrices.

Every pre-token is a row of byte ids in a matrix of its length class. In each round, every row merges its leftmost pair of
minimum rank; pair ranks come from a hashed table, and finished rows are compacted away. Distinct pre-tokens are encoded once
per worker (a bounded memo holds them). A row of over LONG bytes is linked instead of compacted, and a round merges all places of
its minimum rank, from left to right; where a merge makes a pair of a lower rank, only the leftmost.

Character classes of the pattern are those of the ``regex`` library's Unicode version.

Defined cases: a null text is an empty text; an empty text has no ids; repeated rows give repeated results; other columns of
the input are ignored; an empty table gives an empty table. A text of any length is encoded whole, by one task.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import MEMO_ENTRIES, file_bytes, map_texts

#: Cells of one matrix at most (one row may be longer).
CELLS = 1 << 18
NO_PAIR = np.int32(2**31 - 1)
#: Bytes of a pre-token from which on it is encoded by links.
LONG = 2048


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks from lines of base64 bytes and a decimal rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class PairTable:
    """Ranks of mergeable id pairs, in an open-addressing hash table that is looked up by whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        values = np.array(merged, np.int32)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_PAIR, np.int32)
        self.probes, waiting, at = 0, np.arange(len(keys)), self._home(keys)
        while len(waiting):
            self.probes += 1
            free = self.keys[at] == -1
            slots, first = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[slots], self.values[slots] = keys[waiting[chosen]], values[waiting[chosen]]
            left_over = np.ones(len(waiting), bool)
            left_over[chosen] = False
            waiting, at = waiting[left_over], (at[left_over] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NO_PAIR; a negative id stands for padding."""
        keys = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        keys = np.where((left < 0) | (right < 0), np.int64(-2), keys)
        at, out, open_ = self._home(keys), np.full(keys.shape, NO_PAIR, np.int32), keys >= 0
        for _ in range(self.probes):
            held = self.keys[at]
            hit = open_ & (held == keys)
            out = np.where(hit, self.values[at], out)
            open_ &= ~hit & (held != -1)
            if not open_.any():
                break
            at = (at + 1) & self.mask
        return out


class ByteBPE:
    """Encodes and decodes texts by a rank file; each match of ``pattern`` is encoded separately."""

    def __init__(self, data: bytes, pattern: str):
        ranks = load_ranks(data)
        self.ids = dict(ranks)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = PairTable(ranks)
        self.find = regex.compile(pattern).findall
        self.decimal = [str(i) for i in range(len(self.bytes))]
        self.memo: dict[str, tuple[int, ...]] = {}

    def _merge(self, rows: np.ndarray) -> list[tuple[int, ...]]:
        """Rows of ids, padded with -1, merged until no pair has a rank."""
        out: list[tuple[int, ...]] = [()] * len(rows)
        where = np.arange(len(rows))
        rank = self.pairs.rank(rows[:, :-1], rows[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), int)
            every = np.arange(len(rows))
            best = rank[every, at] if rank.shape[1] else np.full(len(rows), NO_PAIR)
            done = best == NO_PAIR
            if done.any():
                ended = rows[done]
                for i, row, n in zip(where[done].tolist(), ended.tolist(), (ended >= 0).sum(axis=1).tolist()):
                    out[i] = tuple(row[:n])
                go = ~done
                rows, rank, where, at, best, every = rows[go], rank[go], where[go], at[go], best[go], np.arange(int(go.sum()))
                if not len(rows):
                    break
            # compaction: what follows the merged pair moves one cell to the left
            cells = np.arange(rows.shape[1] - 1)
            rows[every, at] = best
            rows = np.take_along_axis(rows, cells + (cells > at[:, None]), axis=1)
            cells = np.arange(rank.shape[1] - 1)
            rank = np.take_along_axis(rank, cells + (cells >= at[:, None]), axis=1)
            if rank.shape[1]:
                last = rank.shape[1] - 1
                right = np.minimum(at, last)
                rank[every, right] = self.pairs.rank(rows[every, right], rows[every, right + 1])
                left = np.maximum(at - 1, 0)
                rank[every, left] = self.pairs.rank(rows[every, left], rows[every, left + 1])
        return out

    def _merge_long(self, ids: np.ndarray) -> tuple[int, ...]:
        """One row, in time that follows its merges: places wait by rank, and links lead over merged ones."""
        n = len(ids)
        ids = np.append(ids, np.int32(-1))
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        rank = np.append(self.pairs.rank(ids[:-1], ids[1:]), NO_PAIR)
        waiting: dict[int, list[np.ndarray]] = {}

        def wait(places: np.ndarray) -> list[int]:
            """Ranks that had no place before."""
            places = places[rank[places] != NO_PAIR]
            places = places[np.argsort(rank[places], kind="stable")]
            edges = np.flatnonzero(np.diff(rank[places], prepend=-1))
            new = []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(places)]):
                r = int(rank[places[a]])
                if r not in waiting:
                    waiting[r] = []
                    new.append(r)
                waiting[r].append(places[a:b])
            return new

        heap = wait(np.arange(n))
        heapify(heap)
        while heap:
            r = heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # of places that overlap, every other one
            run = np.append(True, after[at[:-1]] != at[1:])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            for chosen in (at, at[:1]):
                right = after[chosen]
                follow, lead = after[right], before[chosen]
                # ids as they are after this round
                was = ids[chosen]
                ids[chosen] = r
                merged_right = np.where(np.isin(follow, chosen), np.int32(r), ids[np.minimum(follow, n)])
                low = self.pairs.rank(np.full(len(chosen), r, np.int32), merged_right)
                left_of = np.where(lead >= 0, lead, n)
                # what stands before may be the merged pair of this round
                ends = np.isin(left_of, right)
                left_ids = np.where(ends, np.int32(r), ids[left_of])
                lower = self.pairs.rank(left_ids, np.full(len(chosen), r, np.int32))
                if len(chosen) == 1 or min(low.min(), lower.min()) > r:
                    break
                ids[chosen] = was
            after[chosen] = follow
            before[np.minimum(follow, n)] = np.where(follow <= n, chosen, before[n])
            rank[right] = NO_PAIR
            ids[right] = -1
            lead = before[chosen]
            touched = np.unique(np.concatenate([chosen, lead[lead >= 0]]))
            rank[touched] = self.pairs.rank(ids[touched], ids[np.minimum(after[touched], n)])
            if len(chosen) < len(at):
                touched = np.concatenate([touched, at[1:]])
            for new in wait(touched):
                heappush(heap, new)
        return tuple(ids[ids >= 0].tolist())

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each piece: length classes of powers of two, in matrices of a bounded size."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > LONG:
                out[i] = self._merge_long(self.byte_ids[np.frombuffer(piece, np.uint8)])
            elif piece:
                classes.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for width, members in sorted(classes.items()):
            step = max(1, CELLS >> width)
            for start in range(0, len(members), step):
                block = members[start : start + step]
                lengths = np.array([len(pieces[i]) for i in block])
                rows = np.full((len(block), int(lengths.max())), -1, np.int32)
                flat = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in block), np.uint8)]
                rows[np.arange(rows.shape[1]) < lengths[:, None]] = flat
                for i, ids in zip(block, self._merge(rows)):
                    out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = [self.find(t) for t in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        new = list(set().union(*found).difference(self.memo)) if found else []
        self.memo.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        return [list(chain.from_iterable(map(self.memo.__getitem__, pieces))) for pieces in found]

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        return [b"".join(map(self.bytes.__getitem__, row)) for row in ids]

    def joined(self, ids: list[int]) -> str:
        """Decimal ids, joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))


#: The codec of this worker, kept between tasks with its memo.
_kept: dict[tuple[str, str], ByteBPE] = {}


def _maker(df: DataFrame, ranks_path: str, pattern: str):
    data = file_bytes(ranks_path)
    shared, key = df.sparkSession.sparkContext.broadcast(data), (hashlib.sha256(data).hexdigest(), pattern)

    def codec() -> ByteBPE:
        if key not in _kept:
            _kept.clear()
            _kept[key] = ByteBPE(shared.value, pattern)
        return _kept[key]

    return codec


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and ``ids`` array<int> of every whole text."""
    codec = _maker(df, ranks_path, pattern)

    def make():
        bpe = codec()
        return lambda texts: {"ids": pa.array(bpe.encode(texts), pa.list_(pa.int32()))}

    return map_texts(df, [id_col], text_col, "ids array<int>", make)


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and ``decoded`` binary of every row of ids (null: empty)."""
    codec = _maker(df, ranks_path, pattern)

    def make():
        bpe = codec()
        return lambda rows: {"decoded": pa.array(bpe.decode([[] if r == "" else r for r in rows]), pa.binary())}

    return map_texts(df, [id_col], ids_col, "decoded binary", make)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text in one pass: n_tokens, and digests of the ids and of the decoded bytes."""
    codec = _maker(df, ranks_path, pattern)

    def make():
        bpe = codec()

        def of(texts: list[str]) -> dict[str, pa.Array]:
            ids = bpe.encode(texts)
            return {
                "n_tokens": pa.array(map(len, ids), pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(bpe.joined(row).encode()).hexdigest() for row in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(data).hexdigest() for data in bpe.decode(ids)]),
            }

        return of

    return map_texts(df, [id_col], text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
