"""Operator 7: token counts without token ids.

1. Texts are cut into pre-tokens. A task deals its distinct pre-tokens out by a hash, each with its frequency in each of the
   task's documents: those are the two sides of the join, combined per task before the shuffle.
2. Where all of a pre-token meets, its pieces are counted once and joined to the frequencies; products are summed by document.
   A pre-token of many of a task's documents is dealt by task as well, so that no bucket holds all of a frequent one.
3. The sums of a document are added up. No ids are kept anywhere.

Strings of added tokens inside a text count as one token each, as the library treats them by default. Texts with characters that
the library classes otherwise than the ``regex`` package (newer Unicode) are cut by the library. A tokenizer of another kind than
byte-level gets whole texts as pre-tokens.

Defined cases: a null text is an empty text with zero tokens; repeated rows give repeated results; other columns of the input
are ignored; an empty table gives an empty table. A text of any length is counted whole, by one task.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks
from .common import MEMO_ENTRIES, bounded_batches, file_bytes, fresh, keyed

#: Below this code point the character classes of both libraries agree.
AGREED = 0x557
#: Pieces that are encoded by one call.
CALL = 4096
#: What a task holds before it writes blocks: documents (numbered by 16 bits), tokens, and distinct pre-tokens.
HELD_DOCS, HELD_TOKENS, HELD_WORDS = 1 << 16, 1 << 22, 250_000
#: Bytes of texts per bucket of pre-tokens, and buckets at most; a pre-token of a greater share of a task's documents is frequent.
BUCKET_BYTES, MOST_BUCKETS, FREQUENT = 16 << 20, 1 << 14, 1 / 64


class PieceCounter:
    """Counts tokens of whole texts by a byte-level tokenizer file; ``pattern`` is its pre-token pattern."""

    def __init__(self, data: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(data)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        #: Other tokenizers are asked for whole texts.
        self.split = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self.library = Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.names = names
        self.find = regex.compile(pattern).findall
        self.unusual = regex.compile(f"[^\\x00-\\U{AGREED:08x}]").findall
        self.agrees: dict[str, bool] = {}

    def _agree(self, char: str) -> bool:
        """Whether both libraries cut around this character alike."""
        known = self.agrees.get(char)
        if known is None:
            probe = f"a{char}1{char}!{char} {char}{char}"
            cuts = [probe[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            known = self.agrees[char] = cuts == self.find(probe)
        return known

    def _library_cut(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and the number of its added tokens."""
        if not self.split:
            return [text] if text else [], 0
        find = self.find if all(map(self._agree, set(self.unusual(text)))) else self._library_cut
        if not any(n in text for n in self.names):
            return find(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(find, parts))), len(parts) - 1

    def pieces(self, words: list[str]) -> list[int]:
        """How many tokens each pre-token has."""
        out: list[int] = []
        for i in range(0, len(words), CALL):
            out += map(len, self.library.encode_batch_fast(words[i : i + CALL], add_special_tokens=False))
        return out


class _Numbers(dict):
    """Numbers of words in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


#: Of a bucket of pre-tokens: their texts, how many documents each has, those and how often; the documents that occur.
_WORDS = {"size": np.uint32, "text": np.uint8, "many": np.uint32, "doc": np.uint16, "times": np.uint16, "known": np.uint8, "did": np.int64, "tie": np.int64}
#: Of documents: tokens, bytes and rows so far.
_SUMS = {"known": np.uint8, "did": np.int64, "tie": np.int64, "tokens": np.int64, "bytes": np.int64, "rows": np.int64}


def _summed(x: blocks.Columns) -> blocks.Columns:
    """One row per document."""
    at = blocks.order(x, ("known", "did", "tie"))
    x = {c: v[at] for c, v in x.items()}
    new = np.ones(len(at), bool)
    new[1:] = (x["did"][1:] != x["did"][:-1]) | (x["tie"][1:] != x["tie"][:-1]) | (x["known"][1:] != x["known"][:-1])
    first = np.flatnonzero(new)
    return {c: np.add.reduceat(v, first) if c in ("tokens", "bytes", "rows") else v[first] for c, v in x.items()}


_kept: dict[tuple[str, str], PieceCounter] = {}


def _maker(df: DataFrame, tokenizer_path: str, pattern: str):
    data = file_bytes(tokenizer_path)
    shared, key = df.sparkSession.sparkContext.broadcast(data), (hashlib.sha256(data).hexdigest(), pattern)

    def counter() -> PieceCounter:
        if key not in _kept:
            _kept.clear()
            _kept[key] = PieceCounter(shared.value, pattern)
        return _kept[key]

    return counter


def _dealt_words(texts: DataFrame, make, buckets: int) -> DataFrame:
    """Blocks of pre-tokens with their documents (kind 0), and of documents (kind 1), from columns did, tie and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counter, salt = make(), TaskContext.get().partitionId() << 20
        numbers, found, docs, n_tokens = _Numbers(), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            doc = {c: np.array([d[i] for d in docs], kind) for i, (c, kind) in enumerate(_SUMS.items())}
            for b, block in blocks.dealt(doc, (blocks.mix(doc["did"].view(np.uint64), 3) % np.uint64(buckets)).astype(np.int64), lambda y, at: {c: y[c][at] for c in _SUMS}):
                yield blocks.row(b, 1, block)
            sizes = np.array([len(f) for f in found])
            pairs, times = np.unique((np.concatenate(found).astype(np.int64) << 16) | np.repeat(np.arange(len(found)), sizes), return_counts=True)
            if not len(pairs):
                return
            most = np.iinfo(np.uint16).max
            if times.max() > most:  # as several pairs
                again = -(-times // most)
                last = times - (again - 1) * most
                pairs, times = np.repeat(pairs, again), np.full(again.sum(), most)
                times[np.cumsum(again) - 1] = last
            many = np.bincount(pairs >> 16, minlength=len(numbers))
            body = [w.encode() for w in numbers]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, body), np.uint64, len(body))
            hashes ^= np.where(many > max(64, FREQUENT * len(docs)), blocks.mix(np.array([salt], np.uint64)), np.uint64(0))
            x = {"size": np.array([len(w) for w in body], np.uint32), "text": np.frombuffer(b"".join(body), np.uint8), "many": many.astype(np.uint32),
                 "doc": (pairs & 0xFFFF).astype(np.uint16), "times": times.astype(np.uint16)}
            starts = {"text": np.cumsum(x["size"], dtype=np.int64) - x["size"], "pair": np.cumsum(many) - many}

            def cut(y: blocks.Columns, at: np.ndarray) -> blocks.Columns:
                chars = blocks.ranges(starts["text"][at], y["size"][at].astype(np.int64))
                pair = blocks.ranges(starts["pair"][at], many[at])
                used, number = np.unique(y["doc"][pair], return_inverse=True)
                return {"size": y["size"][at], "text": y["text"][chars], "many": y["many"][at], "doc": number.astype(np.uint16), "times": y["times"][pair]} | {
                    c: doc[c][used] for c in ("known", "did", "tie")
                }

            for b, block in blocks.dealt(x, (blocks.mix(hashes, 11) % np.uint64(buckets)).astype(np.int64), cut):
                yield blocks.row(b, 0, block)

        for batch in batches:
            known = batch.column(0).is_valid().to_pylist()
            for ok, did, tie, text in zip(known, batch.column(0).fill_null(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words, added = counter.cut(text)
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                docs.append((ok, did, tie, added, len(text.encode()), 1))
                n_tokens += len(words)
                if len(docs) == HELD_DOCS or n_tokens >= HELD_TOKENS or len(numbers) >= HELD_WORDS:
                    yield from flush()
                    numbers, found, docs, n_tokens, salt = _Numbers(), [], [], 0, salt + 1
        if docs:
            yield from flush()

    return texts.mapInArrow(run, blocks.SCHEMA)


def _document_sums(words: DataFrame, make, buckets: int) -> DataFrame:
    """Blocks of documents' sums over a bucket of pre-tokens: the join of pieces and frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held, n = make(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            x = _summed(blocks.joined(held))
            bucket = (blocks.mix(x["did"].view(np.uint64) + blocks.mix(x["tie"].view(np.uint64)), 5) % np.uint64(buckets)).astype(np.int64)
            for b, block in blocks.dealt(x, bucket, lambda y, at: {c: y[c][at] for c in _SUMS}):
                yield blocks.row(b, 0, block)

        for _, some in blocks.by_bucket(batches):
            pieces: dict[bytes, int] = {}
            for kind, block in some:
                if kind:
                    held.append(blocks.unpack(block, _SUMS))
                else:
                    x = blocks.unpack(block, _WORDS)
                    text, ends = x["text"].tobytes(), np.cumsum(x["size"], dtype=np.int64).tolist()
                    body = [text[a:b] for a, b in zip([0, *ends], ends)]
                    if len(pieces) > MEMO_ENTRIES:
                        pieces.clear()
                    new = [w for w in body if w not in pieces]
                    pieces.update(zip(new, counter.pieces([w.decode() for w in new])))
                    each = np.fromiter(map(pieces.__getitem__, body), np.int64, len(body))
                    tokens = np.zeros(len(x["did"]), np.int64)
                    np.add.at(tokens, x["doc"], np.repeat(each, x["many"]) * x["times"])
                    none = np.zeros(len(tokens), np.int64)
                    held.append({"known": x["known"], "did": x["did"], "tie": x["tie"], "tokens": tokens, "bytes": none, "rows": none})
                n += len(held[-1]["did"])
                if n >= blocks.HELD:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    return blocks.shuffled(words).mapInArrow(run, blocks.SCHEMA)


def _totals(sums: DataFrame) -> DataFrame:
    """(did, tie, tokens, bytes, rows) of every document, summed block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in blocks.by_bucket(batches):
            held, n = [], 0
            for _, block in some:
                held.append(blocks.unpack(block, _SUMS))
                n += len(held[-1]["did"])
                if n >= blocks.HELD and len(held) > 1:
                    held = [_summed(blocks.joined(held))]
                    n = 0
            x = _summed(blocks.joined(held))
            for i in range(0, len(x["did"]), 20_000):
                part = {c: v[i : i + 20_000] for c, v in x.items()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["did"], mask=part["known"] == 0), *(pa.array(part[c]) for c in ("tie", "tokens", "bytes", "rows"))],
                    ["did", "tie", "tokens", "bytes", "rows"],
                )

    return blocks.shuffled(sums).mapInArrow(run, "did bigint, tie bigint, tokens bigint, bytes bigint, rows bigint")


def count_tokens(
    df: DataFrame, tokenizer_path: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text."""
    bounded_batches(df.sparkSession)
    make = _maker(df, tokenizer_path, pattern)
    did, tie = fresh([id_col, text_col], "did", "tie")
    rows = keyed(df.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(text_col)), id_col, text_col, did, tie)
    total = df.agg(F.sum(F.octet_length(f"`{text_col}`"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, total // BUCKET_BYTES))
    texts = rows.select(F.col(did).alias("did"), F.col(tie).alias("tie"), F.col(f"`{text_col}`").alias("text"))
    totals = _totals(_document_sums(_dealt_words(texts, make, buckets), make, buckets))
    kind = df.schema[id_col].dataType
    if isinstance(kind, T.IntegralType):
        out = totals.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).withColumn("id", F.col("did").cast(kind))
    else:
        ids = rows.select(F.col(f"`{id_col}`").alias("id"), F.struct(F.col(did).alias("did"), F.col(tie).alias("tie")).alias("key"))
        out = ids.join(totals.withColumn("key", F.struct("did", "tie")), "key")
    tokens = F.expr("tokens div rows")
    return out.select(F.col("id").alias(id_col), F.expr("bytes div rows").alias("n_bytes"), tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))
