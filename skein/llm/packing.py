"""Operator 5: packing by power-of-two decomposition.

A document's ids (with a closing id) are cut into pieces of binary lengths: as many of the context length as fit, then the
powers of two of the rest, longest first. Pieces of one length are a bucket, so that none crosses documents or is padded. A bucket is
dealt by hash into parts of about PART_BYTES, as many as its counted pieces need; a part is sorted by document and start, and its
sequences stand together. sequence_id is a piece's place by length, part, document and start, from 0 on, whatever the partitions of
the input.

Defined cases: a null text is an empty text, whose only id is the closing one; repeated rows are separate documents, whose ids of
sequences follow each other; null ids come first in a part, ids that are no whole numbers are ordered by a hash; other columns of the input
are ignored; an empty table gives an empty table. A text of any length is packed whole, by one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, file_bytes, fresh, keyed, rounds, written

CALL = 4096
#: A worker remembers the ids of this many stretches and of this many words, about 200 bytes each.
MEMO_ENTRIES, LONGEST = 600_000, 64
#: Words of Latin letters with ASCII punctuation behind them; no special string and no contraction matches.
LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch
#: Byte-level tokenizers write bytes as characters: printable ones as themselves, the rest from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)).difference(_PRINTED)))}
#: Pieces of one Arrow batch that a worker returns.
OUT_ROWS = 20_000
#: Bytes of one part of a bucket, and of a piece besides its ids.
PART_BYTES, ROW_BYTES = 8 << 20, 64


class _Memo(dict):
    """What ``make`` returned for a key of up to LONGEST characters; emptied when it holds MEMO_ENTRIES."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        if len(key) > LONGEST:
            return self.make(key)
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        made = self[key] = self.make(key)
        return made


class WordEncoder:
    """Ids of whole texts by a tokenizer file.

    If the tokenizer drops white space and looks at nothing across it, each stretch between white space is encoded once and
    remembered as little-endian bytes; otherwise whole texts go to the library.
    """

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.library = Tokenizer.from_str(data.decode())
        self.library.no_truncation()
        self.library.no_padding()
        pre = json.dumps(spec.get("pre_tokenizer"))
        norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        added = spec.get("added_tokens", [])
        self.apart = (
            '"Split"' in pre
            and '"Removed"' in pre
            and '"ByteLevel"' in pre
            and "\\\\s" in pre
            and '"add_prefix_space": false' in pre
            and set(norm) == {"NFC", "Replace", "Lowercase"}
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in added)
        )
        #: str.split() also cuts at these, the tokenizer does not.
        self.controls = regex.compile("[\x1c-\x1f]").search
        self.memo = _Memo(self._word)
        #: Lower-cased letters of Latin words, and punctuation behind them: each is a pre-token of its own.
        self.cores = _Memo(self._core)

    def _core(self, piece: str) -> bytes:
        # printed ASCII stands for itself
        spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return array("I", [t.id for t in self.library.model.tokenize(spelt)]).tobytes()

    def _word(self, word: str) -> bytes:
        m = LATIN(word)
        if not m:
            return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
        core = self.cores[m[1].lower()]
        return core + self.cores[m[2]] if m[2] else core

    def _library(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), CALL):
            for e in self.library.encode_batch_fast(texts[i : i + CALL], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.apart:
            return list(self._library(texts))
        ids = self.memo.__getitem__
        return [self._word(t) if self.controls(t) else b"".join(map(ids, t.split())) for t in texts]


def binary_lengths(n: int, most: int) -> list[int]:
    """Powers of two up to ``most`` (itself one) that add up to n, longest first."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


_kept: dict[str, WordEncoder] = {}


def pack(
    df: DataFrame,
    tokenizer_path: str,
    closing_id: int = 1,
    context: int = 2048,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, offset, ids binary if asked for, and sequence_id.

    ``length`` is also the length of the piece's sequence, and its bucket.
    """
    if context < 1 or context & (context - 1):
        raise ValueError("context must be a power of two")
    spark = df.sparkSession
    bounded_batches(spark)
    data = file_bytes(tokenizer_path)
    shared, key = spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
    did, tie = fresh([id_col, text_col], "did", "tie")
    docs = keyed(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col, did, tie)
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(did).alias("did"), F.col(tie).alias("tie"), F.col(f"`{text_col}`").alias("text"))
    names = ["id", "did", "tie", "start", "length", "ids_crc32", "doc_tokens", "offset", *["ids"] * with_ids]
    schema = f"id {docs.schema[0].dataType.simpleString()}, did long, tie long, start long, length long, ids_crc32 long, doc_tokens long, offset long"
    schema += ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _kept:
            _kept.clear()
            _kept[key] = WordEncoder(shared.value)
        encoder, closing = _kept[key], np.array([closing_id], "<u4").tobytes()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(3).to_pylist()]
            for a, b in rounds(texts):
                which, start, length, crc, total, bodies = [], [], [], [], [], []
                for i, ids in enumerate(encoder.encode(texts[a:b]), a):
                    view, n = memoryview(ids + closing), len(ids) // 4 + 1
                    lengths = binary_lengths(n, context)
                    starts = [0, *accumulate(lengths)][:-1]
                    which += [i] * len(lengths)
                    start += starts
                    length += lengths
                    total += [n] * len(lengths)
                    cuts = [view[4 * s : 4 * (s + k)] for s, k in zip(starts, lengths)]
                    crc += map(zlib.crc32, cuts)
                    if with_ids:
                        bodies += map(bytes, cuts)
                for c in range(0, len(which), OUT_ROWS):
                    d = slice(c, c + OUT_ROWS)
                    zero, at = np.zeros(len(which[d]), np.int64), pa.array(which[d])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(at) for k in range(3)), *(pa.array(x[d], pa.int64()) for x in (start, length, crc, total)), pa.array(zero)]
                        + [pa.array(bodies[d], pa.binary())] * with_ids,
                        names,
                    )

    # written, as it is counted and read again
    pieces = written(docs.mapInArrow(run, schema), "pieces")
    # a row for each power of two
    counts = sorted((r.length, r["count"]) for r in pieces.groupBy("length").count().collect())
    parts = [-(-n * (4 * length * with_ids + ROW_BYTES) // PART_BYTES) for length, n in counts]
    part = F.lit(0).cast("long")
    for (length, _), first, n in zip(counts, accumulate(parts, initial=0), parts):
        part = F.when(F.col("length") == length, first + F.pmod(F.xxhash64("did", "tie", "start"), F.lit(n))).otherwise(part)
    pieces = pieces.withColumn("part", part)
    sizes = pieces.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_part = F.row_number().over(Window.partitionBy("part").orderBy("did", "tie", "start")) - 1
    numbered = pieces.withColumn("at", in_part).join(sizes.select("part", before.alias("before")), "part")
    return numbered.select(F.col("id").alias(id_col), *names[3:], (F.col("before") + F.col("at")).alias("sequence_id"))
