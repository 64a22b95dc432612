"""Tokenizers behind one protocol: a byte tokenizer as expressions, and any Python tokenizer as vectorized functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import arrow
from ..policy import BOS, CONTROL_LITERALS, CONTROL_NAMES, CORE_NAMES, END_OF_TURN, FIRST_BYTE_ID, RESERVED_MARK, SPECIAL_IDS, START_LITERAL, TURN_LITERAL, VOCABULARY


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...


class ByteTokenizer:
    """Ids of UTF-8 bytes behind the special ids."""

    def encode(self, text: str) -> list[int]:
        return [b + FIRST_BYTE_ID for b in text.encode()]

    def decode(self, ids: list[int]) -> str:
        return bytes(i - FIRST_BYTE_ID for i in ids).decode()


class FileTokenizer:
    """A public tokenizer's file behind the special ids: JSON of ``tokenizers``, or a ``sentencepiece`` model. Adds no special tokens."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids, self._text = model.encode, model.decode
        else:
            import tokenizers

            model = tokenizers.Tokenizer.from_file(path)
            self._ids = lambda text: model.encode(text, add_special_tokens=False).ids
            self._text = lambda ids: model.decode(ids, skip_special_tokens=False)

    def encode(self, text: str) -> list[int]:
        return [i + FIRST_BYTE_ID for i in self._ids(text)]

    def decode(self, ids: list[int]) -> str:
        return self._text([i - FIRST_BYTE_ID for i in ids])


def encoder(make: Callable[[], Tokenizer], vocabulary: int = VOCABULARY) -> Callable[[Column], Column]:
    """A function of text columns: struct(ids, reason). The tokenizer is made once per worker.

    Texts are normalized to NFC; ids are null where a text breaks the contract, gives control or unknown ids, or does not decode
    to itself.
    """
    arrow.bounded()
    kept: list[Tokenizer] = []
    ids = pa.list_(pa.int32())

    def one(text: str | None) -> dict:
        if text is None or not text.strip():
            return {"ids": None, "reason": "blank"}
        text = unicodedata.normalize("NFC", text)
        if any(c in text for c in CONTROL_LITERALS):
            return {"ids": None, "reason": "control_literal"}
        if RESERVED_MARK in text:
            return {"ids": None, "reason": "reserved_mark"}
        made = kept[0].encode(text)
        if any(i in SPECIAL_IDS or not 0 <= i < vocabulary for i in set(made)):
            return {"ids": None, "reason": "control_id"}
        if kept[0].decode(made) != text:
            return {"ids": None, "reason": "round_trip"}
        return {"ids": np.array(made, np.int32), "reason": None}

    @F.arrow_udf("ids array<int>, reason string")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not kept:
            kept.append(make())
        return arrow.each(batches, one, lambda x: 0 if x["ids"] is None else len(x["ids"]), pa.struct([("ids", ids), ("reason", pa.string())]))

    return encode


def decoder(make: Callable[[], Tokenizer], specials: dict[int, str], skip_special: bool = False) -> Callable[[Column], Column]:
    """A function of id columns: text, where runs of ordinary ids are decoded between special ids, which are written or skipped."""

    arrow.bounded()
    kept: list[Tokenizer] = []

    def one(ids) -> str | None:
        if ids is None:
            return None
        out, run = [], []
        for i in [*ids, None]:
            if i is not None and i not in specials:
                run.append(int(i))
                continue
            if run:
                out.append(kept[0].decode(run))
                run = []
            if i is not None and not skip_special:
                out.append(specials[i])
        return "".join(out)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not kept:
            kept.append(make())
        return arrow.each(batches, one, lambda text: len(text or ""), pa.string())

    return decode


def suppressed(stop: int) -> Column:
    """Special ids but the stop id, sorted."""
    return F.array_sort(F.array_except(F.array(*[F.lit(i) for i in SPECIAL_IDS]), F.array(F.lit(stop))))


def render_chat(messages: Column, generation: bool = False) -> Column:
    """Start literal, then a marker, the content and an end of turn per message (array of struct role, content)."""
    turns = F.transform(messages, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>"), m["content"], F.lit(TURN_LITERAL)))
    return F.concat(F.lit(START_LITERAL), F.array_join(turns, ""), F.lit("<|assistant|>" if generation else ""))


def contents_encoder(make: Callable[[], Tokenizer]) -> Callable[[Column], Column]:
    """A function of columns of arrays of texts: the ids of each, in NFC; a null text has none. The tokenizer is made once per worker."""
    arrow.bounded()
    kept: list[Tokenizer] = []

    def one(texts) -> list | None:
        return None if texts is None else [np.array(kept[0].encode(unicodedata.normalize("NFC", t or "")), np.int32) for t in texts]

    @F.arrow_udf("array<array<int>>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if not kept:
            kept.append(make())
        return arrow.each(batches, one, lambda made: sum(map(len, made or ())), pa.list_(pa.list_(pa.int32())))

    return encode


def chat_ids(messages: Column, encode: Callable[[Column], Column]) -> Column:
    """Ids of a chat: one start id; per message its role's marker, its content's ids and an end of turn. Nothing is cut off.

    ``encode`` is a contents_encoder; messages that chat_reason rejects have null ids.
    """
    marker = lambda m: (F.array_position(F.array(*[F.lit(n) for n in CONTROL_NAMES]), m["role"]) + len(CORE_NAMES) - 1).cast("int")
    contents = encode(F.transform(messages, lambda m: m["content"]))
    turns = F.zip_with(messages, contents, lambda m, ids: F.concat(F.array(marker(m)), ids, F.array(F.lit(END_OF_TURN))))
    return F.when(chat_reason(messages).isNull(), F.concat(F.array(F.lit(BOS)), F.flatten(turns)))


def chat_reason(messages: Column) -> Column:
    """Why messages cannot be rendered, or null: empty, role, content."""
    literal = lambda m: F.exists(F.array(*[F.lit(c) for c in (*CONTROL_LITERALS, RESERVED_MARK)]), lambda c: F.contains(m["content"], c))
    return (
        F.when(messages.isNull() | (F.size(messages) == 0), "empty")
        .when(F.exists(messages, lambda m: ~F.coalesce(m["role"].isin("system", "user", "assistant"), F.lit(False))), "role")
        .when(F.exists(messages, lambda m: m["content"].isNull() | literal(m)), "content")
    )
