"""Text functions as Column expressions; only Unicode normalization leaves the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..policy import CONTROL_LITERALS, DIRECTIONS, RESERVED_MARK

# What parts thousands, and the letters and signs of units.
_GROUP_MARKS, _UNIT_LETTERS, _UNIT_SIGNS = " ,\u00a0", "A-Za-zА-Яа-яЁёµμΩ", ("%", "‰", "°[CFК]?")
#: Letters, numbers of any kind (superscripts, too) and the underscore; white space of Unicode with the separators below it.
_IN_WORD, _BLANK = r"[\p{L}\p{N}_]", r"[\p{IsWhite_Space}\x1c-\x1f]"


def _number_pattern() -> str:
    """A number that stands by itself, and the unit that follows it if there is one."""
    digit, maybe = r"\p{Nd}", "(?:{})?".format
    whole = f"{digit}{{1,3}}(?:[{_GROUP_MARKS}]{digit}{{3}})+|{digit}+"
    number = f"[+-]?(?:{whole})" + maybe(f"[.,]{digit}+") + maybe(f"[eE][+-]?{digit}+")
    name = f"[{_UNIT_LETTERS}]+"
    units = "|".join((*_UNIT_SIGNS, name + maybe(f"{_BLANK}*/{_BLANK}*{name}")))
    return f"(?<!{_IN_WORD}){number}" + maybe(f"{_BLANK}?(?:{units})") + f"(?!{_IN_WORD})"


#: Exact spans of numbers with sign, thousands groups, decimals, exponent and unit.
NUMERIC_SPAN = _number_pattern()
ALPHABETIC_WORD = r"(?U)[^\W\d_]+(?:['’-][^\W\d_]+)*"


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """NFC form; null stays null."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def casefold(text: Column) -> Column:
    """Lower case with the sharp s spelled out; final sigma is the one known difference from full case folding."""
    return F.lower(F.replace(F.replace(text, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss")))


def contract_reject(text: Column) -> Column:
    """Why a text breaks the plain-text contract, or null: blank, control_literal, reserved_mark."""
    control = F.exists(F.array(*[F.lit(c) for c in CONTROL_LITERALS]), lambda c: F.contains(text, c))
    return (
        F.when(text.isNull() | (F.btrim(F.coalesce(text, F.lit(""))) == ""), "blank")
        .when(control, "control_literal")
        .when(F.contains(text, F.lit(RESERVED_MARK)), "reserved_mark")
    )


def numeric_spans(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(NUMERIC_SPAN), F.lit(0))


def numeric_safe_nfc(text: Column) -> Column:
    """struct(text, ok): the NFC form, and whether its numeric spans are those of the text as it was."""
    normal = nfc(text)
    return F.struct(normal.alias("text"), (numeric_spans(text) == numeric_spans(normal)).alias("ok"))


def canonical_prompt(text: Column) -> Column:
    """Case folded, integers and directions replaced by placeholders, white space collapsed."""
    value = F.regexp_replace(casefold(text), r"(?U)(?<!\w)[+-]?\d+(?!\w)", "<number>")
    value = F.regexp_replace(value, rf"(?U)(?<!\w)(?:{'|'.join(DIRECTIONS)})(?!\w)", "<direction>")
    return F.btrim(F.regexp_replace(value, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Words between single spaces of a canonical text; none in an empty one."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def shingles(words_: Column, width: int = 3) -> Column:
    """Distinct runs of ``width`` words, joined by spaces; the whole text if it is shorter; none without words.

    ``words_`` should be a column of its own: it is read once per shingle.
    """
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words_) - width), lambda i: F.concat_ws(" ", *[F.get(words_, i + k) for k in range(width)])
    )
    short = F.when(F.size(words_) == 0, F.array().cast("array<string>")).otherwise(F.array(F.array_join(words_, " ")))
    return F.array_distinct(F.when(F.size(words_) >= width, runs).otherwise(short))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ALPHABETIC_WORD), F.lit(0))


def content_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
