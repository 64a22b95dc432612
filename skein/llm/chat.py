"""Operator 3: chat formatting with typed content parts, in DataFrame expressions only.

A turn's content is an array of parts (struct kind, text, ref). A visitor flattens the parts in order: a text part is escaped,
an image, audio or document part becomes a placeholder that names its kind and its number in the conversation; the reference is
recorded in ``attachments`` together with the number of tokens that the placeholder stands for.

Template: every turn is ``<|role|>`` + newline + content + ``<||end|>`` + newline. In texts and roles a ``<`` before a bar, a
backslash or the end gets a backslash behind it, and a bar in a role is written ``<\\:``; both are reversible, so that no text can
write a control string.
``masked`` lists the spans, as code point offsets of the formatted string, that a loss is taken of: assistant texts.

Defined cases: a null text is an empty text, a null role an empty role, a null kind is text, a null reference an empty one;
turns are ordered by turn (null first), ties by role and text; repeated rows are repeated turns; rows of a null conversation
id form one conversation; other columns are ignored; an empty table gives an empty table. A conversation is one output row:
its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens that a placeholder expands to, by kind of part.
PART_TOKENS = {"image": 576, "audio": 188, "document": 1024}
OPEN, CLOSE, END = "<|", "|>\n", "<||end|>\n"
PART_TYPE = "array<struct<kind:string,text:string,ref:string>>"


def escape(text: Column) -> Column:
    """No control string is left in the result; ``unescape`` reverses it."""
    return F.regexp_replace(text, r"<(?=[|\\]|\z)", r"<\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\", "<")


def escape_role(role: Column) -> Column:
    """As escape; a bar is written otherwise, so that the first bar behind a role ends it."""
    return F.regexp_replace(escape(role), r"\|", r"<\\:")


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"<\\:", "|"))


def text_part(text: Column) -> Column:
    """Content of one text part."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), none.alias("ref")))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def format_chats(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    content_col: str = "content",
    part_tokens: dict[str, int] | None = None,
) -> DataFrame:
    """One row per conversation: conv_col, formatted, masked, attachments, n_turns.

    ``content_col`` holds PART_TYPE. Unknown kinds raise an error when their row is read.
    """
    tokens = PART_TOKENS if part_tokens is None else part_tokens
    kinds = F.create_map(*[F.lit(x) for kv in tokens.items() for x in kv])
    known = ["text", *tokens]
    turns = df.select(
        F.col(f"`{conv_col}`").alias("__conv"),
        F.struct(
            F.col(f"`{turn_col}`").cast("long").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{content_col}`"), F.array().cast(PART_TYPE)).alias("parts"),
        ).alias("t"),
    )
    convs = turns.groupBy("__conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    media = F.flatten(F.transform("turns", lambda t: F.filter(t["parts"], lambda p: ~_is_text(p))))
    convs = convs.withColumn("media", media)
    # the number of a turn's first attachment: how many there are in earlier turns
    before = F.transform(
        "turns",
        lambda t, i: F.when(F.size("media") == 0, F.lit(0)).otherwise(
            F.aggregate(
                F.slice("turns", F.lit(1), i), F.lit(0), lambda n, x: n + F.size(F.filter(x["parts"], lambda p: ~_is_text(p)))
            )
        ),
    )

    def content(parts: Column, first: Column) -> Column:
        """The visitor: parts in order; a placeholder's number counts the attachments before it."""
        return F.array_join(
            F.transform(
                parts,
                lambda p, j: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).when(
                    p["kind"].isin(known),
                    F.concat(
                        F.lit(OPEN),
                        p["kind"],
                        F.lit(":"),
                        (first + F.size(F.filter(F.slice(parts, F.lit(1), j), lambda q: ~_is_text(q)))).cast("string"),
                        F.lit("|>"),
                    ),
                ).otherwise(F.raise_error(F.concat(F.lit("unknown kind of part: "), p["kind"]))),
            ),
            "",
        )

    pieces = F.transform(
        F.arrays_zip("turns", before.alias("before")),
        lambda z: F.struct(
            F.concat(F.lit(OPEN), escape_role(z["turns"]["role"]), F.lit(CLOSE)).alias("head"),
            content(z["turns"]["parts"], z["before"]).alias("body"),
            (z["turns"]["role"] == "assistant").alias("loss"),
        ),
    )
    convs = convs.select("__conv", "media", pieces.alias("pieces"))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p["head"]) + F.length(p["body"]) + F.lit(len(END))).cast("long").alias("at"),
            F.when(
                p["loss"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(p["head"])).cast("long").alias("start"), F.length(p["body"]).cast("long").alias("length")
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return convs.select(
        F.col("__conv").alias(conv_col),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        spans.alias("masked"),
        F.transform(
            "media",
            lambda p, i: F.struct(
                i.cast("long").alias("number"),
                p["kind"].alias("kind"),
                F.coalesce(p["ref"], F.lit("")).alias("ref"),
                F.element_at(kinds, p["kind"]).cast("long").alias("tokens"),
            ),
        ).alias("attachments"),
        F.size("pieces").cast("long").alias("n_turns"),
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted string: unescaped, placeholders as they stand."""
    turns = F.filter(F.split(formatted, r"<\|\|end\|>\n"), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            unescape_role(F.regexp_extract(x, r"(?s)\A<\|([^|]*)\|>\n", 1)).alias("role"),
            unescape(F.regexp_replace(x, r"(?s)\A<\|[^|]*\|>\n", "")).alias("text"),
        ),
    )


def under_loss(formatted: Column, masked: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(masked, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
