"""Operator 4: quality rules as a learned decision list, in DataFrame expressions only.

Statistics of every whole text are array expressions; a base check rejects texts with under ten words and texts that repeat
themselves. Sequential covering learns the rest from the statistics of a bounded sample of labelled documents: a rule grows one
threshold condition at a time on one part of the sample, is pruned on the other, and stays if it is precise there; what it covers
is taken out, and the next rule follows. The list is emitted as one ordered conditional expression over the statistics.

Defined cases: a null text has no words (and fails the base check), as has an empty one; statistics per word of a text without
words are zero; without labels, or with one label only, the list is empty and only the base check rejects; an id with several
labels counts with the least; repeated rows give repeated results; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .folds import labelled_ids

# Fixed values of the contract: what separates words, and symbols.
WORD, SPACE, SYMBOLS = r"[^\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Measures that rules look at.
MEASURES = ["word_length", "symbol_rate", "repeat_rate", "dup_line_rate", "distinct_rate", "capital_rate", "mark_rate", "digit_rate"]
FIT_ROWS, FIT_BYTES = 16_000, 32_768


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, BASE, base_failed and MEASURES of every whole text; one pass, no shuffle."""
    bounded_batches(docs.sparkSession)

    def less(chars: str) -> Column:
        return F.length(F.regexp_replace("__text", f"[{chars}]+", ""))

    df = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    # each step's arrays are columns of a projection of their own, so that no lambda computes them again
    df = df.select(
        "__id",
        F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.length("__text").alias("chars"),
        less(SYMBOLS).alias("no_symbols"),
        less(r"\p{Lu}").alias("no_capitals"),
        less("!?").alias("no_marks"),
        less("0-9").alias("no_digits"),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])
    )
    df = df.select(
        "__id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.size(F.array_distinct("words")).alias("distinct"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        *[F.col(c) for c in ("chars", "no_symbols", "no_capitals", "no_marks", "no_digits")],
    )
    # only texts that repeat a window sort theirs
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*[F.col(c) for c in df.columns if c != "windows"], F.when(repeats, placed).alias("placed"))
    same = F.zip_with("placed", F.slice("placed", F.lit(2), F.size("placed")), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    df = df.withColumn("same", F.when(F.col("placed").isNotNull(), same))
    either = F.zip_with("same", F.concat(F.array(F.lit(False)), "same"), lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
    places = F.zip_with("placed", either, lambda p, e: F.when(e, p["i"]))
    df = df.withColumn("at", F.when(F.col("placed").isNotNull(), F.sort_array(F.filter(places, lambda x: x.isNotNull()))))
    # a window's words count up to the start of the next one that counts
    spans = F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.least(F.lit(WINDOW), b - a))
    total = F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x)
    df = df.withColumn("n_repeat_words", F.coalesce(F.when(F.col("at").isNotNull(), total), F.lit(0)).cast("long"))
    df = df.withColumn("n_symbols", F.col("chars") - F.col("no_symbols"))

    def rate(of: Column, per: Column) -> Column:
        return F.when(per > 0, of.cast("double") / per).otherwise(F.lit(0.0))

    c = F.col
    made = F.struct(
        *[c(b).cast("long").alias(b) for b in BASE],
        ((c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))).alias("base_failed"),
        rate(c("word_chars"), c("n_words")).alias("word_length"),
        rate(c("n_symbols"), c("n_words")).alias("symbol_rate"),
        rate(c("n_repeat_words"), c("n_words")).alias("repeat_rate"),
        rate(c("n_dup_lines"), c("n_lines")).alias("dup_line_rate"),
        rate(c("distinct"), c("n_words")).alias("distinct_rate"),
        rate(c("chars") - c("no_capitals"), c("word_chars")).alias("capital_rate"),
        rate(c("chars") - c("no_marks"), c("n_words")).alias("mark_rate"),
        rate(c("chars") - c("no_digits"), c("word_chars")).alias("digit_rate"),
    )
    # generated columns: a filter on them stays above, else the optimizer would put all of the above into its condition
    return df.select(c("__id").alias(id_col), F.inline(F.array(made)))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        return F.col(self.measure) > self.threshold if self.above else F.col(self.measure) <= self.threshold


@dataclass
class DecisionList:
    """Rules in order; the first whose conditions all hold rejects, and what none covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule(self) -> Column:
        """Number of the first rule that holds, from 1 on; 0 if none does."""
        out = None
        for k, conditions in enumerate(self.rules, 1):
            every = conditions[0].column()
            for c in conditions[1:]:
                every = every & c.column()
            out = F.when(every, k) if out is None else out.when(every, k)
        return F.lit(0) if out is None else out.otherwise(0)

    def __str__(self) -> str:
        return "\n".join(" and ".join(f"{c.measure} {'>' if c.above else '<='} {c.threshold:.6g}" for c in r) for r in self.rules)


def _covers(rule: list[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for c in rule:
        held &= c.holds(x[c.measure])
    return held


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray, cuts: int, most: int) -> list[Condition]:
    """Adds the condition of the greatest information gain until no good row is covered."""
    rule: list[Condition] = []
    held = rows.copy()
    while len(rule) < most and (held & ~bad).any():
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if not p:
            break
        before, best = np.log2(p / (p + n)), (1e-9, None)
        for name in MEASURES:
            values = np.unique(x[name][held])
            if len(values) < 2:
                continue
            middle = (values[:-1] + values[1:]) / 2
            if len(middle) > cuts:
                middle = middle[np.linspace(0, len(middle) - 1, cuts).astype(int)]
            up, down = np.sort(x[name][held & bad]), np.sort(x[name][held & ~bad])
            for above in (True, False):
                tp = np.searchsorted(up, middle, "right")
                fp = np.searchsorted(down, middle, "right")
                if above:
                    tp, fp = len(up) - tp, len(down) - fp
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(tp > 0, tp * (np.log2(tp / (tp + fp)) - before), -np.inf)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], Condition(name, above, float(middle[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        held &= best[1].holds(x[best[1].measure])
    return rule


def learn(
    rows: list[tuple], labels: list[int], precision: float = 0.97, least: int = 4, cuts: int = 256, most_conditions: int = 4, most_rules: int = 16, seed: int = 11
) -> DecisionList:
    """A decision list that rejects label 0; rows hold MEASURES in order.

    A rule stays if the rows it covers, of both parts together, are bad to at least ``precision`` and are ``least`` or more.
    """
    x = {m: np.array([r[i] for r in rows], float) for i, m in enumerate(MEASURES)}
    bad, left = np.array(labels) == 0, np.ones(len(rows), bool)
    out, rng = DecisionList(), np.random.default_rng(seed)
    if not len(rows) or not (~bad).any():
        return out
    n_rows, tries = len(rows), 0
    while (left & bad).any() and len(out.rules) < most_rules and tries < 4:
        grow = rng.random(n_rows) < 2 / 3
        grown = _grow(x, bad, left & grow, cuts, most_conditions)

        def worth(k: int, rule: list[Condition] = grown, part: np.ndarray = left & ~grow) -> float:
            held = _covers(rule[:k], x, n_rows) & part
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            return (p - n) / (p + n + 1)

        best = max(range(1, len(grown) + 1), key=lambda k: (worth(k), -k), default=0)
        tries += 1
        for rule in (grown[:best], grown):
            held = _covers(rule, x, n_rows) & left
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            if rule and p >= least and p >= precision * (p + n):
                out.rules.append(rule)
                left &= ~held
                tries = 0
                break
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = FIT_ROWS) -> DecisionList:
    """Learns from at most ``most`` labelled documents of the fitting folds, of at most FIT_BYTES each, that pass the base check."""
    known = labelled_ids(labels, F.col(f"`{label_col}`").cast("int"), most, id_col)
    texts = docs.select(F.col(f"`{id_col}`").alias("__key"), F.col(f"`{text_col}`").alias("__text")).where(F.octet_length("__text") <= FIT_BYTES)
    # the sample is bounded by ``most``; every document passes by it without a shuffle
    sample = texts.join(F.broadcast(known), "__key").select(F.struct("__key", "__label").alias("__id"), "__text").limit(most)
    rows = statistics(sample, "__id", "__text").where("not base_failed").select("__id.__key", "__id.__label", *MEASURES).collect()
    rows.sort(key=lambda r: tuple(r))
    return learn([tuple(r)[2:] for r in rows], [r[1] for r in rows])


def judge(docs: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, BASE, base_failed, rule (number of the rule that rejects, 0 for none) and kept."""
    return (
        statistics(docs, id_col, text_col)
        .withColumn("rule", rules.rule())
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
        .select(id_col, *BASE, "base_failed", "rule", "kept")
    )


def kept(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that pass the base check and the rules."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"))
    passed = statistics(row.withColumn("__body", F.col(f"__row.`{text_col}`")), "__row", "__body").where(~F.col("base_failed") & (rules.rule() == 0))
    return passed.select(*[F.col(f"__row.`{c}`").alias(c) for c in names])
