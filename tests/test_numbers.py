"""Numeric spans against a slow scanner, which tries every end of every start in the pattern's order of preference."""

import random

from pyspark.sql import functions as F

from skein.functions import text

UNIT = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzµμΩЁё") | {chr(c) for c in range(0x410, 0x450)}


def in_word(c):
    return c == "_" or c.isalnum()


def digits(t, at, least, most=10**9):
    n = 0
    while n < most and at + n < len(t) and t[at + n].isdecimal():
        n += 1
    return list(range(at + n, at + least - 1, -1))


def wholes(t, at):
    def groups(end, n):
        if end + 3 < len(t) and t[end] in " ,\u00a0" and digits(t, end + 1, 3, 3):
            yield from groups(end + 4, n + 1)
        if n:
            yield end

    for end in digits(t, at, 1, 3):
        yield from groups(end, 0)
    yield from digits(t, at, 1)


def tails(t, at):
    def decimals():
        if at < len(t) and t[at] in ".,":
            yield from digits(t, at + 1, 1)
        yield at

    for d in decimals():
        if d < len(t) and t[d] in "eE":
            e = d + 1 + (d + 1 < len(t) and t[d + 1] in "+-")
            yield from digits(t, e, 1)
        yield d


def names(t, at):
    n = at
    while n < len(t) and t[n] in UNIT:
        n += 1
    return range(n, at, -1)


def units(t, at):
    for gap in ([at + 1] if at < len(t) and t[at].isspace() else []) + [at]:
        if gap < len(t) and t[gap] in "%‰":
            yield gap + 1
        if gap < len(t) and t[gap] == "°":
            if gap + 1 < len(t) and t[gap + 1] in "CFК":
                yield gap + 2
            yield gap + 1
        for end in names(t, gap):
            slash = end
            while slash < len(t) and t[slash].isspace():
                slash += 1
            if slash < len(t) and t[slash] == "/":
                second = slash + 1
                while second < len(t) and t[second].isspace():
                    second += 1
                yield from names(t, second)
            yield end
    yield at


def slow_spans(t):
    out, at = [], 0
    while at < len(t):
        if at == 0 or not in_word(t[at - 1]):
            first = at + (t[at] in "+-")
            ends = (u for w in wholes(t, first) for d in tails(t, w) for u in units(t, d))
            end = next((e for e in ends if e == len(t) or not in_word(t[e])), None)
            if end is not None:
                out.append(t[at:end])
                at = end
                continue
        at += 1
    return out


def test_numeric_spans_equal_the_slow_scanner(spark):
    rng = random.Random(5)
    pieces = [*"0123456789" * 2, *" ,.-+eE%°C/mкs²x_", "\u00a0", "000", "‰", "km", " / ", "٣", "½", "\x1c"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))) for i in range(3000)]
    got = spark.createDataFrame(rows, "i int, t string").select("i", text.numeric_spans(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.s == slow_spans(rows[r.i][1]), repr(rows[r.i][1])
