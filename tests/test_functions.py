import hashlib
import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from skein.functions import identity, schedule, text, tokens, windows
from skein.policy import BOS, END_OF_DOCUMENT, PAD


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("span", ["2026", "-3.14159", "1,234.50", "9.81 m/s", "1e-9", "50%"])
def test_numeric_spans_survive(spark, span):
    assert one(spark, text.numeric_spans(F.col("t")), t=("string", f"value {span} end"))[0].startswith(span)


def test_numeric_safe_nfc(spark):
    good = one(spark, text.numeric_safe_nfc(F.col("t")), t=("string", unicodedata.normalize("NFD", "é 12")))
    assert good.text == "é 12" and good.ok


def test_contract_reject(spark):
    for t, want in ((None, "blank"), (" ", "blank"), ("a <|user|> b", "control_literal"), ("a▁b", "reserved_mark"), ("fine", None)):
        assert one(spark, text.contract_reject(F.col("t")), t=("string", t)) == want


def test_canonical_prompt(spark):
    got = one(spark, text.canonical_prompt(F.col("t")), t=("string", "  Go NORTH 12 steps,\n  then x12 Straße -5 "))
    assert got == "go <direction> <number> steps, then x12 strasse <number>"


def test_shingles_and_jaccard(spark):
    cut = lambda s: one(spark, text.shingles(F.col("w")), w=("array<string>", s))
    assert cut([]) == [] and cut(["a", "b"]) == ["a b"] and cut(list("abcabc")) == ["a b c", "b c a", "c a b"]
    j = one(spark, text.jaccard(F.col("a"), F.col("b")), a=("array<string>", ["x", "y"]), b=("array<string>", ["y", "z"]))
    assert j == pytest.approx(1 / 3)
    assert one(spark, text.jaccard(F.col("a"), F.col("b")), a=("array<string>", []), b=("array<string>", [])) == 1.0


def test_seed_equals_hashlib(spark):
    body = "v\x001\x00fam\x007".encode()
    want = hashlib.sha256(body).hexdigest()[:32]
    assert one(spark, identity.seed_hex("v", 1, F.col("f"), F.col("n")), f=("string", "fam"), n=("bigint", 7)) == want
    assert int(want, 16) == identity.seed_number(1, "fam", 7, "v")
    assert int(one(spark, identity.seed64("v", 1, F.col("f"), F.col("n")), f=("string", "fam"), n=("bigint", 7))) == int(want[:16], 16)


def test_config_fingerprint_ignores_pins():
    a = {"data": {"seed": 1, "status": "x"}}
    assert identity.config_fingerprint(a) == identity.config_fingerprint({"data": {"status": "y", "seed": 1}})
    assert identity.config_fingerprint(a) != identity.config_fingerprint({"data": {"seed": 2}})


def naive_windows(n, length):
    """The windows by direct allocation."""
    last, other = length - 2, length - 1
    if n <= last:
        return [(0, n)]
    count = -(-(n - last) // other) + 1
    out, at = [], 0
    for left in range(count, 1, -1):
        size = min(other, n - at - (left - 1))
        out.append((at, at + size))
        at += size
    return [*out, (at, n)]


def test_windows_equal_a_direct_loop(spark):
    cases = [(n, length) for length in (3, 4, 5, 7, 16) for n in range(1, 60)]
    for length in {c[1] for c in cases}:
        rows = spark.createDataFrame([(n,) for n, m in cases if m == length], "n bigint")
        for r in rows.select("n", windows.window_ranges(F.col("n"), length).alias("w")).collect():
            assert [(x.token_start, x.token_end) for x in r.w] == naive_windows(r.n, length), (r.n, length)
            assert [x.final for x in r.w] == [False] * (len(r.w) - 1) + [True]
    assert one(spark, windows.window_ranges(F.col("n"), 8), n=("bigint", 0)) is None


def test_golden_row(spark):
    ids = one(spark, windows.pad(windows.wrap(F.col("b"), F.lit(True)), 6), b=("array<int>", [42]))
    assert ids == [BOS, 42, END_OF_DOCUMENT, PAD, PAD, PAD]
    assert one(spark, windows.labels(F.col("i")), i=("array<int>", ids)) == [-100, 42, 4, -100, -100, -100]
    assert one(spark, windows.attention_mask(F.col("i")), i=("array<int>", ids)) == [1, 1, 1, 0, 0, 0]
    assert one(spark, windows.target_count(F.col("i")), i=("array<int>", [1, 8, 9, -100])) == 2
    with pytest.raises(Exception, match="longer than its row"):
        one(spark, windows.pad(F.col("i"), 2), i=("array<int>", [1, 2, 3]))


def test_packed_reject(spark):
    reason = lambda ids, final: one(spark, windows.packed_reject(F.col("i"), F.lit(final), 6), i=("array<int>", ids))
    assert reason([1, 42, 4, 3, 3, 3], True) is None
    assert reason([1, 42, 3, 4, 3, 3], True) == "padding"
    assert reason([1, 42, 4, 3, 3, 3], False) == "document_end"
    assert reason([1, 42, 7, 4, 3, 3], True) == "control_id"
    assert reason([42, 42, 42, 4, 3, 3], True) == "start"
    assert reason([1, 4, 3, 3, 3, 3], True) == "empty"


def test_curves(spark):
    rows = spark.range(0, 101).select("id", schedule.warmup_cosine(F.col("id"), 10, 100, 0.1).alias("c"), schedule.warmup_stable_decay(F.col("id"), 10, 100, 0.8, 0.1).alias("s")).collect()
    for r in rows:
        cosine = max(r.id, 1) / 10 if r.id < 10 else 0.1 + 0.9 * 0.5 * (1 + math.cos(math.pi * min((r.id - 10) / 90, 1)))
        stable = max(r.id, 1) / 10 if r.id < 10 else 1.0 if r.id < 80 else 0.1 + 0.9 * 0.5 * (1 + math.cos(math.pi * min((r.id - 80) / 20, 1)))
        assert r.c == pytest.approx(cosine) and r.s == pytest.approx(stable)


def test_encode_and_decode(spark):
    encode, decode = tokens.encoder(tokens.ByteTokenizer), tokens.decoder(tokens.ByteTokenizer, {1: "<s>", 4: "<eod>"})
    e = one(spark, encode(F.col("t")), t=("string", "a é"))
    assert e.reason is None and tokens.ByteTokenizer().decode(e.ids) == "a é"
    assert one(spark, encode(F.col("t")), t=("string", "x <|user|>")).reason == "control_literal"
    assert one(spark, decode(F.col("i")), i=("array<int>", [1, *e.ids, 4])) == "<s>a é<eod>"
    skip = tokens.decoder(tokens.ByteTokenizer, {1: "<s>", 4: "<eod>"}, skip_special=True)
    assert one(spark, skip(F.col("i")), i=("array<int>", [1, *e.ids, 4])) == "a é"
