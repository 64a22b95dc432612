"""Operators 1, 5 and 7 against the libraries."""

import hashlib
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
from tokenizers import Tokenizer  # noqa: E402

from skein.llm import bpe, counts, packing  # noqa: E402

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
RNG = random.Random(1)
ODD = [
    None, "", " ", "\n\n  a  b\t\tc   ", "aaaa" * 3000, "'s'S don't I'll", "é́ñ 日本語テキスト 🎉🎉", "\x00\x1c\x1d x", "a b c",
    "x" * 7777, " " * 5000, "a <|endoftext|> b<|endoftext|>", "<|startoftext|>", "x́ K İI ΑΣ Σ", "word " * 20_000, "same", "same",
    *("".join(RNG.choice("ab é\n1!'s日") for _ in range(RNG.randint(1, 200))) for _ in range(200)),
]


def table(spark):
    rows = [(i, t, f"x{i}") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)


def test_encode_equals_the_library(spark):
    ranks = bpe.load_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = table(spark)
    ids = bpe.encode(df, RANKS, P.PATTERN)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in enumerate(ODD)}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(ids, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(ODD)}
    for r in bpe.round_trip(df, RANKS, P.PATTERN).collect():
        assert r.n_tokens == len(got[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, got[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in counts.count_tokens(table(spark), P.path("byte_bpe_50k.json"), P.PATTERN, limit=10).collect():
        t = ODD[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 10), repr(t[:60])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_packing_holds_every_id_once(spark, name):
    library = Tokenizer.from_file(P.path(name))
    rows = packing.pack(table(spark), P.path(name), context=64).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(range(len(ODD)))
    for i, pieces in by_doc.items():
        want = [*library.encode(ODD[i] or "", add_special_tokens=False).ids, 1]
        pieces.sort(key=lambda r: r.start)
        ids = b"".join(bytes(p.ids) for p in pieces)
        assert ids == struct.pack(f"<{len(want)}I", *want)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        for p in pieces:
            assert p.length & (p.length - 1) == 0 and p.length <= 64 and p.offset == 0 and p.doc_tokens == len(want)
            assert p.ids_crc32 == zlib.crc32(bytes(p.ids))
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_binary_lengths():
    for n in range(1, 300):
        got = packing.binary_lengths(n, 16)
        assert sum(got) == n and got == sorted(got, reverse=True) and max(got) <= 16
        assert len([x for x in got if x < 16]) == len({x for x in got if x < 16})


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0
    assert packing.pack(none, P.path("word_bpe_49k.json")).count() == 0
    assert counts.count_tokens(none, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_clashing_columns(spark):
    df = table(spark).withColumn("n_tokens", F.lit("x")).withColumn("__text", F.lit("y")).limit(20)
    assert bpe.round_trip(df, RANKS, P.PATTERN).count() == 20
    assert counts.count_tokens(df, P.path("byte_bpe_50k.json"), P.PATTERN).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
