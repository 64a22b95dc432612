"""Names that clash, ids of other types, long pre-tokens, ids of sequences under other partitions, and the search by blocks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from skein.llm import bpe, components, counts, lines, packing, quality, simhash, subword  # noqa: E402

TEXTS = ["a b c d e f\nx y z", "a b c d e f\nnew words of its own", None, "", "a b c d e f\nx y z", "q r s t u v w"]


def test_helper_columns_never_clash(spark):
    names = ["__gone", "__did", "__tie", "__key", "__keep", "__fp", "__pieces", "__left", "__gone_id"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, ", ".join(["doc_id bigint", "text string", *[f"{n} string" for n in names]]))
    model = quality.fit(df, spark.createDataFrame([], "doc_id bigint, quality int"))
    for out in (lines.dedup_lines(df), simhash.one_of_each(df), quality.accepted(df, model)):
        assert out.columns == df.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
    with pytest.raises(ValueError):
        lines.dedup_lines(df, counts=("__gone", "n"))


def test_ids_of_other_types(spark):
    df = spark.createDataFrame([(f"id{i}", t) for i, t in enumerate(TEXTS)], "doc_id string, text string")
    kept = [x for r in lines.dedup_lines(df).collect() for x in (r.text or "").split("\n")]
    assert sorted(x for x in kept if x) == ["a b c d e f", "new words of its own", "q r s t u v w", "x y z"]
    got = {r.doc_id: r.n_bytes for r in counts.count_tokens(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect()}
    assert got == {f"id{i}": len(t or "") for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("letters", ["ab", "aeinorst", "日本語", "a"])
def test_long_pre_tokens_equal_the_library(letters):
    data = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(data), special_tokens={})
    codec, rng = bpe.ByteBPE(data, P.PATTERN), random.Random(1)
    text = "".join(rng.choice(letters) for _ in range(9000))
    assert codec.encode([text])[0] == library.encode_ordinary(text)
    for _ in range(200):
        piece = "".join(rng.choice(letters) for _ in range(rng.randint(2, 60))).encode()
        if piece not in codec.ids:
            assert list(codec._merge_long(codec.byte_ids[np.frombuffer(piece, np.uint8)])) == library._core_bpe.encode_single_piece(piece)


def test_ids_of_sequences_do_not_follow_the_partitions(spark):
    df = spark.createDataFrame([(i, "word " * (i * 7 % 50)) for i in range(60)], "doc_id bigint, text string")
    found = []
    for n in (1, 5):
        rows = packing.pack(df.repartition(n), P.path("word_bpe_49k.json"), context=16, with_ids=False).collect()
        assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
        by_id = sorted(rows, key=lambda r: r.sequence_id)
        assert [r.length for r in by_id] == sorted(r.length for r in rows)
        found.append([(r.doc_id, r.start) for r in by_id])
    assert found[0] == found[1]


def test_buckets_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 300)
    rows = [(i, "word " * (i * 7 % 50)) for i in range(60)] + [(None, "word"), (3, "other words"), (3, "other words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = []
    for n in (1, 5):
        got = sorted(packing.pack(df.repartition(n), P.path("word_bpe_49k.json"), context=16).collect(), key=lambda r: r.sequence_id)
        assert [r.sequence_id for r in got] == list(range(len(got))) and all(len(r.ids) == 4 * r.length for r in got)
        assert [r.length for r in got] == sorted(r.length for r in got)
        assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
        found.append([(r.doc_id, r.start, r.length, r.ids_crc32) for r in got])
    assert found[0] == found[1]
    assert packing.pack(df.limit(0), P.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("cell", [100_000, 4])
def test_links_within_a_radius_equal_brute_force(spark, monkeypatch, cell):
    from skein.llm.fingerprints import block_masks

    monkeypatch.setattr(components, "CELL", cell)
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(5)})
    df = spark.createDataFrame([(components.signed(f),) for f in fps], "fp bigint").repartition(3)
    links = [(r.a % 2**64, r.b % 2**64) for r in components.linked(df, block_masks(4, 6), radius=4).collect()]

    def roots(pairs):
        root = {f: f for f in fps}
        for _ in fps:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert roots(links) == roots([(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])


def test_folded_scores_equal_the_features_of_whole_texts():
    shape = subword.Shape(bits=10, dim=4, pairs=True, epochs=2)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["aa", "bb", "cab", "é", "dada"]) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    model = subword.train(texts, [i % 2 for i in range(80)], shape)
    features, got = subword.Features(shape), subword.Scorer(model).probabilities(texts)
    for t, p in zip(texts, got):
        bucket, share = features.of_text(t)
        logits = (share @ model.table[bucket] if len(bucket) else np.zeros(2)) + model.bias
        want = np.exp(logits / model.temperature)
        assert np.allclose(p, want / want.sum(), atol=1e-5)
