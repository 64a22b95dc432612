"""The pipeline's stages against brute force, on odd rows and on what the stage before kept."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_copies import slow_groups, slow_long_fingerprint
from test_models import slow_statistics
from test_near import WORDS, removed_by_brute_force

pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from skein.llm import quality, rules, subword  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def slow_quality(spark, rows):
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    features, good = subword.Features(model.shape), list(model.classes).index(1)
    out = []
    for r in rows:
        bucket, share = features.of_text(r[1] or "")
        logits = ((share @ model.table[bucket] if len(bucket) else np.zeros(len(model.classes))) + model.bias) / model.temperature
        p = np.exp(logits - logits.max())
        if p[good] / p.sum() >= quality.ACCEPT:
            out.append(r)
    return out


def slow_rules(spark, rows):
    learnt = rules.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    texts = sorted({r[1] or "" for r in rows})
    judged = rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), learnt).collect()
    rejected = {texts[r.doc_id] for r in judged if r.rule}
    return [r for r in rows if not slow_statistics(r[1])[-1] and (r[1] or "") not in rejected]


def slow_lines(spark, rows):
    # null ids are first; brute force knows no null
    gone = removed_by_brute_force([(-1 if i is None else i, t) for i, t in dict.fromkeys(rows)])
    out = []
    for i, t in rows:
        lost = gone[-1 if i is None else i]
        left = t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost)
        if not lost or WORDS.search(left):
            out.append((i, left))
    return out


def slow_copies(spark, rows):
    key = {r: (10**9 if r[0] is None else r[0]) for r in rows}
    groups = slow_groups([(key[r], slow_long_fingerprint(r[1])) for r in dict.fromkeys(rows)])
    return [r for r in dict.fromkeys(rows) if groups[key[r]] == key[r]]


SLOW = [slow_quality, slow_rules, slow_lines, slow_copies]


def pieces_of(packed):
    found = {}
    for r in packed.orderBy("doc_id", "start").collect():
        found.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    return found


def check_pieces(found, rows):
    library = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    library.no_truncation(), library.no_padding()
    for i, t in rows:
        ids, at = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for start, length, crc, total in found[i]:
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    assert set(found) == {i for i, _ in rows}


def some_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs]
    good = [r for r in rows if len((r[1] or "").split()) > 60][:2]
    # words changed here and there, so that lines differ and texts do not
    near = [" ".join(w if k % 40 != 20 else "changed" for k, w in enumerate(t.split(" "))) for _, t in good]
    return [*rows, *[(1000 + k, t) for k, t in enumerate(near)], rows[0], (2000, None), (2001, ""), (None, good[0][1])]


def test_stages_equal_brute_force_and_keep_columns(spark):
    rows = some_rows(spark)
    for (name, stage), slow in zip(pipeline.STAGES[:-1], SLOW):
        wide = [(i, t, f"w{k}", 7) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(wide, "doc_id bigint, text string, __tie string, label int").repartition(3)
        out = stage(spark, df, SF)
        got = [(r.doc_id, r.text) for r in out.collect()]
        assert out.columns == df.columns, name
        assert sorted(got, key=repr) == sorted(slow(spark, rows), key=repr), name
        assert stage(spark, df.limit(0), SF).count() == 0, name
    pack = pipeline.STAGES[-1][1]
    unique = [r for r in dict(rows).items() if r[0] is not None]
    check_pieces(pieces_of(pack(spark, spark.createDataFrame(unique, "doc_id bigint, text string"), SF)), unique)


def test_run_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for slow in SLOW:
        rows = slow(spark, rows)
    check_pieces(pieces_of(pipeline.run(spark, SF)), rows)


def test_near_copies_go(spark):
    rows = [r for r in some_rows(spark) if r[0] is not None and r[1]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in pipeline.simhash_near_dedup(spark, df, SF).collect()}
    assert not left & {1000, 1001} and df.where(F.col("doc_id") < 1000).select("doc_id").distinct().count() >= len(left) > 40
