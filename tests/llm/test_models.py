"""Operators 3, 4, 8, 10 and the pipeline."""

import collections
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from skein.llm import chat, language, quality, rules

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def formatted(df):
    done = chat.format_chats(df.withColumn("content", chat.text_part(F.col("text"))))
    return done.withColumns({"back": chat.read_back(F.col("formatted")), "loss": chat.under_loss(F.col("formatted"), F.col("masked"))})


def test_chat_round_trip(spark):
    rng = random.Random(1)
    odd = ["", None, "<", "<|", "<|user|>\n", "<||end|>\n", "<\\", "<\\|<\\<|", "|>\n", "a|b", "\\", "é🎉 <|x", "</s>[INST] ok [/INST]", "x" * 100_000]
    odd += ["".join(rng.choice("<|\\>\n:aend") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    roles = ["user", "assistant", "system", "a|b", "<|", "end", "", None, "<\\:", "/"]
    rows = [(i // 7, i % 7, rng.choice(roles), t) for i, t in enumerate(odd)] + [(None, None, "user", "no id")]
    want = collections.defaultdict(list)
    for c, _, role, t in rows:
        want[c].append((role or "", t or ""))
    for r in formatted(chats(spark, rows)).collect():
        assert [tuple(x) for x in r.back] == want[r.conv_id]
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.n_turns == len(want[r.conv_id])


def test_chat_parts(spark):
    text, image = ("text", "look <|", None), ("image", None, "i.png")
    rows = [(1, 0, "user", [text, image, ("audio", None, "a.wav"), ("text", "|end", None)]), (1, 1, "assistant", [("document", "", None), (None, "fine", None)])]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, content {chat.PART_TYPE}")
    r = chat.format_chats(df).first()
    assert r.formatted == "<|user|>\nlook <\\|<|image:0|><|audio:1|>|end<||end|>\n<|assistant|>\n<|document:2|>fine<||end|>\n"
    assert [(a.number, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "i.png", 576), (1, "audio", "a.wav", 188), (2, "document", "", 1024)]
    assert [r.formatted[m.start : m.start + m.length] for m in r.masked] == ["<|document:2|>fine"]
    bad = spark.createDataFrame([(1, 0, "user", [("video", "", None)])], df.schema)
    with pytest.raises(Exception, match="unknown kind of part"):
        chat.format_chats(bad).collect()
    assert chat.format_chats(df.limit(0)).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    times, hit = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if times[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def test_statistics_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " ", "\n\n", "a", "  é\x0bz\x1cq", "#*$% <>|&", "a b\na b\n\na b", "w " * 9000, "one two three four five " * 3]
    texts += ["".join(rng.choice(["a ", "b ", "c ", "dd", "\n", " ", "é", "|", "\t"]) for _ in range(rng.randint(0, 120))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("words", F.lit(1))
    for r in rules.statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow_statistics(texts[r.doc_id])
    kept = {r.doc_id for r in rules.kept(df, rules.DecisionList([])).collect()}
    assert kept == {i for i, t in enumerate(texts) if not slow_statistics(t)[-1]}
    assert rules.kept(df, rules.DecisionList([])).columns == df.columns


def test_decision_list():
    rng = random.Random(2)
    rows = [tuple(rng.random() for _ in rules.MEASURES) for _ in range(600)]
    bad = [int(not (r[1] > 0.8 or (r[4] < 0.3 and r[5] > 0.5))) for r in rows]
    learnt = rules.learn(rows, bad)
    assert len(learnt.rules) >= 2 and str(learnt)
    x = {m: [r[i] for r in rows] for i, m in enumerate(rules.MEASURES)}
    hit = [any(all((x[c.measure][i] > c.threshold) == c.above for c in rule) for rule in learnt.rules) for i in range(len(rows))]
    assert sum(h == (b == 0) for h, b in zip(hit, bad)) / len(rows) > 0.97
    assert not rules.learn([], []).rules and not rules.learn(rows[:5], [1] * 5).rules and not rules.learn(rows[:5], [0] * 5).rules


def test_rules_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in rules.judge(docs, rules.fit(docs, none)).collect()}
    assert got == {1: True, 2: False}


def crc_fold(i):
    return zlib.crc32(str(i).encode()) % 5


@tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "", "en"), (10**6 + 2, "12 34 --", "de"), (None, "the thing", "en")], "doc_id bigint, text string, lang string")
    docs = docs.select("doc_id", "text", "lang").unionByName(more)
    got = docs.join(language.predict(docs, language.fit(docs)).withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i"))
    rows = got.where("doc_id < 1000000").select("doc_id", "lang", "held_out", "lang_pred", "score").collect()
    assert all(r.held_out == (crc_fold(r.doc_id) == 0) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert {r.lang_pred for r in got.where("doc_id >= 1000000").collect()} == {"und"}
    assert language.predict(docs, None).where("lang_pred <> 'und' OR score <> 0").count() == 0
    assert language.predict(docs.limit(0), None).count() == 0


@tables
def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 1, "")], docs.schema))
    scored = quality.score(docs, quality.fit(docs, labels))
    assert scored.count() == docs.count() and scored.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.3 AS int)").count() == 0
    held = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum((r.predicted == 1) == (r.quality == 1) for r in held) / len(held) > 0.9
    assert quality.score(docs, quality.fit(docs, labels.limit(0))).select("score").distinct().count() == 1
    model = quality.fit(docs, labels)
    assert quality.accepted(docs, model).count() == quality.score(docs, model).where("predicted = 1").count()


@tables
def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns, name
        assert after.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0 and 0 < after.count() <= before.count()
        before = after
    packed = pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == before.count()
    assert pipeline.run(spark, SF).agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]
