"""Queries cover their whole job: every pair of splits, every language and position."""

from skein.plans import QUERIES


def test_near_duplicates_of_every_pair_of_splits_are_reported(spark, tmp_path):
    text = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    docs = [(1, text, "web_16"), (2, text + " tail", "web_18"), (3, "other words here", "web_0"), (4, text + " end", "web_19")]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["cross_split_near_dup"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_l, r.doc_r) for r in got) == [(1, 2), (1, 4)]


def test_mix_reports_every_language_and_position(spark, tmp_path):
    docs = [(i, "word " * (1 + i % 5), ("de", "en", "es", "fr")[i % 4], f"web_{i % 20}") for i in range(400)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.lang: r for r in QUERIES["mix_report"](spark, str(tmp_path)).collect()}
    assert {g: (r.presentations, r.unique_rows, r.reused_presentations) for g, r in got.items()} == dict.fromkeys(("de", "en", "es", "fr"), (200, 100, 100))
    assert {r.lang for r in QUERIES["mix_schedule"](spark, str(tmp_path)).collect()} == set(got)
    assert QUERIES["delivery_acknowledgement"](spark, str(tmp_path)).first().resume_at == 800
    assert sum(r.tokens for r in got.values()) == 2 * sum(len(t) + 1 for _, t, _, _ in docs)
