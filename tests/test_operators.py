import random

import pytest
from pyspark.sql import functions as F

from skein.operators import audit, evaluate, generate, mix, pack, profile, verify
from skein.plans.corpus import _families


def test_generated_records_are_verified_and_replayed(spark):
    rows = generate.records(spark, _families(), 40)
    table = generate.families(spark, _families(), 40)
    bad = verify.admitted(rows, table, generate.ROOT_SEED).where("reject_reason IS NOT NULL")
    assert bad.count() == 0
    again = generate.records(spark, _families(), 40)
    assert audit.same_rows(rows.select("record_id", "text_sha256"), again.select("record_id", "text_sha256")).first().equal
    assert rows.select("record_id").distinct().count() == rows.count() == 40 * len(_families())


def test_operands_do_not_repeat(spark):
    for op in ("add", "divide"):
        left, right = generate.operands(F.col("id"), op, *generate.affine_constants("en.x", generate.side_of(op) ** 2))
        rows = spark.range(2000).select(left.alias("l"), right.alias("r"))
        assert rows.distinct().count() == 2000
        assert op != "divide" or rows.where("l % r <> 0").count() == 0


def test_tampering_is_found(spark):
    rows = generate.records(spark, _families(), 8)
    table = generate.families(spark, _families(), 8)
    for column, value, reason in (
        ("text_sha256", F.lit("0" * 64), "text_checksum"),
        ("seed", F.lit("0" * 32), "seed"),
        ("split", F.lit("other"), "conformity"),
        ("family_id", F.lit("none"), "family"),
        ("prompt", F.lit(" "), "required"),
    ):
        got = verify.admitted(rows.withColumn(column, value), table, generate.ROOT_SEED).select("reject_reason").distinct().collect()
        assert [r[0] for r in got] == [reason]
    with pytest.raises(Exception, match="rejected: required"):
        verify.strict(verify.admitted(rows.withColumn("prompt", F.lit(" ")), table, generate.ROOT_SEED)).collect()


def test_family_rules(spark):
    rows = _families()
    rows[0] = rows[0] | {"language": "xx"}
    rows[1] = rows[1] | {"functional_family": rows[5]["functional_family"]}
    got = {r.family_id: r.reject_reason for r in verify.family_reasons(generate.families(spark, rows, 1)).collect()}
    assert got[rows[0]["family_id"]] == "language" and got[rows[1]["family_id"]] == "isolation"


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 14))) for _ in range(60)]
    docs += [d + " w1" for d in docs[:20]] + docs[:5]
    rows = [(i, "train" if i < 60 else "blind", d) for i, d in enumerate(docs)]
    sets = audit.prompt_sets(spark.createDataFrame(rows, "id bigint, split string, text string"), "id", "text")
    got = {(r.doc_l, r.doc_r) for r in audit.near_duplicates(sets.where("split = 'train'"), sets.where("split = 'blind'"), 0.5).collect()}
    made = {(r.split, r.doc): set(r.shingles) for r in sets.collect()}
    want = {
        (a, b) for (s, a), x in made.items() for (t, b), y in made.items() if s == "train" and t == "blind" and len(x & y) >= 0.5 * len(x | y)
    }
    assert got == want and want


def test_length_summary_percentiles(spark):
    for n in (1, 2, 19, 20, 21, 100):
        values = [random.Random(n).randint(0, 50) for _ in range(n)]
        r = profile.length_summary(spark.createDataFrame([(v,) for v in values], "v bigint"), [], F.col("v")).first()
        o = sorted(values)
        assert (r.p50, r.p95, r["min"], r["max"], r["count"]) == (o[(n - 1) // 2], o[int((n - 1) * 0.95)], o[0], o[-1], n)


def test_shards_close_behind_a_document(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randint(1, 40)) for g in "ab" for i in range(200)]
    got = {(r.g, r.i): r.shard for r in pack.shards(spark.createDataFrame(rows, "g string, i bigint, n bigint"), ["g"], ["i"], "n", 100).collect()}
    for g in "ab":
        shard, held = 0, 0
        for _, i, n in [r for r in rows if r[0] == g]:
            assert got[g, i] == shard
            held += n
            if held >= 100:
                shard, held = shard + 1, 0


def test_schedule_equals_the_greedy_merge(spark):
    rng = random.Random(9)
    rows = [(i, "en" if rng.random() < 0.6 else "ru", rng.randint(1, 9)) for i in range(60)]
    weights = {"en": 0.5, "ru": 0.5}
    df = spark.createDataFrame(rows, "id bigint, lang string, t bigint")
    order = {g: [r.id for r in mix.permuted(df.where(F.col("lang") == g), "lang", "id", 1, 2).orderBy("epoch", "pos").collect()] for g in weights}
    got = [r.id for r in mix.schedule(df, "lang", "id", "t", weights, 1, 2).orderBy("position").collect()]
    size, done, at, want = dict((r[0], r[2]) for r in rows), dict.fromkeys(weights, 0), dict.fromkeys(weights, 0), []
    while all(at[g] < len(order[g]) for g in weights):
        g = min(weights, key=lambda g: (done[g] / weights[g], list(weights).index(g)))
        want.append(order[g][at[g]])
        done[g] += size[want[-1]]
        at[g] += 1
    assert got[: len(want)] == want
    assert mix.acknowledged(df.selectExpr("id AS position", "id"), df.where("id < 7").selectExpr("id AS position", "id"), "id").first().resume_at == 7
    assert not mix.acknowledged(df.selectExpr("id AS position", "id"), df.where("id BETWEEN 2 AND 7").selectExpr("id AS position", "id"), "id").first().is_prefix


def test_state_reasons(spark):
    pool = spark.createDataFrame([(i, "a") for i in range(5)], "id bigint, lang string")
    state = mix.permuted(pool, "lang", "id", 1, 1)
    assert mix.state_reasons(state, pool, "lang", "id").count() == 0
    assert mix.state_reasons(state.where("id <> 3"), pool, "lang", "id").first().reason == "missing"
    assert mix.state_reasons(state.withColumn("id", F.lit(1).cast("long")), pool, "lang", "id").first().reason == "repeated"


def test_contiguity_and_reconciliation(spark):
    docs = spark.createDataFrame([(i, 10 * i) for i in range(1, 9)], "doc bigint, n bigint")
    win = pack.windows(docs, F.col("n"), 8)
    assert pack.contiguity(win, "doc").count() == 0
    assert {r.doc for r in pack.contiguity(win.where("NOT (doc = 3 AND chunk_index = 1)"), "doc").collect()} == {3}
    whole = pack.report(win, [], 8)
    assert pack.reconciled(whole, whole.withColumn("chunks", F.col("chunks") + 1), ["chunks", "documents"]).first().field == "chunks"


def test_latest_status(spark):
    rows = [("r", 1, "running", 5, None, None), ("r", 2, "failed", None, "c1", "boom"), ("r", 3, "running", None, None, None), ("r", 4, "running", 9, None, None)]
    df = spark.createDataFrame(rows, "run string, seq bigint, status string, processed_tokens bigint, checkpoint string, error_type string")
    df = df.withColumn("consumed_tokens", F.lit(None).cast("bigint"))
    r = evaluate.latest_status(df, "run", ["seq"], ["processed_tokens", "consumed_tokens", "checkpoint", "error_type"]).first()
    assert (r.status, r.processed_tokens, r.consumed_tokens, r.last_checkpoint, r.error_type) == ("running", 9, 9, "c1", None)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc bigint, n bigint, split string, text string")
    assert pack.report(pack.windows(none, F.col("n"), 8), ["split"], 8).count() == 0
    assert profile.lexical_profile(none, ["split"], "text").count() == 0
    assert audit.near_duplicates(audit.prompt_sets(none, "doc", "text"), audit.prompt_sets(none, "doc", "text")).count() == 0
