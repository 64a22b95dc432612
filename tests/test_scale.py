"""Order, sums and sinks that no single task holds, and what users register."""

import random

import pytest
from pyspark.sql import functions as F

from skein.functions import tokens
from skein.operators import audit, mix, ordering, pack, profile, registry, verify
from skein.sources import readers, sinks


def test_places_and_sums_of_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randint(0, 9)) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, id bigint, n bigint").repartition(7)
    got = {r.id: (r.position, r.before) for r in ordering.placed(df, ["g"], ["id"], amount="n").collect()}
    for g in ("a", "b", None):
        total = 0
        for place, (_, i, n) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1])):
            assert got[i] == (place, total)
            total += n
    assert len(got) == 500
    assert ordering.placed(df.where("false"), ["g"], ["id"], amount="n").count() == 0
    assert [r.id for r in mix.within_budget(df.where("g = 'b'"), ["id"], "n", 1).orderBy("id").collect()][0] == min(r[1] for r in rows if r[0] == "b")


def test_places_of_one_hot_group_are_dealt_to_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), "id", F.lit(1).alias("n"))
    # small ranges are joined at run time, which would leave one here
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = ordering.placed(df, ["g"], ["id"], amount="n")
        assert rows.where("position <> id OR before <> id").count() == 0
        sizes = df.repartitionByRange("g", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("n")).first().n
        assert sizes < 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sharded_sink(spark, tmp_path):
    rows = spark.createDataFrame([(g, i, 7) for g in ("x", "y") for i in range(30)], "g string, id bigint, n bigint")
    root = str(tmp_path / "out")
    (tmp_path / "out").mkdir()
    with pytest.raises(OSError):
        sinks.sharded(spark, rows, root, ["g"], ["id"], "n", 70, reserve=1 << 60)
    assert sinks.sharded(spark, rows, root, ["g"], ["id"], "n", 70) == 6
    back = spark.read.parquet(f"{root}/shards")
    assert sorted(r["count"] for r in back.groupBy("shard", "g").count().collect()) == [10] * 6
    assert sinks.sharded(spark, rows, root, ["g"], ["id"], "n", 70) == 0
    journal = sinks.Journal(spark, root)
    assert {(r.rows, r.tokens) for r in journal.committed().collect()} == {(10, 70)}
    back.where("shard = 3").drop("shard").limit(4).cache().write.mode("append").parquet(f"{root}/shards/shard=3")
    with pytest.raises(ValueError, match="shard 3"):
        journal.verify()


def test_packed_files_are_read_in_part(spark, tmp_path):
    rows = spark.createDataFrame([(i, [i, -100], "p") for i in range(9)], "row_id bigint, labels array<int>, origin string")
    sinks.packed_parquet(rows, str(tmp_path / "p"))
    assert readers.label_metadata(spark, str(tmp_path / "p"), ["origin"]).columns == ["labels", "origin"]
    assert readers.row_at(spark, str(tmp_path / "p"), 4).first().labels == [4, -100]
    manifest = sinks.subset(rows.limit(2), str(tmp_path / "s"), {"manifest_sha256": "m"}, spark)
    assert (manifest["rows"], manifest["source"]) == (2, "m")
    sinks.report(rows.agg(F.count("*").alias("n")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().n == 9
    assert [r.row_id for r in audit.first_n(rows, F.col("row_id") > 2, ["row_id"], 2).collect()] == [3, 4]


def test_batches_are_trimmed(spark):
    rows = spark.createDataFrame([(0, [1, 2, 3], [1, 0, 0]), (0, [4, 5, 3], [1, 1, 0]), (1, [6, 3, 3], [1, 0, 0])], "b int, input_ids array<int>, attention_mask array<int>")
    got = pack.trimmed_batches(rows, "b", ["input_ids", "attention_mask"])
    assert sorted((r.b, r.input_ids) for r in got.collect()) == [(0, [1, 2]), (0, [4, 5]), (1, [6])]


def test_registered_verifiers_are_asked_first(spark):
    task = "struct<kind:string,operation:string,scenario:string,language:string,text:string>"
    rows = spark.createDataFrame([(("parrot", None, None, "en", "a"), "a", "any"), (("parrot", None, None, "en", "a"), "b", "any")], f"task {task}, answer string, answer_verifier string")
    registry.register_verifier("parrot", lambda t: t["text"])
    try:
        assert rows.select(registry.expected().alias("e")).first().e == "a"
        assert [r.r for r in rows.select(F.when(registry.has_verifier(), registry.registered_reason()).alias("r")).collect()] == [None, "answer"]
    finally:
        del registry.VERIFIERS["parrot"]
    assert verify.first_reason(a=F.lit(True)) is not None


def test_tokenizer_files(spark):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    encode = tokens.encoder(lambda: tokens.FileTokenizer(path))
    rows = spark.createDataFrame([("Plain words, 12.5 kg.",), (" ",), ("<|user|> x",)], "t string").select("t", encode(F.col("t")).alias("e"))
    first, blank, control = rows.collect()
    assert first.e.reason is None and tokens.FileTokenizer(path).decode(first.e.ids) == first.t and min(first.e.ids) >= 19
    assert (blank.e.reason, control.e.reason) == ("blank", "control_literal")
    chats = spark.createDataFrame([([("user", "hi there"), ("assistant", "yes")],), ([("robot", "x")],)], "m array<struct<role:string,content:string>>")
    good, bad = [r.i for r in chats.select(tokens.chat_ids(F.col("m"), tokens.contents_encoder(lambda: tokens.FileTokenizer(path))).alias("i")).collect()]
    made = tokens.FileTokenizer(path)
    assert good == [1, 6, *made.encode("hi there"), 2, 7, *made.encode("yes"), 2] and bad is None


def test_maps_by_key(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "x string")
    assert list(profile.counted_map(rows, "x").first().counts.items()) == [("a", 1), ("b", 2)]
