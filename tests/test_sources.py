import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators import pack
from skein.sources import readers, sinks
from skein.streaming import logs

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA)
    sinks.json_lines(df, str(tmp_path / "x"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.json_lines(df, str(tmp_path / "x"))
    assert readers.json_lines(spark, str(tmp_path / "x"), SCHEMA).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": 1, "t": "a"}\n{broken\n')
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), SCHEMA).collect()
    assert readers.json_lines(spark, str(tmp_path / "bad.jsonl"), SCHEMA, strict=False).cache().where("_corrupt_record IS NOT NULL").count() == 1
    digest = hashlib.sha256((tmp_path / "bad.jsonl").read_bytes()).hexdigest()
    assert readers.file_hashes(spark, str(tmp_path), "bad.jsonl").first().sha256 == digest
    assert readers.streamed_hashes(spark.createDataFrame([(str(tmp_path / "bad.jsonl"),)], "path string")).first().sha256 == digest
    with pytest.raises(ValueError, match="hash"):
        readers.verified_json_lines(spark, str(tmp_path / "bad.jsonl"), SCHEMA, "0")


def test_publish_and_manifest(spark, tmp_path):
    path = str(tmp_path / "out" / "m")
    (tmp_path / "out").mkdir()
    body = sinks.write_manifest(spark, path, {"rows": 3})
    assert readers.manifest(spark, path) == body
    with pytest.raises(FileExistsError):
        sinks.write_manifest(spark, path, {"rows": 4})


def test_journal_resumes_without_repeats(spark, tmp_path):
    docs = spark.createDataFrame([(i, 10 + i) for i in range(20)], "doc bigint, n bigint")
    rows = pack.shards(docs.withColumn("g", F.lit(1)), ["g"], ["doc"], "n", 60)
    journal = sinks.Journal(spark, str(tmp_path / "j"))
    assert journal.write(rows, "n", stop_after=2) == 2
    (tmp_path / "j/shards/shard=99").mkdir()  # what a lost run leaves
    later = sinks.Journal(spark, str(tmp_path / "j"))
    assert later.write(rows, "n") == rows.select("shard").distinct().count() - 2
    assert not (tmp_path / "j/shards/shard=99").exists()
    assert spark.read.parquet(str(tmp_path / "j/shards")).count() == 20
    assert later.write(rows, "n") == 0


def test_ledger(spark, tmp_path):
    ledger = sinks.Ledger(spark, str(tmp_path / "l"))
    ledger.append("r", 1, status="running", processed_tokens=4)
    ledger.failure("r", 2, ValueError("no"))
    assert ledger.status().first().error_type == "ValueError"
    ledger.append("r", 3, status="running", checkpoint="c")
    r = ledger.status().first()
    assert (r.status, r.error_type, r.consumed_tokens, r.last_checkpoint) == ("running", None, 4, "c")
    with pytest.raises(ValueError, match="unknown"):
        ledger.append("r", 4, nonsense=1)


def test_capped_skips_and_goes_on(spark):
    df = spark.createDataFrame([(1, "aaa"), (2, "bbbbbb"), (3, "cc")], "id bigint, t string")
    assert [r.id for r in readers.capped(df, ["id"], "t", 5).orderBy("id").collect()] == [1, 3]


def test_prompt_set(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"prompt": "a", "lang": "en"}]')
    assert readers.prompt_set(spark, str(tmp_path / "p.json")).count() == 1
    (tmp_path / "q.json").write_text('[{"prompt": " ", "lang": "en"}]')
    with pytest.raises(Exception, match="a prompt needs"):
        readers.prompt_set(spark, str(tmp_path / "q.json")).collect()


def test_bundle(tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/f").write_bytes(b"x")
    sinks.copy_bundle(str(tmp_path / "b"), str(tmp_path / "c"), {"f": hashlib.sha256(b"x").hexdigest()})
    with pytest.raises(ValueError, match="differ"):
        sinks.copy_bundle(str(tmp_path / "b"), str(tmp_path / "d"), {"f": "0"})
    with pytest.raises(RuntimeError):
        readers.retired("snapshot")


def test_resumable_stream_equals_one_run(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    schema = "doc bigint, n bigint"
    for part in (range(0, 5), range(5, 12)):
        spark.createDataFrame([(i, 9 * i) for i in part], schema).write.mode("append").parquet(src)
        stream = logs.token_windows(spark.readStream.schema(schema).parquet(src), "n", 16)
        logs.resumable(stream, out, check).awaitTermination()
    once = pack.windows(spark.read.parquet(src), F.col("n"), 16)
    assert spark.read.parquet(out).count() == once.count()


def test_streaming_dedup_and_latest(spark, tmp_path):
    schema = "k string, at timestamp, v bigint"
    rows = spark.createDataFrame([("a", "2020-01-01 00:00:00", 1), ("a", "2020-01-01 00:00:05", None), ("b", "2020-01-01 00:00:01", 3)], "k string, at string, v bigint")
    rows.selectExpr("k", "CAST(at AS timestamp) AS at", "v").coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "s"))
    q = logs.latest(stream, "k", "at", ["v"]).writeStream.outputMode("complete").format("memory").queryName("latest").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.k: r.v for r in spark.table("latest").collect()} == {"a": 1, "b": 3}
    q = logs.deduplicated(stream, ["k"], "at", "1 minute").writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("deduped").count() == 2
