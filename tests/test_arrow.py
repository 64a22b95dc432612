"""What a Python worker holds follows neither the rows of a batch nor the size of a table."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skein.functions import arrow, tokens
from skein.functions import windows as wn


def test_batches_returned_are_bounded_and_whole(spark):
    half = arrow.ROUND // 2
    parts = list(arrow.in_rounds(((np.zeros(n, np.int32), n) for n in (half, half, half, 3 * arrow.ROUND, 1)), pa.list_(pa.int32())))
    assert [[len(x) for x in p] for p in parts] == [[half, half], [half], [3 * arrow.ROUND], [1]]
    texts = ["ab" * half, "c", None, "d" * half, ""]
    rows = list(tokens.contents_encoder(tokens.ByteTokenizer).func(iter([pa.array([[t] for t in texts] + [None])])))
    assert [len(x) for x in rows] == [1, 5]
    assert [None if x is None else len(x[0]) for r in rows for x in r.to_pylist()] == [2 * half, 1, 0, half, 0, None]
    coded = list(tokens.encoder(tokens.ByteTokenizer).func(iter([pa.array(["x" * half] * 5 + [" "])])))
    assert [len(x) for x in coded] == [2, 2, 2]
    back = list(tokens.decoder(tokens.ByteTokenizer, {}).func(x.field("ids") for x in coded))
    assert [t for x in back for t in x.to_pylist()] == ["x" * half] * 5 + [None]


def test_spark_sends_small_batches_and_long_texts_stay_whole(spark):
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    rows = spark.range(0, 60, 1, 2).select("id", F.expr("CASE WHEN id = 7 THEN repeat('é', 3000000) WHEN id <> 8 THEN repeat('word ', 20000) END").alias("t"))
    rows = rows.withColumn("ids", wn.byte_ids(F.col("t")))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= arrow.BATCH_BYTES
    got = {r.id: (r.n, r.s) for r in rows.select("id", F.size("ids").alias("n"), F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("s")).collect()}
    want = lambda b: (len(b), sum(b) + 19 * len(b))
    assert len(got) == 60 and got[7] == want("é".encode() * 3_000_000) and got[8] in ((-1, None), (None, None))
    assert {v for k, v in got.items() if k not in (7, 8)} == {want(b"word " * 20_000)}
