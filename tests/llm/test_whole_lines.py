"""Line deduplication of documents without an id, where lines have more candidates than they name."""

from pyspark.sql import functions as F

from skein.llm import lines
from test_near import corpus, removed_by_brute_force


def test_line_dedup_of_null_ids_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lines, "NAMED", 1)
    texts = sorted({t for _, t in corpus() if t})
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string").repartition(3)
    order = [r.text for r in df.orderBy(F.xxhash64("text")).collect()]
    gone = removed_by_brute_force(list(enumerate(order)))
    want = ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in enumerate(order)]
    assert sorted(r.text for r in lines.dedup_lines(df).collect()) == sorted(want)
