"""What a task reads at once does not follow the reader's default number of rows."""

from skein.llm import common, lines, rules


def batches_read(df):
    rows = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    while "numInputBatches" not in plan.metrics().keySet().mkString(" "):
        plan = plan.children().head()
    return rows, plan.metrics().apply("numInputBatches").value()


def test_line_dedup_reads_texts_in_small_batches(spark, tmp_path):
    # what is read at once is on the heap of every task, twice while its arrays grow
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 30) AS text")
    docs.write.parquet(f"{tmp_path}/docs")
    lines.dedup_lines(spark.read.parquet(f"{tmp_path}/docs").limit(10))
    rows, batches = batches_read(spark.read.parquet(f"{tmp_path}/docs").selectExpr("doc_id", "length(text) AS n"))
    assert rows == 2000 and batches >= rows / common.READ_ROWS


def test_quality_rules_alone_read_texts_in_small_batches(spark, tmp_path):
    # a stage may be the first of its session, so that no other one has set the size
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 30) AS text")
    docs.write.parquet(f"{tmp_path}/docs")
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    rules.kept(spark.read.parquet(f"{tmp_path}/docs"), rules.DecisionList())
    rows, batches = batches_read(spark.read.parquet(f"{tmp_path}/docs").selectExpr("doc_id", "length(text) AS n"))
    assert rows == 2000 and batches >= rows / common.READ_ROWS
