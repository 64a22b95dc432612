"""What the operators of this package share: bounded Arrow batches, broadcast files and written intermediate tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of one Arrow batch, so that a worker's memory does not follow the length of the texts.
BATCH_ROWS, BATCH_BYTES = 20_000, 4 << 20
#: Rows of a batch of Spark's Parquet reader, which holds them on the heap whatever their length (its default of 4096 is for numbers).
READ_ROWS = 256
#: Texts of one round inside a worker hold at most this many characters, or are one text.
ROUND_CHARS = 1 << 20
#: A worker's memo of pieces is emptied beyond this many entries.
MEMO_ENTRIES = 250_000


def bounded_batches(spark: SparkSession) -> None:
    """Python operators of this session exchange small Arrow batches, and Parquet is read in small ones, from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READ_ROWS))


def file_bytes(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file as read by the driver; ``most`` proves the bound of what is broadcast."""
    with open(path, "rb") as f:
        data = f.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} has more than {most} bytes")
    return data


def rounds(texts: list[str], most: int = ROUND_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts that hold at most ``most`` characters, or one text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame, columns: list[str], text_col: str, schema: str, make: Callable[[], Callable[[list[str]], dict[str, pa.Array]]]
) -> DataFrame:
    """``columns`` of df as they are, and what ``make()(texts)`` returns for each bounded round of texts (null: empty).

    One output row per input row, without a shuffle; ``make`` runs once per task.
    """
    bounded_batches(df.sparkSession)
    names = [x.strip().split()[0].strip("`") for x in schema.split(",")]
    kept = df.select(*[F.col(f"`{c}`") for c in columns], *[] if text_col in columns else [F.col(f"`{text_col}`").alias("__text")])
    at = columns.index(text_col) if text_col in columns else len(columns)
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[: len(columns)]] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            for a, b in rounds(texts):
                made = of(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(len(columns))] + [made[n] for n in names], [*columns, *names]
                )

    return kept.mapInArrow(run, out)


def fresh(names: list[str], *wanted: str) -> list[str]:
    """Names of helper columns that none of ``names`` has, whatever its case."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str, did_col: str, tie_col: str) -> DataFrame:
    """docs with two longs that tell documents apart: the id (a hash of one that is no whole number), and where ids repeat a hash of the text."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    did = F.col(f"`{id_col}`")
    did = did.cast("long") if whole else F.when(did.isNotNull(), F.xxhash64(did.cast("string")))
    tie = F.xxhash64(F.col(f"`{text_col}`"))
    # texts are read only where ids repeat
    unique = docs.groupBy(did.alias("did")).count().where("count > 1").isEmpty()
    if not unique:
        ids = docs.select(did.alias("did"), tie.alias("tie")).groupBy("did").agg((F.min("tie") != F.max("tie")).alias("differ"))
        unique = ids.where("differ").isEmpty()
    return docs.withColumns({did_col: did, tie_col: F.lit(0).cast("long") if unique else tie})


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; a local default in local mode only."""
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "/tmp/checkpoints/skein"
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def written(df: DataFrame, what: str = "step") -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage is cut, and any executor can read it again.

    What drop_written does not delete before goes when the driver's session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skein-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files of ``written``; df must not be read any more."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets the driver notice plans that are gone, so that Spark deletes their shuffle files before the next large step."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
