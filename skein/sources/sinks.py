"""Sinks: JSON lines, ordered and sharded Parquet, atomic publication, manifests, a resumable journal, a run ledger."""

from __future__ import annotations

import json
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.evaluate import latest_status
from ..operators.ordering import fixed
from ..operators.pack import fixed_shards
from ..policy import ROW_GROUP
from .readers import file_hashes, self_hash


def json_lines(df: DataFrame, path: str) -> None:
    """A line per row; an existing path is refused. Null fields are written, so that lines are of one shape."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def packed_parquet(df: DataFrame, path: str, partitions: list[str] | None = None, block_rows: int = ROW_GROUP) -> None:
    """Parquet with small row groups, as far as bytes can bound them, so that a row is found without reading its file."""
    writer = df.write.mode("errorifexists").option("parquet.block.row.count.limit", str(block_rows))
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(spark: SparkSession, write, path: str) -> None:
    """Calls ``write(stage)`` for a hidden folder beside path, then renames it; an existing path is refused."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    stage = f"{path.rstrip('/').rpartition('/')[0]}/.stage-{uuid.uuid4().hex}"
    try:
        write(stage)
        if fs.exists(target) or not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(stage), target):
            raise FileExistsError(path)
    finally:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(stage), True)


def write_manifest(spark: SparkSession, path: str, body: dict, key: str = "manifest_sha256") -> dict:
    """One JSON object with the hash of its body; an existing path is refused."""
    made = body | {key: self_hash(body)}
    text = json.dumps(made, ensure_ascii=False, sort_keys=True)
    publish(spark, lambda stage: spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(stage), path)
    return made


def subset(df: DataFrame, path: str, source_manifest: dict, spark: SparkSession) -> dict:
    """A subset of a corpus with a manifest that names its source."""
    publish(spark, lambda stage: json_lines(df, stage), path)
    return write_manifest(spark, f"{path}.manifest", {"provenance": "smoke_subset", "source": source_manifest.get("manifest_sha256"), "rows": df.count()})


class Journal:
    """A ledger of committed shards: a run that is started again writes those that are missing and replays none.

    Shards are folders ``shard=<n>``; a committed one has a line in the journal with the rows, tokens and file hashes it had. Shards
    are written and committed some at a time, ``together`` in one job, so that the source is not read once per shard.
    """

    SCHEMA = "shard bigint, rows bigint, tokens bigint, counted string, files array<string>"

    def __init__(self, spark: SparkSession, root: str, together: int = 64):
        self.spark, self.root, self.together = spark, root.rstrip("/"), together

    def committed(self) -> DataFrame:
        fs, p = _fs(self.spark, f"{self.root}/journal")
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).json(f"{self.root}/journal")

    def _found(self, shards: list[int], tokens: str) -> DataFrame:
        """(shard, rows, tokens, files) as they are on disk."""
        folders = [f"{self.root}/shards/shard={n}" for n in shards]
        rows = self.spark.read.option("basePath", f"{self.root}/shards").parquet(*folders)
        counts = rows.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("rows"), F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("tokens"))
        files = file_hashes(self.spark, folders, "*.parquet")
        files = files.groupBy(F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("long").alias("shard")).agg(F.sort_array(F.collect_list("sha256")).alias("files"))
        return counts.join(files, "shard")

    def _present(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/shards")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[6:]) for n in names if n.startswith("shard="))

    def verify(self) -> list[int]:
        """Committed shards; one whose files or counters are not those of its commit is an error. Folders without a commit are deleted."""
        commits = self.committed()
        done = {r.shard: r.counted for r in commits.select("shard", "counted").collect()}
        present = self._present()
        for n in present:
            if n not in done:
                fs, p = _fs(self.spark, f"{self.root}/shards/shard={n}")
                fs.delete(p, True)
        if lost := sorted(set(done) - set(present)):
            raise ValueError(f"shard {lost[0]} differs from its commit")
        for counted in sorted(set(done.values())):
            mine = sorted(n for n, c in done.items() if c == counted)
            found = self._found(mine, counted).select("shard", *[F.col(c).alias(f"__{c}") for c in ("rows", "tokens", "files")])
            same = (F.col("rows") == F.col("__rows")) & (F.col("tokens") == F.col("__tokens")) & (F.sort_array("files") == F.col("__files"))
            both = commits.where(F.col("counted") == counted).join(found, "shard", "left")
            bad = both.where(~F.coalesce(same, F.lit(False))).agg(F.min("shard").alias("n")).first().n
            if bad is not None:
                raise ValueError(f"shard {bad} differs from its commit")
        return sorted(done)

    def write(self, df: DataFrame, tokens: str, shard: str = "shard", stop_after: int | None = None) -> int:
        """Writes the shards of df that are not committed; returns how many were. A shard's rows are one task's, and one file."""
        done = set(self.verify())
        left = [r[0] for r in df.select(shard).distinct().orderBy(shard).collect() if r[0] not in done][:stop_after]
        for i in range(0, len(left), self.together):
            block = left[i : i + self.together]
            rows = df.where(F.col(shard).isin(block)).withColumnRenamed(shard, "shard").repartition("shard")
            rows.write.mode("append").partitionBy("shard").parquet(f"{self.root}/shards")
            commit = self._found(block, tokens).withColumn("counted", F.lit(tokens))
            commit.coalesce(1).write.mode("append").json(f"{self.root}/journal")
        return len(left)


def sharded(spark: SparkSession, df: DataFrame, root: str, by: list[str], order: list[str], tokens: str, most: int, reserve: int = 0) -> int:
    """Numbers shards within groups, in order, and writes those that are not committed yet; refuses a disk without its reserve.

    Shards of all groups are numbered through, by group, so that a shard holds one group only. Returns how many were written.
    """
    if not enough_disk(spark, root, reserve):
        raise OSError(f"{root}: less than {reserve} bytes would stay free")
    # cut once: a second reading of the source must not move a border
    cut = fixed(fixed_shards(df, by, order, tokens, most))
    sizes = cut.groupBy(*by).agg((F.max("shard") + 1).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.struct(*by).alias("__by"), before.alias("__start"))
    rows = cut.withColumn("__by", F.struct(*by)).join(starts, "__by").withColumn("shard", F.col("shard") + F.col("__start"))
    return Journal(spark, root).write(rows.drop("__by", "__start"), tokens)


class Ledger:
    """Append-only run log and its latest state."""

    SCHEMA = (
        "run string, at timestamp, seq bigint, status string, processed_tokens bigint, consumed_tokens bigint, checkpoint string, "
        "error_type string, error_message string, failure_record string, metrics map<string,double>"
    )
    FIELDS = ["processed_tokens", "consumed_tokens", "checkpoint", "error_type", "error_message", "failure_record"]

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/events"

    def append(self, run: str, seq: int, **fields) -> None:
        names = [f.strip().split()[0] for f in self.SCHEMA.replace("map<string,double>", "map").split(",")]
        row = {"run": run, "seq": seq} | fields
        if unknown := set(row) - set(names):
            raise ValueError(f"unknown ledger fields {sorted(unknown)}")
        df = self.spark.createDataFrame([tuple(row.get(n) for n in names)], self.SCHEMA).withColumn("at", F.coalesce("at", F.current_timestamp()))
        df.coalesce(1).write.mode("append").json(self.path)

    def failure(self, run: str, seq: int, error: BaseException) -> str:
        """A failed status with a record of its own name."""
        record = uuid.uuid4().hex
        self.append(run, seq, status="failed", error_type=type(error).__name__, error_message=str(error), failure_record=record)
        return record

    def events(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).json(self.path)

    def status(self) -> DataFrame:
        return latest_status(self.events(), "run", ["seq"], self.FIELDS)


def enough_disk(spark: SparkSession, path: str, reserve: int) -> bool:
    """Whether the file system that holds path keeps ``reserve`` bytes free, local or not."""
    fs, p = _fs(spark, path)
    return fs.getStatus(p).getRemaining() >= reserve


def copy_bundle(source: str, target: str, expected: dict[str, str]) -> None:
    """Copies a small bundle of files whose hashes are expected; verifies before and after, refuses an existing target."""
    import hashlib

    def check(folder: str) -> None:
        found = {n: hashlib.sha256(open(os.path.join(folder, n), "rb").read()).hexdigest() for n in sorted(os.listdir(folder))}
        if found != expected:
            raise ValueError(f"{folder}: files differ from the bundle's manifest")

    check(source)
    if os.path.exists(target):
        raise FileExistsError(target)
    stage = f"{target}.stage-{uuid.uuid4().hex}"
    shutil.copytree(source, stage)
    check(stage)
    os.rename(stage, target)


def report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
