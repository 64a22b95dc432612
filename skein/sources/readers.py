"""Sources: JSON lines with a schema and rejects, hashed files, manifests, configuration, capped and prompt sources."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of a file hash that one worker reads at a time.
CHUNK = 8 << 20


def json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Records of JSON lines by an explicit schema. Strict: a malformed line fails the read; else it is a row with _corrupt_record."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def file_hashes(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of files, each read whole by one task; use streamed_hashes for files beyond a task's memory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def streamed_hashes(paths: DataFrame) -> DataFrame:
    """(path, sha256) of a table of paths on a mounted file system, read in chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p in batch["path"]:
                digest = hashlib.sha256()
                with open(p.removeprefix("file:"), "rb") as f:
                    while part := f.read(CHUNK):
                        digest.update(part)
                out.append(digest.hexdigest())
            yield pd.DataFrame({"path": batch["path"], "sha256": out})

    return paths.select("path").mapInPandas(run, "path string, sha256 string")


def verified_json_lines(spark: SparkSession, path: str, schema: T.StructType, sha256: str) -> DataFrame:
    """As json_lines, of one file whose hash must be the declared one."""
    found = {r.sha256 for r in file_hashes(spark, path).limit(2).collect()}
    if found != {sha256}:
        raise ValueError(f"{path}: the file's hash is not the declared one")
    return json_lines(spark, path, schema)


def manifest(spark: SparkSession, path: str, key: str = "manifest_sha256") -> dict:
    """A JSON object whose field ``key`` is the hash of the rest."""
    text = "\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).collect())
    body = json.loads(text)
    declared = body.pop(key, None)
    if declared != self_hash(body):
        raise ValueError(f"{path}: the manifest does not hash to its {key}")
    return body | {key: declared}


def self_hash(body: dict) -> str:
    return hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True).encode()).hexdigest()


def configuration(path: str) -> dict:
    """A YAML mapping, read on the driver."""
    try:
        import yaml
    except ImportError as e:  # a gate: the engine runs without it
        raise RuntimeError("reading YAML needs PyYAML; a JSON configuration is read by json_configuration") from e
    with open(path, encoding="utf-8") as f:
        made = yaml.safe_load(f)
    if not isinstance(made, dict):
        raise ValueError(f"{path}: a configuration is a mapping")
    return made


def json_configuration(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    if not isinstance(made, dict):
        raise ValueError(f"{path}: a configuration is a mapping")
    return made


def capped(df: DataFrame, order: list[str], text: str, most_chars: int, by: list[str] | None = None) -> DataFrame:
    """Rows in order while they fit a budget of characters: a row that would exceed it is skipped and takes nothing.

    The decision depends on all before it: only keys and lengths go through one ordered stream per group, and the rows that it
    takes are joined back.
    """
    by = by or []
    keys = df.select(*by, *order, F.length(text).alias("__n"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields)
    names = [*by, *order]

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, used = None, 0
        for batch in batches:
            keep = []
            for row in batch.itertuples(index=False, name=None):
                if row[: len(by)] != group:
                    group, used = row[: len(by)], 0
                fits = used + int(row[-1]) <= most_chars
                used += int(row[-1]) if fits else 0
                keep.append(fits)
            yield batch[keep]

    dealt = keys.repartition(*by) if by else keys.coalesce(1)
    return df.join(dealt.sortWithinPartitions(*names).mapInPandas(take, schema).drop("__n"), names, "left_semi")


def prompt_set(spark: SparkSession, path: str) -> DataFrame:
    """(prompt, lang) of a JSON list; blank prompts and unknown fields are errors."""
    schema = T.StructType([T.StructField("prompt", T.StringType()), T.StructField("lang", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    bad = F.coalesce(F.btrim("prompt") == "", F.lit(True)) | F.coalesce(F.btrim("lang") == "", F.lit(True))
    return rows.where(F.when(bad, F.raise_error(F.lit("a prompt needs a text and a language")).cast("boolean")).otherwise(True))


def label_metadata(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the labels and the named provenance columns of packed Parquet: the other arrays are not read."""
    return spark.read.parquet(path).select("labels", *columns)


def row_at(spark: SparkSession, path: str, row_id: int, column: str = "row_id") -> DataFrame:
    """One packed row by its stored number; row groups of other numbers are skipped by their statistics."""
    return spark.read.parquet(path).where(F.col(column) == row_id)


def retired(name: str) -> None:
    """External text sources are not admitted."""
    raise RuntimeError(f"{name}: external text sources are unavailable by policy")
