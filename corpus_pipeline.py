"""A training-data pipeline in five stages, each an operator of skein.llm on all that the stage before it kept.

The stages' models learn from labelled rows of the tables in sf_dir; a stage's decisions cover every row of its docs. A document
that loses all its lines to line deduplication is a copy and goes.

Defined cases: a null or empty text scores as the share of good labels and fails the rules' base check; repeated rows of one id are
one document, of which line and near deduplication keep one; null ids are allowed, and go first; other columns are carried along by
all stages but the last, whatever their names; n_chars, where it is there, follows the text; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import lines, packing, quality, rules, simhash
from skein.llm.common import documents, fresh, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.fit(documents(spark, sf_dir), _labels(spark, sf_dir)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept(docs, rules.fit(documents(spark, sf_dir), _labels(spark, sf_dir)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_lines, n_removed = fresh(docs.columns, "lines", "removed")
    left = lines.dedup_lines(docs, counts=(n_lines, n_removed))
    left = left.where((F.col(n_removed) == 0) | F.col("text").rlike(rules.WORD))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, find=simhash.near_copies)


def power_of_two_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [(f.__name__, f) for f in (quality_classifier, quality_rules, line_dedup, simhash_near_dedup, power_of_two_packing)]

#: Trained models and a similarity join are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
