"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, counts, fingerprints, language, lines, packing, quality, rules, simhash
from .common import documents, release, written


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir), counts=("n_lines", "n_removed")).select("doc_id", "n_lines", "n_removed", "text")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = rows.unionByName(more).withColumn("content", chat.text_part(F.col("text")))
    done = chat.format_chats(turns).withColumns(
        {"back": chat.read_back(F.col("formatted")), "loss": chat.under_loss(F.col("formatted"), F.col("masked"))}
    )
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rules.judge(docs, rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op6_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.fit(docs))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    distances = written(fingerprints.edit_distances(documents(spark, sf_dir)), "distances")
    release(spark)
    return fingerprints.with_groups(distances, fingerprints.SEARCH_BLOCKS, radius=fingerprints.SEARCH_RADIUS)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_line_dedup,
        op3_chat_format,
        op4_quality_rules,
        op5_power_of_two_packing,
        op6_simhash_covering,
        op7_token_counts,
        op8_language_id,
        op9_fingerprints,
        op10_quality_classifier,
    )
}

ORACLE_SQL = {
    # The template adds 2 + 3 code points around a role and 9 behind a turn; texts here hold no "<|", "<\" or "<" at their end
    # unless they are counted.
    "op3_chat_format": r"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(5 + length(role) + length(text) + 9 + length(regexp_replace(text, '[^<]', '', 'g'))
           - length(regexp_replace(regexp_replace(text, '<([|\\]|$)', chr(1), 'g'), '[^<]', '', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""",
}
