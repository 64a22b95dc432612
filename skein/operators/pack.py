"""Isolated document windows, packed rows, their reports, shards and admission."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import attention_mask, labels, packed_reject, pad, target_count, trimmed, window_ranges, wrap
from ..policy import GENERATOR_VERSION, SHARD_SLOTS, VERIFIER_VERSION, WINDOW_SEMANTICS
from .ordering import numbered, placed
from .verify import first_reason

RANGE = ["chunk_index", "chunk_count", "token_start", "token_end", "is_final_document_window"]


def windows(df: DataFrame, n_tokens: Column, length: int) -> DataFrame:
    """df's columns, RANGE and document_token_count: a row per window; documents without tokens have none."""
    rows = df.withColumn("document_token_count", n_tokens.cast("long"))
    rows = rows.withColumn("__w", F.explode(window_ranges(F.col("document_token_count"), length)))
    w = ["chunk_index", "chunk_count", "token_start", "token_end", "final"]
    return rows.select(*[c for c in rows.columns if c != "__w"], *[F.col(f"__w.{a}").alias(b) for a, b in zip(w, RANGE)])


def packed_rows(df: DataFrame, ids: str, length: int) -> DataFrame:
    """A row per window: RANGE, input_ids, labels, attention_mask and target_tokens, besides df's columns without ids."""
    rows = df.withColumn("document_token_count", F.size(ids).cast("long"))
    # each window is cut out before the windows are rows: a row holds its own ids, not those of its document
    cut = F.transform(
        window_ranges(F.col("document_token_count"), length),
        lambda w: F.struct(
            *[w[a].alias(b) for a, b in zip(["chunk_index", "chunk_count", "token_start", "token_end", "final"], RANGE)],
            pad(wrap(F.slice(ids, (w["token_start"] + 1).cast("int"), (w["token_end"] - w["token_start"]).cast("int")), w["final"]), length).alias("input_ids"),
        ),
    )
    rows = rows.select(*[c for c in rows.columns if c != ids], F.inline(cut))
    rows = rows.withColumn("labels", labels(F.col("input_ids"))).withColumn("attention_mask", attention_mask(F.col("input_ids")))
    return rows.withColumn("target_tokens", target_count(F.col("labels")))


def report(win: DataFrame, by: list[str], length: int) -> DataFrame:
    """Token accounting of windows: one aggregate, per group or over all."""
    body, final = F.col("token_end") - F.col("token_start"), F.col("is_final_document_window").cast("long")
    out = win.groupBy(*by).agg(
        F.sum(final).alias("documents"),
        F.count("*").alias("chunks"),
        F.coalesce(F.sum(body), F.lit(0)).alias("body_tokens"),
        F.count("*").alias("bos_tokens"),
        F.sum(final).alias("eod_tokens"),
        F.sum(body + 1 + final).alias("input_tokens"),
        F.sum(body + final).alias("supervised_target_tokens"),
        F.sum(F.lit(length) - (body + 1 + final)).alias("padded_slots"),
    )
    return out.withColumn("packing_efficiency", F.col("input_tokens") / (F.col("chunks") * length))


def reconciled(recounted: DataFrame, declared: DataFrame, fields: list[str]) -> DataFrame:
    """(field, declared, recounted) where two one-row tables differ."""

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("long").alias(name)) for f in fields])
        return df.select(F.explode(pairs).alias("x")).select("x.*")

    both = long(declared, "declared").join(long(recounted, "recounted"), "field", "full_outer")
    return both.where(~F.col("declared").eqNullSafe(F.col("recounted")))


def cross_foot(by_language: DataFrame, whole: DataFrame, field: str = "supervised_target_tokens") -> DataFrame:
    """One row: whether the groups' totals add up to the whole."""
    return by_language.agg(F.sum(field).alias("groups")).crossJoin(whole.agg(F.sum(field).alias("whole"))).withColumn("equal", F.col("groups").eqNullSafe(F.col("whole")))


def contiguity(win: DataFrame, doc: str, provenance: list[str] | None = None) -> DataFrame:
    """(doc, reason) of documents whose windows do not cover them once and in order."""
    w = Window.partitionBy(doc).orderBy("chunk_index")
    identity = F.struct(*[F.col(c) for c in ["document_token_count", "chunk_count", *(provenance or [])]])
    rows = win.withColumns(
        {
            "__n": F.row_number().over(w) - 1,
            "__before": F.coalesce(F.lag("token_end").over(w), F.lit(0)),
            "__same": F.coalesce(F.lag(identity).over(w) == identity, F.lit(True)),
            "__last": F.lead("chunk_index").over(w).isNull(),
        }
    )
    reason = (
        F.when(F.col("__n") != F.col("chunk_index"), "index")
        .when(F.col("token_start") != F.col("__before"), "offset")
        .when(F.col("token_end") <= F.col("token_start"), "empty")
        .when(~F.col("__same"), "provenance")
        .when(F.col("is_final_document_window") != (F.col("chunk_index") == F.col("chunk_count") - 1), "final")
        .when(F.col("__last") & ((F.col("chunk_index") != F.col("chunk_count") - 1) | (F.col("token_end") != F.col("document_token_count"))), "incomplete")
    )
    return rows.select(doc, reason.alias("reason")).where("reason IS NOT NULL").groupBy(doc).agg(F.min("reason").alias("reason"))


def row_reasons(rows: DataFrame, length: int) -> DataFrame:
    """rows with reject_reason of packed rows: ids, then what is derived from them, then the window's place in its document."""
    c = F.col
    body = target_count(c("labels")) - c("is_final_document_window").cast("int")
    last = c("chunk_index") == c("chunk_count") - 1
    made = first_reason(
        labels=c("labels") == labels(c("input_ids")),
        mask=c("attention_mask") == attention_mask(c("input_ids")),
        index=c("chunk_index").between(0, c("chunk_count") - 1),
        offset=(c("token_start") >= 0) & (c("token_start") < c("token_end")) & (c("token_end") <= c("document_token_count")),
        targets=c("token_end") == c("token_start") + body,
        last=c("is_final_document_window") == last,
        tail=last == (c("token_end") == c("document_token_count")),
    )
    return rows.withColumn("reject_reason", F.coalesce(packed_reject(c("input_ids"), c("is_final_document_window"), length), made))


#: Columns of a packed row that repeat its family's, and those that hold a SHA-256 in hexadecimal.
FAMILY_FIELDS = ("split", "language", "functional_family", "template_family", "scenario_family")
HASH_FIELDS = ("task_sha256", "text_sha256", "functional_signature")


def provenance_reasons(rows: DataFrame, families: DataFrame, split: str | None = None) -> DataFrame:
    """rows with reject_reason of where packed rows come from: their family and its values, the split of their files, category,
    versions, status, window semantics, and well-formed hashes."""
    c = F.col
    # families are configuration: a table of fixed, small size
    known = families.select("family_id", F.struct("task_kind", *FAMILY_FIELDS).alias("__family"))
    kind = c("__family.task_kind")
    checks = {"record_id": c("record_id") != "", "family_id": kind.isNotNull()}
    checks |= {f: c(f) == c(f"__family.{f}") for f in FAMILY_FIELDS}
    if split is not None:
        checks["file_split"] = c("split") == split
    checks |= {
        "category": c("category") == F.when(kind == "identity", "identity_foundation").otherwise("synthetic_reasoning"),
        "generator_id": c("generator_id") == kind,
        "generator_version": c("generator_version") == GENERATOR_VERSION,
        "verifier_version": c("verifier_version") == VERIFIER_VERSION,
        "validation_status": c("validation_status") == "verified",
        "window_semantics": c("window_semantics") == WINDOW_SEMANTICS,
    }
    checks |= {f: c(f).rlike("^[0-9a-f]{64}$") for f in HASH_FIELDS}
    return rows.join(F.broadcast(known), "family_id", "left").withColumn("reject_reason", first_reason(**checks)).drop("__family")


def packable(df: DataFrame, n_tokens: Column, length: int) -> DataFrame:
    """df with packable: whether a document fits a window of its own."""
    return df.withColumn("packable", n_tokens + 2 <= length)


def smoke_subset(df: DataFrame, n_tokens: Column, length: int, order: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` packable rows in order, and one row of counters over all rows."""
    rows = packable(df, n_tokens, length)
    chosen = rows.where("packable").orderBy(*order).limit(limit).drop("packable")
    seen = rows.agg(F.count("*").alias("examined"), F.count_if("packable").alias("packable"), F.count_if(~F.col("packable")).alias("skipped"))
    counters = seen.withColumn("accepted", F.least(F.col("packable"), F.lit(limit)))
    return chosen, counters.withColumn("enough", F.col("accepted") == limit)


def shards(df: DataFrame, by: list[str], order: list[str], slots: str, most: int = SHARD_SLOTS) -> DataFrame:
    """df with shard: a shard closes after the document that brings it to ``most`` slots, so that no document is split.

    The cut depends on all cuts before it, so that a group is read in order by one worker; it streams, and holds one batch.
    Groups of one task are told apart by their key; only the key and the number of slots take part in the decision.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", shard bigint"

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, shard, held = None, 0, 0
        for batch in batches:
            out = []
            for key, n in zip(batch[by].itertuples(index=False, name=None), batch[slots]):
                if key != group:
                    group, shard, held = key, 0, 0
                out.append(shard)
                held += int(n)
                if held >= most:
                    shard, held = shard + 1, 0
            yield batch.assign(shard=out)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(cut, schema)


def fixed_shards(df: DataFrame, by: list[str], order: list[str], slots: str, most: int = SHARD_SLOTS) -> DataFrame:
    """As shards with other borders: a document's shard is the slots before it, divided by ``most``; no group is read by one task."""
    rows = placed(df, by, order, "__place", slots, "__before")
    return rows.withColumn("shard", F.floor(F.col("__before") / most).cast("long")).drop("__place", "__before")


def batches(df: DataFrame, order: list[str], rows: int, accumulate: int) -> DataFrame:
    """df with row, micro_batch and step, counted from 0 in order."""
    out = numbered(df, order, "row")
    return out.withColumn("micro_batch", F.floor(F.col("row") / rows)).withColumn("step", F.floor(F.col("row") / (rows * accumulate)))


def trimmed_batches(df: DataFrame, batch: str, columns: list[str]) -> DataFrame:
    """Rows cut to the longest active length of their batch."""
    longest = df.groupBy(batch).agg(F.max(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)).alias("__longest"))
    rows = df.join(longest, batch)
    return rows.withColumns({c: trimmed(F.col(c), F.col("__longest")) for c in columns}).drop("__longest")
