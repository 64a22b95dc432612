"""Queries of the corpus operators over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schedule as curves
from ..functions import text as tx
from ..functions import tokens as tk
from ..functions import windows as wn
from ..functions.identity import record_id, seed64, seed_hex, structured_hash
from ..operators import audit, evaluate, generate, mix, pack, profile, verify
from ..policy import CONTROL_LITERALS

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Shared pieces of SQL: the split of a document, canonical prompts, shingles, windows.
SPLIT = r"(CASE WHEN CAST(regexp_extract(source, '(\d+)$', 1) AS INT) < 16 THEN 'train' WHEN CAST(regexp_extract(source, '(\d+)$', 1) AS INT) < 18 THEN 'validation' ELSE 'blind' END)"
DOCS = f"docs AS (SELECT *, {SPLIT} AS split FROM documents)"
FOLD = "lower(replace(replace(text, 'ß', 'ss'), 'ẞ', 'ss'))"
PROMPT = rf"""trim(regexp_replace(regexp_replace(regexp_replace({FOLD}, '(^|[^\p{{L}}\p{{N}}_])[+-]?\d+\b', '\1<number>', 'g'),
  '\b(north|south|east|west|север|юг|восток|запад)\b', '<direction>', 'g'), '\s+', ' ', 'g'))"""
COUNT = "(CASE WHEN n <= {L} - 2 THEN 1 ELSE CAST(ceil((n - ({L} - 2)) / CAST({L} - 1 AS DOUBLE)) AS BIGINT) + 1 END)"


def _windows_sql(length: int, columns: str = "doc_id, lang") -> str:
    """Windows of byte tokens in closed form."""
    return f"""
base AS (SELECT {columns}, CAST(strlen(text) AS BIGINT) AS n FROM documents WHERE strlen(text) > 0),
cnt AS (SELECT *, {COUNT.format(L=length)} AS c FROM base),
win AS (SELECT {columns}, n, c, k, CASE WHEN k = 0 THEN 0 ELSE least(k * {length - 1}, n - (c - k)) END AS s,
  CASE WHEN k = c - 1 THEN n ELSE least((k + 1) * {length - 1}, n - (c - k - 1)) END AS e, k = c - 1 AS f
  FROM (SELECT *, unnest(range(0, c)) AS k FROM cnt))"""


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if it has any."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumn("split", audit.split_of_source(F.col("source")))


BYTES = F.octet_length


@query("SELECT doc_id, sha256(text) AS text_sha256, length(text) AS chars, strlen(text) AS bytes FROM documents")
def doc_fingerprint(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", tx.content_hash(F.col("text")).alias("text_sha256"), F.length("text").cast("long").alias("chars"), BYTES("text").cast("long").alias("bytes"))


@query(f"WITH {DOCS} SELECT split, count(*) AS records, count(*) - count(DISTINCT text) AS exact_duplicates FROM docs GROUP BY split")
def exact_dup_by_split(spark, sf_dir):
    return audit.exact_duplicates(_docs(spark, sf_dir).withColumn("h", tx.content_hash(F.col("text"))), ["split"], "h")


@query("SELECT source, count(*) AS records, count(*) - count(DISTINCT text) AS exact_duplicates FROM documents GROUP BY source")
def exact_dup_by_source(spark, sf_dir):
    return audit.exact_duplicates(_docs(spark, sf_dir).withColumn("h", tx.content_hash(F.col("text"))), ["source"], "h")


@query("SELECT sha256(text) AS h, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def dedup_keep_first(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(tx.content_hash(F.col("text")).alias("h"), "doc_id", "source")
    return audit.keep_first(rows, ["h"], ["doc_id"])


@query("SELECT sha256(text) AS h, count(*) AS times FROM documents GROUP BY text HAVING count(*) > 1")
def repeated_texts(spark, sf_dir):
    return audit.repeated(_docs(spark, sf_dir).select(tx.content_hash(F.col("text")).alias("h")), ["h"])


def _summary_sql(value: str) -> str:
    return f"""WITH {DOCS}, v AS (SELECT split, CAST({value} AS BIGINT) AS v FROM docs),
g AS (SELECT split, count(*) AS "count", min(v) AS "min", round(sum(v) / CAST(count(*) AS DOUBLE), 3) AS mean, max(v) AS "max", list_sort(list(v)) AS l FROM v GROUP BY split)
SELECT split, "count", "min", mean, l[CAST(floor(("count" - 1) * CAST(0.5 AS DOUBLE)) AS BIGINT) + 1] AS p50,
l[CAST(floor(("count" - 1) * CAST(0.95 AS DOUBLE)) AS BIGINT) + 1] AS p95, "max" FROM g"""


@query(_summary_sql("length(text)"))
def length_summary_chars(spark, sf_dir):
    return profile.length_summary(_docs(spark, sf_dir), ["split"], F.length("text"))


@query(_summary_sql("strlen(text)"))
def length_summary_bytes(spark, sf_dir):
    return profile.length_summary(_docs(spark, sf_dir), ["split"], BYTES("text"))


@query(
    f"""WITH {DOCS} SELECT split, lang, source, CAST(grouping(split, lang, source) AS BIGINT) AS grouping, count(*) AS records
FROM docs GROUP BY GROUPING SETS ((split), (split, lang), (split, source), ())"""
)
def counts_grouping_sets(spark, sf_dir):
    return profile.counts(_docs(spark, sf_dir), [["split"], ["split", "lang"], ["split", "source"], []])


_WORDS = r"regexp_extract_all(text, '\p{L}+(?:[''’-]\p{L}+)*')"


@query(
    f"""WITH t AS (SELECT lang, unnest({_WORDS}) AS w FROM documents),
a AS (SELECT lang, count(*) AS records, sum(length(text))::BIGINT AS chars, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY lang),
b AS (SELECT lang, count(*) AS word_tokens, count(DISTINCT lower(replace(replace(w, 'ß', 'ss'), 'ẞ', 'ss'))) AS word_forms FROM t GROUP BY lang)
SELECT lang, records, chars, bytes, coalesce(word_tokens, 0) AS word_tokens, coalesce(word_forms, 0) AS word_forms,
round(word_forms / CAST(word_tokens AS DOUBLE), 6) AS type_token_ratio FROM a LEFT JOIN b USING (lang)"""
)
def lexical_profile(spark, sf_dir):
    return profile.lexical_profile(_docs(spark, sf_dir), ["lang"], "text")


@query(
    f"""WITH t AS (SELECT source, unnest({_WORDS}) AS w FROM documents)
SELECT source, round(count(DISTINCT lower(replace(replace(w, 'ß', 'ss'), 'ẞ', 'ss'))) / CAST(count(*) AS DOUBLE), 6) AS type_token_ratio FROM t GROUP BY source"""
)
def type_token_ratio(spark, sf_dir):
    return profile.lexical_profile(_docs(spark, sf_dir), ["source"], "text").select("source", "type_token_ratio")


@query(
    """SELECT lang, count(*) AS documents, sum(strlen(text))::BIGINT AS bytes, sum(strlen(text) + 1)::BIGINT AS tokens,
sum(strlen(text)) / CAST(sum(strlen(text) + 1) AS DOUBLE) AS bytes_per_token FROM documents GROUP BY ROLLUP (lang)"""
)
def tokenizer_fertility(spark, sf_dir):
    return profile.fertility(_docs(spark, sf_dir), "lang", BYTES("text"), BYTES("text") + 1)


@query(f"WITH {DOCS} SELECT split, list_sort(list(DISTINCT source)) AS source, list_sort(list(DISTINCT lang)) AS lang FROM docs GROUP BY split")
def split_members(spark, sf_dir):
    return profile.members(_docs(spark, sf_dir), "split", ["source", "lang"])


@query("SELECT source, count(DISTINCT lang) = 1 AS lang_agrees FROM documents GROUP BY source")
def source_agreement(spark, sf_dir):
    return profile.agreement(_docs(spark, sf_dir), ["source"], ["lang"])


@query(f"WITH {DOCS}, p AS (SELECT split, {PROMPT} AS p FROM docs) SELECT split, count(DISTINCT p) AS signatures FROM p GROUP BY split")
def prompt_signature_counts(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("split", tx.content_hash(tx.canonical_prompt(F.col("text"))).alias("p"))
    return rows.groupBy("split").agg(F.count_distinct("p").alias("signatures"))


@query(f"SELECT doc_id, sha256({PROMPT}) AS digest FROM documents")
def canonical_prompts(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.content_hash(tx.canonical_prompt(F.col("text"))).alias("digest"))


def _sets_sql(table: str, columns: str) -> str:
    return f"""SELECT {columns}, min(id) AS doc, list_filter(string_split(p, ' '), lambda x: x <> '') AS w
FROM (SELECT *, {PROMPT} AS p FROM {table}) GROUP BY {columns}, p"""


SHINGLES = """list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"""


def _near_sql(left: str, right: str, least: float, extra: str = "") -> str:
    return f"""
l AS (SELECT doc, {SHINGLES} AS s FROM ({left})), r AS (SELECT doc, {SHINGLES} AS s FROM ({right})),
le AS (SELECT doc, len(s) AS n, unnest(s) AS x FROM l), re AS (SELECT doc, len(s) AS n, unnest(s) AS x FROM r),
c AS (SELECT le.doc AS doc_l, re.doc AS doc_r, count(*) AS c, any_value(le.n) AS a, any_value(re.n) AS b FROM le JOIN re USING (x) GROUP BY le.doc, re.doc)
SELECT doc_l, doc_r, c / CAST(a + b - c AS DOUBLE) AS jaccard FROM c WHERE c / CAST(a + b - c AS DOUBLE) >= CAST({least} AS DOUBLE){extra}"""


@query(
    f"""WITH d AS (SELECT doc_id AS id, text FROM documents), s AS (SELECT doc, len({SHINGLES}) AS n FROM (SELECT id AS doc, list_filter(string_split({PROMPT}, ' '), lambda x: x <> '') AS w FROM d))
SELECT doc AS doc_id, n AS shingles FROM s"""
)
def shingle_stats(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", tx.words(tx.canonical_prompt(F.col("text"))).alias("w"))
    return rows.select("doc_id", F.size(tx.shingles(F.col("w"))).cast("long").alias("shingles"))


@query(
    f"""WITH {DOCS}, p AS (SELECT split, sha256({PROMPT}) AS digest FROM docs)
SELECT digest, list_sort(list(DISTINCT split)) AS splits FROM p GROUP BY digest HAVING count(DISTINCT split) > 1"""
)
def cross_split_exact_overlap(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("split", tx.content_hash(tx.canonical_prompt(F.col("text"))).alias("digest"))
    return audit.cross_split(rows, "digest")


_HELD_OUT = [_sets_sql(f"(SELECT * FROM d WHERE split {w})", "split") for w in ("= 'train'", "<> 'train'", "= 'validation'", "= 'blind'")]
_WITH_SPLITS = f"WITH d AS (SELECT *, doc_id AS id, {SPLIT} AS split FROM documents), "


@query(
    f"SELECT * FROM ({_WITH_SPLITS}{_near_sql(_HELD_OUT[0], _HELD_OUT[1], 0.85)}) UNION ALL SELECT * FROM ({_WITH_SPLITS}{_near_sql(_HELD_OUT[2], _HELD_OUT[3], 0.85)})"
)
def cross_split_near_dup(spark, sf_dir):
    """All three pairs of splits: train with the others, and validation with blind."""
    sets = audit.prompt_sets(_docs(spark, sf_dir), "doc_id", "text")
    return audit.near_duplicates(sets, sets, apart="split")


@query(
    "WITH d AS (SELECT doc_id AS id, text, 'd' AS split FROM documents), b AS (SELECT item_id AS id, text, 'b' AS split FROM benchmark), "
    + _near_sql(_sets_sql("d", "split"), _sets_sql("b", "split"), 0.05)
)
def benchmark_near_dup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("split", F.lit("d"))
    bench = _table(spark, sf_dir, "benchmark").withColumn("split", F.lit("b"))
    return audit.near_duplicates(audit.prompt_sets(docs, "doc_id", "text"), audit.prompt_sets(bench, "item_id", "text"), 0.05)


@query(
    f"""WITH {DOCS}, x AS (SELECT split, 'text' AS kind, sha256(text) AS identity FROM docs UNION ALL SELECT split, 'family', source FROM docs
UNION ALL SELECT split, 'language', lang FROM docs)
SELECT kind, identity, list_sort(list(DISTINCT split)) AS splits FROM x GROUP BY kind, identity HAVING count(DISTINCT split) > 1"""
)
def leakage_by_kind(spark, sf_dir):
    rows = _docs(spark, sf_dir).withColumn("h", tx.content_hash(F.col("text")))
    return audit.leakage(rows, {"text": "h", "family": "source", "language": "lang"})


@query(
    f"""WITH {DOCS} SELECT a.split AS split_l, b.split AS split_r, count(DISTINCT a.text) AS shared FROM docs a JOIN docs b ON a.text = b.text AND a.split < b.split GROUP BY 1, 2"""
)
def split_isolation(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("split", tx.content_hash(F.col("text")).alias("h")).distinct()
    pairs = rows.select(F.col("split").alias("split_l"), "h").join(rows.select(F.col("split").alias("split_r"), "h"), "h").where("split_l < split_r")
    return pairs.groupBy("split_l", "split_r").agg(F.count("*").alias("shared"))


_CONTROL_SQL = " OR ".join(f"contains(t, '{c}')" for c in CONTROL_LITERALS)


@query(
    f"""WITH p AS (SELECT page_id, html AS t FROM pages) SELECT page_id, CASE WHEN t IS NULL OR trim(t) = '' THEN 'blank' WHEN {_CONTROL_SQL} THEN 'control_literal'
WHEN contains(t, '▁') THEN 'reserved_mark' END AS reject_reason FROM p"""
)
def control_literal_rejects(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", tx.contract_reject(F.col("html")).alias("reject_reason"))


@query("SELECT doc_id, strlen(text) AS bytes FROM documents WHERE strlen(text) > 8192")
def byte_limit_rejects(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", BYTES("text").cast("long").alias("bytes")).where("bytes > 8192")


@query("SELECT doc_id, sha256(nfc_normalize(text)) AS nfc_sha256 FROM documents")
def nfc_normalized(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.content_hash(tx.nfc(F.col("text"))).alias("nfc_sha256"))


#: Texts and the spans of their numbers.
NUMBER_CASES = [
    ("9.81 m/s²", ["9.81 m"]), ("5 m²", ["5"]), ("x²5 6³", []), ("5m³", []), ("12 345,6 kg", ["12 345,6 kg"]), ("a1 1a _2", ["1a"]),
    ("-3e-5 °C, +7%", ["-3e-5 °C", "+7%"]), ("60 km / h", ["60 km / h"]), ("1.2.3", ["1.2", "3"]), ("٣٤", ["٣٤"]), ("", []), ("1\x1cm", ["1\x1cm"]),
]


@query(
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, [{', '.join(chr(39) + x + chr(39) for x in spans)}]::VARCHAR[])" for i, (_, spans) in enumerate(NUMBER_CASES))
    + ") t(item, spans)"
)
def number_cases(spark, sf_dir):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NUMBER_CASES)], "item int, text string")
    return rows.select("item", tx.numeric_spans(F.col("text")).alias("spans"))


@query()
def numeric_spans(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.numeric_spans(F.col("text")).alias("spans")).where(F.size("spans") > 0)


@query("SELECT doc_id, true AS ok FROM documents")
def numeric_safe_clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", tx.numeric_safe_nfc(F.col("text"))["ok"].alias("ok"))


@query(
    """SELECT doc_id, substr(sha256('v1' || chr(0) || '42' || chr(0) || source || chr(0) || doc_id), 1, 32) AS seed,
sha256('v1' || chr(0) || source || chr(0) || doc_id || chr(0) || '7') AS record, sha256(lang || chr(0) || '' || chr(0) || source) AS signature FROM documents"""
)
def record_identities(spark, sf_dir):
    c = F.col
    return _docs(spark, sf_dir).select(
        "doc_id", seed_hex("v1", 42, c("source"), c("doc_id")).alias("seed"), record_id(c("source"), c("doc_id"), F.lit(7), "v1").alias("record"),
        structured_hash(c("lang"), F.lit(None).cast("string"), c("source")).alias("signature"),
    )


@query(
    "SELECT doc_id, CAST(CAST('0x' || substr(sha256('v1' || chr(0) || '42' || chr(0) || source || chr(0) || doc_id), 1, 16) AS UBIGINT) AS DECIMAL(20, 0)) AS seed FROM documents"
)
def numeric_seeds(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", seed64("v1", 42, F.col("source"), F.col("doc_id")).alias("seed"))


@query(f"WITH {_windows_sql(512, 'doc_id')} SELECT doc_id, n AS document_token_count, k AS chunk_index, c AS chunk_count, s AS token_start, e AS token_end, f AS is_final_document_window FROM win")
def window_ranges(spark, sf_dir):
    return pack.windows(_table(spark, sf_dir, "documents").select("doc_id", BYTES("text").alias("n")), F.col("n"), 512).drop("n")


def _report_sql(by: str, length: int) -> str:
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH {_windows_sql(length, "doc_id, lang, split") if by == "split" else _windows_sql(length)}
SELECT {by + ", " if by else ""}count(*) FILTER (f) AS documents, count(*) AS chunks, sum(e - s)::BIGINT AS body_tokens, count(*) AS bos_tokens, count(*) FILTER (f) AS eod_tokens,
sum(e - s + 1 + f::INT)::BIGINT AS input_tokens, sum(e - s + f::INT)::BIGINT AS supervised_target_tokens, sum({length} - (e - s + 1 + f::INT))::BIGINT AS padded_slots,
sum(e - s + 1 + f::INT) / CAST(count(*) * {length} AS DOUBLE) AS packing_efficiency FROM win {group}"""


def _byte_windows(spark, sf_dir, length):
    return pack.windows(_table(spark, sf_dir, "documents").select("doc_id", "lang", BYTES("text").alias("n")), F.col("n"), length)


@query(_report_sql("", 4096))
def packing_report(spark, sf_dir):
    return pack.report(_byte_windows(spark, sf_dir, 4096), [], 4096)


@query(_report_sql("lang", 4096))
def packing_report_by_lang(spark, sf_dir):
    return pack.report(_byte_windows(spark, sf_dir, 4096), ["lang"], 4096)


@query(f"WITH {_windows_sql(512)} SELECT sum(e - s + f::INT)::BIGINT AS groups, sum(e - s + f::INT)::BIGINT AS whole, true AS equal FROM win")
def packing_cross_foot(spark, sf_dir):
    win = _byte_windows(spark, sf_dir, 512)
    return pack.cross_foot(pack.report(win, ["lang"], 512), pack.report(win, [], 512))


@query(f"WITH {_windows_sql(512)} SELECT 'body_tokens' AS field, (sum(e - s) + 1)::BIGINT AS declared, sum(e - s)::BIGINT AS recounted FROM win")
def packing_reconciliation(spark, sf_dir):
    """The declared report has one body token too many: that field must differ, and no other."""
    win = _byte_windows(spark, sf_dir, 512)
    fields = ["documents", "chunks", "body_tokens", "input_tokens", "supervised_target_tokens", "padded_slots"]
    whole = pack.report(win, ["lang"], 512).agg(*[F.sum(f).alias(f) for f in fields])
    return pack.reconciled(pack.report(win, [], 512), whole.withColumn("body_tokens", F.col("body_tokens") + 1), fields)


@query(f"WITH {_windows_sql(512)} SELECT doc_id, 'offset' AS reason FROM win WHERE doc_id % 5 = 2 AND k = 1")
def chunk_contiguity_audit(spark, sf_dir):
    """Window 1 of every fifth document begins a token late: the audit must name those that have one, and no other."""
    late = (F.col("doc_id") % 5 == 2) & (F.col("chunk_index") == 1)
    win = _byte_windows(spark, sf_dir, 512).withColumn("token_start", F.col("token_start") + late.cast("long"))
    return pack.contiguity(win, "doc_id", ["lang"])


@query(
    """WITH w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS rn FROM (WITH """ + _windows_sql(512)
    + """ SELECT * FROM win) WHERE doc_id % 7 <> 3 OR k <> 1)
SELECT doc_id, CASE WHEN bool_or(rn - 1 <> k) THEN 'index' ELSE 'incomplete' END AS reason FROM w GROUP BY doc_id HAVING count(*) <> max(c)"""
)
def chunk_gap_detection(spark, sf_dir):
    """Window 1 of every seventh document is lost: the audit must name those that had one."""
    win = _byte_windows(spark, sf_dir, 512)
    return pack.contiguity(win.where("doc_id % 7 <> 3 OR chunk_index <> 1"), "doc_id")


@query(
    f"""WITH {_windows_sql(256, "doc_id, text")}, b AS (SELECT doc_id, n, c, k, s, e, f,
  list_transform(range(0, e - s), lambda i: CAST('0x' || substr(w, 2 * i + 1, 2) AS INT) + 19) AS body FROM (SELECT *, substr(hex(text), 2 * s + 1, 2 * (e - s)) AS w FROM win)),
x AS (SELECT *, body || CASE WHEN f THEN [4] ELSE [] END AS rest, 255 - CAST(e - s AS INT) - f::INT AS free FROM b)
SELECT doc_id, n AS document_token_count, k AS chunk_index, c AS chunk_count, s AS token_start, e AS token_end, f AS is_final_document_window,
[1] || rest || list_transform(range(0, free), lambda i: 3) AS input_ids, [-100] || rest || list_transform(range(0, free), lambda i: -100) AS labels,
list_transform(range(0, 256 - free), lambda i: 1) || list_transform(range(0, free), lambda i: 0) AS attention_mask, CAST(len(rest) AS BIGINT) AS target_tokens FROM x"""
)
def packed_windows(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", wn.byte_ids(F.col("text")).alias("ids"))
    return pack.packed_rows(docs, "ids", 256)


@query(
    f"""WITH {_windows_sql(256)} SELECT doc_id, k AS chunk_index, (e - s + f::INT)::BIGINT AS target_tokens, (e - s + 1 + f::INT)::BIGINT AS active,
f::INT::BIGINT AS ends FROM win"""
)
def packed_row_counts(spark, sf_dir):
    rows = packed_windows(spark, sf_dir)
    return rows.select(
        "doc_id", "chunk_index", "target_tokens", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("active"),
        F.size(F.filter("input_ids", lambda x: x == 4)).cast("long").alias("ends"),
    )


@query(f"WITH {_windows_sql(256)} SELECT doc_id, k AS chunk_index, CASE WHEN f THEN 'offset' ELSE 'targets' END AS reject_reason FROM win WHERE doc_id % 11 = 4")
def packed_row_admission(spark, sf_dir):
    """Windows of every eleventh document end a token late: all of them must be rejected, and no other."""
    rows = packed_windows(spark, sf_dir).withColumn("token_end", F.col("token_end") + (F.col("doc_id") % 11 == 4).cast("long"))
    return pack.row_reasons(rows, 256).where("reject_reason IS NOT NULL").select("doc_id", "chunk_index", "reject_reason")


_PROVENANCE = ["family_id", "split", "category", "generator_version", "window_semantics", "text_sha256"]


@query(f"SELECT doc_id, ['', {', '.join(repr(x) for x in _PROVENANCE)}][doc_id % 13 + 1] AS reject_reason FROM documents WHERE doc_id % 13 BETWEEN 1 AND {len(_PROVENANCE)}")
def packed_row_provenance(spark, sf_dir):
    """Documents as rows of the generator's families; six of thirteen have one broken field each, which must be named, and no other."""
    families = generate.families(spark, _families(), 1)
    c, broken = F.col, dict(zip(_PROVENANCE, ("none", "other", "other", "v0", "v0", "ABC")))
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(len(_families()))).cast("int").alias("family_pos"), tx.content_hash(c("text")).alias("text_sha256"))
    # configuration, of fixed, small size
    rows = rows.join(F.broadcast(families), "family_pos").withColumns({
        "record_id": c("doc_id").cast("string"), "task_sha256": c("text_sha256"), "functional_signature": c("text_sha256"), "generator_id": c("task_kind"),
        "category": F.when(c("task_kind") == "identity", "identity_foundation").otherwise("synthetic_reasoning"), "generator_version": F.lit(generate.GENERATOR_VERSION),
        "verifier_version": F.lit(generate.VERIFIER_VERSION), "validation_status": F.lit("verified"), "window_semantics": F.lit(pack.WINDOW_SEMANTICS),
    })
    rows = rows.withColumns({f: F.when(c("doc_id") % 13 == i, v).otherwise(c(f)) for i, (f, v) in enumerate(broken.items(), 1)})
    return pack.provenance_reasons(rows, families).where("reject_reason IS NOT NULL").select("doc_id", "reject_reason")


@query("SELECT doc_id, CASE doc_id % 9 WHEN 1 THEN 'control_id' WHEN 2 THEN 'out_of_range' WHEN 3 THEN 'empty' END AS reject_reason FROM documents WHERE strlen(text) > 0")
def body_admission(spark, sf_dir):
    """Ids of documents, of which some get a control id, an id beyond the vocabulary, or none."""
    docs = _table(spark, sf_dir, "documents").where("octet_length(text) > 0").select("doc_id", wn.byte_ids(F.col("text")).alias("ids"))
    case = F.col("doc_id") % 9
    ids = F.when(case == 1, F.array_append("ids", F.lit(3))).when(case == 2, F.array_append("ids", F.lit(70_000))).when(case == 3, F.array().cast("array<int>")).otherwise(F.col("ids"))
    return docs.withColumn("ids", ids).select("doc_id", wn.body_reject(F.col("ids")).alias("reject_reason"))


@query(f"WITH {DOCS}, n AS (SELECT split, count(*) AS n FROM docs GROUP BY split) SELECT '{{' || string_agg('\"' || split || '\":' || n, ',' ORDER BY split) || '}}' AS counts FROM n")
def counts_map(spark, sf_dir):
    return profile.counted_map(_docs(spark, sf_dir), "split").select(F.to_json("counts").alias("counts"))


@query(f"WITH {_windows_sql(512)}, o AS (SELECT doc_id, k, e - s + 1 + f::INT AS active, CAST(floor((row_number() OVER (ORDER BY doc_id, k) - 1) / 16) AS BIGINT) AS b FROM win) SELECT doc_id, k AS chunk_index, b AS micro_batch, max(active) OVER (PARTITION BY b)::BIGINT AS longest FROM o")
def batch_trim(spark, sf_dir):
    win = _byte_windows(spark, sf_dir, 512).withColumn("active", F.col("token_end") - F.col("token_start") + 1 + F.col("is_final_document_window").cast("int"))
    rows = pack.batches(win, ["doc_id", "chunk_index"], 16, 1)
    longest = rows.groupBy("micro_batch").agg(F.max("active").alias("longest"))
    return rows.join(longest, "micro_batch").select("doc_id", "chunk_index", "micro_batch", "longest")


@query("SELECT count(*) AS examined, count(*) FILTER (strlen(text) + 2 <= 512) AS packable, count(*) FILTER (strlen(text) + 2 > 512) AS skipped, least(count(*) FILTER (strlen(text) + 2 <= 512), 20) AS accepted, count(*) FILTER (strlen(text) + 2 <= 512) >= 20 AS enough FROM documents")
def packable_selection(spark, sf_dir):
    return pack.smoke_subset(_docs(spark, sf_dir), BYTES("text"), 512, ["doc_id"], 20)[1]


@query("SELECT doc_id, strlen(text) AS bytes FROM documents WHERE strlen(text) + 2 <= 512 ORDER BY doc_id LIMIT 20")
def smoke_subset_rows(spark, sf_dir):
    return pack.smoke_subset(_docs(spark, sf_dir), BYTES("text"), 512, ["doc_id"], 20)[0].select("doc_id", BYTES("text").cast("long").alias("bytes"))


_SHARD_SQL = """WITH RECURSIVE o AS (SELECT lang, doc_id, strlen(text) + 2 AS n, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
r AS (SELECT lang, doc_id, rn, 0 AS shard, n AS held FROM o WHERE rn = 1
UNION ALL SELECT o.lang, o.doc_id, o.rn, CASE WHEN r.held >= 20000 THEN r.shard + 1 ELSE r.shard END, CASE WHEN r.held >= 20000 THEN o.n ELSE r.held + o.n END
FROM r JOIN o ON o.lang = r.lang AND o.rn = r.rn + 1) SELECT lang, doc_id, shard::BIGINT AS shard FROM r"""


@query(_SHARD_SQL)
def shard_cuts(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("lang", "doc_id", (BYTES("text") + 2).cast("long").alias("n"))
    return pack.shards(rows, ["lang"], ["doc_id"], "n", 20_000).drop("n")


@query("SELECT lang, doc_id, CAST(floor(coalesce(sum(strlen(text) + 2) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 20000) AS BIGINT) AS shard FROM documents")
def shard_cuts_fixed(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("lang", "doc_id", (BYTES("text") + 2).cast("long").alias("n"))
    return pack.fixed_shards(rows, ["lang"], ["doc_id"], "n", 20_000).drop("n")


# The mix over every language of the table, equally weighted, and over all positions of both epochs.
_SCHEDULE_SQL = """x AS (SELECT doc_id, lang, strlen(text) + 1 AS t, unnest(range(0, 2)) AS epoch FROM documents WHERE lang IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY lang, epoch ORDER BY sha256('42:' || epoch || ':' || doc_id), doc_id) - 1 AS pos FROM x),
b AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY lang ORDER BY epoch, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
s AS (SELECT *, row_number() OVER (ORDER BY before / (1 / CAST((SELECT count(DISTINCT lang) FROM documents) AS DOUBLE)), lang, epoch, pos) - 1 AS position FROM b)"""


def _schedule(spark, sf_dir):
    rows = _docs(spark, sf_dir).where("lang IS NOT NULL").select("doc_id", "lang", (BYTES("text") + 1).cast("long").alias("t"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    return mix.schedule(rows, "lang", "doc_id", "t", {g: 1 / len(langs) for g in langs}, 42, 2), rows


@query(f"WITH {_SCHEDULE_SQL} SELECT position, doc_id, lang, epoch::INT AS epoch, before::BIGINT AS before FROM s")
def mix_schedule(spark, sf_dir):
    return _schedule(spark, sf_dir)[0].select("position", "doc_id", "lang", "epoch", "before")


@query(
    f"""WITH {_SCHEDULE_SQL}, pool AS (SELECT lang, count(*) AS pool FROM documents WHERE lang IS NOT NULL GROUP BY lang),
g AS (SELECT lang, sum(t)::BIGINT AS tokens, count(*) AS presentations, any_value(pool) AS pool FROM s JOIN pool USING (lang) GROUP BY lang)
SELECT lang, tokens, tokens / CAST(sum(tokens) OVER () AS DOUBLE) AS fraction, presentations, least(presentations, pool) AS unique_rows,
presentations - least(presentations, pool) AS reused_presentations FROM g"""
)
def mix_report(spark, sf_dir):
    return mix.report(*_schedule(spark, sf_dir), "lang", "t")


@query(
    f"""WITH {_SCHEDULE_SQL}, q AS (SELECT lang, sum(t)::BIGINT AS t, max(t) AS m FROM s GROUP BY lang)
SELECT max(t) - min(t) AS imbalance, max(m) AS most_row_tokens, max(t) - min(t) <= max(m) AS balanced FROM q"""
)
def mix_imbalance(spark, sf_dir):
    return mix.imbalance(_schedule(spark, sf_dir)[0], "lang", "t")


@query("SELECT 2 * count(*) AS rows, true AS is_prefix, 2 * count(*) AS resume_at FROM documents WHERE lang IS NOT NULL")
def delivery_acknowledgement(spark, sf_dir):
    scheduled = _schedule(spark, sf_dir)[0].select("position", "doc_id")
    return mix.acknowledged(scheduled, scheduled, "doc_id")


@query(
    """SELECT DISTINCT lang, 1::INT AS epoch, 'missing' AS reason FROM documents WHERE lang = 'fr' AND doc_id % 5 = 0
UNION ALL SELECT DISTINCT lang, 0::INT, 'repeated' FROM documents WHERE lang = 'de' AND doc_id % 7 = 0"""
)
def schedule_state_audit(spark, sf_dir):
    """Every fifth French document is lost from epoch 1, and every seventh German one stands twice in epoch 0."""
    rows = _docs(spark, sf_dir).where("lang IS NOT NULL").select("doc_id", "lang")
    state = mix.permuted(rows, "lang", "doc_id", 42, 2)
    twice = state.where("lang = 'de' AND doc_id % 7 = 0 AND epoch = 0")
    return mix.state_reasons(state.where("NOT (lang = 'fr' AND doc_id % 5 = 0 AND epoch = 1)").unionByName(twice), rows, "lang", "doc_id")


def _messages(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return rows.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


@query("SELECT conv_id, sha256('<|bos|>' || string_agg('<|' || role || '|>' || text || '<|eot|>', '' ORDER BY turn) || '<|assistant|>') AS rendered_sha256 FROM conversations GROUP BY conv_id")
def chat_render(spark, sf_dir):
    return _messages(spark, sf_dir).select("conv_id", tx.content_hash(tk.render_chat(F.col("messages"), True)).alias("rendered_sha256"))


@query(
    """WITH t AS (SELECT conv_id, turn, list_position(['system', 'user', 'assistant'], role) + 4 AS marker, hex(text) AS h FROM conversations)
SELECT conv_id, sha256('1,' || string_agg(marker || ',' || array_to_string(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS INT) + 19) || [2], ','), ',' ORDER BY turn)) AS ids_sha256
FROM t GROUP BY conv_id"""
)
def chat_encoded(spark, sf_dir):
    return _messages(spark, sf_dir).select("conv_id", tx.content_hash(F.array_join(tk.chat_ids(F.col("messages"), tk.contents_encoder(tk.ByteTokenizer)), ",")).alias("ids_sha256"))


@query("SELECT conv_id, NULL::VARCHAR AS reject_reason FROM conversations GROUP BY conv_id")
def chat_admission(spark, sf_dir):
    return _messages(spark, sf_dir).select("conv_id", tk.chat_reason(F.col("messages")).alias("reject_reason"))


@query(
    """WITH t AS (SELECT conv_id, arg_max(text, turn) AS answer, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT conv_id, (1 + sum(strlen(c.text) + 2) FILTER (c.turn < last))::BIGINT AS prefix_tokens, strlen(any_value(answer)) + 1 AS answer_tokens, strlen(any_value(answer)) + 1 AS supervised
FROM t JOIN conversations c USING (conv_id) GROUP BY conv_id HAVING count(*) FILTER (c.turn < last) > 0"""
)
def chat_supervision_lengths(spark, sf_dir):
    """Byte tokens; a marker and an end of turn are one id each, and a start id leads."""
    rows = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    last = F.array_max(F.transform(F.filter("m", lambda x: x["role"] == "assistant"), lambda x: x["turn"]))
    rows = rows.withColumn("last", last).where("last IS NOT NULL")
    rows = rows.withColumn("prefix", F.filter("m", lambda x: x["turn"] < F.col("last"))).withColumn("answer", F.filter("m", lambda x: x["turn"] == F.col("last"))[0]["text"])
    rows = rows.where(F.size("prefix") > 0)
    n = F.lit(1) + F.aggregate("prefix", F.lit(0), lambda a, x: a + F.octet_length(x["text"]) + 2)
    answer = F.concat(wn.byte_ids(F.col("answer")), F.array(F.lit(2)))
    rows = rows.select("conv_id", n.cast("long").alias("prefix_tokens"), answer.alias("a"))
    labels = wn.answer_labels(F.array_repeat(F.lit(5), F.col("prefix_tokens").cast("int")), F.col("a"), 65_536)
    return rows.select("conv_id", "prefix_tokens", F.size("a").cast("long").alias("answer_tokens"), F.size(F.filter(labels, lambda x: x != -100)).cast("long").alias("supervised"))


#: Records of a family; identity families have fewer.
FAMILY_RECORDS, IDENTITY_RECORDS = 4096, {"train": 1400, "validation": 350, "blind": 350}


def _families() -> list[dict]:
    made = []
    for lang in ("en", "ru"):
        for kind, split, op, scenario in (
            ("identity", "train", None, None), ("arithmetic", "train", "add", None), ("mode_transition", "train", None, None),
            ("grounded_action", "train", None, "stop_obstacle"), ("grounded_action", "train", None, "action_sequence"),
            ("identity", "validation", None, None), ("arithmetic", "validation", "multiply", None), ("inventory", "validation", None, None),
            ("grounded_action", "validation", None, "cancel_action"), ("identity", "blind", None, None),
            ("arithmetic", "blind", "subtract", None), ("arithmetic", "blind", "divide", None), ("location", "blind", None, None),
            ("grounded_action", "blind", None, "object_presence"),
        ):
            name = ".".join(x for x in (kind, op, scenario, split) if x)
            made.append({"family_id": f"{lang}.{name}", "language": lang, "split": split, "task_kind": kind, "operation": op, "scenario": scenario,
                         "functional_family": f"{name}.f", "template_family": f"{name}.t", "scenario_family": f"{name}.s"})
    return made


def _counted() -> list[dict]:
    return [f | {"records_per_family": IDENTITY_RECORDS[f["split"]] if f["task_kind"] == "identity" else FAMILY_RECORDS} for f in _families()]


def _records(spark):
    return generate.records(spark, _counted(), FAMILY_RECORDS)


def _generated_sql(pos: int, op: str) -> str:
    family = _families()[pos]["family_id"]
    side = 96 if op == "divide" else 9998
    m, o = generate.affine_constants(family, side * side)
    pair = f"(({m} * i + {o}) % {side * side})"
    left, right = f"(2 + {pair} % {side})" + (f" * (2 + {pair} // {side})" if op == "divide" else ""), f"2 + {pair} // {side}"
    value = {"add": "l + r", "subtract": "l - r", "multiply": "l * r", "divide": "l // r"}[op]
    return f"SELECT '{family}' AS family_id, i AS ordinal, l AS \"left\", r AS \"right\", CAST({value} AS VARCHAR) AS answer FROM (SELECT i, CAST({left} AS BIGINT) AS l, CAST({right} AS BIGINT) AS r FROM (SELECT unnest(range(0, {FAMILY_RECORDS})) AS i))"


@query(" UNION ALL ".join(_generated_sql(i, f["operation"]) for i, f in enumerate(_families()) if f["task_kind"] == "arithmetic"))
def generated_arithmetic(spark, sf_dir):
    return _records(spark).where("generator_id = 'arithmetic'").select("family_id", "ordinal", "task.left", "task.right", "answer")


def _drawn(index: int, low: int, high: int) -> str:
    """SQL of a draw of the seed ``seed``."""
    return f"({low} + CAST('0x' || substr(sha256(seed || chr(0) || '{index}'), 1, 15) AS BIGINT) % {high - low + 1})"


def _ordinals_sql(kind: str) -> str:
    """(family_id, ordinal, shift, seed) of a kind's families."""
    each = [
        f"SELECT '{f['family_id']}' AS family_id, {generate._constants(f, generate.ROOT_SEED)[1]} AS shift, i AS ordinal FROM range({FAMILY_RECORDS}) t(i)"
        for f in _families() if f["task_kind"] == kind
    ]
    seed = f"substr(sha256('{generate.GENERATOR_VERSION}' || chr(0) || '{generate.ROOT_SEED}' || chr(0) || family_id || chr(0) || ordinal), 1, 32)"
    return f"SELECT *, {seed} AS seed FROM ({' UNION ALL '.join(each)})"


# A machine in a state takes one command only, so that what it takes from a start on is one endless series.
@query(
    f"""WITH a AS (SELECT family_id, ordinal, (ordinal + shift) % 59049 AS x FROM ({_ordinals_sql("mode_transition")})),
b AS (SELECT family_id, ordinal, x % 3 AS st, list_transform(range(0, 9), lambda i: CAST(x // CAST(power(3, i + 1) AS BIGINT) % 3 AS BIGINT)) AS d FROM a),
c AS (SELECT *, [[0, 1, 2, 1, 2, 1, 2, 1, 2], [1, 2, 1, 2, 1, 2, 1, 2, 1], [2, 1, 2, 1, 2, 1, 2, 1, 2]][st + 1] AS taken FROM b),
e AS (SELECT *, coalesce(list_min(list_filter(range(1, 10), lambda i: d[i] <> taken[i])), 10) - 1 AS n FROM c),
g AS (SELECT *, CASE WHEN n = 0 THEN ['idle', 'active', 'paused'][st + 1] WHEN taken[n] = 1 THEN 'paused' ELSE 'active' END AS state FROM e)
SELECT family_id, ordinal, ['idle', 'active', 'paused'][st + 1] AS initial_state, list_transform(d, lambda v: ['start', 'pause', 'resume'][v + 1]) AS commands,
CASE WHEN n = 9 THEN state ELSE 'step ' || (n + 1) || ' rejected in ' || state END AS answer FROM g"""
)
def generated_state_machine(spark, sf_dir):
    return _records(spark).where("generator_id = 'mode_transition'").select("family_id", "ordinal", "task.initial_state", "task.commands", "answer")


@query(
    f"""WITH a AS (SELECT family_id, ordinal, (2 * ordinal + shift) % 40401 AS cell, {_drawn(9, 0, 4**8 - 1)} AS bits, {_drawn(8, 0, 7)} + 1 AS n FROM ({_ordinals_sql("location")})),
b AS (SELECT family_id, ordinal, cell % 201 - 100 AS x, cell // 201 - 100 AS y,
  list_transform(range(0, n), lambda i: ['north', 'south', 'east', 'west'][CAST(bits // CAST(power(4, i) AS BIGINT) % 4 AS BIGINT) + 1]) AS moves FROM a)
SELECT family_id, ordinal, x, y, moves,
(x + len(list_filter(moves, lambda m: m = 'east')) - len(list_filter(moves, lambda m: m = 'west'))) || ', ' ||
(y + len(list_filter(moves, lambda m: m = 'north')) - len(list_filter(moves, lambda m: m = 'south'))) AS answer FROM b"""
)
def generated_location(spark, sf_dir):
    return _records(spark).where("generator_id = 'location'").select("family_id", "ordinal", "task.start.x", "task.start.y", "task.moves", "answer")


def _scenario_sql() -> str:
    names = "[" + ", ".join(f"'{x}'" for x in generate.DIALOGUE_SCENARIOS) + "]"
    each = [
        f"SELECT '{f['split']}' AS split, '{f['language']}' AS language, '{f['family_id']}' AS family_id, '{f['task_kind']}' AS kind, "
        + (f"{names}[i % 7 + 1]" if f["task_kind"] == "identity" else f"'{f['scenario'] or f['operation'] or 'default'}'")
        + f" AS scenario FROM range({f['records_per_family']}) t(i)"
        for f in _counted()
    ]
    return " UNION ALL ".join(each)


@query(
    f"""WITH x AS (SELECT split, language, family_id, CASE WHEN kind = 'identity' THEN 'identity_foundation' ELSE 'synthetic_reasoning' END AS category, scenario FROM ({_scenario_sql()}))
SELECT split, language, family_id, category, scenario, CAST(grouping(split, language, family_id, category, scenario) AS BIGINT) AS grouping, count(*) AS records FROM x
GROUP BY GROUPING SETS ((split, language), (family_id), (category), (scenario))"""
)
def record_counts(spark, sf_dir):
    rows = _records(spark).withColumn("scenario", F.coalesce("task.scenario", "task.operation", F.lit("default")))
    return profile.counts(rows, [["split", "language"], ["family_id"], ["category"], ["scenario"]])


@query(f"SELECT count(*) AS records, count(*) AS verified FROM range({sum(f["records_per_family"] for f in _counted())})")
def verified_records(spark, sf_dir):
    rows = verify.verified(_records(spark))
    return rows.agg(F.count("*").alias("records"), F.count_if(F.col("reject_reason").isNull()).alias("verified"))


@query(f"SELECT count(*) AS records, count(*) AS admitted FROM range({sum(f["records_per_family"] for f in _counted())})")
def admitted_records(spark, sf_dir):
    rows = verify.admitted(_records(spark), generate.families(spark, _counted(), FAMILY_RECORDS), generate.ROOT_SEED)
    return rows.agg(F.count("*").alias("records"), F.count_if(F.col("reject_reason").isNull()).alias("admitted"))


@query(f"SELECT generator_id, n::BIGINT AS records, n::BIGINT AS rejected FROM (VALUES {', '.join(f'({chr(39)}{k}{chr(39)}, {sum(f['records_per_family'] for f in _counted() if f['task_kind'] == k)})' for k in ('arithmetic', 'mode_transition', 'inventory', 'location', 'grounded_action', 'identity'))}) t(generator_id, n)")
def tampered_records(spark, sf_dir):
    """Every answer is changed: the verifier must reject every record."""
    rows = verify.verified(_records(spark).withColumn("answer", F.concat(F.col("answer"), F.lit("0"))))
    return rows.groupBy("generator_id").agg(F.count("*").alias("records"), F.count_if(F.col("reject_reason") == "answer").alias("rejected"))


@query(
    "SELECT * FROM (VALUES ('xx.tongue', 'language'), ('en.twice', 'family_id'), ('en.twice', 'family_id'), ('en.left', 'isolation'), ('en.right', 'isolation'),"
    " ('en.kind', 'task_kind'), ('en.scene', 'scenario'), ('en.part', 'split')) t(family_id, reject_reason)"
)
def family_validation(spark, sf_dir):
    """Eight broken families among good ones: each must be named with its reason, and no other."""
    plain = {"language": "en", "split": "train", "task_kind": "identity"}
    broken = [{"family_id": "xx.tongue", "language": "xx"}, {"family_id": "en.twice"}, {"family_id": "en.twice"}, {"family_id": "en.left", "template_family": "shared"},
              {"family_id": "en.right", "template_family": "shared", "split": "blind"}, {"family_id": "en.kind", "task_kind": "riddle"},
              {"family_id": "en.scene", "task_kind": "grounded_action", "scenario": "flight"}, {"family_id": "en.part", "split": "test"}]
    groups = lambda i: {g: f"broken{i}.{g}" for g in ("functional_family", "template_family", "scenario_family")}
    rows = _families() + [plain | groups(i) | b for i, b in enumerate(broken)]
    return verify.family_reasons(generate.families(spark, rows, 1))


@query("SELECT 'en.location.blind' AS family_id, 50000::BIGINT AS records_per_family, 40401 AS space UNION ALL SELECT 'ru.location.blind', 50000, 40401 UNION ALL SELECT 'en.arithmetic.divide.blind', 50000, 9216 UNION ALL SELECT 'ru.arithmetic.divide.blind', 50000, 9216")
def capacity_guard(spark, sf_dir):
    return verify.capacity_reasons(generate.families(spark, _families(), 50_000))


@query(f"SELECT split, lang AS language, n::BIGINT AS records FROM (VALUES " + ", ".join(f"('{s}', '{g}', {sum(f['records_per_family'] for f in _counted() if f['split'] == s and f['language'] == g)})" for s in ("train", "validation", "blind") for g in ("en", "ru")) + ") t(split, lang, n)")
def generated_counts(spark, sf_dir):
    return _records(spark).groupBy("split", "language").agg(F.count("*").alias("records"))


def _concepts_sql() -> str:
    """(concept_pos, lang_pos, domain, ordinal, text) of all records, from the generator's words."""
    quote = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
    words = [(d, pair) for d, pairs in generate.CONCEPTS.items() for pair in pairs]
    each = []
    for g, (lang, marks) in enumerate((("en", '""'), ("ru", "«»"))):
        said = f"{quote(generate.LEADS[lang])}[i % 16 + 1] || ' {marks[0]}' || {quote([pair[g] for _, pair in words])}[c + 1] || '{marks[1]} ' || {quote(generate.ENDINGS[lang])}[i // 16 + 1] || '.'"
        each.append(f"SELECT c::INT AS concept_pos, {g} AS lang_pos, {quote([d for d, _ in words])}[c + 1] AS domain, i::INT AS ordinal, {said} AS text FROM range({len(words)}) a(c), range(128) b(i)")
    return " UNION ALL ".join(each)


@query(f"SELECT concept_pos, lang_pos, domain, ordinal, sha256(text) AS text_sha256 FROM ({_concepts_sql()})")
def concept_records(spark, sf_dir):
    return generate.concept_records(spark, 128).select("concept_pos", "lang_pos", "domain", "ordinal", "text_sha256")


_LANGUAGE_FAULTS = {"schema": "x", "purpose": "x", "generator_version": "x", "language": "xx", "text": "<|user|>", "text_sha256": "0", "provenance": "", "seed": "0", "record_id": "0"}


@query(
    f"""SELECT concept_pos, lang_pos, ordinal, ['{"', '".join("identity" if f == "record_id" else f for f in _LANGUAGE_FAULTS)}', 'duplicate'][ordinal + 1] AS reject_reason
FROM (SELECT * FROM ({_concepts_sql()}) UNION ALL SELECT * FROM ({_concepts_sql()}) WHERE ordinal = {len(_LANGUAGE_FAULTS)}) WHERE ordinal <= {len(_LANGUAGE_FAULTS)}"""
)
def language_record_scan(spark, sf_dir):
    """The first nine records of a concept have one broken field each, and the tenth is there twice: these must be named, and no other."""
    rows = generate.concept_records(spark, 128)
    broken = rows.withColumns({f: F.when(F.col("ordinal") == i, v).otherwise(F.col(f)) for i, (f, v) in enumerate(_LANGUAGE_FAULTS.items())})
    again = rows.where(F.col("ordinal") == len(_LANGUAGE_FAULTS))
    scanned = verify.language_record_reasons(broken.unionByName(again), generate.ROOT_SEED)
    return scanned.where("reject_reason IS NOT NULL").select("concept_pos", "lang_pos", "ordinal", "reject_reason")


@query(f"SELECT domain, count(*) AS records, sum(length(text))::BIGINT AS chars FROM ({_concepts_sql()}) GROUP BY domain")
def concept_profile(spark, sf_dir):
    return profile.lexical_profile(generate.concept_records(spark, 128), ["domain"], "text").select("domain", "records", "chars")


@query("SELECT (i * 3 + j) * 2 + k AS ordinal, 'c' || i || ' q' || j || ' f' || k AS prompt FROM range(0, 4) a(i), range(0, 3) b(j), range(0, 2) c(k)")
def cartesian_prompts(spark, sf_dir):
    return generate.cartesian_prompts(spark, [f"c{i}" for i in range(4)], [f"q{j}" for j in range(3)], [f"f{k}" for k in range(2)])


_LOSS = "(doc_id % 97) / CAST(32 AS DOUBLE)"


@query(f"SELECT lang, quality, toxic, sum(strlen(text))::BIGINT AS tokens, sum({_LOSS} * strlen(text)) / sum(strlen(text)) AS loss, round(exp(least(sum({_LOSS} * strlen(text)) / sum(strlen(text)), 20)), 6) AS perplexity FROM documents JOIN labels USING (doc_id) GROUP BY lang, quality, toxic")
def token_weighted_eval(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    return evaluate.weighted_loss(rows, ["lang", "quality", "toxic"], (F.col("doc_id") % 97) / F.lit(32.0), BYTES("text").cast("long")).withColumn("perplexity", F.round("perplexity", 6))


@query("SELECT event_id, event_type, round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS moving_mean FROM events")
def moving_average_metric(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return evaluate.moving_mean(rows, ["event_type"], ["ts", "event_id"], "value", 10).select("event_id", "event_type", F.round("moving_mean", 6).alias("moving_mean"))


@query("SELECT lang, count(*) AS rows, round(avg((strlen(text) - length(text)) / CAST(greatest(strlen(text), 1) AS DOUBLE)), 9) AS unknown_rate FROM documents GROUP BY lang")
def unknown_rates(spark, sf_dir):
    return evaluate.unknown_rate(_docs(spark, sf_dir), ["lang"], BYTES("text") - F.length("text"), BYTES("text")).withColumn("unknown_rate", F.round("unknown_rate", 9))


@query("SELECT lang, count(*) FILTER (quality = 1 - toxic) AS matches, count(*) AS rows FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def exact_match_rate(spark, sf_dir):
    rows = _docs(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    return evaluate.exact_match(rows, ["lang"], F.col("quality"), 1 - F.col("toxic"))


@query(
    """SELECT s AS step, round(CASE WHEN s < 30 THEN greatest(s, 1) / CAST(30 AS DOUBLE) ELSE 0.1::DOUBLE + 0.9::DOUBLE * 0.5::DOUBLE * (1 + cos(pi() * least((s - 30) / CAST(970 AS DOUBLE), 1.0::DOUBLE))) END, 9) AS cosine,
round(CASE WHEN s < 30 THEN greatest(s, 1) / CAST(30 AS DOUBLE) WHEN s < 800 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE + 0.9::DOUBLE * 0.5::DOUBLE * (1 + cos(pi() * least((s - 800) / CAST(200 AS DOUBLE), 1.0::DOUBLE))) END, 9) AS stable FROM range(0, 1001) t(s)"""
)
def lr_schedule(spark, sf_dir):
    s = F.col("id")
    return spark.range(1001).select(s.alias("step"), F.round(curves.warmup_cosine(s, 30, 1000, 0.1), 9).alias("cosine"), F.round(curves.warmup_stable_decay(s, 30, 1000, 0.8, 0.1), 9).alias("stable"))


@query("SELECT w AS width, (65536 * w + 32 * (2 * w * w + 2 * w * (w // 4) + 12 * w * w + 2 * w) + w)::BIGINT AS parameters, (65536 * w + 32 * (2 * w * w + 2 * w * (w // 4) + 12 * w * w + 2 * w) + w)::BIGINT * 16 AS bytes FROM range(1024, 4097, 1024) t(w)")
def parameter_estimate(spark, sf_dir):
    w = F.col("id")
    p = curves.decoder_parameters(F.lit(65_536), w, F.lit(32), F.lit(16), F.lit(4), w * 4)
    return spark.range(1024, 4097, 1024).select(w.alias("width"), p.alias("parameters"), curves.training_bytes(p).alias("bytes"))


@query(
    """WITH e AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 3 = 0 THEN value END AS v, CASE WHEN event_id % 5 = 0 THEN event_id END AS ck FROM events)
SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, arg_max(v, (ts, event_id)) FILTER (v IS NOT NULL) AS loss, arg_max(ck, (ts, event_id)) FILTER (ck IS NOT NULL) AS checkpoint,
arg_max(ck, (ts, event_id)) FILTER (ck IS NOT NULL) AS last_checkpoint FROM e GROUP BY user_id"""
)
def ledger_status(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    log = e.select("user_id", "ts", "event_id", F.col("event_type").alias("status"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("loss"), F.when(F.col("event_id") % 5 == 0, F.col("event_id")).alias("checkpoint"))
    return evaluate.latest_status(log, "user_id", ["ts", "event_id"], ["loss", "checkpoint"])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def event_dedup(spark, sf_dir):
    return audit.keep_first(_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query(
    """WITH s AS (SELECT CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 32) AS BIGINT) AS step, user_id FROM events), t AS (SELECT step, sum(user_id)::BIGINT AS tokens FROM s GROUP BY step),
b AS (SELECT *, coalesce(sum(tokens) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS consumed_before FROM t) SELECT * FROM b WHERE consumed_before < 10000"""
)
def budget_stop(spark, sf_dir):
    rows = pack.batches(_table(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"], 8, 4)
    return mix.within_budget(rows.groupBy("step").agg(F.sum("user_id").alias("tokens")), ["step"], "tokens", 10_000)


@query(
    """WITH d AS (SELECT doc_id AS path, sha256(text) AS h FROM documents WHERE doc_id % 11 <> 0), a AS (SELECT doc_id AS path, sha256(CASE WHEN doc_id % 13 = 0 THEN text || 'x' ELSE text END) AS h FROM documents WHERE doc_id % 17 <> 0)
SELECT coalesce(d.path, a.path) AS path, CASE WHEN a.h IS NULL THEN 'missing' WHEN d.h IS NULL THEN 'extra' WHEN a.h <> d.h THEN 'mismatched' ELSE 'ok' END AS state FROM d FULL JOIN a USING (path)"""
)
def file_inventory(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(F.col("doc_id").alias("path"), "text")
    declared = rows.where("path % 11 <> 0").select("path", tx.content_hash(F.col("text")).alias("sha256"))
    other = F.when(F.col("path") % 13 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return audit.inventory(declared, rows.where("path % 17 <> 0").select("path", tx.content_hash(other).alias("sha256")))


@query("SELECT 0::BIGINT AS missing, count(*) AS extra, false AS equal FROM documents WHERE doc_id = 5")
def dataset_equality(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", "text")
    return audit.same_rows(rows.where("doc_id <> 5"), rows)


@query("SELECT doc_id, CASE WHEN trim(text) <> '' THEN strlen(nfc_normalize(text)) END::INT AS tokens, CASE WHEN trim(text) = '' THEN 'blank' END AS reason, CASE WHEN trim(text) <> '' THEN nfc_normalize(text) = text END AS equal FROM documents WHERE text IS NOT NULL")
def encoded_round_trip(spark, sf_dir):
    encode, decode = tk.encoder(tk.ByteTokenizer), tk.decoder(tk.ByteTokenizer, {1: "<s>"})
    rows = _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", "text", encode(F.col("text")).alias("e"))
    return rows.select("doc_id", F.size("e.ids").alias("tokens"), "e.reason", (decode(F.col("e.ids")) == F.col("text")).alias("equal"))


@query("SELECT [0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18] AS controls")
def suppressed_controls(spark, sf_dir):
    return spark.range(1).select(tk.suppressed(2).alias("controls"))


_CAPPED_SQL = """WITH RECURSIVE o AS (SELECT lang, doc_id, length(text) AS n, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
r AS (SELECT lang, doc_id, rn, n <= 30000 AS taken, CASE WHEN n <= 30000 THEN n ELSE 0 END AS used FROM o WHERE rn = 1
UNION ALL SELECT o.lang, o.doc_id, o.rn, r.used + o.n <= 30000, CASE WHEN r.used + o.n <= 30000 THEN r.used + o.n ELSE r.used END FROM r JOIN o ON o.lang = r.lang AND o.rn = r.rn + 1)
SELECT lang, doc_id FROM r WHERE taken"""


@query(_CAPPED_SQL)
def capped_source(spark, sf_dir):
    from ..sources.readers import capped

    return capped(_docs(spark, sf_dir).select("lang", "doc_id", "text"), ["doc_id"], "text", 30_000, ["lang"]).select("lang", "doc_id")
