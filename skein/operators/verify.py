"""Independent verification of records: reject reasons as columns. Nothing here is shared with the generator.

A reason is null for a good row. ``strict`` turns the first reason into an error, for pipelines that must fail fast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contract_reject
from ..policy import GENERATOR_VERSION, GROUNDED_SCENARIOS, LANGUAGE_PURPOSE, LANGUAGE_SCHEMA, LANGUAGES, SPLITS, TASK_KINDS
from . import registry

REQUIRED = [
    "record_id", "text", "prompt", "answer", "language", "split", "family_id", "functional_family", "template_family",
    "scenario_family", "functional_signature", "category", "generator_id", "generator_version", "seed", "answer_verifier",
    "verifier_version", "validation_status", "task_sha256", "text_sha256",
]


# What an assistant may say of itself, written down apart from the generator's.
IDENTITY_ANSWERS = {
    "en/name": "I am called Skein.", "en/creator": "The Skein project built me.", "en/type": "I am a language model.",
    "en/false_attribution": "No, the Skein project built me.", "en/multi_turn": "Yes, I am still called Skein.", "en/boundaries": "No, I only read text.",
    "ru/name": "Меня зовут Skein.", "ru/creator": "Меня построил проект Skein.", "ru/type": "Я языковая модель.",
    "ru/false_attribution": "Нет, меня построил проект Skein.", "ru/multi_turn": "Да, меня всё так же зовут Skein.", "ru/boundaries": "Нет, я только читаю текст.",
}


def first_reason(**checks: Column) -> Column:
    """Name of the first check that fails (is false or null), or null."""
    out = None
    for name, ok in checks.items():
        bad = ~F.coalesce(ok, F.lit(False))
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return out if out is not None else F.lit(None).cast("string")


def strict(df: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """df without its reason column; reading a rejected row is an error."""
    kept = F.when(F.col(reason).isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("rejected: "), F.col(reason))).cast("boolean"))
    return df.where(kept).drop(reason)


def _expected(t: Column) -> Column:
    """The answer that a task payload asks for, worked out anew."""
    left, right, op = t["left"], t["right"], t["operation"]
    calc = (
        F.when(op == "add", left + right)
        .when(op == "subtract", left - right)
        .when(op == "multiply", left * right)
        .when((op == "divide") & (right != 0), F.when(F.pmod(left, F.when(right != 0, right)) == 0, (left / F.when(right != 0, right)).cast("long")))
    )
    # states as numbers: each command moves on from one state only
    index = lambda s: F.array_position(F.array(F.lit("idle"), F.lit("active"), F.lit("paused")), s)
    source = lambda c: F.when(c == "start", 1).when(c == "pause", 2).when(c == "resume", 3)
    target = lambda c: F.when(c == "pause", 3).otherwise(2)
    walk = F.aggregate(
        t["commands"],
        F.struct(index(t["initial_state"]).cast("int").alias("s"), F.lit(0).alias("n"), F.lit(False).alias("stop")),
        lambda a, c: F.struct(
            F.when(~a["stop"] & (source(c) == a["s"]), target(c)).otherwise(a["s"]).cast("int").alias("s"),
            F.when(a["stop"], a["n"]).otherwise(a["n"] + 1).alias("n"),
            (a["stop"] | F.coalesce(source(c) != a["s"], F.lit(True))).alias("stop"),
        ),
    )
    state = F.element_at(F.array(F.lit("idle"), F.lit("active"), F.lit("paused")), F.when(walk["s"] > 0, walk["s"]))
    mode = F.when(walk["stop"], F.concat(F.lit("step "), walk["n"].cast("string"), F.lit(" rejected in "), state)).otherwise(state)
    moved = F.transform(t["changes"], lambda c: F.when(c["action"] == "add", c["count"]).when(c["action"] == "remove", -c["count"]))
    left_over = t["initial"] + F.aggregate(moved, F.lit(0).cast("long"), lambda a, x: a + x)
    count = lambda m: F.size(F.filter(t["moves"], lambda x: x == m))
    place = F.concat_ws(", ", (t["start"]["x"] + count("east") - count("west")).cast("string"), (t["start"]["y"] + count("north") - count("south")).cast("string"))
    yes, no = F.when(t["language"] == "ru", "ДА").otherwise("YES"), F.when(t["language"] == "ru", "НЕТ").otherwise("NO")
    truth = (
        F.when(t["scenario"] == "stop_obstacle", t["obstacle_cm"] <= t["braking_cm"])
        .when(t["scenario"] == "cancel_action", F.lit(False))
        .when(t["scenario"] == "object_presence", F.array_contains(t["visible"], t["requested"]))
        .when(t["scenario"] == "action_sequence", t["completed"] == t["required"])
    )
    said = F.create_map(*[F.lit(x) for key, answer in IDENTITY_ANSWERS.items() for x in (key, answer)])
    spoken = F.when(t["scenario"] == "task_switch", (left + right).cast("string")).otherwise(F.element_at(said, F.concat_ws("/", t["language"], t["scenario"])))
    return (
        F.when(t["kind"] == "arithmetic", calc.cast("string"))
        .when(t["kind"] == "mode_transition", mode)
        .when((t["kind"] == "inventory") & (left_over >= 0), left_over.cast("string"))
        .when(t["kind"] == "location", place)
        .when(t["kind"] == "grounded_action", F.when(truth, yes).otherwise(no))
        .when(t["kind"] == "identity", spoken)
    )


def _in_range(t: Column) -> Column:
    """State ranges of grounded tasks."""
    return (
        F.when(t["kind"] != "grounded_action", True)
        .when(t["number"] < 0, False)
        .when(t["scenario"] == "stop_obstacle", t["obstacle_cm"].between(1, 2400) & t["braking_cm"].between(10, 900) & t["action"].isNotNull())
        .when(t["scenario"] == "cancel_action", t["action"].isNotNull())
        .when(t["scenario"] == "object_presence", F.size(t["visible"]).between(1, 6))
        .when(t["scenario"] == "action_sequence", (F.size(t["required"]) == 4) & (F.size(t["completed"]) >= 3))
        .otherwise(False)
    )


def _verifier(t: Column) -> Column:
    return (
        F.when(t["kind"] == "arithmetic", F.concat(F.lit("arithmetic."), t["operation"]))
        .when(t["kind"].isin("mode_transition", "inventory", "location"), F.concat(F.lit("state."), t["kind"]))
        .when(t["kind"].isin("grounded_action", "identity"), F.concat(t["kind"], F.lit("."), t["scenario"]))
    )


def answer_reason(task: str = "task", answer: str = "answer", verifier: str = "answer_verifier") -> Column:
    """Why an answer is not its task's: verifier, range or answer. Kinds with a registered verifier are its own: answer only."""
    t = F.col(task)
    own = first_reason(verifier=F.col(verifier) == _verifier(t), range=_in_range(t), answer=F.col(answer) == _expected(t))
    registered = F.when(~F.col(answer).eqNullSafe(registry.expected(task)), "answer")
    return F.when(registry.has_verifier(task), registered).otherwise(own)


def verified(records: DataFrame) -> DataFrame:
    return records.withColumn("reject_reason", answer_reason())


def admitted(records: DataFrame, families: DataFrame, root: int) -> DataFrame:
    """records with reject_reason: required columns, family conformity, replayed seed and identities, rendering and checksums."""
    hashed = lambda *xs: F.sha2(F.concat_ws("\u0000", *[F.coalesce(x.cast("string"), F.lit("")) for x in xs]).cast("binary"), 256)
    c = F.col
    family_columns = ["language", "split", "functional_family", "template_family", "scenario_family", "task_kind"]
    known = families.select("family_id", F.struct(*family_columns).alias("__family"))
    # families are configuration: a table of fixed, small size
    rows = records.join(F.broadcast(known), "family_id", "left")
    conform = [c(x) == c(f"__family.{x}") for x in family_columns[:-1]] + [c("generator_id") == c("__family.task_kind")]
    every = conform[0]
    for x in conform[1:]:
        every = every & x
    filled = F.lit(True)
    for name in REQUIRED:
        filled = filled & c(name).isNotNull() & (F.btrim(c(name)) != "")
    reason = first_reason(
        required=filled,
        family=c("__family").isNotNull(),
        conformity=every & (c("category") == F.when(c("generator_id") == "identity", "identity_foundation").otherwise("synthetic_reasoning")),
        seed=c("seed") == F.substring(hashed(c("generator_version"), F.lit(root), c("family_id"), c("ordinal")), 1, 32),
        identity=c("record_id") == hashed(c("generator_version"), c("family_id"), c("ordinal"), c("seed")),
        signature=c("functional_signature") == hashed(c("task.kind"), c("task.operation"), c("functional_family")),
        rendering=c("text") == F.concat(F.lit("User: "), c("prompt"), F.lit("\nAssistant: "), c("answer")),
        text_checksum=c("text_sha256") == F.sha2(c("text").cast("binary"), 256),
        task_checksum=c("task_sha256") == hashed(F.to_json("task", {"ignoreNullFields": "false"})),
        status=c("validation_status") == "verified",
    )
    return rows.withColumn("reject_reason", F.coalesce(reason, answer_reason())).drop("__family")


def family_reasons(families: DataFrame) -> DataFrame:
    """(family_id, reject_reason) of families with unknown values, repeated ids, or a group that crosses splits."""
    groups = families.select(
        "split", F.explode(F.array(*[F.struct(F.lit(g).alias("field"), F.col(g).alias("name")) for g in ("functional_family", "template_family", "scenario_family")])).alias("g")
    )
    crossing = groups.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").select("g.field", "g.name")
    bad = {f: crossing.where(F.col("field") == f).select(F.col("name").alias(f), F.lit(True).alias(f"__{f}")) for f in ("functional_family", "template_family", "scenario_family")}
    rows = families.join(families.groupBy("family_id").agg(F.count("*").alias("__times")), "family_id")
    for f, df in bad.items():
        rows = rows.join(df, f, "left")
    c = F.col
    reason = first_reason(
        family_id=(c("family_id") != "") & (c("__times") == 1),
        language=c("language").isin(*LANGUAGES),
        split=c("split").isin(*SPLITS),
        task_kind=c("task_kind").isin(*TASK_KINDS),
        scenario=(c("task_kind") != "grounded_action") | c("scenario").isin(*GROUNDED_SCENARIOS),
        isolation=c("__functional_family").isNull() & c("__template_family").isNull() & c("__scenario_family").isNull(),
    )
    return rows.select("family_id", reason.alias("reject_reason")).where("reject_reason IS NOT NULL")


def capacity_reasons(families: DataFrame, location: int = 201 * 201, divide: int = 96**2, operands: int = 9998**2) -> DataFrame:
    """Families that ask for more records than their space has."""
    space = F.when(F.col("task_kind") == "location", location).when(
        F.col("task_kind") == "arithmetic", F.when(F.col("operation") == "divide", divide).otherwise(operands)
    )
    return families.where(F.col("records_per_family") > space).select("family_id", "records_per_family", space.alias("space"))


def language_record_reasons(records: DataFrame, root: int) -> DataFrame:
    """Tokenizer-language records with reject_reason: schema, purpose, version, language, text, checksum, provenance, seed, identity,
    and duplicate for a text that another record has, too."""
    c = F.col
    hashed = lambda *xs: F.sha2(F.concat_ws("\u0000", *[x.cast("string") for x in xs]).cast("binary"), 256)
    origin = [F.lit(GENERATOR_VERSION), F.lit(root), c("family_id"), c("language"), c("ordinal")]
    digest = F.sha2(c("text").cast("binary"), 256)
    often = records.where("text IS NOT NULL").groupBy(digest.alias("__digest")).agg(F.count("*").alias("__n")).where("__n > 1")
    reason = first_reason(
        schema=c("schema") == LANGUAGE_SCHEMA,
        purpose=c("purpose") == LANGUAGE_PURPOSE,
        generator_version=c("generator_version") == GENERATOR_VERSION,
        language=c("language").isin(*LANGUAGES),
        text=contract_reject(c("text")).isNull(),
        text_sha256=c("text_sha256") == digest,
        provenance=(c("ordinal") >= 0) & (c("family_id") != "") & (c("provenance") != ""),
        seed=c("seed") == F.substring(hashed(*origin), 1, 32),
        identity=c("record_id") == hashed(*origin, c("seed")),
        duplicate=c("__n").isNull(),
    )
    return records.join(often, digest == c("__digest"), "left").withColumn("reject_reason", reason).drop("__digest", "__n")
