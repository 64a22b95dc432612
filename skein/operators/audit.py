"""Duplicates, near duplicates and leakage across splits, and file inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_prompt, content_hash, shingles, words
from ..policy import NEAR_JACCARD, SHINGLE_WORDS
from .ordering import fixed


def split_of_source(source: Column) -> Column:
    """Split of a source family: sources 0 to 15 train, 16 and 17 validation, the rest blind."""
    n = F.regexp_extract(source, r"(\d+)$", 1).cast("int")
    return F.when(n < 16, "train").when(n < 18, "validation").otherwise("blind")


def exact_duplicates(df: DataFrame, by: list[str], hash_col: str) -> DataFrame:
    """Per group: records, and how many repeat a hash of the group. Repeats within a group are counted, never dropped."""
    each = df.groupBy(*by, hash_col).agg(F.count("*").alias("__n"))
    return each.groupBy(*by).agg(F.sum("__n").alias("records"), (F.sum("__n") - F.count("*")).alias("exact_duplicates"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the least by ``order``; an aggregate, so that a hot key is reduced before it is shuffled."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("__row")
    picked = df.groupBy(*keys).agg(least)
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, where a repeat must fail."""
    return df.groupBy(*keys).agg(F.count("*").alias("times")).where("times > 1")


def cross_split(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split, and in which."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(split)).alias("splits")).where(F.size("splits") > 1)


def leakage(df: DataFrame, kinds: dict[str, str], split: str = "split") -> DataFrame:
    """(kind, identity, splits) of identities that cross splits; ``kinds`` maps a kind to its column."""
    stacked = df.select(split, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("identity")) for k, c in kinds.items()])).alias("x"))
    return (
        stacked.groupBy("x.kind", "x.identity")
        .agg(F.array_sort(F.collect_set(split)).alias("splits"))
        .where((F.size("splits") > 1) & F.col("identity").isNotNull())
    )


def prompt_sets(df: DataFrame, id_col: str, text_col: str, split: str = "split", width: int = SHINGLE_WORDS) -> DataFrame:
    """(split, digest, doc, shingles) of distinct canonical prompts of each split; doc is the least id.

    Prompts are told apart by their digests; no text is a key of a shuffle.
    """
    rows = df.select(F.col(split).alias("split"), F.col(id_col).alias("doc"), canonical_prompt(F.col(text_col)).alias("prompt"))
    # prompts are shuffled, of which repeats go, and not their shingles: hashes are longer than words, and are not compressed
    least = F.min(F.struct("doc", "prompt")).alias("x")
    rows = rows.withColumn("digest", content_hash(F.col("prompt"))).groupBy("split", "digest").agg(least)
    rows = rows.select("split", "x.doc", "digest", words(F.col("x.prompt")).alias("words"))
    return rows.select("split", "doc", "digest", F.transform(shingles(F.col("words"), width), lambda x: F.xxhash64(x)).alias("shingles"))


#: Tables of at most so many rows of ids or hashes are broadcast.
FEW = 1 << 19


def _few(df: DataFrame) -> DataFrame | None:
    """df, which is checkpointed, as a broadcast; nothing where it has over FEW rows."""
    return F.broadcast(df) if df.count() <= FEW else None


def near_duplicates(left: DataFrame, right: DataFrame, least: float = NEAR_JACCARD, apart: str | None = None) -> DataFrame:
    """(doc_l, doc_r, jaccard) of pairs of two prompt sets with a Jaccard similarity of ``least`` or more.

    Prefix filter: in an order that both sides share, two such sets have a common member among the first
    n - ceil(least n) + 1 of either. The order is by halves of the hashes, in each by rarity, so that members of the second half
    are counted and shuffled for those sets only whose prefix reaches it. Candidates pass the length and the positional filter, and
    are verified on their sets. With ``apart``, pairs whose values of that column differ, each once: train first, then validation.
    """
    same = left is right
    columns = ["doc", "shingles", *[apart] * (apart is not None)]
    turn = lambda c: F.when(F.col(c) == "train", 0).when(F.col(c) == "validation", 1).otherwise(2)
    n, low = F.size("shingles"), F.filter("shingles", lambda x: x >= 0)

    def reached(x: DataFrame) -> DataFrame:
        prefix = (n - F.ceil(n * least - 1e-9) + 1).cast("int")
        x = fixed(x.select(*columns)).withColumns({"size": n, "low": F.size(low), "prefix": prefix})
        return x.withColumn("members", F.when(F.col("low") >= prefix, low).otherwise(F.col("shingles")))

    sides = [reached(x) for x in ((left,) if same else (left, right))]
    sides = sides * (2 if same else 1)
    groups = [turn(apart) if apart else F.lit(0)] if same else [F.lit(0), F.lit(1)]
    each = [x.select(F.explode("members").alias("member"), g.alias("g")) for x, g in zip(sides, groups)]
    if not same:
        # members that the right side lacks join nothing
        known = fixed(each[1].select("member").distinct())
        each[0] = each[0].join(_few(known) or known, "member", "left_semi")
    counted = (each[0] if same else each[0].unionByName(each[1])).groupBy("member")
    counted = counted.agg(F.count("*").alias("n"), F.min("g").alias("g0"), F.max("g").alias("g1"))
    # members of one set only, or of sets of one kind only, join nothing
    often = fixed(counted.where("n > 1" if same and not apart else "g0 < g1").select("member", "n"))
    often = _few(often) or often

    def side(sets: DataFrame, s: str) -> tuple[DataFrame, DataFrame]:
        held = sets.select("doc", *columns[2:], "size", "low", "prefix", F.explode("members").alias("member")).join(often, "member")
        # in each half what is rare comes first; members that join nothing are rarer than all others
        row = ["doc", *columns[2:], "size", "low", "prefix"]
        order = F.sort_array(F.collect_list(F.struct((F.col("member") < 0).alias("half"), "n", "member"))).alias("order")
        rows = held.groupBy(*row).agg(order).withColumn("low_order", F.size(F.filter("order", lambda x: ~x["half"])))
        first = rows.select(*row, "low_order", F.size("order").alias("joined"), F.posexplode("order").alias("place", "x"))
        ahead = F.when(F.col("x.half"), F.col("size") - F.col("joined")).otherwise(F.col("low") - F.col("low_order"))
        first = first.withColumn("place", F.col("place") + ahead).where("place < prefix")
        named = {"doc": f"doc_{s}", "size": f"n_{s}", "place": f"place_{s}", **({apart: f"apart_{s}"} if apart else {})}
        first = first.select(*[F.col(a).alias(b) for a, b in named.items()], F.col("x.member").alias("member"))
        whole = sets.select(F.col("doc").alias(f"doc_{s}"), F.col("shingles").alias(f"set_{s}"), *[F.col(c).alias(f"apart_{s}") for c in columns[2:]])
        return whole, first

    whole_l, first_l = side(sides[0], "l")
    whole_r, first_r = side(sides[1], "r")
    need = F.ceil((F.col("n_l") + F.col("n_r")) * (least / (1 + least)) - 1e-9)
    keep = (F.least("n_l", "n_r") >= F.greatest("n_l", "n_r") * least - 1e-9) & (F.least(F.col("n_l") - F.col("place_l"), F.col("n_r") - F.col("place_r")) >= need)
    ends = ["doc_l", "doc_r"]
    if apart:
        keep, ends = keep & (turn("apart_l") < turn("apart_r")), [*ends, "apart_l", "apart_r"]
    pairs = first_l.join(first_r.withColumnRenamed("member", "member_r"), (F.col("member") == F.col("member_r")) & keep).select(*ends).distinct()
    full = pairs = fixed(pairs)
    for whole, s in ((whole_l, "_l"), (whole_r, "_r")):
        key = [c for c in ends if c.endswith(s)]
        # sets of no pair are not shuffled, where the pairs' ends are few
        met = _few(fixed(pairs.select(*key).distinct()))
        full = full.join(whole if met is None else whole.join(met, key, "left_semi"), key)
    common = F.size(F.array_intersect("set_l", "set_r"))
    score = common / (F.size("set_l") + F.size("set_r") - common)
    return full.select("doc_l", "doc_r", score.alias("jaccard")).where(F.col("jaccard") >= least)


def inventory(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, state) of files of two (path, sha256) tables: ok, missing, extra or mismatched."""
    d, a = declared.select("path", F.col("sha256").alias("d")), actual.select("path", F.col("sha256").alias("a"))
    state = F.when(F.col("a").isNull(), "missing").when(F.col("d").isNull(), "extra").when(F.col("a") != F.col("d"), "mismatched").otherwise("ok")
    return d.join(a, "path", "full_outer").select("path", state.alias("state"))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows of each side the other lacks (with multiplicity), and whether there are none."""
    lacking = left.exceptAll(right).agg(F.count("*").alias("missing")).crossJoin(right.exceptAll(left).agg(F.count("*").alias("extra")))
    return lacking.select("missing", "extra", ((F.col("missing") == 0) & (F.col("extra") == 0)).alias("equal"))


def first_n(df: DataFrame, eligible: Column, order: list[str], n: int) -> DataFrame:
    """The first n eligible rows in order: a distributed top-n, no global window."""
    return df.where(eligible).orderBy(*order).limit(n)


def changed(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """Rows whose fields differ from those of the row before in their group."""
    w = Window.partitionBy(*keys).orderBy(order)
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f).eqNullSafe(F.lag(f).over(w))
    return df.withColumn("__first", F.row_number().over(w) == 1).withColumn("__differs", differs).where("__differs AND NOT __first").drop("__first", "__differs")
