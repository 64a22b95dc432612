"""Operators 2, 6 and 9 against brute force."""

import collections
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from skein.llm import components, fingerprints, lines, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(n=120, seed=2):
    """Random lines, near copies of lines, copies of documents, and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 5, 9, 20, 40])))
    pool = [line() for _ in range(60)]
    docs = []
    for _ in range(n):
        body = []
        for _ in range(rng.randint(1, 6)):
            x = rng.choice(pool) if rng.random() < 0.6 else line()
            if rng.random() < 0.5:
                w = x.split()
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
                x = " ".join(w)
            body.append(x)
        docs.append("\n".join(body))
    docs += docs[:10] + [None, "", " \n\t", "\n\n", "one", "one one", "x " * 5000, "É é z"]
    return [(i * 3, t) for i, t in enumerate(docs)]


def removed_by_brute_force(rows):
    seen, gone = [], collections.defaultdict(list)
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for k, l in enumerate(text.split("\n")):
            c, t = collections.Counter(), set()
            for w in WORDS.findall(l):
                t.add((w, c[w]))
                c[w] += 1
            if not t:
                continue
            if any(9 * len(t & u) >= 4 * (len(t) + len(u)) for u in seen):
                gone[i].append(k)
            seen.append(t)
    return gone


@pytest.mark.parametrize("cell, named", [(20_000, 16), (5, 16), (20_000, 1), (5, 1)])
def test_line_dedup_equals_brute_force(spark, monkeypatch, cell, named):
    monkeypatch.setattr(lines, "CELL", cell)
    monkeypatch.setattr(lines, "NAMED", named)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("did", F.lit("clash")).repartition(3)
    gone = removed_by_brute_force(rows)
    assert gone
    got = lines.dedup_lines(df, counts=("n_lines", "n_removed")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        t = texts[r.doc_id]
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[r.doc_id])
        assert r.text == want and r.n_removed == len(gone[r.doc_id]) and r.did == "clash"


def test_line_dedup_of_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "v w x y z"), (None, "v w x y z"), (2, "a b c d e")]
    got = sorted((r.doc_id or 0, r.text) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    # the null id is first and keeps its line; both rows of the repeated document keep theirs
    assert got == [(0, "v w x y z"), (1, ""), (1, "a b c d e"), (1, "a b c d e"), (2, "")]


def slow_fingerprint(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    n = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values):
    """Least id reachable over values within two bits."""
    root = {i: i for i, _ in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in values:
        for j, y in values:
            if (x ^ y).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in values}


def test_fingerprint(spark):
    for _, t in corpus(20):
        assert simhash.fingerprint(t or "") == slow_fingerprint(t)
    h = spark.range(1).select(F.xxhash64(F.lit("ab cd ef"))).first()[0]
    assert h % 2**64 == xxhash.xxh64_intdigest(b"ab cd ef", 42)


def test_covering_masks_miss_no_pair():
    masks = [m % 2**64 for m in simhash.covering_masks()]
    for masks_ in (masks, [m % 2**64 for m in fingerprints.block_masks(2, 5)]):
        for i in range(64):
            for j in range(i, 64):
                assert any(not m >> i & 1 and not m >> j & 1 for m in masks_)
        assert min(m.bit_count() for m in masks_) >= 36


@pytest.mark.parametrize("masks", [simhash.covering_masks(), fingerprints.block_masks(2, 5)])
def test_groups_equal_brute_force(spark, masks):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(15)]
    values = [0, 2**64 - 1]
    for b in base:
        walk = b
        for _ in range(rng.choice([1, 2, 5, 30])):
            for _ in range(rng.randint(0, 3)):
                walk ^= 1 << rng.randrange(64)
            values.append(walk)
    values = list(enumerate(values + values[:9]))
    df = spark.createDataFrame([(i, f"{v:016x}") for i, v in values], "doc_id bigint, fingerprint string")
    got = {r.doc_id: r.g for r in components.grouped(df, masks, "doc_id", "fingerprint", "g").collect()}
    assert got == groups(values)


def test_near_groups_and_one_of_each(spark):
    rows = corpus(40)
    df = spark.createDataFrame(rows + rows[:2], "doc_id bigint, text string").withColumn("fp", F.lit(1))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(df).collect()}
    want = groups([(i, slow_fingerprint(t)) for i, t in rows])
    assert got == {i: (f"{slow_fingerprint(t):016x}", want[i]) for i, t in rows}
    kept = simhash.one_of_each(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns


def test_edit_distances_equal_brute_force(spark):
    rows = corpus(30) + [(None, "null id"), (5, "tie a"), (5, "tie b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    tie = {t: h for t, h in df.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    sim, want = fingerprints.SimHash(), []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        e = t[: len(t) - k] + n[:k]
        a, b, c = sim.of(t), sim.of(e), sim.of(n)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", 1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64))
    got = [tuple(r) for r in fingerprints.edit_distances(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    found = {r.doc_id: r for r in fingerprints.near_groups(df.where("doc_id IS NOT NULL AND doc_id <> 5")).collect()}
    assert {i: r.group_id for i, r in found.items()} == groups([(i, int(r.fingerprint, 16)) for i, r in found.items()])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    for f in (lines.dedup_lines, simhash.near_groups, simhash.one_of_each, fingerprints.edit_distances, fingerprints.near_groups):
        assert f(none).count() == 0
