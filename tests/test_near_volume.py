"""Near duplicates by brute force, in the shared order of halves, and what is shuffled for them."""

import random

import pytest

from skein.operators import audit

TURN = {"train": 0, "validation": 1, "blind": 2}


def sets_of(rng, n, first):
    pool = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(60)]
    made = []
    for i in range(n):
        base = set(rng.sample(pool, rng.randint(1, 30))) if i < 5 or rng.random() < 0.4 else set(rng.choice(made)[2])
        for _ in range(rng.randint(0, 3)):
            base ^= {rng.choice(pool)}
        made.append((first + i, rng.choice(list(TURN)), sorted(base) or [pool[0]]))
    return made


def near(a, b, least):
    return len(set(a) & set(b)) / len(set(a) | set(b)) >= least


@pytest.mark.parametrize("least, few", [(0.85, 1 << 19), (0.5, 0), (0.05, 0)])
def test_pairs_equal_brute_force(spark, monkeypatch, least, few):
    monkeypatch.setattr(audit, "FEW", few)
    rng = random.Random(7)
    x = sets_of(rng, 60, 0)
    rng.seed(7)  # the same pool
    y = sets_of(rng, 25, 1000)
    kind = "doc bigint, split string, shingles array<bigint>"
    left, right = spark.createDataFrame(x, kind), spark.createDataFrame(y, kind)
    got = sorted((r.doc_l, r.doc_r) for r in audit.near_duplicates(left, right, least).collect())
    want = sorted((a[0], b[0]) for a in x for b in y if near(a[2], b[2], least))
    assert want and got == want
    got = sorted((r.doc_l, r.doc_r) for r in audit.near_duplicates(left, left, least, apart="split").collect())
    assert got == sorted((a[0], b[0]) for a in x for b in x if TURN[a[1]] < TURN[b[1]] and near(a[2], b[2], least))


def test_repeats_go_before_shingles_are_made(spark):
    # the hashes of a text's shingles are longer than the text
    rows = spark.createDataFrame([(1, "train", "a b c d"), (0, "train", "A  b c d"), (2, "blind", "a b c d")], "id bigint, split string, text string")
    sets = audit.prompt_sets(rows, "id", "text")
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") < plan.index("Aggregate")
    assert sorted((r.split, r.doc, len(r.shingles)) for r in sets.collect()) == [("blind", 2, 2), ("train", 0, 2)]
