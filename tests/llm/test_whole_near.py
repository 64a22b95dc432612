"""The search of near fingerprints at any radius."""

import random

import numpy as np
import pytest

from skein.llm import components, fingerprints, queries


def groups(values, radius):
    root = {i: i for i, _ in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in values:
        for j, y in values:
            if (x ^ y).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in values}


@pytest.mark.parametrize("small, at_once", [(512, 1 << 20), (1, 1 << 20), (1, 3)])
def test_links_of_a_key_equal_brute_force(monkeypatch, small, at_once):
    monkeypatch.setattr(components, "SMALL", small)
    monkeypatch.setattr(components, "AT_ONCE", at_once)
    rng = random.Random(6)
    values = {0, 2**64 - 1}
    for _ in range(12):
        walk = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 15])):
            for _ in range(rng.randint(0, 10)):
                walk ^= 1 << rng.randrange(64)
            values.add(walk)
    fps = sorted(components.signed(v) for v in values)
    a, b = components.key_links(np.array(fps, np.int64), 8)
    at = {v: i for i, v in enumerate(fps)}
    root = list(range(len(fps)))
    for _ in fps:
        for x, y in zip(a.tolist(), b.tolist()):
            root[at[x]] = root[at[y]] = min(root[at[x]], root[at[y]])
    assert dict(enumerate(root)) == groups([(i, v % 2**64) for i, v in enumerate(fps)], 8)


@pytest.mark.parametrize("bucket_rows", [1 << 18, 2000])
def test_links_follow_the_size_of_a_group(spark, monkeypatch, bucket_rows):
    # in each of 45 tables, keys of this group have up to four links a member
    monkeypatch.setattr(components, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(8)
    heart, masks = rng.getrandbits(64), fingerprints.block_masks(8, 10)

    def near():
        return heart ^ sum(1 << k for k in rng.sample(range(64), 4))

    values = sorted({near() for _ in range(400)} | {rng.getrandbits(64) for _ in range(100)})
    df = spark.createDataFrame([(components.signed(v),) for v in values], "fp bigint")
    links = [(r.a % 2**64, r.b % 2**64) for r in components.linked(df, masks, "fp", 8).collect()]
    assert len(links) < 2 * len(values)
    at = {v: i for i, v in enumerate(values)}
    least = components.least_linked(len(values), *(np.array([at[r[k]] for r in links], np.int64) for k in (0, 1)))
    assert dict(enumerate(least.tolist())) == groups(list(enumerate(values)), 8)


def test_fingerprint_query_joins_near_copies(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(30):
        words = [rng.choice(vocabulary) for _ in range(100)]
        rows.append((2 * i, " ".join(words)))
        words[50] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, str(tmp_path)).collect()}
    prints = [(i, int(r.fingerprint, 16)) for i, r in sorted(got.items())]
    want = groups(prints, fingerprints.SEARCH_RADIUS)
    assert {i: r.group_id for i, r in got.items()} == want != groups(prints, 2)
    assert sum(want[i + 1] == want[i] for i in range(0, 60, 2)) > 20
