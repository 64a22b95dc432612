"""Near copies by long fingerprints against brute force."""

import random

import numpy as np
import pytest
import xxhash
from test_near import WORDS, corpus

from skein.llm import components, simhash

ALL = 2**64 - 1


def mixed(h, salt=0):
    h = (h + salt) & ALL
    h = ((h ^ h >> 33) * 0xFF51AFD7ED558CCD) & ALL
    h = ((h ^ h >> 29) * 0xC4CEB9FE1A85EC53) & ALL
    return h ^ h >> 32


def slow_long_fingerprint(text, width=5):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    k = min(width, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    total, out = sum(h) & ALL, 0
    for part, hashes in enumerate((h, [mixed(x, 1) for x in h])):
        even, half = mixed(total ^ (2 + part)), 0
        for b in range(64):
            for_, n = sum(x >> b & 1 for x in hashes), len(h)
            half |= (even >> b & 1 if 2 * for_ == n else int(2 * for_ > n)) << b
        out = out << 64 | half
    return out


def slow_groups(values, radius=11, whole=24):
    """Least id reachable over long fingerprints; values may repeat an id."""
    root = {i: i for i, _ in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in values:
        for j, y in values:
            if ((x ^ y) >> 64).bit_count() <= radius and (x ^ y).bit_count() <= whole:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in values}


def near_texts(seed=5, n=25, words=90):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(500)]
    out = []
    for _ in range(n):
        body = [rng.choice(vocabulary) for _ in range(words)]
        out.append(" ".join(body))
        for _ in range(rng.randint(0, 3)):
            for _ in range(rng.randint(1, 3)):
                body[rng.randrange(words)] = rng.choice(vocabulary)
            out.append(" ".join(body))
    return out


def test_long_fingerprint():
    for t in [t for _, t in corpus(20)] + ["a b c d e f", "a b c d e f g h", " a  B\tc\n"]:
        assert simhash.long_fingerprint(t or "") == slow_long_fingerprint(t)


@pytest.mark.parametrize("radius", range(12))
def test_halves_miss_no_pair(radius):
    masks, rng = [m % 2**64 for m in simhash.covering_halves(radius)], random.Random(radius)
    assert len(masks) == 2 * (2 ** (radius // 2 + 1) - 1) and min(m.bit_count() for m in masks) >= 16
    for _ in range(400):
        low = rng.randint(max(0, radius - 32), radius)
        differ = sum(1 << i for i in rng.sample(range(32), low) + rng.sample(range(32, 64), radius - low))
        assert any(not differ & m for m in masks)
    with pytest.raises(ValueError):
        simhash.covering_halves(12)


@pytest.mark.parametrize("small, cell", [(512, 100_000), (1, 100_000), (512, 4)])
def test_near_copies_equal_brute_force(spark, monkeypatch, small, cell):
    monkeypatch.setattr(components, "SMALL", small)
    monkeypatch.setattr(components, "CELL", cell)
    rows = list(enumerate(near_texts() + [None, "", " \n", "one", "one", "two words", "two words"]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in simhash.near_copies(df).collect()}
    prints = [(i, slow_long_fingerprint(t)) for i, t in rows]
    want = slow_groups(prints)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{x:032x}", want[i]) for i, x in prints}
    assert want != slow_groups(prints, 2, 128) and len(set(want.values())) >= 25


def test_links_hold_both_bounds():
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**62), 2**62, (1, 2))
    flips = (rng.random((300, 2, 64)) < 0.12).astype(np.uint64)
    prints = base ^ (flips << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)
    prints = prints[np.lexsort((prints[:, 1], prints[:, 0]))]
    columns = (prints[:, 0].copy(), prints[:, 1].copy())
    a, b = components.key_pairs(columns, (11, 20))
    want = slow_groups([(i, (int(x) % 2**64) << 64 | int(y) % 2**64) for i, (x, y) in enumerate(prints)], 11, 20)
    root = list(range(300))
    for _ in range(300):
        for x, y in zip(a.tolist(), b.tolist()):
            root[x] = root[y] = min(root[x], root[y])
    assert dict(enumerate(root)) == want and 1 < len(set(root)) < 300


def test_one_of_each_copy(spark):
    texts = near_texts(7, 10)
    rows = [(i, t, f"c{i}") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[3], "no id"), (None, "a text of its own without id", "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    kept = simhash.one_of_each(df, find=simhash.near_copies)
    want = slow_groups([(i, slow_long_fingerprint(t)) for i, t in enumerate(texts)])
    got = kept.collect()
    assert kept.columns == df.columns and sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(set(want.values()))
    assert [r.text for r in got if r.doc_id is None] == ["a text of its own without id"]
    assert simhash.one_of_each(df.limit(0), find=simhash.near_copies).count() == 0
