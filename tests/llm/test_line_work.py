"""Work of the line join: what is dealt is measured once, and lines of unlike sizes are not compared."""

import numpy as np

from skein.llm import blocks, lines


def lines_of(n, rng):
    size = rng.integers(4, 90, n).astype(np.int32)
    x = {"s1": rng.integers(0, 1 << 60, n), "s2": rng.integers(0, 1 << 60, n), "known": np.ones(n, np.uint8), "did": np.arange(n), "tie": np.zeros(n, np.int64)}
    x |= {"ln": np.zeros(n, np.int32), "size": size, "bits": rng.integers(0, 1 << 60, lines._words_of(size).sum()).astype(np.uint64)}
    return x | {"keys": rng.integers(0, 1 << 32, lines._prefix_length(size).sum()).astype(np.uint32)}


def test_dealing_does_not_measure_all_rows_for_every_bucket(monkeypatch):
    rng = np.random.default_rng(5)
    x, seen = lines_of(2000, rng), []
    of = lines._words_of
    monkeypatch.setattr(lines, "_words_of", lambda size: seen.append(len(size)) or of(size))
    cutter = getattr(lines, "_lines_cutter", lambda _: lines._lines_at)
    dealt = list(blocks.dealt(x, x["did"] % 100, cutter(x)))
    assert len(dealt) == 100 and sum(seen) <= 2 * 2000
    back = blocks.joined([blocks.unpack(block, lines._LINES) for _, block in dealt])
    assert sorted(back["did"]) == list(range(2000)) and back["keys"].sum(dtype=np.int64) == x["keys"].sum(dtype=np.int64)


def test_pairs_are_all_that_may_match_and_few_are_compared(monkeypatch):
    rng = np.random.default_rng(6)
    n = 600
    size = rng.integers(4, 200, n).astype(np.int32)
    pos = (rng.random(n) * lines._prefix_length(size)).astype(np.int32)
    x = {"key": np.sort(rng.integers(0, 2, n)).astype(np.uint32), "did": np.arange(n), "size": size, "pos": pos, "open": np.ones(n, np.uint8), "known": np.ones(n, np.uint8)}
    x |= {c: np.zeros(n, lines._TOKENS[c]) for c in ("cell", "tie", "ln", "side")} | {"bits": np.zeros(lines._words_of(size).sum(), np.uint64)}
    want, same = set(), 0
    for j in range(n):
        for i in range(j):
            a, b = int(size[i]), int(size[j])
            same += x["key"][i] == x["key"][j]
            if x["key"][i] == x["key"][j] and 5 * min(a, b) >= 4 * max(a, b) and 9 * min(a - pos[i], b - pos[j]) >= 4 * (a + b):
                want.add((j, i))
    compared = []
    ranges = blocks.ranges
    monkeypatch.setattr(blocks, "ranges", lambda first, many: compared.append(int(many.sum())) or ranges(first, many))
    got = [(int(j), int(i)) for js, at in lines._pairs(x, np.zeros(n, np.int64), None) for j, i in zip(js, at)]
    assert sorted(got) == sorted(want) and want
    assert 0 < compared[0] and sum(compared) < same / 3
    named = np.zeros(n, np.int64)
    few = [(int(j), int(i)) for js, at in lines._pairs(x, named, 2) for j, i in zip(js, at)]
    times = {j: sum(1 for a, _ in want if a == j) for j, _ in want}
    assert set(few) <= want and all(sum(1 for a, _ in few if a == j) == min(2, k) and (named[j] > 2) == (k > 2) for j, k in times.items())
