"""Rows that the line join compares."""

import numpy as np

from skein.llm import lines


def test_only_rows_that_share_a_key_are_compared():
    rng = np.random.default_rng(4)
    n = 5000
    x = {c: rng.integers(0, 3, n).astype(kind) for c, kind in lines._TOKENS.items()} | {"key": rng.integers(0, 4000, n).astype(np.uint32)}
    names = ("key", "cell", "known", "did", "tie", "ln")
    _, of, times = np.unique(x["key"], return_inverse=True, return_counts=True)
    want = sorted(tuple(int(x[c][i]) for c in names) for i in np.flatnonzero(times[of] > 1))
    assert [tuple(int(x[c][i]) for c in names) for i in lines._shared(x)] == want and 0 < len(want) < n
    assert not len(lines._shared({c: v[:0] for c, v in x.items()}))
