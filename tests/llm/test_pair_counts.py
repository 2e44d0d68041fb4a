"""Counts of op11's id pairs by sorted keys."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa

from bondmart.llm import alignment as A


def test_summed_equals_a_counter():
    rng = np.random.default_rng(7)
    for size in (0, 1, 5000):
        key, n = rng.integers(0, 700, size), np.where(rng.random(size) < 0.1, rng.integers(2, 9, size), 1)
        for weights in (None, n, np.ones(size, np.int64)):
            want = Counter()
            for k, w in zip(key.tolist(), (np.ones(size, np.int64) if weights is None else weights).tolist()):
                want[k] += w
            found, times = A.summed(key, weights)
            assert dict(zip(found.tolist(), times.tolist())) == want and (np.diff(found) > 0).all()


def test_links_in_portions_are_those_of_one(monkeypatch):
    """Groups with repeated ids, cut into portions of few links."""
    rng = np.random.default_rng(8)
    group = np.sort(rng.integers(0, 60, 400))
    group[-1] = 59
    sides = [pa.table({"doc": group // 7, "id": pa.array(rng.integers(0, 5, 400), pa.int32()), "group": group}) for _ in "ab"]
    want = Counter()
    for d, i, g in zip(*(sides[0][c].to_pylist() for c in ("doc", "id", "group"))):
        for j, h in zip(*(sides[1][c].to_pylist() for c in ("id", "group"))):
            if g == h:
                want[d, i << A.ID_BITS | j] += 1
    for rows in (A.LINK_ROWS, 16):
        monkeypatch.setattr(A, "LINK_ROWS", rows)
        links = A.linked(*sides).to_pydict()
        assert {(d, p): n for d, p, n in zip(links["doc"], links["pair"], links["n"])} == want
