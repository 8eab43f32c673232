import random

import numpy as np
import pytest

from weir.llm import mixing


def levels(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares by weight; what is above a cap is shared again until nothing is."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > most * sizes[s] + 1e-9}
        if not over:
            return out | {s: left * w[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mix(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])), rnd.choice(["a", "a", "a", "a", "b", "c", "é", "z", None])) for i in range(3000)]
    rows += [(None, None, "a"), (5, rows[5][1], rows[5][2]), (7, "", "empty")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df.repartition(3), leaf=64, fan=4).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = levels(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) < 300
    again = mixing.mix(df.repartition(11), leaf=64, fan=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.Generator(np.random.PCG64(3))
    x, size = rng.random(31), rng.integers(1, 50, 31).astype(float)
    total = np.zeros(31)
    for _ in range(4000):
        y = mixing.pivot(x, size, rng.random(31))
        assert y @ size == pytest.approx(x @ size)
        assert sum(1e-9 < v < 1 - 1e-9 for v in y) <= 1
        total += y
    assert np.abs(total / 4000 - x).max() < 0.04


def test_carried_columns_tell_rows_apart(spark):
    rows = [(1, "w " * (5 + k), "a", k) for k in range(40)] + [(None, "w", "b", 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, k int").repartition(4)
    got = mixing.mix(df, carry=("k",)).collect()
    assert sorted(r.k for r in got) == sorted(r[3] for r in rows) and all(r.size == 5 + r.k for r in got if r.k < 100)
    again = mixing.mix(df.repartition(7), carry=("k",)).collect()
    assert {r.k: r.copies for r in got} == {r.k: r.copies for r in again}
