import numpy as np
import pytest

from weir.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


def plain(vectors, most=32):
    """n, exact deviations, eigenvalues, axes and trace, with Python's whole numbers."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    d = [[n * a - b for a, b in zip(r, s, strict=True)] for r in x]
    m = np.array([[float(v) / n for v in r] for r in d])
    values, axes = np.linalg.eigh(m.T @ m / n)
    return n, [sum(v * v for v in r) for r in d], values[::-1][:most], axes[:, ::-1][:, :most], np.trace(m.T @ m / n), m


def held_against(got, ids, vectors, most=32):
    n, far, values, axes, trace, m = plain(vectors, most)
    k = len(values)
    assert len(got) == len(ids) * k
    by = {(r.vec_id, r.component): r for r in got}
    w = np.array([[by[i, c + 1].whitened for c in range(k)] for i in ids])
    for j, i in enumerate(ids):
        for c in range(k):
            r = by[i, c + 1]
            assert (r.n, r.deviation) == (n, far[j])
            assert abs(r.explained - values[c] / trace) < 1e-9 and r.identity_error < 1e-8
    want = m @ axes / np.sqrt(values)
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w - want * sign).max() < 1e-6
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-8


def test_brute_force(spark):
    rnd = np.random.default_rng(1)
    v = (rnd.normal(size=(500, 40)) @ rnd.normal(size=(40, 40)) + 3).astype(np.float32)
    v[7] = v[8]
    rows = [(i, x.tolist(), 1, "a", "b") for i, x in enumerate(v)]
    bad = [(1000, None, 1, "a", "b"), (1001, [1.0, None] * 20, 1, "a", "b"), (1002, [float("nan")] * 40, 1, "a", "b"), (1003, [float("inf")] * 40, 1, "a", "b"), (1004, [], 1, "a", "b")]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(5)
    held_against(whitening.whiten(df).collect(), list(range(500)), v)
    again = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(df).collect()}
    first = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(df).collect()}
    assert all(abs(again[k] - x) < 1e-9 for k, x in first.items())


def test_lengths_and_flat_components(spark):
    """Each length by itself; a dimension that never varies has no whitened value; repeated and null ids are rows of their own."""
    rows = [(None if i == 3 else i // 2, [float(i), float(i * i % 7), 2.0], 0, "", "") for i in range(20)] + [(50 + i, [float(i)], 0, "", "") for i in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 20 * 3 + 4 and {r.n for r in got} == {20, 4}
    three = [r for r in got if r.n == 20]
    assert all((r.whitened is None) == (r.component == 3) and (r.component < 3 or r.explained == 0) and r.identity_error < 1e-9 for r in three)
    one = sorted((r.vec_id, r.whitened) for r in got if r.n == 4)
    assert np.allclose([w for _, w in one], [-1.3416407865, -0.4472135955, 0.4472135955, 1.3416407865])


def test_single_and_empty(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.5], 0, "", "")], SCHEMA)).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, 0.0, 0.0), (2, 0, None, 0.0, 0.0)]
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 0, "", "")], SCHEMA)).count() == 0


def test_too_far(spark):
    with pytest.raises(Exception, match="fit a long"):
        whitening.whiten(spark.createDataFrame([(1, [1e12], 0, "", ""), (2, [-1e12], 0, "", "")], SCHEMA)).count()
