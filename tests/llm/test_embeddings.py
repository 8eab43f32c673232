import numpy as np
import pytest

from weir.llm import embeddings


def brute(rows, least):
    unit = [embeddings._unit(v) for _, v in rows]
    n = len(rows)
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                a, b = find(i), find(j)
                if a != b:
                    par[a] = b
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), 1 << 60), rows[i][0])
    return sorted((rows[i][0], links[i], low[find(i)], rows[i][0] == low[find(i)]) for i in range(n))


def test_links_match_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(8))
    vs = [rng.normal(size=16) for _ in range(300)]
    hub = rng.normal(size=16)
    vs += [hub + 0.1 * rng.normal(size=16) for _ in range(150)]  # one large group
    for v in vs[:40]:
        vs += [v + s * rng.normal(size=16) for s in (0.05, 0.3, 0.5)]
    rows = [(i, v.tolist()) for i, v in enumerate(vs)]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, None), (1003, [0.0] * 16), (1004, [float("nan")] * 16), (1005, [None] * 16), (1006, []), (1007, [1.0, 0.0]), (1008, [2.0, 0.0]), (1009, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int").repartition(4)
    res = embeddings.near_vectors(df, leaf=32, block=64)
    got = sorted(tuple(r) for r in res.collect())
    want = brute(rows, 0.9)
    over = [a for a, b in zip(got, want, strict=True) if a[1] > b[1]]
    assert not over
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    found, there = embeddings.audit(df.where("vec_id < 1000"), res, every=10)
    assert there and found >= 0.9 * there
    assert embeddings.audit(df.where("vec_id < 1000"), res, every=10, at_once=7) == (found, there)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_tight_groups_join(spark):
    """Lists of k entries are full of a vector's own sub-group; the links across sub-groups count too."""
    rng = np.random.Generator(np.random.PCG64(3))
    unit = lambda v: v / np.linalg.norm(v)
    vs = []
    for _ in range(8):
        centre = unit(rng.normal(size=64))
        for _ in range(4):
            sub = centre + 0.25 * unit(rng.normal(size=64))
            vs += [sub + 0.1 * unit(rng.normal(size=64)) for _ in range(20)]
    vs += list(rng.normal(size=(600, 64)))
    rows = [(i, v.tolist()) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = sorted(tuple(r) for r in embeddings.near_vectors(df, leaf=64).collect())
    want = brute(rows, 0.9)
    assert len({r[2] for r in want}) == 608
    assert got == want


def isolated_pairs(rng, n, others, common, cosine, d=64):
    """Pairs at about one cosine among vectors that all share a direction."""
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    shared = np.zeros(d)
    shared[0] = 1
    out = unit(rng.normal(size=(n + others, d)))
    out[:, 0] = 0
    base = np.sqrt(common) * shared + np.sqrt(1 - common) * unit(out)
    side = rng.normal(size=(n, d))
    side -= (side * base[:n]).sum(1, keepdims=True) * base[:n]
    return np.concatenate([base, cosine * base[:n] + np.sqrt(1 - cosine**2) * unit(side)])


@pytest.mark.parametrize("common,cosine,goal", [(0.0, 0.905, 0.9995), (0.69, 0.92, 0.9995), (0.8, 0.93, 0.9995)])
def test_isolated_pairs_with_a_common_mean(spark, common, cosine, goal):
    rng = np.random.Generator(np.random.PCG64(11))
    vs = isolated_pairs(rng, 1000, 1200, common, cosine)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vs)], "vec_id long, embedding array<double>").repartition(4)
    got = sorted(tuple(r) for r in embeddings.near_vectors(df, leaf=32, block=64, asked=500, goal=goal).collect())
    m = vs / np.linalg.norm(vs, axis=1, keepdims=True)
    links = (m @ m.T >= 0.9).sum(1) - 1
    assert sum(links) >= 2000 and sum(r[1] for r in got) == sum(links)
    assert [r[1] for r in got] == links.tolist()
