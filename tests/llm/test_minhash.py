import random
import re

import numpy as np

from weir.llm import minhash


def sets(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows, size, percent):
    s = [sets(t, size) for _, t in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                par[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(s[i]), least[find(i)], rows[i][0] == least[find(i)]) for i in range(len(rows)))


def corpus(n, seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    hot = [rnd.choice(vocab) for _ in range(40)]
    texts = [None, "", " \t ", "One", "one", "Two words", "two words"]
    for _ in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([3, 12, 60, 200]))] + rnd.choice([[], hot])
        for _ in range(rnd.choice([1, 1, 3, 8])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 12))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(rnd.choice([" ", "\n"]).join(w))
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_components_match_brute_force(spark):
    rows = corpus(60, 5)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, cls string, component long").repartition(5)
    for size in (2, 5):
        got = sorted(tuple(r) for r in minhash.near_duplicates(df, size=size).collect())
        assert got == brute(rows, size, 80)


def test_one_large_group_of_variants(spark):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(6):
            w[rnd.randrange(150)] = f"x{rnd.random()}"
        rows.append((i, " ".join(w)))
    rows.append((150, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(df, size=2).collect()) == brute(rows, 2, 80)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "d e"), (None, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df, size=2).collect()), key=str)
    assert got == sorted([(None, 2, 3, False), (3, 2, 3, True), (3, 1, 3, True), (None, 0, None, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_parities_never_part_similar_sets():
    rng = np.random.Generator(np.random.PCG64(4))
    for n in (1, 5, 40, 300, 2000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[: n - n // 10], rng.integers(0, 1 << 63, n // 12, dtype=np.uint64)]))
        x, y = minhash.parities(np.unique(a)), minhash.parities(b)
        apart = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
    c = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    assert sum(int(v).bit_count() for v in (minhash.parities(a[:300]) ^ minhash.parities(c)).view(np.uint64)) > 100


def test_similar_sets_share_a_value_and_unrelated_ones_few():
    rng = np.random.Generator(np.random.PCG64(7))
    universe = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)  # few shingles, so each is in many sets
    octaves = np.zeros(1 << minhash.COUNTERS_LOG2, dtype=np.uint8)
    octaves[minhash._slots(universe)] = 6
    pick = lambda n: np.unique(rng.choice(universe, n, replace=False))
    for n in (4, 5, 9, 17, 33, 60, 64, 130, 255, 256, 300, 1000):
        for _ in range(40):
            a = pick(n)
            gone, more = rng.integers(0, n // 9 + 1, 2)
            b = np.unique(np.concatenate([rng.permutation(a)[: n - gone], pick(more)]))
            x, y = minhash.sketches([a, b], octaves, 1000, 80)
            if minhash.similar(a, b, 80) and len(np.setxor1d(a, b)):
                both = np.intersect1d(x >> 1, y >> 1)
                assert len(both)
                assert any((x[x >> 1 == v] | y[y >> 1 == v]).max() & 1 for v in both)  # one of them is at home there
    kept = minhash.sketches([pick(100) for _ in range(1000)], octaves, 1000, 80)
    _, uses = np.unique(np.concatenate(kept) >> 1, return_counts=True)
    assert (uses * (uses - 1) // 2).sum() < 5000  # of 499,500 pairs; single shingles would bring all of them
