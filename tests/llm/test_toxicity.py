import random

import numpy as np

from weir.llm import toxicity


def corpus(n=900):
    rnd = random.Random(6)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(n):
        w = [rnd.choice(plain) for _ in range(30)]
        toxic = int(i % 4 == 0)
        if toxic:
            w[rnd.randrange(30)] = rnd.choice(["Grob!", "fies,", "MIES"])
        rows.append((i, " ".join(w), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([*[(i, t, 1.0) for i, t, _ in rows], (None, None, 0.0), (900, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([*[(i, y) for i, _, y in rows], (901, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    y = {i: t for i, _, t in rows}
    held = [i for i in y if got[i].held_out]
    assert 200 < len(held) < 400
    assert np.mean([got[i].predicted == y[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[None].score == got[900].score and got[900].predicted == 0


def test_pairs_count_beyond_their_terms():
    rnd, rows, labels = random.Random(2), [], []
    for _ in range(1500):
        a, b = rnd.random() < 0.3, rnd.random() < 0.3
        words = ({"grob"} if a else set()) | ({"gruppe"} if b else set())
        rows.append(np.array(sorted(toxicity.bucket(w) for w in words), dtype=np.int64))
        labels.append(int(a and b))
    m = toxicity.fit(rows, np.array(labels))
    assert m.score("grob gruppe") > 0.7 > 0.3 > max(m.score("grob"), m.score("gruppe"))


def hashed(words):
    return np.array(sorted(toxicity.bucket(w) for w in words), dtype=np.int64)


def test_neutral_terms_that_interact():
    """Neither term tells anything alone: toxic where exactly one of them is there."""
    rnd, rows, labels = random.Random(4), [], []
    plain = [f"wort{i}" for i in range(60)]
    for k in range(2400):
        a, b = k % 2, k // 2 % 2
        rows.append(hashed({*rnd.sample(plain, 12), *(["links"] if a else []), *(["rechts"] if b else [])}))
        labels.append(int(a != b))
    m = toxicity.fit(rows, np.array(labels))
    assert min(m.score("links"), m.score("rechts")) > 0.7 > 0.3 > max(m.score("links rechts"), m.score("wort1"))


def test_insult_with_group(spark):
    """The insult is toxic in 45 % of its rows alone and in 95 % with a group; the group by itself never is."""
    rnd, rows, labels = random.Random(5), [], []
    plain = [f"wort{i}" for i in range(60)]
    for _ in range(4000):
        a, b = rnd.random() < 0.2, rnd.random() < 0.5
        rows.append(hashed({*rnd.sample(plain, 12), *(["grob"] if a else []), *(["gruppe"] if b else [])}))
        labels.append(int(a and rnd.random() < (0.95 if b else 0.45)))
    m = toxicity.fit(rows, np.array(labels))
    assert m.place.keys() >= {toxicity.bucket("grob"), toxicity.bucket("gruppe")}
    assert m.score("grob gruppe") - m.score("grob") > 0.1 and m.score("gruppe") < 0.2
    dealt = toxicity.fit(rows, np.array(labels), spark=spark, tasks=5)
    assert dealt.place == m.place and np.array_equal(dealt.vectors, m.vectors)


def test_pairs_in_one_pass_match_plain_sum():
    rng = np.random.Generator(np.random.PCG64(1))
    words = [f"w{i}" for i in range(30)]
    buckets = [toxicity.bucket(w) for w in words]
    m = toxicity.Machine(np.array(buckets), -0.3, rng.normal(size=30), rng.normal(size=(30, 3)))
    for size in (0, 1, 2, 9, 30):
        own = rng.choice(30, size, replace=False)
        z = m.bias + sum(m.weights[i] for i in own) + sum(m.vectors[i] @ m.vectors[j] for i in own for j in own if i < j)
        assert abs(m.score(" ".join(words[i].upper() for i in [*own, *own]) + " fremd") - 1 / (1 + np.exp(-z))) < 1e-12


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, none).first().predicted == 0
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def test_repeated_ids_stay_within_the_bound(spark):
    """Labels meet all rows of their doc_id; no more than max_rows of them are fetched."""
    rows = corpus(300)
    docs = spark.createDataFrame([(i % 20, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    seen = []
    real = toxicity.fit
    toxicity.fit = lambda rows, labels, **how: seen.append(len(rows)) or real(rows, labels, **{**how, "spark": None})
    try:
        toxicity.train(docs, labels, max_rows=50)
    finally:
        toxicity.fit = real
    assert seen == [50]


def test_sparse_products_are_those_of_the_whole_matrix():
    rng = np.random.Generator(np.random.PCG64(3))
    x = (rng.random((40, 17)) < 0.2).astype(float)
    x[[0, 7, 39]] = 0
    s = toxicity._Sparse(*np.nonzero(x), *x.shape)
    v, e = rng.normal(size=(17, 3)), rng.normal(size=(40, 3))
    assert np.allclose(s.times(v), x @ v) and np.allclose(s.times(v[:, 0]), x @ v[:, 0])
    assert np.allclose(s.turned(e), x.T @ e) and np.allclose(s.turned(e[:, 0]), x.T @ e[:, 0])
    none = toxicity._Sparse(np.empty(0, np.int64), np.empty(0, np.int64), 4, 2)
    assert none.times(v[:2]).shape == (4, 3) and not none.turned(e[:4]).any()
