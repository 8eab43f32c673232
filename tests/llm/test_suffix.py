import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from weir.llm import suffix


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    c = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if c[b[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(b)]
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(5)) + " "
    shared = ["".join(word() for _ in range(k)) for k in (5, 20, 60, 120)]
    out = [None, "", "a", "x" * 300, "ab" * 200, "abc" * 40, shared[3], shared[3]]
    for _ in range(n):
        parts = [rnd.choice(shared)[rnd.randint(0, 40) :] if rnd.random() < 0.5 else "".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(rnd.randint(1, 5))]
        t = list("".join(parts)) or ["a"]
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = "#"
        out.append("".join(t))
    return out


@pytest.mark.parametrize("length,k,hot", [(200, 64, 1000), (40, 16, 2)])
def test_matches_brute_force(spark, length, k, hot):
    texts = corpus(length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumnRenamed("doc_id", "n_spans2").selectExpr("n_spans2 as doc_id", "text", "1 as n_bytes").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.dedup_substrings(df, length, k, hot=hot, step=4).collect()}
    want = brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want
    assert any(w[1] for w in want)


def test_family_levels_agree_with_counts():
    rnd = np.random.Generator(np.random.PCG64(4))
    keys = rnd.integers(97, 100, (3000, 6), dtype=np.uint8).view("S6").ravel()
    keys = np.concatenate([keys, rnd.integers(97, 123, (3000, 6), dtype=np.uint8).view("S6").ravel()])
    rnd.shuffle(keys)
    f = suffix.Family(base=16)
    for i in range(0, len(keys), 250):
        f.add(keys[i : i + 250], np.arange(i, min(i + 250, len(keys))))
    c = Counter(keys.tolist())
    assert f.repeated().tolist() == [i for i, x in enumerate(keys.tolist()) if c[x] > 1]


def test_spans_and_empty(spark):
    df = spark.createDataFrame([(1, "a" * 210), (None, "b")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix.dedup_substrings(df, texts=True).collect()}
    assert [(p.s, p.e) for p in got[1].removed] == [(0, 210)] and bytes(got[1].kept_bytes) == b""
    assert bytes(got[None].kept_bytes) == b"b" and got[None].removed == []
    assert suffix.dedup_substrings(df.limit(0)).count() == 0


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 2, 3, 4)], "doc_id long, text string, n_tokens int, spans int, rid int")
    with pytest.raises(ValueError):
        suffix.dedup_substrings(df, carry=("doc_id", "spans"))
    assert suffix.dedup_substrings(df).count() == 1
