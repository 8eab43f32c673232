import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weir.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stats(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    c = Counter(grams)
    again = set().union(*[range(i, i + 8) for i, g in enumerate(grams) if c[g] > 1])
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


chosen = []  # which start each estimate came from


def judged(rows, share=0.75, steps=3, least=60, cutoff=36.0):
    """The same estimate with arrays: concentration by histogram bucket from two starts, floors on the diagonal, the least determinant."""
    st = [stats(t) for _, t, _, _ in rows]
    ok = [s[0] >= 20 and 100 * s[4] <= 30 * s[0] for s in st]
    z = {i: np.array([math.floor(1000 * v + 0.5) for v in (math.log(s[0]), math.log(s[1] / s[0]), math.log1p(100 * s[2] / s[0]), math.log1p(s[3]), math.log1p(100 * s[4] / s[0]))], float) for i, s in enumerate(st) if ok[i]}
    n = Counter((rows[i][2], rows[i][3]) for i in z)
    groups = {}
    for i in z:
        own = (rows[i][2], rows[i][3])
        groups.setdefault(("own", *own) if n[own] >= least else ("pool", own[0]), []).append(i)
    floor = np.diag([(1000 * f) ** 2 for f in quality.FLOORS.values()])
    kept = list(ok)
    dist = {}
    for members in groups.values():
        if len(members) < least:
            continue
        x = np.array([z[i] for i in members])
        low = lambda v: np.sort(v)[math.ceil(len(v) * 0.5) - 1]
        bucket = lambda d: np.minimum(600, np.floor(16 * np.log2(1 + 16 * d)))
        far = lambda m, inv: np.einsum("ij,jk,ik->i", x - m, inv, x - m)

        def estimate(s):
            m = s.mean(0)
            cov = s.T @ s / len(s) - np.outer(m, m) + floor
            return m, np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

        m = np.array([low(c) for c in x.T])
        dev = np.array([low(np.abs(c - a)) for c, a in zip(x.T, m, strict=True)])
        ends = []
        for now in ((m, np.diag(1 / ((1.4826 * dev) ** 2 + np.diag(floor))), 0.0), estimate(x)):
            for _ in range(steps):
                b = bucket(far(*now[:2]))
                now = estimate(x[b <= np.sort(b)[math.ceil(share * len(b)) - 1]])
            ends.append(now)
        m, inv, _ = min(ends, key=lambda e: round(e[2], 9))
        chosen.append(int(ends[0][2] > ends[1][2] + 1e-9))
        d = far(m, inv)
        mid = np.sort(bucket(d))[math.ceil(0.5 * len(d)) - 1]
        scale = min(1.0, quality.chi2_median(5) / ((2 ** ((mid + 1) / 16) - 1) / 16))
        for i, v in zip(members, d * scale, strict=True):
            dist[i], kept[i] = v, bool(v <= cutoff)
    return st, ok, kept, dist


def corpus():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 9)))
    rows = []
    for i in range(420):
        w = [word() for _ in range(int(20 * math.exp(rnd.random() * 3)))]
        if i % 29 == 0:
            w = [x + "%%%" for x in w]
        if i % 31 == 0:
            w = w[:12] * 4
        t = "".join(x + rnd.choice([" ", " ", " ", "\n", "\t "]) for x in w)
        if i % 7 == 0:
            t += "\n" + "\n".join([t.split("\n")[0]] * 2)
        rows.append((i, t, rnd.choice(["en", "de", None]), rnd.choice(["s", "s", "s", "t", None])))
    return [*rows, (420, None, "en", "s"), (421, "", None, None), (422, "x " * 50, "en", "s"), (None, rows[0][1], "en", "s")]


def test_statistics_and_verdicts_match_arrays(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, j, "c") for j, r in enumerate(rows)], "doc_id long, text string, lang string, source string, j int, kept string").repartition(4)
    got = {r.j: r for r in quality.robust_quality(df).collect()}
    st, ok, kept, dist = judged(rows)
    assert len(got) == len(rows) and not all(kept) and sum(dist[i] > 36 for i in dist) > 5
    for j, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == st[j]
        assert r.base_failed != ok[j]
        assert r.kept == kept[j], (j, r.distance, dist.get(j))
        if j in dist:
            assert abs(r.distance - dist[j]) < 1e-6 * max(1, dist[j])


def test_carry_and_empty(spark):
    df = spark.createDataFrame([(1, "a " * 30, "en", "s")], "doc_id long, text string, lang string, source string")
    out = quality.robust_quality(df, carry=["doc_id"])
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    assert out.first().base_failed and quality.robust_quality(df.where(F.lit(False))).count() == 0


def test_small_pools_fall_back(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(rnd.randint(40, 80)), "en", "hot") for i in range(90)] + [(90 + i, text(50), "en", "rare") for i in range(5)]
    rows += [(95, " ".join(word() + "%%%%%%" for _ in range(60)), "en", "rare"), (96, text(50), "xx", "s"), (97, " ".join(word() + "%%%%%%" for _ in range(60)), "xx", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.robust_quality(df, widen=True).collect()}
    assert len(got) == len(rows) and all(r.distance is not None for r in got.values() if not r.base_failed)
    assert not got[95].kept and not got[97].kept and got[90].kept and got[96].kept
