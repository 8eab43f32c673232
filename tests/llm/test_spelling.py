import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weir.llm import spelling
from weir.llm.common import Stash

SCHEMA = "doc_id long, text string, word string, n long, root string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def counted(docs, typo=31):
    n = Counter()
    for i, t in docs:
        for r in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(c.lower() if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{i}:{r}".encode())
            if typo and h % typo == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1 :]
            n[r] += len(r) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def plain(docs, typo=31):
    n = counted(docs, typo)
    by = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in by.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(by[w]), n.get(form[w])))
    return sorted(out)


def some(seed, n=400):
    rnd = random.Random(seed)
    letters = "abcÀéÿ×e"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(6, 14))) for _ in range(60)] + ["shared" + "".join(rnd.choice("ab") for _ in range(5)) for _ in range(40)]

    def worded():
        w = rnd.choice(base[:10] if rnd.random() < 0.7 else base)
        if rnd.random() < 0.3:
            i = rnd.randrange(len(w))
            w = w[:i] + rnd.choice([w[i + 1 :], rnd.choice(letters) + w[i:], rnd.choice(letters) + w[i + 1 :]])
        return w.upper() if rnd.random() < 0.1 and w.isascii() else w

    return [(i, rnd.choice([" ", "9", "-", "\n"]).join(worded() for _ in range(rnd.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("limit,sent", [(512, spelling.SENT), (4, spelling.SENT), (1, 0)])
def test_brute_force(spark, monkeypatch, limit, sent):
    """Also where every block is cut as far as it goes, and where nothing may be sent."""
    monkeypatch.setattr(spelling, "SENT", sent)
    docs = some(5) + [(None, "nullkey nullkey"), (900, None), (901, ""), (902, "twice twicelonger twicelonger"), (903, "y" * 70_000 + " " + "y" * 69_999 + "x"), (904, "y" * 70_000 + " " + "y" * 69_999 + "x")]
    docs += [(1000 + i, f"chainabb {'chainaab' if i % 12 == 0 else ''} {'Chainaaa' if i % 200 == 0 else ''}") for i in range(400)]
    df = spark.createDataFrame([(*d, "w", 1, "r") for d in docs], SCHEMA).repartition(5)
    got = sorted(map(tuple, spelling.variants(df, typo=31, limit=limit).collect()), key=lambda r: r[0])
    want = plain([("" if i is None else i, t) for i, t in docs])
    assert got == want and sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)


def test_pairs_meet_once(spark):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(700)})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    want = sorted((a, b) for a in words for b in words if near(a, b))
    for limit in (512, 30, 1):
        got = [(r.word, r.other) for r in spelling.near_words(df, Stash(spark, "t"), limit).collect()]
        assert sorted(got) == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(df, typo=31).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None, "", 0, "")], SCHEMA).where(F.lit(True))).columns == ["word", "form", "root", "n", "n_near", "form_n"]
