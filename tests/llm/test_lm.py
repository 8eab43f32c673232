import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from weir.llm import lm

D = lm.ORDER


def held(i, folds=10):
    return i is not None and zlib.crc32(str(i).encode()) % folds == 0


def reference(rows):
    """Plain prediction by partial matching, one byte at a time."""
    ctx = defaultdict(Counter)
    words = Counter()
    toks = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
    for i, t in rows:
        if held(i):
            continue
        words.update(toks(t))
        s = bytes([lm.START]) * D + (t or "").encode() + bytes([lm.END])
        for p in range(D, len(s)):
            for j in range(D + 1):
                ctx[s[p - j : p]][s[p]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for i, t in rows:
        s, total = bytes([lm.START]) * D + (t or "").encode() + bytes([lm.END]), 0.0
        for p in range(D, len(s)):
            gone = set()
            for j in range(D, -1, -1):
                at = {k: c for k, c in ctx.get(s[p - j : p], {}).items() if k not in gone}
                if not at:
                    continue
                if s[p] in at:
                    total += math.log10(at[s[p]] / (sum(at.values()) + len(at)))
                    break
                total += math.log10(len(at) / (sum(at.values()) + len(at)))
                gone |= set(at)
            else:
                total -= math.log10(256 - len(gone))
        ts = toks(t)
        out.append((i, held(i), len(ts), sum(words[w] > 0 for w in ts), n, sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts), total))
    return out


TEXTS = [None, "", "  ", "The cat sat on the mat.", "the cat sat\ton THE mat again", "zebra quilt éß", "x" * 400, "abracadabra " * 30, "The cat sat on the mat.", "中文 text"]


@pytest.mark.parametrize("hot", [(4_000_000, 300_000), (3, 2)])
def test_scores_match_a_plain_model(spark, hot):
    rows = [(None if i == 7 else i, TEXTS[i % len(TEXTS)]) for i in range(40)]
    assert any(held(i) for i, _ in rows)
    df = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, score string").repartition(3)
    got = sorted((tuple(r) for r in lm.score(df, hot_grams=hot[0], hot_words=hot[1]).collect()), key=lambda r: (str(r[0]), r[6]))
    want = sorted(reference(rows), key=lambda r: (str(r[0]), r[6]))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_empty(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
