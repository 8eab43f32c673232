import math
import random
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm import test_lines, test_quality  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, size=5):
    w = test_quality.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def plain_near(rows):
    """One row of each group, the least (null last) doc_id; equal rows are one."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    best = {}
    for i, r in enumerate(rows):
        best.setdefault(find(i), []).append(r)
    return [min(v, key=lambda r: (r[0] is None, r[0] or 0)) for v in best.values()]


def plain_lines(rows, most=2, least=40, exact=20):
    """Every line against every other, the plain way; equal lines from ``exact`` characters on."""
    seen = [(i is not None, i, k, t, test_lines.norm(x)) for i, t in {(r[0], r[1]) for r in rows} if t for k, x in enumerate(t.split("\n"))]
    seen = sorted((x for x in seen if len(x[4]) >= exact), key=lambda x: (x[0], x[1] or 0, x[2]))
    group = list(range(len(seen)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(seen)):
        for j in range(i):
            a, b = seen[i][4], seen[j][4]
            if a == b or (min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= most and sum((Counter(a) - Counter(b)).values()) <= most and test_lines.distance(a, b) <= most):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    gone = {(s[1], s[3], s[2]) for i, s in enumerate(seen) if find(i) != i}
    out = []
    for r in rows:
        text = None if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if (r[0], r[1], k) not in gone)
        if text is not None and test_quality.WORD.search(text):
            out.append((r[0], text, r[2], r[3], len(text)))
    return out


def corpus():
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(n))
    stock = line(9)
    rows = []
    for i in range(150):
        own = [line(rnd.randint(6, 14)) for _ in range(rnd.randint(3, 6))]
        if i % 5 == 0:
            own.insert(1, stock if i % 10 else stock.replace("a", "z", 1))
        rows.append((i, "\n".join(own), rnd.choice(["en", "de"]), rnd.choice(["s", "s", "t", None])))
    for i in range(12):  # near copies with words exchanged in each line, further than two edits
        changed = [x.split(" ") for x in rows[i * 3][1].split("\n")]
        changed[0][0], changed[-1][-1] = word() + "qqq", word() + "rrr"
        rows.append((200 + i if i % 3 else None, "\n".join(" ".join(x) + " more%d" % (i % 2) * 3 for x in changed), "en", "s"))
    rows += [rows[4], rows[4], (None, line(60), "en", "s"), (None, line(61), "en", "s"), (3, "x", "en", "s"), (None, None, None, None), (7, "", "de", "t")]
    rows += [rows[-5]] * 2 + [(300, "#%$ " * 40 + line(30), "en", "s")]
    return [(*r, len(r[1] or "")) for r in rows]


def test_stages_match_plain_versions(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen, before, df = {}, rows, docs
    for name, f in corpus_pipeline.STAGES:
        f(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        got = [tuple(r) for r in df.collect()]
        if name != "encode":
            assert df.columns == corpus_pipeline.COLUMNS
        if name == "quality rules":
            st, ok, kept, dist = test_quality.judged([(r[0], r[1], r[2], r[3]) for r in before], least=1)
            assert {r for r in got} <= {r for r, o in zip(before, ok, strict=True) if o} and len(got) > 0.9 * sum(ok)
            assert all(r[1] != rows[-1][1] for r in got)
        elif name == "line dedup":
            assert sorted(got, key=repr) == sorted(plain_lines(before), key=repr)
        elif name == "near dedup":
            want = plain_near(before)
            assert len(got) == len(want) < len(before)
            assert sorted((r for r in got if r[0] is not None), key=repr) == sorted((r for r in want if r[0] is not None), key=repr)
            assert Counter(r[0] for r in got)[None] == Counter(r[0] for r in want)[None]
        elif name == "mix sources":
            size = lambda r: len(test_quality.WORD.findall(r[1]))
            times = Counter(got)
            assert set(times) <= set(before) and max(times.values()) <= 2
            for s in ("s", "t", None):
                have, took = (sum(size(r) for r in x if r[3] == s) for x in (before, got))
                assert took <= 2 * have
            total = sum(size(r) for r in before)
            assert abs(sum(size(r) for r in got) - 1.5 * total) < 3 * max(size(r) for r in before)
        else:
            tokenizers = pytest.importorskip("tokenizers")
            from weir.llm import bpe

            tok = tokenizers.Tokenizer.from_file(bpe.vocabulary())
            tok.no_truncation()
            tok.no_padding()
            want = Counter((r[0], len(tok.encode(r[1], add_special_tokens=False).ids)) for r in before)
            assert Counter((r.doc_id, r.n_tokens) for r in df.collect()) == want
        seen[name], before = got, got
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in df.collect())


def test_repeated_rows_and_null_ids_end_as_one(spark, tmp_path):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(1, base, "en", "s"), (1, base, "en", "s"), (None, base + " more", "en", "s"), (None, "other " * 3 + base.upper().replace("WORD", "term"), "en", "s"), (None, "other " * 3 + base.upper().replace("WORD", "term"), "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], SCHEMA).repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.text) for r in got) == [(False, base), (True, rows[3][1])]
    mixed = corpus_pipeline.mix_sources(spark, docs, "").collect()
    words = sum(len(r[1].split()) for r in rows)
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * words) <= 66 and max(Counter(r.text for r in mixed).values()) <= 4
    assert math.isclose(1.5 * words, 459.0, abs_tol=200)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_writes_no_texts(spark, tmp_path, monkeypatch):
    wrote = []
    put = corpus_pipeline.Stash.put
    monkeypatch.setattr(corpus_pipeline.Stash, "put", lambda self, df: wrote.append(df.columns) or put(self, df))
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, "A b c", "en", "s", 5), (2, "d e", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == [(1, "a b c"), (2, "d e")]
    assert wrote and not any("text" in c and "lang" in c for c in wrote)
