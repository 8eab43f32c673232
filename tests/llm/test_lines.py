import hashlib
import random
import re

from pyspark.sql import functions as F

from weir.llm import lines


def norm(x):
    return re.sub(r"[\x20\x09-\x0D]+", " ", x.lower()).strip(" ")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    base = [text(n) for n in (10, 18, 19, 20, 25, 26, 40, 60)]
    docs = [None, "", "\n\n", "short"]
    for _ in range(40):
        own = []
        for _ in range(rnd.randint(0, 6)):
            x = list(rnd.choice(base) if rnd.random() < 0.7 else text(rnd.randint(15, 30)))
            for _ in range(rnd.choice([0, 1, 2, 3])):
                k, i = rnd.random(), rnd.randrange(len(x) + 1)
                if k < 0.4:
                    x.insert(i, rnd.choice("abZ"))
                elif i < len(x):
                    x[i : i + 1] = [] if k < 0.7 else ["q"]
            own.append("".join(x))
        docs.append("\n".join(own))
    return [(i, t) for i, t in enumerate(docs)]


def brute_near(rows, most, least):
    all_ = [(i, k, norm(x)) for i, t in rows if t for k, x in enumerate(t.split("\n"))]
    all_ = [r for r in all_ if len(r[2]) >= least]
    par = list(range(len(all_)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(all_)):
        for j in range(i):
            if distance(all_[i][2], all_[j][2]) <= most:
                a, b = find(i), find(j)
                par[max(a, b)] = min(a, b)
    gone = {}
    for i, (d, k, _) in enumerate(all_):
        if find(i) != i:
            gone.setdefault(d, []).append(k)
    return sorted((i, len(t.split("\n")) if t else 0, len(gone.get(i, [])), ",".join(map(str, gone.get(i, [])))) for i, t in rows)


def test_near_lines_match_brute_force(spark):
    for most in (1, 2):
        rows = corpus(most)
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, gone int").repartition(3)
        assert sorted(tuple(r) for r in lines.dedup_near_lines(df, most, 18).collect()) == brute_near(rows, most, 18)


def test_kept_text_and_extra_columns(spark):
    rows = [(2, "a" * 50 + "\nx\n" + "A" * 51, "e"), (1, "y\n" + "a" * 50, "f"), (None, "a" * 49, "g"), (3, None, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = {r.doc_id: r for r in lines.dedup_near_lines(df, 2, 40, texts=True).collect()}
    assert {k: r.kept_text for k, r in got.items()} == {2: "x", 1: "y", None: "a" * 49, 3: None}
    assert got[2].text == rows[0][1] and got[1].component == "f"
    assert lines.dedup_near_lines(df.limit(0)).count() == 0


def test_clashing_names_short_lines_and_long_texts(spark):
    long = "".join(random.Random(1).choice("abc de") for _ in range(60_000))
    stock = "All rights reserved!"
    rows = [(1, f"{stock}\n" + long, 5, 6, 7), (2, f"tiny\n{stock}\n" + long[:30_000] + "z" + long[30_000:], 5, 6, 7), (3, f"tiny\n{stock[:-1]}", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int, __d int, __lost int")
    got = {r.doc_id: r for r in lines.dedup_near_lines(df, texts=True).collect()}
    assert {k: r.kept_text for k, r in got.items()} == {1: rows[0][1], 2: "tiny", 3: rows[2][1]}
    assert got[1].gone == 5 and got[2]["__d"] == 6 and got[2]["__lost"] == 7


def test_one_large_group_of_variants(spark):
    """Lines that share segments by the hundred and link only here and there."""
    rnd = random.Random(6)
    base = [rnd.choice("abcdefgh") for _ in range(90)]
    rows = []
    for i in range(150):
        x = list(base)
        for _ in range(rnd.randint(0, 5)):
            x[rnd.randrange(90)] = rnd.choice("ijklmnop")
        rows.append((i, "".join(x)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in lines.dedup_near_lines(df).collect()) == brute_near(rows, 2, 40)


def test_distance_in_a_band(spark):
    rnd = random.Random(9)
    rows = [("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))), "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9)))) for _ in range(400)]
    chars = lambda c: F.array_remove(F.split(c, ""), "")
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", lines.within(chars("a"), chars("b"), 2).alias("w")).collect()
    assert all(r.w == (distance(r.a, r.b) <= 2) for r in got)


def pieces(text, unit):
    if unit == "sentence":
        return re.findall(r"[^\n.!?]*[\n.!?]+|[^\n.!?]+", text)
    have = re.findall(r"[^\n]*\n|[^\n]+", text)
    if unit == "line":
        return have
    cut = re.split(r"(\n[\x20\x09-\x0D]*\n)", text)
    return [x for x in ("".join(cut[i : i + 2]) for i in range(0, len(cut), 2)) if x]


def brute_units(rows, unit, least):
    """Every pair of runs, the plain way."""
    found = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        all_ = pieces(t or "", unit)
        have = [(k, norm(x).split(" ")) for k, x in enumerate(all_) if norm(x)]
        if have and sum(len(x) for _, x in have) < least:
            found.append((i, have[0][0], have[-1][0], ["whole", *[x for _, x in have]]))
        line = [sum("\n" in x for x in all_[:k]) for k, _ in have]
        for n in sorted(set(line)) if unit == "sentence" else []:
            mine = [h for h, m in zip(have, line, strict=True) if m == n]
            if sum(len(x) for _, x in mine) >= least:
                found.append((i, mine[0][0], mine[-1][0], [x for _, x in mine]))
        for a in range(len(have)):
            for b in range(a, len(have)):
                if sum(len(x) for _, x in have[a : b + 1]) >= least:
                    found.append((i, have[a][0], have[b][0], [x for _, x in have[a : b + 1]]))
                    break
    drop = {i: set() for i, _ in rows}
    found = sorted({(i is not None, i or 0, a, b): (i, a, b, x) for i, a, b, x in found}.items())
    found = [f for _, f in found]
    for n, (i, a, b, x) in enumerate(found):
        if any(y == x for *_, y in found[:n]):
            drop[i] |= set(range(a, b + 1))
    out = []
    for i, t in rows:
        have, at, spans, kept = pieces(t or "", unit), 0, [], ""
        for k, x in enumerate(have):
            e = at + len(x.encode())
            if k in drop[i] and norm(x):
                spans.append(f"{at}-{e}")
            else:
                kept += x
            at = e
        out.append((i, len(have), len(spans), ",".join(spans), hashlib.md5(kept.encode()).hexdigest()))
    return sorted(out)


def test_units_match_brute_force(spark):
    rnd = random.Random(3)
    parts = ["one two three", "One  two three ", "é ü. Ab", "", "a b", "x y z w! v", "  ", "one. two three"]
    for unit, sep in (("line", "\n"), ("paragraph", "\n \n"), ("sentence", " "), ("sentence", "\n")):
        rows = [(0, None), (1, "")] + [(i, sep.join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))) for i in range(2, 60)]
        df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, tid int").repartition(3)
        for least in (2, 5):
            got = sorted(tuple(r) for r in lines.dedup_units(df, unit, least).collect())
            assert got == brute_units(rows, unit, least), (unit, least)
    assert lines.dedup_units(df.limit(0)).count() == 0


def test_a_passage_inside_a_line_goes_and_clean_texts_stay(spark):
    rnd = random.Random(4)
    say = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage = ". ".join(say(9) for _ in range(7)) + "."
    rows = [(1, say(20) + ". " + passage + " " + say(20)), (2, say(15) + ". " + passage + " " + say(9) + ".\nAll rights reserved."), (3, say(80) + ".\nAll rights reserved."), (None, None)]
    rows += [(4, say(30_000)), (4, rows[0][1]), (4, rows[0][1])]
    got = sorted(((r.doc_id, r.n_removed, r.kept) for r in lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), texts=True).collect()), key=repr)
    by = {}
    for i, n, kept in got:
        by.setdefault(i, []).append((n, kept))
    assert by[1] == [(0, rows[0][1])] and by[3] == [(0, rows[2][1])] and by[None] == [(0, "")]
    assert by[2][0][0] == 7 and passage[:40] not in by[2][0][1] and by[2][0][1].endswith("reserved.")
    assert sorted(n > 0 for n, _ in by[4]) == [False, True, True] and by[4][1] == by[4][2]
