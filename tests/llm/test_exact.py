import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weir.llm import exact

SCHEMA = "doc_id long, text string, lang string, n long, place string"


def plain(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    return sorted((i, max(groups[low(t)]), len(groups[low(t)]), max(groups[low(t)]) == i, hashlib.sha256(low(t).encode()).hexdigest()) for i, t in rows)


def some(n, seed=3):
    rnd = random.Random(seed)
    texts = ["Same Text", "same text", "SAME text\n", "", None, "ÄB", "äb", "äB"] + [f"t{k}" for k in range(n // 3)]
    return [(i, texts[0] if i % 3 == 0 else rnd.choice(texts)) for i in rnd.sample(range(10 * n), n)]


def table(spark, path, rows, files=6):
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(files).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("digest,sent", [(exact.sha256, exact.SENT), (exact.sha256, 0), (lambda t: F.length(t), exact.SENT), (lambda t: F.length(t) % 2, 0)])
def test_brute_force(spark, tmp_path, monkeypatch, digest, sent):
    """Also with digests that many texts share, which only the check of bytes tells apart, and where nothing may be sent."""
    monkeypatch.setattr(exact, "SENT", sent)
    rows = some(400) + [(9_999_999, "x" * 300_000), (9_999_998, "X" * 300_000)]
    path = table(spark, f"{tmp_path}/documents", rows)
    index = exact.ExactIndex(spark, f"{tmp_path}/state", digest=digest, batch=8_000)
    got = exact.dedup_exact(spark, path, index=index, split=16)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_later_files_meet_the_state(spark, tmp_path):
    rows = some(300)
    path, state = f"{tmp_path}/documents", f"{tmp_path}/state"
    for k in range(0, 300, 100):
        table(spark, path, rows[k : k + 100], 2)
        got = exact.dedup_exact(spark, path, index=exact.ExactIndex(spark, state)).collect()
        assert sorted(map(tuple, got)) == plain(rows[: k + 100])
    groups = exact.ExactIndex(spark, state).groups()
    assert groups.agg(F.sum("n")).first()[0] == 300 and groups.count() == len({r[4] for r in plain(rows)})


def test_repeated_and_null_ids(spark, tmp_path):
    path = table(spark, f"{tmp_path}/d", [(5, "a"), (5, "A"), (4, "a"), (None, "b"), (None, "B"), (None, "c"), (1, None), (2, "")], 3)
    got = exact.dedup_exact(spark, path).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    a, b, c, e = (by[hashlib.sha256(x.encode()).hexdigest()] for x in ("a", "b", "c", ""))
    assert [r.keep_id for r in a] == [5] * 3 and sum(r.kept for r in a) == 1 and next(r for r in a if r.kept).doc_id == 5
    assert [(r.keep_id, r.group_size) for r in b] == [(None, 2)] * 2 and sum(r.kept for r in b) == 1
    assert [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in c] == [(None, None, 1, True)]
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in e) == [(1, 2, False), (2, 2, True)]


def test_single_file_and_empty(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"doc_id": [1, 2, 3], "text": ["a", "A", "b"]}), f"{tmp_path}/one.parquet")
    assert sorted(map(tuple, exact.dedup_exact(spark, f"{tmp_path}/one.parquet").collect())) == plain([(1, "a"), (2, "A"), (3, "b")])
    empty = table(spark, f"{tmp_path}/none", [], 1)
    assert exact.dedup_exact(spark, empty).count() == 0
