import os

import pytest

from weir.plans import catalog

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SMALL}/{f}')")
    return con


#: What must hold for queries that have no SQL.
WITHOUT_SQL: dict = {}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    got = sorted((key(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got
    if name in catalog.ORACLE:
        rel = duck.sql(catalog.ORACLE[name])
        assert sorted(rel.columns) == cols
        assert got == sorted((key(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
    else:
        assert WITHOUT_SQL[name](got, cols)


def test_identify_language_matches_sql_on_more_than_100_000_labelled_rows(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = spark.range(130_000).selectExpr(
        "id AS doc_id",
        "CASE WHEN id % 1000 = 1 THEN '' WHEN id % 1000 = 2 THEN NULL ELSE concat('w', substring(md5(string(id)), 1, 3), ' ', substring(md5(string(id)), 4, 2)) END AS text",
        "CASE WHEN id % 1000 = 1 THEN 'none' WHEN id % 1000 = 3 THEN NULL WHEN md5(string(id)) LIKE '%a%' THEN 'a' ELSE 'b' END AS lang",
    )
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalog.QUERIES["identify_language"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == sorted(con.execute(catalog.ORACLE["identify_language"]).fetchall())
