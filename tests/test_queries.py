"""Every query against its SQL in another engine, on the smallest tables."""

import duckdb
import pytest

from plumbline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 8) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if isinstance(v, (int, str, bool, type(None))) else str(v)


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)
    if name not in catalog.ORACLE_SQL:
        assert rows
        again = sorted((tuple(plain(v) for v in r) for r in catalog.QUERIES[name](spark, sf_dir).collect()), key=str)
        assert rows == again
        return
    cur = sql.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=str)
