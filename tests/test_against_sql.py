"""Queries against their SQL on tables with keys, ties and values that the given ones lack."""

import duckdb
import pytest

from plumbline.plans import catalog
from test_queries import plain


@pytest.fixture
def agree(spark, tmp_path):
    """Whether a query gives the rows of its SQL on tables that are given as SELECTs."""

    def check(name, **tables):
        con = duckdb.connect()
        for t, select in tables.items():
            con.execute(f"create table {t} as {select}")
            con.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
        cur = con.execute(catalog.ORACLE_SQL[name])
        names = [c[0] for c in cur.description]
        want = sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=str)
        got = sorted((tuple(plain(v) for v in r) for r in catalog.QUERIES[name](spark, str(tmp_path)).select(*names).collect()), key=str)
        assert want and got == want

    return check


def test_keys_of_two_tables_may_be_equal(agree):
    agree(
        "street_crossings", supplier="select 990 + i as s_suppkey from range(30) t(i)",
        nation="select i::int as n_nationkey from range(25) t(i)",
    )


def test_equal_areas_are_ranked_by_name(agree):
    """Widths of 500 whose last bits differ."""
    agree(
        "top_areas", supplier="select i as s_suppkey, 1 as s_nationkey, round(100.1 + i * 0.7, 2)::double as s_acctbal from range(20) t(i)",
        customer="select i * 10 as c_custkey, 'C' || lpad(i::varchar, 3, '0') as c_name, 1 as c_nationkey, round(101.37 + i * 0.01, 2)::double as c_acctbal from range(150) t(i)",
    )


def test_numbers_of_five_digits_in_sheet_urls(agree):
    agree("url_recode", pages="select 9990 + i as page_id from range(30) t(i) union all select 123456")


def test_a_box_over_more_than_a_thousand_equal_areas(agree):
    """The latest names come first; the last bits of the others' areas are above them or below."""
    agree(
        "polygon_areas", supplier="select i as s_suppkey, (i * 100)::double as s_acctbal from range(3) t(i)",
        customer="select i as c_custkey, 'C' || lpad(i::varchar, 5, '0') as c_name, CASE WHEN i < 19900 THEN round(100 + (i * 0.137) % 300, 2) ELSE 160 END::double as c_acctbal from range(20000) t(i)",
    )
