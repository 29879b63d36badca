"""Every query that has SQL gives the rows DuckDB gives."""

from __future__ import annotations

import duckdb
import pytest

import boreline.plans.bound_flows  # noqa: F401  (adds the flows and streams)
from __spark_entry__ import entry, oracle_sql, queries
from boreline.plans.bound import ORACLE, QUERIES
from check import TABLES, rows_of, same_kind

SQL = dict(ORACLE)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["name", "stage_num_td"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = rows_of(df.collect(), [df.columns.index(c) for c in columns])
    cur = duck.execute(SQL[name])
    theirs_columns = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    assert sorted(theirs_columns) == columns
    assert mine == rows_of(cur.fetchall(), [theirs_columns.index(c) for c in columns])
    assert all(same_kind(kind, kinds[c]) for c, kind in df.dtypes)
    assert mine, "an empty result checks nothing"
