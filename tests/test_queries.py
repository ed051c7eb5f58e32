"""Every registered query of the engine against its SQL, over whole tables."""

import duckdb
import pytest

from vantagrid.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    result = sql.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    assert got == sorted((tuple(r[columns.index(c)] for c in names) for r in result.fetchall()), key=repr)
