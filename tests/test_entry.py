import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["categoria", "departamento", "total_receita", "qtd_itens", "media_satisfacao", "total_funcionarios"]
    assert len(rows) == 7
    assert [r.total_receita for r in rows] == sorted((r.total_receita for r in rows), reverse=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.lake_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.lake_queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    res = duck.execute(sql)
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err


# Keys checked on rows only.
ROWS_ONLY: set[str] = set()


def test_every_key_has_an_oracle_or_a_reason():
    keys, oracles = set(E.lake_queries()), set(E.oracle_sql()) & set(E.lake_queries())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert keys - oracles == ROWS_ONLY
