"""The driver's gate on the smallest scale: registered queries vs DuckDB SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
# the operators of the optional subpackage are compared in its own tests
NAMES = [n for n in E.queries() if not n.startswith("op") and n != "pipeline"]
WITH_SQL = [n for n in NAMES if n in E.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["type", "ID", "period_no"]
    assert df.count() > 0


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(dcols, cur.fetchall())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in WITH_SQL])
def test_others_return_rows(spark, name):
    assert E.queries()[name](spark, SF).count() > 0


def test_every_circuit_is_looked_at(spark):
    tagged = E.queries()["p7_w1_tagged"](spark, SF)
    assert tagged.select("type", "ID").distinct().count() == 5
    counts = E.queries()["n4_cross_circuit_pairs"](spark, SF).collect()
    for r in counts:
        n = r["n_measured"]
        assert r["pairs_both"] + r["pairs_one"] + r["pairs_none"] == n * (n - 1) // 2
    assert sum(r["n_dropped"] for r in counts) == E.queries()["n4_cross_circuit"](spark, SF).count()
