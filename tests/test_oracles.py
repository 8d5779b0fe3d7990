"""Every query with an oracle: Spark result == DuckDB result on sf0.001
(rows, column kinds, order-free values)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from purchase_signals.sources.tables import BASE_TABLES
from tools.oracle_check import kind_duck, kind_spark, norm

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = con.execute(ORACLES[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    skind = {f.name: kind_spark(f.dataType) for f in df.schema.fields}
    dkind = {d[0]: kind_duck(str(d[1])) for d in cur.description}
    assert skind == dkind
    assert len(rows) == len(drows)
    order = sorted(cols)
    s = sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in rows), key=repr)
    d = sorted((tuple(norm(r[dcols.index(c)]) for c in order) for r in drows), key=repr)
    assert s == d


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["region", "visits", "users", "purchases", "purchase_rate"]
