"""Every registered query against its DuckDB statement on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.plans.registry import ORACLES, QUERIES
from tests.conftest import SF001
from tools.oracle_check import TABLES, canon

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from tools.type_audit import SPARK_TO_DUCK
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                 for f in df.schema.fields}
    assert got_types == want_types
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon(rel.columns, rel.fetchall())
    assert c1 == c2
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "window_start", "window_end", "open_price", "close_price",
                          "percent_change", "alert_type"]
    assert df.count() >= 0
