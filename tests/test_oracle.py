"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from riskframe.plans.compare import compare
from riskframe.plans.inputs import TABLES

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    assert compare(df, con, ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["feature", "pearson_corr_with_target", "n"]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0
