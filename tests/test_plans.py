"""Every registered plan against its DuckDB oracle on the smallest tables
(row count, column names, order-insensitive values)."""

import os
import sys

import duckdb
import pytest

from helpers import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import oracle_check as OC  # noqa: E402
import __spark_entry__ as E  # noqa: E402

QS = E.queries()
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in OC.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["role_family", "pages", "pricing_models", "hosts"]


def test_every_plan_has_oracle_or_is_declared():
    # iterative; its checkable facts are in topic_clusters_check
    rows_only = {"topic_clusters"}
    # the optional part has brute-force tests of its own
    assert set(QS) - set(SQLS) - set(E.LLM_QUERIES) == rows_only


@pytest.mark.parametrize("name", sorted(set(QS) - set(SQLS) - set(E.LLM_QUERIES)))
def test_plan_without_oracle_runs(spark, name):
    assert QS[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(set(QS) & set(SQLS)))
def test_plan_matches_oracle(spark, duck, name):
    sdf = QS[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.sql(SQLS[name])
    orows = [tuple(r) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(res.columns)
    assert len(srows) == len(orows)
    assert OC.digest(srows, sdf.columns)[0] == OC.digest(orows, res.columns)[0]
