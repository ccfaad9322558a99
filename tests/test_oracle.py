"""Every query of the catalog against its DuckDB oracle on the smoke-scale tables."""

import pytest

import __spark_entry__ as E
from tests.helpers import duck, rows_digest, spark_rows
from usagelens.plans import catalog

# Queries of optional subpackages have tests of their own.
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["gather_cycle", "custid", "prov", "city", "gather_type", "gather_value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    s_cols, s_rows = spark_rows(E.queries()[name](spark, sf_dir))
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    hs, ls = rows_digest(s_cols, s_rows)
    hd, ld = rows_digest(d_cols, d_rows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])


SHUFFLED = ["usage_summary", "daily_dimension_summary", "roaming_matrix", "day_aggregate", "auth_summary",
            "usage_outlier_period", "area_rank"]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_matches_oracle_without_broadcast(spark, sf_dir, con, name):
    """The path taken at scale: no dimension fits the broadcast budget, so facts are
    pre-aggregated and shuffle-joined."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s_cols, s_rows = spark_rows(E.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    hs, _ = rows_digest(s_cols, s_rows)
    hd, _ = rows_digest(d_cols, cur.fetchall())
    assert hs == hd
