"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.scenarios import QUERIES as SCENARIOS
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_documented():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, queries()[name], oracle_sql()[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


# Scenarios run for long and are left to ``compare``, which looks at types, too.
@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - set(SCENARIOS)))
def test_query_types_match_oracle(spark, con, name):
    spark_types = dict(queries()[name](spark, SF).dtypes)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()}
    diffs = {c: (t, duck_types.get(c)) for c, t in spark_types.items() if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)}
    assert not diffs
