import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hourcast.plans.catalog import REGISTRY as CATALOG
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
# Queries without SQL, MLlib's own fits, with their least rows.
ROWS_ONLY = {"tree_save_load_score": 100, "tree_score_segments": 100, "tree_rules": 5}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["carrier_id", "hour_of_day", "week_of_month", "avg_response_time",
                          "successful_charges", "no_credit", "errors", "total_attempts"]


CORE = set(CATALOG)


def test_every_query_has_oracle_or_is_rows_only():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q) and CORE <= set(q)
    assert CORE - set(o) == set(ROWS_ONLY)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_oracle_runs(spark, name):
    rows = queries()[name](spark, SF).collect()
    assert len(rows) >= ROWS_ONLY[name]


@pytest.mark.parametrize("name", sorted(CORE & set(oracle_sql())))
def test_oracle(spark, name):
    n, problems = compare(spark, name, SF, queries()[name], oracle_sql()[name])
    assert not problems, problems
