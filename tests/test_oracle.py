"""Each registered query against its SQL statement (DuckDB) on the smallest tables."""

import pytest

from sales_rows import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as E

FAST = ["clean_full", "clean_stats", "enrich_full", "agg_by_country", "running_totals", "v_country_analysis",
        "upsert", "load_gate", "check_counts", "validation_report", "run_summary", "daily_change", "load_rejects", "quarantine",
        "coerced", "check_counts_faults", "delete_before", "load_counts", "drop_empty_rows_faults", "schema_problems", "orders_exist", "sample_daily_sales", "sample_product_performance"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    from tallyline.plans.catalog import QUERIES
    from tallyline.plans.oracle import ORACLE_SQL

    assert set(ORACLE_SQL) == set(QUERIES) and set(QUERIES) <= set(E.queries())


def test_every_rule_is_seen_to_fail(spark):
    from tallyline.plans.catalog import QUERIES

    counts = {}
    for r in QUERIES["check_counts_faults"](spark, SF_SMALL.replace("0.001", "0.01")).collect():
        counts[r["column"], r["check"]] = counts.get((r["column"], r["check"]), 0) + r["failures"]
    assert all(counts.values()), counts


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "country"
