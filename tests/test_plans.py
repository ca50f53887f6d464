"""Plan-shape checks: the properties that matter at scale, read from explain()."""

from datetime import datetime

from pyspark.sql import functions as F

from sales_rows import SF_SMALL, raw_frame
from tallyline.operators.clean import CleanConfig, dedupe_first
from tallyline.plans import catalog as C


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_combines_before_shuffle(spark, sample_raw_errors):
    plan = _plan(dedupe_first(sample_raw_errors))
    assert "partial_min" in plan, plan


def test_sales_plan_never_shuffles_raw_rows_by_file(spark):
    plan = _plan(C.q_v_country_analysis(spark, SF_SMALL))
    assert "LeftSemi" in plan
    # the valid-file filter is a broadcast join, not an exchange on the file name alone
    for line in plan.splitlines():
        if "Exchange hashpartitioning(" in line:
            keys = line.split("hashpartitioning(")[1]
            assert not keys.startswith("source_file#") or "order_id#" in keys, line
    assert "WindowGroupLimit" in plan, plan


def test_latest_per_key_limits_before_shuffle(spark):
    plan = _plan(C._run(spark, SF_SMALL).loaded())
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where(F.col("l_quantity") > 10).select("l_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_running_totals_have_no_single_partition_window(spark):
    df = C.q_running_totals(spark, SF_SMALL)
    plan = _plan(df)
    assert "SinglePartition" not in plan
    assert "MapInPandas" not in plan and "Python" not in plan      # the prefix scan stays in the JVM


def test_hot_duplicate_group_is_combined_map_side(spark):
    # a third of all rows share one order id
    rows = [("ORD-000001", "A", "1", "1", "2024-01-01", "C", "Canada")] * 300
    rows += [(f"ORD-{i:06d}", "A", "1", "1", "2024-01-01", "C", "Canada") for i in range(2, 602)]
    df = raw_frame(spark, rows).repartition(6)
    out = dedupe_first(df)
    got = {r.order_id: r.dup_count for r in out.collect()}
    assert got["ORD-000001"] == 299 and len(got) == 601
    # each map task sends at most one row per key: shuffle records <= keys x tasks
    from tallyline.operators.clean import clean

    cleaned = clean(df, CleanConfig(as_of=datetime(2025, 1, 1))).cleaned
    assert cleaned.count() == 601
