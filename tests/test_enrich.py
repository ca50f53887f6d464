from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.operators.enrich import (
    EnrichConfig,
    compute_aggregates,
    daily_summary,
    enrich,
    enrichment_stats,
    running_totals,
)

RUN_TS = datetime(2025, 1, 1)


@pytest.fixture
def cleaned(spark):
    rows = [
        ("f", "ORD-001001", "Oak Desk", 2, 999.99, "2024-01-15", "CUST-20417", "United States"),
        ("f", "ORD-001002", "Reading Lamp", 5, 29.99, "2024-01-16", "CUST-31855", "Canada"),
        ("f", "ORD-001003", "Wool Rug", 3, 49.99, "2024-01-17", "CUST-40266", "United Kingdom"),
        ("f", "ORD-001004", "Bookshelf", 1, 129.99, "2024-01-18", "CUST-57731", "Germany"),
        ("f", "ORD-001005", "Floor Mirror", 2, 349.99, "2024-01-19", "CUST-68102", "France"),
    ]
    df = spark.createDataFrame(rows, "source_file string, order_id string, product_name string, quantity int, "
                                     "unit_price double, order_date string, customer_id string, country string")
    return df.withColumn("order_date", F.to_date("order_date"))


def test_total_amount(cleaned):
    got = {r.order_id: r.total_amount for r in enrich(cleaned, EnrichConfig(run_ts=RUN_TS)).collect()}
    assert got["ORD-001001"] == 1999.98 and got["ORD-001002"] == 149.95


def test_rounding_half_even_on_binary_value(spark):
    df = spark.createDataFrame([(3, 33.333), (5, 33.333), (1, 2.665), (1, 2.675)], "quantity int, unit_price double")
    got = [r.total_amount for r in enrich(df, EnrichConfig(True, False)).collect()]
    assert got == [100.0, 166.66, 2.66, 2.68]


def test_revenue_category(spark):
    df = spark.createDataFrame([(1, 25.0), (1, 100.0), (1, 500.0), (1, 2000.0)], "quantity int, unit_price double")
    got = [r.revenue_category for r in enrich(df, EnrichConfig(True, False, False, True)).collect()]
    assert got == ["Small", "Medium", "Large", "Enterprise"]


def test_date_parts(cleaned):
    r = enrich(cleaned, EnrichConfig(False, False, True)).where("order_id = 'ORD-001001'").first()
    assert (r.order_year, r.order_month, r.order_day, r.order_weekday) == (2024, 1, 15, "Monday")


def test_timestamp_constant(cleaned):
    ts = {r.ingestion_timestamp for r in enrich(cleaned, EnrichConfig(run_ts=RUN_TS)).collect()}
    assert ts == {RUN_TS}


def test_stats(cleaned):
    r = enrichment_stats(enrich(cleaned, EnrichConfig(run_ts=RUN_TS))).first()
    assert r.row_count == 5 and r.total_revenue == 3129.87 and r.fields_added == "total_amount,ingestion_timestamp"


def test_aggregates_and_unknown_column(cleaned):
    e = enrich(cleaned, EnrichConfig(run_ts=RUN_TS))
    rows = compute_aggregates(e, "country").collect()
    assert [r.country for r in rows] == sorted(r.country for r in rows)
    assert compute_aggregates(e, "nope").count() == 0


def test_daily_summary(cleaned):
    rows = daily_summary(enrich(cleaned, EnrichConfig(run_ts=RUN_TS))).collect()
    assert len(rows) == 5 and rows[0].revenue == 1999.98


def test_running_totals_last_equals_sum(spark):
    from tallyline.sources.generator import synthetic_sales
    from tallyline.operators.clean import CleanConfig, clean

    raw = synthetic_sales(spark, 3000, 0.05, seed=7).withColumn("source_file", F.lit("g")) \
        .withColumn("row_ordinal", F.struct("id")).drop("id")
    c = clean(raw, CleanConfig()).cleaned
    e = enrich(c, EnrichConfig(run_ts=RUN_TS))
    rt = running_totals(e, partitions=5).collect()
    n = len(rt)
    assert sorted(r.running_orders for r in rt) == list(range(1, n + 1))
    last = max(rt, key=lambda r: r.running_orders)
    total = e.agg(F.sum(F.col("total_amount").cast("decimal(12,2)")).cast("double")).first()[0]
    assert abs(last.running_revenue - total) < 1e-6
    # Monotone in (date, order_id, file) order.
    srt = sorted(rt, key=lambda r: (r.order_date, r.order_id, r.source_file))
    assert [r.running_orders for r in srt] == list(range(1, n + 1))
