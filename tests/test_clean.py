from datetime import date, datetime

from sales_rows import raw_frame

from tallyline.operators.clean import (
    CleanConfig,
    clean,
    clean_column_names,
    dedupe_first,
    normalize_countries,
    parse_numerics,
    remove_empty_rows,
)

AS_OF = datetime(2025, 1, 1)
CFG = CleanConfig(as_of=AS_OF)


def test_clean_data_all_rows_survive(sample_raw):
    out = clean(sample_raw, CFG)
    assert out.cleaned.count() == 5
    st = out.stats().first()
    assert (st.original_count, st.cleaned_count, st.rows_removed) == (5, 5, 0)
    assert st.removal_rate == 0.0


def test_error_fixture_leaves_one_row(sample_raw_errors):
    out = clean(sample_raw_errors, CFG)
    rows = out.cleaned.collect()
    assert [r.order_id for r in rows] == ["ORD-001001"]
    st = out.stats().first()
    assert st.duplicates_removed == 1
    assert st.invalid_dates_removed == 2      # invalid-date, 2030
    assert st.invalid_numerics_removed == 1   # 'invalid'
    assert st.cleaned_count == 1 and st.original_count == 5


def test_dedupe_keeps_first_in_file_order(spark):
    df = raw_frame(spark, [
        ("ORD-001001", "A", "1", "1", "2024-01-01", "CUST-20417", "Canada"),
        ("ORD-001001", "B", "2", "1", "2024-01-01", "CUST-20417", "Canada"),
        ("ORD-001002", "C", "3", "1", "2024-01-01", "CUST-20417", "Canada"),
    ])
    out = dedupe_first(df).orderBy("order_id").collect()
    assert [(r.order_id, r.product_name, r.dup_count) for r in out] == [("ORD-001001", "A", 1), ("ORD-001002", "C", 0)]


def test_null_ids_are_one_group(spark):
    df = raw_frame(spark, [(None, "A", "1", "1", "2024-01-01", "", ""), (None, "B", "1", "1", "2024-01-01", "", "")])
    assert dedupe_first(df).count() == 1


def test_dedupe_same_for_one_and_many_partitions(spark, sample_raw_errors):
    a = sorted(map(tuple, dedupe_first(sample_raw_errors.coalesce(1)).collect()))
    b = sorted(map(tuple, dedupe_first(sample_raw_errors.repartition(7)).collect()))
    assert a == b


def test_future_and_old_dates_removed(spark):
    df = raw_frame(spark, [
        ("ORD-000001", "A", "1", "1", "2024-01-15", "CUST-20417", "Canada"),
        ("ORD-000002", "A", "1", "1", "2099-01-01", "CUST-20417", "Canada"),
        ("ORD-000003", "A", "1", "1", "2019-12-31", "CUST-20417", "Canada"),
        ("ORD-000004", "A", "1", "1", "2020-01-01", "CUST-20417", "Canada"),
        ("ORD-000005", "A", "1", "1", "2024-1-5", "CUST-20417", "Canada"),
    ])
    rows = {r.order_id: r.order_date for r in clean(df, CFG).cleaned.collect()}
    assert rows == {"ORD-000001": date(2024, 1, 15), "ORD-000004": date(2020, 1, 1), "ORD-000005": date(2024, 1, 5)}


def test_numeric_parsing_rules(spark):
    vals = ["5.0", " 7 ", "1e3", "1d", "0x10", "1,000", "inf", "NaN", "1.9", "0.5", "10001"]
    df = raw_frame(spark, [(f"ORD-{i:06d}", "A", v, "10", "2024-01-01", "CUST-20417", "Canada") for i, v in enumerate(vals)])
    got = {r.order_id: r.quantity for r in clean(df, CFG).cleaned.collect()}
    assert got == {"ORD-000000": 5, "ORD-000001": 7, "ORD-000002": 1000, "ORD-000008": 1, "ORD-000009": 0}


def test_fill_and_normalize(spark):
    df = raw_frame(spark, [
        ("ORD-000001", "", "1", "1", "2024-01-01", None, None),
        ("ORD-000002", "  Big    Box  ", "1", "1", "2024-01-01", "  CUST-20417 ", "United  Kingdom"),
        ("ORD-000003", "   ", "1", "1", "2024-01-01", "CUST-31855", " great britain "),
    ])
    out = clean(df, CFG)
    rows = {r.order_id: r for r in out.cleaned.collect()}
    assert rows["ORD-000001"].product_name == "Unknown Product"
    assert rows["ORD-000001"].customer_id == "UNKNOWN"
    assert rows["ORD-000001"].country == "Unknown"
    assert rows["ORD-000002"].product_name == "Big Box"        # Unicode space squeezed
    assert rows["ORD-000002"].customer_id == "CUST-20417"
    assert rows["ORD-000002"].country == "United Kingdom"
    assert rows["ORD-000003"].product_name == ""               # whitespace-only is not filled
    assert rows["ORD-000003"].country == "United Kingdom"
    st = out.stats().first()
    assert (st.filled_product_name, st.filled_customer_id, st.filled_country) == (1, 1, 1)


def test_country_map(spark):
    vals = ["USA", "us", "UK", "gb", "germany", "Germany", "", None, "none", "Atlantis"]
    df = raw_frame(spark, [(f"ORD-{i:06d}", "A", "1", "1", "2024-01-01", "C", v) for i, v in enumerate(vals)])
    got = [r.country for r in normalize_countries(df).orderBy("order_id").collect()]
    assert got == ["United States", "United States", "United Kingdom", "United Kingdom", "Unknown", "Germany",
                   "Unknown", "Unknown", "Unknown", "Unknown"]


def test_fill_off_gives_nan_text(sample_raw_errors):
    cfg = CleanConfig(fill_missing=False, as_of=AS_OF, validate_dates=False, validate_numerics=False)
    rows = {r.order_id: r for r in clean(sample_raw_errors, cfg).cleaned.collect()}
    assert rows["ORD-001003"].product_name == ""
    assert rows["ORD-001002"].product_name == "Reading Lamp"
    assert rows["ORD-001002"].quantity == "-5"   # numeric step off: text kept


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2)], " `Order ID` int, `Unit-Price ` int")
    assert clean_column_names(df).columns == ["order_id", "unitprice"]


def test_remove_empty_rows(spark):
    df = raw_frame(spark, [(None,) * 7, ("ORD-000001", None, None, None, None, None, None)])
    assert remove_empty_rows(df).count() == 1


def test_rows_in_equal_kept_plus_rejected_plus_duplicates(spark):
    """Invariant on the real fixture tables: every raw row is kept, rejected
    (with a reason) or dropped as a duplicate, per file."""
    from pyspark.sql import functions as F

    from sales_rows import SF_SMALL
    from tallyline.sources.tables import raw_sales

    raw = raw_sales(spark, SF_SMALL)
    out = clean(raw, CFG)
    stats = {r.source_file: r for r in out.stats().collect()}
    raw_n = {r.source_file: r["count"] for r in raw.groupBy("source_file").count().collect()}
    kept = {r.source_file: r["count"] for r in out.cleaned.groupBy("source_file").count().collect()}
    rej = {r.source_file: r["count"] for r in out.rejected.groupBy("source_file").count().collect()}
    for f, n in raw_n.items():
        s = stats[f]
        assert s.original_count == n
        assert kept.get(f, 0) == s.cleaned_count
        assert kept.get(f, 0) + rej.get(f, 0) + s.duplicates_removed == n
        assert rej.get(f, 0) == s.invalid_dates_removed + s.invalid_numerics_removed
    assert out.rejected.where(F.col("reject_reason").isNull()).count() == 0


def test_numeric_step_parses_each_text_once_in_its_filter(spark):
    pairs = [("1", "0.01"), ("10000", "100000"), ("10001", "5"), ("5", "100000.01"), ("0", "5"), ("5", "0"), ("-1", "5"), ("x", "5"), ("5", ""),
             (" 7 ", "2.5"), ("1e999", "5"), ("0.5", "5"), (None, "5"), ("5", None)]
    out = parse_numerics(raw_frame(spark, [(f"ORD-{i:06d}", "a", q, p, "2024-01-15", "CUST-20417", "Canada") for i, (q, p) in enumerate(pairs)]))
    assert sorted((r["quantity"], r["unit_price"]) for r in out.collect()) == [(0, 5.0), (1, 0.01), (7, 2.5), (10000, 100000.0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 4, plan
