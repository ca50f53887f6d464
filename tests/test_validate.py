from datetime import datetime

from pyspark.sql import functions as F

from sales_rows import raw_frame
from tallyline.operators import validate as V
from tallyline.operators.clean import CleanConfig, clean
from tallyline.operators.enrich import EnrichConfig, enrich

CFG = CleanConfig(as_of=datetime(2025, 1, 1))


def _counts(df, stage):
    return {(r.column, r.check): r.failures for r in V.rule_counts(df, stage).collect()}


def test_cleaned_rules_pass_on_clean_data(sample_raw):
    c = clean(sample_raw, CFG).cleaned.drop("row_ordinal")
    assert all(v == 0 for v in _counts(c, "cleaned").values())
    ok, df, msg = V.validate_dataframe(c.drop("source_file"), "cleaned")
    assert ok and msg is None


def test_pattern_and_range_failures(spark):
    df = spark.createDataFrame(
        [("BAD-1", "A", 0, 1.0, "2024-01-01", "BAD", "Mars"), ("ORD-000001", "A", 1, 1.0, "2024-01-01", "UNKNOWN", "Canada")],
        "order_id string, product_name string, quantity int, unit_price double, order_date string, customer_id string, country string",
    ).withColumn("order_date", F.to_date("order_date"))
    c = _counts(df, "cleaned")
    assert c[("order_id", "str_matches")] == 1
    assert c[("customer_id", "str_matches")] == 1
    assert c[("quantity", "ge")] == 1
    assert c[("country", "isin")] == 1
    ok, _, msg = V.validate_dataframe(df, "cleaned")
    assert not ok and "str_matches" in msg
    ok2, _, msg2 = V.validate_dataframe(df, "cleaned", lazy=False)
    assert not ok2 and msg2


def test_unique_marks_every_member(spark):
    df = spark.createDataFrame([("f", "A"), ("f", "A"), ("f", "B"), ("g", "A")], "source_file string, order_id string")
    got = {(r.source_file, r.check): r.failures for r in V.rule_counts(df, "cleaned").collect()}
    assert got[("f", "unique")] == 2 and got[("g", "unique")] == 0


def test_missing_and_extra_columns(spark):
    df = spark.createDataFrame([("ORD-000001",)], "order_id string")
    assert "missing_column:product_name" in V.schema_problems(df, "raw")
    extra = spark.createDataFrame([("x",) * 8], ", ".join(f"{c} string" for c in
                                  ["order_id", "product_name", "quantity", "unit_price", "order_date", "customer_id", "country", "junk"]))
    assert V.schema_problems(extra, "raw") == []
    assert V.schema_problems(extra, "cleaned") == ["extra_column:junk"]


def test_file_verdict_rejects_whole_file(spark):
    a = raw_frame(spark, [("ORD-000001", "A", "1", "1", "2024-01-01", "C", "Canada")], "a.csv")
    b = raw_frame(spark, [(None, "A", "1", "1", "2024-01-01", "C", "Canada"),
                          ("ORD-000002", "A", "1", "1", "2024-01-01", "C", "Canada")], "b.csv")
    v = {r.source_file: r.is_valid for r in V.file_verdict(a.unionByName(b)).collect()}
    assert v == {"a.csv": True, "b.csv": False}


def test_raw_warnings(sample_raw_errors):
    r = V.raw_warnings(sample_raw_errors).first()
    assert r.non_numeric_quantity == 1 and r.empty_order_ids == 0


def test_numeric_file_has_no_text_warning(spark):
    df = raw_frame(spark, [("ORD-000001", "A", "1e3", "1", "2024-01-01", "C", "Canada"),
                           ("ORD-000002", "A", "-2", "1", "2024-01-01", "C", "Canada")])
    assert V.raw_warnings(df).first().non_numeric_quantity == 0


def test_quality_warnings_and_report(sample_raw_errors):
    out = clean(sample_raw_errors, CFG)
    q = V.quality_warnings(out.cleaned, out.stats()).first()
    assert q.warn_data_loss and abs(q.data_loss_ratio - 0.8) < 1e-9
    e = enrich(out.cleaned, EnrichConfig(run_ts=datetime(2025, 1, 1))).drop("row_ordinal")
    rep = V.stage_report(e, "enriched").first()
    assert rep.status == "passed" and rep.valid_rows == 1


def test_failure_cases_and_summary(spark):
    df = spark.createDataFrame([("BAD-1", "x" * 300)], "order_id string, product_name string")
    cases = V.failure_cases(df, "cleaned").collect()
    checks = sorted((c.column, c.check) for c in cases)
    assert checks == [("order_id", "str_matches"), ("product_name", "str_length")]
    assert {len(c.failure_case) for c in cases} == {5, 100}          # values are cut as reports show them, unless whole ones are asked for
    assert {len(c.failure_case) for c in V.failure_cases(df, "cleaned", None).collect()} == {5, 300}
    rep = V.stage_report(df, "cleaned")
    s = V.validation_summary(rep).first()
    assert s.total_validations == 1 and s.failed == 1 and s.total_errors > 0
    empty = V.validation_summary(rep.limit(0)).first()
    assert empty.total_validations == 0


def test_on_fail_modes(spark, sample_raw_errors):
    import pytest

    from tallyline.plans.batch_run import RunConfig, plan_run

    bad = raw_frame(spark, [("BAD-1", "A", "1", "1", "2024-01-01", "CUST-20417", "Canada"),
                            ("ORD-000002", "A", "1", "1", "2024-01-01", "CUST-20417", "Canada")])
    warn = plan_run(bad, RunConfig(clean=CFG))
    assert warn.cleaned.count() == 2
    drop = plan_run(bad, RunConfig(clean=CFG, on_fail="drop"))
    assert [r.order_id for r in drop.cleaned.collect()] == ["ORD-000002"]
    with pytest.raises(ValueError, match="str_matches"):
        plan_run(bad, RunConfig(clean=CFG, on_fail="fail"))


def test_validate_coerces_and_never_raises(spark, sample_raw):
    text = sample_raw.drop("source_file", "row_ordinal")
    ok, typed, msg = V.validate_dataframe(text, "cleaned")
    assert ok and dict(typed.dtypes)["quantity"] == "int" and dict(typed.dtypes)["order_date"] == "timestamp"
    for value, fine in (("abc", False), ("1.0", True), ("1.5", False)):
        ok, typed, msg = V.validate_dataframe(text.withColumn("quantity", F.lit(value)), "cleaned")
        assert ok == fine and (fine or "quantity/coerce: 5" in msg)
        assert V.validate_dataframe(text.withColumn("quantity", F.lit(value)), "cleaned", lazy=False)[0] == fine
