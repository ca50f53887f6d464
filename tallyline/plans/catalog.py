"""Registered queries: one per operator, each reading the test tables in full.

Parameters that depend on the clock are pinned so results repeat:
as_of = 2025-01-01, min_date = 2020-01-01, run_ts = 2025-01-01 00:00:00.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.operators import analytics as A
from tallyline.operators import records as R
from tallyline.operators import sketches as K
from tallyline.operators import validate as V
from tallyline.operators.clean import (
    CleanConfig,
    clean,
    dedupe_first,
    fill_defaults,
    normalize_countries,
    normalize_strings,
    parse_dates,
    parse_numerics,
    remove_empty_rows,
)
from tallyline.operators.enrich import (
    EnrichConfig,
    compute_aggregates,
    daily_summary,
    enrich,
    enrichment_stats,
    running_totals,
)
from tallyline.operators.table import KeyedSalesTable, latest_accepted, latest_order, load_gate, merge
from tallyline.operators.views import MaintainedView
from tallyline.plans import group_queries, time_queries
from tallyline.plans.batch_run import RunConfig, normalize_nulls, plan_run
from tallyline.session import keep, note, remove, work_path
from tallyline.sources.archive import archive_rows, archived_files
from tallyline.sources.tables import raw_sales, stored_sales

AS_OF = datetime(2025, 1, 1)
MIN_DATE = date(2020, 1, 1)
RUN_TS = datetime(2025, 1, 1)
DELETE_BEFORE = date(2022, 1, 1)
RUN_ONE_FILES = ["part-0", "part-1"]   # first run; the second run takes the rest

PINNED_CLEAN = CleanConfig(as_of=AS_OF, min_date=MIN_DATE)
PINNED_ENRICH = EnrichConfig(run_ts=RUN_TS)
PINNED_RUN = RunConfig(clean=PINNED_CLEAN, enrich=PINNED_ENRICH, run_id="pinned")

DATA = S.REQUIRED_COLUMNS


def _raw(spark, d):
    return raw_sales(spark, d)


def _clean(spark, d):
    return clean(_raw(spark, d), PINNED_CLEAN)


def _cleaned(spark, d):
    return _clean(spark, d).cleaned


def _enriched(spark, d, cfg: EnrichConfig = PINNED_ENRICH):
    return enrich(_cleaned(spark, d), cfg)


def _run(spark, d, files: list[str] | None = None, exclude: bool = False, materialize: bool = False, raw: DataFrame | None = None):
    raw = _raw(spark, d) if raw is None else raw
    if files is not None:
        sel = F.col(S.SOURCE_FILE).isin(files)
        raw = raw.where(~sel if exclude else sel)
    return plan_run(raw, PINNED_RUN, materialize=materialize)


def _sales(spark, d):
    return _run(spark, d).loaded()


def _drop_ord(df: DataFrame) -> DataFrame:
    return df.drop(S.ROW_ORDINAL)


def _orders_probe(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    return o.select(F.concat(F.lit("ORD-"), F.format_string("%06d", F.col("o_orderkey"))).alias("order_id"))


def q_null_tokens(spark, d):
    raw = normalize_nulls(_raw(spark, d))
    return raw.groupBy(S.SOURCE_FILE).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in DATA]
    )


def q_raw_file_verdict(spark, d):
    return V.file_verdict(normalize_nulls(_raw(spark, d)))


def q_raw_warnings(spark, d):
    return V.raw_warnings(_raw(spark, d))


def q_check_counts(spark, d):
    return V.rule_counts(_drop_ord(_enriched(spark, d)), "enriched")


def _faulty(spark, d):
    """Raw rows brought to the enriched types without cleaning, with faults placed
    by the keys, so that every rule meets rows that break it."""
    raw = normalize_nulls(_raw(spark, d)).select("*", f"{S.ROW_ORDINAL}.*")
    typed = V.coerce(raw.drop(S.ROW_ORDINAL), "cleaned").drop("_uncoerced")
    every = lambda key, n: (F.col(key) % n) == 0
    total = F.col("quantity") * F.col("unit_price")
    return typed.withColumns({
        "quantity": F.when(every("l_suppkey", 7), F.col("quantity") * 1000).otherwise(F.col("quantity")),
        "unit_price": F.when(every("l_partkey", 19), F.lit(None)).when(every("l_partkey", 7), F.col("unit_price") * 1000).otherwise(F.col("unit_price")),
        "product_name": F.when(every("l_partkey", 5), F.repeat("product_name", 60)).otherwise(F.col("product_name")),
    }).withColumns({
        "total_amount": F.when(every("l_suppkey", 11), F.lit(None)).when(every("l_suppkey", 13), total + 5).otherwise(total),
        "ingestion_timestamp": F.when(~every("l_suppkey", 3), F.lit(RUN_TS.isoformat()).cast("timestamp")),
    }).select(S.SOURCE_FILE, *DATA, "total_amount", "ingestion_timestamp")


def q_check_counts_faults(spark, d):
    return V.rule_counts(_faulty(spark, d), "enriched")


def q_schema_problems(spark, d):
    """Column checks of the stages on frames that lack or add columns, per file."""
    faulty = _faulty(spark, d)
    frames = [("raw", faulty.drop("country", "quantity")), ("cleaned", faulty), ("enriched", faulty.drop("total_amount"))]
    files = faulty.select(S.SOURCE_FILE).distinct()
    texts = F.array(*[F.concat(F.lit(f"{stage}:"), F.lit(x)) for stage, f in frames for x in V.schema_problems(f, stage)])
    return files.select(S.SOURCE_FILE, F.array_join(F.array_sort(texts), ";").alias("problems"))


def q_drop_empty_rows_faults(spark, d):
    """Rows with no value at all are dropped: here those of every third supplier are emptied first."""
    raw = normalize_nulls(_raw(spark, d))
    gone = (F.col(S.ROW_ORDINAL)["l_suppkey"] % 3) == 0
    emptied = raw.select(S.SOURCE_FILE, S.ROW_ORDINAL, *[F.when(~gone, F.col(c)).alias(c) for c in DATA])
    return remove_empty_rows(emptied).groupBy(S.SOURCE_FILE).agg(F.count("*").alias("rows_left"))


def q_check_unique(spark, d):
    raw = _raw(spark, d)
    r = [x for x in V.CLEANED_RULES if x.group][0]
    return V.rule_counts(raw.select(S.SOURCE_FILE, "order_id"), "cleaned").where(
        (F.col("column") == r.column) & (F.col("check") == r.check)
    )


def q_check_coerce(spark, d):
    return V.coerce_failures(normalize_nulls(_raw(spark, d)))


def q_quality_warnings(spark, d):
    c = _clean(spark, d)
    return V.quality_warnings(c.cleaned, c.stats())


def q_validation_report(spark, d):
    return _run(spark, d, materialize=True).reports()


def q_failure_cases(spark, d):
    return V.failure_cases(_enriched(spark, d), "enriched").drop("row_index")


def q_validation_summary(spark, d):
    return V.validation_summary(_run(spark, d, materialize=True).reports())


def q_clean_dedup(spark, d):
    return _drop_ord(dedupe_first(_raw(spark, d)))


def q_clean_dates(spark, d):
    return _drop_ord(parse_dates(_raw(spark, d), PINNED_CLEAN))


def q_clean_numerics(spark, d):
    return _drop_ord(parse_numerics(_raw(spark, d)))


def q_clean_fill(spark, d):
    return _drop_ord(fill_defaults(_raw(spark, d)))


def q_clean_strings(spark, d):
    return _drop_ord(normalize_strings(_raw(spark, d)))


def q_clean_countries(spark, d):
    return _drop_ord(normalize_countries(_raw(spark, d)))


def q_drop_empty_rows(spark, d):
    return _drop_ord(remove_empty_rows(normalize_nulls(_raw(spark, d))))


def q_clean_full(spark, d):
    return _drop_ord(_cleaned(spark, d))


def q_clean_stats(spark, d):
    return _clean(spark, d).stats()


def q_enrich_total(spark, d):
    return _drop_ord(_enriched(spark, d, EnrichConfig(True, False, False, False, RUN_TS)))


def q_enrich_full(spark, d):
    return _drop_ord(_enriched(spark, d))


def q_enrich_date_parts(spark, d):
    df = _drop_ord(_enriched(spark, d, EnrichConfig(False, False, True, False, RUN_TS)))
    return df.select(*[F.col(c).cast("long").alias(c) if c in ("order_year", "order_month", "order_day") else F.col(c)
                       for c in df.columns])


def q_enrich_category(spark, d):
    return _drop_ord(_enriched(spark, d, EnrichConfig(True, False, False, True, RUN_TS)))


def q_enrich_stats(spark, d):
    return enrichment_stats(_enriched(spark, d), PINNED_ENRICH)


def q_agg_by_country(spark, d):
    return compute_aggregates(_enriched(spark, d), "country")


def q_agg_by_product(spark, d):
    return compute_aggregates(_enriched(spark, d), "product_name")


def q_running_totals(spark, d):
    e = _enriched(spark, d).select(S.SOURCE_FILE, "order_id", "order_date", "total_amount")
    return running_totals(e)


def q_daily_summary(spark, d):
    return daily_summary(_enriched(spark, d))


def q_v_daily_sales(spark, d):
    return A.daily_sales(_sales(spark, d))


def q_v_product_performance(spark, d):
    return A.product_performance(_sales(spark, d))


def q_v_country_analysis(spark, d):
    return A.country_analysis(_sales(spark, d))


def q_summary_stats(spark, d):
    return A.summary_stats(_sales(spark, d))


def q_row_count(spark, d):
    return A.row_count(_sales(spark, d))


def q_date_range(spark, d):
    return A.date_range(_sales(spark, d))


def q_orders_exist(spark, d):
    return A.orders_exist(_sales(spark, d), _orders_probe(spark, d))


def q_dashboard_totals(spark, d):
    return A.dashboard_totals(_sales(spark, d))


def q_top_products(spark, d):
    return A.top_products(_sales(spark, d), 10)


def q_aov_by_country(spark, d):
    return A.aov_by_country(_sales(spark, d))


def q_daily_change(spark, d):
    return A.daily_change(_sales(spark, d))


def q_sample_sales(spark, d):
    return A.sample_rows(_sales(spark, d), 5)


def q_load_gate(spark, d):
    g = load_gate(_enriched(spark, d), RUN_TS)
    return g.select(S.SOURCE_FILE, "order_id", "quantity", "unit_price", "total_amount", "gate_reason")


def _table(spark) -> KeyedSalesTable:
    return KeyedSalesTable(spark, note(spark, work_path(spark, f"query-table-{uuid.uuid4().hex}")), buckets=8)


def _two_loads(spark, d):
    """The keyed table after two runs over different files, and the second load's figures."""
    table = _table(spark)
    table.upsert(_run(spark, d, RUN_ONE_FILES).enriched, run_ts=RUN_TS)
    return table, table.upsert(_run(spark, d, RUN_ONE_FILES, exclude=True).enriched, run_ts=RUN_TS)


def q_upsert(spark, d):
    return _two_loads(spark, d)[0].read()


def q_load_counts(spark, d):
    r = _two_loads(spark, d)[1]
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in (
        ("rows_inserted", r.rows_inserted), ("rows_updated", r.rows_updated), ("rows_failed", r.rows_failed),
        ("total_processed", r.total_processed))])


def q_load_rejects(spark, d):
    return _two_loads(spark, d)[1].rejects.select(S.SOURCE_FILE, "order_id", "gate_reason")


def q_delete_before(spark, d):
    table = _table(spark)
    table.upsert(_run(spark, d).enriched, run_ts=RUN_TS)
    deleted = table.delete_before(DELETE_BEFORE)
    return table.read().agg(F.lit(deleted).cast("long").alias("rows_deleted"), F.count("*").alias("rows_left"))


def q_run_enriched(spark, d):
    return _drop_ord(_run(spark, d).enriched)


def q_run_summary(spark, d):
    run = _run(spark, d, materialize=True)
    path = note(spark, work_path(spark, f"query-archive-{uuid.uuid4().hex}"))
    archive_rows(run.valid_raw, path, "pinned", RUN_TS.date())
    return run.summary(archived_files(spark, path))


def q_quarantine(spark, d):
    return _run(spark, d, materialize=True).quarantine()


def q_coerced(spark, d):
    """Raw text brought to the cleaned types; values that do not convert are named."""
    typed = V.coerce(normalize_nulls(_raw(spark, d)).drop(S.ROW_ORDINAL), "cleaned")
    return typed.withColumn("uncoerced", F.array_join("_uncoerced", ",")).drop("_uncoerced")


def q_file_report(spark, d):
    return _run(spark, d, materialize=True).file_report()


def q_sample_daily_sales(spark, d):
    return A.sample_rows(q_v_daily_sales(spark, d), 5, "order_date")


def q_sample_product_performance(spark, d):
    return A.sample_rows(q_v_product_performance(spark, d), 5, "product_name")


def q_sample_country_analysis(spark, d):
    return A.sample_rows(q_v_country_analysis(spark, d), 5, "country")


def _sketched(spark, d, by, column=None):
    """Sketches of every day and country are stored; the figures of `by` come from them and are held against exact ones.

    The joined input and the sales are written once: the verdict, the sketches and the exact figures would each shuffle them anew."""
    raw, raw_path = stored_sales(spark, d)
    sales, _ = keep(_run(spark, d, raw=raw).loaded().select("country", "order_date", "customer_id", "total_amount"), "sketch-sales")
    remove(spark, raw_path)
    sales = sales.withColumn(by, column) if column is not None else sales
    stored, _ = keep(K.day_sketches(sales, ["country"]), "day-sketches")
    rolled, _ = keep(K.estimates(K.merged(stored, [column.alias(by) if column is not None else by])), "sketch-estimates")
    return K.held_to_exact(sales, rolled, by).withColumnRenamed("n", "total_orders")


def q_sketch_countries(spark, d):
    return _sketched(spark, d, "country")


def q_sketch_months(spark, d):
    return _sketched(spark, d, "month", F.date_format("order_date", "yyyy-MM"))


def _after_loads(spark, d, key):
    """A view kept up to date over three loads (a file each) and a delete by date: only changed rows reach it."""
    view = MaintainedView(spark, note(spark, work_path(spark, f"query-view-{uuid.uuid4().hex}")), key, buckets=8)
    table, raw = None, raw_sales(spark, d, stored=True)
    for number, name in enumerate(VIEW_FILES):
        gated = _run(spark, d, [name], raw=raw).gated
        new, _ = keep(latest_accepted(gated, latest_order(gated)).select(*S.TABLE_COLUMNS), "view-load")
        if table is None:
            view.apply(new.limit(0), new, number)
            table = new
            continue
        view.apply(table.join(new.select("order_id"), "order_id", "left_semi"), new, number)
        table, _ = keep(merge(table, new), "view-table")
    gone = table.where(F.col("order_date") < F.lit(DELETE_BEFORE))
    view.apply(gone, table.limit(0), len(VIEW_FILES))
    return view.read()


VIEW_FILES = ["part-0", "part-1", "part-2"]      # part-3 is refused as a whole


def q_view_country_after_loads(spark, d):
    return _after_loads(spark, d, "country")


def q_view_product_after_loads(spark, d):
    return _after_loads(spark, d, "product_name")


def q_result_records(spark, d):
    """The rule counts of each file handed over as one JSON record, read back and summed by check."""
    counts = V.rule_counts(_faulty(spark, d), "enriched")
    checks = F.collect_list(F.struct("column", "check", "failures"))             # one per rule
    records = R.to_records(counts.groupBy(S.SOURCE_FILE).agg(checks.alias("checks"), F.sum("failures").alias("error_count")))
    kind = "array<struct<column:string,check:string,failures:bigint>>"
    read = R.good(R.parse_records(records, {"file": ("$.source_file", "string"), "checks": ("$.checks", kind)}, ("file",)))
    by_check = R.counts_by_name(F.col("checks"), "check", "failures")
    errors = F.col(R.UNKNOWN)["error_count"].cast("long")                          # a field that the reader did not ask for
    return read.select(F.col("file").alias(S.SOURCE_FILE), errors.alias("file_errors"), F.explode(by_check).alias("check", "failures"))


def _event_records(spark, d):
    """Events as JSON texts of several ages: some cut off, some arrays, some with fields more or fewer, some with other types."""
    e = spark.read.parquet(f"{d}/events.parquet")
    i = F.col("event_id")
    number = F.when(i % 13 == 0, F.lit("")).otherwise(F.concat(F.lit('"id":'), i.cast("string"), F.lit(",")))
    props = F.when(i % 19 == 0, F.lit('"none"')).otherwise(F.col("props"))
    shard = F.when(i % 7 == 0, F.concat(F.lit(',"shard":'), (i % 5).cast("string"))).otherwise(F.lit(""))
    whole = F.concat(F.lit("{"), number, F.lit('"type":"'), F.col("event_type"), F.lit('","props":'), props, shard, F.lit("}"))
    text = F.when(i % 17 == 0, F.concat(F.lit("["), whole, F.lit("]"))).when(i % 11 == 0, F.expr("substring(whole, 1, length(whole) - 1)")).otherwise(F.col("whole"))
    fields = {"id": ("$.id", "bigint"), "type": ("$.type", "string"), "k": ("$.props.k", "int")}
    return R.parse_records(e.withColumn("whole", whole).select("event_id", text.alias("record")), fields, ("id",))


def q_event_records(spark, d):
    return R.good(_event_records(spark, d)).select("id", "type", "k", F.col(R.UNKNOWN)["shard"].alias("shard"), F.size(R.UNKNOWN).alias("n_unknown"))


def q_event_record_rejects(spark, d):
    return R.rejects(_event_records(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "null_tokens": q_null_tokens,
    "raw_file_verdict": q_raw_file_verdict,
    "raw_warnings": q_raw_warnings,
    "check_counts": q_check_counts,
    "check_counts_faults": q_check_counts_faults,
    "schema_problems": q_schema_problems,
    "drop_empty_rows_faults": q_drop_empty_rows_faults,
    "check_unique": q_check_unique,
    "check_coerce": q_check_coerce,
    "quality_warnings": q_quality_warnings,
    "validation_report": q_validation_report,
    "failure_cases": q_failure_cases,
    "validation_summary": q_validation_summary,
    "clean_dedup": q_clean_dedup,
    "clean_dates": q_clean_dates,
    "clean_numerics": q_clean_numerics,
    "clean_fill": q_clean_fill,
    "clean_strings": q_clean_strings,
    "clean_countries": q_clean_countries,
    "drop_empty_rows": q_drop_empty_rows,
    "clean_full": q_clean_full,
    "clean_stats": q_clean_stats,
    "enrich_total": q_enrich_total,
    "enrich_full": q_enrich_full,
    "enrich_date_parts": q_enrich_date_parts,
    "enrich_category": q_enrich_category,
    "enrich_stats": q_enrich_stats,
    "agg_by_country": q_agg_by_country,
    "agg_by_product": q_agg_by_product,
    "running_totals": q_running_totals,
    "daily_summary": q_daily_summary,
    "v_daily_sales": q_v_daily_sales,
    "v_product_performance": q_v_product_performance,
    "v_country_analysis": q_v_country_analysis,
    "summary_stats": q_summary_stats,
    "row_count": q_row_count,
    "date_range": q_date_range,
    "orders_exist": q_orders_exist,
    "dashboard_totals": q_dashboard_totals,
    "top_products": q_top_products,
    "aov_by_country": q_aov_by_country,
    "daily_change": q_daily_change,
    "sample_sales": q_sample_sales,
    "sample_daily_sales": q_sample_daily_sales,
    "sample_product_performance": q_sample_product_performance,
    "sample_country_analysis": q_sample_country_analysis,
    "load_gate": q_load_gate,
    "upsert": q_upsert,
    "load_counts": q_load_counts,
    "load_rejects": q_load_rejects,
    "delete_before": q_delete_before,
    "run_enriched": q_run_enriched,
    "run_summary": q_run_summary,
    "file_report": q_file_report,
    "quarantine": q_quarantine,
    "coerced": q_coerced,
    "sketch_countries": q_sketch_countries,
    "sketch_months": q_sketch_months,
    "view_country_after_loads": q_view_country_after_loads,
    "view_product_after_loads": q_view_product_after_loads,
    "result_records": q_result_records,
    "event_records": q_event_records,
    "event_record_rejects": q_event_record_rejects,
}

QUERIES |= time_queries.QUERIES
QUERIES |= {name: (lambda spark, d, fn=fn: fn(_sales(spark, d))) for name, fn in group_queries.ON_SALES.items()}
QUERIES |= {name: (lambda spark, d, fn=fn: fn(_raw(spark, d))) for name, fn in group_queries.ON_RAW.items()}
