import os
import tempfile
from datetime import date, datetime

from tallyline.operators.clean import CleanConfig
from tallyline.operators.enrich import EnrichConfig
from tallyline.operators.table import KeyedSalesTable
from tallyline.plans.batch_run import RunConfig, RunPaths, plan_run, run_batch
from tallyline.sources.archive import archived_files
from tallyline.sources.csv_files import read_sales_csv
from tallyline.sources.generator import synthetic_sales
from tallyline.streaming.incremental import run_incremental

CFG = RunConfig(clean=CleanConfig(as_of=datetime(2025, 1, 1)), enrich=EnrichConfig(run_ts=datetime(2025, 1, 1)))


def _file(spark, folder, name, seed):
    rows = synthetic_sales(spark, 40, 0.1, seed=seed, anchor=date(2024, 6, 1)).drop("id").toPandas()
    rows.to_csv(os.path.join(folder, name), index=False)


def _folders():
    base = tempfile.mkdtemp(prefix="tl-stream-")
    os.makedirs(base + "/in")
    return base + "/in", base + "/ckpt", RunPaths(base + "/table", base + "/archive", base + "/quarantine", base + "/reports")


def _outputs(spark, paths):
    return {name: sorted(map(str, spark.read.parquet(p).drop("duration_seconds").collect())) for name, p in (
        ("archive", paths.archive), ("quarantine", paths.quarantine), ("stages", paths.reports + "/stages"),
        ("files", paths.reports + "/files"), ("runs", paths.reports + "/runs"))} | {
        "table": sorted(map(str, KeyedSalesTable(spark, paths.table).read().collect()))}


def test_two_incremental_runs_equal_one_batch(spark):
    inc, ckpt, paths = _folders()
    _file(spark, inc, "f 1.csv", 1)
    assert run_incremental(spark, inc, ckpt, paths, CFG, buckets=4) == 1
    assert run_incremental(spark, inc, ckpt, paths, CFG, buckets=4) == 0      # nothing new: no batch
    _file(spark, inc, "f[2].csv", 2)
    assert run_incremental(spark, inc, ckpt, paths, CFG, buckets=4) == 1
    streamed = sorted(map(tuple, KeyedSalesTable(spark, paths.table).read().collect()))
    rows, headers = read_sales_csv(spark, inc)
    batch = sorted(map(tuple, plan_run(rows, CFG, headers).loaded().collect()))
    assert streamed == batch and len(batch) > 0
    runs = spark.read.parquet(paths.reports + "/runs").collect()
    assert sorted(r.run_id for r in runs) == ["manual-0", "manual-1"] and all(r.files_archived == 1 for r in runs)


def test_a_run_twice_changes_nothing(spark):
    inc, _, paths = _folders()
    _file(spark, inc, "a.csv", 3)
    with open(inc + "/bad.csv", "w") as f:
        f.write("order_id,quantity\nORD-1,2\n")
    first = run_batch(spark, inc, paths, CFG, buckets=4)
    seen = _outputs(spark, paths)
    again = run_batch(spark, inc, paths, CFG, buckets=4)
    after = _outputs(spark, paths)
    assert first.rows_inserted > 0 and again.rows_inserted == 0 and again.rows_updated == first.rows_inserted
    assert {k: v for k, v in after.items() if k != "runs"} == {k: v for k, v in seen.items() if k != "runs"}
    run = spark.read.parquet(paths.reports + "/runs").first()
    assert (run.files_detected, run.files_valid, run.files_invalid, run.files_archived) == (2, 1, 1, 1)
    kept = spark.read.parquet(paths.quarantine).where("stage = 'file'").collect()
    assert [(os.path.basename(r.source_file), r.order_id) for r in kept] == [("bad.csv", "ORD-1")]
    assert [os.path.basename(r.source_file) for r in archived_files(spark, paths.archive).collect()] == ["a.csv"]


def test_stream_reads_columns_by_header_name(spark):
    inc, ckpt, paths = _folders()
    with open(os.path.join(inc, "swapped.csv"), "w") as f:
        f.write("country,customer_id,order_date,unit_price,quantity,product_name,order_id\n"
                "Canada,CUST-20417,2024-03-01,10.50,2,Mouse,ORD-000042\n")
    assert run_incremental(spark, inc, ckpt, paths, CFG, buckets=4) == 1
    r = KeyedSalesTable(spark, paths.table).read().first()
    assert (r.order_id, r.country, r.quantity, float(r.total_amount)) == ("ORD-000042", "Canada", 2, 21.0)
