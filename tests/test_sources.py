import os
import tempfile
from datetime import date

from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.plans.batch_run import RunConfig, plan_run
from tallyline.operators.clean import CleanConfig
from tallyline.sources.csv_files import file_exists, list_csv_files, read_sales_csv, write_csv
from tallyline.sources.generator import synthetic_sales

HEADER = ",".join(S.REQUIRED_COLUMNS) + "\n"


def _write(folder, name, text):
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_scan_headers_and_verdict(spark):
    d = tempfile.mkdtemp(prefix="tl-csv-")
    _write(d, "a.csv", HEADER + 'ORD-001001,"Laptop, Pro",2,999.99,2024-01-15,CUST-20417,United States\n'
                              "ORD-001002,Mouse,5,29.99,2024-01-16,CUST-31855,Canada\n")
    # Other column order, still valid.
    _write(d, "b.csv", "country,order_id,product_name,quantity,unit_price,order_date,customer_id\n"
                       "Canada,ORD-001003,Hub,3,49.99,2024-01-17,CUST-40266\n")
    _write(d, "c.csv", "order_id,product_name\nORD-001004,Keyboard\n")        # missing columns
    _write(d, "d.csv", HEADER + "ORD-001005,Monitor,2,349.99,2024-01-19,CUST-68102,France,EXTRA\n")  # too many fields
    _write(d, "notes.txt", "not a csv")
    inv = list_csv_files(spark, d).collect()
    assert sorted(r.name for r in inv) == ["a.csv", "b.csv", "c.csv", "d.csv"]
    assert all(r.is_csv and r.size > 0 for r in inv)
    assert file_exists(spark, d, "a.csv") and not file_exists(spark, d, "zzz.csv")
    rows, headers = read_sales_csv(spark, d)
    got = {r.order_id: r for r in rows.collect()}
    assert got["ORD-001001"].product_name == "Laptop, Pro"
    assert got["ORD-001003"].country == "Canada"
    run = plan_run(rows, RunConfig(clean=CleanConfig()), headers)
    v = {os.path.basename(r.source_file): (r.is_valid, r.missing_columns) for r in run.verdict.collect()}
    assert v["a.csv"] == (True, "") and v["b.csv"] == (True, "")
    assert v["c.csv"][0] is False and "country" in v["c.csv"][1]
    assert v["d.csv"][0] is False
    loaded = sorted(r.order_id for r in run.loaded().collect())
    assert loaded == ["ORD-001001", "ORD-001002", "ORD-001003"]


def test_csv_export_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tl-out-")
    df = spark.createDataFrame([("ORD-1", 'say "hi", ok')], "order_id string, product_name string")
    write_csv(df, d + "/out")
    back = spark.read.option("header", True).option("escape", '"').csv(d + "/out").collect()
    assert back[0].product_name == 'say "hi", ok'


def test_generator_repeats_and_counts(spark):
    a = synthetic_sales(spark, 200, 0.1, seed=1, anchor=date(2024, 6, 1), partitions=1)
    b = synthetic_sales(spark, 200, 0.1, seed=1, anchor=date(2024, 6, 1), partitions=7)
    assert a.count() == 200 + int(200 * 0.1 * 0.5)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    clean_rows = synthetic_sales(spark, 50, 0.0, seed=1)
    assert clean_rows.count() == 50
    assert clean_rows.where(F.col("order_id").rlike(r"^ORD-\d{6}$")).count() == 50


def test_raw_archive_by_date(spark):
    from sales_rows import raw_frame
    from tallyline.sources.archive import archive_key, archive_rows, archived_files

    d = tempfile.mkdtemp(prefix="tl-arch-") + "/archive"
    rows = raw_frame(spark, [("ORD-000001", "A", "1", "1", "2024-01-01", "C", "Canada"),
                             ("ORD-000002", "B", "1", "1", "2024-01-01", "C", "Canada")], "a.csv")
    archive_rows(rows, d, "r1", date(2024, 6, 1))
    archive_rows(rows, d, "r1", date(2024, 6, 1))     # the same run again
    archive_rows(rows.limit(1).withColumn("source_file", F.lit("b.csv")), d, "r2", date(2024, 6, 2))
    got = sorted((r.source_file, str(r.archive_date), r.rows) for r in archived_files(spark, d).collect())
    assert got == [("a.csv", "2024-06-01", 2), ("b.csv", "2024-06-02", 1)]
    assert archive_key("a.csv", date(2024, 6, 1)) == "2024/06/01/a.csv"


def test_odd_files_are_judged_one_by_one(spark):
    """Names with spaces and brackets, many headers, empty files, twin names and open quotes: no file stops another."""
    d = tempfile.mkdtemp(prefix="tl-odd-")
    row = "ORD-{:06d},Lamp,1,10,2024-01-15,CUST-20417,Canada"
    _write(d, "a b.csv", HEADER + row.format(1) + "\n")
    _write(d, "sales[1].csv", HEADER + row.format(2) + "\n")
    _write(d, "only header.csv", HEADER)
    _write(d, "no order id.csv", "product_name,quantity\n")
    _write(d, "blank.csv", "\n")
    _write(d, "twin.csv", "order_id," + HEADER.strip() + "\nORD-000003," + row.format(4) + "\n")
    _write(d, "spelt.csv", HEADER.replace("order_id", "Order ID") + row.format(5) + "\n")
    _write(d, "open.csv", HEADER + 'ORD-000006,"two\nlines",1,10,2024-01-15,CUST-20417,Canada\n')
    for k in range(200):
        names = S.REQUIRED_COLUMNS + [f"more_{i}" for i in range(k)]
        _write(d, f"wide-{k}.csv", ",".join(names) + "\n" + row.format(1000 + k) + "," * k + "\n")
    rows, headers = read_sales_csv(spark, d)
    run = plan_run(rows, RunConfig(), headers, materialize=True)
    v = {os.path.basename(r.source_file).replace("%20", " "): r for r in run.verdict.collect()}
    assert len(v) == 208
    ok = {n for n, r in v.items() if r.is_valid}
    assert {"a b.csv", "only header.csv", "twin.csv"} <= ok and sum(n.startswith("wide") for n in ok) == 200
    assert any("sales" in n and r.is_valid for n, r in v.items())
    assert v["blank.csv"].missing_columns.count(",") == 6 and not v["spelt.csv"].is_valid and v["open.csv"].malformed_rows >= 1
    loaded = {r.order_id for r in run.loaded().select("order_id").collect()}
    assert loaded == {"ORD-000001", "ORD-000002", "ORD-000003"} | {f"ORD-{1000 + k:06d}" for k in range(200)}
    rep = {(os.path.basename(r.source_file).replace("%20", " "), r.stage): r for r in run.reports().collect()}
    assert rep["a b.csv", "cleaned"].is_valid and rep["a b.csv", "enriched"].is_valid and rep["a b.csv", "raw"].status == "passed"
    missing = rep["no order id.csv", "raw"]
    assert (missing.error_count, missing.warning_count, missing.status) == (1, 0, "failed")
    s = run.summary().first()
    assert (s.files_detected, s.files_valid, s.files_archived) == (208, 204, 0)
    multi, h = read_sales_csv(spark, d, multi_line=True)
    assert plan_run(multi, RunConfig(), h).verdict.where("source_file like '%open.csv'").first().is_valid


def test_date_formats_are_a_setting(spark):
    from sales_rows import raw_frame

    rows = raw_frame(spark, [(f"ORD-{k:06d}", "Lamp", "1", "10", when, "CUST-20417", "Canada")
                             for k, when in enumerate(["01/15/2024", "2024/01/16", "2024-01-17"])])
    assert plan_run(rows, RunConfig(clean=CleanConfig())).loaded().count() == 1
    wide = CleanConfig(date_formats=("M/d/yyyy", "yyyy/M/d", "yyyy-M-d"))
    got = plan_run(rows, RunConfig(clean=wide)).loaded().select("order_date").collect()
    assert sorted(str(r.order_date) for r in got) == ["2024-01-15", "2024-01-16", "2024-01-17"]


def test_a_file_that_loses_all_rows_has_reports(spark):
    from sales_rows import raw_frame

    rows = raw_frame(spark, [(f"ORD-{k:06d}", "Lamp", "-1", "10", "2024-01-15", "CUST-20417", "Canada") for k in range(5)])
    run = plan_run(rows, RunConfig(), materialize=True)
    rep = {r.stage: r for r in run.reports().collect()}
    assert rep["cleaned"].total_rows == 0 and rep["cleaned"].warning_count == 1 and rep["cleaned"].status == "skipped"
    assert run.quarantine().count() == 5


def test_the_archive_goes_on_after_a_bad_file(spark):
    from tallyline.sources.archive import archive_paths

    d = tempfile.mkdtemp(prefix="tl-arch-")
    names = [f"f{i}.csv" for i in range(9)]
    for i, n in enumerate(names):
        _write(d, n, HEADER + f"ORD-{i:06d},A,2,9.99,2024-01-15,CUST-20417,Canada\n")
    bad = {names[2], names[7]}

    def read(paths):
        if bad & {os.path.basename(p) for p in paths}:
            raise OSError("cannot read")
        return read_sales_csv(spark, paths)[0]

    paths = [os.path.join(d, n) for n in names]
    for _ in range(2):                                    # a repeated run archives once
        done, errors = archive_paths(read, paths, d + "/archive", "r1", date(2025, 1, 1))
        assert [os.path.basename(p) for p in done] == [n for n in names if n not in bad]
        assert {os.path.basename(p): e for p, e in errors.items()} == dict.fromkeys(bad, "cannot read")
        kept = spark.read.parquet(d + "/archive").select("source_file", "order_id").collect()
        assert len(kept) == 7 and len({r.order_id for r in kept}) == 7
    assert archive_paths(read, [], d + "/archive", "r2") == ([], {})


def test_a_run_without_files_stops_at_once(spark):
    from tallyline.plans.batch_run import RunPaths, run_batch

    d = tempfile.mkdtemp(prefix="tl-empty-")
    base = d + "/out"
    r = run_batch(spark, d, RunPaths(base + "/table", base + "/archive", base + "/quarantine", base + "/reports"))
    assert (r.success, r.total_processed, r.rows_failed) == (True, 0, 0) and not os.path.exists(base)


def test_stored_raw_rows_equal_the_derived_ones_and_join_nothing(spark, tmp_path):
    from tallyline.sources.tables import raw_sales

    day = "timestamp '1996-02-29 00:00:00'"
    made = {"lineitem": "id % 7 l_orderkey, id l_linenumber, id % 5 l_partkey, id % 9 l_suppkey, double(id) l_quantity, id + 0.25D l_extendedprice",
            "orders": f"if(id = 3, null, id) o_orderkey, id % 3 o_custkey, if(id = 4, null, {day}) o_orderdate",
            "customer": "id % 4 c_custkey, if(id = 1, null, int(id * 3)) c_nationkey",
            "part": "id p_partkey, if(id = 2, null, 'large ring') p_name, if(id = 1, null, 9.5D + id) p_retailprice"}
    for name, columns in made.items():
        spark.sql(f"SELECT {columns} FROM range({60 if name == 'lineitem' else 7})").write.parquet(f"{tmp_path}/{name}.parquet")
    derived, stored = raw_sales(spark, str(tmp_path)), raw_sales(spark, str(tmp_path), stored=True)
    assert derived.dtypes == stored.dtypes and derived.count() > 0
    assert derived.exceptAll(stored).isEmpty() and stored.exceptAll(derived).isEmpty()
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
