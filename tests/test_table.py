import re
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyline.operators.table import KeyedSalesTable, load_gate

RUN_TS = datetime(2025, 1, 1)
COLS = ("source_file string, order_id string, product_name string, quantity int, unit_price double, "
        "order_date date, customer_id string, country string, total_amount double")


def _rows(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, " + COLS)
    return df.withColumn("row_ordinal", F.struct("pos")).drop("pos")


def _order(k, version="A", file="a", total=10.0):
    return (file, f"ORD-{k:06d}", version, 1, 10.0, date(2024, 1, 1), "C", "Canada", total)


def _table(spark, **kw):
    return KeyedSalesTable(spark, tempfile.mkdtemp(prefix="tl-table-") + "/sales", **kw)


def _state(t):
    return sorted((r.order_id, r.product_name) for r in t.read().collect())


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_stop_before_the_switch_loses_nothing(spark, monkeypatch, step):
    t = _table(spark, buckets=4)
    t.upsert(_rows(spark, [_order(k) for k in range(20)]), run_ts=RUN_TS)
    before = _state(t)
    real = getattr(KeyedSalesTable, step)

    def stop(self, *a, **kw):
        if step == "_write":
            real(self, *a, **kw)          # the new folder is on disk, the table is still the old one
        raise KeyboardInterrupt

    more = _rows(spark, [_order(k, "B") for k in range(10, 30)])
    monkeypatch.setattr(KeyedSalesTable, step, stop)
    with pytest.raises(KeyboardInterrupt):
        t.upsert(more, run_ts=RUN_TS)
    assert _state(KeyedSalesTable(spark, t.path)) == before
    monkeypatch.setattr(KeyedSalesTable, step, real)
    r = KeyedSalesTable(spark, t.path).upsert(more, run_ts=RUN_TS)     # the replay
    assert (r.rows_inserted, r.rows_updated) == (10, 10)
    assert _state(t) == [(f"ORD-{k:06d}", "A" if k < 10 else "B") for k in range(30)]


@pytest.mark.parametrize("rows_per_file", [5_000_000, 20])
def test_each_slice_of_a_bucket_is_written_by_a_task_of_its_own(spark, rows_per_file):
    t = _table(spark, buckets=8, rows_per_file=rows_per_file)
    t.upsert(_rows(spark, [_order(k) for k in range(400)]), run_ts=RUN_TS)
    slices = 1 if rows_per_file > 400 else 3
    files = [f.rsplit("/", 1)[1] for f in t.read().inputFiles()]
    assert len(files) == 8 * slices and len({re.match(r"part-(\d+)", f)[1] for f in files}) == 8 * slices
    assert t.read().count() == 400 and all(t.has_order(f"ORD-{k:06d}") for k in (0, 199, 399))


def test_bucket_count_is_the_stored_one(spark):
    t = _table(spark, buckets=8)
    t.upsert(_rows(spark, [_order(k) for k in range(20)]), run_ts=RUN_TS)
    for buckets in (4, 16):
        again = KeyedSalesTable(spark, t.path, buckets=buckets)
        assert again.buckets == 8 and all(again.has_order(f"ORD-{k:06d}") for k in (0, 7, 19))
        again.upsert(_rows(spark, [_order(k, "B") for k in range(20)]), run_ts=RUN_TS)
        assert again.read().count() == 20
    probe = spark.createDataFrame([("ORD-000003",), ("ORD-000099",)], "order_id string")
    assert sorted(map(tuple, t.has_orders(probe).collect())) == [("ORD-000003", True), ("ORD-000099", False)]


def test_last_row_of_the_last_file_wins_and_ties_need_an_order(spark):
    t = _table(spark, buckets=2)
    rows = _rows(spark, [_order(1, f"v{k}") for k in range(8)])
    t.upsert(rows, run_ts=RUN_TS)
    assert _state(t) == [("ORD-000001", "v7")]
    with pytest.raises(ValueError):
        t.upsert(rows.drop("row_ordinal"), run_ts=RUN_TS)
    assert _state(t) == [("ORD-000001", "v7")]


def test_every_refused_row_is_returned(spark):
    t = _table(spark, buckets=2)
    r = t.upsert(_rows(spark, [_order(k, total=11.0) for k in range(150)] + [_order(500)]), run_ts=RUN_TS)
    assert r.rows_failed == 150 and r.failed_order_ids().distinct().count() == 150 and not r.success
    assert _state(t) == [("ORD-000500", "A")]


def test_two_writers_of_one_version(spark):
    t = _table(spark, buckets=2)
    t.upsert(_rows(spark, [_order(1)]), run_ts=RUN_TS)
    seen = t.current()
    t.upsert(_rows(spark, [_order(2)]), run_ts=RUN_TS)
    with pytest.raises(RuntimeError):
        t._commit(seen, "load-x")
    assert len(_state(t)) == 2


def test_the_table_before_a_load_stays_readable_and_older_ones_go(spark):
    import os

    t = _table(spark, buckets=2)
    for k in range(3):
        reader = t.read() if k else None
        t.upsert(_rows(spark, [_order(k)]), run_ts=RUN_TS)
        assert reader is None or reader.count() == k
    folders = [x for x in os.listdir(t.path) if x.startswith("load-")]
    assert len(folders) == 2 and len(_state(t)) == 3


def test_a_load_is_one_join_and_a_lookup_reads_one_bucket(spark):
    t = _table(spark, buckets=8)
    r = t.upsert(_rows(spark, [_order(k) for k in range(50)]), run_ts=RUN_TS)
    assert r.rows_per_second > 0
    rows = t.read(with_bucket=True).where("key_bucket = 3")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and "(key_bucket" in plan.split("PartitionFilters")[1]


def test_gate_exact_total_after_price_rounding(spark):
    df = _rows(spark, [
        ("f", "ORD-000001", "A", 3, 33.333, date(2024, 1, 1), "C", "Canada", 100.0),
        ("f", "ORD-000002", "A", 1, 33.333, date(2024, 1, 1), "C", "Canada", 33.33),
        ("f", "ORD-000003", "A", 0, 10.0, date(2024, 1, 1), "C", "Canada", 0.0),
        ("f", None, "A", 1, 10.0, date(2024, 1, 1), "C", "Canada", 10.0),
    ])
    got = {r.order_id: r.gate_reason for r in load_gate(df, RUN_TS).collect()}
    assert got == {"ORD-000001": "total_mismatch", "ORD-000002": None,
                   "ORD-000003": "quantity_not_positive", None: "not_null:order_id"}


def test_upsert_insert_update_idempotent_and_delete(spark):
    path = tempfile.mkdtemp(prefix="tl-table-") + "/sales"
    t = KeyedSalesTable(spark, path, buckets=8)
    first = _rows(spark, [
        ("a", "ORD-000001", "A", 1, 10.0, date(2021, 1, 1), "C", "Canada", 10.0),
        ("a", "ORD-000002", "B", 2, 10.0, date(2023, 1, 1), "C", "Canada", 20.0),
    ])
    r1 = t.upsert(first, run_ts=RUN_TS)
    assert (r1.rows_inserted, r1.rows_updated, r1.rows_failed) == (2, 0, 0)
    second = _rows(spark, [
        ("b", "ORD-000002", "B2", 3, 10.0, date(2023, 1, 1), "C", "Canada", 30.0),
        ("c", "ORD-000002", "B3", 4, 10.0, date(2023, 1, 1), "C", "Canada", 40.0),   # later file wins
        ("b", "ORD-000003", "C", 1, 10.0, date(2024, 1, 1), "C", "Canada", 999.0),  # gate reject
    ])
    r2 = t.upsert(second, run_ts=RUN_TS)
    assert (r2.rows_inserted, r2.rows_updated, r2.rows_failed) == (0, 1, 1)
    assert [r.order_id for r in r2.failed_order_ids().collect()] == ["ORD-000003"]
    snap = sorted((r.order_id, r.product_name, r.quantity) for r in t.read().collect())
    assert snap == [("ORD-000001", "A", 1), ("ORD-000002", "B3", 4)]
    t.upsert(second, run_ts=RUN_TS)   # replay changes nothing
    assert sorted((r.order_id, r.product_name, r.quantity) for r in t.read().collect()) == snap
    assert t.has_order("ORD-000002") and not t.has_order("ORD-999999")
    assert t.delete_before(date(2022, 1, 1)) == 1
    assert [r.order_id for r in t.read().collect()] == ["ORD-000002"]
    assert t.delete_before(date(2022, 1, 1)) == 0


def test_atomic_batch_rejects_all(spark):
    path = tempfile.mkdtemp(prefix="tl-table-") + "/sales"
    t = KeyedSalesTable(spark, path, buckets=4)
    bad = _rows(spark, [("a", "ORD-000001", "A", 1, 10.0, date(2021, 1, 1), "C", "Canada", 10.0),
                        ("a", "ORD-000002", "A", 1, 10.0, date(2021, 1, 1), "C", "Canada", 11.0)])
    r = t.upsert(bad, run_ts=RUN_TS, atomic=True)
    assert not r.success and r.rows_inserted == 0 and t.read().count() == 0
