"""Maintained views, sketches and JSON records."""

import json
import os
import random
import tempfile
import time
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from sales_rows import SF_SMALL
from tallyline.operators import records as R
from tallyline.operators import sketches as K
from tallyline.operators.views import MaintainedView, change
from tallyline.plans import catalog as C
from tallyline.session import FREE_SHUFFLES, discard_kept, keep
from tallyline.sources import tables

SALES = "order_id string, country string, customer_id string, order_date date, quantity int, total_amount decimal(12,2)"


def sale(r, i):
    return (f"o{i}", r.choice(["CA", "CA", "CA", "DE", None]), r.choice(["c1", "c2", "c3", None]), date(2024, 1, 1) + timedelta(days=r.randrange(9)),
            r.randrange(1, 5), Decimal(r.randrange(1000)) / 100)


def recomputed(rows):
    out = []
    for k in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == k]
        total = sum(r[5] for r in own)
        out.append((k, len(own), sum(r[4] for r in own), float(total), float(total) / len(own), len({r[2] for r in own} - {None}),
                    min(r[3] for r in own), max(r[3] for r in own)))
    return sorted(out, key=repr)


@pytest.fixture
def view(spark):
    return MaintainedView(spark, tempfile.mkdtemp(prefix="tl-view-") + "/v", "country", buckets=4)


def test_view_equals_recomputation_after_loads_and_deletes(spark, view):
    r = random.Random(4)
    frame = lambda rows: spark.createDataFrame(rows, SALES)
    table = {}
    for load in range(6):
        if load < 4:
            new = {x[0]: x for x in (sale(r, r.randrange(60)) for _ in range(30))}
            old = [table[k] for k in new if k in table]
            table |= new
            removed, added = old, list(new.values())
        else:                                                   # deletes: the first and last dates of groups move
            gone = [k for k, x in table.items() if x[3] < date(2024, 1, 4)] if load == 4 else [k for k, x in table.items() if x[1] == "DE"]
            removed, added = [table.pop(k) for k in gone], []
        view.apply(frame(removed), frame(added), load)
        assert sorted(map(tuple, view.read().collect()), key=repr) == recomputed(list(table.values()))
        view.apply(frame(removed), frame(added), load)          # the load repeated
        assert sorted(map(tuple, view.read().collect()), key=repr) == recomputed(list(table.values()))
    view.apply(frame(list(table.values())), frame([]), 6)       # nothing is left
    assert view.read().collect() == []


def test_untouched_groups_are_not_written(spark, view):
    frame = lambda rows: spark.createDataFrame(rows, SALES)
    one = lambda i, country: (f"o{i}", country, "c", date(2024, 1, 1), 1, Decimal(1))
    rows = [one(i, f"k{i}") for i in range(20)]
    assert view.apply(frame([]), frame(rows), 0) == 4
    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(view.path) for f in names if f.endswith(".parquet")}
    before = files()
    assert view.apply(frame([]), frame([one(99, "k3")]), 1) == 1
    after = files()
    changed = {os.path.dirname(p) for p in before if p not in after}
    assert len(changed) == 1 and len([p for p in before if p in after and before[p] == after[p]]) == len(before) - 1
    assert change(frame(rows), frame(rows), "country").collect() == []
    assert view.apply(frame(rows), frame(rows), 2) == 0          # a load that changes nothing


def sales_frame(spark, n=60_000):
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "big").otherwise(F.concat(F.lit("s"), (i % 5).cast("string"))).alias("country"),
        F.date_add(F.lit(date(2024, 1, 1)), (i % 200).cast("int")).alias("order_date"),
        F.when(i % 97 > 0, F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string"))).alias("customer_id"),
        F.when(i % 89 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100.0).alias("total_amount"))


def test_sketches_stay_within_their_bounds_and_merge_in_any_order(spark):
    sales = sales_frame(spark)
    stored, _ = keep(K.day_sketches(sales, ["country"]), "test-sketches")
    once = K.estimates(K.merged(stored, ["country"]))
    for r in K.held_to_exact(sales, once, "country").collect():
        assert all(r[c] for c in ("distinct_within", "p50_within", "p90_within")), r
    by_month = K.merged(stored, [F.date_trunc("month", "order_date").alias("m"), "country"])
    twice = K.estimates(K.merged(by_month, ["country"]))
    for r in K.held_to_exact(sales, twice, "country").collect():
        assert all(r[c] for c in ("distinct_within", "p50_within", "p90_within")), r
    assert {r["country"]: r["n"] for r in once.collect()} == {r["country"]: r["n"] for r in twice.collect()}
    assert sum(r["n"] for r in once.collect()) == 60_000


def test_roll_up_reads_stored_sketches_only(spark):
    stored, _ = keep(K.day_sketches(sales_frame(spark, 1000), ["country"]), "test-sketches")
    plan = K.estimates(K.merged(stored, ["country"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_hll_union_agg" in plan and "ReadSchema: struct<country:string,n:bigint,who:binary,how_much:binary>" in plan


def test_sketches_of_few_empty_and_null_rows(spark):
    rows = [("x", date(2024, 1, 1), "a", 1.0), ("x", date(2024, 1, 2), "a", 3.0), ("n", date(2024, 1, 1), None, None), (None, None, "b", 2.0)]
    sales = spark.createDataFrame(rows, "country string, order_date date, customer_id string, total_amount double")
    got = {r["country"]: (r["n"], r["distinct"], r["p50"]) for r in K.estimates(K.merged(K.day_sketches(sales, ["country"]), ["country"])).collect()}
    assert got == {"x": (2, 1, 1.0), "n": (1, 0, None), None: (1, 1, 2.0)}
    assert K.estimates(K.merged(K.day_sketches(sales.where("false"), ["country"]), ["country"])).collect() == []


FIELDS = {"file": ("$.file", "string"), "n": ("$.n", "bigint"), "tags": ("$.tags", "array<string>"), "deep": ("$.a.b[1].c", "int")}


def test_records_with_unknown_missing_and_odd_fields(spark):
    texts = ['{"file":"f","n":3,"tags":["x","y"],"a":{"b":[0,{"c":7}]},"new":{"z":[1,2]},"v":"t"}', '{"file":"f"}', '{"file":"g","n":"many","tags":5}',
             '{"n":1}', "{bad", "", None, "[1]", '"text"', "null", '{"file":null}', "{}", '{"file":"f","n":12345678901}', '{"file":"é\\u00e9","n":2.0}', "x" * 100_000]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "i int, record string, unknown_here string")
    rows = {r["i"]: r for r in R.parse_records(df, FIELDS, ("file",)).collect()}
    whys = [rows[i][R.REJECT] for i in range(len(texts))]
    assert whys == [None, None, None, "missing:file", "not_json", "not_json", "no_record", "not_an_object", "not_an_object", "not_an_object",
                    "missing:file", "missing:file", None, None, "not_json"]
    a = rows[0]
    assert (a["file"], a["n"], a["tags"], a["deep"]) == ("f", 3, ["x", "y"], 7)
    assert {k: json.loads(v) if v[0] in "{[" else v for k, v in a[R.UNKNOWN].items()} == {"new": {"z": [1, 2]}, "v": "t"}
    assert (rows[1]["n"], rows[1]["tags"], rows[1][R.UNKNOWN]) == (None, None, {})
    assert (rows[2]["n"], rows[2]["tags"]) == (None, None) and rows[12]["n"] == 12345678901 and rows[13]["file"] == "éé"
    parsed = R.parse_records(df, FIELDS, ("file",))
    assert R.good(parsed).count() + R.rejects(parsed).count() == len(texts)


def test_round_trip_of_nested_rows(spark):
    schema = "file string, n long, checks array<struct<column:string,check:string,failures:long>>, m map<string,long>"
    rows = [("a", 1, [("c", "x", 2), ("d", "x", 3), (None, None, 1)], {"k": 5}), ("b", None, [], {}), ("c", 7, None, None)]
    text = R.to_records(spark.createDataFrame(rows, schema))
    fields = {"file": ("$.file", "string"), "n": ("$.n", "bigint"), "checks": ("$.checks", "array<struct<column:string,check:string,failures:bigint>>"),
              "m": ("$.m", "map<string,bigint>")}
    got = R.good(R.parse_records(text, fields, ("file",)))
    back = sorted((r["file"], r["n"], None if r["checks"] is None else [tuple(x) for x in r["checks"]], r["m"]) for r in got.collect())
    assert back == [(a, b, c, d) for a, b, c, d in rows]
    sums = {r["file"]: r["s"] for r in got.select("file", R.counts_by_name(F.col("checks"), "check", "failures").alias("s")).collect()}
    assert sums == {"a": {"x": 5}, "b": {}, "c": None}


def test_kept_tables_go(spark):
    _, path = keep(spark.range(3), "test-kept")
    assert discard_kept(spark) >= 1 and not os.path.exists(path.removeprefix("file:"))


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in folders for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def test_kept_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept, _ = keep(rows, "test-shuffles")
    end = time.time() + 20                        # the files go in the background
    while (made := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not made and spark.conf.get(FREE_SHUFFLES, None) == setting
    assert rows.exceptAll(kept).isEmpty() and rows.count() == rows.count() == kept.count() == 7


def sale_tables(spark, folder):
    """Line items of 40 orders in four files (order 0 refuses the last one), some orders, customers and parts missing."""
    made = {"lineitem": (400, "id % 40 l_orderkey, id l_linenumber, id % 9 l_partkey, id % 11 l_suppkey, double(id % 6) l_quantity, id + 0.25D l_extendedprice"),
            "orders": (38, "id o_orderkey, id % 7 o_custkey, timestamp '1996-02-29 00:00:00' + make_interval(0, id % 5) o_orderdate"),
            "customer": (6, "id c_custkey, int(id * 3) c_nationkey"),
            "part": (8, "id p_partkey, 'large ring' p_name, 9.5D + id p_retailprice")}
    for name, (n, columns) in made.items():
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["sketch_countries", "sketch_months"])
def test_sketched_queries_join_the_tables_once(spark, monkeypatch, tmp_path, name):
    d, kept = sale_tables(spark, tmp_path), []
    monkeypatch.setattr(tables, "keep", lambda df, name: kept.append(keep(df, name)) or kept[-1])
    out = C.QUERIES[name](spark, d)
    assert out.inputFiles() and not any(d in f for f in out.inputFiles())
    assert len(kept) == 1 and not os.path.exists(kept[0][1].removeprefix("file:"))
    rows = out.collect()
    assert sum(r["total_orders"] for r in rows) == C._sales(spark, d).count() > 0
    assert all(r["distinct_within"] and r["p50_within"] and r["p90_within"] for r in rows)


def test_stored_rows_are_joined_with_the_orders_last(spark, tmp_path):
    d, most = sale_tables(spark, tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for by_order, key in ((True, "l_orderkey"), (False, "l_partkey")):
            plan = tables._joined(spark, d, by_order)._jdf.queryExecution().executedPlan().toString()
            assert plan.split("SortMergeJoin [")[1].startswith(key), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert tables._joined(spark, d, True).exceptAll(tables._joined(spark, d)).isEmpty()
    assert tables._joined(spark, d).exceptAll(tables._joined(spark, d, True)).isEmpty()


@pytest.mark.parametrize("name", ["sketch_countries", "sketch_months", "view_country_after_loads", "result_records", "event_records", "event_record_rejects"])
def test_queries_match_sql(spark, name):
    r = compare(spark, name, SF_SMALL, duck(SF_SMALL))
    assert r["match"], r


def test_views_after_loads_join_the_tables_once(spark, monkeypatch):
    joins = []
    real = tables._joined
    monkeypatch.setattr(tables, "_joined", lambda *a: joins.append(a) or real(*a))
    kept = []
    monkeypatch.setattr(tables, "keep", lambda df, name: kept.append(name) or keep(df, name))
    assert C.q_view_country_after_loads(spark, SF_SMALL).count() > 0
    assert len(joins) == len(kept) == 1
