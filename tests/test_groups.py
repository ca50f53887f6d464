"""Grouping sets, bags of rows and moving windows against brute force, and their plans."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from sales_rows import SF_SMALL
from tallyline.operators.bags import bag_changes, except_all, intersect_all
from tallyline.operators.rollups import cube_sets, grouped_totals, moving_totals, rollup_sets

key = lambda x: tuple((v is not None, v) for v in x)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cube_rows(n=400, seed=2):
    r = random.Random(seed)
    return [(r.choice(["hot", "hot", "x", None]), r.choice([1, 2, None]), r.choice(["c1", "c2", "c3", None]), r.randrange(100)) for _ in range(n)]


def test_cube_tells_null_keys_from_totals_and_counts_distinct_per_level(spark):
    rows = cube_rows()
    df = spark.createDataFrame(rows, "a string, b int, cust string, v long")
    got = grouped_totals(df, ["a", "b"], cube_sets(["a", "b"]), {"s": F.sum("v")}, "cust")
    want = []
    for n in range(3):
        for s in combinations((0, 1), n):
            groups = defaultdict(list)
            for r in rows:
                groups[tuple(r[i] if i in s else None for i in (0, 1))].append(r)
            want += [(*k, *[int(i not in s) for i in (0, 1)], len(g), sum(r[3] for r in g), len({r[2] for r in g} - {None})) for k, g in groups.items()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    p = plan(grouped_totals(df, ["a", "b"], cube_sets(["a", "b"]), {"s": F.sum("v")}, "cust"))
    assert p.count("Expand [") == 1 and "partial_sum" in p and "partial_count" in p
    assert sorted(map(len, rollup_sets(["a", "b"]))) == [0, 1, 2] and len(cube_sets(["a", "b", "c"])) == 8


def test_totals_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int, cust string, v long")
    assert grouped_totals(df, ["a", "b"], cube_sets(["a", "b"]), {}, "cust").collect() == []


def bag(seed, n=300):
    r = random.Random(seed)
    return [(r.choice(["x", "y", None]), r.choice([1, 2, 3, None]), r.choice([0.5, float("nan"), None])) for _ in range(n)]


def norm(rows):
    return Counter(tuple("nan" if v != v else v for v in map(lambda v: v, r)) for r in rows)


@pytest.mark.parametrize("a, b", [(bag(1), bag(2, 150)), ([], bag(3, 5)), (bag(4, 5), []), ([], []), ([("x", 1, None)] * 5000, [("x", 1, None)] * 1700)])
def test_bag_operations_equal_counters(spark, a, b):
    schema = "s string, i int, f double"
    x, y = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    ca, cb = norm(a), norm(b)
    assert norm(map(tuple, except_all(x, y).collect())) == ca - cb
    assert norm(map(tuple, intersect_all(x, y.select("f", "s", "i")).collect())) == ca & cb
    got = {tuple("nan" if v != v else v for v in (r["s"], r["i"], r["f"])): (r["removed"], r["added"]) for r in bag_changes(x, y).collect()}
    assert got == {k: (max(0, ca[k] - cb[k]), max(0, cb[k] - ca[k])) for k in ca | cb if ca[k] != cb[k]}


def test_bags_are_counted_by_hash_and_before_the_shuffle(spark):
    x = spark.createDataFrame(bag(1), "s string, i int, f double")
    p = plan(except_all(x, x))
    assert "partial_sum" in p and "HashAggregate" in p and "SortAggregate" not in p and "Sort [" not in p
    with pytest.raises(ValueError):
        except_all(x, x.drop("f"))


def plain_moving(rows, days):
    if not rows:
        return []
    first, last = min(d for _, d, _ in rows), max(d for _, d, _ in rows)
    value = {(k, d): v for k, d, v in rows}
    out = []
    for k in {r[0] for r in rows}:
        d = first
        while d <= last:
            out.append((k, d, value.get((k, d), 0), sum(value.get((k, d - timedelta(days=i)), 0) for i in range(days))))
            d += timedelta(days=1)
    return out


@pytest.mark.parametrize("days, block", [(7, 64), (7, 7), (5, 10), (1, 3), (30, 30)])
def test_moving_totals_equal_brute_force(spark, days, block):
    r = random.Random(days)
    all_days = [date(2023, 12, 20) + timedelta(days=i) for i in range(120)]
    rows = [(k, d, r.randrange(1, 50)) for k in ("a", "b", None) for d in all_days if r.random() < 0.3]
    df = spark.createDataFrame(rows, "k string, day date, v long")
    got = moving_totals(df, ["k"], "day", ["v"], days, block)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_moving(rows, days), key=key)


def test_moving_totals_of_one_series_use_many_tasks(spark):
    rows = [(date(2020, 1, 1) + timedelta(days=3 * i), 1) for i in range(600)]
    df = spark.createDataFrame([*rows, (None, 5)], "day date, v long")
    got = moving_totals(df, [], "day", ["v"])
    p = plan(got)
    assert "SinglePartition" not in p.split("Window")[1], p
    assert got.count() == 1798 and got.agg(F.max("moving_v")).first()[0] == 3
    assert moving_totals(df.where("false"), [], "day", ["v"]).collect() == []


@pytest.mark.parametrize("name", ["sales_cube", "raw_rollup", "load_except_all", "load_intersect_all", "load_changes", "revenue_7d", "country_revenue_7d"])
def test_queries_match_sql(spark, name):
    r = compare(spark, name, SF_SMALL, duck(SF_SMALL))
    assert r["match"], r


def test_moving_totals_compute_the_daily_rows_once(spark):
    rows = spark.range(40).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("day"), (F.col("id") * 7919).alias("n"))
    out = moving_totals(rows, [], "day", ["n"])
    assert "7919" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["day"].toordinal() - 738886: r["moving_n"] for r in out.collect()} == {d: 7919 * sum(range(max(0, d - 6), d + 1)) for d in range(40)}
