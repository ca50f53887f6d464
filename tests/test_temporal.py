"""As-of and interval joins against brute force, and the shape of their plans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators.temporal import FEW_PERIODS, FINE_BINS, TimeRanges, asof_join, interval_join

T0 = datetime(2024, 1, 1)
LEFT = "k string, g int, at timestamp, id long, _row string"
RIGHT = "k string, g int, since timestamp, seq int, v string"


def moments(r, n, hot):
    """Rows of a hot key, of few keys, at few moments, with nulls."""
    out = []
    for _ in range(n):
        k = "hot" if r.random() < hot else r.choice(["a", "b", "c", None])
        at = None if r.random() < 0.03 else T0 + timedelta(minutes=r.randrange(400), microseconds=r.choice([0, 0, 1]))
        out.append((k, r.choice([1, 1, 2]) if k != "c" else None, at))
    return out


def plain_asof(left, right, strict, tolerance):
    out = []
    for k, g, at, i, x in left:
        best = max(((since, seq, v) for rk, rg, since, seq, v in right if rk == k and rg == g and None not in (k, g, at, since)
                    and (since < at or since == at and not strict)), default=None)
        if best and tolerance is not None and at - best[0] > timedelta(microseconds=tolerance):
            best = None
        out.append((k, g, at, i, x, best[0] if best else None, best[2] if best else None))
    return out


def same(got, want):
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 5 * 60_000_000])
@pytest.mark.parametrize("ranges", [1, 7, None])
def test_asof_equals_brute_force(spark, strict, tolerance, ranges):
    r = random.Random(6)
    left = [(*m, i, "x") for i, m in enumerate(moments(r, 400, 0.5))]
    right = [(*m, r.randrange(3), r.choice("uvwxyz")) for m in moments(r, 150, 0.5)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "g"], "at", "since", ["v"], ["seq"],
                    strict, tolerance, ranges)
    assert got.columns == ["k", "g", "at", "id", "_row", "since", "v"]
    same(got.collect(), plain_asof(left, right, strict, tolerance))


@pytest.mark.parametrize("n_left, n_right", [(0, 5), (5, 0), (0, 0)])
def test_asof_of_empty_sides(spark, n_left, n_right):
    left = [("a", 1, T0, i, "x") for i in range(n_left)]
    right = [("a", 1, T0, i, "v") for i in range(n_right)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k", "g"], "at", "since", ["v"], ["seq"])
    same(got.collect(), plain_asof(left, right, False, None))


def test_a_value_is_carried_over_many_ranges(spark):
    left = [("hot", 1, T0 + timedelta(days=d), d, "x") for d in range(1000)]
    right = [("hot", 1, T0 + timedelta(days=3), 0, "only"), ("late", 1, T0, 0, "no")]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "at", "since", ["v"], ranges=50)
    assert {r["id"]: r["v"] for r in got.collect()} == {d: "only" if d >= 3 else None for d in range(1000)}


def test_asof_plan_spreads_a_key_over_ranges(spark):
    left = spark.createDataFrame([("hot", 1, T0 + timedelta(days=d), d, "x") for d in range(1000)], LEFT)
    right = spark.createDataFrame([("hot", 1, T0, 0, "v")], RIGHT)
    plan = asof_join(left, right, ["k"], "at", "since", ["v"], ranges=50)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan, plan
    # rows (they carry _row) are only ever dealt by key and range
    assert "_range" in plan and "max_by" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning(k#" in line and "_range" not in line:
            assert "since" in line or "_last" in plan, line
    span = TimeRanges.of(left.select(F.unix_micros("at").alias("t")), "t", 50)
    sizes = left.groupBy(span.column(F.unix_micros("at")).alias("r")).count().collect()
    assert len(sizes) == 50 and max(r["count"] for r in sizes) <= 2 * 1000 / 50


def test_ranges_follow_the_rows(spark):
    # nine tenths of the rows in one hour of a year
    t = spark.range(10_000).select(F.when(F.col("id") < 9000, F.col("id") * 400_000).otherwise(F.col("id") * 3_000_000_000).alias("t"))
    span = TimeRanges.of(t, "t", 8)
    ids = span.ids
    assert len(ids) == FINE_BINS and ids == sorted(ids) and ids[0] == 0 and ids[-1] < 8
    assert TimeRanges.of(t.where("false"), "t").ids == [0]


POINTS = "k string, at timestamp, id long"
PERIODS = "k string, begins timestamp, ends timestamp, pid long"


def test_interval_join_equals_brute_force(spark):
    r = random.Random(8)
    key = lambda: r.choice(["hot", "hot", "hot", "a", "b", None])
    points = [(key(), None if r.random() < 0.05 else T0 + timedelta(microseconds=r.randrange(-10**9, 10**10)), i) for i in range(300)]
    points += [(k, a, i + 1000) for k, a, i in points[:40]]
    periods = []
    for i in range(120):
        b = T0 + timedelta(microseconds=r.randrange(-10**9, 10**10))
        length = timedelta(microseconds=r.choice([1, 2, 3, 4, 5, 1000, 1 << 20, (1 << 20) + 1, 10**8, 10**9, 5 * 10**9, 0, -7, 10**14]))
        periods.append((key(), None if r.random() < 0.05 else b, None if r.random() < 0.1 else b + length, i))
    exact = [(k, a) for k, a, _ in points if a is not None][:30]
    periods += [(k, a, a + timedelta(microseconds=1), 500 + i) for i, (k, a) in enumerate(exact)]
    periods += [(k, a - timedelta(days=9), a, 600 + i) for i, (k, a) in enumerate(exact)]            # the end is exclusive
    got = interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(periods, PERIODS), ["k"], "at", "begins", "ends")
    want = [(i, p) for k, a, i in points for pk, b, e, p in periods
            if None not in (k, a, b) and k == pk and b <= a and (e is None or a < e)]
    assert sorted((r["id"], r["pid"]) for r in got.collect()) == sorted(want) and len(want) > 500


def test_interval_join_without_keys_or_rows(spark):
    points = spark.createDataFrame([("a", T0, 1)], POINTS)
    none = spark.createDataFrame([], PERIODS)
    assert interval_join(points, none, ["k"], "at", "begins", "ends").collect() == []
    assert interval_join(points.where("false"), spark.createDataFrame([("a", T0, None, 1)], PERIODS), ["k"], "at", "begins", "ends").collect() == []


def test_interval_plan_is_a_hash_join_and_long_periods_stay_few_rows(spark):
    points = spark.createDataFrame([("a", T0 + timedelta(days=d), d) for d in range(50)], POINTS)
    periods = spark.createDataFrame([("a", T0 - timedelta(days=9000), T0 + timedelta(days=9000), 1), ("a", T0, T0 + timedelta(seconds=1), 2)], PERIODS)
    joined = interval_join(points, periods, ["k"], "at", "begins", "ends")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "_level" in plan and "_bin" in plan
    assert joined.count() == 51


def test_neither_side_of_an_interval_join_is_broadcast(spark):
    points = spark.createDataFrame([("a", T0 + timedelta(days=d), d) for d in range(5)], POINTS)
    periods = spark.createDataFrame([("a", T0, T0 + timedelta(days=2), 1)], PERIODS)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) > 0
    plan = interval_join(points, periods, ["k"], "at", "begins", "ends")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan and "_bin" in plan.split("SortMergeJoin [k")[1].splitlines()[0], plan


def test_points_of_keys_with_few_periods_are_one_row(spark):
    # periods of many lengths, one without an end, some from before 1970; one key has one period too many
    old = datetime(1969, 12, 31, 23)
    points, periods = [], []
    for k, n in (("few", FEW_PERIODS), ("crowded", FEW_PERIODS + 1)):
        points += [(k, t + timedelta(minutes=7 * i), i) for t in (T0, old) for i in range(60)]
        starts = [(T0, old)[i % 2] + timedelta(minutes=11 * (i // 2)) for i in range(n)]
        periods += [(k, b, None if i == 4 else b + timedelta(microseconds=3 ** (i % 22)), i) for i, b in enumerate(starts)]
    got = interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(periods, PERIODS), ["k"], "at", "begins", "ends")
    want = [(k, a, i, p) for k, a, i in points for pk, b, e, p in periods if k == pk and b <= a and (e is None or a < e)]
    key = lambda x: (x[0], x[1], x[2], x[3])
    assert sorted(((r["k"], r["at"], r["id"], r["pid"]) for r in got.collect()), key=key) == sorted(want, key=key)
    few = interval_join(spark.createDataFrame(points, POINTS).where("k = 'few'"), spark.createDataFrame(periods, PERIODS).where("k = 'few'"),
                        ["k"], "at", "begins", "ends")
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Generate") == 1, plan          # only the periods become several rows


def test_asof_summarises_only_crowded_keys(spark):
    # 2,000 keys of a few rows, of another integer type on the right; later also one key with a third of all rows
    r = random.Random(3)
    left = [(k, T0 + timedelta(minutes=r.randrange(999)), 10 * k + i) for k in range(2000) for i in range(3)]
    right = [(k, T0 + timedelta(minutes=r.randrange(999)), f"{k}-{i}") for k in range(0, 2000, 2) for i in range(3)]
    hot = [(7777, T0 + timedelta(minutes=i % 999), 10**6 + i) for i in range(3000)]
    hot_right = [(7777, T0 + timedelta(minutes=10 * i), f"h-{i}") for i in range(40)]

    def joined(lrows, rrows):
        return asof_join(spark.createDataFrame(lrows, "k int, at timestamp, id long"), spark.createDataFrame(rrows, "k long, since timestamp, v string"),
                         ["k"], "at", "since", ["v"], ranges=20)

    def plain(lrows, rrows):
        of = {}
        for k, since, v in rrows:
            of.setdefault(k, []).append((since, v))
        return sorted((i, max(((s, v) for s, v in of.get(k, []) if s <= at), default=(None, None))[1]) for k, at, i in lrows)

    few, both = joined(left, right), joined(left + hot, right + hot_right)
    key = lambda x: (x[0], x[1] or "")
    assert sorted(((r["id"], r["v"]) for r in few.collect()), key=key) == sorted(plain(left, right), key=key)
    assert sorted(((r["id"], r["v"]) for r in both.collect()), key=key) == sorted(plain(left + hot, right + hot_right), key=key)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (few, both)]
    assert "max_by" not in plans[0] and "max_by" in plans[1]
