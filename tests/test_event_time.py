"""Windows, sessions and deduplication: batch, stream with restarts, and brute force agree."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from sales_rows import SF_SMALL
from tallyline.streaming.event_time import first_per_key, sessions, stream_sessions, windowed_totals
from tallyline.streaming.replay import replay

T0 = datetime(2024, 1, 1)
MIN = 60_000_000
SCHEMA = "k string, at timestamp, value double, batch int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain_sessions(rows, gap):
    out = []
    for k in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r[1], r[2]) for r in rows if r[0] == k and r[1] is not None)
        group = []
        for i, (t, v) in enumerate(own):
            if group and t - own[i - 1][0] > gap:
                out.append((k, group[0][0], group[-1][0] + gap, len(group), round(sum(x[1] or 0 for x in group), 4)))
                group = []
            group.append((t, v))
        if group:
            out.append((k, group[0][0], group[-1][0] + gap, len(group), round(sum(x[1] or 0 for x in group), 4)))
    return sorted(out)


def some_rows(seed=1, n=600):
    r = random.Random(seed)
    rows = [(r.choice(["hot", "hot", "a", "b"]), T0 + timedelta(minutes=r.randrange(3000), microseconds=r.choice([0, 0, 1])), r.randrange(500) / 4, 0) for _ in range(n)]
    rows += [("edge", T0 + timedelta(minutes=10 * i), 1.0, 0) for i in range(5)]                                   # exactly the gap apart
    rows += [("edge2", T0 + timedelta(minutes=10 * i, microseconds=i), 1.0, 0) for i in range(5)]                  # one microsecond more
    return rows + [(None, T0, 1.0, 0), ("a", None, 1.0, 0), ("one", T0, 2.5, 0), ("one", T0, 2.5, 0)]


def result(df):
    return sorted((r["k"], r["session_start"], r["session_end"], r["n"], float(r["total"])) for r in df.collect())


def test_batch_sessions_equal_brute_force(spark):
    rows = some_rows()
    assert result(sessions(frame(spark, rows), ["k"], "at", 10 * MIN, "value")) == plain_sessions(rows, timedelta(minutes=10))
    assert sessions(frame(spark, []), ["k"], "at", 10 * MIN, "value").collect() == []


def test_stream_sessions_equal_the_batch_over_restarts(spark):
    rows = [(k, t, v, random.Random(i).randrange(4)) for i, (k, t, v, _) in enumerate(some_rows())]
    end = ("closing", T0 + timedelta(days=30), 0.0, 9)
    run = replay(frame(spark, [*rows, end]), "batch", lambda x: stream_sessions(x, ["k"], "at", 10 * MIN, "value", 5 * 1440 * MIN))
    assert result(run.outputs) == plain_sessions(rows, timedelta(minutes=10))
    run.discard()


def test_a_hot_customer_is_combined_before_the_shuffle(spark):
    rows = frame(spark, [("hot", T0 + timedelta(seconds=i), 1.0, 0) for i in range(3000)])
    df = sessions(rows.repartition(4), ["k"], "at", 10 * MIN, "value")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan
    assert [r["n"] for r in df.collect()] == [3000]


def plain_windows(rows, width, slide, delay):
    """Spark's rule: a row counts in a window whose end is after the latest time of earlier batches less the delay."""
    out, mark = {}, None
    us = lambda t: (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    for b in sorted({r[3] for r in rows}):
        batch = [r for r in rows if r[3] == b and r[1] is not None]
        for k, t, _v, _ in batch:
            w = us(t) // slide * slide
            while w > us(t) - width:
                x = out.setdefault((w, k), [0, 0])
                x[0 if mark is None or w + width > mark else 1] += 1
                w -= slide
        top = max((us(r[1]) for r in batch), default=None)
        if top is not None:
            mark = max(mark or 0, top // 1000 * 1000 - delay)
    return {k: v for k, v in out.items()}


@pytest.mark.parametrize("width, slide, delay", [(30, 30, 60), (60, 20, 0), (60, 15, 2000)])
def test_windows_leave_out_just_the_late_rows(spark, width, slide, delay):
    r = random.Random(3)
    rows = [(k, t, v, None if t is None else int((t - T0) / timedelta(minutes=600)) + (r.randrange(3) if i % 5 == 0 else 0))
            for i, (k, t, v, _) in enumerate(some_rows(n=300))]
    rows = [(k, t, v, 0 if b is None else b) for k, t, v, b in rows]
    df = frame(spark, rows)
    run = replay(df, "batch", lambda x: windowed_totals(x, "at", width * MIN, slide * MIN, ("k",), "value", delay * MIN), mode="update")
    got = {(int(x["window_start"].timestamp() * 1_000_000), x["k"]): x["n"] for x in run.latest(["window_start", "k"]).collect()}
    want = plain_windows(rows, width * MIN, slide * MIN, delay * MIN)
    assert got == {k: a for k, (a, _) in want.items() if a}
    late = sum(b for _, b in want.values())
    whole = windowed_totals(df, "at", width * MIN, slide * MIN, ("k",), "value")
    assert whole.agg(F.sum("n")).first()[0] - sum(got.values()) == late and (late > 0) == (delay < 2000)
    run.discard()


def test_dedupe_keeps_the_first_across_restarts_and_expires(spark):
    day = lambda n: T0 + timedelta(days=n)
    rows = [("a", day(0), 1.0, 0), ("b", day(1), 1.0, 0), ("a", day(1), 2.0, 1), ("c", day(3), 1.0, 1),
            ("a", day(4), 3.0, 2), ("d", day(30), 1.0, 2),             # the watermark will pass day 20
            ("a", day(29), 4.0, 3), ("b", day(2), 5.0, 3),             # a returns after its state expired; b is late
            (None, day(29), 1.0, 3), ("e", None, 1.0, 3), ("d", day(31), 6.0, 4)]
    run = replay(frame(spark, rows), "batch", lambda x: first_per_key(x, ["k"], "at", 10 * 86_400_000_000))
    got = sorted((r["k"], r["at"], r["value"]) for r in run.outputs.collect())
    assert got == [("a", day(0), 1.0), ("a", day(29), 4.0), ("b", day(1), 1.0), ("c", day(3), 1.0), ("d", day(30), 1.0)]
    assert sum(run.figure("numRowsDroppedByWatermark")) == 1 and sum(run.figure("numDroppedDuplicateRows")) == 3
    assert max(run.figure("numRowsTotal")) <= 4 and run.figure("numRowsTotal")[-1] <= 2
    run.discard()


def test_dedupe_state_is_bounded_by_the_delay(spark):
    # 40 days, 50 new keys a day, a state of two days
    rows = [(f"k{d}-{i}", T0 + timedelta(days=d), 1.0, d // 4) for d in range(40) for i in range(50)]
    rows += rows[::7]
    run = replay(frame(spark, rows), "batch", lambda x: first_per_key(x, ["k"], "at", 2 * 86_400_000_000))
    assert run.outputs.count() == 2000
    assert run.figure("numRowsTotal")[-1] <= 50 * 5 < 2000
    run.discard()


def test_replay_of_nothing_and_stop_in_the_middle(spark):
    none = replay(frame(spark, []), "batch", lambda x: first_per_key(x, ["k"], "at", MIN))
    assert none.outputs.collect() == [] and none.progress == []
    rows = frame(spark, [("a", T0, 1.0, 0), ("b", T0, 1.0, 1), ("a", T0, 1.0, 1)])
    half = replay(rows, "batch", lambda x: first_per_key(x, ["k"], "at", 10**10), stop_after=1)
    assert [r["k"] for r in half.outputs.collect()] == ["a"]


@pytest.mark.parametrize("name", ["stream_tumbling", "stream_first_orders", "stream_sessions", "sessions", "asof_price", "events_in_periods"])
def test_queries_match_sql(spark, name):
    r = compare(spark, name, SF_SMALL, duck(SF_SMALL))
    assert r["match"], r
