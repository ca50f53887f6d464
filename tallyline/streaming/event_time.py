"""Event-time operators: tumbling and sliding windows, sessions, deduplication.

Each works on a stream (with a watermark: the state it keeps is bounded by the
delay) and on a batch. Rows that come later than the watermark allows are left
out by Spark's rule; everything else equals the batch result, in whatever order
the rows come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.temporal import micros


def _interval(us: int) -> str:
    return f"{us} microseconds"


def windowed_totals(rows: DataFrame, at: str, width_us: int, slide_us: int | None = None, keys: tuple[str, ...] = (),
                    value: str | None = None, delay_us: int | None = None) -> DataFrame:
    """window_start, `keys`, n and (with `value`) total per window of `width_us`, one every `slide_us`.

    Windows are half-open and start at multiples of the slide since 1970. A row
    is in width / slide of them. `total` is a decimal sum: it does not depend on
    the order of addition, so a stream and a batch agree to the last digit. Rows
    without a time are in no window; keys may be null. `delay_us` puts a
    watermark on a stream."""
    if rows.isStreaming and delay_us is not None:
        rows = rows.withWatermark(at, _interval(delay_us))
    w = F.window(F.col(at), _interval(width_us), _interval(slide_us or width_us))
    totals = [F.sum(F.col(value).cast("decimal(18,4)")).alias("total")] if value else []
    out = rows.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), *totals)
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", *[c for c in ("total",) if value])


def sessions(rows: DataFrame, keys: list[str], at: str, gap_us: int, value: str | None = None) -> DataFrame:
    """`keys`, session_start, session_end (last row plus the gap), n and (with `value`) total, for a batch.

    A row more than `gap_us` after the one before it opens a session. Rows of a
    key in one stretch of gap_us always belong together, so they are combined
    before the shuffle: a customer with a third of all rows costs one row per
    stretch and task. Gaps are then sought between stretches, of which a key has
    at most its time span / gap_us. Rows without a key or time are in no session."""
    known = F.col(at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    t = micros(F.col(at))
    totals = [F.sum(F.col(value).cast("decimal(18,4)")).alias("total")] if value else []
    stretches = rows.where(known).groupBy(*keys, F.floor(t / gap_us).alias("_s")).agg(
        F.min(t).alias("_lo"), F.max(t).alias("_hi"), F.count(F.lit(1)).alias("n"), *totals)
    order = Window.partitionBy(*keys).orderBy("_s")
    opens = F.coalesce(F.col("_lo") - F.lag("_hi").over(order) > gap_us, F.lit(True))
    begun = F.last(F.when(F.col("_opens"), F.col("_lo")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = stretches.withColumn("_opens", opens).withColumn("_begin", begun)
    more = [F.sum("total").cast("decimal(28,4)").alias("total")] if value else []
    return marked.groupBy(*keys, "_begin").agg((F.max("_hi") + gap_us).alias("_end"), F.sum("n").alias("n"), *more).select(
        *keys, F.timestamp_micros("_begin").alias("session_start"), F.timestamp_micros("_end").alias("session_end"), "n",
        *[c for c in ("total",) if value])


def stream_sessions(rows: DataFrame, keys: list[str], at: str, gap_us: int, value: str | None = None, delay_us: int = 0) -> DataFrame:
    """The same sessions of a stream, each emitted once when the watermark has passed its end (append mode)."""
    known: Column = F.col(at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    totals = [F.sum(F.col(value).cast("decimal(18,4)")).alias("total")] if value else []
    out = rows.withWatermark(at, _interval(delay_us)).where(known).groupBy(*keys, F.session_window(F.col(at), _interval(gap_us)).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), *totals)
    return out.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n", *[c for c in ("total",) if value])


def first_per_key(stream: DataFrame, keys: list[str], at: str, delay_us: int) -> DataFrame:
    """The first row of every key that a stream brings; later ones are dropped for `delay_us` of event time.

    A key's state expires at its first row's time plus the delay, once the
    watermark has passed that: the state holds the keys of that span, however
    long the stream runs, and a key that returns after it counts as new. Rows
    without a key or time, and rows that the watermark has passed, are dropped."""
    return stream.withWatermark(at, _interval(delay_us)).dropna(subset=[*keys, at]).dropDuplicatesWithinWatermark(keys)
