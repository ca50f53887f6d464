"""Joins in time: the value in force at a moment (as-of), and moments inside periods.

Both are equi-joins on keys plus a condition on time that a plain join would
meet by trying all pairs of a key. Here a hot key is split by time, and the
work follows the rows and the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import keep

FINE_BINS = 4096
MAX_RANGES = 256
KEY_SLOTS = 4096
OPEN_END = (1 << 62) - 1        # microseconds; the end of a period without one
FEW_PERIODS = 64
ONE_BIN = 63                    # a level whose only bins are the times before 1970 and those from then on


def micros(t: Column) -> Column:
    """A date or timestamp as microseconds since 1970."""
    return F.unix_micros(t.cast("timestamp"))


def range_count(spark: SparkSession, ranges: int | None = None) -> int:
    """`ranges`, or else the number of shuffle partitions, MAX_RANGES at most."""
    if ranges is not None:
        return ranges
    conf = str(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_RANGES, int(conf) if conf.isdigit() else MAX_RANGES)


class TimeRanges:
    """Ranges of time that hold about equally many rows, found from a histogram of at most FINE_BINS counts.

    A lookup is one division and one array access, whatever the number of ranges."""

    def __init__(self, lo: int, width: int, ids: list[int]):
        self.lo, self.width, self.ids = lo, width, ids

    @staticmethod
    def of(times: DataFrame, column: str, ranges: int | None = None) -> "TimeRanges":
        """From the column of microseconds; `ranges` defaults to the number of shuffle partitions."""
        ranges = range_count(times.sparkSession, ranges)
        lo, hi = times.agg(F.min(column), F.max(column)).first()
        if lo is None:
            return TimeRanges(0, 1, [0])
        width = (hi - lo) // FINE_BINS + 1
        counts = [0] * FINE_BINS
        fine = times.where(F.col(column).isNotNull()).groupBy(F.floor((F.col(column) - lo) / width).alias("b")).count()
        for r in fine.collect():                                   # at most FINE_BINS rows
            counts[min(r["b"], FINE_BINS - 1)] += r["count"]
        share, ids, seen = max(1, -(-sum(counts) // max(1, ranges))), [], 0
        for n in counts:
            ids.append(seen // share)
            seen += n
        return TimeRanges(lo, width, ids)

    def column(self, t: Column) -> Column:
        """The range of a moment; earlier and later moments than seen belong to the first and last; null is in the first."""
        if self.ids[-1] == 0:
            return F.lit(0)
        at = F.greatest(F.lit(0), F.least(F.lit(len(self.ids) - 1), F.floor((t - self.lo) / self.width))).cast("int")
        table = F.expr(f"cast(split('{','.join(map(str, self.ids))}', ',') as array<int>)")      # a constant
        return F.coalesce(F.get(table, at), F.lit(0))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, take: list[str],
              tie: list[str] | None = None, strict: bool = False, tolerance_us: int | None = None,
              ranges: int | None = None) -> DataFrame:
    """Every row of `left` with `right_time` and the columns `take` of the latest right row of its key that is
    not later (with `strict`: that is earlier) than `left_time`; null where there is none.

    An ordered merge: rows of both sides stand in one order per key and range of
    time, and each left row takes the last right row before it. Only keys that may
    hold much of a task's rows have more than one range (the rows of both sides are
    counted by the key's hash, in KEY_SLOTS counts). What is in force when a range of theirs
    begins is carried in as one row per key and range, found from one summary row
    per key and range. So a key with most rows spreads over all ranges, other keys
    are one range without a summary, and no pairs of rows are formed.

    Right rows of one key and time: the greatest of `tie` (then of `take`) counts;
    they are combined before the shuffle. Right rows without a key or time match
    nothing; left rows without one stay, unmatched. `tolerance_us`: an older right
    row does not count. `right_time` must not be a column of `left`.
    """
    tie = tie or []
    usable = F.col(right_time).isNotNull()
    for k in on:
        usable = usable & F.col(k).isNotNull()
    best = F.max(F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate([*tie, *take])])).alias("_best")
    value = F.struct(F.col(right_time).alias("_at"), *[F.col(f"_best.t{len(tie) + i}").alias(f"v{i}") for i in range(len(take))])
    latest = right.where(usable).groupBy(*on, right_time).agg(best).select(*on, micros(F.col(right_time)).alias("_t"), value.alias("_value"))

    # a key's hash, of the type that holds both sides' keys
    keys = left.select(*on).unionByName(right.where(usable).select(*on))
    slot = F.pmod(F.xxhash64(*[F.col(k).cast(keys.schema[k].dataType) for k in on]), F.lit(KEY_SLOTS)).cast("int")
    counts = {r["s"]: r["count"] for r in keys.groupBy(slot.alias("s")).count().collect()}           # at most KEY_SLOTS rows
    lrows = left.select(*on, micros(F.col(left_time)).alias("_t"), F.struct(*left.columns).alias("_row"))
    many = range_count(left.sparkSession, ranges)
    hot = sorted(k for k, n in counts.items() if 2 * n * many > sum(counts.values()))                # over half a task's share
    part, crowded = F.lit(0).alias("_range"), slot.isin(hot)
    if hot:
        span = TimeRanges.of(lrows.where(crowded).select("_t"), "_t", many)
        part = F.when(crowded, span.column(F.col("_t"))).otherwise(F.lit(0)).alias("_range")
    kinds = {f.name: f.dataType for f in latest.schema}
    lrows = lrows.select(*on, part, "_t", F.lit(0 if strict else 2).alias("_side"), "_row", F.lit(None).cast(kinds["_value"]).alias("_value"))
    no_row = F.lit(None).cast(lrows.schema["_row"].dataType).alias("_row")
    rrows = latest.select(*on, part, "_t", F.lit(1).alias("_side"), no_row, "_value")

    merged = lrows.unionByName(rrows)
    if hot:
        # what holds when a range begins: of the summaries of a key's ranges, the last value before it
        summary = (rrows.where(crowded).select(*on, "_range", "_t", "_value")
                   .unionByName(lrows.where(crowded).select(*on, "_range", F.lit(None).cast("long").alias("_t"), "_value"))
                   .groupBy(*on, "_range").agg(F.max_by("_value", "_t").alias("_last")))
        before = Window.partitionBy(*on).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carried = summary.select(*on, "_range", F.last("_last", ignorenulls=True).over(before).alias("_value")).where("_value is not null").select(
            *on, "_range", F.lit(-(1 << 63)).cast("long").alias("_t"), F.lit(1).alias("_side"), no_row, "_value")
        merged = merged.unionByName(carried)

    here = Window.partitionBy(*on, "_range").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.withColumn("_found", F.last("_value", ignorenulls=True).over(here)).where("_row is not null")
    known = F.col("_t").isNotNull()
    if tolerance_us is not None:
        known = known & (F.col("_t") - micros(F.col("_found._at")) <= tolerance_us)
    found = F.when(known, F.col("_found"))
    return merged.select("_row.*", found["_at"].alias(right_time), *[found[f"v{i}"].alias(c) for i, c in enumerate(take)])


def interval_join(points: DataFrame, periods: DataFrame, on: list[str], at: str, start: str, end: str) -> DataFrame:
    """Pairs of a point and a period of its key with start <= at < end, each pair once.

    A key with few periods (at most FEW_PERIODS) has one bin: its points meet all of
    them. Else a period of d microseconds belongs to the level k with
    2^(k-1) < d <= 2^k and lies in one or two bins of that width, so a long period
    is two rows at most, and at least a quarter of its bins' width is its own; a
    point of such a key is in one bin of each level that the key has (at most 63).
    So a point of other keys is shuffled once, and candidates are bounded or in
    proportion to the matches; a hot bin is split by adaptive execution. Both
    sides are shuffled, whatever their size: a period becomes several rows and
    the smallest file may unpack to more than a driver holds.

    The periods are written under the checkpoint folder first (`session.discard_kept`).
    A period without an end has none; without a start, or ending before it
    begins, it holds nothing; nor do rows without a key or time match. Columns of
    the two sides must differ but for `on`.
    """
    keyed = lambda df: df.dropna(subset=on)
    s, e = F.col("_s"), F.col("_e")
    held = keyed(periods).withColumns({"_s": micros(F.col(start)), "_e": F.coalesce(micros(F.col(end)), F.lit(OPEN_END))}).where(s < e)
    # bits of (length - 1): the least k with 2^k >= length
    level = F.when(e - s == 1, F.lit(0)).otherwise(F.length(F.bin(e - s - 1))).cast("int")
    held, _ = keep(held.withColumn("_level", level), "periods")
    crowded, _ = keep(held.groupBy(*on).count().where(F.col("count") > FEW_PERIODS).select(*on), "crowded-keys")
    some = not crowded.isEmpty()
    marks = crowded.withColumn("_own", F.lit(True))
    own = held.join(marks.hint("merge") if some else marks, on, "left")
    placed = own.withColumn("_level", F.when(F.col("_own"), F.col("_level")).otherwise(F.lit(ONE_BIN))).drop("_own")
    binned = (placed.withColumns({"_first": F.expr("shiftright(_s, _level)"), "_last": F.expr("shiftright(_e - 1, _level)")})
              .withColumn("_bin", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last"))
    moment = keyed(points).withColumn("_p", micros(F.col(at))).where("_p is not null")
    leveled = moment.withColumn("_level", F.lit(ONE_BIN))
    if some:
        levels = held.join(crowded.hint("merge"), on, "left_semi").where(F.col("_level") < ONE_BIN).select(*on, "_level").distinct()
        leveled = leveled.unionByName(moment.join(levels.hint("merge"), on))
    binned_points = leveled.withColumn("_bin", F.expr("shiftright(_p, _level)"))
    pairs = binned_points.join(binned.hint("merge"), [*on, "_level", "_bin"]).where((F.col("_p") >= s) & (F.col("_p") < e))
    return pairs.drop("_level", "_bin", "_p", "_s", "_e")
