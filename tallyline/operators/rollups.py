"""Totals over several groupings at once, and moving totals over a calendar."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import keep


def cube_sets(dims: list[str]) -> list[list[str]]:
    return [list(c) for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def rollup_sets(dims: list[str]) -> list[list[str]]:
    return [dims[:n] for n in range(len(dims), -1, -1)]


def grouped_totals(rows: DataFrame, dims: list[str], sets: list[list[str]], sums: dict[str, Column], distinct: str) -> DataFrame:
    """One row per group of each grouping set: `dims` (null where a set has no such column), total_of_<dim> (1 where it
    has none, so a null key is told from a total), n, the `sums`, and the number of distinct values of `distinct`.

    Rows are combined to (dims, distinct value) first, and only that is expanded, once per set: the
    distinct count of a level is then a plain count of its values, with no second expansion, and a hot
    group is combined in the map tasks. An empty table yields no rows."""
    cells = rows.groupBy(*dims, distinct).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()])
    flags = [F.grouping(d).cast("int").alias(f"total_of_{d}") for d in dims]
    again = lambda c: F.sum(c).alias(c)
    values = cells.groupingSets([[F.col(c) for c in [*s, distinct]] for s in sets], *[F.col(c) for c in [*dims, distinct]]).agg(
        *flags, again("n"), *[again(k) for k in sums])
    return values.groupBy(*dims, *[f"total_of_{d}" for d in dims]).agg(
        again("n"), *[again(k) for k in sums], F.count(distinct).alias(f"distinct_{distinct}"))


def moving_totals(daily: DataFrame, keys: list[str], day: str, sums: list[str], days: int = 7, block_days: int = 64) -> DataFrame:
    """`keys`, `day`, the `sums` of that day (0 without rows) and moving_<sum> over the `days` days up to it, for every
    calendar day between the first and the last of the table and every key that occurs.

    `daily` holds at most one row per key and day. The calendar is cut into blocks of `block_days` days;
    a window runs inside a key's block, and the last days - 1 days of a block are copied into the
    next as its halo. So one long series is many tasks, and no task needs more than block_days + days
    rows of a key. Rows without a day are left out; null keys are a key.

    `daily` is read several times, so it is computed once and written under the checkpoint folder
    (`session.discard_kept`)."""
    seen, _ = keep(daily.where(F.col(day).isNotNull()).select(*keys, F.to_date(day).alias(day), *sums), "daily")
    first, last = seen.agg(F.min(day), F.max(day)).first()
    if first is None:
        return seen.select(*keys, day, *sums, *[F.col(c).alias(f"moving_{c}") for c in sums])
    number = F.unix_date(day)
    lo, hi = F.unix_date(F.lit(first)), F.unix_date(F.lit(last))
    block = F.floor((number - lo) / block_days).cast("int")
    # one row per key and block, opened to its days and the halo before them
    blocks = F.sequence(F.lit(0), F.floor((hi - lo) / block_days).cast("int"))
    start = lo + F.col("_block") * block_days
    frame = seen.select(*keys).distinct().withColumn("_block", F.explode(blocks)).select(
        *keys, "_block", F.explode(F.sequence(start - (days - 1), F.least(start + (block_days - 1), hi))).alias("_n"))
    opened = frame.where(F.col("_n") >= lo).select(
        *keys, "_block", F.date_from_unix_date("_n").alias(day), *[F.lit(0).cast(seen.schema[c].dataType).alias(c) for c in sums])
    own = seen.withColumn("_block", block)
    halo = own.withColumn("_block", F.col("_block") + 1).where(
        (number >= lo + F.col("_block") * block_days - (days - 1)) & (lo + F.col("_block") * block_days <= hi))
    rows = opened.unionByName(own).unionByName(halo).groupBy(*keys, "_block", day).agg(*[F.sum(c).alias(c) for c in sums])
    w = Window.partitionBy(*keys, "_block").orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    moved = rows.select("*", *[F.sum(c).over(w).alias(f"moving_{c}") for c in sums])
    return moved.where(F.unix_date(day) >= lo + F.col("_block") * block_days).drop("_block")
