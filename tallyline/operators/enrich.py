"""Enrichment (totals, run time, date parts, revenue class) and the
aggregations that read enriched rows (group aggregates, daily summary,
running totals)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.session import keep, remove
from tallyline.functions import exact_sum, line_total, mean_of, revenue_class, round2


@dataclass(frozen=True)
class EnrichConfig:
    add_total_amount: bool = True
    add_timestamp: bool = True
    add_date_parts: bool = False
    add_revenue_category: bool = False
    run_ts: datetime | None = None   # ingestion time for the run; None = now (UTC)

    def fields_added(self) -> list[str]:
        out = []
        if self.add_total_amount:
            out.append("total_amount")
        if self.add_timestamp:
            out.append("ingestion_timestamp")
        if self.add_date_parts:
            out.extend(S.DATE_PART_COLUMNS)
        if self.add_revenue_category:
            out.append("revenue_category")
        return out


def run_timestamp(run_ts: datetime | None = None) -> Column:
    """One timestamp value for the whole run (no time zone, like a naive UTC clock)."""
    ts = run_ts if run_ts is not None else datetime.now(timezone.utc)
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def enrich(df: DataFrame, cfg: EnrichConfig = EnrichConfig()) -> DataFrame:
    out = df
    if cfg.add_total_amount:
        out = out.withColumn("total_amount", line_total(F.col("quantity"), F.col("unit_price")))
    if cfg.add_timestamp:
        out = out.withColumn("ingestion_timestamp", run_timestamp(cfg.run_ts))
    if cfg.add_date_parts and "order_date" in out.columns:
        d = F.col("order_date")
        out = out.select(
            "*",
            F.year(d).alias("order_year"),
            F.month(d).alias("order_month"),
            F.dayofmonth(d).alias("order_day"),
            F.date_format(d, "EEEE").alias("order_weekday"),
        )
    if cfg.add_revenue_category and "total_amount" in out.columns:
        out = out.withColumn("revenue_category", revenue_class(F.col("total_amount")))
    return out


def enrichment_stats(enriched: DataFrame, cfg: EnrichConfig = EnrichConfig()) -> DataFrame:
    """Per source file: rows, fields added, total revenue and mean order value (2 decimals)."""
    keys = [S.SOURCE_FILE] if S.SOURCE_FILE in enriched.columns else []
    has_total = "total_amount" in enriched.columns
    total = exact_sum(F.col("total_amount")) if has_total else F.lit(0.0)
    agg = enriched.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), total.alias("_rev"))
    return agg.select(
        *keys,
        "row_count",
        F.lit(",".join(cfg.fields_added())).alias("fields_added"),
        round2(F.coalesce(F.col("_rev"), F.lit(0.0))).alias("total_revenue"),
        round2(F.coalesce(mean_of(F.col("_rev"), F.col("row_count")), F.lit(0.0))).alias("avg_order_value"),
    )


AGG_COLUMNS = [
    "total_orders", "total_units", "total_revenue", "avg_order_value",
    "min_order", "max_order", "unique_customers",
]


def compute_aggregates(df: DataFrame, by: str = "country") -> DataFrame:
    """Per value of ``by`` (null keys dropped): orders, units, revenue, mean,
    min, max, distinct customers; money rounded to 2. Unknown column -> empty."""
    if by not in df.columns:
        schema = f"`{by}` string, total_orders long, total_units long, total_revenue double, " \
                 "avg_order_value double, min_order double, max_order double, unique_customers long"
        return df.sparkSession.createDataFrame([], schema)
    t = F.col("total_amount")
    agg = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").cast("long").alias("total_units"),
        exact_sum(t).alias("_rev"),
        F.count(t).alias("_n"),
        F.min(t).alias("_min"),
        F.max(t).alias("_max"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return agg.select(
        by,
        "total_orders",
        "total_units",
        round2(F.col("_rev")).alias("total_revenue"),
        round2(mean_of(F.col("_rev"), F.col("_n"))).alias("avg_order_value"),
        round2(F.col("_min")).alias("min_order"),
        round2(F.col("_max")).alias("max_order"),
        "unique_customers",
    ).orderBy(by)


def daily_summary(df: DataFrame) -> DataFrame:
    """Per calendar date (null dates dropped): orders, revenue, units, customers."""
    d = F.to_date(F.col("order_date"))
    return (
        df.where(d.isNotNull())
        .groupBy(d.alias("date"))
        .agg(
            F.count("order_id").alias("orders"),
            round2(exact_sum(F.col("total_amount"))).alias("revenue"),
            F.sum("quantity").cast("long").alias("units"),
            F.countDistinct("customer_id").alias("customers"),
        )
        .orderBy("date")
    )


def running_totals(
    df: DataFrame,
    date_column: str = "order_date",
    tie_keys: tuple[str, ...] = ("order_id", S.SOURCE_FILE),
    partitions: int | None = None,
) -> DataFrame:
    """Cumulative revenue and order count in date order, one output row per input row.

    A distributed prefix scan, never one partition for all rows:
      1. range-partition on the full sort key (date, tie keys); a date with a
         third of all rows spans many partitions;
      2. keep the rows with their partition number, so both passes see the same
         (and before it, so that the sampling of the ranges reads a table);
      3. per-partition sums -> exclusive offsets (a row per partition, a table);
      4. a window inside each partition plus its offset.
    Money is summed as integer cents, so the result does not depend on order
    of addition. Null dates sort last; null totals add nothing.
    """
    if date_column not in df.columns:
        return df
    spark = df.sparkSession
    ties = [k for k in tie_keys if k in df.columns]
    order = [F.col(date_column).asc_nulls_last()] + [F.col(k).asc_nulls_last() for k in ties]
    if partitions is None:
        conf = spark.conf.get("spark.sql.shuffle.partitions")
        partitions = int(conf) if str(conf).isdigit() else spark.sparkContext.defaultParallelism
    cents = F.coalesce(F.round(F.col("total_amount") * F.lit(100)).cast("long"), F.lit(0).cast("long"))
    # kept before the range partitioning, whose sampling would compute the rows a second time
    rows, rows_path = keep(df.withColumn("_cents", cents), "running-input")
    ordered, _ = keep(rows.repartitionByRange(partitions, *order).withColumn("_pid", F.spark_partition_id()), "running-rows")
    remove(spark, rows_path)
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)     # over a row per partition
    sums = ordered.groupBy("_pid").agg(F.sum("_cents").alias("c"), F.count(F.lit(1)).alias("n"))
    offsets, _ = keep(sums.select("_pid", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_c0"),
                                  F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n0")), "running-offsets")
    here = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ordered.join(offsets, "_pid").select(
        *df.columns,
        ((F.sum("_cents").over(here) + F.col("_c0")) / F.lit(100.0)).cast("double").alias("running_revenue"),
        (F.count(F.lit(1)).over(here) + F.col("_n0")).cast("long").alias("running_orders"))
