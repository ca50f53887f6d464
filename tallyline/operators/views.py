"""The analytics views kept up to date by what a load changes, without reading the table.

Sums can be corrected by adding and subtracting; distinct customers and first and
last dates cannot, once rows go away. So the state of a view holds, per group,
how many rows each customer and each date has (the support), and the sums by
date. A load brings the rows it removed or replaced and the rows it added: both
are counted, old with a minus, and added to the support of the groups they
touch. A customer or date whose count falls to zero is gone. Other groups are
neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import hadoop_fs, keep, remove

BUCKET = "bucket"
STATE = ["kind", "member", "n", "units", "revenue"]
SUMS = "n long, units long, revenue decimal(28,2)"


def signed_support(rows: DataFrame, key: str, sign: int) -> DataFrame:
    """key, kind (customer or date), member, and the signed sums, of table rows."""
    zero = F.lit(0).cast("long")
    of = lambda kind, member, units, revenue: F.struct(F.lit(kind).alias("kind"), F.col(member).cast("string").alias("member"),
                                                       units.cast("long").alias("units"), revenue.cast("decimal(28,2)").alias("revenue"))
    both = F.explode(F.array(of("customer", "customer_id", zero, zero), of("date", "order_date", F.col("quantity"), F.col("total_amount"))))
    return rows.select(F.col(key).alias("key"), both.alias("x")).groupBy("key", "x.kind", "x.member").agg(
        (F.count(F.lit(1)) * sign).alias("n"), (F.sum("x.units") * sign).cast("long").alias("units"),
        (F.sum("x.revenue") * sign).cast("decimal(28,2)").alias("revenue"))


def _added_up(state: DataFrame) -> DataFrame:
    rest = [c for c in state.columns if c not in ("n", "units", "revenue")]
    return state.groupBy(*rest).agg(F.sum("n").alias("n"), F.sum("units").cast("long").alias("units"),
                                    F.sum("revenue").cast("decimal(28,2)").alias("revenue"))


def change(removed: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """What a load changes in the support; groups it does not change are not in it."""
    both = signed_support(removed, key, -1).unionByName(signed_support(added, key, 1))
    return _added_up(both).where("n <> 0 or units <> 0 or revenue <> 0")


def view_of(state: DataFrame, key: str) -> DataFrame:
    """The groups that have rows: orders, units, revenue, mean, distinct customers, first and last date."""
    dates = F.col("kind") == "date"
    day = F.when(dates, F.col("member"))
    n = F.sum(F.when(dates, F.col("n")))
    out = state.groupBy("key").agg(
        n.alias("total_orders"), F.sum(F.when(dates, F.col("units"))).alias("total_units"), F.sum(F.when(dates, F.col("revenue"))).alias("_r"),
        F.count_if((F.col("kind") == "customer") & F.col("member").isNotNull()).alias("unique_customers"),
        F.min(day).cast("date").alias("first_order_date"), F.max(day).cast("date").alias("last_order_date"))
    return out.where("total_orders > 0").select(
        F.col("key").alias(key), "total_orders", "total_units", F.col("_r").cast("double").alias("total_revenue"),
        (F.col("_r").cast("double") / F.col("total_orders").cast("double")).alias("avg_order_value"),
        "unique_customers", "first_order_date", "last_order_date")


class MaintainedView:
    """The support of one view as a Parquet table in buckets of its groups.

    `apply` reads and writes the buckets of the groups that a load touches, by
    Spark's dynamic partition overwrite. Loads are numbered; each bucket states
    the last one it took (in a row of kind `mark`), so a load that is repeated
    after a failure is taken by just those buckets that lack it."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str = "string", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = f"key {key_type}, kind string, member string, {SUMS}, applied long, {BUCKET} int"

    def state(self) -> DataFrame:
        p, fs = hadoop_fs(self.spark, self.path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def read(self) -> DataFrame:
        return view_of(self.state().where("kind <> 'mark'").select("key", *STATE), self.key)

    def apply(self, removed: DataFrame, added: DataFrame, load: int) -> int:
        """Take a load's old and new rows; returns the number of buckets written."""
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        delta, delta_path = keep(change(removed, added, self.key).withColumn(BUCKET, bucket), "view-change")
        touched = {r[0] for r in delta.select(BUCKET).distinct().collect()}                     # at most the bucket count
        stored = self.state().where(F.col(BUCKET).isin(sorted(touched)))
        done = {r[0] for r in stored.where((F.col("kind") == "mark") & (F.col("applied") >= load)).select(BUCKET).collect()}
        pending = sorted(touched - done)
        if pending:
            part = F.col(BUCKET).isin(pending)
            rows = stored.where(part & (F.col("kind") != "mark")).drop("applied").unionByName(delta.where(part))
            merged = _added_up(rows).where("n <> 0")
            # every bucket written has its mark, so that one left without groups is overwritten too
            marks = self.spark.range(1).select(F.explode(F.array(*map(F.lit, pending))).alias(BUCKET)).select(
                F.lit(None).cast(self.state().schema["key"].dataType).alias("key"), F.lit("mark").alias("kind"), F.lit(None).cast("string").alias("member"),
                F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("units"), F.lit(0).cast("decimal(28,2)").alias("revenue"), BUCKET)
            new, new_path = keep(merged.unionByName(marks).withColumn("applied", F.lit(load).cast("long")), "view-state")
            (new.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path))
            remove(self.spark, new_path)
        remove(self.spark, delta_path)
        return len(pending)
