"""The keyed sales table: constraint gate, upsert by ``order_id``, delete by
date, load counts.

A load is one plan: gate the rows, keep the latest accepted one per key, join
them with the table (full outer, on the key) and write the outcome as a new
Parquet folder. One small file names the folder that is the table; moving it is
the last step of a load.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyline import schema as S
from tallyline.functions import as_price, as_total
from tallyline.operators.enrich import run_timestamp
from tallyline.session import hadoop_fs, keep, remove

GATE_REASON = "gate_reason"
KEY_BUCKET = "key_bucket"
DEFAULT_BUCKETS = 64

_NOT_NULL = ["order_id", "product_name", "quantity", "unit_price", "order_date",
             "customer_id", "country", "total_amount"]
_MAX_LEN = [("order_id", S.ORDER_ID_MAX_LEN), ("product_name", S.PRODUCT_MAX_LEN),
            ("customer_id", S.CUSTOMER_ID_MAX_LEN), ("country", S.COUNTRY_MAX_LEN)]


def to_table_types(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Enriched rows in stored types: money as decimals, date as date, the
    ingestion time defaulted when absent. Lineage columns are kept."""
    ts = F.col("ingestion_timestamp") if "ingestion_timestamp" in df.columns else F.lit(None)
    typed = {
        "order_id": F.col("order_id").cast("string"),
        "product_name": F.col("product_name").cast("string"),
        "quantity": F.col("quantity").try_cast("int"),
        "unit_price": as_price(F.col("unit_price")),
        "order_date": F.to_date(F.col("order_date")),
        "customer_id": F.col("customer_id").cast("string"),
        "country": F.col("country").cast("string"),
        "total_amount": as_total(F.col("total_amount")),
        "ingestion_timestamp": F.coalesce(ts.cast("timestamp_ntz"), run_timestamp(run_ts)),
    }
    lineage = [c for c in (S.SOURCE_FILE, S.ROW_ORDINAL) if c in df.columns]
    return df.select(*lineage, *[typed[c].alias(c) for c in S.TABLE_COLUMNS])


def gate_reason(raw_price: Column | None = None, raw_total: Column | None = None) -> Column:
    """First table constraint a typed row breaks, or null."""
    expr = None

    def add(cond, text):
        nonlocal expr
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))

    for c in _NOT_NULL:
        add(F.col(c).isNull(), f"not_null:{c}")
    for c, n in _MAX_LEN:
        add(F.char_length(F.col(c)) > n, f"too_long:{c}")
    add(F.col("quantity") <= 0, "quantity_not_positive")
    add(F.col("unit_price") <= 0, "price_not_positive")
    exact = F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")
    add(F.col("total_amount") != exact, "total_mismatch")
    return expr.cast("string")


def load_gate(enriched: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Typed rows with ``gate_reason`` (null = accepted). A price or total that
    does not fit its decimal type reads as null and fails not-null."""
    typed = to_table_types(enriched, run_ts)
    return typed.withColumn(GATE_REASON, gate_reason())


def latest_accepted(gated: DataFrame, order: list[Column], key: str = "order_id") -> DataFrame:
    """Latest accepted row per key from gated rows (rejected rows never win).

    Acceptance leads the window order and the filter comes after the window:
    a filter on ``gate_reason`` below the window would be pushed through the
    projections and re-evaluate every cleaning expression inside it."""
    ok = F.col(GATE_REASON).isNull()
    w = Window.partitionBy(key).orderBy(ok.desc(), *order)
    return (gated.withColumn("_rn", F.row_number().over(w))
            .where((F.col("_rn") == 1) & ok)
            .drop("_rn", GATE_REASON))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def latest_order(df: DataFrame) -> list[Column] | None:
    """Last file, then last row of the file: a total order where the lineage columns are there."""
    cols = [c for c in (S.SOURCE_FILE, S.ROW_ORDINAL) if c in df.columns]
    return [F.col(c).desc() for c in cols] if len(cols) == 2 else None


@dataclass
class LoadResult:
    success: bool
    rows_inserted: int
    rows_updated: int
    rows_failed: int
    rejects: DataFrame | None = None     # every refused row with its reason; None when there is none
    seconds: float = 0.0

    @property
    def total_processed(self) -> int:
        return self.rows_inserted + self.rows_updated

    @property
    def rows_per_second(self) -> float:
        return self.total_processed / self.seconds if self.seconds else 0.0

    def failed_order_ids(self) -> DataFrame:
        return self.rejects.select("order_id")


class KeyedSalesTable:
    """Parquet table keyed by ``order_id``: a folder per load, and a file that names the current one.

    Rows lie in partitions by a hash of the key (``key_bucket``), so a point
    lookup reads one of them. A load writes the whole table anew beside the old
    one and then moves the name; a stop before that changes nothing for readers,
    and the load repeated starts from the same state. The folder before the
    current one stays for readers that still use it; the one before that is
    removed. Loads run one after the other, as the scheduled run does: a writer
    that finds the name moved since it began fails and changes nothing.

    The bucket count belongs to the stored table; the argument only counts for a
    new one. `rows_per_file` sets how many tasks write one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS, rows_per_file: int = 5_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.rows_per_file = rows_per_file
        named = self.current()
        self.buckets = int(named[1]) if named else buckets

    # -- the current folder --------------------------------------------------
    def current(self) -> tuple[str, str, str] | None:
        """(folder, bucket count, folder before it); None for a table never written."""
        p, fs = hadoop_fs(self.spark, f"{self.path}/CURRENT")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return tuple(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split(","))
        finally:
            stream.close()

    def _commit(self, before: tuple | None, folder: str) -> None:
        """Make `folder` the table: a file of the new name replaces the old one in one rename."""
        if self.current() != before:
            raise RuntimeError(f"another writer has changed {self.path}")
        old = before[0] if before else ""
        temp, fs = hadoop_fs(self.spark, f"{self.path}/.{uuid.uuid4().hex}")
        out = fs.create(temp, True)
        out.write(bytearray(f"{folder},{self.buckets},{old}".encode()))
        out.close()
        jvm = self.spark._jvm
        replace = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("OVERWRITE")
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = replace
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), conf).rename(
            temp, hadoop_fs(self.spark, f"{self.path}/CURRENT")[0], options)
        if before and before[2]:
            remove(self.spark, f"{self.path}/{before[2]}")

    # -- reading ---------------------------------------------------------------
    def exists(self) -> bool:
        return self.current() is not None

    def read(self, with_bucket: bool = False) -> DataFrame:
        named = self.current()
        if named is None:
            df = self.spark.createDataFrame([], self._schema())
        else:
            df = self.spark.read.schema(self._schema()).parquet(f"{self.path}/{named[0]}")
        return df if with_bucket else df.drop(KEY_BUCKET)

    @staticmethod
    def _schema() -> StructType:
        return StructType([*S.TABLE_SCHEMA.fields, StructField(KEY_BUCKET, IntegerType())])

    def has_order(self, order_id: str) -> bool:
        """Point lookup reading one bucket."""
        rows = self.read(with_bucket=True)
        return not rows.where((F.col(KEY_BUCKET) == bucket_of(F.lit(order_id), self.buckets)) & (F.col("order_id") == order_id)).isEmpty()

    def has_orders(self, probe: DataFrame, key: str = "order_id") -> DataFrame:
        """For each probe id: does the table hold it?"""
        held = self.read().select(F.col("order_id").alias("_k"), F.lit(True).alias("_hit"))
        return probe.select(key).join(held, F.col(key) == F.col("_k"), "left").select(
            key, F.coalesce("_hit", F.lit(False)).alias("order_exists"))

    # -- writing ---------------------------------------------------------------
    def _write(self, df: DataFrame, rows: int) -> str:
        """The rows as a new folder; a large bucket is written by several tasks.

        Each slice of a bucket has a task of its own; dealt by a hash of the two, some tasks had several
        buckets, for which the load waited, and others none."""
        folder = f"load-{uuid.uuid4().hex}"
        slices = max(1, math.ceil(rows / self.buckets / self.rows_per_file))
        part = F.pmod(F.xxhash64(F.col("order_id"), F.lit("slice")), F.lit(slices))
        (df.withColumn(KEY_BUCKET, bucket_of(F.col("order_id"), self.buckets))
         .repartitionById(self.buckets * slices, (F.col(KEY_BUCKET) * slices + part).cast("int"))
         .sortWithinPartitions(KEY_BUCKET, "order_date", "country")
         .write.partitionBy(KEY_BUCKET).parquet(f"{self.path}/{folder}"))
        return folder

    def upsert(self, enriched: DataFrame, seq: list[Column] | None = None,
               run_ts: datetime | None = None, atomic: bool = False) -> LoadResult:
        """Gate the rows, keep the latest accepted one per key, merge it into the table.

        ``seq`` orders the versions of a key, latest first; the default is the
        last row of the last file. Without ``seq`` and lineage columns a key may
        occur once only. ``atomic`` loads nothing if any row is refused. The kept
        rows (also those of `rejects`) go with `session.discard_kept`."""
        began = time.monotonic()
        before = self.current()
        gated, _ = keep(load_gate(enriched, run_ts), "upsert-gated")
        ok = F.col(GATE_REASON).isNull()
        n_ok, n_bad = gated.agg(F.count_if(ok), F.count_if(~ok)).first()
        rejects = gated.where(~ok) if n_bad else None
        result = lambda i, u: LoadResult(not n_bad, i, u, n_bad, rejects, time.monotonic() - began)
        if n_ok == 0 or (atomic and n_bad):
            return result(0, 0)
        order = seq or latest_order(gated)
        if order is None:
            if not gated.where(ok).groupBy("order_id").count().where("count > 1").isEmpty():
                raise ValueError("a key occurs more than once and nothing orders its rows: give seq, or source_file and row_ordinal")
            order = [F.lit(1)]
        new = latest_accepted(gated, order)
        both = self.read().select("order_id", F.struct(*S.TABLE_COLUMNS).alias("_old")).join(
            new.select("order_id", F.struct(*S.TABLE_COLUMNS).alias("_new")), "order_id", "full")
        counts = Observation()                    # taken while the rows are written
        added, changed = F.col("_old").isNull(), F.col("_old").isNotNull() & F.col("_new").isNotNull()
        merged = both.observe(counts, F.count_if(added).alias("inserted"), F.count_if(changed).alias("updated"))
        held = self.read().count() if before else 0
        folder = self._write(merged.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*"), held + n_ok)
        got = counts.get
        self._commit(before, folder)
        return result(got["inserted"], got["updated"])

    def delete_before(self, before: date | datetime) -> int:
        """Delete rows with order_date < before (strict); nothing is written if there is none."""
        named = self.current()
        if named is None:
            return 0
        old = F.coalesce(F.col("order_date") < F.lit(before.date() if isinstance(before, datetime) else before), F.lit(False))
        n, gone = self.read().agg(F.count("*"), F.count_if(old)).first()
        if gone:
            self._commit(named, self._write(self.read().where(~old), n - gone))
        return gone


def merge(target: DataFrame, incoming: DataFrame, key: str = "order_id") -> DataFrame:
    """Upsert as a plan: target rows whose key is not incoming, plus incoming
    (already one row per key). All columns of a matched key are replaced."""
    return target.join(incoming.select(key), key, "left_anti").unionByName(incoming.select(*target.columns))
