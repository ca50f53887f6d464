"""Synthetic sales rows with controlled faults, as a Spark job.

Every value is a hash of (row id, seed, purpose), so the rows are the same
for one seed at any partition count and any cluster size.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schema as S

# An invented catalogue (name, unit price); no result depends on it.
PRODUCTS = [
    ("Oak Desk", 489.0), ("Reading Lamp", 34.5), ("Wool Rug", 219.0), ("Bookshelf", 149.9), ("Floor Mirror", 99.0),
    ("Cork Board", 18.75), ("Linen Curtain", 62.4), ("Copper Kettle", 54.0), ("Garden Bench", 310.0),
]
COUNTRIES = [c for c in S.VALID_COUNTRIES if c != S.DEFAULT_COUNTRY][:15]
FIRST_ORDER = 1001
DAYS_BACK = 90


def _h(seed: int, purpose: str, *cols: Column) -> Column:
    return F.xxhash64(*cols, F.lit(seed), F.lit(purpose))


def _pick(h: Column, n: int) -> Column:
    return F.pmod(h, F.lit(n)).cast("int")


def _unit(h: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.pmod(h, F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)


def synthetic_sales(spark: SparkSession, n: int, error_rate: float = 0.05, seed: int = 42,
                    anchor: date | None = None, partitions: int | None = None) -> DataFrame:
    """n orders, faults at ``error_rate``, then int(n * error_rate * 0.5) copies
    of random orders with another quantity (only if n > 10). All text columns."""
    anchor = anchor or date.today()
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    i = F.col("id")
    prod = _pick(_h(seed, "product", i), len(PRODUCTS))
    names = F.array(*[F.lit(p) for p, _ in PRODUCTS])
    prices = F.array(*[F.lit(f"{v:.2f}") for _, v in PRODUCTS])
    countries = F.array(*[F.lit(c) for c in COUNTRIES])
    base = ids.select(
        i,
        F.concat(F.lit("ORD-"), F.format_string("%06d", i + FIRST_ORDER)).alias("order_id"),
        F.element_at(names, prod + 1).alias("product_name"),
        (_pick(_h(seed, "qty", i), 10) + 1).cast("string").alias("quantity"),
        F.element_at(prices, prod + 1).alias("unit_price"),
        F.date_format(F.date_sub(F.lit(anchor), _pick(_h(seed, "day", i), DAYS_BACK + 1)), "yyyy-MM-dd").alias("order_date"),
        F.concat(F.lit("CUST-"), (_pick(_h(seed, "cust", i), 90000) + 10000).cast("string")).alias("customer_id"),
        F.element_at(countries, _pick(_h(seed, "country", i), len(COUNTRIES)) + 1).alias("country"),
        (_unit(_h(seed, "err", i)) < F.lit(error_rate)).alias("_err"),
        _pick(_h(seed, "kind", i), 8).alias("_kind"),
        (_pick(_h(seed, "neg", i), 10) + 1).alias("_neg"),
    )
    k, e = F.col("_kind"), F.col("_err")

    def fault(col: str, *cases: tuple[int, Column]) -> Column:
        out = F.col(col)
        for kind, value in cases:
            out = F.when(e & (k == kind), value).otherwise(out)
        return out.alias(col)

    rows = base.select(
        "id",
        "order_id",
        fault("product_name", (4, F.concat(F.lit("  "), F.col("product_name"), F.lit("  ")))),
        fault("quantity", (0, F.lit("")), (1, F.concat(F.lit("-"), F.col("_neg").cast("string")))),
        fault("unit_price", (5, F.lit("0"))),
        fault("order_date", (2, F.lit("invalid-date"))),
        fault("customer_id", (3, F.lit(""))),
        fault("country", (6, F.replace(F.col("country"), F.lit(" "), F.lit("  "))), (7, F.lit(""))),
    )
    n_dup = int(n * error_rate * 0.5) if (error_rate > 0 and n > 10) else 0
    if n_dup == 0:
        return rows
    # Copies: row n+j takes a hashed source row and a new quantity 1..5.
    picks = spark.range(n_dup).select(
        (F.col("id") + n).alias("copy_id"),
        F.pmod(_h(seed, "dup", F.col("id")), F.lit(n)).alias("src"),
        (_pick(_h(seed, "dupqty", F.col("id")), 5) + 1).cast("string").alias("new_qty"),
    )
    copies = picks.join(rows, picks.src == rows.id).select(
        F.col("copy_id").alias("id"), "order_id", "product_name", F.col("new_qty").alias("quantity"),
        "unit_price", "order_date", "customer_id", "country",
    )
    return rows.unionByName(copies)
