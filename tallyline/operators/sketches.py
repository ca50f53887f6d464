"""Distinct counts and quantiles from sketches that merge across days.

A day's rows leave one small sketch of the customers (HyperLogLog, at most
2^lg_k bytes or so) and one of the order values (KLL, a few KB) per key. Any
longer span is the union of its days' sketches: it never reads the orders again
and moves a few KB per day and key, where an exact distinct count shuffles every
(key, customer) pair. Both kinds merge in the map tasks, so a hot key is one
sketch per task.

Errors: the distinct count's relative standard error is 1.04 / sqrt(2^lg_k),
1.6 % for lg_k = 12; a quantile's rank is off by at most 1.7 % of all rows with
99 % confidence for the default KLL size. `DISTINCT_BOUND` (three standard
errors) and `RANK_BOUND` are what the queries and tests hold results against.
Nulls count neither as customers nor as values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
DISTINCT_BOUND = 3 * 1.04 / math.sqrt(1 << LG_K)
RANK_BOUND = 0.025
QUANTILES = {"p50": 0.5, "p90": 0.9}


def day_sketches(sales: DataFrame, keys: list[str], day: str = "order_date", distinct: str = "customer_id", value: str = "total_amount",
                 lg_k: int = LG_K) -> DataFrame:
    """`day`, `keys`, n, and the sketches `who` and `how_much` of the day's rows: what a load stores."""
    return sales.groupBy(day, *keys).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col(distinct).cast("string"), lg_k).alias("who"),
        F.kll_sketch_agg_double(F.col(value).cast("double")).alias("how_much"))


def merged(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """The sketches of coarser groups, from stored ones. Merging merged ones again stays within the same bounds."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("who").alias("who"), F.kll_merge_agg_double("how_much").alias("how_much"))


def estimates(sketches: DataFrame) -> DataFrame:
    """The groups with n, distinct and the quantiles of QUANTILES instead of sketches."""
    group = [c for c in sketches.columns if c not in ("n", "who", "how_much")]
    has = F.kll_sketch_get_n_double("how_much") > 0
    return sketches.select(*group, "n", F.hll_sketch_estimate("who").alias("distinct"), *[
        F.when(has, F.kll_sketch_get_quantile_double("how_much", F.lit(q))).alias(name) for name, q in QUANTILES.items()])


def held_to_exact(sales: DataFrame, estimated: DataFrame, by: str, distinct: str = "customer_id", value: str = "total_amount") -> DataFrame:
    """`by`, n, and for the distinct count and each quantile whether it lies within its bound of the exact figures."""
    x = F.col(value).cast("double")
    near = sales.join(estimated.select(by, *QUANTILES), by)
    ranks = [f(n).alias(f"_{n}_{side}") for n in QUANTILES for side, f in (
        ("lo", lambda n: F.count_if(x < F.col(n)) / F.count(x)), ("hi", lambda n: F.count_if(x <= F.col(n)) / F.count(x)))]
    exact = near.groupBy(by).agg(F.countDistinct(distinct).alias("_exact"), *ranks)
    ok = [((F.col(f"_{n}_lo") <= q + RANK_BOUND) & (F.col(f"_{n}_hi") >= q - RANK_BOUND)).alias(f"{n}_within") for n, q in QUANTILES.items()]
    # below 2 customers of difference no relative bound makes sense
    off = F.abs(F.col("distinct") - F.col("_exact"))
    return estimated.join(exact, by).select(by, "n", (off <= F.greatest(F.lit(2.0), F.col("_exact") * DISTINCT_BOUND)).alias("distinct_within"), *ok)
