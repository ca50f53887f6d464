"""Set operations that respect how often a row occurs, by signed counts.

Both tables are counted in one aggregate, +1 and -1 per row, combined in the map
tasks: a row with very many copies is one row per task before the shuffle, and
no whole rows are sorted (the counts are longs, so the aggregate is a hash
aggregate). Nulls are equal to nulls. Columns are matched by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bag_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each distinct row of either table with n_old and n_new, its copies there."""
    cols = old.columns
    if set(cols) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(cols) ^ set(new.columns))}")
    one = lambda df, a, b: df.select(*cols, F.lit(a).alias("_a"), F.lit(b).alias("_b"))
    return one(old, 1, 0).unionByName(one(new, 0, 1)).groupBy(*cols).agg(F.sum("_a").alias("n_old"), F.sum("_b").alias("n_new"))


def _copies(rows: DataFrame, cols: list[str], n) -> DataFrame:
    """Each row n times. The copies are made in slices, so that a row with very many is spread over tasks."""
    size = 1_000_000
    slices = rows.select(*cols, n.alias("_n")).where("_n > 0").withColumn(
        "_s", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / size))))
    left = F.least(F.lit(size).cast("long"), F.col("_n") - F.col("_s") * size)
    return slices.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), left))).select(*cols)


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of `left` without as many copies as `right` has."""
    return _copies(bag_counts(left, right), left.columns, F.col("n_old") - F.col("n_new"))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, as often as the table has them that has fewer."""
    return _copies(bag_counts(left, right), left.columns, F.least("n_old", "n_new"))


def bag_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What changed between two loads: each distinct row whose number of copies differs, with `removed` and `added`."""
    n = bag_counts(old, new).where("n_old <> n_new")
    zero = F.lit(0).cast("long")
    return n.select(*old.columns, F.greatest(zero, F.col("n_old") - F.col("n_new")).alias("removed"),
                    F.greatest(zero, F.col("n_new") - F.col("n_old")).alias("added"))
