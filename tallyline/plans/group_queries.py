"""Registered queries over several groupings, bags of rows and moving windows.

`sales` is the table after a whole run; the catalog passes it in."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators import bags
from tallyline.operators.rollups import cube_sets, grouped_totals, moving_totals, rollup_sets

BAG_COLUMNS = ["product_name", "quantity", "country"]
CUBE = ["country", "product_name", "month"]


def sales_cube(sales):
    rows = sales.withColumn("month", F.date_format("order_date", "yyyy-MM"))
    out = grouped_totals(rows, CUBE, cube_sets(CUBE), {"units": F.sum("quantity"), "revenue": F.sum("total_amount")}, "customer_id")
    return out.select(*CUBE, *[f"total_of_{d}" for d in CUBE], F.col("n").alias("orders"), "units",
                      F.col("revenue").cast("double").alias("revenue"), F.col("distinct_customer_id").alias("customers"))


def raw_rollup(raw):
    """Raw rows by file and country spelling: here keys are null themselves."""
    out = grouped_totals(raw, ["source_file", "country"], rollup_sets(["source_file", "country"]), {}, "customer_id")
    return out.withColumnsRenamed({"n": "rows", "distinct_customer_id": "customers"})


def bag_sides(raw):
    """The raw rows of the even and the odd files, without what tells two equal sales apart."""
    number = F.element_at(F.split("source_file", "-"), 2).cast("int") % 2
    return raw.where(number == 0).select(*BAG_COLUMNS), raw.where(number == 1).select(*BAG_COLUMNS)


def load_except_all(raw):
    return bags.except_all(*bag_sides(raw))


def load_intersect_all(raw):
    return bags.intersect_all(*bag_sides(raw))


def load_changes(raw):
    return bags.bag_changes(*bag_sides(raw))


def _moving(sales, keys):
    daily = sales.groupBy(*keys, "order_date").agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    out = moving_totals(daily, keys, "order_date", ["revenue", "orders"])
    return out.select(*keys, "order_date", F.col("revenue").cast("double").alias("revenue"), "orders",
                      F.col("moving_revenue").cast("double").alias("revenue_7d"), F.col("moving_orders").alias("orders_7d"))


def revenue_7d(sales):
    return _moving(sales, [])


def country_revenue_7d(sales):
    return _moving(sales, ["country"])


ON_SALES = {"sales_cube": sales_cube, "revenue_7d": revenue_7d, "country_revenue_7d": country_revenue_7d}
ON_RAW = {"raw_rollup": raw_rollup, "load_except_all": load_except_all, "load_intersect_all": load_intersect_all, "load_changes": load_changes}


def _bag(odd: int) -> str:
    return f"SELECT {', '.join(BAG_COLUMNS)} FROM raw WHERE CAST(split_part(source_file, '-', 2) AS INTEGER) % 2 = {odd}"


def _moving_sql(keys: list[str]) -> str:
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    every = f"(SELECT DISTINCT {', '.join(keys)} FROM daily) CROSS JOIN" if keys else ""
    on = " AND ".join(["d.order_date = c.order_date", *[f"d.{x} IS NOT DISTINCT FROM c.{x}" for x in keys]])
    ck = "".join(f"c.{c}, " for c in keys)
    w = f"OVER ({part} ORDER BY order_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"
    return f"""daily AS (SELECT {k}order_date, sum(total_amount) AS revenue, count(*) AS orders FROM sales GROUP BY {k}order_date),
days AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date FROM daily),
cal AS (SELECT {k}order_date FROM {every} days),
filled AS (SELECT {ck}c.order_date, coalesce(d.revenue, 0) AS revenue, coalesce(d.orders, 0) AS orders FROM cal c LEFT JOIN daily d ON {on})
SELECT {k}order_date, CAST(revenue AS DOUBLE) AS revenue, orders, CAST(sum(revenue) {w} AS DOUBLE) AS revenue_7d,
  CAST(sum(orders) {w} AS BIGINT) AS orders_7d FROM filled"""


SALES_SQL = {
    "sales_cube": f"""rows AS (SELECT *, strftime(order_date, '%Y-%m') AS month FROM sales)
SELECT {', '.join(CUBE)}, {', '.join(f'CAST(GROUPING({d}) AS INTEGER) AS total_of_{d}' for d in CUBE)}, count(*) AS orders,
  CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(total_amount) AS DOUBLE) AS revenue, count(DISTINCT customer_id) AS customers
FROM rows GROUP BY CUBE ({', '.join(CUBE)}) HAVING count(*) > 0""",
    "revenue_7d": _moving_sql([]),
    "country_revenue_7d": _moving_sql(["country"]),
}
RAW_SQL = {
    "raw_rollup": """SELECT source_file, country, CAST(GROUPING(source_file) AS INTEGER) AS total_of_source_file,
  CAST(GROUPING(country) AS INTEGER) AS total_of_country, count(*) AS rows, count(DISTINCT customer_id) AS customers
FROM raw GROUP BY ROLLUP (source_file, country) HAVING count(*) > 0""",
    "load_except_all": f"{_bag(0)} EXCEPT ALL {_bag(1)}",
    "load_intersect_all": f"{_bag(0)} INTERSECT ALL {_bag(1)}",
    "load_changes": f"""SELECT {', '.join(BAG_COLUMNS)}, CAST(greatest(0, a - b) AS BIGINT) AS removed, CAST(greatest(0, b - a) AS BIGINT) AS added FROM (
  SELECT {', '.join(BAG_COLUMNS)}, sum(a) AS a, sum(1 - a) AS b FROM (SELECT *, 1 AS a FROM ({_bag(0)}) UNION ALL SELECT *, 0 FROM ({_bag(1)}))
  GROUP BY {', '.join(BAG_COLUMNS)}) WHERE a <> b""",
}
