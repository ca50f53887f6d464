"""Raw sales rows derived from the star-schema test tables.

One raw row per line item, every data column as text, with faults placed by
integer rules on the keys so any engine derives the same rows. The rules are
test-fixture values, stated once here (and mirrored in SQL by
``tallyline.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.session import keep

# ---------------------------------------------------------------------------
# Fixed fixture values.
# ---------------------------------------------------------------------------
FILES = 4                       # source_file = 'part-' || l_suppkey % 4
NULL_ID_FILE = 3                # ids nulled in this file when l_orderkey % 500 = 0
NULL_ID_EVERY = 500
BAD_ID_EVERY = 211              # 'BAD-<key>'
EMPTY_PRODUCT_EVERY = 13        # l_partkey
PADDED_PRODUCT_EVERY = 11       # l_partkey
QUANTITY_FAULTS = [(19, ""), (23, "-5"), (29, "invalid"), (31, "0"), (37, "0.5")]  # l_suppkey
PRICE_FAULTS = [(17, "0"), (41, "33.333")]  # l_partkey
BAD_DATE_EVERY = 43             # l_orderkey
DATE_SHIFT_MONTHS = 24 * 12
EMPTY_CUSTOMER_EVERY = 20       # o_custkey
BAD_CUSTOMER_EVERY = 47
CUSTOMER_BASE = 10000
# Country by c_nationkey: keys 0..14 are the first 15 valid names in list order,
# then these spellings for keys 15..24 (None = null).
COUNTRY_VARIANTS = [
    "USA",
    "uk",
    "GB",
    " great britain ",
    "United  Kingdom",
    "  Canada  ",
    "germany",
    "InvalidCountry",
    "",
    None,
]
COUNTRY_BY_NATION = S.VALID_COUNTRIES[:15] + COUNTRY_VARIANTS

ORDINAL_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _pick(rules: list[tuple[int, str]], key: Column, default: Column) -> Column:
    expr = None
    for every, text in rules:
        cond = (key % F.lit(every)) == 0
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(default)


def raw_sales(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """source_file, row_ordinal (struct, total order), 7 raw text columns.

    ``stored`` writes the joined rows under the checkpoint folder, so that several
    runs read their rows instead of joining the tables anew; as numbers and dates,
    which are smaller than the texts made from them."""
    return stored_sales(spark, sf_dir)[0] if stored else _texts(_joined(spark, sf_dir))


def stored_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The rows of ``raw_sales``, stored, with the path to remove when nothing reads them any more."""
    joined, path = keep(_joined(spark, sf_dir, True), "raw-sales")
    return _texts(joined), path


def _joined(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """A row per line item, with what the raw texts are made from.

    ``by_order`` joins the orders last: where that join is shuffled, the rows of an order lie together,
    and the dedupe combines them before its own shuffle."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    li = read("lineitem").select(*ORDINAL_KEYS)
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read("customer").select("c_custkey", "c_nationkey")
    part = read("part").select("p_partkey", "p_name", "p_retailprice")

    # orders x customer first (customer is the small side), then the big join
    # on the order key, then part. AQE turns any side that proves small at
    # run time into a broadcast; nothing is hinted.
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey)
    of_order, of_part = (oc, li.l_orderkey == oc.o_orderkey), (part, li.l_partkey == part.p_partkey)
    j = li.join(*of_part).join(*of_order) if by_order else li.join(*of_order).join(*of_part)
    return j.select(*ORDINAL_KEYS, "o_custkey", "o_orderdate", "c_nationkey", "p_name", "p_retailprice")


def _texts(j: DataFrame) -> DataFrame:
    """Raw rows from joined ones."""
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ck = F.col("o_custkey")
    # six digits at least, as %06d; a formatter per row is slow
    digits = F.when(ok >= 100_000, ok.cast("string")).when(ok >= 0, F.lpad(ok.cast("string"), 6, "0")).otherwise(F.format_string("%06d", ok))
    order_id = (
        F.when(((sk % FILES) == NULL_ID_FILE) & ((ok % NULL_ID_EVERY) == 0), F.lit(None).cast("string"))
        .when((ok % BAD_ID_EVERY) == 0, F.concat(F.lit("BAD-"), ok.cast("string")))
        .otherwise(F.concat(F.lit("ORD-"), digits))
    )
    product = (
        F.when((pk % EMPTY_PRODUCT_EVERY) == 0, F.lit(""))
        .when(
            (pk % PADDED_PRODUCT_EVERY) == 0,
            F.concat(F.lit("  "), F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")), F.lit("  ")),
        )
        .otherwise(F.col("p_name"))
    )
    quantity = _pick(QUANTITY_FAULTS, sk, F.col("l_quantity").cast("bigint").cast("string"))
    price = _pick(PRICE_FAULTS, pk, F.col("p_retailprice").cast(S.PRICE_TYPE).cast("string"))
    order_date = F.when((ok % BAD_DATE_EVERY) == 0, F.lit("invalid-date")).otherwise(
        F.date_format(F.add_months(F.col("o_orderdate"), DATE_SHIFT_MONTHS), "yyyy-MM-dd")
    )
    customer = (
        F.when((ck % EMPTY_CUSTOMER_EVERY) == 0, F.lit(""))
        .when((ck % BAD_CUSTOMER_EVERY) == 0, F.lit("BAD"))
        .otherwise(F.concat(F.lit("CUST-"), (ck + F.lit(CUSTOMER_BASE)).cast("string")))
    )
    country = F.element_at(
        F.array(*[F.lit(x).cast("string") for x in COUNTRY_BY_NATION]), F.col("c_nationkey") + 1
    )
    return j.select(
        F.concat(F.lit("part-"), (sk % FILES).cast("string")).alias(S.SOURCE_FILE),
        F.struct(*[F.col(k) for k in ORDINAL_KEYS]).alias(S.ROW_ORDINAL),
        order_id.alias("order_id"),
        product.alias("product_name"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        order_date.alias("order_date"),
        customer.alias("customer_id"),
        country.alias("country"),
    )
