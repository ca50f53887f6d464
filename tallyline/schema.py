"""Column names, stage schemas and the fixed values the semantics depend on."""

from __future__ import annotations

from datetime import date

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for identical results).
# ---------------------------------------------------------------------------

# Valid countries, in list order.
VALID_COUNTRIES = [
    "United States",
    "Canada",
    "United Kingdom",
    "Germany",
    "France",
    "Australia",
    "Japan",
    "Brazil",
    "India",
    "Mexico",
    "Spain",
    "Italy",
    "Netherlands",
    "Sweden",
    "Singapore",
    "Unknown",
]

# Country spellings mapped after lower-casing and stripping.
COUNTRY_ALIASES = {
    "usa": "United States",
    "us": "United States",
    "uk": "United Kingdom",
    "gb": "United Kingdom",
    "great britain": "United Kingdom",
    "": "Unknown",
    "nan": "Unknown",
    "none": "Unknown",
}

# Fill values for missing text.
DEFAULT_CUSTOMER_ID = "UNKNOWN"
DEFAULT_COUNTRY = "Unknown"
DEFAULT_PRODUCT = "Unknown Product"

# Patterns.
ORDER_ID_PATTERN = r"^ORD-\d{6}$"
CUSTOMER_ID_PATTERN = r"^(CUST-\d{5}|UNKNOWN)$"

# Ranges.
MIN_QUANTITY = 1
MAX_QUANTITY = 10000
MAX_UNIT_PRICE = 100000
MIN_ORDER_DATE = date(2020, 1, 1)

# Revenue classes: upper bounds (exclusive) and names.
REVENUE_CLASSES = [(50, "Small"), (200, "Medium"), (1000, "Large")]
REVENUE_TOP_CLASS = "Enterprise"

# Warning thresholds.
DATA_LOSS_WARN_RATIO = 0.5
UNKNOWN_SHARE_WARN = 0.1
DATE_SPAN_WARN_DAYS = 365
TOTAL_TOLERANCE = 0.01

# Text read as missing by a CSV reader with default NA handling.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Table column limits (VARCHAR lengths) and money types.
ORDER_ID_MAX_LEN = 50
PRODUCT_MAX_LEN = 255
CUSTOMER_ID_MAX_LEN = 50
COUNTRY_MAX_LEN = 100
PRICE_TYPE = DecimalType(10, 2)
TOTAL_TYPE = DecimalType(12, 2)

# ---------------------------------------------------------------------------
# Column sets and stage schemas
# ---------------------------------------------------------------------------

REQUIRED_COLUMNS = [
    "order_id",
    "product_name",
    "quantity",
    "unit_price",
    "order_date",
    "customer_id",
    "country",
]
TEXT_COLUMNS = ["product_name", "customer_id", "country"]
ENRICH_COLUMNS = ["total_amount", "ingestion_timestamp"]
DATE_PART_COLUMNS = ["order_year", "order_month", "order_day", "order_weekday"]
TABLE_COLUMNS = REQUIRED_COLUMNS + ENRICH_COLUMNS

# Lineage columns carried beside the data columns.
SOURCE_FILE = "source_file"
ROW_ORDINAL = "row_ordinal"

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in REQUIRED_COLUMNS])

CLEANED_SCHEMA = StructType(
    [
        StructField("order_id", StringType(), True),
        StructField("product_name", StringType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("order_date", DateType(), True),
        StructField("customer_id", StringType(), True),
        StructField("country", StringType(), True),
    ]
)

ENRICHED_SCHEMA = StructType(
    CLEANED_SCHEMA.fields
    + [
        StructField("total_amount", DoubleType(), True),
        StructField("ingestion_timestamp", TimestampNTZType(), True),
    ]
)

TABLE_SCHEMA = StructType(
    [
        StructField("order_id", StringType(), False),
        StructField("product_name", StringType(), False),
        StructField("quantity", IntegerType(), False),
        StructField("unit_price", PRICE_TYPE, False),
        StructField("order_date", DateType(), False),
        StructField("customer_id", StringType(), False),
        StructField("country", StringType(), False),
        StructField("total_amount", TOTAL_TYPE, False),
        StructField("ingestion_timestamp", TimestampNTZType(), True),
    ]
)
