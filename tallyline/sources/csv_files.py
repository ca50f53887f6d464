"""CSV sales files: inventory, scan with per-file headers, export.

The scan never infers types: every column is read as text under an explicit
schema, and lineage columns come from the file metadata at the scan
(``source_file``, ``row_ordinal``) before any shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyline import schema as S
from tallyline.session import keep

def list_csv_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """path, name, extension, is_csv, size, last_modified for files ending .csv
    (content is never read)."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))
    return df.select(
        "path",
        name.alias("name"),
        ext.alias("extension"),
        (ext == "csv").alias("is_csv"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def file_info(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Zero or one row for the named file."""
    return list_csv_files(spark, root).where(F.col("name") == name)


def file_exists(spark: SparkSession, root: str, name: str) -> bool:
    return len(file_info(spark, root, name).limit(1).take(1)) > 0


def escape_path(path: str) -> str:
    """A listed path as a literal for Spark's readers, which take paths for glob patterns."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def file_headers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Per CSV file, also empty ones: source_file, header (names as they stand),
    open_quotes (lines with an odd number of quotes).

    One distributed pass over the lines; the header is the first line of the
    block at offset 0. The inventory comes from the listing."""
    inventory = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(paths)
                 .select(F.col("_metadata.file_path").alias(S.SOURCE_FILE)))
    lines = spark.read.option("pathGlobFilter", "*.csv").text(paths).select(
        "value",
        F.col("_metadata.file_path").alias(S.SOURCE_FILE),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("_id"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    first = lines.groupBy(S.SOURCE_FILE).agg(F.min_by("value", "_id").alias("line"),
                                             F.count_if(quotes % 2 == 1).alias("open_quotes"))
    names = F.transform(F.split(F.regexp_replace("line", '["\r\ufeff]', ""), ","), lambda x: F.trim(x))
    return inventory.join(first, S.SOURCE_FILE, "left").select(
        S.SOURCE_FILE, F.coalesce(names, F.array().cast("array<string>")).alias("header"),
        F.coalesce("open_quotes", F.lit(0)).cast("long").alias("open_quotes"))


def read_sales_csv(
    spark: SparkSession,
    paths: list[str] | str,
    multi_line: bool = False,
    headers: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, headers).

    rows: source_file, row_ordinal, the seven data columns as text (missing
    ones null), ``_extra_fields`` (a row with more fields than its header).
    headers: a row per file with its header, for the file verdict.

    One scan under a positional schema as wide as the widest header, joined
    with each file's header; a required column is taken at the place where the
    file's header names it (the first one, if twice). ``multi_line`` allows
    newlines inside quotes but makes each file a single task; without it such
    lines count as malformed."""
    if headers is None:
        headers, _ = keep(file_headers(spark, paths), "csv-headers")     # small: a row per file
        if multi_line:
            headers = headers.withColumn("open_quotes", F.lit(0).cast("long"))
    width = headers.agg(F.max(F.size("header"))).first()[0] or 0
    # One column more than the widest header: a row with extra fields fills it.
    # (The parser's own malformed-row flag is lost under CSV column pruning.)
    schema = StructType([StructField(f"_c{i}", StringType(), True) for i in range(width + 1)])
    scan = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        .option("mode", "PERMISSIVE")
        .option("maxColumns", max(20480, width + 2))
        .option("pathGlobFilter", "*.csv")
        .csv(paths)
    )
    rows = scan.select(
        F.col("_metadata.file_path").alias(S.SOURCE_FILE),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("pos")).alias(S.ROW_ORDINAL),
        F.array(*[F.col(f"_c{i}") for i in range(width + 1)]).alias("_fields"),
    ).join(headers.select(S.SOURCE_FILE, "header"), S.SOURCE_FILE)
    at = lambda c: F.array_position("header", F.lit(c)).cast("int") - 1
    return rows.select(
        S.SOURCE_FILE, S.ROW_ORDINAL,
        *[F.when(at(c) >= 0, F.get("_fields", at(c))).alias(c) for c in S.REQUIRED_COLUMNS],
        F.get("_fields", F.size("header")).isNotNull().alias("_extra_fields"),
    ), headers


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with header and doubled-quote escaping, no index column."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)
