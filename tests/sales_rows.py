"""Literal raw rows for the sales tests."""

SF_SMALL = "/root/testdata/sf0.001"
RAW_COLS = ["order_id", "product_name", "quantity", "unit_price", "order_date", "customer_id", "country"]


def raw_frame(spark, rows, source_file="f1.csv"):
    """Literal raw rows (tuples of 7 texts) with file and ordinal lineage."""
    from pyspark.sql import functions as F

    data = [(source_file, i) + tuple(r) for i, r in enumerate(rows)]
    schema = "source_file string, _i long, " + ", ".join(f"{c} string" for c in RAW_COLS)
    df = spark.createDataFrame(data, schema)
    return df.select("source_file", F.struct(F.col("_i").alias("pos")).alias("row_ordinal"), *RAW_COLS)
