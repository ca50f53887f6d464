"""Result records as JSON: written from nested rows, read back whatever they hold.

A reader states the fields it wants by path and type. A field that is missing or
of another type is null; a field that nobody asked for is kept, by name, as JSON
text; a text that is no JSON object, or lacks a required field, goes to a reject
table with the reason. So records of older and newer writers pass through the
same plan. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT = "reject_reason"
UNKNOWN = "unknown_fields"


def to_records(rows: DataFrame, column: str = "record") -> DataFrame:
    """One JSON object per row; null columns are left out."""
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias(column))


def parse_records(rows: DataFrame, fields: dict[str, tuple[str, str]], required: tuple[str, ...] = (), column: str = "record") -> DataFrame:
    """`rows` with the `fields` (name -> (path, type)), the unknown top-level fields (a map of name to JSON text) and
    the reject reason (null for a good record). A null text is `no_record`."""
    text = F.col(column)
    v = F.try_parse_json(text)
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    # parsed once: the projections below it read the variant
    base = rows.withColumns({"_v": v}).withColumn("_ok", is_object)
    got = {n: F.when(F.col("_ok"), F.try_variant_get("_v", path, kind)) for n, (path, kind) in fields.items()}
    known = F.array(*[F.lit(path[2:].split(".")[0].split("[")[0]) for path, _ in fields.values()])
    every = F.from_json(text, "map<string,string>")
    unknown = F.when(F.col("_ok"), F.map_filter(every, lambda k, _: ~F.array_contains(known, k)))
    out = base.withColumns(got | {UNKNOWN: unknown})
    why = F.when(text.isNull(), "no_record").when(F.col("_v").isNull(), "not_json").when(~F.col("_ok"), "not_an_object")
    for n in required:
        why = why.when(F.col(n).isNull(), f"missing:{n}")
    return out.withColumn(REJECT, why).drop("_v", "_ok")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNull()).drop(REJECT)


def rejects(parsed: DataFrame, column: str = "record") -> DataFrame:
    return parsed.where(F.col(REJECT).isNotNull()).select(column, REJECT)


def counts_by_name(items: Column, name: str, value: str) -> Column:
    """A map of name to summed value, from an array of structs; items without a name are left out."""
    named = F.filter(items, lambda x: x[name].isNotNull())
    names = F.array_distinct(F.transform(named, lambda x: x[name]))
    total = lambda n: F.aggregate(F.filter(named, lambda x: x[name] == n), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x[value], F.lit(0)))
    return F.map_from_arrays(names, F.transform(names, total))
