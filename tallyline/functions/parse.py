"""Parsing raw text into typed values; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import strip_ws

# Plain decimal or scientific notation; rejects Spark-only forms such as
# '1d', '1f', 'Infinity', 'NaN', '0x10'.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Date formats tried in order; 'M' and 'd' take one or two digits.
DATE_FORMATS = ("yyyy-M-d", "yyyy-M-d HH:mm:ss", "yyyy-M-d'T'HH:mm:ss")
PLAIN_DATE = r"^[1-9][0-9]{3}-[0-9]{1,2}-[0-9]{1,2}$"      # what a cast reads as "yyyy-M-d" does
YEAR_FIRST = r"^[+-]?[0-9]"


def parse_number(c: Column) -> Column:
    """Text to double; null unless the trimmed text is a plain number."""
    t = strip_ws(c.cast("string"))
    return F.when(F.regexp_like(t, F.lit(NUMBER_PATTERN)), t.try_cast("double"))


def is_number_text(c: Column) -> Column:
    return F.coalesce(F.regexp_like(strip_ws(c.cast("string")), F.lit(NUMBER_PATTERN)), F.lit(False))


def parse_timestamp(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Text to timestamp trying each format; null when none fits.

    A format that does not fit costs an exception inside Spark, so plain dates are cast and texts that cannot
    begin with a year are not tried, where the formats allow that."""
    t = strip_ws(c.cast("string"))
    tried = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in formats])
    if all(f.startswith("yyyy") for f in formats):
        tried = F.when(F.regexp_like(t, F.lit(YEAR_FIRST)), tried)
    if formats[0] != "yyyy-M-d":
        return tried
    return F.coalesce(F.when(F.regexp_like(t, F.lit(PLAIN_DATE)), t.try_cast("timestamp")), tried)


def timestamp_literal(value) -> Column:
    """A timestamp literal read in the session time zone (like parsed data)."""
    return F.to_timestamp(F.lit(str(value)))
