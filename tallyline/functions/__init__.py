"""Column expressions: text, parsing, money and country rules."""

from tallyline.functions.country import is_valid_country, normalize_country
from tallyline.functions.money import as_price, as_total, exact_sum, line_total, mean_of, revenue_class, round2
from tallyline.functions.parse import is_number_text, parse_number, parse_timestamp, timestamp_literal
from tallyline.functions.text import (
    fill_missing,
    is_missing,
    matches,
    normalize_text,
    null_tokens,
    squeeze_ws,
    standard_column_name,
    strip_ws,
)

__all__ = [
    "as_price", "as_total", "exact_sum", "fill_missing", "is_missing", "is_number_text",
    "is_valid_country", "line_total", "matches", "mean_of", "normalize_country",
    "normalize_text", "null_tokens", "parse_number", "parse_timestamp", "revenue_class",
    "round2", "squeeze_ws", "standard_column_name", "strip_ws", "timestamp_literal",
]
