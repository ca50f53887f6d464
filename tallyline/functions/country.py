"""Country normalisation as a literal map lookup (constant-folded, no UDF)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.functions.text import strip_ws


def normalize_country(c: Column) -> Column:
    """Alias map on lower(strip(text)); else keep the text if it is a valid
    name (case-sensitive); else 'Unknown'. Null reads as 'nan' -> 'Unknown'."""
    alias = F.create_map(*[F.lit(x) for x in chain.from_iterable(S.COUNTRY_ALIASES.items())])
    key = F.lower(strip_ws(F.coalesce(c, F.lit("nan"))))
    kept = F.when(c.isin(S.VALID_COUNTRIES), c).otherwise(F.lit(S.DEFAULT_COUNTRY))
    return F.coalesce(F.element_at(alias, key), kept)


def is_valid_country(c: Column) -> Column:
    return F.coalesce(c.isin(S.VALID_COUNTRIES), F.lit(False))
