"""String column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import schema as S

# Whitespace as Python's str.isspace() sees it (ASCII controls, no-break
# space, the Unicode spaces); derived by rule, not listed by hand.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _ranges(chars: str) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for cp in sorted(map(ord, chars)):
        if out and cp == out[-1][1] + 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


# The same set as a Java regex character class (merged into ranges).
_RUN_WS = "[" + "".join(
    f"\\u{a:04x}" if a == b else f"\\u{a:04x}-\\u{b:04x}" for a, b in _ranges(WHITESPACE)
) + "]+"


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace (a character-set trim, no regex).

    The trim looks up both ends in the whole set and is slow; a text that begins and ends with visible ASCII stays as it is."""
    seen = lambda end: (end >= F.lit("!")) & (end < F.lit("\x7f"))  # noqa: E731  (compares bytes: the first decides)
    return F.when(seen(c) & seen(F.substring(c, -1, 1)), c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def squeeze_ws(c: Column) -> Column:
    """Strip, then turn every run of whitespace into one space.

    A text of ASCII without controls and without two spaces in a row needs only the strip."""
    runs = F.contains(c, F.lit("  ")) | F.regexp_like(c, F.lit("[^ -~]"))
    return F.when(runs, F.regexp_replace(strip_ws(c), _RUN_WS, " ")).otherwise(strip_ws(c))


def null_tokens(c: Column, tokens: list[str] | None = None) -> Column:
    """Null for text a CSV reader treats as missing ('', NA, NULL, nan, ...)."""
    toks = S.NULL_TOKENS if tokens is None else tokens
    longest = max((len(t.encode()) for t in toks), default=0)       # a longer text needs no lookup
    return F.when((F.octet_length(c) <= longest) & c.isin(toks), F.lit(None).cast("string")).otherwise(c)


def is_missing(c: Column) -> Column:
    """Null or exactly the empty string (whitespace-only text is not missing)."""
    return c.isNull() | (c == F.lit(""))


def fill_missing(c: Column, value: str) -> Column:
    return F.when(is_missing(c), F.lit(value)).otherwise(c)


def normalize_text(c: Column) -> Column:
    """Strip + squeeze; a null becomes the text 'nan' (string conversion of a missing value)."""
    return F.coalesce(squeeze_ws(c), F.lit("nan"))


def standard_column_name(name: str) -> str:
    """strip, lower, whitespace runs to '_', drop non-word characters."""
    import re

    out = name.strip().lower()
    out = re.sub(r"\s+", "_", out)
    return re.sub(r"[^\w]", "", out)


def matches(c: Column, pattern: str) -> Column:
    """Regex search; null input gives false (the row fails the check)."""
    return F.coalesce(F.regexp_like(c, F.lit(pattern)), F.lit(False))
