"""Cleaning: dedupe, parse dates and numbers, fill, normalise text and countries.

The original runs these as five destructive steps with a count after each.
Here one classification pass tags every row with the first rule it breaks
(``reject_reason``): the kept rows, the quarantined rows and the per-file
counts all come from the same plan, and the counts equal the step-by-step
ones because the first failing rule wins.

Dedupe is an aggregate (min of a struct led by the row ordinal), not a window over
whole groups: partial aggregation keeps at most one row per key per map task
before the shuffle, so a duplicate group holding a third of the input does
not land on one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.functions import (
    fill_missing,
    is_missing,
    normalize_country,
    normalize_text,
    parse_number,
    parse_timestamp,
    timestamp_literal,
)
from tallyline.functions.parse import DATE_FORMATS

DUP_COUNT = "dup_count"
REJECT_REASON = "reject_reason"
ORDER_TS = "_order_ts"
QTY_NUM = "_qty_num"
PRICE_NUM = "_price_num"

FILL_DEFAULTS = {
    "customer_id": S.DEFAULT_CUSTOMER_ID,
    "country": S.DEFAULT_COUNTRY,
    "product_name": S.DEFAULT_PRODUCT,
}


@dataclass(frozen=True)
class CleanConfig:
    remove_duplicates: bool = True
    fill_missing: bool = True
    validate_dates: bool = True
    validate_numerics: bool = True
    normalize_strings: bool = True
    as_of: datetime | None = None          # newest allowed order time; None = now
    min_date: date = S.MIN_ORDER_DATE      # oldest allowed order date (inclusive)
    date_formats: tuple[str, ...] = DATE_FORMATS   # tried in order
    extra: dict = field(default_factory=dict)

    def newest(self) -> Column:
        """Newest allowed order time, in the session time zone as the parsed dates are."""
        return timestamp_literal(self.as_of) if self.as_of is not None else F.current_timestamp()


def _scope(df: DataFrame) -> list[str]:
    return [S.SOURCE_FILE] if S.SOURCE_FILE in df.columns else []


def dedupe_first(df: DataFrame, keys: list[str] | None = None, order: str = S.ROW_ORDINAL,
                 made: Callable[[Callable[[str], Column]], dict[str, Column]] = lambda of: {}) -> DataFrame:
    """Keep the first row (smallest ``order``) of each key group; nulls form one group.

    Adds ``dup_count`` = rows dropped from the group. Scope defaults to one
    source file plus ``order_id``. ``made`` gives further columns from the kept
    row's: part of the aggregate, they are computed once, while a filter above a
    projection is pushed below it and computes them again.
    """
    keys = keys if keys is not None else _scope(df) + ["order_id"]
    rest = [c for c in df.columns if c not in keys and c != order]
    # min of a struct led by the (unique) ordinal = the first row; cheaper to
    # aggregate than min_by over a struct value.
    first = F.min(F.struct(F.col(order), *[F.col(c) for c in rest]))
    new = made(lambda c: F.col(c) if c in keys else first[c])
    return (
        df.groupBy(*keys)
        .agg(first.alias("_first"), (F.count(F.lit(1)) - 1).alias(DUP_COUNT), *[c.alias(name) for name, c in new.items()])
        .select(*keys, "_first.*", DUP_COUNT, *new)
        .select(*df.columns, DUP_COUNT, *new)
    )


def _within(c: Column, most: int) -> Column:
    """0 < value <= most; false for null. The value is named once, as a filter that is pushed below the projection
    parses the text anew wherever it is named, in one method too long for the JVM to compile."""
    return F.coalesce(F.exists(F.array(c), lambda x: (x > 0) & (x <= F.lit(most))), F.lit(False))


def _parsed(cfg: CleanConfig, of: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """The parsed columns that the rules of ``cfg`` read, from the raw texts."""
    made = {}
    if cfg.validate_dates:
        made[ORDER_TS] = parse_timestamp(of("order_date"), cfg.date_formats)
    if cfg.validate_numerics:
        made |= {QTY_NUM: parse_number(of("quantity")), PRICE_NUM: parse_number(of("unit_price"))}
    return made


def classify(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Add parsed columns and ``reject_reason`` (invalid_date, invalid_numeric or null)."""
    return _tagged(df.withColumns(_parsed(cfg)), cfg)


def _tagged(out: DataFrame, cfg: CleanConfig) -> DataFrame:
    """Parsed rows with ``reject_reason``."""
    bad_date = F.lit(False)
    bad_num = F.lit(False)
    if cfg.validate_dates:
        t = F.col(ORDER_TS)
        bad_date = t.isNull() | (t > cfg.newest()) | (
            t < timestamp_literal(datetime.combine(cfg.min_date, datetime.min.time()))
        )
    if cfg.validate_numerics:
        q, p = F.col(QTY_NUM), F.col(PRICE_NUM)
        bad_num = (
            q.isNull() | p.isNull() | (q <= 0) | (p <= 0)
            | (q > F.lit(S.MAX_QUANTITY)) | (p > F.lit(S.MAX_UNIT_PRICE))
        )
    reason = F.when(bad_date, F.lit("invalid_date")).when(bad_num, F.lit("invalid_numeric"))
    return out.withColumn(REJECT_REASON, reason.cast("string"))


def finish(classified: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Typed, filled, normalised columns for the kept rows (drops helper columns)."""
    cols: dict[str, Column] = {c: F.col(c) for c in classified.columns}
    if cfg.validate_dates:
        cols["order_date"] = F.to_date(F.col(ORDER_TS))
    if cfg.validate_numerics:
        cols["quantity"] = F.col(QTY_NUM).try_cast("int")  # truncates toward zero
        cols["unit_price"] = F.col(PRICE_NUM)
    for c in S.TEXT_COLUMNS:
        v = F.col(c)
        if cfg.fill_missing:
            v = fill_missing(v, FILL_DEFAULTS[c])
        if cfg.normalize_strings:
            v = normalize_text(v)
        cols[c] = v
    drop = {ORDER_TS, QTY_NUM, PRICE_NUM, REJECT_REASON, DUP_COUNT}
    typed = classified.select(*[cols[c].alias(c) for c in classified.columns if c not in drop])
    # a projection of its own: the country's rule names its text several times
    return typed.withColumn("country", normalize_country(F.col("country"))) if "country" in typed.columns else typed


@dataclass
class CleanOutput:
    cleaned: DataFrame      # kept rows, typed
    rejected: DataFrame     # rows failing a parse or range rule, raw text + reject_reason
    classified: DataFrame   # deduped rows with reject_reason (the shared base)
    raw: DataFrame

    def stats(self) -> DataFrame:
        return cleaning_stats(self.classified)


def clean(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> CleanOutput:
    if cfg.remove_duplicates:
        return from_classified(_tagged(dedupe_first(df, made=lambda of: _parsed(cfg, of)), cfg), df, cfg)
    return from_classified(classify(df.withColumn(DUP_COUNT, F.lit(0).cast("long")), cfg), df, cfg)


def from_classified(classified: DataFrame, raw: DataFrame, cfg: CleanConfig = CleanConfig()) -> CleanOutput:
    """Kept and rejected rows from a classified frame (possibly checkpointed)."""
    kept = classified.where(F.col(REJECT_REASON).isNull())
    rejected = classified.where(F.col(REJECT_REASON).isNotNull()).select(*raw.columns, REJECT_REASON)
    return CleanOutput(cleaned=finish(kept, cfg), rejected=rejected, classified=classified, raw=raw)


def clean_df(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    return clean(df, cfg).cleaned


def cleaning_stats(classified: DataFrame) -> DataFrame:
    """One row per source file: the cleaning record (original, cleaned, removed,
    duplicates, invalid dates, invalid numerics, fills per column, removal rate)."""
    keys = _scope(classified)
    ok = F.col(REJECT_REASON).isNull()
    agg = classified.groupBy(*keys).agg(
        (F.count(F.lit(1)) + F.sum(DUP_COUNT)).alias("original_count"),
        F.count_if(ok).alias("cleaned_count"),
        F.sum(DUP_COUNT).alias("duplicates_removed"),
        F.count_if(F.col(REJECT_REASON) == "invalid_date").alias("invalid_dates_removed"),
        F.count_if(F.col(REJECT_REASON) == "invalid_numeric").alias("invalid_numerics_removed"),
        *[F.count_if(ok & is_missing(F.col(c))).alias(f"filled_{c}") for c in FILL_DEFAULTS],
    )
    removed = F.col("original_count") - F.col("cleaned_count")
    return agg.select(
        *keys,
        F.col("original_count").cast("long").alias("original_count"),
        F.col("cleaned_count").cast("long").alias("cleaned_count"),
        removed.cast("long").alias("rows_removed"),
        F.col("duplicates_removed").cast("long").alias("duplicates_removed"),
        F.col("invalid_dates_removed").cast("long").alias("invalid_dates_removed"),
        F.col("invalid_numerics_removed").cast("long").alias("invalid_numerics_removed"),
        *[F.col(f"filled_{c}").cast("long").alias(f"filled_{c}") for c in FILL_DEFAULTS],
        F.when(F.col("original_count") > 0, removed / F.col("original_count"))
        .otherwise(F.lit(0.0))
        .alias("removal_rate"),
    )


# --- single-step operators (each one step of the chain on its own) ---------


def parse_dates(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Date step alone: parse order_date, drop null / future / too old."""
    c = CleanConfig(False, False, True, False, False, cfg.as_of, cfg.min_date, cfg.date_formats)
    k = classify(df, c)
    return k.where(F.col(REJECT_REASON).isNull()).withColumn(
        "order_date", F.to_date(F.col(ORDER_TS))
    ).drop(ORDER_TS, REJECT_REASON)


def parse_numerics(df: DataFrame) -> DataFrame:
    """Numeric step alone: parse quantity and price, range filters, integer quantity."""
    parsed = df.withColumns({QTY_NUM: parse_number(F.col("quantity")), PRICE_NUM: parse_number(F.col("unit_price"))})
    return (
        parsed.where(_within(F.col(QTY_NUM), S.MAX_QUANTITY) & _within(F.col(PRICE_NUM), S.MAX_UNIT_PRICE))
        .withColumn("quantity", F.col(QTY_NUM).try_cast("int"))
        .withColumn("unit_price", F.col(PRICE_NUM))
        .drop(QTY_NUM, PRICE_NUM)
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.select(
        *[fill_missing(F.col(c), FILL_DEFAULTS[c]).alias(c) if c in FILL_DEFAULTS else F.col(c)
          for c in df.columns]
    )


def normalize_strings(df: DataFrame) -> DataFrame:
    return df.select(
        *[normalize_text(F.col(c)).alias(c) if c in S.TEXT_COLUMNS else F.col(c) for c in df.columns]
    )


def normalize_countries(df: DataFrame) -> DataFrame:
    return df.withColumn("country", normalize_country(F.col("country")))


def clean_column_names(df: DataFrame) -> DataFrame:
    """Standard names; two columns mapping to one name is an error."""
    from tallyline.functions import standard_column_name

    names = [standard_column_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after standardising: {dupes}")
    return df.toDF(*names)


def remove_empty_rows(df: DataFrame, data_columns: list[str] | None = None) -> DataFrame:
    """Drop rows whose data columns are all null (lineage columns ignored)."""
    cols = data_columns or [c for c in df.columns if c not in (S.SOURCE_FILE, S.ROW_ORDINAL)]
    return df.na.drop(how="all", subset=cols)
