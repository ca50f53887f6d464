"""Declarative validation: rules are data, every rule is a Boolean column.

One aggregate pass gives all failure counts per (file, column, check); an
optional second pass lists failing rows. Whole-file checks (header, raw
schema) give a per-file verdict that is joined back, never a driver loop.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.functions import is_number_text, matches, null_tokens, parse_number, parse_timestamp, strip_ws
from tallyline.functions.parse import DATE_FORMATS

INT_TEXT = r"^[+-]?\d+$"


@dataclass(frozen=True)
class Rule:
    column: str        # column checked ("*" for a whole-row check)
    check: str         # check name
    fails: Callable[[], Column]   # true when the row breaks the rule
    group: bool = False           # needs the key group (uniqueness)


def _nn(c):
    return Rule(c, "not_null", lambda: F.col(c).isNull())


def _chk(c, name, ok):
    # Checks other than not-null look at non-null values only.
    return Rule(c, name, lambda: F.col(c).isNotNull() & ~F.coalesce(ok(F.col(c)), F.lit(False)))


def _typed_rules() -> list[Rule]:
    return [
        _nn("order_id"),
        Rule("order_id", "unique", lambda: F.lit(False), group=True),
        _chk("order_id", "str_matches", lambda c: matches(c, S.ORDER_ID_PATTERN)),
        _nn("product_name"),
        _chk("product_name", "str_length", lambda c: F.char_length(c).between(1, S.PRODUCT_MAX_LEN)),
        _nn("quantity"),
        _chk("quantity", "ge", lambda c: c >= S.MIN_QUANTITY),
        _chk("quantity", "le", lambda c: c <= S.MAX_QUANTITY),
        _nn("unit_price"),
        _chk("unit_price", "gt", lambda c: c > 0),
        _chk("unit_price", "le", lambda c: c <= S.MAX_UNIT_PRICE),
        _nn("order_date"),
        _nn("customer_id"),
        _chk("customer_id", "str_matches", lambda c: matches(c, S.CUSTOMER_ID_PATTERN)),
        _nn("country"),
        _chk("country", "isin", lambda c: c.isin(S.VALID_COUNTRIES)),
    ]


RAW_RULES = [_nn("order_id")]
CLEANED_RULES = _typed_rules()
ENRICHED_RULES = _typed_rules() + [
    _nn("total_amount"),
    _chk("total_amount", "gt", lambda c: c > 0),
    _nn("ingestion_timestamp"),
    Rule("*", "total_amount_calculation", lambda: ~F.coalesce(
        F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price")) < S.TOTAL_TOLERANCE,
        F.lit(False))),
    # The enrichment validator's own count uses the other side of the tolerance.
    Rule("total_amount", "calculation_error", lambda: F.coalesce(
        F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price")) > S.TOTAL_TOLERANCE,
        F.lit(False))),
]
STAGES = {"raw": RAW_RULES, "cleaned": CLEANED_RULES, "enriched": ENRICHED_RULES}
# The schema names that report rows carry.
SCHEMA_NAMES = {"raw": "RawSalesSchema", "cleaned": "CleanedSalesSchema", "enriched": "EnrichedSalesSchema"}
STAGE_COLUMNS = {
    "raw": S.REQUIRED_COLUMNS,
    "cleaned": S.REQUIRED_COLUMNS,
    "enriched": S.REQUIRED_COLUMNS + S.ENRICH_COLUMNS,
}
CLOSED = {"raw": False, "cleaned": True, "enriched": True}


SCOPE = "_scope"


def _keys(df: DataFrame) -> list[str]:
    return [S.SOURCE_FILE] if S.SOURCE_FILE in df.columns else []


def _scoped(df: DataFrame):
    """Group key for per-file results; a frame without files is one scope."""
    keys = _keys(df)
    if keys:
        return df, keys, False
    if SCOPE in df.columns:
        return df, [SCOPE], False
    return df.withColumn(SCOPE, F.lit("")), [SCOPE], True


def schema_problems(df: DataFrame, stage: str) -> list[str]:
    """Plan-time column checks (no data read): missing columns; extra columns
    when the stage schema is closed. Lineage columns are ignored."""
    data_cols = [c for c in df.columns if c not in (S.SOURCE_FILE, S.ROW_ORDINAL)]
    need = STAGE_COLUMNS[stage]
    out = [f"missing_column:{c}" for c in need if c not in data_cols]
    if CLOSED[stage]:
        out += [f"extra_column:{c}" for c in data_cols if c not in need]
    return out


def _dup_members(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Per scope: rows whose key occurs more than once (every member counts).
    A grouped count with partial aggregation: a hot key is summed map-side."""
    g = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("n"))
    return g.where(F.col("n") > 1).groupBy(*keys).agg(F.sum("n").alias("failures"))


def rule_counts(df: DataFrame, stage: str = "cleaned", keep_zero: bool = True) -> DataFrame:
    """Failures per (file, column, check). Columns: [source_file,] column, check, failures.

    The rows are read once: counts per key first, from which the repeated keys and all other failures of a file are summed.
    Rows deduplicated by file and key need no further shuffle for that."""
    df, keys, scoped = _scoped(df)
    rules = [r for r in STAGES[stage] if r.column == "*" or r.column in df.columns]
    names = {r: f"_r{i}" for i, r in enumerate(rules)}
    unique = sorted({r.column for r in rules if r.group})           # the order id, or nothing
    by_key = df.groupBy(*keys, *unique).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(r.fails()).alias(names[r]) for r in rules if not r.group])
    named = reduce(and_, [F.col(c).isNotNull() for c in keys + unique])
    repeated = F.sum(F.when((F.col("_n") > 1) & named, F.col("_n")).otherwise(0))
    agg = by_key.groupBy(*keys).agg(*[(repeated if r.group else F.sum(names[r])).alias(names[r]) for r in rules])
    pairs = ", ".join(f"'{r.column}', '{r.check}', `{names[r]}`" for r in rules)
    long = agg.select(*keys, F.expr(f"stack({len(rules)}, {pairs}) as (`column`, `check`, failures)"))
    long = long.select(*keys, "column", "check", F.col("failures").cast("long").alias("failures"))
    if scoped:
        long = long.drop(SCOPE)
    return long if keep_zero else long.where(F.col("failures") > 0)


def stage_counts(df: DataFrame, stages: list[str], extra: list[Column] | None = None):
    """Rule failures of several stages (same rows, e.g. enriched rows checked
    as cleaned and as enriched) from ONE aggregate pass plus one grouped count
    for uniqueness.

    Returns (long, wide): long has [source_file,] stage, column, check,
    failures; wide is the per-file aggregate with ``total_rows`` and the
    ``extra`` aggregate columns."""
    df, keys, scoped = _scoped(df)
    names: dict[tuple[str, str], str] = {}
    exprs = []
    group_rules = {}
    for st in stages:
        for r in STAGES[st]:
            if not (r.column == "*" or r.column in df.columns):
                continue
            if r.group:
                group_rules.setdefault(r.column, []).append((st, r.check))
                continue
            k = (r.column, r.check)
            if k not in names:
                names[k] = f"_r{len(names)}"
                exprs.append(F.count_if(r.fails()).alias(names[k]))
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_rows"), *exprs, *(extra or []))
    rows = [(st, r.column, r.check, names[(r.column, r.check)])
            for st in stages for r in STAGES[st] if (r.column, r.check) in names and not r.group]
    pairs = ", ".join(f"'{st}', '{c}', '{k}', `{n}`" for st, c, k, n in rows)
    long = wide.select(*keys, F.expr(f"stack({len(rows)}, {pairs}) as (stage, `column`, `check`, failures)"))
    long = long.select(*keys, "stage", "column", "check", F.col("failures").cast("long").alias("failures"))
    for col, uses in group_rules.items():
        dup = _dup_members(df, keys, col)
        per = wide.select(*keys).join(dup, keys, "left").select(
            *keys, F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"))
        for st, check in uses:
            long = long.unionByName(per.select(*keys, F.lit(st).alias("stage"), F.lit(col).alias("column"),
                                               F.lit(check).alias("check"), "failures"))
    if scoped:
        long, wide = long.drop(SCOPE), wide.drop(SCOPE)
    return long, wide


VALUE_CHARS = 100      # of a failing value that a report shows


def failure_cases(df: DataFrame, stage: str = "cleaned", value_chars: int | None = VALUE_CHARS) -> DataFrame:
    """Every failing (row, column, check): [source_file,] column, check,
    row_index, failure_case (cut to ``value_chars`` characters; None: whole). Uniqueness failures
    are listed for every member of a duplicated key."""
    keys = _keys(df)
    rules = [r for r in STAGES[stage] if r.column == "*" or r.column in df.columns]
    flat = [r for r in rules if not r.group]
    idx = F.col(S.ROW_ORDINAL).cast("string") if S.ROW_ORDINAL in df.columns else F.lit(None).cast("string")

    def val(r):
        return F.lit(None).cast("string") if r.column == "*" else F.col(r.column).cast("string")

    def cut(text):
        return text if value_chars is None else F.left(text, F.lit(value_chars))

    cases = F.array(*[
        F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                 r.fails().alias("failed"), cut(val(r)).alias("failure_case"))
        for r in flat
    ])
    out = df.select(*keys, idx.alias("row_index"), F.inline(F.filter(cases, lambda x: x["failed"])))
    out = out.select(*keys, "column", "check", "row_index", "failure_case")
    for r in rules:
        if r.group:
            cnt = df.where(F.col(r.column).isNotNull()).groupBy(*keys, r.column).agg(F.count(F.lit(1)).alias("_n"))
            dup_keys = cnt.where(F.col("_n") > 1).select(*keys, r.column)
            members = df.join(dup_keys, keys + [r.column], "left_semi")
            out = out.unionByName(members.select(
                *keys, F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                idx.alias("row_index"), cut(F.col(r.column).cast("string")).alias("failure_case")))
    return out


# -- raw stage -----------------------------------------------------------------


VERDICT_COLUMNS = ["total_rows", "null_order_ids", "malformed_rows", "missing_columns", "is_valid"]
WARNING_COLUMNS = ["non_numeric_quantity", "empty_order_ids"]


def raw_profile(raw: DataFrame, header_columns: DataFrame | None = None) -> DataFrame:
    """Everything the raw stage needs, per source file, from ONE aggregate over
    the raw rows: the whole-file verdict (rows, null order ids, rows with too
    many fields, missing columns, is_valid) and the raw warnings (non-numeric
    quantity text, empty order ids).

    A file is valid only if all required columns exist, no order_id is null
    and no row has more fields than the header. Non-numeric quantities count
    only when the column is text, i.e. some non-null value is not a number.
    """
    keys = _keys(raw)
    has = set(raw.columns)
    none = F.lit(None).cast("string")
    oid = F.col("order_id") if "order_id" in has else none
    q = null_tokens(F.col("quantity")) if "quantity" in has else none
    extra_fields = F.col("_extra_fields") if "_extra_fields" in has else F.lit(False)
    digits_only = F.regexp_like(F.replace(F.replace(q, F.lit("-"), F.lit("")), F.lit("."), F.lit("")),
                                F.lit(r"^[0-9]+$"))
    agg = raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(oid.isNull()).alias("null_order_ids"),
        F.count_if(extra_fields).alias("malformed_rows"),
        F.count_if(q.isNotNull() & ~is_number_text(q)).alias("_text_values"),
        F.count_if(q.isNotNull() & ~digits_only).alias("_non_numeric"),
        F.count_if(null_tokens(oid).isNull() | (oid == "")).alias("empty_order_ids"),
    )
    counts = ["total_rows", "null_order_ids", "malformed_rows", "_text_values", "_non_numeric", "empty_order_ids"]
    missing = [m.split(":", 1)[1] for m in schema_problems(raw, "raw")]
    if header_columns is not None:
        # Every listed file has a verdict, also one without rows or header.
        req = F.array(*[F.lit(c) for c in S.REQUIRED_COLUMNS])
        opened = F.col("open_quotes") if "open_quotes" in header_columns.columns else F.lit(0)
        agg = header_columns.join(agg, keys, "left").select(
            *keys, F.array_except(req, F.coalesce(F.col("header"), F.array().cast("array<string>"))).alias("_missing"),
            *[(F.coalesce(c, F.lit(0)) + (opened if c == "malformed_rows" else F.lit(0))).alias(c) for c in counts])
    else:
        agg = agg.withColumn("_missing", F.array(*[F.lit(m) for m in missing]).cast("array<string>"))
    ok = (F.size("_missing") == 0) & (F.col("null_order_ids") == 0) & (F.col("malformed_rows") == 0)
    return agg.select(
        *keys,
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("null_order_ids").cast("long").alias("null_order_ids"),
        F.col("malformed_rows").cast("long").alias("malformed_rows"),
        F.concat_ws(",", F.array_sort("_missing")).alias("missing_columns"),
        ok.alias("is_valid"),
        F.when(F.col("_text_values") > 0, F.col("_non_numeric")).otherwise(F.lit(0)).cast("long")
        .alias("non_numeric_quantity"),
        F.col("empty_order_ids").cast("long").alias("empty_order_ids"),
    )


def file_verdict(raw: DataFrame, header_columns: DataFrame | None = None) -> DataFrame:
    """Per source file: rows, null order ids, rows with too many fields,
    missing columns, and whether the whole file is valid."""
    return raw_profile(raw, header_columns).select(*_keys(raw), *VERDICT_COLUMNS)


def raw_warnings(raw: DataFrame) -> DataFrame:
    """Per file: non-numeric quantity text (only for a text column) and empty order ids."""
    return raw_profile(raw).select(*_keys(raw), *WARNING_COLUMNS)


def raw_stage_report(profile: DataFrame, strict: bool = False) -> DataFrame:
    """The raw-stage report rows (same columns as ``stage_report``) from a raw
    profile, without touching the raw rows again."""
    keys = [c for c in profile.columns if c == S.SOURCE_FILE]
    # Missing columns are one error, and nothing else of the file is looked at.
    missing = F.col("missing_columns") != ""
    err_n = F.when(missing, F.lit(1)).otherwise(F.col("null_order_ids") + F.col("malformed_rows"))
    warn_n = F.when(missing, F.lit(0)).otherwise(
        (F.col("non_numeric_quantity") > 0).cast("int") + (F.col("empty_order_ids") > 0).cast("int"))
    ok = (err_n == 0) & ((warn_n == 0) | F.lit(not strict))
    errs = F.filter(F.array(
        F.when(~missing & (F.col("null_order_ids") > 0), F.lit("order_id:not_null")),
        F.when(missing, F.concat(F.lit("schema:missing_columns:"), F.col("missing_columns"))),
        F.when(~missing & (F.col("malformed_rows") > 0), F.lit("schema:malformed_rows")),
    ), lambda x: x.isNotNull())
    status = F.when(~ok, "failed").when(F.col("total_rows") == 0, "skipped").when(warn_n > 0, "warning").otherwise("passed")
    return profile.select(
        *keys,
        F.lit("raw").alias("stage"),
        F.lit(SCHEMA_NAMES["raw"]).alias("schema_name"),
        status.alias("status"),
        ok.alias("is_valid"),
        F.col("total_rows").cast("long").alias("total_rows"),
        F.when(ok, F.col("total_rows")).otherwise(0).cast("long").alias("valid_rows"),
        F.when(ok, 0).otherwise(F.col("total_rows")).cast("long").alias("invalid_rows"),
        err_n.cast("long").alias("error_count"),
        warn_n.cast("long").alias("warning_count"),
        F.concat_ws(";", F.array_sort(errs)).alias("first_errors"),
        F.when(missing, F.lit("")).otherwise(F.concat_ws(
            ";", F.when(F.col("non_numeric_quantity") > 0, F.concat(F.lit("non_numeric_quantity:"), F.col("non_numeric_quantity"))),
            F.when(F.col("empty_order_ids") > 0, F.concat(F.lit("empty_order_ids:"), F.col("empty_order_ids"))))).alias("warnings"),
    )


# -- post-clean quality ----------------------------------------------------------


def quality_aggregates() -> list[Column]:
    """The per-file aggregates the quality warnings read (for a shared pass)."""
    return [
        F.count_if(F.col("customer_id") == S.DEFAULT_CUSTOMER_ID).alias("unknown_customers"),
        F.count_if(F.col("country") == S.DEFAULT_COUNTRY).alias("unknown_countries"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("date_span_days"),
    ]


def quality_warnings(cleaned: DataFrame, original_counts: DataFrame | None = None) -> DataFrame:
    """Per file: unknown customer / country shares, date span, data loss; each
    with its warning flag."""
    keys = _keys(cleaned)
    agg = cleaned.groupBy(*keys).agg(F.count(F.lit(1)).alias("cleaned_count"), *quality_aggregates())
    return quality_from_aggregates(agg, original_counts, keys)


def quality_from_aggregates(agg: DataFrame, original_counts: DataFrame | None, keys: list[str]) -> DataFrame:
    """Warnings from per-file aggregates (cleaned_count + ``quality_aggregates``)."""
    if original_counts is not None:
        # From the original counts on: a file that lost all its rows has a row too.
        agg = original_counts.select(*keys, "original_count").join(agg, keys, "left").fillna(
            0, ["cleaned_count", "unknown_customers", "unknown_countries"])
    else:
        agg = agg.withColumn("original_count", F.lit(0).cast("long"))
    n = F.col("cleaned_count")
    orig = F.coalesce(F.col("original_count"), F.lit(0))
    loss = F.when(orig > 0, F.lit(1.0) - n / orig)
    return agg.select(
        *keys,
        F.col("original_count").cast("long").alias("original_count"),
        F.col("cleaned_count").cast("long").alias("cleaned_count"),
        loss.alias("data_loss_ratio"),
        F.coalesce(loss > S.DATA_LOSS_WARN_RATIO, F.lit(False)).alias("warn_data_loss"),
        F.col("unknown_customers").cast("long").alias("unknown_customers"),
        (F.col("unknown_customers") > n * S.UNKNOWN_SHARE_WARN).alias("warn_unknown_customers"),
        F.col("unknown_countries").cast("long").alias("unknown_countries"),
        (F.col("unknown_countries") > n * S.UNKNOWN_SHARE_WARN).alias("warn_unknown_countries"),
        F.col("date_span_days").cast("long").alias("date_span_days"),
        F.coalesce(F.col("date_span_days") > S.DATE_SPAN_WARN_DAYS, F.lit(False)).alias("warn_date_span"),
    )


def coerce_failures(raw: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """Type coercion of raw text to the cleaned types: per file and column,
    values present whose text does not convert."""
    keys = _keys(raw)
    checks = {
        "quantity": lambda c: F.regexp_like(strip_ws(c), F.lit(INT_TEXT)),
        "unit_price": is_number_text,
        "order_date": lambda c: parse_timestamp(c, date_formats).isNotNull(),
    }
    agg = raw.groupBy(*keys).agg(*[
        F.count_if(F.col(c).isNotNull() & ~F.coalesce(ok(F.col(c)), F.lit(False))).alias(c)
        for c, ok in checks.items()
    ])
    pairs = ", ".join(f"'{c}', `{c}`" for c in checks)
    return agg.select(*keys, F.expr(f"stack({len(checks)}, {pairs}) as (`column`, failures)")).select(
        *keys, "column", F.lit("coerce").alias("check"), F.col("failures").cast("long").alias("failures"))


# -- reports ------------------------------------------------------------------------


def stage_report(df: DataFrame, stage: str, warnings: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One report row per file for a stage: status, is_valid, row counts
    (all-or-nothing), error and warning counts, schema name, and the first ten
    errors as text. ``warnings`` has [source_file,] warning_count, warnings."""
    problems = schema_problems(df, stage)
    df, keys, scoped = _scoped(df)
    long, wide = stage_counts(df, [stage])
    rep = report_from_counts(long, wide.select(*keys, "total_rows"), stage, keys,
                             warnings if not scoped else None, problems, strict)
    if scoped and warnings is not None:
        rep = rep.drop("warning_count", "warnings").withColumn("_one", F.lit(1)).join(
            warnings.select("warning_count", "warnings", F.lit(1).alias("_one")), "_one").drop("_one")
    return rep.drop(SCOPE) if scoped else rep


def report_from_counts(long: DataFrame, sizes: DataFrame, stage: str, keys: list[str],
                       warnings: DataFrame | None = None, problems: list[str] | None = None,
                       strict: bool = False) -> DataFrame:
    """Report rows for one stage from precomputed failure counts and sizes."""
    errs = long.where((F.col("stage") == stage) & (F.col("failures") > 0)).groupBy(*keys).agg(
        # A wrong calculation is one error, however many rows show it.
        F.sum(F.when(F.col("check") == "calculation_error", 1).otherwise(F.col("failures"))).alias("error_count"),
        F.array_sort(F.collect_list(F.concat_ws(":", "column", "check"))).alias("_errs"),    # at most one per rule
    )
    rep = sizes.join(errs, keys, "left")
    if warnings is not None:
        rep = rep.join(warnings.select(*keys, "warning_count", "warnings"), keys, "left")
    else:
        rep = rep.withColumns({"warning_count": F.lit(0), "warnings": F.lit("")})
    problems = problems or []
    err_n = F.coalesce(F.col("error_count"), F.lit(0)) + F.lit(len(problems))
    warn_n = F.coalesce(F.col("warning_count"), F.lit(0))
    ok = (err_n == 0) & ((warn_n == 0) | F.lit(not strict))
    status = F.when(~ok, "failed").when(F.col("total_rows") == 0, "skipped").when(warn_n > 0, "warning").otherwise("passed")
    return rep.select(
        *keys,
        F.lit(stage).alias("stage"),
        F.lit(SCHEMA_NAMES[stage]).alias("schema_name"),
        status.alias("status"),
        ok.alias("is_valid"),
        F.col("total_rows").cast("long").alias("total_rows"),
        F.when(ok, F.col("total_rows")).otherwise(0).cast("long").alias("valid_rows"),
        F.when(ok, 0).otherwise(F.col("total_rows")).cast("long").alias("invalid_rows"),
        err_n.cast("long").alias("error_count"),
        warn_n.cast("long").alias("warning_count"),
        F.concat_ws(";", F.concat(F.array(*map(F.lit, problems)).cast("array<string>"),
                                  F.coalesce(F.col("_errs"), F.array().cast("array<string>")))).alias("first_errors"),
        F.coalesce("warnings", F.lit("")).alias("warnings"),
    )


def quality_warning_texts(q: DataFrame, keys: list[str]) -> DataFrame:
    """warning_count and their texts per file, from ``quality_from_aggregates``."""
    figures = {"warn_data_loss": None, "warn_unknown_customers": "unknown_customers",
               "warn_unknown_countries": "unknown_countries", "warn_date_span": "date_span_days"}
    texts = [F.when(F.col(flag), F.concat(F.lit(f"{flag[5:]}:"), F.col(value)) if value else F.lit(flag[5:])) for flag, value in figures.items()]
    return q.select(*keys, sum((F.col(flag).cast("int") for flag in figures), F.lit(0)).alias("warning_count"),
                    F.concat_ws(";", *texts).alias("warnings"))


def validation_summary(reports: DataFrame) -> DataFrame:
    """Over a report table: total, passed, failed, success rate, errors, warnings."""
    n = F.count(F.lit(1))
    passed = F.count_if(F.col("is_valid"))
    return reports.agg(
        n.alias("total_validations"),
        passed.alias("passed"),
        (n - passed).alias("failed"),
        F.when(n > 0, passed / n).otherwise(F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.sum("error_count"), F.lit(0)).cast("long").alias("total_errors"),
        F.coalesce(F.sum("warning_count"), F.lit(0)).cast("long").alias("total_warnings"),
    )


def coerce(df: DataFrame, stage: str = "cleaned", date_formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """The frame with its columns in the stage's types. A value that does not
    convert becomes null and is named in ``_uncoerced`` (array of columns)."""
    if stage == "raw":
        return df.withColumn("_uncoerced", F.array().cast("array<string>"))
    kinds = dict(df.dtypes)
    number = lambda c: parse_number(F.col(c))
    stamp = lambda c: (F.col(c) if kinds[c].startswith(("timestamp", "date")) else
                       F.coalesce(parse_timestamp(F.col(c), date_formats), F.col(c).try_cast("timestamp")))
    parsers = {"quantity": number, "unit_price": number, "total_amount": number, "order_date": stamp, "ingestion_timestamp": stamp}
    # a projection of its own: the ones above it name a parsed value several times
    parsed = df.withColumns({f"_as_{c}": parse(c) for c, parse in parsers.items() if c in df.columns})
    made = {c: F.col(f"_as_{c}") for c in parsers if c in df.columns}
    if "quantity" in made:
        q = made["quantity"]
        made["quantity"] = F.when(q == F.floor(q), q).try_cast("int")
    # a text column always converts; an array filter keeps this projection out of the method of the rows' join, which
    # would get too long for the JVM to compile
    lost = F.filter(F.array(*[F.when(F.col(c).isNotNull() & v.isNull(), F.lit(c)) for c, v in made.items()]).cast("array<string>"), lambda x: x.isNotNull())
    made |= {c: F.col(c).cast("string") for c in ("order_id", "product_name", "customer_id", "country") if c in df.columns}
    return parsed.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns], lost.alias("_uncoerced"))


def validate_dataframe(df: DataFrame, stage: str = "cleaned", lazy: bool = True):
    """(ok, typed frame or None, message or None). Values are brought to the
    stage's types first; one that does not convert is a failure, never an
    error. lazy=True gathers every failure in one pass; lazy=False stops at the
    first failing row."""
    problems = schema_problems(df, stage)
    if problems:
        return False, None, "; ".join(problems)
    typed = coerce(df, stage)
    data = typed.drop("_uncoerced", S.SOURCE_FILE)
    lost = typed.select(F.explode("_uncoerced").alias("column"))
    if lazy:
        bad = [(r["column"], "coerce", r["count"]) for r in lost.groupBy("column").count().orderBy("column").collect()]
        bad += [(r["column"], r["check"], r["failures"]) for r in rule_counts(data, stage, keep_zero=False).collect()]   # one row per rule
        if bad:
            return False, None, f"{stage}: {sum(n for *_, n in bad)} failing values; " + ", ".join(f"{c}/{k}: {n}" for c, k, n in bad)
        return True, typed.drop("_uncoerced"), None
    first = lost.take(1)
    if first:
        return False, None, f"{stage}: a value of {first[0]['column']} does not convert"
    first = failure_cases(data, stage).take(1)
    if first:
        r = first[0]
        return False, None, f"{stage}: {r['column']} breaks {r['check']} with {r['failure_case']}"
    return True, typed.drop("_uncoerced"), None
