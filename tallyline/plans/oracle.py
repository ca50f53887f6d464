"""The same queries stated in plain SQL (DuckDB dialect) for cross-checking.

Every query starts from the test tables; the CTE chain mirrors the DataFrame
operators step by step: raw rows -> null tokens -> file verdict -> dedupe ->
classify -> clean -> enrich -> gate -> keyed rows.
"""

from __future__ import annotations

from tallyline import schema as S
from tallyline.functions.text import _ranges
from tallyline.plans import group_queries, time_queries
from tallyline.sources import tables as T

AS_OF = "TIMESTAMP '2025-01-01 00:00:00'"
MIN_TS = "TIMESTAMP '2020-01-01 00:00:00'"
RUN_TS = "TIMESTAMP '2025-01-01 00:00:00'"
DELETE_BEFORE = "DATE '2022-01-01'"
NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ORD = "k1, k2, k3, k4, k5, k6"
DATA = S.REQUIRED_COLUMNS
NAN = "nan"  # text of a missing value after string conversion


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def qlist(xs) -> str:
    return ", ".join(q(x) for x in xs)


WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())   # str.isspace() set
WS_RUN = "[" + "".join(                                              # RE2 class of the same set
    f"\\x{{{a:04x}}}" if a == b else f"\\x{{{a:04x}}}-\\x{{{b:04x}}}" for a, b in _ranges(WS)) + "]+"


def strip(x: str) -> str:
    return f"trim({x}, {q(WS)})"


def squeeze(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{WS_RUN}', ' ', 'g')"


def fill(x: str, v: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {q(v)} ELSE {x} END"


def norm(x: str) -> str:
    return f"coalesce({squeeze(x)}, 'nan')"


def tok(x: str) -> str:
    return f"CASE WHEN {x} IN ({qlist(S.NULL_TOKENS)}) THEN NULL ELSE {x} END"


def country(x: str) -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in S.COUNTRY_ALIASES.items())
    key = f"lower({strip(f'coalesce({x}, {q(NAN)})')})"
    kept = f"CASE WHEN {x} IN ({qlist(S.VALID_COUNTRIES)}) THEN {x} ELSE 'Unknown' END"
    return f"coalesce(CASE {key} {arms} END, {kept})"


def ts(x: str) -> str:
    s = strip(x)
    return (f"coalesce(try_strptime({s}, '%Y-%m-%d'), try_strptime({s}, '%Y-%m-%d %H:%M:%S'), "
            f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S'))")


def num(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_full_match({s}, '{NUM_RE}') THEN try_cast({s} AS DOUBLE) END"


def r2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def money_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(12,2))) AS DOUBLE)"


# ---------------------------------------------------------------------------
# CTE building blocks
# ---------------------------------------------------------------------------


def _qty_case() -> str:
    arms = " ".join(f"WHEN l.l_suppkey % {m} = 0 THEN {q(t)}" for m, t in T.QUANTITY_FAULTS)
    return f"CASE {arms} ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END"


def _price_case() -> str:
    arms = " ".join(f"WHEN l.l_partkey % {m} = 0 THEN {q(t)}" for m, t in T.PRICE_FAULTS)
    return f"CASE {arms} ELSE CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END"


RAW = f"""raw AS (
  SELECT 'part-' || CAST(l.l_suppkey % {T.FILES} AS VARCHAR) AS source_file,
    l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4,
    l.l_quantity AS k5, l.l_extendedprice AS k6,
    CASE WHEN l.l_suppkey % {T.FILES} = {T.NULL_ID_FILE} AND l.l_orderkey % {T.NULL_ID_EVERY} = 0 THEN NULL
         WHEN l.l_orderkey % {T.BAD_ID_EVERY} = 0 THEN 'BAD-' || CAST(l.l_orderkey AS VARCHAR)
         ELSE 'ORD-' || printf('%06d', l.l_orderkey) END AS order_id,
    CASE WHEN l.l_partkey % {T.EMPTY_PRODUCT_EVERY} = 0 THEN ''
         WHEN l.l_partkey % {T.PADDED_PRODUCT_EVERY} = 0 THEN '  ' || replace(p.p_name, ' ', '  ') || '  '
         ELSE p.p_name END AS product_name,
    {_qty_case()} AS quantity,
    {_price_case()} AS unit_price,
    CASE WHEN l.l_orderkey % {T.BAD_DATE_EVERY} = 0 THEN 'invalid-date'
         ELSE strftime(o.o_orderdate + INTERVAL {T.DATE_SHIFT_MONTHS // 12} YEAR, '%Y-%m-%d') END AS order_date,
    CASE WHEN o.o_custkey % {T.EMPTY_CUSTOMER_EVERY} = 0 THEN ''
         WHEN o.o_custkey % {T.BAD_CUSTOMER_EVERY} = 0 THEN 'BAD'
         ELSE 'CUST-' || CAST(o.o_custkey + {T.CUSTOMER_BASE} AS VARCHAR) END AS customer_id,
    [{qlist(T.COUNTRY_BY_NATION)}][c.c_nationkey + 1] AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

NRAW = "nraw AS (SELECT source_file, " + ORD + ", " + ", ".join(f"{tok(c)} AS {c}" for c in DATA) + " FROM raw)"


def verdict(src: str, name: str = "verdict") -> str:
    return (f"{name} AS (SELECT source_file, count(*) AS total_rows, count_if(order_id IS NULL) AS null_order_ids "
            f"FROM {src} GROUP BY source_file)")


def chain(src: str, p: str = "") -> list[str]:
    """dedup -> cls -> clean -> enr -> gate CTEs over source CTE ``src``."""
    dedup = (f"{p}dedup AS (SELECT * EXCLUDE (rn, n), n - 1 AS dup_count FROM ("
             f"SELECT *, row_number() OVER (PARTITION BY source_file, order_id ORDER BY {ORD}) AS rn, "
             f"count(*) OVER (PARTITION BY source_file, order_id) AS n FROM {src}) WHERE rn = 1)")
    cls = (f"{p}cls AS (SELECT *, CASE "
           f"WHEN od_ts IS NULL OR od_ts > {AS_OF} OR od_ts < {MIN_TS} THEN 'invalid_date' "
           f"WHEN qn IS NULL OR pn IS NULL OR qn <= 0 OR pn <= 0 OR qn > {S.MAX_QUANTITY} OR pn > {S.MAX_UNIT_PRICE} "
           f"THEN 'invalid_numeric' END AS reject_reason FROM ("
           f"SELECT *, {ts('order_date')} AS od_ts, {num('quantity')} AS qn, {num('unit_price')} AS pn FROM {p}dedup))")
    clean = (f"{p}clean AS (SELECT source_file, {ORD}, order_id, "
             f"{norm(fill('product_name', S.DEFAULT_PRODUCT))} AS product_name, "
             f"CAST(trunc(qn) AS INTEGER) AS quantity, pn AS unit_price, CAST(od_ts AS DATE) AS order_date, "
             f"{norm(fill('customer_id', S.DEFAULT_CUSTOMER_ID))} AS customer_id, "
             f"{country(norm(fill('country', S.DEFAULT_COUNTRY)))} AS country "
             f"FROM {p}cls WHERE reject_reason IS NULL)")
    enr = (f"{p}enr AS (SELECT *, {r2('quantity * unit_price')} AS total_amount, "
           f"{RUN_TS} AS ingestion_timestamp FROM {p}clean)")
    nn = ["order_id", "product_name", "quantity", "unit_price_d", "order_date", "customer_id", "country", "total_d"]
    nn_names = dict(unit_price_d="unit_price", total_d="total_amount")
    arms = [f"WHEN {c} IS NULL THEN 'not_null:{nn_names.get(c, c)}'" for c in nn]
    arms += [f"WHEN length({c}) > {n} THEN 'too_long:{c}'" for c, n in
             [("order_id", S.ORDER_ID_MAX_LEN), ("product_name", S.PRODUCT_MAX_LEN),
              ("customer_id", S.CUSTOMER_ID_MAX_LEN), ("country", S.COUNTRY_MAX_LEN)]]
    arms += ["WHEN quantity <= 0 THEN 'quantity_not_positive'",
             "WHEN unit_price_d <= 0 THEN 'price_not_positive'",
             "WHEN total_d <> quantity * unit_price_d THEN 'total_mismatch'"]
    gate = (f"{p}gate AS (SELECT source_file, {ORD}, order_id, product_name, quantity, unit_price_d AS unit_price, "
            f"order_date, customer_id, country, total_d AS total_amount, ingestion_timestamp, "
            f"CASE {' '.join(arms)} END AS gate_reason FROM ("
            f"SELECT *, TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price_d, "
            f"TRY_CAST(total_amount AS DECIMAL(12,2)) AS total_d FROM {p}enr))")
    return [dedup, cls, clean, enr, gate]


TABLE_COLS = ", ".join(S.TABLE_COLUMNS)


def latest(gate: str, name: str) -> str:
    return (f"{name} AS (SELECT {TABLE_COLS} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY order_id ORDER BY source_file DESC) AS rn FROM {gate} WHERE gate_reason IS NULL) "
            f"WHERE rn = 1)")


def run_ctes(where: str = "", p: str = "") -> list[str]:
    """A whole run over the files selected by ``where`` (on nraw)."""
    sel = f"{p}rraw AS (SELECT * FROM nraw {where})"
    vd = verdict(f"{p}rraw", f"{p}verdict")
    valid = (f"{p}vraw AS (SELECT * FROM {p}rraw WHERE source_file IN "
             f"(SELECT source_file FROM {p}verdict WHERE null_order_ids = 0))")
    return [sel, vd, valid] + chain(f"{p}vraw", p)


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


BASE = [RAW, NRAW]
CLEAN_ALL = BASE + chain("raw")
RUN = BASE + run_ctes() + [latest("gate", "sales")]


# ---------------------------------------------------------------------------
# Rules (mirror of tallyline.operators.validate)
# ---------------------------------------------------------------------------


def _chk(c: str, ok: str) -> str:
    return f"{c} IS NOT NULL AND NOT coalesce({ok}, false)"


TYPED_RULES = [
    ("order_id", "not_null", "order_id IS NULL"),
    ("order_id", "str_matches", _chk("order_id", rf"regexp_matches(order_id, '{S.ORDER_ID_PATTERN}')")),
    ("product_name", "not_null", "product_name IS NULL"),
    ("product_name", "str_length", _chk("product_name", f"length(product_name) BETWEEN 1 AND {S.PRODUCT_MAX_LEN}")),
    ("quantity", "not_null", "quantity IS NULL"),
    ("quantity", "ge", _chk("quantity", f"quantity >= {S.MIN_QUANTITY}")),
    ("quantity", "le", _chk("quantity", f"quantity <= {S.MAX_QUANTITY}")),
    ("unit_price", "not_null", "unit_price IS NULL"),
    ("unit_price", "gt", _chk("unit_price", "unit_price > 0")),
    ("unit_price", "le", _chk("unit_price", f"unit_price <= {S.MAX_UNIT_PRICE}")),
    ("order_date", "not_null", "order_date IS NULL"),
    ("customer_id", "not_null", "customer_id IS NULL"),
    ("customer_id", "str_matches", _chk("customer_id", rf"regexp_matches(customer_id, '{S.CUSTOMER_ID_PATTERN}')")),
    ("country", "not_null", "country IS NULL"),
    ("country", "isin", _chk("country", f"country IN ({qlist(S.VALID_COUNTRIES)})")),
]
ENRICHED_RULES = TYPED_RULES + [
    ("total_amount", "not_null", "total_amount IS NULL"),
    ("total_amount", "gt", _chk("total_amount", "total_amount > 0")),
    ("ingestion_timestamp", "not_null", "ingestion_timestamp IS NULL"),
    ("*", "total_amount_calculation",
     f"NOT coalesce(abs(total_amount - quantity * unit_price) < {S.TOTAL_TOLERANCE}, false)"),
    ("total_amount", "calculation_error",
     f"coalesce(abs(total_amount - quantity * unit_price) > {S.TOTAL_TOLERANCE}, false)"),
]
RAW_RULES = [("order_id", "not_null", "order_id IS NULL")]


def rule_counts(src: str, rules, unique: bool, name: str) -> list[str]:
    """CTEs ``{name}_flat`` and ``{name}``: (source_file, column, check, failures)."""
    flat = (f"{name}_flat AS (SELECT source_file, "
            + ", ".join(f"count_if({e}) AS r{i}" for i, (_, _, e) in enumerate(rules))
            + f" FROM {src} GROUP BY source_file)")
    parts = [f"SELECT source_file, '{c}' AS \"column\", '{k}' AS \"check\", CAST(r{i} AS BIGINT) AS failures "
             f"FROM {name}_flat" for i, (c, k, _) in enumerate(rules)]
    if unique:
        parts.append(
            f"SELECT f.source_file, 'order_id' AS \"column\", 'unique' AS \"check\", "
            f"CAST(coalesce(d.failures, 0) AS BIGINT) AS failures FROM {name}_flat f LEFT JOIN ("
            f"SELECT source_file, sum(n) AS failures FROM (SELECT source_file, order_id, count(*) AS n FROM {src} "
            f"WHERE order_id IS NOT NULL GROUP BY source_file, order_id) WHERE n > 1 GROUP BY source_file) d "
            f"USING (source_file)")
    return [flat, f"{name} AS ({' UNION ALL '.join(parts)})"]


def stage_report(stage: str, schema_name: str, src: str, rc: str, warn: str | None) -> list[str]:
    errs = (f"{rc}_err AS (SELECT source_file, sum(CASE WHEN \"check\" = 'calculation_error' THEN 1 ELSE failures END) AS error_count, "
            f"array_to_string(list_sort(list(\"column\" || ':' || \"check\")), ';') AS first_errors "
            f"FROM {rc} WHERE failures > 0 GROUP BY source_file)")
    wjoin = f"LEFT JOIN {warn} w USING (source_file)" if warn else ""
    wcol = "coalesce(w.warning_count, 0)" if warn else "0"
    wtext = "coalesce(w.warnings, '')" if warn else "''"
    rep = (f"{rc}_rep AS (SELECT source_file, '{stage}' AS stage, '{schema_name}' AS schema_name, "
           f"CASE WHEN coalesce(e.error_count, 0) <> 0 THEN 'failed' WHEN s.total_rows = 0 THEN 'skipped' "
           f"WHEN {wcol} > 0 THEN 'warning' ELSE 'passed' END AS status, "
           f"coalesce(e.error_count, 0) = 0 AS is_valid, CAST(s.total_rows AS BIGINT) AS total_rows, "
           f"CAST(CASE WHEN coalesce(e.error_count, 0) = 0 THEN s.total_rows ELSE 0 END AS BIGINT) AS valid_rows, "
           f"CAST(CASE WHEN coalesce(e.error_count, 0) = 0 THEN 0 ELSE s.total_rows END AS BIGINT) AS invalid_rows, "
           f"CAST(coalesce(e.error_count, 0) AS BIGINT) AS error_count, CAST({wcol} AS BIGINT) AS warning_count, "
           f"coalesce(e.first_errors, '') AS first_errors, {wtext} AS warnings "
           f"FROM (SELECT source_file, count(*) AS total_rows FROM {src} GROUP BY source_file) s "
           f"LEFT JOIN {rc}_err e USING (source_file) {wjoin})")
    return [errs, rep]


def raw_warnings_body(src: str) -> str:
    return (
        f"SELECT source_file, CAST(CASE WHEN count_if(qn IS NOT NULL AND NOT coalesce(regexp_full_match({strip('qn')}, "
        f"'{NUM_RE}'), false)) > 0 THEN count_if(qn IS NOT NULL AND NOT regexp_full_match("
        f"replace(replace(qn, '-', ''), '.', ''), '^[0-9]+$')) ELSE 0 END AS BIGINT) AS non_numeric_quantity, "
        f"CAST(count_if(oidn IS NULL OR order_id = '') AS BIGINT) AS empty_order_ids "
        f"FROM (SELECT *, {tok('quantity')} AS qn, {tok('order_id')} AS oidn FROM {src}) GROUP BY source_file"
    )


def clean_stats_body(cls: str) -> str:
    fills = ", ".join(
        f"CAST(count_if(reject_reason IS NULL AND ({c} IS NULL OR {c} = '')) AS BIGINT) AS filled_{c}"
        for c in ("customer_id", "country", "product_name")
    )
    return (
        f"SELECT source_file, CAST(orig AS BIGINT) AS original_count, CAST(kept AS BIGINT) AS cleaned_count, "
        f"CAST(orig - kept AS BIGINT) AS rows_removed, CAST(dups AS BIGINT) AS duplicates_removed, "
        f"CAST(bad_dates AS BIGINT) AS invalid_dates_removed, CAST(bad_nums AS BIGINT) AS invalid_numerics_removed, "
        f"filled_customer_id, filled_country, filled_product_name, "
        f"CASE WHEN orig > 0 THEN CAST(orig - kept AS DOUBLE) / CAST(orig AS DOUBLE) ELSE 0.0 END AS removal_rate "
        f"FROM (SELECT source_file, count(*) + sum(dup_count) AS orig, count_if(reject_reason IS NULL) AS kept, "
        f"sum(dup_count) AS dups, count_if(reject_reason = 'invalid_date') AS bad_dates, "
        f"count_if(reject_reason = 'invalid_numeric') AS bad_nums, {fills} FROM {cls} GROUP BY source_file)"
    )


def quality_ctes(clean: str, cls: str, name: str = "qw") -> list[str]:
    orig = f"{name}_orig AS (SELECT source_file, count(*) + sum(dup_count) AS original_count FROM {cls} GROUP BY source_file)"
    body = (
        f"{name} AS (SELECT source_file, CAST(original_count AS BIGINT) AS original_count, "
        f"CAST(n AS BIGINT) AS cleaned_count, loss AS data_loss_ratio, coalesce(loss > {S.DATA_LOSS_WARN_RATIO}, false) AS warn_data_loss, "
        f"CAST(uc AS BIGINT) AS unknown_customers, uc > n * {S.UNKNOWN_SHARE_WARN} AS warn_unknown_customers, "
        f"CAST(uk AS BIGINT) AS unknown_countries, uk > n * {S.UNKNOWN_SHARE_WARN} AS warn_unknown_countries, "
        f"span AS date_span_days, coalesce(span > {S.DATE_SPAN_WARN_DAYS}, false) AS warn_date_span FROM ("
        f"SELECT a.*, o.original_count, CASE WHEN coalesce(o.original_count, 0) > 0 THEN "
        f"1.0 - CAST(a.n AS DOUBLE) / CAST(o.original_count AS DOUBLE) END AS loss FROM ("
        f"SELECT source_file, count(*) AS n, count_if(customer_id = '{S.DEFAULT_CUSTOMER_ID}') AS uc, "
        f"count_if(country = '{S.DEFAULT_COUNTRY}') AS uk, CAST(date_diff('day', min(order_date), max(order_date)) AS BIGINT) AS span "
        f"FROM {clean} GROUP BY source_file) a LEFT JOIN {name}_orig o USING (source_file)))"
    )
    return [orig, body]


def report_ctes() -> list[str]:
    """raw / cleaned / enriched stage reports of the run (needs RUN ctes)."""
    out = []
    out += rule_counts("rraw", RAW_RULES, False, "rc_raw")
    out.append("w_raw AS (SELECT source_file, CAST(non_numeric_quantity > 0 AS INTEGER) + "
               f"CAST(empty_order_ids > 0 AS INTEGER) AS warning_count, concat_ws(';', "
               "CASE WHEN non_numeric_quantity > 0 THEN 'non_numeric_quantity:' || non_numeric_quantity END, "
               "CASE WHEN empty_order_ids > 0 THEN 'empty_order_ids:' || empty_order_ids END) AS warnings "
               f"FROM ({raw_warnings_body('rraw')}))")
    out += stage_report("raw", "RawSalesSchema", "rraw", "rc_raw", "w_raw")
    out += rule_counts("clean", TYPED_RULES, True, "rc_clean")
    out += quality_ctes("clean", "cls")
    out.append("w_clean AS (SELECT source_file, CAST(warn_data_loss AS INTEGER) + CAST(warn_unknown_customers AS INTEGER) "
               "+ CAST(warn_unknown_countries AS INTEGER) + CAST(warn_date_span AS INTEGER) AS warning_count, concat_ws(';', "
               "CASE WHEN warn_data_loss THEN 'data_loss' END, CASE WHEN warn_unknown_customers THEN 'unknown_customers:' || unknown_customers END, "
               "CASE WHEN warn_unknown_countries THEN 'unknown_countries:' || unknown_countries END, "
               "CASE WHEN warn_date_span THEN 'date_span:' || date_span_days END) AS warnings FROM qw)")
    out += stage_report("cleaned", "CleanedSalesSchema", "clean", "rc_clean", "w_clean")
    out += rule_counts("enr", ENRICHED_RULES, True, "rc_enr")
    out += stage_report("enriched", "EnrichedSalesSchema", "enr", "rc_enr", None)
    out.append("reports AS (SELECT * FROM rc_raw_rep UNION ALL SELECT * FROM rc_clean_rep "
               "UNION ALL SELECT * FROM rc_enr_rep)")
    return out


def enrich_stats_body(enr: str) -> str:
    return (f"SELECT source_file, row_count, 'total_amount,ingestion_timestamp' AS fields_added, "
            f"{r2('coalesce(rev, 0.0)')} AS total_revenue, {r2('coalesce(rev / CAST(row_count AS DOUBLE), 0.0)')} "
            f"AS avg_order_value FROM (SELECT source_file, count(*) AS row_count, {money_sum('total_amount')} AS rev "
            f"FROM {enr} GROUP BY source_file)")


def aggregates_body(by: str) -> str:
    return (f"SELECT {by}, total_orders, total_units, {r2('rev')} AS total_revenue, "
            f"{r2('rev / CAST(n AS DOUBLE)')} AS avg_order_value, {r2('mn')} AS min_order, {r2('mx')} AS max_order, "
            f"unique_customers FROM (SELECT {by}, count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units, "
            f"{money_sum('total_amount')} AS rev, count(total_amount) AS n, min(total_amount) AS mn, "
            f"max(total_amount) AS mx, count(DISTINCT customer_id) AS unique_customers FROM enr "
            f"WHERE {by} IS NOT NULL GROUP BY {by})")


DATA_OUT = "source_file, " + ", ".join(DATA)
AVG_TOTAL = "CAST(sum(total_amount) AS DOUBLE) / CAST(count(*) AS DOUBLE)"


def _two_runs() -> list[str]:
    first = run_ctes("WHERE source_file IN ('part-0', 'part-1')", "a_") + [latest("a_gate", "a_sales")]
    second = run_ctes("WHERE source_file NOT IN ('part-0', 'part-1')", "b_") + [latest("b_gate", "b_inc")]
    return BASE + first + second


def _coerced(src: str) -> str:
    whole = f"CASE WHEN {num('quantity')} = floor({num('quantity')}) THEN TRY_CAST({num('quantity')} AS INTEGER) END"
    return (f"typed AS (SELECT source_file, {ORD}, order_id, product_name, {whole} AS quantity, {num('unit_price')} AS unit_price, "
            f"{ts('order_date')} AS order_date, customer_id, country, quantity AS raw_quantity, unit_price AS raw_price, "
            f"order_date AS raw_date FROM {src})")


def _faults() -> str:
    return ("faulty AS (SELECT *, CASE WHEN k4 % 11 = 0 THEN NULL WHEN k4 % 13 = 0 THEN quantity * unit_price + 5 "
            "ELSE quantity * unit_price END AS total_amount FROM (SELECT source_file, k4, order_id, "
            "CASE WHEN k3 % 5 = 0 THEN repeat(product_name, 60) ELSE product_name END AS product_name, "
            "CASE WHEN k4 % 7 = 0 THEN quantity * 1000 ELSE quantity END AS quantity, "
            "CASE WHEN k3 % 19 = 0 THEN NULL WHEN k3 % 7 = 0 THEN unit_price * 1000 ELSE unit_price END AS unit_price, order_date, customer_id, country, "
            f"CASE WHEN k4 % 3 <> 0 THEN {RUN_TS} END AS ingestion_timestamp FROM typed))")


ORACLE_SQL: dict[str, str] = {
    "null_tokens": with_(BASE, "SELECT source_file, " + ", ".join(
        f"count_if({c} IS NULL) AS {c}_nulls" for c in DATA) + " FROM nraw GROUP BY source_file"),
    "raw_file_verdict": with_(BASE + [verdict("nraw")],
        "SELECT source_file, total_rows, null_order_ids, CAST(0 AS BIGINT) AS malformed_rows, "
        "'' AS missing_columns, null_order_ids = 0 AS is_valid FROM verdict"),
    "raw_warnings": with_(BASE, raw_warnings_body("raw")),
    "check_counts": with_(CLEAN_ALL + rule_counts("enr", ENRICHED_RULES, True, "rc"),
        "SELECT * FROM rc"),
    "check_unique": with_(BASE + [
        "u AS (SELECT source_file, sum(n) AS failures FROM (SELECT source_file, order_id, count(*) AS n FROM raw "
        "WHERE order_id IS NOT NULL GROUP BY source_file, order_id) WHERE n > 1 GROUP BY source_file)"],
        "SELECT f.source_file, 'order_id' AS \"column\", 'unique' AS \"check\", "
        "CAST(coalesce(u.failures, 0) AS BIGINT) AS failures FROM (SELECT DISTINCT source_file FROM raw) f "
        "LEFT JOIN u USING (source_file)"),
    "check_coerce": with_(BASE + [
        "cc AS (SELECT source_file, "
        f"count_if(quantity IS NOT NULL AND NOT coalesce(regexp_full_match({strip('quantity')}, '^[+-]?\\d+$'), false)) AS quantity, "
        f"count_if(unit_price IS NOT NULL AND NOT coalesce(regexp_full_match({strip('unit_price')}, '{NUM_RE}'), false)) AS unit_price, "
        f"count_if(order_date IS NOT NULL AND {ts('order_date')} IS NULL) AS order_date FROM nraw GROUP BY source_file)"],
        " UNION ALL ".join(f"SELECT source_file, '{c}' AS \"column\", 'coerce' AS \"check\", CAST({c} AS BIGINT) AS failures FROM cc"
                           for c in ("quantity", "unit_price", "order_date"))),
    "quality_warnings": with_(CLEAN_ALL + quality_ctes("clean", "cls"), "SELECT * FROM qw"),
    "validation_report": with_(RUN + report_ctes(), "SELECT * FROM reports"),
    "failure_cases": with_(CLEAN_ALL, " UNION ALL ".join(
        [f"SELECT source_file, '{c}' AS \"column\", '{k}' AS \"check\", "
         f"{'NULL' if c == '*' else f'left(CAST({c} AS VARCHAR), 100)'} AS failure_case FROM enr WHERE {e}"
         for c, k, e in ENRICHED_RULES]
        + ["SELECT e.source_file, 'order_id', 'unique', e.order_id FROM enr e JOIN ("
           "SELECT source_file, order_id FROM enr WHERE order_id IS NOT NULL GROUP BY source_file, order_id "
           "HAVING count(*) > 1) d ON e.source_file = d.source_file AND e.order_id = d.order_id"])),
    "validation_summary": with_(RUN + report_ctes(),
        "SELECT count(*) AS total_validations, count_if(is_valid) AS passed, count(*) - count_if(is_valid) AS failed, "
        "CASE WHEN count(*) > 0 THEN CAST(count_if(is_valid) AS DOUBLE) / CAST(count(*) AS DOUBLE) ELSE 0.0 END AS success_rate, "
        "CAST(coalesce(sum(error_count), 0) AS BIGINT) AS total_errors, "
        "CAST(coalesce(sum(warning_count), 0) AS BIGINT) AS total_warnings FROM reports"),
    "clean_dedup": with_(CLEAN_ALL, f"SELECT {DATA_OUT}, dup_count FROM dedup"),
    "clean_dates": with_(BASE, f"SELECT source_file, order_id, product_name, quantity, unit_price, "
        f"CAST(od_ts AS DATE) AS order_date, customer_id, country FROM (SELECT *, {ts('order_date')} AS od_ts FROM raw) "
        f"WHERE od_ts IS NOT NULL AND od_ts <= {AS_OF} AND od_ts >= {MIN_TS}"),
    "clean_numerics": with_(BASE, f"SELECT source_file, order_id, product_name, CAST(trunc(qn) AS INTEGER) AS quantity, "
        f"pn AS unit_price, order_date, customer_id, country FROM (SELECT *, {num('quantity')} AS qn, "
        f"{num('unit_price')} AS pn FROM raw) WHERE qn IS NOT NULL AND pn IS NOT NULL AND qn > 0 AND pn > 0 "
        f"AND qn <= {S.MAX_QUANTITY} AND pn <= {S.MAX_UNIT_PRICE}"),
    "clean_fill": with_(BASE, f"SELECT source_file, order_id, {fill('product_name', S.DEFAULT_PRODUCT)} AS product_name, "
        f"quantity, unit_price, order_date, {fill('customer_id', S.DEFAULT_CUSTOMER_ID)} AS customer_id, "
        f"{fill('country', S.DEFAULT_COUNTRY)} AS country FROM raw"),
    "clean_strings": with_(BASE, f"SELECT source_file, order_id, {norm('product_name')} AS product_name, quantity, "
        f"unit_price, order_date, {norm('customer_id')} AS customer_id, {norm('country')} AS country FROM raw"),
    "clean_countries": with_(BASE, f"SELECT source_file, order_id, product_name, quantity, unit_price, order_date, "
        f"customer_id, {country('country')} AS country FROM raw"),
    "drop_empty_rows": with_(BASE, f"SELECT {DATA_OUT} FROM nraw WHERE NOT (" + " AND ".join(
        f"{c} IS NULL" for c in DATA) + ")"),
    "clean_full": with_(CLEAN_ALL, f"SELECT {DATA_OUT} FROM clean"),
    "clean_stats": with_(CLEAN_ALL, clean_stats_body("cls")),
    "enrich_total": with_(CLEAN_ALL, f"SELECT {DATA_OUT}, total_amount FROM enr"),
    "enrich_full": with_(CLEAN_ALL, f"SELECT {DATA_OUT}, total_amount, ingestion_timestamp FROM enr"),
    "enrich_date_parts": with_(CLEAN_ALL, f"SELECT {DATA_OUT}, CAST(year(order_date) AS BIGINT) AS order_year, "
        f"CAST(month(order_date) AS BIGINT) AS order_month, CAST(day(order_date) AS BIGINT) AS order_day, "
        f"dayname(order_date) AS order_weekday FROM clean"),
    "enrich_category": with_(CLEAN_ALL, f"SELECT {DATA_OUT}, total_amount, CASE "
        + " ".join(f"WHEN total_amount < {b} THEN '{n}'" for b, n in S.REVENUE_CLASSES)
        + f" ELSE '{S.REVENUE_TOP_CLASS}' END AS revenue_category FROM enr"),
    "enrich_stats": with_(CLEAN_ALL, enrich_stats_body("enr")),
    "agg_by_country": with_(CLEAN_ALL, aggregates_body("country")),
    "agg_by_product": with_(CLEAN_ALL, aggregates_body("product_name")),
    "running_totals": with_(CLEAN_ALL, "SELECT source_file, order_id, order_date, total_amount, "
        "CAST(sum(CAST(total_amount AS DECIMAL(12,2))) OVER w AS DOUBLE) AS running_revenue, "
        "row_number() OVER w AS running_orders FROM enr WINDOW w AS (ORDER BY order_date ASC NULLS LAST, "
        "order_id ASC NULLS LAST, source_file ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    "daily_summary": with_(CLEAN_ALL, f"SELECT order_date AS date, count(order_id) AS orders, "
        f"{r2(money_sum('total_amount'))} AS revenue, CAST(sum(quantity) AS BIGINT) AS units, "
        f"count(DISTINCT customer_id) AS customers FROM enr WHERE order_date IS NOT NULL GROUP BY order_date"),
    "v_daily_sales": with_(RUN, f"SELECT order_date, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units, "
        f"CAST(sum(total_amount) AS DOUBLE) AS total_revenue, {AVG_TOTAL} AS avg_order_value, "
        f"count(DISTINCT customer_id) AS unique_customers, count(DISTINCT country) AS countries_served "
        f"FROM sales GROUP BY order_date ORDER BY order_date DESC"),
    "v_product_performance": with_(RUN, "SELECT product_name, count(*) AS total_orders, "
        "CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(total_amount) AS DOUBLE) AS total_revenue, "
        "CAST(sum(unit_price) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_unit_price, "
        "CAST(sum(quantity) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_quantity_per_order "
        "FROM sales GROUP BY product_name ORDER BY total_revenue DESC, product_name"),
    "v_country_analysis": with_(RUN, f"SELECT country, count(*) AS total_orders, "
        f"CAST(sum(total_amount) AS DOUBLE) AS total_revenue, {AVG_TOTAL} AS avg_order_value, "
        f"count(DISTINCT customer_id) AS unique_customers, min(order_date) AS first_order_date, "
        f"max(order_date) AS last_order_date FROM sales GROUP BY country ORDER BY total_revenue DESC, country"),
    "summary_stats": with_(RUN, f"SELECT count(*) AS total_orders, coalesce(CAST(sum(total_amount) AS DOUBLE), 0.0) "
        f"AS total_revenue, coalesce({AVG_TOTAL}, 0.0) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers, "
        f"count(DISTINCT country) AS countries, min(order_date) AS first_order, max(order_date) AS last_order FROM sales"),
    "row_count": with_(RUN, "SELECT count(*) AS row_count FROM sales"),
    "date_range": with_(RUN, "SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM sales"),
    "orders_exist": with_(RUN, "SELECT p.order_id, s.order_id IS NOT NULL AS order_exists FROM "
        "(SELECT 'ORD-' || printf('%06d', o_orderkey) AS order_id FROM orders) p "
        "LEFT JOIN (SELECT DISTINCT order_id FROM sales) s ON p.order_id = s.order_id"),
    "dashboard_totals": with_(RUN, "SELECT count(*) AS total_orders, coalesce(CAST(sum(total_amount) AS DOUBLE), 0.0) "
        "AS total_revenue, count(DISTINCT country) AS countries FROM sales"),
    "top_products": with_(RUN, "SELECT product_name, CAST(sum(total_amount) AS DOUBLE) AS total_revenue, "
        "CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(*) AS total_orders FROM sales "
        "GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10"),
    "aov_by_country": with_(RUN, f"SELECT country, {AVG_TOTAL} AS avg_order_value FROM sales GROUP BY country"),
    "daily_change": with_(RUN, "SELECT order_date, total_orders, CAST(rev AS DOUBLE) AS total_revenue, "
        "CAST(lag(rev) OVER (ORDER BY order_date) AS DOUBLE) AS prev_revenue, "
        "CAST(rev - lag(rev) OVER (ORDER BY order_date) AS DOUBLE) AS revenue_change FROM "
        "(SELECT order_date, sum(total_amount) AS rev, count(*) AS total_orders FROM sales GROUP BY order_date)"),
    "sample_sales": with_(RUN, f"SELECT {TABLE_COLS} FROM sales ORDER BY order_id ASC NULLS LAST LIMIT 5"),
    "load_gate": with_(CLEAN_ALL, "SELECT source_file, order_id, quantity, unit_price, total_amount, gate_reason FROM gate"),
    "upsert": with_(_two_runs(), f"SELECT {TABLE_COLS} FROM a_sales t WHERE NOT EXISTS "
        f"(SELECT 1 FROM b_inc i WHERE i.order_id = t.order_id) UNION ALL SELECT {TABLE_COLS} FROM b_inc"),
    "load_counts": with_(_two_runs(), "SELECT ins AS rows_inserted, upd AS rows_updated, failed AS rows_failed, "
        "ins + upd AS total_processed FROM (SELECT count_if(t.order_id IS NULL) AS ins, "
        "count_if(t.order_id IS NOT NULL) AS upd FROM b_inc i LEFT JOIN (SELECT DISTINCT order_id FROM a_sales) t "
        "ON i.order_id = t.order_id) x, (SELECT count(*) AS failed FROM b_gate WHERE gate_reason IS NOT NULL) y"),
    "delete_before": with_(RUN, f"SELECT count_if(order_date < {DELETE_BEFORE}) AS rows_deleted, "
        f"count_if(NOT (order_date < {DELETE_BEFORE}) OR order_date IS NULL) AS rows_left FROM sales"),
    "run_enriched": with_(RUN, f"SELECT {DATA_OUT}, total_amount, ingestion_timestamp FROM enr"),
    "run_summary": with_(RUN, "SELECT 'pinned' AS run_id, count(*) AS files_detected, count_if(is_valid) AS files_valid, "
        "count_if(NOT is_valid) AS files_invalid, CAST(coalesce(sum(ok_rows), 0) AS BIGINT) AS rows_loaded, "
        "CAST(coalesce(sum(bad_rows), 0) AS BIGINT) AS rows_failed, count_if(is_valid) AS files_archived, "
        "CASE WHEN coalesce(sum(bad_rows), 0) = 0 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END AS status FROM ("
        "SELECT v.source_file, v.null_order_ids = 0 AS is_valid, g.ok_rows, g.bad_rows FROM verdict v LEFT JOIN ("
        "SELECT source_file, count_if(gate_reason IS NULL) AS ok_rows, count_if(gate_reason IS NOT NULL) AS bad_rows "
        "FROM gate GROUP BY source_file) g USING (source_file))"),
    "file_report": with_(RUN + ["cs AS (" + clean_stats_body("cls") + ")", "es AS (" + enrich_stats_body("enr") + ")"],
        "SELECT cs.source_file, original_count, cleaned_count, CAST(coalesce(es.row_count, 0) AS BIGINT) AS enriched_count, "
        "coalesce(es.total_revenue, 0.0) AS total_revenue, duplicates_removed, invalid_dates_removed, "
        "invalid_numerics_removed, removal_rate FROM cs LEFT JOIN es USING (source_file)"),
    "load_rejects": with_(_two_runs(), "SELECT source_file, order_id, gate_reason FROM b_gate WHERE gate_reason IS NOT NULL"),
    "quarantine": with_(RUN, " UNION ALL ".join([
        f"SELECT r.source_file, {', '.join('r.' + c for c in DATA)}, 'file' AS stage, 'null_order_ids' AS reason "
        "FROM rraw r JOIN verdict v ON v.source_file = r.source_file WHERE v.null_order_ids > 0",
        f"SELECT source_file, {', '.join(DATA)}, 'clean', reject_reason FROM cls WHERE reject_reason IS NOT NULL",
        f"SELECT source_file, {', '.join(f'CAST({c} AS VARCHAR)' for c in DATA)}, 'load', gate_reason "
        "FROM gate WHERE gate_reason IS NOT NULL"])),
    "coerced": with_(BASE + [_coerced("nraw")], f"SELECT {DATA_OUT}, concat_ws(',', "
        "CASE WHEN raw_quantity IS NOT NULL AND quantity IS NULL THEN 'quantity' END, "
        "CASE WHEN raw_price IS NOT NULL AND unit_price IS NULL THEN 'unit_price' END, "
        "CASE WHEN raw_date IS NOT NULL AND order_date IS NULL THEN 'order_date' END) AS uncoerced FROM typed"),
    "check_counts_faults": with_(BASE + [_coerced("nraw"), _faults()] + rule_counts("faulty", ENRICHED_RULES, True, "rc"), "SELECT * FROM rc"),
    "schema_problems": with_(BASE, "SELECT DISTINCT source_file, 'cleaned:extra_column:ingestion_timestamp;cleaned:extra_column:total_amount;"
        "enriched:missing_column:total_amount;raw:missing_column:country;raw:missing_column:quantity' AS problems FROM raw"),
    "drop_empty_rows_faults": with_(BASE, "SELECT source_file, count(*) AS rows_left FROM nraw WHERE k4 % 3 <> 0 AND NOT ("
        + " AND ".join(f"{c} IS NULL" for c in DATA) + ") GROUP BY source_file"),
}

# The first rows of each view, by its key.
ORACLE_SQL |= {f"sample_{v}": f"SELECT * FROM ({ORACLE_SQL['v_' + v]}) ORDER BY {k} NULLS LAST LIMIT 5" for v, k in (
    ("daily_sales", "order_date"), ("product_performance", "product_name"), ("country_analysis", "country"))}

ORACLE_SQL |= time_queries.ORACLE_SQL | {"stream_first_orders": time_queries.first_orders_sql(RAW)}
ORACLE_SQL |= {name: with_(RUN, body) if body.startswith("SELECT") else with_([*RUN, body[:body.index("\nSELECT")]], body[body.index("\nSELECT") + 1:])
               for name, body in group_queries.SALES_SQL.items()}
ORACLE_SQL |= {name: with_([RAW], body) for name, body in group_queries.RAW_SQL.items()}


def _sketch_sql(by: str, column: str) -> str:
    return with_(RUN, f"SELECT {column} AS {by}, count(*) AS total_orders, true AS distinct_within, true AS p50_within, true AS p90_within FROM sales GROUP BY 1")


def _view_sql(key: str) -> str:
    return with_(RUN, f"""SELECT {key}, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
  CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers,
  min(order_date) AS first_order_date, max(order_date) AS last_order_date FROM sales WHERE order_date >= {DELETE_BEFORE} GROUP BY {key}""")


def _event_records_sql(body: str) -> str:
    """The texts of the events, and what each is by the rule that made it."""
    whole = """'{' || CASE WHEN event_id % 13 = 0 THEN '' ELSE '"id":' || event_id || ',' END || '"type":"' || event_type || '","props":' ||
  CASE WHEN event_id % 19 = 0 THEN '"none"' ELSE props END || CASE WHEN event_id % 7 = 0 THEN ',"shard":' || event_id % 5 ELSE '' END || '}'"""
    return f"""WITH texts AS (SELECT *, {whole} AS whole FROM events),
records AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN '[' || whole || ']' WHEN event_id % 11 = 0 THEN whole[:-2] ELSE whole END AS record,
  CASE WHEN event_id % 17 = 0 THEN 'not_an_object' WHEN event_id % 11 = 0 THEN 'not_json' WHEN event_id % 13 = 0 THEN 'missing:id' END AS reject_reason FROM texts)
{body}"""


ORACLE_SQL |= {
    "sketch_countries": _sketch_sql("country", "country"),
    "sketch_months": _sketch_sql("month", "strftime(order_date, '%Y-%m')"),
    "view_country_after_loads": _view_sql("country"),
    "view_product_after_loads": _view_sql("product_name"),
    "result_records": with_(BASE + [_coerced("nraw"), _faults()] + rule_counts("faulty", ENRICHED_RULES, True, "rc"),
                            'SELECT source_file, CAST(sum(sum(failures)) OVER (PARTITION BY source_file) AS BIGINT) AS file_errors, "check", '
                            'CAST(sum(failures) AS BIGINT) AS failures FROM rc GROUP BY source_file, "check"'),
    "event_records": _event_records_sql("""SELECT event_id AS id, event_type AS type, CASE WHEN event_id % 19 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 5 AS VARCHAR) END AS shard, CAST(event_id % 7 = 0 AS INTEGER) AS n_unknown FROM records WHERE reject_reason IS NULL"""),
    "event_record_rejects": _event_records_sql("SELECT record, reject_reason FROM records WHERE reject_reason IS NOT NULL"),
}
