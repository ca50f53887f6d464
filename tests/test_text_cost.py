"""What reading raw text costs: the results of the short ways, and plans that name a text once."""

from datetime import datetime

from pyspark.sql import functions as F

from sales_rows import SF_SMALL
from tallyline.functions import null_tokens, parse_timestamp, squeeze_ws, strip_ws
from tallyline.functions.parse import DATE_FORMATS
from tallyline.functions.text import WHITESPACE
from tallyline.operators import validate as V
from tallyline.operators.clean import CleanConfig, clean
from tallyline.plans import catalog as C

LONGEST_COMPILED = 8000      # bytes of a method; the JVM interprets longer ones


def _executed(df):
    return df._jdf.queryExecution().executedPlan()


def _column(spark, texts, made):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in rows.select("i", made(F.col("t")).alias("x")).orderBy("i").collect()]


def test_strip_takes_all_white_space_at_both_ends(spark):
    texts = ["", "a", "a b", "é", "日本", "\x7f", "~", "!", *[x for ch in WHITESPACE for x in (ch, ch + "a", "a" + ch, "é" + ch, ch + "a b" + ch)]]
    assert _column(spark, texts + [None], strip_ws) == [t.strip() for t in texts] + [None]


def test_null_tokens_of_any_length(spark):
    assert _column(spark, ["", "NA", "#N/A N/A", "-1.#QNAN", "NA NA NA NA", "é", None], null_tokens) == [None] * 4 + ["NA NA NA NA", "é", None]
    assert _column(spark, ["long token here", "NA"], lambda c: null_tokens(c, ["long token here"])) == [None, "NA"]


def test_dates_read_as_the_formats_do(spark):
    texts = ["2024-01-15", "2024-1-5", " 2024-01-15\t", "2024-02-30", "2024-13-01", "2024-00-10", "0000-01-01", "0999-01-01", "12024-01-01", "+12024-01-01",
             "-2024-01-01", "2024-01-15 10:20:30", "2024-01-15T10:20:30", "2024-01-15T", "2024-01-15 ", "2024-01", "2024", "invalid-date", "20240115",
             "24-01-15", "2024-1-15 10:20", "2024-001-15", "２０２４-01-15", "", None]
    tried = lambda c: F.coalesce(*[F.try_to_timestamp(strip_ws(c), F.lit(f)) for f in DATE_FORMATS])
    shown = lambda made: _column(spark, texts, lambda c: made(c).cast("string"))
    assert shown(parse_timestamp) == shown(tried)
    other = ("d/M/yyyy", "yyyy-M-d")
    assert _column(spark, ["3/4/2024", "2024-04-03", "x"], lambda c: parse_timestamp(c, other)) == [datetime(2024, 4, 3), datetime(2024, 4, 3), None]


def test_a_filter_on_the_reason_does_not_parse_again(spark):
    raw = spark.read.schema("source_file string, row_ordinal long, " + ", ".join(f"{c} string" for c in C.DATA)).parquet(SF_SMALL + "/orders.parquet")
    plan = _executed(clean(raw, CleanConfig(as_of=datetime(2025, 1, 1))).cleaned).toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line.upper() or "gettimestamp" in line for line in filters), filters


def test_rule_counts_read_their_rows_once(spark):
    plan = _executed(C.q_check_counts(spark, SF_SMALL)).toString()
    assert plan.count("FileScan parquet") == 4, plan      # line items, orders, customers, parts


def test_unique_counts_leave_out_null_keys_and_sum_hot_ones(spark):
    rows = [("f", "A")] * 300 + [("f", "B"), ("f", None), ("f", None), ("g", "A"), (None, "C"), (None, "C")]
    got = {(r.source_file, r.check): r.failures for r in V.rule_counts(
        spark.createDataFrame(rows, "source_file string, order_id string").repartition(5), "cleaned").collect()}
    assert got[("f", "unique")] == 300 and got[("g", "unique")] == 0 and got[(None, "unique")] == 0
    assert got[("f", "not_null")] == 2


def test_coercion_parses_a_text_once_in_methods_that_get_compiled(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # else the plan has no code before it runs
    try:
        df = C.q_coerced(spark, SF_SMALL)
        plan = _executed(df)
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) <= LONGEST_COMPILED
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    typed, below = df._jdf.queryExecution().optimizedPlan().toString().split("+- Project", 1)
    assert "RLIKE" not in typed and "RLIKE" in below, typed


def test_coercion_names_what_it_loses(spark):
    rows = [("A", "p", "2", "1.5", "2024-01-05", "c", "Canada"), ("B", "p", "2.5", "x", "soon", None, "é"), ("C", None, None, None, None, "c", ""),
            ("D", "p", " 3 ", "1e2", "2024-01-05 10:00:00", "c", "x"), ("E", "p", "99999999999", "NaN", "2024-02-30", "c", "x")]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.DATA))
    got = {r.order_id: r for r in V.coerce(raw).collect()}
    assert [got[k]["_uncoerced"] for k in "ABCDE"] == [
        [], ["quantity", "unit_price", "order_date"], [], [], ["quantity", "unit_price", "order_date"]]
    assert (got["D"].quantity, got["D"].unit_price, got["D"].order_date) == (3, 100.0, datetime(2024, 1, 5, 10))
    assert (got["B"].quantity, got["B"].order_date, got["B"].country) == (None, None, "é")


def test_squeeze_equals_split_and_join(spark):
    texts = ["", " ", "a", "a b", "a  b", " a b ", "é", "é  ü", "日 本", "a\tb", "a\x7fb", "~ !", "a \t b", *[x for ch in WHITESPACE for x in (f"a{ch}b", f"a {ch}b", f"{ch}a b", f"a b{ch}")]]
    assert _column(spark, texts + [None], squeeze_ws) == [" ".join(t.split()) for t in texts] + [None]


def test_cleaning_squeezes_each_text_once_and_only_where_needed(spark):
    raw = spark.read.schema("source_file string, row_ordinal long, " + ", ".join(f"{c} string" for c in C.DATA)).parquet(SF_SMALL + "/orders.parquet")
    plan = _executed(clean(raw, CleanConfig(as_of=datetime(2025, 1, 1))).cleaned).toString()
    assert plan.count("regexp_replace(") == 3, plan          # product, customer, country
    plain = spark.createDataFrame([("a b",)], "t string").select(squeeze_ws(F.col("t")))
    assert "CASE WHEN (Contains(" in _executed(plain).toString()
