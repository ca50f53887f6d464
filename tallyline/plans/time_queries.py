"""Registered queries over time: values in force, periods, windows and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.operators.temporal import asof_join, interval_join, micros
from tallyline.sources.tables import raw_sales
from tallyline.streaming.event_time import first_per_key, sessions, stream_sessions, windowed_totals
from tallyline.streaming.replay import kept_result, replay

HOUR_US = 3_600_000_000


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def price_list(spark, d):
    """The unit price of a part as each day's last delivery shows it."""
    line = _table(spark, d, "lineitem")
    return line.select("l_partkey", F.col("l_shipdate").alias("price_date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                       "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


PRICE_TIE = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]


def ordered_lines(spark, d):
    line = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    orders = _table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("order_date"))
    return line.join(orders, "l_orderkey")


def q_asof_price(spark, d):
    """Every ordered line with the price of its part that was known on the order's date."""
    return asof_join(ordered_lines(spark, d), price_list(spark, d), ["l_partkey"], "order_date", "price_date", ["price"], PRICE_TIE)


def q_asof_click(spark, d):
    """Every purchase with the user's last click before it, not older than six hours."""
    events = _table(spark, d, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    return asof_join(bought, clicks, ["user_id"], "ts", "click_ts", ["click_id"], strict=True, tolerance_us=6 * HOUR_US)


def price_periods(spark, d):
    """Each price with the day from which it holds and the next price's; the last has no end. A part's days are its own
    deliveries, so the window is over the part's price days, not over its lines."""
    from pyspark.sql import Window

    days = price_list(spark, d).groupBy("l_partkey", "price_date").agg(F.max(F.struct(*PRICE_TIE, "price")).alias("x"))
    nxt = F.lead("price_date").over(Window.partitionBy("l_partkey").orderBy("price_date"))
    return days.select("l_partkey", "price_date", F.col("x.price").alias("price"), nxt.alias("until"))


def q_lines_in_price_periods(spark, d):
    return interval_join(ordered_lines(spark, d), price_periods(spark, d), ["l_partkey"], "order_date", "price_date", "until")


def q_events_in_periods(spark, d):
    """A signup opens a period of `value` hours for its user: all events inside, periods overlap."""
    events = _table(spark, d, "events")
    length = F.round(F.col("value") * HOUR_US).cast("long")
    periods = events.where("event_type = 'signup'").select(
        F.col("event_id").alias("period_id"), "user_id", F.col("ts").alias("begins"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + length).alias("ends"))
    points = events.select("event_id", "user_id", "event_type", "ts")
    return interval_join(points, periods, ["user_id"], "ts", "begins", "ends")


# ---- streams: the events come in batches of six days, every seventh up to four days late -------------------------
BATCH_DAYS = 6
DAY_US = 24 * HOUR_US
LATE_EVERY, LATE_HOURS = 7, 97
WINDOW_DELAY_US = DAY_US


def arriving_events(spark, d):
    """Events with the number of the batch in which they come."""
    events = _table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("event_id") % LATE_HOURS * HOUR_US).otherwise(0)
    return events.withColumn("batch", F.floor((micros(F.col("ts")) + late) / (BATCH_DAYS * DAY_US)).cast("int"))


def _windows(spark, d, width_us, slide_us):
    """Per window and event type: what the stream counted, what there is, and the difference, the rows that came too late."""
    rows = arriving_events(spark, d)
    totals = lambda x: windowed_totals(x, "ts", width_us, slide_us, ("event_type",), "value", WINDOW_DELAY_US)
    run = replay(rows, "batch", totals, mode="update")
    streamed = run.latest(["window_start", "event_type"]).select(
        "window_start", "event_type", F.col("n").alias("n_stream"), F.col("total").alias("t_stream"))
    whole = totals(rows)
    both = whole.join(streamed, (whole.window_start == streamed.window_start) & whole.event_type.eqNullSafe(streamed.event_type), "left")
    n = F.coalesce("n_stream", F.lit(0).cast("long"))
    out = both.select(whole.window_start.cast("timestamp_ntz").alias("window_start"), whole.event_type, n.alias("events"),
                      (F.col("n") - n).alias("excluded"), F.col("t_stream").cast("double").alias("value_total"))
    return kept_result(out, run, "windows")


def q_stream_tumbling(spark, d):
    return _windows(spark, d, 12 * HOUR_US, None)


def q_stream_sliding(spark, d):
    return _windows(spark, d, DAY_US, 6 * HOUR_US)


SESSION_GAP_US = 4 * HOUR_US


def _session_columns(df):
    return df.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                     F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n", F.col("total").cast("double").alias("value_total"))


def q_sessions(spark, d):
    return _session_columns(sessions(_table(spark, d, "events"), ["user_id"], "ts", SESSION_GAP_US, "value"))


def q_stream_sessions(spark, d):
    """The same from the stream: its delay is longer than any row is late, and a row far ahead in time closes
    all sessions but its own, which is never emitted."""
    rows = arriving_events(spark, d)
    end = rows.agg(F.max("ts").alias("ts"), F.max("batch").alias("batch")).where("ts is not null").select(
        F.lit(None).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"), F.timestamp_micros(micros(F.col("ts")) + 60 * DAY_US).alias("ts"), (F.col("batch") + 1).alias("batch"))
    delay = (BATCH_DAYS + 5) * DAY_US
    run = replay(rows.unionByName(end), "batch", lambda x: stream_sessions(x, ["user_id"], "ts", SESSION_GAP_US, "value", delay))
    return kept_result(_session_columns(run.outputs), run, "sessions")


# ---- orders come by date in batches of two years, file part-k comes k batches late --------------------------------
ORDER_BATCH_DAYS = 732
ORDER_DELAY_DAYS = 400


def arriving_orders(spark, d):
    raw = raw_sales(spark, d)
    day = F.to_date(F.try_to_timestamp("order_date", F.lit("yyyy-MM-dd")))
    lag = F.element_at(F.split("source_file", "-"), 2).cast("int")
    rows = raw.select("order_id", "source_file", day.cast("timestamp").alias("ordered_at"),
                      (F.floor(F.unix_date(day) / ORDER_BATCH_DAYS) + lag).cast("int").alias("batch"))
    return rows.where("order_id is not null and ordered_at is not null")


def q_stream_first_orders(spark, d):
    """Every order id once, with the file that brought it first and in time."""
    run = replay(arriving_orders(spark, d), "batch", lambda x: first_per_key(x, ["order_id"], "ordered_at", ORDER_DELAY_DAYS * DAY_US))
    out = run.outputs.select("order_id", "source_file", F.to_date("ordered_at").alias("order_date"), "batch")
    return kept_result(out, run, "first-orders")


QUERIES = {
    "asof_price": q_asof_price,
    "asof_click": q_asof_click,
    "lines_in_price_periods": q_lines_in_price_periods,
    "events_in_periods": q_events_in_periods,
    "stream_tumbling": q_stream_tumbling,
    "stream_sliding": q_stream_sliding,
    "sessions": q_sessions,
    "stream_sessions": q_stream_sessions,
    "stream_first_orders": q_stream_first_orders,
}

_PRICES = """WITH prices AS (SELECT l_partkey, l_shipdate AS price_date, l_extendedprice / l_quantity AS price FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, price DESC) = 1),
lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderdate AS order_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""



def _windows_sql(width_us: int, slide_us: int) -> str:
    """A row counts in a window whose end lies after the watermark: the latest time of earlier batches (whole milliseconds) less the delay."""
    return f"""WITH rows AS (SELECT *, epoch_us(ts) AS t, CAST(floor((epoch_us(ts) + CASE WHEN event_id % {LATE_EVERY} = 0 THEN event_id % {LATE_HOURS} * {HOUR_US} ELSE 0 END)
  / {BATCH_DAYS * DAY_US}) AS BIGINT) AS batch FROM events WHERE ts IS NOT NULL),
marks AS (SELECT batch, max(max(t)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 * 1000 - {WINDOW_DELAY_US} AS mark FROM rows GROUP BY batch),
placed AS (SELECT r.*, unnest(range({width_us // slide_us})) AS k, mark FROM rows r JOIN marks USING (batch)),
windows AS (SELECT event_type, value, (t // {slide_us} - k) * {slide_us} AS w, mark IS NULL OR (t // {slide_us} - k) * {slide_us} + {width_us} > mark AS ok FROM placed)
SELECT make_timestamp(w) AS window_start, event_type, count(*) FILTER (ok) AS events, count(*) FILTER (NOT ok) AS excluded,
  CAST(sum(CAST(value AS DECIMAL(18,4))) FILTER (ok) AS DOUBLE) AS value_total FROM windows GROUP BY w, event_type"""


_SESSIONS = f"""WITH rows AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
marked AS (SELECT *, sum(CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) > {SESSION_GAP_US} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM rows)
SELECT user_id, min(ts) AS session_start, max(ts) + to_microseconds({SESSION_GAP_US}) AS session_end, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value_total FROM marked GROUP BY user_id, island"""


def first_orders_sql(raw: str) -> str:
    return f"""WITH {raw},
rows AS (SELECT order_id, source_file, CAST(order_date AS DATE) AS order_date, CAST(split_part(source_file, '-', 2) AS INTEGER) AS lag FROM raw
  WHERE order_id IS NOT NULL AND order_date <> 'invalid-date'),
numbered AS (SELECT *, CAST(floor((order_date - DATE '1970-01-01') / {ORDER_BATCH_DAYS}.0) AS INTEGER) + lag AS batch FROM rows),
marks AS (SELECT batch, max(max(order_date)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {ORDER_DELAY_DAYS} AS mark FROM numbered GROUP BY batch)
SELECT order_id, source_file, order_date, batch FROM numbered JOIN marks USING (batch) WHERE mark IS NULL OR order_date > mark
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY batch) = 1"""


ORACLE_SQL = {
    "asof_price": f"""{_PRICES}
SELECT l.*, p.price_date, p.price FROM lines l ASOF LEFT JOIN prices p ON l.l_partkey = p.l_partkey AND l.order_date >= p.price_date""",
    "asof_click": """WITH clicks AS (SELECT user_id, ts AS click_ts, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.ts, e.value, CASE WHEN e.ts - c.click_ts <= INTERVAL 6 HOUR THEN c.click_ts END AS click_ts,
  CASE WHEN e.ts - c.click_ts <= INTERVAL 6 HOUR THEN c.click_id END AS click_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN clicks c ON e.user_id = c.user_id AND e.ts > c.click_ts""",
    "lines_in_price_periods": f"""{_PRICES},
periods AS (SELECT *, lead(price_date) OVER (PARTITION BY l_partkey ORDER BY price_date) AS until FROM prices)
SELECT l.*, p.price_date, p.price, p.until FROM lines l JOIN periods p ON l.l_partkey = p.l_partkey
  AND l.order_date >= p.price_date AND (p.until IS NULL OR l.order_date < p.until)""",
    "events_in_periods": f"""WITH periods AS (SELECT event_id AS period_id, user_id, ts AS begins,
  ts + to_microseconds(CAST(round(value * {HOUR_US}) AS BIGINT)) AS ends FROM events WHERE event_type = 'signup')
SELECT e.event_id, e.user_id, e.event_type, e.ts, p.period_id, p.begins, p.ends FROM events e JOIN periods p
  ON e.user_id = p.user_id AND e.ts >= p.begins AND e.ts < p.ends""",
    "stream_tumbling": _windows_sql(12 * HOUR_US, 12 * HOUR_US),
    "stream_sliding": _windows_sql(DAY_US, 6 * HOUR_US),
    "sessions": _SESSIONS,
    "stream_sessions": _SESSIONS,
}
