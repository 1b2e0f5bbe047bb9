"""Queries of the usage analytics. An event stands for one call: its user for the session, its type
for the model, its value for input tokens and the number in its JSON for output tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import usage
from quillspark.streaming import usage as stream
from quillspark.tables import table

MODELS = {"click": "gpt-4o-mini", "purchase": "claude-opus-4-1", "error": "gpt-4.1-mini", "signup": "claude-sonnet", "view": "some-model"}


def _records(spark: SparkSession, folder: str) -> DataFrame:
    model = F.element_at(F.create_map(*[F.lit(x) for kv in MODELS.items() for x in kv]), F.col("event_type"))
    out = F.coalesce(F.variant_get(F.try_parse_json("props"), "$.k", "bigint"), F.lit(0))
    return table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").cast("string").alias("session"), F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("t"), (F.col("event_id") % 50).cast("string"))).alias("trace"),
        F.coalesce(model, F.lit("unknown")).alias("model"), F.floor(F.coalesce(F.abs("value"), F.lit(0.0)) * 100).cast("bigint").alias("tokens_in"), out.alias("tokens_out"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 10).otherwise(0).cast("bigint").alias("cache_read"), F.lit(0).cast("bigint").alias("cache_write"),
        F.when(F.col("event_id") % 11 == 0, F.lit(0.25)).alias("logged_cost"),
    )


def usage_by_model(spark: SparkSession, folder: str) -> DataFrame:
    r = _records(spark, folder)
    return r.groupBy("model").agg(*[F.sum(c).alias(c) for c in usage.COUNTS], F.count("*").alias("messages"), F.count_distinct("session").alias("sessions"))


def _grouped(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return usage.grouped(_records(spark, folder), mode).withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_ts", "last_ts")})


def usage_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder, "day")


def usage_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder, "hour")


def usage_by_session(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder, "session")


def usage_by_trace(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder, "trace")


def usage_newest_days(spark: SparkSession, folder: str) -> DataFrame:
    return usage.newest_groups(usage.grouped(_records(spark, folder), "day"), 3).select("grp", "model", "tokens_in", "cost")


def usage_total_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by model, by day and over all."""
    r = _records(spark, folder)
    cost = usage.log_cost(F.col("model"), F.col("logged_cost"), *[F.col(c) for c in usage.COUNTS])
    return usage.totals(r.withColumn("cost", cost).withColumn("day", F.date_format("ts", "yyyy-MM-dd")))


def usage_date_range(spark: SparkSession, folder: str) -> DataFrame:
    r = _records(spark, folder).withColumn("day", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("")))
    return r.where(usage.in_range(F.col("day"), "2024-01-05", "2024-01-12")).groupBy("day").agg(F.sum("tokens_in").alias("tokens_in"))


def usage_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first call of each session and trace; calls without a trace all stay."""
    rows = usage.first_per_key(_records(spark, folder), ["session", "trace"], ["ts", "event_id"], "trace")
    return rows.groupBy("model").agg(F.count("*").alias("n"), F.sum("tokens_in").alias("tokens_in"))


def usage_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The rate of each model by the first hint in its name."""
    r = _records(spark, folder).select("model").distinct()
    return r.select("model", usage.rate(F.col("model"), "in").alias("rate_in"), usage.rate(F.col("model"), "out").alias("rate_out"))


def billing_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as billing rows: priority as model, price with a dollar sign, status F as beyond the quota."""
    o = table(spark, folder, "orders")
    rows = o.select(
        F.col("o_orderpriority").alias("model"), F.lit("1").alias("quantity"), F.concat(F.lit("$"), F.format_number(F.round("o_totalprice", 2), 2)).alias("gross_amount"), F.lit("n/a").alias("discount_amount"),
        F.round("o_totalprice", 2).cast("string").alias("net_amount"), F.when(F.col("o_orderstatus") == "F", " true ").alias("exceeds_quota"), F.col("o_custkey").cast("string").alias("username"),
    )
    return usage.billing_totals(rows)


def spend_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    items = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("product"), F.col("o_totalprice").alias("net_amount"), F.when(F.col("o_orderstatus") == "O", "Copilot seat").otherwise("other").alias("sku"))
    return usage.spend_by_product(items).withColumns({c: F.round(c, 2) for c in ("net", "copilot_net")})


def number_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of events shown as people read them."""
    r = table(spark, folder, "events").groupBy("event_type").agg(F.floor(F.sum("value")).cast("double").alias("total"))
    return r.select("event_type", T.human_number(F.col("total")).alias("shown"), T.nice_ceiling(F.col("total")).alias("axis"))


def token_estimates(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").where("text is not null")
    return d.groupBy("source").agg(F.sum(T.token_estimate(F.col("text"))).alias("tokens"), F.count("*").alias("n"))


def timestamp_units(spark: SparkSession, folder: str) -> DataFrame:
    """One instant in seconds, milli-, micro- and nanoseconds comes out the same."""
    e = table(spark, folder, "events").where("ts is not null").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    forms = F.explode(F.array(F.floor(F.col("us") / 1_000_000), F.floor(F.col("us") / 1_000), F.col("us"), F.col("us") * 1000))
    return e.select("event_id", forms.alias("raw")).select("event_id", F.floor(T.epoch_seconds(F.col("raw"))).alias("s")).groupBy("event_id").agg(F.count_distinct("s").alias("n_instants"), F.max("s").alias("s"))


def stream_usage_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The events read as a stream until all are processed; tumbling days by event type."""
    def days(events: DataFrame) -> DataFrame:
        return stream.windowed(events, "1 day").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 6).alias("total"))

    return stream.replayed(spark, f"{folder}/events.parquet", days)


def stream_sliding_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Two hours that slide by one, over the events as a stream."""
    def hours(events: DataFrame) -> DataFrame:
        return stream.windowed(events, "2 hours", "1 hour").select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")

    return stream.replayed(spark, f"{folder}/events.parquet", hours)


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Gap sessions per user, over the events as a stream: a break of more than six hours begins a new one."""
    rows = stream.replayed(spark, f"{folder}/events.parquet", lambda events: stream.gap_sessions(events, "6 hours").select("user_id", "n"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.sum("n").alias("n_events"))


QUERIES = {f.__name__: f for f in (
    usage_by_model, usage_by_day, usage_by_hour, usage_by_session, usage_by_trace, usage_newest_days, usage_total_sets, usage_date_range, usage_dedup_first, usage_rates,
    billing_totals, spend_by_segment, number_forms, token_estimates, timestamp_units, stream_usage_daily, stream_sliding_hours, stream_sessions,
)}

_R = """
WITH r AS (SELECT event_id, ts, CAST(user_id AS VARCHAR) AS session, CASE WHEN event_id % 7 <> 0 THEN 't' || CAST(event_id % 50 AS VARCHAR) END AS trace,
  CASE event_type WHEN 'click' THEN 'gpt-4o-mini' WHEN 'purchase' THEN 'claude-opus-4-1' WHEN 'error' THEN 'gpt-4.1-mini' WHEN 'signup' THEN 'claude-sonnet' WHEN 'view' THEN 'some-model' ELSE 'unknown' END AS model,
  CAST(floor(coalesce(abs(value), 0) * 100) AS BIGINT) AS tokens_in, CAST(coalesce(json_extract_string(props, '$.k'), '0') AS BIGINT) AS tokens_out,
  CAST(CASE WHEN event_id % 3 = 0 THEN event_id % 10 ELSE 0 END AS BIGINT) AS cache_read, CAST(0 AS BIGINT) AS cache_write, CASE WHEN event_id % 11 = 0 THEN 0.25 END AS logged FROM events)
"""
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in usage.COUNTS)
_RATE_IN = "CASE WHEN model LIKE '%opus%' THEN 5.0 WHEN model LIKE '%sonnet%' THEN 3.0 WHEN model LIKE '%gpt-4o%' THEN 2.5 WHEN model LIKE '%gpt-4.1%' THEN 2.0 ELSE 1.0 END"
_RATE_OUT = "CASE WHEN model LIKE '%opus%' THEN 25.0 WHEN model LIKE '%sonnet%' THEN 15.0 WHEN model LIKE '%gpt-4o%' THEN 10.0 WHEN model LIKE '%gpt-4.1%' THEN 8.0 ELSE 3.0 END"


def _group_sql(key: str) -> str:
    return _R + f""", g AS (SELECT {key} AS grp, model, {_SUMS}, sum(coalesce(logged, 0)) AS c, min(ts) AS f, max(ts) AS l FROM r GROUP BY ALL)
SELECT grp, model, tokens_in, tokens_out, cache_read, cache_write, round(CASE WHEN c <> 0 THEN c ELSE (tokens_in + cache_read + cache_write) * {_RATE_IN} / 1e6 + tokens_out * {_RATE_OUT} / 1e6 END, 8) AS cost,
  strftime(f, '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(l, '%Y-%m-%d %H:%M:%S') AS last_ts FROM g"""


_DAY = _group_sql("coalesce(strftime(ts, '%Y-%m-%d'), 'no date')")
ORACLE = {
    "usage_by_model": _R + f"SELECT model, {_SUMS}, count(*) AS messages, count(DISTINCT session) AS sessions FROM r GROUP BY model",
    "usage_by_day": _DAY,
    "usage_by_hour": _group_sql("coalesce(strftime(ts, '%Y-%m-%d %H:00'), 'no date')"),
    "usage_by_session": _group_sql("coalesce(nullif(session, ''), 'unknown')"),
    "usage_by_trace": _group_sql("coalesce(nullif(trace, ''), 'no trace')"),
    "usage_newest_days": f"WITH d AS ({_DAY}) SELECT grp, model, tokens_in, cost FROM d WHERE grp IN (SELECT grp FROM d GROUP BY grp ORDER BY max(last_ts) DESC NULLS LAST, grp LIMIT 3)",
    "usage_total_sets": _R + f""", c AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day, coalesce(logged, CASE WHEN model LIKE '%opus%4-1%' THEN (tokens_in * 15 + tokens_out * 75 + cache_read * 1.5 + cache_write * 18.75) / 1e6
  WHEN model LIKE '%sonnet%' THEN (tokens_in * 3 + tokens_out * 15 + cache_read * 0.3 + cache_write * 3.75) / 1e6 ELSE 0 END) AS cost FROM r)
SELECT model, day, {_SUMS}, round(sum(cost), 8) AS cost, count(*) AS messages, count(DISTINCT session) AS sessions,
  CASE WHEN grouping(model) = 0 THEN 'model' WHEN grouping(day) = 0 THEN 'day' ELSE 'all' END AS level FROM c GROUP BY GROUPING SETS ((model), (day), ())""",
    "usage_date_range": _R + ", d AS (SELECT coalesce(strftime(ts, '%Y-%m-%d'), '') AS day, tokens_in FROM r) SELECT day, CAST(sum(tokens_in) AS BIGINT) AS tokens_in FROM d WHERE day = '' OR day BETWEEN '2024-01-05' AND '2024-01-12' GROUP BY day",
    "usage_dedup_first": _R + ", k AS (SELECT * FROM r WHERE trace IS NOT NULL QUALIFY row_number() OVER (PARTITION BY session, trace ORDER BY ts, event_id) = 1 UNION ALL SELECT * FROM r WHERE trace IS NULL) SELECT model, count(*) AS n, CAST(sum(tokens_in) AS BIGINT) AS tokens_in FROM k GROUP BY model",
    "usage_rates": _R + f"SELECT DISTINCT model, {_RATE_IN} AS rate_in, {_RATE_OUT} AS rate_out FROM r",
    "billing_totals": """SELECT o_orderpriority AS model, CAST(sum(CAST(round(o_totalprice, 2) AS DECIMAL(18, 6))) AS DOUBLE) AS net, CAST(sum(CAST(round(o_totalprice, 2) AS DECIMAL(18, 6))) AS DOUBLE) AS gross, 0.0 AS discount, CAST(count(*) AS DOUBLE) AS quantity,
  CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS billed, count(*) AS rows, count(DISTINCT o_custkey) AS users FROM orders GROUP BY ALL""",
    "spend_by_segment": "SELECT c_mktsegment AS product, round(sum(o_totalprice), 2) AS net, round(coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0), 2) AS copilot_net FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
    "token_estimates": "SELECT source, CAST(sum(CAST(round_even(length(text) / 4.0, 0) AS BIGINT)) AS BIGINT) AS tokens, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY source",
    "timestamp_units": "SELECT event_id, 1 AS n_instants, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM events WHERE ts IS NOT NULL",
    "stream_usage_daily": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL",
    "stream_sliding_hours": """WITH h AS (SELECT date_trunc('hour', ts) AS h, event_type FROM events WHERE ts IS NOT NULL)
SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM (SELECT h AS s, event_type FROM h UNION ALL SELECT h - INTERVAL 1 HOUR, event_type FROM h) GROUP BY ALL""",
    "stream_sessions": """WITH g AS (SELECT user_id, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, CAST(sum(new) AS BIGINT) AS n_sessions, count(*) AS n_events FROM g GROUP BY user_id""",
    "number_forms": """WITH t AS (SELECT event_type, floor(sum(value)) AS total FROM events GROUP BY ALL), p AS (SELECT *, pow(10, floor(log10(total))) AS m FROM t)
SELECT event_type, CASE WHEN total >= 1e6 THEN format('{:.1f}M', total / 1e6) WHEN total >= 1000 THEN format('{:.1f}k', total / 1000) ELSE CAST(CAST(total AS BIGINT) AS VARCHAR) END AS shown,
  m * CASE WHEN total / m <= 1 THEN 1.0 WHEN total / m <= 2 THEN 2.0 WHEN total / m <= 2.5 THEN 2.5 WHEN total / m <= 5 THEN 5.0 ELSE 10.0 END AS axis FROM p""",
}
