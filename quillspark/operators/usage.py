"""Token and cost usage: rates, deduplication, totals by group, billing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config
from quillspark.functions.text import clean_number, normalise_path

# ---- Fixed values: US dollars per million tokens; the first name that a model's name holds counts ----
RATE_HINTS = [
    ("opus", 5.0, 25.0), ("sonnet", 3.0, 15.0), ("haiku", 1.0, 5.0), ("gpt-4o", 2.5, 10.0), ("gpt-4.1", 2.0, 8.0), ("gpt-4.1-mini", 0.4, 1.6),
    ("gpt-4o-mini", 0.15, 0.6), ("grok-3", 3.0, 15.0), ("deepseek", 1.35, 5.4),
]
#: input, output, cache read, cache write
LOG_RATES = [("opus", (5.0, 25.0, 0.5, 6.25)), ("sonnet", (3.0, 15.0, 0.3, 3.75)), ("haiku", (1.0, 5.0, 0.1, 1.25))]
LEGACY_OPUS = (15.0, 75.0, 1.5, 18.75)
TOKEN_KINDS = {
    "input": "in", "output": "out", "cacheread": "cr", "cachecreation": "cw", "cache_read": "cr", "cache_creation": "cw", "cache": "cr", "inputcached": "cr", "prompt": "in", "completion": "out",
}
# ---- end of fixed values ------------------------------------------------------------

COUNTS = ("tokens_in", "tokens_out", "cache_read", "cache_write")


def rate(model: Column, which: str, hints=None, default: float | None = None, cfg: Config = DEFAULT) -> Column:
    """The rate 'in' or 'out' of a model by the first hint in its name."""
    hints = RATE_HINTS if hints is None else hints
    col = {"in": 1, "out": 2}[which]
    default = (cfg.default_rate_in if which == "in" else cfg.default_rate_out) if default is None else default
    name = F.lower(F.coalesce(model, F.lit("")))
    out = None
    for h in hints:
        hit = F.contains(name, F.lit(h[0]))
        out = F.when(hit, h[col]) if out is None else out.when(hit, h[col])
    return out.otherwise(default)


def estimated_cost(model: Column, logged: Column, tokens_in: Column, tokens_out: Column, cache_read: Column, cache_write: Column, cfg: Config = DEFAULT) -> Column:
    """The logged cost if there is one, else tokens times rates."""
    made = (tokens_in + cache_read + cache_write) * rate(model, "in", cfg=cfg) / 1e6 + tokens_out * rate(model, "out", cfg=cfg) / 1e6
    return F.when(F.coalesce(logged, F.lit(0.0)) != 0, logged).otherwise(made)


def log_cost(model: Column, logged: Column, tokens_in: Column, tokens_out: Column, cache_read: Column, cache_write: Column) -> Column:
    """Costs of session logs: a logged cost, zero included, else four rates; unknown models cost nothing."""
    name = F.lower(F.coalesce(model, F.lit("")))

    def cost(r) -> Column:
        return (tokens_in * r[0] + tokens_out * r[1] + cache_read * r[2] + cache_write * r[3]) / 1e6

    old = F.contains(name, F.lit("4-1")) | F.contains(name, F.lit("4.1"))
    out = F.when(F.contains(name, F.lit("opus")) & old, cost(LEGACY_OPUS))
    for hint, r in LOG_RATES:
        out = out.when(F.contains(name, F.lit(hint)), cost(r))
    return F.coalesce(logged, out, F.lit(0.0))


def first_per_key(rows: DataFrame, key: list[str], order: list[str], required: str) -> DataFrame:
    """The first row of each key by ``order``; rows whose ``required`` part is null are all kept."""
    w = Window.partitionBy(*key).orderBy(*order)
    firsts = rows.where(F.col(required).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return firsts.unionByName(rows.where(F.col(required).isNull()))


def session_messages(logs: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """(model, day, session, tokens..., cost) of session-log rows read by ``sources.logs``.

    The key of a message is taken by its first copy before any other filter, so a later copy of a
    synthetic or empty message is dropped as well. An unknown day lies within any range.
    """
    rows = first_per_key(logs, ["message_id", "request_id"], ["file", "line_no"], "message_id")
    model = F.coalesce(F.when(F.col("model") != "", F.col("model")), F.lit("unknown"))
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS]
    rows = rows.select(model.alias("model"), F.substring(F.coalesce("timestamp", F.lit("")), 1, 10).alias("day"), F.coalesce("session_id", "file_stem").alias("session"), *zero, "logged_cost")
    rows = rows.where(~F.col("model").isin("<synthetic>", "synthetic") & (sum((F.col(c) for c in COUNTS), F.lit(0)) > 0))
    rows = rows.where(in_range(F.col("day"), since, until))
    cost = log_cost(F.col("model"), F.col("logged_cost"), *[F.col(c) for c in COUNTS])
    return rows.withColumn("cost", cost).withColumn("day", F.when(F.col("day") == "", "?").otherwise(F.col("day"))).drop("logged_cost")


def in_range(day: Column, since: str | None, until: str | None) -> Column:
    ok = F.lit(True)
    if since:
        ok = ok & ((day == "") | (day >= since))
    if until:
        ok = ok & ((day == "") | (day <= until))
    return ok


def totals(messages: DataFrame) -> DataFrame:
    """Sums by model, by day and over all, as grouping sets; ``level`` names the set."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    rows = messages.groupingSets([[F.col("model")], [F.col("day")], []], F.col("model"), F.col("day")).agg(
        *sums, F.round(F.sum("cost"), 8).alias("cost"), F.count("*").alias("messages"), F.count_distinct("session").alias("sessions"), F.grouping_id().alias("_g")
    )
    return rows.withColumn("level", F.when(F.col("_g") == 1, "model").when(F.col("_g") == 2, "day").otherwise("all")).drop("_g")


def group_key(ts: Column, session: Column, trace: Column, mode: str) -> Column:
    """The group of a record: session, trace, day or hour (UTC), with a name for what is missing."""
    if mode == "session":
        return F.coalesce(F.when(session != "", session), F.lit("unknown"))
    if mode == "trace":
        return F.coalesce(F.when(trace != "", trace), F.lit("no trace"))
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd" if mode == "day" else "yyyy-MM-dd HH:00"), F.lit("no date"))


def grouped(records: DataFrame, mode: str, cfg: Config = DEFAULT) -> DataFrame:
    """(grp, model, tokens..., cost, first_ts, last_ts) of records (ts, session, trace, model, tokens..., logged_cost)."""
    rows = records.groupBy(group_key(F.col("ts"), F.col("session"), F.col("trace"), mode).alias("grp"), F.coalesce("model", F.lit("unknown")).alias("model")).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in COUNTS], F.sum(F.coalesce("logged_cost", F.lit(0.0))).alias("_c"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return rows.withColumn("cost", F.round(estimated_cost(F.col("model"), F.col("_c"), *[F.col(c) for c in COUNTS], cfg=cfg), 8)).drop("_c")


def newest_groups(rows: DataFrame, n: int) -> DataFrame:
    """The rows of the n groups that were touched last."""
    last = rows.groupBy("grp").agg(F.max("last_ts").alias("_l")).orderBy(F.col("_l").desc_nulls_last(), "grp").limit(n)
    return rows.join(F.broadcast(last.select("grp")), "grp")


def billing_totals(rows: DataFrame) -> DataFrame:
    """By model: amounts, quantity, what was billed beyond the quota, users; the CSV's numbers may carry $ and commas."""
    n = {c: clean_number(F.col(c)).cast("decimal(18,6)") for c in ("quantity", "gross_amount", "discount_amount", "net_amount")}
    billed = F.upper(F.trim(F.coalesce("exceeds_quota", F.lit("")))) == "TRUE"
    return rows.groupBy(F.coalesce(F.when(F.trim("model") != "", F.trim("model")), F.lit("unknown")).alias("model")).agg(
        *[F.sum(n[c]).cast("double").alias(a) for c, a in (("net_amount", "net"), ("gross_amount", "gross"), ("discount_amount", "discount"), ("quantity", "quantity"))],
        F.coalesce(F.sum(F.when(billed, n["quantity"])), F.lit(0)).cast("double").alias("billed"),
        F.count("*").alias("rows"), F.count_distinct(F.when(F.trim("username") != "", F.trim("username"))).alias("users"),
    )


def spend_by_product(items: DataFrame) -> DataFrame:
    """(product, net, copilot_net) of billing items (product, net_amount, sku)."""
    mine = F.col("product").rlike("(?i)copilot") | F.col("sku").rlike("(?i)copilot")
    return items.groupBy("product").agg(F.round(F.sum("net_amount"), 6).alias("net"), F.round(F.sum(F.when(mine, F.col("net_amount")).otherwise(0.0)), 6).alias("copilot_net"))


def prompts(messages: DataFrame) -> DataFrame:
    """Genuine prompts: typed by a user, no meta, side chain or tool result, no command text.

    ``messages``: type, is_meta, is_sidechain, tool_result, content (text or joined text parts), session_id, ts.
    """
    def off(c: str) -> Column:
        return ~F.coalesce(F.col(c), F.lit(False))

    text = F.trim(F.coalesce("content", F.lit("")))
    return messages.where((F.col("type") == "user") & off("is_meta") & off("is_sidechain") & off("tool_result") & (text != "") & ~text.startswith("<command")).select("session_id", "ts", text.alias("prompt"))


def context_footprint(files: DataFrame, turns: int, rate_in: float, cfg: Config = DEFAULT) -> DataFrame:
    """(ecosystem, startup, invoke, share, cost) of context files (ecosystem, load, chars)."""
    tokens = F.bround(F.col("chars") / cfg.chars_per_token, 0).cast("bigint")
    rows = files.groupBy("ecosystem").agg(
        F.sum(F.when(F.col("load") == "startup", tokens).otherwise(0)).alias("startup"), F.sum(F.when(F.col("load") != "startup", tokens).otherwise(0)).alias("invoke")
    )
    total = Window.partitionBy()  # a row per ecosystem
    return rows.withColumn("share", F.round(F.col("startup") / F.sum("startup").over(total), 6)).withColumn("cost", F.round(F.col("startup") * turns * rate_in / 1e6, 6))


def newest_session(messages: DataFrame, workspaces: DataFrame) -> DataFrame:
    """(workspace, session_id): for each workspace path the session that was last active there; null if none.

    Paths are equal whatever their case, slashes and a slash at the end. ``workspaces``: path.
    """
    last = messages.where(F.col("cwd").isNotNull()).groupBy(normalise_path(F.col("cwd")).alias("key"), "session_id").agg(F.max("ts").alias("ts"))
    best = last.groupBy("key").agg(F.max(F.struct("ts", "session_id")).alias("b")).select("key", F.col("b.session_id").alias("session_id"))
    return workspaces.select(F.col("path").alias("workspace"), normalise_path(F.col("path")).alias("key")).join(best, "key", "left").drop("key")


def ranked_groups(rows: DataFrame, by: str = "tokens") -> DataFrame:
    """The groups with ``tokens`` and ``rank``, by tokens or by cost, the most first, ties by name."""
    if by not in ("tokens", "cost"):
        raise ValueError(f"rank by tokens or cost, not {by!r}")
    totals = rows.groupBy("grp").agg(*[F.sum(c).alias(c) for c in COUNTS], F.round(F.sum("cost"), 8).alias("cost")).withColumn("tokens", sum((F.col(c) for c in COUNTS), F.lit(0)))
    order = Window.orderBy(F.col(by).desc(), "grp")  # a row per group: days, hours, models
    return totals.select("grp", "tokens", "cost").withColumn("rank", F.row_number().over(order))
