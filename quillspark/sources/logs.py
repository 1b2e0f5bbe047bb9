"""Usage sources: session logs, billing CSV, captured prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = (
    "type string, sessionId string, cwd string, timestamp string, requestId string, request_id string, costUSD double, isMeta boolean, isSidechain boolean, toolUseResult variant, "
    "model string, message struct<id: string, model: string, role: string, timestamp: string, costUSD: double, content: variant, "
    "usage: struct<input_tokens: bigint, output_tokens: bigint, cache_read_input_tokens: bigint, cache_creation_input_tokens: bigint>>"
)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(folder)
    pos = F.monotonically_increasing_id()  # taken at the scan, so it follows the lines of a file
    path = F.col("_metadata.file_path")
    return raw.select(path.alias("file"), F.regexp_extract(path, r"([^/]+?)\.jsonl$", 1).alias("file_stem"), pos.alias("line_no"), "value")


def session_logs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line with usage: (file, file_stem, line_no, message_id, request_id, model, timestamp, session_id,
    tokens..., logged_cost). Lines that are no JSON are left out; lines without the word are not parsed."""
    return session_rows(_lines(spark, folder))


def session_rows(lines: DataFrame) -> DataFrame:
    """``session_logs`` of lines (file, file_stem, line_no, value)."""
    rows = lines.where(F.col("value").contains('"usage"')).withColumn("r", F.from_json("value", LOG))
    u = "r.message.usage."
    return rows.where(F.col("r.message.usage").isNotNull()).select(
        "file", "file_stem", "line_no", F.col("r.message.id").alias("message_id"), F.coalesce("r.requestId", "r.request_id").alias("request_id"), F.coalesce("r.message.model", "r.model").alias("model"),
        F.coalesce("r.timestamp", "r.message.timestamp").alias("timestamp"), F.col("r.sessionId").alias("session_id"), F.col(u + "input_tokens").alias("tokens_in"), F.col(u + "output_tokens").alias("tokens_out"),
        F.col(u + "cache_read_input_tokens").alias("cache_read"), F.col(u + "cache_creation_input_tokens").alias("cache_write"), F.coalesce("r.costUSD", "r.message.costUSD").alias("logged_cost"),
    )


def log_messages(spark: SparkSession, folder: str) -> DataFrame:
    """(session_id, ts, type, is_meta, is_sidechain, tool_result, content, cwd) for the prompt filter; text parts are joined."""
    return message_rows(_lines(spark, folder))


def message_rows(lines: DataFrame) -> DataFrame:
    """``log_messages`` of lines (value)."""
    rows = lines.withColumn("r", F.from_json("value", LOG)).where("r.type is not null")
    parts = F.from_json(F.col("r.message.content").cast("string"), "array<struct<type: string, text: string>>")
    joined = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), "\n")
    plain = F.try_variant_get("r.message.content", "$", "string")
    is_list = F.schema_of_variant("r.message.content").startswith("ARRAY")
    return rows.select(
        F.col("r.sessionId").alias("session_id"), F.col("r.timestamp").alias("ts"), F.col("r.type").alias("type"), F.col("r.isMeta").alias("is_meta"), F.col("r.isSidechain").alias("is_sidechain"),
        F.col("r.toolUseResult").isNotNull().alias("tool_result"), F.when(is_list, joined).otherwise(plain).alias("content"), F.col("r.cwd").alias("cwd"),
    )


def billing_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a premium-request report; header names are trimmed and lower-cased, missing columns are null."""
    return billing_rows(spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8"))


def billing_rows(raw: DataFrame) -> DataFrame:
    """The columns of a report under their trimmed and lower-cased names."""
    named = raw.toDF(*[c.replace("﻿", "").strip().lower() for c in raw.columns])
    if "model" not in named.columns:
        raise ValueError("no 'model' column; this is not a report per model: " + ", ".join(named.columns))
    wanted = ("model", "date", "quantity", "gross_amount", "discount_amount", "net_amount", "exceeds_quota", "username")
    return named.select(*[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def captured_content(spark: SparkSession, path: str) -> DataFrame:
    """(session, ts, model, response_id, prompt): user parts of captured calls, once per response and time."""
    return captured_rows(spark.read.text(path))


CAPTURE = "session string, ts double, model string, response_id string, input string, output string"


def captured_rows(lines: DataFrame) -> DataFrame:
    """``captured_content`` of JSON lines (value)."""
    rows = lines.select(F.from_json("value", CAPTURE).alias("r")).where("r is not null").select("r.*")
    parts = F.from_json("input", "array<struct<role: string, content: string>>")
    user = F.array_join(F.transform(F.filter(parts, lambda p: p["role"] == "user"), lambda p: p["content"]), "\n")
    prompt = F.when(F.trim("input").startswith("["), user).otherwise(F.col("input"))
    return rows.select("session", "ts", "model", "response_id", prompt.alias("prompt")).dropDuplicates(["response_id", "ts"])


ITEMS = "usageItems array<struct<product: string, sku: string, model: string, unitType: string, grossQuantity: double, grossAmount: double, discountAmount: double, netAmount: double, netQuantity: double>>"


def usage_items(texts: DataFrame) -> DataFrame:
    """(product, sku, model, quantity, gross_amount, net_amount) of billing answers (value), each a JSON object with usageItems."""
    rows = texts.select(F.from_json("value", ITEMS).alias("r")).select(F.explode("r.usageItems").alias("i"))
    return rows.select("i.product", "i.sku", "i.model", F.coalesce("i.netQuantity", "i.grossQuantity").alias("quantity"), F.col("i.grossAmount").alias("gross_amount"), F.col("i.netAmount").alias("net_amount"))
