"""OpenTelemetry sources: OTLP in JSON lines and protobuf to rows of attributes.

A record is (kind 'metric' or 'span', name, value, ts, session, attributes map<string,string>).
JSON lines of the nested form are exploded by Spark; protobuf has no reader without a
descriptor and is decoded per file in Arrow.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.text import epoch_seconds
from quillspark.operators.usage import TOKEN_KINDS

#: levels that a search for a key goes down
DEPTH = 8
_VALUE = "struct<stringValue: string, intValue: string, doubleValue: double, boolValue: boolean>"
_ATTRS = f"array<struct<key: string, value: {_VALUE}>>"
_POINT = f"struct<attributes: {_ATTRS}, timeUnixNano: string, asInt: string, asDouble: double, sum: double>"
_METRIC = f"struct<name: string, sum: struct<dataPoints: array<{_POINT}>>, gauge: struct<dataPoints: array<{_POINT}>>, histogram: struct<dataPoints: array<{_POINT}>>>"
_SPAN = f"struct<name: string, traceId: string, spanId: string, startTimeUnixNano: string, endTimeUnixNano: string, attributes: {_ATTRS}>"
LINE = (
    f"resourceMetrics array<struct<resource: struct<attributes: {_ATTRS}>, scopeMetrics: array<struct<metrics: array<{_METRIC}>>>>>, "
    f"resourceSpans array<struct<resource: struct<attributes: {_ATTRS}>, scopeSpans: array<struct<spans: array<{_SPAN}>>>>>, "
    f"scopeMetrics array<struct<metrics: array<{_METRIC}>>>, scopeSpans array<struct<spans: array<{_SPAN}>>>, spans array<{_SPAN}>, attributes map<string,string>, timestamp string, hrTime array<bigint>, startTime array<bigint>, name string, traceId string, spanContext struct<traceId: string>"
)


def _attr_map(attrs: Column) -> Column:
    text = lambda v: F.coalesce(v["stringValue"], v["intValue"], v["doubleValue"].cast("string"), v["boolValue"].cast("string"))
    pairs = F.filter(F.transform(F.coalesce(attrs, F.array().cast(_ATTRS)), lambda a: F.struct(a["key"], text(a["value"]))), lambda p: p["key"].isNotNull())
    # Of several values under one key the last counts.
    return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"])))


def _traced(attrs: Column, trace: Column) -> Column:
    """The attributes with the record's trace under ``trace_id``, unless they name one."""
    known = F.map_contains_key(attrs, "trace_id") | trace.isNull()
    return F.when(known, attrs).otherwise(F.map_concat(attrs, F.create_map(F.lit("trace_id"), trace)))


def _pair_seconds(pair: Column) -> Column:
    """[seconds, nanoseconds] as seconds."""
    return (F.get(pair, 0) + F.coalesce(F.get(pair, 1), F.lit(0)) / 1e9).cast("string")


def _session(attrs: Column) -> Column:
    return F.coalesce(attrs["session.id"], attrs["service.instance.id"], F.lit(""))


def json_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Records of JSON lines in the accepted shapes: whole exports, scope lists, bare spans and flat records.
    Lines that are no JSON give no record."""
    rows = lines.select(F.from_json(column, LINE).alias("r")).where("r is not null")
    rm = rows.select(F.inline(F.coalesce("r.resourceMetrics", F.when(F.col("r.scopeMetrics").isNotNull(), F.array(F.struct(F.lit(None).cast(f"struct<attributes: {_ATTRS}>").alias("resource"), F.col("r.scopeMetrics").alias("scopeMetrics")))))))
    m = rm.select(_session(_attr_map(F.col("resource.attributes"))).alias("rs"), F.explode(F.flatten("scopeMetrics.metrics")).alias("m"))
    points = F.concat(*[F.coalesce(F.col(f"m.{k}.dataPoints"), F.array().cast(f"array<{_POINT}>")) for k in ("sum", "gauge", "histogram")])
    p = m.select("rs", F.col("m.name").alias("name"), F.explode(points).alias("p"))
    value = F.coalesce(F.col("p.asInt").cast("double"), F.col("p.asDouble"), F.col("p.sum"), F.lit(0.0))
    metrics = p.select(F.lit("metric").alias("kind"), "name", value.alias("value"), F.col("p.timeUnixNano").alias("t"), "rs", _attr_map(F.col("p.attributes")).alias("attributes"))

    rs = rows.select(F.inline(F.coalesce("r.resourceSpans", F.when(F.col("r.scopeSpans").isNotNull(), F.array(F.struct(F.lit(None).cast(f"struct<attributes: {_ATTRS}>").alias("resource"), F.col("r.scopeSpans").alias("scopeSpans")))))))
    s = rs.select(_session(_attr_map(F.col("resource.attributes"))).alias("rs"), F.explode(F.flatten("scopeSpans.spans")).alias("s"))
    bare = rows.select(F.lit("").alias("rs"), F.explode("r.spans").alias("s"))
    s = s.unionByName(bare)
    spans = s.select(F.lit("span").alias("kind"), F.col("s.name").alias("name"), F.lit(None).cast("double").alias("value"), F.coalesce("s.startTimeUnixNano", "s.endTimeUnixNano").alias("t"), "rs", _traced(_attr_map(F.col("s.attributes")), F.col("s.traceId")).alias("attributes"))
    flat = rows.where("r.attributes is not null").select(F.lit("span").alias("kind"), F.col("r.name").alias("name"), F.lit(None).cast("double").alias("value"), F.coalesce("r.timestamp", _pair_seconds(F.col("r.hrTime")), _pair_seconds(F.col("r.startTime"))).alias("t"), F.lit("").alias("rs"), _traced(F.col("r.attributes"), F.coalesce("r.traceId", "r.spanContext.traceId")).alias("attributes"))

    out = metrics.unionByName(spans).unionByName(flat)
    own = F.coalesce(F.when(F.col("kind") == "span", F.col("attributes")["gen_ai.conversation.id"]), F.col("attributes")["session.id"], F.when(F.col("rs") != "", F.col("rs")), F.lit("unknown"))
    return out.select("kind", "name", "value", F.timestamp_seconds(epoch_seconds(F.col("t").try_cast("double"))).alias("ts"), own.alias("session"), "attributes")


def _fields(buf: bytes) -> dict[int, list]:
    """Protobuf fields by number: varints as integers, the others as bytes."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buf[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(buf):
        key = varint()
        width = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            value = varint()
        elif key & 7 == 2 or width:
            n = width or varint()
            value, at = buf[at : at + n], at + n
        else:  # a group or an unknown type has no length; what came before it stays
            return out
        out.setdefault(key >> 3, []).append(value)
    return out


def _attributes(items: list[bytes]) -> dict[str, str]:
    out = {}
    for item in items:
        f = _fields(item)
        v = _fields(f[2][-1]) if 2 in f else {}
        if 1 in v:
            value = v[1][-1].decode("utf-8", "replace")
        elif 3 in v:
            value = str(v[3][-1] - (1 << 64) if v[3][-1] >> 63 else v[3][-1])
        elif 4 in v:
            value = repr(struct.unpack("<d", v[4][-1])[0])
        elif 2 in v:
            value = str(bool(v[2][-1])).lower()
        else:
            continue
        out[f[1][-1].decode("utf-8", "replace") if 1 in f else ""] = value
    return out


def decode_protobuf(body: bytes, kind: str) -> list[dict]:
    """Records of an export request, 'metric' or 'span'."""
    out = []
    for resource in _fields(body).get(1, []):
        r = _fields(resource)
        res = _attributes(_fields(r[1][-1]).get(1, [])) if 1 in r else {}
        inherited = res.get("session.id") or res.get("service.instance.id") or ""
        for scope in r.get(2, []):
            for item in _fields(scope).get(2, []):
                f = _fields(item)
                if kind == "span":
                    a = _attributes(f.get(9, []))
                    t = f.get(7) or f.get(8)
                    out.append({"kind": kind, "name": f[5][-1].decode() if 5 in f else "", "value": None, "ts": struct.unpack("<Q", t[-1])[0] / 1e9 if t else None, "session": a.get("gen_ai.conversation.id") or inherited or "unknown", "attributes": a})
                    continue
                name = f[1][-1].decode("utf-8", "replace") if 1 in f else ""
                for number, attr, is_hist in ((5, 7, False), (7, 7, False), (9, 9, True)):
                    for data in f.get(number, []):
                        for point in _fields(data).get(1, []):
                            p = _fields(point)
                            a = _attributes(p.get(attr, []))
                            if is_hist:
                                value = struct.unpack("<d", p[5][-1])[0] if 5 in p else 0.0
                            else:
                                value = struct.unpack("<d", p[4][-1])[0] if 4 in p else float(struct.unpack("<q", p[6][-1])[0]) if 6 in p else 0.0
                            out.append({"kind": kind, "name": name, "value": value, "ts": struct.unpack("<Q", p[3][-1])[0] / 1e9 if 3 in p else None, "session": a.get("session.id") or inherited or "unknown", "attributes": a})
    return out


def protobuf_folder(spark: SparkSession, folder: str, kind: str = "metric") -> DataFrame:
    """Records of every ``*.pb`` file below the folder; a file that does not decode gives none."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pb").load(folder).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for body in pdf["content"]:
                try:
                    rows += decode_protobuf(bytes(body), kind)
                except (IndexError, ValueError, struct.error):
                    continue
            if rows:
                yield pd.DataFrame(rows)

    out = raw.mapInPandas(run, "kind string, name string, value double, ts double, session string, attributes map<string,string>")
    return out.withColumn("ts", F.timestamp_seconds("ts"))


def _first(names: list[str]) -> Column:
    return F.coalesce(*[F.col("attributes")[n] for n in names])


def usage_records(records: DataFrame, skip_genai_metrics: bool = False) -> DataFrame:
    """(ts, session, trace, model, tokens..., logged_cost, response_id): spans and token or cost metrics as usage.

    Spans that sum up a whole session are left out, and a response id counts once. With spans at
    hand, ``gen_ai`` token metrics would count twice and can be skipped.
    """
    model = F.coalesce(_first(["gen_ai.request.model", "gen_ai.response.model", "model", "gen_ai.model", "llm.model_name"]), F.lit("unknown"))

    def count(names: list[str]) -> Column:
        return F.coalesce(_first(names).try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))

    common = ["ts", "session", F.coalesce(F.col("attributes")["trace_id"], F.lit("")).alias("trace"), model.alias("model")]
    spans = records.where((F.col("kind") == "span") & (F.lower(F.coalesce(F.col("attributes")["gen_ai.operation.name"], F.lit(""))) != "invoke_agent"))
    spans = spans.select(
        *common, count(["gen_ai.usage.input_tokens", "gen_ai.usage.prompt_tokens", "prompt_tokens", "input_tokens"]).alias("tokens_in"), count(["gen_ai.usage.output_tokens", "gen_ai.usage.completion_tokens", "completion_tokens", "output_tokens"]).alias("tokens_out"),
        count(["gen_ai.usage.cache_read.input_tokens", "gen_ai.usage.cache_read_input_tokens", "cache_read_input_tokens"]).alias("cache_read"), count(["gen_ai.usage.cache_creation.input_tokens", "gen_ai.usage.cache_creation_input_tokens", "cache_creation_input_tokens"]).alias("cache_write"),
        F.lit(0.0).alias("logged_cost"), _first(["gen_ai.response.id", "gen_ai.response_id"]).alias("response_id"),
    )
    spans = spans.where(F.col("response_id").isNotNull()).dropDuplicates(["response_id"]).unionByName(spans.where(F.col("response_id").isNull()))
    spans = spans.where("tokens_in + tokens_out + cache_read + cache_write > 0")
    name = F.lower("name")
    is_cost = F.contains(name, F.lit("cost"))
    m = records.where((F.col("kind") == "metric") & (is_cost | F.contains(name, F.lit("token"))))
    if skip_genai_metrics:
        m = m.where(is_cost | ~name.startswith("gen_ai"))
    kind = F.regexp_replace(F.lower(F.coalesce(_first(["gen_ai.token.type", "type", "token.type", "gen_ai.usage.token_type"]), F.lit(""))), r"[ .]", "")
    place = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TOKEN_KINDS.items() for x in kv]), kind), F.lit("in"))
    n = F.floor("value").cast("bigint")
    metrics = m.select(
        *common, *[F.when(~is_cost & (place == p), n).otherwise(F.lit(0).cast("bigint")).alias(c) for p, c in (("in", "tokens_in"), ("out", "tokens_out"), ("cr", "cache_read"), ("cw", "cache_write"))],
        F.when(is_cost, F.col("value")).otherwise(0.0).alias("logged_cost"), F.lit(None).cast("string").alias("response_id"),
    )
    return spans.unionByName(metrics)


def flattened(lines: DataFrame, column: str = "value", depth: int = DEPTH) -> DataFrame:
    """(paths map<string,string>): the values of JSON lines under their dotted paths, to a depth; list items by number.
    Lines that are no JSON object give no row."""

    def walk(value, path: str, left: int, out: dict) -> None:
        if isinstance(value, (dict, list)):
            if left:
                for k, v in value.items() if isinstance(value, dict) else enumerate(value):
                    walk(v, f"{path}.{k}" if path else str(k), left - 1, out)
        elif value is not None:
            out[path] = json.dumps(value) if isinstance(value, bool) else str(value)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for line in pdf[column]:
                try:
                    value = json.loads(line)
                except (TypeError, ValueError):
                    continue
                if isinstance(value, dict):
                    walk(value, "", depth, out := {})
                    rows.append(out)
            if rows:
                yield pd.DataFrame({"paths": rows})

    return lines.select(column).mapInPandas(run, "paths map<string,string>")


def deep_find(paths: Column, name: str) -> Column:
    """The value under the first path, by depth and then by place, that ends with ``name``."""
    hits = F.filter(F.map_entries(paths), lambda e: (e["key"] == name) | e["key"].endswith("." + name))
    ranked = F.array_sort(F.transform(hits, lambda e: F.struct(F.size(F.split(e["key"], r"\.")).alias("d"), e["key"].alias("k"), e["value"].alias("v"))))
    return F.get(ranked, 0)["v"]


def line_shapes(lines: DataFrame, column: str = "value") -> DataFrame:
    """(shape, n): how many lines have which top-level keys."""
    keys = F.array_join(F.array_sort(F.json_object_keys(column)), " ")
    return lines.select(keys.alias("shape")).where("shape is not null").groupBy("shape").agg(F.count("*").alias("n"))
