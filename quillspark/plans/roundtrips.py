"""Queries of sources and writers: rows of the tables are put into a foreign format, read by the engine's own
reader and held against the table itself, so that each has a plain SQL equivalent."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark import api
from quillspark.config import Config
from quillspark.operators import chunking, classify, convert, diagrams, evaluate, inventory, lint, report, search, store, structure, usage
from quillspark.plans import corpus, pages
from quillspark.plans import usage as usage_plans
from quillspark.session import shared_dir, written
from quillspark.sources import logs, otel
from quillspark.tables import distinct_blocks, table


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_blocks(table(spark, folder, "blocks"))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.coalesce(F.variant_get(F.try_parse_json("props"), "$.k", "bigint"), F.lit(0))
    return table(spark, folder, "events").select("event_id", "ts", "event_type", "user_id", k.alias("k"))


def _nanos(ts: Column) -> Column:
    return (F.unix_micros(ts.cast("timestamp")) * 1000).cast("string")


def _attr(key: str, value: Column, kind: str = "stringValue") -> Column:
    return F.struct(F.lit(key).alias("key"), F.struct(value.cast("string").alias(kind)).alias("value"))


# ---- telemetry ----------------------------------------------------------------------


def otlp_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a span of an OTLP export line, read back as usage by model and session."""
    e = _events(spark, folder)
    attrs = F.to_json(F.array(_attr("gen_ai.request.model", F.col("event_type"))))
    count = F.to_json(F.array(_attr("gen_ai.usage.input_tokens", F.col("k"), "intValue")))
    both = F.concat(F.expr("left(a, length(a) - 1)"), F.lit(","), F.expr("substring(c, 2)"))
    e = e.select("event_id", "ts", "user_id", attrs.alias("a"), count.alias("c")).withColumn("attrs", both)
    line = F.format_string(
        '{"resourceSpans":[{"resource":{"attributes":[{"key":"session.id","value":{"stringValue":"u%s"}}]},"scopeSpans":[{"spans":[{"name":"chat","traceId":"t%s","startTimeUnixNano":"%s","attributes":%s}]}]}]}',
        F.col("user_id"), F.col("event_id") % 50, F.coalesce(_nanos(F.col("ts")), F.lit("")), F.col("attrs"),
    )
    rows = otel.usage_records(otel.json_records(e.select(line.alias("value"))))
    return rows.groupBy("model", "session").agg(F.sum("tokens_in").alias("tokens_in"), F.count("*").alias("n"), F.count_distinct("trace").alias("traces"), F.count("ts").alias("dated"))


def otlp_flat_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a flat record whose time is a pair of seconds and nanoseconds."""
    e = _events(spark, folder).where("ts is not null").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    rec = F.struct(
        F.lit("chat").alias("name"), F.struct(F.concat(F.lit("t"), F.col("event_id") % 50).alias("traceId")).alias("spanContext"), F.array(F.floor(F.col("us") / 1000000).cast("bigint"), (F.col("us") % 1000000 * 1000).cast("bigint")).alias("hrTime"),
        F.struct(F.col("event_type").alias("model"), F.col("k").cast("string").alias("output_tokens")).alias("attributes"),
    )
    rows = otel.usage_records(otel.json_records(e.select(F.to_json(rec).alias("value"))))
    return rows.groupBy("model").agg(F.sum("tokens_out").alias("tokens_out"), F.count_distinct("trace").alias("traces"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"))


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def otlp_protobuf(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a data point of a protobuf export, decoded to records."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for model, user, k in zip(pdf["event_type"], pdf["user_id"], pdf["k"]):
                def attr(key: str, value: str) -> bytes:
                    return _field(1, key.encode()) + _field(2, _field(1, value.encode()))

                point = _field(7, attr("model", model or "")) + _varint(6 << 3 | 1) + int(k).to_bytes(8, "little", signed=True)
                body = _field(1, _field(1, _field(1, attr("session.id", f"u{user}"))) + _field(2, _field(2, _field(1, b"token.usage") + _field(7, _field(1, point)))))
                out += otel.decode_protobuf(body, "metric")
            yield pd.DataFrame(out, columns=["name", "value", "session", "attributes"])

    rows = _events(spark, folder).where("user_id is not null").mapInPandas(run, "name string, value double, session string, attributes map<string,string>")
    return rows.groupBy("name", "session", F.col("attributes")["model"].alias("model")).agg(F.sum("value").alias("total"), F.count("*").alias("n"))


def telemetry_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Which keys the lines have, and a key that lies deep in them."""
    e = _events(spark, folder)
    line = F.to_json(F.struct("event_id", F.struct(F.struct(F.array(F.struct(F.lit(1).alias("x"), F.col("k").alias("deep_k"))).alias("list")).alias("b")).alias("a")))
    lines = e.select(line.alias("value"))
    found = otel.flattened(lines).select(otel.deep_find(F.col("paths"), "deep_k").alias("k"), F.size("paths").alias("n"))
    found = found.agg(F.sum(F.col("k").cast("bigint")).alias("total"), F.sum("n").alias("n_paths"))
    return otel.line_shapes(lines).crossJoin(found)  # a row per shape, one row of sums


# ---- session logs and billing -------------------------------------------------------


def session_log_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a line of a session log, each twice: a message counts once."""
    e = _events(spark, folder)
    rec = F.struct(
        F.lit("assistant").alias("type"), F.concat(F.lit("u"), "user_id").alias("sessionId"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit("r").alias("requestId"),
        F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("model"), F.struct(F.col("k").alias("input_tokens"), F.lit(2).alias("output_tokens")).alias("usage")).alias("message"),
    )
    lines = e.select(F.lit("f").alias("file"), F.lit("f").alias("file_stem"), (F.col("event_id") * 2).alias("line_no"), F.to_json(rec).alias("value"))
    rows = usage.session_messages(logs.session_rows(lines.unionByName(lines.withColumn("line_no", F.col("line_no") + 1))))
    return rows.groupBy("model", "day").agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.count("*").alias("n"), F.count_distinct("session").alias("sessions"))


def session_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Every prose block as what a user typed; every third as a part list, every fifth as a tool's result."""
    b = _blocks(spark, folder).where("content_type = 'paragraph' and text is not null").select("block_id", "doc_id", "seq", "text")
    plain = F.to_json(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    parts = F.to_json(F.struct(F.lit("user").alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text"))).alias("content")))
    message = F.when(F.col("seq") % 3 == 0, parts).otherwise(plain)
    tool = F.when(F.col("seq") % 5 == 0, F.lit(',"toolUseResult":{"a":1}')).otherwise("")
    line = F.concat(F.lit('{"type":"user","sessionId":"'), "doc_id", F.lit('","message":'), message, tool, F.lit("}"))
    rows = usage.prompts(logs.message_rows(b.select(line.alias("value"))))
    return rows.groupBy("session_id").agg(F.count("*").alias("n"), F.sum(F.length("prompt")).alias("chars"))


def captured_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Every golden item as a captured call, twice: a call counts once."""
    g = table(spark, folder, "golden_items").where("query_text is not null")
    said = F.to_json(F.array(F.struct(F.lit("system").alias("role"), F.lit("be brief").alias("content")), F.struct(F.lit("user").alias("role"), F.col("query_text").alias("content"))))
    rec = F.struct(F.lit("s").alias("session"), F.col("item_id").cast("double").alias("ts"), F.lit("m").alias("model"), F.concat(F.lit("r"), "item_id").alias("response_id"), F.when(F.col("item_id") % 2 == 0, said).otherwise(F.col("query_text")).alias("input"))
    lines = g.select(F.to_json(rec).alias("value"))
    return logs.captured_rows(lines.unionByName(lines)).select("response_id", "prompt")


def billing_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as an item of a billing answer."""
    o = table(spark, folder, "orders").select(F.struct(F.col("o_orderpriority").alias("product"), F.when(F.col("o_orderstatus") == "O", "Copilot seat").otherwise("other").alias("sku"), F.lit(1.0).alias("netQuantity"), F.col("o_totalprice").cast("double").alias("netAmount")).alias("i"))
    rows = logs.usage_items(o.select(F.to_json(F.struct(F.array("i").alias("usageItems"))).alias("value")))
    return usage.spend_by_product(rows).withColumns({c: F.round(c, 2) for c in ("net", "copilot_net")})


def usage_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Days ranked by tokens and by cost."""
    rows = usage.grouped(usage_plans._records(spark, folder), "day")
    both = [usage.ranked_groups(rows, by).withColumn("ranked_by", F.lit(by)) for by in ("tokens", "cost")]
    return both[0].unionByName(both[1]).withColumn("cost", F.round("cost", 4))


# ---- store and exports --------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/roundtrip-{uuid.uuid4().hex}"


def store_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks put into a store, one type put over, a space's pages deleted, and read back."""
    s = store.ChunkStore(spark, _folder(spark))
    b = _blocks(spark, folder).select(F.concat_ws("_", "doc_id", "block_id").alias("chunk_id"), "doc_id", "space", "content_type", F.length("text").alias("n_chars"))
    s.upsert(b.withColumn("version", F.lit(1)))
    s.upsert(b.where("content_type = 'table'").withColumn("version", F.lit(2)))
    deleted = s.delete(b.where("space = 'MERROW'").select("doc_id"))
    s.write_provenance("hashing", "md5", 512)
    rows = s.read().groupBy("content_type", "version").agg(F.count("*").alias("n"), F.sum("n_chars").alias("n_chars"))
    return rows.withColumns({"deleted": F.lit(deleted).cast("bigint"), "provider": F.lit(s.provenance()["provider"]), "dimension": F.lit(s.provenance()["dimension"])})


def export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks exported as JSON lines and read again."""
    place = _folder(spark)
    api.export(_blocks(spark, folder).select("doc_id", "block_id", "content_type", "text"), place, 32)
    rows = spark.read.schema("doc_id string, block_id string, content_type string, text string, bucket int").json(place)
    return rows.groupBy("content_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count_distinct("doc_id").alias("docs"))


def paths_and_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks by the path of their page and the title of their section; pages of an inbox folder form the manifest."""
    manifest = table(spark, folder, "page_meta").where("source_path like 'inbox/%'").select("doc_id", F.col("source_path").alias("path"))
    rows = _blocks(spark, folder).groupBy("doc_id", "section_id").agg(F.count("*").alias("n"))
    titled = report.with_titles(rows, table(spark, folder, "sections").select("doc_id", "section_id", "title"))
    return report.with_paths(titled, manifest).select("doc_id", "section_id", "n", "title", "path")


def breadcrumb_sections(spark: SparkSession, folder: str) -> DataFrame:
    """The section that each distinct breadcrumb of a page leads to."""
    s = table(spark, folder, "sections").select("doc_id", "section_id", "seq", "breadcrumb").distinct()
    return report.section_by_breadcrumb(s.select("doc_id", "breadcrumb").distinct(), s).select("doc_id", F.array_join("breadcrumb", " > ").alias("path"), "section_id")


def gate_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents pass the lint and how many fail it."""
    return report.status_totals(api.lint_documents(table(spark, folder, "documents").select("doc_id", "text"), strict=True))


def construct_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The constructs met while converting, with how bad their loss is."""
    return report.macro_totals(convert.convert_pages(_construct_pages(spark, folder).select(F.concat("construct", F.lit("-"), "doc_id").alias("doc_id"), "text")))


def conversion_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = convert.convert_pages(_construct_pages(spark, folder).select(F.concat("construct", F.lit("-"), "doc_id").alias("doc_id"), "text"))
    return report.conversion_totals(rows.select("status", F.regexp_count("markdown", F.lit("(?m)^#{1,6} ")).alias("n_headings"), F.regexp_count("markdown", F.lit("(?m)^\\| --- ")).alias("n_tables")))


def shown_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """How many nodes of the graph a drawing shows and leaves out, by kind."""
    nodes, _ = report.graph(table(spark, folder, "sections").select("doc_id", "section_id", "entities", "depends_on", "exposes").distinct(), table(spark, folder, "page_meta"))
    shown, left = report.shown_nodes(nodes)
    return shown.groupBy("kind").agg(F.count("*").alias("n_shown")).join(left, "kind").withColumn("n_left_out", F.col("n_left_out").cast("bigint"))


# ---- pages --------------------------------------------------------------------------

#: construct -> (HTML around the text, Markdown around it)
CONSTRUCTS: dict[str, tuple[str, str]] = {
    "paragraph": ("<p>One @ two</p>", "One @ two"),
    "heading 1": ("<h1>Top @</h1>", "# Top @"), "heading 4": ("<h4> Part <b>@</b></h4>", "#### Part **@**"),
    "strong": ("<p>a <strong>@</strong> b</p>", "a **@** b"), "emphasis": ("<p>a <em>@</em></p>", "a *@*"), "struck": ('<p>a <span style="text-decoration: line-through;">@</span></p>', "a ~~@~~"),
    "small": ("<p>a <small>@</small> <big>b</big></p>", "a @ b"), "time": ('<p>on <time datetime="2025-01-02">@</time></p>', "on 2025-01-02"),
    "code span": ("<p>run <code>@</code></p>", "run `@`"), "link": ('<p><a href="https://x.example/@">see</a></p>', "[see](https://x.example/@)"), "same page link": ('<p><a href="#top">@</a></p>', "@"),
    "image": ('<p><img src="@.png" alt="pic"></p>', "![pic](@.png)"), "data image": ('<p>a <img src="data:image/png;base64,AA" alt="@"></p>', "a @"), "line break": ("<p>a<br>@</p>", "a\n@"),
    "list": ("<ul><li>a @</li><li>b<ul><li>@</li></ul></li></ul>", "- a @\n- b\n  - @"), "ordered list": ('<ol start="3"><li>@</li><li>b</li></ol>', "3. @\n4. b"), "task list": ('<ul class="inline-task-list"><li class="checked">@</li><li>b</li></ul>', "- [x] @\n- [ ] b"),
    "table": ("<table><tr><th>A</th><th>B</th></tr><tr><td>@</td><td>x|y</td></tr></table>", "| A | B |\n| --- | --- |\n| @ | x\\|y |"), "table cells": ("<table><tr><th>A</th></tr><tr><td><p>@</p><p>b<br>c</p></td></tr></table>", "| A |\n| --- |\n| @; b<br />c |"),
    "merged cells": ('<table><tr><th>A</th><th>B</th></tr><tr><td colspan="2">@</td></tr></table>', "| A | B |\n| --- | --- |\n| @ |  |"), "row headers": ("<table><tr><th>@</th><td>1</td></tr><tr><th>b</th><td>2</td></tr></table>", "|  |  |\n| --- | --- |\n| **@** | 1 |\n| **b** | 2 |"),
    "head rows": ("<table><thead><tr><th>A</th><th>B</th></tr><tr><th>c</th><th>@</th></tr></thead><tr><td>1</td><td>2</td></tr></table>", "| A | B |\n| --- | --- |\n| c | @ |\n| 1 | 2 |"),
    "quote": ("<blockquote><p>@</p></blockquote>", "> @"), "rule": ("<p>@</p><hr><p>b</p>", "@\n\n---\n\nb"), "definition": ("<dl><dt>@</dt><dd>b</dd></dl>", "**@**\n\n: b"),
    "code": ('<pre><code class="language-python">x = "@"</code></pre>', '```python\nx = "@"\n```'), "code macro": ('<div class="code panel"><div class="codeHeader"><b>@</b></div><pre class="syntaxhighlighter-pre" data-syntaxhighlighter-params="brush: py; gutter: false">a = 1</pre></div>', "**@**\n\n```python\na = 1\n```"),
    "code brush unknown": ('<div class="code panel"><pre data-syntaxhighlighter-params="brush: Scala; gutter: false">@</pre></div>', "```scala\n@\n```"), "code brush java": ('<div class="code panel"><pre data-syntaxhighlighter-params="brush: java">select "@" from t</pre></div>', '```sql\nselect "@" from t\n```'),
    "preformatted": ('<div class="preformatted panel"><pre>select @ from b</pre></div>', "```\nselect @ from b\n```"), "bare code": ("<pre>@</pre>", "```\n@\n```"), "code label": ('<div class="code-block"><span class="code-lang">YML</span><pre>a: @</pre></div>', "```yaml\na: @\n```"),
    "warning": ('<div class="confluence-information-macro confluence-information-macro-warning"><p class="title">Hot</p><div class="confluence-information-macro-body"><p>@</p></div></div>', "> **Warning — Hot:**\n>\n> @"), "info": ('<div class="macro-info"><p>@</p></div>', "> **Info:**\n>\n> @"),
    "panel": ('<div class="panel"><div class="panelHeader">Box</div><div class="panelContent"><p>@</p></div></div>', "> **Panel — Box:**\n>\n> @"), "expand": ('<div class="expand-container"><span class="expand-control-text">More</span><div class="expand-content"><p>@</p></div></div>', "**More**\n\n@"),
    "status": ('<p>is <span class="status-macro aui-lozenge">@</span></p>', "is **@**"), "badge": ('<p>is <span class="badge">@</span></p>', "is `@`"), "mention": ('<p>ask <a class="confluence-userlink" href="/people/1">@</a></p>', "ask @"),
    "issue": ('<p><span class="jira-issue resolved"><a class="jira-issue-key" href="https://j.example/browse/AB-1?src=confmacro">AB-1</a> - <span class="summary">@</span><span class="aui-lozenge">Done</span></span></p>', "[AB-1](https://j.example/browse/AB-1) @ (Done) (resolved)"),
    "profile": ('<div class="profile-macro"><img class="userLogo" alt="User icon: @"><a href="/x">link</a></div>', "@"), "emoticon": ('<p>@ <img class="emoticon" data-emoticon-name="tick"></p>', "@ (yes)"),
    "card": ('<div class="adr-card"><div class="adr-card-header"><span class="adr-id">ADR-1</span><span class="adr-title">@</span><span class="badge">accepted</span></div><div class="adr-body"><div class="adr-section"><div class="adr-section-label">Context</div><p>b</p></div></div></div>', "#### ADR-1 — @\n\n**Status:** accepted\n\n**Context:** b"),
    "page properties": ('<div class="page-props"><div class="page-props-title">@</div><table><tr><th>A</th></tr><tr><td>1</td></tr></table></div>', "### @\n\n| A |\n| --- |\n| 1 |"),
    "layout": ('<div class="contentLayout2"><div class="columnLayout"><div class="cell"><div class="innerCell"><p>@</p></div></div><div class="cell"><div class="innerCell"><p>b</p></div></div></div></div>', "@\n\nb"),
    "diagram": ('<figure><svg><text>x</text></svg><figcaption>@</figcaption></figure>', "*@*"), "figure": ('<figure><img src="a.png" alt="x"><figcaption>@</figcaption></figure>', "![x](a.png)\n\n*@*"),
    "gallery": ('<table class="gallery"><tr><td><img class="confluence-embedded-image" alt="@.png"></td><td><img class="confluence-embedded-image" src="/a/b.png"></td></tr></table>', "*Image gallery (2 images): @.png, b.png*"),
    "file": ('<p><a class="confluence-embedded-file" href="/d/1" data-linked-resource-default-alias="@.pdf" data-nice-type="PDF"><img src="t.png"></a></p>', "[@.pdf](/d/1) (PDF)"), "thumbnail": ('<p><a href="/attachments/1.png"><img class="confluence-embedded-image" src="1.png" data-linked-resource-default-alias="@"></a></p>', "![@](1.png)"),
    "power": ("<p>@ has m<sup>2</sup></p>", "@ has m^2"), "footnote": ("<p>@ <sup>1</sup></p>", "@"), "empty paragraph": ("<p><br></p><p>@</p><p> - </p>", "@"),
    "chrome": ('<p>@</p><div class="page-footer">x</div><button>y</button>', "@"), "attachments": ('<p>@</p><div class="pageSection"><h2>Attachments:</h2>a.png</div>', "@"), "nested table": ("<table><tr><th>A</th></tr><tr><td>@<table><tr><td>b</td></tr></table></td></tr></table>", "| A |\n| --- |\n| @b |"),
    "entities": ("<p>a &amp; b &lt;@&gt;</p>", "a & b <@>"), "script": ("<p>@</p><script>var a = '</p>';</script><style>b</style>", "@"),
}


def _construct_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page id within every construct, as a page. The ids are dealt out, not their pages, which are made where they are converted."""
    kinds = spark.createDataFrame([(k, h) for k, (h, _) in CONSTRUCTS.items()], "construct string, html string")
    ids = table(spark, folder, "page_meta").select("doc_id").distinct().repartition(3 * spark.sparkContext.defaultParallelism)
    body = F.replace(F.col("html"), F.lit("@"), F.col("doc_id"))
    page = F.concat(F.lit("<html><head><title>SP : Page "), "doc_id", F.lit("</title></head><body><nav>menu</nav><div id=\"main-content\">"), body, F.lit("</div><footer>end</footer></body></html>"))
    return ids.crossJoin(F.broadcast(kinds)).select("construct", "doc_id", page.alias("text"))  # a stated, fixed set of constructs


def html_constructs(spark: SparkSession, folder: str) -> DataFrame:
    """The Markdown of every page id within every construct."""
    rows = convert.convert_pages(_construct_pages(spark, folder).select(F.concat("construct", F.lit("-"), "doc_id").alias("doc_id"), "text"))
    return rows.select(F.col("doc_id").alias("page"), "status", "title", F.col("meta")["space"].alias("space"), "markdown")


def page_sanity(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by the checks that they fail, and their wiki's flavour."""
    pages = convert.rendered_documents(table(spark, folder, "documents").select("doc_id", "text", "title"))
    flavour = pages.select(lint.wiki_flavour(F.col("text")).alias("flavour"), lint.is_storage_format(F.col("text")).alias("storage")).groupBy("flavour", "storage").agg(F.count("*").alias("n_pages"))
    md = table(spark, folder, "documents").where("text is not null").select(F.explode(convert.sanity(F.col("text"))).alias("failed"))
    return md.groupBy("failed").agg(F.count("*").alias("n")).crossJoin(flavour)  # a few rows each


def visible_texts(spark: SparkSession, folder: str) -> DataFrame:
    """What a reader sees of the documents as pages."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["doc_id"]].assign(seen=[convert.visible_text(t) for t in pdf["text"]])

    rows = convert.rendered_documents(table(spark, folder, "documents").select("doc_id", "text", "title"))
    rows = rows.mapInPandas(run, "doc_id bigint, seen string")
    return rows.select("doc_id", F.md5(F.regexp_replace("seen", r"[ \t\r\n ]+", "")).alias("seen"))


# ---- drawings -----------------------------------------------------------------------


def _drawings(spark: SparkSession, folder: str, shift: float = 0.0) -> DataFrame:
    """Every section as a drawing: a group at (level, seq) that holds a shape with its title, and a line."""
    s = table(spark, folder, "sections").select("doc_id", "section_id", "seq", "heading_level", "title", "section_type").distinct()
    html = F.replace(F.replace(F.coalesce("title", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tid = F.when(F.col("section_type") == "data_model", "com.x.database").when(F.col("section_type") == "decision", "flow.decision").otherwise("box")
    move = F.lit(shift) * (F.col("seq") % 3)
    shape = F.struct((F.col("seq") * 10 + move).alias("x"), F.lit(5).alias("y"), F.lit(100).alias("width"), F.lit(50).alias("height"), F.lit(0).alias("order"), F.struct(F.lit("Shape").alias("type"), F.struct(tid.alias("tid"), html.alias("html")).alias("Shape")).alias("graphic"))
    group = F.struct(F.coalesce("heading_level", F.lit(0)).alias("x"), F.lit(20).alias("y"), F.lit(1).alias("order"), F.array(shape).alias("children"))
    line = '{"x":1,"y":2,"order":0,"graphic":{"type":"Line","Line":{"controlPath":[[0,0],[5,7]],"endArrow":1}}}'
    text = F.concat(F.lit('{"stage":{"objects":['), F.to_json(group), F.lit("," + line + "]}}"))
    return s.select(F.concat_ws("/", "doc_id", "section_id").alias("source"), text.alias("text"))


def diagram_nodes(spark: SparkSession, folder: str) -> DataFrame:
    rows = diagrams.parse_diagrams(_drawings(spark, folder)).select("source", F.explode("nodes").alias("n"), F.size("edges").alias("n_edges"))
    return rows.select("source", "n.kind", "n.x", "n.y", F.col("n.text").alias("label"), "n_edges")


def diagram_kinds(spark: SparkSession, folder: str) -> DataFrame:
    return diagrams.diagram_metrics(diagrams.parse_diagrams(_drawings(spark, folder))).groupBy("kind").agg(F.sum("n").alias("n"))


def diagram_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Shapes that moved by more than the tolerance, against the same drawings with every third shape moved."""
    a, b = (diagrams.parse_diagrams(_drawings(spark, folder, by)) for by in (0.0, 0.4))
    return diagrams.compare(a, b).select("source", "part", "id", "field")


def diagram_pictures(spark: SparkSession, folder: str) -> DataFrame:
    """Pictures of the drawings; overviews have one beside them."""
    drawn = diagrams.rendered(diagrams.parse_diagrams(_drawings(spark, folder)).withColumn("source", F.concat("source", F.lit(".json"))))
    beside = table(spark, folder, "sections").where("section_type = 'overview'").select(F.concat(F.concat_ws("/", "doc_id", "section_id"), F.lit(".svg")).alias("source"), F.lit("<svg>own</svg>").alias("svg")).distinct()
    rows = diagrams.preferring_siblings(drawn, beside)
    return rows.select("source", (F.col("svg") == "<svg>own</svg>").alias("own"), F.regexp_extract("svg", r"<(rect|path|ellipse) ", 1).alias("shape"), F.regexp_extract("svg", r'viewBox="([^"]*)"', 1).alias("box"))


# ---- structure ----------------------------------------------------------------------


def parsed_code(spark: SparkSession, folder: str) -> DataFrame:
    """The fenced code of every document."""
    rows = structure.parsed_rows(table(spark, folder, "documents").select("doc_id", "text")).where("content_type = 'code'")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length(F.regexp_replace("text", r"\s+", ""))).alias("chars"))


def parsed_headings(spark: SparkSession, folder: str) -> DataFrame:
    """The headings of every document by level."""
    rows = structure.parsed_rows(table(spark, folder, "documents").select("doc_id", "text")).where("kind = 'heading'")
    return rows.groupBy("doc_id", "level").agg(F.count("*").alias("n"))


def parsed_titles(spark: SparkSession, folder: str) -> DataFrame:
    """The headings of every document in order, with their place among them and their path."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "title")
    sections, _ = structure.sections_and_blocks(written(structure.parsed_rows(docs)), docs)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq"))
    return sections.where("seq >= 0").withColumn("place", place).select("doc_id", "place", "level", "title", F.size("breadcrumb").alias("depth"))


def lint_findings(spark: SparkSession, folder: str) -> DataFrame:
    """Every finding of every document, with the line of the first match."""
    rows = lint.lint(table(spark, folder, "documents")).select("doc_id", F.explode("issues").alias("i"))
    return rows.select("doc_id", "i.rule", "i.severity", "i.line")


# ---- chunks, inventory, evaluation --------------------------------------------------


def chunk_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every section's chunks in order, without blanks and fences: what is embedded is all of the text, once."""
    rows = corpus._chunks(spark, folder)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_order", "idx", "content"))), lambda c: c["content"]), "")
    return rows.groupBy("doc_id", "section_id").agg(F.md5(F.regexp_replace(text, r"\s+", "")).alias("text"), F.count_distinct("chunk_id").alias("ids"), F.count("*").alias("n")).select("doc_id", "section_id", "text", (F.col("ids") == F.col("n")).alias("distinct_ids"))


def ranked_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of the corpus, the most frequent first."""
    return inventory.frequent_first(corpus.field_frequencies(spark, folder).where("section_key is not null")).select("section_key", "rank", "field", "doc_freq")


def routed_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """Which pages are held against the taxonomy: those of type sad."""
    pages = table(spark, folder, "page_meta").groupBy("doc_id").agg(F.max("doc_type").alias("doc_type"))
    rows = inventory.routed_taxonomy(pages, corpus.corpus_taxonomy(spark, folder))
    return rows.groupBy("doc_id").agg(F.count("section_key").alias("n_sections"))


def evaluated_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Where each page's last section title first occurs among its sections' breadcrumbs, ranked in page order."""
    s = table(spark, folder, "sections").select("doc_id", "section_id", "seq", "title", F.array_join("breadcrumb", " > ").alias("breadcrumb")).distinct()
    ranked = s.select(F.col("doc_id").alias("query_id"), "doc_id", F.col("seq").alias("rank"), "breadcrumb")
    last = s.groupBy("doc_id").agg(F.max_by(F.coalesce("title", F.lit("")), F.struct("seq", "section_id")).alias("section"))
    matchers = last.select(F.col("doc_id").alias("query_id"), F.lit("m").alias("matcher_id"), "doc_id", "section")
    return evaluate.matched_sections(ranked, matchers).select("query_id", "rank")


def eval_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether spaces whose share of prose blocks is the metric pass a floor and a baseline of themselves, one of which fell."""
    rows = _blocks(spark, folder).groupBy("space").agg(F.round(F.avg((F.col("content_type") == "paragraph").cast("double")), 6).alias("m")).orderBy("space").collect()  # a row per space
    out = []
    for r in rows:
        now = {"ALL": {"recall_10": r["m"]}}
        ok, notes = evaluate.judge(now, {"ALL": {"recall_10": r["m"] + (0.05 if (r["space"] or "") < "M" else 0.01)}})
        out.append((r["space"], ok, len(notes)))
    return spark.createDataFrame(out, "space string, passes boolean, n_notes int")


def report_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The stored findings as rows of a page."""
    rows = table(spark, folder, "quality_issues").select("chunk_id", "rule", "severity", "detail").distinct()
    return report.html_rows(rows, "chunk_id")


def scoped_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The sections' metadata as that of a chunk of their blocks' texts: mentions stay only where the chunk holds them."""
    s = table(spark, folder, "sections").select("doc_id", "section_id", F.transform_keys("metadata", lambda k, v: F.concat(F.lit("ner:"), k)).alias("metadata"))
    s = s.groupBy("doc_id", "section_id").agg(F.max_by("metadata", F.size("metadata")).alias("metadata"))
    b = _blocks(spark, folder).where("content_type = 'table' and text is not null").select("doc_id", "section_id", "block_id", "text")
    rows = b.join(s, ["doc_id", "section_id"]).select("doc_id", "block_id", F.explode(chunking.scoped_metadata(F.col("metadata"), F.col("text"))).alias("name", "values"))
    return rows.select("doc_id", "block_id", "name", F.array_join("values", ",").alias("values"))


def merge_strategies(spark: SparkSession, folder: str) -> DataFrame:
    """What is packed together in pages, by their profile."""
    types = classify.document_types(table(spark, folder, "sections").select("doc_id", "section_id", "title").distinct())
    profiles = classify.document_profiles(_blocks(spark, folder), types)
    rows = profiles.select("profile", classify.merge_strategy(F.col("profile"), Config(profile_routing=True)).alias("s")).groupBy("profile", "s.merge_prose", "s.merge_definitions").agg(F.count("*").alias("n"))
    return rows


def newest_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """For each space as a workspace, whatever its spelling, the page that was delivered last there."""
    p = table(spark, folder, "page_meta").where("space <> ''")
    messages = p.select(F.col("doc_id").alias("session_id"), F.col("ingested_at").cast("string").alias("ts"), F.concat(F.lit("C:\\Work\\"), "space", F.lit("/")).alias("cwd"))
    spaces = p.select(F.concat(F.lit("c:/work/"), F.lower("space")).alias("path")).distinct()
    return usage.newest_session(messages, spaces)


def context_footprints(spark: SparkSession, folder: str) -> DataFrame:
    """Sections as context files: what their genres load at the start and on demand, and its cost over ten turns."""
    s = table(spark, folder, "sections").select("doc_id", "section_id", "genre", "section_type", "title").distinct()
    files = s.select(F.coalesce("genre", F.lit("none")).alias("ecosystem"), F.when(F.col("section_type") == "overview", "startup").otherwise("invoke").alias("load"), F.length(F.coalesce("title", F.lit(""))).alias("chars"))
    return usage.context_footprint(files, 10, 3.0)


def result_snippets(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks as results: scores rounded, long texts cut."""
    b = _blocks(spark, folder).where("text is not null").select("doc_id", "block_id", (F.length("text") / F.lit(7.0)).alias("score"), F.col("text").alias("content"))
    rows = search.result_records(b, "content", 100)
    return rows.select("doc_id", "block_id", "score", F.md5("content").alias("snippet"))


QUERIES = {f.__name__: f for f in (
    otlp_spans, otlp_flat_records, otlp_protobuf, telemetry_shapes, session_log_usage, session_prompts, captured_prompts, billing_items, usage_ranked, store_roundtrip, export_roundtrip, paths_and_titles,
    breadcrumb_sections, gate_statuses, construct_totals, conversion_totals, shown_nodes, html_constructs, page_sanity, visible_texts, diagram_nodes, diagram_kinds, diagram_differences, diagram_pictures, parsed_code, parsed_headings, parsed_titles, lint_findings, chunk_texts, ranked_fields,
    routed_taxonomy, evaluated_sections, eval_gate, report_rows, scoped_metadata, merge_strategies, newest_sessions, context_footprints, result_snippets,
)}
# ---- SQL ----------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_B = "(SELECT DISTINCT doc_id, section_id, space, seq, block_id, content_type, text, code_language FROM blocks)"
_E = "(SELECT event_id, ts, event_type, user_id, coalesce(TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END, '$.k') AS BIGINT), 0) AS k FROM events)"
_EXPECTED = ", ".join(f"({_text(k)}, {_text(m)})" for k, (_, m) in CONSTRUCTS.items())
#: constructs met in one page of each kind
_MET = {
    "data_uri_image": 1, "task_list": 2, "merged_table": 1, "row_header_table": 1, "code": 5, "warning": 1, "info": 1, "panel": 1, "expand": 1, "status": 1, "mention": 1, "jira": 1, "profile": 1, "emoticon": 1,
    "adr_card": 1, "layout": 2, "diagram": 1, "gallery": 1, "viewfile": 1, "sup_footnote_dropped": 1, "junk_para_dropped": 1, "nested_table": 1,
}
_DEGRADED = "('panel', 'expand', 'status', 'layout', 'mention', 'emoticon', 'task_list', 'diagram')"
_LEAK = "(?i)<(span|div|p|a|strong|em|table|td|tr|th|u|sup|sub|s|del|code|pre|img)\\b[^>]*>|&(nbsp|amp|lt|gt|quot|#\\d+);"
_MACRO = "(?i)\\{(panel|note|warning|info|tip|code)[^}]*\\}|<ac:[^>]+>|<ri:[^>]+>"
#: documents by line, with what is code: an odd number of fence marks before, or indented lines after an empty one
_LINES = """
ln AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS line FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
l1 AS (SELECT *, regexp_matches(trim(line), '^(```|~~~)') AS mark, trim(line, ' ' || chr(9) || chr(13)) = '' AS bare, starts_with(line, '    ') OR starts_with(line, chr(9)) AS ind FROM ln),
l2 AS (SELECT *, count(*) FILTER (mark) OVER (PARTITION BY doc_id ORDER BY n) % 2 = 1 OR mark AS fenced FROM l1),
l3 AS (SELECT *, count(*) FILTER (bare AND NOT fenced) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM l2),
l4 AS (SELECT *, NOT fenced AND NOT bare AND bool_and(CASE WHEN bare THEN true WHEN fenced THEN NULL ELSE ind END) OVER w AND NOT coalesce(first_value(CASE WHEN bare AND NOT fenced THEN NULL ELSE fenced END IGNORE NULLS) OVER w, false) AS code FROM l3
  WINDOW w AS (PARTITION BY doc_id, g ORDER BY n)),
pr AS (SELECT doc_id, n, line, bare, fenced OR code AS blank, CASE WHEN fenced OR code THEN '' ELSE regexp_replace(line, '`+[^`]*`+', ' ', 'g') END AS p FROM l4),
dp AS (SELECT doc_id, string_agg(p, chr(10) ORDER BY n) AS prose FROM pr GROUP BY doc_id),
hd AS (SELECT doc_id, n, length(regexp_extract(p, '^(#{1,6})\\s+\\S', 1)) AS level FROM pr WHERE regexp_matches(p, '^#{1,6}\\s+\\S')),
hn AS (SELECT *, lead(n, 1, 1000000000) OVER (PARTITION BY doc_id ORDER BY n) AS until, lead(level, 1, 0) OVER (PARTITION BY doc_id ORDER BY n) AS next_level FROM hd),
orp AS (SELECT doc_id, min(n) AS line FROM hn WHERE next_level <= level AND NOT EXISTS (SELECT 1 FROM pr WHERE pr.doc_id = hn.doc_id AND pr.n > hn.n AND pr.n < hn.until AND NOT pr.bare) GROUP BY doc_id)
"""
_LINT = "WITH " + _LINES + f""",
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), x AS (SELECT * FROM d JOIN dp USING (doc_id)),
m AS (SELECT doc_id, text, prose, len(regexp_extract_all(prose, '{_LEAK}')) AS leaks, len(regexp_extract_all(prose, '{_MACRO}')) AS macros,
  coalesce(list_sum(list_transform(regexp_extract_all(text, '(?s)```.*?```|~~~.*?~~~|`[^`]+`'), lambda c: length(c))), 0) AS code_chars, len(regexp_extract_all(prose, '\\S+')) AS words,
  coalesce(list_sum(list_transform(regexp_extract_all(prose, '\\[([^\\]]+)\\]\\([^)]+\\)', 1), lambda c: len(regexp_extract_all(c, '\\S+')))), 0) AS linked,
  length(trim(regexp_replace(regexp_replace(prose, '[#*_`\\[\\]()>|~^\\\\!=+-]', '', 'g'), '\\s+', ' ', 'g'))) AS left_chars FROM x),
fl AS (SELECT doc_id, min(n) FILTER (regexp_matches(p, '{_LEAK}')) AS leak_line, min(n) FILTER (regexp_matches(p, '{_MACRO}')) AS macro_line FROM pr GROUP BY doc_id),
fi AS (SELECT doc_id, 'html_leakage' AS rule, CASE WHEN leaks > 3 THEN 'block' ELSE 'warn' END AS severity, leak_line AS line FROM m JOIN fl USING (doc_id) WHERE leaks > 0
UNION ALL SELECT doc_id, 'confluence_artifacts', 'block', macro_line FROM m JOIN fl USING (doc_id) WHERE macros > 0
UNION ALL SELECT doc_id, 'code_ratio', 'warn', NULL FROM m WHERE length(text) > 0 AND code_chars / length(text) > 0.75
UNION ALL SELECT doc_id, 'link_density', 'warn', NULL FROM m WHERE words > 0 AND linked / words > 0.5
UNION ALL SELECT doc_id, 'content_density', 'block', NULL FROM m WHERE left_chars < 200
UNION ALL SELECT doc_id, 'orphaned_headings', 'warn', line FROM orp)
"""

_SHAPES = """(SELECT DISTINCT doc_id || '/' || section_id AS source, seq, coalesce(heading_level, 0) AS lv, section_type, trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g')) AS label,
  CASE section_type WHEN 'data_model' THEN 'cylinder' WHEN 'decision' THEN 'diamond' ELSE 'rect' END AS kind FROM sections)"""

ORACLE: dict[str, str] = {
    "front_matter": """WITH d AS (SELECT doc_id, regexp_extract(text, '(?s)\\A---[ \\t]*\\n(.*?)\\n---[ \\t]*(?:\\n|\\z)', 1) AS f FROM documents WHERE text IS NOT NULL)
SELECT doc_id, trim(regexp_extract(f, '(?m)^title:(.*)$', 1)) AS title, nullif(trim(regexp_extract(f, '(?m)^space:(.*)$', 1)), '') AS space, array_to_string(list_filter(list_transform(string_split(regexp_extract(f, '(?m)^labels:(.*)$', 1), ','), lambda x: trim(x)), lambda x: x <> ''), ',') AS labels
FROM d WHERE regexp_matches(f, '(?m)^title:')""",
    "lint_findings": _LINT + "SELECT doc_id, rule, severity, CAST(line AS INTEGER) AS line FROM fi",
    "lint_report": _LINT + "SELECT rule, severity, count(*) AS n FROM fi GROUP BY ALL",
    "gate_statuses": _LINT + "SELECT status, count(*) AS n FROM (SELECT doc_id, CASE WHEN bool_or(severity = 'block') THEN 'failed' WHEN count(rule) > 0 THEN 'issue' ELSE 'clean' END AS status FROM d LEFT JOIN fi USING (doc_id) GROUP BY doc_id) GROUP BY status",
    "otlp_spans": f"SELECT event_type AS model, 'u' || user_id AS session, CAST(sum(k) AS BIGINT) AS tokens_in, count(*) AS n, count(DISTINCT event_id % 50) AS traces, count(ts) AS dated FROM {_E} WHERE k > 0 GROUP BY ALL",
    "otlp_flat_records": f"SELECT event_type AS model, CAST(sum(k) AS BIGINT) AS tokens_out, count(DISTINCT event_id % 50) AS traces, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts FROM {_E} WHERE ts IS NOT NULL AND k > 0 GROUP BY ALL",
    "otlp_protobuf": f"SELECT 'token.usage' AS name, 'u' || user_id AS session, event_type AS model, CAST(sum(k) AS DOUBLE) AS total, count(*) AS n FROM {_E} WHERE user_id IS NOT NULL GROUP BY ALL",
    "telemetry_shapes": f"SELECT 'a event_id' AS shape, count(*) AS n, CAST(sum(k) AS BIGINT) AS total, 3 * count(*) AS n_paths FROM {_E}",
    "session_log_usage": f"SELECT event_type AS model, coalesce(strftime(ts, '%Y-%m-%d'), '?') AS day, CAST(sum(k) AS BIGINT) AS tokens_in, 2 * count(*) AS tokens_out, count(*) AS n, count(DISTINCT coalesce('u' || user_id, 'f')) AS sessions FROM {_E} GROUP BY ALL",
    "session_prompts": f"""SELECT doc_id AS session_id, count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS chars FROM (SELECT doc_id, trim(text) AS t FROM {_B} WHERE content_type = 'paragraph' AND text IS NOT NULL AND seq % 5 <> 0)
  WHERE t <> '' AND NOT starts_with(t, '<command') GROUP BY ALL""",
    "captured_prompts": "SELECT DISTINCT 'r' || item_id AS response_id, query_text AS prompt FROM golden_items WHERE query_text IS NOT NULL",
    "billing_items": "SELECT o_orderpriority AS product, round(sum(o_totalprice), 2) AS net, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS copilot_net FROM orders GROUP BY ALL",
    "usage_ranked": "WITH d AS (" + usage_plans.ORACLE["usage_by_day"] + """), t AS (SELECT grp, CAST(sum(tokens_in + tokens_out + cache_read + cache_write) AS BIGINT) AS tokens, round(sum(cost), 8) AS c FROM d GROUP BY grp)
SELECT grp, tokens, round(c, 4) AS cost, row_number() OVER (ORDER BY tokens DESC, grp) AS rank, 'tokens' AS ranked_by FROM t UNION ALL SELECT grp, tokens, round(c, 4), row_number() OVER (ORDER BY c DESC, grp), 'cost' FROM t""",
    "parsed_headings": "WITH " + _LINES + """, f AS (SELECT doc_id, min(n) FILTER (n > 1 AND trim(line) = '---') AS ends, bool_or(n = 1 AND trim(line) = '---') AS front FROM l2 GROUP BY doc_id),
u AS (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY n) AS above, lag(fenced, 1, false) OVER (PARTITION BY doc_id ORDER BY n) AS above_fenced FROM l2),
h AS (SELECT doc_id, n, CASE WHEN regexp_matches(line, '^ {0,3}#{1,6}(?:[ \\t]|$)') THEN length(regexp_extract(line, '^ {0,3}(#{1,6})(?:[ \\t]|$)', 1))
  WHEN regexp_matches(line, '^ {0,3}=+[ \\t]*$') AND NOT above_fenced AND regexp_matches(above, '^[^\\s#>|]') THEN 1 END AS level FROM u WHERE NOT fenced)
SELECT doc_id, CAST(level AS INTEGER) AS level, count(*) AS n FROM h JOIN f USING (doc_id) WHERE level IS NOT NULL AND NOT (front AND n <= ends) GROUP BY ALL""",
    "parsed_titles": "WITH " + _LINES + """, f AS (SELECT doc_id, min(n) FILTER (n > 1 AND trim(line) = '---') AS ends, bool_or(n = 1 AND trim(line) = '---') AS front FROM l2 GROUP BY doc_id),
u AS (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY n) AS above, lag(fenced, 1, false) OVER (PARTITION BY doc_id ORDER BY n) AS above_fenced FROM l2),
x AS (SELECT doc_id, n, CASE WHEN regexp_matches(line, '^ {0,3}#{1,6}(?:[ \\t]|$)') THEN length(regexp_extract(line, '^ {0,3}(#{1,6})(?:[ \\t]|$)', 1))
  WHEN regexp_matches(line, '^ {0,3}=+[ \\t]*$') AND NOT above_fenced AND regexp_matches(above, '^[^\\s#>|]') THEN 1 END AS level,
  CASE WHEN regexp_matches(line, '^ {0,3}#') THEN trim(regexp_replace(regexp_replace(line, '^ {0,3}#+', ''), '[ \\t]+#+[ \\t]*$', '')) ELSE trim(above) END AS title FROM u WHERE NOT fenced),
h AS (SELECT doc_id, n, level, title, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS place FROM x JOIN f USING (doc_id) WHERE level IS NOT NULL AND NOT (front AND n <= ends)),
e AS (SELECT doc_id, min(n) AS first_text FROM l2 JOIN f USING (doc_id) WHERE NOT bare AND NOT (front AND n <= ends) GROUP BY doc_id),
r AS (SELECT doc_id, min(CASE WHEN title = trim(line) THEN n - 1 ELSE n END) AS first_head FROM (SELECT h.doc_id, h.n, h.title, l.line FROM h JOIN l2 l ON l.doc_id = h.doc_id AND l.n = h.n - 1 UNION ALL SELECT doc_id, n, title, '' FROM h WHERE n = 1) GROUP BY doc_id),
o AS (SELECT h.doc_id, h.place FROM h JOIN e USING (doc_id) JOIN r USING (doc_id) WHERE first_text < first_head AND level > 1 AND NOT EXISTS (SELECT 1 FROM h m WHERE m.doc_id = h.doc_id AND m.place < h.place AND m.level = 1)),
a AS (SELECT h.doc_id, h.place, count(*) AS above FROM h JOIN h g ON g.doc_id = h.doc_id AND g.place < h.place AND g.level < h.level AND NOT EXISTS (SELECT 1 FROM h m WHERE m.doc_id = h.doc_id AND m.place > g.place AND m.place < h.place AND m.level <= g.level) GROUP BY ALL)
SELECT h.doc_id, CAST(h.place AS INTEGER) AS place, CAST(level AS INTEGER) AS level, title, CAST(coalesce(above, 0) + 1 + CASE WHEN o.place IS NULL THEN 0 ELSE 1 END AS INTEGER) AS depth
FROM h LEFT JOIN a ON a.doc_id = h.doc_id AND a.place = h.place LEFT JOIN o ON o.doc_id = h.doc_id AND o.place = h.place""",
    "store_roundtrip": f"""WITH b AS {_B}, d AS (SELECT DISTINCT doc_id FROM b WHERE space = 'MERROW'), k AS (SELECT * FROM b WHERE doc_id NOT IN (SELECT doc_id FROM d))
SELECT content_type, CASE WHEN content_type = 'table' THEN 2 ELSE 1 END AS version, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars, (SELECT count(*) FROM b WHERE doc_id IN (SELECT doc_id FROM d)) AS deleted, 'hashing' AS provider, 512 AS dimension FROM k GROUP BY ALL""",
    "export_roundtrip": f"SELECT content_type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT doc_id) AS docs FROM {_B} GROUP BY ALL",
    "paths_and_titles": f"""WITH m AS (SELECT doc_id, min(source_path) AS path FROM page_meta WHERE source_path LIKE 'inbox/%' GROUP BY doc_id), t AS (SELECT doc_id, section_id, min(title) AS title FROM sections GROUP BY ALL),
b AS (SELECT doc_id, section_id, count(*) AS n FROM {_B} GROUP BY ALL)
SELECT doc_id, section_id, n, coalesce(nullif(title, ''), section_id) AS title, coalesce(path, '?') AS path FROM b LEFT JOIN t USING (doc_id, section_id) LEFT JOIN m USING (doc_id)""",
    "breadcrumb_sections": "SELECT doc_id, array_to_string(breadcrumb, ' > ') AS path, section_id FROM (SELECT DISTINCT doc_id, section_id, seq, breadcrumb FROM sections) QUALIFY row_number() OVER (PARTITION BY doc_id, breadcrumb ORDER BY seq DESC, section_id DESC) = 1",
    "html_constructs": f"SELECT construct || '-' || doc_id AS page, 'ok' AS status, 'Page ' || doc_id AS title, 'SP' AS space, replace(md, '@', doc_id) || chr(10) AS markdown FROM (SELECT DISTINCT doc_id FROM page_meta), (VALUES {_EXPECTED}) AS c(construct, md)",
    "construct_totals": "WITH p AS (SELECT count(DISTINCT doc_id) AS k FROM page_meta) SELECT construct, n * k AS n, CASE WHEN construct IN " + _DEGRADED + " THEN 'degraded' ELSE 'silent' END AS tier FROM p, (VALUES " + ", ".join(f"('{c}', {n})" for c, n in _MET.items()) + ") AS c(construct, n)",
    "conversion_totals": f"SELECT {len(CONSTRUCTS)} * k AS ok, 0 AS rejected, 0 AS error, 4 * k AS n_headings, 7 * k AS n_tables FROM (SELECT count(DISTINCT doc_id) AS k FROM page_meta)",
    "shown_nodes": """
WITH s AS (SELECT DISTINCT doc_id, section_id, entities, depends_on, exposes FROM sections), e AS (SELECT unnest(entities) AS x FROM s UNION ALL SELECT unnest(depends_on) FROM s UNION ALL SELECT unnest(exposes) FROM s),
n AS (SELECT 'space' AS kind, count(DISTINCT space) AS n FROM page_meta WHERE space <> '' UNION ALL SELECT 'document', count(DISTINCT doc_id) FROM s UNION ALL SELECT 'section', count(DISTINCT (doc_id, section_id)) FROM s
  UNION ALL SELECT 'entity', count(DISTINCT lower(x)) FROM e WHERE trim(x) <> '')
SELECT kind, least(n, 71) AS n_shown, greatest(n - 71, 0) AS n_left_out FROM n WHERE n > 0""",
    "page_sanity": """
WITH d AS (SELECT text FROM documents WHERE text IS NOT NULL), p AS (SELECT 'unknown' AS flavour, false AS storage, count(*) AS n_pages FROM d),
f AS (SELECT 'tables' AS failed FROM d WHERE NOT regexp_matches(text, '\\| ?---') UNION ALL SELECT 'headings' FROM d WHERE NOT regexp_matches(text, '(?m)^#{1,4} ')
  UNION ALL SELECT 'no runs of empty lines' FROM d WHERE regexp_matches(text, '\\n{4,}') UNION ALL SELECT 'no raw div' FROM d WHERE contains(text, '<div class=') UNION ALL SELECT 'no layout class' FROM d WHERE contains(text, 'class="atl-')
  UNION ALL SELECT 'no data uri' FROM d WHERE contains(text, 'data:image/svg+xml;base64'))
SELECT failed, count(*) AS n, any_value(flavour) AS flavour, any_value(storage) AS storage, any_value(n_pages) AS n_pages FROM f, p GROUP BY failed""",
    "diagram_nodes": "SELECT source, kind, CAST(seq * 10 + lv AS DOUBLE) AS x, 25.0::DOUBLE AS y, label, 1 AS n_edges FROM " + _SHAPES,
    "diagram_kinds": "SELECT kind, count(*) AS n FROM " + _SHAPES + " GROUP BY kind UNION ALL SELECT 'edge', count(*) FROM " + _SHAPES,
    "diagram_differences": "SELECT source, 'nodes' AS part, 'n0000' AS id, 'x' AS field FROM " + _SHAPES + " WHERE seq % 3 = 2",
    "diagram_pictures": """SELECT source || '.json' AS source, section_type IS NOT DISTINCT FROM 'overview' AS own, CASE WHEN section_type IS NOT DISTINCT FROM 'overview' THEN '' WHEN kind = 'rect' THEN 'rect' ELSE 'path' END AS shape,
  CASE WHEN section_type IS NOT DISTINCT FROM 'overview' THEN '' ELSE '0 0 ' || (seq * 10 + lv + 100) || ' 75' END AS box FROM """ + _SHAPES,
    "visible_texts": "SELECT doc_id, md5(regexp_replace(text, '[ \\t\\r\\n\\x{a0}]+', '', 'g')) AS seen FROM documents WHERE text IS NOT NULL",
    "parsed_code": "WITH " + _LINES + """, c AS (SELECT doc_id, n, line, mark, count(*) FILTER (mark) OVER (PARTITION BY doc_id ORDER BY n) AS k FROM l2),
b AS (SELECT doc_id, k, string_agg(CASE WHEN mark THEN '' ELSE line END, chr(10) ORDER BY n) AS body FROM c WHERE k % 2 = 1 GROUP BY ALL)
SELECT doc_id, count(*) AS n, CAST(sum(length(regexp_replace(body, '\\s+', '', 'g'))) AS BIGINT) AS chars FROM b GROUP BY doc_id""",
    "chunk_texts": f"""SELECT doc_id, section_id, md5(string_agg(regexp_replace(text, '\\s+', '', 'g'), '' ORDER BY seq)) AS text, true AS distinct_ids FROM {_B} JOIN (SELECT DISTINCT doc_id, section_id FROM sections) USING (doc_id, section_id)
  WHERE regexp_matches(replace(text, '`', ''), '[A-Za-z0-9]') GROUP BY ALL""",
    "ranked_fields": "SELECT section_key, row_number() OVER (PARTITION BY section_key ORDER BY doc_freq DESC, field) AS rank, field, doc_freq FROM (" + corpus.ORACLE["field_frequencies"] + ") WHERE section_key IS NOT NULL",
    "routed_taxonomy": "SELECT doc_id, CASE WHEN t = 'sad' THEN (SELECT count(*) FROM (" + corpus.ORACLE["corpus_taxonomy"] + ")) ELSE 0 END AS n_sections FROM (SELECT doc_id, max(doc_type) AS t FROM page_meta GROUP BY doc_id)",
    "evaluated_sections": """WITH s AS (SELECT DISTINCT doc_id, section_id, seq, title, array_to_string(breadcrumb, ' > ') AS b FROM sections),
l AS (SELECT doc_id, coalesce(title, '') AS t FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq DESC, section_id DESC) = 1)
SELECT doc_id AS query_id, min(seq) AS rank FROM s JOIN l USING (doc_id) WHERE contains(lower(b), lower(t)) GROUP BY doc_id""",
    "eval_gate": f"""SELECT space, m >= 0.5 AND coalesce(space, '') >= 'M' AS passes, CAST(CASE WHEN m < 0.5 THEN 1 ELSE 0 END + CASE WHEN coalesce(space, '') < 'M' THEN 1 ELSE 0 END AS INTEGER) AS n_notes
  FROM (SELECT space, round(avg(CASE WHEN content_type = 'paragraph' THEN 1.0 ELSE 0.0 END), 6) AS m FROM {_B} GROUP BY space)""",
    "report_rows": "SELECT chunk_id, '<tr>' || " + " || ".join(f"'<td>' || replace(replace(replace(replace(coalesce({c}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') || '</td>'" for c in ("chunk_id", "rule", "severity", "detail")) + " || '</tr>' AS html FROM (SELECT DISTINCT chunk_id, rule, severity, detail FROM quality_issues)",
    "scoped_metadata": f"""
WITH s AS (SELECT doc_id, section_id, max_by(metadata, cardinality(metadata)) AS m FROM sections WHERE metadata IS NOT NULL GROUP BY ALL), b AS (SELECT * FROM {_B} WHERE content_type = 'table' AND text IS NOT NULL),
e AS (SELECT b.doc_id, block_id, text, unnest(map_entries(m)) AS e FROM b JOIN s USING (doc_id, section_id))
SELECT doc_id, block_id, 'ner:' || e.key AS name, array_to_string(list_filter(e.value, lambda x: x IS NOT NULL AND contains(text, x)), ',') AS values FROM e""",
    "merge_strategies": "SELECT profile, profile = 'prose' AS merge_prose, profile = 'technical' AS merge_definitions, count(*) AS n FROM (" + pages.ORACLE["document_profiles"] + ") GROUP BY profile",
    "newest_sessions": "SELECT 'c:/work/' || lower(space) AS workspace, doc_id AS session_id FROM page_meta WHERE space <> '' QUALIFY row_number() OVER (PARTITION BY space ORDER BY ingested_at DESC, doc_id DESC) = 1",
    "context_footprints": """
WITH s AS (SELECT DISTINCT doc_id, section_id, genre, section_type, title FROM sections), f AS (SELECT coalesce(genre, 'none') AS ecosystem, section_type IS NOT DISTINCT FROM 'overview' AS start, CAST(round_even(length(coalesce(title, '')) / 4.0, 0) AS BIGINT) AS t FROM s),
g AS (SELECT ecosystem, CAST(coalesce(sum(t) FILTER (start), 0) AS BIGINT) AS startup, CAST(coalesce(sum(t) FILTER (NOT start), 0) AS BIGINT) AS invoke FROM f GROUP BY ecosystem)
SELECT ecosystem, startup, invoke, round(startup / (SELECT sum(startup) FROM g), 6) AS share, round(startup * 10 * 3.0 / 1e6, 6) AS cost FROM g""",
    "result_snippets": f"SELECT doc_id, block_id, round(length(text) / 7.0, 4) AS score, md5(CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END) AS snippet FROM {_B} WHERE text IS NOT NULL",
}
