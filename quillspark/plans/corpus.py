"""Queries over chunks, tables and facts: chunking, embedding text, inventory, taxonomy, store, serving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import chunking, classify, convert, inventory, report, search, serve, store, structure
from quillspark.plans.pages import _B, _HEADER, _KEY, _S
from quillspark.session import written
from quillspark.tables import distinct_blocks, table


def _sections(spark: SparkSession, folder: str) -> DataFrame:
    cols = ["doc_id", "section_id", "seq", "title", "breadcrumb", "section_type", "genre", "entities", "tags", "depends_on", "exposes"]
    return table(spark, folder, "sections").select(*cols).distinct()


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_blocks(table(spark, folder, "blocks"))


def _widths(spark: SparkSession, folder: str) -> DataFrame:
    """Sections with their width; a space's own limit of characters counts."""
    space = table(spark, folder, "blocks").groupBy("doc_id").agg(F.max("space").alias("space"))
    limits = table(spark, folder, "pipeline_config").select("space", "max_chunk_chars")
    rows = _sections(spark, folder).join(space, "doc_id", "left").join(limits, "space", "left")
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    reserve = chunking.header_reserve(F.array_join("breadcrumb", " > "), F.col("section_type"), tags, F.col("genre"))
    return rows.withColumn("reserve", reserve.cast("int")).withColumn("width", chunking.width(F.col("reserve"), F.col("max_chunk_chars")))


def chunk_widths(spark: SparkSession, folder: str) -> DataFrame:
    return _widths(spark, folder).select("doc_id", "section_id", "reserve", "width")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    sections = _widths(spark, folder).groupBy("doc_id", "section_id").agg(F.min("genre").alias("genre"), F.min("width").alias("width"))
    return chunking.chunks(_blocks(spark, folder).withColumnRenamed("code_language", "language"), sections)


def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _chunks(spark, folder)


def chunk_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _chunks(spark, folder).groupBy("content_type").agg(F.count("*").alias("n"), F.max(F.length("content")).alias("longest"), F.count_distinct("chunk_id").alias("ids"))


def embed_headers(spark: SparkSession, folder: str) -> DataFrame:
    none = F.array().cast("array<string>")
    head = chunking.embed_header(
        crumb=F.coalesce("breadcrumb", none), section_type=F.col("section_type"), genre=F.col("genre"), keywords=F.filter(F.coalesce("entities", none), lambda x: x.isNotNull()),
        tags=F.filter(F.coalesce("tags", none), lambda x: x.isNotNull()), depends_on=F.coalesce("depends_on", none), exposes=F.coalesce("exposes", none),
    )
    return _sections(spark, folder).select("doc_id", "section_id", head.alias("header")).distinct()


def table_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).where("content_type = 'table' and text is not null").select("doc_id", "block_id", chunking.table_summary(F.col("text")).alias("summary"))


def _tables(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.parsed_tables(_blocks(spark, folder))


def table_records(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.table_records(_tables(spark, folder)).select("doc_id", "block_id", "row_no", "col_no", "field", "value")


def field_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.field_frequencies(_tables(spark, folder), _sections(spark, folder).select("doc_id", "section_id", "title"))


def frequent_fields(spark: SparkSession, folder: str) -> DataFrame:
    return field_frequencies(spark, folder).where("doc_freq >= 2 and section_key is null").select("field", "doc_freq")


def corpus_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    rows = inventory.corpus_taxonomy(_tables(spark, folder), _sections(spark, folder).select("doc_id", "section_id", "title"))
    return rows.select("section_key", F.array_join("fields", ",").alias("fields"), "orientation")


def _prose(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.prose_records(_blocks(spark, folder).where("content_type not in ('code', 'table')").select("doc_id", "section_id", "seq", "text"))


def prose_records(spark: SparkSession, folder: str) -> DataFrame:
    return _prose(spark, folder).select("doc_id", "section_id", "value", "source", "confidence")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    cells = inventory.table_records(_tables(spark, folder)).select("doc_id", "section_id", F.col("value").alias("canonical"), "field", F.lit("table_cell").alias("source"), F.lit(1.0).alias("confidence"), F.col("value").alias("text"))
    prose = _prose(spark, folder).select("doc_id", "section_id", F.col("value").alias("canonical"), F.lit("").alias("field"), "source", "confidence", F.col("value").alias("text"))
    return cells.unionByName(prose)


def reconciled_records(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.reconcile(_records(spark, folder)).select("doc_id", "section_id", "canonical", "field", "source", "confidence")


def routed_records(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.routed(inventory.reconcile(_records(spark, folder))).groupBy("target").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def sections_with_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every section with the number of its records, by a left join on (doc_id, section_id)."""
    n = _records(spark, folder).groupBy("doc_id", "section_id").agg(F.count("*").alias("n"))
    return _sections(spark, folder).select("doc_id", "section_id").distinct().join(n, ["doc_id", "section_id"], "left").select("doc_id", "section_id", F.coalesce("n", F.lit(0)).alias("n_records"))


def newest_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The last delivery of each page."""
    rows = store.last_per_key(table(spark, folder, "page_meta"), "doc_id", "ingested_at")
    return rows.select("doc_id", "title", "space", "author", F.array_join(F.coalesce("labels", F.array().cast("array<string>")), ",").alias("labels"))


def provenance_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Even pages stored, then every page of one space put over them: sources per content type."""
    b = _blocks(spark, folder).select(F.concat_ws("_", "doc_id", "block_id").alias("chunk_id"), "doc_id", "space", "content_type")
    old = b.where("content_type in ('paragraph', 'list')").withColumn("origin", F.lit("old"))
    new = b.where("space = 'CORVANE'").withColumn("origin", F.lit("new"))
    return store.upserted(old, new).groupBy("content_type", "origin").agg(F.count("*").alias("n"))


def delete_document_counts(spark: SparkSession, folder: str) -> DataFrame:
    b = _blocks(spark, folder)
    kept, deleted = store.without_documents(b, b.where("space = 'MERROW'").select("doc_id"))
    return kept.agg(F.count("*").alias("n_kept")).crossJoin(deleted)  # one row each


def _scored_sections(spark: SparkSession, folder: str) -> DataFrame:
    s = _sections(spark, folder).select(F.concat_ws("_", "doc_id", "section_id").alias("chunk_id"), F.array_join("breadcrumb", " ").alias("crumb"), "section_type").distinct()
    scores = search.bm25(s, "chunk_id", F.col("crumb"), search.query_terms(spark, {"q": "architecture decision security data model overview"}))
    return scores.join(s.select(F.col("chunk_id").alias("id"), "section_type"), "id").select(F.col("id").alias("chunk_id"), "section_type", "score")


def decision_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return serve.decision_buckets(_scored_sections(spark, folder)).select("bucket", "rank", "chunk_id", F.round("score", 6).alias("score"))


def coverage_hard(spark: SparkSession, folder: str) -> DataFrame:
    words = spark.createDataFrame([("parcel-router",), ("Audit Trail",), ("no-such-service",)], "entity string")
    chunks = _blocks(spark, folder).where("content_type = 'paragraph'").select(F.concat_ws("_", "doc_id", "block_id").alias("chunk_id"), F.col("text").alias("content"))
    return serve.hard_coverage(chunks, words)


def token_retention(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document's text its cleaned form keeps."""
    d = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("before"))
    return report.retention(d.withColumn("after", classify.without_fences(F.col("before")))).select("doc_id", "retention", "dropped")


def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = report.graph(_sections(spark, folder), table(spark, folder, "page_meta"))
    a = nodes.groupBy("kind").agg(F.count("*").alias("n")).withColumn("part", F.lit("node"))
    return a.unionByName(edges.groupBy("kind").agg(F.count("*").alias("n")).withColumn("part", F.lit("edge")))


def parsed_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Documents parsed to headings and blocks, by kind."""
    rows = structure.parsed_rows(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.groupBy("kind", "level", "content_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def parsed_sections(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "title")
    sections, blocks = structure.sections_and_blocks(written(structure.parsed_rows(docs)), docs)  # read by several windows
    n = blocks.groupBy("doc_id", "section_id").agg(F.count("*").alias("n_blocks"))
    return sections.join(n, ["doc_id", "section_id"], "left").select("doc_id", "section_id", "seq", "level", F.array_join("breadcrumb", " > ").alias("path"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))


def front_matter(spark: SparkSession, folder: str) -> DataFrame:
    rows = structure.front_matter_rows(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.where("title is not null").select("doc_id", "title", "space", F.array_join("labels", ",").alias("labels"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return convert.rendered_documents(table(spark, folder, "documents").select("doc_id", "text", "title"))


def converted_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents rendered as pages and converted back, by status."""
    rows = convert.convert_pages(_pages(spark, folder))
    return rows.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.length("markdown")).alias("chars"), F.sum(F.coalesce(F.element_at("macro_counts", "dropped_tag"), F.lit(0))).alias("dropped_tags"))


def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return convert.convert_pages(_pages(spark, folder)).select("doc_id", "status", "title")


QUERIES = {f.__name__: f for f in (
    converted_pages, page_titles, chunk_widths, chunk_documents, chunk_summary, embed_headers, table_summaries, table_records, field_frequencies, frequent_fields, corpus_taxonomy, prose_records,
    reconciled_records, routed_records, sections_with_records, newest_pages, provenance_upsert, delete_document_counts, decision_buckets, coverage_hard, token_retention,
    graph_edges, parsed_markdown, parsed_sections, front_matter,
)}

# ---- SQL ----------------------------------------------------------------------------

_SECT = "(SELECT DISTINCT doc_id, section_id, seq, title, breadcrumb, section_type, genre, entities, tags, depends_on, exposes FROM sections)"
_ROW = "list_transform(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), lambda x: list_transform(string_split(regexp_replace(regexp_replace(trim(x), '^\\|', ''), '\\|$', ''), '|'), lambda c: trim(c)))"
_TABLES = f"""
t0 AS (SELECT *, {_ROW} AS rows FROM {_B} WHERE content_type = 'table' AND text IS NOT NULL),
t1 AS (SELECT *, len(rows) >= 2 AND len(list_filter(rows[2], lambda c: NOT regexp_matches(c, '^:?-+:?$'))) = 0 AS has FROM t0),
t2 AS (SELECT doc_id, section_id, block_id, CASE WHEN has THEN rows[1] ELSE []::VARCHAR[] END AS raw_header,
  list_filter(CASE WHEN has THEN rows[3:] ELSE rows END, lambda r: len(list_filter(r, lambda c: NOT regexp_matches(c, '^:?-+:?$'))) > 0) AS body FROM t1),
h0 AS (SELECT doc_id, section_id, block_id, generate_subscripts(raw_header, 1) AS col_no, unnest(raw_header) AS h FROM t2),
h1 AS (SELECT doc_id, section_id, block_id, col_no, {_HEADER.format(x='h')} AS field FROM h0),
hw AS (SELECT doc_id, section_id, block_id FROM h1 GROUP BY ALL HAVING bool_or(field <> '')),
hk AS (SELECT doc_id, section_id, block_id FROM h1 GROUP BY ALL HAVING count(*) = 2 AND bool_or(col_no = 1 AND field IN ('field', 'key', 'name', 'property', 'parameter', 'setting', 'attribute', 'option')) AND bool_or(col_no = 2 AND field IN ('value', 'values', 'description', 'detail', 'details'))),
b0 AS (SELECT doc_id, section_id, block_id, generate_subscripts(body, 1) AS row_no, unnest(body) AS r FROM t2),
b1 AS (SELECT doc_id, section_id, block_id, row_no, r, generate_subscripts(r, 1) AS col_no, unnest(r) AS v FROM b0)
"""
_RECORDS = _TABLES + f""",
wide AS (SELECT b1.doc_id, b1.section_id, b1.block_id, b1.row_no - 1 AS row_no, b1.col_no - 1 AS col_no, field, v AS value FROM b1 JOIN h1 USING (doc_id, section_id, block_id, col_no)
  JOIN hw USING (doc_id, section_id, block_id) ANTI JOIN hk USING (doc_id, section_id, block_id)),
kv AS (SELECT doc_id, section_id, block_id, row_no - 1 AS row_no, 1 AS col_no, CASE WHEN regexp_matches(r[1], '^\\[.*\\]$') THEN '' ELSE {_HEADER.format(x='r[1]')} END AS field, r[2] AS value FROM b0
  WHERE len(r) >= 2 AND ((doc_id, section_id, block_id) IN (SELECT (doc_id, section_id, block_id) FROM hk) OR (doc_id, section_id, block_id) NOT IN (SELECT (doc_id, section_id, block_id) FROM hw))),
rec AS (SELECT * FROM (SELECT * FROM wide UNION ALL SELECT * FROM kv) WHERE field <> '' AND value IS NOT NULL AND value <> '' AND NOT regexp_matches(value, '^\\[.*\\]$'))
"""
_FIELDS = _TABLES + f""",
fo AS (SELECT DISTINCT doc_id, section_id, block_id, field, 'wide' AS orientation FROM h1 WHERE field <> ''
  UNION SELECT DISTINCT doc_id, section_id, block_id, {_HEADER.format(x='r[1]')}, 'key_value' FROM b0
  WHERE (doc_id, section_id, block_id) NOT IN (SELECT (doc_id, section_id, block_id) FROM hw) AND r[1] <> '' AND NOT regexp_matches(r[1], '^\\[.*\\]$')),
ti AS (SELECT DISTINCT doc_id, section_id, {_HEADER.format(x=_KEY)} AS section_key FROM {_S}),
ff AS (SELECT fo.*, section_key FROM fo JOIN ti USING (doc_id, section_id) WHERE field <> '')
"""
_PROSE_SQL = f"""
px AS (SELECT doc_id, section_id, seq, regexp_replace(text, '(?s)```.*?```|~~~.*?~~~', ' ', 'g') AS t FROM {_B} WHERE content_type NOT IN ('code', 'table') AND text IS NOT NULL),
py AS (SELECT doc_id, section_id, seq, list_concat(list_concat(
  list_transform(list_filter(regexp_extract_all(regexp_replace(t, '[À-ÖØ-öø-ÿ]', 'q', 'g'), '\\b[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*\\b'), lambda v: length(v) >= 3 AND v NOT IN ('TODO', 'NOTE', 'FIXME', 'WARNING', 'INFO', 'TIP', 'OK', 'ID', 'URL', 'API', 'N/A')), lambda v: {{'v': v, 's': 'allcaps_regex', 'c': 0.9::DOUBLE}}),
  list_transform(regexp_extract_all(t, '`([^`\\n]+)`', 1), lambda v: {{'v': trim(v), 's': 'backtick_regex', 'c': 0.8::DOUBLE}})), list_concat(list_concat(
  list_transform(regexp_extract_all(t, '\\b[A-Z][a-z]+(?:[A-Z][a-z0-9]+)+\\b'), lambda v: {{'v': v, 's': 'prose', 'c': 0.6::DOUBLE}}),
  list_transform(regexp_extract_all(t, '\\b[a-z][a-z0-9]*(?:-[a-z0-9]+)+\\b'), lambda v: {{'v': v, 's': 'prose', 'c': 0.6::DOUBLE}})),
  list_transform(regexp_extract_all(t, '\\b[0-9A-Za-z_]+(?:/[0-9A-Za-z_]+){{2,}}\\b'), lambda v: {{'v': v, 's': 'prose', 'c': 0.6::DOUBLE}}))) AS l FROM px),
pz AS (SELECT doc_id, section_id, seq, generate_subscripts(l, 1) AS pos, unnest(l) AS r FROM py),
pr AS (SELECT doc_id, section_id, seq, r.v AS value, r.s AS source, r.c AS confidence FROM pz WHERE r.v <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, section_id, lower(r.v) ORDER BY seq, pos) = 1)
"""
_ALL_RECORDS = "WITH " + _RECORDS + "," + _PROSE_SQL + """,
al AS (SELECT doc_id, section_id, value AS canonical, field, 'table_cell' AS source, 1.0::DOUBLE AS confidence FROM rec UNION ALL SELECT doc_id, section_id, value, '', source, confidence FROM pr),
rc AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY doc_id, section_id, lower(canonical) ORDER BY confidence DESC, field, source, canonical) = 1)
"""
_EMBED_LANGS = ", ".join(f"'{x}'" for x in chunking.EMBED_LANGUAGES)

ORACLE = {
    "page_titles": """SELECT doc_id, 'ok' AS status, CASE WHEN position(' : ' IN t) > 0 THEN substr(t, position(' : ' IN t) + 3) ELSE t END AS title
  FROM (SELECT doc_id, text, trim(regexp_replace(coalesce(title, 'x'), '\\s+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL)""",
    "chunk_widths": f"""
WITH sp AS (SELECT doc_id, max(space) AS space FROM blocks GROUP BY doc_id),
x AS (SELECT s.*, max_chunk_chars, array_to_string(breadcrumb, ' > ') AS crumb, array_to_string(list_filter(coalesce(tags, []), lambda t: t <> section_type), ', ') AS listed FROM {_SECT} s LEFT JOIN sp USING (doc_id) LEFT JOIN pipeline_config c ON c.space = sp.space),
y AS (SELECT *, length(crumb) + CASE WHEN section_type = 'content' THEN 0 ELSE length(section_type) + 3 END + CASE WHEN length(listed) > 0 THEN length(listed) + 6 ELSE 0 END + CASE WHEN genre <> 'general' THEN length(genre) + 10 ELSE 0 END + 224 AS reserve FROM x)
SELECT doc_id, section_id, reserve, greatest(256, least(coalesce(max_chunk_chars, 2000), 1800 - reserve)) AS width FROM y""",
    "embed_headers": f"""
WITH s AS (SELECT *, list_filter(coalesce(entities, []), lambda e: e IS NOT NULL) AS ents, list_filter(coalesce(tags, []), lambda t: t IS NOT NULL) AS tg FROM {_SECT}),
k AS (SELECT *, list_filter(ents, lambda e: NOT list_contains(list_transform(breadcrumb, lambda b: rtrim(lower(trim(b)), ':')), lower(e))) AS k0 FROM s),
u AS (SELECT *, list_filter(k0, lambda e, i: list_position(list_transform(k0, lambda z: lower(z)), lower(e)) = i) AS kw,
  list_filter(tg, lambda t: t <> section_type AND (NOT starts_with(t, 'lang:') OR lower(substr(t, 6)) IN ({_EMBED_LANGS}))) AS tt, array_to_string(breadcrumb, ' > ') AS path FROM k)
SELECT DISTINCT doc_id, section_id, concat_ws(' | ',
  CASE WHEN section_type = 'content' THEN nullif(path, '') WHEN path <> '' THEN '[' || section_type || '] ' || path ELSE '[' || section_type || ']' END,
  CASE WHEN genre <> 'general' THEN 'genre: ' || genre END,
  CASE WHEN len(kw) > 0 THEN 'keywords: ' || array_to_string(kw, ', ') END, CASE WHEN len(tt) > 0 THEN 'tags: ' || array_to_string(tt, ', ') END,
  CASE WHEN len(depends_on) > 0 THEN 'depends on: ' || array_to_string(depends_on, ', ') END, CASE WHEN len(exposes) > 0 THEN 'exposes: ' || array_to_string(exposes, ', ') END) AS header FROM u""",
    "table_summaries": f"""
WITH l AS (SELECT doc_id, block_id, text, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS lines FROM {_B} WHERE content_type = 'table' AND text IS NOT NULL),
a AS (SELECT *, list_position(list_transform(lines, lambda x: regexp_replace(replace(x, '|', ''), '[- :]', '', 'g') = ''), true) AS sep FROM l)
SELECT doc_id, block_id, CASE WHEN sep > 0 THEN array_to_string(lines[1:sep], chr(10)) || chr(10) || '(table, ' || CAST(len(lines) - sep AS VARCHAR) || ' data rows)' ELSE text END AS summary FROM a""",
    "table_records": "WITH " + _RECORDS + "SELECT doc_id, block_id, row_no, col_no, field, value FROM rec",
    "field_frequencies": "WITH " + _FIELDS + "SELECT section_key, field, count(DISTINCT doc_id) AS doc_freq FROM ff GROUP BY GROUPING SETS ((section_key, field), (field))",
    "frequent_fields": "WITH " + _FIELDS + "SELECT field, count(DISTINCT doc_id) AS doc_freq FROM ff GROUP BY field HAVING count(DISTINCT doc_id) >= 2",
    "corpus_taxonomy": "WITH " + _FIELDS + """,
f AS (SELECT section_key, field FROM ff GROUP BY ALL HAVING count(DISTINCT doc_id) >= 2),
v AS (SELECT section_key, orientation, count(DISTINCT (doc_id, section_id, block_id)) AS n FROM ff GROUP BY ALL),
m AS (SELECT section_key, orientation FROM v QUALIFY row_number() OVER (PARTITION BY section_key ORDER BY n DESC, orientation) = 1)
SELECT section_key, string_agg(field, ',' ORDER BY field) AS fields, any_value(orientation) AS orientation FROM f JOIN m USING (section_key) GROUP BY section_key""",
    "prose_records": "WITH " + _PROSE_SQL + "SELECT doc_id, section_id, value, source, confidence FROM pr",
    "reconciled_records": _ALL_RECORDS + "SELECT doc_id, section_id, canonical, field, source, confidence FROM rc",
    "routed_records": _ALL_RECORDS + """
SELECT CASE WHEN confidence < 0.6 THEN 'raw_entities' WHEN field IN ('expose', 'provide', 'publishe', 'offer', 'producer', 'server') THEN 'exposes'
  WHEN field IN ('depend', 'dependency', 'related component', 'consumer', 'consume', 'use', 'direction', 'require', 'upstream', 'subscriber') THEN 'depends_on'
  WHEN field <> '' THEN 'metadata.' || field ELSE 'raw_entities' END AS target, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM rc GROUP BY target""",
    "sections_with_records": _ALL_RECORDS + f", n AS (SELECT doc_id, section_id, count(*) AS n FROM al GROUP BY ALL) SELECT s.doc_id, s.section_id, coalesce(n, 0) AS n_records FROM (SELECT DISTINCT doc_id, section_id FROM {_S}) s LEFT JOIN n USING (doc_id, section_id)",
    "newest_pages": "SELECT doc_id, title, space, author, array_to_string(coalesce(labels, []), ',') AS labels FROM page_meta QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ingested_at DESC) = 1",
    "provenance_upsert": f"SELECT content_type, CASE WHEN space = 'CORVANE' THEN 'new' ELSE 'old' END AS origin, count(*) AS n FROM {_B} WHERE space = 'CORVANE' OR content_type IN ('paragraph', 'list') GROUP BY ALL",
    "delete_document_counts": f"WITH d AS (SELECT DISTINCT doc_id FROM blocks WHERE space = 'MERROW') SELECT count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM d)) AS n_kept, count(*) FILTER (doc_id IN (SELECT doc_id FROM d)) AS n_deleted FROM {_B}",
    "decision_buckets": f"""
WITH s AS (SELECT DISTINCT doc_id || '_' || section_id AS chunk_id, array_to_string(breadcrumb, ' ') AS crumb, section_type FROM {_SECT}),
tok AS (SELECT chunk_id, unnest(regexp_extract_all(lower(crumb), '[\\p{{L}}\\p{{N}}]+')) AS term FROM s),
tf AS (SELECT chunk_id, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT s.chunk_id, coalesce(sum(tf), 0) AS dl FROM s LEFT JOIN tf USING (chunk_id) GROUP BY ALL),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT unnest(['architecture', 'decision', 'security', 'data', 'model', 'overview']) AS term),
sc AS (SELECT chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (chunk_id), st GROUP BY ALL),
x AS (SELECT chunk_id, section_type, score FROM sc JOIN s USING (chunk_id)),
y AS (SELECT *, CASE section_type WHEN 'overview' THEN 'context' WHEN 'architecture' THEN 'context' WHEN 'decision' THEN 'decision' WHEN 'alternative' THEN 'alternatives' WHEN 'tradeoff' THEN 'tradeoffs' WHEN 'consequence' THEN 'consequences' WHEN 'done_criteria' THEN 'done_criteria' END AS bucket,
  CASE section_type WHEN 'architecture' THEN 1 ELSE 0 END AS p FROM x),
k AS (SELECT bucket, chunk_id, score, row_number() OVER (PARTITION BY bucket ORDER BY p, round(score, 9) DESC, chunk_id) AS rank FROM y WHERE bucket IS NOT NULL QUALIFY rank <= 3),
g AS (SELECT 'general' AS bucket, chunk_id, score, row_number() OVER (ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM x WHERE chunk_id NOT IN (SELECT chunk_id FROM k) QUALIFY rank <= 3)
SELECT bucket, rank, chunk_id, round(score, 6) AS score FROM (SELECT bucket, rank, chunk_id, score FROM k UNION ALL SELECT bucket, rank, chunk_id, score FROM g)""",
    "coverage_hard": f"""
WITH e AS (SELECT unnest(['parcel-router', 'Audit Trail', 'no-such-service']) AS entity)
SELECT entity, min(doc_id || '_' || block_id) AS chunk_id FROM e LEFT JOIN {_B} b ON b.content_type = 'paragraph' AND contains(lower(b.text), lower(e.entity)) GROUP BY entity""",
    "token_retention": """
WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]{3,}')) AS a, list_distinct(regexp_extract_all(lower(regexp_replace(coalesce(text, ''), '(?s)```.*?```|~~~.*?~~~', ' ', 'g')), '[a-z0-9]{3,}')) AS b FROM documents)
SELECT doc_id, CASE WHEN len(a) = 0 THEN 1.0 ELSE round(len(list_intersect(a, b)) / len(a), 4) END AS retention,
  array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x)))[1:40], ',') AS dropped FROM d""",
    "graph_edges": f"""
WITH s AS {_SECT}, p AS (SELECT DISTINCT doc_id, space FROM page_meta WHERE space <> ''),
e AS (SELECT DISTINCT doc_id, section_id, unnest(entities) AS x FROM s), d AS (SELECT DISTINCT doc_id, section_id, unnest(depends_on) AS x FROM s), o AS (SELECT DISTINCT doc_id, section_id, unnest(exposes) AS x FROM s)
SELECT 'node' AS part, 'space' AS kind, count(DISTINCT space) AS n FROM p UNION ALL SELECT 'node', 'document', count(DISTINCT doc_id) FROM s UNION ALL SELECT 'node', 'section', count(DISTINCT (doc_id, section_id)) FROM s
UNION ALL SELECT 'node', 'entity', count(DISTINCT lower(x)) FROM (SELECT x FROM e UNION ALL SELECT x FROM d UNION ALL SELECT x FROM o) WHERE x IS NOT NULL AND trim(x) <> ''
UNION ALL SELECT 'edge', 'in_space', count(*) FROM p UNION ALL SELECT 'edge', 'has_section', count(DISTINCT (doc_id, section_id)) FROM s
UNION ALL SELECT 'edge', 'mentions', count(DISTINCT (doc_id, section_id, lower(x))) FROM e WHERE trim(x) <> ''
UNION ALL SELECT 'edge', 'depends_on', nullif(count(DISTINCT (doc_id, section_id, lower(x))), 0) FROM d WHERE trim(x) <> ''
UNION ALL SELECT 'edge', 'exposes', nullif(count(DISTINCT (doc_id, section_id, lower(x))), 0) FROM o WHERE trim(x) <> ''""",
}
ORACLE["graph_edges"] = f"SELECT * FROM ({ORACLE['graph_edges']}) WHERE n IS NOT NULL"
