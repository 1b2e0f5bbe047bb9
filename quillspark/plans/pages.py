"""Queries over page metadata, sections and blocks: structure, classification, entities, lint, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.lang_packs import pack
from quillspark.operators import classify, lint, structure
from quillspark.tables import distinct_blocks, table


def _sections(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sections").select("doc_id", "section_id", "seq", "parent_id", "heading_level", "title", "breadcrumb", "section_type", "genre", "entities", "tags", "depends_on", "exposes").distinct()


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_blocks(table(spark, folder, "blocks"))


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source_path", "title")


def doc_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.doc_id(F.col("source_path")).alias("path_id"))


def section_type_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sections(spark, folder).select("doc_id", "section_id", "title")
    return rows.select("doc_id", "section_id", classify.section_type(F.col("title")).alias("section_type"))


def section_type_by_language(spark: SparkSession, folder: str) -> DataFrame:
    """Titles classified by the rules of the language their space is configured with."""
    blocks = table(spark, folder, "blocks").groupBy("doc_id").agg(F.max("space").alias("space"))
    config = table(spark, folder, "pipeline_config").select("space", "config_language")
    rows = _sections(spark, folder).select("doc_id", "section_id", "title").join(blocks, "doc_id", "left").join(config, "space", "left")
    return rows.select("doc_id", "section_id", classify.section_type(F.col("title"), F.col("config_language")).alias("section_type"))


def title_genres(spark: SparkSession, folder: str) -> DataFrame:
    return _sections(spark, folder).select("doc_id", "section_id", classify.title_genre(F.col("title")).alias("genre")).where("genre is not null")


def section_genres(spark: SparkSession, folder: str) -> DataFrame:
    return classify.section_genres(_blocks(spark, folder), _sections(spark, folder))


def policy_modals(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", classify.modal_count(F.col("text")).cast("bigint").alias("n_modals"))
    return rows.withColumn("is_policy", F.col("n_modals") >= 2)


def document_types(spark: SparkSession, folder: str) -> DataFrame:
    return classify.document_types(_sections(spark, folder))


def document_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return classify.document_profiles(_blocks(spark, folder), classify.document_types(_sections(spark, folder)))


def header_normalise(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sections(spark, folder).select("title").where("title is not null").distinct()
    return rows.select("title", T.normalise_header(T.strip_leading_number(F.col("title"))).alias("header"))


def language_normalise(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("lang", T.normalise_language(F.col("lang")).alias("code"))
    return rows.groupBy("lang", "code").agg(F.count("*").alias("n"))


def entities_extracted(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", F.array_join(classify.entities(F.col("text")), ",").alias("entities"))
    return rows.where("entities <> ''")


def entities_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).select(F.explode(classify.endpoints(F.col("text"))).alias("endpoint")).groupBy("endpoint").agg(F.count("*").alias("n"))


def vocabulary_hits(spark: SparkSession, folder: str) -> DataFrame:
    words = ["Retry Queue", "routing table", "Audit", "audit trail"]
    rows = _docs(spark, folder).select(F.explode(classify.vocabulary_hits(F.col("text"), words)).alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("n"))


def vocabulary_scan(spark: SparkSession, folder: str) -> DataFrame:
    return classify.vocabulary(_docs(spark, folder), F.col("text"), seeds=["retry queue", " ledger ", "x"])


def section_tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", F.array_join(classify.tags(F.lit("content"), F.col("text")), ",").alias("tags"))
    return rows.where("tags <> 'content'")


def rake_keyphrases(spark: SparkSession, folder: str) -> DataFrame:
    rows = classify.keyphrase_rows(_blocks(spark, folder).where("content_type = 'paragraph' and text is not null").select("doc_id", "block_id", "text"))
    return rows.select("doc_id", "block_id", F.array_join("keyphrases", "|").alias("keyphrases"))


def markdown_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", *[c.alias(n) for n, c in T.markdown_measures(F.col("text")).items()])


def title_inference(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", T.infer_title(F.col("text"), F.col("source_path")).alias("inferred"))


def link_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_meta").select("doc_id", T.link_hint(F.col("url")).alias("host")).distinct()


def slugs(spark: SparkSession, folder: str) -> DataFrame:
    return _sections(spark, folder).select("title").distinct().where("title is not null").select("title", T.slug(F.col("title")).alias("slug"))


def low_signal(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).where("text is not null").select("doc_id", "block_id", lint.is_low_signal(F.col("text")).alias("low"), T.has_signal(F.col("text")).alias("signal"), T.is_lead_in(F.col("text")).alias("lead_in"))


def lint_html_leakage(spark: SparkSession, folder: str) -> DataFrame:
    rows = _blocks(spark, folder).where("content_type <> 'code' and text is not null")
    return rows.select("doc_id", "block_id", lint.leak_count(F.col("text")).cast("bigint").alias("n_leaks"), lint.leak_severity(F.col("text")).alias("severity")).where("n_leaks > 0")


def lint_macros(spark: SparkSession, folder: str) -> DataFrame:
    rows = _docs(spark, folder).select("doc_id", F.array_join(lint.macro_samples(F.col("text")), ",").alias("samples"))
    return rows.where("samples <> ''")


def lint_content_density(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", lint.substance(F.col("text")).cast("bigint").alias("substance")).withColumn("is_stub", F.col("substance") < 200)


def lint_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).where("text <> ''").select("doc_id", F.round(lint.code_share(F.col("text")), 6).alias("code_share"), F.round(lint.link_share(F.col("text")), 6).alias("link_share"))


def lint_report(spark: SparkSession, folder: str) -> DataFrame:
    """Findings by rule and severity over all documents, all six checks."""
    rows = lint.lint(table(spark, folder, "documents")).select(F.explode("issues").alias("i"))
    return rows.groupBy("i.rule", "i.severity").agg(F.count("*").alias("n"))


def reported_issues(spark: SparkSession, folder: str) -> DataFrame:
    """The stored findings by rule and severity; a finding reported twice counts once."""
    rows = table(spark, folder, "quality_issues").select("chunk_id", "block_id", "rule", "severity").distinct()
    return rows.groupBy("rule", "severity").agg(F.count("*").alias("n"), F.count_distinct("block_id").alias("n_blocks"))


def chunk_residue_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = _blocks(spark, folder).where("content_type <> 'code' and text is not null")
    flags = {n: c for n, c in lint.residue_flags(F.col("text")).items()}
    some = None
    for c in flags.values():
        some = c if some is None else some | c
    return rows.where(some).select("doc_id", "block_id", *[c.alias(n) for n, c in flags.items()])


def gate_block_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that pass the gate with all their blocks, by number of blocks."""
    rows = table(spark, folder, "blocks").select("doc_id", "section_id", "block_id", "seq", "content_type", "text")
    return lint.passing_documents(rows, ["section_id", "block_id", "seq", "content_type"]).withColumnRenamed("n_chunks", "n_blocks")


def gate_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Poisoned, weak and over-long blocks by content type."""
    rows = _blocks(spark, folder)
    text = F.coalesce("text", F.lit(""))
    return rows.groupBy("content_type").agg(
        F.count("*").alias("n"), F.count_if(lint.is_poisoned(F.col("text"), F.col("content_type"))).alias("poisoned"),
        F.count_if(lint.is_low_signal(text)).alias("weak"), F.count_if(lint.budget_severity(F.length(text)).isNotNull()).alias("long"),
    )


def breadcrumb_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Breadcrumbs rebuilt from heading levels and order by windows."""
    rows = structure.breadcrumbs(_sections(spark, folder).select("doc_id", "seq", F.col("heading_level").alias("level"), "title"))
    return rows.select("doc_id", "seq", F.array_join("breadcrumb", " > ").alias("path"))


def breadth_first(spark: SparkSession, folder: str) -> DataFrame:
    """Sections of each page in level order."""
    w = Window.partitionBy("doc_id").orderBy(F.size("breadcrumb"), "seq", "section_id")
    return _sections(spark, folder).select("doc_id", "section_id", F.row_number().over(w).alias("position"))


def section_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = structure.heading_ids(_sections(spark, folder).select("doc_id", "seq", "title", F.col("heading_level").alias("level")))
    return rows.select("doc_id", "seq", "heading_id", "hash_id")


def block_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Hash ids from the running number of the kept blocks of a page."""
    rows = _blocks(spark, folder).where("trim(text) <> ''")
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "block_id")) - 1
    return rows.select("doc_id", "block_id", T.short_hash(F.col("doc_id"), F.col("section_id"), n.cast("string")).alias("made_id"))


def language_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Hash and length of the first 2,000 characters of every page's title, headings and texts."""
    pages = table(spark, folder, "page_meta").groupBy("doc_id").agg(F.max_by("title", "ingested_at").alias("title"))
    sections = _sections(spark, folder).select("doc_id", "section_id", "seq", "title").distinct()
    rows = classify.language_samples(pages, sections, _blocks(spark, folder).select("doc_id", "section_id", "seq", "block_id", "text"))
    return rows.select("doc_id", F.md5("sample").alias("sample_hash"), F.length("sample").alias("n_chars"))


def voted_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by label and by the language that their stop words vote for."""
    rows = _docs(spark, folder).select(T.normalise_language(F.col("lang")).alias("label"), classify.voted_language(F.col("text")).alias("voted"))
    return rows.groupBy("label", "voted").agg(F.count("*").alias("n"))


def block_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return _blocks(spark, folder).groupBy("content_type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def list_spaces(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_meta").select("space").where("space <> ''").distinct().orderBy("space")


def set_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Headings of decisions and of designs: in both, in the first only, in either."""
    s = _sections(spark, folder).where("title is not null")
    a, b = s.where("heading_level = 2").select("title"), s.where("heading_level = 3").select("title")
    return (
        a.intersect(b).withColumn("op", F.lit("both"))
        .unionByName(a.exceptAll(b).distinct().withColumn("op", F.lit("surplus")))
        .unionByName(a.union(b).distinct().withColumn("op", F.lit("either")))
        .groupBy("op").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_set("title")), "|")).alias("titles"))
    )


QUERIES = {f.__name__: f for f in (
    doc_ids, section_type_classify, section_type_by_language, title_genres, section_genres, policy_modals, document_types, document_profiles, header_normalise,
    language_normalise, entities_extracted, entities_endpoint, vocabulary_hits, vocabulary_scan, section_tags, rake_keyphrases, markdown_stats, title_inference,
    link_hosts, slugs, low_signal, lint_html_leakage, lint_macros, lint_content_density, lint_shares, lint_report, reported_issues, chunk_residue_flags,
    gate_block_documents, gate_counts, breadcrumb_paths, breadth_first, section_ids, block_ids, language_samples, voted_languages, block_distribution, list_spaces, set_operations,
)}

# ---- SQL, written apart from the engine's expressions --------------------------------

_S = "(SELECT DISTINCT doc_id, section_id, seq, parent_id, heading_level, title, breadcrumb FROM sections)"
_B = "(SELECT DISTINCT doc_id, section_id, space, seq, block_id, content_type, text, code_language FROM blocks)"
_D = "(SELECT doc_id, coalesce(text, '') AS text, lang, source_path FROM documents)"
_STOP = ", ".join(f"'{w}'" for w in sorted(pack("en").stop_words))


def _type_case(column: str, language: str) -> str:
    from quillspark.functions.lang_packs import SECTION_RULES

    whens = []
    for kind, words in SECTION_RULES[language].items():
        pattern = words.replace("'", "''")
        whens.append(f"WHEN regexp_matches(lower({column}), '(^|[^\\p{{L}}\\p{{N}}_])({pattern})') THEN '{kind}'")
    return "CASE " + " ".join(whens) + " ELSE 'content' END"


def _genre_case(column: str) -> str:
    from quillspark.functions.lang_packs import GENRE_TITLES

    return "CASE " + " ".join(f"WHEN regexp_matches(lower({column}), '(^|[^\\p{{L}}\\p{{N}}_])({w})') THEN '{g}'" for g, w in GENRE_TITLES["en"].items()) + " END"


def _modals(column: str) -> str:
    """Words of duty counted between boundaries; the text is padded so that neighbours may touch."""
    spaced = f"regexp_replace(lower({column}), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g')"
    return f"len(regexp_extract_all(' ' || {spaced} || ' ', '[^\\p{{L}}\\p{{N}}_](must(\\s+not)?|shall(\\s+not)?|may\\s+not|required|prohibited|mandatory|forbidden)[^\\p{{L}}\\p{{N}}_]'))"


_KEY = "regexp_replace(title, '^[\\d.]+\\s*', '')"
_HEADER = """array_to_string(list_transform(string_split(trim(regexp_replace(string_split(regexp_replace(lower({x}), '\\([^)]*\\)', ' ', 'g'), '/')[1], '\\s+', ' ', 'g')), ' '),
  lambda w: CASE WHEN length(w) > 3 AND w LIKE '%s' AND NOT regexp_matches(w, '(ss|us|is|as|os)$') THEN substr(w, 1, length(w) - 1) ELSE w END), ' ')"""
_LEAK = "(?i)<(span|div|p|a|strong|em|table|td|tr|th|u|sup|sub|s|del|code|pre|img)\\b[^>]*>|&(nbsp|amp|lt|gt|quot|#\\d+);"
_MACRO = "(?i)\\{(panel|note|warning|info|tip|code)[^}]*\\}|<ac:[^>]+>|<ri:[^>]+>"
_CODE = "(?s)```.*?```|~~~.*?~~~|`[^`]+`"
_HTML_RES = """(regexp_matches({t}, '(?i)</?(span|div|p|a|strong|em|table|td|tr|th|thead|tbody|ul|ol|li|h[1-6]|blockquote|u|sup|sub|s|del|code|pre|img|hr)\\b')
 OR regexp_matches({t}, '</?(ac|ri|at|fab):[A-Za-z]') OR regexp_matches({t}, '<[A-Za-z][A-Za-z0-9:.-]*\\s+[^<>]*=[^<>]*/?>|</[A-Za-z][A-Za-z0-9:.-]*\\s*>'))"""
_MACRO_RES = "(regexp_matches({t}, '(^|[^0-9A-Za-z_])(ac|ri|at|fab):[A-Za-z][0-9A-Za-z_-]*') OR regexp_matches({t}, '" + _MACRO + "'))"
_ENT_RES = "regexp_matches({t}, '&([A-Za-z][A-Za-z0-9]*|#\\d+|#x[0-9A-Fa-f]+);')"
_B64_RES = "regexp_matches({t}, '[A-Za-z0-9+/]{200,}')"
_ANY_RES = f"({_HTML_RES} OR {_MACRO_RES} OR {_ENT_RES} OR {_B64_RES} OR contains({{t}}, '�'))"
_POISON = f"(trim(coalesce(text, '')) = '' OR (content_type <> 'code' AND {_ANY_RES.replace('{t}', 'stripped')}))"
_STRIPPED = f"(SELECT *, regexp_replace(coalesce(text, ''), '{_CODE}', ' ', 'g') AS stripped FROM {_B})"
_ENTITY_LIST = """list_sort(list_distinct(list_concat(list_concat(
  regexp_extract_all({t}, '\\b[A-Z][a-z]+(?:[A-Z][a-z]+)*(?:Service|Controller|Manager|Handler|Client|Server|Worker|Processor|Repository|Store|Cache|Queue|Bus|Gateway|Proxy|Registry|Resolver|Scheduler|Engine|Provider|Factory|Adapter|Decorator|Facade|Bridge|Middleware|Filter|Interceptor)\\b'),
  list_transform(regexp_extract_all({t}, '(?i)\\b(?:PostgreSQL|MySQL|MariaDB|MongoDB|Redis|Memcached|Elasticsearch|OpenSearch|Kafka|RabbitMQ|Kinesis|Pulsar|DynamoDB|Cassandra|S3|GCS|Azure\\s*Blob|Kubernetes|K8s|Docker|Helm|Terraform|Ansible|Nginx|HAProxy|Envoy|Istio|Linkerd)\\b'), lambda x: replace(x, ' ', ''))), list_concat(
  regexp_extract_all({t}, '\\b(?:REST|gRPC|GraphQL|WebSocket|MQTT|AMQP|STOMP|JWT|OAuth2?|OIDC|SAML|mTLS|TLS|SSL|HTTPS?)\\b'),
  list_transform(regexp_extract_all({t}, '\\b(?:GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS)\\s+/[A-Za-z0-9_/{{}}.:\\-]*'), lambda x: regexp_replace(x, '\\s+', ' ', 'g'))))))"""

ORACLE = {
    "doc_ids": "SELECT doc_id, substr(md5(source_path), 1, 12) AS path_id FROM documents",
    "section_type_classify": f"SELECT doc_id, section_id, {_type_case('title', 'en')} AS section_type FROM {_S}",
    "section_type_by_language": f"""
WITH sp AS (SELECT doc_id, max(space) AS space FROM blocks GROUP BY doc_id)
SELECT s.doc_id, s.section_id, CASE split_part(replace(lower(trim(config_language)), '_', '-'), '-', 1)
  WHEN 'de' THEN {_type_case('title', 'de')} WHEN 'fr' THEN {_type_case('title', 'fr')} WHEN 'it' THEN {_type_case('title', 'it')} ELSE {_type_case('title', 'en')} END AS section_type
FROM {_S} s LEFT JOIN sp USING (doc_id) LEFT JOIN pipeline_config c ON c.space = sp.space""",
    "title_genres": f"SELECT * FROM (SELECT doc_id, section_id, {_genre_case('title')} AS genre FROM {_S}) WHERE genre IS NOT NULL",
    "policy_modals": f"SELECT doc_id, {_modals('text')} AS n_modals, {_modals('text')} >= 2 AS is_policy FROM {_D}",
    "section_genres": f"""
WITH h AS (SELECT doc_id, section_id, block_id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\\s*\\d+\\.\\s+'))) AS n,
  len(list_filter(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\\s*\\d+\\.\\s+')), lambda x: list_contains(string_split('VERBS', ' '), trim(lower(regexp_extract(x, '^\\s*\\d+\\.\\s+(\\S*)', 1)), '.,:;)')))) AS k
  FROM {_B} WHERE content_type = 'list'),
x AS (SELECT b.doc_id, b.section_id, sum(length(text)) AS chars,
  sum(CASE WHEN content_type IN ('paragraph', 'list', 'blockquote', 'definition') THEN length(text) ELSE 0 END) AS prose,
  sum(CASE WHEN content_type = 'definition' THEN length(text) ELSE 0 END) AS defs,
  count(*) FILTER (content_type = 'paragraph' AND trim(text, E' \\n\\t') LIKE '%?') AS questions,
  coalesce(bool_or(h.n >= 2 AND h.k >= 2), false) AS howto,
  sum(CASE WHEN content_type IN ('paragraph', 'list', 'blockquote', 'definition') THEN {_modals('text')} ELSE 0 END) AS modals
  FROM {_B} b LEFT JOIN h USING (doc_id, section_id, block_id) GROUP BY ALL)
SELECT s.doc_id, s.section_id, CASE
  WHEN chars IS NULL OR chars = 0 OR prose / chars < 0.5 THEN coalesce({_genre_case('title')}, 'general')
  WHEN prose > 0 AND defs / prose >= 0.5 THEN 'glossary' WHEN questions >= 2 THEN 'faq' WHEN howto THEN 'howto' WHEN modals >= 2 THEN 'policy'
  ELSE coalesce({_genre_case('title')}, 'narrative') END AS genre
FROM {_S} s LEFT JOIN x USING (doc_id, section_id)""",
    "document_types": f"""
WITH k AS (SELECT doc_id, {_HEADER.format(x=_KEY)} AS key FROM {_S}),
h AS (SELECT doc_id, count(DISTINCT key) FILTER (key IN ('introduction', 'requirement', 'quality attribute', 'baseline solution architecture', 'target solution architecture', 'architecture', 'component', 'data model', 'decision record')) AS n_matches FROM k GROUP BY doc_id)
SELECT doc_id, n_matches, CASE WHEN n_matches >= 3 THEN 'sad' ELSE 'unknown' END AS doc_type FROM h""",
    "header_normalise": f"SELECT title, {_HEADER.format(x=_KEY)} AS header FROM (SELECT DISTINCT title FROM sections WHERE title IS NOT NULL)",
    "language_normalise": "SELECT lang, CASE WHEN c IN ('en', 'de', 'fr', 'it') THEN c ELSE 'en' END AS code, count(*) AS n FROM (SELECT lang, split_part(replace(lower(trim(lang)), '_', '-'), '-', 1) AS c FROM documents) GROUP BY ALL",
    "entities_extracted": f"SELECT * FROM (SELECT doc_id, array_to_string({_ENTITY_LIST.format(t='text')}, ',') AS entities FROM {_D}) WHERE entities <> ''",
    "entities_endpoint": f"SELECT endpoint, count(*) AS n FROM (SELECT unnest(list_transform(regexp_extract_all(text, '\\b(?:GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS)\\s+/[A-Za-z0-9_/{{}}.:\\-]*'), lambda x: regexp_replace(x, '\\s+', ' ', 'g'))) AS endpoint FROM {_B}) GROUP BY ALL",
    "vocabulary_hits": f"""
WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '\\b(?:routing table|audit trail|retry queue|audit)\\b')) AS x FROM {_D})
SELECT CASE x WHEN 'retry queue' THEN 'Retry Queue' WHEN 'audit' THEN 'Audit' ELSE x END AS term, count(*) AS n FROM w GROUP BY ALL""",
    "vocabulary_scan": f"""
WITH d AS (SELECT regexp_replace(text, '(?s)```.*?```|~~~.*?~~~', ' ', 'g') AS t FROM {_D}),
c AS (SELECT unnest(regexp_extract_all(t, '\\b[A-Z][A-Z0-9]{{2,}}\\b')) AS term FROM d),
r AS (SELECT unnest(list_filter({_ENTITY_LIST.format(t='t')}, lambda x: NOT regexp_matches(x, '^[A-Z]+ /'))) AS term FROM d
 UNION ALL SELECT term FROM c WHERE term NOT IN ('HTTP','HTTPS','URL','URI','API','SQL','XML','CSV','JSON','HTML','YAML','PDF','ID','OK','NA','TODO','FIXME','NOTE','NB','FAQ','HR','IT','PM','QA','CI','CD','PR','TBD','WIP','N/A','EOF','EOL','UUID','UTF','TLDR','SELECT','FROM','WHERE','JOIN','INTO','VALUES','UPDATE','INSERT','DELETE','AND','NOT','SET','GROUP')
 UNION ALL SELECT unnest(regexp_extract_all(t, '`([A-Za-z][A-Za-z0-9_./-]{{2,}})`', 1)) FROM d
 UNION ALL SELECT unnest(['retry queue', 'ledger', 'x']))
SELECT DISTINCT term FROM r WHERE length(term) >= 3""",
    "section_tags": f"""
WITH l AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?m)^[ \\t]*(?:>[ \\t]*)*```([0-9A-Za-z_]+)', 1), lambda x: 'lang:' || lower(x)) AS langs,
  list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?im)^\\s*>\\s*(?:\\[!\\s*)?(?:\\*\\*|__)?\\s*(attention|important|caution|warning|danger|info|note|tip)\\b', 1), lambda x: 'admonition:' || lower(x)))) AS adm FROM {_D}),
u AS (SELECT doc_id, list_concat(langs, adm) AS all_tags FROM l),
o AS (SELECT doc_id, list_filter(all_tags, lambda x, i: list_position(all_tags, x) = i) AS t FROM u)
SELECT doc_id, 'content,' || array_to_string(t, ',') AS tags FROM o WHERE len(t) > 0""",
    "rake_keyphrases": f"""
WITH b AS (SELECT doc_id, block_id, text FROM {_B} WHERE content_type = 'paragraph' AND text IS NOT NULL),
l AS (SELECT doc_id, block_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+(?:[._+-][\\p{{L}}\\p{{N}}_]+)*|[^\\p{{L}}\\p{{N}}_]+') AS l FROM b),
t AS (SELECT doc_id, block_id, generate_subscripts(l, 1) AS pos, unnest(l) AS t FROM l),
c AS (SELECT *, regexp_matches(t, '^[\\p{{L}}\\p{{N}}_]') AS word, regexp_matches(t, '^[\\p{{L}}\\p{{N}}_]') AND length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$') AND t NOT IN ({_STOP}) AS content FROM t),
g AS (SELECT *, count(*) FILTER (CASE WHEN word THEN NOT content ELSE regexp_matches(t, '[^\\s\\x{{a0}}\\x{{202f}}]') END) OVER (PARTITION BY doc_id, block_id ORDER BY pos) AS g FROM c),
r AS (SELECT doc_id, block_id, g, (row_number() OVER (PARTITION BY doc_id, block_id, g ORDER BY pos) - 1) // 4 AS sub, pos, t FROM g WHERE content),
p AS (SELECT doc_id, block_id, g, sub, list(t ORDER BY pos) AS ws FROM r GROUP BY ALL), w AS (SELECT doc_id, block_id, unnest(ws) AS t, len(ws) AS n FROM p), s AS (SELECT doc_id, block_id, t, sum(n) / count(*) AS s FROM w GROUP BY ALL),
d AS (SELECT DISTINCT doc_id, block_id, ws FROM p), e AS (SELECT doc_id, block_id, ws, generate_subscripts(ws, 1) AS i, unnest(ws) AS t FROM d),
k AS (SELECT doc_id, block_id, array_to_string(ws, ' ') AS phrase, round(sum(s), 9) AS score FROM e JOIN s USING (doc_id, block_id, t) GROUP BY doc_id, block_id, ws),
o AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, block_id ORDER BY score DESC, phrase) <= 6)
SELECT doc_id, block_id, coalesce(string_agg(phrase, '|' ORDER BY score DESC, phrase), '') AS keyphrases FROM b LEFT JOIN o USING (doc_id, block_id) GROUP BY ALL""",
    "markdown_stats": f"""
SELECT doc_id, len(string_split(text, chr(10))) - 1 AS lines, len(regexp_extract_all(text, '\\S+')) AS words, length(text) AS chars, h AS sections, h AS headings,
  len(regexp_extract_all(text, '!\\[[^\\]]*\\]\\([^)]*\\)')) AS pictures, f AS code_snippets, f AS code_blocks, len(regexp_extract_all(text, '(?m)^[ \\t]*(?:[-*+]|\\d+\\.)[ \\t]+\\S')) AS lists,
  len(list_filter(string_split(text, chr(10)), lambda x: contains(x, '|') AND contains(x, '-') AND regexp_matches(trim(x), '^[|: -]+$'))) AS tables,
  len(list_filter(regexp_extract_all(text, '!?\\[[^\\]]*\\]\\([^)\\s]+'), lambda x: NOT starts_with(x, '!'))) + len(regexp_extract_all(text, '<https?://[^>\\s]+>'))
    + len(regexp_extract_all(text, '(?:^|[^(<0-9A-Za-z_])https?://[^\\s)>\\]]+')) AS urls, len(regexp_extract_all(text, '(?m)^> ')) AS blockquotes
FROM (SELECT *, len(regexp_extract_all(text, '(?m)^#{{1,6}}[ \\t]')) AS h, CAST(floor(len(regexp_extract_all(text, '```')) / 2) AS BIGINT) AS f FROM {_D})""",
    "link_hosts": "SELECT DISTINCT doc_id, CASE WHEN regexp_matches(url, '^[a-zA-Z]+://') THEN regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1), '^www\\.', '') ELSE regexp_extract(url, '^([^?#]*)', 1) END AS host FROM page_meta",
    "slugs": "SELECT title, CASE WHEN s = '' THEN 'x' ELSE s END AS slug FROM (SELECT DISTINCT title, substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40) AS s FROM sections WHERE title IS NOT NULL)",
    "low_signal": f"""SELECT doc_id, block_id, len(regexp_extract_all(text, '[A-Za-z0-9]{{2,}}')) < 3 AS low, regexp_matches(replace(text, '`', ''), '[A-Za-z0-9]') AS signal,
  length(trim(text)) <= 48 AND length(trim(text)) > 0 AND NOT contains(trim(text), chr(10)) AND (trim(text) LIKE '%:' OR regexp_matches(trim(text), '^[\\p{{L}}\\p{{M}}\\p{{N}}_./-]+\\.[A-Za-z0-9]{{1,6}}$')) AS lead_in FROM {_B} WHERE text IS NOT NULL""",
    "lint_html_leakage": f"SELECT * FROM (SELECT doc_id, block_id, n_leaks, CASE WHEN n_leaks > 3 THEN 'block' WHEN n_leaks > 0 THEN 'warn' END AS severity FROM (SELECT *, len(regexp_extract_all(text, '{_LEAK}')) AS n_leaks FROM {_B} WHERE content_type <> 'code' AND text IS NOT NULL)) WHERE n_leaks > 0",
    "lint_macros": f"SELECT * FROM (SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{_MACRO}'), lambda x: substr(x, 1, 24)))), ',') AS samples FROM {_D}) WHERE samples <> ''",
    "lint_content_density": f"SELECT *, substance < 200 AS is_stub FROM (SELECT doc_id, length(trim(regexp_replace(regexp_replace(text, '[#*_`\\[\\]()>|~^\\\\!=+-]', '', 'g'), '\\s+', ' ', 'g'))) AS substance FROM {_D})",
    "lint_shares": f"""SELECT doc_id, round(coalesce(list_sum(list_transform(regexp_extract_all(text, '{_CODE}'), lambda x: length(x))), 0) / length(text), 6) AS code_share,
  round(coalesce(list_sum(list_transform(regexp_extract_all(text, '\\[([^\\]]+)\\]\\([^)]+\\)', 1), lambda x: len(regexp_extract_all(x, '\\S+')))), 0) / len(regexp_extract_all(text, '\\S+')), 6) AS link_share FROM {_D} WHERE text <> ''""",
    "reported_issues": "SELECT rule, severity, count(*) AS n, count(DISTINCT block_id) AS n_blocks FROM (SELECT DISTINCT chunk_id, block_id, rule, severity FROM quality_issues) GROUP BY ALL",
    "chunk_residue_flags": f"SELECT doc_id, block_id, {_HTML_RES.replace('{t}', 'text')} AS html_residue, {_MACRO_RES.replace('{t}', 'text')} AS macro_residue, {_ENT_RES.replace('{t}', 'text')} AS entity_residue, {_B64_RES.replace('{t}', 'text')} AS base64_residue, contains(text, '�') AS replacement_char FROM {_B} WHERE content_type <> 'code' AND text IS NOT NULL AND {_ANY_RES.replace('{t}', 'text')}",
    "gate_block_documents": f"WITH b AS {_STRIPPED} SELECT doc_id, count(*) AS n_blocks FROM b WHERE doc_id NOT IN (SELECT doc_id FROM b WHERE {_POISON}) GROUP BY ALL",
    "gate_counts": f"SELECT content_type, count(*) AS n, count(*) FILTER ({_POISON}) AS poisoned, count(*) FILTER (len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]{{2,}}')) < 3) AS weak, count(*) FILTER (length(text) > 1800) AS long FROM {_STRIPPED} GROUP BY ALL",
    "breadcrumb_paths": f"SELECT doc_id, seq, array_to_string(breadcrumb, ' > ') AS path FROM {_S}",
    "breadth_first": f"SELECT doc_id, section_id, row_number() OVER (PARTITION BY doc_id ORDER BY len(breadcrumb), seq, section_id) AS position FROM {_S}",
    "block_ids": f"SELECT doc_id, block_id, substr(md5(doc_id || '|' || section_id || '|' || CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seq, block_id) - 1 AS VARCHAR)), 1, 8) AS made_id FROM {_B} WHERE trim(text) <> ''",
    "language_samples": f"""
WITH pg AS (SELECT doc_id, max_by(title, ingested_at) AS title FROM page_meta GROUP BY doc_id), se AS (SELECT DISTINCT doc_id, section_id, seq, title FROM sections), o AS (SELECT doc_id, section_id, min(seq) AS pos FROM se GROUP BY ALL),
x AS (SELECT doc_id, 0 AS part, 0 AS a, 0 AS b, '' AS c, title AS t FROM pg UNION ALL SELECT doc_id, 1, seq, 0, section_id, title FROM se
  UNION ALL SELECT doc_id, 2, coalesce(pos, 2147483647), seq, block_id, text FROM {_B} LEFT JOIN o USING (doc_id, section_id))
SELECT doc_id, md5(substr(s, 1, 2000)) AS sample_hash, length(substr(s, 1, 2000)) AS n_chars FROM (SELECT doc_id, string_agg(t, chr(10) ORDER BY part, a, b, c) AS s FROM x WHERE length(t) > 0 GROUP BY doc_id)""",
    "block_distribution": f"SELECT content_type, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM {_B} GROUP BY ALL",
    "list_spaces": "SELECT DISTINCT space FROM page_meta WHERE space <> ''",
    "set_operations": f"""
WITH a AS (SELECT title FROM {_S} WHERE heading_level = 2 AND title IS NOT NULL), b AS (SELECT title FROM {_S} WHERE heading_level = 3 AND title IS NOT NULL),
u AS (SELECT 'both' AS op, title FROM (SELECT title FROM a INTERSECT SELECT title FROM b) UNION ALL SELECT 'surplus', title FROM (SELECT DISTINCT title FROM (SELECT title FROM a EXCEPT ALL SELECT title FROM b))
      UNION ALL SELECT 'either', title FROM (SELECT title FROM a UNION SELECT title FROM b))
SELECT op, count(*) AS n, md5(string_agg(title, '|' ORDER BY title)) AS titles FROM u GROUP BY op""",
}


def _verbs() -> str:
    from quillspark.functions.lang_packs import VERBS

    return VERBS["en"]


ORACLE["title_inference"] = """
WITH t AS (SELECT doc_id, trim(regexp_extract(coalesce(text, ''), '(?m)^#[ \\t]+(.+?)[ \\t]*$', 1)) AS h, regexp_replace(regexp_extract(source_path, '([^/]+?)(?:\\.[^./]*)?$', 1), '[-_]+', ' ', 'g') AS stem FROM documents)
SELECT doc_id, CASE WHEN h <> '' THEN h ELSE array_to_string(list_transform(string_split(stem, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') END AS inferred FROM t"""
ORACLE["section_ids"] = f"""
WITH b AS (SELECT DISTINCT doc_id, section_id, seq, title, heading_level, regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}\\s_-]', '', 'g'), '\\s+', '-', 'g') AS base FROM sections),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY seq) - 1 AS k FROM b)
SELECT doc_id, seq, CASE WHEN k > 0 THEN base || '-' || CAST(k AS VARCHAR) ELSE base END AS heading_id, substr(md5(doc_id || '|' || coalesce(title, '') || '|' || CAST(heading_level AS VARCHAR)), 1, 8) AS hash_id FROM n"""


def _vote_sql() -> str:
    from quillspark.functions.lang_packs import LANGUAGES, STOP_WORDS

    n = ", ".join(f"len(list_filter(w, lambda x: list_contains(string_split('{STOP_WORDS[c]}', ' '), x))) AS n_{c}" for c in LANGUAGES)
    return f"""WITH w AS (SELECT CASE WHEN c IN ('en', 'de', 'fr', 'it') THEN c ELSE 'en' END AS label, w FROM (SELECT split_part(replace(lower(trim(lang)), '_', '-'), '-', 1) AS c, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}]+') AS w FROM documents)),
v AS (SELECT label, {n} FROM w), m AS (SELECT *, greatest(n_en, n_de, n_fr, n_it) AS most FROM v)
SELECT label, CASE WHEN most = 0 THEN 'en' WHEN n_en = most THEN 'en' WHEN n_de = most THEN 'de' WHEN n_fr = most THEN 'fr' ELSE 'it' END AS voted, count(*) AS n FROM m GROUP BY ALL"""


ORACLE["voted_languages"] = _vote_sql()
ORACLE["section_genres"] = ORACLE["section_genres"].replace("VERBS", _verbs())
ORACLE["document_profiles"] = ORACLE["document_types"].rsplit("SELECT doc_id, n_matches", 1)[0] + f""",
b AS (SELECT doc_id, sum(length(text)) AS chars, sum(CASE WHEN content_type = 'code' THEN length(text) ELSE 0 END) AS code, sum(CASE WHEN content_type = 'table' THEN length(text) ELSE 0 END) AS tab FROM {_B} GROUP BY ALL)
SELECT doc_id, CASE WHEN coalesce(chars, 0) = 0 THEN 'mixed' WHEN coalesce(n_matches, 0) >= 3 OR code / chars >= 0.5 OR tab / chars >= 0.4 THEN 'technical'
  WHEN code / chars < 0.05 AND tab / chars < 0.1 THEN 'prose' ELSE 'mixed' END AS profile FROM b LEFT JOIN h USING (doc_id)"""
