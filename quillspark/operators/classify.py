"""Section types, genres, document profiles and types, entities, tags, key phrases, vocabulary.

Rule packs become column expressions, so a classification is one projection inside the
scan's stage. Key phrases need counters per text and run in an Arrow UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config
from quillspark.functions.lang_packs import LANGUAGES, pack
from quillspark.functions.text import bounded_words, normalise_header, normalise_language, strip_leading_number
from quillspark.tables import PROSE_TYPES

# ---- Fixed values -------------------------------------------------------------------
SERVICES = r"\b([A-Z][a-z]+(?:[A-Z][a-z]+)*(?:Service|Controller|Manager|Handler|Client|Server|Worker|Processor|Repository|Store|Cache|Queue|Bus|Gateway|Proxy|Registry|Resolver|Scheduler|Engine|Provider|Factory|Adapter|Decorator|Facade|Bridge|Middleware|Filter|Interceptor))\b"
TECHNOLOGIES = r"(?i)\b(PostgreSQL|MySQL|MariaDB|MongoDB|Redis|Memcached|Elasticsearch|OpenSearch|Kafka|RabbitMQ|Kinesis|Pulsar|DynamoDB|Cassandra|S3|GCS|Azure\s*Blob|Kubernetes|K8s|Docker|Helm|Terraform|Ansible|Nginx|HAProxy|Envoy|Istio|Linkerd)\b"
PROTOCOLS = r"\b(REST|gRPC|GraphQL|WebSocket|MQTT|AMQP|STOMP|JWT|OAuth2?|OIDC|SAML|mTLS|TLS|SSL|HTTPS?)\b"
ENDPOINTS = r"\b(?:GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS)\s+/[A-Za-z0-9_/{}.:\-]*"
CAPITALS = r"\b([A-Z][A-Z0-9]{2,})\b"
BACKTICKED = r"`([A-Za-z][A-Za-z0-9_./-]{2,})`"
RAKE_TOKEN = r"(\w+(?:[._+\-]\w+)*)|(\W+)"
CAPS_STOP = "HTTP HTTPS URL URI API SQL XML CSV JSON HTML YAML PDF ID OK NA TODO FIXME NOTE NB FAQ HR IT PM QA CI CD PR TBD WIP N/A EOF EOL UUID UTF TLDR SELECT FROM WHERE JOIN INTO VALUES UPDATE INSERT DELETE AND NOT SET GROUP".split()
SAD_HEADINGS = ["introduction", "requirement", "quality attribute", "baseline solution architecture", "target solution architecture", "architecture", "component", "data model", "decision record"]
# ---- end of fixed values ------------------------------------------------------------


def by_language(language: Column, make) -> Column:
    """One expression per language pack, chosen by the row's language."""
    code = normalise_language(language)
    out = F.when(code == "de", make(pack("de")))
    for c in LANGUAGES:
        if c not in ("de", "en"):
            out = out.when(code == c, make(pack(c)))
    return out.otherwise(make(pack("en")))


def section_type(title: Column, language: Column | None = None) -> Column:
    """The first type with a keyword at a word start of the title, else 'content'."""

    def ladder(p) -> Column:
        out = None
        for kind, words in p.sections.items():
            hit = title.rlike(bounded_words(words))
            out = F.when(hit, kind) if out is None else out.when(hit, kind)
        return out.otherwise("content")

    return F.coalesce(ladder(pack("en")) if language is None else by_language(language, ladder), F.lit("content"))


def title_genre(title: Column, language: Column | None = None) -> Column:
    def ladder(p) -> Column:
        out = None
        for genre, words in p.genres.items():
            hit = title.rlike(bounded_words(words))
            out = F.when(hit, genre) if out is None else out.when(hit, genre)
        return out

    return ladder(pack("en")) if language is None else by_language(language, ladder)


def modal_count(text: Column, language: Column | None = None) -> Column:
    """How many words of strong duty the text has."""

    def count(p) -> Column:
        return F.regexp_count(text, F.lit(rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{p.modals})(?![\p{{L}}\p{{N}}_])"))

    return count(pack("en")) if language is None else by_language(language, count)


def is_howto(text: Column, language: Column | None = None) -> Column:
    """A list of at least two numbered items, at least two of which begin with an instruction."""
    items = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\s*\d+\.\s+"))
    lead = F.transform(items, lambda x: F.regexp_replace(F.lower(F.regexp_extract(x, r"^\s*\d+\.\s+(\S*)", 1)), r"^[.,:;)]+|[.,:;)]+$", ""))

    def enough(p) -> Column:
        verbs = F.array(*[F.lit(v) for v in p.verbs])
        return F.size(F.filter(lead, lambda w: F.array_contains(verbs, w))) >= 2

    return enough(pack("en")) if language is None else by_language(language, enough)


def section_genres(blocks: DataFrame, sections: DataFrame, language: str = "en", cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_id, genre) of every section, also of those without blocks.

    One aggregate over blocks: all counts of a section are conditional sums.
    """
    lang = F.lit(language)
    prose = F.col("content_type").isin(*PROSE_TYPES)
    n = F.length("text")
    shape = blocks.groupBy("doc_id", "section_id").agg(
        F.sum(n).alias("chars"),
        F.sum(F.when(prose, n).otherwise(0)).alias("prose"),
        F.sum(F.when(F.col("content_type") == "definition", n).otherwise(0)).alias("definitions"),
        F.count_if((F.col("content_type") == "paragraph") & F.trim("text").endswith("?")).alias("questions"),
        F.max((F.col("content_type") == "list") & is_howto(F.col("text"), lang)).alias("howto"),
        F.sum(F.when(prose, modal_count(F.col("text"), lang)).otherwise(0)).alias("modals"),
    )
    named = title_genre(F.col("title"), lang)
    no_prose = F.col("chars").isNull() | (F.col("chars") == 0) | (F.col("prose") / F.col("chars") < cfg.genre_prose_share)
    genre = (
        F.when(no_prose, F.coalesce(named, F.lit("general")))
        .when((F.col("prose") > 0) & (F.col("definitions") / F.col("prose") >= cfg.genre_definition_share), "glossary")
        .when(F.col("questions") >= cfg.genre_questions, "faq")
        .when(F.col("howto"), "howto")
        .when(F.col("modals") >= cfg.genre_modals, "policy")
        .otherwise(F.coalesce(named, F.lit("narrative")))
    )
    return sections.select("doc_id", "section_id", "title").join(shape, ["doc_id", "section_id"], "left").select("doc_id", "section_id", genre.alias("genre"))


def document_types(sections: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, n_matches, doc_type): 'sad' with enough distinct template headings."""
    key = normalise_header(strip_leading_number(F.col("title")))
    hits = F.count_distinct(F.when(key.isin(*SAD_HEADINGS), key))
    return sections.groupBy("doc_id").agg(hits.alias("n_matches")).withColumn("doc_type", F.when(F.col("n_matches") >= cfg.fingerprint_matches, "sad").otherwise("unknown"))


def document_profiles(blocks: DataFrame, doc_types: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, profile): technical, prose or mixed, by shares of characters."""
    n = F.length("text")
    sums = blocks.groupBy("doc_id").agg(
        F.sum(n).alias("chars"),
        F.sum(F.when(F.col("content_type") == "code", n).otherwise(0)).alias("code"),
        F.sum(F.when(F.col("content_type") == "table", n).otherwise(0)).alias("tables"),
    )
    code, tables = F.col("code") / F.col("chars"), F.col("tables") / F.col("chars")
    profile = (
        F.when(F.coalesce(F.col("chars"), F.lit(0)) == 0, "mixed")
        .when((F.col("doc_type") == "sad") | (code >= cfg.profile_code_share) | (tables >= cfg.profile_table_share), "technical")
        .when((code < cfg.prose_code_share) & (tables < cfg.prose_table_share), "prose")
        .otherwise("mixed")
    )
    return sums.join(doc_types.select("doc_id", "doc_type"), "doc_id", "left").select("doc_id", profile.alias("profile"))


def merge_strategy(profile: Column, cfg: Config = DEFAULT) -> Column:
    """(merge_prose, merge_definitions): the flags if one is set, else by profile when routing is on:
    technical documents merge definitions with code, prose merges prose, mixed ones nothing."""
    if cfg.merge_prose or cfg.merge_definitions or not cfg.profile_routing:
        return F.struct(F.lit(cfg.merge_prose).alias("merge_prose"), F.lit(cfg.merge_definitions).alias("merge_definitions"))
    profile = F.coalesce(profile, F.lit("mixed"))
    return F.struct((profile == "prose").alias("merge_prose"), (profile == "technical").alias("merge_definitions"))


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), group), F.array().cast("array<string>"))


def services(text: Column) -> Column:
    return _found(text, SERVICES)


def technologies(text: Column) -> Column:
    return F.transform(_found(text, TECHNOLOGIES), lambda t: F.replace(t, F.lit(" "), F.lit("")))


def protocols(text: Column) -> Column:
    return _found(text, PROTOCOLS)


def endpoints(text: Column) -> Column:
    whole = _found(text, ENDPOINTS, 0)
    return F.transform(whole, lambda e: F.regexp_replace(e, r"\s+", " "))


def vocabulary_hits(text: Column, words: list[str]) -> Column:
    """The vocabulary's own spelling of each of its words in the text; longer words win."""
    clean = {w.strip().lower(): w.strip() for w in words if w and w.strip()}
    if not clean:
        return F.array().cast("array<string>")
    ordered = sorted(clean, key=lambda w: (-len(w), w))
    spelling = F.create_map(*[F.lit(x) for kv in clean.items() for x in kv])
    hits = _found(text, bounded_words(ordered, tail=True), 0)
    return F.transform(hits, lambda h: F.coalesce(F.element_at(spelling, F.lower(h)), h))


def vocabulary_rows(rows: DataFrame, words: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, word): the vocabulary's words in each text, for vocabularies of any size.

    ``words``: word. Texts and words are cut into runs of letters and digits; the runs of a text as long
    as some word meet the words in a join, and the text itself decides on what stands between them.
    Of two words that differ in case only, the first counts.
    """
    def runs(c: Column) -> Column:
        return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), 0)

    listed = words.where(F.trim("word") != "").groupBy(F.lower(F.trim("word")).alias("low")).agg(F.min(F.trim("word")).alias("word")).withColumn("gram", F.array_join(runs(F.col("low")), " ")).where("gram <> ''")
    longest = listed.select(F.size(F.split("gram", " ")).alias("n")).distinct()
    sizes = [r["n"] for r in longest.collect()]  # the lengths of the vocabulary's words in runs
    if not sizes:
        return rows.select(*key, F.lit(None).cast("string").alias("word")).limit(0)
    t = runs(F.col(text))

    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(t) - n + 1)), lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))

    grams = F.flatten(F.array(*map(of, sizes)))
    each = rows.where(F.length(text) > 0).select(*key, F.lower(text).alias("_low"), F.explode(F.array_distinct(grams)).alias("gram"))
    return each.join(listed, "gram").where(F.contains("_low", "low")).select(*key, "word").distinct()


def entities(text: Column, words: list[str] | None = None) -> Column:
    """Sorted distinct services, technologies, protocols, endpoints and vocabulary words."""
    parts = [services(text), technologies(text), protocols(text), endpoints(text)]
    if words:
        parts.append(vocabulary_hits(text, words))
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def tags(kind: Column, text: Column, language: Column | None = None) -> Column:
    """The section type, ``lang:x`` of fences and ``admonition:x`` of callouts, each once."""
    fences = F.transform(_found(text, r"(?m)^[ \t]*(?:>[ \t]*)*```(\w+)"), lambda x: F.concat(F.lit("lang:"), F.lower(x)))

    def callouts(p) -> Column:
        names = "|".join(sorted(set(p.callouts), key=lambda w: (-len(w), w)))
        return F.array_sort(F.array_distinct(F.transform(_found(text, rf"(?imu)^\s*>\s*(?:\[!\s*)?(?:\*\*|__)?\s*({names})\b"), lambda x: F.concat(F.lit("admonition:"), F.lower(x)))))

    found = callouts(pack("en")) if language is None else by_language(language, callouts)
    return F.array_distinct(F.concat(F.array(kind), fences, found))


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, r"```[\s\S]*?```|~~~[\s\S]*?~~~", " ")


def raw_terms(text: Column) -> Column:
    """All candidates for a vocabulary: entities without endpoints, capitals, code in backticks."""
    caps = F.filter(_found(text, CAPITALS), lambda t: ~t.isin(*CAPS_STOP))
    return F.concat(services(text), technologies(text), protocols(text), caps, _found(text, BACKTICKED))


def vocabulary(texts: DataFrame, text: Column, seeds: list[str] | None = None, cfg: Config = DEFAULT) -> DataFrame:
    """(term) sorted: every distinct candidate of the corpus and the seeds, of a least length."""
    found = texts.select(F.explode(F.array_distinct(raw_terms(without_fences(text)))).alias("term"))
    if seeds:
        extra = texts.sparkSession.createDataFrame([(s.strip(),) for s in seeds if s and s.strip()], "term string")
        found = found.unionByName(extra)
    return found.where(F.length("term") >= cfg.vocabulary_min_length).distinct().orderBy("term")


# ---- key phrases --------------------------------------------------------------------


def keyphrases(text: str | None, top_n: int = DEFAULT.keyphrases, longest: int = DEFAULT.keyphrase_words, language: str = "en") -> list[str]:
    """RAKE: runs of content words, scored by the degree over the frequency of their words."""
    stop = pack(language).stop_words
    runs: list[tuple[str, ...]] = []
    run: list[str] = []
    for word, other in re.findall(RAKE_TOKEN, text or ""):
        word = word.lower()
        content = bool(word) and not (word in stop or word.isdigit() or len(word) < 3)
        if content:
            run.append(word)
        if run and (len(run) >= longest or (word and not content) or other.strip()):
            runs.append(tuple(run))
            run = []
    if run:
        runs.append(tuple(run))
    stats: dict[str, list[int]] = {}
    for r in runs:
        for w in r:
            s = stats.setdefault(w, [0, 0])
            s[0] += 1
            s[1] += len(r)
    scored = {" ".join(r): round(sum(stats[w][1] / stats[w][0] for w in r), 9) for r in set(runs)}  # the order of a sum decides no tie
    return sorted(scored, key=lambda p: (-scored[p], p))[:top_n]


def keyphrase_rows(rows: DataFrame, text: str = "text", language: str = "en", cfg: Config = DEFAULT) -> DataFrame:
    """The rows with ``keyphrases array<string>``; null and empty texts have none."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", keyphrases array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(keyphrases=[keyphrases(t, cfg.keyphrases, cfg.keyphrase_words, language) for t in pdf[text]])

    return rows.mapInPandas(run, schema)


def language_samples(pages: DataFrame, sections: DataFrame, blocks: DataFrame, longest: int = 2000) -> DataFrame:
    """(doc_id, sample): what a detector reads of a page: its title, its headings and its texts, one a line, cut at ``longest``
    characters. ``pages``: doc_id, title; ``sections``: doc_id, section_id, seq, title; ``blocks``: doc_id, section_id, seq, block_id, text.
    Nulls and empty texts are left out; a page of nothing else has no sample. Only what can lie in the sample is collected.
    """
    order = sections.groupBy("doc_id", "section_id").agg(F.min("seq").alias("at"))
    texts = blocks.join(order, ["doc_id", "section_id"], "left")
    none = F.lit("")
    parts = (
        pages.select("doc_id", F.lit(0).alias("part"), F.lit(0).alias("a"), F.lit(0).alias("b"), none.alias("c"), F.col("title").alias("t"))
        .unionByName(sections.select("doc_id", F.lit(1).alias("part"), F.col("seq").cast("int").alias("a"), F.lit(0).alias("b"), F.col("section_id").alias("c"), F.col("title").alias("t")))
        .unionByName(texts.select("doc_id", F.lit(2).alias("part"), F.coalesce(F.col("at").cast("int"), F.lit(2**31 - 1)).alias("a"), F.col("seq").cast("int").alias("b"), F.col("block_id").alias("c"), F.substring("text", 1, longest).alias("t")))
        .where(F.length("t") > 0)
    )
    before = Window.partitionBy("doc_id").orderBy("part", "a", "b", "c").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_n", F.coalesce(F.sum(F.length("t") + 1).over(before), F.lit(0))).where(F.col("_n") <= longest)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "a", "b", "c", "t"))), lambda x: x["t"]), "\n")
    return parts.groupBy("doc_id").agg(F.substring(joined, 1, longest).alias("sample"))


def voted_language(text: Column, default: str = "en") -> Column:
    """The language with the most stop words in the text, the default without any; an extension of the default path.

    Ties go to the first language in the list.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}]+"), 0)

    def count(code: str) -> Column:
        stop = sorted(pack(code).stop_words)
        return F.size(F.filter(words, lambda w: w.isin(*stop)))

    votes = {c: count(c) for c in LANGUAGES}
    most = F.greatest(*votes.values())
    out = F.when(most == 0, default)
    for c, n in votes.items():
        out = out.when(n == most, c)
    return out
