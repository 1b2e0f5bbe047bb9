"""The pN_ queries of the problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import distinctive, language, leaks, markup, packing, residue, splitting, term_counts
from quillspark.llm import repeated_lines as lines_op
from quillspark.session import written
from quillspark.tables import distinct_sections, table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return lines_op.repeated_lines(table(spark, folder, "blocks")).select("doc_id", "block_id", "line_no")


def p1_cleaned_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return lines_op.without_repeated_lines(table(spark, folder, "blocks"))


def p1_exact_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The found lines that are repeated without any name in them: their words alone stand in enough pages."""
    blocks = table(spark, folder, "blocks")
    lines = lines_op._lines(blocks).select("doc_id", "block_id", "space", "line_no", F.lower("words").alias("words"))
    pages = blocks.select(F.coalesce("space", F.lit("")).alias("space"), "doc_id").distinct().groupBy("space").agg(F.count("*").alias("n_space"))
    same = lines.select("space", "words", "doc_id").distinct().groupBy("space", "words").agg(F.count("*").alias("n")).join(pages, "space").where("n >= 3 and n >= 0.2 * n_space")
    exact = lines.join(same, ["space", "words"]).select("doc_id", "block_id", "line_no").distinct()
    return p1_found(spark, folder).join(exact, ["doc_id", "block_id", "line_no"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    found = residue.residue_records(table(spark, folder, "sections"), table(spark, folder, "blocks"))
    return found.select("rec_kind", "doc_id", "rec_id")


def p2_kept_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks without those that hold residue or whose section's title is residue."""
    blocks = table(spark, folder, "blocks")
    found = written(residue.residue_records(table(spark, folder, "sections"), blocks))
    bad_sections = found.where("rec_kind = 'section'").select("doc_id", F.col("rec_id").alias("section_id"))
    bad_blocks = found.where("rec_kind = 'block'").select("doc_id", F.col("rec_id").alias("block_id"))
    return blocks.join(bad_sections, ["doc_id", "section_id"], "left_anti").join(bad_blocks, ["doc_id", "block_id"], "left_anti")


def p2_residue_by_kind(spark: SparkSession, folder: str) -> DataFrame:
    found = residue.residue_records(table(spark, folder, "sections"), table(spark, folder, "blocks"))
    return found.groupBy("rec_kind", "residue").agg(F.count("*").alias("n"))


def p2_exact_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The found titles and blocks that are nothing but a well-known placeholder."""
    plain = F.lower(F.trim("text")).isin("todo", "tbd", "lorem ipsum", "untitled", "untitled section", "[tbd]", "[...]", "...", "{{title}}")
    titles = table(spark, folder, "sections").select(F.lit("section").alias("rec_kind"), "doc_id", F.col("section_id").alias("rec_id"), F.col("title").alias("text"))
    texts = table(spark, folder, "blocks").where(F.coalesce(F.col("content_type") != "code", F.lit(True))).select(F.lit("block").alias("rec_kind"), "doc_id", F.col("block_id").alias("rec_id"), "text")
    return p2_found(spark, folder).join(titles.unionByName(texts).where(plain).drop("text").distinct(), ["rec_kind", "doc_id", "rec_id"])


def _section_terms(spark: SparkSession, folder: str, max_n: int | None) -> tuple[DataFrame, int]:
    sections = distinct_sections(table(spark, folder, "sections"), "doc_id", "section_id", "entities", "tags")
    total = table(spark, folder, "sections").select("doc_id", "section_id").distinct().count()
    return term_counts.term_frequencies(sections, ["entities", "tags"], max_n), total


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    freq, total = _section_terms(spark, folder, 1)
    return term_counts.marked(freq, total).where("mark is not null").select("field_name", "term", "mark")


def p3_term_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    freq, total = _section_terms(spark, folder, 1)
    return term_counts.marked(freq, total).drop("n")


def p3_bigram_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    freq, _ = _section_terms(spark, folder, 2)
    return freq.where("n = 2").drop("n")


def p3_ngram_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of values of a record, of every length."""
    freq, _ = _section_terms(spark, folder, None)
    return freq


def _language_rows(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_rows(table(spark, folder, "blocks"), table(spark, folder, "pipeline_config"), table(spark, folder, "documents"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = _language_rows(spark, folder).where((F.col("seg_key") != "") | ~F.coalesce(F.col("label") == F.col("lang_code"), F.lit(False)))
    return rows.select("origin", "rec_id", "seg_key", "lang_code")


def p4_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, document and foreign segment with its language and confidence."""
    return _language_rows(spark, folder).withColumn("conf", F.round("conf", 6))


def p4_document_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a language, by source: each that holds a letter has one of the four."""
    rows = _language_rows(spark, folder).where("origin = 'document' and seg_key = '' and lang_code in ('en', 'de', 'fr', 'it') and conf > 0")
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("rec_id"), "source")
    return rows.join(docs, "rec_id").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("rec_id").alias("n_docs"))


def _page_terms(spark: SparkSession, folder: str, lengths: bool = True) -> DataFrame:
    sections = table(spark, folder, "sections").select("doc_id", "section_id", "entities", "tags")
    return distinctive.word_counts(table(spark, folder, "blocks"), lengths).unionByName(distinctive.value_counts(sections, lengths))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The terms by counts alone, as they are defined; ``p5_term_scores`` scores them with all others."""
    terms = distinctive.bounded_terms(_page_terms(spark, folder, lengths=False), max_pages=3, min_tf={"word": 4, "entity": 2, "tag": 2})
    return terms.select("doc_id", "kind", "term")


def p5_term_scores(spark: SparkSession, folder: str) -> DataFrame:
    terms = distinctive.distinctive_terms(_page_terms(spark, folder))
    return terms.withColumn("score", F.round("score", 9))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.markup_kinds(table(spark, folder, "blocks"), unpaired=True)


def p6_entities(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with HTML that hold a named entity outside code spans."""
    held = F.regexp_replace("text", "`[^`\n]+`", "").rlike("&(?:nbsp|amp|lt|gt|quot|mdash|ndash|hellip);") & F.coalesce(F.col("content_type") != "code", F.lit(True))
    blocks = table(spark, folder, "blocks").where(held).select("doc_id", "block_id").distinct()
    return p6_found(spark, folder).where("markup = 'html'").join(blocks, ["doc_id", "block_id"]).select("doc_id", "block_id")


def p6_markup_ways(spark: SparkSession, folder: str) -> DataFrame:
    """How many blocks hold which kind of markup, by the way it was found."""
    ways = markup.markup_ways(markup.deduced(table(spark, folder, "blocks")))
    return ways.groupBy("markup", "way").agg(F.count("*").alias("n_blocks"))


def p6_clean_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return markup.cleaned_blocks(table(spark, folder, "blocks"))


def p6_template_classes(spark: SparkSession, folder: str) -> DataFrame:
    return markup.template_classes(markup.deduced(table(spark, folder, "blocks")))


def p6_template_slots(spark: SparkSession, folder: str) -> DataFrame:
    blocks = table(spark, folder, "blocks")
    return markup.template_slots(blocks, markup.deduced(blocks))


def _limits(spark: SparkSession, folder: str) -> dict:
    """The size limits by name; the table has one row per limit, three in all."""
    return {r["limit_name"]: r for r in table(spark, folder, "size_limits").collect()}


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    limits = {k: r["max_tokens"] for k, r in _limits(spark, folder).items() if k.startswith("pack_")}
    return packing.packed_by_limits(table(spark, folder, "documents"), limits)


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Containers, items and share of the capacity used, by limit."""
    caps = table(spark, folder, "size_limits").select("limit_name", "max_tokens")
    fill = p7_containers(spark, folder).groupBy("limit_name", "container_id").agg(F.count("*").alias("items"), F.sum("n_tokens").alias("tokens"))
    fill = fill.groupBy("limit_name").agg(F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), F.sum("tokens").alias("n_tokens"), F.max("tokens").alias("largest"))
    return fill.join(F.broadcast(caps), "limit_name").withColumn("fill_share", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("max_tokens")), 6))


def p7_checks(spark: SparkSession, folder: str) -> DataFrame:
    """By limit: documents packed, containers over the capacity, documents whose tokens are not all placed once, documents cut that would fit whole."""
    caps = table(spark, folder, "size_limits").select("limit_name", "max_tokens")
    rows = written(p7_containers(spark, folder).join(F.broadcast(caps), "limit_name"))
    full = rows.groupBy("limit_name", "container_id", "max_tokens").agg(F.sum("n_tokens").alias("n")).groupBy("limit_name").agg(F.count_if(F.col("n") > F.col("max_tokens")).alias("n_over"))
    docs = rows.groupBy("limit_name", "doc_id", "max_tokens").agg(F.sum("n_tokens").alias("n"), F.max("token_end").alias("last"), F.min("token_start").alias("first"), F.count("*").alias("pieces"), F.count_distinct("piece_no").alias("numbers"))
    docs = docs.groupBy("limit_name").agg(
        F.count("*").alias("n_docs"), F.count_if((F.col("n") != F.col("last")) | (F.col("first") != 0) | (F.col("pieces") != F.col("numbers"))).alias("n_broken"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("max_tokens"))).alias("n_cut"),
    )
    return docs.join(full, "limit_name")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked_items(table(spark, folder, "documents"), table(spark, folder, "golden_items")).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    rows = leaks.leaked_items(table(spark, folder, "documents"), table(spark, folder, "golden_items"))
    return rows.withColumns({c: F.round(c, 6) for c in ("share", "special_share", "question_share")})


def p8_whole_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """The leaks that hold the whole passage, word for word: an exact check after the search."""
    def flat(c: str):
        return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))

    docs = table(spark, folder, "documents").select("doc_id", flat("text").alias("t"))
    items = table(spark, folder, "golden_items").select("item_id", flat("passage").alias("p"))
    return p8_found(spark, folder).join(docs, "doc_id").join(items, "item_id").where(F.contains("t", "p")).select("doc_id", "item_id")


def p9_checks(spark: SparkSession, folder: str) -> DataFrame:
    """By source: documents in pieces, and how many are not rebuilt by their pieces, have a piece over the limit or an overlap beyond the stated one."""
    limit = _limits(spark, folder)["piece"]
    pieces = p9_pieces(spark, folder).withColumn("body", F.expr("substring(text, body_start - char_start + 1)"))
    docs = pieces.groupBy("doc_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "body"))), lambda p: p["body"]), "").alias("made"), F.max("n_tokens").alias("largest"), F.max("overlap_tokens").alias("overlap"),
    ).join(table(spark, folder, "documents").select("doc_id", "source", "text"), "doc_id")
    return docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("made") != F.col("text")).alias("n_broken"), F.count_if(F.col("largest") > limit["max_tokens"]).alias("n_over"), F.count_if(F.col("overlap") > limit["overlap_tokens"]).alias("n_overlap"))


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    limit = _limits(spark, folder)["piece"]
    return splitting.split_documents(table(spark, folder, "documents"), limit["max_tokens"], limit["overlap_tokens"])


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_pieces(spark, folder).where("piece_no = 1").select("doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_exact_lines": p1_exact_lines,
    "p1_cleaned_blocks": p1_cleaned_blocks,
    "p2_found": p2_found,
    "p2_exact_texts": p2_exact_texts,
    "p2_kept_blocks": p2_kept_blocks,
    "p2_residue_by_kind": p2_residue_by_kind,
    "p3_found": p3_found,
    "p3_term_frequencies": p3_term_frequencies,
    "p3_bigram_frequencies": p3_bigram_frequencies,
    "p3_ngram_frequencies": p3_ngram_frequencies,
    "p4_found": p4_found,
    "p4_languages": p4_languages,
    "p4_document_counts": p4_document_counts,
    "p5_found": p5_found,
    "p5_term_scores": p5_term_scores,
    "p6_found": p6_found,
    "p6_clean_blocks": p6_clean_blocks,
    "p6_entities": p6_entities,
    "p6_markup_ways": p6_markup_ways,
    "p6_template_classes": p6_template_classes,
    "p6_template_slots": p6_template_slots,
    "p7_containers": p7_containers,
    "p7_fill": p7_fill,
    "p7_checks": p7_checks,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p8_whole_leaks": p8_whole_leaks,
    "p9_checks": p9_checks,
    "p9_found": p9_found,
    "p9_pieces": p9_pieces,
}
