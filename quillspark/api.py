"""The commands as functions: index, reindex, search, export, lint, scan, report.

An index is built as one lineage from documents to gated chunks and written once. The one
step that needs all documents first is the vocabulary, if one is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.config import DEFAULT, Config
from quillspark.operators import chunking, classify, embed, inventory, lint, search, store, structure
from quillspark.session import written

HASH_DIMS = 512
#: folders that an export is spread over
EXPORT_BUCKETS = 256


def enriched_sections(documents: DataFrame, cfg: Config = DEFAULT, vocabulary: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, blocks) of documents (doc_id, text, title, space): types, genres, entities, tags and table facts.

    Inventory values of a directional field go to depends_on or exposes, named ones to ``facts``.
    """
    sections, blocks = structure.sections_and_blocks(written(structure.parsed_rows(documents)), documents)
    sections, blocks = written(sections), written(blocks)
    lang = F.lit(cfg.language)
    text = blocks.groupBy("doc_id", "section_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda b: b["text"]), "\n").alias("body"))
    genres = classify.section_genres(blocks, sections.select("doc_id", "section_id", "title"), cfg.language, cfg)
    s = sections.join(genres, ["doc_id", "section_id"]).join(text, ["doc_id", "section_id"], "left")
    kind = classify.section_type(F.col("title"), lang)
    body = F.coalesce("body", F.lit(""))
    seen = blocks.groupBy("doc_id", "section_id").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(f"_{c}") for c in ("xref", "figure")])
    s = s.join(seen, ["doc_id", "section_id"], "left")
    s = s.withColumn("section_type", kind).withColumn("entities", classify.entities(F.concat_ws("\n", "title", body), vocabulary)).withColumn("tags", classify.tags(F.col("section_type"), body, lang)).drop("body")
    none, empty = F.array().cast("array<string>"), F.create_map().cast("map<string,array<string>>")
    if cfg.inventory:
        facts = inventory.table_records(inventory.parsed_tables(blocks)).select("doc_id", "section_id", F.col("value").alias("canonical"), "field", F.lit("table_cell").alias("source"), F.lit(1.0).alias("confidence"), F.col("value").alias("text"), F.struct("block_id", "row_no", "col_no").alias("seq"))
        by_target = inventory.routed_values(inventory.reconcile(facts), cfg)
        wide = by_target.groupBy("doc_id", "section_id").agg(
            F.first(F.when(F.col("target") == "depends_on", F.col("values")), True).alias("depends_on"), F.first(F.when(F.col("target") == "exposes", F.col("values")), True).alias("exposes"),
            F.flatten(F.array_sort(F.collect_list(F.when(F.col("target").startswith("metadata."), F.col("values"))))).alias("facts"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(~F.col("target").isin("depends_on", "exposes"), F.struct(F.regexp_replace("target", r"^metadata\.", "").alias("key"), F.col("values").alias("value")))))).alias("metadata"),
        )
        s = s.join(wide, ["doc_id", "section_id"], "left")
    else:
        s = s.withColumns({c: none for c in ("depends_on", "exposes", "facts")}).withColumn("metadata", empty)
    return s.withColumns({c: F.coalesce(c, none) for c in ("depends_on", "exposes", "facts")}).withColumn("metadata", F.map_concat(F.coalesce("metadata", empty), _captured())).drop("_xref", "_figure"), blocks


def _captured() -> Column:
    """Links and figures of a section as metadata, which is not embedded; what a table names so itself stays."""
    pairs = F.array_compact(F.array(*[F.when((F.size(f"_{c}") > 0) & ~F.map_contains_key(F.coalesce("metadata", F.create_map().cast("map<string,array<string>>")), c), F.struct(F.lit(c).alias("k"), F.col(f"_{c}").alias("v"))) for c in ("xref", "figure")]))
    return F.map_from_entries(pairs)


def chunk_documents(documents: DataFrame, cfg: Config = DEFAULT, vocabulary: list[str] | None = None) -> DataFrame:
    """Chunks with their sections' labels and ``embed_text``, before the gate."""
    sections, blocks = enriched_sections(documents, cfg, vocabulary)
    reserve = chunking.header_reserve(F.array_join("breadcrumb", " > "), F.col("section_type"), F.col("tags"), F.col("genre"), cfg)
    sized = sections.withColumn("width", chunking.width(reserve, cfg=cfg))
    key = blocks.withColumn("doc_id", F.col("doc_id").cast("string"))
    sized = sized.select(F.col("doc_id").cast("string").alias("doc_id"), "section_id", "title", "genre", "width")
    if cfg.profile_routing:
        sized = sized.join(classify.document_profiles(key, classify.document_types(sized, cfg), cfg), "doc_id", "left")
    strategy = classify.merge_strategy(F.col("profile") if cfg.profile_routing else F.lit(None), cfg)
    chunks = chunking.chunks(key, sized.select("doc_id", "section_id", "genre", "width", strategy.alias("s")).select("doc_id", "section_id", "genre", "width", "s.*"), cfg)
    labels = sections.select(F.col("doc_id").cast("string").alias("doc_id"), "section_id", "breadcrumb", "section_type", "genre", "tags", "depends_on", "exposes", "facts", "metadata")
    rows = chunks.join(labels, ["doc_id", "section_id"])
    own = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("title").alias("doc_title"), *[F.col(c) for c in ("space",) if c in documents.columns])
    rows = rows.join(own, "doc_id", "left").withColumn("entities", classify.entities(F.col("content"), vocabulary))
    if cfg.keyphrases:  # prose sections name their key phrases after the entities
        rows = classify.keyphrase_rows(rows, "content", cfg.language, cfg)
        rows = rows.withColumn("entities", chunking.merged_keywords(F.col("entities"), F.col("keyphrases"), F.col("genre"))).drop("keyphrases")
    rows = rows.withColumn("metadata", chunking.scoped_metadata(F.col("metadata"), F.col("content")))
    header = chunking.embed_header(crumb=F.col("breadcrumb"), section_type=F.col("section_type"), genre=F.col("genre"), keywords=F.concat("entities", "facts"), tags=F.col("tags"), depends_on=F.col("depends_on"), exposes=F.col("exposes"))
    body = F.when(F.col("content_type") == "table", chunking.table_summary(F.col("content"))).otherwise(F.col("content"))
    return rows.withColumn("embed_text", F.when(header != "", F.concat(header, F.lit("\n\n"), body)).otherwise(body))


def scan_vocabulary(documents: DataFrame, seeds: list[str] | None = None, cfg: Config = DEFAULT) -> DataFrame:
    return classify.vocabulary(documents, F.col("text"), seeds, cfg)


def build_index(documents: DataFrame, target: store.ChunkStore, cfg: Config = DEFAULT, vocabulary: list[str] | None = None, embedder: embed.Factory | None = None) -> dict:
    """Index documents and return counts; a document with a poisoned chunk is left out as a whole when the gate is on.

    ``embedder`` makes the vectors; without one they are hashed, which needs no model. A lexical index stores none and says so in its provenance.
    """
    chunks = written(chunk_documents(documents, cfg, vocabulary))
    kept, bad = lint.gate(chunks, "content") if cfg.gate else (chunks, None)
    kept = written(kept) if cfg.gate else chunks
    target.upsert(kept)
    if cfg.lexical:
        target.write_provenance("lexical", "none", 1)
    elif embedder is not None:
        made = embedder()
        target.upsert(written(embed.embedded(kept.select("chunk_id", F.col("embed_text").alias("text")), embedder)), "vectors", "chunk_id")
        target.write_provenance(made.provider, made.model, made.dimension)
    else:
        target.upsert(written(search.hashed_buckets(kept, "chunk_id", F.col("embed_text"), HASH_DIMS).withColumnRenamed("id", "chunk_id")), "vectors", "chunk_id")
        target.write_provenance("hashing", "md5", HASH_DIMS)
    return {"chunks": kept.count(), "rejected_documents": bad.count() if bad is not None else 0}


def reindex(documents: DataFrame, target: store.ChunkStore, cfg: Config = DEFAULT, vocabulary: list[str] | None = None) -> dict:
    """The documents' chunks are taken out, then indexed anew, so chunks that are gone leave nothing behind."""
    ids = written(documents.select(F.col("doc_id").cast("string").alias("doc_id")).distinct())
    old = target.read()
    if old is not None:
        target.delete_keys(written(old.join(ids, "doc_id", "left_semi").select("chunk_id")), "vectors")
    deleted = target.delete(ids)
    return build_index(documents, target, cfg, vocabulary) | {"deleted": deleted}


def reindex_stream(changes: DataFrame, target: store.ChunkStore, checkpoint: str, cfg: Config = DEFAULT, vocabulary: list[str] | None = None, once: bool = True) -> StreamingQuery:
    """Reindexes the documents of each batch of a stream (doc_id, text, title, ..); of a document that comes
    several times in one batch the last by ``updated_at`` counts, where the stream has that column."""

    def apply(batch: DataFrame, _: int) -> None:
        rows = store.last_per_key(batch, "doc_id", "updated_at") if "updated_at" in batch.columns else batch.dropDuplicates(["doc_id"])
        if not rows.isEmpty():
            reindex(written(rows), target, cfg, vocabulary)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def query(target: store.ChunkStore, text: str, cfg: Config = DEFAULT, embedder: embed.Factory | None = None, **filters: str | None) -> DataFrame:
    """(rank, score, chunk_id, ...) of the best chunks; filters come first, so statistics are those of what is left."""
    chunks = target.read()
    if chunks is None:
        raise ValueError("the index is empty")
    provenance = target.provenance()
    mode = search.route(provenance, cfg)
    if mode != "lexical":
        search.check_provenance(provenance, embed.identity(embedder()) if embedder else {"provider": "hashing", "model": "md5", "dimension": HASH_DIMS})
    spark = chunks.sparkSession
    corpus = search.apply_filters(chunks, **filters)
    n = cfg.pool if mode == "hybrid" else cfg.n_results
    ranked = []
    if mode != "dense":
        words = corpus.withColumn("_t", F.concat_ws(" ", F.array_join("breadcrumb", " "), "content"))
        ranked.append(search.top(search.bm25(words, "chunk_id", F.col("_t"), search.query_terms(spark, {"q": text}), cfg), n))
    if mode != "lexical" and embedder is not None:
        vectors = target.read("vectors").withColumnRenamed("chunk_id", "id").join(corpus.select(F.col("chunk_id").alias("id")), "id", "left_semi")
        asked = spark.createDataFrame([("q", [float(x) for x in embedder().encode([text])[0]])], "query_id string, qvec array<float>")
        ranked.append(search.top(search.dense(vectors, "id", "vector", asked, n), n))
    elif mode != "lexical":
        asked = search.hashed_buckets(spark.createDataFrame([("q", text)], "qid string, text string"), "qid", F.col("text"), HASH_DIMS)
        vectors = target.read("vectors").withColumnRenamed("chunk_id", "id").join(corpus.select(F.col("chunk_id").alias("id")), "id", "left_semi")
        ranked.append(search.top(search.hashed_similarity(vectors, asked), n))
    best = ranked[0] if len(ranked) == 1 else search.top(search.fuse(*ranked, k=cfg.rrf_k), cfg.n_results)
    return search.result_records(best.join(corpus.withColumnRenamed("chunk_id", "id"), "id"), "content", cfg.snippet_chars).withColumnRenamed("id", "chunk_id").drop("query_id").orderBy("rank")


def export(chunks: DataFrame, folder: str, buckets: int = EXPORT_BUCKETS) -> None:
    """Chunks as JSON lines in ``buckets`` folders by the hash of their document, so a document lies in one
    folder and their number does not grow with the documents."""
    chunks.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))).write.partitionBy("bucket").mode("overwrite").json(folder)


def lint_documents(documents: DataFrame, cfg: Config = DEFAULT, strict: bool = False) -> DataFrame:
    """(doc_id, status, issues): clean or issue; strict calls any block a failure."""
    rows = lint.lint(documents, cfg)
    blocked = F.exists("issues", lambda i: i["severity"] == "block")
    return rows.withColumn("status", F.when(F.size("issues") == 0, "clean").when(blocked & F.lit(strict), "failed").otherwise("issue"))
