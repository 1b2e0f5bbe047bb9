"""Queries over documents, blocks and vectors: lexical, dense and fused search, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import embed, evaluate, search
from quillspark.functions.text import terms
from quillspark.tables import distinct_blocks, table

PHRASE = "retry queue session tokens routing table"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


def _bm25(spark: SparkSession, docs: DataFrame, queries: dict[str, str]) -> DataFrame:
    return search.bm25(docs, "doc_id", F.col("text"), search.query_terms(spark, queries))


def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    best = search.top(_bm25(spark, _docs(spark, folder), {"q": PHRASE}), 10)
    return best.select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def bm25_filtered_lang(spark: SparkSession, folder: str) -> DataFrame:
    docs = search.apply_filters(_docs(spark, folder).withColumnRenamed("lang", "genre"), genre="de")
    best = search.top(_bm25(spark, docs, {"q": "warteschlange sitzungsmarken tagessummen"}), 10)
    return best.select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def bm25_repeated_term(spark: SparkSession, folder: str) -> DataFrame:
    best = search.top(_bm25(spark, _docs(spark, folder), {"one": "queue ledger", "two": "queue queue ledger"}), 5)
    return best.select("query_id", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def idf_table(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    posts = search.postings(docs, "doc_id", F.col("text"))
    rows = search.idf_table(posts, search.corpus_statistics(docs, "doc_id", F.col("text")))
    return rows.select("term", "df", F.round("idf", 6).alias("idf"))


def term_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return search.postings(_docs(spark, folder), "doc_id", F.col("text")).select(F.col("id").alias("doc_id"), "term", "tf")


def doc_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    s = search.corpus_statistics(_docs(spark, folder), "doc_id", F.col("text"))
    return s.select("n_docs", F.round("avg_len", 6).alias("avg_len"))


def _query_vectors(spark: SparkSession, folder: str, n: int = 1) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(F.col("vec_id") < n)
    return rows.select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("qvec"))


def dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    scores = search.dense(table(spark, folder, "embeddings"), "vec_id", "embedding", _query_vectors(spark, folder, 5), 10)
    return search.top(scores, 10).select("query_id", F.col("id").alias("vec_id"), F.round("score", 5).alias("score"))


def dense_filtered_label(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").where("label = 3")
    scores = search.dense(vectors, "vec_id", "embedding", _query_vectors(spark, folder), 5)
    return search.top(scores, 5).select(F.col("id").alias("vec_id"), F.round("score", 5).alias("score"))


def dense_every_50th(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whose id is divisible by 50 as a query against all vectors."""
    vectors = table(spark, folder, "embeddings")
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("qvec"))
    return search.top(search.dense(vectors, "vec_id", "embedding", queries, 10), 10).select("query_id", F.col("id").alias("vec_id"), F.round("score", 5).alias("score"))


def hashing_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rows = search.hashed_buckets(_docs(spark, folder), "doc_id", F.col("text"))
    return rows.select(F.col("id").alias("doc_id"), "bucket", F.round("weight", 6).alias("weight"))


def _hashed(spark: SparkSession, folder: str) -> DataFrame:
    return search.hashed_cosine(_docs(spark, folder), "doc_id", F.col("text"), {"q": PHRASE})


def hashing_cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.top(_hashed(spark, folder), 10).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def _pools(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return search.top(_bm25(spark, _docs(spark, folder), {"q": PHRASE}), 50), search.top(_hashed(spark, folder), 50)


def embedded_norms(spark: SparkSession, folder: str) -> DataFrame:
    """The hashing embedder's vectors: unit length, or zero for texts without a token."""
    rows = embed.embedded(_docs(spark, folder).select("doc_id", "text"), embed.factory("hashing", dimension=256))
    return rows.select("doc_id", F.size("vector").alias("dimension"), F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x), 4).alias("norm"))


def rrf_fuse(spark: SparkSession, folder: str) -> DataFrame:
    return search.fuse(*_pools(spark, folder)).select(F.col("id").alias("doc_id"), F.round("score", 9).alias("score"))


def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    best = search.top(search.fuse(*_pools(spark, folder)), 10).drop("query_id")
    rows = best.join(_docs(spark, folder).select(F.col("doc_id").alias("id"), "lang", "text"), "id")
    return search.result_records(rows, "text", 40).select(F.col("id").alias("doc_id"), F.round("score", 4).alias("score"), "rank", "lang", F.col("text").alias("content"))


def block_search(spark: SparkSession, folder: str) -> DataFrame:
    """BM25 over breadcrumb and content of the paragraphs of one space; statistics of that subset."""
    crumbs = table(spark, folder, "sections").select("doc_id", "section_id", F.array_join("breadcrumb", " ").alias("crumb")).distinct()
    blocks = search.apply_filters(distinct_blocks(table(spark, folder, "blocks")), content_type="paragraph", space="CORVANE")
    corpus = blocks.join(crumbs, ["doc_id", "section_id"], "left").select(
        F.concat_ws("_", "doc_id", "block_id").alias("chunk_id"), F.concat_ws(" ", "crumb", "text").alias("body")
    )
    scores = search.bm25(corpus, "chunk_id", F.col("body"), search.query_terms(spark, {"q": "audit trail daily totals endpoints"}))
    return search.top(scores, 10).select(F.col("id").alias("chunk_id"), F.round("score", 6).alias("score"), "rank")


def _golden(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Queries (query_id, category, terms) and what they expect: documents with the passage's first sentence."""
    items = table(spark, folder, "golden_items").select(F.col("item_id").cast("string").alias("query_id"), "category", "query_text", "passage")
    return items, evaluate.expected_documents(table(spark, folder, "documents"), items)


def _evaluated(spark: SparkSession, folder: str) -> DataFrame:
    items, expected = _golden(spark, folder)
    asked = items.select("query_id", F.explode(terms(F.col("query_text"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))
    ranked = search.top(search.bm25(_docs(spark, folder), "doc_id", F.col("text"), asked), 10)
    return evaluate.query_scores(ranked, expected, items.select("query_id", "category"), (5, 10))


def eval_recall_mrr(spark: SparkSession, folder: str) -> DataFrame:
    rows = _evaluated(spark, folder)
    return rows.select("query_id", "category", F.round("recall_5", 6).alias("recall_5"), F.round("recall_10", 6).alias("recall_10"), F.round("rr", 6).alias("rr"))


def eval_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.macro_average(_evaluated(spark, folder), ("recall_5", "recall_10", "rr"))


QUERIES = {f.__name__: f for f in (
    bm25_topk, bm25_filtered_lang, bm25_repeated_term, idf_table, term_frequencies, doc_length_stats, dense_topk, dense_filtered_label, dense_every_50th,
    hashing_buckets, hashing_cosine_topk, embedded_norms, rrf_fuse, hybrid_topk, block_search, eval_recall_mrr, eval_by_category,
)}

_TF = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, lang FROM documents {where}),
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM docs),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS dl FROM docs d LEFT JOIN tf USING (doc_id) GROUP BY d.doc_id),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
"""


def _tf(where: str = "") -> str:
    return _TF.format(where=where)


def _bm25_sql(values: str, k: int, where: str = "") -> str:
    """SQL of BM25 for (query_id, term, times) rows."""
    return _tf(where) + f""",
q(query_id, term, times) AS (VALUES {values}),
sc AS (SELECT q.query_id, tf.doc_id, sum(q.times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
       FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id), st GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sc)
""".replace("{k}", str(k))


_PHRASE_VALUES = ", ".join(f"('q', '{w}', 1)" for w in PHRASE.split())
_COS = """list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) / (sqrt(list_inner_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])))"""


def _dense_sql(query_where: str, vec_where: str, k: int, cols: str) -> str:
    return f"""
WITH s AS (SELECT CAST(q.vec_id AS VARCHAR) AS query_id, e.vec_id, {_COS} AS score FROM embeddings e, embeddings q WHERE {query_where} AND {vec_where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
SELECT {cols}, round(score, 5) AS score FROM r WHERE rank <= {k}"""


_HASH = """
WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '\\s+')) AS t FROM documents),
b AS (SELECT doc_id, (CAST('0x' || substr(md5(t), 30, 3) AS INTEGER) & 511) AS bucket, count(*) AS n FROM t WHERE t <> '' GROUP BY ALL),
w AS (SELECT doc_id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS weight FROM b),
qt AS (SELECT unnest(string_split('PHRASE', ' ')) AS t),
qb AS (SELECT (CAST('0x' || substr(md5(t), 30, 3) AS INTEGER) & 511) AS bucket, count(*) AS n FROM qt GROUP BY ALL),
qw AS (SELECT bucket, n / sqrt((SELECT sum(n * n) FROM qb)) AS weight FROM qb),
hs AS (SELECT w.doc_id, sum(w.weight * qw.weight) AS score FROM w JOIN qw USING (bucket) GROUP BY ALL),
hr AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM hs)
""".replace("PHRASE", PHRASE)

_FUSED = _bm25_sql(_PHRASE_VALUES, 50) + "," + _HASH.replace("\nWITH ", "\n", 1) + """,
fu AS (SELECT doc_id, sum(1.0 / (60 + rank)) AS score FROM (SELECT doc_id, rank FROM rk WHERE rank <= 50 UNION ALL SELECT doc_id, rank FROM hr WHERE rank <= 50) GROUP BY ALL),
fr AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM fu)
"""

_EVAL = _tf() + """,
it AS (SELECT CAST(item_id AS VARCHAR) AS query_id, category, query_text, passage FROM golden_items),
qt AS (SELECT query_id, unnest(regexp_extract_all(lower(query_text), '[\\p{L}\\p{N}]+')) AS term FROM it),
q AS (SELECT query_id, term, count(*) AS times FROM qt GROUP BY ALL),
sc AS (SELECT q.query_id, tf.doc_id, sum(q.times * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
       FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id), st GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sc),
ex AS (SELECT it.query_id, d.doc_id FROM it JOIN documents d ON contains(d.text, string_split(it.passage, '. ')[1])),
ne AS (SELECT query_id, count(*) AS n_expected FROM ex GROUP BY ALL),
hi AS (SELECT ex.query_id, count(*) FILTER (rank <= 5) AS h5, count(*) FILTER (rank <= 10) AS h10, min(rank) AS first FROM ex JOIN rk USING (query_id, doc_id) WHERE rank <= 10 GROUP BY ALL),
ev AS (SELECT it.query_id, it.category, coalesce(h5, 0) / n_expected AS recall_5, coalesce(h10, 0) / n_expected AS recall_10, coalesce(1.0 / first, 0) AS rr
       FROM it JOIN ne USING (query_id) LEFT JOIN hi USING (query_id))
"""

ORACLE = {
    "bm25_topk": _bm25_sql(_PHRASE_VALUES, 10) + "SELECT doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 10",
    "bm25_filtered_lang": _bm25_sql("('q', 'warteschlange', 1), ('q', 'sitzungsmarken', 1), ('q', 'tagessummen', 1)", 10, "WHERE lang = 'de'") + "SELECT doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 10",
    "bm25_repeated_term": _bm25_sql("('one', 'queue', 1), ('one', 'ledger', 1), ('two', 'queue', 2), ('two', 'ledger', 1)", 5) + "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 5",
    "idf_table": _tf() + "SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM df, st",
    "term_frequencies": _tf() + "SELECT doc_id, term, tf FROM tf",
    "doc_length_stats": _tf() + "SELECT n AS n_docs, round(avgdl, 6) AS avg_len FROM st",
    "dense_topk": _dense_sql("q.vec_id < 5", "true", 10, "query_id, vec_id"),
    "dense_filtered_label": _dense_sql("q.vec_id < 1", "e.label = 3", 5, "vec_id"),
    "dense_every_50th": _dense_sql("q.vec_id % 50 = 0", "true", 10, "query_id, vec_id"),
    "embedded_norms": "SELECT doc_id, 256 AS dimension, CASE WHEN regexp_matches(coalesce(text, ''), '\\S') THEN 1.0 ELSE 0.0 END AS norm FROM documents",
    "hashing_buckets": _HASH + "SELECT doc_id, bucket, round(weight, 6) AS weight FROM w",
    "hashing_cosine_topk": _HASH + "SELECT doc_id, round(score, 6) AS score, rank FROM hr WHERE rank <= 10",
    "rrf_fuse": _FUSED + "SELECT doc_id, round(score, 9) AS score FROM fu",
    "hybrid_topk": _FUSED + "SELECT doc_id, round(score, 4) AS score, rank, d.lang, CASE WHEN length(coalesce(d.text, '')) > 40 THEN substr(d.text, 1, 40) || '...' ELSE coalesce(d.text, '') END AS content FROM fr JOIN documents d USING (doc_id) WHERE rank <= 10",
    "block_search": """
WITH c AS (SELECT DISTINCT doc_id, section_id, array_to_string(breadcrumb, ' ') AS crumb FROM sections),
b AS (SELECT DISTINCT doc_id, section_id, block_id, text FROM blocks WHERE content_type = 'paragraph' AND space = 'CORVANE'),
docs AS (SELECT b.doc_id || '_' || b.block_id AS chunk_id, concat_ws(' ', crumb, text) AS body FROM b LEFT JOIN c USING (doc_id, section_id)),
tok AS (SELECT chunk_id, unnest(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+')) AS term FROM docs),
tf AS (SELECT chunk_id, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT d.chunk_id, coalesce(sum(tf), 0) AS dl FROM docs d LEFT JOIN tf USING (chunk_id) GROUP BY ALL),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT unnest(['audit', 'trail', 'daily', 'totals', 'endpoints']) AS term),
sc AS (SELECT chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
       FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (chunk_id), st GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM sc)
SELECT chunk_id, round(score, 6) AS score, rank FROM rk WHERE rank <= 10""",
    "eval_recall_mrr": _EVAL + "SELECT query_id, category, round(recall_5, 6) AS recall_5, round(recall_10, 6) AS recall_10, round(rr, 6) AS rr FROM ev",
    "eval_by_category": _EVAL + "SELECT coalesce(category, 'ALL') AS category, count(*) AS n_queries, round(avg(recall_5), 6) AS recall_5, round(avg(recall_10), 6) AS recall_10, round(avg(rr), 6) AS rr FROM ev GROUP BY GROUPING SETS ((category), ())",
}
