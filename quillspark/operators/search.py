"""Lexical, dense and fused search.

The lexical side works on a postings table (id, term, tf, dl): one tokenising pass, then
aggregates. Statistics are those of the corpus that is handed in, so a filter has to be
applied before; that is the meaning of a filtered search, not a matter of speed. Query
terms and one-row statistics are the only broadcast sides. Rankings end with the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config
from quillspark.operators.embed import HashingEmbedder
from quillspark.session import written
from quillspark.functions.text import terms

FILTERS = ("section_type", "content_type", "space", "doc_id", "genre")


def apply_filters(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows that equal every given facet; an empty or missing value filters nothing."""
    for facet, value in wanted.items():
        if facet not in df.columns:
            raise ValueError(f"no facet {facet!r} among {df.columns}")
        if value:
            df = df.where(F.col(facet) == value)
    return df


def postings(corpus: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(id, term, tf) of every document with a term."""
    rows = corpus.select(F.col(id_col).alias("id"), F.explode(terms(text)).alias("term"))
    return rows.groupBy("id", "term").agg(F.count("*").alias("tf"))


def corpus_statistics(corpus: DataFrame, id_col: str, text: Column) -> DataFrame:
    """One row (n_docs, avg_len); documents without terms count."""
    return corpus.select(F.size(terms(text)).cast("bigint").alias("dl")).agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avg_len"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + 0.5) / (df + 0.5))


def idf_table(posts: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, df, idf)."""
    return posts.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(stats)).select("term", "df", idf(F.col("n_docs"), F.col("df")).alias("idf"))


def query_terms(spark: SparkSession, queries: dict[str, str]) -> DataFrame:
    """(query_id, term, times): a term that a query repeats counts as often."""
    rows = spark.createDataFrame(list(queries.items()), "query_id string, query string")
    return rows.select("query_id", F.explode(terms(F.col("query"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))


def bm25(corpus: DataFrame, id_col: str, text: Column, wanted: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(query_id, id, score) of all documents with a score, for all queries at once.

    One pass over the texts keeps, per document, its length (under an empty term) and the counts of the
    wanted terms only; statistics and document frequencies come from the same written rows.
    """
    words = wanted.select("term").union(wanted.sparkSession.createDataFrame([("",)], "term string")).distinct()
    docs = corpus.select(F.col(id_col).alias("id"), terms(text).alias("ts")).withColumn("dl", F.size("ts").cast("bigint"))
    each = docs.select("id", "dl", F.explode(F.concat("ts", F.array(F.lit("")))).alias("term"))
    found = written(each.join(F.broadcast(words), "term").groupBy("id", "term", "dl").agg(F.count("*").alias("tf")))  # the queries' words are a stated, small set
    stats = found.where("term = ''").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avg_len"))
    hits = found.where("term <> ''")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    weights = F.broadcast(wanted.join(df, "term").crossJoin(F.broadcast(stats)))  # a row per query term
    rows = hits.join(weights, "term")
    norm = F.col("tf") + cfg.bm25_k1 * (1 - cfg.bm25_b + cfg.bm25_b * F.col("dl") / F.col("avg_len"))
    part = F.col("times") * idf(F.col("n_docs"), F.col("df")) * F.col("tf") * (cfg.bm25_k1 + 1) / norm
    return rows.groupBy("query_id", "id").agg(F.sum(part).alias("score")).where("score > 0")


def top(scores: DataFrame, k: int, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The best k rows of each query with their rank from 1; ties by id."""
    w = Window.partitionBy(*by).orderBy(F.round("score", 9).desc(), F.col("id"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


#: query vectors that go to the tasks at once; more are taken in further passes over the vectors
QUERY_BLOCK = 4096


def dense(vectors: DataFrame, id_col: str, vec_col: str, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score): for each query (query_id, qvec), a stated set, its k best vectors by cosine of
    each task, among which are the k best of all. A null or zero vector has score 0.

    Queries are taken in blocks of bounded size; a task multiplies its vectors with a block and sends
    only its best rows on, so no pair of rows is ever made.
    """
    n_blocks = -(-queries.count() // QUERY_BLOCK)
    id_type = dict(vectors.dtypes)[id_col]
    block = F.pmod(F.xxhash64("query_id"), F.lit(max(1, n_blocks)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where("v is not null")
    parts = []
    for n in range(n_blocks):
        asked = queries.where(block == n).select("query_id", "qvec").collect()  # about QUERY_BLOCK rows
        parts.append(rows.mapInPandas(_best_of_batches([r["query_id"] for r in asked], [r["qvec"] for r in asked], k), f"query_id string, id {id_type}, score double"))
    if not parts:
        return vectors.sparkSession.createDataFrame([], f"query_id string, id {id_type}, score double")
    return reduce(DataFrame.unionByName, parts)


def _best_of_batches(names: list[str], asked: list, k: int):
    def unit(m: np.ndarray) -> np.ndarray:
        length = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return np.divide(m, length, out=np.zeros_like(m), where=length > 0)

    q = unit(np.asarray(asked, dtype=np.float64).reshape(len(names), -1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, batches):
            scores = np.round(q @ unit(np.stack(pdf["v"].to_list()).astype(np.float64)).T, 12)
            ids = pdf["id"].to_numpy()
            by_id = np.argsort(ids, kind="stable")
            best = by_id[np.argsort(-np.round(scores[:, by_id], 9), axis=1, kind="stable")[:, :k]]
            yield pd.DataFrame({"query_id": np.repeat(names, best.shape[1]), "id": ids[best].ravel(), "score": np.take_along_axis(scores, best, axis=1).ravel()})

    return run


def fuse(*ranked: DataFrame, k: int = DEFAULT.rrf_k) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, id, rank from 1)."""
    rows = ranked[0].select("query_id", "id", "rank")
    for r in ranked[1:]:
        rows = rows.unionByName(r.select("query_id", "id", "rank"))
    return rows.groupBy("query_id", "id").agg(F.sum(F.lit(1.0) / (F.col("rank") + k)).alias("score"))


def hashed_buckets(text_rows: DataFrame, id_col: str, text: Column, dims: int = 512) -> DataFrame:
    """(id, bucket, weight): blank-separated tokens hashed into ``dims`` (a power of two up to 4096), unit length."""
    toks = F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")
    rows = text_rows.select(F.col(id_col).alias("id"), F.explode(toks).alias("t"))
    bucket = F.conv(F.substring(F.md5("t"), 30, 3), 16, 10).cast("int").bitwiseAND(dims - 1)
    counts = rows.groupBy("id", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    norms = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return counts.join(norms, "id").select("id", "bucket", (F.col("n") / F.col("norm")).alias("weight"))


def hashed_cosine(text_rows: DataFrame, id_col: str, text: Column, queries: dict[str, str], dims: int = 512) -> DataFrame:
    """(query_id, id, score) of ``hashed_buckets`` vectors against a few stated queries, for scores over 0.

    The queries are hashed on the driver, so a document's counters need one shuffle, which sums both its length and its products.
    """
    toks = F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")
    rows = text_rows.select(F.col(id_col).alias("id"), F.explode(toks).alias("t"))
    bucket = F.conv(F.substring(F.md5("t"), 30, 3), 16, 10).cast("int").bitwiseAND(dims - 1)
    counts = rows.groupBy("id", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    weights = []
    for qid, asked in queries.items():
        vector = HashingEmbedder(dims).encode([asked])[0]
        own = [F.lit(x) for b in np.flatnonzero(vector) for x in (int(b), float(vector[b]))]
        each = F.coalesce(F.element_at(F.create_map(*own), F.col("bucket")), F.lit(0.0)) if own else F.lit(0.0)
        weights.append((qid, F.sum(F.col("n") * each)))
    sums = counts.groupBy("id").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"), F.array(*[F.struct(F.lit(q).alias("query_id"), w.alias("w")) for q, w in weights]).alias("q"))
    return sums.select("id", "norm", F.inline("q")).where("w > 0").select("query_id", "id", (F.col("w") / F.col("norm")).alias("score"))


def hashed_similarity(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, score) of sparse unit vectors, joined on the bucket; queries are a small stated set."""
    q = F.broadcast(queries.select(F.col("id").alias("query_id"), "bucket", F.col("weight").alias("_q")))
    return docs.join(q, "bucket").groupBy("query_id", "id").agg(F.sum(F.col("weight") * F.col("_q")).alias("score"))


def result_records(results: DataFrame, content: str, snippet: int) -> DataFrame:
    """Scores with four decimals, content cut with an ellipsis."""
    cut = F.when(F.length(content) > snippet, F.concat(F.substring(F.col(content), 1, snippet), F.lit("..."))).otherwise(F.col(content))
    return results.withColumn("score", F.round("score", 4)).withColumn(content, cut)


def route(provenance: dict, cfg: Config = DEFAULT) -> str:
    """'lexical', 'dense' or 'hybrid'; a lexical index is only searched lexically."""
    if cfg.lexical or provenance.get("provider") == "lexical":
        return "lexical"
    return "hybrid" if cfg.hybrid else "dense"


def check_provenance(stored: dict | None, wanted: dict) -> list[str]:
    """Warnings; raises if the index was made by another provider, model or dimension."""
    if not stored:
        return []
    for key in ("provider", "model", "dimension"):
        if stored.get(key) and wanted.get(key) and stored[key] != wanted[key]:
            raise ValueError(f"the index has {key} {stored[key]!r}, the query {wanted[key]!r}")
    if int(stored.get("embed_format", 0)) < int(wanted.get("embed_format", 0)):
        return [f"embed format {stored.get('embed_format')} is older than {wanted.get('embed_format')}; reindex"]
    return []
