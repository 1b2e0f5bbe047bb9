"""Retrieval evaluation as one batch: all queries are ranked, judged and averaged together."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config


def expected_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(query_id, id): documents that hold the first sentence of an item's passage.

    The items are a stated set; their sentences go into one automaton, which reads every document once, so
    the time does not grow with documents times items. Items with an empty sentence expect nothing.
    """
    first = items.select("query_id", F.split("passage", r"\. ")[0].alias("first")).where(F.length("first") > 0).distinct()
    owners: dict[str, list] = {}
    for r in first.collect():
        owners.setdefault(r["first"], []).append(r["query_id"])
    kinds = dict(documents.dtypes)
    schema = f"query_id {dict(items.dtypes)['query_id']}, id {kinds['doc_id']}"
    if not owners:
        return documents.sparkSession.createDataFrame([], schema)
    shared = documents.sparkSession.sparkContext.broadcast(owners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for sentence, ids in shared.value.items():
            automaton.add_word(sentence, ids)
        automaton.make_automaton()
        for pdf in batches:
            rows = [(q, d) for d, text in zip(pdf["doc_id"], pdf["text"]) for q in sorted({q for _, ids in automaton.iter(text) for q in ids})]
            yield pd.DataFrame(rows, columns=["query_id", "id"])

    return documents.where(F.length("text") > 0).select("doc_id", "text").mapInPandas(run, schema)


def matched_sections(results: DataFrame, matchers: DataFrame) -> DataFrame:
    """(query_id, matcher_id, rank): results of the matcher's document whose breadcrumb holds its
    section's words, whatever the case; without a section any result of the document."""
    hit = F.col("section").isNull() | F.contains(F.lower("breadcrumb"), F.lower("section"))
    return results.join(matchers, ["query_id", "doc_id"]).where(hit).groupBy("query_id", "matcher_id").agg(F.min("rank").alias("rank"))


def query_scores(ranked: DataFrame, expected: DataFrame, queries: DataFrame, ks: tuple[int, ...] = (5, 10)) -> DataFrame:
    """(query_id, ..., recall_k..., rr) of every query that expects something; 0 if nothing was found."""
    wanted = expected.groupBy("query_id").agg(F.count("*").alias("n_expected"))
    hits = expected.join(ranked.select("query_id", "id", "rank"), ["query_id", "id"]).groupBy("query_id").agg(
        *[F.count_if(F.col("rank") <= k).alias(f"hit_{k}") for k in ks], F.min("rank").alias("first")
    )
    rows = queries.join(wanted, "query_id").join(hits, "query_id", "left")
    return rows.select(
        *queries.columns, *[(F.coalesce(F.col(f"hit_{k}"), F.lit(0)) / F.col("n_expected")).alias(f"recall_{k}") for k in ks],
        F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("rr"),
    )


def macro_average(scores: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Means over queries, by category and over all (category 'ALL')."""
    means = [F.round(F.avg(m), 6).alias(m) for m in metrics]
    rows = scores.groupingSets([[F.col("category")], []], F.col("category")).agg(F.count("*").alias("n_queries"), *means)
    return rows.withColumn("category", F.coalesce("category", F.lit("ALL")))


def judge(current: dict[str, dict[str, float]], baseline: dict[str, dict[str, float]] | None, metric: str = "recall_10", cfg: Config = DEFAULT, protected: tuple[str, ...] = ("lexical-control",)) -> tuple[bool, list[str]]:
    """(passes, notes): the floor for all, and no drop beyond the noise against the baseline, overall
    and in the protected categories. A missing baseline is only noted."""
    notes, ok = [], True
    now = current.get("ALL", {}).get(metric, 0.0)
    if now < cfg.eval_floor:
        ok = False
        notes.append(f"{metric} {now:.3f} is under the floor {cfg.eval_floor}")
    if baseline is None:
        return ok, [*notes, "no baseline"]
    for name in ("ALL", *protected):
        before, after = baseline.get(name, {}).get(metric), current.get(name, {}).get(metric)
        if before is not None and after is not None and after < before - cfg.eval_noise:
            ok = False
            notes.append(f"{name}: {metric} fell from {before:.3f} to {after:.3f}")
    return ok, notes
