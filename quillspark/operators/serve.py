"""Serving functions over a corpus of chunks: decision context and coverage."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config

# ---- Fixed values -------------------------------------------------------------------
BUCKETS = {
    "context": ("overview", "architecture"), "decision": ("decision",), "alternatives": ("alternative",),
    "tradeoffs": ("tradeoff",), "consequences": ("consequence",), "done_criteria": ("done_criteria",),
}
SECTION_HINTS = [
    ("database datastore persistence schema sql table", ("data_model",)),
    ("integration kafka topic queue event message broker", ("architecture",)),
    ("service microservice component module api endpoint", ("architecture", "api")),
    ("security auth encryption tls secret credential", ("security",)),
    ("deploy infrastructure kubernetes container runtime", ("deployment",)),
]
SECTION_TYPES = "decision alternative tradeoff consequence done_criteria security data_model overview architecture api deployment content".split()
GENRES = "general narrative glossary faq howto policy".split()
# ---- end of fixed values ------------------------------------------------------------


def checked(value: str | None, allowed: list[str], what: str) -> str | None:
    if value and value not in allowed:
        raise ValueError(f"unknown {what} {value!r}; one of {', '.join(allowed)}")
    return value


def decision_buckets(scored: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(bucket, rank, chunk_id, score) of scored chunks (chunk_id, section_type, score).

    Each bucket takes the best of its types in their order, so architecture only fills what
    overview leaves. 'general' takes the best of all chunks that no bucket has taken.
    """
    order = [(bucket, kind, i) for bucket, kinds in BUCKETS.items() for i, kind in enumerate(kinds)]
    place = F.create_map(*[F.lit(x) for bucket, kind, i in order for x in (kind, i)])
    owner = F.create_map(*[F.lit(x) for bucket, kind, i in order for x in (kind, bucket)])
    rows = scored.withColumn("bucket", F.element_at(owner, F.col("section_type"))).withColumn("_p", F.element_at(place, F.col("section_type")))
    w = Window.partitionBy("bucket").orderBy("_p", F.round("score", 9).desc(), "chunk_id")
    taken = rows.where("bucket is not null").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cfg.bucket_size)
    rest = scored.join(taken.select("chunk_id"), "chunk_id", "left_anti").orderBy(F.round("score", 9).desc(), "chunk_id").limit(cfg.bucket_size)
    g = Window.orderBy(F.round("score", 9).desc(), "chunk_id")  # over bucket_size rows
    rest = rest.withColumn("rank", F.row_number().over(g)).withColumn("bucket", F.lit("general"))
    return taken.select("bucket", "rank", "chunk_id", "score").unionByName(rest.select("bucket", "rank", "chunk_id", "score"))


def expected_sections(decision: str) -> tuple[str, ...]:
    """The section types that should record a decision; none means any."""
    words = set(re.findall("[a-z]+", decision.lower()))
    return next((kinds for hint, kinds in SECTION_HINTS if words & set(hint.split())), ())


def hard_coverage(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, chunk_id): the first chunk, by id, that holds each entity, whatever the case; null if none.

    The entities are those of one decision, a few words, and are broadcast.
    """
    hits = chunks.select("chunk_id", F.lower("content").alias("c")).join(F.broadcast(entities), F.contains(F.col("c"), F.lower("entity")))
    first = hits.groupBy("entity").agg(F.min("chunk_id").alias("chunk_id"))
    return entities.join(first, "entity", "left")


def coverage(entities_found: DataFrame, soft: DataFrame, has_sad: bool, cfg: Config = DEFAULT) -> dict:
    """{'covered', 'tier'}: hard if every entity was found, else soft by the best score; none without documents."""
    if not has_sad:
        return {"covered": False, "tier": "none"}
    n, missing = entities_found.agg(F.count("*"), F.count_if(F.col("chunk_id").isNull())).first()
    if n and not missing:
        return {"covered": True, "tier": "hard"}
    best = soft.agg(F.max("score")).first()[0]
    return {"covered": best is not None and best >= cfg.coverage_score, "tier": "soft"}
