"""Filling fixed-capacity containers with documents.

Method: length-histogram planning. The driver sees only how many items there are of each
length, at most ``capacity`` rows, and plans best-fit over these counts, longest first. The
plan's slots are numbered by length, and an item takes the slot of its rank within its
length. Ranks are found in two steps, per shard of a length and over the shards' counts, so
a length of a third of all items is spread over many tasks.

Defined results: null and empty texts have no tokens and take no place; a document over the
capacity is cut into full containers and one rest, which is placed like any other item;
copies are items of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.tokens import TOKENIZER, tokenizer
from quillspark.session import checkpointed

#: items of one length that one task ranks, about
SHARD_ITEMS = 200_000


def token_sizes(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of documents with text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = tokenizer(path).count
        for pdf in filter(len, batches):
            yield pdf[["doc_id"]].assign(n_tokens=[count(t) for t in pdf["text"]])

    rows = documents.where(F.col("text").isNotNull() & (F.length("text") > 0)).select("doc_id", "text")
    return rows.mapInPandas(run, f"doc_id {dict(documents.dtypes)['doc_id']}, n_tokens bigint")


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit over counts: rows (size, rank_from, rank_to, first container, items of the size in
    each of these containers) and the number of containers."""
    slots: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first container, containers)
    rooms: list[int] = []
    used = 0

    def put_back(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, n))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0

        def take(first: int, n: int, room: int) -> None:
            """Fill up to ``n`` containers from ``first`` on with as many items as fit in each."""
            nonlocal left, rank
            each = min(room // size, left)
            full = min(n, left // each)
            slots.append((size, rank, rank + full * each, first, each))
            rank, left = rank + full * each, left - full * each
            put_back(room - each * size, first, full)
            if full < n:
                if 0 < left < each:
                    slots.append((size, rank, rank + left, first + full, left))
                    put_back(room - left * size, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                put_back(room, first + full, n - full)

        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
                take(first, n, room)
            else:
                n = -(-left // (capacity // size))
                first, used = used, used + n
                take(first, n, capacity)
    return slots, used


def packed(sizes: DataFrame, capacity: int) -> DataFrame:
    """(container_id, doc_id, piece_no, token_start, token_end, n_tokens) of ``sizes`` (doc_id, n_tokens).

    ``sizes`` is read twice, so hand in a written or checkpointed table.
    """
    spark = sizes.sparkSession
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("n_tokens") - 1, F.lit(capacity).cast("bigint"))
    items = sizes.where("n_tokens > 0").select("doc_id", "n_tokens", F.posexplode(starts).alias("piece", "token_start")).select(
        "doc_id", (F.col("piece") + 1).cast("bigint").alias("piece_no"), "token_start",
        F.least(F.col("token_start") + capacity, F.col("n_tokens")).alias("token_end"),
    ).withColumn("size", F.col("token_end") - F.col("token_start"))

    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    slots, _ = plan(histogram, capacity)
    planned = F.broadcast(spark.createDataFrame(slots, "size bigint, rank_from bigint, rank_to bigint, first bigint, each bigint"))  # a few rows a length

    shards = max(8, -(-sum(histogram.values()) // SHARD_ITEMS))
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(shards)))
    before = Window.partitionBy("size").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = items.groupBy("size", "shard").agg(F.count("*").alias("n")).select("size", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("size", "shard").orderBy("doc_id", "piece_no")
    ranked = items.withColumn("rank", F.row_number().over(inner) - 1).join(offsets, ["size", "shard"]).withColumn("rank", F.col("rank") + F.col("offset"))
    placed = ranked.join(planned, "size").where((F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    container = F.col("first") + F.floor((F.col("rank") - F.col("rank_from")) / F.col("each")).cast("bigint")
    return placed.select(container.alias("container_id"), "doc_id", "piece_no", "token_start", "token_end", F.col("size").alias("n_tokens"))


def packed_by_limits(documents: DataFrame, limits: dict[str, int], path: str = TOKENIZER) -> DataFrame:
    """``packed`` for several capacities by name, in ``limit_name``; texts are measured once."""
    sizes = checkpointed(token_sizes(documents, path))
    parts = [packed(sizes, cap).select(F.lit(name).alias("limit_name"), "*") for name, cap in sorted(limits.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
