"""Frequency of every distinct value or n-gram of values.

Method: each task builds a suffix array over the value sequences of its records, by prefix doubling to
the full length of every record, with the common-prefix lengths of neighbouring suffixes. A
common-prefix interval of depth n is one n-gram: its length counts the occurrences, and taking off
the adjacent entries of one record counts the records. The one array gives n-grams of all lengths.
A record lies in one task, so the counts of the tasks simply add up, and a value
in a third of all rows is one row per task before the shuffle.

Defined results: null arrays, null values and blank values hold no term; values are
trimmed, inner blanks collapsed and lower-cased; repeated values of one record count as
occurrences but as one record; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values that one suffix array holds at most; a task with more builds several, whose counts add up
ARRAY_VALUES = 500_000
#: joins the values of an n-gram
GLUE = "␟"


def norm_term(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(value), r"(?U)\s+", " "))


def norm_terms(values: Column) -> Column:
    clean = F.transform(F.coalesce(values, F.array().cast("array<string>")), norm_term)
    return F.filter(clean, lambda t: t.isNotNull() & (t != ""))


def suffix_array(tokens: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the suffixes sorted to the end of their record, and how many values each shares with the one before it.

    A round ranks all suffixes by twice as many values as the last. The ranks of the rounds tell
    the common prefixes: the longest equal powers of two add up to them, from the largest down.
    """
    size = len(tokens)
    if not size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    ends = np.searchsorted(records, records, side="right")  # where each suffix's record ends
    longest = int((ends - np.arange(size)).max())
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1  # 0 is past a record's end
    rounds, width = [rank], 1
    while width < longest:
        at = np.arange(size) + width
        second = np.where(at < ends, rank[np.minimum(at, size - 1)], 0)
        rank = np.unique(rank * (size + 2) + second, return_inverse=True)[1].astype(np.int64) + 1
        rounds.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(size - 1, dtype=np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = (a + (1 << k) <= ends[order[:-1]]) & (b + (1 << k) <= ends[order[1:]])
        same = inside & (rounds[k][np.minimum(a, size - 1)] == rounds[k][np.minimum(b, size - 1)])
        step = same.astype(np.int64) << k
        a, b, lcp = a + step, b + step, lcp + step
    return order, np.concatenate(([0], lcp))


def suffix_counts(tokens: np.ndarray, records: np.ndarray, max_n: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1, 2, .. (to ``max_n``, else to the longest record): the n-grams (rows of token ids), their occurrences and their records.

    ``tokens``: ids of all values in order; ``records``: the record of each, not decreasing.
    """
    size = len(tokens)
    if not size:
        return
    order, lcp = suffix_array(tokens, records)
    length = np.searchsorted(records, records, side="right") - np.arange(size)
    rec = records[order]
    for n in range(1, int(length.max()) + 1 if max_n is None else min(max_n, int(length.max())) + 1):
        begins = lcp < n
        starts = np.flatnonzero(begins)
        interval = np.cumsum(begins) - 1
        occurrences = np.bincount(interval, minlength=len(starts))
        inner = np.lexsort((rec, interval))
        r, i = rec[inner], interval[inner]
        twice = (r[1:] == r[:-1]) & (i[1:] == i[:-1])
        in_records = occurrences - np.bincount(i[1:][twice], minlength=len(starts))
        ok = length[order[starts]] >= n  # shorter suffixes hold no n-gram
        yield tokens[order[starts[ok]][:, None] + np.arange(n)], occurrences[ok], in_records[ok]


def _count_batches(batches: Iterator[pd.DataFrame], max_n: int | None) -> Iterator[pd.DataFrame]:
    def counted(rows: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(rows, ignore_index=True)
        for field, part in pdf.groupby("field_name", sort=False):
            lengths = part["terms"].map(len).to_numpy()
            values = np.concatenate(part["terms"].to_list()) if lengths.sum() else np.array([], dtype=object)
            ids, vocab = pd.factorize(values)
            records = np.repeat(np.arange(len(part)), lengths)
            for grams, n_occ, n_rec in suffix_counts(ids, records, max_n):
                words = vocab[grams]
                yield pd.DataFrame({
                    "field_name": field, "n": grams.shape[1],
                    "term": [GLUE.join(w) for w in words], "n_occurrences": n_occ, "n_records": n_rec,
                })

    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += int(pdf["terms"].map(len).sum())
        if size >= ARRAY_VALUES:
            yield from counted(held)
            held, size = [], 0
    if held:
        yield from counted(held)


def term_frequencies(records: DataFrame, fields: list[str], max_n: int | None = 1) -> DataFrame:
    """(field_name, n, term, n_occurrences, n_records) of every n-gram up to ``max_n`` values, of every length where it is None.

    ``records`` has one row per record; ``fields`` are array columns. The values of an
    n-gram are joined by ``GLUE``.
    """
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), norm_terms(F.col(f)).alias("terms")) for f in fields])
    rows = records.select(F.inline(each)).where(F.size("terms") > 0)
    local = rows.mapInPandas(lambda b: _count_batches(b, max_n), "field_name string, n int, term string, n_occurrences bigint, n_records bigint")
    return local.groupBy("field_name", "n", "term").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_records").alias("n_records"))


def marked(frequencies: DataFrame, n_records: int, rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """Adds ``mark``: 'rare', 'common' or null. 'common' means more than the share of all records."""
    return frequencies.withColumn(
        "mark",
        F.when(F.col("n_records") < rare_below, F.lit("rare")).when(F.col("n_records") > F.lit(common_above) * F.lit(n_records), F.lit("common")),
    )
