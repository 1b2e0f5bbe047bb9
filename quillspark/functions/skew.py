"""Keys that hold so many rows that their group needs splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: no more keys than this can pass the share below, so the result is safe to collect
MAX_HOT = 64


def hot_keys(df: DataFrame, key: str, least_rows: int = 10_000) -> list:
    """The values of ``key`` that hold more than 1 / MAX_HOT of all rows and ``least_rows`` at least.

    Counts are combined in the tasks before the shuffle. At most MAX_HOT keys can hold such a
    share, so what the driver receives is bounded whatever the data.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = df.count()
    least = max(least_rows, total // MAX_HOT)
    return [r[0] for r in counts.where(F.col("_n") > least).select(key).collect()]
