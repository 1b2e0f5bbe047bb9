"""Readers for the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: content types whose text is prose
PROSE_TYPES = ("paragraph", "list", "blockquote", "definition")


#: tables whose texts are worth a shuffle where one file would be one task
TEXT_TABLES = ("blocks", "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows


def spread(rows: DataFrame) -> DataFrame:
    """Rows of fewer files than cores, dealt out to all cores. A file of one row group is read by one
    task however many cores there are; a table of many files is left as it is, so a large table never
    takes this shuffle. The files are counted in the driver's file index, their names stay there.
    Column pruning and filters still reach the scan below the exchange."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows._jdf.inputFiles()) < min(cores, 4) else rows


def is_prose(content_type="content_type"):
    return F.col(content_type).isin(*PROSE_TYPES)


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks without re-delivered copies, which differ in ``ingested_at`` only.

    The distinct runs as a partial and a final hash aggregate, so copies fall away
    before the shuffle and a block with many copies makes no hot partition.
    """
    return blocks.select(
        "doc_id", "section_id", "space", "seq", "block_id", "content_type", "text", "code_language"
    ).distinct()


def distinct_sections(sections: DataFrame, *columns: str) -> DataFrame:
    """One row per (doc_id, section_id); exact copies carry equal values."""
    cols = list(columns) or [c for c in sections.columns if c not in ("metadata",)]
    keys = [c for c in ("doc_id", "section_id") if c not in cols]
    return sections.select(*keys, *cols).distinct()
