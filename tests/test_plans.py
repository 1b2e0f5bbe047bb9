"""Plans: columns are pruned and filters pushed to the scan, copies fall away before the shuffle."""

from __future__ import annotations


from quillspark.operators import lint, search
from quillspark.plans import QUERIES
from quillspark.tables import distinct_blocks, spread, table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_pruned_below_the_spread(spark):
    df = table(spark, FOLDER, "blocks").where("content_type = 'table'").select("doc_id")
    text = plan(df)
    assert "ReadSchema: struct<doc_id:string,content_type:string>" in text and "EqualTo(content_type,table)" in text


def test_many_files_are_not_spread(spark, tmp_path):
    spark.range(100).repartition(5).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert spread(rows) is rows and "Exchange" not in plan(spread(rows))


def test_distinct_combines_before_the_shuffle(spark):
    text = plan(distinct_blocks(table(spark, FOLDER, "blocks")).select("doc_id", "block_id"))
    assert text.count("HashAggregate") >= 2


def test_no_cartesian_products(spark):
    for name in ("dense_every_50th", "gate_block_documents", "reconciled_records", "usage_by_day", "section_genres", "breadcrumb_paths"):
        assert "CartesianProduct" not in plan(QUERIES[name](spark, FOLDER)), name


def test_filters_reach_the_scan(spark):
    docs = search.apply_filters(table(spark, FOLDER, "sections").select("doc_id", "genre", "title"), genre="faq")
    assert "EqualTo(genre,faq)" in plan(docs)
    kept, _ = lint.gate(table(spark, FOLDER, "blocks").select("doc_id", "content_type", "text"))
    assert "ingested_at" not in plan(kept)
