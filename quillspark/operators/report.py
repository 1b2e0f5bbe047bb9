"""Loss reports and the relationship graph, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import token_set

SAMPLE = 40
#: nodes of one kind that a drawing shows
NODE_LIMIT = 71
# How bad the loss of a construct is.
LOSS_TIERS = {"silent": ["dropped_tag", "unknown_macro", "dropped_attachment"], "degraded": ["panel", "expand", "status", "layout", "mention", "emoticon", "task_list", "diagram"], "noise": ["toc", "anchor", "breadcrumb", "navigation"]}


def retention(rows: DataFrame) -> DataFrame:
    """(doc_id, retention, dropped) of rows (doc_id, before, after): the share of distinct tokens kept,
    1 for an empty source, and the first dropped tokens in order."""
    a, b = token_set(F.col("before")), token_set(F.col("after"))
    share = F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.round(F.size(F.array_intersect(a, b)) / F.size(a), 4))
    return rows.select("doc_id", share.alias("retention"), F.array_join(F.slice(F.array_sort(F.array_except(a, b)), 1, SAMPLE), ",").alias("dropped"))


def loss_tier(construct: Column) -> Column:
    out = None
    for tier, names in LOSS_TIERS.items():
        hit = construct.isin(*names)
        out = F.when(hit, tier) if out is None else out.when(hit, tier)
    return out.otherwise("silent")


def conversion_totals(results: DataFrame) -> DataFrame:
    """One row of sums over results (status, n_headings, n_tables, n_links, n_images, n_code, n_chars)."""
    sums = [F.sum(c).alias(c) for c in results.columns if c.startswith("n_")]
    return results.agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "rejected").alias("rejected"), F.count_if(F.col("status") == "error").alias("error"), *sums)


def macro_totals(results: DataFrame, counts: str = "macro_counts") -> DataFrame:
    return results.select(F.explode(counts).alias("construct", "n")).groupBy("construct").agg(F.sum("n").alias("n")).withColumn("tier", loss_tier(F.col("construct")))


def graph(sections: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): spaces, documents, sections and entities; in_space, has_section, mentions, depends_on, exposes.

    Entities are one node whatever their case.
    """
    in_space = pages.where("space <> ''").select(F.col("doc_id").alias("src"), F.col("space").alias("dst")).distinct()
    key = F.concat_ws("#", "doc_id", "section_id").alias("section")
    has = sections.select(F.col("doc_id").alias("src"), key).distinct().withColumnRenamed("section", "dst")

    def to_entities(column: str) -> DataFrame:
        rows = sections.select(key, F.explode(column).alias("x")).where(F.trim("x") != "")
        return rows.select(F.col("section").alias("src"), F.lower("x").alias("dst")).distinct()

    links = {"mentions": to_entities("entities"), "depends_on": to_entities("depends_on"), "exposes": to_entities("exposes")}
    edges = in_space.withColumn("kind", F.lit("in_space")).unionByName(has.withColumn("kind", F.lit("has_section")))
    nodes = (
        in_space.select(F.col("dst").alias("id")).distinct().withColumn("kind", F.lit("space"))
        .unionByName(sections.select(F.col("doc_id").alias("id")).distinct().withColumn("kind", F.lit("document")))
        .unionByName(has.select(F.col("dst").alias("id")).withColumn("kind", F.lit("section")))
    )
    found = None
    for kind, e in links.items():
        edges = edges.unionByName(e.withColumn("kind", F.lit(kind)))
        found = e.select("dst") if found is None else found.unionByName(e.select("dst"))
    return nodes.unionByName(found.select(F.col("dst").alias("id")).distinct().withColumn("kind", F.lit("entity"))), edges


def shown_nodes(nodes: DataFrame, limit: int = NODE_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(the first nodes of each kind by id, how many of each kind are left out)."""
    w = Window.partitionBy("kind").orderBy("id")
    ranked = nodes.withColumn("_n", F.row_number().over(w))
    return ranked.where(F.col("_n") <= limit).drop("_n"), ranked.groupBy("kind").agg(F.greatest(F.lit(0), F.max("_n") - limit).alias("n_left_out"))


def with_paths(results: DataFrame, manifest: DataFrame) -> DataFrame:
    """``results`` (doc_id, ..) with the ``path`` that the manifest (doc_id, path) names; ``?`` where it names none."""
    paths = manifest.groupBy("doc_id").agg(F.min("path").alias("path"))
    return results.join(paths, "doc_id", "left").withColumn("path", F.coalesce("path", F.lit("?")))


def section_by_breadcrumb(rows: DataFrame, sections: DataFrame) -> DataFrame:
    """``rows`` (doc_id, breadcrumb, ..) with the section_id of their breadcrumb; of sections with one breadcrumb the last counts."""
    last = sections.groupBy("doc_id", "breadcrumb").agg(F.max_by("section_id", F.struct("seq", "section_id")).alias("section_id"))
    return rows.join(last, ["doc_id", "breadcrumb"], "left")


def with_titles(rows: DataFrame, sections: DataFrame) -> DataFrame:
    """``rows`` (doc_id, section_id, ..) with their section's ``title``; the id where there is none."""
    titles = sections.groupBy("doc_id", "section_id").agg(F.min("title").alias("title"))
    return rows.join(titles, ["doc_id", "section_id"], "left").withColumn("title", F.coalesce(F.when(F.col("title") != "", F.col("title")), F.col("section_id")))


def status_totals(rows: DataFrame) -> DataFrame:
    """(status, n): how many files were ok or failed."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def html_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, html): each row of a report as a table row, its values escaped; nulls are empty cells."""
    def cell(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(mark), F.lit(name))
        return F.concat(F.lit("<td>"), text, F.lit("</td>"))

    return rows.select(key, F.concat(F.lit("<tr>"), *[cell(c) for c in rows.columns], F.lit("</tr>")).alias("html"))


def html_page(rows: DataFrame, key: str, title: str) -> DataFrame:
    """(at, html): the lines of a report's page in order, to be written as text; rows come by key."""
    head = "".join(f"<th>{c}</th>" for c in rows.columns)
    frame = rows.sparkSession.createDataFrame([(0, f"<!DOCTYPE html><html><head><title>{title}</title></head><body><table><tr>{head}</tr>"), (2, "</table></body></html>")], "at int, html string")
    body = html_rows(rows, key).select(F.lit(1).alias("at"), F.col(key).cast("string").alias("k"), "html")
    return frame.select("at", F.lit("").alias("k"), "html").unionByName(body).orderBy("at", "k", "html").select("at", "html")
