"""Facts from tables and prose, their routing, and the taxonomy of table fields.

A table is parsed by splitting its lines; everything is arrays and one explode, so the
records of a corpus need no Python. Records are keyed by (doc_id, section_id), since
section ids repeat between documents.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config
from quillspark.functions.text import is_placeholder_cell, is_separator_row, normalise_header, split_pipe_row, strip_leading_number

# ---- Fixed values -------------------------------------------------------------------
FIELD_HEADERS = ["field", "key", "name", "property", "parameter", "setting", "attribute", "option"]
VALUE_HEADERS = ["value", "values", "description", "detail", "details"]
PROSE_CAPS_STOP = ["TODO", "NOTE", "FIXME", "WARNING", "INFO", "TIP", "OK", "ID", "URL", "API", "N/A"]
DIRECTIONS = {
    "exposes": ["exposes", "provides", "publishes", "offers", "producer", "server"],
    "depends_on": ["depends", "dependency", "related components", "consumer", "consumes", "uses", "direction", "requires", "upstream", "subscriber"],
}
# ---- end of fixed values ------------------------------------------------------------


def parsed_tables(blocks: DataFrame) -> DataFrame:
    """Table blocks with ``header`` (normalised, empty without a separator in line two) and ``body`` rows."""
    rows = F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), lambda x: split_pipe_row(x))
    t = blocks.where("content_type = 'table' and text is not null").withColumn("_rows", rows)
    has_head = (F.size("_rows") >= 2) & F.coalesce(is_separator_row(F.element_at("_rows", 2)), F.lit(False))
    t = t.withColumn("_has", has_head)
    header = F.when(F.col("_has"), F.transform(F.element_at("_rows", 1), lambda c: normalise_header(c))).otherwise(F.array().cast("array<string>"))
    body = F.filter(F.when(F.col("_has"), F.slice("_rows", 3, F.size("_rows"))).otherwise(F.col("_rows")), lambda r: ~is_separator_row(r))
    return t.withColumn("header", header).withColumn("body", body).drop("_rows", "_has")


def _any_header() -> Column:
    return F.exists("header", lambda h: h != "")


def fields_and_orientation(tables: DataFrame) -> DataFrame:
    """Adds ``fields`` (distinct, in order) and ``orientation`` ('wide' or 'key_value')."""
    wide = F.filter("header", lambda h: h != "")
    first = F.filter(F.transform(F.filter("body", lambda r: (F.size(r) > 0) & ~is_placeholder_cell(r[0])), lambda r: normalise_header(r[0])), lambda f: f != "")
    return tables.withColumn("fields", F.array_distinct(F.when(_any_header(), wide).otherwise(first))).withColumn(
        "orientation", F.when(_any_header(), "wide").otherwise("key_value")
    )


def table_records(tables: DataFrame) -> DataFrame:
    """(doc_id, section_id, block_id, row_no, col_no, field, value): one per filled cell.

    A header of a field and a value column means key-value; cells beyond the header and
    placeholders are dropped.
    """
    generic = (F.size("header") == 2) & F.element_at("header", 1).isin(*FIELD_HEADERS) & F.coalesce(F.element_at("header", 2).isin(*VALUE_HEADERS), F.lit(False))
    keyed = ~_any_header() | F.when(F.size("header") == 2, generic).otherwise(F.lit(False))
    wide_cells = F.transform("body", lambda r, i: F.transform(F.arrays_zip(F.col("header").alias("f"), r.alias("v")), lambda z, j: F.struct(i.alias("row_no"), j.alias("col_no"), z["f"].alias("field"), z["v"].alias("value"))))
    pair_cells = F.transform(F.filter("body", lambda r: F.size(r) >= 2), lambda r, i: F.array(F.struct(i.alias("row_no"), F.lit(1).alias("col_no"), F.when(is_placeholder_cell(r[0]), "").otherwise(normalise_header(r[0])).alias("field"), r[1].alias("value"))))
    cells = F.flatten(F.when(keyed, pair_cells).otherwise(wide_cells))
    rows = tables.select("doc_id", "section_id", "block_id", F.inline(cells))
    return rows.where((F.col("field") != "") & F.col("value").isNotNull() & ~is_placeholder_cell(F.col("value"))).withColumn("value", F.trim("value"))


def prose_records(texts: DataFrame) -> DataFrame:
    """(doc_id, section_id, seq, value, source, confidence): candidates in prose.

    Families in order: capitals, code in backticks, Pascal case, kebab case and paths; a
    value that comes again in another case keeps its first source.
    """
    text = F.regexp_replace("text", r"```[\s\S]*?```|~~~[\s\S]*?~~~", " ")

    def family(pattern: str, group: int, source: str, confidence: float, keep=None) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), group)
        hits = F.filter(hits, keep) if keep else hits
        return F.transform(hits, lambda v: F.struct(F.trim(v).alias("value"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence")))

    found = F.concat(
        family(r"\b[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*\b", 0, "allcaps_regex", 0.9, lambda v: (F.length(v) >= 3) & ~v.isin(*PROSE_CAPS_STOP)),
        family(r"`([^`\n]+)`", 1, "backtick_regex", 0.8),
        family(r"\b[A-Z][a-z]+(?:[A-Z][a-z0-9]+)+\b", 0, "prose", 0.6),
        family(r"\b[a-z][a-z0-9]*(?:-[a-z0-9]+)+\b", 0, "prose", 0.6),
        family(r"\b\w+(?:/\w+){2,}\b", 0, "prose", 0.6),
    )
    rows = texts.where("text is not null").select("doc_id", "section_id", F.col("seq").alias("_seq"), F.posexplode(found).alias("_pos", "r"))
    rows = rows.select("doc_id", "section_id", "_seq", "_pos", "r.*").where("value <> ''")
    best = rows.groupBy("doc_id", "section_id", F.lower("value").alias("key")).agg(F.min(F.struct("_seq", "_pos", "value", "source", "confidence")).alias("b"))
    return best.select("doc_id", "section_id", F.col("b._seq").alias("seq"), F.col("b.value").alias("value"), F.col("b.source").alias("source"), F.col("b.confidence").alias("confidence"))


def reconcile(records: DataFrame) -> DataFrame:
    """One record per (doc_id, section_id, canonical in lower case): the most confident, then the least
    field, source and text. The winner keeps its spelling. ``records``: doc_id, section_id, canonical,
    field, source, confidence, text."""
    order = Window.partitionBy("doc_id", "section_id", F.lower("canonical")).orderBy(F.col("confidence").desc(), "field", "source", "text")
    return records.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def direction(field: Column) -> Column:
    """'exposes', 'depends_on' or null, by the field's normal form alone."""
    out = None
    for name, words in DIRECTIONS.items():
        hit = field.isin(*sorted({_norm(w) for w in words}))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def _norm(word: str) -> str:
    cut = lambda w: w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith(("ss", "us", "is", "as", "os")) else w
    return " ".join(cut(w) for w in word.lower().split())


def routed(records: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds ``target``: raw_entities under the threshold, else the direction, the named field or raw_entities."""
    named = F.when(F.col("field") != "", F.concat(F.lit("metadata."), F.col("field")))
    target = F.when(F.col("confidence") < cfg.confidence, "raw_entities").otherwise(F.coalesce(direction(F.col("field")), named, F.lit("raw_entities")))
    return records.withColumn("target", target)


def routed_values(records: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_id, target, values): distinct values of each target in the order of ``seq``."""
    rows = routed(records, cfg).groupBy("doc_id", "section_id", "target").agg(F.array_sort(F.collect_set(F.struct("seq", "canonical"))).alias("v"))
    return rows.select("doc_id", "section_id", "target", F.array_distinct(F.transform("v", lambda x: x["canonical"])).alias("values"))


def section_key(title: Column) -> Column:
    return normalise_header(strip_leading_number(title))


def field_frequencies(tables: DataFrame, titles: DataFrame) -> DataFrame:
    """(section_key, field, doc_freq) with a null section_key for the whole corpus; tables by (doc_id, section_id)."""
    t = fields_and_orientation(tables).join(titles.select("doc_id", "section_id", section_key(F.col("title")).alias("section_key")), ["doc_id", "section_id"])
    rows = t.select("doc_id", "section_key", F.explode("fields").alias("field")).distinct()
    return rows.groupingSets([[F.col("section_key"), F.col("field")], [F.col("field")]], F.col("section_key"), F.col("field")).agg(F.count_distinct("doc_id").alias("doc_freq"))


def corpus_taxonomy(tables: DataFrame, titles: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(section_key, fields, orientation): fields in enough documents; the most frequent orientation, ties by name."""
    t = fields_and_orientation(tables).where(F.size("fields") > 0).join(titles.select("doc_id", "section_id", section_key(F.col("title")).alias("section_key")), ["doc_id", "section_id"])
    freq = t.select("doc_id", "section_key", F.explode("fields").alias("field")).groupBy("section_key", "field").agg(F.count_distinct("doc_id").alias("n"))
    fields = freq.where(F.col("n") >= cfg.taxonomy_min_docs).groupBy("section_key").agg(F.array_sort(F.collect_list("field")).alias("fields"))
    votes = t.groupBy("section_key", "orientation").agg(F.count("*").alias("n"))
    mode = votes.groupBy("section_key").agg(F.min(F.struct((-F.col("n")).alias("k"), "orientation")).alias("m")).select("section_key", F.col("m.orientation").alias("orientation"))
    return fields.join(mode, "section_key")


def template_taxonomy(tables: DataFrame, titles: DataFrame) -> DataFrame:
    """(section_key, fields, orientation) of one template: all fields in order, the first section's
    orientation, and within a section that of its last table."""
    t = fields_and_orientation(tables).where(F.size("fields") > 0).join(titles.select("doc_id", "section_id", section_key(F.col("title")).alias("section_key")), ["doc_id", "section_id"])
    per = t.groupBy("section_key", "section_id").agg(F.min("seq").alias("first"), F.max_by("orientation", "seq").alias("orientation"), F.array_sort(F.collect_list(F.struct("seq", "fields"))).alias("f"))
    rows = per.groupBy("section_key").agg(F.min_by("orientation", "first").alias("orientation"), F.array_sort(F.collect_list(F.struct("first", "f"))).alias("g"))
    flat = F.flatten(F.flatten(F.transform("g", lambda s: F.transform(s["f"], lambda x: x["fields"]))))
    return rows.select("section_key", F.array_distinct(flat).alias("fields"), "orientation")


def frequent_first(frequencies: DataFrame, by: str = "section_key") -> DataFrame:
    """(by, rank, field, doc_freq): the fields of each group, the most frequent first, ties by name."""
    w = Window.partitionBy(by).orderBy(F.col("doc_freq").desc(), "field")
    return frequencies.select(by, F.row_number().over(w).alias("rank"), "field", "doc_freq")


def routed_taxonomy(documents: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(doc_id, section_key, fields): the taxonomy for documents of type 'sad'; others have none, a row with nulls."""
    sad = documents.where("doc_type = 'sad'").select("doc_id").crossJoin(F.broadcast(taxonomy.select("section_key", "fields")))
    rest = documents.where(F.coalesce(F.col("doc_type") != "sad", F.lit(True))).select("doc_id", F.lit(None).cast("string").alias("section_key"), F.lit(None).cast(dict(taxonomy.dtypes)["fields"]).alias("fields"))
    return sad.unionByName(rest)


def direction_map(path: str) -> dict[str, str]:
    """Normalised field names to directions, of a YAML file {direction: [names]}; a missing file has none."""
    import yaml

    p = Path(path)
    data = (yaml.safe_load(p.read_text(encoding="utf-8")) or {}) if p.exists() else {}
    return {_norm(str(n)): str(d) for d, names in data.items() for n in names or []}
