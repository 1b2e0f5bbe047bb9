"""File sources: Markdown, HTML and DOCX folders, manifests, golden sets, context files, vocabularies.

Each source is one lazy scan; a parse that Spark has no reader for runs per batch in Arrow.
A file that cannot be read becomes a row with ``error``, so one bad file fails no job.
"""

from __future__ import annotations

import io
import json
import os
import re
import urllib.request
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.text import doc_id
from quillspark.operators.lint import is_storage_format


def _texts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/")
    return raw.select(doc_id(path).alias("doc_id"), path.alias("source_path"), F.col("value").alias("text"))


def markdown_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source_path, text) of every ``*.md`` below the folder."""
    return _texts(spark, folder, "*.md")


def html_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(pages, rejects): pages in a wiki's storage format are refused."""
    rows = _texts(spark, folder, "*.html")
    bad = is_storage_format(F.col("text"))
    return rows.where(~bad), rows.where(bad).select("doc_id", "source_path", F.lit("storage format").alias("error"))


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_markdown(data: bytes) -> dict:
    """Title, author, date and a Markdown body of a DOCX: headings, list items, tables, bold and italics."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        props = {}
        if "docProps/core.xml" in names:
            for el in ElementTree.fromstring(z.read("docProps/core.xml")).iter():
                props[el.tag.rpartition("}")[2]] = (el.text or "").strip()
        root = ElementTree.fromstring(z.read("word/document.xml"))
    out: list[str] = []

    def run_text(p) -> str:
        parts = []
        for r in p.iter(f"{_W}r"):
            text = "".join((t.text or "") if t.tag == f"{_W}t" else "\n" for t in r if t.tag in (f"{_W}t", f"{_W}br"))
            style = r.find(f"{_W}rPr")
            if text.strip() and style is not None:
                mark = ("**" if style.find(f"{_W}b") is not None else "") + ("*" if style.find(f"{_W}i") is not None else "")
                text = mark + text + mark[::-1]
            parts.append(text)
        return "".join(parts)

    for el in root.find(f"{_W}body"):
        if el.tag == f"{_W}p":
            text = run_text(el).strip()
            style = el.find(f"{_W}pPr/{_W}pStyle")
            name = style.get(f"{_W}val", "") if style is not None else ""
            level = re.match(r"Heading(\d)", name)
            if not text:
                continue
            if level:
                text = "#" * int(level.group(1)) + " " + text
            elif name == "Title":
                text = "# " + text
            elif el.find(f"{_W}pPr/{_W}numPr") is not None:
                depth = el.find(f"{_W}pPr/{_W}numPr/{_W}ilvl")
                text = "  " * int(depth.get(f"{_W}val", "0") if depth is not None else 0) + "- " + text
            out.append(text)
        elif el.tag == f"{_W}tbl":
            rows = [[" ".join(run_text(p).strip() for p in c.iter(f"{_W}p")).replace("|", "\\|") for c in r.findall(f"{_W}tc")] for r in el.findall(f"{_W}tr")]
            if rows:
                width = max(map(len, rows))
                lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
                out.append("\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]))
    body = re.sub(r"(?m)^(\s*- .*)\n\n(?=\s*- )", r"\1\n", "\n\n".join(out))
    return {"title": props.get("title") or None, "author": props.get("creator") or None, "last_modified": props.get("modified") or None, "text": body}


def docx_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source_path, title, author, last_modified, text, error) of every ``*.docx``; no file is converted outside its task."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(folder)
    path = F.regexp_replace("path", r"^file:/+", "/")
    raw = raw.select(doc_id(path).alias("doc_id"), path.alias("source_path"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for d, p, c in pdf.itertuples(index=False, name=None):
                try:
                    out.append({"doc_id": d, "source_path": p, **docx_markdown(c), "error": None})
                except Exception as e:  # noqa: BLE001 - any broken archive is a row
                    out.append({"doc_id": d, "source_path": p, "title": None, "author": None, "last_modified": None, "text": None, "error": f"{type(e).__name__}: {e}"})
            if out:
                yield pd.DataFrame(out)

    return raw.mapInPandas(run, "doc_id string, source_path string, title string, author string, last_modified string, text string, error string")


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, errors) of a download manifest in YAML or JSON: url and dest are required, dest stays below its folder."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    entries = data.get("entries", []) if isinstance(data, dict) else data
    schema = "n int, url string, dest string, labels array<string>, space string, source_url string"
    rows = [(i, e.get("url"), e.get("dest"), list(e.get("labels") or []), e.get("space"), e.get("source_url")) for i, e in enumerate(entries) if isinstance(e, dict)]
    df = spark.createDataFrame(rows, schema)
    why = F.when(F.coalesce("url", F.lit("")) == "", "no url").when(F.coalesce("dest", F.lit("")) == "", "no dest").when(~F.col("url").rlike("^https?://"), "not http").when(F.col("dest").rlike(r"^/|(^|/)\.\.(/|$)"), "dest outside the folder")
    return df.where(why.isNull()), df.where(why.isNotNull()).select("n", why.alias("error"))


def _http_get(url: str, timeout: float) -> bytes:
    with urllib.request.urlopen(url, timeout=timeout) as answer:
        return answer.read()


def downloaded(entries: DataFrame, folder: str, get: Callable[[str, float], bytes] = _http_get, timeout: float = 30.0, tries: int = 3) -> DataFrame:
    """(n, dest, status, n_bytes, error): the entries of a manifest fetched into ``folder``, which all executors share.

    A file appears by one rename, so a lost task leaves none half written; a file that is there already is kept
    ('kept'), so a repeated job goes on where it was. A failed entry is a row, not a failed job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, url, dest in zip(pdf["n"], pdf["url"], pdf["dest"]):
                place, status, size, error = Path(folder) / dest, "kept", None, None
                for left in range(tries - 1, -1, -1):
                    if place.exists():
                        size = place.stat().st_size
                        break
                    try:
                        body = get(url, timeout)
                        place.parent.mkdir(parents=True, exist_ok=True)
                        staged = place.with_name(f".{place.name}.{uuid.uuid4().hex}")
                        staged.write_bytes(body)
                        os.replace(staged, place)
                        status, size, error = "ok", len(body), None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of a transfer is told in its row
                        status, error = "failed", f"{type(e).__name__}: {e}"
                out.append((n, dest, status, size, error))
            if out:
                yield pd.DataFrame(out, columns=["n", "dest", "status", "n_bytes", "error"]).astype({"n_bytes": "Int64"})

    return entries.select("n", "url", "dest").mapInPandas(run, "n int, dest string, status string, n_bytes bigint, error string")


def golden_set(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(queries, matchers) of an evaluation set in YAML or JSON."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    items = data["queries"]
    queries = [(str(q["id"]), q["text"], q.get("category") or "general") for q in items]
    matchers = [(str(q["id"]), f"{q['id']}-{i}", m["doc"], m.get("section")) for q in items for i, m in enumerate(q.get("expected") or [])]
    return spark.createDataFrame(queries, "query_id string, query string, category string"), spark.createDataFrame(matchers, "query_id string, matcher_id string, doc_id string, section string")


def read_vocabulary(path: str) -> list[str]:
    """The words of a JSON list; a missing file has none."""
    p = Path(path)
    return [str(x) for x in json.loads(p.read_text(encoding="utf-8"))] if p.exists() else []


def write_vocabulary(words: list[str], path: str) -> None:
    """Trimmed, distinct and sorted."""
    Path(path).write_text(json.dumps(sorted({w.strip() for w in words if w and w.strip()}), ensure_ascii=False, indent=2), encoding="utf-8")


def read_taxonomy(path: str) -> dict:
    p = Path(path)
    return json.loads(p.read_text(encoding="utf-8")) if p.exists() else {}


def front_matter_text(fields: dict) -> str:
    """Front matter that reads back as the same fields."""
    import yaml

    text = yaml.safe_dump({k: v for k, v in fields.items() if v not in (None, "", [])}, allow_unicode=True, sort_keys=False, width=10_000)
    if yaml.safe_load(text) != {k: v for k, v in fields.items() if v not in (None, "", [])}:
        raise ValueError("the fields do not survive YAML")
    return f"---\n{text}---\n"


# Which files an assistant loads, in the order in which a file's kind is decided.
CONTEXT_FILES = [
    ("Claude", "startup", r"(^|/)CLAUDE\.md$"), ("Claude", "split", r"(^|/)SKILL\.md$|\.skill\.md$"), ("Claude", "invoke", r"^\.claude/(agents|commands)/.*\.md$"),
    ("GitHub Copilot", "startup", r"^(AGENTS|CLAUDE|GEMINI)\.md$|^\.github/copilot-instructions\.md$"), ("GitHub Copilot", "conditional", r"\.instructions\.md$|(^|/)AGENTS\.md$"),
    ("GitHub Copilot", "invoke", r"\.agent\.md$|(^|/)SKILL\.md$|\.skill\.md$"),
]


def context_files(spark: SparkSession, folder: str) -> DataFrame:
    """(ecosystem, path, load, startup_chars, invoke_chars): a file counts for the first pattern of each
    ecosystem; of a skill only the front matter is loaded at the start."""
    root = folder.rstrip("/") + "/"
    rows = _texts(spark, folder, "*.md").withColumn("path", F.substring_index("source_path", root, -1))
    patterns = F.broadcast(spark.createDataFrame([(e, k, i, p) for i, (e, k, p) in enumerate(CONTEXT_FILES)], "ecosystem string, load string, rank int, pattern string"))
    hits = rows.join(patterns, F.regexp(F.col("path"), F.col("pattern")))
    w = Window.partitionBy("ecosystem", "path").orderBy("rank")
    hits = hits.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    head = F.length(F.regexp_extract("text", r"^(---[\s\S]*?\n---)", 1))
    head = F.when(head > 0, head).otherwise(F.least(F.lit(200), F.length("text")))
    startup = F.when(F.col("load") == "startup", F.length("text")).when(F.col("load") == "split", head).otherwise(0)
    return hits.select("ecosystem", "path", "load", startup.alias("startup_chars"), F.when(F.col("load") == "startup", 0).otherwise(F.length("text") - F.when(F.col("load") == "split", startup).otherwise(0)).alias("invoke_chars"))
