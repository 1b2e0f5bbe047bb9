"""From Markdown to relations: headings, sections, blocks.

The parse itself is sequential and runs in one Arrow UDF per partition; section trees,
breadcrumbs, ids and numbering are window expressions over its flat rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import short_hash

MAX_LEVEL = 6


def breadcrumbs(headings: DataFrame) -> DataFrame:
    """Adds ``breadcrumb`` to rows (doc_id, seq, level, title).

    The ancestors of a heading are, for each shallower level, the last heading of that level
    before it, unless a heading that is shallower still came in between.
    """
    before = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    last = {k: F.last(F.when(F.col("level") == k, F.struct(F.col("seq").alias("s"), F.coalesce("title", F.lit("")).alias("t"))), True).over(before) for k in range(1, MAX_LEVEL)}
    rows = headings.withColumns({f"_l{k}": c for k, c in last.items()})
    parts = []
    for k in range(1, MAX_LEVEL):
        newer = F.lit(True)
        for j in range(1, k):
            newer = newer & (F.col(f"_l{j}").isNull() | (F.col(f"_l{j}.s") < F.col(f"_l{k}.s")))
        parts.append(F.when((F.col("level") > k) & F.col(f"_l{k}").isNotNull() & newer, F.col(f"_l{k}.t")))
    crumb = F.array_compact(F.array(*parts, F.coalesce("title", F.lit(""))))
    return rows.withColumn("breadcrumb", crumb).drop(*[f"_l{k}" for k in range(1, MAX_LEVEL)])


def heading_ids(headings: DataFrame) -> DataFrame:
    """Adds ``heading_id``, a slug that is numbered when the page repeats it, and ``hash_id``."""
    base = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce("title", F.lit(""))), r"[^\p{L}\p{N}\s_-]", ""), r"\s+", "-")
    n = F.row_number().over(Window.partitionBy("doc_id", "_base").orderBy("seq")) - 1
    rows = headings.withColumn("_base", base).withColumn("_n", n)
    made = F.when(F.col("_n") > 0, F.concat_ws("-", "_base", F.col("_n").cast("string"))).otherwise(F.col("_base"))
    return rows.withColumn("heading_id", made).withColumn("hash_id", short_hash(F.col("doc_id"), F.coalesce("title", F.lit("")), F.col("level").cast("string"))).drop("_base", "_n")


# ---- Markdown parser ----------------------------------------------------------------

_ATX = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
_FENCE = re.compile(r"^( {0,3})(`{3,}|~{3,})\s*([\w+#.-]*)")
_ITEM = re.compile(r"^( *)([-*+]|\d{1,9}[.)])(?: +|$)(.*)$")
_RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
_TABLE_RULE = re.compile(r"^ *\|?[ :|-]*-[ :|-]*\|?[ ]*$")
_LINK = re.compile(r"(?<!!)\[([^\[\]\n]+)\]\((\S+?)(?:\s+\"[^\"]*\")?\)")
_IMAGE = re.compile(r"!\[([^\]\n]*)\]\([^()\n]*\)")
_EMPHASIS = re.compile(r"(?<![\w*])(\*{1,3})(?=\S)(.+?)(?<=\S)\1(?![\w*])|(?<![\w_])(_{1,3})(?=\S)(.+?)(?<=\S)\3(?![\w_])|~~(\S(?:.*?\S)?)~~")
_CODE = re.compile(r"(`+)(?!`)(.+?)(?<!`)\1(?!`)")
_FRONT = re.compile(r"\A---[ \t]*\n(.*?)\n(?:---|\.\.\.)[ \t]*(?:\n|\Z)", re.S)
# The spellings of front-matter keys.
FRONT_KEYS = {
    "title": "title", "space": "space", "space-key": "space", "spacekey": "space", "url": "url", "source": "url", "confluence-url": "url",
    "labels": "labels", "tags": "labels", "author": "author", "date": "last_modified", "last-modified": "last_modified",
}


def host_hint(url: str) -> str:
    m = re.match(r"[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)", url)
    return re.sub(r"^www\.", "", m.group(1)) if m and m.group(1) else re.split(r"[?#]", url)[0]


def inline(text: str) -> str:
    """Inline text: code keeps its backticks, links become ``text (host)``, images their caption."""
    kept: list[str] = []

    def hold(m: re.Match) -> str:
        kept.append(m.group(0))
        return f"\x00{len(kept) - 1}\x00"

    out = _CODE.sub(hold, text)
    out = _IMAGE.sub(r"\1", out)
    out = _LINK.sub(lambda m: f"{m.group(1)} ({host_hint(m.group(2))})" if host_hint(m.group(2)) else m.group(1), out)
    for _ in range(2):
        out = _EMPHASIS.sub(lambda m: m.group(2) or m.group(4) or m.group(5), out)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))], out)


def front_matter(text: str) -> tuple[dict, str]:
    """(fields, body): known keys by their aliases, the others under ``extra``; bad YAML counts as none."""
    m = _FRONT.match(text)
    if not m:
        return {}, text
    try:
        import yaml

        data = yaml.safe_load(m.group(1))
    except Exception:
        data = None
    if not isinstance(data, dict):
        return {}, text[m.end() :]
    fields: dict = {"extra": {}}
    for key, value in data.items():
        name = FRONT_KEYS.get(str(key).lower())
        if name == "labels":
            value = [str(x).strip() for x in (value if isinstance(value, list) else str(value or "").split(",")) if str(x).strip()]
        elif name:
            value = None if value is None else str(value)
        if name:
            fields.setdefault(name, value)
        else:
            fields["extra"][str(key)] = str(value)
    return fields, text[m.end() :]


def _list_text(lines: list[str]) -> str:
    """A list with gap-free numbering from its first number and two blanks per nesting level."""
    out: list[str] = []
    stack: list[tuple[int, int]] = []  # (indent, next number or -1)
    for line in lines:
        m = _ITEM.match(line)
        if not m:
            text = line.strip()
            pad = "  " * max(0, len(stack) - 1) + ("   " if stack and stack[-1][1] >= 0 else "  ")
            if text:
                out.append(pad + inline(text))
            continue
        indent, mark, body = len(m.group(1)), m.group(2), m.group(3)
        while stack and indent < stack[-1][0]:
            stack.pop()
        if not stack or indent > stack[-1][0]:
            stack.append((indent, int(mark[:-1]) if mark[0].isdigit() else -1))
        number = stack[-1][1]
        if number >= 0:
            stack[-1] = (stack[-1][0], number + 1)
        out.append("  " * (len(stack) - 1) + (f"{number}. " if number >= 0 else "- ") + inline(body))
    return "\n".join(out)


def _table_text(lines: list[str]) -> str:
    rows = [[inline(c.strip()) for c in re.split(r"(?<!\\)\|", re.sub(r"(?<!\\)\|\s*$", "", line.strip().removeprefix("|")))] for line in lines]
    head, body = rows[0], rows[2:]
    width = max(len(r) for r in [head, *body])
    line = lambda r: "| " + " | ".join([*r, *[""] * (width - len(r))]) + " |"
    return "\n".join([line(head), "| " + " | ".join(["---"] * width) + " |", *map(line, body)])


def parse_markdown(text: str | None) -> list[dict]:
    """Flat rows of one document in order: headings (level, text) and blocks (content_type, text, language).

    Raw HTML and rules leave no block. Links and figures of a block are kept apart from its text.
    """
    rows: list[dict] = []
    lines = (text or "").split("\n")
    i, para = 0, []

    def add(kind: str, body: str, raw: str = "", level: int = 0, language: str | None = None) -> None:
        if kind == "heading" or body.strip():
            rows.append({
                "kind": "heading" if kind == "heading" else "block", "level": level, "content_type": None if kind == "heading" else kind, "text": body, "language": language,
                "xref": [f"{a} -> {u}" for a, u in dict.fromkeys(_LINK.findall(raw))], "figure": list(dict.fromkeys(c for c in _IMAGE.findall(raw) if c)),
            })

    def flush() -> None:
        nonlocal para
        if para:
            raw = "\n".join(para)
            if not re.match(r"\s*<(?:!--|/?[A-Za-z])[^>]*>\s*$", raw):
                add("paragraph", inline(" ".join(p.strip() for p in para)), raw)
            para = []

    while i < len(lines):
        line = lines[i]
        fence = _FENCE.match(line)
        if fence:
            flush()
            mark, lang, body = fence.group(2), fence.group(3), []
            i += 1
            while i < len(lines) and not (lines[i].strip().startswith(mark) and not lines[i].strip().strip(mark[0])):
                body.append(lines[i])
                i += 1
            add("code", "\n".join(body), language=lang.lower() or None)
            i += 1
            continue
        atx = _ATX.match(line)
        if atx:
            flush()
            add("heading", inline((atx.group(2) or "").strip()), line, level=len(atx.group(1)))
        elif para and re.match(r"^ {0,3}(=+|-+)[ \t]*$", line):
            raw = " ".join(p.strip() for p in para)
            para = []
            add("heading", inline(raw), raw, level=1 if line.strip()[0] == "=" else 2)
        elif _RULE.match(line):
            flush()
        elif not line.strip():
            flush()
        elif line.lstrip().startswith(">"):
            flush()
            quote = []
            while i < len(lines) and lines[i].lstrip().startswith(">"):
                quote.append(re.sub(r"^\s*>[ ]?", "", lines[i]))
                i += 1
            add("blockquote", "\n".join("> " + inline(q) if q.strip() else ">" for q in quote), "\n".join(quote))
            continue
        elif "|" in line and i + 1 < len(lines) and "|" in lines[i + 1] and _TABLE_RULE.match(lines[i + 1]):
            flush()
            grid = []
            while i < len(lines) and "|" in lines[i] and lines[i].strip():
                grid.append(lines[i])
                i += 1
            add("table", _table_text(grid), "\n".join(grid))
            continue
        elif _ITEM.match(line) and not (para and _ITEM.match(line).group(2)[0].isdigit() and _ITEM.match(line).group(2)[:-1] != "1"):
            flush()
            items = []
            while i < len(lines) and (_ITEM.match(lines[i]) or (lines[i].startswith("  ") and lines[i].strip()) or (not lines[i].strip() and i + 1 < len(lines) and (_ITEM.match(lines[i + 1]) or lines[i + 1].startswith("   ")))):
                items.append(lines[i])
                i += 1
            add("list", _list_text(items), "\n".join(items))
            continue
        elif i + 1 < len(lines) and re.match(r"^ {0,3}:[ \t]+\S", lines[i + 1]) and not para:
            out = []
            while i < len(lines) and lines[i].strip():
                term, i = lines[i].strip(), i + 1
                meanings = []
                while i < len(lines) and re.match(r"^ {0,3}:[ \t]+\S", lines[i]):
                    meanings.append(inline(lines[i].strip()[1:].strip()))
                    i += 1
                out.append(f"{inline(term)} — {'; '.join(meanings)}" if meanings else inline(term))
            add("definition", "\n".join(out))
            continue
        elif re.match(r"^(?: {4}|\t)", line) and not para:
            code = []
            while i < len(lines) and (re.match(r"^(?: {4}|\t)", lines[i]) or not lines[i].strip()):
                code.append(re.sub(r"^(?: {4}|\t)", "", lines[i]))
                i += 1
            add("code", "\n".join(code).strip("\n"))
            continue
        else:
            para.append(line)
        i += 1
    flush()
    return rows


PARSED = "doc_id {key}, seq int, kind string, level int, content_type string, text string, language string, xref array<string>, figure array<string>"


def parsed_rows(documents: DataFrame) -> DataFrame:
    """The parser's rows (doc_id, seq, kind, level, content_type, text, language, xref, figure) of all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                _, body = front_matter(text or "")
                out += [{"doc_id": doc, "seq": n, **r} for n, r in enumerate(parse_markdown(body))]
            if out:
                yield pd.DataFrame(out)

    return documents.select("doc_id", "text").mapInPandas(run, PARSED.format(key=dict(documents.dtypes)["doc_id"]))


def front_matter_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, title, space, url, labels, author, last_modified, extra) from the front matter."""
    names = ("title", "space", "url", "labels", "author", "last_modified")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                f, _ = front_matter(text or "")
                out.append({"doc_id": doc, **{n: f.get(n) for n in names}, "extra": f.get("extra", {})})
            yield pd.DataFrame(out)

    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, title string, space string, url string, labels array<string>, author string, last_modified string, extra map<string,string>"
    return documents.select("doc_id", "text").mapInPandas(run, schema)


def sections_and_blocks(parsed: DataFrame, titles: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, blocks) of parsed rows. Blocks before the first heading go to a section of level 1
    that is named by the document's title, else 'Document', and comes first (seq -1)."""
    order = Window.partitionBy("doc_id").orderBy("seq")
    rows = parsed.withColumn("head", F.last(F.when(F.col("kind") == "heading", F.col("seq")), True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    heads = parsed.where("kind = 'heading'").select("doc_id", "seq", "level", F.col("text").alias("title"))
    early = rows.where("kind = 'block' and head is null").select("doc_id").distinct()
    named = early.join(titles.select("doc_id", F.col("title").alias("_t")), "doc_id", "left") if titles is not None else early.withColumn("_t", F.lit(None).cast("string"))
    heads = heads.unionByName(named.select("doc_id", F.lit(-1).alias("seq"), F.lit(1).alias("level"), F.coalesce("_t", F.lit("Document")).alias("title")))
    sections = heading_ids(breadcrumbs(heads)).withColumnRenamed("heading_id", "section_id")
    counter = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")) - 1
    blocks = rows.where("kind = 'block'").withColumn("n", counter).withColumn("head", F.coalesce("head", F.lit(-1)))
    blocks = blocks.join(sections.select("doc_id", F.col("seq").alias("head"), "section_id"), ["doc_id", "head"])
    made = short_hash(F.col("doc_id").cast("string"), F.col("section_id"), F.col("n").cast("string"))
    return sections, blocks.select("doc_id", "section_id", "seq", made.alias("block_id"), "content_type", "text", "language", "xref", "figure")



