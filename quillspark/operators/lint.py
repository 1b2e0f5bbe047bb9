"""Lint of Markdown and the hygiene gate over chunks, as boolean and count columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config

# ---- Fixed values: shapes of residue -------------------------------------------------
LEAK = r"(?i)<(?!--)(?:span|div|p|a|strong|em|table|td|tr|th|u|sup|sub|s|del|code|pre|img)\b[^>]*>|&(?:nbsp|amp|lt|gt|quot|#\d+);"
MACRO = r"(?i)\{(?:panel|note|warning|info|tip|code)[^}]*\}|<ac:[^>]+>|<ri:[^>]+>"
CODE = r"```[\s\S]*?```|~~~[\s\S]*?~~~|`[^`]+`"
SYNTAX = r"[#*_`\[\]()>|~^\\!=+-]"
KNOWN_TAG = r"(?i)</?(?:span|div|p|a|strong|em|table|td|tr|th|thead|tbody|ul|ol|li|h[1-6]|blockquote|u|sup|sub|s|del|code|pre|img|hr)\b"
SPACE_TAG = r"</?(?:ac|ri|at|fab):[A-Za-z]"
SHAPED_TAG = r"<[A-Za-z][A-Za-z0-9:.-]*\s+[^<>]*=[^<>]*?/?>|</[A-Za-z][A-Za-z0-9:.-]*\s*>"
SPACE_TOKEN = r"(?:^|[^\w])(?:ac|ri|at|fab):[A-Za-z][\w-]*"
ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]*|#\d+|#x[0-9A-Fa-f]+);"
BASE64 = r"[A-Za-z0-9+/]{200,}={0,2}"
STORAGE = r"<(?:ac|ri|at):[A-Za-z]"
FLAVOUR_DC = r"<meta\b[^>]*name=['\"]ajs-version-number['\"]|class=['\"][^'\"]*(?:syntaxhighlighter-pre|\bconfluenceTable\b)"
FLAVOUR_CLOUD = r"<meta\b[^>]*name=['\"]confluence-version['\"]|class=['\"](?:[^'\"]*\s)?(?:content-area|wiki-content)(?:\s[^'\"]*)?['\"]"
FENCE = r"^(`{3,}|~{3,})"
SPAN = r"`+[^`]*`+"
HEADING = r"^(#{1,6})\s+\S"
# ---- end of fixed values ------------------------------------------------------------


def leak_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LEAK))


def leak_severity(text: Column, cfg: Config = DEFAULT) -> Column:
    """'block' beyond the limit, 'warn' for a few, null for none."""
    n = leak_count(text)
    return F.when(n > cfg.lint_leaks, "block").when(n > 0, "warn")


def macro_samples(text: Column) -> Column:
    """Sorted distinct beginnings of untranslated macros."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(MACRO), 0), lambda m: F.substring(m, 1, 24))))


def code_share(text: Column) -> Column:
    total = F.aggregate(F.regexp_extract_all(text, F.lit(CODE), 0), F.lit(0), lambda s, m: s + F.length(m))
    return F.when(F.length(text) > 0, total / F.length(text))


def link_share(text: Column) -> Column:
    words = F.regexp_count(text, F.lit(r"\S+"))
    linked = F.aggregate(F.regexp_extract_all(text, F.lit(r"\[([^\]]+)\]\([^)]+\)"), 1), F.lit(0), lambda s, m: s + F.regexp_count(m, F.lit(r"\S+")))
    return F.when(words > 0, linked / words)


def substance(text: Column) -> Column:
    """Characters left without Markdown's signs and runs of blanks."""
    return F.length(F.trim(F.regexp_replace(F.regexp_replace(text, SYNTAX, ""), r"\s+", " ")))


def blank_code(text: str | None) -> str:
    """The text with fenced and indented code emptied and code spans blanked; lines keep their numbers.

    A fence is closed by a run of its own character at least as long as the one that opened it. Indented
    code begins after an empty line or at the start and goes on until a line is not indented.
    """
    fence, out = "", []
    indented, fresh = False, True
    for line in (text or "").split("\n"):
        mark = re.match(FENCE, line.strip())
        if fence:
            if mark and mark.group(1)[0] == fence[0] and len(mark.group(1)) >= len(fence) and not line.strip()[len(mark.group(1)) :].strip():
                fence = ""
            out.append("")
            fresh = False
        elif mark:
            fence = mark.group(1)
            out.append("")
            fresh = False
        elif not line.strip():
            out.append(line)
            indented, fresh = False, True
        elif line.startswith(("    ", "\t")) and (indented or fresh):
            out.append("")
            indented, fresh = True, False
        else:
            indented = fresh = False
            out.append(re.sub(SPAN, lambda m: " " * len(m.group(0)), line))
    return "\n".join(out)


def orphan_headings(prose: str, raw: str) -> list[int]:
    """Lines of headings that have no content before a heading of the same or a higher level."""
    rows = raw.split("\n")
    heads = [(i, len(m.group(1))) for i, line in enumerate(prose.split("\n")) if (m := re.match(HEADING, line))]
    bare = []
    for (at, level), (until, then) in zip(heads, [*heads[1:], (len(rows), 0)]):
        if then <= level and not any(r.strip() for r in rows[at + 1 : until]):
            bare.append(at + 1)
    return bare


def with_blanked_code(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``prose`` (code blanked) and ``orphans`` (lines of empty headings): the two steps that need state."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", prose string, orphans array<int>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prose = [blank_code(t) for t in pdf[text]]
            yield pdf.assign(prose=prose, orphans=[orphan_headings(p, t or "") for p, t in zip(prose, pdf[text])])

    return rows.mapInPandas(run, schema)


def first_line(text: Column, pattern: str) -> Column:
    """The number of the line that the first match begins on."""
    before = F.substring(text, F.lit(1), F.regexp_instr(text, F.lit(pattern)) - 1)
    return F.size(F.split(before, "\n"))


def _issue(rule: str, severity: Column, detail: Column, line: Column | None = None) -> Column:
    at = F.lit(None).cast("int") if line is None else line.cast("int")
    return F.when(severity.isNotNull(), F.struct(F.lit(rule).alias("rule"), severity.alias("severity"), detail.alias("detail"), at.alias("line")))


def markdown_issues(text: Column, prose: Column, orphans: Column, cfg: Config = DEFAULT) -> Column:
    """The findings of one document, in a fixed order of six checks."""
    n, samples = leak_count(prose), macro_samples(prose)
    code, links, left = code_share(text), link_share(prose), substance(prose)
    found = [
        _issue("html_leakage", leak_severity(prose, cfg), F.concat(n.cast("string"), F.lit(" HTML fragments")), first_line(prose, LEAK)),
        _issue("confluence_artifacts", F.when(F.size(samples) > 0, "block"), F.array_join(samples, ", "), first_line(prose, MACRO)),
        _issue("code_ratio", F.when(code > cfg.lint_code_share, "warn"), F.format_string("%.0f%% code", code * 100)),
        _issue("link_density", F.when(links > cfg.lint_link_share, "warn"), F.format_string("%.0f%% link text", links * 100)),
        _issue("content_density", F.when(left < cfg.lint_stub_chars, "block"), F.concat(F.lit("only "), left.cast("string"), F.lit(" characters"))),
        _issue("orphaned_headings", F.when(F.size(orphans) > 0, "warn"), F.concat(F.size(orphans).cast("string"), F.lit(" empty headings")), F.get(orphans, 0)),
    ]
    return F.array_compact(F.array(*found))


def lint(documents: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, issues) of every document; null and empty texts are stubs."""
    rows = with_blanked_code(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    return rows.select("doc_id", markdown_issues(F.col("text"), F.col("prose"), F.col("orphans"), cfg).alias("issues"))


def residue_flags(text: Column) -> dict[str, Column]:
    """The six shapes that clean text cannot have."""
    return {
        "html_residue": text.rlike(KNOWN_TAG) | text.rlike(SPACE_TAG) | text.rlike(SHAPED_TAG),
        "macro_residue": text.rlike(SPACE_TOKEN) | text.rlike(MACRO),
        "entity_residue": text.rlike(ENTITY),
        "base64_residue": text.rlike(BASE64),
        "replacement_char": text.contains("�"),
    }


#: a text without any of these characters has none of the shapes, unless it has a long run of base64
_SIGNS = r"[<&{:\uFFFD]|[A-Za-z0-9+/]{200}"


def is_poisoned(text: Column, content_type: Column) -> Column:
    """Empty, or not code and with the shape of markup."""
    any_flag = None
    for flag in residue_flags(F.regexp_replace(text, CODE, " ")).values():
        any_flag = flag if any_flag is None else any_flag | flag
    return (F.trim(F.coalesce(text, F.lit(""))) == "") | ((content_type != "code") & F.coalesce(text.rlike(_SIGNS), F.lit(False)) & F.coalesce(any_flag, F.lit(False)))


#: columns of a chunk that feed the header of its embedding text
HEADER_VALUES = ("breadcrumb", "doc_title", "entities", "tags")


def header_is_poisoned(columns: list[tuple[str, str]]) -> Column:
    """Whether the values of the header, of those columns that there are, have the shape of markup."""
    held = [F.array_join(c, "\n") if t.startswith("array") else F.col(c) for c, t in columns if c in HEADER_VALUES]
    if not held:
        return F.lit(False)
    values, found = F.concat_ws("\n", *held), F.lit(False)
    for flag in residue_flags(values).values():
        found = found | flag
    return F.coalesce(values.rlike(_SIGNS) & found, F.lit(False))


def gate(chunks: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept chunks, rejected doc_ids): one chunk that is poisoned in its text or in its header drops its whole document."""
    poisoned = is_poisoned(F.col(text), F.col("content_type")) | header_is_poisoned(chunks.dtypes)
    bad = chunks.where(poisoned).groupBy("doc_id").agg(F.count("*").alias("n_poisoned"))
    return chunks.join(bad, "doc_id", "left_anti"), bad


def passing_documents(chunks: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(doc_id, n_chunks) of the documents that pass the gate. Each chunk is judged where it is read, so only
    its ``key`` and the verdict cross the network; copies of a chunk count once."""
    poisoned = is_poisoned(F.col(text), F.col("content_type")) | header_is_poisoned(chunks.dtypes)
    judged = chunks.select("doc_id", *key, poisoned.alias("poisoned")).distinct()
    return judged.groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.max("poisoned").alias("bad")).where(~F.col("bad")).select("doc_id", "n_chunks")


def budget_severity(length: Column, cfg: Config = DEFAULT) -> Column:
    """Both are warnings: a length alone does not block."""
    return F.when(length > cfg.embed_char_hard_cap, "truncation_risk").when(length > cfg.embed_char_budget, "over_budget")


def is_low_signal(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z0-9]{2,}")) < 3


def wiki_flavour(html: Column) -> Column:
    """Which kind of wiki rendered a page: 'dc', 'cloud' or 'unknown'; the marks of 'dc' count first."""
    return F.when(html.rlike(FLAVOUR_DC), "dc").when(html.rlike(FLAVOUR_CLOUD), "cloud").otherwise("unknown")


def is_storage_format(html: Column) -> Column:
    return html.rlike(STORAGE)
