"""Column functions over text: tokens, normal forms, hashes, numbers, Markdown measures.

Each returns a Column built from built-in functions. Null in gives null out unless said
otherwise; the empty string is a value like any other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(words: list[str]) -> str:
    """An alternation of literal words for Java's regex."""
    return "|".join(re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", w) for w in words)


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order; null gives an empty array."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0), F.array().cast("array<string>"))


def token_set(text: Column) -> Column:
    """Distinct runs of three and more ASCII letters or digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]{3,}"), 0))


def normalise_language(code: Column) -> Column:
    """The two-letter code of a known language; anything else, null included, is English."""
    base = F.split(F.regexp_replace(F.lower(F.trim(code)), "_", "-"), "-")[0]
    return F.when(base.isin("en", "de", "fr", "it"), base).otherwise(F.lit("en"))


def normalise_header(header: Column) -> Column:
    """Lower-case, without brackets, up to the first slash, single blanks, plural s cut from longer words."""
    s = F.split(F.regexp_replace(F.lower(header), r"\([^)]*\)", " "), "/")[0]
    s = F.trim(F.regexp_replace(s, r"(?U)\s+", " "))
    return F.array_join(
        F.transform(
            F.split(s, " "),
            lambda w: F.when((F.length(w) > 3) & w.rlike("s$") & ~w.rlike("(ss|us|is|as|os)$"), F.regexp_replace(w, "s$", "")).otherwise(w),
        ),
        " ",
    )


def strip_leading_number(title: Column) -> Column:
    return F.regexp_replace(title, r"^[\d.]+\s*", "")


def split_pipe_row(line: Column) -> Column:
    """The trimmed cells of a pipe-table row; an escaped pipe stays in its cell."""
    inner = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"(?<!\\)\|$", "")
    return F.transform(F.split(inner, r"(?<!\\)\|"), lambda c: F.trim(F.replace(c, F.lit("\\|"), F.lit("|"))))


def is_separator_row(cells: Column) -> Column:
    return (F.size(cells) > 0) & F.forall(cells, lambda c: c.rlike(r"^:?-+:?$"))


def is_placeholder_cell(cell: Column) -> Column:
    return F.trim(cell).rlike(r"^\[.*\]$") | (F.trim(cell) == "")


def link_hint(url: Column) -> Column:
    """The host without ``www.``, with its port; without a host the path."""
    host = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), r"^www\.", "")
    return F.when(host != "", host).otherwise(F.regexp_extract(url, r"^([^?#]*)", 1))


def slug(text: Column, length: int = 40) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    s = F.substring(s, 1, length)
    return F.when(s == "", F.lit("x")).otherwise(s)


def short_hash(*parts: Column, length: int = 8) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, length)


def doc_id(path: Column) -> Column:
    return F.substring(F.md5(path), 1, 12)


def has_signal(text: Column) -> Column:
    return F.replace(text, F.lit("`"), F.lit("")).rlike("[A-Za-z0-9]")


# Fixed value: a line that names a file.
LEAD_IN_FILE = r"(?U)^[\w./-]+\.[A-Za-z0-9]{1,6}$"


def is_lead_in(text: Column, longest: int = 48) -> Column:
    """A short single line that ends with a colon or names a file."""
    t = F.trim(text)
    return (F.length(t) <= longest) & (F.length(t) > 0) & ~t.contains("\n") & (t.endswith(":") | t.rlike(LEAD_IN_FILE))


def bounded_words(words: list[str], tail: bool = False) -> str:
    """A pattern for words at a word start, or between word boundaries, in any case and script."""
    end = r"(?![\p{L}\p{N}_])" if tail else ""
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_])(?:{quoted(words)}){end}"


def clean_number(text: Column) -> Column:
    """A number written with dollar signs and commas; what is none is 0."""
    return F.coalesce(F.expr("1.0D") * F.regexp_replace(F.trim(text), "[$,]", "").try_cast("double"), F.lit(0.0))


def human_number(n: Column) -> Column:
    """1234567 as 1.2M, 1234 as 1.2k."""
    return (
        F.when(F.abs(n) >= 1_000_000, F.concat(F.format_string("%.1f", n / 1_000_000.0), F.lit("M")))
        .when(F.abs(n) >= 1_000, F.concat(F.format_string("%.1f", n / 1_000.0), F.lit("k")))
        .otherwise(F.format_string("%d", n.cast("bigint")))
    )


def money(n: Column) -> Column:
    """Two decimals, four under one."""
    return F.when(F.abs(n) < 1, F.concat(F.lit("$"), F.format_string("%.4f", n))).otherwise(F.concat(F.lit("$"), F.format_string("%.2f", n)))


def nice_ceiling(n: Column) -> Column:
    """The next of 1, 2, 2.5, 5 and 10 times a power of ten; 1 for nothing."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(n)))
    share = n / power
    step = F.when(share <= 1, 1.0).when(share <= 2, 2.0).when(share <= 2.5, 2.5).when(share <= 5, 5.0).otherwise(10.0)
    return F.when(n > 0, step * power).otherwise(F.lit(1.0))


def token_estimate(text: Column, chars_per_token: float = 4.0) -> Column:
    return F.bround(F.length(text) / F.lit(chars_per_token), 0).cast("bigint")


def epoch_seconds(raw: Column) -> Column:
    """Seconds from a number in seconds, milli-, micro- or nanoseconds, told by its size."""
    v = raw.cast("double")
    return F.when(v >= 1e17, v / 1e9).when(v >= 1e14, v / 1e6).when(v >= 1e11, v / 1e3).otherwise(v)


def normalise_path(path: Column) -> Column:
    return F.lower(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/+$", ""))


def link_texts(markdown: Column) -> Column:
    return F.regexp_extract_all(markdown, F.lit(r"\[([^\]]+)\]\([^)]+\)"), 1)


# What the counters of a Markdown text count.
MEASURES = {
    "headings": r"(?m)^#{1,6}[ \t]", "pictures": r"!\[[^\]]*\]\([^)]*\)", "lists": r"(?m)^[ \t]*(?:[-*+]|\d+\.)[ \t]+\S", "blockquotes": r"(?m)^> ",
    "links": r"(?<!!)\[[^\]]*\]\([^)\s]+", "autolinks": r"<https?://[^>\s]+>", "bare": r"(?<![(<\w])https?://[^\s)>\]]+",
}


def markdown_measures(markdown: Column) -> dict[str, Column]:
    """Twelve counters of a Markdown text; sections and code_snippets are other names of headings and code_blocks."""
    n = {k: F.regexp_count(markdown, F.lit(p)).cast("bigint") for k, p in MEASURES.items()}
    rules = F.filter(F.transform(F.split(markdown, "\n"), lambda x: F.trim(x)), lambda x: x.contains("|") & x.contains("-") & x.rlike(r"^[|: -]+$"))
    fences = F.floor(F.regexp_count(markdown, F.lit("```")) / 2).cast("bigint")
    return {
        "lines": F.regexp_count(markdown, F.lit("\n")).cast("bigint"), "words": F.regexp_count(markdown, F.lit(r"\S+")).cast("bigint"), "chars": F.length(markdown).cast("bigint"),
        "sections": n["headings"], "headings": n["headings"], "pictures": n["pictures"], "code_snippets": fences, "code_blocks": fences, "lists": n["lists"],
        "tables": F.size(rules).cast("bigint"), "urls": n["links"] + n["autolinks"] + n["bare"], "blockquotes": n["blockquotes"],
    }


def infer_title(markdown: Column, path: Column) -> Column:
    """The first top heading, else the file's name in title case."""
    h1 = F.trim(F.regexp_extract(markdown, r"(?m)^#[ \t]+(.+?)[ \t]*$", 1))
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1), "[-_]+", " ")
    return F.when(F.coalesce(h1, F.lit("")) != "", h1).otherwise(F.initcap(stem))
