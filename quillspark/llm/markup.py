"""Markup residue: which kinds a text holds, and clean text with its structure kept.

Method: equivalence-class template deduction over the pages of a space (the host). The blocks that hold
markup are cut into tokens: markup tokens and words. Tokens with equal occurrence vectors over the space's pages
form a class; a class is valid if its tokens come in one order wherever they occur and its openers and
closers nest in that order. Valid classes whose occurrences lie within another's are nested into
it, and the text between the tokens of a class are the template's slots (``template_slots``).
A construct that stands once on a page has no partner and no vector to share (an entity, a formula, an
emphasis), so a grammar of the notations decides for those; ``markup_ways`` says by which of the two a
block's markup was found. Names in angle brackets that the grammar does not know are markup only as
opener and closer of a valid class.

Defined results: null and empty texts hold no markup; code spans, list marks, numbering,
``>`` marks, pipe tables, ``<br />`` inside a cell and placeholders are no markup; code
blocks are left as they are; copies of a block count once; unknown names in angle
brackets without a class are text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.convert import Page
from quillspark.session import written


# Element names of HTML, macro names of wikis and commands of LaTeX.
HTML_TAGS = (
    "a abbr acronym address article aside audio b base big blockquote body br button canvas caption center cite code col colgroup dd del details dfn div dl dt em embed "
    "fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol "
    "option p picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr tt u ul var video wbr"
).split()
WIKI_MACROS = "color panel info note tip warning excerpt code noformat quote expand toc section column anchor status jira include children gallery attachments html".split()

_KNOWN_TAGS = set(HTML_TAGS)
_TAGS = "|".join(sorted(HTML_TAGS, key=len, reverse=True))
_MACROS = "|".join(WIKI_MACROS)
_WORDY = r"[^\W_]"  # what an emphasis begins and ends next to

#: (kind, form, pattern); each match is a whole construct or one token of a pair
GRAMMAR: list[tuple[str, str, str]] = [
    ("html", "comment", r"<!--.*?-->"),
    ("html", "tag", rf"(?:</?(?:{_TAGS})|(?<!\w)</?(?:{_TAGS.upper()}))(?=[\s/>])(?:\s+[\w:-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*\s*/?>"),
    ("html", "namespaced", r"</?[A-Za-z][\w-]*:[A-Za-z][\w-]*(?:\s[^<>]*)?/?>"),
    ("html", "entity", r"&(?:[A-Za-z][A-Za-z0-9]{1,20}|#\d{1,7}|#[xX][0-9a-fA-F]{1,6});"),
    ("latex", "environment", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\]|\{[^{}\n]*\})?"),
    ("latex", "command", r"\\(?:(?:part|chapter|section|subsection|subsubsection|paragraph|subparagraph|textbf|textit|texttt|textsc|textrm|textsf|text|emph|underline|footnote|cite[pt]?|ref|eqref|label|caption|href|url|frac|sqrt|mathbf|mathrm|mathcal|includegraphics|usepackage|documentclass|title|author|input|vspace|hspace)\*?(?:\[[^\]\n]*\])?\{|item(?![A-Za-z]))"),
    ("latex", "display", r"\$\$[^$]+\$\$|\\\[.+?\\\]|\\\(.+?\\\)"),
    ("latex", "inline", r"(?<![\w$\\])\$(?=[^\s\d$])(?:[^$\n]*?(?:\\[A-Za-z]+|[_^=+<>])[^$\n]*?)(?<!\s)\$(?![\w$])|(?<![\w$\\])\$[A-Za-z]\$(?![\w$])"),
    ("latex", "quotes", r"``[^`'\n]+''"),
    ("wiki", "macro", rf"\{{(?:{_MACROS})(?:[:|][^{{}}\n]*)?\}}"),
    ("wiki", "link", r"\[\[[^\[\]\n]+\]\]|\[[^\[\]\n|]+\|[^\[\]\n|\s]+\](?!\()"),
    ("wiki", "heading", r"(?m:^\s*h[1-6]\.\s+\S)|(?m:^={2,6}[ \t]*[^=\s][^=\n]*?={2,6}[ \t]*$)"),
    ("wiki", "quote", r"(?m:^bq\.\s+\S)"),
    ("wiki", "emphasis", r"'''[^'\n]+'''|(?<![`'\w])''(?!')[^`'\n]+''(?!')"),
    ("wiki", "table head", r"(?m:^\|\|[^|\n]+\|\|)"),
    ("wiki", "image", r"(?<![\w!])![^\s!|]+\.\w{2,4}(?:\|[^!\n]*)?!"),
    ("markdown", "image", r"!\[[^\]\n]*\]\([^()\n]*\)"),
    ("markdown", "link", r"(?<![\w!\]])\[[^\[\]\n]+\]\([^()\s]+(?:\s+\"[^\"\n]*\")?\)"),
    ("markdown", "reference", r"(?<![\w!\]])\[[^\[\]\n]+\]\[[^\[\]\n]*\]|(?m:^\[[^\]\n]+\]:\s+\S+)"),
    ("markdown", "footnote", r"\[\^[^\]\s]+\]"),
    ("markdown", "heading", r"(?m:^#{1,6}[ \t]+\S)|(?m:^\S[^\n]*\n(?:={3,}|-{3,})[ \t]*$)"),
    ("markdown", "rule", r"(?m:^[ \t]*(?:\*[ \t]*){3,}$|^[ \t]*(?:_[ \t]*){3,}$|(?<=\n\n)[ \t]*(?:-[ \t]*){3,}$)"),
    ("markdown", "fence", r"(?m:^(?:```|~~~)[^`\n]*$)"),
    ("markdown", "strong", rf"(?<![\w*])\*{{1,3}}(?=[^\s*])[^*\n]*?(?<=[^\s*])\*{{1,3}}(?![\w*])|(?<![\w_])_{{2,3}}(?=[^\s_])[^_\n]*?(?<=[^\s_])_{{2,3}}(?![\w_])|(?<![\w_])_(?=[^\s_])[^_\n|]+?(?<=[^\s_])_(?![\w_])"),
    ("markdown", "strike", r"~~(?=\S)[^~\n]+~~"),
]
#: what a text must hold, one of them, for a form to be looked for
NEEDS = {
    "comment": "<!--", "tag": "<", "namespaced": "<", "entity": "&", "environment": "\\", "command": "\\", "display": ("$$", "\\[", "\\("), "inline": "$", "quotes": "``", "macro": "{", "link": "[",
    "quote": "bq.", "emphasis": "''", "table head": "||", "reference": "[", "footnote": "[^", "fence": ("```", "~~~"), "strike": "~~", ("wiki", "image"): "!", ("markdown", "image"): "![",
    ("wiki", "heading"): ("h1.", "h2.", "h3.", "h4.", "h5.", "h6.", "=="), ("markdown", "heading"): ("#", "===", "---"), "rule": ("*", "_", "---"), "strong": ("*", "_"),
}


def _needs(kind: str, form: str) -> tuple[str, ...]:
    held = NEEDS.get((kind, form)) or NEEDS[form]
    return (held,) if isinstance(held, str) else held


_GRAMMAR = [(kind, form, _needs(kind, form), re.compile(p, re.S if form in ("comment", "display") else 0)) for kind, form, p in GRAMMAR]
#: tags of names that the grammar does not know; only a class makes them markup
_UNKNOWN = re.compile(r"</?([A-Za-z][A-Za-z0-9-]*)>")
_WORD = re.compile(r"[^\W_]+")
#: forms that stand alone; a tag, macro or environment needs its partner, a class or the list below
_VOID = re.compile(r"<(?:br|hr|img|input|wbr|meta|link|col)\b|/>\Z", re.I)
# A table cell's line break, code spans and placeholders are blanked before lexing.
_CELL_BREAK = re.compile(r"<br\s*/?>", re.I)
_CODE_SPAN = re.compile(r"(?<!`)`(?!`)[^`\n]+`(?!`)")
_TEMPLATE = re.compile(r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|%[A-Z][A-Z_]{2,30}%|@@[A-Z_]+@@")
#: a text without any of these characters holds no markup; the scan leaves it out
PREFILTER = r"<[!/A-Za-z]|&[#A-Za-z]|\\[A-Za-z\[(]|\$|\{|\[|\*|__|(?<![\p{L}\p{N}])_|~~|==|\|\||''|``|(?m)^(?:#|h[1-6]\.|bq\.)|!\S|\n-{3,}"


def _blank(m: re.Match) -> str:
    return " " * len(m.group(0))


def lex(text: str, content_type: str | None = None) -> list[tuple[str, str, int, int]]:
    """(kind, form, start, end) of the markup tokens, in order."""
    if "`" in text:
        text = _CODE_SPAN.sub(_blank, text)
    text = _TEMPLATE.sub(_blank, text)
    if content_type == "table":
        text = _CELL_BREAK.sub(_blank, text)
    found = []
    for kind, form, needs, pattern in _GRAMMAR:
        if not any(n in text for n in needs):
            continue
        for m in pattern.finditer(text):
            name = form
            if form in ("tag", "namespaced"):
                name = re.match(r"</?[\w:-]+", m.group(0)).group(0).lower()
                if _VOID.match(m.group(0)) or m.group(0).endswith("/>"):
                    name += "/"
            elif form == "macro":
                name = re.match(r"\{\w+", m.group(0)).group(0)
            elif form == "environment":
                name = re.match(r"\\(?:begin|end)\{\w+", m.group(0)).group(0)
            found.append((kind, name, m.start(), m.end()))
    found.sort(key=lambda t: (t[2], -t[3]))
    # What lies inside a formula belongs to it; a wiki link is no Markdown link.
    out, inside = [], -1
    for tok in found:
        if tok[2] < inside:
            continue
        out.append(tok)
        if tok[1] in ("display", "inline", "comment"):
            inside = tok[3]
    return out


def template_tokens(text: str, content_type: str | None = None) -> list[tuple[str | None, str, int, int]]:
    """(kind, form, start, end) in order: markup tokens, tags of unknown names (kind 'unknown') and words (kind null).
    Empty for a text that holds neither of the first two."""
    marks = lex(text, content_type)
    plain = _CODE_SPAN.sub(_blank, text) if "`" in text else text
    known = {m[2] for m in marks}
    marks += [("unknown", m.group(0)[:-1].lower(), m.start(), m.end()) for m in _UNKNOWN.finditer(plain) if m.start() not in known and m.group(1).lower() not in _KNOWN_TAGS]
    if not marks:
        return []
    marks.sort(key=lambda t: (t[2], -t[3]))
    out, at = [], 0
    for mark in [*marks, (None, "", len(text), len(text))]:
        out += [(None, w.group(0).lower(), w.start(), w.end()) for w in _WORD.finditer(text, at, max(at, mark[2]))]
        at = max(at, mark[3])
        if mark[0]:
            out.append(mark)
    return out


_TOKENS = "array<struct<kind:string, form:string, start:int, end:int>>"


def tokenised(blocks: DataFrame) -> DataFrame:
    """(doc_id, block_id, space, seq, tokens) of each distinct block that holds markup or tags of unknown names."""
    rows = blocks.where((F.coalesce(F.col("content_type"), F.lit("")) != "code") & F.col("text").rlike(PREFILTER))
    rows = rows.select("doc_id", "block_id", F.coalesce("space", F.lit("")).alias("space"), F.col("seq").cast("int").alias("seq"), "content_type", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tokens = [template_tokens(t, c) for t, c in zip(pdf["text"], pdf["content_type"])]
            at = [i for i, t in enumerate(tokens) if t]
            if at:
                yield pdf.iloc[at][["doc_id", "block_id", "space", "seq"]].assign(tokens=[[dict(zip(("kind", "form", "start", "end"), t)) for t in tokens[i]] for i in at])

    return rows.mapInPandas(run, f"doc_id string, block_id string, space string, seq int, tokens {_TOKENS}").distinct()


def equivalence_classes(tokens: DataFrame, min_pages: int = 2) -> DataFrame:
    """(space, kind, form, class_id, n_pages): tokens of one space with equal occurrence vectors, of classes that hold markup.

    The vector over pages is compared by the folded hashes of its entries and its two sums, so
    no vector is collected.
    """
    each = tokens.select("space", "doc_id", F.explode("tokens").alias("t")).select("space", "doc_id", "t.kind", "t.form")
    vector = each.groupBy("space", "kind", "form", "doc_id").agg(F.count("*").alias("n"))
    forms = vector.groupBy("space", "kind", "form").agg(
        F.count("*").alias("n_pages"), F.sum("n").alias("n_tokens"), F.expr("bit_xor(xxhash64(doc_id, n))").alias("vector")
    ).where(F.col("n_pages") >= min_pages)
    forms = forms.withColumn("class_id", F.xxhash64("vector", "n_pages", "n_tokens"))
    held = forms.groupBy("space", "class_id").agg(F.count("*").alias("k"), F.count("kind").alias("marks")).where("k >= 2 and marks >= 1")
    return forms.join(held.select("space", "class_id"), ["space", "class_id"], "left_semi").select("space", "kind", "form", "class_id", "n_pages")


def partner(form: str) -> str | None:
    """The form that closes an opening one, or opens a closing one."""
    if form.startswith("</"):
        return "<" + form[2:]
    if form.startswith("<") and not form.endswith("/"):
        return "</" + form[1:]
    if form.startswith("\\begin"):
        return form.replace("\\begin", "\\end")
    if form.startswith("\\end"):
        return form.replace("\\end", "\\begin")
    return None


def nests(forms: list[str]) -> bool:
    """Whether the openers and closers among the forms, in this order, close what was opened last."""
    open_: list[str] = []
    for form in forms:
        mate = partner(form)
        if mate is None:
            continue
        if form.startswith(("</", "\\end")):
            if not open_ or open_.pop() != mate:
                return False
        else:
            open_.append(form)
    return not open_


def class_occurrences(tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """(space, class_id, kind, form, doc_id, block_id, seq, pos, start, end, k): the tokens of classes, with the number of
    their occurrence in the page."""
    each = tokens.select("space", "doc_id", "block_id", "seq", F.posexplode("tokens").alias("pos", "t")).select("space", "doc_id", "block_id", "seq", "pos", "t.*")
    same = [F.col("o.space") == F.col("c.space"), F.col("o.form") == F.col("c.form"), F.col("o.kind").eqNullSafe(F.col("c.kind"))]
    rows = each.alias("o").join(classes.alias("c"), same).select("o.*", "c.class_id")
    by_place = Window.partitionBy("space", "class_id", "kind", "form", "doc_id").orderBy("seq", "block_id", "pos")
    return rows.withColumn("k", F.row_number().over(by_place))


def valid_classes(occurrences: DataFrame) -> DataFrame:
    """(space, class_id, sequence): classes whose tokens come in one order in every page and nest in it."""
    in_order = occurrences.groupBy("space", "class_id", "doc_id", "k").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "block_id", "pos", "kind", "form"))), lambda t: F.struct(t["kind"].alias("kind"), t["form"].alias("form"))).alias("sequence"))
    one = in_order.groupBy("space", "class_id").agg(F.min(F.xxhash64("sequence")).alias("a"), F.max(F.xxhash64("sequence")).alias("b"), F.first("sequence").alias("sequence")).where("a = b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[nests([t["form"] for t in seq if t["kind"]]) for seq in pdf["sequence"]]]

    columns = one.select("space", "class_id", "sequence")
    return columns.mapInPandas(run, columns.schema)


@dataclass
class Template:
    """What the classes of a table's spaces say: written tables of its tokens, its classes and their occurrences."""

    tokens: DataFrame
    classes: DataFrame
    occurrences: DataFrame  # of valid classes


def deduced(blocks: DataFrame, min_pages: int = 2) -> Template:
    tokens = written(tokenised(blocks))
    occurrences = written(class_occurrences(tokens, equivalence_classes(tokens, min_pages)))
    classes = written(valid_classes(occurrences))
    return Template(tokens, classes, occurrences.join(classes.select("space", "class_id"), ["space", "class_id"], "left_semi"))


def template_classes(template: Template) -> DataFrame:
    """(space, class_id, n_tokens, n_marks, n_pages, pattern): the valid classes, with their tokens in order."""
    pages = template.occurrences.groupBy("space", "class_id").agg(F.count_distinct("doc_id").alias("n_pages"))
    marks = F.size(F.filter("sequence", lambda t: t["kind"].isNotNull()))
    pattern = F.array_join(F.transform("sequence", lambda t: t["form"]), " ")
    return template.classes.select("space", "class_id", F.size("sequence").alias("n_tokens"), marks.alias("n_marks"), pattern.alias("pattern")).join(pages, ["space", "class_id"])


def nested_slots(text: str, tokens: list[dict]) -> list[tuple[int, int, int, int, str]]:
    """(class, parent class or 0, slot number, depth, slot text) of the class occurrences that lie in one text.

    A slot is the text between two neighbouring tokens of an occurrence, without what lies in occurrences nested in it.
    """
    spans: dict[tuple[int, int], list[dict]] = {}
    for t in sorted(tokens, key=lambda t: (t["start"], -t["end"])):
        spans.setdefault((t["class_id"], t["k"]), []).append(t)
    whole = sorted(((v[0]["start"], -v[-1]["end"], key, v) for key, v in spans.items() if len(v) > 1), key=lambda x: x[:3])
    out, stack, inner = [], [], {}
    placed = []
    for start, end, key, parts in whole:
        while stack and stack[-1][1] < -end:  # closed before this one ends
            stack.pop()
        holder = next((h for h in reversed(stack) if any(a["end"] <= start and -end <= b["start"] for a, b in zip(h[2], h[2][1:]))), None)
        placed.append((key, holder[0] if holder else None, len(stack) if holder else 0, parts))
        if holder:
            inner.setdefault(holder[0], []).append((start, -end))
        stack.append((key, -end, parts))
    for key, holder, depth, parts in placed:
        for n, (a, b) in enumerate(zip(parts, parts[1:])):
            held, at = "", a["end"]
            for i, j in sorted(inner.get(key, [])):
                if at <= i and j <= b["start"]:
                    held, at = held + text[at:i], j
            held = (held + text[at : b["start"]]).strip()
            if held:
                out.append((key[0], holder[0] if holder else 0, n, depth, held))
    return out


def template_slots(blocks: DataFrame, template: Template) -> DataFrame:
    """(doc_id, block_id, class_id, parent_id, slot_no, depth, slot): the text in the slots of each block's templates."""
    held = template.occurrences.groupBy("doc_id", "block_id").agg(F.collect_set(F.struct("class_id", "k", "form", "start", "end")).alias("tokens"))
    rows = blocks.where(F.coalesce(F.col("content_type"), F.lit("")) != "code").select("doc_id", "block_id", "text").join(held, ["doc_id", "block_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(d, b, *slot) for d, b, text, toks in zip(pdf["doc_id"], pdf["block_id"], pdf["text"], pdf["tokens"]) for slot in nested_slots(text, list(toks))]
            yield pd.DataFrame(out, columns=["doc_id", "block_id", "class_id", "parent_id", "slot_no", "depth", "slot"])

    return rows.mapInPandas(run, "doc_id string, block_id string, class_id bigint, parent_id bigint, slot_no int, depth int, slot string").distinct()


def markup_ways(template: Template, unpaired: bool = True) -> DataFrame:
    """(doc_id, block_id, markup, way): the kinds of markup in each block; way 'class' if a token of the kind is of a valid class,
    else 'grammar'. Tags of unknown names count as 'html' in a class that holds opener and closer."""
    grammar = template.tokens.select("doc_id", "block_id", F.explode("tokens").alias("t"), "tokens").where("t.kind <> 'unknown'")
    grammar = (grammar if unpaired else grammar.where(_partnered())).select("doc_id", "block_id", F.col("t.kind").alias("markup"), F.lit(False).alias("by_class"))
    tokens = template.occurrences.where("kind is not null").select("doc_id", "block_id", F.when(F.col("kind") == "unknown", "html").otherwise(F.col("kind")).alias("markup"), F.lit(True).alias("by_class"))
    rows = grammar.unionByName(tokens).groupBy("doc_id", "block_id", "markup").agg(F.max("by_class").alias("c"))
    return rows.select("doc_id", "block_id", "markup", F.when(F.col("c"), "class").otherwise("grammar").alias("way"))


def _partnered() -> Column:
    """Whether the token ``t`` has its partner among the block's tokens, or needs none."""
    form = F.col("t.form")
    mate = (
        F.when(form.startswith("</"), F.concat(F.lit("<"), F.expr("substring(t.form, 3)"))).when(form.startswith("<") & ~form.endswith("/"), F.concat(F.lit("</"), F.expr("substring(t.form, 2)")))
        .when(form.startswith("\\begin"), F.replace(form, F.lit("\\begin"), F.lit("\\end"))).when(form.startswith("\\end"), F.replace(form, F.lit("\\end"), F.lit("\\begin")))
    )
    return mate.isNull() | F.array_contains(F.transform("tokens", lambda x: x["form"]), mate)


def markup_kinds(blocks: DataFrame, unpaired: bool = False) -> DataFrame:
    """(doc_id, block_id, markup): the kinds of markup in each block.

    ``unpaired``: a known tag or environment counts whether its partner stands in the block or not; else
    one without its partner counts only if a class holds both.
    """
    return markup_ways(deduced(blocks), unpaired).select("doc_id", "block_id", "markup")


# ---- clean text ---------------------------------------------------------------------

_RULES: list[tuple[re.Pattern, object]] = [
    (re.compile(r"<!--.*?-->", re.S), ""),
    (re.compile(r"<pre[^>]*>\s*(?:<code[^>]*>)?(.*?)(?:</code>)?\s*</pre>", re.S | re.I), lambda m: "\n```\n" + html.unescape(m.group(1)).strip("\n") + "\n```\n"),
    (re.compile(r"\{(?:code|noformat)(?::(\w+))?[^}]*\}(.*?)\{(?:code|noformat)\}", re.S), lambda m: f"\n```{m.group(1) or ''}\n{m.group(2).strip(chr(10))}\n```\n"),
    (re.compile(r"<code[^>]*>(.*?)</code>|\\texttt\{([^{}]*)\}", re.S | re.I), lambda m: f"`{html.unescape(m.group(1) or m.group(2) or '')}`"),
    (re.compile(r"\\\[(.+?)\\\]", re.S), lambda m: f"$${m.group(1)}$$"),
    (re.compile(r"\\\((.+?)\\\)", re.S), lambda m: f"${m.group(1)}$"),
    (re.compile(r"<h([1-6])[^>]*>(.*?)</h\1>", re.S | re.I), lambda m: f"\n{'#' * int(m.group(1))} {m.group(2).strip()}\n"),
    (re.compile(r"(?m)^\s*h([1-6])\.\s+(.*)$"), lambda m: f"{'#' * int(m.group(1))} {m.group(2)}"),
    (re.compile(r"(?m)^(={2,6})[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$"), lambda m: f"{'#' * len(m.group(1))} {m.group(2)}"),
    (re.compile(r"(?m)^(\S[^\n]*)\n={3,}[ \t]*$"), r"# \1"),
    (re.compile(r"\\(section|subsection|subsubsection|paragraph|chapter)\*?\{([^{}]*)\}"), lambda m: {"chapter": "#", "section": "#", "subsection": "##", "subsubsection": "###", "paragraph": "####"}[m.group(1)] + " " + m.group(2)),
    (re.compile(r"<li[^>]*>\s*(.*?)\s*(?=</li>|<li|</[uo]l>|\Z)(?:</li>)?", re.S | re.I), r"\n- \1"),
    (re.compile(r"(?:(?<=\S)[ \t]*|(?m:^)\s*)\\item(?![A-Za-z])(?:\[[^\]]*\])?\s*"), "\n- "),
    (re.compile(r"(?m)^(\*{2,})[ \t]+(?=\S)"), lambda m: "  " * (len(m.group(1)) - 1) + "- "),
    (re.compile(r"</?(?:ul|ol|dl|p|div|tr|table|tbody|thead|section|blockquote)\b[^>]*>|<(?:br|hr)\s*/?>|\\(?:begin|end)\{[^{}]*\}(?:\[[^\]\n]*\])?", re.I), "\n"),
    (re.compile(r"(^)?</?t[dh]\b[^>]*>", re.I | re.M), lambda m: " " if m.group(1) is None else ""),
    (re.compile(rf"</?(?:{_TAGS})(?=[\s/>])[^<>]*>|</?[A-Za-z][\w-]*:[A-Za-z][^<>]*>", re.I), ""),
    (re.compile(rf"\{{(?:{_MACROS})(?:[:|][^{{}}\n]*)?\}}"), ""),
    (re.compile(r"(?m)^bq\.\s+"), "> "),
    (re.compile(r"(?m)^\|\|(.+?)\|\|[ \t]*$"), lambda m: "| " + " | ".join(c.strip() for c in m.group(1).split("||")) + " |\n|" + " --- |" * len(m.group(1).split("||"))),
    (re.compile(r"!\[([^\]\n]*)\]\([^()\n]*\)"), r"\1"),
    (re.compile(r"(?<![\w!])!([^\s!|]+)\.\w{2,4}(?:\|[^!\n]*)?!"), r"\1"),
    (re.compile(r"\[\[(?:[^\[\]\n|]*\|)?([^\[\]\n|]+)\]\]"), r"\1"),
    (re.compile(r"(?<![\w!\]])\[([^\[\]\n|]+)\](?:\([^()\s]+(?:\s+\"[^\"\n]*\")?\)|\[[^\[\]\n]*\])"), r"\1"),
    (re.compile(r"\[\^[^\]\s]+\]"), ""),
    (re.compile(r"'''([^'\n]+)'''|''(?!')([^`'\n]+)''(?!')"), lambda m: m.group(1) or m.group(2)),
    (re.compile(r"``([^`'\n]+)''"), r'"\1"'),
    (re.compile(r"\\footnote\{([^{}]*)\}"), r" (\1)"),
    (re.compile(r"~?\\(?:cite[pt]?|ref|eqref|label)\{([^{}]*)\}"), r" \1"),
    (re.compile(r"\\(?:textbf|textit|textsc|textrm|textsf|emph|underline|text|caption)\{([^{}]*)\}"), r"\1"),
    (re.compile(r"(?<![\w*])\*{1,3}(?=[^\s*])([^*\n]*?)(?<=[^\s*])\*{1,3}(?![\w*])"), r"\1"),
    (re.compile(r"(?<![\w_])_{1,3}(?=[^\s_])([^_\n|]*?)(?<=[^\s_])_{1,3}(?![\w_])"), r"\1"),
    (re.compile(r"~~(?=\S)([^~\n]+)~~"), r"\1"),
    (re.compile(r"(?m)^[ \t]*(?:\*[ \t]*){3,}$"), ""),
]
_KEEP = re.compile(r"```.*?```|`[^`\n]+`|\$\$[^$]+\$\$|\$[^$\n]+\$", re.S)


#: rules that are applied until nothing is left, from the innermost command outwards
_NESTING = {i for i, (p, _) in enumerate(_RULES) if "textbf" in p.pattern or "footnote" in p.pattern}
_LIST_TAG = re.compile(r"<(/?)(ul|ol|table)\b[^<>]*>", re.I)
_HELD = re.compile("\x00(\\d+)\x00")


def _lists_and_tables(text: str) -> list[tuple[int, int]]:
    """The outermost lists and tables of HTML that are closed, in one pass over their tags."""
    closed: list[tuple[int, int]] = []
    open_: list[tuple[str, int]] = []
    for m in _LIST_TAG.finditer(text):
        name = m.group(2).lower()
        if not m.group(1):
            open_.append((name, m.start()))
        elif open_ and open_[-1][0] == name:
            start = open_.pop()[1]
            while closed and closed[-1][0] > start:  # inside this one
                closed.pop()
            closed.append((start, m.end()))
    return closed


def _structured(markup: str, kept: list[str]) -> str | None:
    """A list or table as Markdown with its rows, cells and numbers, by the page converter; code spans that were put
    aside are put back first. None for markup that it cannot read."""
    try:
        page = Page(_HELD.sub(lambda m: html.escape(kept[int(m.group(1))]), markup))
        page.rewrite(page.tree)
        return "\n" + "\n\n".join(page.blocks(page.tree)) + "\n"
    except Exception:  # noqa: BLE001 - the rules below still take its tags away
        return None


def clean_markup(text: str | None, content_type: str | None = None, unknown: frozenset[str] | set[str] = frozenset()) -> str | None:
    """Text without markup. Headings become ``#`` lines, items ``-`` or numbered lines, tables pipe tables, code stays fenced or in
    backticks, formulas stay between dollar signs, emphasis and links leave their words. ``unknown``: names of
    tags that a template's classes have shown to be markup."""
    if not text or content_type == "code":
        return text
    kept: list[str] = []

    def hold(m: re.Match) -> str:
        kept.append(m.group(0))
        return f"\x00{len(kept) - 1}\x00"

    out = _CODE_SPAN.sub(hold, text)
    if content_type == "table":
        out = _CELL_BREAK.sub(hold, out)
    for start, end in reversed(_lists_and_tables(out)) if "<" in out else ():
        if (made := _structured(out[start:end], kept)) is not None:
            kept.append(made)
            out = f"{out[:start]}\x00{len(kept) - 1}\x00{out[end:]}"
    if unknown and "<" in out:
        out = _UNKNOWN.sub(lambda m: "" if m.group(1).lower() in unknown else m.group(0), out)
    for i, (pattern, by) in enumerate(_RULES):
        while True:  # commands may hold commands
            once = pattern.sub(by, out)
            if once == out or i not in _NESTING:
                break
            out = once
        out = once
        if i == 5:  # code and formulas are whole now; the rest must not touch them
            out = _KEEP.sub(hold, out)
    if "&" in out:
        out = html.unescape(out)
    while "\x00" in out:
        restored = re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))] if int(m.group(1)) < len(kept) else "", out)
        out = restored if restored != out else out.replace("\x00", "")
    out = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", out))
    return out.strip("\n") if out != text else text


def cleaned_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks with ``text`` cleaned, tags of unknown names by the classes of the block's space; a block of
    placeholders alone is left to problem 2's operator."""
    schema = blocks.schema
    template = deduced(blocks)
    names = template.occurrences.where("kind = 'unknown'").groupBy("doc_id", "block_id").agg(F.collect_set(F.regexp_extract("form", r"^</?(.*)$", 1)).alias("_unknown"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = [frozenset() if n is None else frozenset(n) for n in pdf["_unknown"]]
            yield pdf.drop(columns="_unknown").assign(text=[clean_markup(t, c, n) for t, c, n in zip(pdf["text"], pdf["content_type"], held)])

    suspect = F.coalesce(F.col("text").rlike(PREFILTER), F.lit(False))
    marked = blocks.where(suspect).join(names, ["doc_id", "block_id"], "left").select(*blocks.columns, "_unknown")
    return blocks.where(~suspect).unionByName(marked.mapInPandas(run, schema))
