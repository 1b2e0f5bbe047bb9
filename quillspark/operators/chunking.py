"""Chunks of sections under an embedding budget.

The widths are column expressions. Joining lead-ins, pairing questions with answers,
packing and splitting carry state from block to block, so they run over the ordered
blocks of a section in one Arrow pass. A section of very many blocks is handed on in runs, so that it does not
become one task's memory. Runs are cut where no unit is open: whether a block opens a unit of its own, whatever
came before, shows from it and the block before it alone, so the chunks are those of the whole section.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.config import DEFAULT, Config
from quillspark.functions.text import LEAD_IN_FILE
from quillspark.session import written
from quillspark.tables import PROSE_TYPES

#: blocks of a section that a run begins with; it ends where the next block opens a unit
RUN_BLOCKS = 5_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_ITEM = re.compile(r"\s*(?:[-*+]|\d+\.)\s")
_FENCE = re.compile(r"(`{3,}|~{3,})")


def header_reserve(crumb: Column, section_type: Column, tags: Column, genre: Column, cfg: Config = DEFAULT) -> Column:
    """Characters kept free for the header of a section's chunks."""
    prefix = F.when(section_type == "content", F.length(crumb)).otherwise(F.length(crumb) + F.length(section_type) + 3)
    listed = F.array_join(F.filter(tags, lambda t: t != section_type), ", ")
    tag_len = F.when(F.length(listed) > 0, F.length(listed) + 6).otherwise(0)
    genre_len = F.when(genre != "general", F.length(genre) + 10).otherwise(0)
    return prefix + tag_len + genre_len + cfg.entity_reserve + cfg.header_slack


def width(reserve: Column, max_chars: Column | None = None, cfg: Config = DEFAULT) -> Column:
    most = F.coalesce(max_chars, F.lit(cfg.max_chunk_chars)) if max_chars is not None else F.lit(cfg.max_chunk_chars)
    return F.greatest(F.lit(cfg.min_width), F.least(most, F.lit(cfg.embed_char_budget) - reserve)).cast("int")


# ---- splitting ----------------------------------------------------------------------


def has_signal(text: str) -> bool:
    return re.search(r"[A-Za-z0-9]", text.replace("`", "")) is not None


def is_lead_in(text: str, longest: int) -> bool:
    t = text.strip()
    return bool(t) and len(t) <= longest and "\n" not in t and (t.endswith(":") or re.match(LEAD_IN_FILE.removeprefix("(?U)"), t) is not None)


def _packed(parts: list[str], glue: str, limit: int) -> Iterator[str]:
    """Parts joined greedily; a part over the limit comes out as it is."""
    held = ""
    for part in parts:
        if held and len(held) + len(glue) + len(part) > limit:
            yield held
            held = part
        else:
            held = held + glue + part if held else part
    if held:
        yield held


def split_prose(text: str, limit: int) -> list[str]:
    """Blank lines first, then sentences, then a hard cut; small neighbours share a piece."""
    out: list[str] = []
    held = ""
    for para in filter(None, (p.strip() for p in text.split("\n\n"))):
        units, glue = ([para], "\n\n") if len(para) <= limit else (_SENTENCE.split(para), " ")
        if glue == " " and held:
            out.append(held)
            held = ""
        for unit in units:
            if held and len(held) + len(glue) + len(unit) > limit:
                out.append(held)
                held = ""
            while len(unit) > limit:
                out.append(unit[:limit])
                unit = unit[limit:]
            held = held + glue + unit if held else unit
    return [p for p in [*out, held] if p.strip()]


def split_code(text: str, limit: int, language: str | None) -> list[str]:
    """Whole lines per piece; a fence around the code is put around each piece."""
    lines = text.split("\n")
    fence = _FENCE.match(lines[0].strip())
    opener, closer = "", ""
    if fence and len(lines) > 1 and lines[-1].strip().startswith(fence.group(1)):
        opener, closer, lines = lines[0], fence.group(1), lines[1:-1]
    room = max(1, limit - (len(opener) + len(closer) + 2 if opener else 0))
    pieces = []
    for piece in _packed([x for line in lines for x in ([line] if len(line) <= room else [line[i : i + room] for i in range(0, len(line), room)])], "\n", room):
        if piece.strip():
            pieces.append(f"{opener}\n{piece}\n{closer}" if opener else piece)
    return pieces


def split_list(text: str, limit: int) -> list[str]:
    """Whole items per piece, with the lines that go on; an item over the limit stays whole."""
    items: list[str] = []
    for line in text.split("\n"):
        if items and not _ITEM.match(line):
            items[-1] += "\n" + line
        else:
            items.append(line)
    return [p for p in _packed(items, "\n", limit) if p.strip()]


def with_overlap(pieces: list[str], sentences: int) -> list[str]:
    """Each piece begins with the last sentences of the one before."""
    out = pieces[:1]
    for before, piece in zip(pieces, pieces[1:]):
        tail = " ".join(s for s in _SENTENCE.split(before.strip())[-sentences:] if s).strip()
        out.append(f"{tail}\n\n{piece}" if tail else piece)
    return out


def split_block(text: str, limit: int, content_type: str, language: str | None, sentences: int = 0) -> list[str]:
    if len(text) <= limit:
        return [text]
    if content_type == "code":
        return split_code(text, limit, language)
    if content_type == "list":
        return split_list(text, limit)
    pieces = split_prose(text, limit)
    return with_overlap(pieces, sentences) if sentences > 0 and content_type != "table" and len(pieces) > 1 else pieces


def packable_types(cfg: Config) -> set[str]:
    return {*PROSE_TYPES, "code"} if cfg.merge_definitions else set(PROSE_TYPES) if cfg.merge_prose else set()


def ready_text(block: dict) -> str:
    """The block's trimmed text; empty for a block that gives no chunk."""
    text = (block["text"] or "").strip()
    return text if text and has_signal(text) else ""


def opens_unit(before: dict, block: dict, genre: str, limit: int, cfg: Config) -> bool:
    """Whether ``block`` opens a unit whatever came before ``before``, the ready block ahead of it."""
    text, last = ready_text(block), ready_text(before)
    if genre == "faq":
        return block["content_type"] == "paragraph" and text.endswith("?")
    packable = packable_types(cfg)
    if packable:  # what is held includes the block before
        return not {block["content_type"], before["content_type"]} <= packable or len(last) + 2 + len(text) > limit
    return not is_lead_in(last, cfg.lead_in_chars)


def section_units(blocks: list[dict], genre: str, limit: int, cfg: Config) -> Iterator[tuple[str, str, str | None, str]]:
    """(text, content type, language, id of the first block) of what is embedded together."""
    ready = [(text, b) for b in blocks if (text := ready_text(b))]
    if genre == "faq":
        group: list[str] = []
        first = ""
        for text, b in ready:
            if group and b["content_type"] == "paragraph" and text.endswith("?"):
                yield "\n\n".join(group), "paragraph", None, first
                group = []
            first = first if group else b["block_id"]
            group.append(text)
        if group:
            yield "\n\n".join(group), "paragraph", None, first
        return
    packable = packable_types(cfg)
    if packable:
        held, first = "", ""
        for text, b in ready:
            fits = b["content_type"] in packable
            if held and not (fits and len(held) + 2 + len(text) <= limit):
                yield held, "paragraph", None, first
                held = ""
            if fits:
                first = first if held else b["block_id"]
                held = f"{held}\n\n{text}" if held else text
            else:
                yield text, b["content_type"], b["language"], b["block_id"]
        if held:
            yield held, "paragraph", None, first
        return
    waiting: tuple[str, str] | None = None
    for n, (text, b) in enumerate(ready):
        if waiting:
            yield f"{waiting[0]}\n\n{text}", b["content_type"], b["language"], waiting[1]
            waiting = None
        elif is_lead_in(text, cfg.lead_in_chars) and n + 1 < len(ready):
            waiting = (text, b["block_id"])
        else:
            yield text, b["content_type"], b["language"], b["block_id"]


SCHEMA = "doc_id string, section_id string, chunk_id string, idx int, chunk_order int, content string, content_type string, language string"
_BLOCK = ("seq", "block_id", "content_type", "text", "language")
_FLAGS = ("merge_prose", "merge_definitions")


def _runs(blocks: DataFrame) -> DataFrame:
    """(doc_id, section_id, run_no, blocks): the blocks in order, RUN_BLOCKS sequence numbers at a time."""
    return blocks.groupBy("doc_id", "section_id", F.floor(F.col("seq") / RUN_BLOCKS).cast("bigint").alias("run_no")).agg(F.array_sort(F.collect_list(F.struct(*_BLOCK))).alias("blocks"))


def _joined_runs(runs: DataFrame, cfg: Config) -> DataFrame:
    """Runs of sections of several runs, cut anew: the blocks before the first that opens a unit go to the run before.

    Only the last ready block of a run, and whether a run holds a cut, cross from run to run.
    """
    runs = written(runs)
    flags = [f"{c} boolean" for c in _FLAGS]
    last_schema = "doc_id string, section_id string, run_no bigint, last struct<content_type: string, text: string>"

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ends = [next((b for b in reversed(list(bl)) if ready_text(b)), None) for bl in pdf["blocks"]]
            yield pdf[["doc_id", "section_id", "run_no"]].assign(last=[{"content_type": b["content_type"], "text": b["text"]} if b else None for b in ends])

    by_run = Window.partitionBy("doc_id", "section_id").orderBy("run_no")  # a row per RUN_BLOCKS blocks
    before = runs.select("doc_id", "section_id", "run_no", "blocks").mapInPandas(last, last_schema).select("doc_id", "section_id", "run_no", F.last("last", True).over(by_run.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    cut_schema = ", ".join(["doc_id string, section_id string, run_no bigint, part int, genre string, width int", *flags, f"blocks {dict(runs.dtypes)['blocks']}"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                bl, prev, at = list(r["blocks"]), r["before"], 0
                own = _own(cfg, r)
                while prev is not None and at < len(bl):
                    if ready_text(bl[at]):
                        if opens_unit(prev, bl[at], r["genre"], int(r["width"]), own):
                            break
                        prev = bl[at]
                    at += 1
                key = {k: r[k] for k in ("doc_id", "section_id", "run_no", "genre", "width", *_FLAGS)}
                out += [key | {"part": part, "blocks": b} for part, b in ((0, bl[:at]), (1, bl[at:])) if b]
            yield pd.DataFrame(out, columns=["doc_id", "section_id", "run_no", "part", "genre", "width", *_FLAGS, "blocks"])

    parts = written(runs.join(before, ["doc_id", "section_id", "run_no"]).mapInPandas(cut, cut_schema))
    in_order = Window.partitionBy("doc_id", "section_id").orderBy("run_no", "part")
    target = F.coalesce(F.last(F.when(F.col("part") == 1, F.col("run_no")), True).over(in_order), F.lit(-1))
    targets = parts.select("doc_id", "section_id", "run_no", "part").withColumn("target", target)
    merged = parts.join(targets, ["doc_id", "section_id", "run_no", "part"]).groupBy("doc_id", "section_id", F.col("target").alias("run_no"), "genre", "width", *_FLAGS)
    return merged.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("run_no", "part", "blocks"))), lambda p: p["blocks"])).alias("blocks"))


def _own(cfg: Config, row: dict) -> Config:
    """The configuration with the flags of the row's document."""
    return replace(cfg, merge_prose=bool(row["merge_prose"]), merge_definitions=bool(row["merge_definitions"]))


def chunks(blocks: DataFrame, sections: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(doc_id, section_id, chunk_id, idx, chunk_order, content, content_type, language).

    ``blocks``: doc_id, section_id, seq, block_id, content_type, text, language; ``sections``:
    doc_id, section_id, genre, width, and optionally merge_prose and merge_definitions, which else are those of ``cfg``.
    A piece without a letter or figure leaves a gap in idx. ``chunk_order`` is the place of the chunk's first
    block in its document. Sections without blocks, and blocks without a section, give no chunk.
    """
    wanted = sections.select("doc_id", "section_id", "genre", "width", *[F.col(f) if f in sections.columns else F.lit(getattr(cfg, f)).alias(f) for f in _FLAGS])
    long = blocks.groupBy("doc_id", "section_id").agg(F.max("seq").alias("m"), F.min("seq").alias("l")).where(F.floor(F.col("m") / RUN_BLOCKS) > F.floor(F.col("l") / RUN_BLOCKS)).select("doc_id", "section_id")
    rows = _runs(blocks).join(wanted, ["doc_id", "section_id"])
    if not (long := written(long)).isEmpty():
        columns = ["doc_id", "section_id", "run_no", "genre", "width", *_FLAGS, "blocks"]
        rows = rows.join(long, ["doc_id", "section_id"], "left_anti").select(columns).unionByName(_joined_runs(rows.join(long, ["doc_id", "section_id"], "left_semi"), cfg).select(columns))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                doc, section, limit, own = r["doc_id"], r["section_id"], int(r["width"]), _own(cfg, r)
                place = {b["block_id"]: b["seq"] for b in r["blocks"]}
                for text, kind, language, first in section_units(list(r["blocks"]), r["genre"], limit, own):
                    for idx, piece in enumerate(split_block(text, limit, kind, language, own.overlap_sentences)):
                        if has_signal(piece):
                            out.append((doc, section, f"{doc}_{section}_{first}_{idx}", idx, place[first], piece, kind, language))
            yield pd.DataFrame(out, columns=["doc_id", "section_id", "chunk_id", "idx", "chunk_order", "content", "content_type", "language"])

    return rows.mapInPandas(run, SCHEMA)


# ---- embed text ---------------------------------------------------------------------

#: code languages that the header may name
EMBED_LANGUAGES = "python java javascript typescript json yaml xml sql bash shell go rust c cpp csharp kotlin scala ruby php html css".split()


def embed_header(*, crumb: Column, section_type: Column, genre: Column, keywords: Column, tags: Column, depends_on: Column, exposes: Column) -> Column:
    """The parts before a chunk's text, joined by `` | ``; missing parts fall away.

    ``crumb`` is the breadcrumb array. Keywords that repeat a breadcrumb part or each other,
    whatever the case, tags that repeat the section type and unknown code languages are left out.
    """
    path = F.array_join(crumb, " > ")
    head = F.when(section_type == "content", F.when(path != "", path)).otherwise(F.when(path != "", F.concat(F.lit("["), section_type, F.lit("] "), path)).otherwise(F.concat(F.lit("["), section_type, F.lit("]"))))
    known = F.transform(crumb, lambda b: F.regexp_replace(F.lower(F.trim(b)), ":+$", ""))
    kw = F.filter(keywords, lambda k: ~F.array_contains(known, F.lower(k)))
    kw = F.filter(kw, lambda k, i: F.array_position(F.transform(kw, lambda x: F.lower(x)), F.lower(k)) == i + 1)
    shown = F.filter(tags, lambda t: (t != section_type) & (~t.startswith("lang:") | F.lower(F.regexp_replace(t, "^lang:", "")).isin(*EMBED_LANGUAGES)))

    def part(label: str, values: Column) -> Column:
        return F.when(F.size(values) > 0, F.concat(F.lit(label), F.array_join(values, ", ")))

    genre_part = F.when(genre != "general", F.concat(F.lit("genre: "), genre))
    return F.concat_ws(" | ", head, genre_part, part("keywords: ", kw), part("tags: ", shown), part("depends on: ", depends_on), part("exposes: ", exposes))


def table_summary(text: Column) -> Column:
    """The header of a pipe table and how many rows follow; text without a separator stays.

    A header of blank cells counts as the separator itself.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    is_rule = F.transform(lines, lambda x: F.regexp_replace(F.trim(F.replace(x, F.lit("|"), F.lit(""))), "[- :]", "") == "")
    at = F.array_position(is_rule, F.lit(True)).cast("int")
    note = F.concat(F.lit("\n(table, "), (F.size(lines) - at).cast("string"), F.lit(" data rows)"))
    return F.when(at > 0, F.concat(F.array_join(F.slice(lines, F.lit(1), at), "\n"), note)).otherwise(text)


def scoped_metadata(metadata: Column, content: Column) -> Column:
    """Values of ``raw_entities`` and ``ner:`` keys stay only if the chunk holds them."""
    return F.transform_values(metadata, lambda k, v: F.when((k == "raw_entities") | k.startswith("ner:"), F.filter(v, lambda x: F.contains(content, x))).otherwise(v))


def merged_keywords(entities: Column, phrases: Column, genre: Column) -> Column:
    """Key phrases after the entities of prose sections, without repeats in another case."""
    low = F.transform(entities, lambda e: F.lower(e))
    extra = F.filter(F.array_distinct(phrases), lambda p: ~F.array_contains(low, F.lower(p)))
    return F.when(genre == "general", entities).otherwise(F.concat(entities, extra))
