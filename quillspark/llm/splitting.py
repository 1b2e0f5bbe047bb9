"""Splitting oversized texts at natural boundaries.

Method: agglomerative merging. A text is cut into atomic segments; a heap holds the adjacent
pairs, and the pair at the weakest boundary is merged first (then the smallest pair, then the
first) as long as its size and the overlap stay under the limit. Sizes are tokens of the
whole text's encoding, so sums are exact.

Defined results: texts of at most ``max_tokens`` tokens, null and empty texts have no pieces;
a segment without any boundary that exceeds the limit is cut between tokens; pieces follow
each other without gap, and each but the first repeats the last ``overlap`` tokens before it.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.tokens import TOKENIZER, Tokenizer, tokenizer

#: how strong a boundary is, from a blank between words to the start of a heading
WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH, HEADING = range(6)
_BOUNDARY = re.compile(r"\n[^\S\n]*\n\s*|\n+|(?<=[.!?…])(?=\s)|(?<=[。！？])|(?<=[,;:])(?=\s)|(?<=[，、；：])")
_HEADING = re.compile(r"#{1,6}\s|h[1-6]\.\s")
#: tokens left free for what an encoding of the piece alone may add at its edges
SLACK = 8


def _boundaries(text: str) -> list[tuple[int, int]]:
    """(character, strength) of the natural boundaries inside the text, in order."""
    found: dict[int, int] = {}
    for m in _BOUNDARY.finditer(text):
        at = m.end()
        if not 0 < at < len(text):
            continue
        if m.group(0).count("\n") > 1:
            strength = HEADING if _HEADING.match(text, at) else PARAGRAPH
        elif m.group(0):
            strength = HEADING if _HEADING.match(text, at) else LINE
        else:
            strength = SENTENCE if text[at - 1] in ".!?…。！？" else CLAUSE
        found[at] = max(strength, found.get(at, 0))
    return sorted(found.items())


def _token_starts(text: str, tok: Tokenizer) -> tuple[list[int], list[int]]:
    """(first characters, numbers) of the tokens that begin at a character, and the end."""
    pieces = tok.encoding.decode_tokens_bytes(tok.encode(text))
    if text.isascii():
        starts = [0]
        for p in pieces:
            starts.append(starts[-1] + len(p))
        return starts, list(range(len(starts)))
    starts, numbers, chars = [], [], 0
    for i, p in enumerate(pieces):
        if p and p[0] & 0xC0 != 0x80:
            starts.append(chars)
            numbers.append(i)
        chars += sum(1 for b in p if b & 0xC0 != 0x80)
    return starts + [chars], numbers + [len(pieces)]


def split_text(text: str, max_tokens: int, overlap: int, tok: Tokenizer) -> list[dict]:
    """The pieces (piece_no, n_tokens, overlap_tokens, char_start, body_start, char_end, text), or none
    if the text does not exceed the limit."""
    starts, numbers = _token_starts(text, tok)
    total = numbers[-1]
    if total <= max_tokens:
        return []
    room = max(1, max_tokens - overlap - SLACK)
    at_char = dict(zip(starts, numbers))
    # Atomic segments end at boundaries that are also token starts.
    cuts = [(at_char[c], s) for c, s in _boundaries(text) if c in at_char and 0 < at_char[c] < total]
    ends, marks = [], []  # token ends of the segments; strength of the boundary after each
    prev = 0
    for end, strength in [*cuts, (total, HEADING)]:
        while end - prev > room:  # no boundary near enough: cut at a blank, else between tokens
            hi = bisect_right(numbers, prev + room) - 1
            lo = max(bisect_left(numbers, prev + 1), hi - 200)
            k = next((j for j in range(hi, lo - 1, -1) if text[starts[j] : starts[j] + 1].isspace()), hi)
            k = max(k, bisect_left(numbers, prev + 1))
            ends.append(numbers[k])
            marks.append(WORD)
            prev = numbers[k]
        if end > prev:
            ends.append(end)
            marks.append(strength)
            prev = end
    n = len(ends)
    begin = [0, *ends[:-1]]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    finish = list(ends)
    alive = [True] * n
    version = [0] * n
    heap = [(marks[i], finish[i + 1] - begin[i], i, i + 1, 0, 0) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        _, size, i, j, vi, vj = heapq.heappop(heap)
        if not (alive[i] and alive[j] and version[i] == vi and version[j] == vj) or size > room:
            continue
        finish[i], marks[i], alive[j] = finish[j], marks[j], False
        after[i] = after[j]
        version[i] += 1
        if after[i] < n:
            before[after[i]] = i
            k = after[i]
            heapq.heappush(heap, (marks[i], finish[k] - begin[i], i, k, version[i], version[k]))
        if before[i] >= 0:
            k = before[i]
            heapq.heappush(heap, (marks[k], finish[i] - begin[k], k, i, version[k], version[i]))
    if after[0] < n and finish[0] < overlap:  # the second piece could not repeat enough
        j = after[0]
        more = [e for e in ends if overlap <= e <= room and finish[0] < e < finish[j]]
        if more:
            finish[0] = begin[j] = more[0]
    first_char = dict(zip(numbers, starts))
    out = []
    for i in range(n):
        if not alive[i]:
            continue
        lead = numbers[bisect_left(numbers, max(0, begin[i] - overlap))] if begin[i] else 0
        a, b = first_char[lead], first_char[finish[i]]
        out.append({
            "piece_no": len(out) + 1, "n_tokens": finish[i] - lead, "overlap_tokens": begin[i] - lead,
            "char_start": a, "body_start": first_char[begin[i]], "char_end": b, "text": text[a:b],
        })
    return out


SCHEMA = "piece_no bigint, n_tokens bigint, overlap_tokens bigint, char_start bigint, body_start bigint, char_end bigint, text string"


def split_documents(documents: DataFrame, max_tokens: int, overlap: int, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece_no, n_tokens, overlap_tokens, char_start, body_start, char_end, text) of the
    documents over the limit. A token holds a byte at least, so texts of fewer bytes are left out
    before they reach Python."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(path)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                if tok.count(text) > max_tokens:
                    rows += [{"doc_id": doc, **p} for p in split_text(text, max_tokens, overlap, tok)]
            if rows:
                yield pd.DataFrame(rows)

    rows = documents.where(F.octet_length("text") > max_tokens).select("doc_id", "text")
    return rows.mapInPandas(run, f"doc_id {dict(documents.dtypes)['doc_id']}, {SCHEMA}")
