"""Evaluation passages that leaked into documents.

Method: one Aho-Corasick automaton over the normalised words of all test questions and
answers, and one scan of each text. The automaton's patterns are the pairs of neighbouring words of
which one at least stands in few items. Around an item's hits the text's words are aligned with
the passage in order; a place that holds half of the passage's words is a candidate. The same scan counts in
how many documents the passages' words stand, so that the candidates are judged afterwards, without
the texts: a share of the passage's distinctive words must be held, so that the
same phrasing with other names, or stock sentences, do not count. Distinctive are words in few
items that stand in few documents, those aside that hold the word next to its neighbour in the
passage: a leak into many documents raises the count of its words, but not this one. The share
is taken over the passage or over its densest half in the document, so that a leaked part is
judged by its own words. Matches map back to characters of the original.

Defined results: null and empty texts and passages match nothing; a passage under four words
must stand whole and together; the same document and item come out once, at their best place; a match
of the question alone is no leak, its share is reported beside a leak; of several passages under one
item_id the longest counts. Items are taken in blocks of ITEM_BLOCK, each scanned against all documents.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import written

#: items that one automaton holds at most; a larger test set is scanned for in several blocks
ITEM_BLOCK = 100_000
#: a passage of fewer words has to stand whole
WHOLE_BELOW = 4
_WORD = re.compile(r"[^\W_]+")
_NO_WORD = re.compile(r"[\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def rare_items(n: int) -> int:
    return max(2, n // 100)


def in_order(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[str, int] = defaultdict(int)
    for i, w in enumerate(a):
        masks[w] |= 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if w in masks:
            u = row & masks[w]
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def aligned(a: list[str], b: list[str]) -> list[int]:
    """The positions in ``a`` of one longest common subsequence, ascending."""
    masks: dict[str, int] = defaultdict(int)
    for i, w in enumerate(a):
        masks[w] |= 1 << i
    full = (1 << len(a)) - 1
    rows = [full]
    for w in b:
        row = rows[-1]
        u = row & masks.get(w, 0)
        rows.append(((row + u) | (row - u)) & full)
    out, i, j = [], len(a), len(b)
    while i and j:
        bit = 1 << (i - 1)
        if rows[j] & bit:
            i -= 1
        elif rows[j - 1] & bit:
            out.append(i - 1)
            i, j = i - 1, j - 1
        else:
            j -= 1
    return out[::-1]


@dataclass
class Items:
    """The test items of a block and the automaton's patterns."""

    passages: dict[int, list[str]]
    questions: dict[int, list[str]]
    item_df: dict[str, int]  # items, of all blocks, whose passage or question holds the word
    n_items: int
    own: dict[int, set[str]] = field(default_factory=dict)  # words of few items
    pairs: dict[int, set[tuple[str, str]]] = field(default_factory=dict)
    patterns: dict[str, list[tuple[int, bool]]] = field(default_factory=lambda: defaultdict(list))  # text -> (item, of the passage)
    share: float = 0.5
    min_pairs: int = 3

    def __post_init__(self):
        rare = rare_items(self.n_items)
        for item, p in self.passages.items():
            own = {w for w in p if self.item_df[w] <= rare}
            self.own[item] = own
            self.pairs[item] = set(zip(p, p[1:]))
            if len(p) < WHOLE_BELOW:
                self.patterns[f" {' '.join(p)} "].append((item, True))
                continue
            for a, b in self.pairs[item]:
                if len(own) < 4 or a in own or b in own:  # a passage of common words only: all its pairs count
                    self.patterns[f" {a} {b} "].append((item, True))
        for item, q in self.questions.items():
            for a, b in set(zip(q, q[1:])):
                if self.item_df[a] <= rare or self.item_df[b] <= rare:
                    self.patterns[f" {a} {b} "].append((item, False))


def automaton(patterns: dict[str, list]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for pattern, owners in patterns.items():
        made.add_word(pattern, (pattern, owners))
    if patterns:
        made.make_automaton()
    return made


class Scanner:
    """Reads each text once: its candidate places, and the counts that judge them."""

    def __init__(self, items: Items):
        self.items = items
        self.automaton = automaton(items.patterns)
        self.vocab = {w for p in items.passages.values() for w in p}
        self.counts: Counter = Counter()  # documents by passage word
        self.beside: Counter = Counter()  # documents by item and word beside its neighbour of the passage
        self.asked = Counter(item for owners in items.patterns.values() for item, passage in owners if not passage)
        self.n_docs = 0

    def places(self, text: str) -> list[tuple[int, float, float, int, int, str]]:
        """(item, share of words, share of the question, first and last character, the place's words)."""
        items = self.items
        low = text.lower()
        flat = f" {_NO_WORD.sub(' ', low)} "
        doc = flat.split()
        held = set(doc)
        self.n_docs += 1
        self.counts.update(self.vocab & held)
        if not items.patterns:
            return []
        hits: dict[int, list[int]] = defaultdict(list)
        asked: Counter = Counter()
        beside, seen = set(), set()
        for end, (pattern, owners) in self.automaton.iter(flat):
            fresh = pattern not in seen
            seen.add(pattern)
            for item, passage in owners:
                if passage:
                    hits[item].append(end)
                    if fresh:
                        beside.update((item, w) for w in pattern.split() if w in items.own[item])
                elif fresh:
                    asked[item] += 1
        self.beside.update(beside)
        starts, out, spans = None, [], None
        for item, ends in hits.items():
            passage = items.passages[item]
            if sum(map(held.__contains__, passage)) < items.share * len(passage):  # no place can hold more
                continue
            if starts is None:
                starts, at = [], 1
                for w in doc:
                    starts.append(at)
                    at += len(w) + 1
            for share, i, j in self._around(item, ends, doc, starts):
                spans = spans or _spans(text, low)
                a, b = (spans[i][0], spans[j - 1][1]) if j <= len(spans) else (-1, -1)
                out.append((item, share, asked[item] / max(1, self.asked[item]), a, b, " ".join(doc[i:j])))
        return out

    def _around(self, item: int, ends: list[int], doc: list[str], starts: list[int]) -> Iterator[tuple[float, int, int]]:
        """Places around the hits, which end before the characters ``ends`` of the flattened text."""
        passage, pairs = self.items.passages[item], self.items.pairs[item]
        n = len(passage)
        hits = [bisect_left(starts, e) - 2 for e in ends]  # the pair's first word, as hits come in order
        if n < WHOLE_BELOW:
            yield from ((1.0, h + 2 - n, h + 2) for h in hits)
            return
        lo = hi = 0
        for k, h in enumerate(hits):  # windows of a passage's length on both sides, joined where they meet
            if k == 0:
                lo = max(0, h - n)
            hi = min(len(doc) - 1, h + n)
            if k + 1 < len(hits) and hits[k + 1] - n <= hi:
                continue
            at = [i for i in range(lo, hi) if (doc[i], doc[i + 1]) in pairs]
            yield from self._clusters(passage, at, doc)
            if k + 1 < len(hits):
                lo = max(0, hits[k + 1] - n)

    def _clusters(self, passage: list[str], hits: list[int], doc: list[str]) -> Iterator[tuple[float, int, int]]:
        n, start = len(passage), 0
        for k in range(1, len(hits) + 1):
            if k < len(hits) and hits[k] - hits[k - 1] <= max(12, n // 2):
                continue
            first, last, size = hits[start], hits[k - 1], k - start
            start = k
            if size < self.items.min_pairs:
                continue
            i, j = max(0, first - n // 3), min(len(doc), last + n // 3 + 2)
            # a long run is taken in overlapping parts, each place of a passage's length lies in one
            for i, j in [(i, j)] if j - i <= 4 * n else [(max(0, h - n // 3), min(len(doc), h + 2 * n)) for h in range(first, last + 1, n)]:
                place = doc[i:j]
                if sum(map(set(place).__contains__, passage)) >= self.items.share * n:
                    share = in_order(passage, place) / n
                    if share >= self.items.share:
                        yield share, i, j


def _spans(text: str, low: str) -> list[tuple[int, int]]:
    """First and last character in ``text`` of each word of its lower-cased form ``low``."""
    found = [m.span() for m in _WORD.finditer(low)]
    if len(low) == len(text):
        return found
    at = [i for i, ch in enumerate(text) for _ in ch.lower()]
    return [(at[a], at[b - 1] + 1) for a, b in found] if len(at) == len(low) else []


@dataclass
class Judge:
    """Tells leaks from stock phrasing, by what the scan has counted."""

    items: Items
    doc_df: dict[str, int]  # documents that hold a passage's word
    n_docs: int
    doc_pairs: dict[tuple[int, str], int]  # documents that hold the word beside its neighbour of the item
    cold: dict[int, set[str]] = field(default_factory=dict)  # in few documents, leaks included
    special: dict[int, set[str]] = field(default_factory=dict)
    special_share: float = 0.3
    dense: float = 0.8  # share of words held in the densest half, if it is judged alone

    def __post_init__(self):
        rare = max(10, self.n_docs // 100)
        for item, p in self.items.passages.items():
            own = self.items.own[item]
            self.cold[item] = {w for w in own if self.doc_df.get(w, 0) <= rare}
            self.special[item] = {w for w in own if self.doc_df.get(w, 0) - self.doc_pairs.get((item, w), 0) <= rare}
            if len(self.special[item]) < 4:  # a passage of common words only: all its words count
                self.special[item] = set(p)

    def held(self, item: int, place: list[str]) -> float:
        """Share of distinctive words held: of the passage's, or of those of its densest half if that is more."""
        passage, cold, special = self.items.passages[item], self.cold[item], self.special[item]
        if len(passage) < WHOLE_BELOW:
            return 1.0
        judge = cold if len(cold) >= 4 else special
        rare = [w for w in passage if w in judge]
        held = in_order(rare, [w for w in place if w in judge]) / len(rare)
        if held >= self.special_share or special <= cold:
            return held
        at = aligned(passage, place)
        need = math.ceil(self.items.share * len(passage))
        k = min(range(len(at) - need + 1), key=lambda k: at[k + need - 1] - at[k])
        found, part = set(at), range(at[k], at[k + need - 1] + 1)
        hot = [i in found for i in part if passage[i] in special]
        few = [i in found for i in part if passage[i] in cold]
        # Other names than the passage's are no leak, however much of its phrasing is there.
        if need < self.dense * len(part) or len(hot) < 4 or few and sum(few) < self.special_share * len(few):
            return held
        return max(held, sum(hot) / len(hot))


def item_blocks(golden: DataFrame) -> Iterator[Items]:
    """The items, at most about ITEM_BLOCK at a time; how many items hold a word is counted over all of them."""
    rows = golden.where(F.length("passage") > 0).groupBy("item_id").agg(F.max(F.struct(F.length("passage").alias("n"), "passage", "query_text")).alias("m"))
    rows = rows.select("item_id", "m.passage", "m.query_text")
    n_items = rows.count()
    blocks = max(1, -(-n_items // ITEM_BLOCK))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            df = Counter(w for p, q in zip(pdf["passage"], pdf["query_text"]) for w in {*words(p), *words(q)})
            yield pd.DataFrame(list(df.items()), columns=["word", "n"])

    df = rows.mapInPandas(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        passages, questions = {}, {}
        for r in part.collect():  # a block
            if p := words(r["passage"]):
                passages[r["item_id"]], questions[r["item_id"]] = p, words(r["query_text"])
        vocab = sorted({w for held in (passages, questions) for p in held.values() for w in p})
        if blocks == 1:
            item_df = Counter(w for k, p in passages.items() for w in {*p, *questions[k]})
        else:
            wanted = golden.sparkSession.createDataFrame([(w,) for w in vocab], "word string")
            item_df = {r["word"]: r["n"] for r in df.join(wanted, "word").collect()}  # the block's words
        yield Items(passages, questions, item_df, n_items)


def _scanned(documents: DataFrame, items: Items) -> DataFrame:
    """Candidate places (doc_id, item_id, place, ..), and a row per task and passage word with its count ``n`` of documents."""
    doc_type = dict(documents.dtypes)["doc_id"]
    shared = documents.sparkSession.sparkContext.broadcast(items)  # bounded by ITEM_BLOCK
    columns = ["doc_id", "item_id", "share", "question_share", "char_start", "char_end", "place", "word", "n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(shared.value)
        for pdf in batches:
            rows = [(d, *m, None, None) for d, t in zip(pdf["doc_id"], pdf["text"]) for m in scanner.places(t)]
            if rows:
                yield pd.DataFrame(rows, columns=columns)
        counts = [(None, None, None, w, k) for w, k in scanner.counts.items()] + [(None, item, None, w, k) for (item, w), k in scanner.beside.items()]
        rows = [(d, i, None, None, None, None, p, w, k) for d, i, p, w, k in [*counts, (None, None, None, "", scanner.n_docs)]]
        yield pd.DataFrame(rows, columns=columns)

    rows = documents.where(F.length("text") > 0).select("doc_id", "text")
    return rows.mapInPandas(run, f"doc_id {doc_type}, item_id bigint, share double, question_share double, char_start bigint, char_end bigint, place string, word string, n bigint")


def _judged(documents: DataFrame, items: Items) -> DataFrame:
    found = written(_scanned(documents, items))
    # A row per word, and per item and word beside its neighbour: bounded by the block's passages.
    totals = found.where("word is not null").groupBy("item_id", "word").agg(F.sum("n").alias("n")).collect()
    doc_df = {r["word"]: r["n"] for r in totals if r["item_id"] is None}
    n_docs = doc_df.pop("", 0)
    judge = Judge(items, doc_df, n_docs, {(r["item_id"], r["word"]): r["n"] for r in totals if r["item_id"] is not None})
    shared = documents.sparkSession.sparkContext.broadcast(judge)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = shared.value
        for pdf in batches:
            held = [judge.held(i, p.split()) for i, p in zip(pdf["item_id"], pdf["place"])]
            pdf = pdf.drop(columns="place").assign(special_share=held)
            yield pdf[pdf["special_share"] >= judge.special_share]

    columns = ["doc_id", "item_id", "share", "question_share", "char_start", "char_end"]
    places = found.where("place is not null").select(*columns, "place")
    schema = ", ".join(f"{c} {t}" for c, t in found.dtypes if c in columns) + ", special_share double"
    return places.mapInPandas(run, schema)


def leaked_items(documents: DataFrame, golden: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, special_share, question_share, char_start, char_end) of the documents that hold passages.

    The characters bound the region of the original text that was aligned; they are -1 where
    lower-cased characters cannot be mapped back.
    """
    leaks = reduce(DataFrame.unionByName, [_judged(documents, items) for items in item_blocks(golden)])
    best = leaks.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "special_share", "question_share", (-F.col("char_start")).alias("first"), "char_end")).alias("m"))
    return best.select("doc_id", "item_id", "m.share", "m.special_share", "m.question_share", (-F.col("m.first")).alias("char_start"), F.col("m.char_end").alias("char_end"))
