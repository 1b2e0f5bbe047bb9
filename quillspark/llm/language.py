"""Language of pages, documents and mixed-language segments.

Method: prediction by partial matching. One byte context tree per language holds the counts
of every context of up to ``ORDER`` bytes over the full byte alphabet; the escape of method C,
with exclusions, leads from a context to the next shorter one. The statistics are frozen after
training. A byte seen in its context has one code length; a byte not seen there costs what the
context's escape costs (which depends on the context alone) and then its code length in the
shorter context. The nodes of the trees therefore lie in two hash tables an order, one of
code lengths and one of escapes, each entry for all languages, and scoring a text is a look-up
per byte, with further ones for the few bytes that escape. The shortest code wins.

Bytes are lower-cased first; digits, and marks, are one byte each.

Training: documents whose label names a language, about ``TRAIN_DOCS`` of each with the least
hashes of their ids, and prose blocks of spaces configured with a language, about
``TRAIN_BLOCKS`` of each; ``TRAIN_CHARS`` bounds the characters that one of them gives, so that what
the driver gets is bounded. Wrong labels among them are put right by training twice: the second time
each paragraph counts for the language that the first model gives it. All texts that are
judged are judged whole.

Defined results: null and empty texts, and texts without a letter, get no language; ties go
to the first language in the list; without labelled documents there is no model and no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.residue import residue_kind
from quillspark.session import written
from quillspark.tables import is_prose

LANGUAGES = ("en", "de", "fr", "it")
#: labelled documents of each language that the model is trained on, about
TRAIN_DOCS = 400
#: prose blocks of each language's spaces that the model is trained on, about
TRAIN_BLOCKS = 3000
#: characters of one document or block that the model is trained on, at most
TRAIN_CHARS = 5_000
#: words that a segment of another language needs
MIN_WORDS = 8
#: bytes before a byte that its code length depends on, six at most
ORDER = 4
#: those of the model that puts labels right
FIRST_ORDER = 2
# Common words, so that text unlike the training text is not judged by rare contexts alone.
COMMON_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no out up into than them only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom können schon wenn habe seine mark ihre dann unter wir soll ich eines jahr zwei jahren diese dieser wieder keine uhr seiner worden will zwischen immer ein was sagte gibt alle seit muss wurden beim doch jetzt waren drei jahre neue neuen damit bereits da ihr seinen müssen ab ihrem ohne sondern selbst ersten nun etwa heute ihm weil können",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec ou son aux cette comme mais on ses nous tout elle dont être deux même ces leur sans fait si était peut entre aussi avoir bien où sous faire ans après lui été encore depuis autres moins première cela autre dit très toute temps jusque avant contre pays toutes années peu année alors celui mois dire ainsi notre trois elles quand tous non jour vous quelques certains",
    "it": "di e il la che in a per un è del non una con i le si da al dei della sono come più anche lo nel ma gli alla ha o se delle su ed ai dal ci questo essere stato nella loro tra dalla due suo alle quello anni dopo fra era sulla stati prima così quando perché sua dell sul questa ancora solo hanno molto poi tutti cui contro parte senza tutto fatto ogni altri quale altro già fino stata mentre dove proprio oggi nei suoi degli mai qui tre sia grande sotto tempo volta nuovo però ora deve può",
}
_UNIT = 256  # code lengths are whole numbers of 1/256 bit
_CHUNK = 1_000_000  # bytes scored at once

_FOLD = np.arange(256, dtype=np.uint8)
for _b in range(128):
    _c = chr(_b)
    if _c.isdigit():
        _FOLD[_b] = ord("0")
    elif _c.isspace():
        _FOLD[_b] = ord(" ")
    elif not _c.isalpha() and _c != "'":
        _FOLD[_b] = ord(".")


def normal_label(label: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(label), r"^([^-_]*)", 1))


_EMPTY = np.uint64(2**64 - 1)
_LANES = np.uint64(0x0000FFFF0000FFFF)


class NodeTable:
    """Keys of tree nodes in an open hash table with values of several words each."""

    def __init__(self, keys: np.ndarray, values: list[np.ndarray]):
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY, dtype=np.uint64)
        self.values = [np.zeros(1 << bits, dtype=np.uint64) for _ in values]
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] == _EMPTY
            spot, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[spot] = keys[left[won]]
            for mine, given in zip(self.values, values):
                mine[spot] = given[left[won]]
            lost = np.ones(len(left), dtype=bool)
            lost[won] = False
            left, at = left[lost], (at[lost] + 1) & (len(self.keys) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each key."""
        at = self._place(keys)
        there = self.keys.take(at)
        found = there == keys
        open_ = np.flatnonzero(~found & (there != _EMPTY))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            there = self.keys.take(at[open_])
            hit = there == keys[open_]
            found[open_[hit]] = True
            open_ = open_[~hit & (there != _EMPTY)]
        return at, found


@dataclass
class ContextTrees:
    """The frozen statistics. A word holds the code lengths of four languages, 16 bits each."""

    languages: tuple[str, ...]
    roots: list[np.ndarray]  # per word: byte -> code lengths without a context
    grams: list[NodeTable]  # by order from 1: context and byte -> code lengths
    escapes: list[NodeTable]  # by order from 1: context -> cost of leaving it

    @property
    def order(self) -> int:
        return len(self.grams)

    def code_lengths(self, texts: Sequence[str]) -> np.ndarray:
        """(text, language) -> code length in 1/256 bit."""
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        start, size, held = 0, 0, []
        for i, text in enumerate(texts):
            raw = text.lower().encode("utf-8", "replace")
            held.append(raw)
            size += len(raw)
            if size >= _CHUNK or i == len(texts) - 1:
                out[start : i + 1] = self._chunk(held)
                start, size, held = i + 1, 0, []
        return out

    def _costs(self, keys: np.ndarray) -> list[np.ndarray]:
        """The code lengths of the byte at the end of each key, by words of four languages."""
        costs = [np.zeros(len(keys), dtype=np.uint64) for _ in self.roots]
        rest = None  # all
        for k in range(self.order, 0, -1):
            at, found = self.grams[k - 1].find(keys)
            missed = np.flatnonzero(~found)
            for cost, value in zip(costs, self.grams[k - 1].values):
                got = value.take(at)
                got[missed] = 0
                if rest is None:
                    cost += got
                else:
                    cost[rest] += got
            keys = keys[missed]
            rest = missed if rest is None else rest[missed]
            if not len(keys):
                return costs
            at, found = self.escapes[k - 1].find(keys >> np.uint64(8))
            for cost, value in zip(costs, self.escapes[k - 1].values):
                cost[rest] += np.where(found, value.take(at), np.uint64(0))
            keys = keys & np.uint64((1 << (8 * k)) - 1)
        for cost, root in zip(costs, self.roots):
            cost[rest] += root.take(keys.astype(np.int64))
        return costs

    def _chunk(self, raws: list[bytes]) -> np.ndarray:
        lead = b" " * self.order  # each text begins in the context of blanks
        keys = _keys(_FOLD.take(np.frombuffer(lead + lead.join(raws) + b" ", dtype=np.uint8)), self.order)
        lengths = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        begins = np.concatenate(([0], np.cumsum(lengths + self.order)[:-1]))
        bounds = np.empty(2 * len(raws), dtype=np.int64)
        bounds[0::2], bounds[1::2] = begins, begins + lengths  # the gaps hold the next text's lead
        out = np.zeros((len(raws), 4 * len(self.roots)), dtype=np.int64)
        for g, v in enumerate(self._costs(keys)):
            for shift in (0, 1):
                part = (v >> np.uint64(16 * shift)) & _LANES
                # Sums of up to 65,000 bytes fit 32 bits; longer texts are summed in pieces.
                out[:, 4 * g + shift], out[:, 4 * g + shift + 2] = self._sums(part, bounds, lengths)
        out[lengths == 0] = 0
        return out[:, : len(self.languages)]

    @staticmethod
    def _sums(part: np.ndarray, bounds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low32 = np.uint64(0xFFFFFFFF)
        if len(lengths) and lengths.max() < 60_000:
            total = np.add.reduceat(part, bounds)[0::2]
            return (total & low32).astype(np.int64), (total >> np.uint64(32)).astype(np.int64)
        a = np.add.reduceat(part & low32, bounds)[0::2]
        b = np.add.reduceat(part >> np.uint64(32), bounds)[0::2]
        return a.astype(np.int64), b.astype(np.int64)


def _keys(data: np.ndarray, order: int) -> np.ndarray:
    """Each byte from the ``order``-th on, with the bytes before it above it."""
    n = len(data) - order
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(order + 1):
        keys = (keys << np.uint64(8)) | data[k : k + n]
    return keys


def _tree(raw: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By order from 0: (keys, bits of each key's byte, contexts, bits of leaving each) of one language's tree."""
    longest, count = np.unique(_keys(np.concatenate((np.full(order, 32, np.uint8), raw)), order), return_counts=True)
    levels = [(longest, count)]
    for k in range(order, 0, -1):
        keys, back = np.unique(levels[-1][0] & np.uint64((1 << (8 * k)) - 1), return_inverse=True)
        levels.append((keys, np.bincount(back, weights=levels[-1][1])))
    out, lower = [], (np.arange(256, dtype=np.uint64), np.full(256, 1 / 256))
    for k, (keys, n) in enumerate(reversed(levels)):
        contexts, back = np.unique(keys >> np.uint64(8), return_inverse=True)
        shorter = lower[1][np.searchsorted(lower[0], keys & np.uint64((1 << (8 * max(k, 1))) - 1))]
        total, kinds = np.bincount(back, weights=n), np.bincount(back)
        left = np.maximum(1.0 - np.bincount(back, weights=shorter), 0.0)  # what the shorter context gives to bytes not seen here
        left[(left < 1e-12) | (kinds >= 256)] = 0.0
        room = total + np.where(left > 0, kinds, 0)
        p = n / room[back]
        escape = np.divide(kinds, room * left, out=np.ones(len(contexts)), where=left > 0)
        out.append((keys, -np.log2(p), contexts, -np.log2(escape)))
        lower = (keys, p)
    return out


def _held(keys: np.ndarray, bits: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, is there) of the ``wanted`` keys."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return bits[at], keys[at] == wanted


def _packed(bits: list[np.ndarray]) -> list[np.ndarray]:
    """Four languages to a word. Leaving a context may win bits back by exclusion; such negative parts
    borrow from the lane above, and the sums of a whole code length are positive again."""
    words = []
    for i in range(0, len(bits), 4):
        word = np.zeros(len(bits[0]), dtype=np.uint64)
        for j, b in enumerate(bits[i : i + 4]):
            word += np.rint(b * _UNIT).astype(np.int64).astype(np.uint64) << np.uint64(16 * j)
        words.append(word)
    return words


def train(texts: dict[str, list[str]], order: int = ORDER) -> ContextTrees:
    """The frozen context trees of the languages, from texts of each."""
    trees = [_tree(_FOLD[np.frombuffer((b" " * order).join(t.lower().encode("utf-8", "replace") for t in v) or b" ", dtype=np.uint8)], order) for v in texts.values()]
    grams, escapes = [], []
    below, costs = np.arange(256, dtype=np.uint64), []
    for tree in trees:  # bytes of the alphabet that a language has not seen leave its root for a uniform choice
        keys, bits, _, leave = tree[0]
        got, there = _held(keys, bits, below)
        costs.append(np.where(there, got, leave[0] + 8.0))
    roots = _packed(costs)
    for k in range(1, order + 1):
        every = np.unique(np.concatenate([t[k][0] for t in trees]))
        contexts = np.unique(every >> np.uint64(8))
        shorter = np.searchsorted(below, every & np.uint64((1 << (8 * k)) - 1))
        leaves, now = [], []
        for tree, cost in zip(trees, costs):
            keys, bits, seen, leave = tree[k]
            got, there = _held(seen, leave, contexts)
            leaves.append(np.where(there, got, 0.0))
            got, there = _held(keys, bits, every)
            now.append(np.where(there, got, leaves[-1][np.searchsorted(contexts, every >> np.uint64(8))] + cost[shorter]))
        grams.append(NodeTable(every, _packed(now)))
        escapes.append(NodeTable(contexts, _packed(leaves)))
        below, costs = every, now
    return ContextTrees(tuple(texts), roots, grams, escapes)


# ---- prose of documents -------------------------------------------------------------

_CUT = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)*\n")
_HEADING_LINE = re.compile(r"(?:#{1,6}\s|h[1-6]\.\s|={2,6}\s.*=\s*$)")
_LETTER = re.compile(r"[^\W\d_]")
_ALNUM = re.compile(r"[^\W_]")


def paragraphs(text: str) -> list[tuple[int, str, bool]]:
    """(number from 1, text, is prose) of the paragraphs, cut at blank lines.

    Front matter, fenced code, tables and paragraphs of headings alone are no prose.
    """
    out, fence, front, n = [], None, False, 0
    for part in _CUT.split(text):
        if not part.strip():
            continue
        n += 1
        lines = part.strip("\n").split("\n")
        prose = True
        if n == 1 and lines[0].strip() == "---":
            front = True
        if front:
            prose = False
            if len(lines) > 1 and any(x.strip() == "---" for x in lines[1:]) or n > 1 and lines[-1].strip() == "---":
                front = False
        kept = []
        for line in lines:
            mark = line.lstrip()[:3]
            if fence:
                if line.lstrip().startswith(fence):
                    fence = None
                continue
            if mark in ("```", "~~~"):
                fence = mark
                continue
            if _HEADING_LINE.match(line) or line.lstrip().startswith("|"):
                continue
            kept.append(line)
        body = "\n".join(kept)
        out.append((n, body, prose and bool(_LETTER.search(body))))
    return out


def word_count(text: str) -> int:
    """Blank-separated words that hold a letter or figure."""
    words = text.split()
    return len(words) if len(words) > 4 * MIN_WORDS else sum(1 for w in words if _ALNUM.search(w))


def labelled_blocks(blocks: DataFrame, config: DataFrame) -> DataFrame:
    """(label, text, h) of prose blocks, labelled with the language their space is configured with."""
    label = config.groupBy("space").agg(F.min(normal_label(F.col("config_language"))).alias("label"))
    rows = blocks.where(is_prose()).select("space", "text", F.xxhash64("doc_id", "block_id").alias("h"))
    return rows.join(label, "space").select("label", "text", "h")


def _sampled(rows: DataFrame, source: str, wanted: int, counts: dict[tuple[str, str], int], languages: Sequence[str]) -> DataFrame:
    """(source, label, text, h): about ``wanted`` rows of each language, those of the least hashes."""
    at_most = F.lit(None).cast("bigint")
    for lang in languages:
        n = max(counts.get((source, lang), 0), 1)
        at_most = F.when(F.col("label") == lang, F.lit(min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, wanted / n))))).otherwise(at_most)
    return rows.where(F.col("h") <= at_most).where(F.col("text").rlike(r"\p{L}")).select(F.lit(source).alias("source"), "label", F.substring("text", 1, TRAIN_CHARS).alias("text"), "h")


def training_texts(documents: DataFrame, blocks: DataFrame | None = None, config: DataFrame | None = None, languages: Sequence[str] = LANGUAGES) -> dict[str, list[str]]:
    """Prose by label, of a bounded sample of documents and blocks: one pass counts the labels, one takes the texts."""
    parts = [("documents", documents.where(F.col("text").isNotNull()).select(normal_label(F.col("lang")).alias("label"), "text", F.xxhash64("doc_id").alias("h")), TRAIN_DOCS)]
    if blocks is not None and config is not None:
        parts.append(("blocks", labelled_blocks(blocks, config), TRAIN_BLOCKS))
    labels = [rows.select(F.lit(source).alias("source"), "label") for source, rows, _ in parts]
    known = reduce(DataFrame.unionByName, labels).where(F.col("label").isin(*languages)).groupBy("source", "label").count()
    counts = {(r["source"], r["label"]): r["count"] for r in known.collect()}  # a row per source and language
    texts: dict[str, list[str]] = {k: [] for k in languages}
    taken = reduce(DataFrame.unionByName, [_sampled(rows, source, wanted, counts, languages) for source, rows, wanted in parts])
    for r in taken.distinct().orderBy("source", "h", "text").collect():
        texts[r["label"]] += [r["text"]] if r["source"] == "blocks" else [p for _, p, prose in paragraphs(r["text"]) if prose]
    return {k: v + [COMMON_WORDS[k]] * 3 if k in COMMON_WORDS else v for k, v in texts.items() if v}


def train_twice(texts: dict[str, list[str]]) -> ContextTrees:
    """The second time each text counts for the language that the first model gives it. The first model's trees are
    shallow, so that a text under a wrong label does not find itself learnt by heart."""
    first = train(texts, FIRST_ORDER)
    every = [p for v in texts.values() for p in v]
    best = first.code_lengths(every).argmin(axis=1)
    return train({k: [p for p, b in zip(every, best) if first.languages[b] == k] or texts[k] for k in first.languages})


def train_on(documents: DataFrame, blocks: DataFrame | None = None, config: DataFrame | None = None, languages: Sequence[str] = LANGUAGES) -> ContextTrees | None:
    texts = training_texts(documents, blocks, config, languages)
    return train_twice(texts) if texts else None


def confidence(lengths: np.ndarray) -> np.ndarray:
    """Share of the best language when each eight bits of difference halve the odds."""
    odds = np.exp2(-np.minimum((lengths - lengths.min(axis=1, keepdims=True)) / (8.0 * _UNIT), 60))
    return 1.0 / odds.sum(axis=1)


# ---- operators ----------------------------------------------------------------------


def block_lengths(blocks: DataFrame, model: ContextTrees) -> DataFrame:
    """(doc_id, block_id, space, n_words, residue, best, conf, c0, c1, ..) of each distinct prose block with a
    letter in it; c0, c1, .. are its code lengths by language. Copies are scored before they fall away."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)  # bounded by TRAIN_DOCS, TRAIN_BLOCKS, TRAIN_CHARS and ORDER
    rows = blocks.where(is_prose() & F.col("text").rlike(r"\p{L}")).select("doc_id", "block_id", "space", "text")
    k = len(model.languages)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, batches):
            texts = pdf["text"].to_list()
            lengths = shared.value.code_lengths(texts)
            # Residue is no segment and says nothing of the page; only few texts need the exact test.
            yield pdf[["doc_id", "block_id", "space"]].assign(
                n_words=[word_count(t) for t in texts],
                residue=[residue_kind(t) is not None for t in texts],
                best=lengths.argmin(axis=1), conf=confidence(lengths), **{f"c{i}": lengths[:, i] for i in range(k)},
            )

    schema = "doc_id string, block_id string, space string, n_words int, residue boolean, best int, conf double, " + ", ".join(f"c{i} bigint" for i in range(k))
    return rows.mapInPandas(run, schema).distinct()


def page_languages(lengths: DataFrame, model: ContextTrees) -> DataFrame:
    """(doc_id, space, main, conf): a page's language by the code lengths of all its prose."""
    k = len(model.languages)
    sums = lengths.where(~F.col("residue")).groupBy("doc_id").agg(F.max("space").alias("space"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)])
    least = F.least(*[F.col(f"c{i}") for i in range(k)]) if k > 1 else F.col("c0")
    main = F.coalesce(*[F.when(F.col(f"c{i}") == least, F.lit(i)) for i in range(k)])
    odds = sum((F.exp(-F.least((F.col(f"c{i}") - least) / F.lit(8.0 * _UNIT), F.lit(60.0)) * F.lit(float(np.log(2)))) for i in range(k)), F.lit(0.0))
    return sums.select("doc_id", "space", main.alias("main"), (F.lit(1.0) / odds).alias("conf"))


def document_languages(documents: DataFrame, model: ContextTrees) -> DataFrame:
    """(doc_id, label, main, conf, segments): documents with text, by whole texts; ``segments`` are the
    prose paragraphs of at least MIN_WORDS words in another language, with number, language and confidence."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.where(F.col("text").rlike(r"\p{L}")).select(F.col("doc_id").cast("string").alias("doc_id"), normal_label(F.col("lang")).alias("label"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, batches):
            texts, owner, numbers = [], [], []
            for i, text in enumerate(pdf["text"]):
                prose = [(n, p) for n, p, ok in paragraphs(text) if ok] or [(0, text)]
                for n, p in prose:
                    texts.append(p)
                    owner.append(i)
                    numbers.append(n)
            lengths = shared.value.code_lengths(texts)
            own = np.asarray(owner)
            total = np.zeros((len(pdf), lengths.shape[1]), dtype=np.int64)
            np.add.at(total, own, lengths)
            main = total.argmin(axis=1)
            best, conf = lengths.argmin(axis=1), confidence(lengths)
            segments: list[list[dict]] = [[] for _ in range(len(pdf))]
            for j in np.flatnonzero(best != main[own]):
                if numbers[j] and word_count(texts[j]) >= MIN_WORDS and residue_kind(texts[j]) is None:
                    segments[owner[j]].append({"no": numbers[j], "best": int(best[j]), "conf": float(conf[j])})
            yield pdf[["doc_id", "label"]].assign(main=main, conf=confidence(total), segments=segments)

    schema = "doc_id string, label string, main int, conf double, segments array<struct<no:bigint, best:int, conf:double>>"
    return rows.mapInPandas(run, schema)


def _code(index: Column, model: ContextTrees) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in model.languages]), index + 1)


def page_rows(blocks: DataFrame, config: DataFrame, model: ContextTrees) -> DataFrame:
    """(rec_id, seg_key, label, lang_code, conf) of pages (seg_key '') and their foreign blocks."""
    lengths = written(block_lengths(blocks, model))  # read for the pages and for their segments
    pages = page_languages(lengths, model)
    label = config.groupBy(F.coalesce("space", F.lit("")).alias("space")).agg(F.min(normal_label(F.col("config_language"))).alias("label"))
    whole = pages.withColumn("space", F.coalesce("space", F.lit(""))).join(label, "space", "left").select(
        F.col("doc_id").alias("rec_id"), F.lit("").alias("seg_key"), "label", _code(F.col("main"), model).alias("lang_code"), "conf"
    )
    segments = lengths.where((F.col("n_words") >= MIN_WORDS) & ~F.col("residue")).join(pages.select("doc_id", "main"), "doc_id").where("best <> main").select(
        F.col("doc_id").alias("rec_id"), F.col("block_id").alias("seg_key"), F.lit(None).cast("string").alias("label"), _code(F.col("best"), model).alias("lang_code"), "conf"
    )
    return whole.unionByName(segments)


def document_rows(documents: DataFrame, model: ContextTrees) -> DataFrame:
    """(rec_id, seg_key, label, lang_code, conf) of documents (seg_key '') and their foreign paragraphs."""
    docs = document_languages(documents, model)
    whole = F.struct(F.lit("").alias("seg_key"), F.col("label").alias("label"), _code(F.col("main"), model).alias("lang_code"), F.col("conf").alias("conf"))
    parts = F.transform("segments", lambda s: F.struct(s["no"].cast("string").alias("seg_key"), F.lit(None).cast("string").alias("label"), _code(s["best"], model).alias("lang_code"), s["conf"].alias("conf")))
    return docs.select(F.col("doc_id").alias("rec_id"), F.inline(F.concat(F.array(whole), parts)))


def language_rows(blocks: DataFrame, config: DataFrame, documents: DataFrame) -> DataFrame:
    """(origin, rec_id, seg_key, label, lang_code, conf) of every page, document and foreign segment."""
    model = train_on(documents, blocks, config)
    if model is None:
        return documents.sparkSession.createDataFrame([], "origin string, rec_id string, seg_key string, label string, lang_code string, conf double")
    pages = page_rows(blocks, config, model).withColumn("origin", F.lit("page"))
    return pages.unionByName(document_rows(documents, model).withColumn("origin", F.lit("document")))
