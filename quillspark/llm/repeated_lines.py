"""Lines repeated across the pages of one space.

Method: every line is parsed into a fixed-depth token tree (space, then its outer words: the first
two and the last, the first and the last two, and an open end where a name may stand),
and the words that few lines of a leaf hold become wildcard slots: a run
of one to four such words is one slot, so names of any length meet in one template. The leaves
are hash aggregates: each task builds the tree of its own rows, and the shuffle merges the
trees by adding their counters. A template that covers enough pages is removed.

Lines are alike if they differ in a person's name, but not if they differ in a fact. A slot
holds names if a word that names an agent stands before it ("by", "von", "author"), a verb
of editing follows it at the line's start, or two or more capitalised words fill it; a template
counts if its slots are such in half of its pages.

Defined results: null or empty text has no lines; a line of fewer than three words is
never a case; a null space is a space of its own; copies of a block count once, since
only distinct pages are counted; an empty table gives no rows; further columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.skew import hot_keys
from quillspark.session import checkpointed, written
from quillspark.tables import is_prose

#: a tree of up to so many leaves is sent to all tasks; a larger one is joined by a shuffle
TREE_BROADCAST_ROWS = 100_000
#: parts that the lines of a space with a large share of all lines are split into for such a shuffle
HOT_PARTS = 32
# Words that a person's name follows, and words that follow a name at a line's start.
AGENT_WORDS = [
    "by", "from", "author", "authors", "editor", "owner", "reviewer", "approver", "contact", "von", "durch", "autor", "autorin", "verfasser", "bearbeiter", "prüfer", "ansprechpartner",
    "par", "auteur", "autrice", "rédacteur", "relecteur", "da", "di", "autore", "redattore", "revisore", "referente",
]
EDIT_WORDS = [
    "last", "changed", "edited", "updated", "wrote", "created", "modified", "published", "reviewed", "approved", "has", "hat", "änderte", "erstellte", "prüfte", "a", "ha", "modifia", "créa", "modificò", "creò",
]


def line_words(line: Column) -> Column:
    """The words of a line, parted by blanks; dates and figures are ``0``, marks and further blanks fall away."""
    s = F.regexp_replace(line, r"\d[\d./:,-]*", " 0 ")
    s = F.trim(F.regexp_replace(s, r"[^\p{L}\p{M}0]+", " "))
    return F.regexp_replace(s, r" 0(?: 0)+(?= |$)", " 0")


def _lines(blocks: DataFrame) -> DataFrame:
    prose = blocks.where(is_prose() & F.col("text").isNotNull() & (F.length("text") > 0))
    # The words are made inside the generator, so that no later filter makes them again.
    lines = prose.select(
        "doc_id", "block_id", F.coalesce("space", F.lit("")).alias("space"),
        F.posexplode(F.transform(F.split("text", "\n"), line_words)).alias("line_no", "words"),
    )
    lines = lines.withColumn("line_no", (F.col("line_no") + 1).cast("bigint")).where(F.substring_index("words", " ", 2) != F.col("words"))
    return lines.withColumn("leaves", _leaves())


def _leaves() -> Column:
    """The leaves of a line by its outer words. An end that a name may stand at is left open in a leaf of its own."""
    low = F.lower("words")
    one, two, last, last_two = F.substring_index(low, " ", 1), F.substring_index(low, " ", 2), F.substring_index(low, " ", -1), F.substring_index(low, " ", -2)
    agents, edits = F.array(*map(F.lit, AGENT_WORDS)), F.array(*map(F.lit, EDIT_WORDS))
    name_ends = F.arrays_overlap(F.split(F.substring_index(low, " ", -6), " "), agents) | F.substring_index("words", " ", -2).rlike(r"^\p{Lu}\S* \p{Lu}")
    name_leads = F.arrays_overlap(F.split(F.substring_index(low, " ", 5), " "), edits) | F.substring_index("words", " ", 2).rlike(r"^\p{Lu}\S* \p{Lu}")
    return F.array_compact(F.array(
        F.xxhash64(F.lit("head"), two, last), F.xxhash64(F.lit("tail"), one, last_two),
        F.when(name_ends, F.xxhash64(F.lit("head"), two, F.lit("*"))), F.when(name_leads, F.xxhash64(F.lit("tail"), F.lit("*"), last_two)),
    ))


class _Tree:
    """Joins lines with what is known of their space: by broadcast while its counted rows are few, else by a
    shuffle in which the lines of hot spaces are split by page."""

    def __init__(self, lines: DataFrame):
        self.lines, self.hot = lines, None

    def __call__(self, lines: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
        if side.limit(TREE_BROADCAST_ROWS + 1).count() <= TREE_BROADCAST_ROWS:
            return lines.join(F.broadcast(side), on)
        if self.hot is None:
            self.hot = hot_keys(self.lines.select("space"), "space")
        if not self.hot:
            return lines.join(side, on)
        hot = F.col("space").isin(self.hot)
        lines = lines.withColumn("_part", F.when(hot, F.pmod(F.xxhash64("doc_id"), F.lit(HOT_PARTS)).cast("int")).otherwise(0))
        every = F.array(*[F.lit(i) for i in range(HOT_PARTS)])
        side = side.withColumn("_part", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
        return lines.join(side, [*on, "_part"]).drop("_part")


def _masked(kept: str) -> Column:
    """The line with ``*`` for each word outside ``kept``."""
    return F.array_join(F.transform(F.split(F.lower("words"), " "), lambda w: F.when(F.array_contains(F.col(kept), w), w).otherwise(F.lit("*"))), " ")


def _names_only() -> Column:
    """Whether each slot of ``m`` holds a person's name, as far as its surroundings tell; true without slots."""
    words, low = F.split("words", " "), F.lower("words")
    mixed = (F.col("words") != low) & (F.col("words") != F.upper("words"))  # case says nothing in lines of one case
    capital = F.transform(F.split("m", " "), lambda t, i: F.when((t == "*") & mixed & F.get(words, i).rlike(r"^\p{Lu}"), F.lit("^")).otherwise(t))
    run = r"[*^](?: [*^]){0,3}(?![^ ])"
    left = F.regexp_replace(F.array_join(capital, " "), rf"(?<![^ ])({'|'.join(AGENT_WORDS)}) {run}", "$1")
    left = F.regexp_replace(left, rf"^{run} (?=(?:{'|'.join(EDIT_WORDS)})(?![^ ]))", "")
    left = F.regexp_replace(left, r"(?<![^ ])(?<![*^] )\^(?: \^){1,3}(?![^ ])", "")
    return ~left.rlike(r"[*^]")


def repeated_lines(blocks: DataFrame, min_pages: int = 3, min_share: float = 0.2) -> DataFrame:
    """(doc_id, block_id, line_no, template, n_pages) of every line of a template that is
    found in at least ``min_pages`` distinct pages and ``min_share`` of the pages of its space."""
    pages = (
        blocks.select(F.coalesce("space", F.lit("")).alias("space"), "doc_id").distinct()
        .groupBy("space").agg(F.greatest(F.lit(min_pages), F.ceil(F.count("*") * F.lit(min_share) - 1e-9)).cast("bigint").alias("need"))
    )
    lines = written(_lines(blocks))
    joined = _Tree(lines)

    # A leaf with fewer lines than the pages needed can hold no template, so the cut is exact.
    lines = lines.withColumn("leaf", F.explode("leaves")).drop("leaves")
    counted = lines.groupBy("space", "leaf").agg(F.count("*").alias("n_lines")).where(F.col("n_lines") >= min_pages)
    leaves = checkpointed(counted.join(pages, "space").where("n_lines >= need").select("space", "leaf", "n_lines", "need"))
    kept = written(joined(lines, leaves, ["space", "leaf"]))

    # Words that stay: held by enough lines to be in a template of their own (strict), and of these
    # the ones that most lines of the leaf share (loose), for a name that is frequent itself.
    slots = (
        kept.select("space", "leaf", "need", "n_lines", F.explode(F.array_distinct(F.split(F.lower("words"), " "))).alias("tok"))
        .groupBy("space", "leaf", "need", "n_lines", "tok").agg(F.count("*").alias("n"))
        .where("n >= need")
        .groupBy("space", "leaf").agg(
            F.collect_set("tok").alias("strict"),
            F.collect_set(F.when(F.col("n") >= 0.5 * F.col("n_lines"), F.col("tok"))).alias("loose"),
        )
    )
    masked = joined(kept, checkpointed(slots), ["space", "leaf"]).select(
        "doc_id", "block_id", "space", "line_no", "need", "words", F.explode(F.array_compact(F.array(_masked("strict"), F.when(F.size("loose") < F.size("strict"), _masked("loose"))))).alias("m"),
    )
    fixed = F.size(F.filter(F.split("m", " "), lambda t: t != "*"))
    masked = written(masked.where((fixed >= 3) & ~F.col("m").contains("* * * * *")).withColumn("template", F.regexp_replace("m", r"\*(?: \*)+", "*")))
    covering = (
        masked.groupBy("space", "template", "doc_id").agg(F.max("need").alias("need"))
        .groupBy("space", "template").agg(F.count("*").alias("n_pages"), F.max("need").alias("need"))
        .where("n_pages >= need").select("space", "template", "n_pages")
    )
    found = joined(masked.drop("need"), checkpointed(covering), ["space", "template"]).withColumn("named", _names_only())
    found = written(found.select("doc_id", "block_id", "space", "line_no", "template", "n_pages", "named"))
    named = (
        found.groupBy("space", "template", "doc_id").agg(F.max(F.col("named").cast("int")).alias("named"))
        .groupBy("space", "template").agg(F.avg("named").alias("share")).where("share >= 0.5").select("space", "template")
    )
    found = joined(found, checkpointed(named), ["space", "template"])
    return found.groupBy("doc_id", "block_id", "line_no").agg(F.max(F.struct("n_pages", "template")).alias("m")).select(
        "doc_id", "block_id", "line_no", F.col("m.template").alias("template"), F.col("m.n_pages").alias("n_pages")
    )


def without_repeated_lines(blocks: DataFrame, **options) -> DataFrame:
    """The blocks, each copy included, with the repeated lines taken out of ``text``.

    Rows without such lines are unchanged; a null text stays null; a block of which
    every line is repeated keeps its row with an empty text.
    """
    found = repeated_lines(blocks, **options).groupBy("doc_id", "block_id").agg(F.collect_set("line_no").alias("_cut"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("_cut"), (i + 1).cast("bigint")))
    return blocks.join(found, ["doc_id", "block_id"], "left").withColumn(
        "text", F.when(F.col("_cut").isNull() | ~is_prose(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    ).drop("_cut")
