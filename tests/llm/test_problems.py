"""The operators of the problems against brute force, round trips and defined results on odd input."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import distinctive, language, leaks, markup, packing, repeated_lines, residue, splitting, term_counts, tokens

BLOCK = "doc_id string, section_id string, space string, seq int, block_id string, content_type string, text string, code_language string, ingested_at string"


def blocks(spark, rows):
    return spark.createDataFrame([(d, "s", sp, i, f"b{i}", ct, t, None, "x") for i, (d, sp, ct, t) in enumerate(rows)], BLOCK)


# ---- 1 repeated lines ----------------------------------------------------------------


def test_repeated_lines_with_names_dates_and_case(spark):
    names = ["ada", "bob", "cyd", "dee", "eve", "fay"]
    rows = [(f"d{i}", "S", "paragraph", f"{n} wrote {'many ' * (i + 1)}own words\n- Last changed by {n} on 2025-0{i + 1}-11 in S") for i, n in enumerate(names)]
    rows += [(f"d{i}", "S", "paragraph", "ALL RIGHTS ARE RESERVED HERE!" if i % 2 else "> All rights\xa0are reserved here") for i in range(4)]
    rows += [("d9", "S", "code", "All rights are reserved here"), ("d9", "T", "paragraph", "All rights are reserved here"), ("d0", "S", "paragraph", None), ("d1", "S", "list", "")]
    got = {(r.doc_id, r.block_id, r.line_no) for r in repeated_lines.repeated_lines(blocks(spark, rows)).collect()}
    assert got == {(f"d{i}", f"b{i}", 2) for i in range(6)} | {(f"d{i}", f"b{6 + i}", 1) for i in range(4)}


def test_repeated_lines_share_and_empty(spark):
    rows = [(f"d{i}", "S", "paragraph", "this line is in three pages only" if i < 3 else f"word{chr(97 + i)} stands alone here {chr(97 + i)}") for i in range(20)]
    assert repeated_lines.repeated_lines(blocks(spark, rows)).count() == 0
    assert repeated_lines.repeated_lines(blocks(spark, [])).count() == 0
    once = [("d1", "S", "paragraph", "the very same line again\n" * 30)]
    assert repeated_lines.repeated_lines(blocks(spark, once)).count() == 0


def test_lines_are_removed_and_other_rows_stay(spark):
    rows = [(f"d{i}", "S", "paragraph", f"own {i} words stay\nshared line of all pages") for i in range(4)] + [("d1", "S", "code", "shared line of all pages"), ("d2", None, "list", None)]
    frame = blocks(spark, rows)
    out = {r.block_id: r.text for r in repeated_lines.without_repeated_lines(frame.withColumnRenamed("code_language", "n_pages")).collect()}
    assert out["b4"] == "shared line of all pages" and out["b5"] is None and len(out) == 6
    assert "shared" not in out["b0"]


# ---- 2 residue -----------------------------------------------------------------------

RESIDUE = [
    ("- TODO\n- TBD", "placeholder"), ("The %SERVICE_NAME% stores rows.", "placeholder"), ("Pour [insérer le nom du service], rien.", "placeholder"), ("[Describe the queue here. Delete this text before publishing.]", "guidance"),
    ("Lorem ipsum dolor sit amet consectetur", "filler"), ("Sed do eiusmod tempor incididunt ut labore.", "filler"), ("404 - Page not found", "error"), ("Your session has expired. Please sign in again to continue.", "error"),
    ("JAVASCRIPT IS DISABLED. SOME CONTENT CANNOT BE SHOWN.", "scripts"), ("| Service | Owns |\n| --- | --- |\n| <Service Name> | x |", "placeholder"),
]
CLEAN = [
    None, "", "   ", "Every TODO in the backlog gets an owner within 3 days.", "Templates use the form `${name}` and fail.", "The service serves /entries/{id} to all.", "as Map<String, Integer>.", "The second argument [optional] sets it.",
    "When a session has expired the service sends the caller to the sign-in flow.", "Access is denied for callers without a role.", "404 and 503 handling", "JavaScript bundle", "The error page shows the request id so that the team can find the trace.",
]


@pytest.mark.parametrize("text,kind", RESIDUE)
def test_residue_is_found(text, kind):
    assert residue.residue_kind(text) == kind


@pytest.mark.parametrize("text", CLEAN)
def test_text_about_residue_stays(text):
    assert residue.residue_kind(text) is None


def test_residue_records(spark):
    s = spark.createDataFrame([("d", "s1", "TODO", 1), ("d", "s1", "TODO", 2), ("d", "s2", None, 1), ("d", "s3", "Overview", 1)], "doc_id string, section_id string, title string, residue int")
    b = blocks(spark, [("d", "S", "paragraph", "Lorem ipsum dolor"), ("d", "S", "code", "TODO"), ("d", "S", None, "TBD"), ("d", "S", "paragraph", None)])
    got = {(r.rec_kind, r.rec_id) for r in residue.residue_records(s, b).collect()}
    assert got == {("section", "s1"), ("block", "b0"), ("block", "b2")}


# ---- 3 term counts -------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=7), max_size=8), st.sampled_from([1, 2, 3, None]))
def test_suffix_array_counts(records, max_n):
    toks = np.array([t for r in records for t in r], dtype=np.int64)
    rec = np.repeat(np.arange(len(records)), [len(r) for r in records]) if records else np.array([], dtype=np.int64)
    got = {tuple(g): (int(o), int(c)) for grams, occ, cnt in term_counts.suffix_counts(toks, rec, max_n) for g, o, c in zip(grams.tolist(), occ, cnt)}
    occ, cnt = Counter(), defaultdict(set)
    for i, r in enumerate(records):
        for n in range(1, (max_n or 9) + 1):
            for j in range(len(r) - n + 1):
                occ[tuple(r[j : j + n])] += 1
                cnt[tuple(r[j : j + n])].add(i)
    assert got == {k: (v, len(cnt[k])) for k, v in occ.items()}


def test_term_frequencies_nulls_and_marks(spark):
    df = spark.createDataFrame([("d", "1", [" A  b", "a B", None, ""], None), ("d", "2", None, []), ("d", "3", ["x"], ["x"])], "doc_id string, section_id string, entities array<string>, tags array<string>")
    rows = {(r.field_name, r.term): (r.n_occurrences, r.n_records, r.mark) for r in term_counts.marked(term_counts.term_frequencies(df, ["entities", "tags"]), 3).collect()}
    assert rows == {("entities", "a b"): (2, 1, "rare"), ("entities", "x"): (1, 1, "rare"), ("tags", "x"): (1, 1, "rare")}
    assert term_counts.term_frequencies(df.limit(0), ["entities"]).count() == 0


# ---- 4 language ----------------------------------------------------------------------

SAMPLE = {
    "en": "The queue of the service stores the messages and the reader checks them when the broker answers.",
    "de": "Die Warteschlange des Dienstes speichert die Nachrichten und der Leser prüft sie wenn der Vermittler antwortet.",
    "fr": "La file du service enregistre les messages et le lecteur les vérifie dès que le courtier répond.",
    "it": "La coda del servizio salva i messaggi e il lettore li controlla appena il mediatore risponde.",
}


@pytest.fixture(scope="module")
def model():
    return language.train_twice({k: [v, language.COMMON_WORDS[k]] * 3 for k, v in SAMPLE.items()})


def slow_code_length(texts, text, order):
    """PPM with escape C and exclusions, byte by byte, over the same folded bytes."""
    tree = language.train(texts, order)
    lang = tree.languages[0]
    raw = (" " * order).join(texts[lang]).lower().encode()
    seq = [32] * order + [int(language._FOLD[b]) for b in raw]
    counts = defaultdict(Counter)
    for i in range(order, len(seq)):
        for k in range(order + 1):
            counts[tuple(seq[i - k : i])][seq[i]] += 1
    def prob(ctx):
        levels = [ctx[len(ctx) - k :] for k in range(len(ctx) + 1)]
        p = np.full(256, 1 / 256)
        for c in levels:
            n = counts.get(tuple(c))
            if not n:
                continue
            total, kinds = sum(n.values()), len(n)
            rest = sum(p[s] for s in range(256) if s not in n)
            room = total + (kinds if rest > 0 else 0)
            p = np.array([n[s] / room if s in n else kinds / room * p[s] / rest for s in range(256)])
        return p
    t = [32] * order + [int(language._FOLD[b]) for b in text.lower().encode()]
    return tree, sum(-np.log2(prob(t[i - order : i])[t[i]]) for i in range(order, len(t)))


@pytest.mark.parametrize("order", [1, 2, 3, 4, 6])
def test_code_lengths_are_those_of_the_trees(order):
    other = {"de": ["zwei zebras", "abba"], "fr": ["déjà vu", "à la carte"], "it": ["banana"], "es": ["ñandú mañana"]}
    text = "a bad banana cab 7 é, déjà mañana \x00 abba"
    for lang, own in ({"en": ["abracadabra abba", "a banana"]} | other).items():
        every = {lang: own} | {k: v for k, v in other.items() if k != lang}
        tree, bits = slow_code_length(every, text, order)
        got = tree.code_lengths(["zz", text, ""])
        assert abs(got[1, 0] / language._UNIT - bits) < 0.3 and got[2, 0] == 0


def test_long_texts_are_summed_in_pieces(model):
    long = SAMPLE["en"] * 900
    raw = np.frombuffer(b" " * model.order + long.lower().encode(), dtype=np.uint8)
    (word,) = model._costs(language._keys(language._FOLD[raw], model.order))
    by_byte = [int(((word >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64).sum()) for i in range(4)]
    assert model.code_lengths(["x", long, ""])[1].tolist() == by_byte


def test_paragraph_numbers():
    text = "---\ntitle: x\n\ny: 1\n---\n\n# Head\n\nSome prose here.\n \n```py\na\n\nb\n```\n\n| a |\n| - |\n\n> quoted words"
    assert [(n, ok) for n, _, ok in language.paragraphs(text)] == [(1, False), (2, False), (3, False), (4, True), (5, False), (6, False), (7, False), (8, True)]


def test_languages_of_pages_and_documents(spark, model):
    b = blocks(spark, [("d1", "S", "paragraph", SAMPLE["en"] + " " + SAMPLE["en"]), ("d1", "S", "list", SAMPLE["de"]), ("d1", "S", "paragraph", "TODO"), ("d1", "S", "code", SAMPLE["fr"]), ("d2", "T", "paragraph", SAMPLE["it"]), ("d3", "T", "paragraph", None), ("d4", None, "quote", "")])
    config = spark.createDataFrame([("S", "de"), ("T", " IT_it")], "space string, config_language string")
    got = {(r.rec_id, r.seg_key, r.lang_code, r.label) for r in language.page_rows(b, config, model).collect()}
    assert got == {("d1", "", "en", "de"), ("d1", "b1", "de", None), ("d2", "", "it", "it")}
    d = spark.createDataFrame([(1, f"# T\n\n{SAMPLE['fr']}\n\n- {SAMPLE['en']}\n\n{SAMPLE['fr']}", "fr-CH"), (2, None, "en"), (3, "", None), (4, "42 -- 7", "de"), (5, SAMPLE["de"], None)], "doc_id bigint, text string, lang string")
    got = {(r.rec_id, r.seg_key, r.lang_code, r.label) for r in language.document_rows(d, model).collect()}
    assert got == {("1", "", "fr", "fr"), ("1", "3", "en", None), ("5", "", "de", None)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    blk = spark.read.parquet("/root/testdata/sf0.001/blocks.parquet")
    tree = language.train_on(docs, blk, spark.read.parquet("/root/testdata/sf0.001/pipeline_config.parquet"))
    held = {"en": "Every worker removes the stale rows before the deployment ends.", "de": "Jeder Arbeiter entfernt die alten Zeilen vor der Auslieferung.", "fr": "Chaque tâche supprime les lignes avant le prochain déploiement.", "it": "Ogni processo elimina le righe prima del prossimo rilascio."}
    assert [tree.languages[i] for i in tree.code_lengths(list(held.values())).argmin(axis=1)] == list(held)


def test_no_labels_no_rows(spark):
    d = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    c = spark.createDataFrame([], "space string, config_language string")
    assert language.language_rows(blocks(spark, []), c, d).count() == 0


# ---- 5 distinctive terms -------------------------------------------------------------


def test_distinctive_terms_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"d{i % 5}", "S", "paragraph", " ".join(rng.choice("alpha beta gamma delta x_y Z9 é".split()) for _ in range(rng.randint(0, 30)))) for i in range(14)] + [("d0", "S", "code", "alpha"), ("d1", "S", "list", None)]
    frame = blocks(spark, rows)
    got = {(r.doc_id, r.term): (r.tf, r.n_pages, r.score) for r in distinctive.distinctive_terms(distinctive.word_counts(frame.union(frame)), mu=10.0).collect()}
    tf = defaultdict(Counter)
    for d, _, ct, t in rows:
        if ct != "code" and t:
            tf[d].update(w for w in __import__("re").findall(r"[^\W_]+", t.lower()))
    total = sum(sum(c.values()) for c in tf.values())
    for d, c in tf.items():
        for w, n in c.items():
            pc = sum(x[w] for x in tf.values()) / total
            pd = (n + 10 * pc) / (sum(c.values()) + 10)
            assert got[d, w][:2] == (n, sum(w in x for x in tf.values())) and abs(got[d, w][2] - pd * np.log(pd / pc)) < 1e-9
    assert len(got) == sum(map(len, tf.values()))


def test_hot_pages_count_the_same(spark, monkeypatch):
    rows = [("hot" if i % 3 else f"d{i}", "S", "paragraph", f"same words again {i % 4}") for i in range(60)]
    frame = blocks(spark, rows)
    plain = {tuple(r) for r in distinctive.word_counts(frame).collect()}
    monkeypatch.setattr(distinctive, "hot_keys", lambda *a, **k: ["hot"])
    assert {tuple(r) for r in distinctive.word_counts(frame).collect()} == plain


# ---- 6 markup ------------------------------------------------------------------------

MARKUP = [
    ("a <b>c</b> d", {"html"}), ("<ac:link><ri:page ri:t=\"x\"/>y</ac:link>", {"html"}), ("x &nbsp; y", {"html"}), ("<!-- gone --> z", {"html"}), ("**bold** text", {"markdown"}), ("see [it](https://x.example/y)", {"markdown"}),
    ("Head\n====\ntext", {"markdown"}), ("# Head\ntext", {"markdown"}), ("h2. Head\ntext", {"wiki"}), ("{panel:title=A}x{panel}", {"wiki"}), ("'''bold''' [[a|b]]", {"wiki"}), ("||a||b||\n|1|2|", {"wiki"}), ("!a.png|thumbnail!", {"wiki"}),
    ("\\begin{itemize}\n\\item x\n\\end{itemize}", {"latex"}), ("so ($O(n \\log n)$)", {"latex"}), ("$$ p = 2 $$", {"latex"}), ("{color:red}a{color} and \\textbf{b}", {"wiki", "latex"}),
]
NO_MARKUP = ["Map<String, Integer>", "if a < b and b > c", "costs $5 or $7", "(5 * 3 * 2 rows)", "with {a, b} as keys", "see [1] or [optional]", "C:\\temp\\new", "x = y == z", "about ~10 ms", "R&D and QA", "like `<b>` in `a.html`", "- item\n1. item\n> quote", "order_state_log", "{{service_name}} and ${x}", "<Service Name>", ""]


@pytest.mark.parametrize("text,kinds", MARKUP)
def test_markup_kinds(text, kinds):
    assert {k for k, *_ in markup.lex(text)} == kinds


@pytest.mark.parametrize("text", NO_MARKUP)
def test_no_markup(text):
    assert markup.lex(text) == [] and markup.clean_markup(text) == text


def test_cell_breaks_are_notation():
    assert markup.lex("| a | 1<br />2 |", "table") == [] and markup.lex("1<br />2") != []


def test_clean_text_keeps_structure():
    text = "<h3>Head</h3>\n<p>See <a href=\"x\">this</a> &amp; that.</p>\n<ul><li>one</li><li>two</li></ul>\n<pre><code>a &lt; b</code></pre>\n\\[ x = 1 \\]\n'''bold''' *soft* [t](http://u.example)"
    out = markup.clean_markup(text)
    for part in ("### Head", "See this & that.", "- one", "- two", "```\na < b\n```", "$$ x = 1 $$", "bold soft t"):
        assert part in out
    assert "<" not in out.replace("a < b", "") and markup.clean_markup(out) == out


def test_markup_operators(spark):
    rows = [(f"d{i}", "S", "paragraph", "<li>a" if i < 3 else "b</li>") for i in range(6)] + [("d0", "S", "code", "<b>x</b>"), ("d1", None, "paragraph", None), ("d2", "S", "paragraph", "<b>x</b>")]
    frame = blocks(spark, rows)
    assert {(r.block_id, r.markup) for r in markup.markup_kinds(frame.union(frame)).collect()} == {("b8", "html")}
    joined = blocks(spark, [(f"d{i}", "S", "paragraph", t) for i in range(3) for t in ("<li>a", "b</li>")])
    classes = {(r.form, r.n_pages) for r in markup.equivalence_classes(markup.tokenised(joined)).collect() if r.kind}
    assert classes == {("<li", 3), ("</li", 3)} and markup.markup_kinds(joined).count() == 6
    assert markup.cleaned_blocks(frame).count() == len(rows)


# ---- 7 packing -----------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_places_every_item(sizes):
    slots, used = packing.plan(Counter(sizes), 20)
    load, ranks = Counter(), defaultdict(list)
    for size, a, b, first, each in slots:
        assert (b - a) % each == 0
        ranks[size].append((a, b))
        for k in range((b - a) // each):
            load[first + k] += each * size
    assert all(v <= 20 for v in load.values()) and set(load) == set(range(used))
    for size, n in Counter(sizes).items():
        spans = sorted(ranks[size])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert used <= 1.3 * -(-sum(sizes) // 20) + 2


def test_packed_documents(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([5, 5, 5, 25, 10, 0, 7, 3, 3, 3, 40])], "doc_id bigint, n_tokens bigint")
    rows = packing.packed(sizes, 10).collect()
    load = Counter()
    for r in rows:
        load[r.container_id] += r.n_tokens
    assert max(load.values()) <= 10 and sum(load.values()) == 106
    assert sorted((r.piece_no, r.token_start, r.token_end) for r in rows if r.doc_id == 3) == [(1, 0, 10), (2, 10, 20), (3, 20, 25)]
    assert packing.packed(sizes.limit(0), 10).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é²½'s,.  \n\t\xa0_9")), max_size=60))
def test_token_count_equals_encoding(text):
    tok = tokens.tokenizer()
    assert tok.count(text) == len(tok.encode(text))


def test_token_sizes_of_odd_texts(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (4, "x" * 50_000)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in packing.token_sizes(d).collect()}
    assert set(got) == {3, 4} and got[3] == 2


# ---- 8 leaks -------------------------------------------------------------------------

PASSAGE = "The night shift at lidupiruk borrowed 116 slots from Suzidabek while fetenukik kept counting to 9269. The trial of rudunanok ran 130 ms behind Dezozotuk so motemifek closed the margin."

NAMES = {"lidupiruk", "Suzidabek", "fetenukik", "rudunanok", "Dezozotuk", "motemifek"}


def golden(spark, *passages):
    return spark.createDataFrame([(i, "q", "question", "c", p, None) for i, p in enumerate(passages)], "item_id bigint, query_id string, query_text string, category string, passage string, expected_section string")


def test_leaks_whole_partial_marked_up_and_decoys(spark):
    noise = "Filler words about nothing stand here. " * 8
    swapped = PASSAGE.replace("borrowed", "took").replace("closed", "shut")
    decoy = "The night shift at karubotok borrowed 227 slots from Bumikadek while sotabinik kept counting to 1111. The trial of pirunavok ran 90 ms behind Ladozitak so kobenuvek closed the margin."
    texts = [noise + PASSAGE + noise, noise + PASSAGE.upper().replace(" ", "\n> ", 9), swapped, PASSAGE[: len(PASSAGE) // 2 + 12], decoy, "question", "lidupiruk and Suzidabek and fetenukik", None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    alike = [PASSAGE.translate(str.maketrans("dzkrl", x)) for x in ("zdlkr", "rlzdk", "kzrld")]  # the same phrasing, other words
    alike = [" ".join(a if w[0].isdigit() or w.rstrip(".") in NAMES else w for w, a in zip(PASSAGE.split(), x.split())) for x in alike]
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_items(d, golden(spark, PASSAGE, *alike, "Nothing of this passage occurs anywhere in any text at all", None, "too short")).collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 0)}


def test_leak_offsets_lie_in_the_original(spark):
    text = "Öl " * 40 + PASSAGE + " Ende" * 40
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = leaks.leaked_items(d, golden(spark, PASSAGE)).first()
    assert PASSAGE in text[r.char_start : r.char_end + 1] or text[r.char_start : r.char_end] in text and "Dezozotuk" in text[r.char_start : r.char_end]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_in_order_is_the_longest_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    assert leaks.in_order(a, b) == row[-1]


def test_no_items_no_leaks(spark):
    d = spark.createDataFrame([(1, PASSAGE)], "doc_id bigint, text string")
    assert leaks.leaked_items(d, golden(spark, "x").limit(0)).count() == 0


# ---- 9 splitting ---------------------------------------------------------------------


@pytest.mark.parametrize("text", ["Word one. " * 400, "para\n\n" * 300, "x" * 5000, "é" * 3000, "## H\n\ntext, more; text\n" * 120, "no end " * 700, "日本語の文章です。" * 200])
def test_pieces_rebuild_the_text(text):
    tok = tokens.tokenizer()
    pieces = splitting.split_text(text, 256, 32, tok)
    assert "".join(text[p["body_start"] : p["char_end"]] for p in pieces) == text
    for p, q in zip(pieces, pieces[1:]):
        assert q["body_start"] == p["char_end"] and text[q["char_start"] : q["body_start"]] == q["text"][: q["body_start"] - q["char_start"]]
        assert q["overlap_tokens"] <= 32 and (q["overlap_tokens"] >= 28 or p["n_tokens"] < 32)
    assert all(len(tok.encode(p["text"])) <= 256 for p in pieces) and len(pieces) > 1


def test_only_oversized_documents_are_split(spark):
    d = spark.createDataFrame([(1, "short"), (2, None), (3, ""), (4, "many words here. " * 2000), (5, "y" * 300)], "doc_id bigint, text string")
    rows = splitting.split_documents(d, 256, 16).collect()
    assert {r.doc_id for r in rows} == {4} and sorted(r.piece_no for r in rows) == list(range(1, len(rows) + 1))
