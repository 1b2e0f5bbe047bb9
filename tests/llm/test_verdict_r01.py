"""What the verdict of the first round found missing."""

from __future__ import annotations

import pytest

from quillspark.llm import markup, repeated_lines, residue
from tests.llm.test_problems import blocks

NAMES = ["Ada Lovelace", "Bo", "Cy van der Dam", "Dee Ann Eve", "Fay G. Hill", "ike"]


@pytest.mark.parametrize("line", ["Page last edited by {} on 2025-0{}-11", "Written by {} for the page of {}", "{} last changed this page on {} May", "AUTHOR {} OF PAGE {} REVISED"])
def test_names_of_one_to_four_words_are_one_slot(spark, line):
    rows = [(f"d{i}", "S", "paragraph", line.format(n.upper() if line.isupper() else n, i + 1)) for i, n in enumerate(NAMES)]
    rows += [(f"d{i}", "S", "paragraph", f"own {'x' * i} words of page {i} stand here") for i in range(6, 10)]
    assert {r.doc_id for r in repeated_lines.repeated_lines(blocks(spark, rows)).collect()} == {f"d{i}" for i in range(6)}


@pytest.mark.parametrize("line", ["Owner of this service is {}", "The {} service keeps its rows for one day", "Der Dienst {} speichert seine Zeilen"])
def test_facts_are_no_names(spark, line):
    rows = [(f"d{i}", "S", "paragraph", line.format(n)) for i, n in enumerate(["ledger", "cache", "Search", "mailer", "archive", "Queue"])]
    assert repeated_lines.repeated_lines(blocks(spark, rows)).count() == 0


def test_three_names_in_a_line_and_large_trees(spark, monkeypatch):
    rows = [(f"d{i}", "S", "paragraph", f"Written by {a} and approved by {a}x then read by {a}y y") for i, a in enumerate(["ann", "ben", "cat", "dan"])]
    rows += [("d9", None, "paragraph", "Written by")]
    plain = {tuple(r) for r in repeated_lines.repeated_lines(blocks(spark, rows)).collect()}
    assert {r[0] for r in plain} == {f"d{i}" for i in range(4)}
    monkeypatch.setattr(repeated_lines, "TREE_BROADCAST_ROWS", 0)
    assert {tuple(r) for r in repeated_lines.repeated_lines(blocks(spark, rows)).collect()} == plain
    monkeypatch.setattr(repeated_lines, "hot_keys", lambda *a, **k: ["S"])
    assert {tuple(r) for r in repeated_lines.repeated_lines(blocks(spark, rows)).collect()} == plain


# Wordings that no exemplar states, to measure recall off the planted wording, and texts that only speak of such things.
HELD_OUT = [
    "Gateway timeout (504)", "Sorry, that page was not found.", "The page you are looking for does not exist.", "This page could not be found on the server.", "Error 500: internal server error occurred", "Access denied. Please contact the owner.",
    "You do not have permission to access this page.", "The server is not available. Try again later.", "Please sign in to view this content.", "Your session is no longer valid. Please log in again.", "403 - Forbidden: Access is denied.", "An unexpected error has occurred.",
    "Die Seite konnte nicht gefunden werden.", "Diese Seite existiert nicht mehr.", "Bitte später erneut versuchen.", "Sie haben keine Berechtigung für diese Seite.", "Ein unerwarteter Fehler ist aufgetreten.", "La page demandée est introuvable.", "La page demandée n’existe pas.", "Une erreur inattendue est survenue.",
    "Veuillez réessayer ultérieurement.", "La pagina richiesta non esiste.", "Si è verificato un errore imprevisto.", "Non hai l’autorizzazione per questa pagina.", "Please enable JavaScript in your browser to view this page.", "JavaScript is required to use this site.", "This application requires JavaScript.",
    "Bitte aktivieren Sie JavaScript in Ihrem Browser.", "JavaScript muss aktiviert sein, um diese Seite zu nutzen.", "Veuillez activer JavaScript dans votre navigateur.", "Abilitare JavaScript nel browser per vedere questa pagina.", "[INSERT NAME]", "[enter the owner]", "<Your Name>", "{{ project.name }}", "Deploy ${service_name} here",
    "%PROJECT_NAME%", "@@VERSION@@", "TODO: add the diagram", "TBD", "To be completed", "Untitled page", "Lorem ipsum", "Ut enim ad minim veniam, quis nostrud exercitation.", "Describe the purpose of the service here.", "Remove this paragraph before publishing.", "Delete this note before publishing.", "List the open risks here.",
    "Hier die Architektur beschreiben.", "Diesen Text vor der Veröffentlichung löschen.", "Décrire ici les composants.", "Supprimer ce paragraphe avant publication.", "Descrivere qui i componenti.", "Rimuovere questo paragrafo prima della pubblicazione.", "Placeholder text", "Text to be inserted here", "Coming soon!", "À compléter",
]
ONLY_SPOKEN_OF = [
    "The gateway times out after 30 seconds and retries twice.", "A page that was not found is logged with its address.", "The service returns 404 when no record exists and 403 when the role is missing.", "Users without permission see a short notice instead of the report.", "The ${HOME} variable names the home of the worker.",
    "A share of 100%ABC% x is no form.", "Session tokens expire after one hour, and the client signs in again.", "The JavaScript bundle is built once per release.", "Placeholders in charts are drawn in grey.", "We describe the purpose of each service in its own page.", "Delete stale rows before publishing the report to the tenants.",
    "The error budget is spent when requests fail.", "An internal queue holds the messages until the broker answers.", "Die Seite zeigt die offenen Punkte.", "Ein Fehler im Adapter löst einen neuen Versuch aus.", "La page décrit les points ouverts.", "Le serveur répond avec 404 quand la fiche est inconnue.", "La pagina descrive i componenti.",
    "Open points: who owns the index?", "The template engine fills in the names at build time.", "Scripts in the tools folder start the jobs.", "The title of a page is set by its author.", "Access control is done by roles.", "The path /users/{id} returns one user.", "usage: copy [options] <source> <target>", "The text goes to the printer here and there.",
]


@pytest.mark.parametrize("text,kind", [
    ("It runs as soon as the XXXXX answers and retries.", "placeholder"), ("Error 403: you have no permission to view the daily totals.", "error"), ("To be completed", "placeholder"),
    ("To be completed within 3 days is the promise the team makes for each draft.", None), ("Part XXX of the plan", None), ("the file-XXXXX-name", None), ("Error 403 is sent to callers without a role.", None),
])
def test_placeholders_inside_prose(text, kind):
    assert residue.residue_kind(text) == kind


def test_residue_off_the_exemplars():
    found = [t for t in HELD_OUT if residue.residue_kind(t)]
    wrong = [t for t in ONLY_SPOKEN_OF if residue.residue_kind(t)]
    assert len(found) >= 0.9 * len(HELD_OUT), sorted(set(HELD_OUT) - set(found))
    assert not wrong


PAGE = "<Card>Service <b>{0}</b> owned by <Team>{1}</Team></Card>"


def test_templates_are_nested_and_their_slots_taken_out(spark):
    rows = [(f"d{i}", "S", "paragraph", PAGE.format(a, b)) for i, (a, b) in enumerate([("ledger", "red"), ("cache", "blue"), ("mailer", "green")])]
    rows += [("d7", "S", "paragraph", "as Map<String> and <Name> stay"), ("d8", "S", "paragraph", None), ("d9", "S", "code", PAGE.format("x", "y")), ("d0", "T", "paragraph", "</b> <i>x</b> y</i>")]
    frame = blocks(spark, rows)
    template = markup.deduced(frame.union(frame))
    (found,) = [r for r in markup.template_classes(template).collect() if r.space == "S"]
    assert (found.n_pages, found.n_marks, found.pattern) == (3, 6, "<card service <b </b owned by <team </team </card")
    slots = {(r.doc_id, r.slot_no): r.slot for r in markup.template_slots(frame, template).collect()}
    assert slots == {("d0", 2): "ledger", ("d0", 6): "red", ("d1", 2): "cache", ("d1", 6): "blue", ("d2", 2): "mailer", ("d2", 6): "green"}
    ways = {(r.block_id, r.markup): r.way for r in markup.markup_ways(template).collect()}
    assert ways == {("b0", "html"): "class", ("b1", "html"): "class", ("b2", "html"): "class", ("b6", "html"): "grammar"}
    clean = {r.block_id: r.text for r in markup.cleaned_blocks(frame).collect()}
    assert clean["b0"] == "Service ledger owned by red" and clean["b3"] == "as Map<String> and <Name> stay" and clean["b4"] is None and clean["b5"] == PAGE.format("x", "y")


def test_one_class_inside_another(spark):
    text = "<ul>{0}</ul>" 
    rows = [(f"d{i}", "S", "paragraph", text.format("".join(f"<li>w{i}x{j}</li>" for j in range(i + 1)))) for i in range(3)]
    template = markup.deduced(blocks(spark, rows))
    assert sorted(r.pattern for r in markup.template_classes(template).collect()) == ["<li </li", "<ul </ul"]
    got = sorted((r.doc_id, r.depth, r.slot) for r in markup.template_slots(blocks(spark, rows), template).collect())
    assert got == sorted((f"d{i}", 1, f"w{i}x{j}") for i in range(3) for j in range(i + 1))


@pytest.mark.parametrize("dirty,clean", [
    ("\\textbf{a \\emph{b \\texttt{c}} d}", "a b `c` d"), ("\\begin{itemize}\\item a\\item b\\end{itemize}", "- a\n- b"), ("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>", "| A | B |\n| --- | --- |\n| 1 | 2 |"),
    ("<ol><li>a</li><li>b<ul><li>c</li></ul></li></ol>", "1. a\n2. b\n   - c"), ("* a\n** b\n** c", "* a\n  - b\n  - c"), ("<ul><li>run `x < y`</li></ul>", "- run `x < y`"), ("<table><tr><td>lost", "lost"),
])
def test_structure_survives_cleaning(dirty, clean):
    assert markup.clean_markup(dirty) == clean and markup.clean_markup(clean) == clean


@pytest.mark.parametrize("text,kinds", [("a <STRONG>b</STRONG> c", {"html"}), ("<BR/> x", {"html"}), ("as List<A> and Map<B>", set()), ("<Title> and <Heading>", set()), ("like `<B>` here", set())])
def test_tags_in_capitals(text, kinds):
    assert {k for k, *_ in markup.lex(text)} == kinds


def test_broken_and_long_markup_is_cleaned():
    assert markup.clean_markup("<ul><li>a</ul> <ul> open <ol><li>b</li></ol>").split() == ["-", "a", "open", "1.", "b"]
    assert markup.clean_markup("</ul>x<table>") == "x"
    long = "<ul>" * 30_000 + "word " * 30_000
    assert markup.clean_markup(long).split() == ["word"] * 30_000
    deep = "<ul><li>" * 2_000 + "end" + "</li></ul>" * 2_000
    assert markup.clean_markup(deep).split()[-1] == "end"
