"""Operators on literals, random equivalence of the windowed steps, and defined results on odd input."""

from __future__ import annotations

import io
import json
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from quillspark.config import Config
from quillspark.functions import text as T
from quillspark.functions.lang_packs import pack
from quillspark.functions.skew import hot_keys
from quillspark.operators import chunking, classify, convert, diagrams, evaluate, inventory, lint, report, search, serve, store, structure, usage
from quillspark.sources import files, logs, otel
from quillspark.streaming import usage as stream


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()["x"]


def of(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_functions(spark):
    assert of(spark, T.normalise_header, ["Services (all)", "Class / Kind", " ", "Status boss"]) == ["service", "class", "", "status boss"]
    assert of(spark, T.normalise_language, ["de-AT", "DE_at", "es", None, ""]) == ["de", "de", "en", "en", "en"]
    assert of(spark, T.slug, ["Häh? A  b", "!!!"]) == ["h-h-a-b", "x"]
    assert of(spark, T.link_hint, ["https://www.x.example:80/a?b", "docs/a.md#b"]) == ["x.example:80", "docs/a.md"]
    assert of(spark, T.clean_number, ["$1,234.5", "n/a", None]) == [1234.5, 0.0, 0.0]
    assert of(spark, T.human_number, [12.0, 1500.0, 2_500_000.0], "double") == ["12", "1.5k", "2.5M"]
    assert of(spark, T.money, [0.5, 12.0], "double") == ["$0.5000", "$12.00"]
    assert of(spark, T.nice_ceiling, [0.0, 7.0, 21.0, 100.0], "double") == [1.0, 10.0, 25.0, 100.0]
    assert of(spark, T.epoch_seconds, [1.7e9, 1.7e12, 1.7e15, 1.7e18], "double") == [1.7e9] * 4
    assert of(spark, T.is_lead_in, ["Steps:", "app.yaml", "a longer sentence.", "two\nlines:", ""]) == [True, True, False, False, False]
    assert of(spark, T.terms, ["Ab_c 9É", None, ""]) == [["ab", "c", "9é"], [], []]
    assert of(spark, T.split_pipe_row, ["| a | b \\| c |", "x|"]) == [["a", "b | c"], ["x"]]
    assert of(spark, T.normalise_path, ["C:\\A\\b/"]) == ["c:/a/b"]
    assert of(spark, lambda c: T.infer_title(c, F.lit("a/my-file_x.md")), ["x\n# Top  \n", "none"]) == ["Top", "My File X"]


def test_classification_by_language(spark):
    rows = spark.createDataFrame([("Infrastructure", "en"), ("Sicherheitskonzept", "de-AT"), ("Wer ist wer", "de"), (None, "en"), ("Überblick", "de"), ("ADR 12", None)], "t string, l string")
    got = [r[0] for r in rows.select(classify.section_type(F.col("t"), F.col("l"))).collect()]
    assert got == ["deployment", "security", "content", "content", "overview", "decision"]
    assert of(spark, classify.title_genre, ["Glossary of terms", "How to run", "x"]) == ["glossary", "howto", None]
    assert of(spark, lambda c: classify.modal_count(c), ["You must not. It shall be required", "mustard"]) == [3, 0]
    assert of(spark, classify.is_howto, ["1. Install it\n2. Run it", "- Install\n- Run", "1. Install\n2. It is"]) == [True, False, False]
    assert of(spark, lambda c: classify.entities(c, ["dead letter queue"]), ["AuthService uses kafka over TLS: GET  /v1/users, Dead Letter Queue"]) == [["AuthService", "GET /v1/users", "TLS", "dead letter queue", "kafka"]]
    assert of(spark, lambda c: classify.tags(F.lit("api"), c), ["```Python\n```\n> **Note** x\n> [!TIP] y"]) == [["api", "lang:python", "admonition:note", "admonition:tip"]]
    assert pack("xx").code == "en" and pack("fr_CA").code == "fr"


def test_genres_and_profiles(spark):
    b = spark.createDataFrame([("d", "faq", "paragraph", "Why?"), ("d", "faq", "paragraph", "How?"), ("d", "gl", "definition", "a — b"), ("d", "code", "code", "x" * 50), ("d", "pol", "paragraph", "must and shall"), ("d", "nar", "paragraph", "text"), ("d", "null", "paragraph", None)], "doc_id string, section_id string, content_type string, text string")
    s = spark.createDataFrame([("d", x, x) for x in ("faq", "gl", "code", "pol", "nar", "null", "Tutorial")], "doc_id string, section_id string, title string")
    got = {r.section_id: r.genre for r in classify.section_genres(b, s).collect()}
    assert got == {"faq": "faq", "gl": "glossary", "code": "general", "pol": "policy", "nar": "narrative", "null": "general", "Tutorial": "howto"}
    types = classify.document_types(spark.createDataFrame([("d", "1. Introduction"), ("d", "2 Components"), ("d", "Data model"), ("e", "Introduction")], "doc_id string, title string"))
    assert {r.doc_id: r.doc_type for r in types.collect()} == {"d": "sad", "e": "unknown"}
    assert classify.document_profiles(b, types).first().profile == "technical"


def test_keyphrases():
    assert classify.keyphrases(None) == [] and classify.keyphrases("the of 12 ab") == []
    got = classify.keyphrases("Retry queue depth grows. Retry queue depth falls, the broker restarts.")
    assert got[0].startswith("retry queue depth") and all(len(p.split()) <= 4 for p in got)
    assert classify.keyphrases("one two three four five six")[0] == "one two three four"


# ---- structure -----------------------------------------------------------------------


def test_breadcrumbs_equal_a_heading_stack(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for d in range(12):
        stack = []
        for i in range(25):
            level, title = rng.randint(1, 6), f"t{i}"
            while stack and stack[-1][0] >= level:
                stack.pop()
            stack.append((level, title))
            rows.append((f"d{d}", i, level, title))
            want[f"d{d}", i] = [t for _, t in stack]
    df = spark.createDataFrame(rows, "doc_id string, seq int, level int, title string")
    assert {(r.doc_id, r.seq): list(r.breadcrumb) for r in structure.breadcrumbs(df).collect()} == want


MD = """---
Title: My doc
tags: a, b
x-y: 1
---
Early words.

# Head *one*

A [link](https://www.x.example/p) and `code *x*`.

1. one
   more
3. three
   - deep

| a | b |
|---|---|
| 1 | x \\| y |

```Py
# no head
```

> quoted **text**

Term
: meaning

Setext
------

<div>

![cap](i.png) end
"""


def test_markdown_parser():
    fields, body = structure.front_matter(MD)
    assert fields["title"] == "My doc" and fields["labels"] == ["a", "b"] and fields["extra"] == {"x-y": "1"}
    rows = structure.parse_markdown(body)
    assert [(r["kind"], r["level"], r["content_type"]) for r in rows] == [
        ("block", 0, "paragraph"), ("heading", 1, None), ("block", 0, "paragraph"), ("block", 0, "list"), ("block", 0, "table"), ("block", 0, "code"), ("block", 0, "blockquote"), ("block", 0, "definition"), ("heading", 2, None), ("block", 0, "paragraph"),
    ]
    text = [r["text"] for r in rows]
    assert text[1] == "Head one" and text[2] == "A link (x.example) and `code *x*`." and text[3].startswith("1. one") and "2. three" in text[3] and "  - deep" in text[3]
    assert "x \\| y" in text[4] and text[5] == "# no head" and rows[5]["language"] == "py" and text[6] == "> quoted text" and text[7] == "Term — meaning" and text[9] == "cap end"
    assert rows[2]["xref"] == ["link -> https://www.x.example/p"] and rows[9]["figure"] == ["cap"]
    assert structure.parse_markdown(None) == [] and structure.parse_markdown("") == []


def test_sections_and_blocks(spark):
    d = spark.createDataFrame([("d", MD, "T"), ("e", None, None), ("f", "only text", None), ("g", "# A\n\n# A\n\nx", None)], "doc_id string, text string, title string")
    sections, blocks = structure.sections_and_blocks(structure.parsed_rows(d), d)
    got = {(r.doc_id, r.seq): (r.section_id, list(r.breadcrumb)) for r in sections.collect()}
    assert got["d", -1] == ("t", ["T"]) and got["f", -1] == ("document", ["Document"]) and got["g", 1][0] == "a-1"
    rows = blocks.collect()
    assert len({(r.doc_id, r.block_id) for r in rows}) == len(rows) and {r.section_id for r in rows if r.doc_id == "g"} == {"a-1"}


# ---- chunks --------------------------------------------------------------------------


def test_splitters():
    assert chunking.split_prose("a b. " * 100, 50) and all(len(p) <= 50 for p in chunking.split_prose("a b. " * 100 + "x" * 120, 50))
    code = chunking.split_code("```py\n" + "line = 1\n" * 30 + "```", 60, "py")
    assert all(p.startswith("```py\n") and p.endswith("```") and len(p) <= 60 for p in code) and len(code) > 3
    items = chunking.split_list("- a\n  more\n- " + "b" * 80 + "\n- c", 20)
    assert items == ["- a\n  more", "- " + "b" * 80, "- c"]
    assert chunking.with_overlap(["One. Two.", "Three."], 1) == ["One. Two.", "Two.\n\nThree."]
    assert chunking.split_block("short", 10, "table", None, 2) == ["short"]


def units(blocks, genre="narrative", limit=100, **cfg):
    rows = [{"block_id": f"b{i}", "content_type": ct, "text": t, "language": None} for i, (ct, t) in enumerate(blocks)]
    return list(chunking.section_units(rows, genre, limit, Config(**cfg)))


def test_section_units():
    assert units([("paragraph", "Steps:"), ("list", "- a"), ("paragraph", "`\\`"), ("paragraph", None), ("paragraph", "end:")]) == [("Steps:\n\n- a", "list", None, "b0"), ("end:", "paragraph", None, "b4")]
    faq = units([("paragraph", "Intro"), ("paragraph", "Why?"), ("code", "x"), ("table", "| a |"), ("paragraph", "How?")], genre="faq")
    assert [u[0] for u in faq] == ["Intro", "Why?\n\nx\n\n| a |", "How?"]
    packed = units([("paragraph", "a" * 60), ("paragraph", "b" * 60), ("code", "c"), ("list", "- d")], merge_prose=True)
    assert [(u[1], u[3]) for u in packed] == [("paragraph", "b0"), ("paragraph", "b1"), ("code", "b2"), ("paragraph", "b3")]
    assert len(units([("paragraph", "a"), ("code", "c"), ("table", "| t |")], merge_definitions=True)) == 2


def test_chunks_keep_all_text(spark):
    b = spark.createDataFrame([("d", "s", i, f"b{i}", "paragraph", f"Sentence number {i} stands here. " * 20, None) for i in range(6)] + [("d", "s", 9, "b9", "code", None, None)], "doc_id string, section_id string, seq int, block_id string, content_type string, text string, language string")
    s = spark.createDataFrame([("d", "s", "narrative", 300), ("d", "none", "general", 300)], "doc_id string, section_id string, genre string, width int")
    rows = chunking.chunks(b, s).collect()
    assert len({r.chunk_id for r in rows}) == len(rows) and all(len(r.content) <= 300 for r in rows)
    assert sorted(" ".join(r.content for r in sorted(rows, key=lambda r: r.chunk_id)).split()) == sorted((" ".join(f"Sentence number {i} stands here. " * 20 for i in range(6))).split())


def test_embedding_text(spark):
    arr = lambda *v: F.array(*[F.lit(x) for x in v]) if v else F.array().cast("array<string>")
    head = chunking.embed_header(crumb=arr("Doc", "API:"), section_type=F.lit("api"), genre=F.lit("howto"), keywords=arr("api", "Kafka", "kafka"), tags=arr("api", "lang:cobol", "x"), depends_on=arr("db"), exposes=arr())
    assert spark.range(1).select(head).first()[0] == "[api] Doc > API: | genre: howto | keywords: Kafka | tags: x | depends on: db"
    empty = chunking.embed_header(crumb=arr(), section_type=F.lit("content"), genre=F.lit("general"), keywords=arr(), tags=arr(), depends_on=arr(), exposes=arr())
    assert spark.range(1).select(empty).first()[0] == ""
    assert of(spark, chunking.table_summary, ["| a |\n| --- |\n| 1 |\n| 2 |", "|  |\n| - |\n| x |", "no table"]) == ["| a |\n| --- |\n(table, 2 data rows)", "|  |\n(table, 2 data rows)", "no table"]
    meta = spark.sql("select map('raw_entities', array('a', 'zz'), 'ner:org', array('b'), 'f', array('q')) as m, 'has a' as c")
    assert meta.select(chunking.scoped_metadata(F.col("m"), F.col("c"))).first()[0] == {"raw_entities": ["a"], "ner:org": [], "f": ["q"]}


# ---- inventory -----------------------------------------------------------------------


def tables(spark, *texts):
    return inventory.parsed_tables(spark.createDataFrame([("d", "s", i, f"b{i}", "table", t) for i, t in enumerate(texts)], "doc_id string, section_id string, seq int, block_id string, content_type string, text string"))


def test_table_records(spark):
    t = tables(spark, "| Service | Owns DB |\n| --- | --- |\n| order-service | orders | extra |", "|  |  |\n| --- | --- |\n| Description | An order service |\n| [todo] | x |", "| Field | Value |\n| --- | --- |\n| Runtime | Go 1.22 |\n| Port |  |", "no separator | here", None)
    got = [(r.block_id, r.field, r.value) for r in inventory.table_records(t).orderBy("block_id", "row_no", "col_no").collect()]
    assert got == [("b0", "service", "order-service"), ("b0", "own db", "orders"), ("b1", "description", "An order service"), ("b2", "runtime", "Go 1.22"), ("b3", "no separator", "here")]
    o = {r.block_id: (list(r.fields), r.orientation) for r in inventory.fields_and_orientation(t).collect()}
    assert o["b0"] == (["service", "own db"], "wide") and o["b1"] == (["description"], "key_value")


def test_prose_reconcile_and_routing(spark):
    texts = spark.createDataFrame([("d", "s", 0, "CQRS uses `cqrs` and OrderStore, order-store in a/b/c. TODO ```\nXYZ\n```"), ("d", "s", 1, None)], "doc_id string, section_id string, seq int, text string")
    got = {r.value: (r.source, r.confidence) for r in inventory.prose_records(texts).collect()}
    assert got == {"CQRS": ("allcaps_regex", 0.9), "OrderStore": ("prose", 0.6), "order-store": ("prose", 0.6), "a/b/c": ("prose", 0.6)}
    rec = spark.createDataFrame([("d", "s", "Kafka", "", "prose", 0.6, "Kafka", 0), ("d", "s", "kafka", "consume", "table_cell", 1.0, "kafka", 1), ("d", "s", "X", "", "x", 0.5, "X", 2), ("d", "s", "Go", "runtime", "table_cell", 1.0, "Go", 3)], "doc_id string, section_id string, canonical string, field string, source string, confidence double, text string, seq int")
    best = inventory.reconcile(rec)
    assert {r.canonical for r in best.collect()} == {"kafka", "X", "Go"}
    assert {r.target: list(r["values"]) for r in inventory.routed_values(best).collect()} == {"depends_on": ["kafka"], "raw_entities": ["X"], "metadata.runtime": ["Go"]}


def test_taxonomies(spark):
    t = tables(spark, "| A | B |\n| - | - |\n| 1 | 2 |", "| A |\n| - |\n| 1 |").withColumn("doc_id", F.concat("doc_id", "block_id"))
    titles = t.select("doc_id", "section_id", F.lit("1.2 Services").alias("title"))
    r = inventory.corpus_taxonomy(t, titles).collect()
    assert [(x.section_key, list(x.fields), x.orientation) for x in r] == [("service", ["a"], "wide")]
    one_doc = t.withColumn("doc_id", F.lit("d"))
    r = inventory.template_taxonomy(one_doc, titles.withColumn("doc_id", F.lit("d")).distinct()).first()
    assert list(r.fields) == ["a", "b"]


# ---- lint ----------------------------------------------------------------------------


def test_lint(spark):
    text = "# A\n\n# B\n\nSee <span>x</span> <b>y</b>\n\n```\n<div>\n```\n{panel}"
    d = spark.createDataFrame([(1, text), (2, None), (3, "word " * 60), (4, "[a b](x) " * 40 + "y")], "doc_id int, text string")
    got = {r.doc_id: [(i.rule, i.severity) for i in r.issues] for r in lint.lint(d).collect()}
    assert got[1] == [("html_leakage", "warn"), ("confluence_artifacts", "block"), ("content_density", "block"), ("orphaned_headings", "warn")]
    assert got[2] == [("content_density", "block")] and got[3] == [] and got[4] == [("link_density", "warn")]
    assert lint.blank_code("a `b` c\n````\n```\nx\n````\ny") == "a     c\n\n\n\n\ny"
    c = spark.createDataFrame([("d", "paragraph", "ok"), ("d", "paragraph", "<div>x"), ("e", "code", "<div>x"), ("f", "paragraph", "  "), ("g", "table", "a<br />b &nbsp;")], "doc_id string, content_type string, text string")
    kept, bad = lint.gate(c)
    assert {r.doc_id for r in kept.collect()} == {"e"} and {r.doc_id for r in bad.collect()} == {"d", "f", "g"}


# ---- search, serving, evaluation -----------------------------------------------------


def test_bm25_micro_corpus(spark):
    c = spark.createDataFrame([("steps", "Install VSCode and configure the remote SSH host."), ("intro", "VSCode is a code editor that calls language servers."), ("docker", "Develop inside a Docker dev container."), ("none", None)], "id string, text string")
    ranked = search.top(search.bm25(c, "id", F.col("text"), search.query_terms(spark, {"q": "install vscode", "k": "kubernetes helm", "e": ""})), 5).collect()
    assert [(r.query_id, r.id) for r in sorted(ranked, key=lambda r: r["rank"])] == [("q", "steps"), ("q", "intro")]
    assert search.bm25(c.limit(0), "id", F.col("text"), search.query_terms(spark, {"q": "x"})).count() == 0


def test_dense_ties_fusion_and_provenance(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.0])], "id int, v array<float>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, qvec array<float>")
    got = search.top(search.dense(v, "id", "v", q, 3), 3).orderBy("rank").collect()
    assert [(r.id, round(r.score, 6)) for r in got] == [(1, 1.0), (3, 1.0), (2, 0.0)]
    a = spark.createDataFrame([("q", "x", 1), ("q", "y", 2)], "query_id string, id string, rank int")
    assert {r.id: r.score for r in search.fuse(a, a.where("id = 'y'").withColumn("rank", F.lit(1))).collect()} == pytest.approx({"x": 1 / 61, "y": 1 / 62 + 1 / 61})
    assert search.route({"provider": "lexical"}) == "lexical" and search.route({}, Config(hybrid=True)) == "hybrid" and search.route({}) == "dense"
    assert search.check_provenance({"model": "a", "embed_format": 3}, {"model": "a", "embed_format": 4}) and search.check_provenance(None, {}) == []
    with pytest.raises(ValueError):
        search.check_provenance({"model": "a"}, {"model": "b"})
    with pytest.raises(ValueError):
        search.apply_filters(v, nothing="x")
    assert search.result_records(spark.createDataFrame([(0.123456, "abcdef")], "score double, c string"), "c", 3).first() == (0.1235, "abc...")


def test_serving(spark):
    s = spark.createDataFrame([(f"c{i}", k, float(i)) for i, k in enumerate(["overview", "architecture", "decision", "api", "overview", "overview", "overview", "content"])], "chunk_id string, section_type string, score double")
    got = {}
    for r in serve.decision_buckets(s).orderBy("bucket", "rank").collect():
        got.setdefault(r.bucket, []).append(r.chunk_id)
    assert got == {"context": ["c6", "c5", "c4"], "decision": ["c2"], "general": ["c7", "c3", "c1"]}
    assert serve.expected_sections("Use a database table") == ("data_model",) and serve.expected_sections("topical") == ()
    with pytest.raises(ValueError):
        serve.checked("x", serve.GENRES, "genre")
    ch = spark.createDataFrame([("a", "Uses Kafka"), ("b", None)], "chunk_id string, content string")
    e = serve.hard_coverage(ch, spark.createDataFrame([("kafka",), ("nope",)], "entity string"))
    soft = spark.createDataFrame([(0.4,)], "score double")
    assert serve.coverage(e.where("entity = 'kafka'"), soft, True) == {"covered": True, "tier": "hard"} and serve.coverage(e, soft, True) == {"covered": True, "tier": "soft"}
    assert serve.coverage(e, soft.where("score > 1"), True) == {"covered": False, "tier": "soft"} and serve.coverage(e, soft, False)["tier"] == "none"


def test_evaluation(spark):
    ok, notes = evaluate.judge({"ALL": {"recall_10": 0.6}, "lexical-control": {"recall_10": 0.5}}, {"ALL": {"recall_10": 0.61}, "lexical-control": {"recall_10": 0.6}})
    assert not ok and len(notes) == 1
    assert evaluate.judge({"ALL": {"recall_10": 0.5}}, None) == (True, ["no baseline"]) and not evaluate.judge({"ALL": {"recall_10": 0.4}}, None)[0]
    res = spark.createDataFrame([("q", "d", 1, "A > B"), ("q", "d", 2, "A > Config")], "query_id string, doc_id string, rank int, breadcrumb string")
    m = spark.createDataFrame([("q", "m1", "d", "config"), ("q", "m2", "d", None), ("q", "m3", "x", None)], "query_id string, matcher_id string, doc_id string, section string")
    assert {r.matcher_id: r["rank"] for r in evaluate.matched_sections(res, m).collect()} == {"m1": 2, "m2": 1}


def test_store(spark, tmp_path):
    s = store.ChunkStore(spark, str(tmp_path / "idx"))
    df = lambda *rows: spark.createDataFrame(rows, "chunk_id string, doc_id string, n int")
    assert s.read() is None and s.count() == 0 and s.delete(["x"]) == 0 and s.provenance() == {}
    s.upsert(df(("a", "d", 1), ("b", "e", 1)))
    s.upsert(df(("a", "d", 2), ("c", "d", 2)))
    assert {r.chunk_id: r.n for r in s.read().collect()} == {"a": 2, "b": 1, "c": 2}
    assert s.delete(["d"]) == 2 and s.count() == 1
    s.write_provenance("hashing", "md5", 512)
    assert s.provenance()["embed_format"] == store.EMBED_FORMAT
    s.reset()
    assert s.read() is None


def test_report(spark):
    rows = spark.createDataFrame([("a", "one two three", "one three"), ("b", "", ""), ("c", "x", "")], "doc_id string, before string, after string")
    assert {r.doc_id: (r.retention, r.dropped) for r in report.retention(rows).collect()} == {"a": (0.6667, "two"), "b": (1.0, ""), "c": (1.0, "")}
    nodes = spark.createDataFrame([(f"n{i:03d}", "entity") for i in range(75)], "id string, kind string")
    shown, left = report.shown_nodes(nodes)
    assert shown.count() == 71 and left.first().n_left_out == 4


def test_hot_keys(spark):
    df = spark.createDataFrame([("h",)] * 50 + [(f"k{i}",) for i in range(50)], "k string")
    assert hot_keys(df, "k", least_rows=10) == ["h"] and hot_keys(df, "k") == [] and hot_keys(df.limit(0), "k") == []


# ---- usage ---------------------------------------------------------------------------


def log_line(mid, req="r", model="claude-opus-4", tin=10, **extra):
    return json.dumps({"type": "assistant", "sessionId": "s1", "timestamp": "2025-01-02T03:04:05Z", "requestId": req, "message": {"id": mid, "model": model, "role": "assistant", "content": [{"type": "text", "text": "x"}], "usage": {"input_tokens": tin, "output_tokens": 2}}} | extra)


def test_session_logs(spark, tmp_path):
    lines = [log_line("m1"), log_line("m1"), log_line("m2", model="<synthetic>"), log_line("m2"), "not json", '{"usage": 1', log_line(None), log_line(None), log_line("m3", tin=5, costUSD=0.5), log_line("m4", model="claude-opus-4-1", timestamp=None)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "sess.jsonl").write_text("\n".join(lines))
    msgs = usage.session_messages(logs.session_logs(spark, str(tmp_path)))
    rows = msgs.collect()
    assert len(rows) == 5 and {r.day for r in rows} == {"2025-01-02", "?"}
    assert sorted(round(r.cost, 8) for r in rows) == [0.0001, 0.0001, 0.0001, 0.0003, 0.5]
    assert usage.session_messages(logs.session_logs(spark, str(tmp_path)), since="2026-01-01").count() == 1
    t = {(r.level, r.model, r.day): r.messages for r in usage.totals(msgs).collect()}
    assert t["all", None, None] == 5 and t["day", None, "?"] == 1
    user = [json.dumps({"type": "user", "sessionId": "s", "timestamp": "t", "cwd": "/w", "message": {"role": "user", "content": c}} | e) for c, e in (("hello", {}), ([{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}], {}), ("<command-x>", {}), ("meta", {"isMeta": True}), ("tool", {"toolUseResult": {"a": 1}}))]
    (tmp_path / "p" / "u.jsonl").write_text("\n".join(user))
    assert sorted(r.prompt for r in usage.prompts(logs.log_messages(spark, str(tmp_path))).collect()) == ["a\nb", "hello"]


def test_billing_csv(spark, tmp_path):
    f = tmp_path / "r.csv"
    f.write_text('﻿Model , Date,Quantity,gross_amount,net_amount,exceeds_quota,username\ngpt,2025-01-01,"1,000",$2.50,x,TRUE,"a, b"\ngpt,2025-01-02,2,1,1,false,\n,,,,,,z\n', encoding="utf-8")
    got = {r.model: r for r in usage.billing_totals(logs.billing_csv(spark, str(f))).collect()}
    assert (got["gpt"].quantity, got["gpt"].billed, got["gpt"].gross, got["gpt"].net, got["gpt"].users, got["unknown"].rows) == (1002.0, 1000.0, 3.5, 1.0, 1, 1)
    f.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        logs.billing_csv(spark, str(f))


def test_rates(spark):
    assert of(spark, lambda c: usage.rate(c, "in"), ["gpt-4.1-mini", "GPT-4o-mini", "x", None]) == [2.0, 2.5, 1.0, 1.0]


ATTR = lambda k, v: {"key": k, "value": {"stringValue": v} if isinstance(v, str) else {"intValue": str(v)}}


def test_otlp_json(spark):
    span = lambda **a: {"name": "chat", "startTimeUnixNano": "1700000000000000000", "attributes": [ATTR(k.replace("__", "."), v) for k, v in a.items()]}
    whole = {"resourceSpans": [{"resource": {"attributes": [ATTR("session.id", "S")]}, "scopeSpans": [{"spans": [span(gen_ai__request__model="m", gen_ai__usage__input_tokens=5, gen_ai__response__id="r1"), span(gen_ai__request__model="m", gen_ai__usage__input_tokens=5, gen_ai__response__id="r1"), span(gen_ai__operation__name="invoke_agent", gen_ai__usage__input_tokens=99)]}]}]}
    metric = {"resourceMetrics": [{"resource": {"attributes": [ATTR("session.id", "T")]}, "scopeMetrics": [{"metrics": [{"name": "token.usage", "sum": {"dataPoints": [{"attributes": [ATTR("type", "output"), ATTR("model", "m")], "timeUnixNano": "1700000000000", "asInt": "7"}]}}, {"name": "cost", "gauge": {"dataPoints": [{"attributes": [ATTR("model", "m")], "asDouble": 0.5}]}}, {"name": "other", "sum": {"dataPoints": [{"asInt": "1"}]}}]}]}]}
    bare = {"spans": [span(model="b", output_tokens=3)]}
    lines = spark.createDataFrame([(json.dumps(x),) for x in (whole, metric, bare)] + [("no json",), (json.dumps({"a": 1}),)], "value string")
    rec = otel.json_records(lines)
    use = {(r.session, r.model): (r.tokens_in, r.tokens_out, r.logged_cost) for r in otel.usage_records(rec).where("tokens_in > 0 or tokens_out > 0").collect()}
    assert use == {("S", "m"): (5, 0, 0.0), ("T", "m"): (0, 7, 0.0), ("unknown", "b"): (0, 3, 0.0)}
    assert {str(r.ts)[:19] for r in rec.where("ts is not null").select("ts").collect()} == {"2023-11-14 22:13:20"}
    assert {r["shape"] for r in otel.line_shapes(lines).collect()} >= {"resourceSpans", "a"}


def pb(number, data):
    head = bytes([(number << 3) | 2])
    n, out = len(data), b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return head + out + bytes([n]) + data


def test_otlp_protobuf(spark, tmp_path):
    attr = lambda k, v: pb(1, k.encode()) + pb(2, pb(1, v.encode()) if isinstance(v, str) else bytes([3 << 3]) + bytes([v]))
    point = pb(7, attr("model", "m")) + bytes([(3 << 3) | 1]) + struct.pack("<Q", 1_700_000_000_000_000_000) + bytes([(6 << 3) | 1]) + struct.pack("<q", 42)
    metric = pb(1, b"token.usage") + pb(7, pb(1, point))
    body = pb(1, pb(1, pb(1, attr("session.id", "S"))) + pb(2, pb(2, metric)))
    got = otel.decode_protobuf(body, "metric")
    assert got == [{"kind": "metric", "name": "token.usage", "value": 42.0, "ts": 1.7e9, "session": "S", "attributes": {"model": "m"}}]
    span = pb(5, b"chat") + bytes([(7 << 3) | 1]) + struct.pack("<Q", 1_700_000_000_000_000_000) + pb(9, attr("input_tokens", 9))
    (tmp_path / "a.pb").write_bytes(pb(1, pb(2, pb(2, span))))
    (tmp_path / "bad.pb").write_bytes(b"\xff\xff")
    rows = otel.usage_records(otel.protobuf_folder(spark, str(tmp_path), "span")).collect()
    assert [(r.session, r.tokens_in) for r in rows] == [("unknown", 9)]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.sql("select 'r' || (id % 10) as response_id, if(id % 4 = 0, null, 'r' || (id % 10)) as maybe, timestamp_seconds(1700000000 + id) as ts, 'g' as grp, 'm' as model, id as tokens_in, id as tokens_out from range(20)")
    rows.write.parquet(str(tmp_path / "in"))
    live = stream.event_stream(spark, str(tmp_path / "in"), rows.schema)
    q = stream.snapshot_sink(stream.running_totals(stream.deduplicated(live, "maybe", late=None)), str(tmp_path / "out"), str(tmp_path / "state"), "complete")
    q.awaitTermination()
    n = spark.read.parquet(str(tmp_path / "out")).first()
    batch = stream.running_totals(stream.deduplicated(rows, "maybe")).first()
    assert n.tokens_in <= sum(range(20)) and n.first_ts is not None and batch.model == n.model
    assert stream.deduplicated(rows, "maybe").count() == 5 + rows.where("maybe is not null").select("maybe").distinct().count()
    kept = stream.deduplicated(live, "response_id").writeStream.format("memory").queryName("kept").trigger(availableNow=True).start()
    kept.awaitTermination()
    assert spark.table("kept").count() == 10


# ---- files, pages, diagrams ----------------------------------------------------------


def test_file_sources(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text("# Hi\n")
    (tmp_path / "ok.html").write_text("<p>x</p>")
    (tmp_path / "bad.html").write_text("<ac:image/>")
    md = files.markdown_folder(spark, str(tmp_path)).collect()
    assert len(md) == 1 and len(md[0].doc_id) == 12 and md[0].source_path.endswith("a/x.md")
    pages, rejects = files.html_folder(spark, str(tmp_path))
    assert pages.count() == 1 and rejects.count() == 1
    (tmp_path / "m.yaml").write_text("entries:\n- {url: 'https://x.example/a', dest: a.md, labels: [l]}\n- {url: 'https://x.example/b'}\n- {url: 'https://x.example/c', dest: '../c'}\n")
    good, bad = files.manifest(spark, str(tmp_path / "m.yaml"))
    assert good.count() == 1 and {r.error for r in bad.collect()} == {"no dest", "dest outside the folder"}
    (tmp_path / "g.json").write_text(json.dumps({"queries": [{"id": 1, "text": "q", "expected": [{"doc": "d"}]}]}))
    q, m = files.golden_set(spark, str(tmp_path / "g.json"))
    assert q.first().category == "general" and m.first().section is None
    files.write_vocabulary([" b ", "a", "b", ""], str(tmp_path / "v.json"))
    assert files.read_vocabulary(str(tmp_path / "v.json")) == ["a", "b"] and files.read_vocabulary(str(tmp_path / "none.json")) == [] and files.read_taxonomy(str(tmp_path / "none.json")) == {}
    assert structure.front_matter(files.front_matter_text({"title": "A: b", "labels": ["x"], "author": None}) + "text")[0]["title"] == "A: b"
    (tmp_path / "ctx" / "s").mkdir(parents=True)
    (tmp_path / "ctx" / "CLAUDE.md").write_text("x" * 40)
    (tmp_path / "ctx" / "s" / "SKILL.md").write_text("---\nname: s\n---\nbody")
    got = {(r.ecosystem, r.path): (r.load, r.startup_chars, r.invoke_chars) for r in files.context_files(spark, str(tmp_path / "ctx")).collect()}
    assert got["Claude", "CLAUDE.md"] == ("startup", 40, 0) and got["Claude", "s/SKILL.md"] == ("split", 15, 5)


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = '<w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r><w:r><w:t xml:space="preserve"> text</w:t></w:r></w:p><w:p><w:pPr><w:numPr><w:ilvl w:val="0"/></w:numPr></w:pPr><w:r><w:t>item</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a|b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
        z.writestr("docProps/core.xml", '<c xmlns:dc="d"><dc:title>T</dc:title><dc:creator>me</dc:creator></c>')
    (tmp_path / "a.docx").write_bytes(buf.getvalue())
    (tmp_path / "b.docx").write_bytes(b"no zip")
    rows = {r.source_path[-6:]: r for r in files.docx_folder(spark, str(tmp_path)).collect()}
    assert rows["a.docx"].text == "## Head\n\n**bold** text\n\n- item\n\n| a\\|b |\n| --- |" and rows["a.docx"].title == "T" and "BadZipFile" in rows["b.docx"].error


PAGE = """<html><head><title>SP : My page</title><meta name="ajs-page-id" content="7"><style>x</style></head><body><nav>menu</nav><div id="main-content">
<h1>Top</h1><p>One <b>two</b> &amp; <a href="#x">here</a> <a href="https://u.example">out</a><p>unclosed <i>it
<div class="confluence-information-macro confluence-information-macro-warning"><p class="title">Hot</p><div class="confluence-information-macro-body"><p>Mind it</p><ul><li>a</li></ul></div></div>
<div class="code panel"><pre class="syntaxhighlighter-pre" data-syntaxhighlighter-params="brush: java; gutter: false">SELECT a FROM b</pre></div>
<pre>plain</pre><ul class="inline-task-list"><li class="checked">done</li><li>open<ul><li>sub</li></ul></li></ul><ol start="3"><li>c</li><li>d</li></ol>
<table><tr><th>H|1</th><th>H2</th></tr><tr><td><p>x</p><p>y</p></td></tr></table><img class="emoticon" data-emoticon-name="tick"><span class="status-macro">DONE</span><script>var a = '</p>';</script>
<blockquote>said</blockquote></div></body></html>"""


def test_html_conversion(spark):
    got = convert.convert_html(PAGE)
    md = got["markdown"]
    for part in ("# Top", "One **two** & here [out](https://u.example)", "> **Warning — Hot:**", "> Mind it", "> - a", "```sql\nSELECT a FROM b\n```", "```\nplain\n```", "- [x] done", "  - [ ] sub", "3. c\n4. d", "| H\\|1 | H2 |", "| x; y |  |", "(yes)", "**DONE**", "> said"):
        assert part in md, part
    assert "menu" not in md and "var a" not in md and got["title"] == "My page" and got["meta"]["space"] == "SP" and got["meta"]["page_id"] == "7" and got["macro_counts"]["warning"] == 1
    d = spark.createDataFrame([(1, PAGE), (2, None), (3, "<ri:page/>"), (4, "<p>bare</p>"), (5, "")], "doc_id int, text string")
    assert {r.doc_id: r.status for r in convert.convert_pages(d).collect()} == {1: "ok", 2: "error", 3: "rejected", 4: "quarantine", 5: "quarantine"}
    assert convert.visible_text("<p>a</p><script>b</script><nav>c</nav>d") == "a d"
    assert convert.tidy("a\xa0b  \n\n\n\n``` py\nx  \n\n\n\ny\n```\n- \\[x\\] t\n") == "a b\n\n```py\nx  \n\n\n\ny\n```\n- [x] t\n"


STAGE = json.dumps({"stage": {"objects": [
    {"id": 1, "x": 10, "y": 20, "width": 100, "height": 50, "order": 2, "graphic": {"type": "Shape", "Shape": {"tid": "com.x.ellipse", "fillColor": "#FFF", "strokeWidth": 2, "dashStyle": "8,2"}}, "children": [{"id": 2, "x": 5, "y": 5, "order": 0, "graphic": {"type": "Text", "Text": {"html": "<p>Hi&nbsp;<b>you</b></p>"}}}, {"id": 3, "x": 1, "y": 2, "width": 4, "height": 4, "order": 1, "graphic": {"type": "Shape", "Shape": {"tid": "database"}}}]},
    {"id": 4, "x": 1, "y": 1, "order": 1, "graphic": {"type": "Line", "Line": {"controlPath": [[0, 0], [5, 7]], "endArrow": 1}}},
]}})


def test_diagrams(spark):
    nodes, edges = diagrams.parse_stage(STAGE)
    assert [(n["kind"], n["x"], n["y"], n["text"]) for n in nodes] == [("ellipse", 10.0, 20.0, "Hi you"), ("cylinder", 11.0, 22.0, "")] and edges[0]["points"] == [{"x": 1.0, "y": 1.0}, {"x": 6.0, "y": 8.0}]
    rows = spark.createDataFrame([("a", STAGE), ("b", "not json"), ("c", "{}")], "source string, text string")
    assert diagrams.round_trip(rows).count() == 0
    parsed = diagrams.parse_diagrams(rows)
    assert parsed.where("error is not null").count() == 1 and {(r.kind, r.n) for r in diagrams.diagram_metrics(parsed).collect()} == {("ellipse", 1), ("cylinder", 1), ("edge", 1)}
    moved = diagrams.parse_diagrams(spark.createDataFrame([("a", STAGE.replace('"x": 10', '"x": 10.4').replace('"fillColor": "#FFF"', '"fillColor": "#000"').replace('"tid": "database"', '"tid": "note"'))], "source string, text string"))
    assert {(r.part, r.id, r.field) for r in diagrams.compare(parsed.where("source = 'a'"), moved).collect()} == {("nodes", "n0000", "fill"), ("nodes", "n0001", "kind")}
    assert "<ellipse" in diagrams.render_svg(nodes, edges) and "Hi you" in diagrams.render_svg(nodes, edges)
    assert of(spark, diagrams.shape_kind, ["x.Rectangle", "flow.decision"]) == ["rect", "diamond"]
