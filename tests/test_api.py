"""The commands end to end over a small corpus."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillspark import api
from quillspark.config import Config
from quillspark.operators import classify, store, usage

DOCS = [
    ("a", "# Install\n\nInstall the broker with Kafka and configure the remote host.\n\n| Service | Uses |\n| --- | --- |\n| orders | payments |\n\n## Security\n\nTokens must not leave. Keys shall rotate.", "Install guide", "S"),
    ("b", "# Overview\n\nThe editor calls language servers.\n\n```sql\nSELECT 1\n```", "Editor", "T"),
    ("c", "# Bad\n\nSee &nbsp; this.", "Bad page", "S"),
    ("d", None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, text string, title string, space string")


def test_index_and_search(spark, docs, tmp_path):
    s = store.ChunkStore(spark, str(tmp_path / "i"))
    with pytest.raises(ValueError):
        api.query(s, "x")
    got = api.build_index(docs, s)
    assert got["rejected_documents"] == 1 and {r.doc_id for r in s.read().collect()} == {"a", "b"}
    rows = s.read().collect()
    table = next(r for r in rows if r.content_type == "table")
    assert table.embed_text.startswith("Install | genre: howto") or "depends on: payments" in table.embed_text
    assert "depends on: payments" in table.embed_text and "(table, 1 data rows)" in table.embed_text
    hit = api.query(s, "install broker kafka", Config(lexical=True)).first()
    assert hit.doc_id == "a" and hit["rank"] == 1
    assert api.query(s, "install broker", Config(hybrid=True)).count() > 0 and api.query(s, "language servers").first().doc_id == "b"
    assert {r.doc_id for r in api.query(s, "the", Config(lexical=True), space="T").collect()} == {"b"}
    before = s.count()
    again = api.reindex(docs.where("doc_id = 'a'"), s)
    assert again["deleted"] > 0 and s.count() == before
    api.export(s.read(), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == before


def test_lint_vocabulary_and_profiles(spark, docs):
    assert {r.doc_id: r.status for r in api.lint_documents(docs, strict=True).collect()} == {"a": "failed", "b": "failed", "c": "failed", "d": "failed"}
    assert "Kafka" in [r.term for r in api.scan_vocabulary(docs, ["seed"]).collect()]
    flags = {p: tuple(spark.range(1).select(classify.merge_strategy(F.lit(p), Config(profile_routing=True)).alias("s")).first().s) for p in ("technical", "prose", "mixed", None)}
    assert flags == {"technical": (False, True), "prose": (True, False), "mixed": (False, False), None: (False, False)}
    assert tuple(spark.range(1).select(classify.merge_strategy(F.lit("technical"), Config(profile_routing=True, merge_prose=True)).alias("s")).first().s) == (True, False)
    m = spark.createDataFrame([("s1", "1", "/W/a/"), ("s2", "2", "/w/A"), ("s3", "3", None)], "session_id string, ts string, cwd string")
    assert usage.newest_session(m, spark.createDataFrame([("/w/a",), ("/none",)], "path string")).orderBy("workspace").collect() == [("/none", None), ("/w/a", "s2")]
    got = docs.select("doc_id", classify.voted_language(F.col("text")).alias("v")).collect()
    assert {r.v for r in got} == {"en"}
