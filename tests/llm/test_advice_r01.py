"""What the first review found missing."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import leaks, queries
from tests.llm.test_problems import NAMES, PASSAGE, blocks, golden


def test_tags_without_partner_are_found(spark, tmp_path):
    texts = ["ends here.</td>", "ends here.</p></div>", "<div> starts here", "plain text", "a code span `</td>` only", "x \\begin{itemize} y"]
    blocks(spark, [(f"d{i}", "S", "paragraph", t) for i, t in enumerate(texts)] + [("d9", "S", "code", "</td>")]).write.parquet(str(tmp_path / "blocks.parquet"))
    got = {(r.block_id, r.markup) for r in queries.p6_found(spark, str(tmp_path)).collect()}
    assert got == {("b0", "html"), ("b1", "html"), ("b2", "html"), ("b5", "latex")}


@pytest.mark.parametrize("share", [0.6, 1.0])
def test_leaks_into_many_documents_are_found(spark, share):
    words = PASSAGE.split()
    part = " ".join(words[: round(len(words) * share)])
    alike = [" ".join(w[::-1].strip(".") if w[0].isdigit() or w.strip(".") in NAMES else w for w in words)]
    alike += [" ".join(w + x if w[0].isdigit() or w.strip(".") in NAMES else w for w in words) for x in ("q7", "w8")]
    decoys = [" ".join(f"{w.strip('.')}x{i}" if w[0].isdigit() or w.strip(".") in NAMES else w for w in words) for i in range(15)]
    texts = [f"Page {i} opens here. {part} It ends on line {i}." for i in range(15)] + decoys + ["Nothing of it stands here."] * 30
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_items(d, golden(spark, PASSAGE, *alike)).collect()}
    assert got == {(i, 0) for i in range(15)}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_aligned_positions_are_a_longest_common_subsequence(a, b):
    at, rest = leaks.aligned(a, b), iter(b)
    assert len(at) == leaks.in_order(a, b) and at == sorted(set(at)) and all(a[i] in rest for i in at)
