"""Columns of the input that have the names operators write or join by."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import contamination, line_dedup, mixing, near_duplicates, quality

NAMES = [
    "line_dedup", "_dedup_doc_id", "_dedup_text_key", "_dedup_no_id", "_dedup_runs", "_text_key", "quality", "_quality", "_made",
    "_dropped_id", "_dropped_key", "text_key", "found", "_found", "id", "key", "bands",
]


@pytest.fixture
def clashing(documents):
    run = "\n".join(f"line {i} has these many words in it and some more" for i in range(8))
    rows = [(1, run), (2, "first\n" + run), (3, None), (4, "other words of a text that is alone here")]
    return documents(rows).withColumns({name: F.lit(name) for name in NAMES})


def test_rows_and_columns_stay_with_clashing_names(clashing, labels):
    made = labels([(1, 1, 0), (4, 1, 0)])
    benchmark = clashing.sparkSession.createDataFrame([("b1", "no such passage")], "item_id string, text string")
    for out, ids in (
        (line_dedup.cleaned(clashing), {1, 2, 3, 4}), (quality.kept(clashing, made), None),
        (near_duplicates.one_of_each(clashing), None), (contamination.decontaminated(clashing, benchmark), {1, 2, 3, 4}),
    ):
        assert out.columns == clashing.columns
        rows = out.collect()
        assert all(r[name] == name for r in rows for name in NAMES)
        assert ids is None or {r["doc_id"] for r in rows} == ids


def test_a_result_replaces_a_column_of_its_name(clashing, labels):
    deduplicated = line_dedup.deduplicated(clashing).select("doc_id", "line_dedup.text", "line_dedup.n_deleted").collect()
    assert {r["doc_id"]: r["n_deleted"] for r in deduplicated} == {1: 0, 2: 8, 3: 0, 4: 0}
    judged = quality.classified(clashing, labels([(1, 1, 0)])).select("doc_id", "quality.kept").collect()
    assert {r["doc_id"] for r in judged} == {1, 2, 3, 4} and not any(r["kept"] for r in judged if r["doc_id"] == 3)


def test_mixing_leaves_clashing_columns_alone(clashing):
    assert mixing.mixed(clashing).count() == mixing.mixed(clashing.drop(*NAMES)).count()
