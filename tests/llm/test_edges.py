"""Every query and stage on nulls, empty texts, ties, repeated rows, clashing columns and empty tables."""

from collections import Counter

import pytest
from conftest_texts import TEXTS  # noqa: F401

NAMES = ["op1_sentencepiece", "op2_near_duplicates", "op3_secrets", "op5_fingerprints", "op6_toxicity", "op7_license_scan", "op8_language_id", "op9_coded_ids", "op10_decontamination", "op11_suffix_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(llm, sf_dir, name):
    from adjudica.llm.queries import QUERIES

    got = QUERIES[name].run(llm, sf_dir).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in TEXTS)


@pytest.mark.parametrize("name", [*NAMES, "op4_url_filter", "op12_filter_audit", "op13_ranked_search"])
def test_empty_tables(llm, sf_dir, tmp_path, name):
    from adjudica.llm.queries import QUERIES

    empty = tmp_path / "empty"
    for t in ("documents", "labels", "benchmark", "pages"):
        llm.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(str(empty / f"{t}.parquet"))
    assert QUERIES[name].run(llm, str(empty)).collect() == []


def test_captures_without_url(llm, sf_dir):
    from adjudica.llm.queries import QUERIES

    got = {r["page_id"]: r["verdict"] for r in QUERIES["op4_url_filter"].run(llm, sf_dir).collect()}
    assert len(got) == 5 and got[2] == "none" and got[3] == "none"


def test_pipeline_on_odd_rows(llm, sf_dir):
    import corpus_pipeline

    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs.columns, function(llm, docs, sf_dir).cache()
        seen[name] = sorted((r["doc_id"] or 0) for r in docs.collect())
        if name != "encode":
            assert docs.columns == before
    assert 3 not in seen["language"] and 4 not in seen["language"] and 5 not in seen["language"]
    assert seen["near_dedup"].count(1) == 1 and 2 not in seen["near_dedup"] and seen["near_dedup"].count(6) == 1 and 7 not in seen["near_dedup"]
    # Items 1 and 2 stand in documents 1 and 6.
    assert seen["decontaminate"] == [0, 8, 9] and seen["encode"] == [0, 8, 9]


def test_pipeline_judges_rows_that_share_an_id_by_their_own_text(llm, sf_dir):
    import corpus_pipeline

    text = lambda x, end="": " ".join(f"{x}{k}" for k in range(60)) + end
    item = " it was seen by all of them there and so on it went"
    dirty = [(None, text("n", item)), (40, text("p", item))]
    clean = [(None, text("o")), (None, text("q")), (40, text("r")), (40, text("s")), (39, text("t"))]
    # A near copy of document 39 and a copy equal in id and text go.
    gone = [(40, text("t", " x")), (40, text("r"))]
    docs = llm.createDataFrame(dirty + clean + gone, "doc_id bigint, text string").repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    left = stages["near_dedup"](llm, docs, sf_dir)
    assert rows(left) == Counter(dirty + clean)
    assert rows(stages["decontaminate"](llm, left, sf_dir)) == Counter(clean)


def test_pipeline_on_an_empty_table(llm, no_docs, sf_dir):
    import corpus_pipeline

    docs = no_docs
    for _, function in corpus_pipeline.STAGES:
        docs = function(llm, docs, sf_dir)
        assert docs.count() == 0
