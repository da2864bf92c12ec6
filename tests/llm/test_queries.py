"""Registered corpus queries beside their SQL twins, and the pipeline beside its operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from check_oracles import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from traceframe.llm import queries  # noqa: E402
from traceframe.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    rows, outcome = compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.ORACLES[name])
    assert outcome == "match", outcome
    assert rows > 0


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in queries.QUERIES}) == list(range(1, 14))


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == table(spark, SF, "documents").columns
            before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
            assert after.keys() <= before.keys() and len(after) > 0
            if name != "personal_data":
                assert all(before[i] == t for i, t in after.items())
            docs = out
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_stages_take_awkward_rows(spark):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "some text here", "en", "a", 14), (3, "write to me@site.org", "en", "a", 20), (3, "write to me@site.org", "en", "a", 20), (4, "idiot", "en", "b", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for source in (frame, frame.limit(0)):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name == "near_duplicates" and source is frame:
                assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "3", "4", "None"]
            if name == "personal_data" and source is frame:
                assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}[3] == ("write to <EMAIL>", 16)
