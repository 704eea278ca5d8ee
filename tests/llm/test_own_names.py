"""Every stage and operator that keeps columns leaves those of its input alone, whatever their names."""

import pytest

import corpus_pipeline
from llm.conftest import ODD
from llm.test_corpus_operators import SENTENCES, _near_docs
from sparktide.llm import pii

CLASHING = [
    "_key", "_digest", "_read", "_text", "_size", "_source", "_nth", "_cut", "key", "digest", "size", "none", "nth", "cut", "cuts",
    "stays", "fp", "component", "part", "given0", "given1", "given99", "made", "same", "raw", "row", "place", "target",
]

STEPS = [*corpus_pipeline.STAGES, ("pii", lambda spark, docs, folder: pii.find(docs))]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "en", "src0") for i, t in ODD] + [(20 + i, t, "en", f"src{i % 3}") for i, t in _near_docs()]
    rows += [(5_000 + i, t, lang, "src1") for i, (lang, t) in enumerate(SENTENCES.items())]
    columns = [f"{c} string" for c in CLASHING]

    def make(rows):
        return spark.createDataFrame(
            [(*r, 3, *(f"{c} of {r[0]}" for c in CLASHING)) for r in rows],
            ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *columns]),
        )

    return make, rows


@pytest.mark.parametrize("name,stage", STEPS)
def test_columns_come_back_unchanged(spark, clashing, name, stage):
    make, rows = clashing
    docs = make(rows)
    got = stage(spark, docs, "")
    assert [c for c in got.columns if c in docs.columns] == docs.columns
    found = got.collect()
    assert found
    for r in found:
        assert all(r[c] == f"{c} of {r.doc_id}" for c in CLASHING) and r.n_chars == 3
    ids = {i for i, *_ in rows}
    assert {r.doc_id for r in found} <= ids
    if name in ("bpe", "pii"):
        assert len(found) == len(rows)


@pytest.mark.parametrize("name,stage", STEPS)
def test_empty_tables(spark, clashing, name, stage):
    make, _ = clashing
    assert stage(spark, make([]), "").count() == 0
