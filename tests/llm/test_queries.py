"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from compare import differences, duck

import corpus_pipeline
from llm.test_corpus_operators import SENTENCES, _components, _near_docs, _plain_print
from sparktide.llm import exact_dedup, mixing
from sparktide.llm.queries import QUERIES


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, folder, name):
    assert differences(QUERIES[name].build(spark, folder), duck(folder), QUERIES[name].sql) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_query_has_a_row_per_document(spark, folder, name):
    found = QUERIES[name].build(spark, folder)
    given = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert found.where("doc_id is not null").count() == given


def _one_of_each_group(docs):
    """The smallest id of each group that fingerprints within four bits connect."""
    prints = [(r.doc_id, _plain_print(r.text)) for r in docs]
    pairs = [(a, b) for n, (a, x) in enumerate(prints) for b, y in prints[:n] if (x ^ y).bit_count() <= 4]
    return set(_components(pairs, [i for i, _ in prints]).values())


def test_stages_do_what_they_say(spark, docs_of, library, work):
    rows = [(i, t, "en", f"src{i % 3}") for i, t in _near_docs()]
    rows += [(5_000 + i, t, lang, "src0") for i, (lang, t) in enumerate(SENTENCES.items())]
    rows += [(6_000 + i, " ".join(t.split()[::-1]), lang, "src0") for i, (lang, t) in enumerate(SENTENCES.items())]
    rows += [(9_000, rows[0][1], "en", "src1"), (9_001, "12 34 !!", "en", "src1"), (9_002, None, "en", "src1")]
    docs_of(rows).drop("digest").write.parquet(f"{work}/documents.parquet")
    docs, kept = spark.read.parquet(f"{work}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "bpe"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{work}/{name}"
        stage(spark, docs, work).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns[:5] == columns
        kept[name] = docs.collect()
    ids = {n: {r.doc_id for r in rs} for n, rs in kept.items()}
    assert ids["language"] == {r[0] for r in rows} - {9_001, 9_002}
    assert ids["exact_dedup"] == ids["language"] - {0}  # equal to 9000, which is larger
    assert ids["near_dedup"] == _one_of_each_group(kept["exact_dedup"])
    assert len(ids["near_dedup"]) < len(ids["exact_dedup"])
    size = sum(len(r.text.split()) for r in kept["near_dedup"])
    assert abs(sum(len(r.text.split()) for r in kept["mixing"]) - 1.5 * size) <= 0.02 * size
    assert {r.text for r in kept["mixing"] if r.text in {x.text for x in kept["near_dedup"]}}
    for r in kept["bpe"]:
        assert list(memoryview(r.ids).cast("I")) == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4 and r.round_trip
    assert corpus_pipeline.run(spark, work).count() == len(kept["bpe"])


def test_stages_of_empty_tables(spark, docs_of, work):
    docs_of([]).drop("digest").write.parquet(f"{work}/documents.parquet")
    assert corpus_pipeline.run(spark, work).count() == 0


def test_operators_leave_their_input_alone(docs_of):
    docs = docs_of([(1, "a b", "en", "s"), (2, "a b", "en", "s")])
    assert exact_dedup.drop_exact_duplicates(docs).columns == docs.columns
    assert mixing.take(docs).columns == docs.columns
