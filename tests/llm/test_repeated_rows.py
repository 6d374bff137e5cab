"""Ids that repeat, null ids, ties and empty tables in the Jaccard join and the pipeline."""

import pytest

import corpus_pipeline as pipeline
from presslens.llm import jaccard
from presslens.shared import materialise
from tests.llm.test_operators import DOCS, classes, shingles


def words(name, n=100):
    return [f"{name}{i}" for i in range(n)]


A, B, Q = words("a"), words("b", 60), words("q", 2)
TABLES = {
    "unrelated text of one id": [(1, A), (3, B), (3, A[:-1]), (5, B + Q)],
    "id between two groups": [(7, A[:-1]), (7, B), (8, B[:-1]), (9, A)],
    "equal rows": [(9, A), (9, A), (12, A[1:]), (12, A[1:])],
    "null ids": [(None, A), (None, B), (None, A), (4, A[:-1]), (None, [])],
}


@pytest.mark.parametrize("name", TABLES)
def test_jaccard_with_ids_that_repeat(spark, name):
    rows = [(i, " ".join(x)) for i, x in TABLES[name]]
    sets = [shingles(t, 5) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = classes(range(len(rows)), near)
    least = {c: min((rows[r][0] for r in top if top[r] == c and rows[r][0] is not None), default=None) for c in top.values()}
    frame = spark.createDataFrame([(i, t, "en", "s", k, "x", 1) for k, (i, t) in enumerate(rows)], DOCS)
    got = sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in jaccard.jaccard_components(frame).collect())
    assert got == sorted(repr((i, len(sets[k]), least[top[k]])) for k, (i, _) in enumerate(rows))
    kept = [r["n_chars"] for r in jaccard.keep_one(frame).collect()]
    assert len({top[k] for k in kept}) == len(kept) == len(set(top.values()))
    assert all(rows[k][0] == least[top[k]] for k in kept)


def test_pipeline_on_an_empty_table_and_on_edges(spark, tmp_path):
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "one", "en", "b", 3), (3, "one", "en", "b", 3), (None, "one two", "en", "a", 7), (None, "one two", "en", "a", 7), (4, "word " * 3000, "en", "a", 15000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for made, n in (([], 0), (rows, 5)):
        docs = spark.createDataFrame(made, schema)
        for k, (name, stage) in enumerate(pipeline.STAGES):
            docs = materialise(stage(spark, docs, str(tmp_path)), f"edges-{k}")
            if k == 2:
                assert docs.count() == n
            if k < len(pipeline.STAGES) - 1:
                assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        assert (docs.count() > 0) == (n > 0)
