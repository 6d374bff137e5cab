"""Columns of the input whose names operators use inside, repeated rows, null ids and empty tables."""

import pytest
from pyspark.sql import functions as F

from presslens.llm import jaccard, line_dedup, mixing, mpeg, toxicity, vectors

CLASHES = ["m_size", "m_source", "m_target", "t_node", "g_id", "g_node", "node", "text_bytes", "first", "k_id", "d_text", "d0", "d1", "row", "times", "k_gone"]
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "s", *[f"{c}{i}" for c in CLASHES]) for i, t in texts], SCHEMA)


def others(rows):
    return sorted(repr((r["doc_id"], *[r[c] for c in CLASHES])) for r in rows)


TEXTS = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, ""), (None, "seven eight"), (5, "a\nb\nc\nd")]


def test_other_columns_stay_as_they_are(spark):
    docs = frame(spark, TEXTS)
    want = others(docs.collect())
    assert others(mixing.repetition_plan(docs).collect()) == want
    assert others(line_dedup.dedup_lines(docs).collect()) == want
    assert others(mpeg.read_mpeg(mpeg.write_mpeg(docs)).collect()) == want
    assert others(toxicity.score(docs, None).collect()) == want
    kept = jaccard.keep_one(docs).collect()
    assert others(kept) == [w for w in want if w != others(docs.filter("doc_id = 2").collect())[0]]
    assert jaccard.keep_one(docs).columns == docs.columns


def test_clashing_names_in_empty_tables(spark):
    docs = frame(spark, [])
    for out in (mixing.repetition_plan(docs), mpeg.write_mpeg(docs), jaccard.keep_one(docs), line_dedup.dedup_lines(docs)):
        assert out.collect() == []


VECTOR = "vec_id long, embedding array<float>, label int, component_id string, class string"


def test_vectors_of_null_and_repeated_ids(spark):
    """1 and its copies (under a null id, and again under 1) are linked; 2 is far; 3 has no label; 4 is zero; 5 has a hole."""
    one, far = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(1, one, 0), (None, one, 0), (1, one, 0), (2, far, 0), (3, one, None), (4, [0.0, 0.0, 0.0], 0), (5, [None, 1.0, 0.0], 0), (6, None, 0), (7, one, 1), (8, [], 0), (9, [float("nan"), 1.0, 0.0], 0)]
    got = vectors.near_vectors(spark.createDataFrame([(*r, "x", "y") for r in rows], VECTOR)).collect()
    want = [(1, 2, 1, True), (None, 2, None, True), (1, 2, 1, True), *[(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 9)]]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert vectors.near_vectors(spark.createDataFrame([], VECTOR)).collect() == []


@pytest.mark.parametrize("column", ["size", "rate", "copies"])
def test_columns_of_the_plan_replace_those_of_the_input(spark, column):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string").withColumn(column, F.lit("old"))
    assert mixing.repetition_plan(docs).columns.count(column) == 1
