"""op12: license phrases and notices against a plain scan."""

import random
import re

import pytest

from presslens.llm import licenses, queries
from tests.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(licenses.UPPER, licenses.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def base(text):
    """n_words, n_base, first_word, last_word, base_labels by comparing at every place."""
    w = words(text)
    found = [(i, label) for label, phrase in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def coverage(text, notice):
    """Largest share of the notice's words covered by shared grams on diagonals that lie together."""
    w, t = words(text), words(notice)
    k = min(licenses.GRAM, len(t))
    diagonals = {}
    for p in range(len(w) - k + 1):
        for q in range(len(t) - k + 1):
            if w[p : p + k] == t[q : q + k]:
                diagonals.setdefault(p - q, []).append((p, q))

    def covered(hits):
        return len({q + j for _, q in hits for j in range(k)})

    best, run, before = 0, [], None
    for d in sorted(diagonals):
        run = run + diagonals[d] if before is not None and d - before <= licenses.SLACK else diagonals[d]
        before = d
        best = max(best, covered(diagonals[d]))
        after = min((x for x in diagonals if x > d), default=None)
        if (after is None or after - d > licenses.SLACK) and 2 * (max(p for p, _ in run) + k - min(p for p, _ in run)) <= 3 * len(t):
            best = max(best, covered(run))
    return best / len(t)


def plain(text):
    n_words, n_base, first, last, labels = base(text)
    found = {label: c for label, notice in licenses.NOTICES if (c := coverage(text, notice)) >= licenses.LEAST}
    every = sorted({*filter(None, labels.split(",")), *found})
    return n_words, n_base, first, last, labels, ",".join(every), max([*found.values(), *[1.0] * bool(n_base)], default=0.0)


def figures(frame):
    return sorted(repr((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])) for r in frame.collect())


def test_query_equals_its_sql(same):
    same(queries.op12_licenses, queries.ORACLE_SQL["op12_licenses"])


def edited(draw):
    """A notice with words left out, put in and changed, among others."""
    said = draw.choice(licenses.NOTICES)[1].split(" ")
    for _ in range(draw.randrange(0, 6)):
        at = draw.randrange(len(said))
        said[at : at + draw.randrange(0, 3)] = draw.choice([[], ["word"], ["the", "License"]])
        said = said or ["x"]
    around = [draw.choice(["the", "License", "of", "MIT", "Öl", "İcense", "under"]) for _ in range(draw.randrange(0, 30))]
    at = draw.randrange(len(around) + 1)
    return draw.choice([" ", "\n", " - "]).join(around[:at] + said + around[at:])


def test_scan_equals_plain_scan_of_edited_notices(spark):
    draw = random.Random(4)
    texts = [edited(draw) for _ in range(300)]
    texts += [None, "", "...", "mit", "MIT License", "mit license mit license general public license license", "MIT Lİcense", "the MIT\x00License", "mit license " * 3000, "MIT License. Released under the MIT License."]
    rows = [(k % 50 or None, t, "x", 1) for k, t in enumerate(texts)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, label string, start int").repartition(3)
    assert figures(licenses.scan(frame)) == sorted(repr((i, *plain(t))) for i, t, _, _ in rows)


def test_query_equals_plain_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op12_licenses(spark, SF)
    assert figures(got) == sorted(repr((r["doc_id"], *plain(r["text"]))) for r in docs)
    assert got.filter("n_base > 0").count() > 0 and got.filter("n_base = 0").count() > 0


def test_main_path_is_native(spark):
    plan = queries.op12_licenses(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_and_bad_phrases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(empty).collect() == []
    with pytest.raises(ValueError, match="2 to 3 words"):
        licenses.scan(empty, phrases=[("x", "one")])
