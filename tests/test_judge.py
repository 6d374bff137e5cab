"""A judge's answers against a plain reading."""

import json

from pyspark.sql import functions as F

from presslens.operators import judge

ITEM = "pool string, idx long, url string, title string, category string, priority int, scope string, home boolean, near boolean, bridge boolean, score double"
KEYWORDS = {"SPORT": ("cup",), "TECH": ("app",)}


def rows(pool, n=6, change=None):
    out = [{"pool": pool, "idx": 10 * i, "url": f"http://x/{i}", "title": f"title {i}", "category": "NEWS", "priority": 0, "scope": "world", "home": False, "near": False, "bridge": False, "score": float(i)} for i in range(n)]
    out[0].update(change or {})
    return [tuple(r[c.split()[0]] for c in ITEM.split(", ")) for r in out]


def run(spark, items, answers, chunk=60):
    frame = spark.createDataFrame(items, ITEM)
    verdicts = judge.judged(frame, spark.createDataFrame(answers, "pool string, chunk long, text string"), F.col("score"), chunk)
    return frame, verdicts, judge.apply(frame, verdicts, 1000, KEYWORDS)


def kept(out, pool):
    return [r["idx"] for r in sorted(out, key=lambda r: (r["chunk"], r["pos"])) if r["pool"] == pool]


HALF = [50, 40, 30]
ANSWERS = [
    ('{"keep": [1, 3]}', [0, 20]),
    ('{"keep": [3, 1, 3]}', [20, 0]),
    ('```json\n{"keep": [2]}\n```', [10]),
    ('Sure:\n```\n{"keep": [2]}\n```\nAnd ```more```', [10]),
    ('{"keep": [0, -1, 7, 99, 6]}', [50]),
    ("{}", []),
    ('{"keep": [1, 2], "title_mismatch": [2]}', [0]),
    ('{"keep": [1], "unknown": 5}', [0]),
    # Not an answer: the better half, the best first.
    (..., HALF),
    (None, HALF),
    ("", HALF),
    ("no JSON", HALF),
    ('{"keep": [1, 3]', HALF),
    ('{"keep": ["one"]}', HALF),
    ('{"keep": [1, null]}', HALF),
    ('{"keep": {"a": 1}}', HALF),
    ('{"keep": [1], "recategorize": {"x": "SPORT"}}', HALF),

]


def test_answers_count_whole_or_not_at_all(spark):
    """Every case in a pool of its own; a pool without an answer is missing from the table."""
    items = [r for k in range(len(ANSWERS)) for r in rows(f"p{k}")]
    answers = [(f"p{k}", 0, text) for k, (text, _) in enumerate(ANSWERS) if text is not ...]
    _, verdicts, out = run(spark, items, answers)
    out, verdicts = out.collect(), verdicts.collect()
    assert {k: kept(out, f"p{k}") for k in range(len(ANSWERS))} == {k: want for k, (_, want) in enumerate(ANSWERS)}
    assert {(r["pool"], r["fell_back"], r["remembered"]) for r in verdicts} == {(f"p{k}", want is HALF, want is not HALF) for k, (_, want) in enumerate(ANSWERS)}


def test_one_broken_chunk_keeps_a_run_from_being_remembered(spark):
    answers = [("en", 0, '{"keep": [1]}'), ("en", 1, "oops"), ("en", 2, '{"keep": [1]}')]
    frame, verdicts, out = run(spark, rows("en", 5), answers, 2)
    assert kept(out.collect(), "en") == [0, 30, 40]
    assert judge.memory_rows(frame, verdicts, 0, 7).count() == 0
    frame, verdicts, _ = run(spark, rows("en", 5), [("en", k, '{"keep": [1]}') for k in range(3)], 2)
    assert sorted((r["key"], r["keep"]) for r in judge.memory_rows(frame, verdicts, 0, 7).collect()) == [(f"http:__x_{i}", i % 2 == 0) for i in range(5)]


VERDICTS = [
    ({}, {"urgent": [1]}, ("NEWS", 2, "world", None)),
    ({}, {"important": [1]}, ("NEWS", 1, "world", None)),
    ({}, {"urgent": [1], "important": [1]}, ("NEWS", 2, "world", None)),
    ({"category": "URGENT"}, {"urgent": [1]}, ("URGENT", 2, "world", None)),
    ({"category": "URGENT"}, {}, ("NEWS", 0, "world", None)),
    ({"title": "Live updates on it"}, {"urgent": [1]}, ("NEWS", 0, "world", None)),
    ({"title": "Live updates on it", "category": "URGENT"}, {"urgent": [1]}, ("NEWS", 0, "world", None)),
    ({"title": "Live updates on it"}, {"important": [1]}, ("NEWS", 1, "world", None)),
    ({"title": "World cup"}, {"recategorize": {"1": "SPORT"}}, ("SPORT", 0, "world", None)),
    ({}, {"recategorize": {"1": "SPORT"}}, ("NEWS", 0, "world", None)),
    ({}, {"recategorize": {"1": "STARS"}}, ("STARS", 0, "world", None)),
    ({}, {"recategorize": {"1": "AUTO"}}, ("NEWS", 0, "world", None)),
    ({"category": "TOURS"}, {"recategorize": {"1": "STARS"}}, ("TOURS", 0, "world", None)),
    ({"category": "MONEY", "title": "New app"}, {"recategorize": {"1": "TECH"}}, ("TECH", 0, "world", None)),
    ({"category": "MONEY"}, {"recategorize": {"1": "URGENT"}}, ("NEWS", 0, "world", None)),
    ({"category": "KG"}, {"recategorize": {"1": "STARS"}}, ("STARS", 0, "world", None)),
    ({}, {"ad_suspects": [1]}, ("NEWS", 0, "world", 1000 + judge.EXPIRY_MS)),
    ({}, {"scope_fix": {"1": "pool"}}, ("NEWS", 0, "pool", None)),
    ({}, {"scope_fix": {"1": "galaxy"}}, ("NEWS", 0, "world", None)),
    ({}, {"scope_fix": {"1": "local"}}, ("NEWS", 0, "world", None)),
    ({"home": True}, {"scope_fix": {"1": "local"}}, ("NEWS", 0, "local", None)),
    ({"bridge": True}, {"scope_fix": {"1": "local"}}, ("NEWS", 0, "local", None)),
    ({"scope": "local"}, {}, ("NEWS", 0, "world", None)),
    ({"scope": "local", "near": True}, {"scope_fix": {"1": "local"}}, ("NEWS", 0, "pool", None)),
    ({"scope": "local", "home": True}, {}, ("NEWS", 0, "local", None)),

]


def test_verdicts_apply_in_order(spark):
    items = [r for k, (change, _, _) in enumerate(VERDICTS) for r in rows(f"p{k}", 1, change)]
    _, _, out = run(spark, items, [(f"p{k}", 0, json.dumps({"keep": [1], **said})) for k, (_, said, _) in enumerate(VERDICTS)])
    assert {r["pool"]: (r["category"], r["priority"], r["scope"], r["expiresAt"]) for r in out.collect()} == {f"p{k}": want for k, (_, _, want) in enumerate(VERDICTS)}


def test_empty_tables(spark):
    assert run(spark, [], [])[2].collect() == []
