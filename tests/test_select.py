"""Ranks in parts and places in feeds against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from presslens.functions import words as W
from presslens.operators import reports, select

ROW = "pool string, idx long, family string, scope string, priority int, category string, title string, publishedAt long, imageUrl string, source string, summary string"


@pytest.fixture(scope="module")
def rows():
    """One pool with most rows, ties in priority, a family with a third of all, null families and scopes."""
    draw = random.Random(6)
    return [
        (draw.choice(["ru", "en", "en", "en"]), i, draw.choice(["a", "a", "b", "c", None, f"f{i % 9}"]), draw.choice(["local", "pool", "world", None]), draw.randrange(3), draw.choice(["URGENT", "NEWS", "URGENT_LOCAL_ONLY"]), draw.choice(["What now", "A plain title", "почему так"]), draw.randrange(8 * select.HOUR), "x", "s", "t")
        for i in range(900)
    ]


@pytest.fixture(autouse=True)
def parts(spark):
    """Small tables keep their parts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_equal_a_walk(spark, rows):
    frame = spark.createDataFrame(rows, ROW).repartition(5)
    placed = select.in_order(frame.select("pool", "idx", "family", "priority"), F.col("pool"), F.desc("priority"), F.col("idx"))
    assert placed.select("part").distinct().count() > 2
    got = {r["idx"]: (r["rank"], r["nth"]) for r in select.numbered(select.numbered(placed, "rank", "pool"), "nth", "pool", "family").collect()}
    seen, want = Counter(), {}
    for r in sorted(rows, key=lambda r: (r[0], -r[4], r[1])):
        seen[r[0]] += 1
        seen[r[0], r[2]] += 1
        want[r[1]] = (seen[r[0]], seen[r[0], r[2]])
    assert got == want


def test_feed_equals_a_walk(spark, rows):
    want = {}
    for pool in ("ru", "en"):
        mine = sorted((r for r in rows if r[0] == pool), key=lambda r: (-r[4], r[1]))
        rank = {r[1]: k for k, r in enumerate(mine, 1)}
        families, capped = Counter(), []
        for r in mine:
            families[r[2]] += 1
            if families[r[2]] <= max(3, len(mine) // 5):
                capped.append(r)
        size = W.FEED_SIZE.get(pool, W.FEED_SIZE_ELSE)
        scopes, held = Counter(), []
        for r in capped:
            scopes[r[3]] += 1
            if scopes[r[3]] <= size * W.FLOORS.get(r[3], 0) // 100:
                held.append(r)
        chosen = {r[1] for r in held}
        fill = [r for r in capped if r[1] not in chosen][: size - len(held)]
        shelf = {"local": 0, "pool": 1, "world": 2}
        for place, r in enumerate([*sorted(held, key=lambda r: (shelf[r[3]], rank[r[1]])), *fill], 1):
            want[pool, r[1]] = (rank[r[1]], r[1] in chosen, place)
    got = select.feed_places(spark.createDataFrame(rows, ROW).repartition(3))
    assert {(r["pool"], r["idx"]): (r["rank"], r["reserved"], r["place"]) for r in got.collect()} == want


def test_urgent_rows_equal_a_walk(spark, rows):
    now, stay = 8 * select.HOUR, set()
    near = {"local": 0, "pool": 1, "world": 2}
    for pool in ("ru", "en"):
        able = [r for r in rows if r[0] == pool and r[5].startswith("URGENT") and r[6] == "A plain title" and now - r[7] <= 3 * select.HOUR]
        stay |= {r[1] for r in sorted(able, key=lambda r: (near.get(r[3], 3), -r[7], r[1]))[:2]}
    got = {r["idx"]: r["category"] for r in select.cap_urgent(spark.createDataFrame(rows, ROW), now).collect()}
    assert got == {r[1]: r[5] if r[1] in stay or r[5] == "NEWS" else "NEWS" for r in rows} and len(stay) == 4


def test_no_window_over_a_pool_of_texts(spark, rows):
    plan = select.feed(spark.createDataFrame(rows, ROW))._jdf.queryExecution().executedPlan().toString()
    assert not any("Window" in line and "summary" in line for line in plan.split("\n"))


def test_hogs_and_logos_equal_counts(spark):
    rows = [("en", i, "a", "local", 0, "NEWS", "t" * 30, 0, "http://logo" if i % 3 == 0 else f"http://{i}", "hog" if i < 9 else f"s{i}", "A text that is long enough to be no fault at all, and it ends well.") for i in range(20)]
    kinds = defaultdict(set)
    for r in reports.audit_kinds(spark.createDataFrame(rows, ROW)).collect():
        kinds[r["kind"]].add(r["idx"])
    assert kinds == {"logo": {i for i in range(20) if i % 3 == 0}, "publisher hog": set(range(9))}
