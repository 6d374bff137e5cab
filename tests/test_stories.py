"""Press reviews and streamed stories against plain walks."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from presslens.functions import words as W
from presslens.operators import reviews as R
from presslens.streaming import stories as S

BLOCK = "pool string, pos int, k long, idx long, source string, family string, title string, summary string, priority int, role string, story_title string, base boolean"


def stems(text):
    return {w[:5] for w in re.findall("[а-яёa-zà-ú]{4,}", (text or "").lower()) if w not in W.STORY_STOP}


def walk(rows):
    """One block after the other, pool by pool."""
    out = []
    for pool in sorted({r[0] for r in rows}):
        used, urgent = set(), set()
        for pos in range(1, R.MOST_STORIES + 1):
            blocks, taken, families = [], set(), set()
            for r in sorted((r for r in rows if r[:2] == (pool, pos)), key=lambda r: (not r[11], r[2], r[3])):
                _, _, _, idx, _, family, title, _, priority, role, story, base = r
                if not base:
                    if idx in used or family in families:
                        continue
                    if blocks and stems(title) and not stems(title) & (stems(story) | stems(blocks[0][6]) | stems((blocks[0][7] or "")[:400])):
                        continue
                    if role != R.LEAD:
                        used.add(idx)
                        taken.add(idx)
                        urgent |= {idx} if priority >= 2 else set()
                families.add(family)
                blocks.append(r)
            blocks = blocks[: R.MOST_BLOCKS]
            big = bool(urgent & used) or any(b[9] in R.TELLING for b in blocks)
            if len({b[4] for b in blocks}) < (R.LEAST_BIG if big else R.LEAST_SOURCES):
                used -= taken
                continue
            out += [(pool, pos, place, b[3], b[9] == R.LEAD) for place, b in enumerate(blocks)]
    return sorted(out)


def test_reviews_equal_a_walk(spark):
    """Blocks named for several stories, families of several sources, leads, old blocks, titles without words, more than five stories."""
    draw = random.Random(11)
    rows = []
    for pool in ("en", "ru", "es"):
        for pos in range(1, 8):
            for k, idx in enumerate(draw.sample(range(30), draw.randrange(0, 16))):
                title = " ".join(draw.choice(["flood", "floods", "river", "Город", "the", "after", "storm"]) for _ in range(draw.randrange(0, 3)))
                source = draw.randrange(9)
                rows.append((pool, pos, k, idx, f"s{source}", f"f{source % 7}", title, draw.choice([None, "storm at the river", "x" * 500 + " flood"]), draw.choice([0, 0, 1, 2]) if pool != "es" else 0, draw.choice([R.LEAD, "detail", "detail", "witness"] if pool == "ru" else ["detail", R.LEAD]), draw.choice(["Flood", "Город", ""]), draw.random() < 0.1))
    want = walk(rows)
    assert sorted(map(tuple, R.assign_blocks(spark.createDataFrame(rows, BLOCK)).collect())) == want and len({r[1] for r in want}) > 2
    assert R.assign_blocks(spark.createDataFrame([], BLOCK)).collect() == []


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (("Flood in the city", ["u1", "u2"]), ("Nothing alike", ["u1", "u2", "u3"]), True),
        (("Flood in the city", ["u1"]), ("Nothing alike", ["u1"]), False),
        (("Flooded cities", []), ("Flood in the city hall", []), False),
        (("Flooded citizens", []), ("Floods and citizens", []), True),
        (("Флаги на площади", ["", ""]), ("Площадь без флагов", ["", ""]), True),
        ((None, None), (None, None), False),
    ],
)
def test_same_stories(spark, a, b, want):
    frame = spark.createDataFrame([(0, *a), (1, *b)], "id long, title string, urls array<string>")
    assert [tuple(r)[:2] for r in R.same_stories(frame).collect()] == ([(0, 1)] if want else [])


def test_fits(spark):
    cases = [("Tariffs rise", "US tariff row", "", "", True), ("Ballroom works", "US tariff row", "Name in court", "", False), ("Оттава отвечает", "Пошлины", "", "Власти Оттавы против", True), ("Will this be", "x", "y", "z", True), (None, "x", None, None, True), ("After said", "After said", "", "", True)]
    frame = spark.createDataFrame(cases, "t string, s string, lt string, ls string, want boolean")
    assert frame.filter(R.fits(F.col("t"), F.col("s"), F.col("lt"), F.col("ls")) != F.col("want")).collect() == []


class Handle:
    """State of one key in memory."""

    def __init__(self):
        self.value, self.items, self.timers = None, [], set()

    def getValueState(self, *_):  # noqa: N802
        outer = self

        class Value:
            def exists(self):
                return outer.value is not None

            def get(self):
                return outer.value

            def update(self, value):
                outer.value = value

            def clear(self):
                outer.value = None

        return Value()

    def getListState(self, *_):  # noqa: N802
        outer = self

        class Items:
            def get(self):
                return iter(outer.items)

            def put(self, items):
                outer.items = list(items)

            def clear(self):
                outer.items = []

        return Items()

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(at)


START = datetime(2024, 1, 1)


def feed(processor, *reports):
    import pandas as pd

    rows = [{"idx": k, "source": s, "family": s, "url": f"u{k}", "title": t, "summary": "", "scope": "local", "at": START + timedelta(hours=h)} for k, (s, t, h) in enumerate(reports)]
    return [tuple(r) for frame in processor.handleInputRows(("en", "x"), iter([pd.DataFrame(rows)]), None) for r in frame.itertuples(index=False)]


def test_a_story_ends_when_stale_or_old_or_by_its_timer():
    processor, handle = S.Stories(), Handle()
    processor.init(handle)
    zero = int((START - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert feed(processor, ("a", "t", 0), ("b", "t", 5), ("a", "again", 9)) == []
    assert handle.timers == {zero + 11 * S.HOUR}  # the second report of a family is nothing new
    assert feed(processor, ("c", "t", 11)) == [("en", "x", zero, zero + 5 * S.HOUR, 2, 2, "local", "u0 u1")]
    assert feed(processor, *[(f"s{h}", "t", h) for h in range(16, 34, 5)]) == [] and len(handle.items) == 5
    assert handle.timers == {zero + 35 * S.HOUR}
    for end in sorted(handle.timers):
        info = type("Info", (), {"getExpiryTimeInMs": lambda self, end=end: end})()
        assert len(list(processor.handleExpiredTimer(("en", "x"), None, info))) == 1
    assert handle.value is None and handle.items == []


def test_a_day_ends_a_story_that_is_still_fed():
    processor, handle = S.Stories(), Handle()
    processor.init(handle)
    got = feed(processor, *[(f"s{h}", "t", h) for h in range(0, 30, 5)])
    assert [(r[4], r[5]) for r in got] == [(5, 5)] and len(handle.items) == 1


def test_blocks_are_put_under_new_rules_when_read():
    processor, handle = S.Stories(), Handle()
    processor.init(handle)
    feed(processor, ("a", "Minister thanked all", 0))
    assert len(handle.items) == 1  # stored, but gone at the next look
    feed(processor, ("b", "Bridge closed", 1), ("a", "Bridge opens", 2))
    assert [b[3] for b in handle.items] == ["Bridge closed", "Bridge opens"]


def test_at_most_seven_blocks():
    processor, handle = S.Stories(), Handle()
    processor.init(handle)
    feed(processor, *[(f"s{k}", "t", k / 10) for k in range(12)])
    assert len(handle.items) == S.MOST
