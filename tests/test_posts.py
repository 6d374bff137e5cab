"""Posts published once, against a walk in order of time."""

import random

import pytest

from presslens.shared import fresh_path
from presslens.streaming import posts as P

HOUR = 3_600_000


def walk(rows, log=(), ttl=P.TTL_MS):
    seen = [(k, at) for _, at, keys in log for k in keys]
    out = []
    for i, at, keys in sorted(rows, key=lambda r: (r[1], r[0])):
        own = {k for k in keys or [] if k}
        if any(k in own and t > at - ttl for k, t in seen):
            continue
        out.append(i)
        seen += [(k, at) for k in own]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_first_posts_equal_a_walk(spark, seed):
    """Chains by either key, a key in a third of all posts, ties in time, expiry, missing and doubled keys."""
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot", None, "", *[f"k{n}" for n in range(40)]])
    rows = [(i, draw.randrange(60) * HOUR, draw.choice([None, [], [key()], [key(), key()], [key(), key()], [key(), key()]])) for i in range(250)]
    log = [(1000 + i, -i * HOUR, [key() or "x"]) for i in range(20)]
    got = P.first_posts(spark.createDataFrame(rows, P.POST), spark.createDataFrame(log, P.POST), 12 * HOUR)
    assert sorted(r["id"] for r in got.collect()) == walk(rows, log, 12 * HOUR)


def test_a_batch_that_runs_again_changes_nothing(spark):
    publisher = P.Publisher(spark, fresh_path(spark, "test-posts"))
    assert publisher.posts(spark).collect() == []
    one = spark.createDataFrame([(1, 10, ["a", "b"]), (2, 11, ["b", "c"]), (3, 12, ["c"])], P.POST)
    two = spark.createDataFrame([(4, 20, ["c", "d"]), (5, 21, ["d"])], P.POST)
    for frame, number in ((one, 0), (one, 0), (two, 1), (one, 0), (two, 1)):
        publisher.batch(frame, number)
    assert sorted((r["id"], r["batch"]) for r in publisher.posts(spark).collect()) == [(1, 0), (3, 0), (5, 1)]


def test_stretches_of_time_equal_the_whole(spark):
    rows = [(i, i * HOUR, [f"a{i % 7}", f"b{i % 5}"]) for i in range(60)]
    got = P.replay(spark.createDataFrame(rows, P.POST), ttl_ms=9 * HOUR)
    assert sorted(r["id"] for r in got.collect()) == walk(rows, ttl=9 * HOUR)
    assert P.replay(spark.createDataFrame([], P.POST)).collect() == []
