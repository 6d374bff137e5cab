"""Links that are counted over subsets of words, against all pairs."""

import random

import pytest

from presslens.operators import cluster, reviews

from tests.test_cluster import plain_pairs


def drawn(seed):
    """Sets inside others, equal sets, frequent words, and some sets too large for subsets."""
    draw = random.Random(seed)
    letters = [f"word{c}" for c in "abcdefghijklmnopqrstuvw"]
    return {i: set(draw.sample(letters, 16 if i % 40 == 0 else draw.choice([1, 1, 2, 3, 4, 6, 9]))) for i in range(90)}


def test_link_counts_equal_all_pairs(spark):
    """overlaps of at least 0.3 and below 0.6, of sets of at least three words."""
    sets = {i: s for i, s in drawn(1).items() if len(s) >= 3}
    want = dict.fromkeys(sets, 0)
    for a, b, shared, smaller in plain_pairs(sets, 30, 3):
        if 10 * shared < 6 * smaller:
            want[a] += 1
            want[b] += 1
    rows = [(i, " ".join(sorted(s))) for i, s in sets.items()]
    got = cluster.near_duplicates(spark.createDataFrame(rows, "idx long, title string")).collect()
    assert {r["idx"]: r["n_links"] for r in got} == want
    assert all(r["class"] == min(i for i in sets if sets[i] == sets[r["idx"]]) for r in got)


def test_duplicate_titles_equal_all_pairs(spark):
    """the first set of a subset tells whether an earlier title is alike."""
    sets = drawn(2)
    got = cluster.duplicate_titles(spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in sets.items()], "idx long, title string"))
    assert {r["idx"] for r in got.collect()} == {b for _, b, _, _ in plain_pairs(sets, 50)}


@pytest.mark.parametrize("seed", [3])
def test_story_links_equal_all_pairs(spark, seed):
    """two of three addresses, two word starts, or both, which count once."""
    draw = random.Random(seed)
    stories = {i: ([f"u{draw.randrange(5)}" for _ in range(draw.randrange(4))], draw.sample(["alpha", "bravo", "chalk", "delta", "eager"], draw.randrange(5))) for i in range(50)}
    frame = spark.createDataFrame([(i, " ".join(t), u) for i, (u, t) in stories.items()], "id long, title string, urls array<string>")
    alike = lambda x, y: any(len(set(x[k]) & set(y[k])) >= 2 for k in (0, 1))
    want = {i: sum(alike(x, y) for j, y in stories.items() if j != i) for i, x in stories.items()}
    assert {r["id"]: r["n_links"] for r in reviews.story_links(frame).collect()} == want
