"""op11: part codes by metric trees against plain k-means."""

import numpy as np
import pytest

from presslens.llm import ballcodes, queries

ROWS = "vec_id long, embedding array<float>, label int, part int, e_label string"


def plain_codes(vectors, parts, entries, rounds):
    """Integer vectors in order of id: (codes, errors, books) by comparing everything."""
    v = np.array(vectors, np.int64).reshape(len(vectors), parts, -1)
    books = [v[:entries, p].copy() for p in range(parts)]

    def nearest(p):
        return ((v[:, p][:, None, :] - books[p][None, :, :]) ** 2).sum(axis=2)

    for _ in range(rounds):
        for p in range(parts):
            own = nearest(p).argmin(axis=1)
            for e in set(own.tolist()):
                books[p][e] = v[own == e, p].sum(axis=0) // (own == e).sum()
    away = [nearest(p) for p in range(parts)]
    codes = ["".join(f"{away[p][i].argmin():02x}" for p in range(parts)) for i in range(len(v))]
    return codes, [int(sum(away[p][i].min() for p in range(parts))) for i in range(len(v))], np.array(books)


@pytest.mark.parametrize(("n", "scale"), [(1, 5), (3, 1), (700, 2), (5000, 40), (4000, 100_000)])
def test_trees_assign_as_plain_search(n, scale):
    draw = np.random.default_rng(n)
    parts = np.floor(draw.standard_normal((n, 4)) * scale).astype(np.int64)
    book = np.vstack([parts[:40], parts[:9], parts[:5] + 1])  # with equal entries and ties
    tree = ballcodes._tree_columns(parts)
    owner, sums, counts = ballcodes.descend(tree, book)
    want = ((parts[:, None, :] - book[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    got = np.empty(len(tree["order"]), np.int64)
    got[tree["order"]] = owner
    assert (got[tree["member"]] == want).all()
    totals = np.zeros_like(book)
    np.add.at(totals, want, parts)
    assert (totals == sums).all() and (np.bincount(want, minlength=len(book)) == counts).all()


def test_balls_hold_their_points_and_sums():
    parts = np.random.default_rng(3).integers(-500, 500, (3000, 4))
    tree = ballcodes._tree_columns(parts)
    points = tree["points"].reshape(-1, 4)[tree["order"]]
    counts = tree["counts"][tree["order"]]
    assert sorted(tree["order"].tolist()) == list(range(len(points)))
    for i in range(len(tree["lo"])):
        own = slice(tree["lo"][i], tree["hi"][i])
        centre = tree["centre"].reshape(-1, 4)[i]
        assert np.sqrt(((points[own] - centre) ** 2).sum(axis=1)).max() <= tree["radius"][i]
        assert (tree["sums"].reshape(-1, 4)[i] == (points[own] * counts[own, None]).sum(axis=0)).all()
        left, right = tree["left"][i], tree["right"][i]
        if left >= 0:
            assert (tree["lo"][left], tree["hi"][left], tree["hi"][right]) == (tree["lo"][i], tree["lo"][right], tree["hi"][i])


def test_most_parts_are_owned_by_whole_balls():
    """Clusters far apart: the lists shrink to one entry long before the leaves."""
    draw = np.random.default_rng(5)
    centres = draw.integers(-100_000, 100_000, (16, 4))
    parts = centres[draw.integers(0, 16, 6000)] + draw.integers(-50, 50, (6000, 4))
    tree = ballcodes._tree_columns(parts)
    seen = []
    plain = ballcodes._at_leaves

    def spy(tree, points, counts, entries, balls, lists, *rest):
        seen.append(int((tree["hi"][balls] - tree["lo"][balls]).sum()))
        return plain(tree, points, counts, entries, balls, lists, *rest)

    ballcodes._at_leaves = spy
    try:
        ballcodes.descend(tree, centres)
    finally:
        ballcodes._at_leaves = plain
    assert sum(seen) == 0


def test_query_columns_of_repeats_nulls_and_clashing_names(spark):
    draw = np.random.default_rng(7)
    rows = [(i, (draw.standard_normal(32) / 3).astype(np.float32).tolist(), None if i % 5 == 0 else i % 2, i, "x") for i in range(300)]
    rows += [(7, rows[7][1], 1, 0, "x")] * 40  # one id and vector many times
    bad = [(400, None, 1, 0, "x"), (401, [], 1, 0, "x"), (402, [None] * 32, 1, 0, "x"), (403, [float("nan")] * 32, 1, 0, "x"), (404, [float("inf")] + [0.0] * 31, 1, 0, "x"), (405, [1.0] * 16, 1, 0, "x"), (None, rows[0][1], None, 0, "x")]
    coded, books = ballcodes.compress(spark.createDataFrame(rows + bad, ROWS))
    kept = sorted(rows, key=lambda r: (r[0], np.floor(256 * np.array(r[1], float)).tolist())) + [bad[-1]]
    whole = [np.floor(256 * np.array(r[1], float)).astype(int) for r in kept]
    codes, errors, want_books = plain_codes(whole, 16, 64, 2)
    by_label = {label: sum(e for e, r in zip(errors, kept, strict=True) if r[2] == label) for label in (None, 0, 1)}
    want = sorted(repr((r[0], r[2], c, e, by_label[r[2]])) for r, c, e in zip(kept, codes, errors, strict=True))
    assert sorted(repr((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"])) for r in coded.collect()) == want
    assert (books == want_books).all()


def test_small_empty_and_extreme_tables(spark):
    assert ballcodes.compress(spark.createDataFrame([], ROWS))[0].collect() == []
    three = [(i, [float(i)] * 16, 0, 0, "x") for i in range(3)]
    coded, books = ballcodes.compress(spark.createDataFrame(three, ROWS))
    assert books.shape == (16, 3, 1) and {r["error"] for r in coded.collect()} == {0}
    huge = [(0, [3e38] * 16, 0, 0, "x"), (1, [-3e38] * 16, 0, 0, "x"), (2, [0.0] * 16, 0, 0, "x")]
    got = ballcodes.compress(spark.createDataFrame(huge, ROWS), entries=1, rounds=0)[0]
    most = int(2**30 / 4)
    assert {r["vec_id"]: r["error"] for r in got.collect()} == {0: 0, 1: 16 * (2 * most) ** 2, 2: 16 * most**2}
    with pytest.raises(ValueError, match="16 equal parts"):
        ballcodes.compress(spark.createDataFrame([(0, [1.0] * 10, 0, 0, "x")], ROWS))


def test_query_equals_brute_force(spark):
    from tests.conftest import SF

    rows = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect(), key=lambda r: r["vec_id"])
    codes, errors, books = plain_codes([np.floor(256 * np.array(r["embedding"], float)).astype(int) for r in rows], 16, 64, 2)
    got = {r["vec_id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in queries.op11_ball_codes(spark, SF).collect()}
    assert got == {r["vec_id"]: (c, e, ballcodes.fingerprint(books)) for r, c, e in zip(rows, codes, errors, strict=True)}
