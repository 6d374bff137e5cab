"""The class model against a plain version that knows nothing but the words' classes."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from presslens.llm import classlm

WORDS = {0: ["the", "a", "one"], 1: ["cat", "dog", "bird", "fish"], 2: ["runs", "sleeps", "eats"], 3: ["today", "now"]}


def sentences(n):
    rng = random.Random(11)
    made = []
    for i in range(n):
        words = [rng.choice(WORDS[k]) for k in (0, 1, 2, 0, 1, 3)] * rng.randint(1, 3)
        made.append((i, " ".join([*words, f"rare{i % 90}", f"Once{i}ing"])))
    return [*made, (n, None), (n + 1, ""), (n + 2, made[0][1])]


def class_of(model, word):
    place = {w: i for i, w in enumerate(model.frequent)}
    return int(model.word_class[place[word]] if word in place else model.item_class[model.first_group + classlm.ending(word)])


def plain(model, texts, n_classes):
    """Steps between classes, share of unknown words and counts, from the classes alone."""
    counts, table = Counter(), np.zeros((n_classes, n_classes))
    for text in texts:
        before = b""
        for word in [*(text or "").encode().lower().split(), b""]:
            counts[word] += 1
            table[class_of(model, before), class_of(model, word)] += 1
            before = word
    size, once = np.zeros(n_classes), np.zeros(n_classes)
    for word, n in counts.items():
        size[class_of(model, word)] += n
        once[class_of(model, word)] += n == 1
    share = (size + 0.1) / (size.sum() + 0.1 * n_classes)
    steps = (table + 10 * share) / (table.sum(axis=1, keepdims=True) + 10)
    return counts, size, steps, (once + 0.1) / (size + once + 0.2), table


@pytest.mark.parametrize(("item_share", "own_count"), [(5e-5, 10), (0.01, 2), (0.01, 10**9)])
def test_scores_equal_a_plain_version(spark, monkeypatch, item_share, own_count):
    monkeypatch.setattr(classlm, "ITEM_SHARE", item_share)
    monkeypatch.setattr(classlm, "OWN_COUNT", own_count)
    rows = sentences(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    training = docs.filter(~classlm.held_out(docs.doc_id))
    model = classlm.fit(training, n_classes=8, rounds=4)
    learnt = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    counts, size, steps, unknown, _ = plain(model, learnt, 8)
    assert np.allclose(steps.sum(axis=1), 1)
    assert np.allclose(10**model.step_log, steps)
    texts = dict(rows)
    for r in classlm.score(docs, model).collect():
        want, before = 0.0, class_of(model, b"")
        for word in [*(texts[r["doc_id"]] or "").encode().lower().split(), b""]:
            now = class_of(model, word)
            p = (1 - unknown[now]) * counts[word] / size[now] if word in counts else unknown[now]
            want += math.log10(steps[before, now]) + math.log10(p)
            before = now
        assert r["score"] == pytest.approx(want, rel=1e-9)


def test_words_leave_their_group_where_that_is_likelier(spark, monkeypatch):
    """Rare words of one ending, some used as nouns and some as verbs are: alone they join these, in their group they can't."""
    monkeypatch.setattr(classlm, "ITEM_SHARE", 0.03)
    rng = random.Random(2)
    nouns, verbs = "bcdfg", "klmnp"
    rows = []
    for i in range(1500):
        noun, verb = rng.choice(["cat", "dog"]), rng.choice(["runs", "eats"])
        if i % 4 == 0:
            noun, verb = (f"{rng.choice(nouns)}xxing", verb) if i % 8 else (noun, f"{rng.choice(verbs)}xxing")
        rows.append((i, f"{rng.choice(['the', 'a'])} {noun} {verb} {rng.choice(['now', 'here'])}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for own_count in (10, 10**9):
        monkeypatch.setattr(classlm, "OWN_COUNT", own_count)
        model = classlm.fit(docs, n_classes=7)
        kinds = [{class_of(model, f"{c}xxing".encode()) for c in letters} for letters in (nouns, verbs)]
        found[own_count] = *kinds, classlm.likelihood(plain(model, [t for _, t in rows], 7)[4])
    first, second, together = found[10**9]
    assert first == second and len(first) == 1
    first, second, apart = found[10]
    assert not first & second and apart > together


def test_best_class_equals_trying_every_class():
    rng = np.random.default_rng(4)
    for _ in range(20):
        words, n_classes = 12, 4
        kind = rng.integers(0, n_classes, words)
        kind[:n_classes] = np.arange(n_classes)
        n = rng.integers(0, 9, (words, words)) + 1
        table = lambda k: np.array([[n[np.ix_(k == a, k == b)].sum() for b in range(n_classes)] for a in range(n_classes)])
        item = words - 1
        others = np.arange(words) != item
        left = np.bincount(kind[others], n[others, item], n_classes)
        right = np.bincount(kind[others], n[item, others], n_classes)
        tried = []
        for to in range(n_classes):
            k = kind.copy()
            k[item] = to
            tried.append(classlm.likelihood(table(k)))
        got = classlm.best_class(int(kind[item]), left, right, float(n[item, item]), table(kind))
        assert tried[got] == pytest.approx(max(tried), rel=1e-9)
