"""The pipeline's stages, each on what its predecessor kept, against plain versions; held-out accuracy of toxicity."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as pipeline
from presslens.llm import mixing, queries
from presslens.shared import materialise
from tests.conftest import SF
from tests.llm.test_operators import classes, shingles


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"test-{name.replace(' ', '-')}")
        out.append(docs.collect())
    return out


def test_toxicity_drops_what_it_rejects_and_nothing_else(spark, stages):
    rejected = {r["doc_id"] for r in queries.op10_toxicity(spark, SF).filter("predicted = 1").collect()}
    assert sorted(map(repr, stages[1])) == sorted(repr(r) for r in stages[0] if r["doc_id"] not in rejected)


def test_lines_of_later_windows_go(stages):
    lines = {r["doc_id"]: (r["text"] or "").split("\n") for r in stages[1]}
    seen, gone = set(), defaultdict(set)
    for i in sorted(lines):
        solid = [k for k, line in enumerate(lines[i]) if line.strip(" \t\r\f\v")]
        for at in zip(solid, solid[1:], solid[2:], strict=False):
            window = tuple(lines[i][k] for k in at)
            if window in seen:
                gone[i].update(at)
            seen.add(window)
    want = {i: "\n".join(line for k, line in enumerate(x) if k not in gone[i]) for i, x in lines.items()}
    got = {r["doc_id"]: r["text"] or "" for r in stages[2]}
    assert gone
    assert got == {i: t for i, t in want.items() if not gone[i] or t.encode().split()}


def test_one_document_of_each_group_stays(stages):
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in stages[2]}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = classes(ids, links)
    assert links
    assert sorted(r["doc_id"] for r in stages[3]) == [i for i in ids if group[i] == i]


def test_mix_comes_near_its_targets(spark, stages):
    size = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in stages[3]}
    source = {r["doc_id"]: r["source"] for r in stages[3]}
    copies = Counter(r["doc_id"] // pipeline.COPIES for r in stages[4])
    assert len({r["doc_id"] for r in stages[4]}) == len(stages[4])
    assert max(copies.values()) <= 3
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    # The targets: shares by weight of all words, none above three times its source's.
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(total, key=lambda s: (s is None, s or "")))}
    target, free, left = {}, set(total), sum(total.values())
    while full := {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * total[s]}:
        target |= {s: 3 * total[s] for s in full}
        left -= sum(3 * total[s] for s in full)
        free -= full
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    plan = {r["doc_id"]: r for r in mixing.repetition_plan(spark.createDataFrame(stages[3])).collect()}
    for i, s in source.items():
        assert plan[i]["target"] == pytest.approx(target[s])
        rate = target[s] / total[s] if total[s] else 0
        assert copies[i] in (int(rate + 1e-9), int(rate + 1e-9) + 1, int(rate - 1e-9))


def test_pieces_cover_what_was_mixed(stages):
    pieces = defaultdict(list)
    for r in stages[5]:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    assert set(pieces) == {r["doc_id"] for r in stages[4]}
    for parts in pieces.values():
        at = 0
        for start, length, n in sorted(parts):
            assert start == at
            at += length
        assert at == n


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op10_toxicity(spark, sf).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    toxic, clean = (np.array([r["score"] for r in rows if labels[r["doc_id"]] == k]) for k in (1, 0))
    area = np.mean(toxic[:, None] > clean[None, :]) + np.mean(toxic[:, None] == clean[None, :]) / 2
    assert area >= 0.8
    assert np.mean(toxic >= 0.3) >= 0.6
    assert np.mean(clean >= 0.3) <= 0.1
