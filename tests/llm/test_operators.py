"""Operators against plain versions on small tables."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from presslens.llm import classlm, jaccard, line_dedup, mixing, mpeg, packing, pii, queries, toxicity, vectors, warc
from tests.conftest import SF

KEY = "key of the tests"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, rank int"
EDGES = [(1, None, "en", "a", 0, "x", 1), (2, "", "en", None, 0, "x", 1), (3, "one", None, "b", 3, "x", 1), (3, "one", None, "b", 3, "x", 1), (None, "one two", "en", "a", 7, None, None), (4, "word " * 40_000, "en", "a", None, "x", 1)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


def classes(nodes, links):
    name = {n: n for n in nodes}

    def top(n):
        while name[n] != n:
            n = name[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        name[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(same, name):
    same(queries.QUERIES[name], queries.ORACLE_SQL[name])


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def test_jaccard_equals_all_pairs(spark, texts):
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = classes(ids, links)
    got = queries.op4_jaccard(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), want[i]) for i in ids}
    assert links


def test_vectors_equal_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    close = x @ x.T >= 0.93
    label = np.array([r["label"] for r in rows])
    close &= label[:, None] == label[None, :]
    np.fill_diagonal(close, False)
    ids = [r["vec_id"] for r in rows]
    want = classes(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(close), strict=True)])
    got = queries.op5_vectors(spark, SF).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (int(n), want[i]) for i, n in zip(ids, close.sum(axis=1), strict=True)}


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [1.0, math.inf], 0), (6, [1.0, 2.0], None), (7, [1.0, 2.0], 1), (8, [2.0, 4.0], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got == {i: (0, i) for i in range(1, 7)} | {7: (1, 7), 8: (1, 7)}


def test_packing_is_whole_and_gapless(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    got, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op3_packing(spark, SF).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(np.array(part, "<u4").tobytes()), len(ids[r["doc_id"]]))
        got[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in ids.items():
        assert [s for s, _ in sorted(got[i])] == [sum(n for _, n in sorted(got[i])[:k]) for k in range(len(got[i]))]
        assert sum(n for _, n in got[i]) == len(x)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(map(len, ids.values())) >= 0.98 * 1024 * (len(sequences) - 1)  # little padding


def test_warc_round_trip(spark):
    html = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    first = {}
    for i in sorted(html):
        first.setdefault(html[i], i)
    got = queries.op2_warc(spark, SF).collect()
    want = {i: (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first[b] == i else "revisit", None if first[b] == i else first[b]) for i, b in html.items()}
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == want


def test_mpeg_round_trip(spark, texts):
    for r in queries.op9_mpeg(spark, SF).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert r["crc_bad"] == 0


def test_class_lm_counts_base_and_gain(spark, texts):
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, x in tokens.items() if not held[i] for w in x)
    n, v = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in queries.op8_class_lm(spark, SF).collect()}
    for i, x in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(x), sum(w in counts for w in x), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    assert sum(r["score"] for r in rows.values() if r["held_out"]) > sum(r["base_score"] for r in rows.values() if r["held_out"])


def test_block_max_search_equals_all_cosines():
    rng = random.Random(5)
    made = []
    for _ in range(700):
        raw = {f: rng.random() for f in rng.sample(range(60), 4)}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        made.append({f: w / norm for f, w in raw.items()})
    index = toxicity.BlockMaxIndex(made)
    for query in made[:40]:
        cosines = [(-round(sum(w * d.get(f, 0) for f, w in query.items()), 12), i) for i, d in enumerate(made)]
        ids, _ = index.search(query, 15)
        assert ids.tolist() == [i for c, i in sorted(cosines)[:15] if c < 0]


def test_toxicity_ignores_other_columns_and_equal_texts_score_alike(spark):
    got = queries.op10_toxicity(spark, SF).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_surrogates_keep_type_and_stay_distinct():
    texts = [f"mail u{i}@host{i % 7}.org or 4111 1111 1111 {1000 + i}, Dr. Anna Kovacs" for i in range(200)]
    seen = defaultdict(set)
    for text in texts:
        new, entities = pii.anonymise(text, KEY)
        assert [e["kind"] for e in entities] == [k for k, _, _ in pii.find(text)]
        assert new != text and "Kovacs" not in new
        for e in entities:
            seen[e["kind"], e["surrogate"]].add(e["entity"])
    assert all(len(x) == 1 for x in seen.values())
    assert pii.anonymise(None, KEY) == (None, []) and pii.anonymise("", KEY) == ("", [])


def test_edges_and_empty_tables(spark):
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame(EDGES, DOCS)
    for frame in (docs, docs.limit(0)):
        n = frame.count()
        assert mixing.repetition_plan(frame).count() == n
        assert line_dedup.dedup_lines(frame).count() == n
        assert jaccard.jaccard_components(frame).count() == n
        assert toxicity.score(frame, toxicity.fit(frame, labels)).count() == n
        assert classlm.score(frame, classlm.fit(frame)).count() == n
        assert pii.replace_entities(frame, KEY).count() == n
        assert mpeg.read_mpeg(mpeg.write_mpeg(frame)).count() == n
        cut = packing.pack(packing.pieces(frame, public_tokenizers.path("byte_bpe_50k.json")))
        assert cut.filter("start = 0").count() == n
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "v", "x")], "page_id long, url string, html string")
    for frame in (pages, pages.limit(0)):
        assert warc.read_archives(warc.normalise(warc.write_archives(warc.revisits(frame)))).count() == frame.count()


def test_toxicity_compares_all_words(spark):
    """A toxic phrase of words that are ordinary one by one, and a long clean text with one marker."""
    rng = random.Random(3)
    word = lambda: rng.choice(["apple", "stone", "river", "cloud", "table", "paper", "green", "light", "music", "horse"]) + rng.choice("abcdefgh")
    rows = [(i, " ".join(word() for _ in range(12)) + (" zork" if i % 10 == 0 else ""), int(i % 10 == 0)) for i in range(400)]
    rows += [(400 + i, f"go back where you came {i}", 1) for i in range(4)]
    rows += [(500, "go back where you came from", None), (501, "zork", None), (502, "zork " + " ".join(word() for _ in range(200)), None), (503, rows[1][1], None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] is not None], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert got[500]["evidence"] and got[500]["evidence"][0]["example_id"] in {"400", "401", "402", "403"}
    assert got[501]["evidence"][0]["cosine"] > got[502]["evidence"][0]["cosine"]
    assert got[502]["evidence"][0]["cosine"] < 0.9
    assert got[503]["evidence"][0]["cosine"] == pytest.approx(1)


@pytest.mark.parametrize("text", ["+33 1 23 45 67 89", "+49 (0)30 123456", "5552234567", "030/1234567", "Dr. O'Brien", "Anna McDonald", "Frau Şñß", "Dr. Παπαδόπουλος", "мир@example.org", "ñandú@example.org", "山田@example.org"])
def test_entities_are_found_whole_and_change(text):
    new, entities = pii.anonymise(f"x {text} y", KEY)
    assert [x[1:] for x in pii.find(f"x {text} y")] == [(2, 2 + len(text))] and len(entities) == 1
    assert new != f"x {text} y"


def test_permutation_moves_every_value():
    for size in (2, 3, 40, 105):
        moved = [pii.permute(i, size, "t", KEY) for i in range(size)]
        assert sorted(moved) == list(range(size)) and all(a != i for i, a in enumerate(moved))


def test_toxicity_scores_equal_a_plain_version(spark):
    """Weights, neighbours, votes and calibration again with dictionaries, on rows with ties and copies."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 3, 7])))
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 12))] + (["zorkish"] if i % 9 == 0 else []))) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(300, None)]
    label = {i: int(i % 9 == 0) for i, _ in rows if i % 2 == 0}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(list(label.items()), "doc_id long, toxic int"), k=5)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}

    counts = {i: Counter(f for t in (x or "").encode().split() for f in toxicity.token_features(t)) for i, x in rows}
    train = [i for i in label if zlib.crc32(str(i).encode()) % 4 != 2]
    by = [Counter(f for i in train if label[i] == k for f in counts[i]) for k in (0, 1)]
    total = [sum(label[i] == k for i in train) for k in (0, 1)]
    weight = {}
    for f in set(by[0] | by[1]):
        a, b = by[1][f], by[0][f]
        if a + b >= 2:
            c, d = total[1] - a, total[0] - b
            below = (a + b) * (c + d) * total[0] * total[1]
            chi = len(train) * (a * d - b * c) ** 2 / below if below else 0
            weight[f] = (math.log((len(rows) + 1) / (sum(f in x for x in counts.values()) + 1)) + 1) * (1 + math.log1p(chi))

    def unit(i):
        raw = {f: (1 + math.log(n)) * weight[f] for f, n in counts[i].items() if f in weight}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return frozenset((f, x / norm) for f, x in raw.items())

    merged = defaultdict(list)
    for i in train:
        merged[unit(i)].append(i)
    base = total[1] / len(train)
    empty = merged.pop(frozenset(), [])
    vectors_of = sorted(merged, key=lambda v: min((len(str(i)), str(i)) for i in merged[v]))

    def vote(i, out=None):
        q = dict(unit(i))
        near = [(-round(sum(x * q.get(f, 0) for f, x in v), 7), n) for n, v in enumerate(vectors_of)]
        near = [(c, n) for c, n in sorted(near)[:5] if c < 0]
        sums = [0.0, 0.0]
        for c, n in near:
            for j in merged[vectors_of[n]]:
                if j != out:
                    sums[label[j]] += 1 / (1 + c + 0.05)
        return (sums[1] + base) / (sum(sums) + 1)

    left = sorted((vote(i, i), label[i]) for i in train if i not in empty)
    steps, levels = toxicity.isotonic(np.array([v for v, _ in left]), np.array([y for _, y in left], float), np.ones(len(left)))
    for i, _ in rows:
        if not unit(i):
            assert got[i] == pytest.approx((sum(label[j] for j in empty) + base) / (len(empty) + 1))
        else:
            v = vote(i)
            near = {round(float(levels[np.searchsorted(steps, x, "right") - 1]), 6) for x in (v - 1e-4, v, v + 1e-4)}  # rounding next to a step
            assert any(got[i] == pytest.approx(x, abs=0.02) for x in near)
