"""Toxicity by nearest labelled examples: exact TF-IDF cosine over an inverted index.

Training labels are those of rows whose crc32(id) mod 4 is not 2. A model is
fitted on at most ``max_examples`` of them (those of smallest hash, a documented
bound; all where there are fewer). All features of the texts, words and starts
of words, that at least ``LEAST_DF`` examples hold are the vocabulary, whether
they lean to toxic or to clean examples. The weight of a feature in a text is
its TF-IDF, with document frequencies counted over all documents, times
1 + log(1 + chi-square) of the feature and the label among the examples: none
is dropped, those that tell count more. Equal vectors are merged with their
counts. Block maxima of features bound the cosines of a query with all examples;
those whose bound reaches the best cosines are computed in full, so the ``k``
neighbours are exact. Votes weighted by distance are mapped to probabilities by
isotonic regression on leave-one-out votes.

What happens in special cases:

* a null or empty text, and any text without a vocabulary feature, gets the
  share of toxic examples among examples without features;
* null labels count as missing; of several labels of one id the largest holds;
* documents with a null id are never training rows and are not held out;
* without training rows every score is 0;
* equal texts get equal scores; ties in cosine go to the smaller example id (the
  shorter one first, then by code point; of equal vectors the smallest);
* all columns of the input stay, ``held_out, score, predicted, evidence`` are
  added and replace input columns of these names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.memory import release_memory
from presslens.shared import materialise

MAX_EXAMPLES = 3_000
K = 15
LEAST_DF = 2
THRESHOLD = 0.3
#: Queries that are compared together.
TOGETHER = 32
#: More than what rounding to single precision takes from a cosine.
SLACK = 1e-5
#: Vectors in a block, and the share of the vectors from which a feature is held by many.
BLOCK = 64
MANY_SHARE = 0.1
#: Where bounds leave more than this share of the vectors, all are added up in one product.
FEW = 0.125
PREFIX = 5
#: Bytes of tokens whose features a task remembers, about, and texts whose scores (of a fixed size).
TOKEN_BYTES, TEXTS = 32 << 20, 20_000
ADDED = ("held_out", "score", "predicted", "evidence")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def token_features(token: bytes) -> tuple[str, ...]:
    """A token's word without outer marks, and the start of a longer word."""
    word = token.decode("utf-8", "replace").lower()
    if word.isalpha():
        return (word,) if len(word) <= PREFIX else (word, word[:PREFIX] + "*")
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    word = word[start:end]
    return () if not word else (word,) if len(word) <= PREFIX else (word, word[:PREFIX] + "*")


class _Tokens(dict):
    """Known features of tokens, as ids in ``vocabulary`` or, without one, as names."""

    def __init__(self, vocabulary: dict[str, int] | None = None):
        super().__init__()
        self.vocabulary, self.held = vocabulary, 0

    def __missing__(self, token: bytes) -> tuple:
        names = token_features(token)
        known = names if self.vocabulary is None else tuple(self.vocabulary[n] for n in names if n in self.vocabulary)
        if self.held < TOKEN_BYTES:
            self[token] = known
            self.held += 220 + len(token)
        return known

    def count(self, text: bytes | None) -> Counter:
        counts: Counter = Counter()
        for known in filter(None, map(self.__getitem__, (text or b"").split())):
            counts.update(known)
        return counts

    def packed(self, text: bytes | None) -> np.ndarray:
        """The ids of a text's features and, in a second row, how often they occur."""
        found = np.fromiter(chain.from_iterable(map(self.__getitem__, (text or b"").split())), np.int32)
        return np.stack(np.unique(found, return_counts=True)).astype("<i4")


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(column).cast(pa.binary()))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_examples: int) -> DataFrame:
    """``id, text, toxic`` of at most ``max_examples`` training rows, by smallest hash of the id."""
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("x_id"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("x_id"), "x_id")
        .limit(max_examples)
    )
    return docs.select(F.col(id_col).alias("x_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "x_id")


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, seen = _Tokens(), (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(_texts(batch, "text"), batch.column("toxic").to_pylist(), strict=True):
            seen[int(toxic == 1)].update(set(tokens.count(text)))
    names = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in seen]], names=["feature", "clean", "toxic"])


def feature_counts(examples: DataFrame) -> pa.Table:
    """``feature, clean, toxic``: every feature of at least LEAST_DF examples and how many of them hold it; bounded as the examples are."""
    return (
        examples.select("text", "toxic")
        .mapInArrow(_document_frequencies, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= LEAST_DF)
        .orderBy("feature")
        .toArrow()
    )


def relevance(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """What features' weights are multiplied by, at least 1: 1 + log(1 + chi-square)."""
    a, b = toxic.astype(float), clean.astype(float)
    c, d = n_toxic - a, n_clean - b
    below = (a + b) * (c + d) * float(n_toxic) * float(n_clean)
    return 1 + np.log1p(np.where(below > 0, (n_clean + n_toxic) * (a * d - b * c) ** 2 / np.maximum(below, 1.0), 0.0))


def _vectors(examples: DataFrame, shared) -> pa.Table:
    """Each example's features and their counts, packed; one row for each of the bounded number of examples."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens(shared.value)
        for batch in batches:
            counts = [tokens.packed(t) for t in _texts(batch, "text")]
            arrays = [pa.array([x[k].tobytes() for x in counts], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("x_id").cast(pa.string()), batch.column("toxic").cast(pa.int64()), *arrays], names=["x_id", "toxic", "ids", "counts"])

    return examples.select("x_id", "toxic", "text").mapInArrow(vectors, "x_id string, toxic long, ids binary, counts binary").toArrow()


def _corpus_frequencies(docs: DataFrame, text_col: str, shared) -> tuple[int, np.ndarray]:
    """The number of documents and, of each feature, of documents that hold it: over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, n = _Tokens(shared.value), np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for text in _texts(batch, text_col):
                seen[tokens.packed(text)[0]] += 1
                n += 1
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], n))], names=["id", "n"])

    found = docs.select(F.col(text_col).alias(text_col)).mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found["id"].to_numpy(), found["n"].to_numpy()
    out = np.zeros(len(shared.value), np.int64)
    out[ids[ids >= 0]] = n[ids >= 0]
    return int(n[ids < 0].sum()), out


def unit(ids: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a text's features, of length 1."""
    raw = (1 + np.log(counts)) * weight[ids]
    return raw / np.sqrt((raw * raw).sum())


class BlockMaxIndex:
    """Normalised vectors by feature, in blocks of similar vectors.

    Features that few vectors hold have postings, which are added up in full. Of
    the others a block has the largest weight only, and a vector its length in
    them: both bound what they can add to a cosine. Vectors whose bound reaches
    the k-th best cosine known are completed exactly from their own weights. For
    queries whose bounds leave many vectors, one matrix product narrows them down
    first.
    """

    def __init__(self, vectors: list[dict[int, float]]):
        n = [len(v) for v in vectors]
        flat = (np.fromiter((x for v in vectors for x in v), np.int64, sum(n)), np.fromiter((w for v in vectors for w in v.values()), float, sum(n)))
        self._build(np.repeat(np.arange(len(n), dtype=np.int32), n), *flat, len(n))

    @classmethod
    def of(cls, rows: np.ndarray, features: np.ndarray, weights: np.ndarray, n: int) -> BlockMaxIndex:
        index = cls.__new__(cls)
        index._build(rows, features, weights, n)
        return index

    def _build(self, rows: np.ndarray, features: np.ndarray, weights: np.ndarray, n: int) -> None:
        self.n, self.n_features = n, int(features.max(initial=-1)) + 1
        df = np.bincount(features, minlength=self.n_features)
        many = np.flatnonzero(df >= max(2 * BLOCK, MANY_SHARE * n))
        self.slot_of = np.full(self.n_features, -1, np.int32)  # of features that many vectors hold
        self.slot_of[many] = np.arange(len(many))
        slots = self.slot_of[features]
        often = slots >= 0
        # Similar vectors stand together: those whose heaviest features are the same.
        by = np.lexsort((-weights[often], rows[often]))
        heads, first = np.unique(rows[often][by], return_index=True)
        heaviest = np.full((2, n), -1, np.int64)
        heaviest[0, heads] = slots[often][by[first]]
        second = np.minimum(first + 1, max(len(by) - 1, 0))
        heaviest[1, heads] = np.where(rows[often][by[second]] == heads, slots[often][by[second]], -1)
        self.name = np.lexsort((np.arange(n), heaviest[1], heaviest[0])).astype(np.int32)  # of the vector at each place
        place = np.empty(n, np.int32)
        place[self.name] = np.arange(n, dtype=np.int32)
        rows = place[rows]

        order = np.argsort(rows[often], kind="stable")
        self.own_slots, self.own_weights = slots[often][order], weights[often][order]
        self.own_starts = np.concatenate([[0], np.cumsum(np.bincount(rows[often], minlength=n))])
        self.length = np.sqrt(np.bincount(rows[often], weights[often].astype(float) ** 2, n))
        self.matrix = np.zeros((len(many), n), np.float32)
        self.matrix[slots[often], rows[often]] = weights[often]
        self.block_max = np.zeros((-(-n // BLOCK), len(many)), np.float32)
        np.maximum.at(self.block_max, (rows[often] // BLOCK, slots[often]), weights[often])

        rows, features, weights = rows[~often], features[~often], weights[~often]
        order = np.argsort(features, kind="stable")
        self.rows, self.weights = rows[order], weights[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(features, minlength=self.n_features))]).astype(np.int64)

    def search(self, query: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k nearest vectors, best first, ties by id; all that share a feature if they are fewer."""
        return self.search_all([(np.array(list(query), np.int64), np.array(list(query.values()), float))], k)[0]

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search`` for queries of features and weights."""
        return [x for at in range(0, len(queries), TOGETHER) for x in self._search_part(queries[at : at + TOGETHER], k)]

    def _search_part(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        often = np.zeros((len(queries), len(self.matrix)))
        sums = np.empty((len(queries), self.n))
        for i, (features, weights) in enumerate(queries):
            known = features < self.n_features
            features, weights = features[known], weights[known]
            slots = self.slot_of[features]
            often[i, slots[slots >= 0]] = weights[slots >= 0]
            sums[i] = self._postings(features[slots < 0], weights[slots < 0])
        bounds = often.astype(np.float32) @ self.block_max.T
        hits = [self._reaching(sums[i], np.minimum(np.repeat(bounds[i], BLOCK)[: self.n], self.length * np.sqrt(often[i] @ often[i])), often[i], k) for i in range(len(queries))]
        many = [i for i, hit in enumerate(hits) if len(hit) > max(k, FEW * self.n)]
        if many:
            added = often[many].astype(np.float32) @ self.matrix
            for i, more in zip(many, added, strict=True):
                hits[i] = self._reaching(sums[i], more, often[i], k)
        return [self._nearest(sums[i], hit, often[i], k) for i, hit in enumerate(hits)]

    def _postings(self, features: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the features that few vectors hold add to all cosines."""
        starts, n = self.starts[features], self.starts[features + 1] - self.starts[features]
        at = np.arange(n.sum(), dtype=np.int32) + np.repeat((starts - np.cumsum(n) + n).astype(np.int32), n)
        return np.bincount(self.rows.take(at), self.weights.take(at) * np.repeat(weights, n), self.n)

    def _complete(self, sums: np.ndarray, places: np.ndarray, often: np.ndarray) -> np.ndarray:
        """Exact cosines of some vectors."""
        starts = self.own_starts[places]
        n = self.own_starts[places + 1] - starts
        at = np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)
        added = np.bincount(np.repeat(np.arange(len(places)), n), self.own_weights[at] * often[self.own_slots[at]], len(places))
        return np.round(sums[places] + added, 12)

    def _reaching(self, sums: np.ndarray, at_most: np.ndarray, often: np.ndarray, k: int) -> np.ndarray:
        """Vectors that may be among the k nearest: ``at_most`` bounds what is still to add, in single precision."""
        most = sums + at_most
        hit = most > 0
        if self.n > k:
            # The exact cosines of the k vectors of the largest bounds are a floor under the k-th best one.
            likely = np.argpartition(most, self.n - k)[self.n - k :]
            hit &= most >= self._complete(sums, likely, often).min() - SLACK
        return np.flatnonzero(hit)

    def _nearest(self, sums: np.ndarray, hit: np.ndarray, often: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        cosines, names = self._complete(sums, hit, often), self.name[hit]
        best = np.lexsort((names, -cosines))[:k]
        best = best[cosines[best] > 0]
        return names[best], cosines[best]


@dataclass
class Examples:
    """What travels to the workers; each builds the index for itself, so that the driver holds the plain vectors only."""

    vocabulary: dict[str, int]
    weight: np.ndarray  # of features: inverse document frequency times relevance
    features: np.ndarray  # of all vectors, one after the other
    weights: np.ndarray
    starts: np.ndarray  # of vectors in features and weights, and the end
    counts: np.ndarray  # of merged examples, by vector: clean, toxic
    example_ids: list[str]
    empty_score: float
    prior: float
    k: int

    @cached_property
    def index(self) -> BlockMaxIndex:
        n = len(self.counts)
        return BlockMaxIndex.of(np.repeat(np.arange(n, dtype=np.int32), np.diff(self.starts)), self.features, self.weights, n)

    def left_out_votes(self, places: list[int]) -> list[tuple[int, int, float, int]]:
        """Vector, label, vote and number of the examples of some vectors, each example left out of its own vote."""
        own = [slice(self.starts[i], self.starts[i + 1]) for i in places]
        found = self.index.search_all([(self.features[s], self.weights[s].astype(float)) for s in own], self.k)
        return [(i, label, self.vote(*near, (i, label)), int(self.counts[i, label])) for i, near in zip(places, found, strict=True) for label in (0, 1) if self.counts[i, label]]

    def vote(self, ids: np.ndarray, cosines: np.ndarray, without: tuple[int, int] | None = None) -> float:
        """Share of toxic examples among neighbours, weighted by 1 / distance; ``without``: leave one example of (vector, label) out."""
        counts = self.counts[ids].astype(float)
        if without is not None:
            counts[ids == without[0], without[1]] -= 1
        weights = counts / (1.0 - np.minimum(cosines, 1.0) + 0.05)[:, None]
        return float((weights[:, 1].sum() + self.prior) / (weights.sum() + 1.0))

    def score_all(self, packed: list[bytes], steps: np.ndarray, levels: np.ndarray) -> list[tuple[float, list[tuple[str, float, float]]]]:
        """Calibrated score and the nearest examples (id, toxic share, cosine) of texts, each given as its features and their counts."""
        pairs = [np.frombuffer(p, "<i4").reshape(2, -1) for p in packed]
        found = iter(self.index.search_all([(p[0], unit(*p, self.weight)) for p in pairs if p.size], self.k))
        out = []
        for p in pairs:
            ids, cosines = next(found) if p.size else ((), ())
            if not len(ids):
                out.append((self.empty_score, []))
                continue
            near = [(self.example_ids[i], float(self.counts[i, 1] / self.counts[i].sum()), float(c)) for i, c in zip(ids[:3], cosines[:3], strict=True)]
            vote = self.vote(ids, cosines)
            out.append((float(levels[np.searchsorted(steps, vote, "right") - 1]) if len(steps) else vote, near))
        return out


@dataclass
class Model:
    examples: Broadcast
    steps: np.ndarray  # votes at which the calibrated score changes
    levels: np.ndarray


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps and levels of the rising function nearest to the labels."""
    pools: list[list[float]] = []
    for i in np.argsort(votes, kind="stable"):
        pools.append([votes[i], labels[i] * weights[i], weights[i]])
        while len(pools) > 1 and (pools[-1][0] == pools[-2][0] or pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]):
            _, s, w = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += w
    steps = np.array([p[0] for p in pools])
    levels = np.array([(p[1] + 0.01) / (p[2] + 0.1) for p in pools])
    if len(steps):
        steps[0] = -np.inf
    return steps, levels


def _left_out_votes(spark: SparkSession, shared: Broadcast, n: int) -> tuple[np.ndarray, ...]:
    """Votes, labels and numbers of all examples; tasks search, one row for each vector and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = shared.value.left_out_votes(batch.column("id").to_pylist())
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["i", "label", "vote", "n"])

    tasks = max(1, min(n // 500, 2 * spark.sparkContext.defaultParallelism))
    found = spark.range(0, n, 1, tasks).mapInArrow(run, "i long, label long, vote double, n long").toArrow().sort_by([("i", "ascending"), ("label", "ascending")])
    return tuple(found[c].to_numpy().astype(float) for c in ("vote", "label", "n"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_examples: int = MAX_EXAMPLES, k: int = K) -> Model | None:
    """The model, or None without training rows."""
    spark = docs.sparkSession
    examples = materialise(labelled(docs, labels, id_col, text_col, max_examples), "toxic-examples")
    by_label = {bool(r["t"]): r["n"] for r in examples.groupBy((F.col("toxic") == 1).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = by_label.get(False, 0), by_label.get(True, 0)
    if not n_clean + n_toxic:
        return None
    features = feature_counts(examples)
    vocabulary = {name: i for i, name in enumerate(features["feature"].to_pylist())}
    shared = spark.sparkContext.broadcast(vocabulary)
    total, found = _corpus_frequencies(docs, text_col, shared)
    weight = (np.log((total + 1) / (found + 1)) + 1) * relevance(features["toxic"].to_numpy(), features["clean"].to_numpy(), n_toxic, n_clean)
    base = n_toxic / (n_clean + n_toxic)
    empty, merged = [0, 0], {}
    for batch in _vectors(examples, shared).to_batches():
        for row in range(batch.num_rows):
            x_id, toxic, *key = (c[row].as_py() for c in batch.columns)
            label = int(toxic == 1)
            if not key[0]:
                empty[label] += 1
                continue
            entry = merged.setdefault(tuple(key), [x_id, [0, 0]])
            entry[0] = min(entry[0], x_id, key=lambda x: (len(x), x))
            entry[1][label] += 1
    del batch
    empty_score = (empty[1] + base) / (sum(empty) + 1)
    keys = sorted(merged, key=lambda c: (len(merged[c][0]), merged[c][0], c))  # in the order of ids, by which ties go
    starts = np.concatenate([[0], np.cumsum([len(c[0]) // 4 for c in keys], dtype=np.int64)]).astype(np.int64)
    ids, weights = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.float32)
    for i, c in enumerate(keys):
        own = slice(starts[i], starts[i + 1])
        ids[own] = np.frombuffer(c[0], "<i4")
        weights[own] = unit(ids[own], np.frombuffer(c[1], "<i4"), weight)
    by_vector = (np.array([merged[c][1] for c in keys], np.int64).reshape(-1, 2), [merged[c][0] for c in keys])
    del keys, merged
    held = spark.sparkContext.broadcast(Examples(vocabulary, weight, ids, weights, starts, *by_vector, empty_score, base, k))
    n = len(by_vector[0])
    votes = _left_out_votes(spark, held, n) if n else (np.empty(0),) * 3
    return Model(held, *isotonic(*votes))


EVIDENCE = T.ArrayType(T.StructType([T.StructField("example_id", T.StringType()), T.StructField("toxic_share", T.DoubleType()), T.StructField("cosine", T.DoubleType())]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Score all documents; no shuffle, the model is bounded by its parameters."""
    kept = docs.drop(*ADDED)
    if model is None:
        added = kept.withColumn("score", F.lit(0.0)).withColumn("evidence", F.array().cast(EVIDENCE))
    else:
        shared, steps, levels = model.examples, model.steps, model.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_memory()
            model = shared.value
            tokens, known = _Tokens(model.vocabulary), {}
            for batch in batches:
                scores, evidence = [], []
                packed = [tokens.packed(text).tobytes() for text in _texts(batch, text_col)]
                names = [hashlib.blake2b(p, digest_size=16).digest() for p in packed]
                if len(known) > TEXTS:
                    known.clear()
                new = {n: p for n, p in zip(names, packed, strict=True) if n not in known}
                known.update(zip(new, model.score_all(list(new.values()), steps, levels), strict=True))
                for name in names:
                    s, e = known[name]
                    scores.append(s)
                    evidence.append([{"example_id": i, "toxic_share": t, "cosine": c} for i, t, c in e])
                kind = pa.list_(pa.struct([("example_id", pa.string()), ("toxic_share", pa.float64()), ("cosine", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=[*batch.schema.names, "score", "evidence"])

        added = kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE)]))
    return added.select(*kept.columns, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
