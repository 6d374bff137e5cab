"""Language-model scoring with Brown class-based bigrams.

P(w | v) = P(class(w) | class(v)) * P(w | class(w)). Classes come from exchange
clustering run as Spark jobs: every round each item is moved to the class that
raises the likelihood of the class bigrams most, with the other items' classes
fixed for the round; alternate halves of the items move. Items are the words of
a relative frequency of at least ``ITEM_SHARE``, each alone, and all rarer words
tied by their endings, so every word of the corpus belongs to a class and all
bigrams of the training texts count. Both kinds of items are bounded by their
definition (at most 1 / ``ITEM_SHARE`` words and ``ENDINGS`` groups), at any size of
the input. Then every word of at least ``WORD_SHARE`` and ``OWN_COUNT`` occurrences
leaves its group for the class that the classes before and after it make likeliest,
in ``WORD_ROUNDS`` rounds in which all of them move at once; the table is counted
anew after each, and its moves stand if they raise the likelihood. Texts are read
for counts, once more for the codes of their words (a written table that all later
counts read), and for scores.
Only words rarer than that keep their ending's class.

Word counts are exact and cover all training texts. Words of a relative
frequency of at least ``WORD_SHARE`` (at most 1 / ``WORD_SHARE`` words) travel with
the task; occurrences of rarer words are joined with the table of counts.
Unknown words get their class's Good-Turing mass of words seen once.

What happens in special cases:

* a null or empty text is the end token alone;
* training texts are those whose crc32(id) mod 10 is not 0; rows of a null id
  belong to them; rows that repeat count as often as they occur;
* without training texts every score is 0, as the base score is;
* other columns of the input are not carried; an empty table gives an empty
  result;
* words rarer than ``WORD_SHARE`` are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.shared import materialise

CLASSES = 64
ROUNDS = 8
ITEM_SHARE = 5e-5
WORD_SHARE = 1e-6
ENDINGS = 1024
#: Occurrences from which a word has enough neighbours to choose a class of its own.
OWN_COUNT = 10
WORD_ROUNDS = 2
#: Strength with which class transitions lean on class frequencies.
LEAN = 10.0
ADD = 0.1
END = b""
#: Distinct words or bigrams that a task holds before it passes them on; words whose code a worker remembers.
HOLD = 1_000_000


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def words(text: bytes | None) -> list[bytes]:
    """Words and the end token; bytes lower A-Z only and split at the six ASCII spaces."""
    found = (text or b"").lower().split()
    found.append(END)
    return found


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def ending(word: bytes) -> int:
    """The group of a rare word: its last two characters and its closing mark."""
    core = word.rstrip(b".,;:!?")
    return zlib.crc32(core.decode("utf-8", "replace")[-2:].encode() + word[len(core) : len(core) + 1]) % ENDINGS


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(column).cast(pa.binary()))


def word_counts(training: DataFrame) -> DataFrame:
    """``h, word, n`` of every token of the training texts."""

    def emit(counts: Counter) -> pa.RecordBatch:
        names = list(counts)
        return pa.RecordBatch.from_arrays([pa.array(map(word_hash, names), pa.int64(), size=len(names)), pa.array(names, pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["h", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                counts.update(words(text))
            if len(counts) > HOLD:
                yield emit(counts)
                counts = Counter()
        yield emit(counts)

    return training.select("text").mapInArrow(count, "h long, word binary, n long").groupBy("h", "word").agg(F.sum("n").alias("n"))


class Coder(dict):
    """Codes of words: the position of a frequent word, or -1 - item of a rare one."""

    def __init__(self, frequent: list[bytes], first_group: int):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.first_group, self.fixed = first_group, len(frequent)

    def __missing__(self, word: bytes) -> int:
        code = -1 - (self.first_group + ending(word))
        if len(self) < self.fixed + HOLD:
            self[word] = code
        return code


def encoded(training: DataFrame, shared) -> DataFrame:
    """``codes`` of every text: those of its tokens, as little-endian 32-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _, first_group, _ = shared.value
        coder = Coder(frequent, first_group)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                codes = [np.fromiter(map(coder.__getitem__, words(text)), "<i4").tobytes() for text in _texts(batch.slice(at, 256))]
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary())], names=["codes"])

    return training.select("text").mapInArrow(encode, "codes binary")


def _chains(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[np.ndarray]:
    """Codes of some texts in a row; the end token of each stands before the next."""
    before = np.array([end], "<i4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield np.frombuffer(before + b"".join(batch.column("codes").slice(at, 256).to_pylist()), "<i4").astype(np.int64)


def bigrams(codes: DataFrame, shared) -> DataFrame:
    """``a, b, n``: bigrams of items, the end token standing before each text too."""

    def emit(held: list[np.ndarray], width: int) -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(held or [np.empty(0, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs // width), pa.array(pairs % width), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, item_of, first_group, end = shared.value
        width = first_group + ENDINGS
        held, size = [], 0
        for code in _chains(batches, end):
            items = np.where(code >= 0, item_of[np.maximum(code, 0)], -1 - code)
            held.append(items[:-1] * width + items[1:])
            size += len(items)
            if size > 4 * HOLD:
                yield emit(held, width)
                held, size = [], 0
        yield emit(held, width)

    return codes.mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _kinds(code: np.ndarray, word_class: np.ndarray, item_class: np.ndarray) -> np.ndarray:
    """Classes of word codes."""
    return np.where(code >= 0, word_class[np.maximum(code, 0)], item_class[np.maximum(-1 - code, 0)])


def contexts(codes: DataFrame, shared, classes, n_classes: int) -> DataFrame:
    """``code, cells, n`` of each word that may move: counts of classes before it, after it, and of its own repeats."""
    width = 2 * n_classes + 1

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held or [np.empty(0, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys // width), pa.array(keys % width), pa.array(n.astype(np.int64))], names=["code", "cell", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_class, item_class, free = classes.value
        held, size = [], 0
        for code in _chains(batches, shared.value[3]):
            kind, moves = _kinds(code, word_class, item_class), (code >= 0) & free[np.maximum(code, 0)]
            again = code[:-1] == code[1:]
            before, after = moves[1:] & ~again, moves[:-1]
            held.append(code[1:][before] * width + kind[:-1][before])
            held.append(code[:-1][after] * width + np.where(again, 2 * n_classes, n_classes + kind[1:])[after])
            size += len(held[-1]) + len(held[-2])
            if size > 4 * HOLD:
                yield emit(held)
                held, size = [], 0
        yield emit(held)

    # Tasks have combined their counts; words that move are no hot keys, as none reaches ITEM_SHARE.
    cells = codes.mapInArrow(count, "code long, cell long, n long").repartition("code").groupBy("code", "cell").agg(F.sum("n").alias("n"))
    return cells.groupBy("code").agg(F.collect_list(F.struct("cell", "n")).alias("x")).select("code", F.col("x.cell").alias("cells"), F.col("x.n").alias("n"))


def own_classes(around: DataFrame, classes, table: np.ndarray) -> pa.Table:
    """``code, to`` of the words that leave their group's class: at most one row for each of the bounded words."""
    n_classes, sent = len(table), around.sparkSession.sparkContext.broadcast(table)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (word_class, _, _), table = classes.value, sent.value
        for batch in batches:
            codes, to = [], []
            for code, cells, n in zip(batch.column("code").to_pylist(), batch.column("cells"), batch.column("n"), strict=True):
                seen = np.zeros(2 * n_classes + 1)
                seen[cells.values.to_numpy()] = n.values.to_numpy()
                best = best_class(int(word_class[code]), seen[:n_classes], seen[n_classes:-1], seen[-1], table)
                if best != word_class[code]:
                    codes.append(code)
                    to.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(to, pa.int64())], names=["code", "to"])

    return around.mapInArrow(move, "code long, to long").toArrow()


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(now: int, left: np.ndarray, right: np.ndarray, twice: float, table: np.ndarray) -> int:
    """The class to which an item belongs by likelihood, from its counts after and before classes (itself left out)."""
    h = table.astype(float).copy()
    h[now, :] -= right
    h[:, now] -= left
    h[now, now] -= twice
    diagonal = np.diagonal(h)
    some = np.flatnonzero(right)
    gain = (_xlogx(h[:, some] + right[some]) - _xlogx(h[:, some])).sum(axis=1) - (_xlogx(diagonal + right) - _xlogx(diagonal))
    some = np.flatnonzero(left)
    gain += (_xlogx(h[some] + left[some, None]) - _xlogx(h[some])).sum(axis=0) - (_xlogx(diagonal + left) - _xlogx(diagonal))
    gain += _xlogx(diagonal + left + right + twice) - _xlogx(diagonal)
    before, after = h.sum(axis=1) + left, h.sum(axis=0) + right  # neighbours keep these counts wherever the item goes
    gain -= _xlogx(before + right.sum() + twice) - _xlogx(before)
    gain -= _xlogx(after + left.sum() + twice) - _xlogx(after)
    best = int(np.argmax(gain))
    return best if gain[best] > gain[now] + 1e-6 * abs(gain[now]) else now


def _summed(cells: DataFrame, n_classes: int) -> np.ndarray:
    """The table of which tasks sent their cells."""
    out = np.zeros(n_classes * n_classes, np.int64)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out.reshape(n_classes, n_classes)


def word_table(codes: DataFrame, shared, classes, n_classes: int) -> np.ndarray:
    """Counts of class bigrams where words have classes of their own, from the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_class, item_class, _ = classes.value
        sums = np.zeros(n_classes * n_classes, np.int64)
        for code in _chains(batches, shared.value[3]):
            kind = _kinds(code, word_class, item_class)
            sums += np.bincount(kind[:-1] * n_classes + kind[1:], minlength=n_classes * n_classes)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], names=["cell", "n"])

    return _summed(codes.mapInArrow(count, "cell long, n long"), n_classes)


def class_table(around: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Counts of class bigrams; tasks send one small table each, summed by cell."""
    shared = around.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, sums = shared.value, np.zeros((n_classes, n_classes), np.int64)
        for batch in batches:
            for item, after, n in zip(batch.column("item").to_pylist(), batch.column("after"), batch.column("after_n"), strict=True):
                if len(after.values):
                    sums[classes[item]] += np.bincount(classes[after.values.to_numpy()], n.values.to_numpy(), n_classes).astype(np.int64)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums.ravel()[cells])], names=["cell", "n"])

    return _summed(around.select("item", "after", "after_n").mapInArrow(count, "cell long, n long"), n_classes)


def likelihood(table: np.ndarray) -> float:
    t = table.astype(float)
    return float(_xlogx(t).sum() - _xlogx(t.sum(axis=0)).sum() - _xlogx(t.sum(axis=1)).sum())


def exchange(around: DataFrame, start: np.ndarray, n_classes: int, rounds: int, fixed: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of items and their table after some rounds; the likelihood never ends below the best seen."""
    classes, table = start, class_table(around, start, n_classes)
    best = (likelihood(table), classes, table)
    for turn in range(rounds):
        shared = around.sparkSession.sparkContext.broadcast((classes, table))

        def move(batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            classes, table = shared.value
            for batch in batches:
                items, moved = [], []
                columns = [batch.column(c) for c in ("before", "before_n", "after", "after_n")]
                for item, *lists in zip(batch.column("item").to_pylist(), *columns, strict=True):
                    if item == fixed or zlib.crc32(f"{item}".encode()) % 2 != turn % 2:
                        continue
                    before, before_n, after, after_n = (x.values.to_numpy() for x in lists)
                    twice = float(after_n[after == item].sum())
                    left = np.bincount(classes[before[before != item]], before_n[before != item], n_classes)
                    right = np.bincount(classes[after[after != item]], after_n[after != item], n_classes)
                    to = best_class(int(classes[item]), left, right, twice, table)
                    if to != classes[item]:
                        items.append(item)
                        moved.append(to)
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(moved, pa.int64())], names=["item", "to"])

        moves = around.mapInArrow(move, "item long, to long").collect()  # at most one row for each of the bounded items
        classes = classes.copy()
        for row in moves:
            classes[row["item"]] = row["to"]
        table = class_table(around, classes, n_classes)
        if likelihood(table) > best[0]:
            best = (likelihood(table), classes, table)
        if not moves:
            break
    return best[1], best[2]


@dataclass
class Model:
    frequent: list[bytes]
    first_group: int
    end: int
    item_class: np.ndarray  # of items
    word_class: np.ndarray  # of frequent words
    word_log: np.ndarray  # log10 P(word | class) of frequent words
    word_base: np.ndarray  # log10 of base probabilities of frequent words
    step_log: np.ndarray  # log10 P(class | class before)
    known_log: np.ndarray  # per class, what a rare word's log10 count is added to
    unknown_log: np.ndarray
    tokens: int
    base_total: float
    counts: DataFrame  # h, n of rarer words


def fit(training: DataFrame, n_classes: int = CLASSES, rounds: int = ROUNDS) -> Model | None:
    """The model of a table with ``text``; None if the table is empty."""
    counts = materialise(word_counts(training), "lm-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    if not total["n"]:
        return None
    n_tokens, n_types = total["n"], total["v"]
    least = max(1, math.ceil(WORD_SHARE * n_tokens))
    is_frequent = (F.col("n") >= least) | (F.col("word") == F.lit(END))
    rows = sorted(counts.filter(is_frequent).select("word", "n").collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    frequent, n = [bytes(r["word"]) for r in rows], np.array([r["n"] for r in rows], np.int64)
    end = frequent.index(END)
    alone = (n >= ITEM_SHARE * n_tokens) | (np.arange(len(n)) == end)
    first_group = int(alone.sum())
    item_of = np.empty(len(n), np.int64)
    item_of[alone] = np.arange(first_group)
    item_of[~alone] = [first_group + ending(frequent[i]) for i in np.flatnonzero(~alone)]
    shared = training.sparkSession.sparkContext.broadcast((frequent, item_of, first_group, end))
    codes = materialise(encoded(training, shared), "lm-codes")
    pairs = materialise(bigrams(codes, shared), "lm-bigrams")
    gathered = lambda key, other: pairs.groupBy(F.col(key).alias("item")).agg(F.collect_list(F.struct(F.col(other).alias("o"), "n")).alias("x"))  # noqa: E731  at most one entry for each item
    after = gathered("a", "b").select("item", F.col("x.o").alias("after"), F.col("x.n").alias("after_n"))
    before = gathered("b", "a").select("item", F.col("x.o").alias("before"), F.col("x.n").alias("before_n"))
    none = F.array().cast("array<bigint>")
    around = after.join(before, "item", "full").select("item", *[F.coalesce(c, none).alias(c) for c in ("before", "before_n", "after", "after_n")])
    around = materialise(around, "lm-around")
    width, end_item = first_group + ENDINGS, int(item_of[end])
    start = 1 + np.arange(width) % (n_classes - 1)
    start[end_item] = 0
    item_class, table = exchange(around, start, n_classes, rounds, end_item)

    # Words that are common enough for it leave the groups.
    spark_context = training.sparkSession.sparkContext
    word_class, free = item_class[item_of], ~alone & (n >= OWN_COUNT)
    for _ in range(WORD_ROUNDS):
        classes = spark_context.broadcast((word_class, item_class, free))
        moved = own_classes(contexts(codes, shared, classes, n_classes), classes, table)
        own = word_class.copy()
        own[moved["code"].to_numpy()] = moved["to"].to_numpy()
        own_table = word_table(codes, shared, spark_context.broadcast((own, item_class, free)), n_classes)
        if likelihood(own_table) <= likelihood(table):
            break
        word_class, table = own, own_table
    classes = spark_context.broadcast((word_class, item_class, free))

    # Tokens and words seen once of each class, from all counts.
    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _, first_group, _ = shared.value
        word_class, item_class, _ = classes.value
        coder, sums = Coder(frequent, first_group), np.zeros((n_classes, 2), np.int64)
        for batch in batches:
            code = np.array([coder[w.as_py()] for w in batch.column("word")], np.int64)
            times = batch.column("n").to_numpy()
            np.add.at(sums, _kinds(code, word_class, item_class), np.stack([times, times == 1], axis=1))
        some = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some, 0]), pa.array(sums[some, 1])], names=["class", "n", "once"])

    per_class = np.zeros((n_classes, 2))
    for row in counts.select("word", "n").mapInArrow(by_class, "class long, n long, once long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("once").alias("once")).collect():
        per_class[row["class"]] = (row["n"], row["once"])
    tokens, once = per_class.T
    unknown = (once + ADD) / (tokens + once + 2 * ADD)
    share = (tokens + ADD) / (n_tokens + ADD * n_classes)
    steps = (table + LEAN * share[None, :]) / (table.sum(axis=1, keepdims=True) + LEAN)
    known_log = np.log10(1 - unknown) - np.log10(np.maximum(tokens, 1))
    base_total = math.log10(n_tokens + ADD * (n_types + 1))
    return Model(
        frequent, first_group, end, item_class, word_class, np.log10(n) + known_log[word_class], np.log10(n + ADD) - base_total, np.log10(steps), known_log, np.log10(unknown), n_tokens, base_total,
        counts.filter(~is_frequent).select(F.col("h").alias("c_h"), F.col("n").alias("c_n")),
    )


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        n = 1 + F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
        return source.select("doc_id", n.cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    light = (model.frequent, model.first_group, model.end, model.item_class, model.word_class, model.word_log, model.word_base, model.step_log)
    shared = docs.sparkSession.sparkContext.broadcast(light)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, first_group, end, item_class, word_class, word_log, word_base, step_log = shared.value
        coder = Coder(frequent, first_group)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                tokens, sizes = [], []
                for text in _texts(part):
                    found = words(text)
                    tokens += found
                    sizes.append(len(found))
                code = np.fromiter(map(coder.__getitem__, tokens), np.int64, len(tokens))
                starts = np.cumsum([0, *sizes[:-1]])
                known, rare = code >= 0, np.flatnonzero(code < 0)
                kind, place = _kinds(code, word_class, item_class), np.maximum(code, 0)
                steps = step_log[np.concatenate([[word_class[end]], kind[:-1]]), kind]  # each text ends with the end token
                per_text = lambda values: np.add.reduceat(values, starts)  # noqa: B023, E731
                base, logp = per_text(np.where(known, word_base[place], 0.0)), per_text(steps + np.where(known, word_log[place], 0.0))
                n_known = per_text(known.astype(np.int64))
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes - n_known)]), pa.int32())
                hashes = pa.ListArray.from_arrays(ends, pa.array([word_hash(tokens[i]) for i in rare.tolist()], pa.int64()))
                kinds = pa.ListArray.from_arrays(ends, pa.array(kind[rare], pa.int8()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n_known), pa.array(base), pa.array(logp), hashes, kinds], names=["doc_id", "n_tokens", "n_frequent", "base", "logp", "hashes", "kinds"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = source.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_frequent long, base double, logp double, hashes array<long>, kinds array<tinyint>")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("hashes", "kinds")).alias("x")).select("row", "x.hashes", "x.kinds")
    lit = lambda values: F.array(*[F.lit(float(v)) for v in values])
    seen = F.col("c_n").isNotNull()
    found = rare.join(model.counts, F.col("hashes") == F.col("c_h"), "left").select(
        "row",
        seen.cast("long").alias("known"),
        F.log10(F.coalesce("c_n", F.lit(0)) + F.lit(ADD)).alias("base"),
        F.when(seen, F.log10("c_n") + F.get(lit(model.known_log), F.col("kinds").cast("int"))).otherwise(F.get(lit(model.unknown_log), F.col("kinds").cast("int"))).alias("logp"),
    )
    sums = found.groupBy("row").agg(F.sum("known").alias("r_known"), F.sum("base").alias("r_base"), F.sum("logp").alias("r_logp"), F.count(F.lit(1)).alias("r_n"))
    zero = F.lit(0)
    return scored.select("row", "doc_id", "n_tokens", "n_frequent", "base", "logp").join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("r_known", zero)).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0)) - F.coalesce("r_n", zero) * F.lit(model.base_total)).alias("base_score"),
        (F.col("logp") + F.coalesce("r_logp", F.lit(0.0))).alias("score"),
    )
