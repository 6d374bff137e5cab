"""Exact Jaccard join of word-shingle sets with adaptive multi-match prefixes.

Shingles are put in one global order, rare first (by a count sketch over all
documents; the order only steers cost). With overlap of at least ceil(t * n)
demanded of a set of n shingles, two linked sets share at least k shingles among
the first n - ceil(t * n) + k of each. Every document chooses its own k: a longer
prefix where the estimated candidates of a short one would cost more, and a pair
must then share min(k1, k2) prefix shingles before it is verified exactly.

Documents with equal word sequences are one class from the start. First each class
meets the hub with which it shares most prefix shingles (a hub is the class of the
most common prefix among a shingle's holders), which joins nearly all near copies.
Classes of different components that still share a prefix shingle come next: in
small groups pair by pair, and only pairs that share shingles enough move on; in
large ones block by block, without blocks that are one component already. Texts
move only to verify what is left. Compared classes return a spanning forest of
their links, which keeps all components without writing out all pairs.

What happens in special cases:

* a text without words (or null) has an empty set and links with nothing;
* a text of fewer words than a shingle has its whole sequence as one shingle;
* rows that share an id are separate nodes if their words differ; rows that are
  equal are one class;
* component ids are the smallest ids of components; a null id is taken only
  where no row has another;
* other columns of the input are not carried; an empty table gives an empty
  result;
* shingles and word sequences are compared by 64-bit hashes: two given ones
  collide with a chance of 5e-20.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.graph import Forest, components
from presslens.llm.memory import release_memory
from presslens.shared import materialise

WORDS = 5
PERCENT = 80
#: Sketch: 2 ** 24 counters in ranges of 2 ** 14, on a logarithmic scale of one byte each: 16 MB in all.
SKETCH_BITS, RANGE_BITS = 24, 14
#: Cost of verifying a pair against reading one posting.
VERIFY_COST = 30.0
MAX_MATCH = 8
#: Members of a group that are compared in one block.
GROUP = 256
#: Shingles of at most about so many holders by the sketch are cold.
COLD = 4096
#: Groups of at most so many holders are taken pair by pair.
SMALL = 16
#: A node's hub is likely to be its copy if it stands for a 1 / LIKELY of the node's prefix.
LIKELY = 4
#: Shingles that are counted together in a block.
COLUMNS = 4096
#: So many rows of ids are sent to every executor (40 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Bytes of words whose hash a task remembers, about; the memory starts again beyond it.
CACHE_BYTES = 32 << 20


class Shingler:
    """Shingle hashes of whole texts."""

    def __init__(self, size: int):
        self.size, self.words, self.held = size, {}, 0

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The distinct shingles' hashes, in order of hash."""
        if len(words) < self.size:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)] if words else [], np.uint64)
        known = self.words
        if self.held > CACHE_BYTES:
            known.clear()
            self.held = 0
        try:
            ids = np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
                    self.held += 150 + len(w)
            ids = np.array([known[w] for w in words], np.uint64)
        n = len(words) - self.size + 1
        mixed = ids[:n].copy()
        for k in range(1, self.size):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (mixed >> np.uint64(31)) + ids[k : k + n]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(mixed ^ mixed >> np.uint64(32))


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII spaces


def sequence_hash(words: list[bytes]) -> int:
    """What stands for a word sequence."""
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def _bytes(column: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in column.cast(pa.binary()))


def count_sketch(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, float]:
    """Logarithmic counters of all shingles (copies within a task counted once) and the mean load of a counter."""
    width = 1 << RANGE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        shingler, counts, seen = Shingler(size), np.zeros(1 << SKETCH_BITS, np.uint16), set()
        for batch in batches:
            for text in _bytes(batch.column(0)):
                words = split(text)
                key = xxhash.xxh3_64_intdigest(b" ".join(words))
                if key not in seen:
                    seen.add(key)
                    at = (shingler.hashes(words) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                    counts[at] += (counts[at] < 65535).astype(np.uint16)
        rows = counts.reshape(-1, width)
        some = np.flatnonzero(rows.any(axis=1))
        places = [np.flatnonzero(rows[r]).astype("<u2") for r in some]
        for a in range(0, len(some), 128):
            part = some[a : a + 128]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([places[a + k].tobytes() for k in range(len(part))], pa.binary()), pa.array([rows[r][places[a + k]].astype("<u2").tobytes() for k, r in enumerate(part)], pa.binary())],
                names=["part", "places", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part not in sums:
                    sums[part] = np.zeros(width, np.int64)
                sums[part][np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<u2")
        levels = [np.where(s > 0, np.minimum(255, 1 + 8 * np.log2(np.maximum(s, 1))), 0).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(levels, pa.binary()), pa.array([int(s.sum()) for s in sums.values()], pa.int64())], names=["part", "levels", "total"])

    parts = docs.select(text_col).mapInArrow(count, "part long, places binary, counts binary").repartition("part").mapInArrow(add, "part long, levels binary, total long")
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    total = 0
    for row in parts.collect():  # at most 2 ** (SKETCH_BITS - RANGE_BITS) rows, 16 MB
        levels[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(row["levels"], np.uint8)
        total += row["total"]
    return levels, total / (1 << SKETCH_BITS)


class Orderer:
    """Puts a set in the global order and chooses its prefix."""

    def __init__(self, levels: np.ndarray, load: float, percent: int):
        self.levels, self.load, self.percent = levels, load, percent

    def order(self, hashes: np.ndarray) -> tuple[np.ndarray, int, int, np.ndarray]:
        """Shingles rare first; the prefix length, the matches it asks for, and the prefix's levels."""
        levels = self.levels[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        by = np.argsort(levels, kind="stable")  # hashes come in order, so ties go by hash
        hashes, levels, n = hashes[by], levels[by], len(hashes)
        need = -(-self.percent * n // 100)
        most = min(MAX_MATCH, need)
        # Readings of the counters less what other shingles leave there by chance.
        readings = np.maximum(np.exp2((levels[: n - need + most].astype(float) - 1) / 8) - 1 - self.load - 2 * np.sqrt(self.load), 0)
        reads = np.cumsum(readings)[n - need :]
        matches = np.arange(1, most + 1)
        k = int(np.argmin(reads + VERIFY_COST * reads / matches + matches * 1e-6)) + 1
        return hashes, n - need + k, k, levels[: n - need + k]


def signatures(docs: DataFrame, shared, id_col: str, text_col: str, size: int) -> DataFrame:
    """``doc_id, node, n, k, weight, cold, hot`` of every document.

    ``node`` stands for the word sequence (null without words), ``k`` is the number
    of prefix shingles that a partner must share, ``weight`` the prefix's mean
    level. Prefix shingles are ``hot`` where the counters don't rule out more than
    ``COLD`` holders.
    """
    limit = int(1 + 8 * math.log2(COLD))

    def lists(parts: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        shingler, orderer, none = Shingler(size), Orderer(*shared.value), np.empty(0, np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows, cold, hot = [], [], []
                for text in _bytes(part.column(1)):
                    words = split(text)
                    hashes = shingler.hashes(words)
                    if not len(hashes):
                        rows.append((None, 0, 0, 0))
                        cold.append(none)
                        hot.append(none)
                        continue
                    ordered, length, k, levels = orderer.order(hashes)
                    rows.append((sequence_hash(words), len(hashes), k, int(levels.mean() * 256)))
                    cold.append(ordered[:length][levels <= limit])
                    hot.append(ordered[:length][levels > limit])
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, lists(cold), lists(hot)], names=["doc_id", "node", "n", "k", "weight", "cold", "hot"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(sign, f"doc_id {kind}, node long, n long, k int, weight int, cold array<long>, hot array<long>")


def token_groups(speakers: DataFrame) -> DataFrame:
    """``token, node, hub, m``: the m holders of each prefix shingle that at least two hold; ``hub`` is that of the most common prefix.

    A cold shingle's holders are few by the counters and meet in a window; a hot
    one's top is combined before the shuffle and joined back, which adaptive
    execution can split.
    """
    top = F.max(F.struct("weight", "node"))
    same = Window.partitionBy("token")
    cold = speakers.select("node", "weight", F.explode("cold").alias("token")).withColumns({"m": F.count(F.lit(1)).over(same), "top": top.over(same)})
    hot = speakers.select("node", "weight", F.explode("hot").alias("token"))
    hot = hot.join(hot.groupBy("token").agg(F.count(F.lit(1)).alias("m"), top.alias("top")), "token")
    return cold.select("token", "node", "top", "m").union(hot.select("token", "node", "top", "m")).filter("m > 1").select("token", "node", F.col("top.node").alias("hub"), "m")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each pair of sets has in common; over slices of the elements, so memory is bounded."""
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[at]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[column >= 0]
    column = column[column >= 0]
    by = np.argsort(column, kind="stable")
    rows, column = rows[by], column[by]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        slab = np.zeros((len(sets), COLUMNS), np.float32)
        slab[rows[part], column[part] - low] = 1
        out += slab @ slab.T
    return out


def common(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    return int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))


def verified_links(prefixes: list[np.ndarray], matches: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sorted sets.

    Candidates share enough prefix shingles; they are counted exactly, those that
    share most of them first, unless earlier links join them already.
    """
    sizes = np.array([len(s) for s in sets])
    shares = shared_counts(prefixes)
    pairs = np.triu(shares >= np.minimum(matches[:, None], matches[None, :]), 1)
    pairs &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    a, b = np.nonzero(pairs)
    lengths = np.array([len(p) for p in prefixes])
    by = np.argsort(-shares[a, b] / np.minimum(lengths[a], lengths[b]), kind="stable")
    forest = Forest(len(sets))
    for i, j in zip(a[by].tolist(), b[by].tolist(), strict=True):
        if forest.find(i) != forest.find(j):
            both = common(sets[i], sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                forest.join(i, j)
    return forest.stars()


def starred(edges: DataFrame) -> DataFrame:
    """``part, low, high, node``: pairs (node, hub) with each hub's nodes in lots of at most about ``GROUP``, the hub in every lot."""
    lots = edges.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("lots"))
    dealt = edges.join(lots, "hub").select(F.col("hub").alias("part"), F.pmod(F.xxhash64("node"), F.col("lots")).cast("int").alias("low"), "node")
    hubs = lots.select(F.col("hub").alias("part"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("low"), F.col("hub").alias("node"))
    return dealt.union(hubs).select("part", "low", F.lit(-1).alias("high"), "node")


def blocked(groups: DataFrame) -> DataFrame:
    """``part, low, high, node``: members of ``groups`` (hub, node, component) in blocks of which all pairs meet, but for blocks of one component.

    A component of more than ``GROUP`` members has blocks of its own.
    """
    sizes = groups.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("size"))
    large = F.col("size") > GROUP
    small = sizes.filter(~large).groupBy("hub").agg(F.sum("size").alias("rest"))
    sizes = sizes.join(small, "hub", "left").select("hub", F.col("component"), large.alias("alone"), F.ceil(F.when(large, F.col("size")).otherwise(F.col("rest")) / GROUP).alias("parts"))
    own = F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = groups.join(sizes, ["hub", "component"]).select("hub", "node", F.when(F.col("alone"), F.col("component")).alias("only"), F.when(F.col("alone"), own).otherwise(F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block"))
    placed = materialise(placed, "jaccard-blocks")
    blocks = placed.select("hub", "block", "only").distinct()
    other = blocks.select("hub", F.col("block").alias("other"), F.col("only").alias("their"))
    met = blocks.join(other, "hub").filter((F.col("block") <= F.col("other")) & ~F.coalesce(F.col("only") == F.col("their"), F.lit(False)))
    sides = met.select("hub", F.col("block").alias("low"), F.col("other").alias("high"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    return sides.join(placed.drop("only"), ["hub", "block"]).select(F.col("hub").alias("part"), "low", "high", "node")


def candidate_pairs(small: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``hub, node``: pairs of different components in groups (token, node, component) of at most ``SMALL``, which share shingles enough."""
    one, two = (small.select("token", F.col("node").alias(x), F.col("component").alias(f"{x}_component")) for x in "ab")
    counted = one.join(two, "token").filter("a < b AND a_component <> b_component").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    for x in "ab":
        counted = counted.join(nodes.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("k").alias(f"{x}_k")), x)
    enough = (F.col("shared") >= F.least("a_k", "b_k")) & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    return counted.filter(enough).select(F.col("a").alias("hub"), F.col("b").alias("node"))


def with_node(docs: DataFrame, id_col: str, text_col: str, once: bool = False) -> DataFrame:
    """Rows with ``t_node``, null without words; ``once``: only rows with words, and a task returns rows of equal id and words once."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        seen: set = set()
        for batch in batches:
            nodes, kept = [], []
            for row, text in zip(batch.column(id_col).to_pylist(), _bytes(batch.column(text_col)), strict=True):
                words = split(text)
                nodes.append(sequence_hash(words) if words else None)
                if once:
                    kept.append(bool(words) and (row, nodes[-1]) not in seen)
                    seen.add((row, nodes[-1]))
            named = pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=[*batch.schema.names, "t_node"])
            yield named.filter(pa.array(kept, pa.bool_())) if once else named

    return docs.mapInArrow(name, T.StructType([*docs.schema.fields, T.StructField("t_node", T.LongType())]))


class Comparison:
    """Fetches the texts of nodes that meet, each by its row's id and word sequence, and verifies links among them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, shared, id_col: str, text_col: str, size: int):
        self.docs = docs.select(F.col(id_col).alias("t_id"), F.col(text_col).alias("text"))
        self.nodes, self.shared, self.size = nodes, shared, size

    def links(self, meetings: DataFrame) -> DataFrame:
        """``a, b``: verified links among the nodes that meet (part, low, high, node)."""
        shared, size = self.shared, self.size

        def compare(group: pa.Table) -> pa.Table:
            shingler, orderer = Shingler(size), Orderer(*shared.value)
            sets: dict[int, np.ndarray] = {}
            for node, text in zip(group.column("node").to_pylist(), _bytes(group.column("text")), strict=True):
                if node not in sets:
                    sets[node] = shingler.hashes(split(text))
            nodes, prefixes, matches = list(sets), [], []
            for hashes in sets.values():
                ordered, length, k, _ = orderer.order(hashes)
                prefixes.append(ordered[:length])
                matches.append(k)
            found = verified_links(prefixes, np.array(matches), list(sets.values()), orderer.percent)
            return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.int64()), "b": pa.array([nodes[j] for _, j in found], pa.int64())})

        wanted = materialise(meetings.join(self.nodes.select("node", F.col("doc_id").alias("w_id")), "node"), "jaccard-wanted")
        n = wanted.count()
        near = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
        members = with_node(self.docs, "t_id", "text", once=True).join(near, (F.col("t_node") == F.col("node")) & F.col("t_id").eqNullSafe(F.col("w_id"))).select("part", "low", "high", "node", "text")
        return materialise(members.groupBy("part", "low", "high").applyInArrow(compare, "a long, b long"), "jaccard-links")


def bounded(table: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it is small enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``doc_id, n, node, rep, component_id, keeper`` of every row: of its class the smallest id, of its component the smallest id, and whether the class is the component's first."""
    shared = docs.sparkSession.sparkContext.broadcast((*count_sketch(docs, text_col, words), percent))
    signed = materialise(signatures(docs, shared, id_col, text_col, words).withColumn("row", F.monotonically_increasing_id()), "jaccard-signatures")
    # The row of the smallest id speaks for its class.
    first = signed.filter("n > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"))
    first = materialise(first.select(F.col("node").alias("c_node"), F.col("first.doc_id").alias("rep"), F.col("first.row").alias("c_row")), "jaccard-classes")
    near = bounded(first)
    speakers = signed.join(near, (F.col("node") == F.col("c_node")) & (F.col("row") == F.col("c_row")))
    nodes = materialise(speakers.select("node", "doc_id", "n", "k", (F.size("cold") + F.size("hot")).alias("prefix")), "jaccard-nodes")
    groups = materialise(token_groups(speakers), "jaccard-groups")
    comparison = Comparison(docs, nodes, shared, id_col, text_col, words)

    # First each node meets the hub with which it shares most; that joins nearly all near copies.
    stars = groups.filter("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(F.max(F.struct("n", "hub")).alias("most"))
    likely = stars.join(nodes.select("node", "prefix"), "node").filter(F.col("most.n") * LIKELY >= F.col("prefix")).select(F.col("most.hub").alias("hub"), "node")
    links = comparison.links(starred(likely))

    # Then all pairs that are still apart.
    named = components(links)
    placed = groups.join(named, "node", "left").select("token", "node", "hub", "m", F.coalesce("component", "node").alias("component"))
    parted = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("last")).filter("least < last").select("token")
    apart = materialise(placed.join(parted, "token"), "jaccard-apart")
    pairs = candidate_pairs(apart.filter(F.col("m") <= SMALL), nodes, percent)
    large = blocked(apart.filter(F.col("m") > SMALL).select("hub", "node", "component").distinct())
    links = links.union(comparison.links(starred(pairs).union(large)))

    found = components(links)
    moved = found.join(nodes.select("node", F.col("doc_id").alias("rep")), "node")
    least = moved.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "node")).alias("least"))
    moved = moved.join(least, "component").select(F.col("node").alias("m_node"), F.col("least.rep").alias("component_id"), (F.col("node") == F.col("least.node")).alias("keeper"))
    moved = bounded(materialise(moved, "jaccard-moved"))
    named = signed.select("doc_id", "node", "n").join(near, F.col("node") == F.col("c_node"), "left").join(moved, F.col("node") == F.col("m_node"), "left")
    return named.select("doc_id", "n", "node", "rep", F.coalesce("component_id", "rep", "doc_id").alias("component_id"), F.coalesce("keeper", F.lit(True)).alias("keeper"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: documents linked by a Jaccard similarity of at least ``percent`` / 100."""
    return grouped(docs, id_col, text_col, words, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: one of those of its smallest id (the first word sequence by hash if that id has several).

    Rows without words are in no component and stay. Rows are told apart by id and
    words, so of an id's unrelated texts each counts for itself.
    """
    names = docs.columns
    docs = docs.toDF(*[f"d{i}" for i in range(len(names))])  # so that no column of the input meets one of the operator
    id_col, text_col = f"d{names.index(id_col)}", f"d{names.index(text_col)}"
    rows = grouped(docs, id_col, text_col, words, percent).filter("n > 0")
    first = F.col("doc_id").eqNullSafe(F.col("rep")) & F.col("keeper")
    rows = rows.groupBy("doc_id", "node").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("times"))
    gone = bounded(materialise(rows.filter(~F.col("first") | (F.col("times") > 1)).select(F.col("doc_id").alias("g_id"), F.col("node").alias("g_node"), "first"), "jaccard-gone"))
    this = F.col(id_col).eqNullSafe(F.col("g_id")) & (F.col("t_node") == F.col("g_node"))
    named = with_node(docs, id_col, text_col)
    kept = named.join(gone, this, "left_anti").drop("t_node")
    repeated = gone.filter("first")
    if repeated.isEmpty():
        return kept.toDF(*names)
    once = named.join(repeated, this).drop("g_id", "g_node", "first").groupBy("t_node", id_col).agg(*[F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")])
    return kept.unionByName(once.select("row.*")).toDF(*names)
