"""Compression of vectors to part codes, with metric trees over the parts.

A vector's components become integers floor(256 * x) and are cut into equal
consecutive parts; each part position has a codebook that is refined by rounds
of k-means and then names every part by its nearest entry.

The rounds don't look at single parts. Vectors are dealt into chunks, and in
each chunk every part position gets a metric tree by the anchors hierarchy:
about sqrt(n) anchors take the parts nearest to them (a new anchor is the part
farthest from its own), anchors' balls are merged from the middle upwards, the
pair of the smallest common ball first, and each anchor's own parts are split
by the same rule further down. A ball keeps its centre, radius, count and sum.
To assign parts, a tree is descended with a list of candidate entries: a child
inherits its parent's list, and an entry leaves the list if the whole ball lies
on the far side of the plane between it and the ball's nearest entry. A ball
with one candidate left is wholly owned, so its sum and count are added at
once; at leaves the parts themselves are compared. Trees are written to the
shared folder once and serve every round; a round shuffles sums of at most
``entries`` rows a part position.

All arithmetic that decides is in integers, and bounds are widened by more than
their rounding, so results equal those of plain k-means (ties to the lower
index), whatever the chunks are.

What happens in special cases:

* null or empty vectors and vectors with null or non-finite components are
  dropped;
* all vectors have one dimension, that of the smallest kept id, and it is a
  multiple of ``parts``; vectors of another dimension are dropped, and if that
  dimension is no multiple of ``parts`` a ValueError says so;
* integer components beyond plus or minus 2^30 / sqrt(dimension) (2^27 at 64
  dimensions) are taken as that bound, since beyond it a vector's error need
  not fit a long;
* rows that share an id are separate vectors, the codebook's start takes rows by
  (id, components); null ids come after all others;
* with fewer vectors than entries the codebook has as many entries as vectors;
* entries that own no part stay as they are; of equal entries the lowest owns;
* null labels are one label; a label's error beyond a long is the largest long;
* other columns of the input are not carried; an empty table gives an empty
  result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.memory import rows_at_a_time
from presslens.shared import materialise

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors in a chunk at most, so trees of a task have a bounded size.
CHUNK = 8192
#: Chunks, of about 7 MB each, that a worker holds at a time.
CHUNKS_AT_ONCE = 2
#: Parts in a leaf at most, unless they are equal.
LEAF = 24
#: Labels whose sums are broadcast at most; more are joined by a shuffle.
BROADCAST_LABELS = 100_000
#: Added to radii, relative and absolute: more than the rounding of a square root.
SLACK = 1e-9


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` (integer components) of the vectors that count."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
    # dim * (2 * most)^2 stays below 2^63; 256 * x is exact in double precision.
    most = F.floor(F.lit(2.0**30) / F.sqrt(F.size("x"))).cast("double")
    whole = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * 256.0, most), -most)).cast("long"))
    return rows.select("vec_id", "label", whole.alias("v"))


class Tree:
    """Balls over the rows of ``points`` (distinct, with counts), by the anchors hierarchy.

    ``order`` lists the points so that ball i holds order[lo[i]:hi[i]]; children
    are ``left`` and ``right`` (-1 at leaves). The root is ball 0.
    """

    def __init__(self, points: np.ndarray, counts: np.ndarray):
        self.points, self.counts = points, counts
        self.order = np.arange(len(points))
        self.rows: list[tuple[int, int, int, int]] = [(0, 0, -1, -1)]
        self._build(0, len(points), 0)
        table = np.array(self.rows, np.int64).reshape(-1, 4)
        self.lo, self.hi, self.left, self.right = table.T
        self._balls()

    def _balls(self) -> None:
        """Sum, count, centre and radius of every ball."""
        points, counts = self.points[self.order], self.counts[self.order]
        before = np.vstack([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * counts[:, None], axis=0)])
        held = np.concatenate([[0], np.cumsum(counts)])
        self.sums, self.count = before[self.hi] - before[self.lo], held[self.hi] - held[self.lo]
        self.centre = np.floor_divide(2 * self.sums + self.count[:, None], 2 * self.count[:, None])
        self.radius = np.empty(len(self.lo))
        for i, (lo, hi) in enumerate(zip(self.lo.tolist(), self.hi.tolist(), strict=True)):
            away = points[lo:hi] - self.centre[i]
            self.radius[i] = math.sqrt(float((away * away).sum(axis=1).max())) * (1 + SLACK) + SLACK

    def _build(self, lo: int, hi: int, at: int) -> None:
        """Row ``at`` becomes a ball over order[lo:hi], with all that is below it."""
        self.rows[at] = (lo, hi, -1, -1)
        if hi - lo <= LEAF:
            return
        own = self.order[lo:hi].copy()
        owner, n = _anchors(self.points[own], math.isqrt(hi - lo - 1) + 1)
        self._place(at, lo, own, owner, np.bincount(owner, minlength=n), _merge(self.points[own], owner, n))

    def _place(self, at: int, lo: int, own: np.ndarray, owner: np.ndarray, sizes: np.ndarray, merged: list[tuple[int, int]]) -> None:
        """Lay the anchors' points out in the order of the merged tree and build what is below each anchor."""
        n = len(sizes)
        groups = np.split(own[np.argsort(owner, kind="stable")], np.cumsum(sizes)[:-1])
        # Depth first, so that every ball is a stretch of the order; a stack, since merged trees can be deep.
        stack = [(n + len(merged) - 1, at, lo)]
        width = [*sizes.tolist()]
        for a, b in merged:
            width.append(width[a] + width[b])
        while stack:
            node, row, start = stack.pop()
            if node < n:
                self.order[start : start + width[node]] = groups[node]
                self._build(start, start + width[node], row)
                continue
            a, b = merged[node - n]
            left, right = len(self.rows), len(self.rows) + 1
            self.rows.extend([(0, 0, -1, -1)] * 2)
            self.rows[row] = (start, start + width[node], left, right)
            stack.append((a, left, start))
            stack.append((b, right, start + width[a]))


def _anchors(points: np.ndarray, wanted: int) -> tuple[np.ndarray, int]:
    """The anchor of every point, and the number of anchors.

    A new anchor is the point farthest from its own anchor. It can only take
    points from an anchor that are farther from it than half the distance
    between the two anchors, so only those are looked at.
    """
    x = points.astype(np.float64)
    anchors = [x[0]]
    owner = np.zeros(len(x), np.int64)
    away = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(anchors) < wanted:
        far = int(away.argmax())
        if away[far] == 0:
            break
        new = x[far]
        half = np.sqrt(((np.array(anchors) - new) ** 2).sum(axis=1)) / 2
        asked = np.flatnonzero(away > half[owner])
        d = np.sqrt(((x[asked] - new) ** 2).sum(axis=1))
        taken = d < away[asked]
        owner[asked[taken]], away[asked[taken]] = len(anchors), d[taken]
        anchors.append(new)
    held = np.unique(owner)
    return np.searchsorted(held, owner), len(held)


def _merge(points: np.ndarray, owner: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs of balls merged from the anchors upwards, the smallest common ball first; pair k becomes ball n + k."""
    x = points.astype(np.float64)
    count = np.bincount(owner, minlength=n).astype(np.float64)
    centre = np.column_stack([np.bincount(owner, x[:, k], n) for k in range(x.shape[1])]) / count[:, None]
    radius = np.zeros(n)
    np.maximum.at(radius, owner, np.sqrt(((x - centre[owner]) ** 2).sum(axis=1)))

    def common(i: int) -> np.ndarray:
        return (np.sqrt(((centre - centre[i]) ** 2).sum(axis=1)) + radius + radius[i]) / 2

    size = np.vstack([common(i) for i in range(n)])
    size = np.maximum(size, np.maximum(radius[:, None], radius[None, :]))
    np.fill_diagonal(size, np.inf)
    name, out = list(range(n)), []
    for k in range(n - 1):
        a, b = divmod(int(size.argmin()), n)
        out.append((name[a], name[b]))
        name[a], radius[a] = n + k, size[a, b]
        centre[a] = (centre[a] * count[a] + centre[b] * count[b]) / (count[a] + count[b])
        count[a] += count[b]
        size[b], size[:, b] = np.inf, np.inf
        row = np.maximum(common(a), np.maximum(radius, radius[a]))
        row[~np.isfinite(size[a])] = np.inf
        row[a] = np.inf
        size[a], size[:, a] = row, row
    return out


FIELDS = "points order counts member lo hi left right count sums centre".split()


def descend(tree: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entry of every point in tree order, and sums and counts that the entries own.

    ``book`` (entries x components) may hold equal entries: only the first of
    them is ever a candidate.
    """
    dim = book.shape[1]
    points, counts = tree["points"].reshape(-1, dim)[tree["order"]], tree["counts"][tree["order"]]
    centre, sums = tree["centre"].reshape(-1, dim), tree["sums"].reshape(-1, dim)
    first = np.sort(np.unique(book, axis=0, return_index=True)[1])
    entries = book[first]
    apart = np.sqrt(((entries[:, None, :] - entries[None, :, :]).astype(np.float64) ** 2).sum(axis=2))
    owner = np.empty(len(points), np.int64)
    total, held = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    balls, lists = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
    while len(balls):
        away = ((centre[balls][:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        open_away = np.where(lists, away, np.iinfo(np.int64).max)
        best = open_away.argmin(axis=1)
        least = open_away[np.arange(len(balls)), best]
        # d(x, j)^2 - d(x, best)^2 over the ball is at least the difference at its centre less 2 r |j - best|.
        reach = 2 * tree["radius"][balls][:, None] * apart[best] * (1 + SLACK) + SLACK
        lists = lists & ((away - least[:, None]).astype(np.float64) * (1 - SLACK) <= reach)
        lists[np.arange(len(balls)), best] = True
        alone = lists.sum(axis=1) == 1
        for ball, entry in zip(balls[alone].tolist(), best[alone].tolist(), strict=True):
            owner[tree["lo"][ball] : tree["hi"][ball]] = entry
        np.add.at(total, best[alone], sums[balls[alone]])
        np.add.at(held, best[alone], tree["count"][balls[alone]])
        balls, lists = balls[~alone], lists[~alone]
        leaf = tree["left"][balls] < 0
        _at_leaves(tree, points, counts, entries, balls[leaf], lists[leaf], owner, total, held)
        balls, lists = balls[~leaf], lists[~leaf]
        balls, lists = np.concatenate([tree["left"][balls], tree["right"][balls]]), np.vstack([lists, lists])
    full, n = np.zeros_like(book), np.zeros(len(book), np.int64)
    full[first], n[first] = total, held
    return first[owner], full, n


def _at_leaves(tree: dict, points: np.ndarray, counts: np.ndarray, entries: np.ndarray, balls: np.ndarray, lists: np.ndarray, owner: np.ndarray, total: np.ndarray, held: np.ndarray) -> None:
    """Compare the parts of leaves with the candidates their balls have left; ties go to the lower index."""
    if not len(balls):
        return
    sizes = tree["hi"][balls] - tree["lo"][balls]
    of = np.repeat(np.arange(len(balls)), sizes)
    at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(tree["lo"][balls], sizes)
    row, candidate = np.nonzero(lists[of])
    away = points[at][row] - entries[candidate]
    away = (away * away).sum(axis=1)
    order = np.lexsort((candidate, away, row))
    head = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    owner[at] = candidate[head]
    np.add.at(total, candidate[head], points[at] * counts[at][:, None])
    np.add.at(held, candidate[head], counts[at])


def _tree_columns(parts: np.ndarray) -> dict:
    """One part position's tree over the rows of a chunk, as columns."""
    points, member, counts = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    tree = Tree(points, counts)
    columns = {f: np.ascontiguousarray(getattr(tree, f), np.int64).reshape(-1) for f in FIELDS if f != "member"}
    return columns | {"member": member.reshape(-1).astype(np.int64), "radius": tree.radius}


def _long_lists(columns: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in columns])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(columns), kind))


def plant(rows: DataFrame, dim: int, parts: int) -> DataFrame:
    """One row a chunk: its ids and labels, and a tree for each part position."""
    id_type, label_type = rows.schema["vec_id"].dataType, rows.schema["label"].dataType
    tree = T.StructType([*[T.StructField(f, T.ArrayType(T.LongType())) for f in FIELDS], T.StructField("radius", T.ArrayType(T.DoubleType()))])
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), T.StructField("labels", T.ArrayType(label_type)), T.StructField("trees", T.ArrayType(tree))])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            flat = pa.concat_arrays([c.flatten() for c in batch.column("v").chunks]).to_numpy(zero_copy_only=False)
            v = flat.reshape(len(batch), parts, dim // parts)
            trees = [_tree_columns(v[:, p]) for p in range(parts)]
            struct = pa.StructArray.from_arrays([*[_long_lists([t[f] for t in trees], pa.int64()) for f in FIELDS], _long_lists([t["radius"] for t in trees], pa.float64())], names=[*FIELDS, "radius"])
            one = pa.array([0, len(batch)], pa.int32())
            ids, labels = (pa.ListArray.from_arrays(one, batch.column(c).combine_chunks()) for c in ("vec_id", "label"))
            yield pa.RecordBatch.from_arrays([ids, labels, pa.ListArray.from_arrays(pa.array([0, parts], pa.int32()), struct)], names=["ids", "labels", "trees"])

    return rows.mapInArrow(grow, schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of at most CHUNK rows."""
    held, n = [], 0
    for batch in batches:
        while len(batch):
            part = batch.slice(0, CHUNK - n)
            held.append(part)
            n += len(part)
            batch = batch.slice(len(part))
            if n == CHUNK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _trees(row: pa.StructArray) -> Iterator[dict[str, np.ndarray]]:
    for k in range(len(row)):
        yield {f: row.field(f)[k].values.to_numpy(zero_copy_only=False) for f in [*FIELDS, "radius"]}


def refine(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts it owns."""
    shared = chunks.sparkSession.sparkContext.broadcast(books)
    width = books.shape[2]

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*shared.value.shape[:2], width + 1), np.int64)
        for batch in batches:
            for k in range(len(batch)):
                for p, tree in enumerate(_trees(batch.column("trees")[k].values)):
                    _, sums, n = descend(tree, shared.value[p])
                    total[p, :, :width] += sums
                    total[p, :, width] += n
        part, entry = np.nonzero(total[:, :, width])
        some = total[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), *[pa.array(some[:, c]) for c in range(width + 1)]], names=["part", "entry", *[f"s{c}" for c in range(width + 1)]])

    sums = ", ".join(f"s{c} long" for c in range(width + 1))
    found = chunks.select("trees").mapInArrow(owned, f"part long, entry long, {sums}")
    out = books.copy()
    for r in found.groupBy("part", "entry").agg(*[F.sum(f"s{c}").alias(f"s{c}") for c in range(width + 1)]).collect():  # parts * entries rows at most
        out[r["part"], r["entry"]] = [r[f"s{c}"] // r[f"s{width}"] for c in range(width)]
    return out


def assign(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every vector."""
    shared = chunks.sparkSession.sparkContext.broadcast(books)
    id_type, label_type = chunks.schema["ids"].dataType.elementType, chunks.schema["labels"].dataType.elementType
    schema = T.StructType([T.StructField("vec_id", id_type), T.StructField("label", label_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids = batch.column("ids")[k].values
                codes, error = np.empty((len(ids), len(shared.value)), np.uint8), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(_trees(batch.column("trees")[k].values)):
                    entry = np.empty(len(tree["order"]), np.int64)
                    entry[tree["order"]] = descend(tree, shared.value[p])[0]
                    away = tree["points"].reshape(len(entry), -1) - shared.value[p][entry]
                    codes[:, p], error = entry[tree["member"]], error + (away * away).sum(axis=1)[tree["member"]]
                yield pa.RecordBatch.from_arrays([ids, batch.column("labels")[k].values, pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return chunks.mapInArrow(name, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error`` of every kept vector, and the codebooks (parts x entries x components).

    At most 256 entries: a code has two hex digits a part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = quantised(vectors, id_col, vector_col, label_col)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not start:
        empty = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return empty.limit(0), np.zeros((parts, 0, 0), np.int64)
    dim = len(start[0]["v"])
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    rows = rows.filter(F.size("v") == dim)
    if any(len(r["v"]) != dim for r in start):
        start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, dim // parts).transpose(1, 0, 2).copy()
    chunks = materialise(plant(rows, dim, parts), "ball-trees", compression="zstd")
    with rows_at_a_time(chunks.sparkSession, CHUNKS_AT_ONCE):
        for _ in range(rounds):
            books = refine(chunks, books)
        coded = materialise(assign(chunks, books), "ball-codes")
    return coded.join(_label_errors(coded), F.col("label").eqNullSafe(F.col("e_label"))).drop("e_label"), books


def _label_errors(coded: DataFrame) -> DataFrame:
    """Errors by label: broadcast while there are few labels."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy(F.col("label").alias("e_label")).agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most).cast("long").alias("label_error"))
    sums = materialise(sums, "ball-labels")
    return F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
