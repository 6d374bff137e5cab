"""Embedding near-dedup with randomised-rotation binary codes.

Vectors are normalised and turned by one random orthogonal matrix; a code is the
signs of the turned vector, and its correction factor rho is the inner product of
the vector with its code. For vectors x, y of length one, <code(x), y> / rho(x)
estimates <x, y> without bias over rotations, and it errs by at most
sqrt(1 - <x, y>^2) * sqrt(1 - rho^2) / rho. Over all pairs with a cosine of at
least t the estimate is therefore at least t - sqrt(1 - t^2) * sqrt(1 - rho^2) / rho:
pairs below this bound are settled by their codes, the others are recomputed in
double precision. The bound holds for certain, so no link is lost.

Only equal labels are compared. Vectors of a label that are equal in all bits are
one class. Classes are dealt into blocks of similar vectors (by an anchor each),
and a pair of blocks whose centres and radii put every pair beyond the threshold
angle is never joined.

What happens in special cases:

* null labels, null vectors, empty vectors, zero vectors and vectors with null
  or non-finite components link with nothing;
* within a label only vectors of equal dimension are compared;
* equal rows (also under different ids) are linked copies: each counts the
  others as links;
* rows that share an id count as separate vectors, their component is that of
  the id; null ids count as links of others and are returned, kept, with a
  null component;
* other columns of the input are not carried; an empty table gives an empty
  result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.graph import components, spanning_forest
from presslens.shared import materialise

THRESHOLD = 0.93
SEED = 20240101
#: Classes in a block.
BLOCK = 1024
#: Anchors around which blocks are formed.
ANCHORS = 16


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction factors of unit row vectors."""
    turned = unit @ turn.T
    signs = turned >= 0
    return np.packbits(signs, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def signs(codes: np.ndarray, dim: int) -> np.ndarray:
    return (np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(dim))


def estimates(codes: np.ndarray, rho: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the inner products of coded vectors (rows) with turned ones (columns)."""
    return (signs(codes, turned.shape[1]) @ turned.astype(np.float32).T) / rho[:, None].astype(np.float32)


def least_estimate(rho: np.ndarray, threshold: float) -> np.ndarray:
    """What the estimate of a pair at or above the threshold is at least; a little less for rounding in single precision."""
    return threshold - math.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - rho**2)) / rho - 1e-4


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise cosines in double precision."""
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and of y whose cosine reaches the threshold."""
    turn = rotation(x.shape[1])
    ux = x / np.sqrt((x * x).sum(axis=1))[:, None]
    uy = y / np.sqrt((y * y).sum(axis=1))[:, None]
    codes, rho = encode(ux, turn)
    a, b = np.nonzero(estimates(codes, rho, uy @ turn.T) >= least_estimate(rho, threshold)[:, None].astype(np.float32))
    exact = np.zeros(len(a), bool)
    for at in range(0, len(a), 65536):
        part = slice(at, at + 65536)
        exact[part] = cosines(x[a[part]], y[b[part]]) >= threshold
    return a[exact], b[exact]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` of rows that can link."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    return rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(whole, F.lit(False)))


def in_blocks(per_class: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Classes with their block, and the pairs of blocks of one label and dimension that may hold a link.

    A few classes of smallest hash are anchors; a class belongs to the block
    of its nearest anchor (dealt on by hash where that is large). If the angles
    of two blocks to some anchor differ by more than the threshold's angle, the
    triangle inequality rules all their pairs out.
    """
    limit = math.acos(threshold) + 1e-9
    anchors = [np.array(r["v"], np.float64) for r in per_class.orderBy(F.abs("class"), "class").limit(ANCHORS).select("v").collect()]
    by_dim: dict[int, np.ndarray] = {}
    for v in anchors:
        unit = v / math.sqrt((v * v).sum())
        by_dim[len(v)] = np.vstack([by_dim[len(v)], unit]) if len(v) in by_dim else unit[None, :]

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = np.array(v, np.float64)
                near = by_dim.get(len(x))
                out.append([0.0] if near is None else np.arccos(np.clip(near @ x / math.sqrt((x * x).sum()), -1, 1)).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=[*batch.schema.names, "angles"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in per_class.schema.fields)
    near = F.array_position("angles", F.array_min("angles"))
    placed = materialise(per_class.mapInArrow(angles, fields + ", angles array<double>").withColumn("anchor", near), "vector-angles")
    cells = placed.groupBy("label", "dim", "anchor").agg(F.count(F.lit(1)).alias("m")).withColumn("parts", F.ceil(F.col("m") / BLOCK)).drop("m")
    placed = placed.join(cells, ["label", "dim", "anchor"]).withColumn("block", F.xxhash64("label", "dim", "anchor", F.pmod(F.col("class"), F.col("parts"))))
    spans = [F.struct(F.min(F.get("angles", F.lit(k))).alias("lo"), F.max(F.get("angles", F.lit(k))).alias("hi")) for k in range(max([1, *map(len, by_dim.values())]))]
    stats = materialise(placed.groupBy("label", "dim", "block").agg(F.array(*spans).alias("spans")), "vector-blocks")
    other = stats.select("label", "dim", F.col("block").alias("other"), F.col("spans").alias("y"))
    pairs = stats.select("label", "dim", "block", F.col("spans").alias("x")).join(other, ["label", "dim"]).filter("block <= other")
    apart = F.exists(F.arrays_zip("x", "y"), lambda z: F.coalesce((z["x"]["lo"] - z["y"]["hi"] > limit) | (z["y"]["lo"] - z["x"]["hi"] > limit), F.lit(False)))
    return placed.select("block", "class", "copies", "v"), pairs.filter(~apart).select("block", "other")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = usable(vectors, id_col, vector_col, label_col)
    per_class = rows.groupBy("label", F.size("v").alias("dim"), F.xxhash64("label", "v").alias("class")).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    per_class = materialise(per_class, "vector-classes")
    members, pairs = in_blocks(per_class.drop("rep"), threshold)
    sides = pairs.select("block", "other", F.explode(F.array_distinct(F.array("block", "other"))).alias("from"))
    dealt = sides.join(members.withColumnRenamed("block", "from"), "from").select("block", "other", F.col("from"), "class", "copies", "v")

    def compare(group: pa.Table) -> pa.Table:
        block, other = group.column("block")[0].as_py(), group.column("other")[0].as_py()
        first = group.column("from").to_numpy() == block
        names, copies, x = group.column("class").to_numpy(), group.column("copies").to_numpy(), _matrix(group.column("v"))
        left, right = np.flatnonzero(first), np.flatnonzero(~first) if block != other else np.flatnonzero(first)
        a, b = linked(x[left], x[right], threshold)
        a, b = left[a], right[b]
        if block == other:
            a, b = a[a < b], b[a < b]
        sums = np.bincount(a, copies[b], len(names)) + np.bincount(b, copies[a], len(names))
        some = np.flatnonzero(sums)
        forest = spanning_forest(zip(a.tolist(), b.tolist(), strict=True), len(names))
        ends = np.array(forest, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "a": pa.array(np.concatenate([names[some], names[ends[:, 0]]])),
                "b": pa.array([*[None] * len(some), *names[ends[:, 1]].tolist()], pa.int64()),
                "links": pa.array(np.concatenate([sums[some].astype(np.int64), np.zeros(len(ends), np.int64)])),
            }
        )

    found = materialise(dealt.groupBy("block", "other").applyInArrow(compare, "a long, b long, links long"), "vector-links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    named = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "class")
    least = named.join(per_class.select("class", "rep"), "class").groupBy("component").agg(F.min("rep").alias("component_id"))
    per = (
        per_class.select("class", "rep", "copies")
        .join(counts, "class", "left")
        .join(named.join(least, "component").select("class", "component_id"), "class", "left")
        .select("class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    )
    keyed = vectors.select(F.col(id_col).alias("vec_id"), F.xxhash64(F.col(label_col).alias("label"), F.col(vector_col).alias("v")).alias("key"), F.col(label_col).isNull().alias("alone"))
    joined = keyed.join(per, (F.col("key") == F.col("class")) & ~F.col("alone"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
