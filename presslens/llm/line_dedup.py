"""Line deduplication by overlapping windows of consecutive lines.

Built from DataFrame functions only. Every run of three consecutive non-blank
lines is hashed; a window that occurs more than once in the corpus keeps its
first occurrence, in order of (doc_id, position), and the lines that any later
occurrence covers are removed.

What happens in special cases:

* null text stays null, an empty text stays empty;
* blank lines (spaces, tabs, carriage returns, form feeds) are no part of a
  window and are never removed, so they neither make nor break a repeat;
* a text of fewer than three non-blank lines has no window and stays as it is;
* a text whose lines are all covered becomes ``''``;
* rows with the same id and the same text count as one occurrence and are
  treated alike; a null id sorts before all others;
* all columns of the input stay; ``lines_in`` and ``lines_removed`` are added
  and replace input columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
BLANK = r"^[ \t\r\f\x0B]*$"


def _windows(lines: Column, size: int) -> Column:
    """array<struct<at, a, b, p>>: index, two 64-bit hashes and the line positions of each window."""
    solid = F.filter(
        F.transform(lines, lambda line, i: F.struct(i.alias("p"), F.when(~line.rlike(BLANK), line).alias("line"))),
        lambda s: s["line"].isNotNull(),
    )
    hashed = F.transform(
        solid,
        lambda s: F.struct(
            s["p"].alias("p"), F.xxhash64(s["line"]).alias("a"), F.xxhash64(F.lit(size), s["line"]).alias("b")
        ),
    )
    zipped = F.arrays_zip(*[F.slice(hashed, k + 1, F.greatest(F.size(hashed) - (size - 1), F.lit(0))) for k in range(size)])
    each = [str(k) for k in range(size)]
    return F.transform(
        zipped,
        lambda z, i: F.struct(
            i.alias("at"),
            F.xxhash64(*[z[k]["a"] for k in each]).alias("a"),
            F.xxhash64(*[z[k]["b"] for k in each]).alias("b"),
            F.array(*[z[k]["p"] for k in each]).alias("p"),
        ),
    )


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Later occurrences of repeated windows: ``k_id, k_text, at, p``.

    Hot windows cost nothing extra: the first occurrence is a minimum that is
    combined before the shuffle, and the join back is on an equality that
    adaptive execution splits or broadcasts.
    """
    windows = docs.select(
        F.col(id_col).alias("k_id"),
        F.xxhash64(F.col(text_col)).alias("k_text"),
        F.explode(_windows(F.split(F.col(text_col), "\n", -1), size)).alias("w"),
    ).select("k_id", "k_text", "w.*")
    here = F.struct("k_id", "k_text", "at")
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .drop("n")
    )
    return (
        windows.join(first, ["a", "b"])
        .filter(F.struct("k_id", "k_text", "at") > F.col("first"))
        .select("k_id", "k_text", "at", "p")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Remove the lines that later occurrences of repeated windows cover."""
    covered = (
        repeated_windows(docs, id_col, text_col, size)
        .groupBy("k_id", "k_text")
        .agg(F.array_distinct(F.flatten(F.collect_list("p"))).alias("k_gone"))
    )
    columns = [c for c in docs.columns if c not in ("lines_in", "lines_removed")]
    rest = [c for c in columns if c != text_col]
    keyed = docs.select(
        *[F.col(c).alias(f"in_{c}") for c in rest],
        F.xxhash64(F.col(text_col)).alias("d_text"),
        F.split(F.col(text_col), "\n", -1).alias("d_lines"),
    )
    joined = keyed.join(
        covered, F.col(f"in_{id_col}").eqNullSafe(F.col("k_id")) & (F.col("d_text") == F.col("k_text")), "left"
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("d_lines") - 1), F.col("k_gone"))
    text = F.array_join(F.transform(kept, lambda p: F.get(F.col("d_lines"), p)), "\n")
    whole = F.array_join("d_lines", "\n")
    return joined.select(
        *[
            (F.when(F.col("k_gone").isNull(), whole).otherwise(text) if c == text_col else F.col(f"in_{c}")).alias(c)
            for c in columns
        ],
        F.when(F.col("d_lines").isNull(), 0).otherwise(F.size("d_lines")).alias("lines_in"),
        F.coalesce(F.size(F.col("k_gone")), F.lit(0)).alias("lines_removed"),
    )
