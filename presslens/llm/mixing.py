"""Mixing sources to target weights by fractional repetition.

Sizes are words. Sources in code-point order (null last) weigh 1, 2, 3,
repeating; together their targets are all words of the corpus. A target stops
at ``max_repeat`` times its source's size and the excess is shared again by
weight among the others until none is above (water filling). A source's
repetition rate is target / size; each document is emitted floor(rate) times
and once more with probability equal to the fraction, decided by a hash of the
seed and its id, so reruns agree.

What happens in special cases:

* null text has size 0, and a document of size 0 is repeated at its source's
  rate like any other (it adds no words);
* a source without words has target 0 and rate 0;
* null sources form one source, which sorts last;
* rows that share an id share the decision; a null id is decided as ``''``;
* ``size, source_size, target, rate, copies`` (and ``copy`` from :func:`mix`)
  are added and replace input columns of these names;
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.shared import materialise

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
#: A table of sources with at most this many rows is sent to every executor; a larger one is joined by a shuffle.
BROADCAST_SOURCES = 100_000
ADDED = ("size", "source_size", "target", "rate", "copies", "copy")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 32 bits of a hash of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size`` -> with ``target``: one row per source, null last.

    Sources are capped in order of size / weight. With the first k capped, the
    others are level at (total - capped) / (their weight); the first source
    whose cap is not below that level ends the capping. Window functions run
    over the table of sources, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - max_repeat * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    leveled = ranked.withColumn("ratio", max_repeat * F.col("source_size") / F.col("weight")).withColumn("level", level)
    water = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", F.col("source").isNull().alias("n"), "source", "level"))).over(every)["level"]
    return (
        leveled.withColumn("water", water)
        .withColumn("target", F.when(F.col("ratio") >= F.col("water"), F.col("water") * F.col("weight")).otherwise((max_repeat * F.col("source_size")).cast("double")))
        .select("source", "source_size", "target")
    )


def repetition_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add to each document its size, its source's size, target and rate, and its number of copies."""
    size = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.regexp_count(F.col(text_col), F.lit(WORD))).cast("long")
    names = [c for c in docs.columns if c not in ADDED]
    inner = {c: f"d{i}" for i, c in enumerate(names)}  # so that no column of the input meets one of the plan
    sized = docs.select(*[F.col(f"`{c}`").alias(d) for c, d in inner.items()], size.alias("size"))
    source = F.col(inner[source_col])
    per_source = targets(sized.groupBy(source.alias("source")).agg(F.sum("size").alias("source_size")), max_repeat)
    per_source = materialise(per_source, "mix-targets").select(F.col("source").alias("m_source"), F.col("source_size").alias("m_size"), F.col("target").alias("m_target"))
    if per_source.count() <= BROADCAST_SOURCES:
        per_source = F.broadcast(per_source)
    joined = sized.join(per_source, source.eqNullSafe(F.col("m_source")))
    rate = F.when(F.col("m_size") > 0, F.col("m_target") / F.col("m_size")).otherwise(F.lit(0.0))
    planned = joined.select(*inner.values(), "size", F.col("m_size").alias("source_size"), F.col("m_target").alias("target"), rate.alias("rate"))
    extra = (uniform(F.col(inner[id_col]), seed) < F.col("rate") - F.floor("rate")).cast("long")
    planned = planned.withColumn("copies", F.floor("rate") + extra)
    return planned.select(*[F.col(d).alias(c) for c, d in inner.items()], *[c for c in ADDED if c != "copy"])


def mix(docs: DataFrame, **options) -> DataFrame:
    """Emit every document as often as its plan says; ``copy`` counts from 1."""
    planned = repetition_plan(docs, **options)
    return planned.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
