"""Posts that are published once: none of a post's keys may have been published shortly before.

``dropDuplicatesWithinWatermark`` knows one key, but a post is known by its
address or by its title. So a batch is decided as a whole, against the posts of
earlier batches and within itself, and written as one partition that carries the
batch's number: a batch that is run again overwrites its own partition and
changes nothing. The published posts are the memory of later batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.shared import fresh_path, materialise

TTL_MS = 7 * 24 * 3_600_000
POST = "id long, at long, keys array<string>"


def first_posts(posts: DataFrame, published: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """Of posts (id, at in ms, keys), in order of (at, id), those of which no key was published within ``ttl_ms`` before.

    Goes by rounds: a post that is the first undecided one under all its keys is
    published, and what it blocks goes. A round needs minima by key only, so a
    key with many posts costs its posts, not their pairs. Posts without keys are
    always published. Ids are unique.
    """
    keyed = posts.select("id", "at", F.array_distinct(F.filter(F.coalesce("keys", F.array().cast("array<string>")), lambda k: F.length(k) > 0)).alias("keys"))
    by_key = lambda frame: frame.select("id", "at", F.explode("keys").alias("key"))
    seen = published.select(F.explode("keys").alias("s_key"), F.col("at").alias("s_at"))
    blocked = by_key(keyed).join(seen, (F.col("key") == F.col("s_key")) & (F.col("s_at") > F.col("at") - ttl_ms)).select("id").distinct()
    out = [materialise(keyed.filter(F.size("keys") == 0), "posts-bare")]
    open_ = materialise(keyed.filter(F.size("keys") > 0).join(blocked, "id", "left_anti"), "posts-open")
    while not open_.isEmpty():
        rows = by_key(open_)
        first = rows.groupBy("key").agg(F.min(F.struct("at", "id")).alias("first"))
        leads = rows.join(first, "key").groupBy("id").agg(F.min(F.col("first.id") == F.col("id")).alias("leads")).filter("leads").select("id")
        made = materialise(open_.join(leads, "id", "left_semi"), "posts-made")
        out.append(made)
        blocks = made.select(F.explode("keys").alias("m_key"), F.col("at").alias("m_at"))  # one post a key
        gone = rows.join(blocks, (F.col("key") == F.col("m_key")) & (F.col("at") < F.col("m_at") + ttl_ms)).select("id").distinct()
        open_ = materialise(open_.join(gone, "id", "left_anti"), "posts-open")
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


class Publisher:
    """The table of published posts under ``path``; ``batch`` is what ``foreachBatch`` takes."""

    def __init__(self, spark: SparkSession, path: str, ttl_ms: int = TTL_MS):
        self.path, self.ttl_ms = path, ttl_ms
        self._write(spark.createDataFrame([], POST + ", batch long"))

    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.path)

    def posts(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(POST + ", batch long").parquet(self.path)

    def batch(self, posts: DataFrame, number: int) -> None:
        before = self.posts(posts.sparkSession).filter(F.col("batch") < number)
        self._write(first_posts(posts, before, self.ttl_ms).withColumn("batch", F.lit(number).cast("long")))


def replay(posts: DataFrame, batches: int = 3, ttl_ms: int = TTL_MS) -> DataFrame:
    """Publish a table of posts as a stream of ``batches`` stretches of time; every batch runs twice, as after a lost driver."""
    spark = posts.sparkSession
    path = fresh_path(spark, "posts")
    publisher = Publisher(spark, f"{path}/table", ttl_ms)
    span = posts.agg(F.min("at").alias("lo"), F.max("at").alias("hi")).first()
    if span["lo"] is None:
        return publisher.posts(spark)
    part = F.least(F.floor((F.col("at") - span["lo"]) * batches / F.lit(span["hi"] - span["lo"] + 1)), F.lit(batches - 1))

    def twice(frame: DataFrame, number: int) -> None:
        publisher.batch(frame, number)
        publisher.batch(frame, number)

    for k in range(batches):
        posts.filter(part == k).write.mode("append").parquet(f"{path}/arrived")
        arriving = spark.readStream.schema(posts.schema).parquet(f"{path}/arrived")
        arriving.writeStream.foreachBatch(twice).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return publisher.posts(spark)
