"""Event-time windows, for tables and streams alike, and runs over all that has arrived.

Events without a time belong to no window. A stream emits a window once the
watermark (the latest time seen less ``delay``) has passed its end; later rows
of that window are dropped. State is bounded by the delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.shared import fresh_path, table

SHOWN = "yyyy-MM-dd HH:mm:ss"


def timed(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events with ``at``, their time as a timestamp, under a watermark."""
    return events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)


def _by_window(events: DataFrame, window: Column, *keys: str) -> DataFrame:
    sums = events.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return sums.select(F.date_format("w.start", SHOWN).alias("start"), *keys, "n", "total")


def tumbling(events: DataFrame, size: str = "1 hour") -> DataFrame:
    """``start, event_type, n, total`` of windows that follow each other."""
    return _by_window(timed(events), F.window("at", size), "event_type")


def sliding(events: DataFrame, size: str = "2 hours", step: str = "1 hour") -> DataFrame:
    """``start, event_type, n, total`` of overlapping windows."""
    return _by_window(timed(events), F.window("at", size, step), "event_type")


def sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    """``start, user_id, n, total`` of each user's runs of events without a pause of ``gap``."""
    return _by_window(timed(events), F.session_window("at", gap), "user_id")


def once(events: DataFrame, *keys: str) -> DataFrame:
    """Of events with equal keys within the watermark, the first to arrive."""
    return timed(events).dropDuplicatesWithinWatermark(list(keys))


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files; the pattern lets it be one file or a folder of them."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Run over all that has arrived, with table and progress in the shared folder; what was emitted.

    A rerun under the same progress folder goes on where the last one ended.
    """
    path = fresh_path(stream.sparkSession, name)
    run = stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start(f"{path}/table", format="parquet")
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/table")
