"""Tables and intermediate results that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only where the session names none, as in tests on one machine, is a local
    temporary folder made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='presslens-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/presslens/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage so that what follows survives lost executors and nothing
    above is computed twice. The shuffles that it took are dropped at once.
    """
    path = fresh_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside leave no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
