import math
import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='spark-')}",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(value):
    """A value in a form that compares alike from both engines."""
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.fixture(scope="session")
def same(spark):
    """Asserts that a query's rows equal its SQL's."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")

    def check(query, sql):
        frame = query(spark, SF)
        found = db.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(frame.columns)
        want = sorted(repr([plain(v) for v in r]) for r in found.fetchall())
        assert sorted(repr([plain(r[c]) for c in names]) for r in frame.collect()) == want

    return check
