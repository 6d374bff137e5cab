"""Small operators of the desk: countries of sources, station totals, viral clips and what a run costs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import text as X

# Dollars for a million tokens, of the main and of the fallback provider.
PRICE_IN, PRICE_OUT = 0.10, 0.40
FALLBACK_IN, FALLBACK_OUT = 0.03, 0.30


def source_country(sources: DataFrame, names: DataFrame, tlds: DataFrame) -> DataFrame:
    """Add ``country``: that of the source's name, else of its address's last label, else empty. Both maps have unique keys."""
    tld = F.regexp_extract("url", r"^[a-z]+://[^/:]*\.([^/:.]+)", 1)
    named = sources.withColumn("tld", tld).join(names.select("source", F.col("country").alias("by_name")), "source", "left")
    return named.join(tlds.select("tld", F.col("country").alias("by_tld")), "tld", "left").withColumn("country", F.coalesce("by_name", "by_tld", F.lit(""))).drop("tld", "by_name", "by_tld")


def station_totals(rows: DataFrame, talk: tuple[str, ...]) -> DataFrame:
    """Stations of each country: listed, on air, and on air with talk."""
    live = F.coalesce((F.col("lastcheckok") == 1) & (F.length("url") > 0), F.lit(False))
    speaks = F.coalesce(X.any_of(F.lower(F.concat_ws(" ", "tags", "name")), talk), F.lit(False))
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("listed"), F.count_if(live).alias("live"), F.count_if(live & speaks).alias("talk"))


def viral_merge(parts: list[DataFrame], most: int = 25) -> DataFrame:
    """The most viewed clips of several lists; of one address the first list's first row counts."""
    listed = reduce(DataFrame.unionByName, [p.withColumn("part", F.lit(k)) for k, p in enumerate(parts)])
    first = F.row_number().over(Window.partitionBy("url").orderBy("part", "idx"))
    return listed.withColumn("nth", first).filter("nth = 1").drop("nth", "part").orderBy(F.desc("views"), "idx").limit(most)


def run_cost(calls: DataFrame) -> DataFrame:
    """Calls, tokens and dollars of a run's calls (main, tokens_in, tokens_out)."""
    price = F.when(F.col("main"), PRICE_IN * F.col("tokens_in") + PRICE_OUT * F.col("tokens_out")).otherwise(FALLBACK_IN * F.col("tokens_in") + FALLBACK_OUT * F.col("tokens_out"))
    return calls.agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").cast("long").alias("tokens_in"), F.sum("tokens_out").cast("long").alias("tokens_out"), F.round(F.sum(price) / 1_000_000, 9).alias("usd"))
