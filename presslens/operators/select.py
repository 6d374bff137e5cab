"""Choosing rows: best of a group, caps, floors, budgets and top-k.

Ranks within a pool, of which there are a handful, don't come from windows over
the pool: narrow rows are sorted by range into parts (a pool spreads over as many
parts as its rows need), rows are numbered within their part, and what the parts
before hold is added from a small table of counts. Texts are not sorted; they
are joined again by (pool, idx).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W
from presslens.shared import materialise

HOUR = 3_600_000


def has_photo() -> Column:
    return F.length(F.coalesce("imageUrl", F.lit(""))) > 0


def _merit() -> list[Column]:
    return [F.desc("priority"), has_photo().desc(), F.length(F.coalesce("summary", F.lit(""))).desc(), F.asc("idx")]


def best_of(items: DataFrame, *group: str) -> DataFrame:
    """The best row of each group: priority, photo, length of text, arrival."""
    return items.withColumn("rn", F.row_number().over(Window.partitionBy(*group).orderBy(*_merit()))).filter("rn = 1").drop("rn")


def angles(items: DataFrame, cluster: str = "cluster", most: int = 3, least: int = 200) -> DataFrame:
    """The best row of a cluster, and of important clusters up to two more from other scopes with photo and text.

    A row without photo or text doesn't use up its scope. Kept groups of
    several rows get the best row's address as ``storyKey``.
    """
    ranked = items.withColumn("rn", F.row_number().over(Window.partitionBy(cluster).orderBy(*_merit())))
    whole = Window.partitionBy(cluster)
    best = F.max(F.when(F.col("rn") == 1, F.struct("scope", "priority", "url"))).over(whole)
    ranked = ranked.withColumn("best", best)
    able = (F.col("rn") == 1) | ((F.col("best.priority") >= 2) & has_photo() & (F.length("summary") >= least) & (F.col("scope") != F.col("best.scope")))
    first = ranked.filter(able).withColumn("per_scope", F.row_number().over(Window.partitionBy(cluster, "scope").orderBy("rn"))).filter("per_scope = 1")
    kept = first.withColumn("nth", F.row_number().over(Window.partitionBy(cluster).orderBy("rn"))).filter(F.col("nth") <= most)
    kept = kept.withColumn("n", F.count(F.lit(1)).over(whole))
    return kept.withColumn("storyKey", F.when(F.col("n") > 1, F.col("best.url"))).drop("rn", "best", "per_scope", "nth", "n")


def drop_twins(items: DataFrame, hours: int = 12) -> DataFrame:
    """Of a source's items with one signature within 12 hours, keep that with a photo and the most Cyrillic letters."""
    marked = items.withColumn("signature", X.signature(F.col("title")))
    group = Window.partitionBy("source", "signature")
    close = (F.max("publishedAt").over(group) - F.min("publishedAt").over(group) <= hours * HOUR) & F.col("signature").isNotNull()
    rank = F.row_number().over(group.orderBy(has_photo().desc(), X.count(F.concat_ws(" ", "title", "summary"), X.CYRILLIC).desc(), "publishedAt", "idx"))
    return marked.withColumn("close", close).withColumn("rank", rank).filter("NOT close OR rank = 1").drop("signature", "close", "rank")


def blank_repeated_images(items: DataFrame, least: int = 3) -> DataFrame:
    """A picture that a source uses at least three times is its logo: blank it."""
    n = F.count(F.lit(1)).over(Window.partitionBy("source", "imageUrl"))
    return items.withColumn("n", n).withColumn("imageUrl", F.when((F.length("imageUrl") > 0) & (F.col("n") >= least), "").otherwise(F.col("imageUrl"))).drop("n")


def source_quota(items: DataFrame, quota: Column) -> DataFrame:
    """The first ``quota`` rows of each source in order of arrival."""
    return items.withColumn("rn", F.row_number().over(Window.partitionBy("source").orderBy("idx"))).filter(F.col("rn") <= quota).drop("rn")


def dedup_by(items: DataFrame, key: str = "url") -> DataFrame:
    return items.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy("idx"))).filter("rn = 1").drop("rn")


def fetch_budget(items: DataFrame, budget: int, least: int = 400) -> DataFrame:
    """The first distinct addresses, in order of arrival, of items with too little text."""
    short = items.filter((F.length(F.coalesce("summary", F.lit(""))) < least) & F.col("url").startswith("http") & ~F.col("url").contains("t.me"))
    return dedup_by(short).orderBy("idx").limit(budget)


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """Narrow rows sorted by range over all parts; ``part`` and ``at`` say where a row came to stand.

    Written to the shared folder, so that places stay as they are.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "in-order")


def numbered(placed: DataFrame, name: str, *keys: str) -> DataFrame:
    """``name``: each row's number among rows of equal keys, in the order of ``in_order``."""
    counts = placed.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("part").alias("b_part"), F.coalesce(F.sum("c").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    same = F.col("part") == F.col("b_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"b_{k}"))
    here = placed.withColumn("here", F.row_number().over(Window.partitionBy("part", *keys).orderBy("at")))
    return here.join(before, same).withColumn(name, F.col("before") + F.col("here")).drop("here", "before", "b_part", *[f"b_{k}" for k in keys])


def feed_size() -> Column:
    out = F.lit(W.FEED_SIZE_ELSE)
    for pool, size in W.FEED_SIZE.items():
        out = F.when(F.col("pool") == pool, size).otherwise(out)
    return out


def feed_places(items: DataFrame) -> DataFrame:
    """``pool, idx, rank, reserved, place`` of the rows that make each pool's feed.

    By priority, then arrival; of one family at most a fifth of the pool, and at
    least three, in rank order; each scope's floor of places is reserved and the
    rest filled by rank. ``place`` is the output order. At most 80 rows a pool.
    """
    narrow = items.select("pool", "idx", "family", "scope", "priority")
    placed = in_order(narrow, F.col("pool"), F.desc("priority"), F.col("idx"))
    sizes = placed.groupBy(F.col("pool").alias("s_pool")).agg(F.count(F.lit(1)).alias("n"))  # a row a pool
    ranked = numbered(numbered(placed, "rank", "pool"), "nth", "pool", "family").join(sizes, F.col("pool") == F.col("s_pool"))
    capped = ranked.filter(F.expr("nth <= greatest(3, n div 5)")).drop("n", "nth", "s_pool")
    size, floor = feed_size(), F.lit(0)
    for scope, percent in W.FLOORS.items():
        floor = F.when(F.col("scope") == scope, F.floor(size * percent / 100)).otherwise(floor)
    held = materialise(numbered(capped, "nth", "pool", "scope").withColumn("reserved", F.coalesce(F.col("nth") <= floor, F.lit(False))).drop("nth"), "feed-held")
    filled = numbered(held, "fill", "pool", "reserved")
    total = held.filter("reserved").groupBy(F.col("pool").alias("t_pool")).agg(F.count(F.lit(1)).alias("total"))
    kept = filled.join(total, F.col("pool") == F.col("t_pool"), "left").filter(F.col("reserved") | (F.col("fill") <= size - F.coalesce("total", F.lit(0))))
    shelf = F.when(~F.col("reserved"), 3).when(F.col("scope") == "local", 0).when(F.col("scope") == "pool", 1).otherwise(2)
    place = F.row_number().over(Window.partitionBy("pool").orderBy(shelf, "rank"))  # over a feed's rows, at most 80
    return kept.withColumn("place", place).select("pool", "idx", F.col("rank").cast("int").alias("rank"), "reserved", "place")


def feed(items: DataFrame) -> DataFrame:
    """The feed rows of every pool with their places; the places, a few hundred rows at most, go to the texts."""
    places = feed_places(items).select(F.col("pool").alias("p_pool"), F.col("idx").alias("p_idx"), "rank", "reserved", "place")
    return items.join(F.broadcast(places), (F.col("pool") == F.col("p_pool")) & (F.col("idx") == F.col("p_idx"))).drop("p_pool", "p_idx")


def first_of(rows: DataFrame, key: str, most: int, *order: Column, salts: int = 64) -> DataFrame:
    """The first ``most`` rows of each key, from the first of each of its salts."""
    part = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    some = part.withColumn("rn", F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order))).filter(F.col("rn") <= most)
    return some.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rn") <= most).drop("rn", "salt")


def cap_urgent(items: DataFrame, as_of_ms: int, keep: int = 2, hours: int = 3) -> DataFrame:
    """Two urgent rows of a pool stay urgent: fresh ones, nearest scope first; explanations and prices never are."""
    urgent = F.col("category").isin("URGENT", "URGENT_LOCAL_ONLY")
    able = urgent & ~F.lower("title").rlike(W.NEVER_URGENT) & (F.lit(as_of_ms) - F.col("publishedAt") <= hours * HOUR)
    near = F.when(F.col("scope") == "local", 0).when(F.col("scope") == "pool", 1).when(F.col("scope") == "world", 2).otherwise(3)
    fresh = items.filter(able).select("pool", "idx", near.alias("near"), "publishedAt")
    stay = first_of(fresh, "pool", keep, F.col("near"), F.desc("publishedAt"), F.col("idx")).select(F.col("pool").alias("u_pool"), F.col("idx").alias("u_idx"))  # ``keep`` rows a pool
    joined = items.join(F.broadcast(stay), (F.col("pool") == F.col("u_pool")) & (F.col("idx") == F.col("u_idx")), "left")
    return joined.withColumn("category", F.when(urgent & F.col("u_idx").isNull(), "NEWS").otherwise(F.col("category"))).drop("u_pool", "u_idx")


def first_reporter(blocks: DataFrame, minutes: int = 15) -> DataFrame:
    """``lead``: the earliest own block (else the earliest of all) where it is 15 minutes before the present lead, else that."""
    whole = Window.partitionBy("story")
    own = F.min(F.when(F.col("own"), F.struct("publishedAt", "pos"))).over(whole)
    first = F.coalesce(own, F.min(F.struct("publishedAt", "pos")).over(whole))
    now = F.min(F.when(F.col("pos") == 0, F.col("publishedAt"))).over(whole)
    lead = F.when(now - F.col("first.publishedAt") >= minutes * 60_000, F.col("first.pos")).otherwise(0)
    return blocks.withColumn("first", first).withColumn("lead", F.col("pos") == lead).drop("first")


def fallback_half(items: DataFrame, score: Column, chunk: int = 20) -> DataFrame:
    """``pool, idx, chunk, score``: of each chunk the better half by score, at least one; chunks follow arrival within a pool."""
    narrow = items.select("pool", "idx", score.alias("score"))
    placed = numbered(in_order(narrow, F.col("pool"), F.col("idx")), "nth", "pool").withColumn("chunk", F.floor((F.col("nth") - 1) / chunk))
    group = Window.partitionBy("pool", "chunk")  # ``chunk`` rows
    ranked = placed.withColumn("n", F.count(F.lit(1)).over(group)).withColumn("rn", F.row_number().over(group.orderBy(F.desc("score"), "idx")))
    return ranked.filter(F.expr("rn <= greatest(1, n div 2)")).select("pool", "idx", "chunk", "score")


def posts(items: DataFrame, posted: DataFrame, pool: str, most: int = 5) -> DataFrame:
    """Up to five important rows in the channel's language of which neither key was posted."""
    read = F.col("language").isin("ru", "ky", "uk", "be", "bg", "sr", "kk") if pool == "ru" else F.col("language") == pool
    fit = items.filter((F.col("priority") >= 1) & ~F.col("category").isin("CURRENCY", "CRYPTO") & (read | F.coalesce(F.col("language"), F.lit("unknown")).isin("unknown")))
    keyed = fit.withColumn("key", F.explode(X.post_keys(F.col("url"), F.col("title"))))
    seen = keyed.join(posted.select("key"), "key", "left_semi").select(F.col("idx").alias("s_idx")).distinct()
    return fit.join(seen, F.col("idx") == F.col("s_idx"), "left_anti").orderBy("idx").limit(most)


def stations(rows: DataFrame, talk: tuple[str, ...], most_talk: int = 6, most_any: int = 20) -> DataFrame:
    """Per country the six most clicked talk stations on air, else the twenty most clicked of any kind."""
    live = rows.filter((F.col("lastcheckok") == 1) & (F.length("url") > 0)).withColumn("talk", X.any_of(F.lower(F.concat_ws(" ", "tags", "name")), talk))
    order = [F.desc("clickcount"), F.col("name"), F.col("url")]
    talks = first_of(live.filter("talk"), "country", most_talk, *order)
    some = talks.select(F.col("country").alias("t_country")).distinct()  # a row a country
    silent = live.join(some, F.col("country").eqNullSafe(F.col("t_country")), "left_anti")
    return talks.unionByName(first_of(silent, "country", most_any, *order))
