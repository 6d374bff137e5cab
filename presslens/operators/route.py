"""Which pool an item goes to, and which scope its source has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import words as W


def home_pool(source_lang: Column, language: Column) -> Column:
    """The source's language where it is a pool; Cyrillic languages go to ru; unknown ones to en."""
    lang = F.coalesce(language, F.lit("unknown"))
    return F.when(source_lang.isin(*W.POOLS), source_lang).when(lang.isin(*W.CYRILLIC_CODES), "ru").when(lang.isin("es", "pt", "fr"), lang).otherwise("en")


def route(items: DataFrame) -> DataFrame:
    """A copy of world items for every pool, other items for their own pool: an explode over five literals, no join."""
    pools = F.when(F.coalesce("scope", F.lit("world")) == "world", F.array(*map(F.lit, W.POOLS))).otherwise(F.array(home_pool(F.col("source_lang"), F.col("language"))))
    return items.withColumn("pool", F.explode(pools))


def bridges(items: DataFrame, markers: dict[str, tuple[str, ...]], most: int = 20, order: tuple[str, ...] = ("ru", "en", "es", "pt")) -> DataFrame:
    """Copies of items that mention another pool's country, for the first such pool; at most 20 in all, in order of arrival."""
    text = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.substring(F.coalesce("summary", F.lit("")), 1, 300)))
    own = home_pool(F.col("source_lang"), F.col("language"))
    first = F.coalesce(*[F.when((own != p) & F.exists(F.array(*map(F.lit, markers[p])), lambda m: F.contains(text, m)), F.lit(p)) for p in order if markers.get(p)])
    local = items.filter(F.coalesce("scope", F.lit("world")) != "world").withColumn("pool", first).filter(F.col("pool").isNotNull())
    return local.orderBy("idx").limit(most).withColumn("bridge", F.lit(True))


def source_scope(sources: DataFrame, domains: DataFrame, world: tuple[str, ...], spaces: DataFrame | None = None) -> DataFrame:
    """``scope`` of each source: known world outlets, then home domains, then pool domains, then a country of a pool's space, else world.

    ``domains`` (kind, domain), matched inside the address, and ``spaces``
    (source, pool: sources whose country is in a pool's space) are bounded dimensions.
    """
    d = F.broadcast(domains.select(F.col("kind").alias("d_kind"), "domain"))
    hit = sources.join(d, F.contains(F.lower("url"), F.col("domain"))).groupBy("url").agg(F.max((F.col("d_kind") == "home").cast("int")).alias("home"), F.max((F.col("d_kind") == "pool").cast("int")).alias("near"))
    joined = sources.drop("scope").join(hit, "url", "left")
    known = F.lit(False)
    if spaces is not None:
        joined = joined.join(F.broadcast(spaces.select(F.col("source").alias("k_source")).distinct()), F.col("source") == F.col("k_source"), "left")
        known = F.col("k_source").isNotNull()
    scope = F.when(F.col("source").isin(*world), "world").when(F.col("home") == 1, "local").when((F.col("near") == 1) | known, "pool").otherwise("world")
    return joined.withColumn("scope", scope).drop("home", "near", "k_source")


def active_sources(sources: DataFrame, retired: DataFrame) -> DataFrame:
    """Sources of active languages whose address holds no retired part."""
    r = F.broadcast(retired.select("fragment"))
    active = sources.filter(F.col("lang").isNull() | F.col("lang").isin(*W.POOLS))
    return active.join(r, F.contains(F.lower("url"), F.col("fragment")), "left_anti")


def demote_foreign_local(scope: Column, bridge: Column, at_home: Column, in_pool: Column) -> Column:
    return F.when((scope == "local") & ~F.coalesce(bridge, F.lit(False)) & ~at_home, F.when(in_pool, "pool").otherwise("world")).otherwise(scope)


def fix_scope(items: DataFrame, countries: DataFrame, utility: tuple[str, ...]) -> DataFrame:
    """World items that mention a country of their pool's space become pool; utility news leave entertainment shelves.

    ``countries`` (country, pool, word) is a bounded dimension; a country without words counts as mentioned.
    """
    from presslens.functions import text as X

    low = F.lower(F.concat_ws(" ", "title", F.substring("summary", 1, 400)))
    space = countries.groupBy("pool", "country").agg(F.collect_set("word").alias("c_words")).select(F.col("pool").alias("c_pool"), F.col("country").alias("c_country"), "c_words")
    joined = items.join(F.broadcast(space), (F.col("pool") == F.col("c_pool")) & (F.col("country") == F.col("c_country")), "left")
    named = F.col("c_words").isNotNull() & ((F.size("c_words") == 0) | F.exists("c_words", lambda w: F.contains(low, w)))
    scope = F.when((F.col("scope") == "world") & named, "pool").otherwise(F.col("scope"))
    shelf = F.when(F.col("category").isin("SPORT", "STARS", "TECH", "MONEY", "CULTURE") & X.any_of(low, utility), F.when(F.col("scope") == "local", "KG").otherwise("NEWS")).otherwise(F.col("category"))
    return joined.withColumn("scope", scope).withColumn("category", shelf).drop("c_pool", "c_country", "c_words")


def auto_category(items: DataFrame, keywords: DataFrame) -> DataFrame:
    """Items filed under NEWS get the first category (by ``pos``) of which the title holds a keyword.

    ``keywords`` (category, pos, keyword) is a bounded dimension. A keyword
    counts inside longer words too.
    """
    k = F.broadcast(keywords.select(F.col("category").alias("k_category"), F.col("pos").alias("k_pos"), F.lower("keyword").alias("keyword")))
    first = items.filter("category = 'NEWS'").select("idx", F.lower("title").alias("low")).join(k, F.contains(F.col("low"), F.col("keyword"))).groupBy("idx").agg(F.min(F.struct("k_pos", "k_category")).alias("k"))
    return items.join(first.select(F.col("idx").alias("k_idx"), F.col("k.k_category").alias("found")), F.col("idx") == F.col("k_idx"), "left").withColumn("category", F.coalesce("found", "category")).drop("k_idx", "found")
