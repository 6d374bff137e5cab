"""Queries over the memory of earlier runs, configuration, stories, pages and events, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.operators import memory, select
from presslens.plans.feed import ROUTED, _items, _routed, _with, query
from presslens.sources import items as S
from presslens.sources.items import AS_OF_MS, ITEMS_SQL
from presslens.shared import table
from presslens.streaming import events as E

HOUR = memory.HOUR
KEY = "right(translate(url, './#$[]', '______'), 180)"
VERDICTS = ROUTED + f""",
verdicts AS (
  SELECT pool, {KEY} AS key, idx % 8 = 0 AS keep, {AS_OF_MS} - (idx % 60) * {HOUR} AS ts, CASE WHEN idx % 16 = 4 THEN 6 ELSE 7 END AS rules FROM routed WHERE idx % 4 = 0
  UNION ALL SELECT DISTINCT '_world', {KEY}, idx % 2 = 0, {AS_OF_MS} - (idx % 60) * {HOUR}, CASE WHEN idx % 16 = 4 THEN 6 ELSE 7 END FROM routed WHERE scope = 'world' AND idx % 5 < 2
)"""
SOURCES = ", sources AS (SELECT source, count(*) AS n FROM items WHERE source IS NOT NULL GROUP BY source)"


def _verdicts(routed: DataFrame) -> DataFrame:
    """Answers of earlier runs, made from the items: the pools' own and, for world items, shared ones."""
    idx = F.col("idx")
    columns = [X.cache_key(F.col("url"), F.col("title")).alias("key"), (F.lit(AS_OF_MS) - idx % 60 * HOUR).alias("ts"), F.when(idx % 16 == 4, 6).otherwise(7).alias("rules")]
    own = routed.filter("idx % 4 = 0").select("pool", (idx % 8 == 0).alias("keep"), *columns)
    world = routed.filter("scope = 'world' AND idx % 5 < 2").select(F.lit("_world").alias("pool"), (idx % 2 == 0).alias("keep"), *columns).distinct()
    return own.unionByName(world)


@query(_with(VERDICTS) + f""", valid AS (SELECT * FROM verdicts WHERE ts > {AS_OF_MS - 48 * HOUR} AND ts >= {AS_OF_MS - 40 * HOUR} AND rules = 7)
SELECT r.idx, r.pool, CASE WHEN coalesce(o.keep, w.keep) THEN 'keep' WHEN NOT coalesce(o.keep, w.keep) THEN 'drop' ELSE 'ask' END AS state
FROM (SELECT *, {KEY} AS key FROM routed) r LEFT JOIN valid o ON o.pool = r.pool AND o.key = r.key LEFT JOIN valid w ON w.pool = '_world' AND w.key = r.key AND r.scope = 'world'""")
def verdict_lookup(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    valid = memory.valid_verdicts(_verdicts(routed), AS_OF_MS, AS_OF_MS - 40 * HOUR, 7)
    return memory.with_verdicts(routed, valid).select("idx", "pool", "state")


@query(_with(VERDICTS) + f""", both_runs AS (SELECT * FROM verdicts UNION ALL SELECT pool, key, false, ts + {HOUR}, rules FROM verdicts WHERE keep)
SELECT pool, key, keep, ts, rules FROM (SELECT *, row_number() OVER (PARTITION BY pool, key ORDER BY ts DESC, keep DESC, rules DESC) AS rn FROM both_runs WHERE ts > {AS_OF_MS - 48 * HOUR}) WHERE rn = 1""")
def verdict_merge(spark, sf_dir):
    old = _verdicts(_routed(spark, sf_dir))
    new = old.filter("keep").withColumn("ts", F.col("ts") + HOUR).withColumn("keep", F.lit(False))
    return memory.merge_verdicts(old, new, AS_OF_MS).select("pool", "key", "keep", "ts", "rules")


def _sources(spark, sf_dir) -> DataFrame:
    return _items(spark, sf_dir).filter("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(_with(ITEMS_SQL) + SOURCES + """, code AS (SELECT 'https://' || upper(source) || '.example/rss' AS url, source, (n % 7)::INT AS quota, 1 AS priority, 'world' AS scope, NULL::VARCHAR AS lang, 'NEWS' AS category FROM sources WHERE n % 3 <> 0),
stored AS (SELECT 'https://' || source || '.example/rss' AS url, source, 99 AS quota, 0 AS priority, 'local' AS scope, 'en' AS lang, 'TECH' AS category FROM sources WHERE n % 2 = 0)
SELECT coalesce(s.url, c.url) AS url, coalesce(s.source, c.source) AS source, coalesce(c.quota, s.quota) AS quota, coalesce(c.priority, s.priority) AS priority, coalesce(c.scope, s.scope) AS scope, coalesce(c.lang, s.lang) AS lang, coalesce(c.category, s.category) AS category
FROM code c FULL JOIN stored s ON lower(c.url) = lower(s.url)""")
def config_merge(spark, sf_dir):
    """The registry and stored rows by address, which differ in case."""
    s = _sources(spark, sf_dir)
    row = lambda url, quota, priority, scope, lang, category: [url.alias("url"), "source", quota.cast("int").alias("quota"), F.lit(priority).alias("priority"), F.lit(scope).alias("scope"), F.lit(lang).cast("string").alias("lang"), F.lit(category).alias("category")]
    address = lambda name: F.concat(F.lit("https://"), name, F.lit(".example/rss"))
    code = s.filter("n % 3 <> 0").select(*row(address(F.upper("source")), F.col("n") % 7, 1, "world", None, "NEWS"))
    stored = s.filter("n % 2 = 0").select(*row(address(F.col("source")), F.lit(99), 0, "local", "en", "TECH"))
    return memory.merge_config(code, stored)


@query(_with(ITEMS_SQL) + SOURCES + f""", old AS (SELECT source AS key, 'old-' || source AS payload, {AS_OF_MS} - (n % 6) * {HOUR} AS "updatedAt" FROM sources),
fresh AS (SELECT source AS key, CASE WHEN n % 4 = 1 THEN '' ELSE 'new-' || source END AS payload FROM sources WHERE n % 4 <> 0),
taken AS (SELECT o.*, f.payload AS other, "updatedAt" <= {AS_OF_MS - 3 * HOUR} AND length(coalesce(f.payload, '')) > 0 AS take FROM old o LEFT JOIN fresh f USING (key))
SELECT key, CASE WHEN take THEN other ELSE payload END AS payload, CASE WHEN take THEN {AS_OF_MS} ELSE "updatedAt" END AS "updatedAt" FROM taken""")
def state_refresh(spark, sf_dir):
    """Payloads older than three hours give way to new ones that aren't empty."""
    s = _sources(spark, sf_dir)
    old = s.select(F.col("source").alias("key"), F.concat(F.lit("old-"), "source").alias("payload"), (F.lit(AS_OF_MS) - F.col("n") % 6 * HOUR).alias("updatedAt"))
    new = s.filter("n % 4 <> 0").select(F.col("source").alias("key"), F.when(F.col("n") % 4 == 1, "").otherwise(F.concat(F.lit("new-"), "source")).alias("payload"))
    return memory.refresh(old, new, AS_OF_MS)


@query("SELECT month, usd, calls, usd >= 1000 AS stopped, usd >= 750 AS warned FROM (SELECT strftime(ts, '%Y-%m') AS month, round(sum(value), 4) AS usd, count(*) AS calls FROM events GROUP BY 1)")
def monthly_spend(spark, sf_dir):
    return memory.monthly_spend(table(spark, sf_dir, "events").select("ts", F.col("value").alias("usd")), 1000.0)


TITLE_KEY = r"'t:' || left(array_to_string(list_slice(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(lower(title), '\p{L}+'), lambda x: length(x) > 3), lambda x: left(x, 6)))), 1, 10), '-'), 96)"


@query(_with(ITEMS_SQL) + rf""", keyed AS (SELECT *, 'u:' || left(regexp_replace(url, '[./#$\[\]]', '_', 'g'), 96) AS url_key, {TITLE_KEY} AS title_key FROM items),
posted AS (SELECT url_key AS key FROM keyed WHERE idx % 7 = 0 UNION SELECT title_key FROM keyed WHERE idx % 7 = 0)
SELECT idx FROM keyed WHERE priority >= 1 AND category NOT IN ('CURRENCY', 'CRYPTO') AND (language = 'en' OR coalesce(language, 'unknown') = 'unknown')
AND url_key NOT IN (SELECT key FROM posted) AND title_key NOT IN (SELECT key FROM posted) ORDER BY idx LIMIT 5""")
def posts(spark, sf_dir):
    """The five rows to post, without those of which a key was posted before."""
    items = _items(spark, sf_dir)
    posted = items.filter("idx % 7 = 0").select(F.explode(X.post_keys(F.col("url"), F.col("title"))).alias("key")).distinct()
    return select.posts(items, posted, "en").select("idx")


@query(_with(ITEMS_SQL) + """SELECT idx, CASE WHEN length(coalesce(summary, '')) <= 700 THEN summary WHEN length(whole) > 200 THEN whole ELSE left(summary, 700) END AS summary, scope IN ('local', 'pool') AS own
FROM (SELECT *, regexp_extract(left(coalesce(summary, ''), 700), '(?s)^(.*[.!?…])', 1) AS whole FROM items)""")
def story_blocks(spark, sf_dir):
    return memory.story_blocks(_items(spark, sf_dir)).select("idx", "summary", "own")


@query(r"""SELECT page_id, len(found)::INT AS n, array_to_string(found, ' ') AS links FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"', 1) AS found FROM pages)""")
def page_links(spark, sf_dir):
    found = table(spark, sf_dir, "pages").select("page_id", S.links(F.col("html")).alias("found"))
    return found.select("page_id", F.when(F.col("found").isNotNull(), F.size("found")).alias("n"), F.array_join("found", " ").alias("links"))


@query()
def page_texts(spark, sf_dir):
    """Titles, texts and pictures of pages (look-ahead and back references have no form in the SQL dialect; tested by cases)."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", S.page_title(html).alias("title"), S.page_text(html).alias("text"), S.page_photo(html).alias("photo"))


STARTED = "strftime(start, '%Y-%m-%d %H:%M:%S') AS start"
SUMS = "count(*) AS n, round(sum(value), 4) AS total"


@query(f"SELECT {STARTED}, event_type, n, total FROM (SELECT date_trunc('hour', ts) AS start, event_type, {SUMS} FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)")
def tumbling(spark, sf_dir):
    return E.tumbling(table(spark, sf_dir, "events"))


@query(f"SELECT {STARTED}, event_type, n, total FROM (SELECT start, event_type, {SUMS} FROM (SELECT *, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events WHERE ts IS NOT NULL) GROUP BY 1, 2)")
def sliding(spark, sf_dir):
    return E.sliding(table(spark, sf_dir, "events"))


@query(f"""WITH marked AS (SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 6 HOUR, true) AS opens FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM marked)
SELECT {STARTED}, user_id, n, total FROM (SELECT min(ts) AS start, user_id, {SUMS} FROM numbered GROUP BY user_id, nth)""")
def sessions(spark, sf_dir):
    return E.sessions(table(spark, sf_dir, "events"))


@query(f"""SELECT {STARTED}, event_type, n, total FROM (SELECT date_trunc('hour', ts) AS start, event_type, {SUMS} FROM events WHERE ts IS NOT NULL GROUP BY 1, 2)
WHERE start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def stream_tumbling(spark, sf_dir):
    """Hourly sums of the stream of events: windows that the watermark has passed."""
    return E.run_available(E.tumbling(E.arriving(spark, sf_dir, "events")), "stream-tumbling")


@query("SELECT event_id, user_id FROM events WHERE ts IS NOT NULL")
def stream_once(spark, sf_dir):
    """A stream that delivers every event twice, each kept once."""
    twice = E.arriving(spark, sf_dir, "events").filter("ts IS NOT NULL").unionByName(E.arriving(spark, sf_dir, "events").filter("ts IS NOT NULL"))
    return E.run_available(E.once(twice, "event_id").select("event_id", "user_id"), "stream-once")
