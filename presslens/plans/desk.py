"""Queries over sources, shelves, stations, videos, rates and running costs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.operators import desk, memory, route, select
from presslens.plans.feed import _items, _like, _with, query
from presslens.sources import items as S
from presslens.sources.items import AS_OF_MS, ITEMS_SQL
from presslens.shared import table

HOUR = memory.HOUR
HOME = """CASE WHEN source_lang IN ('ru', 'en', 'es', 'pt', 'fr') THEN source_lang WHEN language IN ('ru', 'uk', 'be', 'bg', 'sr', 'kk', 'ky') THEN 'ru' WHEN language IN ('es', 'pt', 'fr') THEN language ELSE 'en' END"""


def values(rows: list[tuple], names: str) -> str:
    """Rows of text and numbers as a SQL table."""
    cell = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") v({names})"


CODES = ("USD", "EUR", "RUB", "CNY", "KZT", "GBP", "JPY")


@query(f"""WITH cells AS (
  SELECT c_custkey AS office, {list(CODES)}[c_custkey % 7 + 1] AS code, CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE replace(printf('%.2f', c_acctbal / 100), '.', ',') END AS buy,
    CASE WHEN c_nationkey = 0 THEN '' ELSE ' ' || printf('%.4f', c_acctbal / 99) || ' ' END AS sell FROM customer
), priced AS (SELECT office, code, try_cast(replace(trim(buy), ',', '.') AS DOUBLE) AS buy, try_cast(replace(trim(sell), ',', '.') AS DOUBLE) AS sell FROM cells WHERE code IN ('USD', 'EUR', 'RUB', 'CNY', 'KZT'))
SELECT code, count(*) AS offices, max(buy) AS best_buy, min(sell) AS best_sell FROM priced WHERE buy > 0 AND sell > 0 GROUP BY code""")
def fx_rates(spark, sf_dir):
    """Exchange offices' price cells as text: accounts stand for prices, some empty, some below zero, with either decimal mark."""
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    cells = table(spark, sf_dir, "customer").select(
        key.alias("office"),
        F.get(F.array(*map(F.lit, CODES)), (key % 7).cast("int")).alias("code"),
        F.when(balance < 0, "n/a").otherwise(F.replace(F.format_string("%.2f", balance / 100), F.lit("."), F.lit(","))).alias("buy"),
        F.when(F.col("c_nationkey") == 0, "").otherwise(F.format_string(" %.4f ", balance / 99)).alias("sell"),
    )
    return S.fx_rates(cells)


@query("""WITH days AS (SELECT o_orderstatus AS name, o_orderdate AS day, max(o_orderkey) AS last_key FROM orders GROUP BY ALL),
closes AS (SELECT d.name, d.day, CASE WHEN o.o_orderpriority LIKE '1%' THEN 0 ELSE o.o_totalprice END AS price FROM days d JOIN orders o ON o.o_orderkey = d.last_key),
quotes AS (SELECT *, lag(price) OVER (PARTITION BY name ORDER BY day) AS previous FROM closes)
SELECT name, strftime(day, '%Y-%m-%d') AS day, price, previous, round(coalesce((price - previous) * 100 / nullif(previous, 0), 0), 2) AS change, format('{:,.2f}', price) AS shown FROM quotes""")
def index_quotes(spark, sf_dir):
    """Order prices as index quotes: the last order of a day closes it, urgent ones have no price; the day before is the previous close."""
    orders = table(spark, sf_dir, "orders")
    last = F.max_by(F.when(F.col("o_orderpriority").startswith("1"), 0.0).otherwise(F.col("o_totalprice")), "o_orderkey")
    closes = orders.groupBy(F.col("o_orderstatus").alias("name"), F.col("o_orderdate").alias("at")).agg(last.alias("price"))
    quotes = closes.withColumn("previous", F.lag("price").over(Window.partitionBy("name").orderBy("at")))  # a row a day
    return S.index_quotes(quotes).select("name", F.date_format("at", "yyyy-MM-dd").alias("day"), "price", "previous", "change", "shown")


@query(_with(ITEMS_SQL) + """, clips AS (SELECT idx, source AS "channelId", title || CASE WHEN idx % 10 = 0 THEN ' 🔥🔥' WHEN idx % 10 = 1 THEN ' 🔥' ELSE '' END AS title, idx * 7919 % 500000 AS views FROM items),
subscribers AS (SELECT source AS "channelId", count(*) * 30000 AS subscribers FROM items WHERE source IS NOT NULL GROUP BY source)
SELECT idx, views, subscribers FROM clips JOIN subscribers USING ("channelId") WHERE views >= CASE WHEN idx % 2 = 0 THEN 50000 ELSE 200000 END AND subscribers >= CASE WHEN idx % 2 = 0 THEN 50000 ELSE 300000 END
AND len(regexp_extract_all(title, '[\\x{1F301}-\\x{10FFFF}]')) < 2 AND NOT contains(lower(title), 'trailer') AND NOT contains(lower(title), 'the ')""")
def trending_videos(spark, sf_dir):
    items, fire = _items(spark, sf_dir), F.col("idx") % 10
    clips = items.select("idx", F.col("source").alias("channelId"), F.concat("title", F.when(fire == 0, " 🔥🔥").when(fire == 1, " 🔥").otherwise("")).alias("title"), (F.col("idx") * 7919 % 500000).alias("views"))
    subscribers = items.filter("source IS NOT NULL").groupBy(F.col("source").alias("channelId")).agg((F.count(F.lit(1)) * 30000).alias("subscribers"))
    return S.videos(clips, subscribers, F.col("idx") % 2 == 0, ("trailer", "the ")).select("idx", "views", "subscribers")


STATIONS = """, stations AS (SELECT idx, title AS name, url, language AS country, source AS tags, idx * 31 % 1000 AS clickcount, (idx % 4 <> 0)::INT AS lastcheckok FROM items),
live AS (SELECT *, coalesce(contains(lower(concat_ws(' ', tags, name)), 'news') OR contains(lower(concat_ws(' ', tags, name)), 'src1'), false) AS talk FROM stations WHERE lastcheckok = 1 AND length(url) > 0)"""


def _stations(spark, sf_dir):
    return _items(spark, sf_dir).select("idx", F.col("title").alias("name"), "url", F.col("language").alias("country"), F.col("source").alias("tags"), (F.col("idx") * 31 % 1000).alias("clickcount"), (F.col("idx") % 4 != 0).cast("int").alias("lastcheckok"))


@query(_with(ITEMS_SQL) + STATIONS + """, ranked AS (SELECT *, bool_or(talk) OVER (PARTITION BY country) AS has_talk, row_number() OVER (PARTITION BY country, talk ORDER BY clickcount DESC, name, url) AS r_talk,
row_number() OVER (PARTITION BY country ORDER BY clickcount DESC, name, url) AS r_any FROM live)
SELECT idx, country, talk FROM ranked WHERE CASE WHEN has_talk THEN talk AND r_talk <= 6 ELSE r_any <= 20 END""")
def station_pick(spark, sf_dir):
    return select.stations(_stations(spark, sf_dir), ("news", "src1")).select("idx", "country", "talk")


@query(_with(ITEMS_SQL) + STATIONS + """SELECT s.country, count(*) AS listed, count(l.idx) AS live, count(*) FILTER (WHERE l.talk) AS talk FROM stations s LEFT JOIN live l ON l.idx = s.idx GROUP BY s.country""")
def station_totals(spark, sf_dir):
    return desk.station_totals(_stations(spark, sf_dir), ("news", "src1"))


@query(_with(ITEMS_SQL) + STATIONS + """SELECT 'calm' AS run, idx, lastcheckok = 1 AS alive FROM stations WHERE (SELECT count(*) FILTER (WHERE lastcheckok = 0) * 2 <= count(*) FROM stations)
UNION ALL SELECT 'fault', idx, true FROM stations WHERE (SELECT count(*) FILTER (WHERE lastcheckok = 1) * 2 > count(*) FROM stations)""")
def majority_alive(spark, sf_dir):
    """Two checks: one in which a quarter of the stations looks dead, and its opposite, in which most do and none counts as dead."""
    ok, runs = F.col("lastcheckok") == 1, []
    for run, alive in (("calm", ok), ("fault", ~ok)):
        runs.append(memory.majority_alive(_stations(spark, sf_dir).withColumn("alive", alive)).select(F.lit(run).alias("run"), "idx", "alive"))
    return runs[0].unionByName(runs[1])


SOURCES = """, sources AS (SELECT source, 'https://' || source || '.example/feed' AS url, arg_max(language, idx) AS lang FROM items WHERE source IS NOT NULL GROUP BY source)"""
DOMAINS = [("home", "src1."), ("pool", "src2."), ("pool", "src1."), ("home", "src3.example"), ("pool", "src1")]
RETIRED = [("src4.",), ("src17",)]
COUNTRIES = [("src5", "CountryA"), ("src6", "CountryB"), ("src9", "CountryA"), ("src3", "CountryA")]
SPACES = [("ru", "CountryA"), ("es", "CountryC")]
TLDS = [("example", "Exampleland"), ("kg", "Kyrgyzstan")]


def _sources(spark, sf_dir):
    url = F.concat(F.lit("https://"), "source", F.lit(".example/feed")).alias("url")
    return _items(spark, sf_dir).filter("source IS NOT NULL").groupBy("source").agg(F.max_by("language", "idx").alias("lang")).select("source", url, "lang", F.lit(None).cast("string").alias("scope"))


@query(_with(ITEMS_SQL) + SOURCES + f""", hit AS (SELECT url, bool_or(kind = 'home') AS home FROM sources JOIN {values(DOMAINS, 'kind, domain')} ON contains(lower(url), domain) GROUP BY url)
SELECT source, s.url, CASE WHEN source = 'src9' THEN 'world' WHEN home THEN 'local' WHEN home IS NOT NULL THEN 'pool' WHEN source IN (SELECT source FROM {values(COUNTRIES, 'source, country')} JOIN {values(SPACES, 'pool, land').replace(' v(', ' w(')} ON land = country) THEN 'pool' ELSE 'world' END AS scope FROM sources s LEFT JOIN hit USING (url)""")
def source_scopes(spark, sf_dir):
    """World outlets, home and pool domains, countries of a pool's space, and the rest."""
    known = spark.createDataFrame(COUNTRIES, "source string, country string").join(spark.createDataFrame(SPACES, "pool string, land string"), F.col("country") == F.col("land"))
    return route.source_scope(_sources(spark, sf_dir), spark.createDataFrame(DOMAINS, "kind string, domain string"), ("src9",), known).select("source", "url", "scope")


@query(_with(ITEMS_SQL) + SOURCES + f"""SELECT source, url FROM sources s WHERE (lang IS NULL OR lang IN ('ru', 'en', 'es', 'pt', 'fr')) AND NOT EXISTS (SELECT 1 FROM {values(RETIRED, 'fragment')} WHERE contains(lower(s.url), fragment))""")
def active_sources(spark, sf_dir):
    return route.active_sources(_sources(spark, sf_dir), spark.createDataFrame(RETIRED, "fragment string")).select("source", "url")


@query(_with(ITEMS_SQL) + SOURCES + f"""SELECT s.source, coalesce(c.country, t.country, '') AS country FROM sources s LEFT JOIN {values(COUNTRIES, 'source, country').replace(' v(', ' c(')} ON c.source = s.source
LEFT JOIN {values(TLDS, 'tld, country').replace(' v(', ' t(')} ON t.tld = regexp_extract(s.url, '^[a-z]+://[^/:]*\\.([^/:.]+)', 1)""")
def source_country(spark, sf_dir):
    names, tlds = spark.createDataFrame(COUNTRIES, "source string, country string"), spark.createDataFrame(TLDS, "tld string, country string")
    return desk.source_country(_sources(spark, sf_dir), names, tlds).select("source", "country")


KEYWORDS = [("SPORT", 1, "ar"), ("TECH", 2, "The"), ("MONEY", 3, "in")]


@query(_with(ITEMS_SQL) + f"""SELECT idx, CASE WHEN category = 'NEWS' THEN coalesce((SELECT arg_min(v.k, pos) FROM {values(KEYWORDS, 'k, pos, keyword')} WHERE contains(lower(title), lower(keyword))), category) ELSE category END AS category FROM items""")
def auto_category(spark, sf_dir):
    return route.auto_category(_items(spark, sf_dir), spark.createDataFrame(KEYWORDS, "category string, pos int, keyword string")).select("idx", "category")


HOMES, NEIGHBOURS = ("//src1.", "//src3."), ("//src1", "//src7.")


@query(_with(ITEMS_SQL) + f"""SELECT idx, CASE WHEN scope = 'local' AND NOT coalesce(starts_with(title, 'T'), false) AND NOT {_like('url', HOMES)} THEN CASE WHEN {_like('url', NEIGHBOURS)} THEN 'pool' ELSE 'world' END ELSE scope END AS scope FROM items""")
def demoted_local(spark, sf_dir):
    """Local items of sources that aren't at home go to the pool of their domain, else to the world; bridges stay."""
    holds = lambda parts: X.any_of(F.col("url"), parts)
    return _items(spark, sf_dir).select("idx", route.demote_foreign_local(F.col("scope"), F.startswith("title", F.lit("T")), holds(HOMES), holds(NEIGHBOURS)).alias("scope"))


MARKERS = {"ru": ("ta",), "en": ("ou", "st"), "es": ("ri",), "pt": ()}


@query(_with(ITEMS_SQL) + f""", marked AS (SELECT *, {HOME} AS home, lower(coalesce(title, '') || ' ' || left(coalesce(summary, ''), 300)) AS low FROM items WHERE coalesce(scope, 'world') <> 'world'),
first AS (SELECT idx, CASE {' '.join(f"WHEN home <> '{p}' AND (" + " OR ".join(f"contains(low, '{m}')" for m in MARKERS[p]) + f") THEN '{p}'" for p in ('ru', 'en', 'es'))} END AS pool FROM marked)
SELECT idx, pool FROM first WHERE pool IS NOT NULL ORDER BY idx LIMIT 20""")
def pool_bridges(spark, sf_dir):
    return route.bridges(_items(spark, sf_dir), MARKERS).select("idx", "pool")


@query(_with(ITEMS_SQL) + f""", old AS (SELECT idx AS id, title, {AS_OF_MS} - (idx % 30) * {HOUR} AS created, {AS_OF_MS} - (idx % 8) * {HOUR} AS fresh, url FROM items WHERE idx % 3 <> 0),
new AS (SELECT idx AS id, 'new ' || title AS title, CASE WHEN idx % 4 = 0 THEN url ELSE url || '/b' END AS url FROM items WHERE idx % 2 = 0),
merged AS (SELECT coalesce(o.id, n.id) AS id, coalesce(n.title, o.title) AS title, coalesce(created, {AS_OF_MS}) AS "createdAt", CASE WHEN n.id IS NOT NULL THEN {AS_OF_MS} ELSE fresh END AS "freshAt",
CASE WHEN o.url = n.url THEN o.url ELSE concat_ws(' ', o.url, n.url) END AS urls FROM old o FULL JOIN new n ON o.id = n.id)
SELECT * FROM merged WHERE "createdAt" > {AS_OF_MS} - 24 * {HOUR} AND "freshAt" > {AS_OF_MS} - 6 * {HOUR}""")
def merged_stories(spark, sf_dir):
    items, idx = _items(spark, sf_dir), F.col("idx")
    old = items.filter("idx % 3 <> 0").select(idx.alias("id"), "title", (F.lit(AS_OF_MS) - idx % 30 * HOUR).alias("createdAt"), (F.lit(AS_OF_MS) - idx % 8 * HOUR).alias("freshAt"), F.array("url").alias("urls"))
    new = items.filter("idx % 2 = 0").select(idx.alias("id"), F.concat(F.lit("new "), "title").alias("title"), F.array(F.when(idx % 4 == 0, F.col("url")).otherwise(F.concat("url", F.lit("/b")))).alias("urls"))
    return memory.merge_stories(old, new, AS_OF_MS).withColumn("urls", F.array_join("urls", " "))


@query(_with(ITEMS_SQL) + """, clips AS (SELECT idx, category, 'https://v.example/' || (idx % 500) AS url, idx * 7919 % 100003 AS views FROM items)
SELECT idx, url, views FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY array_position(['NEWS', 'MONEY', 'TECH', 'URGENT'], category), idx) AS rn FROM clips) WHERE rn = 1 ORDER BY views DESC, idx LIMIT 25""")
def viral_merge(spark, sf_dir):
    clips = _items(spark, sf_dir).select("idx", "category", F.concat(F.lit("https://v.example/"), (F.col("idx") % 500).cast("string")).alias("url"), (F.col("idx") * 7919 % 100003).alias("views"))
    return desk.viral_merge([clips.filter(F.col("category") == c) for c in ("NEWS", "MONEY", "TECH", "URGENT")]).select("idx", "url", "views")


@query("""WITH calls AS (SELECT conv_id % 2 = 0 AS main, CASE WHEN role = 'assistant' THEN 0 ELSE length(text) END AS t_in, CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS t_out FROM conversations)
SELECT count(*) AS calls, sum(t_in)::BIGINT AS tokens_in, sum(t_out)::BIGINT AS tokens_out,
round(sum(CASE WHEN main THEN 0.10::DOUBLE ELSE 0.03::DOUBLE END * t_in + CASE WHEN main THEN 0.40::DOUBLE ELSE 0.30::DOUBLE END * t_out) / 1000000, 9) AS usd FROM calls""")
def run_cost(spark, sf_dir):
    size, answer = F.length("text"), F.col("role") == "assistant"
    calls = table(spark, sf_dir, "conversations").select((F.col("conv_id") % 2 == 0).alias("main"), F.when(answer, 0).otherwise(size).alias("tokens_in"), F.when(answer, size).otherwise(0).alias("tokens_out"))
    return desk.run_cost(calls)


@query(r"""SELECT doc_id, CASE WHEN length(text) <= 1300 THEN text WHEN length(whole) > 151 THEN whole ELSE left(text, 1300) END AS cut, len(parts)::INT AS n, parts[1] AS opening, parts[-1] AS closing
FROM (SELECT doc_id, text, regexp_extract(left(text, 1300), '(?s)^(.*[а-яёa-z]{3,}[.!?][\s\x{a0}])', 1) AS whole,
list_filter(list_transform(regexp_extract_all(coalesce(text, '') || ' ', '(?s)(.*?(?:[а-яёa-zà-ú\d]{2,}[.!?][\s\x{a0}]+|\z))', 1), lambda x: regexp_replace(x, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')), lambda x: x <> '') AS parts FROM documents)""")
def text_sentences(spark, sf_dir):
    """Texts cut at a sentence, and how many sentences they hold, with the first and the last."""
    parts = table(spark, sf_dir, "documents").select("doc_id", X.sentence_cut(F.col("text")).alias("cut"), X.sentences(F.col("text")).alias("parts"))
    return parts.select("doc_id", "cut", F.size("parts").alias("n"), F.try_element_at("parts", F.lit(1)).alias("opening"), F.try_element_at("parts", F.lit(-1)).alias("closing"))
