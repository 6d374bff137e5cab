"""Queries over feeds as their publishers send them, and titles repeated in texts, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import words as W
from presslens.operators import gate
from presslens.plans.feed import _items, _like, _with, query, stripped_sql
from presslens.sources import items as S
from presslens.sources.items import AS_OF_MS, ITEMS_SQL

QUOTA = 40
LOWER = "abcdefghijklmnopqrstuvwxyz"
ONLY_RUSSIAN = ("src6",)


def _escaped(text):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _feeds(spark, sf_dir) -> DataFrame:
    """One feed a source, with its items in order of arrival: entities in titles, bodies in either element, pictures of every kind, broken dates and one broken feed."""
    n, kind = F.col("idx"), F.col("category")
    tag = lambda name, inner: F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))
    title = _escaped(F.concat(F.when(kind == "TECH", "Caf&eacute; &#8212; ").when(kind == "MONEY", "Пленарное заседание ").otherwise(""), F.coalesce("title", F.lit(""))))
    body = _escaped(F.concat(F.lit("<p class=\"a>b\">"), F.when(kind == "TECH", F.concat("title", F.lit(" - "))).otherwise(""), F.coalesce(F.substring("summary", 1, 900), F.lit("")), F.lit("</p>&nbsp;")))
    date = F.date_format(F.timestamp_millis("publishedAt"), "EEE, d MMM yyyy HH:mm:ss")
    when = F.when(F.length("title") % 7 == 0, "").when(F.length("title") % 7 == 1, "<pubDate>soon</pubDate>").otherwise(tag("pubDate", F.concat(date, F.lit(" GMT"))))
    base = F.concat(F.lit("https://cdn.example/"), n.cast("string"))
    picture = (
        F.when(F.col("scope") == "local", F.concat(F.lit('<enclosure type="image/jpeg" url="'), base, F.lit('"/>')))
        .when(F.col("scope") == "pool", F.concat(F.lit('<media:thumbnail url="'), base, F.lit('-s.jpg"/><media:content url="'), base, F.lit('.jpg" width="'), (n % 1200).cast("string"), F.lit('"/><media:content medium="video" url="'), base, F.lit('.mp4" width="9999"/>')))
        .when(kind == "URGENT", F.concat(F.lit('<enclosure type="audio/mpeg" url="'), base, F.lit('"/><media:thumbnail url="'), base, F.lit('-1024.png"/>')))
        .otherwise("")
    )
    text = F.when(F.col("priority") == 2, tag("content:encoded", body)).otherwise(tag("description", body))
    item = tag("item", F.concat(tag("title", title), tag("link", F.concat(F.lit(" "), "url", F.lit(" "))), when, text, picture))
    rows = _items(spark, sf_dir).filter("source IS NOT NULL").select("source", F.struct("idx", item.alias("item")).alias("e"))
    feeds = rows.groupBy("source").agg(F.slice(F.array_sort(F.collect_list("e")), 1, 2 * QUOTA).alias("entries"))  # what one feed lists
    xml = F.concat(F.lit('<rss xmlns:media="m" xmlns:content="c"><channel>'), F.array_join("entries.item", ""), F.when(F.col("source") == "src8", "</rss>").otherwise("</channel></rss>"))
    lang = F.when(F.col("source").isin("src1", "src2"), "ru").when(F.col("source") == "src3", "es")
    return feeds.select("source", F.lit(QUOTA).alias("quota"), F.lit("NEWS").alias("category"), F.lit(0).alias("priority"), F.lit("world").alias("scope"), lang.alias("lang"), F.when(F.col("source") == "src2", "uz").alias("native"), xml.alias("xml"))


_CLEAN = lambda x: f"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '<[a-zA-Z/!][^<>"]*(?:"[^"]*"[^<>"]*)*>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '{W.ORPHAN_ATTRIBUTES}', '\\1 ', 'g'), '\\s*/?>\\s*', ' ', 'g'), '\\s+', ' ', 'g'))"""
_SUMMARY = "CASE WHEN length(body) <= 600 THEN body WHEN length(e1) > 100 THEN e1 || '.' WHEN length(e2) > 100 THEN e2 || '!' WHEN length(e3) > 100 THEN e3 || '?' ELSE left(body, 600) END"


@query(_with(ITEMS_SQL) + f""", listed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY idx) AS nth FROM items WHERE source IS NOT NULL AND source <> 'src8'
), taken AS (
  SELECT *, {_CLEAN("CASE category WHEN 'TECH' THEN 'Café — ' WHEN 'MONEY' THEN 'Пленарное заседание ' ELSE '' END || coalesce(title, '')")} AS said,
    {_CLEAN("'<p class=\"a>b\">' || CASE WHEN category = 'TECH' THEN title || ' - ' ELSE '' END || coalesce(left(summary, 900), '') || '</p> '")} AS text FROM listed WHERE nth <= {QUOTA}
), texts AS (SELECT idx, text FROM taken), {stripped_sql("texts")},
bodies AS (
  SELECT t.*, CASE WHEN starts_with(s.text, said) THEN ltrim(substr(s.text, length(said) + 1), ' .,—-') ELSE s.text END AS body FROM taken t JOIN stripped s ON s.idx = t.idx
  WHERE said <> '' AND NOT {_like("lower(said)", W.BORING)} AND (source <> '{ONLY_RUSSIAN[0]}' OR len(regexp_extract_all(said, '[Ѐ-ӿ]')) * 2 > len(regexp_extract_all(said, '[A-Za-z]')))
), cut AS (
  SELECT *, regexp_extract(left(body, 600), '(?s)^(.*)\\. ', 1) AS e1, regexp_extract(left(body, 600), '(?s)^(.*)! ', 1) AS e2, regexp_extract(left(body, 600), '(?s)^(.*)\\? ', 1) AS e3 FROM bodies
), made AS (
  SELECT *, trim({_SUMMARY}) AS short, CASE scope WHEN 'pool' THEN idx % 1200 END AS width FROM cut
), told AS (
  SELECT *, said || ' ' || short AS whole, CASE WHEN source IN ('src1', 'src2') THEN 'ru' WHEN source = 'src3' THEN 'es' END AS lang FROM made
), heard AS (
  SELECT *, CASE WHEN len(regexp_extract_all(whole, '[Ѐ-ӿ]')) * 5 > length(whole) THEN 'ru' WHEN len(regexp_extract_all(whole, '[؀-ۿ]')) * 5 > length(whole) THEN 'ar' WHEN len(regexp_extract_all(whole, '[A-Za-z]')) * 10 > length(whole) * 3 THEN 'en' ELSE 'other' END AS detected FROM told
)
SELECT source, url, said AS title, short AS summary,
  CASE WHEN scope = 'local' THEN 'https://cdn.example/' || idx WHEN scope = 'pool' THEN 'https://cdn.example/' || idx || CASE WHEN width BETWEEN 1 AND 99 THEN '-s.jpg' ELSE '.jpg' END WHEN category = 'URGENT' THEN 'https://cdn.example/' || idx || '-1024.png' END AS "imageUrl",
  scope = 'pool' AND (CASE WHEN width BETWEEN 1 AND 99 THEN 100 WHEN width = 0 THEN 400 ELSE width END) < 600 AND NOT contains(idx::VARCHAR, '1024') AS "imageLowRes",
  CASE WHEN length(title) % 7 IN (0, 1) THEN {AS_OF_MS} ELSE "publishedAt" // 1000 * 1000 END AS "publishedAt",
  CASE WHEN source = 'src2' THEN 'uz' WHEN coalesce(lang, detected) IN ('ru') AND len(regexp_extract_all(said || short, '[а-яёА-ЯЁ]')) < 3 AND len(regexp_extract_all(said || short, '[A-Za-z]{{3,}}')) >= 5 THEN CASE WHEN detected = 'other' THEN 'en' ELSE detected END ELSE coalesce(lang, detected) END AS language
FROM heard""")
def feed_items(spark, sf_dir):
    """Items read from one feed a source."""
    return S.rss_items(_feeds(spark, sf_dir), AS_OF_MS, ONLY_RUSSIAN).select("source", "url", "title", "summary", "imageUrl", "imageLowRes", "publishedAt", "language")


_TOKENS = "list_filter(string_split_regex(coalesce({0}, ''), '[\\s\\x{{a0}}]+'), lambda x: x <> '')"
_BARE = "list_transform({0}, lambda x: lower(regexp_replace(x, '[^\\p{{L}}\\p{{N}}_]', '', 'g')))"


@query(_with(ITEMS_SQL) + f""", given AS (SELECT idx, summary AS body, {_TOKENS.format("summary")} AS w FROM items),
titled AS (SELECT *, CASE WHEN idx % 3 = 0 THEN 'no such words here' ELSE translate(array_to_string(w[6:10], ', '), '{LOWER}', '{LOWER.upper()}') END AS title FROM given),
parts AS (SELECT *, list_filter({_BARE.format(_TOKENS.format("title"))}, lambda x: x <> '') AS wanted, {_BARE.format("w")} AS plain FROM titled),
found AS (SELECT *, len({_TOKENS.format("title")}) >= 4 AND len(wanted) > 0 AS long, list_filter(range(1, greatest(len(w) - len(wanted) + 2, 1)), lambda i: plain[i] = wanted[1] AND plain[i:i + len(wanted) - 1] = wanted)[1] AS at FROM parts)
SELECT idx, CASE WHEN long AND found.at IS NOT NULL THEN array_to_string(list_concat(w[1:found.at - 1], w[found.at + len(wanted):]), ' ') ELSE body END AS text, long AND found.at IS NOT NULL AS cut FROM found""")
def inner_titles(spark, sf_dir):
    """Texts without their title: five of their words with other marks and case, or words that they don't hold."""
    split = F.filter(F.split(F.coalesce("summary", F.lit("")), r"[\s\u00a0]+", -1), lambda w: w != "")
    title = F.when(F.col("idx") % 3 == 0, "no such words here").otherwise(F.translate(F.array_join(F.slice(split, 6, 5), ", "), LOWER, LOWER.upper()))
    given = _items(spark, sf_dir).select("idx", "summary", title.alias("title"))
    made = given.select("idx", "summary", gate.drop_inner_title(F.col("title"), F.col("summary")).alias("text"))
    return made.select("idx", "text", F.coalesce(F.col("text") != F.col("summary"), F.lit(False)).alias("cut"))
