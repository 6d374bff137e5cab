"""Items: the feed rows that every operator takes, read from tables or feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions import text as X
from presslens.functions import words as W
from presslens.shared import table

#: The moment at which the tested queries run.
AS_OF_MS = 1_706_659_200_000
ITEM = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "url", "summary", "imageUrl", "source", "category", "scope", "language", "source_lang")]
    + [T.StructField("priority", T.IntegerType()), T.StructField("publishedAt", T.LongType()), T.StructField("idx", T.LongType())]
)


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items; event types stand for categories and labels for priorities."""
    docs, events, labels = (table(spark, sf_dir, t) for t in ("documents", "events", "labels"))
    # Titles are made before the joins, so texts are joined only where a query needs them.
    docs = docs.withColumn("title", F.array_join(X.first_tokens(F.col("text"), 12), " "))
    n = F.col("doc_id")
    kind = F.col("event_type")
    return (
        docs.join(events.select("event_id", "event_type"), n == F.col("event_id"), "left")
        .join(labels.withColumnRenamed("doc_id", "label_id"), n == F.col("label_id"), "left")
        .select(
            n.alias("idx"),
            "title",
            F.concat(F.lit("https://"), "source", F.lit(".example/a/"), n.cast("string")).alias("url"),
            F.col("text").alias("summary"),
            F.when(n % 5 == 0, "").when(n % 7 == 0, F.concat(F.lit("https://cdn.example/"), "source", F.lit("/logo.png"))).otherwise(F.concat(F.lit("https://cdn.example/"), "source", F.lit("/"), n.cast("string"), F.lit(".jpg"))).alias("imageUrl"),
            "source",
            F.when(kind == "error", "URGENT").when(kind == "purchase", "MONEY").when(kind == "signup", "TECH").otherwise("NEWS").alias("category"),
            F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).when(F.col("quality") == 1, 1).otherwise(0).alias("priority"),
            F.col("lang").alias("language"),
            F.when(n % 4 != 0, F.col("lang")).alias("source_lang"),
            F.when(n % 3 == 0, "local").when(n % 3 == 1, "pool").otherwise("world").alias("scope"),
            (F.lit(AS_OF_MS) - (n * 7919 % 172800) * 1000).alias("publishedAt"),
        )
    )


ITEMS_SQL = r"""items AS (
  SELECT d.doc_id AS idx,
    array_to_string(list_slice(list_filter(string_split_regex(d.text, '[ \t\r\n]+'), lambda x: x <> ''), 1, 12), ' ') AS title,
    'https://' || d.source || '.example/a/' || d.doc_id AS url, d.text AS summary,
    CASE WHEN d.doc_id % 5 = 0 THEN '' WHEN d.doc_id % 7 = 0 THEN 'https://cdn.example/' || d.source || '/logo.png' ELSE 'https://cdn.example/' || d.source || '/' || d.doc_id || '.jpg' END AS "imageUrl",
    d.source, CASE e.event_type WHEN 'error' THEN 'URGENT' WHEN 'purchase' THEN 'MONEY' WHEN 'signup' THEN 'TECH' ELSE 'NEWS' END AS category,
    CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 2 WHEN l.quality = 1 THEN 1 ELSE 0 END AS priority,
    d.lang AS language, CASE WHEN d.doc_id % 4 <> 0 THEN d.lang END AS source_lang,
    CASE d.doc_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'pool' ELSE 'world' END AS scope,
    1706659200000 - (d.doc_id * 7919 % 172800) * 1000 AS "publishedAt"
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""


def families(spark: SparkSession) -> DataFrame:
    """Publishers that belong to one family: a bounded dimension."""
    rows = [(f"src{i}", "netA" if i < 12 else "netB") for i in range(14)]
    return spark.createDataFrame(rows, "source string, family string")


FAMILIES_SQL = """families AS (SELECT 'src' || i AS source, CASE WHEN i < 12 THEN 'netA' ELSE 'netB' END AS family FROM range(14) t(i))"""


def with_family(items: DataFrame, members: DataFrame) -> DataFrame:
    """Add ``family``: that of the source, else the source itself. ``members`` is a bounded dimension."""
    renamed = members.select(F.col("source").alias("f_source"), F.col("family").alias("f_family"))
    return items.join(F.broadcast(renamed), F.col("source") == F.col("f_source"), "left").withColumn("family", F.coalesce("f_family", "source")).drop("f_source", "f_family")


MEDIA = "array<struct<_url:string,_width:string,_type:string,_medium:string>>"
RSS = f"title string, link string, pubDate string, description string, `content:encoded` string, enclosure {MEDIA}, `media:content` {MEDIA}, `media:thumbnail` {MEDIA}"


def best_image(row: Column) -> Column:
    """An image enclosure, else the widest media entry that is a picture (400 for contents and 100 for thumbnails without a width)."""
    none = F.array().cast(MEDIA)
    enclosure = F.get(F.coalesce(row["enclosure"], none), F.lit(0))
    enclosed = F.when(F.contains(enclosure["_type"], F.lit("image")) & (F.length(enclosure["_url"]) > 0), enclosure["_url"])

    def scored(name: str, base: int) -> Column:
        pictures = F.filter(
            F.coalesce(row[name], none),
            lambda m: F.startswith(m["_url"], F.lit("http")) & (F.contains(F.lower(F.coalesce(m["_medium"], m["_type"], F.lit(""))), F.lit("image")) | F.lower(m["_url"]).rlike(r"\.(jpg|jpeg|png|webp)")),
        )
        width = lambda m: F.when(m["_width"].rlike(r"^\s*\d{1,9}\s*$") & ~m["_width"].rlike(r"^\s*0+\s*$"), F.trim(m["_width"]).cast("long")).otherwise(F.lit(base).cast("long"))
        return F.transform(pictures, lambda m, i: F.struct(width(m).alias("score"), (-i).alias("pos"), m["_url"].alias("url")))

    widest = F.array_max(F.concat(scored("media:content", 400), scored("media:thumbnail", 100)))
    low = enclosed.isNull() & (widest["score"] < 600) & ~F.contains(widest["url"], F.lit("1024"))
    return F.struct(F.coalesce(enclosed, widest["url"]).alias("url"), F.coalesce(low, F.lit(False)).alias("low"))


def russian_or_kyrgyz(text: Column) -> Column:
    """Whether there is more than half as much Cyrillic as Latin."""
    return X.count(text, X.CYRILLIC) * 2 > X.count(text, X.LATIN)


def item_language(native: Column, lang: Column, detected: Column, text: Column) -> Column:
    """The source's language, unless that is a Cyrillic one and the text is Latin; a ``native`` one always holds."""
    own = F.coalesce(lang, detected)
    latin = own.isin(*W.CYRILLIC_SOURCES) & (X.count(text, "[а-яёА-ЯЁ]") < 3) & (X.count(text, "[A-Za-z]{3,}") >= 5)
    return F.coalesce(native, F.when(latin, F.when(detected.isin("unknown", "other"), "en").otherwise(detected)).otherwise(own))


def rss_items(feeds: DataFrame, as_of_ms: int, russian_only: tuple[str, ...] = ()) -> DataFrame:
    """Items of feeds (``source, quota, category, priority, scope, lang, native, xml``): the first ``quota`` entries of each, then the title rules.

    Entries are taken before filtering, as the quota counts what the feed lists.
    A feed that isn't well-formed XML has no entries at all.
    """
    entries = F.regexp_extract_all("xml", F.lit(r"(?s)(<item[ >].*?</item>)"), F.lit(1))
    whole = F.from_xml("xml", "_corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    sound = feeds.withColumn("entries", F.when(whole["_corrupt_record"].isNull(), entries))
    parsed = sound.withColumn("item", F.explode(F.slice("entries", F.lit(1), F.greatest(F.col("quota"), F.lit(0)))))
    image = best_image(F.col("r"))
    out = parsed.withColumn("r", F.from_xml("item", RSS)).select(
        "source", "category", "priority", "scope", F.col("lang").alias("source_lang"), "native", X.clean_text(F.btrim(F.coalesce(F.col("r.title"), F.lit("")))).alias("title"), F.trim(F.coalesce(F.col("r.link"), F.lit(""))).alias("url"),
        X.strip_boilerplate(X.clean_text(F.coalesce(F.nullif(F.col("r.`content:encoded`"), F.lit("")), F.col("r.description")))).alias("body"),
        image["url"].alias("imageUrl"), image["low"].alias("imageLowRes"), F.coalesce(X.pub_date(F.col("r.pubDate")), F.lit(as_of_ms)).alias("publishedAt"),
    )
    out = out.filter((F.length("title") > 0) & ~X.any_of(F.lower("title"), W.BORING) & (~F.col("source").isin(*russian_only) | russian_or_kyrgyz(F.col("title"))))
    body = F.col("body")
    without = F.when(F.startswith(body, F.col("title")), F.ltrim(F.substring(body, F.length("title") + 1, F.length(body)), F.lit(" .,—-"))).otherwise(body)
    out = out.withColumn("summary", extract_summary(without)).drop("body")
    text = F.concat_ws(" ", "title", "summary")
    return out.withColumn("language", item_language(F.col("native"), F.col("source_lang"), X.detect_language(text), F.concat("title", "summary"))).drop("native")


def extract_summary(body: Column, size: int = 600) -> Column:
    """At most 600 characters, cut after the last full stop and space past the hundredth, else the last exclamation or question mark."""
    head = F.substring(body, 1, size)
    out = head
    for mark in (r"\.\n", r"\? ", r"! ", r"\. "):  # the last tried has the first say
        whole = F.regexp_extract(head, rf"(?s)^(.*){mark}", 1)
        out = F.when(F.length(whole) > 100, F.concat(whole, F.lit(mark.strip("\\").replace("\\n", "")[0]))).otherwise(out)
    return F.trim(F.when(F.length(body) <= size, body).otherwise(out))


def page_text(html: Column) -> Column:
    """The text of paragraphs and list items of at least 60 characters outside scripts, styles, navigation and footers."""
    body = F.regexp_replace(html, r"(?is)<(script|style|nav|footer|aside|header|form|noscript)\b.*?</\1>|<!--.*?-->", " ")
    parts = F.regexp_extract_all(body, F.lit(r"(?is)<(?:p|li)\b[^>]*>(.*?)(?=<(?:p|li|/p|/li|/ul|/article|/div|h[1-6])\b|$)"), F.lit(1))
    return F.array_join(F.array_distinct(F.filter(F.transform(parts, X.clean_text), lambda p: F.length(p) >= 60)), " ")


def page_title(html: Column) -> Column:
    return X.clean_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def page_photo(html: Column) -> Column:
    """The page's og or twitter image, else its first picture that isn't a pixel, logo or icon."""
    meta = [F.nullif(F.regexp_extract(html, rf"(?is)<meta[^>]+{name}[\"'][^>]+content=[\"']([^\"']+)", 1), F.lit("")) for name in ("og:image", "twitter:image")]
    pictures = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<img[^>]+src=[\"']([^\"']+)"), F.lit(1)), lambda u: u.startswith("http") & ~F.lower(u).rlike("logo|icon|pixel|avatar|sprite"))
    return F.coalesce(*meta, F.get(pictures, F.lit(0)))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*?href=\"([^\"]*)\""), F.lit(1))


def fx_rates(cells: DataFrame) -> DataFrame:
    """Offices' cells (office, code, buy, sell), all text -> ``code, offices, best_buy, best_sell`` of pairs whose prices are both above 0."""
    number = lambda c: F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")
    good = cells.filter(F.col("code").isin("USD", "EUR", "RUB", "CNY", "KZT")).select("code", number(F.col("buy")).alias("buy"), number(F.col("sell")).alias("sell")).filter("buy > 0 AND sell > 0")
    return good.groupBy("code").agg(F.count(F.lit(1)).alias("offices"), F.max("buy").alias("best_buy"), F.min("sell").alias("best_sell"))


def index_quotes(quotes: DataFrame) -> DataFrame:
    """``name, price, previous`` -> percent change (0 without a previous close) and the price as shown."""
    change = F.coalesce(F.try_divide((F.col("price") - F.col("previous")) * 100, F.col("previous")), F.lit(0.0))
    return quotes.withColumn("change", F.round(change, 2)).withColumn("shown", F.format_number("price", 2))


def videos(rows: DataFrame, subscribers: DataFrame, home: Column, blocked: tuple[str, ...]) -> DataFrame:
    """Trending videos: view and subscriber thresholds by region, no blocked genre, fewer than two emoji."""
    least_views, least_subs = F.when(home, 50_000).otherwise(200_000), F.when(home, 50_000).otherwise(300_000)
    calm = X.count(F.col("title"), "[\\x{1F301}-\\x{10FFFF}]") < 2
    kept = rows.filter((F.col("views") >= least_views) & calm & ~X.any_of(F.lower("title"), blocked))
    return kept.join(subscribers, "channelId").filter(F.col("subscribers") >= least_subs)


def published(rows: DataFrame, column: str = "items") -> DataFrame:
    """Rows of a feed that was stored as a list or as a map with integer keys."""
    kind = rows.schema[column].dataType
    values = F.map_values(column) if isinstance(kind, T.MapType) else F.col(column)
    return rows.select(*[c for c in rows.columns if c != column], F.posexplode(values).alias("pos", "item")).filter(F.col("item").isNotNull())
