"""Queries over texts that need polishing, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W
from presslens.plans.feed import _items, _with, query
from presslens.sources.items import ITEMS_SQL

#: What publishers put before texts, by the category and source of an item.
DATELINE, CITY, SLASHED, NEWSROOM = "Aug. 21 (UPI) -- ", "Madrid, 20 ago (EFE).- ", "Bishkek, 21.08.26 /Kabar/. ", "Redacción Deportes, 21 ago (EFE).- "
CREDITED, CAPTION, CHART = "View of a plant on Monday. (Photo by Getty Images). ", "Rider is seen at the start. ", "Data: Bureau; Chart: Axios Visuals "


def _raw(spark, sf_dir) -> DataFrame:
    """Bodies with what their publishers add: date lines by category, captions by the length of the title, teasers by scope."""
    n, kind = F.length("title"), F.col("category")
    start = F.when(kind == "MONEY", DATELINE + CITY).when(kind == "TECH", CITY).when(kind == "URGENT", SLASHED).when(F.col("priority") == 2, NEWSROOM).otherwise("")
    caption = F.when(n % 5 == 0, CREDITED).when(n % 5 == 1, CAPTION).when(n % 5 == 2, CHART).otherwise("")
    body = F.when(F.col("scope") == "local", F.substring("summary", 1, 400)).when(F.col("scope") == "pool", F.concat("summary", F.lit(" Read more..."))).otherwise(F.col("summary"))
    return _items(spark, sf_dir).select("idx", F.concat(start, caption, body).alias("text"))


def _replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by}')"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g')"


def _layers(text: str) -> str:
    for _ in range(3):
        for pattern in W.DATELINES:
            text = _replace(text, pattern)
        text = f"trim({text}, ' —-–·|')"
    return text


_RAW = f"""SELECT idx, CASE WHEN category = 'MONEY' THEN '{DATELINE + CITY}' WHEN category = 'TECH' THEN '{CITY}' WHEN category = 'URGENT' THEN '{SLASHED}' WHEN priority = 2 THEN '{NEWSROOM}' ELSE '' END
    || CASE length(title) % 5 WHEN 0 THEN '{CREDITED}' WHEN 1 THEN '{CAPTION}' WHEN 2 THEN '{CHART}' ELSE '' END
    || CASE scope WHEN 'local' THEN left(summary, 400) WHEN 'pool' THEN summary || ' Read more...' ELSE summary END AS text FROM items"""
_HAS_CREDIT = "regexp_matches(p, '" + W.CREDIT + "')"


@query(_with(ITEMS_SQL) + f""", raw AS ({_RAW}),
bare AS (SELECT idx, {_replace(_layers(_strip("coalesce(text, '')")), W.CHART_LINE)} AS text FROM raw),
cut AS (SELECT idx, list_filter(list_transform(regexp_extract_all(text || ' ', '(?s)(.*?(?:[а-яёa-zà-ú\\d]{{2,}}[.!?][\\s\\x{{a0}}]+|\\z))', 1), lambda x: {_strip("x")}), lambda x: x <> '') AS parts FROM bare),
marked AS (SELECT *, coalesce(list_max(list_transform(parts[1:3], lambda p, i: CASE WHEN {_HAS_CREDIT} THEN i ELSE 0 END)), 0) AS credit FROM cut),
placed AS (SELECT *, CASE WHEN credit > 0 THEN credit WHEN len(parts) > 1 AND length(parts[1]) < 220 AND regexp_matches(parts[1], '{W.CAPTION_VERBS}') THEN 1 ELSE 0 END AS at FROM marked),
joined AS (SELECT idx, {_strip("regexp_replace(array_to_string(CASE WHEN at < len(parts) THEN parts[at + 1:] ELSE parts END, ' '), '[\\s\\x{a0}]{2,}', ' ', 'g')")} AS text FROM placed),
calm AS (SELECT idx, {_strip(_replace("text", W.TEASERS))} AS text FROM joined),
ends AS (SELECT *, regexp_extract(text, '([^\\s\\x{{a0}}]+)$', 1) AS last, regexp_extract(text || ' ', '(?s)^(.*[а-яёa-zà-ú]{{3,}}[.!?])[\\s\\x{{a0}}]', 1) AS whole FROM calm),
hung AS (SELECT *, text <> '' AND NOT regexp_matches(text, '[.!?…»"'']$') AS open, length(trim(last, '.,')) <= 2 OR lower(last) IN ({", ".join(f"'{w}'" for w in W.HANGING)}) AS hangs FROM ends)
SELECT idx, {_strip("CASE WHEN open AND hangs AND length(whole) >= 80 THEN whole WHEN open AND NOT hangs THEN text || '.' ELSE text END")} AS text FROM hung""".replace(" AS at FROM", " AS cut_at FROM").replace("CASE WHEN at < len(parts) THEN parts[at + 1:]", "CASE WHEN cut_at < len(parts) THEN parts[cut_at + 1:]"))
def polished(spark, sf_dir):
    """Bodies without date lines, credits, captions and teasers, ended where they are whole."""
    return _raw(spark, sf_dir).select("idx", X.polish(F.col("text")).alias("text"))
