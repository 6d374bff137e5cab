"""Queries over a judge's answers, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import words as W
from presslens.operators import judge
from presslens.plans.feed import ROUTED, SCORE, _like, _routed, _score, _with, query
from presslens.sources.items import AS_OF_MS
from presslens.shared import materialise

#: Words that shelves ask for in these queries.
KEYWORDS = {"SPORT": ("th",), "TECH": ("ou", "ic"), "CULTURE": ("an",)}
HOME, NEAR = ("https://src1.", "https://src4."), ("https://src1", "https://src7.")


def _asked(spark, sf_dir) -> DataFrame:
    """Routed items with what the judge looks at: whose address is at home or near, and who writes of a neighbour."""
    has = lambda parts: F.col("url").rlike("|".join(p.replace(".", "\\.") for p in parts))
    asked = _routed(spark, sf_dir).withColumns({"home": has(HOME), "near": has(NEAR), "bridge": F.contains("title", F.lit("un")), "chars": F.length("summary"), "score": _score()})
    return asked.select("pool", "idx", "url", "title", "category", "priority", "scope", "home", "near", "bridge", "chars", "score")


def _answers(items: DataFrame) -> DataFrame:
    """A judge that keeps texts of 300 characters, written as such judges write: fenced, with numbers that don't exist, cut short or missing."""
    numbers = judge.in_chunks(items).join(items.select("pool", "idx", "title", "chars", "category", "priority", "scope"), ["pool", "idx"])
    when = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("n"))))
    entry = lambda c, value: F.map_from_entries(F.array_sort(F.collect_list(F.when(c, F.struct(F.col("n").cast("string").alias("k"), value.alias("v"))))))
    t = F.col("title")
    said = numbers.groupBy("pool", "chunk").agg(
        when(F.col("chars") >= 300).alias("kept"),
        when((F.col("priority") == 2) & (F.col("category") != "TECH")).alias("urgent"),
        when(F.col("category") == "MONEY").alias("important"),
        when(F.contains(t, F.lit("|"))).alias("ad_suspects"),
        when((F.col("category") == "TECH") & (F.col("priority") == 2)).alias("title_mismatch"),
        entry(t.rlike("^[A-M]"), F.when(F.contains(t, F.lit("er")), "SPORT").when(F.contains(t, F.lit("en")), "TECH").otherwise("STARS")).alias("recategorize"),
        entry(F.length(t) % 3 == 0, F.when(F.contains(t, F.lit("st")), "local").when(F.contains(t, F.lit("ta")), "galaxy").otherwise("pool")).alias("scope_fix"),
    )
    keep = F.concat(F.array(F.lit(0)), F.reverse("kept"), F.array(F.lit(999)), F.slice("kept", 1, 2))
    json = F.to_json(F.struct(keep.alias("keep"), "urgent", "important", "ad_suspects", "title_mismatch", "recategorize", "scope_fix"))
    text = F.when(F.col("pool").isin("en") & (F.col("chunk") % 3 == 1), F.substring(json, F.lit(1), F.length(json) - 9)).when(F.col("chunk") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), json, F.lit("\n```\nDone."))).otherwise(json)
    return said.filter("NOT (pool = 'es' AND chunk = 0)").select("pool", "chunk", text.alias("text"))


def _judged(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items = materialise(_asked(spark, sf_dir), "judge-items")
    return items, judge.judged(items, _answers(items), F.col("score"))


JUDGED = ROUTED + f""",
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY pool ORDER BY idx) - 1) // {judge.CHUNK} AS chunk, ((row_number() OVER (PARTITION BY pool ORDER BY idx) - 1) % {judge.CHUNK} + 1)::INT AS n,
    {_like('url', HOME)} AS home, {_like('url', NEAR)} AS near, contains(title, 'un') AS bridge, {SCORE} AS score FROM routed
), ranked AS (
  SELECT *, (pool = 'en' AND chunk % 3 = 1) OR (pool = 'es' AND chunk = 0) AS fell_back, row_number() OVER (PARTITION BY pool, chunk ORDER BY score DESC, idx) AS better, count(*) OVER (PARTITION BY pool, chunk) AS held,
    length(summary) >= 300 AND NOT (category = 'TECH' AND priority = 2) AS fit, row_number() OVER (PARTITION BY pool, chunk, length(summary) >= 300 ORDER BY n DESC) + 1 AS kept_as FROM numbered
), judged AS (
  SELECT *, coalesce(CASE WHEN fell_back THEN better <= greatest(1, held // 2) ELSE fit END, false) AS kept, NOT bool_or(fell_back) OVER (PARTITION BY pool) AS remembered,
    CASE WHEN regexp_matches(title, '^[A-M]') THEN CASE WHEN contains(title, 'er') THEN 'SPORT' WHEN contains(title, 'en') THEN 'TECH' ELSE 'STARS' END END AS new_category,
    CASE WHEN length(title) % 3 = 0 THEN CASE WHEN contains(title, 'st') THEN 'local' WHEN contains(title, 'ta') THEN NULL ELSE 'pool' END END AS new_scope,
    CASE WHEN priority = 2 AND category <> 'TECH' THEN 2 WHEN category = 'MONEY' THEN 1 ELSE priority END AS raised FROM ranked
)"""


@query(_with(JUDGED) + f""", steps AS (
  SELECT *, ({_like('lower(url)', W.SERVICE_URLS)} OR {_like('lower(title)', W.SERVICE_TITLES)}) AND (raised >= 2 OR category = 'URGENT') AS service,
    CASE WHEN scope = 'local' AND NOT bridge AND NOT home THEN CASE WHEN near THEN 'pool' ELSE 'world' END ELSE scope END AS first FROM judged WHERE kept
), filed AS (
  SELECT *, CASE WHEN service THEN 0 ELSE raised END AS importance,
    CASE WHEN new_category IS NOT NULL AND (category NOT IN ('TECH', 'MONEY') OR (category = 'TECH' AND new_category = 'TECH') OR (category = 'MONEY' AND new_category = 'TECH'))
        AND CASE new_category WHEN 'SPORT' THEN contains(lower(title), 'th') WHEN 'TECH' THEN contains(lower(title), 'ou') OR contains(lower(title), 'ic') ELSE true END THEN new_category
      WHEN service AND category = 'URGENT' THEN 'NEWS' ELSE category END AS shelf FROM steps
)
SELECT idx, pool, chunk::BIGINT AS chunk, (CASE WHEN fell_back THEN better ELSE kept_as END)::INT AS pos, fell_back,
  CASE WHEN fell_back THEN priority ELSE importance END AS priority,
  CASE WHEN fell_back THEN category WHEN shelf = 'URGENT' AND importance < 2 THEN 'NEWS' ELSE shelf END AS category,
  CASE WHEN fell_back THEN scope WHEN new_scope = 'local' AND NOT bridge AND NOT home THEN first ELSE coalesce(new_scope, first) END AS scope,
  CASE WHEN NOT fell_back AND contains(title, '|') THEN {AS_OF_MS + judge.EXPIRY_MS} END AS "expiresAt"
FROM filed""")
def judged_items(spark, sf_dir):
    """Items that a judge keeps, with what its answers change; chunks with a broken answer keep their better half."""
    items, verdicts = _judged(spark, sf_dir)
    return judge.apply(items, verdicts, AS_OF_MS, KEYWORDS).select("idx", "pool", "chunk", "pos", "fell_back", "priority", "category", "scope", "expiresAt")


@query(_with(JUDGED) + f"""SELECT pool, right(translate(url, './#$[]', '______'), 180) AS key, bool_or(kept) AS keep, {AS_OF_MS} AS ts, 7 AS rules FROM judged WHERE remembered GROUP BY ALL""")
def judge_memory(spark, sf_dir):
    """What is remembered of the runs: all or nothing of a pool."""
    items, verdicts = _judged(spark, sf_dir)
    return judge.memory_rows(items, verdicts, AS_OF_MS, 7)
