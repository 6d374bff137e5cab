"""A judge's answers: JSON by chunk of numbered items, checked and applied.

Items of a pool are numbered in order of arrival in chunks. The answer to a
chunk names items by their numbers, from 1. An answer counts as a whole or not at
all: if it is missing, isn't JSON, or holds a value of the wrong kind, its chunk
keeps its better half by plain score, and nothing of its pool's run is
remembered. Numbers that the chunk doesn't have are passed over, a number that is
kept twice counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W
from presslens.operators.route import demote_foreign_local
from presslens.operators.select import in_order, numbered

CHUNK = 60
EXPIRY_MS = 75 * 60_000
LISTS = ("keep", "urgent", "important", "ad_suspects", "title_mismatch")
ANSWER = ", ".join(f"{c} array<int>" for c in LISTS) + ", recategorize map<string,string>, scope_fix map<string,string>, broken string"


def unfenced(text: Column) -> Column:
    """What stands between the first two code fences, without the word json; all of a text without fences."""
    inner = F.btrim(F.replace(F.get(F.split(text, "```", -1), F.lit(1)), F.lit("json"), F.lit("")), F.lit(" \t\r\n"))
    return F.when(F.contains(text, F.lit("```")), inner).otherwise(text)


def in_chunks(items: DataFrame, size: int = CHUNK) -> DataFrame:
    """``pool, idx, chunk, n, held``: each item's chunk, its number there from 1, and how many the chunk holds."""
    placed = numbered(in_order(items.select("pool", "idx"), F.col("pool"), F.col("idx")), "nth", "pool")
    chunked = placed.select("pool", "idx", F.floor((F.col("nth") - 1) / size).alias("chunk"), ((F.col("nth") - 1) % size + 1).cast("int").alias("n"))
    return chunked.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("pool", "chunk")))  # ``size`` rows


def answers_read(answers: DataFrame) -> DataFrame:
    """``a_pool, a_chunk, answer, good`` of answers (pool, chunk, text)."""
    answer = F.from_json(unfenced(F.col("text")), ANSWER, {"columnNameOfCorruptRecord": "broken"})
    whole_keys = lambda m: F.coalesce(F.forall(F.map_keys(m), lambda k: k.rlike(r"^\s*[+-]?\d{1,9}\s*$")), F.lit(True))
    read = answers.select(F.col("pool").alias("a_pool"), F.col("chunk").alias("a_chunk"), answer.alias("answer"))
    kind = F.col("answer").isNotNull() & F.col("answer.broken").isNull() & whole_keys(F.col("answer.recategorize")) & whole_keys(F.col("answer.scope_fix"))
    full = lambda c: ~F.coalesce(F.exists(F.col(f"answer.{c}"), lambda x: x.isNull()), F.lit(False))
    for c in LISTS:
        kind = kind & full(c)
    return read.withColumn("good", kind)


def _says(column: str) -> Column:
    return F.coalesce(F.array_contains(F.col(f"answer.{column}"), F.col("n")), F.lit(False))


def judged(items: DataFrame, answers: DataFrame, score: Column, size: int = CHUNK) -> DataFrame:
    """A row for every item: ``kept``, what the answer says of it, and whether its chunk fell back.

    ``pool, idx, chunk, n, kept, fell_back, remembered, urgent, important, ad_suspect, new_category, new_scope, pos``.
    """
    numbers = in_chunks(items, size).join(items.select("pool", "idx", score.alias("score")), ["pool", "idx"])
    joined = numbers.join(answers_read(answers), (F.col("pool") == F.col("a_pool")) & (F.col("chunk") == F.col("a_chunk")), "left")
    good = F.coalesce("good", F.lit(False))
    better = F.row_number().over(Window.partitionBy("pool", "chunk").orderBy(F.desc("score"), "idx"))  # ``size`` rows
    marked = joined.withColumn("better", better).withColumn("fell_back", ~good)
    failed = marked.groupBy(F.col("pool").alias("f_pool")).agg(F.max("fell_back").alias("failed"))  # a row a pool
    said = lambda m: F.try_element_at(F.col(f"answer.{m}"), F.col("n").cast("string"))
    half = F.expr("better <= greatest(1, held div 2)")
    scope = said("scope_fix")
    return marked.join(failed, F.col("pool") == F.col("f_pool")).select(
        "pool", "idx", "chunk", "n",
        F.when(good, _says("keep") & ~_says("title_mismatch")).otherwise(half).alias("kept"),
        "fell_back", (~F.col("failed")).alias("remembered"),
        *[(good & _says(c)).alias(name) for c, name in (("urgent", "urgent"), ("important", "important"), ("ad_suspects", "ad_suspect"))],
        F.when(good, said("recategorize")).alias("new_category"), F.when(good & scope.isin("local", "pool", "world"), scope).alias("new_scope"),
        F.when(good, F.array_position("answer.keep", F.col("n"))).otherwise(F.col("better")).cast("int").alias("pos"),
    )


def allowed_category(own: Column, new: Column, title: Column, keywords: dict[str, tuple[str, ...]]) -> Column:
    """Whether a source of category ``own`` may be refiled: within its lock, and with a keyword where the new shelf asks for one."""
    lock = F.lit(True)
    for category, others in W.CATEGORY_LOCK.items():
        lock = F.when(own == category, F.lit(True) if others is None else new.isin(*others)).otherwise(lock)
    named = F.lit(True)
    for category in W.CATEGORY_NAMED:
        has = X.any_of(F.lower(title), tuple(k.lower() for k in keywords[category])) if keywords.get(category) else F.lit(False)
        named = F.when(new == category, has).otherwise(named)
    return F.coalesce(lock & named, F.lit(False))


def apply(items: DataFrame, verdicts: DataFrame, as_of_ms: int, keywords: dict[str, tuple[str, ...]]) -> DataFrame:
    """The kept items with their verdicts applied, in this order: importance, service formats, category, urgency, adverts, shelf.

    ``items`` have ``bridge``, ``home`` and ``near`` (their address is one of the
    pool's space). What the order of the feed needs is in ``chunk`` and ``pos``.
    Items whose chunk fell back stay as they are.
    """
    v = verdicts.filter("kept").select(F.col("pool").alias("v_pool"), F.col("idx").alias("v_idx"), "chunk", "pos", "fell_back", "urgent", "important", "ad_suspect", "new_category", "new_scope")
    joined = items.join(v, (F.col("pool") == F.col("v_pool")) & (F.col("idx") == F.col("v_idx")))
    judged_ = ~F.col("fell_back")
    raised = F.when(F.col("urgent"), 2).when(F.col("important"), 1).otherwise(F.col("priority"))
    service = X.service_format(F.col("url"), F.col("title")) & ((raised >= 2) | (F.col("category") == "URGENT"))
    out = joined.withColumn("own_category", F.col("category")).withColumn("priority", F.when(judged_ & service, 0).otherwise(raised))
    category = F.when(service & (F.col("own_category") == "URGENT"), "NEWS").otherwise(F.col("own_category"))
    refile = F.col("new_category").isNotNull() & allowed_category(F.col("own_category"), F.col("new_category"), F.col("title"), keywords)
    category = F.when(refile, F.col("new_category")).otherwise(category)
    out = out.withColumn("category", F.when(judged_, category).otherwise(F.col("own_category")))
    out = out.withColumn("category", F.when(judged_ & (F.col("category") == "URGENT") & (F.col("priority") < 2), "NEWS").otherwise(F.col("category")))
    bridge, home = F.coalesce("bridge", F.lit(False)), F.coalesce("home", F.lit(False))
    first = demote_foreign_local(F.col("scope"), bridge, home, F.col("near"))
    fixed = F.when((F.col("new_scope") == "local") & ~bridge & ~home, first).otherwise(F.coalesce("new_scope", first))
    out = out.withColumn("scope", F.when(judged_, fixed).otherwise(F.col("scope")))
    out = out.withColumn("expiresAt", F.when(F.col("ad_suspect"), F.lit(as_of_ms + EXPIRY_MS)))
    return out.drop("v_pool", "v_idx", "urgent", "important", "ad_suspect", "new_category", "new_scope", "own_category")


def memory_rows(items: DataFrame, verdicts: DataFrame, as_of_ms: int, rules: int) -> DataFrame:
    """``pool, key, keep, ts, rules`` to remember: all items of runs of which every chunk was judged."""
    asked = verdicts.filter("remembered").select(F.col("pool").alias("v_pool"), F.col("idx").alias("v_idx"), "kept")
    joined = items.join(asked, (F.col("pool") == F.col("v_pool")) & (F.col("idx") == F.col("v_idx")))
    key = X.cache_key(F.col("url"), F.col("title"))
    return joined.groupBy("pool", key.alias("key")).agg(F.max("kept").alias("keep")).withColumns({"ts": F.lit(as_of_ms), "rules": F.lit(rules)})
