"""The quality gate: ordered drops, repairs and notes as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W

HOUR = 3_600_000


def drop_junk_lines(text: Column) -> Column:
    """Texts without service lines, and without the two service phrases that stand inside lines."""
    pattern = "^(" + "|".join(W.JUNK_LINES) + ")$"
    within = F.regexp_replace(F.coalesce(text, F.lit("")), "(?iu)" + "|".join(W.JUNK_PHRASES), "")
    lines = F.filter(F.split(within, "\n", -1), lambda line: ~F.lower(line).rlike(pattern))
    return F.trim(F.array_join(lines, "\n"))


def drop_leading_title(title: Column, body: Column) -> Column:
    """The body without the title at its start (judged by the first 40 characters)."""
    same = (F.length(title) > 0) & F.startswith(F.lower(body), F.lower(F.substring(title, 1, 40)))
    whole = F.startswith(F.lower(body), F.lower(title))
    return F.when(same & whole, F.ltrim(F.regexp_replace(F.substring(body, F.length(title) + 1, F.length(body)), r"^[ .:—–-]+", ""))).otherwise(body)


def drop_inner_title(title: Column, body: Column) -> Column:
    """The body without the first place where all words of a title (of at least four) stand in a row.

    Words are compared in lower case and without marks. A body that loses its
    title has single spaces; others stay as they are.
    """
    bare = lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}_]", ""))
    split = lambda text: F.filter(F.split(F.coalesce(text, F.lit("")), r"[\s\u00a0]+", -1), lambda w: w != "")

    def cut(both: Column) -> Column:
        wanted, words, plain = both["wanted"], both["words"], both["plain"]
        n = F.size(wanted)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: (F.get(plain, i - 1) == F.get(wanted, F.lit(0))) & (F.slice(plain, i, n) == wanted))
        at = F.get(starts, F.lit(0))
        rest = F.concat(F.slice(words, F.lit(1), at - 1), F.slice(words, at + n, F.size(words)))
        return F.when((n > 0) & at.isNotNull(), F.array_join(rest, " ")).otherwise(body)

    def worth(wanted: Column) -> Column:
        # Without spaces and marks, a body that has the words in a row has them as one string.
        plain = lambda t: F.translate(F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}_]+", "")), "ς", "σ")
        return F.contains(plain(F.coalesce(body, F.lit(""))), F.translate(F.array_join(wanted, ""), "ς", "σ"))

    words = split(body)
    parts = F.struct(F.filter(F.transform(split(title), bare), lambda w: w != "").alias("wanted"), words.alias("words"), F.transform(words, bare).alias("plain"))
    wanted = F.filter(F.transform(split(title), bare), lambda w: w != "")
    return F.when((F.size(split(title)) >= 4) & X.bound(wanted, worth), X.bound(parts, cut)).otherwise(body)


def stub(body: Column) -> Column:
    return X.any_of(F.lower(body), W.STUBS)


def shortfall(as_of_ms: int) -> Column:
    """Why an item falls below the standard, or null."""
    body = F.length(F.trim(F.coalesce("summary", F.lit(""))))
    return (
        F.when(F.length(F.trim(F.coalesce("title", F.lit("")))) < 25, "short title")
        .when((body < 40) & ~F.coalesce(F.col("notifyOnly"), F.lit(False)), "no text")
        .when(~F.coalesce(F.col("url"), F.lit("")).startswith("http"), "no address")
        .when(F.col("publishedAt") > as_of_ms + 3 * HOUR, "from the future")
        .when(F.col("publishedAt") < as_of_ms - 36 * HOUR, "too old")
    )


def no_text_gate(items: DataFrame, least: int = 40) -> DataFrame:
    """Items without text stay for notification only if they are urgent or important."""
    bare = F.length(F.trim(F.coalesce("summary", F.lit("")))) < least
    return items.withColumn("notifyOnly", bare).filter(~F.col("notifyOnly") | (F.col("category") == "URGENT") | (F.col("priority") >= 2))


def age_cut(items: DataFrame, as_of_ms: int, days: int = 30) -> DataFrame:
    return items.filter(F.col("publishedAt") >= as_of_ms - days * 24 * HOUR)


def gate(items: DataFrame, as_of_ms: int, ad_urls: DataFrame | None = None) -> DataFrame:
    """All rows with repaired title, summary and category, and ``drop_reason`` (null: kept); the first reason counts."""
    if "notifyOnly" not in items.columns:
        items = items.withColumn("notifyOnly", F.lit(False))
    if "origTitle" not in items.columns:
        items = items.withColumns({"origTitle": F.lit(None).cast("string"), "origSummary": F.lit(None).cast("string")})
    ad = F.lit(False)
    if ad_urls is not None:
        items = items.join(ad_urls.select(F.col("url").alias("ad_url")).distinct(), F.col("url") == F.col("ad_url"), "left")
        ad = F.col("ad_url").isNotNull()
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    early = (
        F.when(stub(F.col("summary")), "stub")
        .when(ad, "advertisement")
        .when(X.daily_filler(F.col("title")) | X.daily_filler(F.col("origTitle")), "daily filler")
        .when(low("title").rlike(W.WEATHER) | low("origTitle").rlike(W.WEATHER), "weather")
        .when(low("summary").rlike(W.VIDEO_CAPTION) | low("origSummary").rlike(W.VIDEO_CAPTION), "video caption")
    )
    title = F.trim(F.coalesce("title", F.lit("")))
    body = X.strip_tail(drop_junk_lines(F.col("summary")))
    body = X.bound(body, lambda b: drop_leading_title(title, b))
    body = X.bound(body, lambda b: drop_inner_title(title, b))
    fixed = (
        items.withColumn("early", early)
        .withColumn("summary", body)
        .withColumn("category", F.when((F.col("category") == "URGENT") & (F.col("priority") < 2), "NEWS").otherwise(F.col("category")))
        .withColumn("title", X.title_tail(title))
    )
    notes = F.array_compact(F.array(F.when(F.length("title") > 200, "long title"), F.when(F.col("scope").isNull(), "no scope"), F.when(F.length(F.coalesce("imageUrl", F.lit(""))) == 0, "no photo")))
    return fixed.withColumn("drop_reason", F.coalesce("early", shortfall(as_of_ms))).withColumn("notes", notes).withColumn("scope", F.coalesce("scope", F.lit("world"))).drop("early", "ad_url")


def gate_counts(gated: DataFrame) -> DataFrame:
    return gated.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
