"""Scorecards and audits over feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W


def source_scorecard(items: DataFrame, least: int = 2) -> DataFrame:
    """Per source: items, mean text, share with photo, urgent items and the share of title words that only it uses."""
    words = (
        items.select("idx", "source", F.explode(F.array_distinct(F.filter(X.tokens(F.lower("title")), lambda w: F.length(w) > 5))).alias("word"))
    )
    users = words.groupBy("word").agg(F.countDistinct("source").alias("users"))
    unique = words.groupBy("word", "source").agg(F.count(F.lit(1)).alias("uses")).join(users, "word").groupBy("source").agg(F.sum("uses").alias("total"), F.sum(F.when(F.col("users") == 1, F.col("uses")).otherwise(0)).alias("own"))
    n = F.count(F.lit(1))
    base = items.groupBy("source").agg(
        n.alias("n"),
        F.expr("sum(length(coalesce(summary, ''))) div count(1)").alias("avg_chars"),
        F.expr("count_if(length(coalesce(imageUrl, '')) > 0) * 100 div count(1)").alias("photo_pct"),
        F.count_if(F.col("category") == "URGENT").alias("urgent"),
    )
    pct = F.coalesce(F.expr("own * 100 div greatest(total, 1)"), F.lit(0)).alias("unique_pct")
    return base.filter(F.col("n") >= least).join(unique, "source", "left").select("source", "n", "avg_chars", "photo_pct", "urgent", pct)


def elimination_candidates(scorecard: DataFrame) -> DataFrame:
    """Sources to give up, with reasons."""
    reasons = F.array_compact(F.array(F.when(F.col("avg_chars") < 150, "short"), F.when(F.col("photo_pct") < 40, "few photos"), F.when(F.col("unique_pct") < 15, "nothing of its own")))
    return scorecard.withColumn("reasons", F.array_join(reasons, ", ")).filter("reasons <> ''")


def _start_repeated(size: int) -> Column:
    return F.startswith(F.lower(F.substring(F.trim(F.coalesce("summary", F.lit(""))), 1, 5 * size)), F.lower(F.substring(F.trim("title"), 1, size)))


def _last_word(body: Column) -> Column:
    """The last word in lower case, else empty: read at the text's end, unless it is very long."""

    def last(text: Column) -> Column:
        near = F.substring_index(F.translate(F.right(text, F.lit(256)), "\t\r\n", "   "), " ", -1)
        return F.when(F.length(near) < 256, near).otherwise(F.element_at(F.concat(F.array(F.lit("")), X.tokens(text)), -1))

    return F.lower(X.bound(F.rtrim(body, F.lit(" \t\r\n")), last))


def _totals(counted: DataFrame, name: str, *keys: str) -> DataFrame:
    """Sums of counts by ``keys``, which are renamed after the sum."""
    return counted.groupBy(*[F.col(k).alias(f"{name}_{k}") for k in keys]).agg(F.sum("c").alias(name))


def audit_kinds(items: DataFrame) -> DataFrame:
    """``idx, kind``: a row for each fault of each item."""
    body, low, title = F.trim(F.coalesce("summary", F.lit(""))), F.lower(F.trim(F.coalesce("summary", F.lit("")))), F.lower("title")
    cut = (F.length(body) > 80) & (body.rlike("[:—,]$") | F.regexp_replace(_last_word(body), r"^\.+|\.+$", "").isin(*W.AUDIT_DANGLING))
    counted = items.groupBy("pool", "source", "imageUrl").agg(F.count(F.lit(1)).alias("c"))
    logos = _totals(counted, "logo_n", "pool", "imageUrl").filter("logo_n >= 3")
    mine, all_ = _totals(counted, "mine", "pool", "source"), _totals(counted, "all_n", "pool")
    hogs = mine.join(all_.withColumnRenamed("all_n_pool", "a_pool"), F.col("mine_pool").eqNullSafe(F.col("a_pool"))).filter(F.expr("mine > greatest(3, all_n div 5)"))
    marked = items.join(logos, F.col("pool").eqNullSafe(F.col("logo_n_pool")) & F.col("imageUrl").eqNullSafe(F.col("logo_n_imageUrl")), "left")
    marked = marked.join(hogs, F.col("pool").eqNullSafe(F.col("mine_pool")) & F.col("source").eqNullSafe(F.col("mine_source")), "left")
    kinds = F.array_compact(
        F.array(
            F.when(~F.coalesce("imageUrl", F.lit("")).startswith("http"), "no photo"),
            F.when(low.rlike(W.AUDIT_MARKUP), "markup"),
            F.when(low.rlike(W.AUDIT_SERVICE), "service tail"),
            F.when(low.rlike(W.AUDIT_CAPTION), "video caption"),
            F.when(title.rlike(W.AUDIT_WEATHER) | title.rlike(W.AUDIT_FILLER), "weather or horoscope"),
            F.when(F.length(body) < 60, "empty text"),
            F.when((F.length("title") > 25) & _start_repeated(25), "title in body"),
            F.when(cut, "cut short"),
            F.when(F.col("imageUrl").startswith("http") & F.col("logo_n").isNotNull(), "logo"),
            F.when(F.col("mine").isNotNull(), "publisher hog"),
        )
    )
    return marked.select("idx", "pool", F.explode(kinds).alias("kind"))


def quality_marks(items: DataFrame) -> DataFrame:
    """``idx``, what routing reads, and of each item the problems that it has in any pool (``marks``), whether its text is ``empty`` and how many Cyrillic letters it holds."""
    body = F.trim(F.coalesce("summary", F.lit("")))
    hanging = (F.length(body) > 0) & (X.ends_with(body, "[,—–:;]") | _last_word(body).isin(*W.QUALITY_HANGING))
    marks = F.array_compact(
        F.array(
            F.when(F.length(F.coalesce("imageUrl", F.lit(""))) == 0, "no photo"),
            F.when(F.length(body) < 120, "short text"),
            F.when(X.any_of(F.lower(body), W.QUALITY_JUNK), "service line"),
            F.when(hanging, "hanging end"),
            F.when((F.length("title") > 0) & _start_repeated(40), "title at start"),
            F.when((F.col("category") == "URGENT") & (F.col("priority") < 2), "urgent without priority"),
        )
    )
    route = [c for c in ("pool", "scope", "source_lang", "language") if c in items.columns]
    return items.select("idx", *route, marks.alias("marks"), (F.length(body) == 0).alias("empty"), X.count(F.lower(body), "[а-яё]").alias("cyrillic"))


def quality_problems(marked: DataFrame) -> DataFrame:
    """``idx, pool, problem``: a row for each problem of each published item, from its marks and its pool."""
    foreign = F.when(F.col("pool") == "ru", ~F.col("empty") & (F.col("cyrillic") == 0)).otherwise(F.col("cyrillic") > 10)
    problems = F.concat("marks", F.when(foreign, F.array(F.lit("foreign script"))).otherwise(F.array().cast("array<string>")))
    return marked.select("idx", "pool", F.explode(problems).alias("problem"))


def quality_summary(marked: DataFrame) -> DataFrame:
    found = quality_problems(marked)
    return found.groupBy("pool", "problem").agg(F.count(F.lit(1)).alias("n"))


def home_funnel(before: DataFrame, after: DataFrame) -> DataFrame:
    """Local rows of each source before and after selection."""
    count = lambda df, name: df.filter("scope = 'local'").groupBy("pool", "source").agg(F.count(F.lit(1)).alias(name))
    return count(before, "came").join(count(after, "stayed"), ["pool", "source"], "full").select("pool", "source", F.coalesce("came", F.lit(0)).alias("came"), F.coalesce("stayed", F.lit(0)).alias("stayed"))


def scope_pivot(items: DataFrame) -> DataFrame:
    return items.groupBy("pool").agg(*[F.count_if(F.col("scope") == s).alias(f"n_{s}") for s in ("local", "pool", "world")])
