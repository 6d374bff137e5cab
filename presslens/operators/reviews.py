"""Press reviews: which stories are one, which blocks fit, and who gets a place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.functions import words as W
from presslens.operators.cluster import link_counts, rare_first, sharing, weighted
from presslens.operators.select import first_of
from presslens.shared import materialise

MOST_STORIES, MOST_BLOCKS = 5, 7
LEAST_SOURCES, LEAST_BIG = 3, 2
LEAD, TELLING = "lead", ("dispute", "witness")


def same_stories(stories: DataFrame) -> DataFrame:
    """``a, b, copy`` of stories (id, title, urls) a < b that share two addresses, or the starts of two words of their titles.

    Both come from an index of rare values: with two needed, the most frequent
    one of the smaller set is never looked up. Stories with the same addresses
    and word starts are compared once: each is paired with the first of them as
    a ``copy`` (if they have two of either), and only that one with others.
    """
    keyed = stories.select("id", F.array_sort(F.array_distinct(F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: F.length(u) > 0))).alias("urls"), F.array_sort(X.stems(F.col("title"), 4, 4)).alias("stems"))
    first = materialise(keyed.groupBy("urls", "stems").agg(F.min("id").alias("rep")), "stories-first")
    found = []
    for sets in ("urls", "stems"):
        side = first.filter(F.size(sets) >= 2).select("rep", F.col(sets).alias("words"))
        found.append(sharing(rare_first(side), F.lit(2), 2).select("a", "b", F.lit(False).alias("copy")))
    copies = keyed.filter((F.size("urls") >= 2) | (F.size("stems") >= 2)).join(first, ["urls", "stems"]).filter("id <> rep")
    return found[0].union(found[1]).distinct().union(copies.select("rep", "id", F.lit(True)))


def story_links(stories: DataFrame) -> DataFrame:
    """``id, class, n_links``: with how many other stories a story shares two addresses or the starts of two words; ``class`` is the first with the same of both.

    Those of either kind are counted over subsets, and those of both kinds taken
    off: each subset of two addresses or more is a group of stories that share it.
    """
    urls = F.array_sort(F.array_distinct(F.filter(F.coalesce("urls", F.array().cast("array<string>")), lambda u: F.length(u) > 0)))
    keyed = materialise(stories.select("id", urls.alias("urls"), F.array_sort(X.stems(F.col("title"), 4, 4)).alias("stems")), "stories-keyed", compression="zstd")
    two, all_ = lambda n: 2, lambda n: n
    counted = []
    for sets in ("urls", "stems"):
        some, members = weighted(keyed.filter(F.size(sets) >= 2).select(F.col("id").alias("idx"), F.col(sets).alias("words")))
        counted.append(members.join(link_counts(some, two, all_, 2), "rep", "left").select(F.col("idx").alias("id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")))
    none = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("u1"), F.lit(0).cast("long").alias("u2")))
    with_url = lambda acc, u: F.concat(acc, F.transform(acc, lambda x: F.struct((x["k"] + 1).alias("k"), x["u1"].bitwiseXOR(F.xxhash64(u)).alias("u1"), x["u2"].bitwiseXOR(F.xxhash64(u, F.lit(""))).alias("u2"))))
    both = keyed.filter((F.size("urls") >= 2) & (F.size("stems") >= 2)).select("id", F.col("stems").alias("words"), F.explode(F.filter(F.aggregate("urls", none, with_url), lambda x: x["k"] >= 2)).alias("s")).select("id", "words", "s.*")
    held = both.groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("u1", "u2")
    some, members = weighted(both.join(held, ["u1", "u2"]).withColumn("idx", F.struct("id", "u1", "u2")), "u1", "u2")
    ids = F.col("idx.id").alias("id")
    sign = members.join(both.select(F.struct("id", "u1", "u2").alias("idx"), "k"), "idx").withColumn("sign", F.when(F.col("k") % 2 == 0, 1).otherwise(-1) * (F.col("k") - 1))
    counted.append(sign.join(link_counts(some, two, all_, 2, "u1", "u2"), "rep", "left").select(ids, (-F.col("sign") * (F.coalesce("links", F.lit(0)) + F.col("weight") - 1)).alias("n")))
    links = counted[0].union(counted[1]).union(counted[2]).groupBy("id").agg(F.sum("n").alias("n_links"))
    first = keyed.groupBy("urls", "stems").agg(F.min("id").alias("class"))
    return keyed.join(first, ["urls", "stems"]).select("id", "class").join(links, "id", "left").select("id", "class", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def story_stems(text: Column) -> Column:
    """Starts of five letters of the words of at least four, without words that tell nothing."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([а-яёa-zà-ú]{4,})"), F.lit(1))
    return F.array_distinct(F.transform(F.filter(found, lambda w: ~w.isin(*W.STORY_STOP)), lambda w: F.substring(w, 1, 5)))


def fits(title: Column, story_title: Column, lead_title: Column, lead_summary: Column) -> Column:
    """Whether a block shares a word start with its story's title or with the lead; a title without words fits."""
    own = story_stems(title)
    about = F.concat(story_stems(story_title), story_stems(lead_title), story_stems(F.substring(F.coalesce(lead_summary, F.lit("")), 1, 400)))
    return (F.size(own) == 0) | F.arrays_overlap(own, about)


def _no(schema: str, like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema)


def assign_blocks(proposed: DataFrame) -> DataFrame:
    """``pool, pos, place, idx, lead`` of the blocks that make press reviews.

    ``proposed`` (pool, pos, k, idx, source, family, title, summary, priority,
    role, story_title, base) lists stories by importance with the blocks named
    for each; ``base`` blocks stand in an old story already. The first five of a
    pool count. In their order, a block is taken unless an earlier story has it, its
    family speaks already, or it doesn't fit; leads stay free for other stories.
    A story has at most seven blocks and needs three sources, or two if something
    important is told; otherwise its blocks are free again.

    Stories of one rank are made in all pools at once, in five rounds: the first
    free block leads, and of each family the first that fits is taken, so no
    group of blocks comes together anywhere.
    """
    narrow = proposed.select("pool", "pos", "k", "idx", "source", "family", "title", F.substring("summary", 1, 400).alias("summary"), "priority", "role", "story_title", "base")
    narrow = materialise(narrow.filter(F.col("pos") <= MOST_STORIES), "reviews-proposed")
    used, out = _no("u_pool string, u_idx long, u_priority int", narrow), None
    place = F.struct((~F.col("base")).alias("fresh"), "k", "idx")
    for pos in range(1, MOST_STORIES + 1):
        rows = narrow.filter(F.col("pos") == pos)
        old = rows.filter("base")
        free = rows.filter("NOT base").join(used, (F.col("pool") == F.col("u_pool")) & (F.col("idx") == F.col("u_idx")), "left_anti")
        lead = old.unionByName(free).groupBy(F.col("pool").alias("l_pool")).agg(F.min_by(F.struct("idx", "base", "title", "summary"), place).alias("l"))  # a row a pool
        leads = (F.col("idx") == F.col("l.idx")) & ~F.col("l.base")
        fit = free.join(F.broadcast(lead), F.col("pool") == F.col("l_pool")).filter(leads | fits(F.col("title"), F.col("story_title"), F.col("l.title"), F.col("l.summary")))
        spoken = old.select(F.col("pool").alias("o_pool"), F.col("family").alias("o_family")).distinct()
        fit = fit.join(spoken, (F.col("pool") == F.col("o_pool")) & F.col("family").eqNullSafe(F.col("o_family")), "left_anti")
        block = F.struct("k", "idx", "source", "priority", "role", "base")
        taken = materialise(fit.groupBy("pool", "family").agg(F.min(block).alias("b")).select("pool", "b.*"), "reviews-taken")
        every = old.select(*taken.columns).unionByName(taken)
        blocks = materialise(first_of(every, "pool", MOST_BLOCKS, F.desc("base"), F.col("k"), F.col("idx")), "reviews-blocks")
        marked = taken.filter(F.col("role") != LEAD).select(F.col("pool").alias("u_pool"), F.col("idx").alias("u_idx"), F.col("priority").alias("u_priority"))
        urgent = used.union(marked).filter("u_priority >= 2").select("u_pool").distinct().withColumn("urgent", F.lit(True))
        sizes = blocks.groupBy("pool").agg(F.countDistinct("source").alias("n"), F.max(F.col("role").isin(*TELLING)).alias("told")).join(urgent, F.col("pool") == F.col("u_pool"), "left")
        big = F.coalesce("urgent", F.lit(False)) | F.col("told")
        good = sizes.filter(F.col("n") >= F.when(big, LEAST_BIG).otherwise(LEAST_SOURCES)).select(F.col("pool").alias("g_pool"))
        order = Window.partitionBy("pool").orderBy(F.desc("base"), "k", "idx")  # seven blocks
        made = blocks.join(good, F.col("pool") == F.col("g_pool"), "left_semi").withColumn("place", F.row_number().over(order) - 1)
        made = made.select("pool", F.lit(pos).alias("pos"), "place", "idx", (F.col("role") == LEAD).alias("lead"))
        out = made if out is None else out.unionByName(made)
        used = materialise(used.union(marked.join(good, F.col("u_pool") == F.col("g_pool"), "left_semi")), "reviews-used")
    return out
