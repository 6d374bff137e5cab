"""Long texts are read at their ends only, with the results of reading them whole."""

import random

from pyspark.sql import functions as F

from presslens.functions import text as X
from presslens.operators import gate, reports


def texts(n=400):
    draw = random.Random(3)
    ends = ["Read more", "[…]", "© me", "Copyright 2020 All", "abc Condé Nast. 2", "(Image credit: a. b)", "(image credit: ", ")", "\n", "\t" * 120, " ", ". ", "word", "—", "The post X appeared first on Y"]
    return [(k, "lorem ipsum dolor. Read more then (x) " * draw.choice([0, 3, 40, 90]) + "".join(draw.choice(ends) + draw.choice(["", " "]) for _ in range(draw.randrange(9)))) for k in range(n)]


def test_tails_at_the_end_equal_tails_of_whole_texts(spark):
    """F8, F2: the window gives what the patterns give over the whole text."""
    frame = spark.createDataFrame(texts(), "idx long, text string")
    got = frame.select("idx", X._tailless(F.col("text")).alias("near"), X._without_tails(F.col("text")).alias("whole")).collect()
    assert [r for r in got if r["near"] != r["whole"]] == []


def test_inner_titles_are_only_looked_for_where_they_can_be(spark):
    """bodies that hold the title's letters in a row, but other words, stay; the others are cut as before."""
    rows = [("One two three Σας", "Start one, two three ΣΑΣ end"), ("One two three four", "Start onetwo three four end"), ("One two three four", "no such   words")]
    frame = spark.createDataFrame(rows, "t string, b string")
    assert [r[0] for r in frame.select(gate.drop_inner_title(F.col("t"), F.col("b"))).collect()] == ["Start end", rows[1][1], rows[2][1]]


def test_problems_come_from_marks_of_items(spark):
    """an item is judged once; its pools only tell which script is foreign."""
    rows = [(1, None, "", "NEWS", 0, "x" * 130 + ". the"), (2, "t", "p", "URGENT", 1, "слово " * 30)]
    marked = reports.quality_marks(spark.createDataFrame(rows, "idx long, title string, imageUrl string, category string, priority int, summary string"))
    found = reports.quality_problems(marked.withColumn("pool", F.explode(F.array(F.lit("ru"), F.lit("en"))))).collect()
    assert sorted(map(tuple, found)) == [
        (1, "en", "hanging end"), (1, "en", "no photo"), (1, "ru", "foreign script"), (1, "ru", "hanging end"), (1, "ru", "no photo"),
        (2, "en", "foreign script"), (2, "en", "urgent without priority"), (2, "ru", "urgent without priority"),
    ]
