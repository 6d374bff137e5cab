"""Titles are read from the start of texts."""

import pytest
from pyspark.sql import functions as F

from presslens.functions import text as X


@pytest.mark.parametrize("head", [1, 7, 30, 512])
def test_first_tokens_equal_those_of_the_whole_text(spark, head):
    """starts that cut a token, end in white space or hold too few tokens."""
    texts = [None, "", "   ", "one", " one  two\tthree\r\nfour five ", "x" * 600 + " y z", " " * 600 + "a b c d", "a b c d e f g", "ab cd ef" + " " * 40 + "gh ij"]
    t = F.col("t")
    for r in spark.createDataFrame([(x,) for x in texts], "t string").select(X.first_tokens(t, 3, head).alias("got"), F.slice(X.tokens(t), 1, 3).alias("want")).collect():
        assert r["got"] == r["want"]
