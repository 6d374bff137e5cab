"""A training corpus from raw documents, stage by stage.

Every stage takes what its predecessor kept. Toxicity drops the documents that
the classifier rejects; line dedup rewrites texts and drops those of which
nothing is left; the Jaccard join keeps one document of each group; the mix
repeats or drops documents by their source's rate; packing returns token pieces
with their places in sequences.

What happens in special cases:

* null and empty texts score as texts without features, have no lines to remove
  and link with nothing; the mix takes them as often as their source's rate says,
  and packing gives them their end token;
* rows that share an id are separate documents: toxicity and line dedup look at
  each row's own text, the join keeps one row of equal id and words;
* null ids stay null, also those of the copies that the mix emits;
* null languages and lengths are passed on, a null source is one of its own;
* only the columns of ``documents`` are carried, others are dropped;
* an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm import jaccard, line_dedup, mixing, packing, toxicity
from presslens.shared import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Copies of one document, as the mix emits them, get ids of their own: id * COPIES + copy - 1.
COPIES = mixing.MAX_REPEAT


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).filter("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of later repeated windows; texts of which no words are left go."""
    cleaned = line_dedup.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("lines_removed") > 0) & ~F.col("text").rlike(mixing.WORD)
    length = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", length).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates: five words, similarity 0.8."""
    return jaccard.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs).withColumn("doc_id", F.col("doc_id") * COPIES + F.col("copy") - 1).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 1024 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Nearest-neighbour scores have no SQL form; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
