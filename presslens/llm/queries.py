"""The queries op1 to op13 over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm import alignment, ballcodes, classlm, jaccard, licenses, line_dedup, mixing, mpeg, packing, pii, toxicity, vectors, warc
from presslens.shared import materialise, table


#: The key of op6_surrogates where the session sets no secret ``presslens.pii.key``: known to all, so for samples and tests only.
SAMPLE_KEY = "sample"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, repeats counted."""
    planned = mixing.repetition_plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, normalised, and read back through the sidecar index."""
    archives = warc.normalise(warc.write_archives(warc.revisits(table(spark, sf_dir, "pages"))))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "offset", "length")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their places in packed sequences."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines of later repeated windows removed."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_in", "lines_removed")


def op9_mpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as MPEG audio in a table, read back from it, with the stream's features."""
    stored = materialise(mpeg.write_mpeg(table(spark, sf_dir, "documents").select("doc_id", "text")), "mpeg", compression="zstd")
    features = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in ("frames", "samples", "rate", "min_kbps", "max_kbps", "junk_bytes", "crc_good", "crc_bad", "vbr", "vbr_frames", "vbr_bytes")]
    seek = F.concat(F.lit("seek="), F.sha1(F.array_join("offsets", ",")))
    return mpeg.read_mpeg(stored).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.concat_ws(";", *features, seek).alias("feature"), "frames", (F.col("samples") / F.col("rate")).alias("seconds"), "crc_bad"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score from its nearest labelled examples."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted", "evidence")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of at least 0.85."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings of one label with a cosine of at least 0.93."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by class bigrams, learnt from nine tenths of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classlm.fit(docs.filter(~classlm.held_out(F.col("doc_id"))))
    return classlm.score(docs, model).withColumn("held_out", classlm.held_out(F.col("doc_id")))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced; documents with a surrogate that isn't one to one would be marked."""
    replaced = materialise(pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get("presslens.pii.key", SAMPLE_KEY)), "pii")
    met = pii.collisions(replaced).select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
    clash = replaced.select("doc_id", F.explode("entities").alias("e")).join(met, (F.col("e.kind") == F.col("k")) & (F.col("e.surrogate") == F.col("s")), "left_semi").select(F.col("doc_id").alias("c_id")).distinct()
    clash = materialise(clash, "pii-clash")
    if clash.count() <= jaccard.BROADCAST_IDS:  # texts needn't be shuffled for a few ids
        clash = F.broadcast(clash)
    return replaced.join(clash, F.col("doc_id") == F.col("c_id"), "left").select("doc_id", "text", "n_entities", "entities", F.col("c_id").isNull().alias("distinct_surrogates"))


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's part codes after two rounds of k-means over metric trees, and its error."""
    coded, books = ballcodes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(ballcodes.fingerprint(books)).alias("codebooks_sha256"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and notices."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, with corpus-wide counts of the linked ids."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op13_alignment": op13_alignment,
    "op12_licenses": op12_licenses,
    "op11_ball_codes": op11_ball_codes,
    "op6_surrogates": op6_surrogates,
    "op8_class_lm": op8_class_lm,
    "op5_vectors": op5_vectors,
    "op4_jaccard": op4_jaccard,
    "op10_toxicity": op10_toxicity,
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op7_line_dedup": op7_line_dedup,
    "op9_mpeg": op9_mpeg,
}

def _nearest(book: str) -> str:
    """Parts with the entry of ``book`` nearest to each, and their squared distance."""
    away = " + ".join(f"(p.x{k} - b.x{k}) * (p.x{k} - b.x{k})" for k in range(4))
    return f"(SELECT vec_id, label, part, x0, x1, x2, x3, min({{'d': d, 'e': entry}}) AS best FROM (SELECT p.*, b.entry, {away} AS d FROM parts p JOIN {book} b USING (part)) GROUP BY ALL)"


def _moved(book: str) -> str:
    """``book`` after a round: floored means, unused entries as they are."""
    means = ", ".join(f"coalesce(m{k}, b.x{k}) AS x{k}" for k in range(4))
    sums = ", ".join(f"(sum(x{k}) // count(*) - CASE WHEN sum(x{k}) % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS m{k}" for k in range(4))
    return f"SELECT part, entry, {means} FROM {book} b LEFT JOIN (SELECT part, best.e AS entry, {sums} FROM {_nearest(book)} GROUP BY ALL) USING (part, entry)"


def _sql_words(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{licenses.UPPER}', '{licenses.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_TEMPLATES_SQL = ", ".join("('{}', '{}', '{}')".format(label, kind, text.replace("'", "''")) for kind, some in (("phrase", licenses.PHRASES), ("notice", licenses.NOTICES)) for label, text in some)

_PARTS_SQL = ", ".join(f"v[4 * part + {k + 1}] AS x{k}" for k in range(4))

ORACLE_SQL = {
    "op12_licenses": f"""
WITH docs AS (
  SELECT doc_id, {_sql_words("coalesce(text, '')")} AS w FROM documents
), grams AS (
  SELECT doc_id, p, array_to_string(w[p + 1 : p + 2], ' ') AS two, array_to_string(w[p + 1 : p + 3], ' ') AS three
  FROM (SELECT doc_id, w, unnest(range(len(w) - 1)) AS p FROM docs WHERE len(w) >= 2)
), templates AS (
  SELECT label, kind, w, len(w) AS n, CASE WHEN kind = 'phrase' THEN len(w) ELSE least(len(w), {licenses.GRAM}) END AS k
  FROM (SELECT label, kind, {_sql_words("said")} AS w FROM (VALUES {_TEMPLATES_SQL}) AS t(label, kind, said))
), positions AS (
  SELECT label, kind, n, k, q, array_to_string(w[q + 1 : q + k], ' ') AS said FROM (SELECT *, unnest(range(n - k + 1)) AS q FROM templates)
), hits AS (
  SELECT doc_id, label, kind, n, k, p, q FROM grams JOIN positions ON three = said AND k = 3
  UNION ALL SELECT doc_id, label, kind, n, k, p, q FROM grams JOIN positions ON two = said AND k = 2
), voted AS (
  SELECT doc_id, label, kind, n, k, p - q AS diagonal, list(DISTINCT q) AS met, min(p) AS first, max(p) AS last FROM hits GROUP BY ALL
), places AS (
  SELECT doc_id, label, diagonal AS start FROM voted WHERE kind = 'phrase' AND len(met) = n - k + 1
), runs AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS run
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) > {licenses.SLACK} THEN 1 ELSE 0 END AS apart FROM voted WHERE kind = 'notice')
), sized AS (
  SELECT *, len(list_distinct(flatten(list_transform(met, lambda q: range(q, q + k))))) AS alone FROM runs
), merged AS (
  SELECT doc_id, label, n, k, run, list_distinct(flatten(list(met))) AS met, max(alone) AS alone, min(first) AS start, max(last) + k AS stop FROM sized GROUP BY doc_id, label, n, k, run
), found AS (
  SELECT doc_id, label, greatest(alone, CASE WHEN (stop - start) * 2 <= n * 3 THEN len(list_distinct(flatten(list_transform(met, lambda q: range(q, q + k))))) ELSE 0 END) / n AS coverage FROM merged
), every AS (
  SELECT doc_id, label, start, 1.0 AS coverage FROM places UNION ALL SELECT doc_id, label, NULL, coverage FROM found WHERE coverage >= {licenses.LEAST}
), per AS (
  SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
    coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE start IS NOT NULL)), ','), '') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage)::DOUBLE AS score
  FROM every GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM docs d LEFT JOIN per p ON d.doc_id = p.doc_id
""",
    "op11_ball_codes": f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS nth
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS (
  SELECT vec_id, label, nth, part, {_PARTS_SQL} FROM kept, range(16) AS r(part)
), book0 AS (SELECT part, nth AS entry, x0, x1, x2, x3 FROM parts WHERE nth < 64
), book1 AS MATERIALIZED ({_moved("book0")}), book2 AS MATERIALIZED ({_moved("book1")}
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM {_nearest("book2")} GROUP BY ALL
), named AS (
  SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, named
""",
    "op1_mixing": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents
), ranked AS (
  SELECT source, source_size, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)
), leveled AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS ratio,
    ((sum(source_size) OVER ())::BIGINT - 3 * coalesce(sum(source_size) OVER before, 0)::BIGINT)::DOUBLE
      / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT) AS level
  FROM ranked
  WINDOW before AS (ORDER BY (3 * source_size)::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT level AS w FROM leveled WHERE ratio >= level ORDER BY ratio, source ASC NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN ratio >= w THEN w * weight ELSE (3 * source_size)::DOUBLE END AS target FROM leveled, water
), planned AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copied AS (
  SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM planned
)
SELECT doc_id, size, source_size, target, size * copies AS taken, rate, copies FROM copied
""",
    "op7_line_dedup": r"""
WITH docs AS (
  SELECT DISTINCT doc_id, text FROM documents
), lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs WHERE text IS NOT NULL
), solid AS (
  SELECT *, row_number() OVER w AS ord, lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3, lead(pos, 1) OVER w AS pos2, lead(pos, 2) OVER w AS pos3
  FROM lines WHERE NOT regexp_matches(line, '^[ \t\r\f\x0B]*$')
  WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos)
), later AS (
  SELECT doc_id, text, pos, pos2, pos3 FROM (
    SELECT *, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, ord) AS nth FROM solid WHERE line3 IS NOT NULL
  ) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, text, unnest([pos, pos2, pos3]) AS pos FROM later
), kept AS (
  SELECT l.doc_id, l.text, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS new_text, count(*) AS lines_in, count(g.pos) AS lines_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.text = g.text AND l.pos = g.pos GROUP BY l.doc_id, l.text
)
SELECT d.doc_id, k.new_text AS text, coalesce(k.lines_in, 0)::INT AS lines_in, coalesce(k.lines_removed, 0)::INT AS lines_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
""",
}
