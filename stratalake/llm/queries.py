"""The numbered queries over the given tables, each operator with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm.bpe import bpe_documents, vocabulary
from stratalake.llm.decontamination import decontaminate
from stratalake.llm.fingerprints import fingerprint_documents
from stratalake.llm.hard_negatives import mine_hard_negatives
from stratalake.llm.jaccard_join import jaccard_components
from stratalake.llm.lexical_search import rank_documents
from stratalake.llm.line_dedup import dedup_lines
from stratalake.llm.mixing import mix_sources
from stratalake.llm.quality_classifier import classify_quality, fit_quality_model
from stratalake.llm.quality_rules import quality_rules
from stratalake.llm.sharding import shard_documents
from stratalake.llm.url_filter import filter_urls, fit_url_model, sample_url_labels
from stratalake.llm.warc import archive_pages
from stratalake.sources import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return shard_documents(_table(spark, sf_dir, "documents"), 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' components at 80 of 100 shared 5-word shingles."""
    return jaccard_components(_table(spark, sf_dir, "documents"), 80)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources weighing 1, 2, 3 in turn, none repeated over 3 times."""
    mixed = mix_sources(_table(spark, sf_dir, "documents"), (1, 2, 3), 3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded; digests of both."""
    coded = bpe_documents(_table(spark, sf_dir, "documents"), vocabulary(spark))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls: rules, else a model of a small labelled table."""
    weights = fit_url_model(sample_url_labels(spark))
    judged = filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, weights)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    return archive_pages(spark, _table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the blocks of 50 words or more that an earlier one has."""
    return dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.length("text").cast("bigint").alias("n_chars"), "removed_lines", "removed_spans", "earlier_docs"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    return quality_rules(_table(spark, sf_dir, "documents")).drop("distance")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    model = fit_quality_model(documents, _table(spark, sf_dir, "labels"))
    return classify_quality(documents, model)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector's hard negatives among all vectors, some of which are relabelled first."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of all documents lies in a ten-word window of a benchmark item."""
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_decontamination": op13_decontamination,
}

# Words as in the operator: its queue is a sum over each source in shuffled order, its mix the places up to the budget.
_OP4_SQL = r"""
WITH base AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS shuffle,
         coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::BIGINT AS size
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM base GROUP BY source
), limits AS (
  SELECT *, 1 + source_no % 3 AS weight, 3 * source_size AS full_size FROM sizes
), steps AS (
  SELECT *, row_number() OVER filling AS step,
         sum(source_size) OVER () - coalesce(sum(full_size) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM limits WINDOW filling AS (ORDER BY full_size * 6 // weight, source_no)
), level AS (
  SELECT step AS at_step, remaining AS at_remaining, open_weight AS at_weight
  FROM steps WHERE remaining * weight <= full_size * open_weight ORDER BY step LIMIT 1
), targets AS (
  SELECT source, source_no, source_size,
         CASE WHEN step < at_step THEN full_size::DOUBLE
              ELSE (weight * at_remaining)::DOUBLE / at_weight::DOUBLE END AS target
  FROM steps, level
), queue AS (
  SELECT b.doc_id, b.size, b.shuffle, t.source_no, t.source_size, t.target,
         sum(b.size) OVER (PARTITION BY t.source_no ORDER BY b.shuffle, b.doc_id, b.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), places AS (
  SELECT *, CASE WHEN target > 0 THEN (turn * source_size + words)::DOUBLE / target ELSE 0 END AS finish
  FROM queue, (VALUES (0), (1), (2)) AS turns(turn)
  WHERE turn = 0 OR turn * source_size < target
), line AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_no, turn, shuffle, doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS taken_words
  FROM places
)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN taken_words <= (SELECT sum(size) FROM base) THEN size ELSE 0 END)::BIGINT AS taken
FROM line GROUP BY doc_id
"""

# Every anchor's inner product with every row.
_OP11_SQL = r"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM vectors
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM ints a JOIN ints b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), far AS (
  SELECT near.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY near.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM near JOIN scores ON near.anchor_id = scores.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM far WHERE place <= 10
"""

# Every term's contribution to every document that holds it, added up by item.
_OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), docs AS (
  SELECT doc_id, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs
), postings AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, corpus GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * corpus.docs) // corpus.terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

# Every run of words of a window's length, looked up among the windows.
_OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), starts AS (
  SELECT item_id, words, least(len(words), 10) AS width, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS first_word
  FROM items WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(words, first_word, first_word + width - 1), ' ') AS win FROM starts
), runs AS (
  SELECT row_no, words, width, unnest(range(1, len(words) - width + 2)) AS first_word
  FROM docs, (SELECT DISTINCT width FROM windows) WHERE len(words) >= width
), found AS (
  SELECT row_no, item_id, first_word, runs.width FROM runs JOIN windows
  ON runs.width = windows.width AND win = array_to_string(list_slice(words, first_word, first_word + runs.width - 1), ' ')
), hits AS (
  SELECT row_no, count(DISTINCT word_no)::BIGINT AS n_hit
  FROM (SELECT row_no, unnest(range(first_word, first_word + width)) AS word_no FROM (SELECT DISTINCT row_no, first_word, width FROM found))
  GROUP BY row_no
), named AS (
  SELECT row_no, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS item FROM found) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN named USING (row_no)
"""

ORACLE: dict[str, str] = {
    "op4_mixing": _OP4_SQL,
    "op11_hard_negatives": _OP11_SQL,
    "op12_lexical_search": _OP12_SQL,
    "op13_decontamination": _OP13_SQL,
}
