"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of ``documents``; ``run`` writes what
a stage returns and reads it back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.llm.bpe import bpe_documents, vocabulary
from stratalake.llm.jaccard_join import jaccard_groups
from stratalake.llm.line_dedup import ADDED, dedup_lines, doc_key
from stratalake.llm.mixing import WORD, mix_sources
from stratalake.llm.names import free_name
from stratalake.llm.quality_classifier import CUT, fit_quality_model, quality_score
from stratalake.sources import stage

WEIGHTS, MAX_REPEATS = (1, 2, 3), 3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the cut; labels that are held out are not learned from.

    Null and empty texts have the score of no difference. An empty table stays
    empty; other columns, whatever their names, stay as they are.
    """
    model = fit_quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality_score("text", model) >= CUT)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without blocks that an earlier one has; those of which no word is left go.

    Texts that lose nothing stay, null and empty ones too, and so do columns named
    as those of the operator.
    """
    own = {c: free_name(docs.columns, f"own_{c}") for c in docs.columns if c in ADDED}
    cut = dedup_lines(docs.withColumnsRenamed(own))
    loses = F.col("removed_lines") > 0
    length = F.when(loses, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    cut = cut.filter(~loses | F.col("text").rlike(WORD)).withColumn("n_chars", length).drop(*ADDED)
    return cut.withColumnsRenamed({mine: c for c, mine in own.items()}).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles the first: that with the smallest doc_id, null last.

    Texts of the same doc_id, or of none, are judged each by itself, the least hash
    first. Of rows that repeat both doc_id and text one stays. Texts without words
    are linked with nothing and stay; so do other columns, whatever their names.
    """
    groups = stage(jaccard_groups(docs), "text-groups")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("doc_key") == F.col("first_key"))
    copy = free_name(docs.columns, "copy")
    gone = stage(groups.filter(~first).select("doc_id", "doc_key").distinct(), "group-copies")
    gone = gone.select(F.struct("doc_id", "doc_key").alias(copy))
    # Copies, as what the mix takes, grow with the documents: merged at any size, never sent to all executors.
    kept = docs.join(gone.hint("merge"), _is(copy), "left_anti").select(*docs.columns)
    # Without repeated keys there is nothing to drop.
    repeated = groups.filter(first).groupBy("doc_id", "doc_key").count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: up to three rows, or none.

    Texts of one id are documents of their own; rows that repeat id, text and
    source are each taken as often as the one taken most. A null source is a
    source, and documents without words come for no words. An empty table stays
    empty; other columns, whatever their names, stay as they are.
    """
    key = doc_key(F.col("doc_id"), F.col("text"))
    mixed = mix_sources(docs, WEIGHTS, MAX_REPEATS, key).groupBy("doc_id", "doc_key", "source")
    taken = mixed.agg(F.max("repeats").alias("repeats")).filter("repeats > 0")
    plan, turn = free_name(docs.columns, "plan"), free_name(docs.columns, "turn")
    taken = taken.select(F.struct("doc_id", "doc_key", "source", "repeats").alias(plan))
    found = docs.join(taken.hint("merge"), _is(plan) & F.col("source").eqNullSafe(F.col(f"{plan}.source")))
    turns = F.explode(F.sequence(F.lit(1), F.col(f"{plan}.repeats")))
    return found.withColumn(turn, turns).select(*docs.columns)


def _is(other: str) -> Column:
    """Whether a document has the id and the text of the struct ``other``."""
    same_text = doc_key(F.col("doc_id"), F.col("text")) == F.col(f"{other}.doc_key")
    return F.col("doc_id").eqNullSafe(F.col(f"{other}.doc_id")) & same_text


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's token ids, with digests of the ids and of what they decode to.

    Null and empty texts have no ids. An empty table gives no rows; columns but
    doc_id and text are left out.
    """
    return bpe_documents(docs, vocabulary(spark)).select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", cut_lines),
    ("n-gram Jaccard join", keep_one_of_group),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", encode),
]

# No stage but the mix can be said in SQL: dictionaries, alignment, set joins and merges of pairs cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
