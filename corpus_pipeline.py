"""From raw documents to packed sequences: quality filter, near-duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.kneser_ney import classify_quality, row_key
from tallyloom.llm.near_copies import near_copy_groups, node_of
from tallyloom.llm.pattern_packing import packed_documents
from tallyloom.llm.shared import kept, table
from tallyloom.llm.substring_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, told apart by doc_id, text and language, null ids included."""
    scored = classify_quality(docs, table(spark, sf_dir, "labels"))
    rejected = kept(scored.filter("not keep").select("row_key").distinct(), "rejected")
    return docs.select(COLUMNS).withColumn("row_key", row_key(docs)).join(rejected, "row_key", "left_anti").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts with a five-word Jaccard similarity of 0.8 or more, that with the smallest doc_id.

    Candidates come from the SimHash index, with wide fingerprints; links are exact. Null ids come last and equal ids are
    told apart by text, so of every group one row stays, whatever its ids are.
    """
    rows = docs.select(*COLUMNS, node_of().alias("_node"), F.xxhash64(*COLUMNS).alias("_row"))
    groups = near_copy_groups(docs).select(F.col("node").alias("_node"), F.col("group").alias("_group"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("_least")
    ids = rows.groupBy("_node").agg(least).join(groups, "_node", "left")
    first = F.struct("_least.none", "_least.doc_id", "_node", "_least._row")
    stay = kept(ids.groupBy(F.coalesce("_group", "_node").alias("_group")).agg(F.min(first).alias("_first")).select("_first._node", "_first._row"), "representatives")
    # joined and grouped by the same columns, so that the texts are shuffled once
    return rows.join(stay, ["_node", "_row"]).groupBy("_node", "_row").agg(F.first(F.struct(*COLUMNS)).alias("_text")).select("_text.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; those with repeated passages have the other words, joined by single spaces, as their text."""
    done = remove_repeats(docs, COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return done.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 tokens."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packing)]

#: Perplexities, XXH64 and token ids have no SQL form; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
