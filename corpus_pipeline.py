"""A training corpus from documents: clean, deduplicate, mix and pack.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as
Parquet in the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import jaccard_join, mixing, packing, suffix_dedup, toxicity
from scrubline.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained network does not predict toxic."""
    texts, toxic = toxicity.training_sample(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs.select(*COLUMNS), toxicity.fit(texts, toxic))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with similar word 5-grams."""
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte passages of earlier ones; their length is counted anew."""
    left = suffix_dedup.remove_repeats(docs)
    shorter = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.withColumn("n_chars", F.coalesce(shorter, F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh as the roots of their sizes, in random order."""
    return mixing.mix(docs, weights=0.5).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and places."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("mixing_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# A network, MinHash pruning and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
