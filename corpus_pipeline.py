"""From raw documents to packed training sequences: five stages, each reading what the one before it wrote."""

from __future__ import annotations

import os
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablestream.llm import exact_dedup, mixing, near_dedup, packing, quality_cnn  # noqa: E402
from tablestream.llm.queries import mix_levels  # noqa: E402
from tablestream.llm.shared import written  # noqa: E402

# The mix keeps most of the corpus and evens out domains and languages where they crowd the rest out.
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "*": 2}}
MIX_SHARE, MIX_SEED = 0.9, 17


def _matching(docs: DataFrame, keys: list[Column], kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are a row of ``kept`` (nulls match each other), with the columns of ``docs``, whatever their names."""
    mine = docs.select(F.struct(*docs.columns).alias("_doc"), *[c.alias(f"_key{i}") for i, c in enumerate(keys)])
    named = kept.toDF(*[f"_kept{i}" for i in range(len(keys))]).distinct()
    on = [F.col(f"_key{i}").eqNullSafe(F.col(f"_kept{i}")) for i in range(len(keys))]
    return mine.join(named, on, "left_semi").select("_doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is trained on labelled documents of the stage's input.

    Null and empty texts are scored like any other; rows that repeat and rows without doc_id are judged by their text. Without labelled
    documents nothing is known against any text.
    """
    net = quality_cnn.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_cnn.keep(docs, net)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, the one with the largest doc_id; ties and rows without doc_id: the least by its columns. Null is empty."""
    return exact_dedup.one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the smallest doc_id.

    Null, empty and blank texts and rows without doc_id are linked with nothing and stay. Rows that repeat a doc_id with different texts
    are one document with the links of each, and stay or go together.
    """
    return _matching(docs, [F.col("doc_id").cast("long")], near_dedup.near_duplicates(docs).where("kept").select("doc_id"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each once; a document in which a budget ends stays whole, documents without words go.

    Budgets count words (the tokens of the packing stage are not known yet). A document is its doc_id and text here, so rows without
    doc_id, or of one doc_id with different texts, are chosen each by itself; rows equal in both are chosen together.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    chosen = mixing.mix(docs.withColumn("doc_id", key), mix_levels(), MIX_WEIGHTS, MIX_SHARE, 1, MIX_SEED)
    return _matching(docs, [key], chosen.select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens; null and empty texts are the end token alone, every row is packed by itself."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens")


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("packing", packed)]
# A trained network and a tokenizer are not SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
