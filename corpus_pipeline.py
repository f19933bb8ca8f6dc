"""A training corpus from raw documents: filter, clean, de-duplicate, mix and pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.llm import jaccard_join, line_templates, mixing, packing, quality
from wirespark.session import new_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; a document that had nothing else goes."""
    cleaned = line_templates.without_recurring_lines(
        docs, min_constant=line_templates.MIN_CONSTANT
    )
    emptied = (F.size("dropped_lines") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return cleaned.filter(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: five-word shingles, 0.8 or more."""
    classes = jaccard_join.near_duplicate_rows(docs, width=5, ratio=(4, 5))
    return jaccard_join.one_of_each(docs, classes)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.take_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    pieces = packing.packed(docs, TOKENIZER)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


STAGES = [
    ("quality", good),
    ("line_dedup", lines),
    ("near_duplicates", unique),
    ("mixing", mixture),
    ("packing", pack),
]

#: Token ids and suffix arrays have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
