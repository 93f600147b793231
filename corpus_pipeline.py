"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import packing, phrases, simhash, suffixes, toxicity
from larder.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link."""
    return simhash.one_of_each(docs, 3, 3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 200 that stand elsewhere, too; n_chars follows the text."""
    return suffixes.without_repeats(docs, 200).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return phrases.decontaminate(docs, table(spark, sf_dir, "benchmark"), 10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("suffixes", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: the stages score by nearest examples, fingerprint, sort suffixes and tokenize: SQL can't express them
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
