"""A corpus pipeline over `documents`: quality rules, near duplicates, repeated strings, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's result to the shared folder before the next one reads it, as the stages read their input several
times. SQL cannot express the learned rules, fingerprints and tokens, so ORACLE_SQL is None and tests compare the stages
with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from channelmart.llm import packing, pii, quality, simhash, suffix_dedup
from channelmart.llm.common import stored
from channelmart.llm.queries import tokenizer_path

SHINGLE_WORDS, MAX_BITS = 4, 4
REPEAT_LENGTH = 50
WINDOW, END_ID = 4096, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed limits or the rules learned from `labels` reject go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays."""
    return simhash.one_of_each(docs, SHINGLE_WORDS, MAX_BITS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that a document with a smaller id has are taken out of the texts."""
    return suffix_dedup.without_repeats(docs, REPEAT_LENGTH)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced or taken out."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in windows."""
    return packing.pack(packing.pieces(docs, tokenizer_path("word_bpe_49k.json"), END_ID, WINDOW), WINDOW)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated strings", repeated_strings),
          ("personal data", personal_data), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
