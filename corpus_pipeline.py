"""A training-corpus pipeline: rules, classifier, near-duplicates, repeated passages, packing.

Each stage takes what its predecessor kept, as a table with the columns of
documents, and returns such a table; the last returns the packed pieces. The
classifier also reads the labels and the texts it learns from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.classifier import keep_good
from holdfast.llm.common import importable, materialise
from holdfast.llm.packing import pack_documents
from holdfast.llm.quality_rules import apply_rules
from holdfast.llm.simhash import keep_first_of_groups
from holdfast.llm.suffix_dedup import remove_repeated_words

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their outlier distance reject go."""
    importable(spark)
    return apply_rules(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of poor quality go; the model is learnt from the web text as it came."""
    importable(spark)
    labels, web = (spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in ("labels", "documents"))
    return keep_good(docs, labels, web)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays."""
    importable(spark)
    return keep_first_of_groups(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur twice or more are cut out of the texts; n_chars follows.

    The query op10's 400 bytes would leave most of them: 51 words of these texts take 260 bytes and more.
    """
    importable(spark)
    cut = remove_repeated_words(docs)
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the tokenised documents, with its sequence and offset."""
    importable(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [(f.__name__, f) for f in (quality_rules, quality_classifier, simhash_near_dedup, suffix_array_dedup, best_fit_packing)]

#: Robust covariances, a fitted classifier and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
