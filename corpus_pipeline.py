"""The corpus pipeline over ``documents``: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return
the columns of ``docs``; the last returns where every piece of every kept document is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnocast.llm.common import ready, table
from limnocast.llm.language_id import identify
from limnocast.llm.packing import pack_documents
from limnocast.llm.quality import score_quality
from limnocast.llm.simhash import without_near_duplicates
from limnocast.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    ready(spark)
    scored = score_quality(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    return scored.where(F.col("predicted") == 1).drop("held_out", "score", "predicted")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    ready(spark)
    named = identify(docs, keep=tuple(docs.columns))
    return named.where(~F.col("rejected")).drop("held_out", "lang_pred", "score", "rejected")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    ready(spark)
    return without_near_duplicates(docs, words=3, max_bits=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document, cut and packed into sequences of at most 2048 tokens."""
    ready(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

# Neither the classifiers nor the packing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's rows are written to the shared folder and read again by the next."""
    docs = table(ready(spark), sf_dir, "documents")
    # The last stage writes its own copy of all it needs, so what the others wrote goes in the end, also after a failure.
    with scratch_folder(spark, "pipeline") as folder:
        for name, stage in STAGES[:-1]:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
