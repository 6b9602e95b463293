"""A training corpus from raw documents: language, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanloom.llm import decontaminate, language_id, near_dedup, packing
from spanloom.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the fused evidence accepts."""
    model = language_id.fit(docs, "text", "lang")
    found = language_id.identify(docs, model, declared=F.col("lang"), host=F.col("source"))
    return found.where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every kept document with its sequence, place and checksum."""
    packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.digest(packed)


STAGES = [("language", language), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack)]
#: Tokenisation and the banded search are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
