"""The corpus pipeline: stages over ``documents``, each written and read again.

Defined cases, for every stage: an empty table gives an empty one; other columns
are carried through unchanged (``shard`` replaces a column of that name); texts
are read whole, however long; rows alike in every column fare alike, except that
``near_duplicates`` leaves one of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from reelmart.llm import decontaminate, jaccard, kneser_ney, mixing, sharding
from reelmart.llm.common import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the language model of trusted text does not reject.
    Null texts are scored as empty ones, null languages as ``und``; a language
    without trusted text keeps all its documents; a tie with the ceiling stays."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return kneser_ney.good_rows(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that are alike: that of the least
    doc_id. Null, empty and blank texts are a class each and stay."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of ``benchmark``. Null and blank texts
    hold none; a null doc_id goes with its text, whatever other rows hold."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean_rows(docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, 0 to 2 times. Null
    sources are one source; ties of the drawn key go by doc_id, null first; texts
    without words count 0 and are drawn as any other."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard. Null texts weigh 1; equal texts lie
    together; rows alike in doc_id and text are never parted."""
    return sharding.sharded_rows(docs)


STAGES = [("quality", quality), ("near duplicates", near_duplicates),
          ("decontamination", decontaminated), ("mixing", mix), ("sharding", shard)]

#: the stages draw, hash and score; their rows are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what one keeps is written as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex[:12]}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
