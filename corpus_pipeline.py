"""A training-corpus pipeline: filter, deduplicate, mix and encode ``documents``.

Every stage takes the rows its predecessor kept, as Parquet; all but the last return the columns of
``documents``, whatever their names.  Null and empty texts and rows with a null id are judged like others; rows that
repeat are rows of their own until near copies go; an empty table gives empty stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.classifiers import quality, toxicity
from tallyfield.llm.common import shared_folder
from tallyfield.llm.mixing import mix_sources
from tallyfield.llm.ngram_join import drop_near_copies
from tallyfield.llm.queries import segmentation_digest


def _whole(docs: DataFrame, *inputs: str) -> DataFrame:
    """The columns that an operator reads, next to the whole row: no name of ``docs`` meets one that it adds."""
    return docs.select(F.struct("*").alias("_whole"), *inputs)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity classifier predicts toxic."""
    scored = toxicity(_whole(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select("_whole.*")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier does not predict good."""
    scored = quality(_whole(docs, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select("_whole.*")


def reject_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five words, similarity 0.8)."""
    return drop_near_copies(docs, n=5, similarity=0.8).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix of sources takes it: not at all, once or twice.

    Its rows are equal then, and the next stage gives them equal samples: what is taken twice is trained on twice.
    """
    mixed = mix_sources(_whole(docs, "doc_id", "text", "source"), carry=["_whole"]).where("copies > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "_whole").select("_whole.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, decoded again and digested."""
    return segmentation_digest(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_low_quality),
    ("ngram_jaccard_join", reject_near_copies),
    ("mixing", mix),
    ("sentencepiece", encode),
]

# The classifiers and hashes of the first stages have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared checkpoint folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
