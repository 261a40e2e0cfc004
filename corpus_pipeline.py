"""Corpus pipeline: quality rules, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.

Defined cases: a null or empty text fails the base rule and goes in the first stage;
a very long text is one row in every stage; rows that repeat are judged alike, their
repeated lines and the rows themselves go as copies, of ties in the least id every row
stays; columns beyond those of ``documents`` are kept by all stages but the last,
whatever their names; an empty table goes through as an empty table.  The tables
between the stages stay in the shared folder until the session's owner clears it, as
the result is read from the last of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import shared_dir
from lexmill.llm.line_dedup import dedup_lines
from lexmill.llm.mixing import mix_documents
from lexmill.llm.ngram_join import drop_near_duplicates
from lexmill.llm.packing import pack_documents
from lexmill.llm.quality import filter_quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the cascade keep."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of three-line windows are cut; a document left without a word goes."""
    return dedup_lines(docs, length_col="n_chars", drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return drop_near_duplicates(docs, words_per_gram=5, threshold=(80, 100))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share says."""
    return mix_documents(docs, cycle=[3.0, 1.0, 2.0], budget=1.5, max_epochs=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Tokens cannot be expressed in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            out.write.parquet(path := f"{folder}/{k}-{name}")
            out = spark.read.parquet(path)
        docs = out
    return docs
