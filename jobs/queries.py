"""The jobs as registered queries: each runs twice into one new folder, and what it holds then is returned."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.plans import oracle
from lexmill.plans.staging import shared_dir

from . import keyword_index, result_package


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def job1_keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "job1")
    for _ in range(2):
        keyword_index.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/index", f"{folder}/checkpoint", keyword_index.read_config() | {"buckets": 8})
    return keyword_index.postings(spark, f"{folder}/index").select("token", F.col("rowid").alias("doc_id"), "f", "dl")


def job2_result_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "job2")
    for _ in range(2):
        result_package.run(spark, f"{sf_dir}/benchmark.parquet", f"{sf_dir}/documents.parquet", f"{sf_dir}/conversations.parquet", folder)
    return result_package.results(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_keyword_index": job1_keyword_index, "job2_result_package": job2_result_package}

ORACLE_SQL: dict[str, str] = {
    "job1_keyword_index": f"""
        WITH d AS (SELECT doc_id, {oracle.index_list('text')} AS w FROM documents WHERE doc_id IS NOT NULL), t AS (SELECT doc_id, len(w)::INT AS dl, unnest(w) AS token FROM d)
        SELECT token, doc_id, count(*)::INT AS f, dl FROM t GROUP BY token, doc_id, dl""",
    "job2_result_package": oracle.result_package(result_package.read_config()["least_answer_score"]),
}
