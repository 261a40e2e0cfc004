"""Builds the result package of a question set: ranked evidence under each variant's caps, with the best stored answer.

Questions are searched among the documents by keywords, each ranking is cut to the
caps of every result variant, and where a stored question is near enough its answer is
taken.  Results are written as JSON lines with a partition per variant, a summary
of the variants as CSV.  A run replaces the package as a whole, so a run again, or one
after a failure, gives the same files' rows.

    python -m jobs.result_package --questions PATH --documents PATH --conversations PATH --out PATH [--config FILE]
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.operators import bm25, lookup, select
from lexmill.plans.staging import materialize

LOG = logging.getLogger("jobs.result_package")
CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "result_package.json")


def read_config(path: str = CONFIG) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def stored_answers(conversations: DataFrame) -> DataFrame:
    """The first two turns of each conversation as a stored question and answer."""
    said = lambda turn: F.coalesce(F.max(F.when(F.col("turn") == turn, tx.norm_space(F.col("text")))), F.lit(""))
    none = F.array().cast("array<string>")
    rows = conversations.where("turn in (0, 1)").groupBy(F.col("conv_id").alias("id")).agg(said(0).alias("question"), said(1).alias("answer"))
    return rows.select("id", "question", "answer", none.alias("relevant_docs"), none.alias("relevant_articles"))


def run(spark: SparkSession, questions: str, documents: str, conversations: str, out: str, config: dict[str, Any] | None = None) -> dict[str, int]:
    """Write the package under ``out`` from Parquet tables; returns rows read and written."""
    config = config or read_config()
    asked = spark.read.parquet(questions).select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    docs = spark.read.parquet(documents)
    talks = spark.read.parquet(conversations)
    counts = {"questions": asked.count(), "documents": docs.count(), "conversations": talks.count()}
    LOG.info("read %s", ", ".join(f"{n} {name}" for name, n in counts.items()))

    texts = docs.select(F.col("doc_id").alias("rowid"), "text")
    found = bm25.bm25_search(texts, asked.withColumnRenamed("question", "text"), ["text"], config["candidates"], digits=6)
    places = docs.select(F.col("doc_id").alias("rowid"), F.coalesce("source", F.lit("")).alias("doc"))
    citation = F.concat_ws("|", "doc", F.col("rowid").cast("string"))
    ranked = materialize(found.join(places, "rowid").select("qid", citation.alias("citation"), "doc", F.col("rank").alias("pos")))

    best = lookup.answer_candidates(lookup.prepare_rows(stored_answers(talks)), asked, 1)
    near = best.where(F.col("score") >= config["least_answer_score"]).select("qid", F.col("answer_head").alias("answer"), F.array().cast("array<string>").alias("used_articles"))
    results = select.assemble(asked, near, ranked, select.variants(spark))
    results = results.repartition("variant", F.pmod(F.xxhash64("qid"), F.lit(config["files_per_variant"])))
    results.write.mode("overwrite").partitionBy("variant").option("ignoreNullFields", "false").json(f"{out}/results")

    written = spark.read.schema(results.schema).json(f"{out}/results")
    select.variant_summary(written).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{out}/summary")
    counts["results"] = written.count()
    LOG.info("wrote %d results to %s", counts["results"], out)
    return counts


def results(spark: SparkSession, out: str) -> DataFrame:
    """The package as it stands; lists are joined by semicolons."""
    schema = "qid long, question string, answer string, relevant_docs array<string>, relevant_articles array<string>, variant string"
    rows = spark.read.schema(schema).json(f"{out}/results")
    return rows.select("variant", "qid", "question", "answer", F.array_join("relevant_docs", ";").alias("docs"), F.array_join("relevant_articles", ";").alias("articles"))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("questions", "documents", "conversations", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config", default=CONFIG)
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("result-package").getOrCreate()
    try:
        run(spark, given.questions, given.documents, given.conversations, given.out, read_config(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
