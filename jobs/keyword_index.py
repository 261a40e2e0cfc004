"""Keeps a stored keyword index up to date with a growing table of documents.

A file stream takes the files that its checkpoint does not know yet, as micro-batches
of bounded size, and every micro-batch becomes one batch of the index, in
partitions of its own.  Ids that an earlier batch holds are skipped, so a file that
repeats documents adds only its new ones.  A micro-batch that was cut off is run
again under the same number and replaces its partitions; a run without new files
changes nothing.

    python -m jobs.keyword_index --documents PATH --index PATH --checkpoint PATH [--config FILE]
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators import index

LOG = logging.getLogger("jobs.keyword_index")
CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "keyword_index.json")


def read_config(path: str = CONFIG) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def run(spark: SparkSession, documents: str, index_path: str, checkpoint: str, config: dict[str, Any] | None = None) -> dict[str, int]:
    """Index what is new under ``documents`` (Parquet); returns batches and rows that were added."""
    config = config or read_config()
    key, columns = config["id_column"], config["text_columns"]
    schema = spark.read.parquet(documents).select(key, *columns).schema
    # a stream watches a folder or a glob; a glob that only this path fits also takes a path that names one file
    exact = f"{documents.rstrip('/')[:-1]}[{documents.rstrip('/')[-1]}]"
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(exact)
    added: dict[int, int] = {}

    def take(batch: DataFrame, number: int) -> None:
        added[number] = index.add_rows(batch, index_path, number, columns, row_id=key, buckets=config["buckets"], shards=config["shards"])
        LOG.info("batch %d: indexed %d new rows into %s", number, added[number], index_path)

    LOG.info("reading new files of %s, checkpoint %s", documents, checkpoint)
    stream = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()
    done = {"batches": len(added), "rows": sum(added.values())}
    LOG.info("read %d batches, wrote %d rows", done["batches"], done["rows"])
    return done


def postings(spark: SparkSession, index_path: str) -> DataFrame:
    """The index as it stands: token, rowid, occurrences and the row's length."""
    return index.postings(spark, index_path).select("token", "rowid", "f", "dl")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--documents", required=True)
    parser.add_argument("--index", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--config", default=CONFIG)
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("keyword-index").getOrCreate()
    try:
        run(spark, given.documents, given.index, given.checkpoint, read_config(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
