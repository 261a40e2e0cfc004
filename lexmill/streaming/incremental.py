"""Incremental runs: resume by id, and file streams into a deduped table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.functions import text as tx
from lexmill.operators import normalize
from lexmill.plans.staging import materialize, rank_within
from lexmill.sources.readers import path_exists


def pending(rows: DataFrame, done: DataFrame, key: str = "qid") -> DataFrame:
    """Rows of which the key is not done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def finished(rows: DataFrame, upstream: DataFrame, key: str = "qid") -> DataFrame:
    """Rows that the stage before has produced."""
    return rows.join(upstream.select(key).distinct(), key, "left_semi")


def row_slice(rows: DataFrame, start: int = 0, limit: int | None = None, order: str = "ord") -> DataFrame:
    """The rows from ``start`` on, at most ``limit`` of them, as a crawl is cut into runs; places are ranked by ranges."""
    place = F.col("_place") > start if limit is None else F.col("_place").between(start + 1, start + limit)
    placed = rank_within(rows.withColumn("_all", F.lit(0)), "_all", order, "_place")
    return placed.where(place).select(*rows.columns)


def append_pending(rows: DataFrame, path: str, key: str = "qid") -> int:
    """Append rows that the table at ``path`` lacks; a rerun adds nothing."""
    spark = rows.sparkSession
    new = pending(rows, spark.read.parquet(path), key) if path_exists(spark, path) else rows
    new = new.dropDuplicates([key])
    count = new.count()
    if count:
        new.write.mode("append").parquet(path)
    return count


def stream_jsonl(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON lines of new files under a folder; lines that are not objects are skipped."""
    lines = spark.readStream.format("text").load(folder).where(F.startswith(F.btrim("value"), F.lit("{")))
    return lines.select(F.from_json("value", schema).alias("j")).select("j.*")


def dedupe_stream(rows: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row of each key; state for keys older than ``delay`` is dropped."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(rows: DataFrame, event_time: str, window: str, delay: str, *by: str) -> DataFrame:
    """Events per time window and group; late rows are taken until ``delay``."""
    return rows.withWatermark(event_time, delay).groupBy(F.window(event_time, window), *by).agg(F.count("*").alias("events"))


def stream_to_table(rows: DataFrame, path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append each micro-batch's new keys once; a batch that is run again adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        append_pending(batch, path, key)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_two_keys_to_table(rows: DataFrame, path: str, checkpoint: str, key: str, other: str, order: str = "ord") -> StreamingQuery:
    """Append the rows that a scan in order would keep, dropping a row of which either key was kept before.

    A micro-batch first loses what shares a key with the rows of other batches in the
    table, then is scanned by itself, so as long as order grows with the batches the
    table is that of one scan over everything.  Each batch has a partition of its own,
    which a batch that runs again replaces; what was kept survives a restart as data.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, new = batch.sparkSession, batch
        if path_exists(spark, path):
            kept = spark.read.parquet(path).where(F.col("batch") != number)
            for name in (key, other):
                new = new.join(kept.select(name).distinct(), name, "left_anti")
        kept_now = normalize.two_key_dedupe(materialize(new.select(*batch.columns)), key, other, order)
        kept_now.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def text_key(text: str = "text"):
    """Content key for streams whose rows carry no id."""
    return tx.sha1_text(F.col(text))
