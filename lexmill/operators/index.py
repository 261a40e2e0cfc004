"""Stored keyword index: written batch by batch, read by a search without any text.

An index is a folder of Parquet tables.  ``settings`` has the numbers of buckets and
shards; the others have a partition per batch:

* ``postings`` also partitioned by bucket, the hash of the token, so that a search opens
  only the buckets of its tokens.  A row is a block, the postings of a token in one shard
  of the rows: (token, shard, rows, most, shortest) tell how many they are and what bounds
  their scores, and the lists (rowids, fs, dls, places) hold them; a place is
  column * 2**32 + position.  A search that asks for bounds reads no list;
* ``lengths`` (rowid, dl) of every row, also of those without a token.

A shard is a hash class of row ids, so all postings of a row lie in one shard and
its score is known from that shard alone.  Rows are dealt by shard once, with their
texts, and blocks are made where they lie: no posting is shuffled.  A large shard makes
several blocks of a token, so no task holds more than a slice of it.  A search scores
the shards that promise most first; shards of which the bound is below the k-th score
found so far are not scored.  Results equal those of ``bm25.bm25_search``.

Ids are longs; rows without one are left out.  Writing a batch again replaces it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.tokens import index_text
from lexmill.plans.staging import BROADCAST_ROWS, materialize, partitions, small_or_shuffled
from lexmill.sources.readers import path_exists

from . import bm25

#: Partitions by token and hash classes of rows of a new index; shards that a search scores before it skips any.
BUCKETS, SHARDS, FIRST_SHARDS = 64, 1024, 8
#: Bytes of text that Python holds at a time; rows that ask for another task (no more tasks than shuffle partitions).
SLICE_BYTES, TASK_ROWS = 8 << 20, 2048
BLOCK = "token string, shard int, rows long, most int, shortest int, rowids array<long>, fs array<int>, dls array<int>, places array<array<long>>"
SCHEMAS = {"postings": f"{BLOCK}, batch int, bucket int"}


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(token), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, *by: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _settings(spark: SparkSession, path: str, buckets: int = BUCKETS, shards: int = SHARDS) -> tuple[int, int]:
    """Buckets and shards of the index; the first batch sets them."""
    if not path_exists(spark, f"{path}/settings/_SUCCESS"):
        return buckets, shards
    return tuple(spark.read.parquet(f"{path}/settings").first())


def _words(rows: DataFrame, columns: list[str], row_id: str, shard: Column) -> DataFrame:
    """(rowid, shard, dl, c0, c1, ...) of rows: the tokens of each column joined by blanks, and how many all are."""
    names = [f"c{i}" for i in range(len(columns))]
    texts = rows.select(F.col(row_id).cast("long").alias("rowid"), shard.alias("shard"), *[index_text(F.col(c)).alias(n) for c, n in zip(columns, names, strict=True)])
    count = lambda c: F.when(F.col(c) == "", 0).otherwise(1 + F.octet_length(c) - F.octet_length(F.replace(F.col(c), F.lit(" "))))
    return texts.select("rowid", "shard", sum((count(n) for n in names), F.lit(0)).alias("dl"), *names)


def _slice_blocks(part: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    """The blocks of rows that stand in order of shard and id."""
    words, owners, places = [], [], []
    for i, column in enumerate(columns):
        lists = pc.split_pattern(part.column(column), " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        values = lists.flatten()
        owner = np.repeat(np.arange(part.num_rows), sizes)
        place = (i << 32) + np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        there = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0  # an empty text is split into one empty word
        words.append(values.filter(pa.array(there)))
        owners.append(owner[there])
        places.append(place[there])
    owner, place = np.concatenate(owners), np.concatenate(places)
    named = pa.concat_arrays(words).dictionary_encode()
    key = named.indices.to_numpy(zero_copy_only=False).astype(np.int64) * part.num_rows + owner
    order = np.argsort(key, kind="stable")  # places of a row stay in order
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))  # of each posting
    f = np.diff(first, append=len(key)).astype(np.int32)
    code, row = np.divmod(key[first], part.num_rows)
    dl = np.bincount(owner, minlength=part.num_rows).astype(np.int32)[row]
    shard = part.column("shard").to_numpy(zero_copy_only=False)[row]
    block = np.flatnonzero(np.diff(code, prepend=-1) | np.diff(shard, prepend=-1))
    listed = lambda offsets, end, values: pa.ListArray.from_arrays(pa.array(np.append(offsets, end), pa.int32()), values)
    held = lambda values: listed(block, len(first), values)
    bound = lambda least, values: least.reduceat(values, block) if len(block) else values
    rows = np.diff(block, append=len(first)).astype(np.int64)
    arrays = [named.dictionary.take(pa.array(code[block])), pa.array(shard[block], pa.int32()), pa.array(rows), pa.array(bound(np.maximum, f)), pa.array(bound(np.minimum, dl))]
    arrays += [held(part.column("rowid").take(pa.array(row))), held(pa.array(f)), held(pa.array(dl)), held(listed(first, len(key), pa.array(place[order])))]
    return pa.RecordBatch.from_arrays(arrays, ["token", "shard", "rows", "most", "shortest", "rowids", "fs", "dls", "places"])


def _blocks(words: DataFrame) -> DataFrame:
    """Blocks (``BLOCK``) of ``_words`` where they lie, one for each token and shard in a slice of the rows."""
    columns = words.columns[3:]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.lexsort([batch.column(c).to_numpy(zero_copy_only=False) for c in ("rowid", "shard")])
            rows = batch.take(pa.array(order))
            ends = np.cumsum(sum(pc.binary_length(rows.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)) // SLICE_BYTES
            cuts = [*np.flatnonzero(np.diff(ends, prepend=-1)), len(ends)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                yield _slice_blocks(rows.slice(start, end - start), columns)

    return words.mapInArrow(make, BLOCK)


def unfolded(blocks: DataFrame) -> DataFrame:
    """(token, rowid, shard, f, dl, packed), a row for each posting of the blocks."""
    each = blocks.select("token", "shard", "fs", "dls", "places", F.posexplode("rowids").alias("i", "rowid"))
    return each.select("token", "rowid", "shard", F.get("fs", "i").alias("f"), F.get("dls", "i").alias("dl"), F.get("places", "i").alias("packed"))


def _row_postings(rows: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """(token, rowid, dl, packed) of each distinct token of a row; a place is column * 2**32 + position, in order."""
    return unfolded(_blocks(_words(rows, columns, row_id, F.lit(0)))).select("token", "rowid", "dl", "packed")


def postings(spark: SparkSession, path: str) -> DataFrame:
    """``unfolded`` blocks of the whole index."""
    return unfolded(spark.read.schema(SCHEMAS["postings"]).parquet(f"{path}/postings"))


def _store(words: DataFrame, rows: int, path: str, batch: int, buckets: int, shards: int) -> None:
    """Write so many rows of materialised words as one batch."""
    spark = words.sparkSession
    if not path_exists(spark, f"{path}/settings/_SUCCESS"):
        spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(shards).alias("shards")).write.mode("overwrite").parquet(f"{path}/settings")
    # a task writes a file for each bucket, so few rows are left to few tasks
    dealt = words.coalesce(min(partitions(spark), 1 + rows // TASK_ROWS))
    blocks = _blocks(dealt).select("*", F.lit(batch).alias("batch"), _bucket(F.col("token"), buckets).alias("bucket"))
    _write(blocks, f"{path}/postings", "batch", "bucket")
    _write(dealt.select("rowid", "dl", F.lit(batch).alias("batch")), f"{path}/lengths", "batch")


def add_rows(rows: DataFrame, path: str, batch: int, columns: list[str], *, row_id: str = "rowid", buckets: int = BUCKETS, shards: int = SHARDS) -> int:
    """Index the rows whose id no other batch holds, one row of each id; returns how many.  A batch that runs again gives the same."""
    spark = rows.sparkSession
    buckets, shards = _settings(spark, path, buckets, shards)
    text = F.struct(*[F.col(c) for c in columns])
    given = rows.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("long").alias("rowid"), text.alias("_t"), F.lit(False).alias("_known"))
    if path_exists(spark, f"{path}/lengths"):
        known = spark.read.parquet(f"{path}/lengths").where(F.col("batch") != batch)
        given = given.unionByName(known.select("rowid", F.lit(None).cast(given.schema["_t"].dataType).alias("_t"), F.lit(True).alias("_known")))
    # one shuffle deals the texts by shard, and finds repeated and known ids
    dealt = given.withColumn("shard", F.pmod(F.xxhash64("rowid"), F.lit(shards)).cast("int")).repartition(partitions(spark), "shard")
    new = dealt.groupBy("shard", "rowid").agg(F.min("_t").alias("_t"), F.max("_known").alias("_known")).where("not _known")
    words = materialize(_words(new.select("rowid", "shard", "_t.*"), columns, "rowid", F.col("shard")))
    count = words.count()
    if count:
        _store(words, count, path, batch, buckets, shards)
    return count


def _postings(spark: SparkSession, path: str, tokens: DataFrame, table: str = "postings") -> DataFrame:
    """The blocks of the named tokens; only their buckets are opened."""
    rows = spark.read.schema(SCHEMAS[table]).parquet(f"{path}/{table}")  # a table without a row has no file to tell its columns
    wanted = sorted(r["bucket"] for r in tokens.select("bucket").distinct().collect())  # at most the index's buckets
    rows, count = rows.where(F.col("bucket").isin(wanted)), tokens.count()
    if count <= BROADCAST_ROWS:  # most blocks are of other tokens, and a number is looked up faster than a word
        rows = rows.join(F.broadcast(tokens.select(F.xxhash64("token").alias("_h"))), F.xxhash64("token") == F.col("_h"), "left_semi")
    return rows.join(small_or_shuffled(tokens.select("token"), count), "token", "left_semi")


def _phrase_counts(hits: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, rowid, shard, f, dl) of phrases (key, phrase) of several tokens: places that continue each other."""
    parts = phrases.select("key", F.size("phrase").alias("n"), F.posexplode("phrase").alias("i", "token"))
    starts = hits.join(F.broadcast(parts), "token").select("key", "n", "rowid", "shard", "dl", "i", F.explode("packed").alias("p"))
    whole = starts.groupBy("key", "n", "rowid", "shard", "dl", (F.col("p") - F.col("i")).alias("start")).count().where("count = n")
    return whole.groupBy("key", "rowid", "shard", "dl").agg(F.count("*").alias("f"))


def _weight(f: Column, dl: Column) -> Column:
    return f * (bm25.K1 + 1) / (f + bm25.K1 * (1 - bm25.B + bm25.B * dl / F.col("avgdl")))


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = bm25.TOP, *, digits: int = 9, first_shards: int = FIRST_SHARDS, query_id: str = "qid", text: str = "text") -> DataFrame:
    """(qid, rowid, score, rank) from the stored index, as ``bm25.bm25_search`` gives from the rows."""
    buckets, _ = _settings(spark, path)
    asked = materialize(bm25.query_phrases(queries, query_id, text).groupBy("qid", F.array_join("phrase", " ").alias("key"), "phrase").agg(F.count("*").alias("times")))
    phrases = materialize(asked.select("key", "phrase").distinct())
    tokens = materialize(phrases.select(F.explode("phrase").alias("token")).distinct().withColumn("bucket", _bucket(F.col("token"), buckets)))
    lengths = spark.read.parquet(f"{path}/lengths")
    totals = lengths.agg(F.count("*").alias("n_rows"), F.avg("dl").alias("avgdl"))

    # phrases of several tokens are rare: their matches are found first, and bound a shard like blocks do
    long_phrases = phrases.where("size(phrase) > 1")
    blocks = _postings(spark, path, tokens).groupBy("token", "shard").agg(F.sum("rows").alias("rows"), F.max("most").alias("most"), F.min("shortest").alias("shortest"))
    plain = blocks.join(F.broadcast(phrases.where("size(phrase) = 1").select("key", F.element_at("phrase", 1).alias("token"))), "token").select("key", "shard", "rows", F.col("most").cast("long").alias("most"), "shortest")
    if long_phrases.isEmpty():
        found = None
        bounds = plain
    else:
        parts = materialize(long_phrases.select(F.explode("phrase").alias("token")).distinct().withColumn("bucket", _bucket(F.col("token"), buckets)))
        hits = unfolded(_postings(spark, path, parts))
        found = materialize(_phrase_counts(hits, long_phrases))
        bounds = plain.unionByName(found.groupBy("key", "shard").agg(F.count("*").alias("rows"), F.max("f").alias("most"), F.min("dl").alias("shortest")))
    bounds = materialize(bounds.crossJoin(F.broadcast(totals)))
    held = bounds.groupBy("key").agg(F.sum("rows").alias("n"), F.first("n_rows").alias("n_rows"))
    idf = F.ln((F.col("n_rows") - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weights = held.select("key", F.when(idf > 0, idf).otherwise(bm25.LEAST_IDF).alias("idf")).crossJoin(F.broadcast(totals.select("avgdl")))
    weighted = materialize(asked.select("qid", "key", "times").join(weights, "key").select("qid", "key", (F.col("times") * F.col("idf")).alias("weight"), "avgdl"))
    best = bounds.drop("avgdl").join(weighted, "key").groupBy("qid", "shard").agg(F.sum(F.col("weight") * _weight(F.col("most"), F.col("shortest"))).alias("bound"))
    turn = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("bound"), "shard"))
    plan = materialize(best.withColumn("turn", turn))
    terms = small_or_shuffled(weighted, weighted.count())

    def scored(wanted: DataFrame) -> DataFrame:
        """Scores of the rows of the wanted (qid, shard); blocks lie by shard, and the terms of few queries go to them."""
        near = _postings(spark, path, tokens).select(F.col("token").alias("key"), "shard", "rowids", "fs", "dls")
        if found is not None:
            near = near.unionByName(found.select("key", "shard", F.array("rowid").alias("rowids"), F.array(F.col("f").cast("int")).alias("fs"), F.array("dl").alias("dls")))
        asking = near.repartition(bm25.ROW_PARTS * partitions(spark), "shard").join(terms, "key")
        asking = asking.join(small_or_shuffled(wanted.select("qid", "shard"), wanted.count()), ["qid", "shard"], "left_semi")
        each = asking.select("qid", "shard", "weight", "avgdl", "fs", "dls", F.posexplode("rowids").alias("i", "rowid"))
        part = F.col("weight") * _weight(F.get("fs", "i"), F.get("dls", "i"))
        return each.groupBy("qid", "shard", "rowid").agg(F.round(F.sum(part), digits).alias("score")).drop("shard")

    by = [F.desc("score"), F.asc("rowid")]
    first = materialize(bm25.top_k(scored(plan.where(F.col("turn") <= first_shards)), k, by))
    reached = first.where(F.col("rank") == k).select("qid", F.col("score").alias("least"))
    rest = materialize(plan.where(F.col("turn") > first_shards).join(reached, "qid", "left").where(f"least is null or bound >= least - {10.0**-digits}"))
    # what is below the k-th score so far need not be sorted
    promising = lambda: scored(rest).join(F.broadcast(reached), "qid", "left").where("least is null or score >= least").drop("least")
    found_rows = [first.select("qid", "rowid", "score")] + ([] if rest.isEmpty() else [promising()])
    return bm25.top_k(reduce(DataFrame.unionByName, found_rows), k, by)
