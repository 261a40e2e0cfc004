"""Materialising intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most rows and bytes of a side that is broadcast; beyond them the same join is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only for a local master."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="lexmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found if ":" in found else f"file://{found}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and cut the lineage there.

    A checkpointed table keeps the size estimate of the plan behind it, which
    grows as a product in loops of joins; the rows are wrapped anew without it.
    """
    session = df.sparkSession
    shared_dir(session)
    done = df.checkpoint(eager=True)._jdf
    rows = session._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False)
    return DataFrame(rows, session)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def small_or_shuffled(side: DataFrame, rows: int, row_bytes: int = 100) -> DataFrame:
    """Hint a broadcast when the counted rows of so many bytes are few; otherwise leave a shuffled join."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES else side


def join_counted(rows: DataFrame, side: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Join to a materialised side with one row a key, of which ``weight`` says how many rows it meets.

    A small side is broadcast.  Of a large one the heaviest keys are, as many as a
    broadcast holds; no other key meets more than its share of the rows, so the
    shuffled join of the rest has no hot key.  ``how`` is inner, left or left_semi.
    """
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c, kind in side.dtypes if kind in ("string", "binary")), F.lit(0))
    lists = [F.size(c) for c, kind in side.dtypes if kind.startswith("array")]
    size = size + sum((32 * F.greatest(n, F.lit(0)) for n in lists), F.lit(0)) + 8 * len(side.columns)
    found = side.agg(F.count("*"), F.sum(weight), F.coalesce(F.max(size), F.lit(1))).first()
    fit = max(1, min(BROADCAST_ROWS, BROADCAST_BYTES // found[2]))  # rows of the largest size that a broadcast holds
    if found[0] <= fit:
        return rows.join(F.broadcast(side), key, how)
    share = -(-found[1] // fit)
    heavy, rest = side.where(F.col(weight) > share), side.where(F.col(weight) <= share)
    met = rows.join(F.broadcast(heavy), key, "left_semi" if how == "left_semi" else "inner")
    others = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return met.unionByName(others.join(rest, key, how))


def join_hot(rows: DataFrame, side: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join to a materialised side with one row a key, of which ``weight`` says how many rows it meets.

    Only keys that alone meet more than a quarter of a partition's share are broadcast,
    at most four a partition whatever the input; the others are shuffled as ever.
    """
    share = (side.agg(F.sum(weight)).first()[0] or 0) // (4 * partitions(rows.sparkSession))
    heavy = side.where(F.col(weight) > share)
    if heavy.isEmpty():
        return rows.join(side, key)
    met = rows.join(F.broadcast(heavy), key)
    others = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return met.unionByName(others.join(side.where(F.col(weight) <= share), key))


def rank_within(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """1-based place of each row in its group by a unique column; a large group is ranked by many tasks.

    Rows are dealt by ranges of group and order and numbered inside their range.  Only
    groups that go over the end of a range need to know how many of them stand before;
    there are at most two of those a partition.
    """
    placed = df.repartitionByRange(partitions(df.sparkSession), group, order).withColumn("_rank_part", F.spark_partition_id())
    placed = materialize(placed)
    counts = placed.groupBy(group, "_rank_part").agg(F.count("*").alias("_rank_n"))
    by_group = Window.partitionBy(group)
    earlier = F.coalesce(F.sum("_rank_n").over(by_group.orderBy("_rank_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    split = counts.withColumn("_rank_parts", F.count("*").over(by_group)).withColumn("_rank_before", earlier).where("_rank_parts > 1").select(F.col(group).alias("_rank_group"), F.col("_rank_part").alias("_rank_at"), "_rank_before")
    inside = placed.withColumn("_rank_i", F.row_number().over(Window.partitionBy("_rank_part", group).orderBy(order)))
    joined = inside.join(F.broadcast(split), F.col(group).eqNullSafe(F.col("_rank_group")) & (F.col("_rank_part") == F.col("_rank_at")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_rank_i") + F.coalesce("_rank_before", F.lit(0))).cast("long").alias(name))
