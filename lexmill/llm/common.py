"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.plans.staging import join_counted, join_hot, materialize, partitions, shared_dir, small_or_shuffled

__all__ = ["join_counted", "join_hot", "materialize", "partitions", "shared_dir", "small_or_shuffled"]

#: Words are separated by space and the control characters \x09-\x0D only.
SPACES = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII text takes the faster built-in path."""
    folded = F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)


def single_spaced(text: Column) -> Column:
    """Words joined by one space (null: empty)."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def spaced_word_count(spaced: Column) -> Column:
    """Words of a text that ``single_spaced`` has made."""
    gaps = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based rank over all rows without one task holding them all.

    Rows are range-partitioned and sorted; only the row count of each
    partition reaches the driver.
    """
    index = F.monotonically_increasing_id()
    placed = materialize(df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_place", index))
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, offsets = 0, []
    for row in counts:
        offsets += [F.lit(row["part"]), F.lit(before)]
        before += row["count"]
    if not offsets:
        return placed.drop("_place").withColumn(name, F.lit(None).cast("long"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, F.element_at(F.create_map(*offsets), part) + within + 1).drop("_place")
