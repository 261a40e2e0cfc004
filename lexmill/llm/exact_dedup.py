"""Exact deduplication with hash groups and a byte comparison inside them.

Main path: DataFrame functions only.  Rows are grouped by a 128-bit content
hash (only hashes are shuffled, pre-aggregated on the map side), then the texts
of groups with several members, and of those only, are grouped by their bytes;
a hash that turns out to stand for different texts is split by its full digest.
Where groups are too many for a broadcast, the largest ones are broadcast all
the same, so no join has a hot key.

Defined cases: null text counts as empty, so null and empty texts are equal;
a very long text is hashed in one row and shuffled only if its hash is shared;
a null id is smaller than any id; rows that repeat an id compete as separate
rows, and of such a tie one row stays; an empty table gives an empty result; columns other
than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, lower_ascii, materialize, small_or_shuffled


def content_hash(digest: Column) -> Column:
    """128 bits of the digest."""
    return F.substring(digest, 1, 32)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fold_case: bool = True, short_hash: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which id of a group stays.  ``short_hash`` maps the hex
    digest to the grouping key; tests shorten it to force collisions.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(keep)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    text = lower_ascii(text) if fold_case else text
    digest = F.sha2(text, 256)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest.alias("text_sha256"), F.monotonically_increasing_id().alias("row_no"))
    rows = materialize(rows).withColumn("hash", short_hash(F.col("text_sha256")))

    pick = F.max if keep == "largest" else F.min

    def groups() -> DataFrame:  # of several members; a text that stands alone needs no row
        sums = rows.groupBy("hash").agg(pick(F.struct("doc_id", "row_no")).alias("stays"), F.count("*").alias("group_size"))
        return materialize(sums.where("group_size > 1"))

    kept = groups()
    texts = docs.select(short_hash(digest).alias("hash"), text.alias("bytes"))
    members = join_counted(texts, kept.select("hash", "group_size"), "hash", "group_size", "left_semi")
    variants = members.groupBy("hash", "bytes").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("texts"))
    collided = materialize(variants.where("texts > 1").select("hash", F.lit(True).alias("collided")))
    if n := collided.count():
        split = rows.join(small_or_shuffled(collided, n), "hash", "left")
        rows = split.withColumn("hash", F.when(F.col("collided"), F.concat("hash", "text_sha256")).otherwise(F.col("hash"))).drop("collided")
        kept = groups()

    joined = join_counted(rows, kept, "hash", "group_size", "left")
    alone = F.col("group_size").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row_no") == F.col("stays.row_no"))).alias("kept"), "text_sha256")
