"""Line deduplication on overlapping windows of three lines.

Windows are runs of three consecutive lines that hold a word (blank lines
between them are passed over), hashed to 128 bits.  The first occurrence of a
window, by document id and position, stays; in every later one its lines are
covered, covered positions of a document are merged, and the covered lines go.
Hashes are counted with map-side combination, so a window that a third of the
corpus shares is one row per task before the shuffle.  Where repeated windows
are too many for a broadcast, the most frequent ones are broadcast all the same.

Defined cases: null text is kept as null; documents of fewer than three lines
with a word have no window; a very long text is one row, whose lines and hashes
must fit a task; rows equal in id and text are one document and get the same
result; of rows tied in id the order of their texts' hashes decides; a null id
comes first in order; blank lines are never removed; an empty table gives an
empty result; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, small_or_shuffled

WINDOW = 3


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _full_lines(lines: Column) -> Column:
    """Positions of the lines that hold a word."""
    placed = F.transform(lines, lambda line, i: F.when(line.rlike(r"[^\x20\x09-\x0D]"), i))
    return F.filter(placed, lambda i: i.isNotNull())


def window_hashes(text: Column) -> Column:
    """128-bit hash of each window of a text, in order."""

    def hashes(lines: Column) -> Column:
        joined = lambda full, i: F.concat_ws("\n", *[F.get(lines, F.get(full, i + k)) for k in range(WINDOW)])
        return _let(_full_lines(lines), lambda full: F.when(F.size(full) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(full) - WINDOW), lambda i: F.unhex(F.md5(joined(full, i))))))

    return _let(F.split(text, "\n"), hashes)


def document_key(doc_id: Column, text: Column) -> Column:
    """128 bits of id and text; rows that share them are one document."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))))


def repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places (key, i) of windows that an earlier place holds too, as key and array of i."""
    text = F.col(f"`{text_col}`")
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), document_key(F.col(f"`{id_col}`"), text).alias("key"), window_hashes(text).alias("hashes"))
    places = keyed.select("doc_id", "key", F.posexplode("hashes").alias("i", "hash"))
    first = F.min(F.struct("doc_id", "key", "i"))
    repeated = materialize(places.groupBy("hash").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1"))
    joined = join_counted(places, repeated, "hash", "n")
    later = joined.where(~((F.col("key") == F.col("first.key")) & (F.col("i") == F.col("first.i"))))
    return later.groupBy("key").agg(F.collect_set("i").alias("later"))


def _kept_lines(lines: Column, later: Column) -> Column:
    def kept(full: Column) -> Column:
        covered = F.flatten(F.transform(later, lambda i: F.transform(F.sequence(i, i + WINDOW - 1), lambda k: F.get(full, k))))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        return F.transform(stay, lambda p: F.get(lines, p))

    return _let(_full_lines(lines), kept)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, drop_emptied: bool = False, counts: bool = False) -> DataFrame:
    """The documents with later repeats of three-line windows cut from the text.

    ``length_col`` is a column that holds the text's length and is set anew where
    the text changes.  With ``drop_emptied`` documents that lose their last word
    go.  With ``counts`` the result also has n_lines and n_removed, which take the
    place of columns of these names.
    """
    later = materialize(repeated_windows(docs, id_col=id_col, text_col=text_col)).withColumnRenamed("key", "_key").withColumnRenamed("later", "_later")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.col(f"row.`{text_col}`")
    keyed = docs.select(row.alias("row"), document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_key"))
    held = later.agg(F.count("*"), F.sum(F.size("_later"))).first()
    joined = keyed.join(small_or_shuffled(later, held[0], 64 + 4 * (held[1] or 0) // max(1, held[0])), "_key", "left")
    cut = joined.withColumn("_text", F.when(F.col("_later").isNull(), text).otherwise(_let(F.split(text, "\n"), lambda lines: F.array_join(_kept_lines(lines, F.col("_later")), "\n"))))
    changed = F.col("_later").isNotNull()
    if drop_emptied:
        cut = cut.where(~changed | F.col("_text").rlike(r"[^\x20\x09-\x0D]"))
    lines = lambda t: F.coalesce(F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1), F.lit(0)).cast("long")
    new = {"n_lines": lines(text), "n_removed": lines(text) - lines(F.col("_text"))} if counts else {}
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {text_col: F.col("_text")}
    if length_col is not None:
        columns[length_col] = F.when(changed, F.length("_text")).otherwise(columns[length_col]).cast(docs.schema[length_col].dataType)
    return cut.select(*[value.alias(c) for c, value in (columns | new).items()])
