"""Mixing sources to target weights by capped water-filling.

Main path: DataFrame functions only.  Sizes are words of the whole text.  The
water level rises over a table of one row per source: sources whose share is
above their cap (maximum epochs times their size) are clamped and the excess is
shared again by weight, until none is above; each round is one pre-aggregated
sum.  A source then repeats every document ``floor(target / size)`` times and a
seeded part of its documents once more.  That part is the documents of smallest
seeded hash whose sizes make up the rest, found by radix selection on the hash
(4,096 sums per source and round), so no source is ever gathered or sorted.

Defined cases: null and empty texts have size 0, and are taken as often as their
hash says; a very long text is one row of a large size; documents of equal hash are
taken together or not at all; null source is a source of its own, last
in order; sources of size 0 have target 0; rows that repeat an id are taken
alike; an empty table gives an empty result; other columns are kept by
``mix_documents`` and ignored by ``mix_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import global_rank, materialize, single_spaced, small_or_shuffled, spaced_word_count

HASH_BITS, DIGIT_BITS = 60, 12
#: Documents of one source that the last step of the selection sorts together.
LAST_STEP_ROWS = 4096


def seeded_hash(doc_id: Column, seed: int) -> Column:
    """60 bits of an md5 of id and seed, as a long."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def document_sizes(docs: DataFrame, seed: int, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    spaced = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), single_spaced(F.col(f"`{text_col}`")).alias("spaced"))
    return spaced.select("doc_id", "source", spaced_word_count(F.col("spaced")).alias("size"), seeded_hash(F.col("doc_id"), seed).alias("u"))


def cycled_weights(sources: DataFrame, cycle: list[float]) -> DataFrame:
    """Give sources, by code point with null last, the weights of ``cycle`` in turn."""
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], "place")
    values = F.array(*[F.lit(float(w)) for w in cycle])
    return ranked.withColumn("weight", F.element_at(values, ((F.col("place") - 1) % len(cycle) + 1).cast("int"))).drop("place")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to a table of source, source_size, weight."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = None
    while True:
        clamped = F.lit(False) if level is None else cap < F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(clamped, cap)).alias("full"), F.sum(F.when(~clamped, F.col("weight"))).alias("weight"), F.count_if(clamped).alias("n")).first()
        if level is not None and row["n"] == n:
            break
        n = row["n"]
        if not row["weight"]:
            level = float("inf")
            break
        level = (total - (row["full"] or 0.0)) / row["weight"]
    share = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(cap < share, cap).otherwise(share).cast("double"))


def _thresholds(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source the largest hash that is taken once more (last_u)."""
    active = sizes.join(F.broadcast(sources.select("source", "rest")) if sources.count() <= LAST_STEP_ROWS else sources.select("source", "rest"), sizes["source"].eqNullSafe(sources["source"])).select(sizes["source"], "u", "size", "rest").where("rest > 0")
    active = active.withColumn("base", F.lit(0).cast("long"))
    shift = HASH_BITS - DIGIT_BITS
    while shift >= 0:
        digit = F.shiftright("u", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        sums = active.groupBy("source", digit.alias("digit")).agg(F.sum("size").alias("sum"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("base").alias("base"))
        run = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        after = sums.withColumn("after", F.col("base") + F.sum("sum").over(run))
        hit = materialize(after.where("after >= rest").groupBy("source").agg(F.min(F.struct("digit", (F.col("after") - F.col("sum")).alias("before"), "n")).alias("hit")))
        most = hit.agg(F.max("hit.n"), F.count("*")).first()
        if most[0] is None:
            return hit.select("source", F.lit(None).cast("long").alias("last_u"))
        side = small_or_shuffled(hit, most[1])
        active = active.join(side, active["source"].eqNullSafe(side["source"]) & (digit == side["hit.digit"])).select(active["source"], "u", "size", "rest", F.col("hit.before").alias("base"))
        shift -= DIGIT_BITS
        if most[0] <= LAST_STEP_ROWS:
            break
    values = active.groupBy("source", "u").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("base").alias("base"))
    run = Window.partitionBy("source").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * (F.col("base") + F.sum("size").over(run)) - F.col("size")
    # values below the last digits' bucket are taken: its first value minus one stands for them
    return values.select("source", "u", "rest", middle.alias("middle")).groupBy("source").agg(F.coalesce(F.max(F.when(F.col("middle") <= 2 * F.col("rest"), F.col("u"))), F.min("u") - 1).alias("last_u"))


def mix_plan(docs: DataFrame, *, cycle: list[float] = (3.0, 1.0, 2.0), budget: float = 1.5, max_epochs: float = 2.0, seed: int = 17, weights: DataFrame | None = None, **columns: str) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats, taken.

    ``weights`` is a table (source, weight); without it the weights of
    ``cycle`` go round the sources in code-point order.
    """
    sizes = materialize(document_sizes(docs, seed, **columns))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycled_weights(sources, list(cycle))
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
        sources = sources.join(given, sources["source"].eqNullSafe(given["_source"]), "left").select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sources = materialize(sources)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = water_fill(sources, budget * total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = materialize(sources)
    last = _thresholds(sizes, sources)
    table = materialize(sources.join(last.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").select(F.col("source").alias("_source"), "source_size", "target", "whole", "last_u"))
    side = small_or_shuffled(table, table.count())
    repeats = F.col("whole") + F.coalesce((F.col("u") <= F.col("last_u")).cast("long"), F.lit(0))
    joined = sizes.join(side, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"), "u", "whole", "last_u")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as many times as the plan repeats it."""
    seed = options.get("seed", 17)
    plan = mix_plan(docs, **options)
    table = materialize(plan.groupBy("source").agg(F.first("whole").alias("whole"), F.first("last_u").alias("last")).withColumnRenamed("source", "of"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    name, source = F.col(f"`{options.get('id_col', 'doc_id')}`"), F.col(f"`{options.get('source_col', 'source')}`")
    rows = docs.select(row, source.alias("source"), seeded_hash(name, seed).alias("u"))
    joined = rows.join(small_or_shuffled(table, table.count()), F.col("source").eqNullSafe(F.col("of")))
    taken = F.col("whole") + F.coalesce((F.col("u") <= F.col("last")).cast("long"), F.lit(0))
    return joined.where(taken > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), taken))).select("row.*")
