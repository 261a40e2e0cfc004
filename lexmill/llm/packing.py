"""Packing token sequences by minimum bin slack.

There are at most ``capacity`` different piece lengths, so the whole packing is
planned on a histogram of lengths, whatever the number of documents: for each
bin a bitset subset-sum search over the lengths still available, starting from
the longest, finds the fullest feasible combination; it is removed as many
times as the counts allow.  Each repetition uses up at least one length, so the
plan stays at a few thousand combinations.  Pieces get their rank among pieces
of equal length from salted partial counts, and a rank is a place in the plan.

Defined cases: null and empty texts hold the end id alone; documents over the
capacity, however long, are cut into pieces of that length of which the first may be
shorter, and the ids of one document must fit a worker; pieces of equal length are
interchangeable, so ties among them go by document and piece; rows that repeat a
document are packed each; null ids are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, small_or_shuffled
from .tokens import CACHE_ENTRIES

CAPACITY = 1024
END_ID = 2
#: Pieces that one salt of a length is meant to hold, and most salts of a length.
SALT_PIECES, MAX_SALTS = 5_000, 4096

PIECE_FIELDS = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


def cut_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, cache_entries: int = CACHE_ENTRIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    end = np.uint32(end_id).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lexmill.llm.tokens import encoder

        encode = encoder(tokenizer_path, cache_entries).encode
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                row, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    ids = encode(text) + end
                    total = len(ids) // 4
                    a, b, k = 0, (total - 1) % capacity + 1, 0
                    while a < total:
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                        a, b, k = b, b + capacity, k + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return rows.mapInArrow(cut, T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *PIECE_FIELDS]))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths that fills ``room`` best (length -> how many)."""
    reach, steps = 1, []
    limit = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        many, power = min(counts[length], room // length), 1
        while many:  # binary splitting: 1, 2, 4, ... and the rest
            used = min(power, many)
            steps.append((length, used, reach))
            reach |= (reach << (length * used)) & limit
            many -= used
            power *= 2
        if reach >> room & 1:
            break
    left, taken = reach.bit_length() - 1, {}
    for length, used, before in reversed(steps):
        if not before >> left & 1:
            left -= length * used
            taken[length] = taken.get(length, 0) + used
    return taken


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(repetitions, combination) pairs that use up all counts."""
    counts, plan = {k: v for k, v in counts.items() if v}, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        combination = fullest({k: v for k, v in counts.items() if v}, capacity - longest)
        counts[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in combination.items())
        for k, n in combination.items():
            counts[k] -= times * n
            if not counts[k]:
                del counts[k]
        plan.append((times, combination))
    return plan


def place_table(plan: list[tuple[int, dict[int, int]]], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces per bin, first bin, first offset), sorted."""
    rank, rows, first_bin = dict.fromkeys(range(capacity + 1), 0), [], 0
    for times, combination in plan:
        offset = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            rows.append((length, rank[length], n, first_bin, offset))
            rank[length] += times * n
            offset += length * n
        first_bin += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a materialised table of pieces."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = place_table(plan_bins(counts, capacity), capacity)
    salts = int(min(MAX_SALTS, 1 + sum(counts.values()) // SALT_PIECES))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    sums = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside)).join(small_or_shuffled(base, (capacity + 1) * salts), ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("base") + F.col("rank") - 1).alias("rank"))
    wide = int(table[:, 1].max()) + 1 if len(table) else 1
    wide = max(wide, sum(counts.values()) + 1)
    keys = table[:, 0] * wide + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = table[np.searchsorted(keys, length * wide + rank, "right") - 1]
            behind = rank - at[:, 1]
            columns = [*batch.columns[:-1], pa.array(at[:, 3] + behind // at[:, 2]), pa.array(at[:, 4] + behind % at[:, 2] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = END_ID, cache_entries: int = CACHE_ENTRIES, **columns: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``cache_entries`` bounds the chunks that a worker keeps; more save time
    where the workers' memory is not shared with other stages.
    """
    pieces = materialize(cut_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, cache_entries=cache_entries, **columns))
    return pack_pieces(pieces, capacity=capacity)
