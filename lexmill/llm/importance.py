"""Importance resampling of documents towards a target distribution.

A text's features are its runs of 1 to 3 consecutive words, each in the bucket of
its bytes' CRC-32.  A document weighs the sum of its features' gains, the
logarithms of how much likelier a bucket is in the target texts than in the
corpus, and the draw without replacement takes the largest weights after Gumbel
noise that only the id decides.

Features are found by a vectorised byte automaton.  The bytes of an Arrow string
column go through one lookup table, which lower-cases A-Z and marks separators;
words begin and end where neighbouring marks differ.  The CRCs of all runs advance
together, one byte of every run a step, and are read after each word of the run;
words of more than ``LONG_WORD`` bytes go through zlib.  Separators are ASCII, so
cutting bytes is the same as cutting code points.

The corpus is read twice (counts, then weights).  Tasks add up their counts, so a
shuffle holds at most one row a task and bucket; the table of gains has one number
a bucket, whatever the input.  Ranks come from a range partitioning of narrow rows.

Words are runs of code points outside ``\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F`` after
lower-casing A-Z.  Defined cases: null and empty texts have no feature and weight 0;
a very long text is one row, and its runs are hashed in blocks; rows that repeat
count each time and are drawn one by one; a null id draws its noise as ``null`` and
comes last among ties; equal scores go to the smaller id; an empty corpus gives an
empty result, an empty target is counted as no features; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import global_rank, materialize
from .wordhash import LOWER, row_bounds, row_chunks, text_buffers

BUCKETS, MAX_WORDS = 10_000, 3
#: Bytes of a word from which on zlib takes over, bytes of text that are cut at once, and runs that are hashed at once.
LONG_WORD, TEXT_CHUNK, RUN_CHUNK = 48, 2_000_000, 200_000

# Each byte's lower case, or 0 for the bytes that no word holds.
_KIND = np.where(((LOWER >= 0x30) & (LOWER <= 0x39)) | ((LOWER >= 0x61) & (LOWER <= 0x7A)) | (LOWER >= 0x80), LOWER, 0).astype(np.uint8)


def crc_table() -> np.ndarray:
    """The reflected CRC-32 (polynomial 0xEDB88320) of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = crc_table()


def find_words(kinds: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; none goes over a cut (a row's first byte)."""
    inside = kinds != 0
    edge = np.zeros(len(kinds) + 1, dtype=bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = len(kinds) and inside[0], len(kinds) and inside[-1]
    places = np.flatnonzero(edge)
    starts, ends = places[::2], places[1::2]
    cuts = cuts[(cuts > 0) & (cuts < len(kinds))]
    split = np.unique(cuts[inside[cuts] & inside[cuts - 1]])  # two rows' words touch here
    return (np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))) if len(split) else (starts, ends)


def _advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC states after so many more bytes from each start."""
    order = np.argsort(-sizes, kind="stable")  # the runs that go on are always the first ones
    crc, at, size = state[order], starts[order], sizes[order]
    steps = min(int(size[0]), LONG_WORD) if len(size) else 0
    going = np.searchsorted(-size, -np.arange(steps), "left")  # runs longer than each step
    for j in range(steps):
        n = going[j]
        head = crc[:n]
        crc[:n] = _CRC[(head ^ data[at[:n] + j]) & 0xFF] ^ (head >> np.uint32(8))
    for i in range(int(np.searchsorted(-size, -LONG_WORD, "left"))):
        rest = data[at[i] + LONG_WORD : at[i] + size[i]]
        crc[i] = zlib.crc32(rest.tobytes(), int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(crc)
    out[order] = crc
    return out


def run_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, longest: int = MAX_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(CRC-32, row) of the runs of 1 to ``longest`` words, for each length and block of starts."""
    for low in range(0, len(starts), RUN_CHUNK):
        first = np.arange(low, min(low + RUN_CHUNK, len(starts)))
        crc = np.full(len(first), 0xFFFFFFFF, dtype=np.uint32)
        for n in range(longest):
            if n:
                inside = first + n < len(starts)
                inside[inside] = rows[first[inside] + n] == rows[first[inside]]
                first, crc = first[inside], crc[inside]
                crc = _CRC[(crc ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            word = first + n
            crc = _advance(crc, data, starts[word], ends[word] - starts[word])
            yield crc ^ np.uint32(0xFFFFFFFF), rows[first]


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For each range of rows: words of each row, and (bucket, row in the range) of its features in blocks."""
    data, offsets = text_buffers(column)
    for a, b in row_chunks(offsets, TEXT_CHUNK):
        base = int(offsets[a])
        kinds = _KIND[data[base : int(offsets[b])]]
        bounds = offsets[a : b + 1] - base
        starts, ends = find_words(kinds, bounds)
        rows = np.searchsorted(bounds, starts, "right") - 1
        blocks = ((crc % np.uint32(BUCKETS), row) for crc, row in run_crcs(kinds, starts, ends, rows))
        yield np.diff(row_bounds(rows, b - a)), blocks


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) over all features of a one-column table of texts; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, blocks in _features(batch.column(0)):
                for bucket, _ in blocks:
                    total += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))); one number a bucket reaches the driver."""
    counts = bucket_counts(corpus).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(bucket_counts(target).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    s, t = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    ratio = ((t + 1.0) * (s.sum() + float(BUCKETS))) / ((s + 1.0) * (t.sum() + float(BUCKETS)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row (doc_id, text)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words, blocks in _features(batch.column(1)):
                weight = np.zeros(len(words), dtype=np.int64)
                for bucket, row in blocks:
                    if len(row):  # rows are sorted, so each one's features are one slice
                        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                        weight[row[first]] += np.add.reduceat(gains[bucket], first)
                features = sum(np.maximum(words - k, 0) for k in range(MAX_WORDS))
                found.append((words, features, weight))
            columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (zip(*found, strict=True) if found else ([], [], []))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_words", "n_features", "weight"])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))]
    return docs.select("doc_id", "text").mapInArrow(weigh, T.StructType(fields))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, min_words: int = 20, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (of the drawn ones, else null).

    Of the N documents of at least ``min_words`` words, floor(percent * N / 100) are drawn.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    gains = bucket_gains(rows.select("text"), target.select(F.col(f"`{target_text}`").alias("text")))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))
    scored = document_weights(rows, gains).select("doc_id", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"), (F.col("n_words") >= min_words).alias("_able"), F.monotonically_increasing_id().alias("_row"))
    ranked = global_rank(materialize(scored), [F.desc("_able"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")], "place")
    able = ranked.agg(F.count_if("_able")).first()[0]
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("_able") & (F.col("place") <= percent * able // 100), F.col("place")).cast("long").alias("rank"))
