"""Substring deduplication with prefix-partitioned suffix trees.

A window of ``window`` words repeats when two suffixes of the corpus share a
path of that depth.  Not every suffix is needed for that: each window holds an
anchor, the word n-gram of smallest hash in it (the leftmost of equal ones), and
the suffixes that start at anchors, with the words before them, form a sparse
suffix tree that still meets every window.  A run is the stretch of adjacent
windows around one anchor (about a dozen), shipped once as its words.

1. Runs are counted by their prefix.  A prefix is the anchor's words; where a
   sample of the documents says that more than ``SPLIT_WINDOWS`` windows stand
   behind one anchor, it is the whole window; prefixes have these two lengths.  Suffixes whose
   prefix occurs once have no repeat and go no further, so words are shipped for
   the others only.
2. The words of the rest are grouped by prefix.  A group fits in memory: a short
   prefix by the bound, a full one because its texts are equal.  Equal texts are
   kept once, in every batch and again in the group, so a passage of a third of
   the corpus is one row per batch.
3. In a group the suffixes are sorted, and the shared words of neighbours give
   the nodes of the tree.  Below a node of depth d its suffixes share d words from
   the anchor on; the words they share before it are found by sorting the same
   leaves by what precedes.  Where both make up a window the node is a maximal
   repeat and its windows are reported.

Hashes only decide which suffixes meet; that words are equal is seen on the words.
Words are runs of code points other than space and ``\\x09-\\x0D``, compared
unchanged.  Every word covered by a repeated window goes, in all places.
Defined cases: null and empty texts have no words; texts shorter than the
window lose nothing; a very long text is one row, its words and runs must fit a
worker; rows that repeat are each other's copies and lose all windows, there is
no order among ties; null ids are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions
from .wordhash import U64, combine, gram_hashes, row_chunks, text_buffers, word_hashes, words

WINDOW, ANCHOR = 35, 12
#: Windows of an anchor above which its prefixes are longer, the share of documents counted to find such anchors, and most of them.
SPLIT_WINDOWS, COUNTED, MOST_SPLIT = 65_536, 16, 4_000_000
#: Bytes of text hashed at a time, bytes of runs compared at a time before they are shipped.
TEXT_CHUNK, SHIP_BYTES = 4_000_000, 32_000_000
#: A place is a long: check of the document (8 bits), first window (31), windows (11), words before the anchor (11),
#: prefix also stands earlier in its part (1), prefix stands elsewhere or run repeats (1).
_CHECK, _FIRST, _SIZE, _AT, _LATER, _TWICE = 55, 24, 13, 2, 2, 1
_PLACE_BITS = U64(31)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    best, have = values, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    return best


def anchor_runs(hashes: np.ndarray, rows: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, words before the anchor and anchor hash of each run.

    A run is a longest stretch of windows of one row with the same anchor
    occurrence; windows are numbered by their first word.
    """
    count = len(hashes) - window + 1
    none = np.zeros(0, dtype=np.int64)
    if count <= 0:
        return none, none, none, np.zeros(0, U64)
    grams = gram_hashes(hashes, anchor)
    place = np.arange(len(grams), dtype=U64)
    least = _sliding_min((grams >> _PLACE_BITS << _PLACE_BITS) | place, window - anchor + 1)[:count]
    valid = np.flatnonzero(rows[:count] == rows[window - 1 :])
    at = (least[valid] & U64((1 << 31) - 1)).astype(np.int64)
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(valid)))
    return valid[first], sizes, at[first] - valid[first], grams[at[first]]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each size, concatenated."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def _runs(batch: pa.RecordBatch, column: int, window: int, anchor: int) -> Iterator[tuple]:
    """Offset of the rows, begin of each row, rows and hashes of words, and runs of a part of the batch."""
    data, offsets = text_buffers(batch.column(column))
    for a, b in row_chunks(offsets, TEXT_CHUNK):
        starts, ends, rows = words(data, offsets[a : b + 1])
        hashes = word_hashes(data, starts, ends)
        runs = anchor_runs(hashes, rows, window, anchor)
        if len(runs[0]):
            yield a, np.searchsorted(rows, np.arange(b - a)), rows, hashes, *runs


def _first_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys equal an earlier one, and which equal any other."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = np.zeros(len(order), dtype=bool)
    later[order[1:][same]] = True
    twice = later.copy()
    twice[order[:-1][same]] = True
    return later, twice


def _count(window: int, anchor: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, hashes, first, sizes, _, anchors in _runs(batch, 0, window, anchor):
                labels = gram_hashes(hashes, window)
                later, _ = _first_of(combine(combine(labels[first], labels[first + sizes - 1]), sizes.astype(U64)))
                yield pa.RecordBatch.from_arrays([pa.array(anchors[~later].view(np.int64)), pa.array(sizes[~later])], names=["anchor", "windows"])

    return count


def split_anchors(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, split_windows: int = SPLIT_WINDOWS, counted: int = COUNTED) -> np.ndarray:
    """Anchors of more than about ``split_windows`` windows, sorted.

    They are counted on one document of ``counted``, and one that stands in half
    as many by this sample is listed too, so that hardly one is missed; a miss
    costs memory, never the result.  The list holds ``MOST_SPLIT`` at most, the
    most frequent ones, so beyond 1e11 words the bound rises with the corpus.
    """
    sample = docs.where(F.pmod("loc", F.lit(counted)) == 0).select("text")
    sums = sample.mapInArrow(_count(window, anchor), "anchor long, windows long").groupBy("anchor").agg(F.sum("windows").alias("windows"))
    often = sums.where(F.col("windows") * (2 * counted) >= split_windows).orderBy(F.desc("windows"), "anchor").limit(MOST_SPLIT)
    found = [r[0] for r in often.select("anchor").collect()]
    return np.sort(np.array(found, dtype=np.int64).view(U64))


def _emit(window: int, anchor: int, split: np.ndarray):
    """Rows (loc, check, text) -> prefixes (key, loc, place) without words; equal keys of a part meet here."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            locs, checks = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for a, begin, rows, hashes, first, sizes, at, keys in _runs(batch, 2, window, anchor):
                if len(split) and (wide := np.isin(keys, split)).any():
                    own = np.flatnonzero(wide)
                    run, where = np.repeat(own, sizes[own]), _spread(first[own], sizes[own])
                    whole = combine(keys[run], gram_hashes(hashes, window)[where])
                    keys = np.concatenate([keys[~wide], whole])
                    at = np.concatenate([at[~wide], at[run] - (where - first[run])])
                    first, sizes = np.concatenate([first[~wide], where]), np.concatenate([sizes[~wide], np.ones(len(where), dtype=np.int64)])
                later, twice = _first_of(keys)
                row = rows[first]
                place = (checks[a + row] << _CHECK) | ((first - begin[row]) << _FIRST) | (sizes << _SIZE) | (at << _AT) | (later * _LATER) | (twice * _TWICE)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(locs[a + row]), pa.array(place)], names=["key", "loc", "place"])

    return emit


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, loc and place, those whose key occurs twice; equal rows once."""
    held: pa.RecordBatch | None = None
    held_known = False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys, locs, places = (batch.column(i).to_numpy() for i in range(3))
        same = keys[1:] == keys[:-1]
        known = (places & _TWICE) > 0
        known[0] |= held_known
        known[1:] |= same
        known[:-1] |= same
        repeat = np.zeros(len(keys), dtype=bool)
        repeat[1:] = same & (locs[1:] == locs[:-1]) & (places[1:] >> _AT == places[:-1] >> _AT)
        held, held_known = batch.slice(len(keys) - 1), bool(known[-1])
        # the last row waits for the next batch; a repeated one is told by the row before it
        out = np.flatnonzero(known[:-1] & ~repeat[1:])
        yield batch.take(pa.array(out))
    if held is not None and held_known:
        yield held


def _ship(window: int):
    """Rows (loc, check, doc_id, text, prefixes) -> the words of each run; equal runs of a part once."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int] = []
        locs: list[int] = []
        places: list[int] = []
        runs: list[bytes | None] = []
        seen: dict[bytes, int] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(locs, pa.int64()), pa.array(places, pa.int64()), pa.array(runs, pa.binary())], names=["key", "loc", "place", "run"])

        for batch in batches:
            loc_of, check_of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                loc, found = loc_of[i], batch.column(3)[i].as_py().encode().split()
                spaced = b" ".join(found)
                begins = np.zeros(len(found) + 1, dtype=np.int64)
                np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=begins[1:])
                prefixes = batch.column(4)[i].values
                place_of = prefixes.field("place").to_numpy()
                mine = np.flatnonzero(place_of >> _CHECK == check_of[i])  # another document may share loc, not check too
                place_of = place_of[mine]
                first, size = place_of >> _FIRST & 0x7FFFFFFF, place_of >> _SIZE & 0x7FF
                key_of = prefixes.field("key").to_numpy()[mine].tolist()
                for key, place, a, b in zip(key_of, (place_of & ~(_LATER | _TWICE)).tolist(), begins[first].tolist(), (begins[first + size + window - 1] - 1).tolist(), strict=True):
                    run = spaced[a:b]
                    known = seen.get(run)
                    if known is None:
                        seen[run] = len(keys)
                        held += len(run)
                    else:
                        places[known] |= _TWICE
                        key, place, run = (key ^ loc ^ place * 0x9E3779B1) & 0x7FFFFFFFFFFFFFFF, place | _TWICE, None
                    keys.append(key)
                    locs.append(loc)
                    places.append(place)
                    runs.append(run)
                if held >= SHIP_BYTES:
                    yield flush()
                    for part in (keys, locs, places, runs, seen):
                        part.clear()
                    held = 0
        if keys:
            yield flush()

    return ship


def shared_words(a: bytes, b: bytes) -> int:
    """Words that two texts share from their start; every word ends with a space."""
    size = min(len(a), len(b))
    if a[:size] != b[:size]:
        differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
        size -= (differ.bit_length() + 7) // 8
    return a.count(b" ", 0, size)


def tree_nodes(depths: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Inner nodes (depth, first leaf, leaf behind the last) of at least a depth, from the depths shared by neighbouring leaves."""
    stack: list[tuple[int, int]] = []
    for k in range(1, len(depths) + 2):
        depth = depths[k - 1] if k <= len(depths) else 0
        left = k - 1
        while stack and stack[-1][0] > depth:
            inner, left = stack.pop()
            yield inner, left, k
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))


def repeated_offsets(runs: list[bytes], ats: list[int], window: int) -> list[int]:
    """Per run, a bit mask over the words before the anchor: bit j says that the window starting j words before it repeats.

    The runs differ from each other; ``ats`` are the words before their anchors.
    """
    after, before = [], []
    for run, at in zip(runs, ats, strict=True):
        split = run.split(b" ")
        after.append(b" ".join(split[at:]) + b" ")
        before.append(b"".join(w + b" " for w in reversed(split[:at])))
    leaves = sorted(range(len(runs)), key=after.__getitem__)
    rank = {leaf: i for i, leaf in enumerate(sorted(range(len(runs)), key=before.__getitem__))}
    depths = [min(window, shared_words(after[a], after[b])) for a, b in zip(leaves, leaves[1:], strict=False)]
    masks = [0] * len(runs)
    for depth, low, high in tree_nodes(depths, window - max(ats)):
        members = sorted(leaves[low:high], key=rank.__getitem__)
        shared = [shared_words(before[a], before[b]) for a, b in zip(members, members[1:], strict=False)]
        need = window - depth
        for i, leaf in enumerate(members):
            most = max(shared[i - 1] if i else 0, shared[i] if i < len(shared) else 0)
            if most >= need:
                masks[leaf] |= (2 << most) - (1 << need)
    return masks


def _windows_of(mask: int, place: int) -> Iterator[tuple[int, int]]:
    """Runs (first, size) of repeated windows of a place."""
    first, size, at = place >> _FIRST & 0x7FFFFFFF, place >> _SIZE & 0x7FF, place >> _AT & 0x7FF
    begin = None
    for w in range(size + 1):
        hit = w < size and w <= at and mask >> (at - w) & 1
        if hit and begin is None:
            begin = w
        elif not hit and begin is not None:
            yield first + begin, w - begin
            begin = None


def _solve(window: int):
    """Prefix-sorted runs -> repeated windows (loc, check, first, size)."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[bytes, list] = {}  # run -> [loc, place], the flag of the place says that it repeats
        current, out = None, []

        def report(loc: int, place: int) -> None:
            out.append((loc, place >> _CHECK, place >> _FIRST & 0x7FFFFFFF, place >> _SIZE & 0x7FF))

        def finish() -> None:
            open_places = 0
            for loc, place in group.values():
                if place & _TWICE:
                    report(loc, place)
                else:
                    open_places += 1
            if open_places and len(group) > 1:
                masks = repeated_offsets(list(group), [p >> _AT & 0x7FF for _, p in group.values()], window)
                for (loc, place), mask in zip(group.values(), masks, strict=True):
                    if mask and not place & _TWICE:
                        out.extend((loc, place >> _CHECK, *found) for found in _windows_of(mask, place))
            group.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.int32()) for c in columns[1:])], names=["loc", "check", "first", "size"])

        for batch in batches:
            for key, loc, place, run in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if run is None:
                    report(loc, place)
                    continue
                if key != current:
                    if len(group) > 1 or group and next(iter(group.values()))[1] & _TWICE:
                        finish()
                    else:
                        group.clear()
                    current = key
                known = group.get(run)
                if known is None:
                    group[run] = [loc, place]
                else:
                    known[1] |= _TWICE
                    report(loc, place)
            if out:
                yield batch_of()
                out.clear()
        finish()
        yield batch_of()

    return solve


def repeated_windows(rows: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, split_windows: int = SPLIT_WINDOWS, counted: int = COUNTED) -> DataFrame:
    """Repeated windows (loc, check, first, size) of a table loc, check, doc_id, text."""
    parts = partitions(rows.sparkSession)
    split = split_anchors(rows, window=window, anchor=anchor, split_windows=split_windows, counted=counted)
    prefixes = rows.select("loc", "check", "text").mapInArrow(_emit(window, anchor, split), "key long, loc long, place long")
    # a prefix found earlier in its part needs no company any more and may go anywhere
    route = F.when(F.col("place").bitwiseAND(F.lit(_LATER)) > 0, F.xxhash64("key", "loc", "place")).otherwise(F.col("key"))
    paired = prefixes.repartition(parts, route).sortWithinPartitions("key", "loc", "place").mapInArrow(_paired, prefixes.schema)
    wanted = paired.groupBy("loc").agg(F.collect_list(F.struct("key", "place")).alias("prefixes"))
    joined = rows.join(wanted, "loc").select("loc", "check", "doc_id", "text", "prefixes")
    shipped = joined.mapInArrow(_ship(window), "key long, loc long, place long, run binary")
    grouped = shipped.repartition(parts, "key").sortWithinPartitions("key")
    return grouped.mapInArrow(_solve(window), "loc long, check int, first int, size int")


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, split_windows: int = SPLIT_WINDOWS, counted: int = COUNTED, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept text)."""
    if not 0 < anchor <= window < 2048:
        raise ValueError("the anchor must fit in the window, and the window be under 2048 words")
    doc_id, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    check = F.xxhash64(text, doc_id).bitwiseAND(F.lit(0xFF)).cast("int")
    rows = docs.select(F.xxhash64(doc_id, text).alias("loc"), check.alias("check"), doc_id.alias("doc_id"), text.alias("text"))
    found = repeated_windows(rows, window=window, anchor=anchor, split_windows=split_windows, counted=counted)
    found = found.groupBy("loc").agg(F.collect_set(F.struct("check", "first", "size")).alias("found"))
    joined = rows.join(found, "loc", "left").select("doc_id", "check", "text", "found.check", "found.first", "found.size").toDF("doc_id", "check", "text", "of", "first", "size")
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    if with_text:
        fields.append(T.StructField("text", T.StringType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                counts, removed, digests, texts = [], [], [], []
                for check, text, of, first, size in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
                    found = text.encode().split()
                    counts.append(len(found))
                    if first:
                        mine = np.asarray(of) == check
                        begin, many = np.asarray(first)[mine], np.asarray(size)[mine]
                        change = np.zeros(len(found) + 1, dtype=np.int64)
                        np.add.at(change, begin, 1)
                        np.add.at(change, begin + many + window - 1, -1)
                        gone = np.cumsum(change[:-1]) > 0
                        found = [found[i] for i in np.flatnonzero(~gone).tolist()]
                    removed.append(counts[-1] - len(found))
                    kept = b" ".join(found)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        texts.append(kept.decode())
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.string())] if with_text else []), names=[f.name for f in fields])

    return joined.mapInArrow(cut, T.StructType(fields))
