"""Exact Jaccard join on word n-grams with pivots in metric regions.

The Jaccard distance d is a metric, but documents that share nothing all lie at
distance 1 from each other, and no choice of pivots tells such documents apart.
So space is first cut where d is informative, then by pivots:

1. Documents with equal n-gram sets are one point.
2. Each point gives its prefix, the n-grams that come first in one global order
   (frequent ones, from a bounded sample, come last).  A prefix is longer than
   the usual prefix filter by a part of the set, so linked points share many
   prefix n-grams: a point that shares fewer with all others has no link.  Each
   shared n-gram ties its points to the first of them; a point may leave out its
   weakest ties as long as they weigh less than half of what a link must share,
   so a linked pair always keeps a common tie.  Connected ties form regions.
3. A region of at most ``REGION_POINTS`` points and ``REGION_GRAMS`` n-grams is one
   task.  A larger one is tied once more, now by whole sets, which leaves out
   points that no other point covers well enough, and what is still large is
   divided over the cluster by rounds of pivots.  A pivot is compared with
   every point that shares an n-gram with it, so all its links are known.  Points
   belong to the nearest pivot (its Voronoi region, up to a distance at which
   the next step still tells points apart; points beyond it form a region of
   their own), and in it to a ring of width r = 1 - threshold.  By the triangle
   inequality a point can only be linked into a ring if its distance from that
   pivot lies in the ring or in one beside it, and if that distance exceeds the one
   from its own pivot by at most 2r: such boundary points are repeated in the
   ring's window.  A window whose points are connected already is done.  The
   others are the next regions, or stay together where windows overlap so much
   that dividing would repeat most points; the next pivots are taken from points
   outside the largest component.  What is large after ``ROUNDS`` rounds is cut in
   blocks, and every two blocks meet in a task.
4. In a task pivots are taken in turn: a pivot owns the free points within r; points
   up to 2r from it that are not yet in its component are compared exactly.
   Texts of small regions are compared by their words, not by hashes of them.

The order, the sample and the pivots change the cost, never the result.

Words are runs of code points other than space and ``\\x09-\\x0D``, A-Z
lower-cased.  Defined cases: with fewer than n words the whole sequence is one
n-gram; null and empty texts have no n-gram and no link; a very long text is one
set, which must fit a worker; rows equal in id and text are one document and keep
or lose their place together; of ties in the least id every row stays; a null id
is smaller than any id; an empty table gives an empty result; other columns are
ignored, and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot, materialize, partitions, small_or_shuffled
from .components import connected_components
from .wordhash import LOWER, U64, gram_hashes, row_bounds, row_chunks, text_buffers, word_hashes, words

#: How much longer than the prefix filter's a prefix is, in hundredths of the set.
EXTRA_PERCENT = 12
#: Documents of the sample for the global order; an n-gram that so many of them hold comes last.
SAMPLE_DOCS, FREQUENT_DOCS, FREQUENT_GRAMS = 4000, 8, 200_000
TEXT_CHUNK = 2_000_000
#: A region of more points or n-grams than this is divided first.
REGION_POINTS, REGION_GRAMS = 8000, 2_000_000
#: Pivots of a region in a round at least, rows per n-gram that a round may compare, and rounds before blocks.
PIVOTS, ROUND_ROWS, ROUNDS = 16, 8, 6
#: Bytes of pivots that are broadcast at most; more are shuffled.
PIVOT_BYTES = 32 << 20


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int, seeds: tuple[int, ...] = (0,)) -> tuple[np.ndarray, ...]:
    """Sorted distinct n-gram hashes of all rows, one after the other, and their bounds; then hashes of the same n-grams by further seeds."""
    rows_count = len(offsets) - 1
    base = int(offsets[0])
    data, offsets = LOWER[data[base : int(offsets[-1])]], offsets - base
    starts, ends, rows = words(data, offsets)
    bounds = row_bounds(rows, rows_count)
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < n))
    lanes, owner = [], np.zeros(0, dtype=np.int64)
    for seed in seeds:
        hashes = word_hashes(data, starts, ends, seed)
        grams = gram_hashes(hashes, n)
        inside = rows[: len(grams)] == rows[n - 1 :] if len(grams) else np.zeros(0, dtype=bool)
        whole = [gram_hashes(hashes[a:b], b - a) + U64(b - a) for a, b in zip(bounds[short], bounds[short + 1], strict=True)]
        owner = np.concatenate([rows[: len(grams)][inside], short])
        lanes.append(np.concatenate([grams[inside], *whole]))
    order = np.lexsort((lanes[0], owner))
    values, owner = lanes[0][order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], row_bounds(owner[new], rows_count), *(lane[order][new] for lane in lanes[1:])


def needed(size: int, num: int, den: int) -> int:
    """Least overlap of a set of ``size`` with any set it is linked to."""
    return -(-size * num // den)


def prefix_length(size: int, num: int, den: int) -> int:
    return min(size, size - needed(size, num, den) + 1 + size * EXTRA_PERCENT // 100)


def least_shared(size: int, num: int, den: int) -> int:
    """Prefix n-grams that any linked pair with a set of ``size`` shares at least."""
    return 1 + needed(size, num, den) * EXTRA_PERCENT // 100


def _sets_of(batch_text: pa.Array, n: int, seeds: tuple[int, ...] = (0,)) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted set of each text (one array a seed)."""
    data, offsets = text_buffers(batch_text)
    for a, b in row_chunks(offsets, TEXT_CHUNK):
        values, bounds, *further = gram_sets(data, offsets[a : b + 1], n, seeds)
        for i in range(b - a):
            yield tuple(lane[bounds[i] : bounds[i + 1]] for lane in (values, *further))


def frequent_grams(rows: DataFrame, n: int) -> np.ndarray:
    """N-grams of many documents of a bounded sample, sorted."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (grams,) in _sets_of(batch.column(0), n):
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    total = rows.count()
    if not total:
        return np.zeros(0, dtype=U64)
    sample = rows.select("text").sample(fraction=min(1.0, SAMPLE_DOCS / total), seed=7)
    often = sample.mapInArrow(spread, "gram long").groupBy("gram").count().where(F.col("count") >= FREQUENT_DOCS)
    found = [r["gram"] for r in often.orderBy(F.desc("count"), "gram").limit(FREQUENT_GRAMS).collect()]
    return np.sort(np.array(found, dtype=np.int64).view(U64))


def _point_table(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """One row per document: doc_id, check, size, digest of the set, prefix."""
    frequent = frequent_grams(rows, n)
    kind = rows.schema["doc_id"].dataType

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, prefixes, lengths = [], [], [], []
            for grams, second in _sets_of(batch.column("text"), n, (0, 1)):
                sizes.append(len(grams))
                digests.append(hashlib.blake2b(grams.tobytes() + second.tobytes(), digest_size=16).digest() if len(grams) else None)
                take = prefix_length(len(grams), num, den) if len(grams) else 0
                if take and len(frequent):
                    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
                    often = frequent[at] == grams
                    if often[:take].any():
                        grams = np.concatenate([grams[~often], grams[often]])
                prefixes.append(grams[:take])
                lengths.append(take)
            offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
            np.cumsum(lengths, out=offsets[1:])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                names=["doc_id", "check", "size", "digest", "prefix"],
            )

    fields = [T.StructField("doc_id", kind), T.StructField("check", T.LongType()), T.StructField("size", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("prefix", T.ArrayType(T.LongType()))]
    points = rows.mapInArrow(point, T.StructType(fields)).withColumn("node", F.monotonically_increasing_id())
    return materialize(points)


class _Region:
    """Exact links among the sets of one region."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int) -> None:
        self.count, self.num, self.den = len(sets), num, den
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        grams, index = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(self.count), self.sizes)
        self.grams_of, self.at = index, np.concatenate([[0], np.cumsum(self.sizes)])
        order = np.argsort(index, kind="stable")
        self.owners = owner[order]
        self.first = np.searchsorted(index[order], np.arange(len(grams) + 1))
        self.root = np.arange(self.count)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = int(self.root[x])
        return x

    def unite(self, x: int, others: np.ndarray) -> None:
        for y in others.tolist():
            a, b = self.find(x), self.find(y)
            if a != b:
                self.root[max(a, b)] = min(a, b)

    def overlaps(self, x: int) -> np.ndarray:
        """Sizes of the intersections of x with every point."""
        mine = self.grams_of[self.at[x] : self.at[x + 1]]
        begin, size = self.first[mine], self.first[mine + 1] - self.first[mine]
        ends = np.cumsum(size)
        places = np.arange(int(ends[-1])) + np.repeat(begin - (ends - size), size)
        return np.bincount(self.owners[places], minlength=self.count)

    def solve(self) -> np.ndarray:
        """Component (a member's number) of each point."""
        num, den = self.num, self.den
        free = np.ones(self.count, dtype=bool)
        windows: list[tuple[int, np.ndarray]] = []
        for pivot in range(self.count):
            if not free[pivot]:
                continue
            shared = self.overlaps(pivot)
            union = self.sizes + self.sizes[pivot] - shared
            linked = den * shared >= num * union
            self.unite(pivot, np.flatnonzero(linked))
            free &= ~linked
            window = np.flatnonzero(~linked & (den * shared >= (2 * num - den) * union) & (shared > 0))
            if len(window):
                windows.append((pivot, window))
        probed = np.zeros(self.count, dtype=bool)
        for pivot, window in windows:
            for y in window.tolist():
                if probed[y] or self.find(y) == self.find(pivot):
                    continue
                probed[y] = True
                shared = self.overlaps(y)
                self.unite(y, np.flatnonzero(den * shared >= num * (self.sizes + self.sizes[y] - shared)))
        return np.array([self.find(i) for i in range(self.count)])


def word_sets(text: str, n: int, numbers: dict[bytes, int]) -> np.ndarray:
    """The n-grams of a text as numbers that ``numbers`` gives out, one for each sequence of words."""
    found = text.encode().translate(LOWER.tobytes()).split()
    spaced = b" ".join(found)
    if len(found) <= n:
        return np.array([numbers.setdefault(spaced, len(numbers))], dtype=np.int64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    begins = np.concatenate([[0], ends])
    grams = {spaced[a:b] for a, b in zip(begins[: len(found) - n + 1].tolist(), (ends[n - 1 :] - 1).tolist(), strict=True)}
    return np.array([numbers.setdefault(g, len(numbers)) for g in grams], dtype=np.int64)


def _solve_regions(n: int, num: int, den: int):
    """Rows (region, node, text or grams), region-sorted -> links (a, b)."""

    def solve(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        roots = _Region(sets, num, den).solve() if len(sets) > 1 else np.zeros(len(sets), dtype=np.int64)
        found = np.array(nodes, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(found[roots])], names=["a", "b"])

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, sets, numbers = None, [], [], {}
        for batch in batches:
            regions_of, node_of, content = batch.column("region").to_pylist(), batch.column("node").to_pylist(), batch.column(2)
            for i, (region, node) in enumerate(zip(regions_of, node_of, strict=True)):
                if nodes and region == current and node == nodes[-1]:
                    continue  # a repeated row
                if region != current and nodes:
                    yield solve(nodes, sets)
                    nodes, sets, numbers = [], [], {}
                current = region
                nodes.append(node)
                if pa.types.is_list(content.type):
                    sets.append(content[i].values.to_numpy().astype(np.int64))
                else:
                    sets.append(word_sets(content[i].as_py(), n, numbers))
        if nodes:
            yield solve(nodes, sets)

    return regions


def _links_inside(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    placed = rows.repartition(partitions(rows.sparkSession), "region").sortWithinPartitions("region", "node")
    return placed.mapInArrow(_solve_regions(n, num, den), "a long, b long").where("a <> b").distinct()


def _tie_edges(grams: DataFrame, must: Column) -> DataFrame:
    """Edges (a, b) of points (node, size, gram) through the first point of each n-gram.

    The points of the most frequent n-grams meet their ties by broadcast, so no task
    holds all points of one n-gram.

    ``must`` (of size) is what a point shares with any point it is linked to.
    Points that share less with all others have no edge.  A point leaves out
    its weakest ties while they weigh less than half of ``must``.  Every point
    that may have a link is an ``a``, if only beside itself.
    """
    ties = grams.groupBy("gram").agg(F.min(F.struct("size", "node")).alias("first"), F.count("*").alias("n")).where("n > 1").select("gram", F.col("first.node").alias("tie"), "n")
    weights = join_hot(grams, materialize(ties), "gram", "n").groupBy("node", "tie").agg(F.count("*").alias("w"), F.first("size").alias("size"))
    per_node = weights.groupBy("node").agg(F.first("size").alias("size"), F.sum("w").alias("shared"), F.array_sort(F.collect_list(F.struct("w", "tie"))).alias("ties"))
    alive = per_node.withColumn("must", must).where("shared >= must")
    running = F.aggregate("ties", F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("kept")), lambda a, t: F.struct((a["sum"] + F.when(t["tie"] == F.col("node"), 0).otherwise(t["w"])).alias("sum"), F.when((t["tie"] != F.col("node")) & (a["sum"] + t["w"] <= F.floor((F.col("must") - 1) / 2)), a["kept"]).otherwise(F.concat(a["kept"], F.array(t["tie"]))).alias("kept")))
    return alive.select(F.col("node").alias("a"), F.explode(running["kept"]).alias("b"))


def _with_sizes(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (region, node, grams) of the regions that one task solves, and of the others."""
    sizes = points.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.size("grams").cast("long")).alias("total"))
    large = materialize(sizes.where((F.col("n") > 1) & ((F.col("n") > REGION_POINTS) | (F.col("total") > REGION_GRAMS))).select("region"))
    side = small_or_shuffled(large, large.count())
    return points.join(side, "region", "left_anti"), points.join(side, "region", "left_semi")


def _overlaps(points: DataFrame, pivots: DataFrame) -> DataFrame:
    """(region, node, pivot, shared, joint): sizes of intersection and union where the former is not empty.

    Few pivots of a region meet its points as whole sets, broadcast or salted;
    where there are many, points and pivots meet through their n-grams.
    """
    few = pivots.where(F.col("many") <= 2 * PIVOTS).select("region", "pivot", "pivot_grams")
    used = few.agg(F.count("*").alias("n"), F.sum(F.size("pivot_grams").cast("long")).alias("grams")).first()
    if 8 * (used["grams"] or 0) + 40 * used["n"] <= PIVOT_BYTES:
        met = points.join(F.broadcast(few), "region")
    else:
        salts = partitions(points.sparkSession)
        salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = points.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")).join(salted, ["region", "salt"])
    shared = F.size(F.array_intersect("grams", "pivot_grams")).cast("long")
    whole = met.select("region", "node", "pivot", shared.alias("shared"), (F.size("grams") + F.size("pivot_grams")).cast("long").alias("both"))
    sparse = pivots.where(F.col("many") > 2 * PIVOTS)
    if sparse.isEmpty():
        found = whole
    else:
        left = points.select("region", "node", F.size("grams").cast("long").alias("size"), F.explode("grams").alias("gram"))
        right = sparse.select("region", "pivot", F.size("pivot_grams").cast("long").alias("pivot_size"), F.explode("pivot_grams").alias("gram"))
        counted = left.join(right, ["region", "gram"]).groupBy("region", "node", "pivot").agg(F.count("*").alias("shared"), F.first(F.col("size") + F.col("pivot_size")).alias("both"))
        found = whole.unionByName(counted)
    return found.where("shared > 0").select("region", "node", "pivot", "shared", (F.col("both") - F.col("shared")).alias("joint"))


def _choose_pivots(points: DataFrame, turn: int) -> DataFrame:
    """(region, pivot, pivot_grams, many) among the points (region, node, grams, part) outside the largest part of each region."""
    parts = points.groupBy("region", "part").agg(F.count("*").alias("n"))
    totals = parts.groupBy("region").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("main"))
    held = points.select("region", F.explode("grams").alias("gram")).groupBy("region", "gram").agg(F.count("*").alias("c"))
    spread = held.groupBy("region").agg((F.sum("c") / F.sum(F.col("c") * F.col("c"))).alias("ratio"))
    outside = F.col("n") - F.col("main.n")
    many = F.least(outside, F.greatest(F.lit(PIVOTS), F.ceil(ROUND_ROWS * F.col("ratio") * F.col("n"))))
    plan = materialize(totals.join(spread, "region").select("region", F.col("main.part").alias("main"), outside.alias("outside"), many.alias("many")))
    placed = points.join(small_or_shuffled(plan, plan.count()), "region").where("part <> main")
    turned = F.xxhash64("node", F.lit(turn))
    least = placed.groupBy("region").agg(F.min(F.struct(turned.alias("turned"), "node"))["node"].alias("least"))
    drawn = F.pmod(turned, F.greatest("outside", F.lit(1))) < F.col("many")
    placed = placed.join(least, "region").where(drawn | (F.col("node") == F.col("least")))
    return materialize(placed.select("region", F.col("node").alias("pivot"), F.col("grams").alias("pivot_grams"), "many"))


def _divide(points: DataFrame, known: DataFrame | None, turn: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """One round of pivots over large regions (region, node, grams): what is known to be connected (node, component), and the next regions."""
    last = -(-den // (den - num)) - 3  # the last ring of owners; the one behind it is still told apart from distance 1
    part = F.col("node")
    if known is not None:
        points, part = points.join(known, "node", "left"), F.coalesce("component", "node")
    points = materialize(points.select("region", "node", "grams", part.alias("part")))
    pivots = _choose_pivots(points, turn)
    near = _overlaps(points.select("region", "node", "grams"), pivots)
    near = near.withColumn("ring", F.expr(f"cast(((joint - shared) * {den}) div (joint * {den - num}) as int)")).where(F.col("ring") <= last + 1)
    near = materialize(near.withColumn("linked", F.expr(f"{den} * shared >= {num} * joint")))
    links = near.where("linked and node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    if known is not None:
        links = links.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    known = materialize(connected_components(links))

    # nearest pivot, and the windows of its rings; the pivots themselves are done
    done = pivots.select("region", F.col("pivot").alias("node"))
    rest = materialize(points.select("region", "node").join(done, ["region", "node"], "left_anti"))
    near = near.join(rest, ["region", "node"], "left_semi")
    away = (F.col("joint") - F.col("shared")) / F.col("joint")
    own = near.where(F.col("ring") <= last).groupBy("region", "node").agg(F.min(F.struct(away.alias("away"), "pivot", "ring")).alias("own"))
    own = materialize(own.select("region", "node", F.col("own.pivot").alias("pivot"), F.col("own.ring").alias("ring")))
    cells = own.select("region", "pivot", "ring").distinct()
    beside = near.join(own.select("region", "node", F.col("ring").alias("own_ring")), ["region", "node"], "left").where("own_ring is null or ring <= own_ring + 2")
    beside = beside.select("region", "node", "pivot", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)).alias("ring"))
    windows = beside.join(cells, ["region", "pivot", "ring"]).select(own.columns).unionByName(own).distinct()
    loose = rest.join(own.select("region", "node"), ["region", "node"], "left_anti")
    windows = windows.unionByName(loose.select("region", "node", F.lit(-1).cast("long").alias("pivot"), F.lit(-1).alias("ring")))

    # a window whose points are connected is done
    windows = materialize(windows.join(known, "node", "left").select("region", "pivot", "ring", "node", F.coalesce("component", "node").alias("part")))
    sizes = windows.groupBy("region", "pivot", "ring").agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    totals = rest.groupBy("region").agg(F.count("*").alias("points"))
    dividing = sizes.groupBy("region").agg(F.sum("n").alias("total"), F.max("n").alias("most")).join(totals, "region")
    dividing = dividing.select("region", F.expr("2 * total <= 3 * points and 5 * most <= 4 * points").alias("divide"))
    open_windows = materialize(sizes.select("region", "pivot", "ring").join(dividing, "region"))
    kept = windows.join(small_or_shuffled(open_windows, open_windows.count()), ["region", "pivot", "ring"])
    named = kept.select("region", "node", F.when(F.col("divide"), F.xxhash64("region", "pivot", "ring", F.lit(turn))).otherwise(F.col("region")).alias("next")).distinct()
    following = points.select("region", "node", "grams").join(named, ["region", "node"]).select(F.col("next").alias("region"), "node", "grams")
    return known, materialize(following)


def _blocks(points: DataFrame) -> DataFrame:
    """Every two blocks of a region as a region of their own, each of about ``REGION_GRAMS`` n-grams."""
    totals = points.groupBy("region").agg(F.sum(F.size("grams").cast("long")).alias("total"), F.count("*").alias("n"))
    many = F.greatest(F.ceil(2 * F.col("total") / F.lit(REGION_GRAMS)), F.ceil(F.col("n") / F.lit(8 * REGION_POINTS))).cast("int")
    placed = points.join(materialize(totals.select("region", many.alias("many"))), "region").withColumn("block", F.pmod(F.xxhash64("node"), F.col("many")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    return placed.select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("region"), "node", "grams")


def _links_of_large(texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links in regions (region, node, text) that are too large for a task."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for (s,) in _sets_of(batch.column("text"), n)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["node", "grams"])

    points = materialize(texts.select("node", "text").mapInArrow(hashed, "node long, grams array<long>").dropDuplicates(["node"]))
    grams = points.select("node", F.size("grams").cast("long").alias("size"), F.explode("grams").alias("gram"))
    pairs = materialize(_tie_edges(grams, F.expr(f"(size * {num} + {den - 1}) div {den}")))
    tied = connected_components(pairs).join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    small, large = _with_sizes(materialize(points.join(tied, "node").select(F.col("component").alias("region"), "node", "grams")))
    found = [materialize(_links_inside(small, n, num, den))]
    known = None
    for turn in range(ROUNDS if num < den else 0):
        if large.isEmpty():
            break
        known, following = _divide(large, known, turn, num, den)
        small, large = _with_sizes(following)
        found.append(materialize(_links_inside(small, n, num, den)))
    else:
        found.append(_links_inside(_blocks(large), n, num, den))
    if known is not None:
        found.append(known.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b"))
    return reduce(DataFrame.unionByName, found)


def near_duplicate_classes(docs: DataFrame, *, words_per_gram: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, check, n_shingles, component_id.

    ``check`` tells rows of the same id with different texts apart.
    """
    num, den = threshold
    if not den < 2 * num <= 2 * den:
        raise ValueError("the threshold must be over 1/2 and at most 1")
    name, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(name.alias("doc_id"), F.xxhash64(name, text).alias("check"), text.alias("text"))
    points = _point_table(rows, words_per_gram, num, den)

    classes = points.where("digest is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "node")).alias("first"), F.count("*").alias("n"))
    copies = materialize(classes.where("n > 1").select("digest", F.col("first.node").alias("first_node"), F.col("first.doc_id").alias("first_id")))
    copies_side = small_or_shuffled(copies, copies.count())
    single = points.join(copies_side, "digest", "left").where("digest is not null and (first_node is null or first_node = node)")
    grams = single.select("node", "size", F.explode("prefix").alias("gram"))

    must = 1 + F.floor(F.expr(f"(size * {num} + {den - 1}) div {den}") * EXTRA_PERCENT / 100)  # least_shared()
    pairs = materialize(_tie_edges(grams, must))
    regions = connected_components(pairs)

    # only points that may have a link travel with their texts
    members = regions.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi").join(points.select("node", "doc_id", "check", "size"), "node")
    members = materialize(members.groupBy("doc_id", "check").agg(F.min("node").alias("node"), F.min("component").alias("region"), F.min("size").alias("size")))
    there = members.select(F.col("doc_id").alias("_id"), F.col("check").alias("_check"), "node", "region")
    texts = rows.join(small_or_shuffled(there, members.count()), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("check") == F.col("_check"))).select("region", "node", "text")
    large = materialize(members.groupBy("region").agg(F.count("*").alias("points"), F.sum("size").alias("grams")).where((F.col("points") > REGION_POINTS) | (F.col("grams") > REGION_GRAMS)).select("region"))
    if n_large := large.count():
        side = small_or_shuffled(large, n_large)
        links = _links_inside(texts.join(side, "region", "left_anti"), words_per_gram, num, den)
        links = links.unionByName(_links_of_large(texts.join(side, "region", "left_semi"), words_per_gram, num, den))
    else:
        links = _links_inside(texts, words_per_gram, num, den)

    # a component's id is the least document id of its points; equal sets share a point
    found = connected_components(links)
    least = materialize(found.join(points.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id")))
    named = materialize(found.join(least, "component").select(F.col("node").alias("point"), "component_id"))
    point = points.join(copies_side, "digest", "left").select("doc_id", "check", "size", "first_id", F.coalesce("first_node", "node").alias("point"))
    joined = point.join(small_or_shuffled(named, named.count()), "point", "left")
    own = F.coalesce("component_id", "first_id", "doc_id")
    return joined.select("doc_id", "check", F.col("size").alias("n_shingles"), own.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents of which the component has no smaller id, with all columns."""
    classes = near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **options)
    gone = materialize(classes.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone_id"), F.col("check").alias("gone_check")).distinct())
    name, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("id"), F.xxhash64(name, text).alias("check"))
    kept = rows.join(small_or_shuffled(gone, gone.count()), F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("check") == F.col("gone_check")), "left_anti")
    return kept.select("row.*")
