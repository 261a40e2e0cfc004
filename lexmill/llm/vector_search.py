"""Nearest neighbours by inner product with an inverted multi-index.

1. Equal vectors are one class, known by a 128-bit digest and named by its least
   id; of a class only the ``k + 1`` least ids can be among a query's k nearest, so
   a vector that a third of all rows share is searched once.
2. Each half of the vectors has its own centroids, fitted by Lloyd's iterations on
   about ``SAMPLE`` classes that the digest picks; a pair of centroids is a cell.
   Every class is placed in its cell.
3. A query visits cells by the summed distance of its halves from the pair's
   centroids (here the negated inner product), which a heap over the two sorted
   lists gives one after the other, until the cells hold as many classes as the
   search budget says.  The budget is measured, not set: for ``CALIBRATION`` queries
   the true neighbours are found by a full scan, and the budget is the number of
   visited classes within which ``recall`` of them are reached.  It grows with the
   table where neighbours are spread over it, so no bound cuts recall.
4. Cells are gathered in units of like size; a large cell is divided by class, and a
   unit that many queries visit is repeated for blocks of them.  A task holds one
   unit and streams its queries by, comparing whole vectors of the visited cells.
   It returns one list of the best for each query; lists are merged, spread over
   the ids of their classes and cut to the k nearest.

Scores are sums of products in the order of the components, in doubles.

Defined cases: vectors that are null, zero, or hold null or non-finite components
take no part, nor do those whose length is not the commonest (of ties the least), nor
rows without an id; ties go to the smaller id; rows equal in id and vector count
once, and an id with several vectors is a candidate, and a query, with each of them; a
query is never its own neighbour; with fewer candidates than k all are returned;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, materialize, partitions, small_or_shuffled

#: Classes that the centroids are fitted on, at most about; iterations; and most centroids of a half.
SAMPLE, ITERATIONS, CENTROIDS = 20_000, 10, 256
#: Queries of the calibration and the share of their neighbours that a search reaches.
CALIBRATION, RECALL = 128, 0.95
#: Least and most classes of a unit, queries of a block, and queries that are scored at once.
UNIT_LEAST, UNIT_MOST, BLOCK, AT_ONCE = 2048, 32_768, 16_384, 64


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, key, vec) of the rows that take part; ``key`` is a digest of the vector."""
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "float" if kind == "float" else "double"
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("vec")).where("vec_id is not null and size(vec) > 0")
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    width = common["d"] if common else 1

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            holes = np.zeros(len(column), dtype=bool)
            if column.flatten().null_count:
                holes = np.array([any(x is None for x in v) for v in column.to_pylist()], dtype=bool)
            whole = batch.filter(pa.array(~holes))
            found = _matrix(whole.column(1)) + 0.0  # no negative zeros
            good = np.isfinite(found).all(axis=1) & (found != 0).any(axis=1) if len(found) else np.zeros(0, dtype=bool)
            keys = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in found[good]]
            kept = whole.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(keys, pa.binary()), kept.column(1)], names=["vec_id", "key", "vec"])

    id_type = vectors.schema[id_col].dataType.simpleString()
    return rows.where(F.size("vec") == width).mapInArrow(check, f"vec_id {id_type}, key binary, vec array<{kind}>")


def vector_classes(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """One row per distinct vector: key, node (a number), vec, asked (its queries), ids (the least k + 1)."""
    pairs = rows.groupBy("key", "vec_id").agg(F.count("*").alias("_n"))
    least = pairs.withColumn("_i", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("_i") <= k + 1)
    ids = least.groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    whole = rows.groupBy("key").agg(F.first("vec").alias("vec"), F.count_if(is_query).alias("asked"))
    return materialize(whole.join(ids, "key").select("key", F.monotonically_increasing_id().alias("node"), "vec", "asked", "ids"))


def drawn(classes: DataFrame, many: int, total: int, salt: int) -> DataFrame:
    """About ``many`` of ``total`` classes, picked by their digests."""
    return classes if total <= many else classes.where(F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(1 << 30)) < int(many / total * (1 << 30)))


def fit_centroids(points: np.ndarray, many: int, seed: int = 7) -> np.ndarray:
    """Lloyd's iterations from distinct points; a centroid without points stays where it is."""
    distinct = np.unique(points, axis=0)
    centers = distinct[np.random.RandomState(seed).permutation(len(distinct))[:many]].copy()
    for _ in range(ITERATIONS):
        nearest = nearest_centroid(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centers))
        held = counts > 0
        centers[held] = sums[held] / counts[held, None]
    return centers


def nearest_centroid(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(axis=1)[None, :] - 2 * (points @ centers.T)).argmin(axis=1)


@dataclass
class Codebook:
    """Centroids of both halves; what a cell holds once it is known."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None
    #: Each cell's first unit and number of units.
    unit_of: np.ndarray | None = None
    units_of: np.ndarray | None = None

    @classmethod
    def fit(cls, sample: np.ndarray, total: int) -> Codebook:
        half, many = sample.shape[1] // 2, int(np.clip(round(total**0.5 / 4), 2, CENTROIDS))
        return cls(fit_centroids(sample[:, :half], many if half else 1), fit_centroids(sample[:, half:], many))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return nearest_centroid(vectors[:, :half], self.first) * len(self.second) + nearest_centroid(vectors[:, half:], self.second)

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return -(queries[:, :half] @ self.first.T), -(queries[:, half:] @ self.second.T)

    def gather(self, counts: np.ndarray) -> None:
        """Neighbouring cells share a unit while they fit; a larger cell is divided."""
        size = int(np.clip(counts.sum() // 24, UNIT_LEAST, UNIT_MOST))
        self.counts, self.unit_of, self.units_of = counts, np.zeros(len(counts), dtype=np.int64), np.ones(len(counts), dtype=np.int64)
        unit, room = -1, 0
        for cell in np.flatnonzero(counts).tolist():
            n = int(counts[cell])
            parts = -(-n // size)
            if parts > 1 or n > room:
                self.unit_of[cell] = unit + 1
                unit, room = unit + parts, size - n if parts == 1 else 0
            else:
                self.unit_of[cell], room = unit, room - n
            self.units_of[cell] = parts


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(distance, cell, classes in it), pairs of centroids by summed distance."""
    by_first, by_second = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    one, two = first[by_first].tolist(), second[by_second].tolist()
    held, width = counts.tolist() if isinstance(counts, np.ndarray) else counts, len(two)
    heap = [(one[0] + two[0], 0, 0)]
    while heap:
        distance, i, j = heapq.heappop(heap)
        cell = by_first[i] * width + by_second[j]
        yield distance, cell, held[cell]
        if j + 1 < width:
            heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))


def ordered_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the order of the components."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def best_of(queries: np.ndarray, vectors: np.ndarray, k: int, seen: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and exact scores of each query's k best vectors (ties with the last one too) among those ``seen``."""
    fast = queries @ vectors.T
    if seen is not None:
        fast[~seen] = -np.inf
    slack = 1e-9 * np.abs(queries).sum(axis=1) * (np.abs(vectors).max() if vectors.size else 0)
    for query, scores, least in zip(queries, fast, slack, strict=True):
        if len(scores) > k:
            places = np.flatnonzero(scores >= np.partition(scores, -k)[-k] - least)
            places = places[scores[places] > -np.inf]
        else:
            places = np.flatnonzero(scores > -np.inf)
        exact = ordered_scores(query, vectors[places])
        if len(places) > k:
            kept = exact >= np.partition(exact, -k)[-k]
            places, exact = places[kept], exact[kept]
        yield places, exact


def true_neighbours(classes: DataFrame, nodes: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query, node, vec) of the nearest classes of a few queries, by a scan of all; tasks keep their best."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in nodes]
        for batch in batches:
            vectors, found = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if not len(found):
                continue
            for q, (places, scores) in enumerate(best_of(queries, vectors, k + 1)):
                new = [(-s, n, p) for s, n, p in zip(scores.tolist(), found[places].tolist(), places.tolist(), strict=True) if n != nodes[q]]
                held[q] = sorted([*held[q], *((s, n, vectors[p].tolist()) for s, n, p in new)], key=lambda x: x[:2])[:k]
        rows = [(q, n, -s, v) for q, best in enumerate(held) for s, n, v in best]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.list_(pa.float64()))], names=["query", "node", "score", "vec"])

    found = classes.select("node", "vec").mapInArrow(scan, "query int, node long, score double, vec array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    return found.withColumn("_i", rank).where(F.col("_i") <= k).select("query", "node", "vec")


def search_budget(classes: DataFrame, total: int, book: Codebook, k: int, recall: float) -> int:
    """Classes that a query visits so that ``recall`` of the true neighbours of the calibration are reached."""
    asked = classes.where("asked > 0")
    some = drawn(asked, CALIBRATION, asked.count(), 1).select("node", "vec").toArrow()
    if not some.num_rows:
        some = asked.select("node", "vec").limit(CALIBRATION).toArrow()
    nodes, queries = some.column("node").to_numpy(), _matrix(some.column("vec").combine_chunks())
    if not len(nodes):
        return 0
    truth = true_neighbours(classes, nodes, queries, k).toArrow()  # k rows a query of the calibration
    if not truth.num_rows:
        return total
    cells = book.cells(_matrix(truth.column("vec").combine_chunks()))
    of = truth.column("query").to_numpy()
    first, second = book.distances(queries)
    needs = []
    for q in range(len(nodes)):
        wanted = cells[of == q].tolist()
        reached, visited = {}, 0
        for _, cell, n in traverse(first[q], second[q], book.counts):
            visited += n
            reached[cell] = visited
        needs += [reached[c] for c in wanted]
    return int(np.quantile(needs, recall, method="higher"))


def _probes(classes: DataFrame, book: Codebook, budget: int) -> DataFrame:
    """(node, vec, reach, units) of each asked class: the distance up to which cells are visited and the units they lie in."""
    kind = classes.schema["vec"].dataType.simpleString()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = book.counts.tolist()
        for batch in batches:
            reach, units = [], []
            for first, second in zip(*book.distances(_matrix(batch.column(1))), strict=True) if batch.num_rows else ():
                visited, last = 0, 0.0
                cells = []
                for distance, cell, n in traverse(first, second, counts):
                    last = distance
                    if n:
                        cells.append(cell)
                        visited += n
                        if visited >= budget:
                            break
                begin, size = book.unit_of[cells], book.units_of[cells]
                found = {u for b, s in zip(begin.tolist(), size.tolist(), strict=True) for u in range(b, b + s)}
                reach.append(last + 1e-9 * (1 + abs(last)))
                units.append(sorted(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(reach, pa.float64()), pa.array(units, pa.list_(pa.int64()))], names=["node", "vec", "reach", "units"])

    return classes.where("asked > 0").select("node", "vec").mapInArrow(visit, f"node long, vec {kind}, reach double, units array<bigint>")


def _entries(classes: DataFrame, book: Codebook) -> DataFrame:
    """(node, vec, low, cell) of every class, and with units known also its unit."""
    kinds = dict(classes.select("vec", F.element_at("ids", 1).alias("low")).dtypes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = book.cells(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, dtype=np.int64)
            units = np.zeros(len(cells), dtype=np.int64) if book.counts is None else book.unit_of[cells] + batch.column(0).to_numpy() % book.units_of[cells]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64()), pa.array(units, pa.int64())], names=["node", "vec", "low", "cell", "unit"])

    return classes.select("node", "vec", F.element_at("ids", 1).alias("low")).mapInArrow(place, f"node long, vec {kinds['vec']}, low {kinds['low']}, cell long, unit long")


def _compare(book: Codebook, k: int):
    """Rows of a unit's block, its classes first and then its queries -> (query, unit, best) of each query."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            group = np.stack([batch.column(c).to_numpy() for c in (0, 1, 2)], axis=1)  # unit, block, kind
            starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])) if len(group) else []
            low_type = batch.schema.field("low").type
            for a, b in zip(starts, [*starts[1:], len(group)], strict=True):
                unit, kind, part = tuple(group[a][:2]), group[a][2], batch.slice(a, b - a)
                if unit != current:
                    current, parts, held = unit, [], None
                if kind == 0:
                    parts.append((part.column("node").to_numpy(), part.column("cell").to_numpy(), _matrix(part.column("vec")), np.array(part.column("low").to_pylist())))
                    continue
                if held is None:
                    held = tuple(np.concatenate(c) for c in zip(*parts, strict=True))
                nodes, cells, vectors, lows = held
                width = len(book.second)
                for begin in range(0, part.num_rows, AT_ONCE):
                    some = part.slice(begin, AT_ONCE)
                    queries, reach = _matrix(some.column("vec")), some.column("reach").to_numpy()
                    first, second = book.distances(queries)
                    seen = first[:, cells // width] + second[:, cells % width] <= reach[:, None]
                    sizes, negs, found = [], [], []
                    for places, scores in best_of(queries, vectors, k, seen):
                        order = np.lexsort((lows[places], -scores))[:k]
                        sizes.append(len(order))
                        negs.append(0.0 - scores[order])
                        found.append(places[order])
                    flat = np.concatenate(found)
                    hits = pa.StructArray.from_arrays([pa.array(np.concatenate(negs)), pa.array(lows[flat].tolist(), low_type), pa.array(nodes[flat])], names=["neg", "low", "node"])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), hits)
                    yield pa.RecordBatch.from_arrays([some.column("node"), some.column("unit"), lists], names=["query", "unit", "best"])

    return compare


def nearest_neighbours(vectors: DataFrame, *, k: int = 20, every: int = 20, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = materialize(valid_vectors(vectors, id_col, vector_col))
    is_query = F.col("vec_id") % every == 0
    classes = vector_classes(rows, is_query, k)
    total = classes.count()
    sample = _matrix(drawn(classes, SAMPLE, total, 0).select("vec").toArrow().column("vec").combine_chunks()) if total else np.zeros((0, 0))
    if not len(sample):  # nothing to search, or a handful of classes that the draw has missed
        sample = _matrix(classes.select("vec").limit(SAMPLE).toArrow().column("vec").combine_chunks()) if total else np.ones((1, 2))
    book = Codebook.fit(sample, total)
    counts = np.zeros(len(book.first) * len(book.second), dtype=np.int64)
    for row in _entries(classes, book).groupBy("cell").count().collect():  # at most CENTROIDS squared
        counts[row["cell"]] = row["count"]
    book.gather(counts)
    probes = materialize(_probes(classes, book, search_budget(classes, total, book, k, recall)))

    # units that many queries visit are repeated for blocks of them
    visits = probes.withColumn("unit", F.explode("units")).drop("units")
    blocks = materialize(visits.groupBy("unit").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    side = small_or_shuffled(blocks, blocks.count(), 12)
    there = _entries(classes, book).join(side, "unit").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    there = there.select("unit", "block", F.lit(0).alias("kind"), "node", "cell", "low", "vec", F.lit(0.0).alias("reach"))
    nothing = F.lit(None).cast(there.schema["low"].dataType).alias("low")
    asked = visits.join(side, "unit").select("unit", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), "node", F.lit(-1).cast("long").alias("cell"), nothing, "vec", "reach")
    dealt = there.unionByName(asked).repartition(partitions(spark), "unit", "block").sortWithinPartitions("unit", "block", "kind")
    found = dealt.mapInArrow(_compare(book, k + 1), f"query long, unit long, best array<struct<neg:double,low:{dict(there.dtypes)['low']},node:bigint>>")

    # the best classes of a query, merged over its units in two steps, then the ids of those
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k + 1).alias("best")
    few = F.pmod("unit", F.lit(max(1, round((int(book.unit_of.max()) + 1) ** 0.5))))
    merged = found.groupBy("query", few.alias("part")).agg(best).groupBy("query").agg(best)
    hits = merged.select("query", F.inline("best")).join(classes.select("node", "ids"), "node").select("query", "neg", F.explode("ids").alias("vec_id"))
    lists = hits.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("neg", "vec_id"))), 1, k + 1).alias("near"))  # of at most (k + 1) squared
    lists = lists.select(F.col("query").alias("node"), "near")
    answers = materialize(classes.where("asked > 0").select("node", "key", "asked").join(lists, "node").select("key", "asked", "near"))

    queries = rows.where(is_query).groupBy("vec_id", "key").agg(F.count("*").alias("_n")).select(F.col("vec_id").alias("query_id"), "key")
    joined = join_counted(queries, answers, "key", "asked")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("_pos", "_hit")).select("query_id", (F.col("_pos") + 1).alias("rank"), "_hit.vec_id", (0.0 - F.col("_hit.neg")).alias("score"))
