"""Exact inner-product search over embeddings, with clusters that bounds leave out.

Vectors are placed with the nearest of a few centres; a cluster knows its size and the
largest distance from its centre.  By Cauchy-Schwarz no vector of a cluster scores
more than ``q.c + |q| * radius``.  A query is compared with its most promising
clusters first, until they hold k vectors; of the others only those are scored whose
bound reaches the k-th score so far.  Queries stay a table: they are sent to the
blocks of their clusters and stream past the vectors there, and the best of each block
are merged as lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.plans.staging import materialize, partitions

TOP = 60
#: Centres, which are vectors of the table; vectors of a block; queries of a block; and queries that are scored at once.
CENTRES, BLOCK, QUERY_BLOCK, AT_ONCE = 64, 16_384, 16_384, 64


class Encoder(Protocol):
    """Turns texts into unit vectors; passed to ``embed``."""

    def encode(self, texts: list[str]) -> np.ndarray: ...


def embed(df: DataFrame, encoder: Encoder, text: str, vector: str = "embedding") -> DataFrame:
    """Add float32 unit vectors of a text column, batch by batch."""
    schema = T.StructType([*df.schema.fields, T.StructField(vector, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray(encoder.encode(batch.column(text).to_pylist()), dtype=np.float32)
            found = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.float32()))], names=[*batch.schema.names, vector])

    return df.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _placed(vectors: DataFrame, centres: np.ndarray, blocks: np.ndarray | None = None) -> DataFrame:
    """(id, vec, cluster, away, block): the nearest centre, the distance from it, and the block of the cluster."""
    kinds = dict(vectors.dtypes)
    lengths = (centres**2).sum(axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            found = _matrix(batch.column(1))
            near = (lengths[None, :] - 2 * (found @ centres.T)).argmin(axis=1) if len(found) else np.zeros(0, dtype=np.int64)
            away = np.linalg.norm(found - centres[near], axis=1) if len(found) else np.zeros(0)
            turn = np.arange(at, at + len(near))
            at += len(near)
            block = turn % blocks[near] if blocks is not None else np.zeros(len(near), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(away), pa.array(block.astype(np.int32))], names=["id", "vec", "cluster", "away", "block"])

    return vectors.mapInArrow(place, f"id {kinds['id']}, vec {kinds['vec']}, cluster int, away double, block int")


def _visits(queries: DataFrame, centres: np.ndarray, counts: np.ndarray, radii: np.ndarray, k: int) -> DataFrame:
    """(qid, vec, visits): each cluster with its bound and whether it is among the first."""
    kinds = dict(queries.dtypes)
    held = np.flatnonzero(counts)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, lists = _matrix(batch.column(1)), []
            for query in asked:
                bounds = centres[held] @ query + np.linalg.norm(query) * radii[held]
                order = np.argsort(-bounds, kind="stable")
                before = np.concatenate([[0], np.cumsum(counts[held][order])[:-1]])
                lists.append([{"cluster": int(held[c]), "bound": float(bounds[c]), "first": bool(n < k)} for c, n in zip(order, before, strict=True)])
            kind = pa.list_(pa.struct([("cluster", pa.int32()), ("bound", pa.float64()), ("first", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, kind)], names=["qid", "vec", "visits"])

    return queries.mapInArrow(plan, f"qid {kinds['qid']}, vec {kinds['vec']}, visits array<struct<cluster:int,bound:double,first:boolean>>")


def _score(id_type: str, query_type: str, k: int, digits: int):
    """Rows of a block, its vectors first and then its queries -> (qid, part, best)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            group = np.stack([batch.column(c).to_numpy() for c in ("cluster", "block", "turn", "kind")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)])) if len(group) else []
            for a, b in zip(starts, [*starts[1:], len(group)], strict=True):
                at, part = tuple(group[a][:3]), batch.slice(a, b - a)
                if at != current:
                    current, parts, held = at, [], None
                if group[a][3] == 0:
                    parts.append((np.array(part.column("id").to_pylist()), _matrix(part.column("vec"))))
                    continue
                if not parts:
                    continue
                held = held or tuple(np.concatenate(c) for c in zip(*parts, strict=True))
                for low in range(0, part.num_rows, AT_ONCE):
                    some = part.slice(low, AT_ONCE)
                    scores = np.round(_matrix(some.column("vec")) @ held[1].T, digits) + 0.0
                    order = np.lexsort((np.broadcast_to(held[0], scores.shape), -scores))[:, :k]
                    flat = order.reshape(-1)
                    negs = -np.take_along_axis(scores, order, axis=1).reshape(-1)
                    hits = pa.StructArray.from_arrays([pa.array(negs), pa.array(held[0][flat].tolist(), part.schema.field("id").type)], names=["neg", "id"])
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(order) + 1) * order.shape[1], pa.int32()), hits)
                    yield pa.RecordBatch.from_arrays([some.column("qid"), some.column("cluster"), lists], names=["qid", "part", "best"])

    return score, f"qid {query_type}, part int, best array<struct<neg:double,id:{id_type}>>"


def dense_search(vectors: DataFrame, queries: DataFrame, k: int = TOP, *, vec_id: str = "vec_id", query_id: str = "qid", vector: str = "embedding", digits: int = 9) -> DataFrame:
    """(qid, vec_id, score, rank): the k vectors of largest inner product per query; ties go to the smaller id."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vec")).where("vec is not null")
    asked = queries.select(F.col(query_id).alias("qid"), F.col(vector).alias("vec")).where("vec is not null")
    id_type, query_type = dict(rows.dtypes)["id"], dict(asked.dtypes)["qid"]
    share = min(1.0, 2.0 * CENTRES / max(rows.count(), 1))
    found = [r["vec"] for r in rows.where(F.rand(11) < share).limit(CENTRES).collect()] or [r["vec"] for r in rows.limit(1).collect()]
    if not found:
        return spark.createDataFrame([], f"qid {query_type}, vec_id {id_type}, score double, rank int")
    centres = np.array(found, dtype=np.float64)
    counts, radii = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres))
    for r in _placed(rows, centres).groupBy("cluster").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():  # a row a centre
        counts[r["cluster"]], radii[r["cluster"]] = r["n"], r["radius"] * (1 + 1e-12)
    blocks = np.maximum(1, -(-counts // BLOCK))
    plan = materialize(_visits(asked, centres, counts, radii, k))
    place = _placed(rows, centres, blocks).select("cluster", "block", "id", "vec")
    sizes = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "cluster int, blocks int")  # a row a centre
    score, schema = _score(id_type, query_type, k, digits)

    def lists(visits: DataFrame) -> DataFrame:
        """Best of each visited cluster, as (qid, best) lists."""
        load = visits.groupBy("cluster").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("turns")).join(F.broadcast(sizes), "cluster")
        load = F.broadcast(load)  # a row a centre at most
        there = place.join(load.select("cluster", "turns"), "cluster").select("cluster", "block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(0).alias("kind"), "id", F.lit(None).cast(query_type).alias("qid"), "vec")
        sent = visits.join(load, "cluster").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        sent = sent.select("cluster", "block", F.pmod(F.xxhash64("qid"), F.col("turns")).cast("int").alias("turn"), F.lit(1).alias("kind"), F.lit(None).cast(id_type).alias("id"), "qid", "vec")
        dealt = there.unionByName(sent).repartition(partitions(spark), "cluster", "block", "turn").sortWithinPartitions("cluster", "block", "turn", "kind")
        best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        return dealt.mapInArrow(score, schema).groupBy("qid", F.pmod("part", F.lit(8)).alias("part")).agg(best).groupBy("qid").agg(best)

    visit = plan.select("qid", "vec", F.inline("visits"))
    first = materialize(lists(visit.where("first")))
    least = first.select("qid", F.when(F.size("best") >= k, -F.element_at("best", k)["neg"]).alias("least"))
    rest = visit.where("not first").join(least, "qid").where(f"least is null or bound >= least - {10.0**-digits}")
    both = first.unionByName(lists(rest.select("qid", "vec", "cluster"))).groupBy("qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return both.select("qid", F.posexplode("best").alias("at", "hit")).select("qid", F.col("hit.id").alias("vec_id"), (0.0 - F.col("hit.neg")).alias("score"), (F.col("at") + 1).cast("int").alias("rank"))
