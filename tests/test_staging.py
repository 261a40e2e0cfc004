"""Joins and ranks that do not gather a hot key in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexmill.plans import components, staging
from lexmill.plans.staging import join_counted, join_hot, materialize, rank_within


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, the rest under keys of a few rows, some without."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 700 + 1)
    return spark.range(6000).select(F.col("id").alias("row"), key.alias("k"))


def test_join_hot_sends_only_hot_keys(spark, skewed):
    side = materialize(skewed.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("row").alias("low")))
    got = join_hot(skewed, side, "k", "n")
    assert sorted(tuple(r) for r in got.select("row", "k", "low").collect()) == sorted(tuple(r) for r in skewed.join(side, "k").select("row", "k", "low").collect())
    share = side.agg(F.sum("n")).first()[0] // (4 * staging.partitions(spark))
    assert [r["k"] for r in side.where(F.col("n") > share).collect()] == [0]
    # what is shuffled holds no key above the share
    assert "Union" in got._jdf.queryExecution().toString()
    even = side.where("k > 0")
    assert "Union" not in join_hot(skewed, even, "k", "n")._jdf.queryExecution().toString()
    assert join_hot(skewed, side.limit(0), "k", "n").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_counted_minds_bytes(monkeypatch, skewed, how):
    side = materialize(skewed.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).withColumn("name", F.repeat(F.lit("x"), 1000)))
    monkeypatch.setattr(staging, "BROADCAST_BYTES", 20_000)  # twenty rows of the side
    got = join_counted(skewed, side, "k", "n", how)
    assert sorted(map(repr, got.select("row", "k").collect())) == sorted(map(repr, skewed.join(side, "k", how).select("row", "k").collect()))


def test_ranks_of_a_group_over_many_tasks(spark, skewed):
    rows = skewed.withColumn("_at", F.lit("kept"))
    got = rank_within(rows.repartition(5), "k", "row", "place")
    assert got.columns == [*rows.columns, "place"]
    want, seen = [], {}
    for r in sorted(rows.collect(), key=lambda r: r["row"]):
        seen[r["k"]] = seen.get(r["k"], 0) + 1
        want.append((r["row"], r["k"], seen[r["k"]]))
    assert sorted(map(repr, ((r["row"], r["k"], r["place"]) for r in got.collect()))) == sorted(map(repr, want))
    parts = {r[0]: r[1] for r in rows.repartitionByRange(staging.partitions(spark), "k", "row").groupBy(F.spark_partition_id().alias("p")).count().collect()}
    assert max(parts.values()) < 3000  # the hot key is dealt over ranges
    assert rank_within(rows.limit(0), "k", "row", "place").collect() == []


@pytest.mark.parametrize("few", [True, False])
def test_components_of_few_edges_leave_few_files(spark, monkeypatch, few):
    parts, session = [], spark.newSession()
    for key, value in (("spark.sql.shuffle.partitions", "40"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        session.conf.set(key, value)
    if not few:
        monkeypatch.setattr(components, "BROADCAST_ROWS", 0)

    def kept(df):
        done = staging.materialize(df)
        parts.append(done.rdd.getNumPartitions())
        return done

    monkeypatch.setattr(components, "materialize", kept)
    edges = session.createDataFrame([(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 200), 100)}
    assert max(parts[1:]) <= (components.LEAST_TASKS if few else 40)
