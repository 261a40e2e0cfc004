"""The stored keyword index against the search over rows."""

from __future__ import annotations

import random

import pytest

from lexmill.operators import bm25, index


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    words = ["luật", "đất", "dai", "nha", "13/2008/NĐ-CP", "1", "2008", "art", "x", "quyền", "code-2", "rare1", "rare2"]
    made = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 25))), " ".join(rnd.choices(words[:6], k=3))) for i in range(400)]
    made += [(400, None, "luật"), (401, "rare3 rare3 rare3", None), (None, "luật luật", "x"), (402, "the 13/2008/NĐ-CP", "")]
    return spark.createDataFrame(made, "rowid long, body string, title string")


@pytest.fixture(scope="module")
def asked(spark):
    texts = ["quyền đất 13/2008/NĐ-CP", "rare3 luật", "code-2 code-2 nha", "zzz", "", None, "rare1 rare2 art x", "luật đất dai nha 1 2008"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "qid int, text string")


def listed(df):
    return sorted((r["qid"], r["rank"], r["rowid"], round(r["score"], 6)) for r in df.collect())


@pytest.mark.parametrize(("columns", "shards", "first"), [(["body"], 1, 1), (["body", "title"], 50, 1), (["title", "body"], 7, 100)])
def test_search_equals_the_search_over_rows(spark, tmp_path, rows, asked, columns, shards, first):
    path = f"file://{tmp_path}/index"
    there = rows.where("rowid is not null")
    assert index.add_rows(rows.where("rowid < 150 or rowid is null"), path, 0, columns, buckets=4, shards=shards) == 150
    assert index.add_rows(rows, path, 1, columns) == 253  # ids of batch 0 are known; the settings stay
    assert index.add_rows(rows, path, 1, columns) == 253  # run again, the same
    assert index.add_rows(rows, path, 2, columns) == 0
    for k in (3, 80):
        want = listed(bm25.bm25_search(there, asked, columns, k, digits=6))
        assert want and listed(index.search(spark, path, asked, k, digits=6, first_shards=first)) == want


def test_only_buckets_of_the_tokens_are_opened(spark, tmp_path, rows, asked):
    path = f"file://{tmp_path}/index"
    index.add_rows(rows, path, 0, ["body"], buckets=32, shards=16)
    tokens = spark.createDataFrame([("rare1",)], "token string").withColumn("bucket", index._bucket(index.F.col("token"), 32))
    found = index._postings(spark, path, tokens, "postings")
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "bucket#" in plan
    assert {r["token"] for r in found.collect()} == {"rare1"}
    files = found.inputFiles()
    assert files and len({f.split("bucket=")[1].split("/")[0] for f in files if f"bucket={tokens.first()['bucket']}/" in f}) == 1


def test_shards_below_the_kth_score_are_left_out(spark, tmp_path):
    """Only a few rows hold the rare word: once k of them are scored, shards without it are not read."""
    path = f"file://{tmp_path}/index"
    rows = spark.range(2000).selectExpr("id as rowid", "case when id < 5 then 'gold gold common' else 'common filler words' end as body")
    index.add_rows(rows, path, 0, ["body"], buckets=2, shards=200)
    query = spark.createDataFrame([(1, "gold common")], "qid int, text string")
    got = index.search(spark, path, query, 5, digits=6, first_shards=5)
    assert sorted(r["rowid"] for r in got.collect()) == [0, 1, 2, 3, 4]
    assert listed(got) == listed(bm25.bm25_search(rows, query, ["body"], 5, digits=6))


def test_empty_index(spark, tmp_path, asked):
    path = f"file://{tmp_path}/index"
    rows = spark.createDataFrame([(1, ""), (2, None)], "rowid long, body string")
    assert index.add_rows(rows, path, 0, ["body"]) == 2
    assert index.search(spark, path, asked).collect() == []
