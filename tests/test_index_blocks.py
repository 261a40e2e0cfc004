"""Blocks of the stored index: made where the rows lie, bounded by a slice, and scored without gathering pairs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lexmill.operators import bm25, index

TEXTS = ["Đất đai ñandú", "a b a", None, "", "  ", "é́e ÀB ß İx", "b-a b/a 12 ١٢", "x" * 3000, "a " * 500, "日本 語ab", "ascii ONLY text, 7z"]


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, TEXTS[i % len(TEXTS)], TEXTS[i * 7 % 5]) for i in range(150)]
    return spark.createDataFrame(made, "rowid long, body string, title string")


def test_index_text_joins_the_index_tokens(spark, rows):
    both = rows.select(index.index_text(F.col("body")).alias("text"), F.array_join(bm25.index_tokens(F.col("body")), " ").alias("tokens"))
    assert both.where("not text <=> tokens").count() == 0


@pytest.mark.parametrize("slice_bytes", [50, 8 << 20])
def test_a_block_tells_what_it_holds(spark, tmp_path, monkeypatch, rows, slice_bytes):
    monkeypatch.setattr(index, "SLICE_BYTES", slice_bytes, raising=False)
    path = f"file://{tmp_path}/index"
    index.add_rows(rows, path, 0, ["body", "title"], buckets=3, shards=4)
    found = spark.read.parquet(f"{path}/postings").collect()
    seen = {}
    for r in found:
        assert r["rows"] == len(r["rowids"]) == len(r["fs"]) == len(r["dls"]) == len(r["places"])
        assert (r["most"], r["shortest"]) == (max(r["fs"]), min(r["dls"])) and r["fs"] == [len(p) for p in r["places"]]
        for rowid, f in zip(r["rowids"], r["fs"], strict=True):
            assert (r["token"], rowid) not in seen
            seen[r["token"], rowid] = f
    assert seen == {(r["token"], r["rowid"]): r["count"] for r in bm25.build_postings(rows, ["body", "title"]).groupBy("token", "rowid").count().collect()}
    blocks = {(r["token"], r["shard"]) for r in found}
    assert len(found) > len(blocks) if slice_bytes == 50 else len(found) == len(blocks) < len(seen)
    asked = spark.createDataFrame([(1, "a đất 12"), (2, "b/a text")], "qid int, text string")
    listed = lambda df: sorted((r["qid"], r["rank"], r["rowid"], round(r["score"], 6)) for r in df.collect())
    assert listed(index.search(spark, path, asked, 20, digits=6)) == listed(bm25.bm25_search(rows, asked, ["body", "title"], 20, digits=6))


def test_pairs_of_a_query_and_a_row_are_not_shuffled(spark, tmp_path, rows):
    path = f"file://{tmp_path}/index"
    index.add_rows(rows, path, 0, ["body"], buckets=2, shards=50)
    asked = spark.createDataFrame([(q, f"a text {q}") for q in range(5)], "qid int, text string")
    found = index.search(spark, path, asked, 500, digits=6, first_shards=1)
    plan = re.sub(r"#\d+L?", "", found._jdf.queryExecution().executedPlan().toString())
    assert "hashpartitioning(shard" in plan and "hashpartitioning(qid, rowid" not in plan and found.count() > 0
