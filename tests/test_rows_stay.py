"""Steps of keyword search and indexing that go on by row without a shuffle."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lexmill.operators import bm25, index


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_do_not_gather_a_frequent_token(spark):
    rows = spark.range(300).select(F.col("id").alias("rowid"), F.concat(F.lit("common word "), F.col("id") % 7, F.lit(" "), F.col("id")).alias("text"))
    asked = spark.createDataFrame([(q, f"common word {q} common") for q in range(20)], "qid long, text string")
    found = bm25.bm25_search(rows, asked, ["text"], 5)
    plan = plan_of(found)
    # neither the matches of a token nor the pairs of a query and a row are brought together
    assert "SortMergeJoin" not in plan and "hashpartitioning(qid, rowid" not in re.sub(r"#\d+L?", "", plan)
    assert {(r["qid"], r["rank"]) for r in found.collect()} == {(q, k) for q in range(20) for k in range(1, 6)}


def test_postings_of_a_row_need_no_shuffle(spark):
    rows = spark.createDataFrame([(1, "b a b", "A c"), (2, None, "x"), (3, "", None), (4, "z " * 300, "b")], "rowid long, title string, text string")
    made = index._row_postings(rows, ["title", "text"], "rowid")
    assert "Exchange" not in plan_of(made)
    want = {}
    for r in rows.collect():
        for col, text in enumerate((r["title"], r["text"])):
            for pos, token in enumerate((text or "").lower().split()):
                want.setdefault((token, r["rowid"]), []).append((col, pos))
    assert {(r["token"], r["rowid"]): [(p >> 32, p & 0xFFFFFFFF) for p in r["packed"]] for r in made.collect()} == want
    assert {r["rowid"]: r["dl"] for r in made.collect()} == {1: 5, 2: 1, 4: 301}
