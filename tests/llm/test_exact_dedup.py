from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lexmill.llm.exact_dedup import exact_dedup


def brute(rows, largest):
    groups = {}
    for d, t in rows:
        groups.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""), []).append(d)
    pick = max if largest else min
    return sorted((d, pick(ids), len(ids), d == pick(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for d in ids)


def test_groups(odd_docs, odd_rows, no_docs):
    for keep in ("largest", "smallest"):
        got = sorted(tuple(r) for r in exact_dedup(odd_docs, keep=keep).collect())
        assert got == brute([r[:2] for r in odd_rows], keep == "largest")
    assert exact_dedup(no_docs).collect() == []


def test_collisions_are_told_apart_by_bytes(odd_docs, odd_rows):
    got = sorted(tuple(r) for r in exact_dedup(odd_docs, keep="largest", short_hash=lambda d: F.substring(d, 1, 1)).collect())
    assert got == brute([r[:2] for r in odd_rows], True)


def test_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([(1, "a"), (1, "A"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = exact_dedup(df, keep="largest").collect()
    assert sorted(r["kept"] for r in got if r["group_size"] == 3) == [False, False, True]
    assert [r["kept"] for r in got if r["group_size"] == 1] == [True]
