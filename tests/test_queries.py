"""Every query with SQL against DuckDB, and the plans that matter at scale."""

from __future__ import annotations

import math

import duckdb
import pytest

from lexmill.plans.oracle import ORACLE_SQL
from lexmill.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 7)
    return value


def compare(spark, sf_dir, query, sql):
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = base.execute(sql)
    names = [d[0] for d in found.description]
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(plain(v) for v in r) for r in found.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    compare(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_top_k_prunes_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(QUERIES["bm25_topk"](spark, sf_dir))


@pytest.mark.parametrize("name", ["bm25_topk", "norm_fold", "tokens_lookup", "hybrid_rrf", "answer_lookup", "chunk_pack"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    assert not any(word in plan_of(QUERIES[name](spark, sf_dir)) for word in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas"))


def test_scan_reads_only_what_it_needs(spark, sf_dir):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(QUERIES["bm25_topk"](spark, sf_dir)) or "ReadSchema: struct<text:string,doc_id:bigint>" in plan_of(QUERIES["norm_fold"](spark, sf_dir)) or "struct<doc_id:bigint,text:string>" in plan_of(QUERIES["norm_fold"](spark, sf_dir))


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["qid", "rowid", "score", "rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
