from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from brute import line_removal, near_duplicates, pieces
from test_queries import compare
from tokenizers import Tokenizer

import corpus_pipeline
from lexmill.llm.queries import ORACLE_SQL, QUERIES

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    compare(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


def test_stages_against_plain_versions(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    plain = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"file://{tmp_path}/{k}")
        out = spark.read.parquet(path)
        got = out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "quality_rules":
            base = duckdb.connect()
            base.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
            kept = {r[0] for r in base.execute(f"SELECT doc_id FROM ({ORACLE_SQL['op3_quality_rules']}) WHERE kept").fetchall()}
            assert {r["doc_id"] for r in got} == kept
        elif name == "line_dedup":
            want = line_removal(list(plain.items()))
            assert {r["doc_id"]: r["text"] for r in got} == {d: t for d, t in want.items() if t.strip() or t == plain[d]}
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        elif name == "near_duplicates":
            assert {r["doc_id"] for r in got} == {d for d, (_, c) in near_duplicates(list(plain.items()), 5, 80, 100).items() if c == d}
        elif name == "mixing":
            assert {r["doc_id"] for r in got} <= set(plain) and len(got) <= 2 * len(plain)
            words, total = sum(len(t.split()) for t in plain.values()), sum(len(r["text"].split()) for r in got)
            assert abs(total - 1.5 * words) < 0.1 * words
        else:
            want = pieces(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [(r["doc_id"], r["text"]) for r in before], 1024, 2)
            assert sorted(tuple(r)[:5] for r in got) == sorted(want)
        before, docs = got, out
        if name in ("quality_rules", "line_dedup", "near_duplicates"):
            plain = {r["doc_id"]: r["text"] for r in got}


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_the_rest_works_without_these_modules(tmp_path):
    for name in ("lexmill", "jobs", "__spark_entry__.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name) if name.endswith(".py") else __import__("shutil").copytree(f"{ROOT}/{name}", tmp_path / name, ignore=lambda d, n: ["llm", "__pycache__"])
    code = "import __spark_entry__ as e; q = e.queries(); assert 'bm25_topk' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
