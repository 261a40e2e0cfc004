"""The jobs over growing input, run again, and cut off."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_queries import compare

from jobs import keyword_index, queries, result_package
from lexmill.operators import bm25

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CONFIG = {"id_column": "doc_id", "text_columns": ["text"], "buckets": 4, "shards": 8, "files_per_batch": 1}


def plain(rows):
    """Postings straight from the texts."""
    made = bm25.build_postings(rows.withColumnRenamed("doc_id", "rowid"), ["text"]).groupBy("token", "rowid").count()
    return sorted(map(tuple, made.collect()))


def stored(spark, path):
    return sorted((r["token"], r["rowid"], r["f"]) for r in keyword_index.postings(spark, path).collect())


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").cache()


def test_index_takes_only_what_is_new(spark, tmp_path, documents):
    source, target, mark = (f"file://{tmp_path}/{n}" for n in ("documents", "index", "checkpoint"))
    run = lambda: keyword_index.run(spark, source, target, mark, CONFIG)
    documents.where("doc_id < 60").repartition(2).write.parquet(source)
    assert run() == {"batches": 2, "rows": 60}
    assert stored(spark, target) == plain(documents.where("doc_id < 60"))
    assert run() == {"batches": 0, "rows": 0}

    # a new file repeats ten documents, changed, beside new ones
    grown = documents.where("doc_id between 60 and 99").unionByName(documents.where("doc_id < 10").withColumn("text", F.lit("changed")))
    grown.coalesce(1).write.mode("append").parquet(source)
    assert run() == {"batches": 1, "rows": 40}
    assert stored(spark, target) == plain(documents.where("doc_id < 100"))

    # the last micro-batch as if it had been cut off before its commit: it runs again and changes nothing
    os.remove(tmp_path / "checkpoint/commits/2")
    for name in os.listdir(tmp_path / "checkpoint/commits"):
        if name.startswith(".2"):
            os.remove(tmp_path / "checkpoint/commits" / name)
    assert run() == {"batches": 1, "rows": 40}
    assert stored(spark, target) == plain(documents.where("doc_id < 100"))


def test_index_without_documents(spark, tmp_path, documents):
    paths = [f"file://{tmp_path}/{n}" for n in ("documents", "index", "checkpoint")]
    documents.limit(0).write.parquet(paths[0])
    assert keyword_index.run(spark, *paths, CONFIG)["rows"] == 0


def test_package_runs_again_with_the_same_result(spark, tmp_path, sf_dir):
    tables = [f"{sf_dir}/{t}.parquet" for t in ("benchmark", "documents", "conversations")]
    out = f"file://{tmp_path}/out"
    first = result_package.run(spark, *tables, out)
    rows = sorted(map(tuple, result_package.results(spark, out).collect()))
    assert first["results"] == len(rows) == 4 * first["questions"] and len({r[0] for r in rows}) == 4
    assert result_package.run(spark, *tables, out) == first
    assert sorted(map(tuple, result_package.results(spark, out).collect())) == rows
    assert spark.read.option("header", "true").csv(f"{out}/summary").count() == 4
    fewer = f"file://{tmp_path}/questions"
    spark.read.parquet(tables[0]).where("item_id < 3").write.parquet(fewer)
    result_package.run(spark, fewer, *tables[1:], out)  # what is gone from the input is gone from the package
    assert sorted(map(tuple, result_package.results(spark, out).collect())) == [r for r in rows if r[1] < 3]


def test_command_line(spark, tmp_path, documents):
    source = tmp_path / "documents"
    documents.where("doc_id < 20").write.parquet(f"file://{source}")
    args = ["--documents", str(source), "--index", f"{tmp_path}/index", "--checkpoint", f"{tmp_path}/mark"]
    done = subprocess.run([sys.executable, "-m", "jobs.keyword_index", *args, "--config", f"{ROOT}/jobs/keyword_index.json"], cwd=ROOT, capture_output=True, text=True, timeout=300, env=os.environ | {"SPARK_LOCAL_DIRS": str(tmp_path / "local"), "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=2 --conf spark.ui.enabled=false pyspark-shell"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "wrote 20 rows" in done.stderr
    assert stored(spark, f"file://{tmp_path}/index") == plain(documents.where("doc_id < 20"))
    shutil.rmtree(tmp_path / "local", ignore_errors=True)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_query_equals_sql(spark, sf_dir, name):
    compare(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_jobs_need_no_corpus_operators():
    for name in os.listdir(f"{ROOT}/jobs"):
        if name.endswith(".py"):
            text = open(f"{ROOT}/jobs/{name}", encoding="utf-8").read()
            assert "lexmill.llm" not in text and "corpus_pipeline" not in text
