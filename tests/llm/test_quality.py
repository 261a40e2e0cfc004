from __future__ import annotations

import re
from collections import Counter

from brute import WORD
from pyspark.sql import functions as F

from lexmill.llm import quality
from lexmill.llm.quality import SAMPLE_ROWS, all_rules, drawn, filter_quality, judge_quality, order_rules, spaced_words, verdict


def figures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {p for i, g in enumerate(grams) if count[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols, dup, marks = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), text.count("!")
    failed = n < 50 or 100 * len(covered) > 50 * n
    kept = not (failed or 100 * symbols > 30 * n or 100 * dup > 60 * len(lines) or chars < 2 * n or chars > 20 * n or 100 * marks > 40 * n)
    return n, chars, symbols, dup, len(covered), failed, kept


TEXTS = ["w%%% " * 3 + " ".join(f"a{i}%%%" for i in range(60)), "same line here\n" * 30 + " ".join(f"b{i}" for i in range(80)), " ".join(f"LOUD{i}!!" for i in range(60)), "a b c d a b c " + " ".join(f"w{i}" for i in range(60)), "a a a a a", "x\x0by\x1cz"]


def test_figures_and_verdict(spark, odd_rows, odd_docs, no_docs):
    rows = [r[:2] for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    df = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    got = sorted(tuple(r) for r in judge_quality(df).collect())
    assert got == sorted((d, *figures(t)) for d, t in rows)
    assert judge_quality(no_docs).collect() == []


def test_filter_keeps_all_columns(odd_docs, odd_rows, no_docs):
    got = filter_quality(odd_docs)
    assert got.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r[0] for r in odd_rows if figures(r[1])[-1])
    assert filter_quality(no_docs).collect() == []


def test_order_is_by_rejections_per_cost(spark):
    df = spark.range(1000).select(F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    order = order_rules(df, {"none": F.col("n_words") < 0, "all": F.col("n_words") >= 0})
    assert order == ["all", "none"]


def test_sample_is_drawn_from_everywhere(spark):
    """A table sorted by source: the draw holds rows of its head and of its tail."""
    df = spark.range(0, 8000, 1, 16).select(F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    ids = sorted(int(r["text"].split()[1]) for r in drawn(df, "text").select("text").collect())
    assert len(ids) == len(set(ids)) and SAMPLE_ROWS // 2 < len(ids) < 2 * SAMPLE_ROWS
    assert all(sum(a <= i < a + 2000 for i in ids) > 20 for a in range(0, 8000, 2000))


def test_sample_reads_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_FILES", 3)
    spark.range(0, 400, 1, 20).select(F.concat(F.lit("w "), F.col("id").cast("string")).alias("text")).write.parquet(f"file://{tmp_path}/d")
    df = spark.read.parquet(f"file://{tmp_path}/d")
    assert drawn(df, "text").count() == 60
    grouped = df.groupBy("text").count()  # no files' names left: drawn from all rows
    assert 100 < drawn(grouped, "text").count() < 300


def test_order_takes_two_actions_and_times_every_rule(spark):
    df = spark.range(1000).select(F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"))
    slow = F.size(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3000)), lambda i: F.array(F.concat(F.col("text"), i.cast("string"))))))) > 0
    tracker, group = spark.sparkContext.statusTracker(), "order-rules"
    spark.sparkContext.setJobGroup(group, group)
    assert order_rules(df, {"slow": slow, "fast": F.col("n_words") >= 0, "never": F.col("n_words") < 0}) == ["fast", "slow", "never"]
    assert len(tracker.getJobIdsForGroup(group)) <= 4  # two actions; each exchange is a job to the tracker
    spark.sparkContext._jsc.clearJobGroup()


def test_every_order_gives_the_same_verdict(odd_docs, odd_rows):
    rules = all_rules()
    rows = spaced_words(odd_docs.select("doc_id", "text"))
    want = {r[0] for r in odd_rows if figures(r[1])[-1]}
    for order in (list(rules), list(reversed(rules))):
        assert {r["doc_id"] for r in rows.where(verdict(rules, order)).collect()} == want
