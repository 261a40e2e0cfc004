from __future__ import annotations

import random

from brute import WORD

from lexmill.llm.mixing import mix_documents, mix_plan


def targets(sizes, cycle, budget, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [s for s in sizes if s is None]
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if most * sizes[s] < level * weight[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def check(rows, plan, budget=1.5):
    sizes = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = targets(sizes, [3.0, 1.0, 2.0], budget, 2.0)
    taken = dict.fromkeys(sizes, 0)
    longest = {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest.get(r["source"], 0), r["size"])
        assert r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1


def test_targets_and_totals(odd_docs, odd_rows, no_docs):
    plan = mix_plan(odd_docs).collect()
    check([r[:3] for r in odd_rows], plan)
    assert sorted(map(tuple, mix_plan(odd_docs.repartition(3)).select("doc_id", "taken").collect())) == sorted((r["doc_id"], r["taken"]) for r in plan)
    assert mix_plan(no_docs).collect() == []


def test_selection_in_several_rounds(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 4), "hot" if i % 3 else f"s{i % 40}") for i in range(30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, mix_plan(df).collect())


def test_documents_repeat_as_planned(odd_docs, no_docs):
    plan = {r["doc_id"]: r["repeats"] for r in mix_plan(odd_docs).collect()}
    mixed = mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    count = dict.fromkeys(plan, 0)
    for r in mixed.collect():
        count[r["doc_id"]] += 1
    assert count == plan
    assert mix_documents(no_docs).collect() == []


def test_given_weights(spark, odd_docs):
    weights = spark.createDataFrame([("s0", 1.0), (None, 1.0)], "source string, weight double")
    plan = mix_plan(odd_docs, weights=weights, budget=0.1).collect()
    assert {r["source"] for r in plan if r["taken"]} <= {"s0", None}
