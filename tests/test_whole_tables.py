"""Queries over whole tables against plain Python."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_operators import greedy_caps

from lexmill.functions.tokens import lookup_tokens
from lexmill.operators import graph, lookup, select
from lexmill.plans import queries


def code(k):
    return "" if k % 7 == 0 else f"{k % 900 + 1}/{2000 + k % 25}/NĐ-CP"


def documents(spark, sf_dir):
    return queries._documents(spark, sf_dir).select("doc_id", "source", "lang").collect()


def test_rule_plan_takes_the_last_of_all_documents(spark, sf_dir):
    last = {}
    for r in sorted(documents(spark, sf_dir)):
        last[r["doc_id"] % 50] = r["lang"], f"{r['source']} {code(r['doc_id'])}".strip()
    want = {}
    for r in queries._t(spark, sf_dir, "benchmark").collect():
        said = [f"{r['text']} {code(r['item_id'])}", *last.get(r["item_id"], ("", ""))]
        want[r["item_id"]] = "|".join(x for x in said if x), said[2]
    assert {r["qid"]: (r["queries"], r["hyde_answer"]) for r in queries.rule_plan(spark, sf_dir).collect()} == want


def test_relations_of_all_documents(spark, sf_dir):
    docs, want = documents(spark, sf_dir), []
    for r in docs:
        number = code(r["doc_id"] % 60).replace("Đ", "D")
        kind = str(r["doc_id"] % 20)
        for a in docs:
            if number and a["source"] == r["source"] and number in {code(k).replace("Đ", "D") for k in (a["doc_id"] % 60, a["doc_id"] % 45 + 1)}:
                want.append((r["source"], str(a["doc_id"]), graph.RELATIONS.get(kind, kind), str(r["doc_id"]), number, f"http://host/--{r['doc_id']}"))
    assert sorted(tuple(r) for r in queries.relation_enrich(spark, sf_dir).collect()) == sorted(want)


def test_caps_over_whole_rankings(spark, sf_dir):
    nation = {r["c_custkey"]: r["c_nationkey"] for r in queries._t(spark, sf_dir, "customer").collect()}
    lists, got, want = {}, {}, {}
    for r in sorted(queries._t(spark, sf_dir, "orders").collect(), key=lambda r: (-r["o_totalprice"], r["o_orderkey"])):
        doc = f"D{r['o_custkey'] % 7}"
        lists.setdefault(nation[r["o_custkey"]], []).append((f"{doc}|{r['o_orderkey'] % 5}", doc))
    for q, rows in lists.items():
        for name, a, d, p in select.VARIANTS:
            want[q, name] = greedy_caps(rows, a, d, p, False)
    for r in sorted(queries.evidence_caps(spark, sf_dir).collect(), key=lambda r: r["art_no"]):
        got.setdefault((r["qid"], r["variant"]), []).append(r["citation"])
    assert got == want


def test_lookup_of_all_stored_questions(spark, sf_dir):
    stored = queries._results(spark, sf_dir)
    rows = lookup.prepare_rows(stored).select("id", "exact", "tokens").collect()
    asked = [(r["item_id"], r["text"]) for r in queries._t(spark, sf_dir, "benchmark").collect()]
    upper = lambda s: "".join(c.upper() if "a" <= c <= "z" else c for c in s)
    asked += [(r["id"] + 1_000_000, upper(r["question"])) for r in stored.collect() if r["question"]]
    tokens = {r["qid"]: r["t"] for r in spark.createDataFrame(asked, "qid long, text string").select("qid", lookup_tokens(F.col("text"), lookup.QUERY_TOKENS).alias("t")).collect()}
    want = {}
    for qid, text in asked:
        query, own = " ".join(text.split()).lower(), set(tokens[qid])
        scores = sorted((-(1.0 if r["exact"] == query else len(own & set(r["tokens"])) / max(1, len(own))), r["id"]) for r in rows)
        want |= {(qid, k + 1): (x, round(-s, 5)) for k, (s, x) in enumerate(scores[:5])}
    assert len(asked) > len(rows)
    assert {(r["qid"], r["rank"]): (r["id"], r["score"]) for r in queries.answer_lookup(spark, sf_dir).collect()} == want
