"""The inverted multi-index against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from lexmill.llm import vector_search
from lexmill.llm.vector_search import Codebook, best_of, nearest_neighbours, traverse


def brute(rows, k, every):
    """query -> its k nearest (vec_id, score), ties to smaller ids."""
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=np.float64)).all() and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            scored = sorted((-float(np.cumsum(q * v)[-1]), j) for j, v in good if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def answers(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for got in found.values():
        got.sort()
        assert [g[0] for g in got] == list(range(1, len(got) + 1))
    return {q: [(v, s) for _, v, s in got] for q, got in found.items()}


def test_traversal_is_by_summed_distance():
    rnd = np.random.RandomState(3)
    one, two = rnd.randn(7), rnd.randn(5)
    found = list(traverse(one, two, np.arange(35)))
    assert [d for d, _, _ in found] == sorted((one[:, None] + two[None, :]).ravel().tolist())
    assert sorted(c for _, c, _ in found) == list(range(35)) and all(c == n for _, c, n in found)


def test_units_hold_every_cell():
    rnd = np.random.RandomState(1)
    counts = rnd.randint(0, 900, 400)
    counts[7] = 50_000
    book = Codebook(np.zeros((20, 2)), np.zeros((20, 2)))
    book.gather(counts)
    load = {}
    for cell in np.flatnonzero(counts):
        for u in range(book.unit_of[cell], book.unit_of[cell] + book.units_of[cell]):
            load[u] = load.get(u, 0) + counts[cell] / book.units_of[cell]
    assert max(load.values()) <= max(vector_search.UNIT_LEAST, counts.sum() // 24) and sorted(load) == list(range(len(load)))


def test_best_of_keeps_ties():
    vectors = np.array([[1.0, 0], [1, 0], [1, 0], [0, 1], [0.5, 0]])
    ((places, scores),) = best_of(np.array([[2.0, 0]]), vectors, 2)
    assert places.tolist() == [0, 1, 2] and scores.tolist() == [2.0] * 3
    ((places, _),) = best_of(np.array([[2.0, 0]]), vectors, 2, np.array([[False, False, False, True, True]]))
    assert places.tolist() == [3, 4]


@pytest.mark.parametrize(("kind", "units"), [("float", 2048), ("double", 40)])
def test_exact_when_all_is_visited(spark, monkeypatch, kind, units):
    """Nulls, zeros, non-finite and odd lengths, repeated rows, a vector of many rows, ties."""
    monkeypatch.setattr(vector_search, "UNIT_LEAST", units)
    monkeypatch.setattr(vector_search, "BLOCK", units)
    rnd = np.random.RandomState(5)
    rows = [(i, [float(np.float32(x)) for x in rnd.randn(7)]) for i in range(300)]
    rows += [(1000 + i, rows[40][1]) for i in range(200)] + [(3000 + i, [-x for x in rows[20][1]]) for i in range(30)]
    rows += [(2000, None), (2001, [0.0] * 7), (2002, [1.0, None] + [2.0] * 5), (2003, [float("nan")] + [1.0] * 6), (2004, [float("inf")] + [1.0] * 6), (None, rows[1][1])]
    extra = [(i, v, 1, "x") for i, v in rows] + [(40, rows[40][1], 1, "x"), (2005, [1.0] * 6, 1, "x"), (2006, [], 1, "x")]
    df = spark.createDataFrame(extra, f"vec_id long, embedding array<{kind}>, rank int, node string").repartition(4)
    got = nearest_neighbours(df, k=20, every=20, recall=1.0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found, want = answers(got), brute(rows, 20, 20)
    assert found.keys() == want.keys()
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))  # the calibration sees 128 queries at most
    assert all(len(found[q]) == 20 for q in want)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert answers(nearest_neighbours(df)) == brute(rows, 20, 20)
    assert nearest_neighbours(df.limit(0)).collect() == []
    assert nearest_neighbours(df.where("vec_id = 1")).collect() == []
    assert nearest_neighbours(df.where("vec_id = 0")).collect() == []
    one = spark.createDataFrame([(0, [1.0]), (1, [3.0]), (2, [-2.0])], "`v.id` int, `e.x` array<float>")
    assert answers(nearest_neighbours(one, id_col="v.id", vector_col="e.x")) == {0: [(1, 3.0), (2, -2.0)]}


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    found, want = answers(nearest_neighbours(df)), brute(rows, 20, 20)
    assert found.keys() == want.keys()
    recall = sum(len(set(found[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))
    assert recall >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    assert all(exact[q][v] == s for q, got in found.items() for v, s in got if v in exact[q])
