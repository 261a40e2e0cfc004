"""Answer lookup where every row shares words with every question."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from lexmill.operators import lookup


def words_of(seed):
    """Sets with words that most of them hold, some copies, and a few rare words."""
    draw = random.Random(seed)
    sets = [["the", *draw.sample([f"w{i}" for i in range(12)], draw.randint(1, 8)), *([f"r{draw.randint(0, 30)}"] if draw.random() < 0.4 else [])] for _ in range(60)]
    return sets + sets[:9] * 4


@pytest.mark.parametrize("block", [7, 1000])
def test_overlap_in_blocks_equals_all_pairs(spark, block):
    rows = [(i * 7 % 97, f"q{i % 80}", t) for i, t in enumerate(words_of(1))]
    asked = [(i, f"q{i}" if i % 3 == 0 else "-", [w for w in t if w != "the" or i % 2]) for i, t in enumerate(words_of(2))] + [(900, "q1", []), (901, "-", ["nowhere"])]
    want = {}
    for qid, exact, own in asked:
        best = {}
        for i, e, t in rows:
            score = 1.0 if e == exact else len(set(own) & set(t)) / max(1, len(own))
            best[i] = max(score, best.get(i, 0.0))
        want |= {(qid, i): s for s, i in sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:4] if s > 0}
    schema = "id int, exact string, tokens array<string>"
    got = lookup.top_overlap(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema.replace("id", "qid", 1)), 4, block=block).collect()
    assert {(r["qid"], r["id"]): r["score"] for r in got} == want and len(got) == len(want)


def test_a_block_gives_k_rows_for_a_question():
    rows = pa.table({"id": list(range(500, 0, -1)), "words": ["a b c"] * 499 + ["a z"]})
    found = lookup._overlaps_of_block(3)(rows, pa.table({"qid": [8, 9], "words": ["c y", "z a"]})).to_pylist()
    assert [(r["qid"], r["id"], r["shared"]) for r in found] == [(8, 2, 1), (8, 3, 1), (8, 4, 1), (9, 1, 2), (9, 2, 1), (9, 3, 1)]
