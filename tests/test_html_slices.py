"""Pages in a worker's memory."""

from __future__ import annotations

import pyarrow as pa
import pytest

from lexmill.operators import html


@pytest.mark.parametrize("size, most", [(10, html.SLICE_ROWS), (300_000, 3), (3_000_000, 1)])
def test_few_pages_are_held_at_a_time(size, most):
    pages = [None, *("<p>" + "x" * (size + i) + "</p>" for i in range(9 if size > 10 else 999))]
    held = []

    def make(page):
        held[-1] += 1
        return {"n": len(page or "")}

    out, held = [], [0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(pages))), pa.array(pages)], names=["k", "html"]).slice(1)
    for made in html._mapped(iter([batch]), ["html"], make, {"n": pa.int64()}):
        assert held[-1] == made.num_rows <= most
        held.append(0)
        out += zip(made.column("k").to_pylist(), made.column("n").to_pylist(), strict=True)
    assert out == [(i, len(p or "")) for i, p in enumerate(pages)][1:]


def test_pages_without_rows_or_texts():
    batch = pa.RecordBatch.from_arrays([pa.array([None, None], pa.string())], names=["html"])
    run = lambda b: [r.to_pylist() for r in html._mapped(iter([b]), ["html"], lambda h: {"t": h}, {"t": pa.string()})]
    assert run(batch) == [[{"html": None, "t": None}] * 2] and run(batch.slice(0, 0)) == []
