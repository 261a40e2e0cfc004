from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 30)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, source): nulls, empties, ties, repeats, a long text, near and exact copies, shared passages."""
    import random

    rnd = random.Random(11)
    base = [prose(rnd, n) for n in (3, 60, 200, 80, 120)]
    passage = prose(rnd, 50)
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20, base[2], "s0"), (21, base[2].upper(), "s1"), (22, base[2] + " more", "s1"), (23, base[2].replace(" ", "\n\t "), None)]
    rows += [(30, prose(rnd, 40) + " " + passage + " " + prose(rnd, 30), "s2"), (31, passage + " " + prose(rnd, 90), "s2")]
    rows += [(40, None, "s0"), (41, "", "s1"), (42, " \n\t", None), (43, "a b", "s0"), (44, "A B", "s0"), (45, "x " * 300, "s1")]
    rows += [(50, "one line here\ntwo line here\nthree line here\nfour\n\nfive", "s0"), (51, "zero\ntwo line here\nthree line here\n\nfour\nsix", "s0"), (52, "one line here\ntwo line here\nthree line here", "s2")]
    rows += [(60, "\n".join(prose(rnd, 9) for _ in range(4000)), "s0"), (61, "é" * 50 + " 漢字 😀", "s9")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with extra columns of clashing names."""
    extra = [(*r, i, "k", "d") for i, r in enumerate(odd_rows)]
    return spark.createDataFrame(extra, "doc_id long, text string, source string, size int, kept string, digest string").repartition(5)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
