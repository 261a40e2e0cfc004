"""Line dedup, substring dedup and the n-gram join against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import line_removal, near_duplicates, substring_removal
from conftest import prose

from lexmill.llm import ngram_join, substring_dedup
from lexmill.llm.components import connected_components
from lexmill.llm.line_dedup import dedup_lines
from lexmill.llm.ngram_join import drop_near_duplicates, near_duplicate_classes
from lexmill.llm.substring_dedup import remove_repeats, split_anchors
from lexmill.llm.wordhash import gram_hashes, text_buffers, word_hashes, words
from lexmill.plans import staging


def test_word_hashes():
    texts = ["a bc  a\tbc", None, "", "bc\x0ba\x1ca", "é x", " a "]
    data, offsets = text_buffers(pa.chunked_array([texts[:2], texts[2:]]).combine_chunks().slice(0))
    starts, ends, rows = words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert found == ["a", "bc", "a", "bc", "bc", "a\x1ca", "é", "x", "a"] and rows.tolist() == [0, 0, 0, 0, 3, 3, 4, 4, 5]
    hashes = word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(found))
    grams = gram_hashes(hashes, 2)
    assert grams[0] == grams[2] and len(set(grams.tolist())) == len(grams) - 1
    sliced = pa.array(texts).slice(3)
    again = word_hashes(text_buffers(sliced)[0], *words(*text_buffers(sliced))[:2])
    assert np.array_equal(again, hashes[4:])


def test_lines(odd_docs, odd_rows, no_docs):
    got = dedup_lines(odd_docs, counts=True)
    assert got.columns == [*odd_docs.columns, "n_lines", "n_removed"]
    assert {r["doc_id"]: r["text"] for r in got.collect()} == line_removal([r[:2] for r in odd_rows])
    assert dedup_lines(no_docs).collect() == []


def test_lines_with_columns_of_like_names(spark):
    text = "a b\nc d\ne f"
    rows = [(1, text, 9, "r", "k"), (2, text, 9, "r", "k"), (3, text + "\ng", 9, "r", "k"), (4, None, 9, "r", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed int, row string, _later string")
    got = sorted(tuple(r) for r in dedup_lines(df, length_col="n_removed", drop_emptied=True).collect())
    assert got == [(1, text, 9, "r", "k"), (3, "g", 1, "r", "k"), (4, None, 9, "r", "k")]
    assert {r["doc_id"]: r["n_removed"] for r in dedup_lines(df, counts=True).collect()} == {1: 0, 2: 3, 3: 3, 4: 0}


def test_lines_where_windows_are_too_many_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_ROWS", 3)
    rnd = random.Random(6)
    rows = [(i, "\n".join(rnd.choice(["a", "b", "c d", "", " "]) for _ in range(rnd.randint(0, 12)))) for i in range(120)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == line_removal(rows)


def test_lines_of_many_documents(spark):
    rnd = random.Random(6)
    rows = [(i, "\n".join(rnd.choice(["a", "b", "c d", "", " "]) for _ in range(rnd.randint(0, 12)))) for i in range(120)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == line_removal(rows)


@pytest.mark.parametrize("window", [35, 14])
def test_substrings(odd_docs, odd_rows, no_docs, window):
    got = sorted(tuple(r) for r in remove_repeats(odd_docs, window=window).collect())
    assert got == sorted(substring_removal([r[:2] for r in odd_rows], window))
    assert remove_repeats(no_docs).collect() == []


def test_substrings_at_random(spark):
    rnd = random.Random(8)
    passages = [prose(rnd, rnd.randint(30, 60)) for _ in range(6)]
    rows = [(i, " ".join(rnd.choice([*passages, prose(rnd, rnd.randint(0, 40)), "z " * rnd.randint(0, 60)]) for _ in range(rnd.randint(0, 5)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(tuple(r) for r in remove_repeats(df, window=35).collect())
    assert got == sorted(substring_removal(rows, 35))
    text = remove_repeats(df, window=35, with_text=True).where("doc_id = 0").first()["text"]
    assert isinstance(text, str)


def located(df):
    return df.selectExpr("xxhash64(doc_id, text) as loc", "cast(0 as int) as check", "doc_id", "text")


def test_boilerplate_in_unlike_texts_has_longer_prefixes(spark):
    rnd = random.Random(11)
    plate = prose(rnd, 30)
    rows = [(i, f"{prose(rnd, rnd.randint(20, 40))} {plate} {prose(rnd, rnd.randint(20, 40))}") for i in range(300)]
    rows += [(300 + i, f"{rows[i][1]} {prose(rnd, 5)}") for i in range(0, 300, 3)]  # repeats that cross the boilerplate
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    split = split_anchors(located(df), split_windows=500, counted=1)
    assert 0 < len(split) < 20 and not len(split_anchors(located(df), split_windows=10**9, counted=1))
    want = sorted(substring_removal(rows, 35))
    for bound in (1, 500, 10**9):
        assert sorted(tuple(r) for r in remove_repeats(df, split_windows=bound, counted=1).collect()) == want


def test_rows_that_repeat_share_all_windows(spark):
    rnd = random.Random(12)
    text = prose(rnd, 60)
    rows = [(1, text)] * 5 + [(2, prose(rnd, 60)), (None, text), (None, None), (3, " ".join(["x"] * 500)), (4, "y\t" * 34)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == [(0, 0, 0), (0, 60, 60), *[(1, 60, 60)] * 5, (2, 60, 0), (3, 500, 500), (4, 34, 0)]


def thue_morse(size):
    """Two complementary words of a and b, which agree in every polynomial modulo a power of two once they are long enough."""
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [64, 1024, 2048])
def test_long_words_of_like_form_differ(spark, size):
    one, two = thue_morse(size)
    head = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{head} {one}"), (2, f"{head} {two}"), (3, one), (4, two), (5, f"{one} {two} {two} {one} {one}"), (6, f"{two} {one} {one} {two} {one}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(tuple(r) for r in remove_repeats(df).collect()) == sorted(substring_removal(rows, 35))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_classes(df, words_per_gram=4, threshold=(85, 100)).collect()}
    assert got == near_duplicates(rows, 4, 85, 100)


def test_words_decide_where_hashes_agree(spark, monkeypatch):
    """With every word hashed alike all runs meet, and only equal words count as repeats."""
    monkeypatch.setattr(substring_dedup, "word_hashes", lambda data, starts, ends: np.ones(len(starts), dtype=np.uint64))
    rnd = random.Random(13)
    passage = prose(rnd, 40)
    rows = [(i, " ".join([prose(rnd, rnd.randint(10, 40)), passage if i % 3 else "", prose(rnd, rnd.randint(0, 30))])) for i in range(30)]
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([0] * 30, pa.int32()), pa.array([r[1] for r in rows])], names=["loc", "check", "text"])
    (sent,) = substring_dedup._emit(35, 12, np.zeros(0, np.uint64))(iter([batch]))
    assert len(set(sent.column("key").to_pylist())) >= 1
    runs, ats = [], []
    for loc, place in zip(sent.column("loc").to_pylist(), sent.column("place").to_pylist(), strict=True):
        first, size = place >> substring_dedup._FIRST & 0x7FFFFFFF, place >> substring_dedup._SIZE & 0x7FF
        runs.append(" ".join(rows[loc][1].split()[first : first + size + 34]).encode())
        ats.append(place >> substring_dedup._AT & 0x7FF)
    masks = substring_dedup.repeated_offsets(runs, ats, 35)
    seen = {}
    for i, (run, at) in enumerate(zip(runs, ats, strict=True)):
        split = run.split()
        for w in range(len(split) - 34):
            seen.setdefault((at - w, tuple(split[w : w + 35])), set()).add(i)
    want = [0] * len(runs)
    for (j, _), owners in seen.items():
        if len(owners) > 1 and j >= 0:
            for i in owners:
                want[i] |= 1 << j
    assert masks == want


@pytest.mark.parametrize(("n", "num", "den"), [(4, 85, 100), (5, 80, 100)])
def test_near_duplicates(odd_docs, odd_rows, no_docs, n, num, den):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_classes(odd_docs, words_per_gram=n, threshold=(num, den)).collect()}
    assert got == near_duplicates([r[:2] for r in odd_rows], n, num, den)
    assert near_duplicate_classes(no_docs).collect() == []


def edited(rnd, text, edits):
    found = text.split()
    for _ in range(edits):
        found[rnd.randrange(len(found))] = prose(rnd, 1)
    return " ".join(found)


@pytest.mark.parametrize(("seed", "frequent", "most"), [(1, 8, 1000), (2, 2, 1000), (3, 10**6, 12)])
def test_near_duplicates_at_random(spark, monkeypatch, seed, frequent, most):
    monkeypatch.setattr(ngram_join, "FREQUENT_DOCS", frequent)
    monkeypatch.setattr(ngram_join, "REGION_POINTS", most)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    rnd = random.Random(seed)
    passage, texts = prose(rnd, 40), []
    for _ in range(14):
        text = prose(rnd, rnd.randint(20, 160))
        texts += [edited(rnd, text, rnd.randint(0, max(1, len(text.split()) // 30))) for _ in range(rnd.randint(1, 9))]
    texts += [passage + " " + prose(rnd, rnd.randint(3, 60)) for _ in range(30)]
    chain = prose(rnd, 100).split()
    texts += [" ".join(chain[i * 4 : i * 4 + 60]) for i in range(10)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for n, num, den in ((4, 85, 100), (5, 80, 100), (3, 60, 100)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicate_classes(df, words_per_gram=n, threshold=(num, den)).collect()}
        assert got == near_duplicates(rows, n, num, den)


@pytest.mark.parametrize(("rounds", "many", "broadcast", "n", "num"), [(4, 2, 0, 4, 85), (2, 16, 32 << 20, 3, 60), (0, 2, 32 << 20, 4, 85)])
def test_large_regions_are_divided(spark, monkeypatch, rounds, many, broadcast, n, num):
    """Families, a chain and mixtures of passages in one region: pivots, rings and windows, then blocks, give all links."""
    for name, value in (("REGION_POINTS", 5), ("REGION_GRAMS", 3000), ("ROUNDS", rounds), ("PIVOTS", many), ("PIVOT_BYTES", broadcast)):
        monkeypatch.setattr(ngram_join, name, value)
    rnd = random.Random(21)
    words_of = prose(rnd, 600).split()
    texts = [" ".join(words_of[i * 6 : i * 6 + 60]) for i in range(85)]
    texts += [edited(rnd, " ".join(words_of[:90]), rnd.randint(0, 5)) for _ in range(40)]
    texts += [edited(rnd, " ".join(words_of[40:120]), rnd.randint(0, 4)) for _ in range(30)]
    texts += [" ".join(w for k in sorted(rnd.sample(range(10), 8)) for w in words_of[k * 20 : k * 20 + 20]) for _ in range(30)]
    rows = list(enumerate(texts))
    points = [(i, 0, t) for i, t in rows]
    df = spark.createDataFrame(points, "node long, region long, text string").repartition(5)
    links = ngram_join._links_of_large(df, n, num, 100)
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert {d: found.get(d, d) for d, _ in rows} == {d: c for d, (_, c) in near_duplicates(rows, n, num, 100).items()}


def test_one_of_each_group_stays(spark, odd_docs, odd_rows):
    kept = drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {d for d, (_, c) in near_duplicates([r[:2] for r in odd_rows], 5, 80, 100).items() if c == d}
    assert {r["doc_id"] for r in kept.collect()} == want
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, "c")], "doc_id long, text string")
    assert [r["component_id"] for r in near_duplicate_classes(twice.where("doc_id is not null")).collect()] == [1, 1]
    assert near_duplicate_classes(twice).count() == 4


def test_components(spark):
    rnd = random.Random(9)
    pairs = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if sum(find(y) == find(x) for y in root) > 1}
