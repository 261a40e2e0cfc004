"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexmill.llm import importance
from lexmill.llm.importance import _features, crc_table, resample

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def plain(rows, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    total_s, total_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
    out, able = [], []
    for i, (doc, text) in enumerate(rows):
        found, n = features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, None])
        if n >= least:
            able.append((-score, doc is None, doc or 0, i))
    for rank, (*_, i) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[i][4] = rank
    return out


def texts():
    rnd = random.Random(4)
    bits = ["Word", "x1", "É", "漢字", "😀", "a" * 47, "b" * 48, "c" * 49, "d" * 300, " ", "  ", "-", "\n", "\x00", "_", "{", "9", "/", ":", "@", "`", "\x7f", "\x80"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 120))) for _ in range(300)]
    return made + ["", None, " . ", "a", "ab cd", "same words here " * 40, "Z" * 5000, "end", "start word"]


def test_table_is_zlibs():
    crc = np.uint32(0xFFFFFFFF)
    for byte in b"the quick":
        crc = crc_table()[(crc ^ byte) & 0xFF] ^ (crc >> np.uint32(8))
    assert int(crc) ^ 0xFFFFFFFF == zlib.crc32(b"the quick")


@pytest.mark.parametrize(("text_chunk", "run_chunk"), [(2_000_000, 200_000), (500, 7)])
def test_features_of_every_text(monkeypatch, text_chunk, run_chunk):
    monkeypatch.setattr(importance, "TEXT_CHUNK", text_chunk)
    monkeypatch.setattr(importance, "RUN_CHUNK", run_chunk)
    column = pa.array(texts())
    for part in (column, column[100:]):  # also a slice, of which the buffers begin earlier
        got, counts = [], []
        for words, blocks in _features(part):
            base = len(counts)
            counts += words.tolist()
            got += [(base + r, b) for bucket, row in blocks for b, r in zip(bucket.tolist(), row.tolist(), strict=True)]
        assert counts == [features(t)[1] for t in part.to_pylist()]
        assert sorted(got) == sorted((i, b) for i, t in enumerate(part.to_pylist()) for b in features(t)[0])


def test_resample_equals_plain(spark, odd_rows, odd_docs, no_docs):
    rnd = random.Random(5)
    rows = [(r[0], r[1]) for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(texts())]
    rows += [(2000 + i, " ".join(rnd.choice("law code of the land art 5".split()) for _ in range(rnd.randint(15, 60)))) for i in range(200)]
    rows += [(2000, rows[-200][1]), (None, "null id text " * 10), (None, None)]
    target = ["the law of the land", "code of law art 5", None]
    extra = [(d, t, 1, "s") for d, t in rows]
    df = spark.createDataFrame(extra, "doc_id long, text string, rank int, score string").repartition(6)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(df, wanted, percent=20)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and [t for _, t in got.dtypes[1:]] == ["bigint"] * 4
    assert sorted(map(repr, map(list, got.collect()))) == sorted(map(repr, plain(rows, target, 20)))
    assert resample(no_docs, wanted).collect() == []
    assert {r["rank"] for r in resample(odd_docs, wanted.limit(0), percent=0).collect()} == {None}


def test_columns_with_dots(spark):
    df = spark.createDataFrame([(i, f"word{i} " * 25) for i in range(40)], "`a.id` long, `a.text` string")
    got = resample(df, df, id_col="a.id", text_col="a.text", target_text="a.text")
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == [1, 2]
