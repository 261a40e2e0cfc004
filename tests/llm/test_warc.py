from __future__ import annotations

import base64
import gzip
import hashlib
import os

import pytest

from lexmill.llm.warc import _members, parse_record, read_warc, write_warc

ROWS = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://é", ""), (5, "u", "big " * 50000), (6, "u", "big " * 50000), (None, "n", "only"), (9, "d", "same"), (9, "d", "same"), (8, "e", "same"), (7, "z", "漢😀")]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, sha1 int").repartition(4)
    where = f"file://{tmp_path}/w"
    manifest = write_warc(pages, where, shard_bytes=40_000, roll_bytes=300).collect()
    assert len(manifest) > 3 and sum(r["records"] for r in manifest) == len(ROWS)
    for r in manifest:
        body = (tmp_path / "w" / r["file"]).read_bytes()
        assert hashlib.sha256(body).hexdigest() == r["sha256"] and len(body) == r["bytes"]
        assert gzip.decompress(body).startswith(b"WARC/1.1\r\n")
    assert not os.listdir(tmp_path / "w/_temporary")
    top = {}
    for p, _, h in ROWS:
        top[h or ""] = max(top.get(h or "", -1), -1 if p is None else p)
    want = []
    for p, _, h in ROWS:
        raw = (h or "").encode()
        alone = sum((x[2] or "") == (h or "") for x in ROWS) == 1 or top[h or ""] == p
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if alone else "revisit", None if alone else top[h or ""], b"" if not alone else raw))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in read_warc(spark, where, with_payload=True).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_same_input_same_files(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    names = []
    for i, parts in enumerate((1, 5)):
        made = write_warc(pages.repartition(parts), f"file://{tmp_path}/{i}", shard_bytes=40_000, roll_bytes=300).collect()
        names.append(sorted((r["file"], r["sha256"]) for r in made))
    assert names[0] == names[1]


def test_shards_are_ranges_of_ids_wherever_they_lie(spark, tmp_path):
    rows = [(i * 7, "u", f"{i} " * 2000) for i in range(60)] + [(10**15, "far", "x"), (5, "one id", "a" * 5000), (5, "one id", "b" * 5000), (-(10**17), "low", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    manifest = write_warc(pages, f"file://{tmp_path}/r", shard_bytes=20_000).collect()
    assert sum(r["records"] for r in manifest) == len(rows) and len(manifest) >= 10
    ids, spans = [], {}
    for name in sorted(r["file"] for r in manifest):
        for member in _members(open(tmp_path / "r" / name, "rb")):
            fields, _ = parse_record(member)
            ids.append(fields["WARC-Record-ID"])
            spans.setdefault(name, []).append(int(fields["X-Page"]))
    assert len(set(ids)) == len(ids)
    ends = [(min(v), max(v)) for _, v in sorted(spans.items())]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert read_warc(spark, f"file://{tmp_path}/r").count() == len(rows)


def test_rows_that_repeat_have_ids_of_their_own(spark, tmp_path):
    write_warc(spark.createDataFrame([(9, "d", "same")] * 3 + [(8, "d", "same")], "page_id long, url string, html string"), f"file://{tmp_path}/i")
    name = next(n for n in os.listdir(tmp_path / "i") if n.endswith(".gz"))
    fields = [parse_record(m)[0] for m in _members(open(tmp_path / "i" / name, "rb"))]
    found = [f["WARC-Record-ID"] for f in fields]
    assert len(set(found)) == 4 and {f["WARC-Refers-To"] for f in fields if f["WARC-Type"] == "revisit"} <= set(found)


def test_small_payloads_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    write_warc(pages, f"file://{tmp_path}/m", min_revisit_bytes=100)
    kinds = {(r["page_id"], r["record_type"]) for r in read_warc(spark, f"file://{tmp_path}/m").collect()}
    assert {p for p, k in kinds if k == "revisit"} == {5}
    write_warc(pages.limit(0), f"file://{tmp_path}/e")
    assert read_warc(spark, f"file://{tmp_path}/e").collect() == []


def test_damage_is_found(spark, tmp_path):
    write_warc(spark.createDataFrame(ROWS[:1], "page_id long, url string, html string"), f"file://{tmp_path}/x")
    name = next(n for n in os.listdir(tmp_path / "x") if n.endswith(".gz"))
    record = gzip.decompress((tmp_path / "x" / name).read_bytes())
    with pytest.raises(ValueError, match="digest"):
        parse_record(record.replace(b"<p>x", b"<p>y"))


def test_null_ids_are_dealt_over_shards(spark, tmp_path):
    rows = [(None, "u", f"payload {i} " * 20) for i in range(300)] + [(i, "u", f"other {i} " * 20) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = write_warc(pages, f"file://{tmp_path}/n", shard_bytes=20_000)
    assert sorted(r["records"] for r in manifest.collect())[-1] < 100 and sum(r["records"] for r in manifest.collect()) == 305
    got = read_warc(spark, f"file://{tmp_path}/n", with_payload=True)
    assert sorted((r["page_id"] is None, bytes(r["payload"]).decode()) for r in got.collect()) == sorted((p is None, t) for p, _, t in rows)
    write_warc(pages.where("page_id is null").limit(3), f"file://{tmp_path}/a")
    assert read_warc(spark, f"file://{tmp_path}/a").count() == 3
