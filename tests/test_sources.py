from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexmill.operators import select
from lexmill.plans.engine import STAGES, Engine, EngineConfig, Models, clean_question, retrieve
from lexmill.sources import fetch, readers, sinks
from lexmill.streaming import incremental


def test_jsonl(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_bytes('﻿{"a": 1}\n\n[1]\n{"a": bad}\n {"a": 2} \n'.encode())
    got = readers.read_jsonl(spark, f"file://{path}", "a int").orderBy("ord").collect()
    assert [r["a"] for r in got] == [1, 2]
    assert readers.read_jsonl(spark, f"file://{tmp_path}/none", "a int").count() == 0
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_jsonl(spark, f"file://{path}", "a int", strict=True).collect()


def test_questions_and_results(spark, tmp_path):
    path = tmp_path / "q.json"
    path.write_text(json.dumps({"data": [], "questions": [{"question": " a  b"}, {"id": 7, "query": "c"}, {"text": ""}]}))
    assert [tuple(r) for r in readers.read_questions(spark, f"file://{path}").orderBy("qid").collect()] == [(1, "a b"), (3, ""), (7, "c")]
    assert [tuple(r) for r in readers.read_questions(spark, f"file://{path}", need_id=True).collect()] == [(7, "c")]
    path.write_text(json.dumps([{"id": 1, "question": "q", "answer": " x  y ", "relevant_docs": ["d", " "], "relevant_articles": None}]))
    row = readers.read_results(spark, f"file://{path}").first()
    assert (row["answer"], row["relevant_docs"], row["relevant_articles"]) == ("x y", ["d"], [])


def test_sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Số ký hiệu,Trích yếu\n1,x,http://a.b/c).\n2,y,t\n", encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text("ID,Số ký hiệu,Trích yếu\n1,again,t\n3,z,http://a.b/c\n", encoding="utf-8")
    rows = readers.read_sheets(spark, f"file://{tmp_path}")
    named = readers.normalize_columns(rows).orderBy("ord").collect()
    assert [(r["id"], r["so_ky_hieu"], r["url"]) for r in named] == [("1", "x", ""), ("2", "y", ""), ("3", "z", "")]
    assert [r[0] for r in readers.url_list(rows).collect()] == ["http://a.b/c"]


def test_every_sheet_of_a_workbook(spark, tmp_path):
    """Two sheets a file, the second with other columns and URLs; cells without value are null."""

    def two_sheets(name, content):
        import pandas as pd

        first = pd.DataFrame({"ID": [1, 2], "a.b": ["x", None]})
        return [first, pd.DataFrame({"link": ["see http://a.b/1, http://a.b/2", content.decode()]})]

    (tmp_path / "w.xlsx").write_bytes(b"http://c.d/")
    (tmp_path / "~lock.xlsx").write_bytes(b"x")
    rows = readers.read_sheets(spark, f"file://{tmp_path}", frames=two_sheets)
    assert [tuple(r) for r in rows.orderBy("ord").collect()] == [("1", "x", 0), ("2", None, 1)] and rows.columns == ["ID", "a.b", "ord"]
    whole = readers.read_sheets(spark, f"file://{tmp_path}", every_sheet=True, frames=two_sheets)
    assert whole.columns == ["ID", "link", "a.b", "ord"] or whole.columns == ["ID", "a.b", "link", "ord"]
    assert [r[0] for r in readers.url_list(whole.drop("ord")).collect()] == ["http://a.b/1", "http://a.b/2", "http://c.d/"]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        readers.read_sheets(spark, f"file://{tmp_path}/none")


def test_docx(spark, tmp_path):
    xml = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>Điều</w:t><w:t> 1</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>x &amp;amp;  y</w:t></w:r></w:p></w:body></w:document>'
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", xml)
    assert readers.read_docx(spark, f"file://{tmp_path}").first()["lines"] == ["Điều 1", "x & y"]


def test_action_text(spark):
    text = '0:{"a":1}\n2:T1f,<html>x\ny</html>\n1:[{"b":2}]\n'
    blob = '3:T8,aGVsbG8=\n4:{"data":"$3"}\n'
    row = spark.createDataFrame([(text, blob)], "t string, b string").select(readers.action_html(F.col("t")), readers.action_json(F.col("t")), readers.action_blob(F.col("b")), readers.action_blob(F.col("t"))).first()
    assert row[0] == "<html>x\ny</html>" and row[1] == '[{"b":2}]' and bytes(row[2]) == b"hello" and row[3] is None


def test_fetch(spark):
    waits, answers = [], [(503, "a"), OSError("x"), (200, "ok")]

    def transport(url, timeout):
        answer = answers.pop(0)
        if isinstance(answer, OSError):
            raise answer
        return answer

    assert fetch.with_retry("u", transport, sleep=waits.append) == (200, "ok") and waits == [1.5, 3.0]
    assert fetch.fetch_page("u", lambda u, t: (404, "")) == (None, "HTTP 404")
    assert fetch.fetch_page("u", lambda u, t: (200, "Not Found")) == (None, "Page looks invalid")
    rows = spark.createDataFrame([("12", "T", ""), ("x", "Luật A", "http://u")], "id string, title string, url string")
    urls = rows.withColumn("urls", fetch.candidate_urls(F.col("id"), F.col("title"), F.col("url"), "http://old", "http://new"))
    got = [r["urls"] for r in urls.orderBy("id").collect()]
    assert got == [["http://old/vbpq-toanvan.aspx?ItemID=12", "http://old/vbpq-print.aspx?ItemID=12", "http://new/--12"], ["http://u", "http://new/luat-a--x", "http://new/--x"]]
    page = fetch.fetch_first_ok(urls, transport=lambda u, t: (200, "<p>") if u.startswith("http://new/--") else (500, ""), retries=1).orderBy("id").collect()
    assert [r["source_url"] for r in page] == ["http://new/--12", "http://new/--x"] and [len(r["logs"]) for r in page] == [3, 3]


def test_fetching_needs_to_be_allowed(spark):
    rows = spark.createDataFrame([("1", ["http://a/"])], "id string, urls array<string>")
    with pytest.raises(PermissionError, match="fetch is switched off"):
        Engine(spark, EngineConfig()).fetch(rows)
    allowed = Engine(spark, EngineConfig(allow_fetch=True))
    assert allowed.fetch(rows, transport=lambda u, t: (200, "<p>"), retries=1).first()["source_url"] == "http://a/"


def test_sinks(spark, tmp_path):
    base = f"file://{tmp_path}"
    results = spark.createDataFrame([("v1", 2, "q", "a", ["d"], ["x"]), ("v1", 1, "q", "a", [], [])], "variant string, qid int, question string, answer string, relevant_docs array<string>, relevant_articles array<string>")
    assert sinks.write_variants(results, base) == ["v1"]
    assert [r["id"] for r in json.loads((tmp_path / "v1/results.json").read_text())] == [1, 2]
    with zipfile.ZipFile(io.BytesIO((tmp_path / "v1.zip").read_bytes())) as z:
        assert z.namelist() == ["results.json"]
    made = sinks.promote(spark, {"r": (f"{base}/v1/results.json", f"{base}/kept/r.json"), "n": (f"{base}/no", f"{base}/n")}, f"{base}/manifest.json", hashes=True)
    assert {r["name"]: r["state"] for r in made.collect()} == {"r": "copied", "n": "missing"}
    assert {r["name"]: r["state"] for r in sinks.promote(spark, {"r": (f"{base}/v1/results.json", f"{base}/kept/r.json")}, f"{base}/m2.json").collect()} == {"r": "kept"}
    vectors = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id int, embedding array<float>")
    assert sinks.write_vectors(vectors.where("vec_id = 1"), f"{base}/v") == 1 and sinks.write_vectors(vectors, f"{base}/v") == 2
    with pytest.raises(FileNotFoundError):
        readers.require_artifacts(spark, {"x": f"{base}/nothing"})


def test_slices_and_page_check(spark):
    rows = spark.createDataFrame([(i, "x" * 6000 + "404" if i else "Page NOT Found") for i in range(5)], "ord int, html string")
    assert [r["ord"] for r in incremental.row_slice(rows, 1, 2).collect()] == [1, 2] and incremental.row_slice(rows, 3).count() == 2
    assert [r[0] for r in rows.orderBy("ord").select(fetch.looks_invalid(F.col("html"))).collect()] == [True, False, False, False, False]


def test_incremental(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "qid int, x string")
    path = f"file://{tmp_path}/t"
    assert incremental.append_pending(rows, path) == 2 and incremental.append_pending(rows, path) == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"qid": 3, "x": "c"}\nbad\n{"qid": 1, "x": "a"}\n')
    for _ in range(2):
        stream = incremental.stream_jsonl(spark, f"file://{tmp_path}/in", "qid int, x string")
        incremental.stream_to_table(stream, path, f"file://{tmp_path}/cp", "qid").awaitTermination()
        assert sorted(r["qid"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_engine(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "documents.jsonl").write_text("\n".join(json.dumps({"doc_id": f"d{i}", "title": f"Luật {i}/2020/QH", "status": ""}) for i in range(3)))
    (raw / "articles.jsonl").write_text("\n".join(json.dumps({"doc_id": f"d{i}", "text": f"Điều {j}. Quyền {w} " + f"{w} " * 30}) for i in range(3) for j, w in ((1, "đất"), (2, "nhà"))))
    (tmp_path / "q.json").write_text(json.dumps([{"id": 1, "question": "quyền nhà"}]))
    base = f"file://{tmp_path}"
    engine = Engine(spark, EngineConfig(base=base, out=f"{base}/out", questions=f"{base}/q.json", results=f"{base}/out/results/p4_d2/results.json", raw_dirs=["raw"], index_parts=2))
    took = engine.run(["normalize", "chunk", "keyword_index", "retrieve", "rerank", "results"])
    assert list(took) == ["normalize", "chunk", "keyword_index", "retrieve", "rerank", "results"]
    assert engine.table("documents").count() == 3 and engine.table("chunks").count() == 2
    result = json.loads((tmp_path / "out/results/p4_d2/results.json").read_text())[0]
    assert result["relevant_articles"][0].endswith("Điều 2")
    assert engine.answer(" quyền   nhà ")["matched_id"] == 1 and engine.health()["results_exists"] is True
    with pytest.raises(ValueError, match="empty"):
        clean_question("  ")
    with pytest.raises(ValueError, match="longer"):
        clean_question("x" * 2501)
    assert select.VARIANTS[0][0] == "p4_d2" and "raw_dirs" in engine.config()


def stand_ins():
    """Encoder and generator, as local classes so that they travel to the workers."""

    class Letters:
        """How often each of four letters occurs."""

        def encode(self, texts):
            return [[t.lower().count(c) + 0.01 for c in "abcd"] for t in texts]

    class Echo:
        """A plan for an expansion prompt, an answer with a label for one with context."""

        def generate(self, prompts):
            assert all(p.startswith(("EXPAND", "ANSWER")) for p in prompts)
            return ['{"query_expansion": "nhà đất", "hyde_answer": "bbb"}' if p.startswith("EXPAND") else '{"answer": " Có  quyền ", "used_articles": ["2", "A9"]}' for p in prompts]

    return Models(encoder=Letters(), generator=Echo(), expand_instructions="EXPAND", answer_instructions="ANSWER")


def test_engine_runs_all_stages(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "documents.jsonl").write_text("\n".join(json.dumps({"doc_id": f"d{i}", "title": f"Luật {i}/2020/QH", "status": ""}) for i in range(3)))
    (raw / "articles.jsonl").write_text("\n".join(json.dumps({"doc_id": f"d{i}", "text": f"Điều {j}. Quyền {w} {i} " + f"{w} {'abc'[i]} " * 30}) for i in range(3) for j, w in ((1, "đất"), (2, "nhà"))))
    (tmp_path / "q.json").write_text(json.dumps([{"id": 1, "question": "quyền nhà"}, {"id": 2, "question": "quyền gì"}]))
    base = f"file://{tmp_path}"
    engine = Engine(spark, EngineConfig(base=base, out=f"{base}/out", questions=f"{base}/q.json", results="", raw_dirs=["raw"], index_parts=2))
    for stage in ("dense_index", "expand", "answer"):
        with pytest.raises(ValueError, match=stage):
            engine.run([stage])
    models = stand_ins()
    assert list(engine.run(STAGES, models=models)) == STAGES
    assert engine.table("vectors").columns == ["vec_id", "embedding"] and engine.table("vectors").count() == engine.table("chunks").count() == 6
    one = {r["rowid"]: "\n".join([r["title"], r["article_label"], r["article_title"], r["text"]]) for r in engine.table("chunks").collect()}
    counts = {i: [t.lower().count(c) + 0.01 for c in "abcd"] for i, t in one.items()}
    assert all(r["embedding"] == pytest.approx([x / sum(y * y for y in counts[r["vec_id"]]) ** 0.5 for x in counts[r["vec_id"]]], abs=1e-5) for r in engine.table("vectors").collect())
    assert {(r["query_expansion"], r["hyde_answer"]) for r in engine.table("plans").collect()} == {("nhà đất", "bbb")}
    found = engine.table("candidates").collect()
    assert {s["source"] for r in found for s in r["sources"]} == {"bm25", "dense"}
    # the stored index and the rows give the same keyword list
    plans, questions = engine.plans(), engine.questions()
    rows = retrieve(engine.table("chunks"), questions, plans, engine.settings)
    stored = retrieve(engine.table("chunks"), questions, plans, engine.settings, index_path=engine.path("index"))
    listed = lambda df: sorted((r["qid"], r["rank"], r["citation"]) for r in df.collect())
    assert listed(rows) == listed(stored)
    used = {r["qid"]: r for r in engine.table("evidence").collect()}
    second = {r["qid"]: r["citation"] for r in engine.table("reranked").where("final_rank = 2").collect()}
    assert {q: (r["answer"], r["used_labels"], r["used_articles"]) for q, r in used.items()} == {q: ("Có quyền", ["A2"], [second[q]]) for q in (1, 2)}
    result = json.loads((tmp_path / "out/results/p4_d2/results.json").read_text())
    assert [r["answer"] for r in result] == ["Có quyền"] * 2 and result[0]["relevant_articles"] == [second[1]]
    assert list(engine.run(["keyword_index", "retrieve"], models=models)) == ["keyword_index", "retrieve"]  # complete stages stay
