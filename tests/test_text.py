from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.functions import tokens as tk


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(("text", "want"), [("  a 　b\x1c\tc ", "a b c"), (None, ""), ("", ""), ("x", "x")])
def test_norm_space(spark, text, want):
    assert one(spark, tx.norm_space, text) == want


@pytest.mark.parametrize("text", ["Nghị Định Số 13", "ĐẤT ĐAI", unicodedata.normalize("NFD", "Điều lệ ấy"), "éçñ ø"])
def test_fold(spark, text):
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
    assert one(spark, tx.fold, text) == plain


@pytest.mark.parametrize(
    ("text", "want"),
    [("theo 13/2008/nđ-cp và", "13/2008/NĐ-CP"), ("số 5/QH-10", "5/QH-10"), ("9/QH-1 rồi 1/2020/TT", "1/2020/TT"), ("không có", ""), ("12345/2008/X", ""), (None, "")],
)
def test_legal_id(spark, text, want):
    assert one(spark, tx.legal_id, text) == want


@pytest.mark.parametrize(("title", "want"), [("Nghị định hướng dẫn Luật Giá", "Luật"), ("Bộ luật Dân sự", "Bộ luật"), ("Thông tư 1", "Thông tư"), ("Kỷ luật", "Luật"), ("Công văn", ""), ("luatsu", "")])
def test_doc_type(spark, title, want):
    assert one(spark, tx.doc_type, title) == want


def test_citations(spark):
    row = spark.createDataFrame([("", "Luật 1/2020/QH", "điều  5", "Điều 9"), ("", "T", "", "Điều 9")], "c string, t string, n string, l string")
    got = [r[0] for r in row.select(tx.article_citation(F.col("c"), F.col("t"), F.col("n"), F.col("l"))).collect()]
    assert got == ["1/2020/QH|Luật 1/2020/QH|Điều 5", "T|Điều 9"]


@pytest.mark.parametrize(("text", "want"), [("Điều".encode().decode("latin-1"), "Điều"), ("plain", "plain"), ("ÃÃ", "ÃÃ"), ("Â ấ", "Â ấ")])
def test_mojibake(spark, text, want):
    assert one(spark, tx.fix_mojibake, text) == want


@pytest.mark.parametrize(("text", "want"), [('```json {"a": {"b": 1}} ```', '{"a": {"b": 1}}'), ("none", None), ("} {", None), ('x {"a":1} y', '{"a":1}')])
def test_json_object_text(spark, text, want):
    assert one(spark, tx.json_object_text, text) == want


def test_slug_and_names(spark):
    assert one(spark, tx.slug, " Luật  Đất/đai ") == "luat-dat-dai"
    assert one(spark, tx.slug, "!!") == "van-ban"
    assert one(spark, tx.safe_filename, "a b/ç?.x") == "a_b_ç_.x"
    assert one(spark, tx.urls_in, 'see http://a.b/c), "https://x.y".') == ["http://a.b/c", "https://x.y"]


def test_search_terms(spark):
    assert one(spark, tk.search_terms, "Theo 13/2008/NĐ-CP, Luật và luật đất. a") == ["13/2008/NĐ-CP", "2008/NĐ-CP", "Luật", "đất."]
    assert one(spark, lambda c: tk.search_terms(c, 1), "Theo 13/2008/NĐ-CP, Luật") == ["13/2008/NĐ-CP"]
    assert one(spark, tk.search_terms, None) == []


def test_other_tokens(spark):
    assert one(spark, tk.plan_terms, "Của cua Luật, luật. dieu ab 12%") == ["của", "luật", "12%"]
    assert one(spark, tk.lookup_tokens, "Của Luật-đất, QUYỀN quyền 12.5% ab") == ["luat-dat", "quyen", "12.5%"]


def test_index_tokens_are_those_of_sqlite(spark):
    import sqlite3

    text = "a_b 12.5% ½ Đất đai ƯU tiên ấy ế é " + unicodedata.normalize("NFD", "đất ế") + " Ñandú straße ΑΒΓ x²"
    base = sqlite3.connect(":memory:")
    base.execute("CREATE VIRTUAL TABLE t USING fts5(x)")
    base.execute("CREATE VIRTUAL TABLE v USING fts5vocab(t, instance)")
    base.execute("INSERT INTO t VALUES (?)", (text,))
    want = [r[0] for r in base.execute("SELECT term FROM v ORDER BY offset")]
    assert one(spark, tk.index_tokens, text) == want
