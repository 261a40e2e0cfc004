"""Splitting texts into articles, paragraphs and overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.plans.counters import Counters

from .normalize import DEFAULT_SOURCE, WHOLE_TEXT, first_wins

TARGET_CHARS, MAX_CHARS, OVERLAP, MIN_CHARS = 2200, 3600, 1, 80
HEADING = r"(?iU)Điều\s+([0-9]+[a-zA-Z]?|toan_van)\.?\s+([^\n]{0,180})"
#: Private-use character that marks cuts; it is removed from the input first.
MARK = "\uE000"


def split_articles(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per article: article_no, article_title, article_pos and the article's text.

    A heading takes up to 180 characters after its number, so a heading inside
    that span does not start an article.
    """
    whole = F.replace(tx.norm_space(F.col(text)), F.lit(MARK), F.lit(""))
    marked = F.regexp_replace(whole, f"({HEADING})", MARK + "$1")
    parts = F.split(marked, MARK)
    headed = F.filter(F.transform(parts, lambda p, i: F.when(i > 0, p)), lambda p: p.isNotNull())
    one = F.transform(headed, lambda p: F.struct(F.regexp_extract(p, HEADING, 1).alias("article_no"), tx.norm_space(F.regexp_extract(p, HEADING, 2)).alias("article_title"), tx.norm_space(p).alias("text")))
    none = F.array(F.struct(F.lit(WHOLE_TEXT).alias("article_no"), F.lit("Toàn văn").alias("article_title"), whole.alias("text")))
    rows = df.select(*[c for c in df.columns if c != text], F.posexplode(F.when(F.size(headed) > 0, one).otherwise(none)).alias("article_pos", "_a"))
    return rows.select("*", "_a.*").drop("_a")


def paragraphs(text: Column) -> Column:
    """Cut at white space after a full stop before "1." or "a)"; blanks dropped."""
    parts = F.split(text, r"(?:\n+|(?<=\.)(?U:[\s\x1c-\x1f]+)(?=\d+\.|[a-z]\)))")
    return F.filter(F.transform(parts, tx.norm_space), lambda p: p != "")


def chunk_texts(text: Column, target: int = TARGET_CHARS, longest: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """Pieces of a text: short texts whole, longer ones packed by paragraph with overlap."""
    whole = tx.norm_space(text)
    empty = F.array().cast("array<string>")
    zero = F.struct(empty.alias("out"), empty.alias("cur"), F.lit(0).alias("n"))
    size = lambda a: F.aggregate(a, F.lit(0), lambda s, p: s + F.length(p) + 1)

    def flush(state: Column) -> Column:
        tail = F.slice(state["cur"], F.greatest(F.size(state["cur"]) - overlap + 1, F.lit(1)), overlap) if overlap else empty
        return F.struct(F.concat(state["out"], F.array(F.array_join(state["cur"], " "))).alias("out"), tail.alias("cur"), size(tail).alias("n"))

    def add(state: Column, p: Column) -> Column:
        room = F.when((F.size(state["cur"]) > 0) & (state["n"] + F.length(p) + 1 > target), flush(state)).otherwise(state)
        put = F.struct(room["out"].alias("out"), F.concat(room["cur"], F.array(p)).alias("cur"), (room["n"] + F.length(p) + 1).alias("n"))
        return F.when(put["n"] >= longest, flush(put)).otherwise(put)

    packed = F.aggregate(paragraphs(whole), zero, add, lambda s: F.when(F.size(s["cur"]) > 0, F.concat(s["out"], F.array(F.array_join(s["cur"], " ")))).otherwise(s["out"]))
    return F.when(F.length(whole) <= longest, F.array(whole)).otherwise(packed)


def chunk_articles(articles: DataFrame, target: int = TARGET_CHARS, longest: int = MAX_CHARS, overlap: int = OVERLAP, shortest: int = MIN_CHARS, counters: Counters | None = None) -> DataFrame:
    """Chunks of articles; numbered before short ones go, first of equal texts stays.

    ``chunk_id`` is not unique when two articles share code and number.  ``counters``
    gets pieces, long_pieces and chunks from the pass that writes them.
    """
    counters = counters or Counters()
    pieces = articles.select("*", F.posexplode(chunk_texts(F.col("text"), target, longest, overlap)).alias("idx", "piece"))
    pieces = counters.at(pieces, pieces=F.count("*"), long_pieces=F.count_if(F.length("piece") >= shortest)).where(F.length("piece") >= shortest)
    code = F.col("legal_id")
    name = F.concat(F.lit(f"{DEFAULT_SOURCE}:"), tx.doc_key(code, F.col("title")), F.lit(":article:"), F.col("article_no"), F.lit(":chunk:"), F.col("idx").cast("string"))
    rows = pieces.select(name.alias("chunk_id"), "source", "doc_id", "legal_id", "doc_type", "title", "article_no", tx.article_label(F.col("article_no")).alias("article_label"), "article_title", "url", F.col("piece").alias("text"), F.struct("ord", "idx").alias("_at"), F.sha1("piece").alias("_hash"))
    kept = first_wins(rows, "_hash", "_at").select(*[c for c in rows.columns if not c.startswith("_")], F.col("_at.ord").alias("ord"), F.col("_at.idx").alias("idx"))
    return counters.at(kept, chunks=F.count("*"))
