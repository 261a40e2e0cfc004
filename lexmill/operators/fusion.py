"""Reciprocal-rank fusion, prior bonuses and re-ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as tx

from .bm25 import top_k

# Fusion constant, sizes and penalties.
RRF_K, TOP = 60, 80
LOCAL_PENALTY, BOILERPLATE_PENALTY, NO_ID_PENALTY = 0.08, 0.03, 0.05
RERANK_LOCAL, RERANK_BOILERPLATE, RERANK_CHARS = 0.18, 0.08, 1600


def with_citations(chunks: DataFrame) -> DataFrame:
    """Candidate fields of a chunk: filled legal_id, label, doc and citation."""
    code = tx.first_filled(F.col("legal_id"), tx.legal_id(F.col("title")))
    rows = chunks.withColumns({"legal_id": code, "article_no": tx.norm_space(F.col("article_no")), "source": tx.first_filled(F.col("source"), F.lit("vbpl"))})
    rows = rows.withColumn("article_label", tx.article_label(F.col("article_no")))
    return rows.withColumns({"doc": tx.doc_citation(F.col("legal_id"), F.col("title")), "citation": tx.article_citation(F.col("legal_id"), F.col("title"), F.col("article_no"), F.col("article_label"))})


def rrf(ranked: DataFrame, k: int = RRF_K) -> DataFrame:
    """Fuse rows (qid, citation, list_no, source, rank, weight, score, ...) into one per citation.

    Every item adds weight / (k + rank), several chunks of one article add
    each; the other fields come from the first item (first list, first rank).
    """
    others = [c for c in ranked.columns if c not in ("qid", "citation", "list_no", "source_name", "rank", "weight", "score")]
    place = F.struct("list_no", "rank")
    adds = F.transform(F.array_sort(F.collect_list(F.struct("list_no", "rank", (F.col("weight") / (F.lit(float(k)) + F.col("rank"))).alias("add"), "source_name", "score"))), lambda s: s)
    grouped = ranked.where("citation <> ''").groupBy("qid", "citation").agg(adds.alias("_items"), F.min(place).alias("first_at"), F.min_by(F.struct(*others), place).alias("_first") if others else F.lit(None).alias("_first"))
    # a sum in list order does not depend on partitions
    score = F.aggregate("_items", F.lit(0.0), lambda s, i: s + i["add"])
    sources = F.transform("_items", lambda i: F.struct(i["source_name"].alias("source"), i["rank"].alias("rank"), i["score"].alias("score")))
    return grouped.select("qid", "citation", "first_at", score.alias("rrf_score"), sources.alias("sources"), *([F.col(f"_first.{c}") for c in others]))


def prior(title: Column, kind: Column, article_title: Column, code: Column, question: Column) -> Column:
    """Document-type bonus and penalties added to the fused score."""
    local = F.when(tx.looks_local(title) & ~tx.allows_local(question), F.lit(-LOCAL_PENALTY)).otherwise(0.0)
    plate = F.when(tx.is_boilerplate(article_title) & ~tx.needs_boilerplate(question), F.lit(-BOILERPLATE_PENALTY)).otherwise(0.0)
    no_id = F.when((tx.legal_id(title) == "") & (tx.text_or_empty(code) == ""), F.lit(-NO_ID_PENALTY)).otherwise(0.0)
    return tx.doc_type_bonus(kind, title) + local + plate + no_id


def hybrid(fused: DataFrame, questions: DataFrame, k: int = TOP, digits: int = 12) -> DataFrame:
    """Add hybrid_score and keep the k best candidates of each question."""
    asked = fused.join(questions.select("qid", "question"), "qid")
    score = F.round(F.col("rrf_score") + prior(F.col("title"), F.col("doc_type"), F.col("article_title"), F.col("legal_id"), F.col("question")), digits)
    return top_k(asked.withColumn("hybrid_score", score), k, [F.desc("hybrid_score"), F.asc("first_at")])


def dense_text(title: Column, label: Column, article_title: Column, text: Column) -> Column:
    """What a chunk's vector is made of: its title, label and heading, then its whole text; absent parts are empty lines."""
    return F.concat_ws("\n", *map(tx.text_or_empty, (title, label, article_title, text)))


def rerank_text(title: Column, label: Column, article_title: Column, text: Column) -> Column:
    return F.concat_ws("\n", tx.text_or_empty(title), tx.text_or_empty(label), tx.text_or_empty(article_title), F.substring(tx.text_or_empty(text), 1, RERANK_CHARS))


def lexical_scorer(question: Column, text: Column) -> Column:
    """Deterministic stand-in for a model: share of the question's tokens in the text."""
    from lexmill.functions.tokens import lookup_tokens

    asked = lookup_tokens(question)
    return F.size(F.array_intersect(asked, lookup_tokens(text, 100_000))) / F.greatest(F.size(asked), F.lit(1))


def rerank(candidates: DataFrame, scorer: Callable[[Column, Column], Column] = lexical_scorer, digits: int = 12) -> DataFrame:
    """Score candidates, add the re-rank bonuses, and order them; all stay."""
    title = F.col("title")
    score = scorer(F.col("question"), rerank_text(title, F.col("article_label"), F.col("article_title"), F.col("text"))).cast("double")
    local = F.when(tx.looks_local(title) & ~tx.allows_local(F.col("question")), F.lit(-RERANK_LOCAL)).otherwise(0.0)
    plate = F.when(tx.is_boilerplate(F.col("article_title")) & ~tx.needs_boilerplate(F.col("question")), F.lit(-RERANK_BOILERPLATE)).otherwise(0.0)
    scored = candidates.withColumn("rerank_score", score)
    scored = scored.withColumn("final_score", F.round(F.col("rerank_score") + tx.doc_type_bonus(F.col("doc_type"), title) + local + plate, digits))
    return top_k(scored, 2**31 - 1, [F.desc("final_score"), F.asc("rank")], rank="final_rank")
