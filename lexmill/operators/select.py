"""Capped selection of articles and assembly of result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as tx

# Name, articles, documents, articles per document.
VARIANTS = [("p4_d2", 4, 2, 2), ("p5_d3", 5, 3, 2), ("p3_d2_precision", 3, 2, 2), ("p6_d3_recall", 6, 3, 3)]
CONTEXT_ARTICLES, CONTEXT_CHARS = 5, 1000


def variants(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VARIANTS, "variant string, max_articles int, max_docs int, max_per_doc int")


def capped(ranked: DataFrame, caps: DataFrame, *, group: str = "qid", distinct: bool = True) -> DataFrame:
    """Selection from rows (qid, pos, citation, doc) under each variant's caps.

    Equal to a greedy scan: first of each citation, documents in order of first
    appearance up to max_docs, then max_per_doc and max_articles by position.  First
    positions are aggregated before any window, and windows keep no more rows of a
    document, and documents of a group, than the largest cap, already before they are
    shuffled, so no task holds a whole ranking.
    """
    most = caps.agg(F.max("max_docs").alias("docs"), F.max("max_per_doc").alias("per_doc")).first()
    rows = ranked.where("citation <> ''").select(group, "pos", "citation", "doc")
    if distinct:
        rows = rows.groupBy(group, "citation").agg(F.min(F.struct("pos", "doc")).alias("_f")).select(group, "_f.pos", "citation", "_f.doc")
    docs = rows.groupBy(group, "doc").agg(F.min("pos").alias("_doc_at"))
    docs = docs.withColumn("doc_no", F.dense_rank().over(Window.partitionBy(group).orderBy("_doc_at"))).where(F.col("doc_no") <= (most["docs"] or 0))
    rows = rows.withColumn("in_doc", F.row_number().over(Window.partitionBy(group, "doc").orderBy("pos"))).where(F.col("in_doc") <= (most["per_doc"] or 0))
    fit = rows.join(docs.select(group, "doc", "doc_no"), [group, "doc"]).crossJoin(F.broadcast(caps)).where("doc_no <= max_docs and in_doc <= max_per_doc")
    fit = fit.withColumn("art_no", F.row_number().over(Window.partitionBy(group, "variant").orderBy("pos"))).where("art_no <= max_articles")
    return fit.select(group, "variant", "art_no", "doc_no", "citation", "doc")


def _ordered(value: str, at: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(at, value))), lambda s: s[value])


def selected_lists(selection: DataFrame, group: str = "qid") -> DataFrame:
    """(qid, variant, articles[], docs[]) of a selection."""
    return selection.groupBy(group, "variant").agg(_ordered("citation", "art_no").alias("articles"), F.array_distinct(_ordered("doc", "art_no")).alias("docs"))


def evidence_rows(evidence: DataFrame) -> DataFrame:
    """Used citations as ranked rows; the document is the first two parts of a citation."""
    rows = evidence.select("qid", F.posexplode("used_articles").alias("pos", "raw"))
    return rows.select("qid", "pos", tx.norm_space(F.col("raw")).alias("citation")).withColumn("doc", F.array_join(F.slice(F.split("citation", r"\|"), 1, 2), "|"))


def assemble(questions: DataFrame, evidence: DataFrame, ranked: DataFrame, caps: DataFrame) -> DataFrame:
    """(variant, qid, question, answer, relevant_docs[], relevant_articles[]) for every question and variant.

    Capped evidence where a question has any, the capped ranking otherwise.
    """
    used = selected_lists(capped(evidence_rows(evidence), caps, distinct=False)).select("qid", "variant", F.col("articles").alias("e_articles"), F.col("docs").alias("e_docs"))
    fallback = selected_lists(capped(ranked, caps)).select("qid", "variant", F.col("articles").alias("r_articles"), F.col("docs").alias("r_docs"))
    answers = evidence.select("qid", tx.norm_space(F.col("answer")).alias("answer"))
    rows = questions.select("qid", "question").crossJoin(F.broadcast(caps.select("variant"))).join(answers, "qid", "left").join(used, ["qid", "variant"], "left").join(fallback, ["qid", "variant"], "left")
    has = F.coalesce(F.size("e_articles") > 0, F.lit(False))
    none = F.array().cast("array<string>")
    pick = lambda e, r: F.when(has, F.col(e)).otherwise(F.coalesce(F.col(r), none))
    return rows.select("variant", "qid", "question", F.coalesce("answer", F.lit("")).alias("answer"), pick("e_docs", "r_docs").alias("relevant_docs"), pick("e_articles", "r_articles").alias("relevant_articles"))


def variant_summary(results: DataFrame) -> DataFrame:
    """Smallest, mean and largest list sizes and answers with CJK letters, per variant."""
    a, d = F.size("relevant_articles"), F.size("relevant_docs")
    return results.groupBy("variant").agg(F.min(a).alias("min_articles"), F.round(F.avg(a), 3).alias("avg_articles"), F.max(a).alias("max_articles"), F.min(d).alias("min_docs"), F.round(F.avg(d), 3).alias("avg_docs"), F.max(d).alias("max_docs"), F.count_if(tx.has_cjk(F.col("answer"))).alias("bad_answers"))


def context_items(ranked: DataFrame, most: int = CONTEXT_ARTICLES) -> DataFrame:
    """First distinct citations of each question with labels A1, A2, ..."""
    rows = ranked.where("citation <> ''").withColumn("_n", F.row_number().over(Window.partitionBy("qid", "citation").orderBy("pos"))).where("_n = 1")
    rows = rows.withColumn("label_no", F.row_number().over(Window.partitionBy("qid").orderBy("pos"))).where(F.col("label_no") <= most)
    return rows.drop("_n").withColumn("label", F.concat(F.lit("A"), F.col("label_no")))


def context_block(chars: int = CONTEXT_CHARS) -> Column:
    """One labelled block of the answer prompt."""
    heading = F.concat(tx.text_or_empty(F.col("article_label")), F.lit(" "), tx.text_or_empty(F.col("article_title")))
    return F.concat(F.lit("["), F.col("label"), F.lit("]\nCITATION: "), F.col("citation"), F.lit("\nTÊN VĂN BẢN: "), tx.text_or_empty(F.col("title")), F.lit("\nTÊN ĐIỀU: "), heading, F.lit("\nNỘI DUNG: "), F.substring(tx.norm_space(F.col("text")), 1, chars))


def context_texts(items: DataFrame, chars: int = CONTEXT_CHARS) -> DataFrame:
    """(qid, context): blocks in label order with an empty line between."""
    blocks = items.withColumn("block", context_block(chars))
    return blocks.groupBy("qid").agg(F.array_join(_ordered("block", "label_no"), "\n\n").alias("context"))


def clean_labels(raw: Column, known: Column) -> Column:
    """Labels a model named, as known labels in order; the first known one if none fits."""
    bare = F.transform(raw, lambda x: F.upper(F.btrim(tx.norm_space(x), F.lit("[]"))))
    full = F.transform(bare, lambda x: F.when(x.rlike(r"(?U)^\d+$"), F.concat(F.lit("A"), x)).otherwise(x))
    found = F.array_distinct(F.filter(full, lambda x: F.array_contains(known, x)))
    return F.when(F.coalesce(F.size(found), F.lit(0)) > 0, found).otherwise(F.slice(known, 1, 1))


def read_evidence(answers: DataFrame, items: DataFrame) -> DataFrame:
    """Parse model answers (qid, question, raw) against the labelled context items."""
    parsed = F.from_json(tx.json_object_text(F.col("raw")), "answer string, used_articles array<string>")
    listed = items.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("label_no", "label", "citation", "doc"))).alias("items"))
    rows = answers.withColumn("_p", parsed).join(listed, "qid", "left")
    text = tx.norm_space(F.col("_p.answer"))
    known = F.coalesce(F.col("items.label"), F.array().cast("array<string>"))
    labels = clean_labels(F.coalesce(F.col("_p.used_articles"), F.array().cast("array<string>")), known)
    field = lambda name: F.transform("used_labels", lambda x: F.element_at(F.filter("items", lambda i: i["label"] == x), 1)[name])
    rows = rows.withColumn("used_labels", labels)
    return rows.select("qid", "question", F.when(tx.has_cjk(text), "").otherwise(text).alias("answer"), "used_labels", field("citation").alias("used_articles"), F.array_distinct(field("doc")).alias("used_docs"), F.substring("raw", 1, 2000).alias("raw"))
