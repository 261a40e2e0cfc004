"""Registered queries of the retrieval operators and the same in DuckDB SQL.

The tables hold no legal identifiers, so queries about them add markers that
both engines build alike from the row's id.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.functions import tokens as tk
from lexmill.operators import bm25, chunk, dense, fusion, graph, html, index, lookup, normalize, select, units
from lexmill.plans.counters import Counters
from lexmill.plans.staging import shared_dir
from lexmill.sources import readers
from lexmill.streaming import incremental


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents")


# Titles that the id picks; the same list in both engines.
TITLES = ["Bộ luật Dân sự", "Luật Đất đai tỉnh Hà Nam", "Nghị định về xuất bản", "Thông tư liên tịch", "Nghị quyết của HĐND huyện", "Quyết định phê duyệt", "Pháp lệnh thuế", "Công văn", "Nghị định hướng dẫn Luật Giá"]
STATUSES = ["Còn hiệu lực", "Hết hiệu lực", "HẾT HIỆU LỰC một phần", ""]
HEADINGS = ["Phạm vi điều chỉnh", "Quyền của người mua", "Tổ chức thực hiện", "Mức phạt"]
QUESTIONS = ["UBND tỉnh có quyền gì?", "Phạm vi áp dụng của luật", "Giá đất là bao nhiêu"]


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _sql_pick(values: list[str], key: str) -> str:
    listed = ", ".join("'" + v + "'" for v in values)
    return f"([{listed}])[({key} % {len(values)} + 1)::INT]"


def _code(key: Column) -> Column:
    """13/2008/NĐ-CP and the like; every seventh id has none."""
    return F.when(key % 7 == 0, "").otherwise(F.concat((key % 900 + 1).cast("string"), F.lit("/"), (2000 + key % 25).cast("string"), F.lit("/NĐ-CP")))


_SQL_CODE = "CASE WHEN {k} % 7 = 0 THEN '' ELSE ({k} % 900 + 1) || '/' || (2000 + {k} % 25) || '/NĐ-CP' END"


def _whole_text() -> Column:
    return F.coalesce("text", F.lit(""))


def norm_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", tx.norm_space(F.col("text")).alias("normal"), tx.fold(F.col("text")).alias("folded"))


def legal_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat(F.lit("theo "), F.lower(_code(k)), F.lit(" va "), (k % 50 + 1).cast("string"), F.lit("/QH-"), (k % 7).cast("string"), F.lit(" cung "), _code(k + 3), F.lit(" het "), _whole_text())
    rows = _documents(spark, sf_dir).select("doc_id", text.alias("t"))
    return rows.select("doc_id", tx.legal_id(F.col("t")).alias("legal_id"), F.array_join(tx.sorted_legal_ids(F.col("t")), ",").alias("all_ids"))


def title_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, heading, question = _pick(TITLES, F.col("doc_id")), _pick(HEADINGS, F.col("doc_id")), _pick(QUESTIONS, F.col("doc_id"))
    return _documents(spark, sf_dir).select("doc_id", tx.doc_type(title).alias("kind"), tx.doc_type_bonus(F.lit(""), title).alias("bonus"), tx.looks_local(title).alias("is_local"), tx.allows_local(question).alias("local_asked"), tx.is_boilerplate(heading).alias("plate"), tx.needs_boilerplate(question).alias("plate_asked"))


def citation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    rows = _documents(spark, sf_dir).select("doc_id", _code(k).alias("code"), _pick(TITLES, k).alias("title"), F.concat(F.lit("điều  "), (k % 9).cast("string")).alias("number"))
    return rows.select("doc_id", tx.doc_key(F.col("code"), F.col("title")).alias("doc_key"), tx.doc_citation(F.col("code"), F.col("title")).alias("doc"), tx.article_citation(F.col("code"), F.col("title"), F.col("number"), F.lit("")).alias("citation"))


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", tx.slug(F.col("text")).alias("slug"), tx.is_numeric_id(F.col("source")).alias("numeric"))


def tokens_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.array_join(tk.lookup_tokens(F.col("text")), " ").alias("tokens"))


def tokens_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.array_join(tk.plan_terms(F.col("text")), " ").alias("terms"))


def tokens_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.array_join(tk.search_terms(F.col("text")), " ").alias("terms"))


def doc_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("source", "lang", "n_chars", F.col("doc_id").alias("ord"), _pick(STATUSES, F.col("doc_id")).alias("status"))
    return normalize.last_wins(normalize.drop_expired(rows), "source")


def dedupe_text_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select(F.sha1("text").alias("hash"), F.col("doc_id").alias("ord"), "lang")
    return normalize.first_wins(rows, "hash")


def _two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(F.col("doc_id").alias("ord"), F.concat_ws("|", "source", "lang", (F.col("n_chars") % 40).cast("string")).alias("key"), F.concat_ws("|", F.substring(F.sha1("text"), 1, 2), "lang").alias("hash"))


def dedupe_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _two_keys(spark, sf_dir)
    return normalize.two_key_dedupe(rows, "key", "hash").select("ord", "key", "hash")


def dedupe_two_key_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stream over files that come one after the other."""
    folder = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    rows = _two_keys(spark, sf_dir)
    middle = rows.agg(F.percentile_approx("ord", 0.5)).first()[0] or 0
    for part in (rows.where(F.col("ord") <= middle), rows.where(F.col("ord") > middle)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        incremental.dedupe_two_keys_to_table(stream, f"{folder}/out", f"{folder}/checkpoint", "key", "hash").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("ord", "key", "hash")


def _raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    return _documents(spark, sf_dir).select(F.lit("").alias("title"), F.concat(_pick(TITLES, k), F.lit("  số "), F.col("source")).alias("ten_van_ban"), _code(k).alias("so_ky_hieu"), F.lit(None).cast("string").alias("url"), F.concat(F.lit("http://x/"), k).alias("source_url"), _pick(STATUSES, k).alias("tinh_trang"), k.alias("ord"))


def normalized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_documents(_raw_documents(spark, sf_dir))


def stage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the document and chunk stages count while they are written."""
    counters = Counters()
    made = [normalize.document_table(_raw_documents(spark, sf_dir), counters=counters), chunk.chunk_articles(_sample_articles(spark, sf_dir), counters=counters)]
    for table in made:
        table.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counters.values().items()), "counter string, n long")


def _sample_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    marked = F.regexp_replace(F.regexp_replace("text", r"\s+", " "), r"\. ", ". 1. ")
    return _documents(spark, sf_dir).select(F.col("source"), k.cast("string").alias("doc_id"), _code(k).alias("legal_id"), F.lit("").alias("doc_type"), _pick(TITLES, k).alias("title"), (k % 20).cast("string").alias("article_no"), _pick(HEADINGS, k).alias("article_title"), F.lit("").alias("url"), marked.alias("text"), k.alias("ord"))


def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk_articles(_sample_articles(spark, sf_dir))


def article_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Mở đầu. Điều 1. "), F.col("text"), F.lit(" Điều 2a Phạm vi. "), F.substring("text", 1, 200), F.lit(" điều 3. hết"))
    return chunk.split_articles(_documents(spark, sf_dir).select("doc_id", text.alias("text")))


def _bm25_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("rowid"), "text")
    found = bm25.bm25_search(rows, _bm25_queries(spark, sf_dir), ["text"], 80, digits=6)
    return found.select("qid", "rowid", "score", "rank")


def keyword_search_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search from an index that is written in two batches first."""
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("rowid"), "text")
    folder = f"{shared_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    half = F.pmod(F.xxhash64("rowid"), F.lit(2))
    for batch in (0, 1):
        index.add_rows(rows.where(half == batch), folder, batch, ["text"], buckets=16)
    return index.search(spark, folder, _bm25_queries(spark, sf_dir), 80, digits=6)


def bm25_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("rowid"), "text")
    tokens = _bm25_queries(spark, sf_dir).select("qid", tk.index_tokens(F.col("text")).alias("tokens")).where("size(tokens) >= 2")
    pairs = F.transform(F.sequence(F.lit(1), F.size("tokens") - 1), lambda i: F.slice("tokens", i, 2))
    return bm25.phrase_matches(bm25.token_rows(rows, ["text"]), tokens.select("qid", F.explode(pairs).alias("phrase"))).select("key", "rowid", "f")


def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _t(spark, sf_dir, "embeddings")
    queries = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), "embedding")  # the stated query set
    return dense.dense_search(vectors, queries, 60, digits=6)


def _ranked_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ranked lists of chunks per language, several chunks to a citation."""
    docs = _documents(spark, sf_dir)
    k = F.col("doc_id")
    rows = docs.select(F.col("lang").alias("qid"), k.alias("rowid"), F.col("n_chars").cast("double").alias("score"), _code(F.floor(k / 3)).alias("legal_id"), _pick(TITLES, F.floor(k / 3)).alias("title"), F.lit("").alias("doc_type"), (k % 2).cast("string").alias("article_no"), _pick(HEADINGS, k % 2).alias("article_title"), F.lit("").alias("source"), "text")
    rows = fusion.with_citations(rows).drop("source")
    one = bm25.top_k(rows, 80, [F.desc("score"), F.asc("rowid")]).withColumns({"list_no": F.lit(0), "source_name": F.lit("bm25"), "weight": F.lit(1.0)})
    two = bm25.top_k(rows, 60, [F.asc("rowid")]).withColumns({"list_no": F.lit(1), "source_name": F.lit("dense"), "weight": F.lit(1.0)})
    return one.unionByName(two)


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _documents(spark, sf_dir).select(F.col("lang").alias("qid")).distinct().withColumn("question", _pick(QUESTIONS, F.length("qid") + F.ascii("qid")))
    return fusion.hybrid(fusion.rrf(_ranked_lists(spark, sf_dir)), questions)


def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("qid", "citation", "rowid", F.round("rrf_score", 9).alias("rrf"), F.round("hybrid_score", 9).alias("hybrid"), F.size("sources").cast("long").alias("n_sources"), "rank")


def rerank_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fusion.rerank(_fused(spark, sf_dir), scorer=lambda q, t: F.length(t) / 10000.0)
    return scored.select("qid", "citation", F.round("rerank_score", 9).alias("score"), F.round("final_score", 9).alias("final"), "final_rank")


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders by price as a ranking of citations within documents."""
    orders = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    doc = F.concat(F.lit("D"), (F.col("o_custkey") % 7).cast("string"))
    return orders.select(F.col("c_nationkey").alias("qid"), F.concat(doc, F.lit("|"), (F.col("o_orderkey") % 5).cast("string")).alias("citation"), doc.alias("doc"), F.struct(-F.col("o_totalprice"), "o_orderkey").alias("pos"))


def capped_select_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.capped(_ranking(spark, sf_dir), select.variants(spark)).select("qid", "variant", "art_no", "citation", "doc")


def evidence_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.capped(_ranking(spark, sf_dir), select.variants(spark), distinct=False).select("qid", "variant", "art_no", "citation", "doc")


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("qid"), F.col("n_name").alias("question"))
    evidence = questions.where("qid % 3 <> 0").select("qid", F.concat(F.lit(" answer  "), F.col("question")).alias("answer"), F.when(F.col("qid") % 3 == 1, F.array(F.lit("a|b|1"), F.lit("a|b|2"), F.lit("a|b|3"), F.lit("c|d|1"), F.lit(" "), F.lit("e|f|1"), F.lit("g|h|1"))).otherwise(F.array().cast("array<string>")).alias("used_articles"))
    return select.assemble(questions, evidence, _ranking(spark, sf_dir), select.variants(spark))


def result_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).select("variant", "qid", "question", "answer", F.array_join("relevant_docs", ";").alias("docs"), F.array_join("relevant_articles", ";").alias("articles"))


def variant_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.variant_summary(_assembled(spark, sf_dir))


def context_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fused(spark, sf_dir).withColumn("pos", F.col("rank"))
    return select.context_texts(select.context_items(rows))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _t(spark, sf_dir, "conversations")
    said = lambda turn: F.max(F.when(F.col("turn") == turn, tx.norm_space(F.col("text"))))
    rows = turns.groupBy(F.col("conv_id").alias("id")).agg(F.coalesce(said(0), F.lit("")).alias("question"), F.coalesce(said(1), F.lit("")).alias("answer"))
    none = F.array().cast("array<string>")
    return rows.select("id", "question", "answer", none.alias("relevant_docs"), none.alias("relevant_articles"))


def answer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _results(spark, sf_dir)
    questions = _bm25_queries(spark, sf_dir).select("qid", F.col("text").alias("question"))
    exact = stored.where("question <> ''").select((F.col("id") + 1_000_000).alias("qid"), F.translate("question", string.ascii_lowercase, string.ascii_uppercase).alias("question"))  # repeats of all stored questions; engines differ on other letters
    found = lookup.answer_candidates(lookup.prepare_rows(stored), questions.unionByName(exact))
    return found.select("qid", "rank", "id", "score", "answer_head")


def rule_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.concat("text", F.lit(" "), _code(F.col("item_id"))).alias("question"))
    plans = _documents(spark, sf_dir).select((F.col("doc_id") % 50).alias("qid"), F.col("lang").alias("query_expansion"), F.concat("source", F.lit(" "), _code(F.col("doc_id"))).alias("hyde_answer"), F.col("doc_id").alias("ord"))
    made = graph.rule_plans(questions, plans)
    return made.select("qid", F.array_join("queries", "|").alias("queries"), F.array_join("must_terms", " ").alias("terms"), F.array_join("legal_codes", ",").alias("codes"), "hyde_answer")


def _coded_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat(F.lit("theo "), _code(k), F.lit(" va "), F.lower(_code(k * 3 + 1)), F.lit(" "), F.col("lang"), F.lit(" "), _whole_text())
    return _documents(spark, sf_dir).select(F.col("doc_id").alias("chunk_id"), "source", k.cast("string").alias("doc_id"), _code(F.floor(k / 2)).alias("legal_id"), (k % 3).cast("string").alias("article_no"), _pick(TITLES, k).alias("title"), F.col("lang").alias("article_title"), text.alias("text"), k.alias("ord"))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.article_nodes(_coded_chunks(spark, sf_dir))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.mention_edges(_coded_chunks(spark, sf_dir))


def relation_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    docs = _documents(spark, sf_dir)
    articles = docs.select(F.col("source").alias("doc_id"), k.cast("string").alias("article_no"), F.concat(F.lit("theo "), _code(k % 60), F.lit(" va "), _code(k % 45 + 1), F.lit(" "), _whole_text()).alias("article_text"))
    groups = docs.select(F.col("source").alias("doc_id"), F.lit(graph.RELATION_GROUPS[0]).alias("relation_group"), F.create_map((k % 20).cast("string"), F.array(F.struct(k.cast("string").alias("id"), F.concat(F.lit("Văn bản "), _code(k % 60)).alias("name")))).alias("items"))
    relations = graph.relation_rows(groups, "items", "http://host")
    return graph.enrich_with_relations(articles, relations).select("doc_id", "article_no", "quan_he", "id", "matched_so_hieu", "url")


def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).withColumns({"status": _pick(STATUSES, F.col("doc_id")), "answer": F.when(F.col("doc_id") % 11 == 0, F.concat("lang", F.lit(" 中文"))).otherwise(F.col("lang"))})
    return normalize.drop_expired(rows).where(F.length("text") >= 80).where(~tx.has_cjk(F.col("answer"))).select("doc_id", "status", "answer")


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("qid"), "lang")
    done = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("qid"))
    return incremental.pending(rows, done).withColumn("state", F.lit("pending")).unionByName(incremental.finished(rows, done).withColumn("state", F.lit("done")))


def url_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.url_list(_t(spark, sf_dir, "pages").select("url", "html"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"))


def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("doc_id", F.concat_ws("_", "source", tx.safe_filename(F.col("lang"))).alias("base"))
    return normalize.suffix_keys(rows, "base", "doc_id").select("doc_id", "key")


def html_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.with_text_and_title(_t(spark, sf_dir, "pages")).select("page_id", "title", "text")


def html_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.page_units(_t(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    return found.select("page_id", "pos", "chunk_level", "article_no", "article_title", "article_text")


#: What stands before the lines of a document, by turns; the same list in both engines.
LINE_STARTS = ["", "Chương II ", "Mục 3 ", "Điều 4. ", "1. ", "a) ", "", "b) ", "12. ", "Đ) ", "điều 5a ", "", "Chương 7. "]


def text_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, clauses and points of whole documents whose lines are given headings."""
    docs = _documents(spark, sf_dir).select("doc_id", F.posexplode(F.split(_whole_text(), "\n")).alias("i", "line"))
    start = F.when(F.col("doc_id") % 5 == 0, "").otherwise(_pick(LINE_STARTS, F.col("doc_id") * 7 + F.col("i") * (F.col("doc_id") % 3 + 1)))
    lines = docs.select(F.col("doc_id").alias("key"), F.col("i").alias("pos"), F.concat(start, F.col("line")).alias("raw"))
    rows = lines.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw"))), lambda x: x["raw"]), "\n").alias("text"))
    found = units.units(units.plain_lines(rows, "key", "text"))
    clauses = F.array_join(F.transform("clauses", lambda c: F.concat_ws("~", c["clause_no"], c["text"], F.array_join(F.transform(c["points"], lambda p: F.concat_ws("=", p["point"], p["text"])), "+"))), "|")
    return found.select(F.col("key").alias("doc_id"), "pos", "chunk_level", "article_no", "article_title", "chapter", "section", F.sha1("article_text").alias("text_sha1"), F.size("clauses").cast("long").alias("n_clauses"), F.sha1(clauses).alias("clauses_sha1"))


def html_file_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.with_file_links(_t(spark, sf_dir, "pages")).select("page_id", F.array_join("files", " ").alias("files"))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return incremental.windowed_counts(rows, "ts", "1 hour", "10 minutes", "event_type").select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "events")


_ALL = [
    norm_fold, legal_ids, title_flags, citation_keys, file_names, tokens_lookup, tokens_plan, tokens_search, doc_last_wins, dedupe_text_first, dedupe_two_key, dedupe_two_key_stream, normalized_documents, stage_counters,
    chunk_pack, article_split, bm25_topk, keyword_search_stored, bm25_phrases, dense_topk, hybrid_rrf, rerank_adjust, capped_select_variants, evidence_caps, result_assembly, variant_summary, context_blocks,
    answer_lookup, rule_plan, graph_nodes, graph_edges, relation_enrich, row_filters, resume_pending, url_extract, json_props, unique_keys, html_title_text, html_units, html_file_links, text_units, daily_events,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
