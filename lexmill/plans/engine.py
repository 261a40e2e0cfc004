"""Stages of the retrieval pipeline as tables, and the serving calls on stored results."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as tx
from lexmill.operators import bm25, chunk, dense, fusion, graph, index, lookup, normalize, select
from lexmill.sources import fetch, readers, sinks

from .counters import Counters

LONGEST_QUESTION, MOST_RESULTS, MOST_QUESTIONS = 2500, 20, 100
STAGES = ["normalize", "chunk", "keyword_index", "dense_index", "expand", "retrieve", "rerank", "answer", "results"]
INDEX_COLUMNS = ["title_fts", "legal_fts", "article_fts", "body_fts"]
RAW_DOCUMENT = "doc_id string, title string, ten_van_ban string, name string, legal_id string, so_ky_hieu string, code string, url string, source_url string, doc_type string, loai_van_ban string, status string, tinh_trang string, hieu_luc string, source string"
RAW_ARTICLE = "doc_id string, title string, ten_van_ban string, doc_title string, legal_id string, so_ky_hieu string, text string, content string, body string, article_no string, dieu string, article string, article_title string, ten_dieu string, heading string, doc_type string, url string, status string, source string"


class Generator(Protocol):
    """A text model: one answer per prompt."""

    def generate(self, prompts: list[str]) -> list[str]: ...


@dataclass
class Models:
    """What the stages with models use; the instructions are the caller's."""

    encoder: dense.Encoder | None = None
    generator: Generator | None = None
    scorer: Callable[[Column, Column], Column] | None = None
    expand_instructions: str = ""
    answer_instructions: str = ""


@dataclass
class EngineConfig:
    """Paths and sizes; every field can be set by LEXMILL_<FIELD> in the environment."""

    base: str = "data"
    out: str = "data/out"
    questions: str = "data/questions.json"
    results: str = "data/results.json"
    raw_dirs: list[str] = field(default_factory=lambda: ["raw"])
    skip_expired: bool = True
    chunk_target: int = chunk.TARGET_CHARS
    chunk_longest: int = chunk.MAX_CHARS
    bm25_top: int = bm25.TOP
    dense_top: int = dense.TOP
    fused_top: int = fusion.TOP
    rrf_k: int = fusion.RRF_K
    index_parts: int = 64
    allow_fetch: bool = False

    @classmethod
    def from_environment(cls) -> EngineConfig:
        given = {}
        for f in fields(cls):
            if (value := os.environ.get(f"LEXMILL_{f.name.upper()}")) is not None:
                default = f.default if f.default_factory.__class__.__name__ == "_MISSING_TYPE" else f.default_factory()
                given[f.name] = value.split(",") if isinstance(default, list) else value.lower() in ("1", "true", "yes", "on") if isinstance(default, bool) else int(value) if isinstance(default, int) else value
        return cls(**given)


def clean_question(question: str | None, longest: int = LONGEST_QUESTION) -> str:
    """White space collapsed; empty and overlong questions are refused."""
    text = " ".join((question or "").split())
    if not text:
        raise ValueError("question must not be empty")
    if len(text) > longest:
        raise ValueError(f"question is longer than {longest} characters")
    return text


def require_enabled(enabled: bool, feature: str) -> None:
    """Refuse a feature that the configuration leaves off."""
    if not enabled:
        raise PermissionError(f"{feature} is switched off in the configuration")


def generate(df: DataFrame, model: Generator, prompt: str = "prompt", out: str = "raw") -> DataFrame:
    """Add a model's answer to each prompt, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = model.generate(batch.column(prompt).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, pa.string())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def index_rows(chunks: DataFrame) -> DataFrame:
    """The four searched columns of each chunk."""
    label = F.concat_ws(" ", tx.text_or_empty(F.col("article_label")), tx.text_or_empty(F.col("article_title")))
    return chunks.withColumns({"title_fts": tx.text_or_empty(F.col("title")), "legal_fts": tx.text_or_empty(F.col("legal_id")), "article_fts": label, "body_fts": tx.text_or_empty(F.col("text"))})


def query_texts(questions: DataFrame, plans: DataFrame) -> DataFrame:
    """(qid, question, text): question, expansion and hypothetical answer; an id's last plan counts."""
    last = plans.groupBy("qid").agg(F.max_by(F.struct("query_expansion", "hyde_answer"), "ord").alias("p"))
    joined = questions.join(last, "qid", "left")
    return joined.select("qid", "question", tx.norm_space(F.concat_ws("\n", "question", F.coalesce("p.query_expansion", F.lit("")), F.coalesce("p.hyde_answer", F.lit("")))).alias("text"))


def parse_plans(raw: DataFrame) -> DataFrame:
    """Model output (qid, raw, ord) -> query_expansion, hyde_answer; unreadable output is kept as the answer."""
    parsed = F.from_json(tx.json_object_text(F.col("raw")), "query_expansion string, hyde_answer string")
    rows = raw.withColumn("_p", parsed)
    return rows.select("qid", F.coalesce("_p.query_expansion", F.lit("")).alias("query_expansion"), tx.first_filled(F.col("_p.hyde_answer"), F.substring(tx.norm_space(F.col("raw")), 1, 800)).alias("hyde_answer"), "ord")


def answer_prompt(question: Column, context: Column, instructions: str) -> Column:
    """Prompt for an answer with the labels it rests on: the caller's instructions, the question, the labelled context."""
    return F.concat(F.lit(instructions.rstrip() + "\n\n"), tx.text_or_empty(question), F.lit("\n\n"), tx.text_or_empty(context))


def retrieve(chunks: DataFrame, questions: DataFrame, plans: DataFrame, config: EngineConfig, vectors: DataFrame | None = None, query_vectors: DataFrame | None = None, index_path: str | None = None) -> DataFrame:
    """Fused candidates per question: keyword list, from a stored index if there is one, and the dense list where vectors are given."""
    rows = fusion.with_citations(index_rows(chunks))
    queries = query_texts(questions, plans)
    listed = index.search(chunks.sparkSession, index_path, queries, config.bm25_top) if index_path else bm25.bm25_search(rows, queries, INDEX_COLUMNS, config.bm25_top)
    keyword = listed.select("qid", "rowid", "score", "rank", F.lit(0).alias("list_no"), F.lit("bm25").alias("source_name"))
    lists = keyword
    if vectors is not None and query_vectors is not None:
        near = dense.dense_search(vectors, query_vectors, config.dense_top)
        lists = lists.unionByName(near.select("qid", F.col("vec_id").alias("rowid"), "score", "rank", F.lit(1).alias("list_no"), F.lit("dense").alias("source_name")))
    shown = rows.select("rowid", "chunk_id", "citation", "doc", "title", "legal_id", "doc_type", "article_no", "article_label", "article_title", "url", "text")
    ranked = lists.join(shown, "rowid").withColumn("weight", F.lit(1.0))
    return fusion.hybrid(fusion.rrf(ranked, config.rrf_k), questions, config.fused_top)


class Engine:
    """Runs stages between Parquet tables and answers questions from stored results."""

    def __init__(self, spark: SparkSession, config: EngineConfig | None = None) -> None:
        self.spark, self.settings = spark, config or EngineConfig()
        self._rows: DataFrame | None = None
        self.counted: dict[str, dict[str, int]] = {}

    def path(self, name: str) -> str:
        return f"{self.settings.out}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _stage(self, name: str, make: Callable[[Counters], DataFrame]) -> DataFrame:
        """Skip a stage whose table is complete; what it counts while it writes is in ``counted``."""
        if not readers.path_exists(self.spark, f"{self.path(name)}/_SUCCESS"):
            counters = Counters()
            make(counters).write.mode("overwrite").parquet(self.path(name))
            self.counted[name] = counters.values()
        return self.table(name)

    def normalize(self) -> tuple[DataFrame, DataFrame]:
        c = self.settings
        docs = self._stage("documents", lambda n: normalize.document_table(readers.read_raw_dirs(self.spark, c.base, c.raw_dirs, RAW_DOCUMENT), c.skip_expired, n))
        arts = self._stage("articles", lambda n: normalize.article_table(readers.read_raw_dirs(self.spark, c.base, c.raw_dirs, RAW_ARTICLE, articles=True), docs, c.skip_expired, n))
        return docs, arts

    def chunks(self) -> DataFrame:
        c = self.settings
        return self._stage("chunks", lambda n: chunk.chunk_articles(self.table("articles"), c.chunk_target, c.chunk_longest, counters=n).withColumn("rowid", F.xxhash64("ord", "idx")))

    def keyword_index(self) -> None:
        """Index the chunks that the index does not hold yet."""
        batch = int(self.spark.read.parquet(f"{self.path('index')}/lengths").agg(F.max("batch")).first()[0] or 0) + 1 if self.has("index/lengths/_SUCCESS") else 0
        index.add_rows(index_rows(self.table("chunks")), self.path("index"), batch, INDEX_COLUMNS, buckets=self.settings.index_parts)

    def has(self, name: str) -> bool:
        return readers.path_exists(self.spark, self.path(name))

    def questions(self) -> DataFrame:
        return readers.read_questions(self.spark, self.settings.questions)

    def plans(self) -> DataFrame:
        """Expansions of the questions; none without the expand stage."""
        return self.table("plans") if self.has("plans/_SUCCESS") else self.spark.createDataFrame([], "qid long, query_expansion string, hyde_answer string, ord long")

    def evidence(self) -> DataFrame:
        return self.table("evidence") if self.has("evidence/_SUCCESS") else self.spark.createDataFrame([], "qid long, answer string, used_articles array<string>")

    def _retrieve(self, plans: DataFrame, models: Models) -> DataFrame:
        questions, vectors, asked = self.questions(), None, None
        if self.has("vectors/_SUCCESS"):
            if models.encoder is None:
                raise ValueError("retrieve needs an encoder, as there are vectors")
            vectors = self.table("vectors")
            asked = dense.embed(query_texts(questions, plans).select("qid", "text"), models.encoder, "text")
        where = self.path("index") if self.has("index/settings/_SUCCESS") else None
        return retrieve(self.table("chunks"), questions, plans, self.settings, vectors, asked, where)

    def _answer(self, models: Models) -> DataFrame:
        ranked = self.table("reranked").withColumn("pos", F.col("final_rank"))
        items = select.context_items(ranked)
        asked = self.questions().join(select.context_texts(items), "qid", "left")
        prompts = asked.select("qid", "question", answer_prompt(F.col("question"), F.col("context"), models.answer_instructions).alias("prompt"))
        return select.read_evidence(generate(prompts, models.generator).drop("prompt"), items)

    def run(self, stages: list[str], *, models: Models | None = None, plans: DataFrame | None = None, evidence: DataFrame | None = None) -> dict[str, float]:
        """Run the named stages in order; returns seconds by stage.  A stage without the model it needs raises."""
        models, took = models or Models(), {}
        for stage, model in (("dense_index", models.encoder), ("expand", models.generator), ("answer", models.generator)):
            if stage in stages and model is None:
                raise ValueError(f"{stage} needs a model")
        prompt = lambda: tx.hyde_prompt(F.col("question"), models.expand_instructions).alias("prompt")
        ranked = lambda: self.table("reranked").withColumn("pos", F.col("final_rank"))
        whole = fusion.dense_text(F.col("title"), F.col("article_label"), F.col("article_title"), F.col("text"))
        work: dict[str, Callable[[], object]] = {
            "normalize": self.normalize,
            "chunk": self.chunks,
            "keyword_index": self.keyword_index,
            "dense_index": lambda: self._stage("vectors", lambda _: dense.embed(self.table("chunks").select(F.col("rowid").alias("vec_id"), whole.alias("text")), models.encoder, "text").drop("text")),
            "expand": lambda: self._stage("plans", lambda _: parse_plans(generate(self.questions().select("qid", prompt(), F.lit(0).cast("long").alias("ord")), models.generator).drop("prompt"))),
            "retrieve": lambda: self._stage("candidates", lambda _: self._retrieve(plans if plans is not None else self.plans(), models)),
            "rerank": lambda: self._stage("reranked", lambda _: fusion.rerank(self.table("candidates"), *([models.scorer] if models.scorer else []))),
            "answer": lambda: self._stage("evidence", lambda _: self._answer(models)),
            "results": lambda: sinks.write_variants(select.assemble(self.questions(), evidence if evidence is not None else self.evidence(), ranked(), select.variants(self.spark)), self.path("results")),
        }
        for name in [s for s in STAGES if s in stages]:
            began = time.time()
            work[name]()
            took[name] = time.time() - began
        return took

    def graph(self) -> tuple[DataFrame, DataFrame]:
        chunks = self.table("chunks")
        return graph.article_nodes(chunks), graph.mention_edges(chunks)

    def health(self) -> dict[str, object]:
        found: dict[str, object] = {}
        for f in ("questions", "results", "out"):
            path = getattr(self.settings, f)
            found |= {f"{f}_path": path, f"{f}_exists": readers.path_exists(self.spark, path)}
        return found

    def config(self) -> dict[str, object]:
        return {"name": "lexmill", "stages": STAGES} | vars(self.settings)

    def rows(self, force: bool = False) -> DataFrame:
        """Stored results with their tokens, cached between calls."""
        if self._rows is None or force:
            self._rows = lookup.prepare_rows(readers.read_results(self.spark, self.settings.results)).cache()
        return self._rows

    def fetch(self, rows: DataFrame, **options) -> DataFrame:
        """First page that answers for each row's ``urls``, where fetching is allowed."""
        require_enabled(self.settings.allow_fetch, "fetch")
        return fetch.fetch_first_ok(rows, **options)

    def answer(self, question: str, top_k: int = 5) -> dict[str, object]:
        return self.batch_answer([question], top_k)[0]

    def batch_answer(self, questions: list[str], top_k: int = 5) -> list[dict[str, object]]:
        """Best stored answer for each question, in order, with the time it took."""
        if not 1 <= len(questions) <= MOST_QUESTIONS or not 1 <= top_k <= MOST_RESULTS:
            raise ValueError(f"1 to {MOST_QUESTIONS} questions and 1 to {MOST_RESULTS} results")
        began = time.time()
        asked = self.spark.createDataFrame([(i, clean_question(q)) for i, q in enumerate(questions)], "qid long, question string")
        found = {r["qid"]: r.asDict(recursive=True) for r in lookup.answers(self.rows(), asked, top_k).collect()}
        spent = round((time.time() - began) * 1000, 2)
        return [{k: v for k, v in found[i].items() if k != "qid"} | {"elapsed_ms": spent} for i in range(len(questions))]
