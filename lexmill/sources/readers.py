"""Readers of JSON lines, wrapped JSON, sheets, DOCX files, results and model output.

Readers that "first wins" rules depend on add ``ord``: file order, then line.
"""

from __future__ import annotations

import html as html_lib
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as tx
from lexmill.plans.staging import materialize, rank_within

# Names and headers looked for.
DOCUMENT_FILES = ["documents.jsonl", "documents (1).jsonl", "documents (2).jsonl"]
ARTICLE_FILES = ["articles.jsonl", "articles.json", "articles (1).jsonl", "articles (2).jsonl"]
ID_HEADERS = ["id", "doc_id", "uuid", "itemid", "item_id"]
HEADER_PARTS = [("so ky hieu", "so_ky_hieu"), ("so hieu", "so_ky_hieu"), ("ten van ban", "ten_van_ban"), ("trich yeu", "ten_van_ban"), ("loai van ban", "loai_van_ban")]
SHEET_COLUMNS = ["so_ky_hieu", "ten_van_ban", "loai_van_ban", "url"]
ENCODINGS = ["utf-8-sig", "utf-8", "cp1258", "utf-16"]
WORD_NAMESPACE = {"w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main"}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    found = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(name)
    return found is not None and len(found) > 0


def artifact_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, path, there, mb) of named files."""
    jvm = spark.sparkContext._jvm
    rows = []
    for name, path in paths.items():
        at = jvm.org.apache.hadoop.fs.Path(path)
        system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        there = system.exists(at)
        rows.append((name, path, there, system.getContentSummary(at).getLength() / 1048576 if there else None))
    return spark.createDataFrame(rows, "name string, path string, there boolean, mb double")


def require_artifacts(spark: SparkSession, required: dict[str, str], optional: dict[str, str] | None = None) -> DataFrame:
    """Sizes of all; raises when a required one is missing."""
    found = artifact_sizes(spark, required | (optional or {}))
    missing = [r["name"] for r in found.where("not there").collect() if r["name"] in required]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    return found


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, *, strict: bool = False, need_brace: bool = True, file_no: int = 0) -> DataFrame:
    """One row per JSON object line with ``ord``; missing paths give no rows.

    Blank lines are skipped.  Without ``strict`` so are lines that do not start
    with ``{`` (unless ``need_brace`` is off) and bad JSON; with it they raise.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    there = [p for p in ([paths] if isinstance(paths, str) else paths) if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("ord", T.LongType())]))
    files = [spark.read.text(p).select(F.btrim(F.regexp_replace("value", "^\\s*﻿+", "")).alias("line"), (F.lit((file_no + i) << 50) + F.monotonically_increasing_id() % (1 << 50)).alias("ord")) for i, p in enumerate(there)]
    lines = files[0]
    for more in files[1:]:
        lines = lines.unionByName(more)
    lines = lines.where("line <> ''")
    if not strict and need_brace:
        lines = lines.where(F.startswith("line", F.lit("{")))
    if strict:
        return lines.select(F.from_json("line", kind, {"mode": "FAILFAST"}).alias("_j"), "ord").select("_j.*", "ord")
    checked = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select(F.from_json("line", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("_j"), "ord")
    return parsed.where("_j._bad is null").select("_j.*", "ord").drop("_bad")


def read_raw_dirs(spark: SparkSession, base: str, dirs: list[str], schema: str, *, articles: bool = False) -> DataFrame:
    """Rows of the known file names under the listed folders, in listed order."""
    names = ARTICLE_FILES if articles else DOCUMENT_FILES
    out = None
    for i, path in enumerate(f"{base}/{d}/{n}" for d in dirs for n in names):
        if not path_exists(spark, path):
            continue
        rows = read_wrapped_json(spark, path, schema, ["data", "articles"], file_no=i) if path.endswith(".json") else read_jsonl(spark, path, schema, file_no=i)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out if out is not None else read_jsonl(spark, [], schema)


def read_wrapped_json(spark: SparkSession, path: str, schema: str, keys: list[str], *, file_no: int = 0) -> DataFrame:
    """Items of a JSON list, or of the first non-empty list under one of ``keys``."""
    item = T.ArrayType(T.StructType.fromDDL(schema))
    whole = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", T.StructType([T.StructField(k, item) for k in keys]))
    filled = [F.when(F.size(wrapped[k]) > 0, wrapped[k]) for k in keys]
    items = F.when(F.ltrim(F.col("value")).startswith("["), F.from_json("value", item)).otherwise(F.coalesce(*filled))
    return whole.select(F.posexplode(items).alias("pos", "_i")).select("_i.*", (F.lit(file_no << 50) + F.col("pos")).alias("ord"))


def read_questions(spark: SparkSession, path: str, *, need_id: bool = False) -> DataFrame:
    """(qid, question): id defaults to the 1-based position; with ``need_id`` rows lacking id or text go."""
    schema = "id bigint, question_id bigint, qid bigint, question string, query string, text string"
    rows = read_wrapped_json(spark, path, schema, ["questions"] if need_id else ["data", "questions", "rows"])
    text = tx.norm_space(tx.first_filled(F.col("question"), F.col("query"), F.col("text")))
    if need_id:
        return rows.select(F.coalesce("id", "question_id", "qid").alias("qid"), text.alias("question")).where("qid is not null and question <> ''")
    return rows.select(F.coalesce(F.col("id"), F.col("ord") + 1).alias("qid"), text.alias("question"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Stored result rows with normalised text; empty list items go."""
    schema = "id bigint, question string, answer string, relevant_docs array<string>, relevant_articles array<string>"
    rows = read_wrapped_json(spark, path, schema, ["data"])
    listed = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), tx.norm_space), lambda x: x != "")
    return rows.select(F.coalesce("id", F.lit(0)).alias("id"), tx.norm_space(F.col("question")).alias("question"), tx.norm_space(F.col("answer")).alias("answer"), listed(F.col("relevant_docs")).alias("relevant_docs"), listed(F.col("relevant_articles")).alias("relevant_articles"))


def _sheet_frames(name: str, content: bytes):
    """pandas frames of one file: a workbook by its magic bytes, else CSV in the first encoding that reads."""
    import pandas as pd

    if content[:2] == b"PK" or name.lower().endswith((".xlsx", ".xls")):
        return list(pd.read_excel(io.BytesIO(content), sheet_name=None).values())  # needs openpyxl
    for encoding in ENCODINGS:
        try:
            return [pd.read_csv(io.BytesIO(content), encoding=encoding)]
        except (UnicodeError, ValueError):
            continue
    raise ValueError(f"cannot read {name}")


def read_sheets(spark: SparkSession, path: str, *, every_sheet: bool = False, frames: Callable = _sheet_frames) -> DataFrame:
    """Rows of the sheets under a path as text columns, first of each id; lock files are skipped.

    Files are parsed where they are read, one at a time; the driver learns the names of
    the columns only.  A workbook's first sheet counts, or with ``every_sheet`` all.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!~]*").load(path).select("path", "content")
    files = files.where(F.lower("path").rlike(r"\.(csv|xlsx|xls)$"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = frames(name, content)
                for sheet, frame in enumerate(found if every_sheet else found[:1]):
                    names = [str(c) for c in frame.columns]
                    cells = [[None if v is None or v != v else str(v) for v in row] for row in frame.itertuples(index=False, name=None)]
                    size = len(cells)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * size), pa.array([sheet] * size, pa.int32()), pa.array(range(size), pa.int64()), pa.array([names] * size, pa.list_(pa.string())), pa.array(cells, pa.list_(pa.string()))], names=["path", "sheet", "row", "names", "cells"])

    rows = materialize(files.repartition("path").mapInArrow(parse, "path string, sheet int, row long, names array<string>, cells array<string>"))
    at = F.struct("path", "sheet", "pos").alias("at")
    named = rows.select("path", "sheet", F.posexplode("names").alias("pos", "name")).groupBy("name").agg(F.min(at).alias("at")).orderBy("at").collect()
    if not named:
        raise FileNotFoundError(path)
    names = [r["name"] for r in named]
    whole = rows.select(F.struct("path", "sheet", "row").alias("_at"), F.map_from_arrays("names", "cells").alias("_cells"))
    whole = whole.select("_at", *[F.element_at("_cells", F.lit(n)).alias(n) for n in names])
    key = next((n for n in names if n.strip().lower() == "id"), None)
    if key is not None:
        others = F.struct(*[F.col(f"`{n}`") for n in names])
        alone = F.when(F.col(f"`{key}`").isNull(), F.col("_at")).alias("_alone")  # rows without an id all stay
        whole = whole.groupBy(F.col(f"`{key}`").alias("_id"), alone).agg(F.min("_at").alias("_at"), F.min_by(others, "_at").alias("_row")).select("_at", "_row.*")
    ranked = rank_within(whole.withColumn("_all", F.lit(0)), "_all", "_at", "_place")
    return ranked.select(*[F.col(f"`{n}`") for n in names], (F.col("_place") - 1).alias("ord"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Known headers, in any spelling, become id, so_ky_hieu, ten_van_ban, loai_van_ban, url."""
    import unicodedata

    def plain(name: str) -> str:
        parts = unicodedata.normalize("NFD", name.strip().lower()).replace("đ", "d")
        return "".join(c for c in parts if unicodedata.category(c) != "Mn")

    names = {}
    for column in df.columns:
        low = column.strip().lower()
        target = "id" if low in ID_HEADERS else next((t for part, t in HEADER_PARTS if part in plain(column)), "url" if "url" in low else column)
        names[column] = target
    if "id" not in names.values():
        raise ValueError("no id column")
    out = df.select(*[F.col(f"`{c}`").alias(t) for c, t in names.items()])
    for column in SHEET_COLUMNS:
        if column not in out.columns:
            out = out.withColumn(column, F.lit(""))
    return out.withColumn("id", F.trim(F.col("id").cast("string")))


def url_list(df: DataFrame) -> DataFrame:
    """Distinct URLs of all cells, sorted."""
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    return df.select(F.explode(F.flatten(F.transform(cells, tx.urls_in))).alias("url")).distinct().orderBy("url")


def docx_lines(content: bytes) -> list[str]:
    """Non-empty paragraphs of a DOCX file."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        root = ElementTree.fromstring(archive.read("word/document.xml"))
    joined = ("".join(t.text for t in p.findall(".//w:t", WORD_NAMESPACE) if t.text) for p in root.findall(".//w:p", WORD_NAMESPACE))
    lines = (re.sub(r"\s+", " ", html_lib.unescape(text)).strip() for text in joined)
    return [line for line in lines if line]


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """(path, lines) of DOCX files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [docx_lines(c) for c in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(lines, pa.list_(pa.string()))], names=["path", "lines"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path)
    return files.select("path", "content").mapInArrow(run, "path string, lines array<string>")


def action_html(text: Column) -> Column:
    """HTML inside a streamed component answer; null without one."""
    return F.nullif(F.regexp_extract(text, r"(?s)\d+:T[0-9a-fA-F]+,(<html>.*?</html>)", 1), F.lit(""))


def action_json(text: Column) -> Column:
    """JSON text of line 1, else of the first numbered line but 0."""
    return F.nullif(tx.first_filled(F.regexp_extract(text, r"(?m)^1:(\[.*\]|\{.*\})$", 1), F.regexp_extract(text, r"(?m)^(?!0:)\d+:(\[.*\]|\{.*\})$", 1)), F.lit(""))


def action_blob(text: Column) -> Column:
    """Bytes of a base64 line that the metadata line refers to; null otherwise."""
    number, body = F.regexp_extract(text, r"(?m)^(\d+):T\d+,(.*)$", 1), F.regexp_extract(text, r"(?m)^(\d+):T\d+,(.*)$", 2)
    meta = F.get_json_object(F.regexp_extract(text, r"(?m)^\d+:(\{.*\})$", 1), "$.data")
    return F.when((number != "") & (meta == F.concat(F.lit("$"), number)), F.unbase64(body))
