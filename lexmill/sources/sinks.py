"""Writers: JSON lines, indexes, result variants, crawl exports and promoted files."""

from __future__ import annotations

import json
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as tx


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; null fields are kept."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents sorted by code and title."""
    documents.orderBy("legal_id", "title", "ord").drop("ord").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_vectors(vectors: DataFrame, path: str, vec_id: str = "vec_id") -> int:
    """Append vectors of ids that the table lacks; returns how many rows it has then."""
    from .readers import path_exists

    spark = vectors.sparkSession
    rows = vectors.join(spark.read.parquet(path).select(vec_id), vec_id, "left_anti") if path_exists(spark, path) else vectors
    rows.write.mode("append").parquet(path)
    return spark.read.parquet(path).count()


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small file through Spark's file system layer, by way of a temporary name."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    temporary = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(temporary, True)
    stream.write(bytearray(content))
    stream.close()
    if system.exists(target):
        system.delete(target, False)
    system.rename(temporary, target)


def write_report(spark: SparkSession, path: str, report: object) -> None:
    _put(spark, path, json.dumps(report, ensure_ascii=False, indent=2).encode())


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as tasks need it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(name).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def write_variants(results: DataFrame, folder: str) -> list[str]:
    """results.json and a zip of it for each variant; one row per question, as the output format wants.

    Spark makes the JSON of every row and deals the rows by variant and question; the
    task of a variant streams them into its two files under temporary names.
    """
    spark = results.sparkSession
    row = F.struct(F.col("qid").alias("id"), "question", "answer", "relevant_docs", "relevant_articles")
    lines = results.select("variant", "qid", F.to_json(row, {"ignoreNullFields": "false"}).alias("line"))
    target = _qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(target)
        current, close, put = None, None, None

        def start(name: str) -> tuple[Callable[[bytes], None], Callable[[], None]]:
            system.create_dir(f"{root}/{name}", recursive=True)
            mark = uuid.uuid4().hex
            names = {f"{root}/{name}/results.json-{mark}": f"{root}/{name}/results.json", f"{root}/{name}.zip-{mark}": f"{root}/{name}.zip"}
            plain, packed = (system.open_output_stream(n) for n in names)
            archive = zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED)
            entry = zipfile.ZipInfo("results.json")  # without the time, so a rerun gives the same file
            entry.compress_type = zipfile.ZIP_DEFLATED
            inner = archive.open(entry, "w", force_zip64=True)

            def write_both(data: bytes) -> None:
                plain.write(data)
                inner.write(data)

            def finish() -> None:
                write_both(b"\n]")
                for stream in (inner, archive, packed, plain):
                    stream.close()
                for old, new in names.items():
                    system.move(old, new)

            return write_both, finish

        for batch in batches:
            for name, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if name != current:
                    if close:
                        close()
                        yield pa.RecordBatch.from_pydict({"variant": [current]})
                    current, (put, close) = name, start(name)
                    put(b"[\n" + line.encode())
                else:
                    put(b",\n" + line.encode())
        if close:
            close()
            yield pa.RecordBatch.from_pydict({"variant": [current]})

    dealt = lines.repartition("variant").sortWithinPartitions("variant", "qid")
    return sorted(r["variant"] for r in dealt.mapInArrow(write, "variant string").collect())  # a row a variant


def export_document() -> Column:
    """Nested export struct of a crawled document (absent attributes are null)."""
    none = F.lit(None).cast("string")
    fill = lambda c: F.nullif(F.col(c), F.lit(""))
    names = F.transform("file_paths", lambda p: F.regexp_extract(p, r"[^/]*$", 0))
    first = lambda pattern: F.get(F.filter(names, lambda n: F.lower(n).rlike(pattern)), F.lit(0))
    suffix = lambda n: F.nullif(F.upper(F.regexp_extract(n, r"\.([^.]+)$", 1)), F.lit(""))
    attributes = F.struct(
        F.col("id"), fill("so_ky_hieu").alias("so_hieu"), fill("ten_van_ban").alias("ten_van_ban"), fill("loai_van_ban").alias("loai_van_ban"),
        *[none.alias(c) for c in ("loai_code", "ngay_ban_hanh", "hieu_luc_tu", "hieu_luc_den", "trang_thai_hieu_luc", "trang_thai_code", "co_quan_ban_hanh", "bo_nganh")],
        F.lit("vi").alias("ngon_ngu"), *[none.alias(c) for c in ("luot_xem", "ngay_cap_nhat", "trang_thai_xuat_ban", "is_luat", "is_cu")],
        (F.coalesce(F.length("content_html"), F.lit(0)) > 0).alias("has_content"), first(r"\.pdf$").alias("file_pdf"), first(r"\.docx?$").alias("file_doc"), F.col("source_url").alias("url_chi_tiet"), none.alias("url_pdf"), none.alias("url_doc"),
    )
    content = F.struct(F.col("id"), fill("ten_van_ban").alias("title"), F.col("content_html"), F.length("content_text").alias("content_length"))
    files = F.transform(names, lambda n, i: F.struct(n.alias("file_name"), suffix(n).alias("loai_file"), n.alias("file_title"), (i + 1).alias("file_order"), F.get("file_paths", i).alias("url")))
    return F.struct(F.col("id").alias("doc_id"), attributes.alias("thuoc_tinh"), content.alias("noi_dung"), F.col("luoc_do"), F.col("lich_su"), files.alias("files_dinh_kem"))


def export_chunk(code: Column, title: Column, level: Column, number: Column, heading: Column, text: Column) -> Column:
    """Non-empty parts of an exported unit, one per line."""
    part = lambda c: F.trim(tx.text_or_empty(c))
    label = F.array_join(F.filter(F.array(tx.first_filled(part(level), F.lit("article")), part(number), part(heading)), lambda x: x != ""), " ")
    return F.array_join(F.filter(F.array(part(code), part(title), label, part(text)), lambda x: x != ""), "\n")


def write_crawl(documents: DataFrame, articles: DataFrame, failed: DataFrame, folder: str) -> None:
    """documents and articles as JSON lines, failures as CSV."""
    keep = {"ignoreNullFields": "false"}
    documents.write.mode("overwrite").options(**keep).json(f"{folder}/documents")
    articles.write.mode("overwrite").options(**keep).json(f"{folder}/articles")
    failed.write.mode("overwrite").option("header", "true").csv(f"{folder}/failed")


def promote(spark: SparkSession, files: dict[str, tuple[str, str]], manifest: str, *, overwrite: bool = False, hashes: bool = False) -> DataFrame:
    """Copy name -> (source, target), skipping targets that exist, and write a manifest."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for name, (source, target) in files.items():
        a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
        from_system, to_system = a.getFileSystem(conf), b.getFileSystem(conf)
        if not from_system.exists(a):
            rows.append((name, source, target, "missing", None, None))
            continue
        copied = overwrite or not to_system.exists(b)
        if copied:
            jvm.org.apache.hadoop.fs.FileUtil.copy(from_system, a, to_system, b, False, overwrite, conf)
        digest = spark.read.format("binaryFile").load(target).select(F.sha2("content", 256)).first()[0] if hashes and to_system.getFileStatus(b).isFile() else None
        rows.append((name, source, target, "copied" if copied else "kept", to_system.getContentSummary(b).getLength(), digest))
    out = spark.createDataFrame(rows, "name string, source string, target string, state string, bytes long, sha256 string")
    write_report(spark, manifest, [r.asDict() for r in out.collect()])
    return out
