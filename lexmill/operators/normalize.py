"""Normalising raw documents and articles, and the dedupe rules between them.

Rows carry an ``ord`` column from ingest; "first" and "last" mean by ``ord``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as tx
from lexmill.plans.components import connected_components
from lexmill.plans.counters import Counters
from lexmill.plans.staging import materialize, rank_within

# Input names tried in order for each output field.
DOC_ALIASES = {"title": ["title", "ten_van_ban", "name"], "legal_id": ["legal_id", "so_ky_hieu", "code"], "url": ["url", "source_url"], "doc_type": ["doc_type", "loai_van_ban"], "status": ["status", "tinh_trang", "hieu_luc"], "doc_id": ["doc_id"], "source": ["source"]}
ARTICLE_ALIASES = {"title": ["title", "ten_van_ban", "doc_title"], "legal_id": ["legal_id", "so_ky_hieu"], "text": ["text", "content", "body"], "article_no": ["article_no", "dieu", "article"], "article_title": ["article_title", "ten_dieu", "heading"], "doc_type": ["doc_type"], "url": ["url"], "status": ["status"], "source": ["source"], "doc_id": ["doc_id"]}
DEFAULT_SOURCE = "vbpl"
WHOLE_TEXT = "toan_van"
#: Rounds of the two-key dedupe before what is open is scanned by components.
DEDUPE_ROUNDS = 4


def _field(df: DataFrame, aliases: list[str]) -> Column:
    there = [F.col(f"`{a}`") for a in aliases if a in df.columns]
    return tx.first_filled(*there) if there else F.lit("")


def normalize_documents(raw: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, legal_id, title, doc_type, url, status, source, ord; rows without a title go."""
    names = DOC_ALIASES | (aliases or {})
    get = {k: _field(raw, v) for k, v in names.items()}
    base = raw.select("ord", tx.norm_space(get["title"]).alias("title"), *[get[k].alias(f"_{k}") for k in ("legal_id", "url", "doc_type", "status", "doc_id", "source")]).where("title <> ''")
    base = base.withColumn("legal_id", tx.norm_space(tx.first_filled(F.col("_legal_id"), tx.legal_id(F.col("title")))))
    return base.select(
        tx.norm_space(tx.first_filled(F.col("_doc_id"), tx.doc_key(F.col("legal_id"), F.col("title")))).alias("doc_id"), "legal_id", "title",
        tx.norm_space(tx.first_filled(F.col("_doc_type"), tx.doc_type(F.col("title")))).alias("doc_type"),
        tx.norm_space(F.col("_url")).alias("url"), tx.norm_space(F.col("_status")).alias("status"), tx.norm_space(tx.first_filled(F.col("_source"), F.lit(DEFAULT_SOURCE))).alias("source"), "ord",
    )


def drop_expired(df: DataFrame, status: str = "status") -> DataFrame:
    return df.where(~tx.is_expired(F.col(status)))


def last_wins(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """The row of greatest ``order`` of each key; one pre-aggregated shuffle."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("_row")).select(key, "_row.*").select(*df.columns)


def first_wins(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """The row of smallest ``order`` of each key."""
    return df.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), order).alias("_row")).select(key, "_row.*").select(*df.columns)


def document_table(raw: DataFrame, skip_expired: bool = True, counters: Counters | None = None) -> DataFrame:
    """Normalised documents, expired ones dropped, last one of each id.

    ``counters`` gets rows_read, titled, live and documents from the pass that writes the table.
    """
    counters = counters or Counters()
    docs = normalize_documents(counters.at(raw, rows_read=F.count("*")))
    docs = counters.at(docs, titled=F.count("*"), live=F.count_if(~tx.is_expired(F.col("status"))))
    return counters.at(last_wins(drop_expired(docs) if skip_expired else docs, "doc_id"), documents=F.count("*"))


def normalize_articles(raw: DataFrame, documents: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Articles with fields filled from their document (left join on doc_id)."""
    names = ARTICLE_ALIASES | (aliases or {})
    get = {k: _field(raw, v) for k, v in names.items()}
    base = raw.select("ord", tx.norm_space(get["title"]).alias("title"), tx.norm_space(get["text"]).alias("text"), _field(raw, ["text"]).alias("_plain_text"), *[get[k].alias(f"_{k}") for k in ("legal_id", "article_no", "article_title", "doc_type", "url", "status", "source", "doc_id")])
    base = base.withColumn("legal_id", tx.norm_space(tx.first_filled(F.col("_legal_id"), tx.legal_id(F.col("title")), tx.legal_id(F.col("_plain_text")))))
    base = base.withColumn("doc_id", tx.norm_space(tx.first_filled(F.col("_doc_id"), tx.doc_key(F.col("legal_id"), F.col("title")))))
    known = documents.select("doc_id", *[F.col(c).alias(f"d_{c}") for c in ("title", "legal_id", "doc_type", "url", "status", "source")])
    joined = base.join(known, "doc_id", "left").withColumn("title", tx.first_filled(F.col("title"), F.col("d_title"))).where("title <> '' and text <> ''")
    number = tx.first_filled(tx.norm_space(F.col("_article_no")), F.regexp_extract("text", r"(?iU)Điều\s+([0-9]+[a-zA-Z]?|toan_van)\.?", 1), F.lit(WHOLE_TEXT))
    joined = joined.withColumn("article_no", number)
    heading = F.regexp_extract("text", r"(?iU)Điều\s+[0-9]+[a-zA-Z]?\.\s*([^\n]{0,160})", 1)
    has_heading = F.col("text").rlike(r"(?iU)Điều\s+[0-9]+[a-zA-Z]?\.\s*")
    title = tx.first_filled(tx.norm_space(F.col("_article_title")), F.when(has_heading, F.concat(F.lit("\0"), tx.norm_space(heading))).otherwise(tx.article_label(F.col("article_no"))))
    filled = lambda name, last: tx.norm_space(tx.first_filled(F.col(f"_{name}"), F.col(f"d_{name}"), last))
    return joined.select(
        "doc_id", tx.first_filled(F.col("legal_id"), F.col("d_legal_id")).alias("legal_id"), "title", filled("doc_type", tx.doc_type(F.col("title"))).alias("doc_type"), filled("url", F.lit("")).alias("url"), filled("status", F.lit("")).alias("status"), filled("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        "article_no", tx.article_label(F.col("article_no")).alias("article_label"), F.replace(title, F.lit("\0"), F.lit("")).alias("article_title"), "text", "ord",
    )


def _scan(key: str, other: str, order: str):
    """One group of rows (order, key, other) -> the orders that a scan keeps."""

    def scan(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        seen: tuple[set, set] = (set(), set())
        kept = []
        for place, first, second in zip(rows[order].to_pylist(), rows[key].to_pylist(), rows[other].to_pylist(), strict=True):
            if first not in seen[0] and second not in seen[1]:
                seen[0].add(first)
                seen[1].add(second)
                kept.append(place)
        return pa.table({order: pa.array(kept, rows[order].type)})

    return scan


def two_key_dedupe(df: DataFrame, key: str, other: str, order: str = "ord", rounds: int = DEDUPE_ROUNDS) -> DataFrame:
    """Rows kept by scanning in order (a unique long) and dropping a row of which either key was kept before.

    The scan is done in rounds.  In each round the rows that are first under
    both of their keys are kept, and all rows that share a key with them are
    settled.  A round is two pre-aggregated minima and anti-joins; typical data
    need a few.  What is open after ``rounds`` of them (long chains of keys) is
    divided into components that share no key, and each is scanned by itself.
    """
    open_rows = materialize(df.groupBy(key, other).agg(F.min(order).alias(order)))  # repeats of a pair fall with its first
    kept = None
    for _ in range(rounds):
        by_key = open_rows.groupBy(key).agg(F.min(order).alias("_k"))
        by_other = open_rows.groupBy(other).agg(F.min(order).alias("_o"))
        ahead = materialize(open_rows.join(by_key, key).join(by_other, other).where(f"{order} = _k and {order} = _o").select(key, other, order))
        kept = ahead.select(order) if kept is None else kept.unionByName(ahead.select(order))
        open_rows = materialize(open_rows.join(ahead.select(key), key, "left_anti").join(ahead.select(other), other, "left_anti").select(key, other, order))
        if open_rows.isEmpty():
            return df.join(kept, order, "left_semi")
    ties = [open_rows.join(open_rows.groupBy(k).agg(F.min(order).alias("b")), k).select(F.col(order).alias("a"), "b") for k in (key, other)]
    parts = connected_components(ties[0].unionByName(ties[1])).withColumnRenamed("node", order)
    placed = open_rows.join(parts, order, "left").withColumn("component", F.coalesce("component", order))
    scanned = materialize(placed.select("component", order, key, other).groupBy("component").applyInArrow(_scan(key, other, order), T.StructType([df.schema[order]])))
    return df.join(scanned if kept is None else kept.unionByName(scanned), order, "left_semi")


def article_table(raw: DataFrame, documents: DataFrame, skip_expired: bool = True, counters: Counters | None = None) -> DataFrame:
    """Normalised articles, deduped by citation key or text hash, first wins.

    ``counters`` gets articles_read, live_articles and articles; what is skipped as repeated is the difference of the last two.
    """
    counters = counters or Counters()
    rows = normalize_articles(counters.at(raw, articles_read=F.count("*")), documents)
    rows = counters.at(drop_expired(rows) if skip_expired else rows, live_articles=F.count("*"))
    rows = materialize(rows.withColumn("_key", tx.article_key(F.col("legal_id"), F.col("title"), F.col("article_no"))).withColumn("_hash", tx.sha1_text(F.col("text"))))
    return counters.at(two_key_dedupe(rows, "_key", "_hash").drop("_key", "_hash"), articles=F.count("*"))


def _number(base: str, order: str):
    """One group of rows (order, base) -> order and a key that no earlier row has."""

    def number(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        taken: set[str] = set()
        following: dict[str, int] = {}  # numbers below are taken for a base
        keys = []
        for name in rows[base].to_pylist():
            key, n = name, following.get(name, 2)
            while key in taken:
                key, n = f"{name}_{n}", n + 1
            following[name] = n
            taken.add(key)
            keys.append(key)
        return pa.table({order: rows[order], "_key": pa.array(keys, pa.string())})

    return number


def suffix_keys(df: DataFrame, base: str, order: str = "ord", name: str = "key") -> DataFrame:
    """Unique keys in the order of a unique column: a base, or else the base with the least ``_n`` from 2 on that is free.

    Only bases that are equal without trailing numbers can meet.  Where all rows
    of such a family have the same base the number is the place, ranked by ranges, so a
    base of most rows is many tasks; mixed families are scanned one by one.
    """
    family = F.regexp_replace(F.col(base), r"(_[0-9]+)+$", "")
    rows = rank_within(df.withColumn("_family", family), base, order, "_n")
    sizes = rows.groupBy("_family").agg((F.min(base) != F.max(base)).alias("_mixed")).where("_mixed").select("_family")
    rows = rows.join(sizes.withColumn("_mixed", F.lit(True)), "_family", "left")
    scanned = rows.where("_mixed").select("_family", order, base).groupBy("_family").applyInArrow(_number(base, order), T.StructType([df.schema[order], T.StructField("_key", T.StringType())]))
    numbered = rows.withColumn("_plain", F.when(F.col("_n") == 1, F.col(base)).otherwise(F.concat_ws("_", F.col(base), F.col("_n"))))
    return numbered.join(scanned, order, "left").select(*df.columns, F.when(F.col("_mixed"), F.col("_key")).otherwise(F.col("_plain")).alias(name))
