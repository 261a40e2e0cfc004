"""Keyword index and BM25 search with phrase terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.tokens import index_tokens, search_terms
from lexmill.plans.staging import materialize, partitions, small_or_shuffled

# Fixed values of the ranking function.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
TOP = 80
#: Partitions of the matches for each shuffle partition: a match is small, but meets every query that asks its phrase.
ROW_PARTS = 4


def token_rows(rows: DataFrame, columns: list[str], row_id: str = "rowid") -> DataFrame:
    """(rowid, col, tokens), one row per column of each row."""
    each = F.array(*[F.struct(F.lit(i).alias("col"), index_tokens(F.col(c)).alias("tokens")) for i, c in enumerate(columns)])
    return rows.select(F.col(row_id).alias("rowid"), F.explode(each).alias("c")).select("rowid", "c.col", "c.tokens")


def token_rows_with_lengths(rows: DataFrame, columns: list[str], row_id: str = "rowid") -> DataFrame:
    """``token_rows`` with dl, the tokens over all columns of the row; every column is split once."""
    each = F.array(*[F.struct(F.lit(i).alias("col"), index_tokens(F.col(c)).alias("tokens")) for i, c in enumerate(columns)])
    split = rows.select(F.col(row_id).alias("rowid"), each.alias("cs"))
    length = F.aggregate("cs", F.lit(0), lambda n, c: n + F.size(c["tokens"]))
    return split.select("rowid", length.alias("dl"), F.explode("cs").alias("c")).select("rowid", "dl", "c.col", "c.tokens")


def build_postings(rows: DataFrame, columns: list[str], row_id: str = "rowid") -> DataFrame:
    """(rowid, col, pos, token), one row per token of each column."""
    return token_rows(rows, columns, row_id).select("rowid", "col", F.posexplode("tokens").alias("pos", "token"))


def build_lengths(rows: DataFrame, columns: list[str], row_id: str = "rowid") -> DataFrame:
    """(rowid, dl): tokens over all columns, also for rows without any."""
    return rows.select(F.col(row_id).alias("rowid"), sum((F.size(index_tokens(F.col(c))) for c in columns), F.lit(0)).alias("dl"))


def query_phrases(queries: DataFrame, query_id: str = "qid", text: str = "text", limit: int = 32) -> DataFrame:
    """(qid, term_no, phrase): each search term as the index tokens it stands for."""
    terms = queries.select(F.col(query_id).alias("qid"), F.posexplode(search_terms(F.col(text), limit)).alias("term_no", "term"))
    return terms.select("qid", "term_no", index_tokens(F.col("term")).alias("phrase")).where("size(phrase) > 0")


def _grams(size: int) -> Column:
    """Every run of so many adjacent tokens, joined by blanks."""
    if size == 1:
        return F.col("tokens")
    runs = F.transform(F.sequence(F.lit(1), F.size("tokens") - (size - 1)), lambda i: F.array_join(F.slice("tokens", i, size), " "))
    return F.when(F.size("tokens") >= size, runs).otherwise(F.array().cast("array<string>"))


def phrase_matches(tokens: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, rowid, f): how often each distinct phrase occurs, tokens in order in one column; and dl, where ``tokens`` have it.

    The result lies by rowid, so what goes on by row is not shuffled again.

    Runs of tokens are formed inside their row, for the lengths that are asked, and
    meet the phrases whole: a common token in many phrases makes no hits by itself.
    """
    wanted = phrases.select(F.array_join("phrase", " ").alias("key"), F.size("phrase").alias("n")).distinct()
    asked = wanted.groupBy("n").agg(F.count("*").alias("keys")).collect()  # a row for each length of a phrase
    lengths = sorted(r["n"] for r in asked) or [1]
    kept = ["rowid", *(c for c in ("dl",) if c in tokens.columns)]
    hits = tokens.select(*kept, F.explode(F.concat(*[_grams(n) for n in lengths])).alias("key"))
    hits = hits.join(small_or_shuffled(wanted.select("key"), sum(r["keys"] for r in asked)), "key", "left_semi").repartition(ROW_PARTS * partitions(tokens.sparkSession), "rowid")
    return hits.groupBy("key", "rowid").agg(F.count("*").alias("f"), *(F.first(c).alias(c) for c in kept[1:]))


def bm25_scores(matches: DataFrame, lengths: DataFrame, phrases: DataFrame) -> DataFrame:
    """(qid, rowid, score) of matches with dl: every OR-ed term of a query counts by itself.

    The terms of the queries, when they are few, go to the matches where they lie, by
    row: no task holds all rows of a frequent token, and the pairs of a query and a row are
    added up without a shuffle.
    """
    totals = lengths.agg(F.count("*").alias("rows"), F.avg("dl").alias("avgdl"))
    # reads what the scores read, so both share one shuffle of the matches
    held = matches.groupBy("key").agg(F.count_if((F.col("f") > 0) & (F.col("dl") > 0)).alias("n"))
    # repeats of a phrase in a query weigh as often as they occur
    asked = materialize(phrases.groupBy("qid", F.array_join("phrase", " ").alias("key")).agg(F.count("*").alias("times")))
    idf = F.ln((F.col("rows") - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weighted = held.crossJoin(F.broadcast(totals)).select("key", F.when(idf > 0, idf).otherwise(LEAST_IDF).alias("idf"), "avgdl").join(asked, "key")
    part = F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    per_row = matches.join(small_or_shuffled(weighted, asked.count()), "key")
    return per_row.groupBy("qid", "rowid").agg(F.sum(part * F.col("times")).alias("score"))


def top_k(scores: DataFrame, k: int, by: list[Column], group: str = "qid", rank: str = "rank") -> DataFrame:
    """The k first rows of each group with their rank; Spark prunes before the shuffle."""
    return scores.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*by))).where(F.col(rank) <= k)


def bm25_search(rows: DataFrame, queries: DataFrame, columns: list[str], k: int = TOP, digits: int = 9) -> DataFrame:
    """(qid, rowid, score, rank); scores are rounded before ranking, ties go to the smaller rowid."""
    phrases = query_phrases(queries)
    matches = phrase_matches(token_rows_with_lengths(rows, columns), phrases)
    scores = bm25_scores(matches, build_lengths(rows, columns), phrases).withColumn("score", F.round("score", digits))
    return top_k(scores, k, [F.desc("score"), F.asc("rowid")])
