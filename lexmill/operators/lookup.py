"""Answer lookup by token overlap with stored questions and answers."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as tx
from lexmill.functions.tokens import lookup_tokens
from lexmill.plans.staging import materialize

from .bm25 import top_k

QUERY_TOKENS, ROW_TOKENS, HEAD_CHARS, DIGITS = 80, 120, 300, 5
#: Rows and questions of a block, and blocks of either at least.
BLOCK, LEAST_BLOCKS = 32_768, 3
#: Words of a block that get a number for every row: those of one row in so many, at most as many words.
DENSE_SHARE, DENSE_WORDS = 32, 4000


def prepare_rows(results: DataFrame) -> DataFrame:
    """(id, question, answer, lists, exact, tokens); cache it when it serves many queries."""
    text = F.concat_ws(" ", "question", "answer", F.array_join("relevant_articles", " "))
    return results.select("id", "question", "answer", "relevant_docs", "relevant_articles", F.lower("question").alias("exact"), lookup_tokens(text, ROW_TOKENS).alias("tokens"))


def _least_of_equals(rows: DataFrame, by: str, k: int) -> DataFrame:
    """Of the rows equal in ``by`` those of the k least ids, as no others can be among k best."""
    return rows.withColumn("_i", F.row_number().over(Window.partitionBy(by).orderBy("id"))).where(F.col("_i") <= k).drop("_i")


def _overlaps_of_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(qid, id, shared, n) of the k rows of a block (id, words) that share most words with each question (qid, words)."""

    def best(rows: pa.Table, asked: pa.Table) -> pa.Table:
        # ties go to the least id: positions follow the ids, as Spark orders them
        rows = rows.take(pc.sort_indices(rows["id"], null_placement="at_start"))
        numbers: dict[str, int] = {}
        sets = [[numbers.setdefault(w, len(numbers)) for w in words.split(" ")] for words in rows["words"].to_pylist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        word = np.fromiter(chain.from_iterable(sets), np.int64, int(sizes.sum()))
        order = np.argsort(word, kind="stable")
        places = np.repeat(np.arange(len(sets)), sizes)[order]
        first = np.searchsorted(word[order], np.arange(len(numbers) + 1))
        held = np.diff(first)
        often = np.argsort(-held, kind="stable")[:DENSE_WORDS]
        maps = {}  # of a frequent word a number for every row, of the others their rows
        for w in often[held[often] * DENSE_SHARE >= len(sets)].tolist():
            maps[w] = np.zeros(len(sets), np.uint8)
            maps[w][places[first[w] : first[w + 1]]] = 1

        qids, ids, shared, sizes_of = [], [], [], []
        for at, words in enumerate(asked["words"].to_pylist()):
            own = words.split(" ")
            count = np.zeros(len(sets), np.uint8 if len(own) < 256 else np.int32)
            for w in own:
                if (number := numbers.get(w)) is None:
                    continue
                if number in maps:
                    count += maps[number]
                else:
                    count[places[first[number] : first[number + 1]]] += 1
            least = int(count.max(initial=0))
            while least > 1 and np.count_nonzero(count >= least) < k:
                least -= 1
            if least:
                found = np.flatnonzero(count >= least)
                found = found[np.argsort(-count[found].astype(np.int32), kind="stable")[:k]]
                qids.append(np.full(len(found), at))
                ids.append(found)
                shared.append(count[found].astype(np.int64))
                sizes_of.append(np.full(len(found), len(own)))
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"qid": asked["qid"].take(pa.array(whole(qids))), "id": rows["id"].take(pa.array(whole(ids))), "shared": whole(shared), "n": whole(sizes_of)})

    return best


def top_overlap(rows: DataFrame, asked: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(qid, id, score) of the k rows (id, exact, tokens) that share most tokens with each question (qid, exact, tokens).

    Rows and questions are dealt to blocks of about ``block`` members, and every block
    of rows meets every block of questions in a group of its own, which gives the k best
    of its rows for each question.  Only these are shuffled, never the pairs that share a
    token, and a group's memory is that of its two blocks.  Rows with equal tokens score
    alike, so the k of least id stand for all of them; likewise for rows with an
    equal question.  Rows that share nothing have no score.
    """
    asked = materialize(asked)
    same = _least_of_equals(rows.select("id", "exact"), "exact", k).join(asked.select("qid", "exact"), "exact").select("qid", "id", F.lit(1.0).alias("score"))
    words = F.array_join("tokens", " ").alias("words")  # no token holds a blank
    sets = materialize(_least_of_equals(rows.where("size(tokens) > 0").select("id", words), "words", k))
    questions = asked.where("size(tokens) > 0").select("qid", words)
    blocks, parts = (max(LEAST_BLOCKS, -(-side.count() // block)) for side in (sets, questions))
    dealt = lambda key, many: F.pmod(F.xxhash64(key), F.lit(many)).cast("int")
    each = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    left = sets.select(dealt("id", blocks).alias("block"), each(parts).alias("part"), "id", "words")
    right = questions.select(each(blocks).alias("block"), dealt("qid", parts).alias("part"), "qid", "words")
    kinds = {name: side.schema[name].dataType.simpleString() for side, name in ((asked, "qid"), (sets, "id"))}
    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    best = met.applyInArrow(_overlaps_of_block(k), f"qid {kinds['qid']}, id {kinds['id']}, shared long, n long")
    scored = best.select("qid", "id", (F.col("shared") / F.col("n")).alias("score"))
    merged = same.unionByName(scored).groupBy("qid", "id").agg(F.max("score").alias("score"))
    return materialize(top_k(merged, k, [F.desc("score"), F.asc("id")], rank="_rank")).select("qid", "id", "score")


def answer_candidates(rows: DataFrame, questions: DataFrame, k: int = 5) -> DataFrame:
    """The k best rows per question: qid, query, rank, id, score, question, answer_head.

    Where fewer than k rows share a token, rows of score 0 follow by id, as a
    full scan would give; they are taken from the k least ids of the table.
    """
    asked = questions.select("qid", tx.norm_space(F.col("question")).alias("query"))
    keyed = asked.select("qid", F.lower("query").alias("exact"), lookup_tokens(F.col("query"), QUERY_TOKENS).alias("tokens"))
    scored = top_overlap(rows, keyed, k)
    least = rows.select("id").orderBy("id").limit(k)  # at most k rows
    # of the k least ids as many are without score as places can be left
    fill = asked.select("qid").crossJoin(F.broadcast(least)).join(scored.select("qid", "id"), ["qid", "id"], "left_anti").withColumn("score", F.lit(0.0))
    top = top_k(scored.unionByName(fill), k, [F.desc("score"), F.asc("id")])
    shown = rows.select("id", "question", F.substring("answer", 1, HEAD_CHARS).alias("answer_head"))
    return top.join(asked, "qid").join(shown, "id").select("qid", "query", "rank", "id", F.round("score", DIGITS).alias("score"), "question", "answer_head")


def answers(rows: DataFrame, questions: DataFrame, k: int = 5) -> DataFrame:
    """Best match and candidates per question; no row when the table is empty gives a null match."""
    found = answer_candidates(rows, questions, k)
    best = found.where("rank = 1").select("qid", F.col("id").alias("matched_id"), "score")
    kept = rows.select(F.col("id").alias("matched_id"), "answer", "relevant_docs", "relevant_articles")
    lists = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score", "question", "answer_head"))).alias("candidates"))
    asked = questions.select("qid", tx.norm_space(F.col("question")).alias("query"))
    rows_out = asked.join(best, "qid", "left").join(kept, "matched_id", "left").join(lists, "qid", "left")
    none = F.array().cast("array<string>")
    return rows_out.select("qid", "query", "matched_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("relevant_docs", none).alias("relevant_docs"), F.coalesce("relevant_articles", none).alias("relevant_articles"), "candidates")
