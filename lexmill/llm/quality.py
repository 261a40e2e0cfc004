"""Quality rules as a short-circuit cascade.

Main path: DataFrame functions only, one scan, no shuffle.  Rules stand in a
CASE chain, and what a rule needs is computed inside its branch, so a document
that one rule rejects costs nothing in the rules behind it.  Their order comes
from a bounded random sample that is drawn, judged and timed at once: every rule
stands between two readings of the clock, its rejections are counted, and rules
stand by rejections per second.  The order changes the cost, never the verdict.  ``filter_quality`` has all rules in the
chain; ``judge_quality`` reports the base figures of every document, so there
only what they leave is in the chain.

Words are runs of code points other than space and ``\\x09-\\x0D``.  Defined
cases: null and empty texts have no words and fail the base rule; a very long
text is judged whole, in one row; rows that repeat are judged alike and there is
nothing to tie; a rule without a value (no lines, no words) does not reject; an
empty table gives an empty result; other columns are kept by ``filter_quality``
and ignored by ``judge_quality``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import single_spaced, spaced_word_count

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents of the sample that orders the rules, bytes of the longest one in it, and files that it is drawn from at most.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_FILES = 200, 1 << 15, 32


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(spaced: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text."""
    windows = F.regexp_extract_all(spaced, F.lit(r"(?<![^ ])(?=([^ ]+ [^ ]+ [^ ]+))"), 1)

    def covered(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return _let(placed, lambda s: F.size(F.array_distinct(F.flatten(F.transform(F.filter(s, lambda x, i: x["w"].eqNullSafe(F.get(s, i - 1)["w"]) | x["w"].eqNullSafe(F.get(s, i + 1)["w"])), lambda x: F.sequence(x["i"], x["i"] + 2))))))

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))).cast("long")


def _symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def _line_counts(text: Column) -> Column:
    """Lines that hold a word, and how many of them equal an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")))


def spaced_words(docs: DataFrame) -> DataFrame:
    """Add spaced and n_words to a table with text, which both branches of the chain use."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("spaced", single_spaced(F.col("text"))).withColumn("n_words", spaced_word_count(F.col("spaced")))


def text_figures(docs: DataFrame) -> DataFrame:
    """Add word_chars, n_symbols, line_counts and n_repeat_words to the rows of ``spaced_words``."""
    return spaced_words(docs).withColumns({
        "word_chars": F.when(F.col("n_words") > 0, F.length("spaced") - F.col("n_words") + 1).otherwise(0).cast("long"),
        "n_symbols": _symbols(F.col("text")),
        "line_counts": _line_counts(F.col("text")),
        "n_repeat_words": repeated_window_words(F.col("spaced")),
    })


def base_rules(repeat_words: Column) -> dict[str, Column]:
    return {"few_words": F.col("n_words") < MIN_WORDS, "repeated_words": 100 * repeat_words > MAX_REPEATED_PERCENT * F.col("n_words")}


def cascade_rules(symbols: Column, lines: Column, word_chars: Column) -> dict[str, Column]:
    """Rule name to the condition under which it rejects."""
    marks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))
    return {
        "symbols": 100 * symbols > 30 * F.col("n_words"),
        "repeated_lines": _let(lines, lambda x: 100 * x["again"] > 60 * x["lines"]),
        "word_length": (word_chars < 2 * F.col("n_words")) | (word_chars > 20 * F.col("n_words")),
        "shouting": 100 * marks > 40 * F.col("n_words"),
    }


def all_rules() -> dict[str, Column]:
    """Every rule on the rows of ``spaced_words``, each with what it needs inside."""
    word_chars = F.length("spaced") - F.col("n_words") + 1
    return base_rules(repeated_window_words(F.col("spaced"))) | cascade_rules(_symbols(F.col("text")), _line_counts(F.col("text")), word_chars)


def sample_files(docs: DataFrame) -> DataFrame:
    """The rows of at most ``SAMPLE_FILES`` of the files behind a table, by hash of their names; other files are not read."""
    files = docs.inputFiles()
    if len(files) <= SAMPLE_FILES:
        return docs
    chosen = sorted(files, key=lambda f: hashlib.md5(f.encode()).digest())[:SAMPLE_FILES]
    try:
        return docs.where(docs.metadataColumn("_metadata")["file_name"].isin([unquote(f.rsplit("/", 1)[-1]) for f in chosen]))
    except AnalysisException:  # a derived table has lost its files' names
        return docs


def drawn(docs: DataFrame, text_col: str) -> DataFrame:
    """A random draw of about ``SAMPLE_ROWS`` documents that are not too long, as text, spaced and n_words; they stay in the tasks that read them."""
    part = sample_files(docs)
    fraction = SAMPLE_ROWS / max(part.count(), 1)  # Parquet counts rows without reading them
    text = part.select(F.col(f"`{text_col}`").alias("text"))
    return spaced_words(text.where(F.rand(17) < fraction).where(F.octet_length("text") <= SAMPLE_BYTES))


def _clock() -> Column:
    """Nanoseconds at the moment of evaluation; fields of a struct are evaluated in turn."""
    return F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")


def order_rules(docs: DataFrame, rules: dict[str, Column], text_col: str = "text") -> list[str]:
    """Rule names by rejections per nanosecond on the sample, best first; two actions, a count and the timing."""
    marks = [_clock().alias("t0")]
    for i, rule in enumerate(rules.values()):
        marks += [F.coalesce(rule, F.lit(False)).alias(f"r{i}"), _clock().alias(f"t{i + 1}")]
    timed = drawn(docs, text_col).select(F.struct(*marks).alias("m"))
    sums = [F.count_if(f"m.r{i}").alias(f"n{i}") for i in range(len(rules))] + [F.sum(F.col(f"m.t{i + 1}") - F.col(f"m.t{i}")).alias(f"ns{i}") for i in range(len(rules))]
    found = timed.agg(*sums).first()
    gain = {name: found[f"n{i}"] / max(found[f"ns{i}"] or 0, 1) for i, name in enumerate(rules)}
    return sorted(rules, key=lambda name: -gain[name])


def verdict(rules: dict[str, Column], order: list[str]) -> Column:
    """True when no rule rejects; later rules run only where earlier ones pass."""
    kept = None
    for name in order:
        rejects = F.coalesce(rules[name], F.lit(False))
        kept = F.when(rejects, False) if kept is None else kept.when(rejects, False)
    return kept.otherwise(True)


def judge_quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base figures, base_failed, kept."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    base = base_rules(F.col("n_repeat_words"))
    failed = base["few_words"] | base["repeated_words"]
    order = [name for name in order_rules(docs, all_rules(), text_col) if name not in base]
    rules = cascade_rules(F.col("n_symbols"), F.col("line_counts"), F.col("word_chars")) | {"base": failed}
    return text_figures(rows).select("doc_id", "n_words", "word_chars", "n_symbols", F.col("line_counts.again").alias("n_dup_lines"), "n_repeat_words", failed.alias("base_failed"), verdict(rules, ["base", *order]).alias("kept"))


def filter_quality(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    rules = all_rules()
    kept = verdict(rules, order_rules(docs, rules, text_col))
    # a filter would be pushed below the words and compute them once per rule
    return spaced_words(rows).select(F.inline(F.when(kept, F.array("row"))))
