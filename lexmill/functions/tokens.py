"""Four tokenizers, as array-valued Column expressions."""

from __future__ import annotations

import sqlite3
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold_lookup, legal_ids, norm_space, short_legal_ids, text_or_empty

# Stop words of each tokenizer.
SEARCH_STOP = ["và", "hoặc", "thì", "là", "của", "cho", "với", "trong", "khi", "nếu", "theo", "được", "bị", "có", "không", "như", "nào", "gì", "về", "cần", "phải", "sẽ", "một", "các", "những", "để", "tại", "từ", "đến", "ra", "sao", "này", "đó"]
LOOKUP_STOP = ["cua", "cho", "voi", "trong", "khi", "neu", "thi", "la", "va", "hoac", "cac", "nhung", "duoc", "khong", "phai", "theo", "quy", "dinh", "phap", "luat"]
PLAN_STOP = ["cua", "cho", "voi", "trong", "theo", "phap", "luat", "dieu", "khoan", "quy", "dinh"]


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _strip(value: Column, chars: str) -> Column:
    return F.btrim(value, F.lit(chars))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def search_terms(text: Column, limit: int = 32) -> Column:
    """Legal identifiers, then words; first spelling of each, at least two characters, no stop words."""
    words = F.regexp_extract_all(norm_space(text), F.lit(r"[0-9A-Za-zÀ-ỹĐđ/\.-]+"), F.lit(0))
    found = F.concat(legal_ids(text), short_legal_ids(text), words)
    pairs = F.transform(found, lambda t: F.struct(_strip(F.lower(t), ".,;:/").alias("low"), t.alias("term")))
    pairs = F.filter(pairs, lambda p: (F.length(p["low"]) >= 2) & ~F.array_contains(_strings(SEARCH_STOP), p["low"]))

    def first_spellings(found: Column) -> Column:
        lows = F.transform(found, lambda p: p["low"])
        wanted = F.slice(F.array_distinct(lows), 1, limit)
        return _let(lows, lambda low: F.transform(wanted, lambda w: F.element_at(found, F.array_position(low, w).cast("int"))["term"]))

    return _let(pairs, first_spellings)


def plan_terms(text: Column, limit: int = 40) -> Column:
    """Lower-cased words of at least three characters; the stop words carry no diacritics."""
    words = F.split(F.trim(F.regexp_replace(text_or_empty(text), r"[^0-9A-Za-zÀ-ỹ%/.-]+", " ")), " ")
    lowered = F.transform(words, lambda w: F.lower(_strip(w, ".,;:")))
    kept = F.filter(lowered, lambda w: (F.length(w) >= 3) & ~F.array_contains(_strings(PLAN_STOP), w))
    return F.slice(F.array_distinct(kept), 1, limit)


def lookup_tokens(text: Column, limit: int = 80) -> Column:
    """Folded words of at least three characters without stop words."""
    words = F.split(F.regexp_replace(fold_lookup(text), r"[^a-z0-9%/.,-]+", " "), " ")
    stripped = F.transform(words, lambda w: _strip(w, ".,-"))
    kept = F.filter(stripped, lambda w: (F.length(w) >= 3) & ~F.array_contains(_strings(LOOKUP_STOP), w))
    return F.slice(F.array_distinct(kept), 1, limit)


@cache
def _index_table() -> tuple[str, str]:
    """How SQLite's full-text tokenizer folds single letters, asked from SQLite itself."""
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00)) if unicodedata.category(chr(c))[0] == "L"]
    base = sqlite3.connect(":memory:")
    base.execute("CREATE VIRTUAL TABLE t USING fts5(x)")
    base.execute("CREATE VIRTUAL TABLE v USING fts5vocab(t, instance)")
    base.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", enumerate(letters))
    seen = {doc: term for term, doc in base.execute("SELECT term, doc FROM v") if len(term) == 1}
    base.close()
    pairs = [(a, seen[i]) for i, a in enumerate(letters) if i in seen and seen[i] != a]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def index_tokens(text: Column) -> Column:
    """Tokens of the keyword index: letters and numbers, single diacritics removed."""
    lowered = F.regexp_replace(F.lower(F.translate(text_or_empty(text), *_index_table())), r"\p{Mn}+", "")
    return F.filter(F.split(lowered, r"[^\p{L}\p{N}\p{Co}]+"), lambda t: t != "")


def index_text(text: Column) -> Column:
    """The tokens of ``index_tokens`` joined by blanks; letters of ASCII texts need no table."""
    plain = text_or_empty(text)
    folded = F.regexp_replace(F.lower(F.translate(plain, *_index_table())), r"\p{Mn}+", "")
    words = F.when(F.octet_length(plain) == F.length(plain), F.regexp_replace(F.lower(plain), "[^a-z0-9]+", " ")).otherwise(F.regexp_replace(folded, r"[^\p{L}\p{N}\p{Co}]+", " "))
    return F.btrim(words, F.lit(" "))
