"""Secret scans with multipart credential linking.

Strong patterns (assignments, access identifiers, long hex runs) are reported
wherever they match.  Weak parts are only candidates: a 40-character key that
mixes letter cases and digits, and an endpoint URL.  A candidate opens a scope:
the block of text around it, up to the next blank lines whatever its length, and at
least ``scope`` code points on both sides.  An interval join (sorted starts, binary searches for the ends of each scope) looks
for complementary parts in it.  A key is reported when an identifier or an endpoint
is in scope, an endpoint when an identifier, a key or an assigned secret is.

Texts are scanned whole.  An Arrow regular expression drops texts without any
pattern before Python sees them.  Defined cases: null text is empty; a very long
text is one row, scanned in time proportional to its length and to its parts times
their logarithm; rows that repeat are scanned alike; equal starts are ordered by
kind as in ``KINDS``; a candidate inside a strong span is not reported again, and
counts as no part; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["assign", "access", "hex", "key", "endpoint"]
#: Code points on both sides of a candidate that its scope holds at least.
SCOPE = 300

# Fixed patterns of the strong kinds, with their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

KEY = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"""https?://[^\s"'<>]+""")
BLANK = re.compile(r"\n[^\S\n]*\n")
#: What a text must hold to be scanned at all; an endpoint alone is complementary to nothing.
ANY = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/]{40}"

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())])


def _mixed(key: str) -> bool:
    return any(c.islower() for c in key) and any(c.isupper() for c in key) and any(c.isdigit() for c in key)


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of sorted spans those that touch none of the taken ones."""
    merged: list[list[int]] = []
    for a, b in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b) - 1  # the last one that starts before the span ends
        return i < 0 or merged[i][1] <= a

    return [(a, b) for a, b in spans if free(a, b)]


def linked_parts(text: str, strong: list[tuple[int, int, str]], scope: int = SCOPE) -> list[tuple[int, int, str]]:
    """Weak parts that have a complementary part inside their scope."""
    taken = [(a, b) for a, b, _ in strong]
    keys = _apart([m.span() for m in KEY.finditer(text) if _mixed(m[0])], taken)
    ends = _apart([m.span() for m in ENDPOINT.finditer(text)], taken + keys)
    access = sorted(a for a, _, kind in strong if kind == "access")
    secrets = sorted([a for a, _, kind in strong if kind == "assign"] + [a for a, _ in keys])
    if not (keys or ends):
        return []
    borders = [m.span() for m in BLANK.finditer(text)]
    border_starts, border_ends = [a for a, _ in borders], [b for _, b in borders]

    def near(span: tuple[int, int], others: list[int]) -> bool:
        before, after = bisect_right(border_ends, span[0]), bisect_left(border_starts, span[1])
        low, high = border_ends[before - 1] if before else 0, border_starts[after] if after < len(borders) else len(text)
        return bisect_left(others, min(low, span[0] - scope)) < bisect_right(others, max(high, span[1] + scope))

    end_starts = [a for a, _ in ends]
    found = [(a, b, "key") for a, b in keys if near((a, b), access) or near((a, b), end_starts)]
    return found + [(a, b, "endpoint") for a, b in ends if near((a, b), access) or near((a, b), secrets)]


def find_spans(text: str, scope: int = SCOPE) -> list[tuple[int, int, str]]:
    """All reported (start, end, kind), code points, by start and kind."""
    strong = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    strong += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    strong += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(strong + linked_parts(text, strong, scope), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, spans array<struct<kind,start,end,value>>."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in pc.indices_nonzero(pc.match_substring_regex(texts, ANY)).to_pylist():
                text = texts[i].as_py()
                spans[i] = [{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, b, k in find_spans(text, scope)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(struct))], names=["doc_id", "spans"])

    return rows.mapInArrow(scan, T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(SPAN))]))
