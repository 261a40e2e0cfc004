"""Fetching pages over HTTP inside the engine; transports are passed in for tests."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator
from urllib import error, request

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import text as tx

RETRIES, BACKOFF, TIMEOUT = 3, 1.5, 30
# What marks a page as invalid within its first characters.
BAD_MARKERS, BAD_WITHIN = ["không tìm thấy", "not found", "404", "internal server error"], 5000

LOGS = T.ArrayType(T.StructType([T.StructField("url", T.StringType()), T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())]))

Transport = Callable[[str, float], tuple[int, str]]


def http_get(url: str, timeout: float) -> tuple[int, str]:
    try:
        with request.urlopen(request.Request(url, headers={"Accept-Language": "vi,en;q=0.8"}), timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except error.HTTPError as failed:
        return failed.code, failed.read().decode("utf-8", "replace")


def _outcome(url: str, transport: Transport, timeout: float) -> tuple[int, str] | OSError:
    try:
        return transport(url, timeout)
    except OSError as problem:
        return problem


def with_retry(url: str, transport: Transport = http_get, *, retries: int = RETRIES, backoff: float = BACKOFF, timeout: float = TIMEOUT, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str]:
    """Ask until the status is below 500; the last answer, or the last error, stands."""
    seen: list[tuple[int, str] | OSError] = []
    settled = lambda: bool(seen) and isinstance(seen[-1], tuple) and seen[-1][0] < 500
    pauses = (backoff * n for n in range(retries))
    for pause in itertools.takewhile(lambda _: not settled(), pauses):
        if pause:
            sleep(pause)
        seen.append(_outcome(url, transport, timeout))
    last = next((x for x in reversed(seen) if isinstance(x, tuple)), seen[-1])
    if isinstance(last, OSError):
        raise last
    return last


def fetch_page(url: str, transport: Transport = http_get, **options) -> tuple[str | None, str | None]:
    """(html, error) of one page."""
    try:
        status, body = with_retry(url, transport, **options)
    except OSError as problem:
        return None, str(problem)
    if status != 200:
        return None, f"HTTP {status}"
    if any(m in body[:BAD_WITHIN].lower() for m in BAD_MARKERS):
        return None, "Page looks invalid"
    return body, None


def looks_invalid(html: Column) -> Column:
    """Whether a stored page is an error page, by the same markers."""
    start = F.lower(F.substring(tx.text_or_empty(html), 1, BAD_WITHIN))
    found = F.lit(False)
    for marker in BAD_MARKERS:
        found = found | start.contains(marker)
    return found


def candidate_urls(doc_id: Column, title: Column, url: Column, old_base: str, new_base: str) -> Column:
    """URLs to try in order: legacy ones for numeric ids, else given, slug and bare."""
    key, given = F.trim(tx.text_or_empty(doc_id)), F.trim(tx.text_or_empty(url))
    own = F.when(given.startswith("http"), F.array(given)).otherwise(F.array().cast("array<string>"))
    legacy = F.array(F.concat(F.lit(f"{old_base}/vbpq-toanvan.aspx?ItemID="), key), F.concat(F.lit(f"{old_base}/vbpq-print.aspx?ItemID="), key), F.concat(F.lit(f"{new_base}/--"), key))
    modern = F.concat(own, F.array(F.concat(F.lit(f"{new_base}/"), tx.slug(title), F.lit("--"), key), F.concat(F.lit(f"{new_base}/--"), key)))
    return F.array_distinct(F.concat(F.when(tx.is_numeric_id(key), legacy).otherwise(modern), own))


def fetch_first_ok(rows: DataFrame, urls: str = "urls", transport: Transport = http_get, **options) -> DataFrame:
    """Add html, source_url and logs array<struct<url,ok,error>>; the first page that is valid wins."""
    log = pa.list_(pa.struct([("url", pa.string()), ("ok", pa.bool_()), ("error", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, sources, logs = [], [], []
            for tried in batch.column(urls).to_pylist():
                html, source, seen = None, None, []
                for url in tried or []:
                    html, failure = fetch_page(url, transport, **options)
                    seen.append({"url": url, "ok": html is not None, "error": failure})
                    if html:
                        source = url
                        break
                pages.append(html)
                sources.append(source)
                logs.append(seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pages, pa.string()), pa.array(sources, pa.string()), pa.array(logs, log)], names=[*batch.schema.names, "html", "source_url", "logs"])

    schema = T.StructType([*rows.schema.fields, T.StructField("html", T.StringType()), T.StructField("source_url", T.StringType()), T.StructField("logs", LOGS)])
    return rows.mapInArrow(run, schema)
