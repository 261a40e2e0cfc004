"""HTML operators: the standard library's parser in Arrow batches, and Spark for the rest.

Python only flattens a page: to its text and title, to its elements in document
order (tag, classes, id, text), to its links.  Units, article ids and the choice of
file links are DataFrame operations on those rows.  A small tree (tag, attributes,
children) stands in for an HTML library; the text of a node is the text of its parts,
each stripped, joined by a separator.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import units

SKIPPED = {"script", "style", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

# Fixed suffixes and words of links to files.
FILE_SUFFIXES = [".pdf", ".doc", ".docx"]
FILE_WORDS = ["bản pdf", "tải về", *FILE_SUFFIXES]

#: Bytes and rows of pages that are parsed before their results go on.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 256


class Node:
    """An element, or the document when the tag is empty."""

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []

    @property
    def classes(self) -> set[str]:
        return set((self.attributes.get("class") or "").split())

    def walk(self) -> Iterator[Node]:
        """Elements below, in document order."""
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def strings(self) -> Iterator[str]:
        for child in self.children:
            if isinstance(child, str):
                yield child
            else:
                yield from child.strings()

    def text(self, separator: str = " ") -> str:
        return separator.join(s.strip() for s in self.strings() if s.strip())

    def line(self) -> str:
        return re.sub(r"\s+", " ", self.text()).strip()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SKIPPED:
            self.skip += 1
        if self.skip:
            return
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if not self.skip and tag not in SKIPPED:
            self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
            return
        if self.skip:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _space(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def text_and_title(html: str | None, url: str | None = "") -> tuple[str, str]:
    """Whole text, and the first h1's text, else the title, else the url."""
    root = parse(html)
    first = lambda tag: next((n.text() for n in root.walk() if n.tag == tag), "")
    return _space(root.text("\n")), _space(first("h1") or first("title") or url or "")


def text_lines(html: str | None) -> list[str]:
    """Non-empty lines of the text with white space collapsed."""
    return [x for x in (_space(line) for line in "\n".join(parse(html).strings()).splitlines()) if x]


def elements(html: str | None) -> list[dict]:
    """Elements that hold a line of text or mark an article, in document order."""
    found = [(n, n.line()) for n in parse(html).walk() if n.tag in ("p", "div", "li") or n.classes]
    return [{"tag": n.tag, "classes": sorted(n.classes), "id": n.attributes.get("id"), "text": line} for n, line in found]


def links(html: str | None, base_url: str | None) -> list[dict]:
    """Whole URLs of all links with what they say."""
    found = [n for n in parse(html).walk() if n.tag == "a" and "href" in n.attributes]
    return [{"href": urljoin(base_url or "", n.attributes["href"]), "label": n.text()} for n in found]


def _slices(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE_BYTES`` in the columns, one row at least."""
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False), np.int64) for c in columns)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))), at + SLICE_ROWS)
        yield batch.slice(at, end - at)
        at = end


def _mapped(batches: Iterator[pa.RecordBatch], inputs: list[str], make: Callable[..., dict], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches with the made columns; Python holds the values of one slice at a time, whatever the batch and the pages in it."""
    for batch in batches:
        for part in _slices(batch, inputs):
            rows = [make(*values) for values in zip(*(part.column(c).to_pylist() for c in inputs), strict=True)]
            made = [pa.array([r[name] for r in rows], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *kinds])


def _map_rows(df: DataFrame, inputs: list[str], make: Callable[..., dict], fields: list[T.StructField]) -> DataFrame:
    """Add ``fields`` made from the string columns ``inputs`` row by row inside Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in fields}
    return df.mapInArrow(lambda batches: _mapped(batches, inputs, make, kinds), T.StructType([*df.schema.fields, *fields]))


def with_text_and_title(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    return _map_rows(pages, [html, url], lambda h, u: dict(zip(("text", "title"), text_and_title(h, u), strict=True)), [T.StructField("text", T.StringType()), T.StructField("title", T.StringType())])


def with_lines(pages: DataFrame, html: str = "html") -> DataFrame:
    return _map_rows(pages, [html], lambda h: {"lines": text_lines(h)}, [T.StructField("lines", T.ArrayType(T.StringType()))])


_ELEMENT = T.StructType([T.StructField("tag", T.StringType()), T.StructField("classes", T.ArrayType(T.StringType())), T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])


def element_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pos, text, tag, classes, id, level): a page's marked elements, or its plain lines when no class marks a unit."""
    made = _map_rows(pages.select(F.col(key).alias("key"), html), [html], lambda h: {"elements": elements(h), "lines": text_lines(h)}, [T.StructField("elements", T.ArrayType(_ELEMENT)), T.StructField("lines", T.ArrayType(T.StringType()))])
    made = made.withColumn("level", units.page_level(F.flatten("elements.classes")))
    none = F.lit(None).cast("string")
    plain = F.transform("lines", lambda x: F.struct(none.alias("tag"), F.array().cast("array<string>").alias("classes"), none.alias("id"), x.alias("text")))
    return made.select("key", "level", F.posexplode(F.when(F.col("level").isNotNull(), F.col("elements")).otherwise(plain)).alias("pos", "e")).select("key", "pos", "e.text", "e.tag", "e.classes", "e.id", "level")


def page_units(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Units of each page, as ``units.units`` gives them."""
    rows = element_rows(pages, key, html)
    return units.units(rows.where("text <> '' and (tag is null or tag in ('p', 'div', 'li'))")).withColumnRenamed("key", key)


def page_article_ids(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    return units.article_ids(element_rows(pages, key, html)).withColumnRenamed("key", key)


def with_file_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``files``: links to files, by suffix or by what the link says; ordered, distinct."""
    link = T.StructType([T.StructField("href", T.StringType()), T.StructField("label", T.StringType())])
    made = _map_rows(pages, [html, url], lambda h, u: {"_links": links(h, u)}, [T.StructField("_links", T.ArrayType(link))])
    any_of = lambda value, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(value), w))
    kept = F.filter("_links", lambda x: any_of(x["href"], FILE_SUFFIXES) | any_of(x["label"], FILE_WORDS))
    return made.withColumn("files", F.array_distinct(F.transform(kept, lambda x: x["href"]))).drop("_links")
