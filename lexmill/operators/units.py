"""Articles, clauses and points from ordered lines, as running groups.

Input is one row per line: (key, pos, text), and for lines of marked-up pages also the
element's tag, classes and id, and the level of the page's marks (null for plain text).
Every rule is a flag on the line; a running sum of start flags numbers the units, and
running last values carry the part, chapter and section that a unit stands under.
Windows are partitioned by document, which is what one task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed patterns of headings, and class names of marked units by level, first level first.
CHAPTER = r"(?iU)^Chương\s+([IVXLCDM]+|\d+)\b"
SECTION = r"(?iU)^Mục\s+\d+\b"
ARTICLE = r"(?iU)^Điều\s+(\d+[a-zA-Z]?)\.?\s*(.*)"
NUMBERED = r"(?iU)^(\d+(?:[.\-]\d+)*)[\-.]?\s*(.*)"
PART = r"(?iU)^([IVXLCDM]+|\d+)[\-.]?\s*(.*)"
CLAUSE = r"(?U)^(\d+)\.\s+"
POINT = r"(?U)^([a-zA-ZđĐ])\)\s+"
LEVELS = {"article": ("prov-article", ARTICLE), "section": ("prov-section", NUMBERED), "clause": ("prov-clause", NUMBERED), "part": ("prov-part", PART)}
WHOLE, WHOLE_TITLE = "toan_van", "Toàn văn"
#: Levels above a unit's own, at which it ends.
ENDS = {"section": ["prov-part"], "clause": ["prov-part", "prov-section"]}


def page_level(classes: Column) -> Column:
    """The first level of which the class is among those of a page; null if none is."""
    chosen = F.lit(None).cast("string")
    for level, (css, _) in reversed(LEVELS.items()):
        chosen = F.when(F.array_contains(classes, css), level).otherwise(chosen)
    return chosen


def plain_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, text, ...) of the non-empty lines of a text, white space collapsed."""
    lines = df.select(F.col(key).alias("key"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")).alias("pos", "raw"))
    clean = F.trim(F.regexp_replace("raw", r"(?U)\s+", " "))
    none = F.lit(None).cast("string")
    return lines.select("key", "pos", clean.alias("text"), none.alias("tag"), F.array().cast("array<string>").alias("classes"), none.alias("id"), none.alias("level")).where("text <> ''")


def _by_level(make: dict[str, Column], other: Column) -> Column:
    found = other
    for level, value in make.items():
        found = F.when(F.col("level") == level, value).otherwise(found)
    return found


def _flags(rows: DataFrame) -> DataFrame:
    """Which role each line has."""
    marked = F.col("level").isNotNull()
    has = lambda css: F.array_contains("classes", css)
    chapter = F.when(marked, has("prov-chapter")).otherwise(F.col("text").rlike(CHAPTER))
    section = F.when(marked, has("prov-section")).otherwise(~F.col("text").rlike(CHAPTER) & F.col("text").rlike(SECTION))
    plain_start = ~F.col("text").rlike(CHAPTER) & ~F.col("text").rlike(SECTION) & F.col("text").rlike(ARTICLE)
    start = _by_level({level: has(css) for level, (css, _) in LEVELS.items()}, plain_start)
    end = _by_level({level: F.arrays_overlap("classes", F.array(*map(F.lit, names))) for level, names in ENDS.items()}, F.lit(False))
    rows = rows.withColumns({"_part": marked & has("prov-part"), "_chapter": chapter, "_section": section, "_start": start, "_end": end & ~start})
    return rows.withColumn("_aside", ~marked & (F.col("_chapter") | F.col("_section")))


def unit_lines(rows: DataFrame) -> DataFrame:
    """Each line with its unit's number (0: before any) and the headings above it."""
    so_far = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = lambda flag: F.last(F.when(F.col(flag), F.col("text")), ignorenulls=True).over(so_far)
    event = F.when(F.col("_start"), True).when(F.col("_end"), False)
    placed = _flags(rows).withColumns({
        "unit": F.sum(F.col("_start").cast("int")).over(so_far),
        "part": carried("_part"), "chapter": carried("_chapter"), "section": carried("_section"),
        "_open": F.coalesce(F.last(event, ignorenulls=True).over(so_far), F.lit(False)),
    })
    return placed.withColumn("units", F.max("unit").over(Window.partitionBy("key")))


def _clauses(lines: DataFrame) -> DataFrame:
    """(key, unit, clauses) from the lines of units: numbered lines begin a clause, lettered ones are its points, others go on with its text."""
    so_far = Window.partitionBy("key", "unit").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = lines.where("not _start").withColumn("_clause", F.col("text").rlike(CLAUSE))
    inner = inner.withColumn("clause", F.sum(F.col("_clause").cast("int")).over(so_far)).where("clause > 0")
    inner = inner.withColumn("_point", ~F.col("_clause") & F.col("text").rlike(POINT))
    ordered = lambda flag, value: F.transform(F.array_sort(F.collect_list(F.when(flag, F.struct("pos", value.alias("v"))))), lambda x: x["v"])
    point = F.struct(F.lower(F.regexp_extract("text", POINT, 1)).alias("point"), F.col("text"))
    one = inner.groupBy("key", "unit", "clause").agg(F.max(F.when(F.col("_clause"), F.regexp_extract("text", CLAUSE, 1))).alias("clause_no"), F.array_join(ordered(~F.col("_point"), F.col("text")), "\n").alias("text"), ordered(F.col("_point"), point).alias("points"))
    return one.groupBy("key", "unit").agg(F.transform(F.array_sort(F.collect_list(F.struct("clause", "clause_no", "text", "points"))), lambda c: F.struct(c["clause_no"].alias("clause_no"), c["text"].alias("text"), c["points"].alias("points"))).alias("clauses"))


def units(rows: DataFrame) -> DataFrame:
    """One row per unit: key, pos, chunk_level, chunk_no, chunk_title, part, chapter, section, article_no, article_title, provision_id, article_text, clauses.

    Lines before the first unit are left out, headings too; plain text without any article is one unit with all its lines.
    """
    lines = unit_lines(rows)
    whole = F.col("level").isNull() & (F.col("units") == 0)
    body = lines.where((F.col("unit") > 0) & F.col("_open") & ~F.col("_aside"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("article_text")
    head = F.min_by(F.struct("text", "level", "part", "chapter", "section", "id"), "pos").alias("h")
    made = body.groupBy("key", "unit").agg(head, ordered).join(_clauses(body), ["key", "unit"], "left")
    level = F.coalesce("h.level", F.lit("article"))
    heading = lambda k: _by_level({name: F.regexp_extract("h.text", pattern, k) for name, (_, pattern) in LEVELS.items()}, F.regexp_extract("h.text", ARTICLE, k))
    made = made.withColumn("level", F.col("h.level")).withColumn("_no", heading(1))
    found = F.col("_no") != ""
    number = F.when(found, F.col("_no")).otherwise(F.concat_ws("_", level, F.col("unit").cast("string")))
    title = F.when(found, F.trim(heading(2))).otherwise(F.col("h.text"))
    no_clauses = F.array().cast(made.schema["clauses"].dataType)
    section = F.when(level == "section", F.lit(None)).otherwise(F.col("h.section"))
    rows_out = made.select("key", (F.col("unit") - 1).cast("int").alias("pos"), level.alias("chunk_level"), number.alias("chunk_no"), title.alias("chunk_title"), F.col("h.part").alias("part"), F.col("h.chapter").alias("chapter"), section.alias("section"), number.alias("article_no"), title.alias("article_title"), F.col("h.id").alias("provision_id"), "article_text", F.coalesce("clauses", no_clauses).alias("clauses"))
    none = F.lit(None).cast("string")
    rest = lines.where(whole).groupBy("key").agg(ordered)
    rest = rest.select("key", F.lit(0).alias("pos"), F.lit("full_text").alias("chunk_level"), F.lit(WHOLE).alias("chunk_no"), F.lit(WHOLE_TITLE).alias("chunk_title"), none.alias("part"), none.alias("chapter"), none.alias("section"), F.lit(WHOLE).alias("article_no"), F.lit(WHOLE_TITLE).alias("article_title"), none.alias("provision_id"), "article_text", no_clauses.alias("clauses"))
    return rows_out.unionByName(rest)


def article_ids(rows: DataFrame) -> DataFrame:
    """(key, article_no, provision_id): the id of the first marked element of each article that has one."""
    marked = rows.where(F.array_contains("classes", "prov-article") & F.col("id").isNotNull() & F.col("text").rlike(ARTICLE))
    return marked.groupBy("key", F.regexp_extract("text", ARTICLE, 1).alias("article_no")).agg(F.min_by("id", "pos").alias("provision_id"))
