"""URL filters as a sorted sweep over nested rule intervals.

Main path: DataFrame functions only.  A rule (host, path) becomes the interval
of all keys that start with ``reversed host, zero byte, path``; a URL becomes
one probe key for each suffix of its host.  Rules and probes are sorted
together and swept: the running sum of openings and closings is the depth of
the stack of active rules, and the last rule opened at the present depth is its
top, the longest rule that holds.  Only probes whose suffix has a rule are swept.
Those of one suffix are salted over as many sweeps as its count asks for (its
rules are repeated in each), so that no sweep holds more than a small share of
the probes.  The longest of a URL's tops wins.

Defined cases: a very long URL is one key; null URLs and URLs without ``://`` have empty host and path and
fit no rule; rules given twice count once and block beats allow; of rules of
equal length the one with the longer host wins; rows that repeat a page are
judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, lower_ascii, materialize, partitions

#: Sweeps for each shuffle partition that the probes of all suffixes are dealt over.
SWEEPS = 4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return lower_ascii(host), path


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def interval_key(host: Column, path: Column) -> Column:
    """Bytes that sort rules and URLs of one host together, by path."""
    return F.concat(F.encode(reversed_host(host), "UTF-8"), F.lit(bytearray(b"\0")), F.encode(path, "UTF-8"))


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow", sweeps: int = SWEEPS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block).
    """
    host, path = split_url(F.col(f"`{url_col}`"))
    urls = materialize(pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row_no")))
    rules = materialize(rules.groupBy(lower_ascii(F.col("host")).alias("suffix"), F.col("path").alias("rule_path")).agg(F.max("verdict").alias("verdict")))

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probes = urls.select("row_no", "path", F.explode(suffixes).alias("suffix"))
    met = probes.groupBy("suffix").agg(F.count("*").alias("n")).join(rules.select("suffix").distinct(), "suffix")
    met = materialize(met)
    total = met.agg(F.sum("n")).first()[0] or 1
    share = -(-total // (sweeps * partitions(pages.sparkSession)))  # probes of a sweep
    met = met.withColumn("salts", F.ceil(F.col("n") / F.lit(share)).cast("int"))
    probes = join_counted(probes, met, "suffix", "n")
    probes = probes.select("suffix", F.pmod(F.xxhash64("row_no"), F.col("salts")).cast("int").alias("salt"), interval_key(F.col("suffix"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "row_no", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))

    key = interval_key(F.col("suffix"), F.col("rule_path"))
    edges = F.array(F.struct(F.lit(0).alias("kind"), key.alias("key")), F.struct(F.lit(2).alias("kind"), F.concat(key, F.lit(bytearray(b"\xff"))).alias("key")))
    events = rules.join(met.select("suffix", "salts"), "suffix").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    events = events.select("suffix", "salt", F.concat("suffix", "rule_path").alias("rule"), "verdict", F.explode(edges).alias("edge"))
    events = events.select("suffix", "salt", "edge.key", "edge.kind", F.lit(None).cast("long").alias("row_no"), "rule", "verdict")

    # of equal keys: openings outermost first, then probes, then closings
    sweep = Window.partitionBy("suffix", "salt").orderBy("key", "kind", F.length("rule")).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    depth = probes.unionByName(events).withColumn("depth", F.sum(step).over(sweep))
    stack = Window.partitionBy("suffix", "salt", "depth").orderBy("key", "kind", F.length("rule")).rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("kind") == 0, F.struct(F.length("rule").alias("size"), F.length("suffix").alias("host_size"), "rule", "verdict"))
    tops = depth.withColumn("top", F.when(F.col("depth") > 0, F.last(opened, ignorenulls=True).over(stack))).where("kind = 1 and top is not null")
    best = tops.groupBy("row_no").agg(F.max("top").alias("top"))
    return urls.join(best, "row_no", "left").select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
