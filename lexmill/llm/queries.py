"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import exact_dedup
from .importance import resample
from .line_dedup import dedup_lines
from .mixing import mix_plan
from .ngram_join import near_duplicate_classes
from .packing import pack_documents
from .quality import judge_quality
from .secrets import scan_secrets
from .substring_dedup import remove_repeats
from .url_filter import filter_urls
from .vector_search import nearest_neighbours
from .warc import archive_dir, read_warc, write_warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: Rules of the URL query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2, cache_entries=1_000_000)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(_table(spark, sf_dir, "documents"), cycle=[3.0, 1.0, 2.0], budget=1.5, max_epochs=2.0)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = archive_dir(spark)
    write_warc(_table(spark, sf_dir, "pages"), directory, keep="largest", min_revisit_bytes=0)
    return read_warc(spark, directory).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents"), counts=True).select("doc_id", "n_lines", "n_removed", "text")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), window=35)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(_table(spark, sf_dir, "pages"), rules)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(_table(spark, sf_dir, "documents"), words_per_gram=4, threshold=(85, 100))
    return classes.select("doc_id", "n_shingles", "component_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=5, min_words=20, seed=42)


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), k=20, every=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_ngram_join": op10_ngram_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_nearest_neighbours": op12_nearest_neighbours,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op3_quality_rules": f"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
        g AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
        g2 AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM g),
        g3 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g2),
        r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g3 WHERE n > 1) GROUP BY doc_id),
        f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(text, '[^!]', '', 'g')) AS marks FROM w LEFT JOIN r USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 60 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * marks > 40 * n_words) AS kept
        FROM f""",
    "op4_mixing": f"""
        WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|17'), 1, 15))::BIGINT AS u FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM d GROUP BY source),
        c AS (SELECT *, 2.0 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS k FROM s),
        l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
        v AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY k LIMIT 1),
        t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM v))::DOUBLE AS target FROM l),
        q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
        m AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.target - q.whole * q.source_size AS rest,
            2 * sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u) - sum(d.size) OVER (PARTITION BY d.source, d.u) AS middle FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
        SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN rest > 0 AND middle <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM m""",
    "op9_url_filter": r"""
        WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
        p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
        r(rule_host, rule_path, rule_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        m AS (SELECT page_id, rule_host || rule_path AS rule, rule_verdict FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
        d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
        b AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::INT >> ((3 - i % 4) * 5)::INT) & 31) + 1, 1)), '') AS payload_digest FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = max(page_id) OVER g THEN NULL ELSE max(page_id) OVER g END AS refers_to FROM b WINDOW g AS (PARTITION BY hex)""",
    "op6_line_dedup": r"""
        WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS p, unnest(lines) AS line FROM t),
        f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        w AS (SELECT doc_id, i, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS win FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w WHERE win IS NOT NULL),
        c AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM o WHERE n > 1),
        g AS (SELECT l.doc_id, count(*) FILTER (c.i IS NOT NULL) AS gone, coalesce(string_agg(l.line, chr(10) ORDER BY l.p) FILTER (c.i IS NULL), '') AS kept
            FROM l LEFT JOIN f USING (doc_id, p) LEFT JOIN c ON f.doc_id = c.doc_id AND f.i = c.i GROUP BY l.doc_id),
        r AS (SELECT t.doc_id, t.text, CASE WHEN t.text IS NULL THEN NULL WHEN gone = 0 THEN t.text ELSE kept END AS cut FROM t LEFT JOIN g USING (doc_id))
        SELECT doc_id, cut AS text, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + 1 END::BIGINT AS n_lines,
            (CASE WHEN coalesce(text, '') = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + 1 END
            - CASE WHEN coalesce(cut, '') = '' THEN 0 ELSE length(cut) - length(replace(cut, chr(10), '')) + 1 END)::BIGINT AS n_removed FROM r""",
    "op8_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        s AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w),
        n AS (SELECT doc_id, i, count(*) OVER (PARTITION BY sha256(array_to_string(words[i:i + 34], ' '))) AS n FROM s),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM n WHERE n > 1),
        x AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
        k AS (SELECT doc_id, count(*) FILTER (c.p IS NOT NULL) AS gone, string_agg(word, ' ' ORDER BY p) FILTER (c.p IS NULL) AS kept FROM x LEFT JOIN c USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)""",
    "op10_ngram_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS i FROM w WHERE len(words) > 0)),
        s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
        e AS MATERIALIZED (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
        SELECT doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, low AS component_id FROM documents LEFT JOIN s USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS low FROM r GROUP BY node) USING (doc_id)""",
    "op11_importance_resampling": r"""
        WITH tbl AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce([b] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS b))),
        x AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
        w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM x),
        p AS (SELECT side, id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
        r AS (SELECT side, id, unnest(list_filter([words[i], CASE WHEN i + 1 <= len(words) THEN words[i] || ' ' || words[i + 1] END, CASE WHEN i + 2 <= len(words) THEN words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END], lambda f: f IS NOT NULL)) AS f FROM p),
        n AS (SELECT side, id, f, count(*) AS c FROM r GROUP BY ALL),
        d AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM n)),
        k AS (SELECT f, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda j: ('0x' || substr(h, (2 * j + 1)::INT, 2))::BIGINT), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM d, tbl),
        b AS (SELECT bucket, coalesce(sum(c) FILTER (side = 0), 0) AS s, coalesce(sum(c) FILTER (side = 1), 0) AS t FROM n JOIN k USING (f) GROUP BY bucket),
        a AS (SELECT sum(s) AS s, sum(t) AS t FROM b),
        g AS (SELECT bucket, floor(1000 * ln(((b.t + 1)::DOUBLE * (a.s + 10000)::DOUBLE) / ((b.s + 1)::DOUBLE * (a.t + 10000)::DOUBLE)))::BIGINT AS gain FROM b, a),
        v AS (SELECT id AS doc_id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM n JOIN k USING (f) JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
        e AS (SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT AS h FROM w LEFT JOIN v ON v.doc_id = w.id WHERE side = 0),
        z AS (SELECT doc_id, n_words >= 20 AS able, n_features::BIGINT AS n_features, weight::BIGINT AS weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM e),
        o AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS size FROM z)
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * size // 100 THEN place END AS rank FROM o""",
}


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# White space of Python's regular expressions, as a class of RE2.
_BLANKS = r"\x{09}\x{0B}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ASSIGN_SQL = _either_case("(?:password|passwd|secret|token|api_?key)") + r"""[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"""
_SPAN_SQL = {
    "assign": (_ASSIGN_SQL + r"[A-Za-z0-9+/_.=-]+", rf"length(regexp_extract(m, '{_ASSIGN_SQL}([A-Za-z0-9+/_.=-]+)', 1)) >= 6"),
    "access": (r"AKIA[A-Z0-9]+", "length(m) >= 20"),
    "hex": (r"[0-9a-f]{24,}", "true"),
    "key": (r"[A-Za-z0-9+/]{40,}=?", "length(m) = 40 AND NOT ends_with(m, '=') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')"),
    "endpoint": (rf"https?://[^\x{{0A}}{_BLANKS}\x22\x27<>]+", "true"),
    "blank": (rf"\n[{_BLANKS}]*\n", "true"),
}


def _found(kind: str) -> str:
    """(doc_id, kind, a, b) of the matches of a kind; places are sums of the lengths before."""
    pattern, keep = _SPAN_SQL[kind]
    return f"""SELECT doc_id, '{kind}' AS kind, a, a + length(m) AS b FROM (SELECT doc_id, m, sum(length(g) + length(m)) OVER (PARTITION BY n ORDER BY i) - length(m) AS a
        FROM (SELECT n, doc_id, unnest(k) AS m, unnest(h[1:len(k)]) AS g, generate_subscripts(k, 1) AS i FROM (SELECT n, doc_id, regexp_extract_all(t, '{pattern}') AS k, string_split_regex(t, '{pattern}') AS h FROM d))) WHERE {keep}"""


_NEAR = "EXISTS (FROM {others} o WHERE o.doc_id = s.doc_id AND o.a BETWEEN least(s.low, s.a - 300) AND greatest(s.high, s.b + 300))"
_APART = "NOT EXISTS (FROM {taken} x WHERE x.doc_id = s.doc_id AND x.a < s.b AND s.a < x.b)"
_SCOPED = "SELECT s.*, coalesce((SELECT max(b) FROM blank x WHERE x.doc_id = s.doc_id AND x.b <= s.a), 0) AS low, coalesce((SELECT min(a) FROM blank x WHERE x.doc_id = s.doc_id AND x.a >= s.b), (SELECT length(t) FROM d WHERE d.doc_id = s.doc_id)) AS high"
ORACLE_SQL["op7_secret_scan"] = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
    strong AS MATERIALIZED ({_found('assign')} UNION ALL {_found('access')} UNION ALL {_found('hex')}),
    blank AS MATERIALIZED ({_found('blank')} AND doc_id IN (SELECT doc_id FROM strong UNION SELECT doc_id FROM ({_found('key')}))),
    k AS MATERIALIZED ({_SCOPED} FROM ({_found('key')}) s WHERE {_APART.format(taken='strong')}),
    taken AS (SELECT doc_id, a, b FROM strong UNION ALL SELECT doc_id, a, b FROM k),
    e AS MATERIALIZED ({_SCOPED} FROM ({_found('endpoint')}) s WHERE {_APART.format(taken='taken')} AND s.doc_id IN (SELECT doc_id FROM taken)),
    access AS (FROM strong WHERE kind = 'access'), hidden AS (SELECT doc_id, a FROM strong WHERE kind = 'assign' UNION ALL SELECT doc_id, a FROM k),
    f AS (SELECT doc_id, kind, a, b FROM strong
        UNION ALL SELECT doc_id, kind, a, b FROM k s WHERE {_NEAR.format(others='access')} OR {_NEAR.format(others='e')}
        UNION ALL SELECT doc_id, kind, a, b FROM e s WHERE {_NEAR.format(others='access')} OR {_NEAR.format(others='hidden')}),
    o AS (SELECT *, kind || ':' || a || ':' || b AS said, list_position(['assign', 'access', 'hex', 'key', 'endpoint'], kind) AS rk FROM f),
    g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(said, ',' ORDER BY a, rk, b) FILTER (rk <= 3) AS base, string_agg(said, ',' ORDER BY a, rk, b) AS spans FROM o GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (doc_id)"""
