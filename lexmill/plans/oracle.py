"""DuckDB SQL of the registered retrieval queries."""

from __future__ import annotations

from lexmill.functions import text as tx
from lexmill.functions import tokens as tk
from lexmill.operators import bm25, chunk, fusion, graph, lookup, select

from .queries import _SQL_CODE, HEADINGS, LINE_STARTS, QUESTIONS, STATUSES, TITLES, _sql_pick


def _code(key: str) -> str:
    return _SQL_CODE.format(k=f"({key})")


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _norm(text: str) -> str:
    return rf"trim(regexp_replace(coalesce({text}, ''), '\s+', ' ', 'g'))"


def _fold(text: str) -> str:
    return f"replace(strip_accents(lower({_norm(text)})), 'đ', 'd')"


def _chain(folded: str, cases: list[tuple[str, object]], other: str, quote: bool) -> str:
    """The same first-match chain as CASE; word bounds are spelt out."""
    branches = []
    for pattern, value in cases:
        hit = f"regexp_matches({folded}, '(^|[^a-z0-9_]){pattern[2:-2]}($|[^a-z0-9_])')" if "\\" in pattern else f"contains({folded}, '{pattern}')"
        branches.append(f"WHEN {hit} THEN " + (f"'{value}'" if quote else f"{value}::DOUBLE"))
    return f"CASE {' '.join(branches)} ELSE {other} END"


def _local(folded: str) -> str:
    return f"regexp_matches({folded}, '(^|[^a-z0-9_])" + tx.LOCAL_TITLE[2:-2] + "($|[^a-z0-9_])')"


_LONG_ID = r"(?i)\b\d{1,4}/\d{4}/[A-ZĐ0-9]+(?:-[A-ZĐ0-9]+)*\b"
_SHORT_ID = r"(?i)\b\d{1,4}/[A-ZĐ0-9]+(?:-[A-ZĐ0-9]+)+\b"
# the identifiers that the queries add end in ASCII letters, so RE2's word bounds do


def _legal_id(text: str) -> str:
    return f"replace(upper(coalesce(nullif(regexp_extract({_norm(text)}, '{_LONG_ID}'), ''), nullif(regexp_extract({_norm(text)}, '{_SHORT_ID}'), ''), '')), 'Ð', 'Đ')"


def _sorted_ids(text: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all({text}, '{_LONG_ID}')))"


def _strip(value: str, chars: str) -> str:
    return f"trim({value}, '{chars}')"


def _first_of_each(listed: str) -> str:
    """Distinct values in order of first appearance."""
    return f"list_filter({listed}, lambda x, i: list_position({listed}, x) = i)"


_INDEX_TOKENS = "list_filter(string_split_regex(lower(text), '[^a-z0-9{map}]+'), lambda x: x <> '')"
_TITLE, _HEADING, _QUESTION = (_sql_pick(v, "doc_id") for v in (TITLES, HEADINGS, QUESTIONS))
_LOOKUP_RAW = "list_filter(list_transform(string_split_regex(regexp_replace({text}, '[^a-z0-9%/.,-]+', ' ', 'g'), ' '), lambda x: trim(x, '.,-')), lambda x: length(x) >= 3 AND NOT list_contains(" + _list(tk.LOOKUP_STOP) + ", x))"


def index_list(text: str) -> str:
    """Index tokens by explicit folding of the letters that the tables hold."""
    source, target = tk._index_table()
    pairs = [(a, b) for a, b in zip(source, target, strict=True) if a != "'"]
    folded = f"lower(translate({text}, '{''.join(a for a, _ in pairs)}', '{''.join(b for _, b in pairs)}'))"
    return rf"list_filter(string_split_regex({folded}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def _search_terms(text: str) -> str:
    words = rf"regexp_extract_all({_norm(text)}, '[0-9A-Za-zÀ-ỹĐđ/\.-]+')"
    kept = f"list_filter({words}, lambda t: length(trim(lower(t), '.,;:/')) >= 2 AND NOT list_contains({_list(tk.SEARCH_STOP)}, trim(lower(t), '.,;:/')))"
    return f"(SELECT list_slice(list(t ORDER BY i), 1, 32) FROM (SELECT t, i, row_number() OVER (PARTITION BY trim(lower(t), '.,;:/') ORDER BY i) AS n FROM (SELECT unnest(k) AS t, generate_subscripts(k, 1) AS i FROM (SELECT {kept} AS k))) WHERE n = 1)"


_RANKING = "SELECT c_nationkey AS qid, 'D' || (o_custkey % 7) || '|' || (o_orderkey % 5) AS citation, 'D' || (o_custkey % 7) AS doc, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM orders JOIN customer ON o_custkey = c_custkey"
_VARIANTS = "SELECT * FROM (VALUES " + ", ".join(str(v) for v in select.VARIANTS) + ") v(variant, max_articles, max_docs, max_per_doc)"


def _capped(rows: str, distinct: bool) -> str:
    once = "QUALIFY row_number() OVER (PARTITION BY qid, citation ORDER BY pos) = 1" if distinct else ""
    return f"""SELECT qid, variant, art_no, citation, doc, max_articles FROM (
        SELECT *, row_number() OVER (PARTITION BY qid, variant ORDER BY pos)::INT AS art_no FROM (
            SELECT *, dense_rank() OVER (PARTITION BY qid ORDER BY doc_at) AS doc_no, row_number() OVER (PARTITION BY qid, doc ORDER BY pos) AS in_doc FROM (
                SELECT *, min(pos) OVER (PARTITION BY qid, doc) AS doc_at FROM (SELECT * FROM ({rows}) {once}))) CROSS JOIN ({_VARIANTS})
        WHERE doc_no <= max_docs AND in_doc <= max_per_doc) WHERE art_no <= max_articles"""


_CITATION = "CASE WHEN code = '' THEN title ELSE code || '|' || title END || '|' || 'Điều ' || article_no"
_LISTS = f"""
    WITH docs AS (SELECT lang AS qid, doc_id AS rowid, n_chars::DOUBLE AS score, {_code('doc_id // 3')} AS code, {_sql_pick(TITLES, '(doc_id // 3)')} AS title, (doc_id % 2)::VARCHAR AS article_no, {_sql_pick(HEADINGS, '(doc_id % 2)')} AS article_title, text FROM documents),
    cited AS (SELECT *, {_CITATION} AS citation FROM docs),
    lists AS (SELECT *, 0 AS list_no, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid) AS pos FROM cited QUALIFY pos <= 80
        UNION ALL SELECT *, 1 AS list_no, row_number() OVER (PARTITION BY qid ORDER BY rowid) AS pos FROM cited QUALIFY pos <= 60),
    fused AS (SELECT qid, citation, sum(1.0::DOUBLE / (60 + pos)) AS rrf, count(*) AS n_sources, arg_min(rowid, list_no * 1000 + pos) AS rowid, arg_min(title, list_no * 1000 + pos) AS title, arg_min(code, list_no * 1000 + pos) AS code, arg_min(article_no, list_no * 1000 + pos) AS article_no, arg_min(article_title, list_no * 1000 + pos) AS article_title, arg_min(text, list_no * 1000 + pos) AS text, min(list_no * 1000 + pos) AS first_at FROM lists GROUP BY qid, citation),
    asked AS (SELECT *, {_sql_pick(QUESTIONS, '(length(qid) + ascii(qid))')} AS question FROM fused),
    flags AS (SELECT *, {_chain(_fold("title"), tx.TYPE_BONUSES, '0.0', False)} AS bonus, {_local(_fold("title"))} AND NOT regexp_matches({_fold("question")}, '{tx.LOCAL_QUESTION}') AS off_local,
        regexp_matches({_fold("article_title")}, '{"|".join(tx.BOILERPLATE)}') AND NOT regexp_matches({_fold("question")}, '{tx.BOILERPLATE_QUESTION}') AS off_plate FROM asked),
    hybrid AS (SELECT *, round(rrf + bonus - CASE WHEN off_local THEN {fusion.LOCAL_PENALTY} ELSE 0 END::DOUBLE - CASE WHEN off_plate THEN {fusion.BOILERPLATE_PENALTY} ELSE 0 END::DOUBLE - CASE WHEN code = '' THEN {fusion.NO_ID_PENALTY} ELSE 0 END::DOUBLE, 12) AS hybrid FROM flags),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY hybrid DESC, first_at)::INT AS rank FROM hybrid QUALIFY rank <= 80)"""

ORACLE_SQL: dict[str, str] = {
    "norm_fold": f"SELECT doc_id, {_norm('text')} AS normal, {_fold('text')} AS folded FROM documents",
    "legal_ids": f"""WITH t AS (SELECT doc_id, 'theo ' || lower({_code('doc_id')}) || ' va ' || (doc_id % 50 + 1) || '/QH-' || (doc_id % 7) || ' cung ' || {_code('doc_id + 3')} || ' het ' || coalesce(text, '') AS t FROM documents)
        SELECT doc_id, {_legal_id('t')} AS legal_id, array_to_string({_sorted_ids('t')}, ',') AS all_ids FROM t""",
    "title_flags": f"""SELECT doc_id, {_chain(_fold(_TITLE), tx.DOC_TYPES, "''", True)} AS kind, {_chain(_fold(_TITLE), tx.TYPE_BONUSES, '0.0::DOUBLE', False)} AS bonus, {_local(_fold(_TITLE))} AS is_local,
        regexp_matches({_fold(_QUESTION)}, '{tx.LOCAL_QUESTION}') AS local_asked, regexp_matches({_fold(_HEADING)}, '{"|".join(tx.BOILERPLATE)}') AS plate, regexp_matches({_fold(_QUESTION)}, '{tx.BOILERPLATE_QUESTION}') AS plate_asked FROM documents""",
    "citation_keys": f"""WITH t AS (SELECT doc_id, {_code('doc_id')} AS code, {_TITLE} AS title, 'Điều ' || (doc_id % 9) AS label FROM documents)
        SELECT doc_id, CASE WHEN code = '' THEN left(sha1(title), 16) ELSE code END AS doc_key, CASE WHEN code = '' THEN title ELSE code || '|' || title END AS doc, CASE WHEN code = '' THEN title ELSE code || '|' || title END || '|' || label AS citation FROM t""",
    "file_names": f"""WITH t AS (SELECT doc_id, source, trim(regexp_replace(replace(strip_accents(lower(trim(text))), 'đ', 'd'), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM documents)
        SELECT doc_id, CASE WHEN trim(left(s, 120), '-') = '' THEN 'van-ban' ELSE trim(left(s, 120), '-') END AS slug, regexp_matches(source, '^[0-9]+$') AS numeric FROM t""",
    "tokens_lookup": f"WITH t AS (SELECT doc_id, {_LOOKUP_RAW.format(text='f')} AS k FROM (SELECT doc_id, replace({_fold('text')}, 'ð', 'd') AS f FROM documents)) SELECT doc_id, coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(k) AS x, generate_subscripts(k, 1) AS i) GROUP BY x ORDER BY i LIMIT 80)), '') AS tokens FROM t",
    "tokens_plan": f"WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(trim(regexp_replace(text, '[^0-9A-Za-zÀ-ỹ%/.-]+', ' ', 'g')), ' '), lambda w: lower(trim(w, '.,;:'))), lambda w: length(w) >= 3 AND NOT list_contains({_list(tk.PLAN_STOP)}, w)) AS k FROM documents) SELECT doc_id, coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(k) AS x, generate_subscripts(k, 1) AS i) GROUP BY x ORDER BY i LIMIT 40)), '') AS terms FROM t",
    "tokens_search": f"SELECT doc_id, coalesce(array_to_string({_search_terms('text')}, ' '), '') AS terms FROM documents",
    "doc_last_wins": f"WITH t AS (SELECT source, lang, n_chars, doc_id AS ord, {_sql_pick(STATUSES, 'doc_id')} AS status FROM documents) SELECT * FROM t WHERE NOT contains({_fold('status')}, 'het hieu luc') QUALIFY row_number() OVER (PARTITION BY source ORDER BY ord DESC) = 1",
    "dedupe_text_first": "SELECT sha1(text) AS hash, doc_id AS ord, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "dedupe_two_key": """WITH RECURSIVE r AS (SELECT doc_id AS ord, source || '|' || lang || '|' || (n_chars % 40) AS key, left(sha1(text), 2) || '|' || lang AS hash, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
        s(n, keys, hashes, ord, key, hash, kept) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], NULL::BIGINT, NULL::VARCHAR, NULL::VARCHAR, false
            UNION ALL SELECT r.n, CASE WHEN dup THEN keys ELSE list_append(keys, r.key) END, CASE WHEN dup THEN hashes ELSE list_append(hashes, r.hash) END, r.ord, r.key, r.hash, NOT dup
            FROM s JOIN r ON r.n = s.n + 1, LATERAL (SELECT list_contains(s.keys, r.key) OR list_contains(s.hashes, r.hash) AS dup))
        SELECT ord, key, hash FROM s WHERE kept""",
    "normalized_documents": f"""WITH t AS (SELECT doc_id, {_TITLE} || ' số ' || source AS title, {_code('doc_id')} AS code, {_sql_pick(STATUSES, 'doc_id')} AS status FROM documents)
        SELECT CASE WHEN code = '' THEN left(sha1(title), 16) ELSE code END AS doc_id, code AS legal_id, title, {_chain(_fold('title'), tx.DOC_TYPES, "''", True)} AS doc_type, 'http://x/' || doc_id AS url, status, 'vbpl' AS source, doc_id AS ord FROM t""",
    "bm25_topk": f"""WITH tok AS (SELECT doc_id AS rowid, unnest({index_list('text')}) AS token FROM documents), dl AS (SELECT doc_id AS rowid, len({index_list('text')}) AS dl FROM documents),
        tf AS (SELECT rowid, token, count(*) AS f FROM tok GROUP BY ALL), n AS (SELECT token, count(*) AS n FROM tf GROUP BY token),
        q AS (SELECT item_id AS qid, unnest({_search_terms('text')}) AS term FROM benchmark), qt AS (SELECT qid, list_filter(string_split_regex(lower(term), '[^a-z0-9ß-ÿ]+'), lambda x: x <> '') AS p, term FROM q),
        qk AS (SELECT qid, ({index_list('term')})[1] AS token, count(*) AS times FROM qt GROUP BY ALL HAVING token IS NOT NULL),
        s AS (SELECT qid, rowid, round(sum(times * greatest(idf0, CASE WHEN idf0 > 0 THEN idf0 ELSE {bm25.LEAST_IDF} END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / (SELECT avg(dl) FROM dl)))), 6) AS score
            FROM (SELECT *, ln(((SELECT count(*) FROM documents) - n + 0.5) / (n + 0.5)) AS idf0 FROM qk JOIN tf USING (token) JOIN n USING (token) JOIN dl USING (rowid)) GROUP BY qid, rowid)
        SELECT qid, rowid, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rowid)::INT AS rank FROM s QUALIFY rank <= 80""",
    "bm25_phrases": f"""WITH d AS (SELECT doc_id AS rowid, {index_list('text')} AS w FROM documents), p AS (SELECT rowid, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM d),
        q AS (SELECT DISTINCT w[i] AS a, w[i + 1] AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT {index_list('text')} AS w FROM benchmark)))
        SELECT a || ' ' || b AS key, x.rowid, count(*) AS f FROM q JOIN p x ON x.token = a JOIN p y ON y.token = b AND y.rowid = x.rowid AND y.pos = x.pos + 1 GROUP BY ALL""",
    "dense_topk": """WITH s AS (SELECT q.vec_id AS qid, v.vec_id, round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0)
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id)::INT AS rank FROM s QUALIFY rank <= 60""",
    "hybrid_rrf": _LISTS + " SELECT qid, citation, rowid, round(rrf, 9) AS rrf, round(hybrid, 9) AS hybrid, n_sources, rank FROM ranked",
    "rerank_adjust": _LISTS + f""", texts AS (SELECT *, length(title || chr(10) || 'Điều ' || article_no || chr(10) || article_title || chr(10) || left(text, {fusion.RERANK_CHARS})) / 10000.0::DOUBLE AS score FROM ranked),
        fin AS (SELECT *, round(score + bonus - CASE WHEN off_local THEN {fusion.RERANK_LOCAL} ELSE 0 END::DOUBLE - CASE WHEN off_plate THEN {fusion.RERANK_BOILERPLATE} ELSE 0 END::DOUBLE, 12) AS final FROM texts)
        SELECT qid, citation, round(score, 9) AS score, round(final, 9) AS final, row_number() OVER (PARTITION BY qid ORDER BY final DESC, rank)::INT AS final_rank FROM fin""",
    "capped_select_variants": f"SELECT qid, variant, art_no, citation, doc FROM ({_capped(_RANKING, True)})",
    "evidence_caps": f"SELECT qid, variant, art_no, citation, doc FROM ({_capped(_RANKING, False)})",
    "context_blocks": _LISTS + """, items AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS n FROM ranked QUALIFY n <= 5)
        SELECT qid, string_agg('[A' || n || ']' || chr(10) || 'CITATION: ' || citation || chr(10) || 'TÊN VĂN BẢN: ' || title || chr(10) || 'TÊN ĐIỀU: Điều ' || article_no || ' ' || article_title || chr(10) || 'NỘI DUNG: ' || left(""" + _norm("text") + """, 1000), chr(10) || chr(10) ORDER BY n) AS context FROM items GROUP BY qid""",
    "rule_plan": f"""WITH q AS (SELECT item_id AS qid, text || ' ' || {_code('item_id')} AS question FROM benchmark), h AS (SELECT doc_id % 50 AS qid, arg_max(lang, doc_id) AS e, arg_max({_norm("source || ' ' || " + _code('doc_id'))}, doc_id) AS a FROM documents GROUP BY 1),
        j AS (SELECT q.qid, question, coalesce(e, '') AS e, coalesce(a, '') AS a FROM q LEFT JOIN h USING (qid)),
        t AS (SELECT *, list_filter(list_transform(string_split(trim(regexp_replace(question, '[^0-9A-Za-zÀ-ỹ%/.-]+', ' ', 'g')), ' '), lambda w: lower(trim(w, '.,;:'))), lambda w: length(w) >= 3 AND NOT list_contains({_list(tk.PLAN_STOP)}, w)) AS k FROM j)
        SELECT qid, array_to_string(list_filter([question, e, a], lambda x: x <> ''), '|') AS queries, coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(k) AS x, generate_subscripts(k, 1) AS i) GROUP BY x ORDER BY i LIMIT 24)), '') AS terms,
            array_to_string({_sorted_ids("question || ' ' || a")}, ',') AS codes, a AS hyde_answer FROM t""",
    "graph_nodes": f"""SELECT {_code('doc_id // 2')} AS legal_id, (doc_id % 3)::VARCHAR AS article_no, {_TITLE} AS title, source, doc_id::VARCHAR AS doc_id, lang AS article_title, documents.doc_id AS ord FROM documents WHERE {_code('documents.doc_id // 2')} <> ''
        QUALIFY row_number() OVER (PARTITION BY {_code('documents.doc_id // 2')}, documents.doc_id % 3, {_sql_pick(TITLES, 'documents.doc_id')} ORDER BY documents.doc_id) = 1""",
    "graph_edges": f"""WITH c AS (SELECT doc_id, {_code('doc_id // 2')} AS own, 'theo ' || {_code('doc_id')} || ' va ' || lower({_code('doc_id * 3 + 1')}) || ' ' || lang || ' ' || coalesce(text, '') AS text FROM documents)
        SELECT own AS src_legal_id, (doc_id % 3)::VARCHAR AS src_article_no, upper(code) AS dst_legal_id, 'mentions_legal_id' AS relation, doc_id AS src_chunk_id FROM (SELECT *, unnest({_sorted_ids('text')}) AS code FROM c) WHERE own <> '' AND upper(code) <> upper(own)""",
    "row_filters": f"""SELECT doc_id, {_sql_pick(STATUSES, 'doc_id')} AS status, lang AS answer FROM documents WHERE NOT contains({_fold(_sql_pick(STATUSES, 'doc_id'))}, 'het hieu luc') AND length(text) >= 80 AND doc_id % 11 <> 0""",
    "resume_pending": "SELECT doc_id AS qid, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'done' ELSE 'pending' END AS state FROM documents",
    "url_extract": r"""SELECT DISTINCT regexp_replace(u, '[).,;]+$', '') AS url FROM (SELECT unnest(regexp_extract_all(url, 'https?://[^\s"''<>]+') || regexp_extract_all(html, 'https?://[^\s"''<>]+')) AS u FROM pages)""",
    "json_props": "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events",
    "unique_keys": "WITH n AS (SELECT doc_id, source || '_' || lang AS base, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents) SELECT doc_id, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS key FROM n",
    "daily_events": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS events FROM events GROUP BY ALL",
    "relation_enrich": f"""WITH a AS (SELECT source AS doc_id, doc_id::VARCHAR AS article_no, {_sorted_ids("'theo ' || " + _code('documents.doc_id % 60') + " || ' va ' || " + _code('documents.doc_id % 45 + 1') + " || ' ' || coalesce(documents.text, '')")} AS codes FROM documents),
        cited AS (SELECT DISTINCT doc_id, article_no, upper(replace(strip_accents(lower(c)), 'đ', 'd')) AS n FROM (SELECT doc_id, article_no, unnest(codes) AS c FROM a) WHERE c <> ''),
        r AS (SELECT source AS doc_id, (doc_id % 20)::VARCHAR AS kind, doc_id::VARCHAR AS id, upper(replace(strip_accents(lower({_code('documents.doc_id % 60')})), 'đ', 'd')) AS n FROM documents)
        SELECT doc_id, article_no, coalesce(map {{{', '.join(f"'{k}': '{v}'" for k, v in graph.RELATIONS.items())}}}[kind], kind) AS quan_he, id, n AS matched_so_hieu, 'http://host/--' || id AS url FROM cited JOIN r USING (doc_id, n) WHERE n <> ''""",
}

_EVIDENCE = "SELECT n_nationkey AS qid, unnest([1, 2, 3, 4, 5, 6]) AS pos, unnest(['a|b|1', 'a|b|2', 'a|b|3', 'c|d|1', 'e|f|1', 'g|h|1']) AS citation, unnest(['a|b', 'a|b', 'a|b', 'c|d', 'e|f', 'g|h']) AS doc FROM nation WHERE n_nationkey % 3 = 1"


def _lists(rows: str) -> str:
    return f"SELECT qid, variant, string_agg(citation, ';' ORDER BY art_no) AS articles, count(*) AS n_articles, (SELECT string_agg(d, ';' ORDER BY m) FROM (SELECT d, min(i) AS m FROM (SELECT unnest(list(doc ORDER BY art_no)) AS d, generate_subscripts(list(doc ORDER BY art_no), 1) AS i) GROUP BY d)) AS docs, count(DISTINCT doc) AS n_docs FROM ({rows}) GROUP BY qid, variant"


_ASSEMBLY = f"""WITH e AS ({_lists(_capped(_EVIDENCE, False))}), k AS ({_lists(_capped(_RANKING, True))}),
    a AS (SELECT v.variant, n_nationkey AS qid, n_name AS question, CASE WHEN n_nationkey % 3 <> 0 THEN 'answer ' || n_name ELSE '' END AS answer, coalesce(e.docs, k.docs, '') AS docs, coalesce(e.articles, k.articles, '') AS articles, coalesce(e.n_docs, k.n_docs, 0) AS nd, coalesce(e.n_articles, k.n_articles, 0) AS na
        FROM nation CROSS JOIN ({_VARIANTS}) v LEFT JOIN e ON e.qid = n_nationkey AND e.variant = v.variant LEFT JOIN k ON k.qid = n_nationkey AND k.variant = v.variant)"""

def _lookup_tokens(text: str, limit: int) -> str:
    k = _LOOKUP_RAW.format(text=f"replace({_fold(text)}, 'ð', 'd')")
    return f"(SELECT list_slice(list(x ORDER BY i), 1, {limit}) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(k) AS x, generate_subscripts(k, 1) AS i FROM (SELECT {k} AS k)) GROUP BY x))"


ORACLE_SQL["answer_lookup"] = f"""
    WITH c AS (SELECT conv_id AS id, coalesce(max({_norm('text')}) FILTER (turn = 0), '') AS question, coalesce(max({_norm('text')}) FILTER (turn = 1), '') AS answer FROM conversations GROUP BY conv_id),
    r AS (SELECT *, lower(question) AS exact, coalesce({_lookup_tokens("question || ' ' || answer", lookup.ROW_TOKENS)}, []) AS tokens FROM c),
    q AS (SELECT item_id AS qid, {_norm('text')} AS query FROM benchmark UNION ALL
        SELECT id + 1000000, translate(question, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') FROM c WHERE question <> ''),
    a AS (SELECT *, lower(query) AS exact, coalesce({_lookup_tokens('query', lookup.QUERY_TOKENS)}, []) AS tokens FROM q),
    s AS (SELECT qid, id, answer, CASE WHEN a.exact = r.exact THEN 1.0::DOUBLE ELSE len(list_intersect(a.tokens, r.tokens))::DOUBLE / greatest(1, len(a.tokens)) END AS score FROM a, r),
    t AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)::INT AS rank FROM s QUALIFY rank <= 5)
    SELECT qid, rank, id, round(score, {lookup.DIGITS}) AS score, left(answer, {lookup.HEAD_CHARS}) AS answer_head FROM t"""
_CHAPTER_RE, _SECTION_RE, _ARTICLE_RE = r"(?i)^Chương\s+([IVXLCDM]+|\d+)\b", r"(?i)^Mục\s+\d+\b", r"(?i)^Điều\s+(\d+[a-zA-Z]?)\.?\s*(.*)"
ORACLE_SQL["text_units"] = rf"""
    WITH d AS (SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) - 1 AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)),
    l AS (SELECT * FROM (SELECT doc_id, i AS pos, {_norm("CASE WHEN doc_id % 5 = 0 THEN '' ELSE " + _sql_pick(LINE_STARTS, '(doc_id * 7 + i * (doc_id % 3 + 1))') + " END || line")} AS t FROM d) WHERE t <> ''),
    f AS (SELECT *, regexp_matches(t, '{_CHAPTER_RE}') AS ch, NOT ch AND regexp_matches(t, '{_SECTION_RE}') AS se, NOT ch AND NOT se AND regexp_matches(t, '{_ARTICLE_RE}') AS st FROM l),
    g AS (SELECT *, sum(st::INT) OVER w AS unit, last_value(CASE WHEN ch THEN t END IGNORE NULLS) OVER w AS chapter, last_value(CASE WHEN se THEN t END IGNORE NULLS) OVER w AS section, max(st::INT) OVER (PARTITION BY doc_id) AS has
        FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    b AS (SELECT *, sum((NOT st AND regexp_matches(t, '^(\d+)\.\s+'))::INT) OVER (PARTITION BY doc_id, unit ORDER BY pos ROWS UNBOUNDED PRECEDING) AS clause, NOT st AND regexp_matches(t, '^(\d+)\.\s+') AS cl FROM g WHERE unit > 0 AND NOT ch AND NOT se),
    c AS (SELECT doc_id, unit, clause, max(CASE WHEN cl THEN regexp_extract(t, '^(\d+)\.', 1) END) AS no, coalesce(string_agg(t, chr(10) ORDER BY pos) FILTER (NOT p), '') AS body, coalesce(string_agg(lower(left(t, 1)) || '=' || t, '+' ORDER BY pos) FILTER (p), '') AS points
        FROM (SELECT *, NOT cl AND regexp_matches(t, '^([a-zA-ZđĐ])\)\s+') AS p FROM b WHERE clause > 0 AND NOT st) GROUP BY doc_id, unit, clause),
    k AS (SELECT doc_id, unit, count(*) AS n, string_agg(no || '~' || body || '~' || points, '|' ORDER BY clause) AS s FROM c GROUP BY doc_id, unit),
    u AS (SELECT doc_id, unit, string_agg(t, chr(10) ORDER BY pos) AS body, arg_min(t, pos) AS head, arg_min(coalesce(chapter, ''), pos) AS chapter, arg_min(coalesce(section, ''), pos) AS section FROM b GROUP BY doc_id, unit)
    SELECT doc_id, (unit - 1)::INT AS pos, 'article' AS chunk_level, regexp_extract(head, '{_ARTICLE_RE}', 1) AS article_no, trim(regexp_extract(head, '{_ARTICLE_RE}', 2)) AS article_title, nullif(chapter, '') AS chapter, nullif(section, '') AS section, sha1(body) AS text_sha1, coalesce(n, 0)::BIGINT AS n_clauses, sha1(coalesce(s, '')) AS clauses_sha1
    FROM u LEFT JOIN k USING (doc_id, unit)
    UNION ALL SELECT doc_id, 0, 'full_text', 'toan_van', 'Toàn văn', NULL, NULL, sha1(string_agg(t, chr(10) ORDER BY pos)), 0, sha1('') FROM g WHERE has = 0 GROUP BY doc_id"""
_MARK = "chr(57344)"  # private use, in no text


def _paragraphs(text: str) -> str:
    """Cut after a full stop before "1." or "a)"; RE2 has no lookarounds, so cuts are marked, every second one in a second pass."""
    once = r"regexp_replace({0}, '\.\s+(\d+\.|[a-z]\))', '.' || chr(57344) || '\1', 'g')"
    return f"list_filter(list_transform(string_split({once.format(once.format(text))}, {_MARK}), lambda p: trim(p)), lambda p: p <> '')"


def _pieces(text: str) -> str:
    """Paragraphs packed up to the target with one of overlap, as a fold over (out, cur, n)."""
    flush = "{{'o': list_append({0}.o, array_to_string({0}.c, ' ')), 'c': [{0}.c[-1]], 'n': length({0}.c[-1]) + 1}}"
    start = "[{'o': []::VARCHAR[], 'c': []::VARCHAR[], 'n': 0::BIGINT}]"
    each = f"list_transform({_paragraphs(text)}, lambda p: {{'o': []::VARCHAR[], 'c': [p], 'n': 0::BIGINT}})"
    room = f"CASE WHEN len(a.c) > 0 AND a.n + length(x.c[1]) + 1 > {chunk.TARGET_CHARS} THEN {flush.format('a')} ELSE a END"
    put = "{'o': r.o, 'c': list_append(r.c, x.c[1]), 'n': r.n + length(x.c[1]) + 1}"
    step = f"list_transform(list_transform([{room}], lambda r: {put}), lambda q: CASE WHEN q.n >= {chunk.MAX_CHARS} THEN {flush.format('q')} ELSE q END)[1]"
    done = f"list_transform([list_reduce({start} || {each}, lambda a, x: {step})], lambda s: CASE WHEN len(s.c) > 0 THEN list_append(s.o, array_to_string(s.c, ' ')) ELSE s.o END)[1]"
    return f"CASE WHEN length({text}) <= {chunk.MAX_CHARS} THEN [{text}] ELSE {done} END"


_HEADING_RE = r"(?i)Điều\s+([0-9]+[a-zA-Z]?|toan_van)\.?\s+([^\n]{0,180})"
ORACLE_SQL["chunk_pack"] = f"""
    WITH t AS (SELECT doc_id, source, {_code('doc_id')} AS legal_id, {_sql_pick(TITLES, 'doc_id')} AS title, (doc_id % 20)::VARCHAR AS article_no, {_sql_pick(HEADINGS, 'doc_id')} AS article_title,
            {_norm(r"replace(regexp_replace(text, '\s+', ' ', 'g'), '. ', '. 1. ')")} AS text FROM documents),
    p AS (SELECT *, unnest(k) AS piece, generate_subscripts(k, 1) - 1 AS idx FROM (SELECT *, {_pieces('text')} AS k FROM t))
    SELECT 'vbpl:' || CASE WHEN legal_id = '' THEN left(sha1(title), 16) ELSE legal_id END || ':article:' || article_no || ':chunk:' || idx AS chunk_id, source, doc_id::VARCHAR AS doc_id, legal_id, '' AS doc_type, title, article_no,
        'Điều ' || article_no AS article_label, article_title, '' AS url, piece AS text, doc_id AS ord, idx::INT AS idx
    FROM p WHERE length(piece) >= {chunk.MIN_CHARS} QUALIFY row_number() OVER (PARTITION BY piece ORDER BY doc_id, idx) = 1"""
ORACLE_SQL["article_split"] = f"""
    WITH t AS (SELECT doc_id, {_norm("'Mở đầu. Điều 1. ' || text || ' Điều 2a Phạm vi. ' || substr(text, 1, 200) || ' điều 3. hết'")} AS text FROM documents),
    p AS (SELECT doc_id, string_split(regexp_replace(text, '({_HEADING_RE})', {_MARK} || '\\1', 'g'), {_MARK})[2:] AS k FROM t),
    a AS (SELECT doc_id, unnest(k) AS part, generate_subscripts(k, 1) - 1 AS article_pos FROM p)
    SELECT doc_id, article_pos::INT AS article_pos, regexp_extract(part, '{_HEADING_RE}', 1) AS article_no, {_norm(f"regexp_extract(part, '{_HEADING_RE}', 2)")} AS article_title, {_norm('part')} AS text FROM a"""
_STATUS_SQL = f"contains({_fold(_sql_pick(STATUSES, 'doc_id'))}, 'het hieu luc')"
ORACLE_SQL["stage_counters"] = f"""
    WITH n AS ({ORACLE_SQL["normalized_documents"]}), c AS ({ORACLE_SQL["chunk_pack"]}),
    t AS (SELECT {_norm(r"replace(regexp_replace(text, '\s+', ' ', 'g'), '. ', '. 1. ')")} AS text FROM documents),
    p AS (SELECT unnest(k) AS piece FROM (SELECT {_pieces('text')} AS k FROM t)), e AS (SELECT doc_id, NOT {_STATUS_SQL} AS alive FROM documents)
    SELECT 'rows_read' AS counter, count(*) AS n FROM documents UNION ALL SELECT 'titled', count(*) FROM n UNION ALL SELECT 'live', count(*) FILTER (alive) FROM e
    UNION ALL SELECT 'documents', count(DISTINCT n.doc_id) FROM n JOIN e ON e.doc_id = n.ord WHERE alive
    UNION ALL SELECT 'pieces', count(*) FROM p UNION ALL SELECT 'long_pieces', count(*) FROM p WHERE length(piece) >= {chunk.MIN_CHARS} UNION ALL SELECT 'chunks', count(*) FROM c"""
ORACLE_SQL["dedupe_two_key_stream"] = ORACLE_SQL["dedupe_two_key"]
ORACLE_SQL["keyword_search_stored"] = ORACLE_SQL["bm25_topk"]
ORACLE_SQL["result_assembly"] = _ASSEMBLY + " SELECT variant, qid, question, answer, docs, articles FROM a"
ORACLE_SQL["variant_summary"] = _ASSEMBLY + " SELECT variant, min(na)::INT AS min_articles, round(avg(na), 3) AS avg_articles, max(na)::INT AS max_articles, min(nd)::INT AS min_docs, round(avg(nd), 3) AS avg_docs, max(nd)::INT AS max_docs, 0::BIGINT AS bad_answers FROM a GROUP BY variant"


def result_package(least: float) -> str:
    """Keyword ranking under the caps of each variant, with the nearest stored answer of at least this score."""
    ranking = f"SELECT qid, coalesce(source, '') || '|' || doc_id AS citation, coalesce(source, '') AS doc, rank AS pos FROM ({ORACLE_SQL['bm25_topk']}) JOIN documents ON doc_id = rowid"
    return f"""WITH k AS ({_lists(_capped(ranking, True))}), l AS (SELECT qid, answer_head FROM ({ORACLE_SQL['answer_lookup']}) WHERE rank = 1 AND score >= {least} AND qid < 1000000)
        SELECT v.variant, item_id AS qid, text AS question, coalesce({_norm('answer_head')}, '') AS answer, coalesce(k.docs, '') AS docs, coalesce(k.articles, '') AS articles
        FROM benchmark CROSS JOIN ({_VARIANTS}) v LEFT JOIN k ON k.qid = item_id AND k.variant = v.variant LEFT JOIN l ON l.qid = item_id"""
