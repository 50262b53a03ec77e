"""DuckDB oracle SQL for every catalog query (same names, same columns).

The SQL is written from the definitions, not from the Spark plans:
stemming is the SQL Porter expression (``porter_sql``), phrase matching is
checked directly ("every word i at start + i") instead of by position votes,
scores use dot / (|d| * |q|) instead of pre-normalised weights, and the crawl
order comes from recursive CTEs over shortest paths. Tables ``documents``,
``pages``, ``events`` and ``benchmark`` are views registered by the driver.
"""

from __future__ import annotations

from html.entities import html5

from quarry.plans.porter_sql import porter_sql
from quarry.sources.stopwords import read_stopword_lines


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Written here again, for the SQL engine's own regex dialect; nothing is shared with the Spark expressions.
PAT = _q(r"[\p{L}\p{N}_]+(?:'+[\p{L}\p{N}_]+)*")
BLOCKS_PATTERN = r"(?is)<!--.*?(-->|\z)|<script\b[^>]*>.*?(</script\s*>|\z)|<style\b[^>]*>.*?(</style\s*>|\z)|<template\b[^>]*>.*?(</template\s*>|\z)"
TAG_PATTERN = r"""(?is)</?[a-z]("[^"]*"|'[^']*'|[^"'>])*>|<[!?][^>]*>"""
TITLE_PATTERN = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
ANCHOR_PATTERN = r"""(?is)<a[\s/](?:"[^"]*"|'[^']*'|[^"'>])*>"""
HREF_PATTERN = r"""(?is)[\s/"']href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
REF_PATTERN = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
TOP_K = 50
CRAWL_BUDGET = 75


def _references() -> str:
    return "MAP {" + ", ".join(f"{_q('&' + k)}: {_q(v)}" for k, v in html5.items()) + "}"


def _unescape(x: str) -> str:
    """Numbers by code point, names by table (a name without ``;`` only whole), one pass."""
    code = (
        "CASE WHEN regexp_matches(r, '^&#[xX]') THEN chr(CAST('0x' || regexp_extract(r, '[xX]([0-9a-fA-F]+)', 1) AS INTEGER)) "
        "WHEN starts_with(r, '&#') THEN chr(CAST(regexp_extract(r, '[0-9]+') AS INTEGER)) "
        f"WHEN r = '&amp;' THEN '&' ELSE coalesce({_references()}[r], r) END"
    )
    parts = f"string_split_regex({x}, {_q(REF_PATTERN)})"
    refs = f"list_transform(regexp_extract_all({x}, {_q(REF_PATTERN)}, 0), lambda r: {code})"
    joined = f"array_to_string(list_transform(list_zip({parts}, {refs}), lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '')"
    return f"(CASE WHEN contains({x}, '&') THEN {joined} ELSE {x} END)"


def _visible(html: str) -> str:
    return f"regexp_replace(coalesce({html}, ''), {_q(BLOCKS_PATTERN)}, ' ', 'g')"


def _title(html: str) -> str:
    return _unescape(f"regexp_extract({_visible(html)}, {_q(TITLE_PATTERN)}, 1)")


def _body(html: str) -> str:
    text = _unescape(f"regexp_replace({_visible(html)}, {_q(TAG_PATTERN)}, ' ', 'g')")
    return f"trim(regexp_replace({text}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


def _hrefs(html: str) -> str:
    tags = f"regexp_extract_all({_visible(html)}, {_q(ANCHOR_PATTERN)})"
    raw = f"list_transform({tags}, lambda t: regexp_replace(regexp_extract(t, {_q(HREF_PATTERN)}, 1), '^([\"'']?)(.*?)[\"'']?$', '\\2'))"
    cleaned = f"list_transform({raw}, lambda h: regexp_replace({_unescape('h')}, '^\\s+|\\s+$', '', 'g'))"
    return f"list_filter({cleaned}, lambda h: h <> '' AND NOT starts_with(h, 'javascript:'))"


def _stop_values() -> str:
    return ", ".join(f"({_q(w)})" for w in read_stopword_lines())


# ---------------------------------------------------------------------------
# CTE blocks
# ---------------------------------------------------------------------------

DOCS = f"""docs AS (
  SELECT CAST(doc_id AS BIGINT) AS page_id,
         'doc://' || coalesce(source, '') || '/' || CAST(doc_id AS VARCHAR) AS url,
         array_to_string(regexp_extract_all(split_part(coalesce(text, ''), chr(10), 1), {PAT}), ' ') AS title,
         coalesce(text, '') AS body,
         '' AS last_modified,
         CAST(strlen(coalesce(text, '')) AS BIGINT) AS size,
         CAST(doc_id AS BIGINT) AS page_order
  FROM documents)"""

BENCH_QUERIES = f"""bt0 AS (SELECT item_id, regexp_extract_all(coalesce(text, ''), {PAT}) AS t FROM benchmark),
bq AS (
  SELECT CAST(item_id * 10 AS BIGINT) AS query_id, coalesce(text, '') AS query FROM benchmark
  UNION ALL
  SELECT CAST(item_id * 10 + 1 AS BIGINT),
         array_to_string(list_concat(list_transform(range(1, len(t)), lambda i: '"' || t[i] || ' ' || t[i + 1] || '"'), t[-1:]), ' ')
  FROM bt0
  UNION ALL
  SELECT CAST(item_id * 10 + 2 AS BIGINT),
         array_to_string(list_transform(range(1, len(t) - 1), lambda i: '"' || t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || '"'), ' ')
  FROM bt0)"""


def crawl_ctes(max_pages: int | None = None) -> str:
    """pg_raw (page snapshot), edges, tree(page_id, depth, parent_id, visit_order)."""
    return f"""np AS (SELECT count(*) AS n FROM pages),
edges AS (
  SELECT CAST(page_id AS BIGINT) AS parent_id,
         unnest([0, 1, 2, 3]) AS link_pos,
         unnest([3 * page_id + 1, 3 * page_id + 2, (5 * page_id + 7) % (SELECT n FROM np), 3 * page_id + 3]) AS child_id
  FROM pages),
live AS (SELECT * FROM edges WHERE child_id IN (SELECT page_id FROM pages)),
reach AS (
  WITH RECURSIVE r(node, depth) AS (
    SELECT CAST(0 AS BIGINT), 0 WHERE 0 IN (SELECT page_id FROM pages)
    UNION
    SELECT l.child_id, r.depth + 1 FROM r JOIN live l ON l.parent_id = r.node
    WHERE r.depth < (SELECT n FROM np))
  SELECT node, min(depth) AS depth FROM r GROUP BY node),
sp AS (
  WITH RECURSIVE s(node, depth, path) AS (
    SELECT node, depth, CAST([] AS INTEGER[]) FROM reach WHERE depth = 0
    UNION ALL
    SELECT l.child_id, s.depth + 1, list_append(s.path, CAST(l.link_pos AS INTEGER))
    FROM s JOIN live l ON l.parent_id = s.node
    JOIN reach rc ON rc.node = l.child_id AND rc.depth = s.depth + 1)
  SELECT node AS page_id, depth, min(path) AS path FROM s GROUP BY node, depth),
tree AS (
  SELECT b.page_id, b.depth, p.page_id AS parent_id,
         row_number() OVER (ORDER BY b.depth, b.path) AS visit_order
  FROM sp b LEFT JOIN sp p ON p.depth = b.depth - 1 AND p.path = b.path[1:len(b.path) - 1]
  {f"QUALIFY visit_order <= {max_pages}" if max_pages else ""}),
pg AS (
  SELECT CAST(p.page_id AS BIGINT) AS page_id, p.url, {_title('p.html')} AS title, {_body('p.html')} AS body,
         '' AS last_modified, CAST(strlen(coalesce(p.html, '')) AS BIGINT) AS size, t.visit_order AS page_order
  FROM pages p JOIN tree t ON t.page_id = p.page_id),
plinks AS (
  SELECT t.page_id, coalesce(string_agg(pp.url, ', ' ORDER BY pp.url), 'None') AS parent_links
  FROM tree t LEFT JOIN tree e ON e.page_id = t.page_id AND e.parent_id IS NOT NULL
  LEFT JOIN pages pp ON pp.page_id = e.parent_id
  GROUP BY t.page_id),
clinks AS (
  SELECT t.page_id, coalesce(string_agg(c.url, ',' || chr(10) ORDER BY c.visit_order), 'None') AS child_links
  FROM tree t LEFT JOIN (
    SELECT k.parent_id, k.visit_order, pc.url,
           row_number() OVER (PARTITION BY k.parent_id ORDER BY k.visit_order) AS r
    FROM tree k JOIN pages pc ON pc.page_id = k.page_id WHERE k.parent_id IS NOT NULL) c
    ON c.parent_id = t.page_id AND c.r <= 10
  GROUP BY t.page_id)"""


def index_ctes(p: str, corpus: str) -> str:
    """Index over corpus CTE ``corpus``; every CTE is prefixed with ``p``."""
    stem = porter_sql("w")
    return f"""{p}ftok AS (
  SELECT page_id, 'body' AS field, 0 AS field_order, regexp_extract_all(body, {PAT}) AS toks FROM {corpus}
  UNION ALL
  SELECT page_id, 'title', 1, regexp_extract_all(title, {PAT}) FROM {corpus}),
{p}tok AS (SELECT page_id, field, field_order, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM {p}ftok),
{p}stems AS (SELECT w, {stem} AS s FROM (SELECT DISTINCT lower(tok) AS w FROM {p}tok)),
{p}stops AS (SELECT DISTINCT {stem} AS s FROM (VALUES {_stop_values()}) t(w)),
{p}kt AS (
  SELECT t.page_id, t.field, t.field_order, t.pos, st.s AS term
  FROM {p}tok t JOIN {p}stems st ON lower(t.tok) = st.w
  WHERE st.s NOT IN (SELECT s FROM {p}stops)),
{p}wide AS (
  SELECT page_id, term,
         count(*) FILTER (WHERE field = 'body') AS body_tf,
         count(*) FILTER (WHERE field = 'title') AS title_tf,
         coalesce(list(pos ORDER BY pos) FILTER (WHERE field = 'body'), []) AS body_positions,
         coalesce(list(pos ORDER BY pos) FILTER (WHERE field = 'title'), []) AS title_positions
  FROM {p}kt GROUP BY page_id, term),
{p}tdf AS (
  SELECT term, count(*) FILTER (WHERE body_tf > 0) AS body_df, count(*) FILTER (WHERE title_tf > 0) AS title_df
  FROM {p}wide GROUP BY term),
{p}mx AS (
  SELECT c.page_id, coalesce(max(w.body_tf), 0) AS body_maxtf, coalesce(max(w.title_tf), 0) AS title_maxtf
  FROM {corpus} c LEFT JOIN {p}wide w ON w.page_id = c.page_id GROUP BY c.page_id),
{p}nd AS (SELECT count(*) AS n FROM {corpus}),
{p}dw AS (
  SELECT w.page_id, w.term,
         (w.body_tf + 2.0 * w.title_tf) * ln((SELECT n FROM {p}nd) / (t.body_df + t.title_df))
           / greatest(CAST(m.body_maxtf AS DOUBLE), 2.0 * m.title_maxtf, 1.0) AS weight
  FROM {p}wide w JOIN {p}tdf t ON t.term = w.term JOIN {p}mx m ON m.page_id = w.page_id),
{p}dn AS (SELECT page_id, sqrt(sum(weight * weight)) AS norm FROM {p}dw GROUP BY page_id),
{p}vocab AS (
  SELECT term, row_number() OVER (ORDER BY k, term) AS word_id
  FROM (SELECT t.term, min([c.page_order, t.field_order, t.pos]) AS k
        FROM {p}kt t JOIN {corpus} c ON c.page_id = t.page_id GROUP BY t.term)),
{p}kw AS (
  SELECT page_id, term, total, r FROM (
    SELECT page_id, term, total, row_number() OVER (PARTITION BY page_id ORDER BY total DESC, word_id) AS r
    FROM (
      SELECT w.page_id, w.term, w.body_tf + w.title_tf AS total, v.word_id
      FROM {p}wide w JOIN {p}vocab v ON v.term = w.term
      UNION ALL
      SELECT c.page_id, f.term, 0, f.word_id
      FROM {corpus} c, (SELECT term, word_id FROM {p}vocab ORDER BY word_id LIMIT 5) f
      WHERE NOT EXISTS (SELECT 1 FROM {p}wide w WHERE w.page_id = c.page_id AND w.term = f.term)))
  WHERE r <= 5),
{p}kwtext AS (
  SELECT c.page_id, coalesce(string_agg(k.term || '(' || CAST(k.total AS VARCHAR) || ')', '; ' ORDER BY k.r), 'None') AS keywords
  FROM {corpus} c LEFT JOIN {p}kw k ON k.page_id = c.page_id GROUP BY c.page_id)"""


def search_ctes(p: str, queries: str, s: str = "") -> str:
    """Parse ``queries(query_id, query)`` and rank against index ``p``;
    CTEs are prefixed with ``p + s``."""
    ps = p + s
    stem = porter_sql("w")
    return f"""{ps}qparts AS (
  SELECT query_id, -1 AS phrase_idx, regexp_extract_all(regexp_replace(query, '"[^"]+"', '', 'g'), {PAT}) AS toks FROM {queries}
  UNION ALL
  SELECT query_id, phrase_idx, regexp_extract_all(ph, {PAT}) FROM (
    SELECT query_id, unnest(regexp_extract_all(query, '"([^"]+)"', 1)) AS ph,
           unnest(range(len(regexp_extract_all(query, '"([^"]+)"', 1)))) AS phrase_idx
    FROM {queries})),
{ps}qtok AS (SELECT query_id, phrase_idx, unnest(toks) AS tok, unnest(range(len(toks))) AS i FROM {ps}qparts),
{ps}qstems AS (SELECT w, {stem} AS s FROM (SELECT DISTINCT lower(tok) AS w FROM {ps}qtok)),
{ps}qt AS (SELECT q.query_id, q.phrase_idx, q.i, st.s AS term FROM {ps}qtok q JOIN {ps}qstems st ON lower(q.tok) = st.w),
{ps}qfree AS (SELECT DISTINCT query_id, term FROM {ps}qt WHERE phrase_idx = -1),
{ps}qphr AS (SELECT query_id, phrase_idx, i, term FROM {ps}qt WHERE phrase_idx >= 0),
{ps}qk AS (
  SELECT query_id, key, bool_or(is_free) AS is_free FROM (
    SELECT query_id, term AS key, true AS is_free FROM {ps}qfree
    UNION ALL
    SELECT query_id, string_agg(term, ' ' ORDER BY i), false FROM {ps}qphr GROUP BY query_id, phrase_idx)
  GROUP BY query_id, key),
{ps}qv AS (
  SELECT query_id, key, df, ln((SELECT n FROM {p}nd) / df) AS weight FROM (
    SELECT k.query_id, k.key, CAST(greatest(min(coalesce(t.body_df + t.title_df, 0)), 1) AS BIGINT) AS df
    FROM (SELECT query_id, key, unnest(string_split(key, ' ')) AS word FROM {ps}qk) k
    LEFT JOIN {p}tdf t ON t.term = k.word
    GROUP BY k.query_id, k.key)),
{ps}qn AS (SELECT query_id, sqrt(sum(weight * weight)) AS qnorm FROM {ps}qv GROUP BY query_id),
{ps}cterm AS (SELECT DISTINCT f.query_id, w.page_id FROM {ps}qfree f JOIN {p}wide w ON w.term = f.term),
{ps}cphr AS (
  SELECT DISTINCT f.query_id, f.page_id FROM (
    SELECT p0.query_id, p0.phrase_idx, w0.page_id, unnest(w0.body_positions) AS start
    FROM {ps}qphr p0 JOIN {p}wide w0 ON w0.term = p0.term WHERE p0.i = 0) f
  WHERE NOT EXISTS (
    SELECT 1 FROM {ps}qphr pi
    WHERE pi.query_id = f.query_id AND pi.phrase_idx = f.phrase_idx
      AND NOT EXISTS (
        SELECT 1 FROM {p}wide wi
        WHERE wi.page_id = f.page_id AND wi.term = pi.term AND list_contains(wi.body_positions, f.start + pi.i)))),
{ps}cand AS (SELECT query_id, page_id FROM {ps}cterm UNION SELECT query_id, page_id FROM {ps}cphr),
{ps}dot AS (
  SELECT c.query_id, c.page_id, sum(q.weight * d.weight) AS dot
  FROM {ps}cand c JOIN {ps}qv q ON q.query_id = c.query_id AND NOT contains(q.key, ' ')
  JOIN {p}dw d ON d.page_id = c.page_id AND d.term = q.key
  GROUP BY c.query_id, c.page_id),
{ps}sc AS (
  SELECT c.query_id, c.page_id, coalesce(d.dot, 0.0) AS dot, coalesce(n.norm, 0.0) AS doc_norm,
         coalesce(qn.qnorm, 0.0) AS query_norm,
         CASE WHEN coalesce(n.norm, 0) <> 0 AND coalesce(qn.qnorm, 0) <> 0
              THEN coalesce(d.dot, 0.0) / (n.norm * qn.qnorm) ELSE 0.0 END AS score
  FROM {ps}cand c LEFT JOIN {ps}dot d ON d.query_id = c.query_id AND d.page_id = c.page_id
  LEFT JOIN {p}dn n ON n.page_id = c.page_id LEFT JOIN {ps}qn qn ON qn.query_id = c.query_id),
{ps}top AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY floor(score * 1e9 + 0.5) DESC, page_id) AS rank
  FROM {ps}sc QUALIFY rank <= {TOP_K})"""


def _with(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


def _docs_index() -> str:
    return _with(DOCS, index_ctes("d_", "docs"))


def _docs_search() -> str:
    return _with(DOCS, BENCH_QUERIES, index_ctes("d_", "docs"), search_ctes("d_", "bq"))


def _r6(x: str) -> str:
    return f"(floor(({x}) * 1e6 + 0.5) / 1e6)"


def _round(c: str, alias: str | None = None) -> str:
    return f"{_r6(c)} AS {alias or c.split('.')[-1]}"


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    di = _docs_index()
    ds = _docs_search()
    q["tokenize_documents"] = di + """SELECT f.page_id, f.field, CAST(len(f.toks) AS BIGINT) AS n_tokens,
  CAST((SELECT count(*) FROM d_kt k WHERE k.page_id = f.page_id AND k.field = f.field) AS BIGINT) AS n_kept
FROM d_ftok f"""
    q["stem_vocabulary"] = di + "SELECT w AS word, s AS stem FROM d_stems"
    q["stopword_filter"] = di + """SELECT st.s AS term, count(*) AS n_dropped
FROM d_tok t JOIN d_stems st ON lower(t.tok) = st.w WHERE st.s IN (SELECT s FROM d_stops) GROUP BY st.s"""
    for f in ("body", "title"):
        q[f"postings_{f}"] = di + f"""SELECT '{f}' AS field, term, page_id, {f}_tf AS tf,
  array_to_string({f}_positions, ',') AS positions FROM d_wide WHERE {f}_tf > 0"""
        q[f"df_{f}"] = di + f"SELECT '{f}' AS field, term, {f}_df AS df FROM d_tdf WHERE {f}_df > 0"
        q[f"max_tf_{f}"] = di + f"SELECT '{f}' AS field, page_id, CAST({f}_maxtf AS BIGINT) AS maxtf FROM d_mx"
    q["doc_count"] = di + "SELECT n AS n_docs FROM d_nd"
    q["vocabulary"] = di + "SELECT DISTINCT term FROM d_wide"
    q["word_ids"] = di + "SELECT CAST(word_id AS BIGINT) AS word_id, term FROM d_vocab"
    q["term_totals"] = di + """SELECT term, CAST(sum(body_tf) AS BIGINT) AS body_total, CAST(sum(title_tf) AS BIGINT) AS title_total,
  CAST(sum(body_tf + title_tf) AS BIGINT) AS total FROM d_wide GROUP BY term"""
    stem = porter_sql("w")
    requests = f""", req AS (
  SELECT DISTINCT r.url, {stem} AS term FROM (
    SELECT url, lower(unnest(regexp_extract_all(title, {PAT}))) AS w FROM docs) r)
"""
    q["term_frequency"] = di + requests + """SELECT r.url, r.term, coalesce(w.body_tf, 0) AS body_tf, coalesce(w.title_tf, 0) AS title_tf
FROM req r LEFT JOIN docs c ON c.url = r.url LEFT JOIN d_wide w ON w.page_id = c.page_id AND w.term = r.term"""
    q["term_positions"] = di + requests + """SELECT r.url, r.term, coalesce(array_to_string(w.body_positions, ','), '') AS body_positions,
  coalesce(array_to_string(w.title_positions, ','), '') AS title_positions
FROM req r LEFT JOIN docs c ON c.url = r.url LEFT JOIN d_wide w ON w.page_id = c.page_id AND w.term = r.term"""
    q["page_terms"] = di + "SELECT page_id, term FROM d_wide"
    q["pages_with_term"] = di + f""", bt AS (
  SELECT DISTINCT {stem} AS term FROM (SELECT lower(unnest(regexp_extract_all(coalesce(text, ''), {PAT}))) AS w FROM benchmark))
SELECT f.field, w.term, w.page_id, c.url FROM d_wide w
JOIN (SELECT 'body' AS field UNION ALL SELECT 'title') f
  ON (f.field = 'body' AND w.body_tf > 0) OR (f.field = 'title' AND w.title_tf > 0)
JOIN docs c ON c.page_id = w.page_id
WHERE w.term IN (SELECT term FROM bt)"""
    q["top_keywords"] = di + "SELECT page_id, keywords FROM d_kwtext"
    q["parse_queries"] = ds + """SELECT p.query_id, CAST(p.phrase_idx AS BIGINT) AS phrase_idx,
  coalesce((SELECT string_agg(t.term, ' ' ORDER BY t.i) FROM d_qt t WHERE t.query_id = p.query_id AND t.phrase_idx = p.phrase_idx), '') AS terms
FROM d_qparts p"""
    q["match_terms"] = ds + "SELECT query_id, page_id FROM d_cterm"
    q["match_phrases"] = ds + "SELECT query_id, page_id FROM d_cphr"
    q["candidates"] = ds + "SELECT query_id, page_id FROM d_cand"
    q["query_weights"] = ds + f"SELECT query_id, key, df, {_round('weight')} FROM d_qv"
    q["document_weights"] = di + f"""SELECT w.page_id, w.term, {_round('w.weight')},
  {_r6("CASE WHEN n.norm > 0 THEN w.weight / n.norm ELSE 0.0 END")} AS nweight
FROM d_dw w JOIN d_dn n ON n.page_id = w.page_id"""
    q["search_topk"] = ds + f"""SELECT t.query_id, t.rank, t.page_id, c.url, {_round('t.score')}
FROM d_top t JOIN docs c ON c.page_id = t.page_id"""
    q["explain_scores"] = ds + f"""SELECT query_id, rank, page_id, {_round('dot')}, {_round('doc_norm')}, {_round('query_norm')}, {_round('score')}
FROM d_top"""
    q["similar_pages"] = _with(
        DOCS,
        index_ctes("d_", "docs"),
        "simq AS (SELECT page_id AS query_id, trim(coalesce((SELECT string_agg(k.term, ' ' ORDER BY k.r) FROM d_kw k WHERE k.page_id = c.page_id), '')) AS query FROM docs c)",
        search_ctes("d_", "simq", "s_"),
    ) + f"SELECT query_id, rank, page_id, {_round('score')} FROM d_s_top"
    q["similar_to_pages"] = _with(
        DOCS,
        BENCH_QUERIES,
        index_ctes("d_", "docs"),
        search_ctes("d_", "bq"),
        """simq AS (SELECT page_id AS query_id, trim(coalesce((SELECT string_agg(k.term, ' ' ORDER BY k.r) FROM d_kw k
  WHERE k.page_id = c.page_id), '')) AS query FROM docs c WHERE page_id IN (SELECT page_id FROM d_top WHERE rank = 1))""",
        search_ctes("d_", "simq", "s_"),
    ) + f"SELECT query_id, rank, page_id, {_round('score')} FROM d_s_top"
    q["search_stored"] = q["search_topk"]
    q["lookup_stored"] = di + requests + """SELECT r.url, r.term, coalesce(w.body_tf, 0) AS body_tf, coalesce(w.title_tf, 0) AS title_tf,
  coalesce(array_to_string(w.body_positions, ','), '') AS body_positions, CAST(m.body_maxtf AS BIGINT) AS body_maxtf
FROM req r JOIN docs c ON c.url = r.url LEFT JOIN d_wide w ON w.page_id = c.page_id AND w.term = r.term
JOIN d_mx m ON m.page_id = c.page_id"""
    q["search_guards"] = """SELECT CAST(item_id * 10 + form AS BIGINT) AS query_id, CAST(0 AS BIGINT) AS n_results
FROM benchmark, (SELECT unnest(range(5)) AS form)"""
    q["enriched_results"] = _with(BENCH_QUERIES, crawl_ctes(), index_ctes("p_", "pg"), search_ctes("p_", "bq")) + f"""SELECT t.query_id, t.rank, t.page_id, c.url, coalesce(c.title, 'No Title') AS title, {_round('t.score')},
  coalesce(c.last_modified, 'Last Modified Not Found') AS last_modified,
  coalesce(CAST(c.size AS VARCHAR), 'Size Not Found') AS size,
  k.keywords, pl.parent_links, cl.child_links
FROM p_top t LEFT JOIN pg c ON c.page_id = t.page_id
LEFT JOIN p_kwtext k ON k.page_id = t.page_id
LEFT JOIN plinks pl ON pl.page_id = t.page_id
LEFT JOIN clinks cl ON cl.page_id = t.page_id"""
    q["paginate"] = ds + f"""SELECT query_id, rank, page_id, CAST((rank - 1) // 7 + 1 AS BIGINT) AS page,
  CAST(ceil(count(*) OVER (PARTITION BY query_id) / 7.0) AS BIGINT) AS total_pages FROM d_top"""
    q["extract_title"] = f"SELECT CAST(page_id AS BIGINT) AS page_id, {_title('html')} AS title FROM pages"
    q["extract_body"] = f"SELECT CAST(page_id AS BIGINT) AS page_id, {_body('html')} AS body FROM pages"
    links = f"""WITH hl AS (SELECT CAST(page_id AS BIGINT) AS page_id, url AS base, {_hrefs('html')} AS hrefs FROM pages),
l AS (SELECT page_id, base, unnest(hrefs) AS href, CAST(unnest(range(len(hrefs))) AS BIGINT) AS link_pos FROM hl)
"""
    q["extract_links"] = links + "SELECT page_id, link_pos, href FROM l"
    q["resolve_url"] = links + f"SELECT page_id, link_pos, {_resolve('base', 'href')} AS url FROM l"
    crawl = _with(crawl_ctes())
    visits = """SELECT t.page_id, p.url, CAST(t.depth AS BIGINT) AS depth, CAST(t.visit_order AS BIGINT) AS visit_order,
  coalesce(t.parent_id, -1) AS parent_id FROM tree t JOIN pages p ON p.page_id = t.page_id"""
    q["crawl_tree"] = crawl + visits
    q["crawl_budget"] = _with(crawl_ctes(CRAWL_BUDGET)) + visits
    q["parent_links"] = crawl + "SELECT l.page_id, p.url, l.parent_links FROM plinks l JOIN pages p ON p.page_id = l.page_id"
    q["child_links"] = crawl + "SELECT l.page_id, p.url, l.child_links FROM clinks l JOIN pages p ON p.page_id = l.page_id"
    day = "'2024-01-' || lpad(CAST({} % 28 + 1 AS VARCHAR), 2, '0')"
    q["changed_pages"] = _with(DOCS, "pu AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)") + f"""SELECT s.url FROM (
  SELECT url, {day.format("(page_id + CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END)")} AS last_modified FROM pu
  UNION ALL SELECT url, last_modified FROM docs) s
LEFT JOIN (SELECT url, {day.format("page_id")} AS lm FROM pu) st ON st.url = s.url
WHERE st.url IS NULL OR st.lm IS DISTINCT FROM s.last_modified"""
    refreshed = (
        DOCS,
        f"""pgall AS (
  SELECT url, {_title('html')} AS title, {_body('html')} AS body, '' AS last_modified,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS size FROM pages
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY title DESC, body DESC) = 1)""",
        """mc AS (
  SELECT page_id, url, title, CASE WHEN page_id % 2 = 0 THEN title ELSE body END AS body, last_modified, size, page_id AS page_order FROM docs
  UNION ALL
  SELECT (SELECT coalesce(max(page_id), -1) FROM docs) + row_number() OVER (ORDER BY url), url, title, body,
         last_modified, size, 0 FROM pgall WHERE url NOT IN (SELECT url FROM docs))""",
        index_ctes("m_", "mc"),
    )
    q["merge_index"] = q["merge_segments"] = _with(*refreshed) + """SELECT 'body' AS field, term, page_id, body_tf AS tf, array_to_string(body_positions, ',') AS positions
FROM m_wide WHERE body_tf > 0
UNION ALL
SELECT 'title', term, page_id, title_tf, array_to_string(title_positions, ',') FROM m_wide WHERE title_tf > 0"""
    q["search_segments"] = _with(*refreshed, BENCH_QUERIES, search_ctes("m_", "bq")) + f"""SELECT t.query_id, t.rank, t.page_id, c.url, {_round('t.score')}
FROM m_top t JOIN mc c ON c.page_id = t.page_id"""
    q["lookup_segments"] = _with(*refreshed) + """SELECT w.term, c.url, w.body_tf, w.title_tf, array_to_string(w.body_positions, ',') AS body_positions,
  CAST(m.body_maxtf AS BIGINT) AS body_maxtf, CAST(t.body_df + t.title_df AS BIGINT) AS df
FROM m_wide w JOIN mc c ON c.page_id = w.page_id JOIN m_mx m ON m.page_id = w.page_id JOIN m_tdf t ON t.term = w.term"""
    q["word_ids_refreshed"] = _with(*refreshed, index_ctes("d_", "docs")) + """SELECT CAST(word_id AS BIGINT) AS word_id, term FROM d_vocab
UNION ALL
SELECT (SELECT coalesce(max(word_id), 0) FROM d_vocab) + row_number() OVER (ORDER BY k, term), term FROM (
  SELECT term, min([page_id, field_order, pos]) AS k FROM m_kt WHERE term NOT IN (SELECT term FROM d_vocab) GROUP BY term)"""
    q["dedupe_pages"] = _with(DOCS) + """SELECT page_id, url, size FROM (
  SELECT page_id, url, size, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM (
    SELECT CAST(page_id AS BIGINT) AS page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size FROM pages
    UNION ALL SELECT page_id, url, size FROM docs
    UNION ALL SELECT page_id + 1000000000, url, strlen(coalesce(html, '')) + 1 FROM pages
    UNION ALL SELECT page_id + 1000000000, url, size + 1 FROM docs))
WHERE rn = 1"""
    q["term_df_lookup"] = _docs_index() + f""", bt AS (
  SELECT DISTINCT {porter_sql('w')} AS term FROM (SELECT lower(unnest(regexp_extract_all(coalesce(text, ''), {PAT}))) AS w FROM benchmark))
SELECT b.term, coalesce(t.body_df, 0) AS body_df, coalesce(t.title_df, 0) AS title_df FROM bt b LEFT JOIN d_tdf t ON t.term = b.term"""
    q["page_max_tf"] = _docs_index() + """SELECT u.url, coalesce(m.body_maxtf, 0) AS body_maxtf, coalesce(m.title_maxtf, 0) AS title_maxtf
FROM (SELECT url FROM docs UNION ALL SELECT url FROM pages) u LEFT JOIN docs c ON c.url = u.url LEFT JOIN d_mx m ON m.page_id = c.page_id"""
    q["page_report"] = _with(crawl_ctes(), index_ctes("p_", "pg")) + """SELECT CAST(t.visit_order AS BIGINT) AS visit_order,
  'Page title: ' || coalesce(c.title, 'None') || chr(10) ||
  'URL: ' || c.url || chr(10) ||
  'Last Modification Date: ' || CASE WHEN coalesce(c.last_modified, '') = '' THEN 'N/A' ELSE c.last_modified END || chr(10) ||
  'Size: ' || CAST(c.size AS VARCHAR) || ' bytes' || chr(10) ||
  'Keywords: ' || k.keywords || chr(10) ||
  'Parent Links: ' || pl.parent_links || chr(10) ||
  'Child Links: ' || cl.child_links AS block
FROM tree t JOIN pg c ON c.page_id = t.page_id
LEFT JOIN p_kwtext k ON k.page_id = t.page_id
LEFT JOIN plinks pl ON pl.page_id = t.page_id
LEFT JOIN clinks cl ON cl.page_id = t.page_id"""
    q["format_results"] = ds + """SELECT t.query_id, t.rank,
  CAST(t.rank AS VARCHAR) || '. [' || CASE WHEN trim(coalesce(c.title, '')) = '' THEN 'No Title' ELSE trim(c.title) END || ']' || chr(10) ||
  '   URL: ' || c.url || chr(10) || '   Score: ' || printf('%.4f', floor(t.score * 1e4 + 0.5) / 1e4) || chr(10) AS text
FROM d_top t JOIN docs c ON c.page_id = t.page_id
UNION ALL
SELECT query_id, CAST(0 AS BIGINT), 'No results found.' FROM bq WHERE query_id NOT IN (SELECT query_id FROM d_top)"""
    q["recent_distinct"] = """SELECT user_id, rank, props, strftime(last_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_ts FROM (
  SELECT user_id, props, last_ts, row_number() OVER (PARTITION BY user_id ORDER BY last_ts DESC, props) AS rank
  FROM (SELECT user_id, props, max(ts) AS last_ts FROM events GROUP BY user_id, props)
  QUALIFY rank <= 5)"""
    return q


def _resolve(base: str, href: str) -> str:
    """Reference resolution of ``href`` against ``base`` (see html.resolve_url)."""
    href = f"regexp_replace({href}, '[\\t\\r\\n]', '', 'g')"
    href = (
        f"(CASE WHEN regexp_matches({href}, '^[^/?#:]+:') AND NOT regexp_matches({href}, '^[^:]*://[^/?#]') "
        f"AND lower(split_part({href}, ':', 1)) = lower(split_part({base}, ':', 1)) "
        f"THEN substr({href}, strpos({href}, ':') + 1) ELSE {href} END)"
    )
    net = f"regexp_matches({href}, '^//[^/?#]')"
    href = f"(CASE WHEN regexp_matches({href}, '^//($|[/?#])') THEN substr({href}, 3) ELSE {href} END)"
    scheme = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)"
    auth = f"regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)"
    rest = f"regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(.*)$', 1)"
    bpath = f"regexp_extract({rest}, '^([^?#]*)', 1)"
    bquery = f"regexp_extract({rest}, '^[^?#]*(\\?[^#]+)?', 1)"
    hpath = f"regexp_extract({href}, '^([^?#]*)', 1)"
    hquery = f"regexp_extract({href}, '^[^?#]*(\\?[^#]+)?', 1)"
    hfrag = f"regexp_extract({href}, '^[^#]*(#.+)?$', 1)"
    origin = f"({scheme} || '://' || {auth})"

    def dots(segs: str) -> str:
        red = (
            f"list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform({segs}, lambda x: [x])), "
            "lambda acc, s: CASE WHEN s[1] = '..' THEN acc[1:len(acc) - 1] WHEN s[1] = '.' THEN acc "
            "ELSE list_concat(acc, s) END)"
        )
        fixed = f"CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({red}, '') ELSE {red} END"
        path = f"array_to_string({fixed}, '/')"
        return f"(CASE WHEN {path} = '' THEN '/' WHEN starts_with({path}, '/') THEN {path} ELSE '/' || {path} END)"

    bsegs = f"string_split({bpath}, '/')"
    bdir = f"(CASE WHEN len({bsegs}) <= 1 THEN [''] ELSE {bsegs}[1:len({bsegs}) - 1] END)"
    merged = f"list_concat({bdir}, string_split({hpath}, '/'))"
    merged_clean = (
        f"(CASE WHEN len({merged}) <= 2 THEN {merged} ELSE list_concat([{merged}[1]], "
        f"list_filter({merged}[2:len({merged}) - 1], lambda s: s <> ''), [{merged}[-1]]) END)"
    )
    return f"""(CASE
  WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {href}
  WHEN {net} THEN {scheme} || ':' || {href}
  WHEN {hpath} = '' THEN {origin} || {bpath} || CASE WHEN {hquery} <> '' THEN {hquery} ELSE {bquery} END || {hfrag}
  WHEN starts_with({hpath}, '/') THEN {origin} || {dots(f"string_split({hpath}, '/')")} || {hquery} || {hfrag}
  ELSE {origin} || {dots(merged_clean)} || {hquery} || {hfrag} END)"""


ORACLE_SQL: dict[str, str] = _sql()
