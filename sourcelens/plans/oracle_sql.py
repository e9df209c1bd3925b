"""DuckDB SQL oracles for the registered queries.

Each oracle restates the query's semantics in plain SQL over the same parquet
views (documents, labels, conversations, events, part, orders, lineitem). The
fixture adapters are restated as CTEs below.
"""

from __future__ import annotations

from sourcelens.functions import text as T

LINE_RE = T.LINE_RE
LINE_END_RE = T.LINE_END_RE
STRIP_RE = T.STRIP_RE
WS_RUN_RE = T.WS_RUN_RE
INDENT_RE = T.INDENT_RE
REVIEW_RE = T.REVIEW_RE


def keepends(x: str) -> str:
    return f"regexp_extract_all({x}, '{LINE_RE}', 0)"


def nolines(x: str) -> str:
    return f"list_transform({keepends(x)}, lambda l: regexp_replace(l, '{LINE_END_RE}', ''))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_RE}', '', 'g')"


def line_key(d: str) -> str:
    return f"(CASE WHEN ltrim({d}, '0') = '' THEN '0' ELSE ltrim({d}, '0') END)"


# Within an oracle ``path`` is a key of one document; ``file_name`` makes it the path that its project has, which
# files of other projects have too.
DOC_PATH = "('doc_' || CAST(doc_id AS VARCHAR))"


def file_name(project: str, path: str) -> str:
    doc = f"CAST(substr({path}, 5) AS BIGINT)"
    return (f"(CASE WHEN {project} = 'src' || CAST({doc} % 20 AS VARCHAR) THEN 'doc_' || CAST({doc} // 20 AS VARCHAR) "
            f"ELSE 'doc_all_' || substr({path}, 5) END)")


DOC_FILES = f"""doc_files AS (
  SELECT doc_id, source AS project, {DOC_PATH} AS path, text AS content FROM documents)"""

DOC_FILES_ANNOT = f"""doc_files_a AS (
  SELECT doc_id, source AS project, {DOC_PATH} AS path,
         CASE WHEN doc_id % 6 = 0 THEN regexp_replace(text || chr(10), '^([^\\n]*\\n)[^\\n]*', '\\1')
              ELSE text || chr(10) END AS content
  FROM documents)"""

DOC_RESPONSES = f"""doc_lines AS (
  SELECT doc_id, lang, {DOC_PATH} AS path, {nolines('text')} AS dl FROM documents),
low_q AS (SELECT DISTINCT doc_id, true AS low_quality FROM labels WHERE quality = 0),
doc_responses AS (
  SELECT d.doc_id, d.path, concat_ws(chr(10),
    'Findings for doc ' || CAST(d.doc_id AS VARCHAR),
    'REVIEW:' || CAST(1 + d.doc_id % d.n AS VARCHAR) || ': check wording ' || d.lang,
    '  REVIEW:' || CAST(1 + (d.doc_id * 7) % d.n AS VARCHAR) || ':  second look  ',
    CASE WHEN d.doc_id % 3 = 0 THEN 'REVIEW:' || CAST(1 + d.doc_id % d.n AS VARCHAR) || ': again' END,
    CASE WHEN d.doc_id % 5 = 0 THEN 'REVIEW:' || CAST(d.n + 10 AS VARCHAR) || ': past the end' END,
    CASE WHEN d.doc_id % 11 = 0 THEN 'REVIEW:99999999999999999999: too big' END,
    CASE WHEN d.doc_id % 4 = 0 THEN 'REVIEW:1:' END,
    CASE WHEN l.low_quality THEN 'REVIEW:1: low quality' END,
    CASE WHEN d.doc_id % 7 = 0 AND d.doc_id % 29 <> 0
         THEN 'FILE_START' || chr(10) || array_to_string(d.rewrite, chr(10)) || chr(10) || 'FILE_END' END,
    CASE WHEN d.doc_id % 29 = 0 THEN 'FILE_END' || chr(10) || 'FILE_START' END
  ) AS output_text
  FROM (SELECT doc_id, lang, path, len(dl) AS n, list_concat(['# doc ' || CAST(doc_id AS VARCHAR)], dl) AS rewrite FROM doc_lines) d
  LEFT JOIN low_q l USING (doc_id))"""

# Parsed responses: mode, rewrite, and review rows (review mode only).
PARSED = f"""resp_lines AS (
  SELECT doc_id, path, {nolines('output_text')} AS rl FROM doc_responses),
resp_mode AS (
  SELECT doc_id, path, rl, list_position(rl, 'FILE_START') AS s, list_position(rl, 'FILE_END') AS e,
    CASE WHEN list_position(rl, 'FILE_START') IS NULL OR list_position(rl, 'FILE_END') IS NULL THEN 'review'
         WHEN list_position(rl, 'FILE_START') >= list_position(rl, 'FILE_END') THEN 'invalid'
         ELSE 'rewrite' END AS mode
  FROM resp_lines),
all_review_rows AS (
  SELECT doc_id, path, mode, seq, {line_key("regexp_extract(s, '" + REVIEW_RE + "', 1)")} AS line_key,
         TRY_CAST(regexp_extract(s, '{REVIEW_RE}', 1) AS BIGINT) AS lineno,
         {strip("regexp_extract(s, '" + REVIEW_RE + "', 2)")} AS comment
  FROM (SELECT doc_id, path, mode, unnest(rl) AS l, generate_subscripts(rl, 1) AS seq FROM resp_mode) x,
       LATERAL (SELECT {strip('x.l')} AS s) y
  WHERE regexp_matches(s, '{REVIEW_RE}')),
review_rows AS (SELECT * FROM all_review_rows WHERE mode = 'review')"""

# Injection of review rows into annotated files, line by line.
INJECTED = f"""flines AS (
  SELECT path, unnest(ls) AS line, generate_subscripts(ls, 1) AS idx
  FROM (SELECT path, {keepends('content')} AS ls FROM doc_files_a)),
fsize AS (SELECT path, content, CAST(len({keepends('content')}) AS BIGINT) AS n_lines FROM doc_files_a),
prefix AS (
  SELECT f.path, f.idx,
         string_agg(regexp_extract(f.line, '{INDENT_RE}', 0) || '# REVIEW: ' || r.comment || chr(10), '' ORDER BY r.seq) AS p
  FROM flines f JOIN review_rows r ON r.path = f.path AND r.lineno = f.idx
  GROUP BY f.path, f.idx),
inj_text AS (
  SELECT f.path, string_agg(coalesce(p.p, '') || f.line, '' ORDER BY f.idx) AS t
  FROM flines f LEFT JOIN prefix p ON p.path = f.path AND p.idx = f.idx GROUP BY f.path),
review_targets AS (SELECT path FROM resp_mode WHERE mode = 'review'),
injected AS (
  SELECT z.path, z.content, z.n_lines, coalesce(i.t, '') AS injected_text,
         CAST((SELECT count(*) FROM review_rows r WHERE r.path = z.path AND r.lineno BETWEEN 1 AND z.n_lines) AS BIGINT)
           AS injected
  FROM fsize z JOIN review_targets USING (path) LEFT JOIN inj_text i USING (path))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["split_number_lines"] = f"""
SELECT doc_id, CAST(idx AS BIGINT) AS lineno, regexp_replace(line, '{LINE_END_RE}', '') AS line,
       CAST(idx AS VARCHAR) || ' | ' || regexp_replace(line, '{LINE_END_RE}', '') AS numbered
FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS idx
      FROM (SELECT doc_id, {keepends('text')} AS ls FROM documents))
"""

ORACLES["numbered_text"] = f"""
SELECT d.doc_id, CAST(coalesce(n.n_lines, 0) AS BIGINT) AS n_lines, coalesce(n.numbered_text, '') AS numbered_text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, string_agg(CAST(idx AS VARCHAR) || ' | ' || line, chr(10) ORDER BY idx) AS numbered_text
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS idx
        FROM (SELECT doc_id, {keepends('text')} AS ls FROM documents))
  GROUP BY doc_id) n USING (doc_id)
"""

_SUM = f"regexp_replace({strip('x.text')}, '{WS_RUN_RE}', ' ', 'g')"
ORACLES["summarise_text"] = f"""
SELECT src, id, turn, CASE WHEN length(s) <= 120 THEN s ELSE substr(s, 1, 117) || '...' END AS summary
FROM (
  SELECT 'doc' AS src, doc_id AS id, CAST(-1 AS BIGINT) AS turn, {_SUM} AS s FROM documents x
  UNION ALL
  SELECT 'conv' AS src, conv_id AS id, turn, {_SUM} AS s FROM conversations x)
"""

ORACLES["parse_reviews"] = with_(DOC_RESPONSES, PARSED) + """
SELECT doc_id, CAST(seq AS BIGINT) AS seq, line_key, lineno, comment FROM all_review_rows
"""

ORACLES["parse_response_mode"] = with_(DOC_RESPONSES, PARSED) + """
SELECT m.doc_id, m.mode,
       CASE WHEN m.mode = 'rewrite' THEN array_to_string(list_slice(m.rl, m.s + 1, m.e - 1), chr(10)) END
         AS rewritten_source,
       CAST((SELECT count(*) FROM review_rows r WHERE r.doc_id = m.doc_id) AS BIGINT) AS n_reviews
FROM resp_mode m
"""

ORACLES["group_reviews"] = with_(DOC_RESPONSES, PARSED) + """
SELECT doc_id, line_key, TRY_CAST(line_key AS BIGINT) AS lineno, CAST(count(*) AS BIGINT) AS n_comments,
       string_agg(comment, ' | ' ORDER BY seq) AS comments, CAST(min(seq) AS BIGINT) AS first_seq
FROM review_rows GROUP BY doc_id, line_key
"""

ORACLES["inject_reviews"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED) + """
SELECT path, n_lines, injected, injected_text,
       CAST(CASE WHEN injected_text <> content THEN 1 ELSE 0 END AS BIGINT) AS changed
FROM injected
"""

_CLEAN = f"""cleaned AS (
  SELECT path, content, injected,
         array_to_string(list_filter(ls, lambda l: NOT starts_with({strip('l')}, '# REVIEW:')), '') AS cleaned_text,
         CAST(len(ls) - len(list_filter(ls, lambda l: NOT starts_with({strip('l')}, '# REVIEW:'))) AS BIGINT) AS removed
  FROM (SELECT path, content, injected, {keepends('injected_text')} AS ls FROM injected))"""

ORACLES["clean_reviews"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, _CLEAN) + """
SELECT path, removed, cleaned_text FROM cleaned
"""

ORACLES["round_trip_check"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, _CLEAN) + """
SELECT path, injected, removed, CAST(CASE WHEN cleaned_text = content THEN 1 ELSE 0 END AS BIGINT) AS round_trip_ok
FROM cleaned
"""

ORACLES["review_counts"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED) + f"""
SELECT m.path, m.mode,
       CAST((SELECT count(*) FROM review_rows r WHERE r.path = m.path) AS BIGINT) AS added,
       CAST((SELECT count(*) FROM review_rows r WHERE r.path = m.path
             AND r.lineno BETWEEN 1 AND len({keepends('f.content')})) AS BIGINT) AS injected
FROM resp_mode m JOIN doc_files_a f USING (path)
"""


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


# Synthetic code corpus (see sources.tables.code_files), restated in SQL.
CODE_FILES = f"""items AS (
  SELECT l_orderkey, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem),
part_files AS (
  SELECT p_partkey, p_size, 'parts/p_' || {s('p_partkey')} || '.py' AS path,
         'class Part' || {s('p_partkey')} || ':' || chr(10) || '    def price(self):' || chr(10) ||
         '        return ' || {s('p_size')} || chr(10) || chr(10) || 'def make_' || {s('p_partkey')} || '():' ||
         chr(10) || '    return Part' || {s('p_partkey')} || '()' || chr(10) AS content
  FROM part),
order_agg AS (
  SELECT l_orderkey, count(*) AS n,
         string_agg('from parts.p_' || {s('l_partkey')} || ' import make_' || {s('l_partkey')} || chr(10), ''
                    ORDER BY l_linenumber, l_partkey) AS imports,
         string_agg('    make_' || {s('l_partkey')} || '()' || chr(10), '' ORDER BY l_linenumber, l_partkey) AS calls,
         string_agg('    make_' || {s('l_partkey')} || '()', chr(10) ORDER BY l_linenumber, l_partkey) AS run_body
  FROM lineitem GROUP BY l_orderkey),
order_files AS (
  SELECT o.o_orderkey, 'orders/o_' || {s('o.o_orderkey')} || '.py' AS path, coalesce(a.n, 0) AS n,
         coalesce(a.imports, '') || chr(10) || 'def run():' || chr(10) || coalesce(a.calls, '    pass' || chr(10))
           AS content,
         'def run():' || chr(10) || coalesce(a.run_body, '    pass') AS run_source
  FROM orders o LEFT JOIN order_agg a ON a.l_orderkey = o.o_orderkey),
code_files AS (SELECT path, content FROM part_files UNION ALL SELECT path, content FROM order_files)"""

ORACLES["skeleton"] = with_(CODE_FILES) + f"""
SELECT 'shop' AS project, path, CAST(3 AS BIGINT) AS n_names,
       '### ' || path || chr(10) || 'Part' || {s('p_partkey')} || ', make_' || {s('p_partkey')} || ', price' AS entry
FROM part_files
UNION ALL
SELECT 'shop', path, CAST(1 AS BIGINT), '### ' || path || chr(10) || 'run' FROM order_files
"""

TOOL_CALLS = f"""ev AS (
  SELECT event_id, user_id, event_type, props, json_extract_string(props, '$.k') AS k FROM events),
tool_calls AS (
  SELECT event_id AS call_id, user_id AS conv_id,
    CASE WHEN event_type IN ('view', 'error') THEN 'read_file' WHEN event_type = 'click' THEN 'get_function'
         WHEN event_type = 'purchase' THEN 'search_symbol' WHEN event_type = 'signup' THEN 'list_dir' END AS name,
    CASE WHEN event_id % 10 = 0 THEN '[1]'
         WHEN event_type = 'view' AND event_id % 7 = 0 THEN '{{"file_path":"../p_' || k || '.py"}}'
         WHEN event_type = 'view' THEN '{{"file_path":"parts/p_' || k || '.py"' || CASE event_id % 11
           WHEN 1 THEN ',"max_chars":40' WHEN 2 THEN ',"max_chars":true' WHEN 3 THEN ',"max_chars":"3"'
           WHEN 4 THEN ',"max_chars":9,"max_chars":25' WHEN 5 THEN ',"max_chars":-4' WHEN 6 THEN ',"max_chars":2.5'
           WHEN 8 THEN ',"max_chars":null' ELSE '' END || '}}'
         WHEN event_type = 'click' THEN '{{"file_path":"parts/p_' || k || '.py","name":"make_'
              || {s('CAST(k AS BIGINT) + event_id % 2')} || '"}}'
         WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN '{{"symbol":"nothing_' || k || '"}}'
         WHEN event_type = 'purchase' THEN '{{"symbol":"make_' || k || '"}}'
         WHEN event_type = 'signup' THEN '{{}}'
         ELSE substr(props, 1, length(props) - 1) END AS arguments
  FROM ev),
calls_c AS (
  SELECT *, CASE WHEN NOT json_valid(arguments) THEN 'invalid'
                 WHEN json_type(arguments) = 'OBJECT' THEN 'object' ELSE 'not_object' END AS arg_status
  FROM tool_calls)"""

SYMBOL_HITS = f"""defs AS (
  SELECT path, 'Part' || {s('p_partkey')} AS name, 1 AS lineno FROM part_files
  UNION ALL SELECT path, 'make_' || {s('p_partkey')}, 5 FROM part_files
  UNION ALL SELECT path, 'price', 2 FROM part_files
  UNION ALL SELECT path, 'run', n + 2 FROM order_files),
callsites AS (
  SELECT path, 'Part' || {s('p_partkey')} AS name, 6 AS lineno FROM part_files
  UNION ALL SELECT 'orders/o_' || {s('l_orderkey')} || '.py', 'make_' || {s('l_partkey')}, n + 2 + rn FROM items),
hits AS MATERIALIZED (
  SELECT name, 'DEFINED' AS kind, path, lineno, 'DEFINED  ' || path || ':' || {s('lineno')} AS hit FROM defs
  UNION ALL
  SELECT name, 'CALLED', path, lineno, 'CALLED   ' || path || ':' || {s('lineno')} FROM callsites)"""

ORACLES["search_symbols"] = with_(CODE_FILES, TOOL_CALLS, SYMBOL_HITS) + """,
requested AS (
  SELECT DISTINCT json_extract_string(arguments, '$.symbol') AS symbol FROM calls_c
  WHERE name = 'search_symbol' AND arg_status = 'object'
  UNION SELECT 'run' UNION SELECT 'price')
SELECT r.symbol, h.kind, h.path, CAST(h.lineno AS BIGINT) AS lineno, h.hit
FROM requested r JOIN hits h ON h.name = r.symbol
UNION ALL
SELECT r.symbol, 'NONE', NULL, NULL, '''' || r.symbol || ''' not found in project'
FROM requested r WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.name = r.symbol)
"""

ORACLES["resolve_imports"] = with_(CODE_FILES) + f"""
SELECT 'orders/o_' || {s('i.l_orderkey')} || '.py' AS path, CAST(i.rn AS BIGINT) AS lineno,
       'parts.p_' || {s('i.l_partkey')} AS module, p.path AS resolved_path,
       CAST(length(p.content) AS BIGINT) AS resolved_chars
FROM items i JOIN part_files p ON p.p_partkey = i.l_partkey
"""

ORACLES["get_definitions"] = with_(CODE_FILES) + f"""
SELECT path, 'Part' || {s('p_partkey')} AS name, CAST(1 AS BIGINT) AS lineno, CAST(1 AS BIGINT) AS found,
       'class Part' || {s('p_partkey')} || ':' || chr(10) || '    def price(self):' || chr(10) || '        return '
         || {s('p_size')} AS output
FROM part_files
UNION ALL
SELECT path, 'price', 2, 1, 'def price(self):' || chr(10) || '        return ' || {s('p_size')} FROM part_files
UNION ALL
SELECT path, 'make_' || {s('p_partkey')}, 5, 1,
       'def make_' || {s('p_partkey')} || '():' || chr(10) || '    return Part' || {s('p_partkey')} || '()'
FROM part_files
UNION ALL
SELECT path, 'make_' || {s('p_partkey + 1')}, NULL, 0, '''make_' || {s('p_partkey + 1')} || ''' not found in ' || path
FROM part_files
UNION ALL
SELECT path, 'run', CAST(n + 2 AS BIGINT), 1, run_source FROM order_files
"""


def numbered(x: str) -> str:
    return f"array_to_string(list_transform({keepends(x)}, lambda l, i: {s('i')} || ' | ' || l), chr(10))"


ORACLES["build_contexts"] = with_(CODE_FILES) + f""",
entries AS (
  SELECT '### ' || path || chr(10) || 'Part' || {s('p_partkey')} || ', make_' || {s('p_partkey')} || ', price' AS e
  FROM part_files
  UNION ALL SELECT '### ' || path || chr(10) || 'run' FROM order_files),
skel AS (SELECT CAST(20 + sum(length(e)) + count(*) - 1 AS BIGINT) AS skeleton_chars FROM entries),
imported AS (
  SELECT 'orders/o_' || {s('i.l_orderkey')} || '.py' AS path,
         '## Imported Files' || chr(10) || string_agg(p.content, chr(10) || chr(10) || '---' || chr(10) || chr(10)
                                                       ORDER BY i.rn) AS imported_section
  FROM items i JOIN part_files p ON p.p_partkey = i.l_partkey GROUP BY i.l_orderkey),
targets AS (
  SELECT f.path, i.imported_section,
         '## Target File: ' || regexp_extract(f.path, '([^/]*)$', 1) || chr(10) || {numbered('f.content')}
           AS target_section
  FROM code_files f LEFT JOIN imported i USING (path))
SELECT t.path, k.skeleton_chars, CAST(CASE WHEN t.imported_section IS NULL THEN 0 ELSE 1 END AS BIGINT) AS has_imported,
       t.imported_section, t.target_section,
       CAST(k.skeleton_chars + coalesce(length(t.imported_section) + 2, 0) + 2 + length(t.target_section) AS BIGINT)
         AS context_chars
FROM targets t CROSS JOIN skel k
"""

ORACLES["dispatch_tool_calls"] = with_(CODE_FILES, TOOL_CALLS, SYMBOL_HITS) + f""",
ok_calls AS MATERIALIZED (SELECT * FROM calls_c WHERE arg_status = 'object' AND name IN ('read_file', 'get_function', 'search_symbol')),
search AS (
  SELECT c.call_id, json_extract_string(c.arguments, '$.symbol') AS symbol FROM ok_calls c WHERE c.name = 'search_symbol'),
read AS (
  SELECT c.call_id, json_extract_string(c.arguments, '$.file_path') AS fp,
         CASE WHEN c.arguments NOT LIKE '%max_chars%' THEN NULL ELSE
           CASE c.call_id % 11 WHEN 1 THEN 40 WHEN 2 THEN 1 WHEN 4 THEN 25 WHEN 5 THEN -4 END END AS most
  FROM ok_calls c WHERE c.name = 'read_file'),
getf AS (
  SELECT c.call_id, json_extract_string(c.arguments, '$.file_path') AS fp,
         json_extract_string(c.arguments, '$.name') AS nm FROM ok_calls c WHERE c.name = 'get_function'),
answers AS (
SELECT call_id, name,
       CASE arg_status WHEN 'invalid' THEN 'invalid_json' WHEN 'not_object' THEN 'not_object' ELSE 'unknown_tool' END
         AS status, '' AS chunk_key,
       CASE WHEN arg_status = 'invalid' THEN 'Error: invalid JSON arguments for tool ''' || name || ''''
            WHEN arg_status = 'not_object' THEN 'Error running tool ''' || name
                 || ''': Tool arguments must decode to a JSON object'
            ELSE 'Error running tool ''' || name || ''': Tool "' || name || '" not found in registry' END AS output
FROM calls_c WHERE arg_status <> 'object' OR name NOT IN ('read_file', 'get_function', 'search_symbol')
UNION ALL
SELECT r.call_id, 'read_file',
       CASE WHEN starts_with(r.fp, '../') THEN 'tool_error' WHEN f.content IS NULL THEN 'tool_error' ELSE 'ok' END,
       '',
       CASE WHEN starts_with(r.fp, '../') THEN 'Error: ''' || r.fp || ''' is outside the project root'
            WHEN f.content IS NULL THEN 'Error reading ''' || r.fp || ''': file not found'
            WHEN r.most IS NOT NULL AND length(f.content) > r.most
              THEN left(f.content, CASE WHEN r.most < 0 THEN length(f.content) + r.most ELSE r.most END)
                   || chr(10) || chr(10) || '... truncated at ' || {s('r.most')} || ' characters'
            ELSE f.content END
FROM read r LEFT JOIN code_files f ON f.path = r.fp
UNION ALL
SELECT g.call_id, 'get_function', 'ok', '',
       CASE WHEN g.nm = 'make_' || {s('p.p_partkey')}
            THEN 'def make_' || {s('p.p_partkey')} || '():' || chr(10) || '    return Part' || {s('p.p_partkey')} || '()'
            ELSE '''' || g.nm || ''' not found in ' || g.fp END
FROM getf g JOIN part_files p ON p.path = g.fp
UNION ALL
SELECT x.call_id, 'search_symbol', 'ok', h.path, string_agg(h.hit, chr(10) ORDER BY h.lineno)
FROM search x JOIN hits h ON h.name = x.symbol GROUP BY x.call_id, h.path
UNION ALL
SELECT x.call_id, 'search_symbol', 'ok', '', '''' || x.symbol || ''' not found in project'
FROM search x WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.name = x.symbol))
SELECT call_id, name, status, string_agg(output, chr(10) ORDER BY chunk_key) AS output
FROM answers GROUP BY call_id, name, status
"""


ORACLES["sql_lookups"] = with_(CODE_FILES, TOOL_CALLS, SYMBOL_HITS) + """,
search AS (
  SELECT call_id, json_extract_string(arguments, '$.symbol') AS symbol FROM calls_c
  WHERE arg_status = 'object' AND name = 'search_symbol'),
read AS (
  SELECT call_id, json_extract_string(arguments, '$.file_path') AS fp,
    CASE WHEN arguments NOT LIKE '%max_chars%' THEN NULL ELSE
      CASE call_id % 11 WHEN 1 THEN 40 WHEN 2 THEN 1 WHEN 4 THEN 25 WHEN 5 THEN -4 END END AS most
  FROM calls_c WHERE arg_status = 'object' AND name = 'read_file'),
lines AS (
  SELECT x.call_id, x.symbol, h.hit, row_number() OVER (PARTITION BY x.call_id ORDER BY h.path, h.lineno) - 1 AS n
  FROM search x LEFT JOIN hits h ON h.name = x.symbol),
texts AS (
  SELECT r.call_id, CASE WHEN starts_with(r.fp, '../') THEN 'Error: ''' || r.fp || ''' is outside the project root'
      WHEN f.content IS NULL THEN 'Error reading ''' || r.fp || ''': file not found'
      WHEN r.most IS NOT NULL AND length(f.content) > r.most
        THEN left(f.content, CASE WHEN r.most < 0 THEN length(f.content) + r.most ELSE r.most END)
             || chr(10) || chr(10) || '... truncated at ' || CAST(r.most AS VARCHAR) || ' characters'
      ELSE f.content END AS t
  FROM read r LEFT JOIN code_files f ON f.path = r.fp),
pieces AS (
  SELECT call_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS n FROM texts)
SELECT 'search_symbol' AS name, call_id, CAST(n // 100 AS BIGINT) AS piece,
       string_agg(coalesce(hit, '''' || symbol || ''' not found in project'), chr(10) ORDER BY n) AS output
FROM lines GROUP BY call_id, n // 100
UNION ALL
SELECT 'read_file', call_id, CAST(n // 100 AS BIGINT), string_agg(l, chr(10) ORDER BY n) FROM pieces GROUP BY call_id, n // 100
"""


def norm_path(p: str) -> str:
    return (f"coalesce(nullif(list_reduce(string_split({p}, '/'), lambda acc, x: CASE WHEN x IN ('', '.') THEN acc "
            f"WHEN x = '..' THEN regexp_replace(acc, '/[^/]*$', '') ELSE acc || '/' || x END, ''), ''), '/')")


ORACLES["within_root"] = f"""
WITH ev AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events),
p AS (
  SELECT event_id AS call_id,
    CASE WHEN event_type = 'view' AND event_id % 7 = 0 THEN '../p_' || k || '.py'
         WHEN event_type = 'view' THEN 'parts/p_' || k || '.py'
         WHEN event_type = 'click' THEN 'parts/./sub/../p_' || k || '.py'
         WHEN event_type = 'purchase' THEN '/project/parts/p_' || k || '.py'
         WHEN event_type = 'signup' THEN 'parts/../../etc/p_' || k
         ELSE '/etc/../project/../../p_' || k || '.py' END AS raw_path
  FROM ev),
r AS (
  SELECT call_id, raw_path,
         {norm_path("CASE WHEN starts_with(raw_path, '/') THEN raw_path ELSE '/project/' || raw_path END")} AS resolved
  FROM p)
SELECT call_id, raw_path, resolved,
       CAST(CASE WHEN resolved = '/project' OR starts_with(resolved, '/project/') THEN 1 ELSE 0 END AS BIGINT) AS inside,
       CASE WHEN resolved = '/project' THEN ''
            WHEN starts_with(resolved, '/project/') THEN substr(resolved, length('/project/') + 1) END AS rel_path,
       CASE WHEN NOT (resolved = '/project' OR starts_with(resolved, '/project/'))
            THEN '''' || raw_path || ''' is outside the project root' END AS message
FROM r
"""


DOC_REQUESTS = f"""doc_requests AS (
  SELECT doc_id, path,
    CASE WHEN doc_id % 13 = 0 THEN 'x-3' WHEN doc_id % 17 = 0 THEN '9-2'
         WHEN doc_id % 2 = 0 THEN '1-' || {s('CAST(greatest(1, floor(n / 2)) AS BIGINT)')} END AS lines,
    CASE WHEN doc_id % 30 = 0 THEN 'review this' WHEN doc_id % 10 = 0 OR doc_id % 23 = 0 THEN NULL
         ELSE 'review this' END AS message,
    doc_id % 4 = 0 AS dry_run, doc_id % 10 = 0 AS clean
  FROM (SELECT doc_id, {DOC_PATH} AS path, len({keepends('text')}) AS n FROM documents))"""

INT_RE = rf"^[{T.WS_CHARS}]*[+-]?[0-9]+(_[0-9]+)*[{T.WS_CHARS}]*$"


def py_int(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{INT_RE}') THEN TRY_CAST(replace({strip(x)}, '_', '') AS BIGINT) END)"


RANGES = f"""rq AS (
  SELECT *, instr(lines, '-') AS pos,
         CASE WHEN instr(lines, '-') > 0 THEN substr(lines, 1, instr(lines, '-') - 1) ELSE lines END AS st,
         CASE WHEN instr(lines, '-') > 0 THEN substr(lines, instr(lines, '-') + 1) ELSE '' END AS et
  FROM doc_requests),
rq2 AS (SELECT *, {py_int('st')} AS a, {py_int('et')} AS b FROM rq),
ranges AS (
  SELECT *, CASE WHEN lines IS NULL THEN 'none'
                 WHEN NOT (pos > 0 AND st <> '' AND et <> '' AND a IS NOT NULL AND b IS NOT NULL) THEN 'bad_shape'
                 WHEN a < 1 OR b < 1 OR a > b THEN 'bad_order' ELSE 'ok' END AS range_status
  FROM rq2)"""

ORACLES["validate_requests"] = with_(DOC_REQUESTS, RANGES) + """
SELECT doc_id, path,
  CASE WHEN (clean AND dry_run) OR (clean AND message IS NOT NULL) OR (NOT clean AND message IS NULL) THEN 'options'
       WHEN range_status IN ('bad_shape', 'bad_order') THEN 'range' ELSE 'ok' END AS stage,
  CASE WHEN clean AND dry_run THEN '--clean cannot be used with --dry-run'
       WHEN clean AND message IS NOT NULL THEN '--clean cannot be used with a review message'
       WHEN NOT clean AND message IS NULL THEN 'A review message is required unless --clean is set'
       WHEN range_status = 'bad_shape' THEN 'Line range must look like A-B'
       WHEN range_status = 'bad_order' THEN 'Line range must be positive and ascending' END AS error,
  CAST(0 AS BIGINT) AS python_file, range_status
FROM ranges
"""

ORACLES["range_violations"] = with_(DOC_RESPONSES, PARSED, DOC_REQUESTS, RANGES) + """,
keys AS (SELECT DISTINCT path, line_key, lineno FROM review_rows),
bad AS (
  SELECT g.doc_id, string_agg(k.line_key, ', ' ORDER BY length(k.line_key), k.line_key) AS offending
  FROM ranges g JOIN keys k ON k.path = g.path
  WHERE g.range_status = 'ok' AND (k.lineno IS NULL OR k.lineno < g.a OR k.lineno > g.b)
  GROUP BY g.doc_id)
SELECT g.doc_id, g.lines, m.mode, g.range_status,
       CASE WHEN g.range_status = 'ok' THEN g.a END AS range_start,
       CASE WHEN g.range_status = 'ok' THEN g.b END AS range_end,
       CASE WHEN g.range_status IN ('bad_shape', 'bad_order') THEN 'range_error'
            WHEN m.mode <> 'review' THEN 'not_checked'
            WHEN g.range_status = 'none' OR b.offending IS NULL THEN 'pass' ELSE 'reject' END AS outcome,
       CASE WHEN g.range_status = 'ok' AND m.mode = 'review' AND b.offending IS NOT NULL
            THEN 'Model returned reviews outside requested line range: ' || b.offending END AS message
FROM ranges g JOIN resp_mode m ON m.path = g.path LEFT JOIN bad b ON b.doc_id = g.doc_id
"""


def rng(start: str, length: str) -> str:
    return (f"(CASE WHEN {length} = 1 THEN {s(start + ' + 1')} WHEN {length} = 0 THEN {s(start)} || ',0' "
            f"ELSE {s(start + ' + 1')} || ',' || {s(length)} END)")


ORACLES["diff_hunks"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED) + f""",
ed AS (
  SELECT r.path, r.lineno, count(*) AS k, z.n_lines FROM review_rows r JOIN fsize z USING (path)
  WHERE r.lineno BETWEEN 1 AND z.n_lines GROUP BY r.path, r.lineno, z.n_lines),
g AS (
  SELECT *, CASE WHEN lag(lineno) OVER w IS NULL OR lineno - lag(lineno) OVER w > 6 THEN 1 ELSE 0 END AS brk
  FROM ed WINDOW w AS (PARTITION BY path ORDER BY lineno)),
h AS (SELECT *, sum(brk) OVER (PARTITION BY path ORDER BY lineno ROWS UNBOUNDED PRECEDING) AS hunk_no FROM g),
hh AS (
  SELECT path, hunk_no, min(lineno) AS first, max(lineno) AS last, sum(k) AS added, max(n_lines) AS n
  FROM h GROUP BY path, hunk_no),
hb AS (
  SELECT *, coalesce(sum(added) OVER (PARTITION BY path ORDER BY hunk_no
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         greatest(first - 1 - 3, 0) AS old0, least(n, last - 1 + 3) - greatest(first - 1 - 3, 0) AS old_len
  FROM hh)
SELECT path, CAST(hunk_no AS BIGINT) AS hunk_no, CAST(old0 + 1 AS BIGINT) AS old_start, CAST(old_len AS BIGINT) AS old_len,
       CAST(old0 + before + 1 AS BIGINT) AS new_start, CAST(old_len + added AS BIGINT) AS new_len,
       '@@ -' || {rng('old0', 'old_len')} || ' +' || {rng('(old0 + before)', '(old_len + added)')} || ' @@' AS header
FROM hb
"""

UPDATED = f"""updated AS (
  SELECT f.project, f.path, f.content, m.mode,
    CASE WHEN m.mode = 'review' THEN i.injected_text
         WHEN m.mode = 'rewrite' THEN
           CASE WHEN suffix(f.content, chr(10)) AND NOT suffix(array_to_string(list_slice(m.rl, m.s + 1, m.e - 1), chr(10)), chr(10))
                THEN array_to_string(list_slice(m.rl, m.s + 1, m.e - 1), chr(10)) || chr(10)
                ELSE array_to_string(list_slice(m.rl, m.s + 1, m.e - 1), chr(10)) END
         ELSE f.content END AS updated,
    CASE WHEN m.mode = 'review' THEN (SELECT count(*) FROM review_rows r WHERE r.path = f.path) ELSE 0 END AS added,
    CASE WHEN m.mode = 'review' THEN i.injected ELSE 0 END AS injected
  FROM doc_files_a f JOIN resp_mode m USING (path) LEFT JOIN injected i USING (path))"""

ORACLES["clean_hunks"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED) + f""",
il AS (
  SELECT path, unnest(ls) AS line, generate_subscripts(ls, 1) AS lineno, len(ls) AS n
  FROM (SELECT path, {keepends('injected_text')} AS ls FROM injected)),
g AS (
  SELECT *, CASE WHEN lag(lineno) OVER w IS NULL OR lineno - lag(lineno) OVER w - 1 > 6 THEN 1 ELSE 0 END AS brk
  FROM il WHERE starts_with({strip('line')}, '# REVIEW:') WINDOW w AS (PARTITION BY path ORDER BY lineno)),
h AS (SELECT *, sum(brk) OVER (PARTITION BY path ORDER BY lineno ROWS UNBOUNDED PRECEDING) AS hunk_no FROM g),
hh AS (
  SELECT path, hunk_no, min(lineno) AS first, max(lineno) AS last, count(*) AS cut, max(n) AS n FROM h GROUP BY path, hunk_no),
hb AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY path ORDER BY hunk_no
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         greatest(first - 1 - 3, 0) AS old0, least(n, last + 3) - greatest(first - 1 - 3, 0) AS old_len
  FROM hh)
SELECT path, CAST(hunk_no AS BIGINT) AS hunk_no, CAST(old0 + 1 AS BIGINT) AS old_start, CAST(old_len AS BIGINT) AS old_len,
       CAST(old0 - before + 1 AS BIGINT) AS new_start, CAST(old_len - cut AS BIGINT) AS new_len,
       '@@ -' || {rng('old0', 'old_len')} || ' +' || {rng('(old0 - before)', '(old_len - cut)')} || ' @@' AS header
FROM hb
"""

ORACLES["line_changes"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, UPDATED) + f""",
bl AS (SELECT path, unnest({keepends('content')}) AS line FROM updated WHERE content <> updated),
al AS (SELECT path, unnest({keepends('updated')}) AS line FROM updated WHERE content <> updated),
plus AS (SELECT path, line FROM al EXCEPT ALL SELECT path, line FROM bl),
minus AS (SELECT path, line FROM bl EXCEPT ALL SELECT path, line FROM al)
SELECT path, '+' AS change, line, CAST(count(*) AS BIGINT) AS n FROM plus GROUP BY path, line
UNION ALL
SELECT path, '-', line, CAST(count(*) AS BIGINT) FROM minus GROUP BY path, line
"""

_STEM = "regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)\\.[^.]*$', '\\1')"
U_FILE = file_name("u.project", "u.path")
# Unified texts: the hunks of known insertions (reviews), one replaced block where a rewrite differs.
ORACLES["unified_diffs"] = f"""
WITH hunks AS MATERIALIZED (SELECT * FROM ({ORACLES["diff_hunks"]})),
all_of AS MATERIALIZED ({with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, UPDATED)}
  SELECT project, path, mode, content, updated, {keepends('content')} AS a, {keepends('updated')} AS b
  FROM updated WHERE content <> updated),
comments AS MATERIALIZED ({with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED)}
  SELECT f.path, f.idx, string_agg('+' || regexp_extract(f.line, '{INDENT_RE}', 0) || '# REVIEW: ' || r.comment || chr(10), ''
                                   ORDER BY r.seq) AS plus
  FROM flines f JOIN review_rows r ON r.path = f.path AND r.lineno = f.idx GROUP BY f.path, f.idx),
review_lines AS (
  SELECT path, unnest(a) AS line, generate_subscripts(a, 1) AS idx FROM all_of WHERE mode = 'review'),
review_hunks AS (
  SELECT h.path, h.hunk_no, any_value(h.header) || chr(10) || string_agg(coalesce(c.plus, '') || ' ' || l.line, '' ORDER BY l.idx) AS t
  FROM hunks h JOIN review_lines l ON l.path = h.path AND l.idx BETWEEN h.old_start AND h.old_start + h.old_len - 1
  LEFT JOIN comments c ON c.path = l.path AND c.idx = l.idx GROUP BY h.path, h.hunk_no),
review_texts AS (SELECT path, string_agg(t, '' ORDER BY hunk_no) AS t, count(*) AS n_hunks FROM review_hunks GROUP BY path),
heads AS (
  SELECT *, coalesce(list_position(list_transform(range(1, CAST(least(len(a), len(b)) AS BIGINT) + 1), lambda i: a[i] = b[i]), false) - 1,
                     least(len(a), len(b))) AS p
  FROM all_of WHERE mode = 'rewrite'),
tails AS (
  SELECT *, coalesce(list_position(list_transform(range(0, CAST(least(len(a), len(b)) - p AS BIGINT)),
                                                  lambda i: a[len(a) - i] = b[len(b) - i]), false) - 1, least(len(a), len(b)) - p) AS s
  FROM heads),
bounds AS (
  SELECT *, greatest(p - 3, 0) AS old0, least(len(a), len(a) - s + 3) - greatest(p - 3, 0) AS old_len,
         least(len(a), len(a) - s + 3) - greatest(p - 3, 0) + len(b) - len(a) AS new_len
  FROM tails),
rewrite_texts AS (
  SELECT path, '@@ -' || {rng('old0', 'old_len')} || ' +' || {rng('old0', 'new_len')} || ' @@' || chr(10)
    || array_to_string(list_transform(list_slice(a, old0 + 1, p), lambda l: ' ' || l), '')
    || array_to_string(list_transform(list_slice(a, p + 1, len(a) - s), lambda l: '-' || l), '')
    || array_to_string(list_transform(list_slice(b, p + 1, len(b) - s), lambda l: '+' || l), '')
    || array_to_string(list_transform(list_slice(a, len(a) - s + 1, old0 + old_len), lambda l: ' ' || l), '') AS t, 1 AS n_hunks
  FROM bounds),
texts AS (SELECT * FROM review_texts UNION ALL SELECT * FROM rewrite_texts)
SELECT u.project, {U_FILE} AS path, '--- ' || {U_FILE} || chr(10) || '+++ ' || {U_FILE} || chr(10) || t.t AS diff,
       'review_' || {_STEM.replace('path', U_FILE)} || '_' || substr(sha1(u.project || '/' || {U_FILE}), 1, 10) || '.diff' AS diff_path,
       CAST(t.n_hunks AS BIGINT) AS n_hunks
FROM all_of u JOIN texts t USING (path)
"""

ORACLES["apply_decisions"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, UPDATED) + f""",
doc_decisions AS (
  SELECT {DOC_PATH} AS path, CASE WHEN doc_id % 3 = 0 THEN ' Y ' ELSE 'n' END AS answer
  FROM documents WHERE doc_id % 3 <> 2)
SELECT u.path, u.mode,
  CASE WHEN u.updated = u.content THEN 'no_changes'
       WHEN lower({strip('d.answer')}) = 'y' THEN 'applied' ELSE 'rejected' END AS outcome,
  CASE WHEN u.updated <> u.content AND lower({strip('d.answer')}) = 'y' THEN u.updated ELSE u.content END
    AS final_content,
  CASE WHEN u.updated <> u.content THEN 'review_' || {_STEM.replace('path', U_FILE)} || '_' || substr(sha1(u.project || '/' || {U_FILE}), 1, 10)
       || '.diff' END AS diff_path
FROM updated u LEFT JOIN doc_decisions d USING (path)
WHERE u.mode <> 'invalid'
"""

ORACLES["published_updates"] = f"""
SELECT d.source AS project, {file_name("d.source", "q.path")} AS path, q.final_content AS content
FROM ({ORACLES["apply_decisions"]}) q JOIN documents d ON q.path = 'doc_' || CAST(d.doc_id AS VARCHAR)
WHERE q.outcome = 'applied'
"""

ORACLES["final_turn"] = """
WITH t AS (SELECT conv_id, turn + 1 AS turn, text, length(text) % 3 <> 0 AS has_tool FROM conversations),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         min(turn) FILTER (WHERE NOT has_tool AND turn <= 9) AS answered_turn,
         arg_min(text, turn) FILTER (WHERE NOT has_tool AND turn <= 9) AS answered_text,
         max(text) FILTER (WHERE turn = 9) AS limit_text
  FROM t GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns,
  CAST(CASE WHEN answered_turn IS NOT NULL THEN answered_turn WHEN limit_text IS NOT NULL THEN 9 END AS BIGINT)
    AS final_turn,
  CASE WHEN answered_turn IS NOT NULL THEN 'answered' WHEN limit_text IS NOT NULL THEN 'limit' ELSE 'unfinished' END
    AS outcome,
  CASE WHEN answered_turn IS NOT NULL THEN answered_text ELSE limit_text END AS final_text
FROM g
"""

ORACLES["first_text_delta"] = """
SELECT user_id AS response_id, min(event_id) AS seq,
       strftime(arg_min(ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS ts, arg_min(props, event_id) AS payload
FROM events WHERE event_type = 'view' AND event_id % 9 <> 0 GROUP BY user_id
"""

ORACLES["audit_responses"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES) + f""",
r AS (
  SELECT doc_id, path, rl, list_position(rl, 'FILE_START') AS s, list_position(rl, 'FILE_END') AS e,
         coalesce(list_position(rl, 'FILE_END') > list_position(rl, 'FILE_START'), false) AS rewrite
  FROM (SELECT doc_id, path, {nolines('output_text')} AS rl FROM doc_responses)),
ln AS (
  SELECT r.doc_id, r.rewrite, r.s, r.e, x.i, {strip('x.l')} AS st, len({keepends('f.content')}) AS n_lines
  FROM r JOIN doc_files_a f USING (path),
       LATERAL (SELECT unnest(r.rl) AS l, generate_subscripts(r.rl, 1) AS i) x),
agg AS (
  SELECT doc_id, any_value(rewrite) AS rewrite,
    count(*) FILTER (WHERE st <> '' AND NOT (rewrite AND i > s AND i < e) AND NOT regexp_matches(st, '{REVIEW_RE}')
                     AND st NOT IN ('FILE_START', 'FILE_END')) AS prose_lines,
    count(*) FILTER (WHERE starts_with(st, '```')) AS fence_lines,
    count(*) FILTER (WHERE regexp_matches(st, '{REVIEW_RE}')) AS review_lines,
    count(*) FILTER (WHERE regexp_matches(st, '{REVIEW_RE}') AND coalesce(
        NOT (TRY_CAST(regexp_extract(st, '{REVIEW_RE}', 1) AS BIGINT) BETWEEN 1 AND n_lines), true)) AS out_of_target
  FROM ln GROUP BY doc_id)
SELECT doc_id, CAST(prose_lines AS BIGINT) AS prose_lines, CAST(fence_lines AS BIGINT) AS fence_lines,
       CAST(review_lines AS BIGINT) AS review_lines,
       CAST(CASE WHEN rewrite AND review_lines > 0 THEN 1 ELSE 0 END AS BIGINT) AS both_modes,
       CAST(CASE WHEN review_lines > 5 THEN 1 ELSE 0 END AS BIGINT) AS too_many,
       CAST(out_of_target AS BIGINT) AS out_of_target, CAST(least(review_lines, 5) AS BIGINT) AS kept_findings
FROM agg
"""

ORACLES["run_summary"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, UPDATED) + """
SELECT project, mode, CAST(count(*) AS BIGINT) AS targets,
       CAST(count(*) FILTER (WHERE updated <> content) AS BIGINT) AS changed,
       CAST(sum(added) AS BIGINT) AS added, CAST(sum(injected) AS BIGINT) AS injected
FROM updated GROUP BY ROLLUP (project, mode)
"""

ORACLES["run_conversations"] = """
WITH t AS (SELECT conv_id, turn + 1 AS turn, text, length(text) % 3 <> 0 AS has_tool FROM conversations),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         min(turn) FILTER (WHERE NOT has_tool AND turn <= 9) AS answered_turn,
         arg_min(text, turn) FILTER (WHERE NOT has_tool AND turn <= 9) AS answered_text,
         max(text) FILTER (WHERE turn = 9) AS limit_text
  FROM t GROUP BY conv_id),
f AS (
  SELECT conv_id, n_turns,
    CAST(CASE WHEN answered_turn IS NOT NULL THEN answered_turn WHEN limit_text IS NOT NULL THEN 9 END AS BIGINT)
      AS final_turn,
    CASE WHEN answered_turn IS NOT NULL THEN 'answered' WHEN limit_text IS NOT NULL THEN 'limit' ELSE 'unfinished' END
      AS outcome,
    CASE WHEN answered_turn IS NOT NULL THEN answered_text ELSE limit_text END AS final_text
  FROM g),
calls AS (SELECT event_id AS call_id, user_id AS conv_id, 1 + event_id % 5 AS turn FROM events)
SELECT f.conv_id, f.final_turn, f.outcome, f.final_text,
  CAST((SELECT count(*) FROM calls c WHERE c.conv_id = f.conv_id AND c.turn <=
        CASE f.outcome WHEN 'answered' THEN f.final_turn - 1 WHEN 'limit' THEN 8 ELSE f.n_turns END) AS BIGINT)
    AS n_tool_calls
FROM f
"""

ORACLES["validate_targets"] = """
WITH d AS (
  SELECT doc_id, doc_id % 5 AS c, 'pkg_' || CAST(doc_id % 7 AS VARCHAR) AS folder, CAST(doc_id AS VARCHAR) AS k FROM documents),
t AS (
  SELECT doc_id, c, CASE c WHEN 1 THEN folder || '/missing_' || k || '.py' WHEN 2 THEN folder
         WHEN 3 THEN folder || '/mod_' || k || '.txt' ELSE folder || '/mod_' || k || '.py' END AS path FROM d)
SELECT doc_id, path, CASE WHEN c IN (1, 2, 3) THEN 'target' WHEN c = 4 THEN 'range' ELSE 'ok' END AS stage,
  CASE c WHEN 1 THEN 'File not found: ' || path WHEN 2 THEN 'Not a file: ' || path
         WHEN 3 THEN 'Only Python files are supported' WHEN 4 THEN 'Line range must be positive and ascending' END AS error,
  CAST(CASE WHEN c IN (2, 3) THEN 0 ELSE 1 END AS BIGINT) AS python_file
FROM t
"""

ORACLES["normalise_newlines"] = f"""
SELECT doc_id, CAST(len({keepends('text')}) AS BIGINT) AS n_lines,
  CASE WHEN doc_id % 4 = 2 THEN replace(text, chr(10), chr(8232)) ELSE text END AS normalised
FROM documents
"""

ORACLES["index_rules"] = f"""
SELECT 'odd/o_' || {s('p_partkey')} || '.py' AS path,
  CASE WHEN p_partkey % 4 = 3 THEN 'syntax_error' ELSE 'ok' END AS status,
  CAST(CASE WHEN p_partkey % 4 IN (0, 1) THEN 2 END AS BIGINT) AS n_names,
  CASE WHEN p_partkey % 4 = 1 THEN 'parts.p_' || {s('p_partkey')} END AS module,
  CAST(CASE WHEN p_partkey % 4 = 1 THEN 1 END AS BIGINT) AS n_imports,
  CAST(CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 6 END AS BIGINT) AS lineno,
  CAST(CASE WHEN p_partkey % 4 IN (0, 1) THEN 1 ELSE 0 END AS BIGINT) AS found,
  CASE p_partkey % 4 WHEN 0 THEN 'def f():' || chr(10) || '    return ' || {s('p_partkey')}
                     WHEN 1 THEN 'def f(self):' || chr(10) || '        g()' END AS source
FROM part
"""

ORACLES["exclude_sensitive"] = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 4 THEN 'a/.envrc/f_' || CAST(p_partkey AS VARCHAR)
                             ELSE 'a/f_' || CAST(p_partkey AS VARCHAR) || '.py' END AS path
FROM part WHERE p_partkey % 6 IN (4, 5)
"""

ORACLES["argument_violations"] = """
SELECT event_id AS call_id, CASE event_id % 6 WHEN 1 THEN 'file_path is not of type string'
  WHEN 2 THEN 'missing file_path; max_chars is not of type integer' WHEN 3 THEN 'file_path is not of type string'
  ELSE 'file_path is not of type string; max_chars is not of type integer' END AS problems
FROM events WHERE event_id % 6 IN (1, 2, 3, 4)
"""

ORACLES["tool_feedback"] = f"""
SELECT p_partkey AS conv_id, CAST(3 AS BIGINT) AS final_turn, 'answered' AS outcome,
       'answer: def make_' || {s('p_partkey')} || '():' || chr(10) || '    return Part' || {s('p_partkey')} || '()'
         AS final_text
FROM part
"""

ORACLES["review_corpus"] = with_(DOC_FILES_ANNOT, DOC_RESPONSES, PARSED, INJECTED, UPDATED, DOC_REQUESTS, RANGES) + f""",
keys AS (SELECT DISTINCT path, line_key, lineno FROM review_rows),
bad AS (
  SELECT g.doc_id, string_agg(k.line_key, ', ' ORDER BY length(k.line_key), k.line_key) AS offending
  FROM ranges g JOIN keys k ON k.path = g.path
  WHERE g.range_status = 'ok' AND (k.lineno IS NULL OR k.lineno < g.a OR k.lineno > g.b)
  GROUP BY g.doc_id),
doc_decisions AS (
  SELECT {DOC_PATH} AS path, CASE WHEN doc_id % 3 = 0 THEN ' Y ' ELSE 'n' END AS answer
  FROM documents WHERE doc_id % 3 <> 2),
cl AS (
  SELECT path,
         array_to_string(list_filter(ls, lambda l: NOT starts_with({strip('l')}, '# REVIEW:')), '') AS cleaned_text,
         len(ls) - len(list_filter(ls, lambda l: NOT starts_with({strip('l')}, '# REVIEW:'))) AS removed
  FROM (SELECT path, {keepends('content')} AS ls FROM doc_files_a)),
j AS (
  SELECT g.doc_id, g.path, {file_name("u.project", "g.path")} AS f, g.clean, g.dry_run, g.message, g.range_status, u.project, u.content, u.updated, u.mode, u.added,
         b.offending, d.answer, cl.cleaned_text, cl.removed,
         CASE WHEN (g.clean AND g.dry_run) THEN '--clean cannot be used with --dry-run'
              WHEN g.clean AND g.message IS NOT NULL THEN '--clean cannot be used with a review message'
              WHEN NOT g.clean AND g.message IS NULL THEN 'A review message is required unless --clean is set'
              WHEN g.range_status = 'bad_shape' THEN 'Line range must look like A-B'
              WHEN g.range_status = 'bad_order' THEN 'Line range must be positive and ascending' END AS err,
         coalesce(lower({strip('d.answer')}) = 'y', false) AS yes
  FROM ranges g JOIN updated u ON u.path = g.path LEFT JOIN bad b ON b.doc_id = g.doc_id
       LEFT JOIN doc_decisions d ON d.path = g.path JOIN cl ON cl.path = g.path),
o AS (
  SELECT *,
    CASE WHEN err IS NOT NULL THEN 'error'
         WHEN clean THEN 'cleaned'
         WHEN mode = 'invalid' THEN 'error'
         WHEN mode = 'review' AND offending IS NOT NULL THEN 'error'
         WHEN dry_run AND updated = content THEN 'no_changes'
         WHEN dry_run AND yes THEN 'applied'
         WHEN dry_run THEN 'rejected' ELSE 'done' END AS outcome
  FROM j)
SELECT doc_id, path, outcome,
  CASE WHEN err IS NOT NULL THEN err
       WHEN clean THEN {s('removed')} || ' review comments removed from ' || f
       WHEN mode = 'invalid' THEN 'Invalid copilot rewrite response: FILE_END appears before FILE_START'
       WHEN mode = 'review' AND offending IS NOT NULL
         THEN 'Model returned reviews outside requested line range: ' || offending
       WHEN dry_run AND updated = content THEN 'No changes to apply.'
       WHEN dry_run AND NOT yes THEN 'Diff available at review_' || {_STEM.replace('path', 'f')} || '_' || substr(sha1(project || '/' || f), 1, 10) || '.diff'
       WHEN mode = 'rewrite' THEN 'updated ' || f
       ELSE {s('added')} || ' reviews added to ' || f END AS message,
  CAST(CASE WHEN outcome = 'cleaned' THEN cleaned_text <> content
            WHEN outcome = 'applied' THEN true
            WHEN outcome = 'done' THEN updated <> content ELSE false END AS BIGINT) AS written,
  CASE WHEN outcome = 'cleaned' AND cleaned_text <> content THEN cleaned_text
       WHEN outcome = 'applied' OR (outcome = 'done' AND updated <> content) THEN updated
       ELSE content END AS final_content
FROM o
"""


# Outputs that name a document's path name its project too.
for _name in ("inject_reviews", "clean_reviews", "round_trip_check", "review_counts", "validate_requests", "diff_hunks", "clean_hunks",
              "line_changes", "apply_decisions", "review_corpus"):
    ORACLES[_name] = (f"SELECT q.* REPLACE ({file_name('d.source', 'q.path')} AS path), d.source AS project "
                      f"FROM ({ORACLES[_name]}) q JOIN documents d ON q.path = 'doc_' || CAST(d.doc_id AS VARCHAR)")


def summarise_sql(x: str) -> str:
    sx = f"regexp_replace({strip(x)}, '{WS_RUN_RE}', ' ', 'g')"
    return f"(CASE WHEN length({sx}) <= 120 THEN {sx} ELSE substr({sx}, 1, 117) || '...' END)"


ORACLES["turn_progress"] = f"""
SELECT * FROM (
  SELECT user_id AS response_id, event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
    CASE WHEN event_type = 'signup' THEN 'response created: ' || {s('user_id')}
         WHEN event_type = 'error' THEN 'model turn ' || {s('1 + event_id % 8')} || ' in progress'
         WHEN event_type = 'purchase' AND event_id % 2 = 0
           THEN 'model requested tool `search_' || json_extract_string(props, '$.k') || '`'
         WHEN event_type = 'click' THEN 'tool args ready for `lookup_' || json_extract_string(props, '$.k') || '`: '
           || {summarise_sql('props')}
         WHEN event_type = 'view' AND event_id % 9 = 0 THEN 'model turn ' || {s('1 + event_id % 8')} || ' completed'
    END AS message
  FROM events)
WHERE message IS NOT NULL
"""

ORACLES["turn_outcomes"] = """
WITH e AS (
  SELECT user_id AS rid, 1 + event_id % 8 AS turn, event_id, event_type, ts,
    CASE WHEN event_type = 'purchase' AND event_id % 2 = 0
           THEN '{"type":"function_call","name":"search_' || json_extract_string(props, '$.k') || '"}'
         WHEN event_type = 'purchase' THEN '{"type":"message"}'
         WHEN event_type = 'click' THEN '{"name":"lookup_' || json_extract_string(props, '$.k')
           || '","arguments":' || to_json(CAST(props AS VARCHAR)) || '}'
         ELSE props END AS payload
  FROM events),
m AS (
  SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL '1 hour' THEN 0 ELSE 1 END AS brk
  FROM e WINDOW w AS (PARTITION BY rid, turn ORDER BY ts, event_id)),
n AS (
  SELECT *, sum(brk) OVER (PARTITION BY rid, turn ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM m)
SELECT rid AS response_id, turn, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started,
       arg_max(payload, event_id) AS last_payload, max(event_id) AS last_seq, CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS tool_calls,
       CAST(count(*) FILTER (WHERE event_type = 'view' AND event_id % 9 <> 0) AS BIGINT) AS text_deltas
FROM n GROUP BY rid, turn, session
HAVING count(*) FILTER (WHERE event_type = 'view' AND event_id % 9 = 0) > 0
"""

ORACLES["turn_records"] = """
WITH e AS (
  SELECT user_id AS rid, 1 + event_id % 8 AS turn, event_id, event_type, ts, props,
    event_type = 'view' AND event_id % 9 = 0 AS done, event_type = 'view' AND event_id % 9 <> 0 AS delta
  FROM events),
m AS (
  SELECT *, CASE WHEN NOT lag(done) OVER w AND ts <= lag(ts) OVER w + INTERVAL '1 day' THEN 0 ELSE 1 END AS opens
  FROM e WINDOW w AS (PARTITION BY rid, turn ORDER BY ts, event_id)),
n AS (
  SELECT *, sum(opens) OVER (PARTITION BY rid, turn ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS attempt FROM m),
r AS (
  SELECT *, min(ts) OVER w AS started, count(*) OVER w AS n_events, count(*) FILTER (event_type = 'click') OVER w AS calls,
    count(*) FILTER (delta) OVER w AS deltas
  FROM n WINDOW w AS (PARTITION BY rid, turn, attempt ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT rid AS response_id, turn, CASE WHEN done THEN 'outcome' ELSE 'drafting' END AS kind,
       strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started, event_id AS seq, props AS payload, n_events AS events,
       calls AS tool_calls, deltas AS text_deltas
FROM r WHERE done OR delta AND deltas = 1
"""

ORACLES["truncate_content"] = """
SELECT doc_id, max_chars,
  CASE WHEN max_chars <> 0 AND length(text) > max_chars
       THEN (CASE WHEN max_chars > 0 THEN substr(text, 1, max_chars)
                  ELSE substr(text, 1, greatest(length(text) + max_chars, 0)) END)
            || chr(10) || chr(10) || '... truncated at ' || CAST(max_chars AS VARCHAR) || ' characters'
       ELSE text END AS output
FROM (SELECT doc_id, text, doc_id % 200 - 20 AS max_chars FROM documents)
"""

ORACLES["compose_prompts"] = with_(DOC_REQUESTS, RANGES) + f"""
SELECT g.doc_id,
  g.message || CASE WHEN g.range_status = 'ok'
                    THEN chr(10) || chr(10) || 'Only comment on or change lines ' || {s('g.a')} || '-' || {s('g.b')}
                         || '. Ignore all other lines.' ELSE '' END
  || chr(10) || chr(10) || 'Use tools only when the provided context is insufficient.' || chr(10) || chr(10)
  || '## Project Skeleton' || chr(10) || chr(10) || chr(10)
  || '## Target File: ' || {file_name("d.source", DOC_PATH.replace("doc_id", "g.doc_id"))} || chr(10) || {numbered('d.text')} AS prompt,
  CAST(20 AS BIGINT) AS skeleton_chars
FROM ranges g JOIN documents d ON d.doc_id = g.doc_id
WHERE NOT g.clean AND g.message IS NOT NULL AND g.range_status NOT IN ('bad_shape', 'bad_order')
"""


def chunked(entries: str, size: int) -> str:
    """CTE ``skeleton_chunks(project, chunk_no, text)`` of a CTE with project, path and e."""
    return f"""placed AS (
  SELECT project, path, e, CAST(coalesce(sum(length(e) + 1) OVER (
    PARTITION BY project ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // {size} AS chunk_no
  FROM {entries}),
skeleton_chunks AS (
  SELECT project, chunk_no, CASE WHEN chunk_no = 0 THEN '## Project Skeleton' ELSE '' END || chr(10)
    || string_agg(e, chr(10) ORDER BY path) AS text
  FROM placed GROUP BY project, chunk_no)"""


HEAD = """'Review ' || path || chr(10) || chr(10) || 'Use tools only when the provided context is insufficient.'
    || chr(10) || chr(10)"""
_MARKS = [f"CAST('0x' || substr(sha256({s('part')} || ':' || {s('chunk_no')} || ':' || text), {1 + 15 * i}, 15) AS HUGEINT)"
          for i in range(4)]

ORACLES["compose_code_prompts"] = with_(CODE_FILES) + f""",
entries AS (
  SELECT 'shop' AS project, path,
    '### ' || path || chr(10) || 'Part' || {s('p_partkey')} || ', make_' || {s('p_partkey')} || ', price' AS e
  FROM part_files
  UNION ALL SELECT 'shop', path, '### ' || path || chr(10) || 'run' FROM order_files),
{chunked('entries', 16_384)},
imported AS (
  SELECT 'orders/o_' || {s('i.l_orderkey')} || '.py' AS path,
         '## Imported Files' || chr(10) || string_agg(p.content, chr(10) || chr(10) || '---' || chr(10) || chr(10)
                                                       ORDER BY i.rn) AS imported_section
  FROM items i JOIN part_files p ON p.p_partkey = i.l_partkey GROUP BY i.l_orderkey),
targets AS MATERIALIZED (
  SELECT f.path, i.imported_section,
         '## Target File: ' || regexp_extract(f.path, '([^/]*)$', 1) || chr(10) || {numbered('f.content')}
           AS target_section
  FROM code_files f LEFT JOIN imported i USING (path)),
own AS (
  SELECT path, 0 AS part, 0 AS chunk_no, {HEAD} AS text FROM targets
  UNION ALL SELECT path, 2, 0, chr(10) || chr(10) || imported_section FROM targets WHERE imported_section IS NOT NULL
  UNION ALL SELECT path, 3, 0, chr(10) || chr(10) || target_section FROM targets),
own_sums AS (
  SELECT path, sum({_MARKS[0]}) AS m0, sum({_MARKS[1]}) AS m1, sum({_MARKS[2]}) AS m2, sum({_MARKS[3]}) AS m3,
         sum(length(text)) AS chars, count(*) AS n FROM own GROUP BY path),
shared AS (
  SELECT sum({_MARKS[0]}) AS m0, sum({_MARKS[1]}) AS m1, sum({_MARKS[2]}) AS m2, sum({_MARKS[3]}) AS m3,
         sum(length(text)) AS chars, count(*) AS n FROM (SELECT 1 AS part, chunk_no, text FROM skeleton_chunks))
SELECT o.path, CAST(o.m0 + h.m0 AS VARCHAR) || '-' || CAST(o.m1 + h.m1 AS VARCHAR) || '-' || CAST(o.m2 + h.m2 AS VARCHAR)
         || '-' || CAST(o.m3 + h.m3 AS VARCHAR) AS prompt_digest,
       CAST(o.chars + h.chars AS BIGINT) AS prompt_chars, CAST(o.n + h.n AS BIGINT) AS n_chunks,
       CAST(h.chars AS BIGINT) AS skeleton_chars,
       CAST(CASE WHEN t.imported_section IS NULL THEN 0 ELSE 1 END AS BIGINT) AS has_imported,
       CAST(h.chars + coalesce(length(t.imported_section) + 2, 0) + 2 + length(t.target_section) AS BIGINT) AS context_chars
FROM own_sums o JOIN targets t USING (path) CROSS JOIN shared h
"""

# Projects that hold their orders and copies of the parts these import (sources.tables.vendored_files).
VENDORED = CODE_FILES + f""",
v_orders AS (
  SELECT 'vendor_' || {s('o.o_custkey')} AS project, f.* FROM orders o JOIN order_files f ON f.o_orderkey = o.o_orderkey),
v_parts AS (
  SELECT DISTINCT 'vendor_' || {s('o.o_custkey')} AS project, p.p_partkey, p.path, p.content
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part_files p ON p.p_partkey = l.l_partkey),
v_entries AS (
  SELECT project, path, 3 AS n_names,
    '### ' || path || chr(10) || 'Part' || {s('p_partkey')} || ', make_' || {s('p_partkey')} || ', price' AS e FROM v_parts
  UNION ALL SELECT project, path, 1, '### ' || path || chr(10) || 'run' FROM v_orders)"""

ORACLES["vendored_contents"] = with_(VENDORED) + """,
f AS (SELECT project, content FROM v_orders UNION ALL SELECT project, content FROM v_parts)
SELECT project, count(*) AS n_files, count(DISTINCT content) AS n_contents FROM f GROUP BY project
UNION ALL SELECT 'all parsed', count(DISTINCT content), count(DISTINCT content) FROM f
"""

ORACLES["vendored_skeleton"] = with_(VENDORED) + """
SELECT project, path, CAST(n_names AS BIGINT) AS n_names, e AS entry FROM v_entries
"""

_V_HITS = with_(VENDORED) + f""",
v_hits AS (
  SELECT project, 'make_' || {s('p_partkey')} AS symbol, 'DEFINED' AS kind, path, 5 AS lineno FROM v_parts
  UNION ALL SELECT project, 'run', 'DEFINED', path, n + 2 FROM v_orders
  UNION ALL SELECT v.project, 'make_' || {s('i.l_partkey')}, 'CALLED', v.path, n + 2 + i.rn
  FROM v_orders v JOIN (SELECT l_orderkey, l_partkey, rn FROM items) i ON i.l_orderkey = v.o_orderkey),
asked AS (
  SELECT DISTINCT 'vendor_' || {s('o_custkey')} AS project, unnest(['run', 'make_' || {s('o_orderkey % 50')}]) AS symbol
  FROM orders),
found AS (
  SELECT a.project, a.symbol, h.kind, h.path, CAST(h.lineno AS BIGINT) AS lineno,
         rpad(h.kind, 9, ' ') || h.path || ':' || {s('h.lineno')} AS hit
  FROM asked a JOIN v_hits h ON h.project = a.project AND h.symbol = a.symbol
  UNION ALL
  SELECT a.project, a.symbol, 'NONE', NULL, NULL, '''' || a.symbol || ''' not found in project'
  FROM asked a WHERE NOT EXISTS (SELECT 1 FROM v_hits h WHERE h.project = a.project AND h.symbol = a.symbol))"""

ORACLES["vendored_symbols"] = _V_HITS + """
SELECT project, symbol, kind, path, lineno, hit FROM found
"""

ORACLES["ordered_search"] = _V_HITS + """
SELECT row_number() OVER (ORDER BY project, symbol, path NULLS LAST, lineno) AS position, project, symbol, hit FROM found
"""

ORACLES["vendored_definitions"] = with_(VENDORED) + f"""
SELECT project, path, 'run' AS name, CAST(n + 2 AS BIGINT) AS lineno, CAST(1 AS BIGINT) AS found, run_source AS output
FROM v_orders
UNION ALL
SELECT project, path, 'make_' || {s('p_partkey')}, 5, 1,
       'def make_' || {s('p_partkey')} || '():' || chr(10) || '    return Part' || {s('p_partkey')} || '()' FROM v_parts
"""

ORACLES["vendored_prompts"] = with_(VENDORED) + f""",
{chunked('v_entries', 1_000)},
imported AS (
  SELECT i.l_orderkey,
         '## Imported Files' || chr(10) || string_agg(p.content, chr(10) || chr(10) || '---' || chr(10) || chr(10)
                                                       ORDER BY i.rn) AS section
  FROM items i JOIN part_files p ON p.p_partkey = i.l_partkey GROUP BY i.l_orderkey)
SELECT project, path, CAST(0 AS BIGINT) AS part, CAST(0 AS BIGINT) AS chunk_no, {HEAD} AS text FROM v_orders
UNION ALL SELECT o.project, o.path, 1, k.chunk_no, k.text FROM v_orders o JOIN skeleton_chunks k ON k.project = o.project
UNION ALL SELECT o.project, o.path, 2, 0, chr(10) || chr(10) || i.section FROM v_orders o JOIN imported i ON i.l_orderkey = o.o_orderkey
UNION ALL
SELECT project, path, 3, 0, chr(10) || chr(10) || '## Target File: ' || regexp_extract(path, '([^/]*)$', 1) || chr(10)
       || {numbered('content')}
FROM v_orders
"""
