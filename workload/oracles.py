"""Checking SQL for DuckDB. It starts from the same derived inputs and states the expected results on its own:
renames as the outcome per kind of dataset, fuzzy operators as comparisons of all pairs."""

from __future__ import annotations

from tabaudit.operators.catalog import (
    EMPTY_DETAIL,
    EMPTY_DETAIL_MESSAGE,
    EMPTY_FINGERPRINT,
    EMPTY_FINGERPRINT_MESSAGE,
    FETCH_ERROR,
    IDENTICAL,
)
from tabaudit.operators.schema import NO_YEAR_ISSUE
from workload import inputs
from workload.inputs import CODE_VALUE, LEGACY_COLUMNS, PLACE_VALUE, YEAR_VALUE

# --- ragged order rows ---------------------------------------------------------------------------------------------

BASE = f"""base AS (SELECT 'ds_' || o_custkey AS dataset_id, o_custkey, o_orderkey AS row_no, o_custkey % 40 AS c,
 {YEAR_VALUE} AS year_value, {CODE_VALUE} AS code_value, {PLACE_VALUE} AS place_value,
 cast(cast(floor(o_totalprice) AS bigint) AS string) AS jml, o_orderstatus, o_orderpriority FROM orders)"""
CELLS = "cells AS (" + " UNION ALL ".join(
    f"SELECT 'ds_' || o_custkey AS dataset_id, o_orderkey AS row_no, o_custkey % 40 AS c, {pos} AS pos, '{name}' AS k, {value} AS v "
    f"FROM orders WHERE {exists}"
    for pos, (name, value, exists) in enumerate(LEGACY_COLUMNS)
) + ")"
COLUMNS = f"""{CELLS}, cols AS (SELECT dataset_id, c, k, row_number() OVER (PARTITION BY dataset_id ORDER BY pos) - 1 AS ord
 FROM (SELECT DISTINCT dataset_id, c, pos, k FROM cells))"""
NEW_NAME = """CASE WHEN k = 'tahun_data' OR (k = 'thn' AND c <> 10) OR k = 'Tahun' THEN 'tahun' WHEN k = 'thn' THEN 'thn'
 WHEN k = 'Tahun ' THEN k WHEN k = 'kod_wil' AND c <> 13 THEN 'kode_wilayah' WHEN k = 'Kab_Kota' THEN 'nama_wilayah'
 WHEN k = 'jml' THEN 'jumlah' ELSE lower(k) END"""
METHOD = """CASE WHEN new = k THEN '' WHEN k IN ('Tahun', 'Tahun Ajaran', 'Nama', 'Keterangn', 'Prioritas') THEN 'lowercase'
 ELSE 'explicit_alias' END"""
HAS_YEAR = "c NOT IN (5, 6, 7)"
N_YEARS = "CASE WHEN c IN (5, 6, 7) THEN 0 WHEN c IN (10, 11) THEN 2 ELSE 1 END"
N_KEYS = f"({N_YEARS}) + (CASE c WHEN 13 THEN 2 WHEN 14 THEN 0 ELSE 1 END) + 3 + (CASE WHEN c IN (15, 16) THEN 1 ELSE 0 END)"
N_KEYS_LAST = f"(CASE WHEN {HAS_YEAR} THEN 1 ELSE 0 END) + (CASE c WHEN 14 THEN 0 ELSE 1 END) + 3 + (CASE WHEN c IN (15, 16) THEN 1 ELSE 0 END)"


def _dotted(value: str) -> str:
    return f"""CASE WHEN regexp_full_match(trim({value}), '[0-9]+') AND length(trim({value})) >= 4 THEN substr(trim({value}), 1, 2) || '.' ||
 substr(trim({value}), 3, 2) || CASE WHEN length(trim({value})) >= 6 THEN '.' || substr(trim({value}), 5, 2) ELSE '' END ||
 CASE WHEN length(trim({value})) >= 8 THEN '.' || substr(trim({value}), 7) ELSE '' END ELSE {value} END"""


ASSESSED = f"""{BASE}, judged AS (SELECT *, {HAS_YEAR} AND trim(coalesce(year_value, '')) = '' AS no_year,
 c <> 14 AND trim(coalesce(code_value, '')) = '' AS no_code, {HAS_YEAR} AND coalesce(try_cast(year_value AS double) NOT BETWEEN 2000 AND 2025, false) AS odd
 FROM base),
assessed AS (SELECT *, CASE WHEN no_year OR no_code THEN 'flagged' ELSE 'ready' END AS migration_status,
 concat_ws(' | ', CASE WHEN no_year THEN 'Missing ''tahun''' END, CASE WHEN no_code THEN 'Missing ''kode_wilayah''' END,
 CASE WHEN odd THEN 'WARNING: tahun di luar range [2000-2025]' END) AS flag_reason FROM judged)"""
ISSUES = f"""concat_ws(' | ', CASE WHEN c IN (5, 6, 7) THEN '{NO_YEAR_ISSUE} | Missing required columns: [''tahun'']' END,
 CASE WHEN c = 14 THEN 'Missing required columns: [''kode_wilayah'']' END, CASE WHEN c = 15 THEN 'Duplicate columns dropped: [''nama'']' END)"""
QUALITY = f"""{ASSESSED}, counted AS (SELECT dataset_id, count(*) AS n, count(*) FILTER (WHERE migration_status = 'flagged') AS bad FROM assessed GROUP BY 1),
quality AS (SELECT 'ds_' || c_custkey AS Dataset_Id, 'Data ' || c_name AS Judul_Tabel, false AS Catalog_Suspect, coalesce(n, 0) AS Total_Rows,
 coalesce(bad, 0) AS Baris_Bermasalah, coalesce(n - bad, 0) AS Baris_Siap_Load,
 CASE WHEN n IS NULL THEN 'Tabel Kosong (0 baris)' ELSE (SELECT {ISSUES} FROM (SELECT c_custkey % 40 AS c)) END AS Schema_Issues,
 CASE WHEN n IS NULL THEN 'skipped' WHEN bad > 0 THEN 'manager_review_required' ELSE 'ready_for_load' END AS Load_Decision
 FROM customer LEFT JOIN counted ON dataset_id = 'ds_' || c_custkey)"""
CLEAN_VALUES = f"""CASE WHEN {HAS_YEAR} THEN trim(year_value) END AS tahun, CASE WHEN c <> 14 THEN {_dotted('trim(code_value)')} END AS kode_wilayah"""

# --- titles and their scores ---------------------------------------------------------------------------------------


def _normal(title: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({title}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"


def _tokens(text: str) -> str:
    return rf"array_to_string(list_sort(list_filter(regexp_split_to_array(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_]', ' ', 'g'), ' +'), lambda w: w <> '')), ' ')"


def _patterns(source: str) -> str:
    """Strings of ``source(x)`` as characters, length, and position masks for a bit-parallel subsequence (up to 125)."""
    return f"""SELECT x, string_split(x, '') AS chars, length(x) AS n, list_transform(string_split('abcdefghilmnoprstu ', ''), lambda ch: length(x) - length(replace(x, ch, ''))) AS bag, CASE WHEN length(x) <= 125 THEN (1::HUGEINT << length(x)) - 1 ELSE 0::HUGEINT END AS full_mask,
 CASE WHEN length(x) BETWEEN 1 AND 125 THEN map(list_distinct(string_split(x, '')), list_transform(list_distinct(string_split(x, '')), lambda ch:
 list_sum(list_transform(range(length(x)), lambda i: CASE WHEN substr(x, i + 1, 1) = ch THEN (1::HUGEINT << i) ELSE 0::HUGEINT END))::HUGEINT)) END AS masks
 FROM (SELECT DISTINCT x FROM {source})"""


def _lcs(p: str, t: str) -> str:
    """Longest common subsequence of pattern row ``p`` (up to 125 characters) and string row ``t``."""
    return f"""({p}.n - bit_count(list_reduce(list_transform({t}.chars, lambda ch: coalesce({p}.masks[ch], 0::HUGEINT)),
 lambda v, m: ((v + (v & m)) | (v - (v & m))) & {p}.full_mask, {p}.full_mask)))"""


def _lcs_long(p: str, t: str) -> str:
    """The same for long patterns, by the table of prefixes, row by row."""
    return f"""list_reduce(range(1, {p}.n + 1), lambda prev, i: list_reduce(range(1, {t}.n + 1), lambda cur, j: list_append(cur,
 CASE WHEN {p}.chars[i] = {t}.chars[j] THEN prev[j] + 1 ELSE greatest(prev[j + 1], cur[j]) END), [0::BIGINT]),
 list_transform(range(0, {t}.n + 1), lambda z: 0::BIGINT))[{t}.n + 1]"""


def _score(lcs: str, p: str, t: str) -> str:
    return f"cast(round_even(200.0 * {lcs} / ({p}.n + {t}.n), 0) AS INTEGER)"


def _budget(p: str, t: str, threshold: int) -> str:
    return f"({p}.n + {t}.n - 2 * (({2 * threshold - 1} * ({p}.n + {t}.n) + 399) // 400))"


def _close(p: str, t: str, threshold: int) -> str:
    """Necessary for the threshold: edit distance within the budget. The distance counts bytes, hence the factor for
    strings beyond ASCII."""
    wide = f"CASE WHEN strlen({p}.x) = {p}.n AND strlen({t}.x) = {t}.n THEN 1 ELSE 3 END"
    return f"CASE WHEN abs({p}.n - {t}.n) > {_budget(p, t, threshold)} THEN false ELSE levenshtein({p}.x, {t}.x) <= {wide} * {_budget(p, t, threshold)} END"


def _all_scores(pairs: str, pats: str, threshold: int) -> str:
    """Text scores ``(ax, bx, score)`` of the different non-empty ``pairs(ax, bx)`` that may reach the threshold."""
    bag = "list_sum(list_transform(range(1, 20), lambda i: abs(p.bag[i] - t.bag[i])))"
    return f"""{pairs}_alike AS MATERIALIZED (SELECT ax, bx FROM {pairs} JOIN {pats} p ON p.x = ax JOIN {pats} t ON t.x = bx
 WHERE p.n > 0 AND t.n > 0 AND ax <> bx AND abs(p.n - t.n) <= {_budget('p', 't', threshold)} AND {bag} <= {_budget('p', 't', threshold)}),
{pairs}_near AS MATERIALIZED (SELECT ax, bx, CASE WHEN p.n <= t.n THEN ax ELSE bx END AS px, CASE WHEN p.n <= t.n THEN bx ELSE ax END AS tx
 FROM {pairs}_alike JOIN {pats} p ON p.x = ax JOIN {pats} t ON t.x = bx WHERE {_close('p', 't', threshold)}),
{pairs}_short AS MATERIALIZED (SELECT * FROM {pairs}_near WHERE length(px) <= 125), {pairs}_long AS MATERIALIZED (SELECT * FROM {pairs}_near WHERE length(px) > 125),
{pairs}_scores AS (SELECT ax, bx, {_score(_lcs('p', 't'), 'p', 't')} AS score FROM {pairs}_short JOIN {pats} p ON p.x = px JOIN {pats} t ON t.x = tx
 UNION ALL SELECT ax, bx, {_score(_lcs_long('p', 't'), 'p', 't')} FROM {pairs}_long JOIN {pats} p ON p.x = px JOIN {pats} t ON t.x = tx)"""


def _titles(source: str, threshold: int) -> str:
    return f"""cat AS ({source}), titled AS (SELECT *, {_normal('judul')} AS title, {_tokens(_normal('judul'))} AS x FROM cat),
pats AS MATERIALIZED ({_patterns('titled')}), nodes AS (SELECT min(ord) AS node, x FROM titled GROUP BY x),
tpairs AS (SELECT a.x AS ax, b.x AS bx FROM nodes a JOIN nodes b ON a.node < b.node), {_all_scores('tpairs', 'pats', threshold)},
edges AS MATERIALIZED (SELECT a.node AS a, b.node AS b, ax, bx, score FROM tpairs_scores JOIN nodes a ON a.x = ax JOIN nodes b ON b.x = bx WHERE score >= {threshold})"""


def _groups(source: str, threshold: int) -> str:
    return f"""{_titles(source, threshold)},
steps AS (SELECT list({{'id': node, 'nb': coalesce((SELECT list(a) FROM edges WHERE b = node), []::BIGINT[])}} ORDER BY node) AS l FROM nodes),
led AS (SELECT list_reduce(l, lambda acc, s: {{'id': s.id, 'nb': CASE WHEN list_has_any(acc.nb, s.nb) THEN acc.nb ELSE list_append(acc.nb, s.id) END}},
 {{'id': -1::BIGINT, 'nb': []::BIGINT[]}}).nb AS leaders FROM steps),
placed AS (SELECT node, x, coalesce(CASE WHEN list_contains(leaders, node) THEN node END, (SELECT min(a) FROM edges WHERE b = node AND list_contains(leaders, a))) AS group_ord FROM nodes, led),
members AS (SELECT group_ord, id AS dataset_id, ord, judul, title, count(*) OVER (PARTITION BY group_ord) AS n FROM titled JOIN placed USING (x)),
groups AS (SELECT m.group_ord, h.title AS base_title, m.dataset_id, m.ord, m.judul FROM members m JOIN members h ON h.ord = m.group_ord WHERE m.n > 1)"""


PAGE_CATALOG = f"SELECT page_id AS ord, cast(page_id AS string) AS id, regexp_extract(html, '{inputs.TITLE}', 1) AS judul FROM pages"
DOCUMENT_CATALOG = r"SELECT doc_id AS ord, cast(doc_id AS string) AS id, string_split_regex(text, '[.\n]')[1] AS judul FROM documents"
PART_CATALOG = "SELECT p_partkey AS ord, cast(p_partkey AS string) AS id, p_name AS judul FROM part"
LINE_CATALOG = "SELECT doc_id AS ord, cast(doc_id AS string) AS id, string_split(text, chr(10))[1] AS judul FROM documents"
TITLES, GROUPS = _titles(DOCUMENT_CATALOG, 85), _groups(DOCUMENT_CATALOG, 85)


def _sentences(identity: str, text: str, table: str, first: int) -> str:
    return rf"""split AS (SELECT cast({identity} AS string) AS dataset_id, string_split_regex({text}, '[.\n]') AS parts FROM {table}),
numbered AS (SELECT dataset_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS row_no FROM split),
sentences AS (SELECT dataset_id, row_no, trim(part) AS teks FROM numbered WHERE row_no >= {first} AND trim(part) <> '')"""


PAGE_SENTENCES = _sentences("page_id", "regexp_replace(html, '<[^>]*>', chr(10), 'g')", "pages", 0)
SENTENCES = _sentences("doc_id", "text", "documents", 1)
# A sample of five rows can only reach 98 if every row has a match of at least 80 (100 - 5 * 4), so row scores that
# cannot reach 80 need no exact value.
PAIRS = f"""{GROUPS}, {SENTENCES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY row_no) AS rk FROM sentences),
prints AS (SELECT g.group_ord, g.ord, r.dataset_id, 'Teks=' || lower(teks) AS x FROM ranked r JOIN groups g USING (dataset_id) WHERE rk <= 5),
samples AS (SELECT group_ord, ord, dataset_id, list(x ORDER BY x) AS xs FROM prints GROUP BY ALL),
classed AS (SELECT *, min(ord) OVER (PARTITION BY group_ord, xs) AS class FROM samples),
classes AS (SELECT DISTINCT group_ord, class, xs FROM classed), rowpats AS MATERIALIZED ({_patterns('prints')}),
class_rows AS (SELECT group_ord, class, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM classes),
rpairs AS (SELECT DISTINCT a.x AS ax, b.x AS bx FROM class_rows a JOIN class_rows b ON a.group_ord = b.group_ord AND a.class < b.class),
{_all_scores('rpairs', 'rowpats', 80)},
row_scores AS (SELECT a.group_ord, a.class AS a_class, b.class AS b_class, a.i AS ai, b.i AS bi,
 CASE WHEN a.x = b.x THEN 100 ELSE coalesce(score, 0) END AS s
 FROM class_rows a JOIN class_rows b ON a.group_ord = b.group_ord AND a.class < b.class LEFT JOIN rpairs_scores ON ax = a.x AND bx = b.x),
forward AS (SELECT group_ord, a_class, b_class, avg(m) AS f FROM (SELECT group_ord, a_class, b_class, ai, max(s) AS m FROM row_scores GROUP BY ALL) GROUP BY ALL),
backward AS (SELECT group_ord, a_class, b_class, avg(m) AS f FROM (SELECT group_ord, a_class, b_class, bi, max(s) AS m FROM row_scores GROUP BY ALL) GROUP BY ALL),
class_pairs AS (SELECT group_ord, a_class, b_class, (forward.f + backward.f) / 2 AS similarity FROM forward JOIN backward USING (group_ord, a_class, b_class)),
dups AS (SELECT a.dataset_id AS a_id, b.dataset_id AS b_id, a.group_ord, CASE WHEN a.class = b.class THEN 100.0 ELSE similarity END AS similarity
 FROM classed a JOIN classed b ON a.group_ord = b.group_ord AND a.ord < b.ord
 LEFT JOIN class_pairs p ON p.group_ord = a.group_ord AND p.a_class = least(a.class, b.class) AND p.b_class = greatest(a.class, b.class)
 WHERE a.class = b.class OR similarity >= 98)"""

# --- mapping -------------------------------------------------------------------------------------------------------

BEST = rf"""old AS (SELECT cast(page_id AS string) AS old_id, regexp_extract(html, '{inputs.TITLE}', 1) AS old_title, {_tokens(f"regexp_extract(html, '{inputs.TITLE}', 1)")} AS x FROM pages),
new AS (SELECT doc_id AS ord, cast(doc_id AS string) AS id, string_split_regex(text, '[.\n]')[1] AS judul, {_tokens("string_split_regex(text, '[.\n]')[1]")} AS x FROM documents),
firsts AS (SELECT x, min(ord) AS ord, arg_min(id, ord) AS id, arg_min(judul, ord) AS judul FROM new GROUP BY x),
old_pats AS ({_patterns('old')}), new_chars AS (SELECT x, ord, id, judul, string_split(x, '') AS chars, length(x) AS n FROM firsts),
scored AS (SELECT p.x, t.ord, t.id, t.judul, {_score(_lcs('p', 't'), 'p', 't')} AS score FROM old_pats p, new_chars t WHERE p.n > 0 AND t.n > 0),
best AS (SELECT * FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY x ORDER BY score DESC, ord) = 1),
mapping AS (SELECT old_id, old_title, id AS new_id, judul AS new_title, score AS match_score FROM old JOIN best USING (x) WHERE score >= 85)"""

# --- payloads and progress -----------------------------------------------------------------------------------------

CLASSIFIED = f"""{BASE}, classified AS (SELECT *, cast(c_custkey * 10 AS string) AS target_id, trunc(try_cast(year_value AS double))::INTEGER AS tahun_data,
 CASE WHEN c_custkey IS NULL THEN 'unmapped_dataset' WHEN c IN (5, 6, 7, 12) OR year_value IS NULL THEN 'missing_year'
 WHEN try_cast(year_value AS double) IS NULL THEN 'invalid_year' END AS reject_reason
 FROM base JOIN customer k ON k.c_custkey = o_custkey LEFT JOIN (SELECT c_custkey AS mapped FROM customer WHERE c_acctbal >= 0) ON mapped = o_custkey)"""
CLASSIFIED = CLASSIFIED.replace("CASE WHEN c_custkey IS NULL", "CASE WHEN mapped IS NULL")
LATEST = """latest AS (SELECT cast(user_id AS string) AS new_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial' ELSE 'done' END AS status,
 cast(json_extract_string(props, '$.k') AS BIGINT) AS rows_sent, cast(day(ts) AS INTEGER) AS batch_number FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day(ts) DESC, event_id DESC) = 1)"""
OUTCOMES = """outcomes AS (SELECT cast(user_id * 31 + day(ts) AS string) AS target_id, cast(user_id AS string) AS old_id, event_id AS tahun_data, event_id % 3 AS chunk, props,
 event_type <> 'error' AS ok, cast(json_extract_string(props, '$.k') AS BIGINT) AS n_rows FROM events)"""
FOLD = f"""{OUTCOMES}, fold AS (SELECT target_id, min(old_id) AS old_id, count(DISTINCT old_id) > 1 AS collision,
 CASE WHEN bool_and(ok) THEN 'done' WHEN NOT bool_or(ok) THEN 'failed' ELSE 'partial' END AS status, count(*) FILTER (WHERE ok) AS n_ok,
 count(*) FILTER (WHERE NOT ok) AS n_failed, cast(coalesce(sum(n_rows) FILTER (WHERE ok), 0) AS BIGINT) AS rows_sent FROM outcomes GROUP BY 1)"""
STATUS = f"""{LATEST}, status AS (SELECT cast(c_custkey AS string) AS id, c_custkey AS ord, c_name AS judul, coalesce(upper(status), 'NEW') AS status
 FROM customer LEFT JOIN latest ON new_id = cast(c_custkey AS string))"""
TURNS = "turns AS (SELECT *, min(turn) FILTER (WHERE length(text) % 17 = 0) OVER (PARTITION BY conv_id) AS bad FROM conversations)"

_STATUS_OF = "SELECT dataset_id, row_no, CASE WHEN {0} THEN 'flagged' ELSE 'pending' END AS migration_status, CASE WHEN {0} THEN '{1}' ELSE '' END AS flag_reason"

ORACLES: dict[str, str] = {
    "page_scan": "SELECT cast(c_custkey // 100 + 1 AS INTEGER) AS page, cast(c_custkey AS string) AS id, c_name AS judul, c_mktsegment AS segmen FROM customer",
    "detail_scan": f"WITH {TURNS} SELECT cast(conv_id AS string) AS dataset_id, cast(turn AS string) AS turn, role, md5(text) AS text_md5 FROM turns",
    "prefix_until_bad_page": f"""WITH {TURNS} SELECT cast(conv_id AS string) AS dataset_id, count(*) AS n_rows, cast(max(turn) AS INTEGER) AS last_turn
 FROM turns WHERE bad IS NULL OR turn < bad GROUP BY 1""",
    "target_catalog_scan": "SELECT 4294967296 + row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 100 ORDER BY s_suppkey) - 1 AS ord, cast(s_suppkey AS string) AS id, s_name AS judul FROM supplier",
    "keyword_filter": f"""SELECT page_id AS ord, cast(page_id AS string) AS id, regexp_extract(html, '{inputs.TITLE}', 1) AS judul FROM pages
 WHERE lower(regexp_extract(html, '{inputs.TITLE}', 1)) LIKE '%the%' OR lower(regexp_extract(html, '{inputs.TITLE}', 1)) LIKE '%aux%'""",
    "catalog_head": "SELECT c_custkey AS ord, 'ds_' || c_custkey AS id, 'Data ' || c_name AS judul FROM customer ORDER BY c_custkey LIMIT 100",
    "ready_contract_scan": f"WITH {BASE} SELECT dataset_id, row_no, jml, place_value AS kab_kota, CASE WHEN c <> 14 THEN code_value END AS kod_wil FROM base",
    "rename_plan": f"WITH {COLUMNS}, named AS (SELECT *, {NEW_NAME} AS new FROM cols) SELECT dataset_id, cast(ord AS INTEGER) AS ord, k AS old, new, {METHOD} AS method FROM named",
    "rename_apply": f"""WITH {BASE} SELECT dataset_id, row_no, CASE WHEN {HAS_YEAR} THEN year_value END AS tahun, CASE WHEN c <> 14 THEN code_value END AS kode_wilayah,
 place_value AS nama_wilayah, jml AS jumlah, CASE WHEN c = 15 THEN o_orderstatus END AS nama, o_orderpriority AS prioritas,
 CASE WHEN c = 13 THEN code_value END AS kod_wil, CASE WHEN c = 10 THEN year_value END AS thn, cast({N_KEYS} AS INTEGER) AS n_keys FROM base""",
    "rename_report": f"""WITH {COLUMNS}, named AS (SELECT *, {NEW_NAME} AS new FROM cols),
 final AS (SELECT k AS old_column, CASE WHEN k = 'Tahun Ajaran' THEN 'tahun' ELSE new END AS new_column, CASE WHEN k = 'Tahun Ajaran' THEN 'year_contains' ELSE {METHOD} END AS match_method FROM named)
 SELECT old_column, new_column, match_method, 100 AS match_score, count(*) AS n_datasets FROM final WHERE match_method <> '' GROUP BY ALL""",
    "year_column": """SELECT 'ds_' || o_custkey AS dataset_id, CASE WHEN c < 5 THEN 'tahun_data' WHEN c < 8 THEN '' WHEN c < 11 THEN 'Tahun' WHEN c = 12 THEN 'Tahun Ajaran' ELSE 'thn' END AS year_col,
 CASE WHEN c IN (5, 6, 7) THEN '' WHEN c = 12 THEN 'contains' ELSE 'pattern' END AS method FROM (SELECT DISTINCT o_custkey, o_custkey % 40 AS c FROM orders)""",
    "schema_issues": f"SELECT 'ds_' || o_custkey AS dataset_id, {ISSUES} AS Schema_Issues FROM (SELECT DISTINCT o_custkey, o_custkey % 40 AS c FROM orders)",
    "key_normalize_plan": f"""WITH {COLUMNS}, named AS (SELECT *, CASE WHEN k IN ('tahun_data', 'thn', 'Tahun', 'Tahun ') THEN 'tahun' WHEN k = 'kod_wil' THEN 'kode_wilayah'
 WHEN k = 'Kab_Kota' THEN 'nama_wilayah' WHEN k = 'jml' THEN 'jumlah' WHEN k = 'Keterangn' THEN 'keterangan' ELSE lower(k) END AS new,
 CASE WHEN k IN ('tahun_data', 'thn', 'kod_wil', 'Kab_Kota', 'jml') THEN 'explicit_alias' WHEN k IN ('Tahun', 'Tahun ', 'Prioritas') THEN 'case_normalize'
 WHEN k = 'Keterangn' THEN 'fuzzy_match' WHEN k IN ('Tahun Ajaran', 'Nama') THEN 'lowercase_fallback' ELSE '' END AS method FROM cols)
 SELECT dataset_id, k AS old, new, method, cast(CASE method WHEN '' THEN -1 WHEN 'fuzzy_match' THEN 95 WHEN 'lowercase_fallback' THEN 0 ELSE 100 END AS INTEGER) AS score,
 ord <> max(ord) OVER (PARTITION BY dataset_id, new) AS dropped FROM named""",
    "key_normalize_apply": f"""WITH {BASE} SELECT dataset_id, row_no, CASE WHEN {HAS_YEAR} AND c <> 12 THEN year_value END AS tahun, CASE WHEN c <> 14 THEN code_value END AS kode_wilayah,
 place_value AS nama_wilayah, jml AS jumlah, CASE WHEN c = 15 THEN o_orderpriority END AS nama, o_orderpriority AS prioritas,
 CASE WHEN c = 16 THEN o_orderpriority END AS keterangan, cast({N_KEYS_LAST} AS INTEGER) AS n_keys FROM base""",
    "whitespace_clean": r"""SELECT cast(doc_id AS string) AS dataset_id, cast(length(t) AS INTEGER) AS n_chars, md5(t) AS md5
 FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)""",
    "region_code": f"WITH {BASE} SELECT dataset_id, row_no, CASE WHEN c <> 14 THEN {_dotted('code_value')} END AS kod_wil FROM base",
    "change_log": f"""WITH {CELLS}, seen AS (SELECT dataset_id, k, v, regexp_replace(trim(v), ' +', ' ', 'g') AS w FROM cells),
 fixed AS (SELECT *, k = 'kod_wil' AND {_dotted('w')} <> w AS hit FROM seen)
 SELECT dataset_id, 'whitespace_strip' AS action, k AS target, count(*) AS n_changed, cast(0 AS BIGINT) AS n_lossy FROM seen WHERE v <> w GROUP BY ALL
 UNION ALL SELECT dataset_id, 'kode_wilayah_fix', k, count(*), count(*) FILTER (WHERE length(w) IN (5, 7)) FROM fixed WHERE hit GROUP BY ALL""",
    "flag_missing": f"""WITH {ASSESSED} SELECT dataset_id, row_no, CASE WHEN no_year OR no_code THEN 'flagged' ELSE 'pending' END AS migration_status,
 concat_ws(' | ', CASE WHEN no_year THEN 'Missing ''tahun''' END, CASE WHEN no_code THEN 'Missing ''kode_wilayah''' END) AS flag_reason FROM assessed""",
    "flag_duplicates": f"WITH {BASE}, n AS (SELECT *, c <> 14 AND count(*) OVER (PARTITION BY dataset_id, code_value, place_value) > 1 AS hit FROM base) "
    + _STATUS_OF.format("hit", "Duplicate subset: [''kod_wil'', ''Kab_Kota'']") + " FROM n",
    "duplicate_check_issues": """SELECT 'ds_' || o_custkey AS dataset_id, 'Duplicate check skipped, missing columns: [' ||
 concat_ws(', ', CASE WHEN c = 14 THEN '''kod_wil''' END, CASE WHEN c < 10 OR c = 12 THEN '''thn''' END) || ']' AS issue
 FROM (SELECT DISTINCT o_custkey, o_custkey % 40 AS c FROM orders) WHERE c < 10 OR c IN (12, 14)""",
    "custom_rule": f"WITH {BASE} " + _STATUS_OF.format("jml::BIGINT > 200000", "jumlah terlalu besar") + " FROM base",
    "warn_year": f"""WITH {BASE} SELECT dataset_id, row_no, 'pending' AS migration_status,
 CASE WHEN (c IN (10, 11) OR c > 12) AND try_cast(year_value AS double) NOT BETWEEN 2000 AND 2003 THEN 'WARNING: tahun di luar range [2000-2003]' ELSE '' END AS flag_reason FROM base""",
    "assess_rows": f"WITH {ASSESSED} SELECT dataset_id, row_no, migration_status, flag_reason FROM assessed",
    "gate_select": f"WITH {ASSESSED} SELECT dataset_id, row_no, migration_status, flag_reason FROM assessed WHERE migration_status = 'ready'",
    "gate_summary": f"""WITH {ASSESSED} SELECT count(*) AS total_rows, count(*) FILTER (WHERE migration_status = 'ready') AS loadable_rows,
 count(*) FILTER (WHERE migration_status <> 'ready') AS blocked_rows FROM assessed""",
    "quality_report": f"WITH {QUALITY} SELECT * FROM quality",
    "load_summary": f"""WITH {QUALITY} SELECT count(*) AS Total_Dataset_Dinilai, cast(sum(Total_Rows) AS BIGINT) AS Total_Baris_Dinilai,
 cast(sum(Baris_Siap_Load) AS BIGINT) AS Total_Baris_Siap_Load, cast(sum(Baris_Bermasalah) AS BIGINT) AS Total_Baris_Bermasalah FROM quality""",
    "pack_ready": f"""WITH {QUALITY} SELECT q.Dataset_Id, Judul_Tabel, row_no, {CLEAN_VALUES}, regexp_replace(trim(place_value), ' +', ' ', 'g') AS nama_wilayah, jml AS jumlah,
 cast({N_KEYS} AS INTEGER) AS n_keys, 'BIGINT,STRING' AS types FROM assessed a JOIN quality q ON q.Dataset_Id = a.dataset_id WHERE Load_Decision = 'ready_for_load' AND migration_status = 'ready'""",
    "pack_review": f"""WITH {QUALITY} SELECT q.Dataset_Id, Judul_Tabel, Catalog_Suspect, row_no, migration_status, flag_reason, {CLEAN_VALUES},
 cast({N_KEYS} AS INTEGER) AS n_keys FROM assessed a JOIN quality q ON q.Dataset_Id = a.dataset_id WHERE Load_Decision = 'manager_review_required'""",
    "title_normalize": f"SELECT doc_id, cast(length(t) AS INTEGER) AS n_chars, md5(t) AS md5 FROM (SELECT doc_id, {_normal('text')} AS t FROM documents)",
    "token_sort": f"SELECT doc_id, cast(length(t) AS INTEGER) AS n_chars, md5(t) AS md5 FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)",
    "indel_ratio": f"""WITH {PAGE_SENTENCES}, t AS (SELECT cast(page_id AS string) AS dataset_id, regexp_extract(html, '{inputs.TITLE}', 1) AS x FROM pages),
 pats AS ({_patterns('t')}), rows_ AS (SELECT *, string_split(teks, '') AS chars, length(teks) AS n FROM sentences)
 SELECT dataset_id, row_no, CASE WHEN p.n = 0 THEN 0 ELSE {_score(_lcs('p', 'r'), 'p', 'r')} END AS score FROM rows_ r JOIN t USING (dataset_id) JOIN pats p ON p.x = t.x""",
    "token_sort_ratio": f"""WITH t AS (SELECT page_id, {_tokens(f"regexp_extract(html, '{inputs.TITLE}', 1)")} AS x, {_tokens('url')} AS u FROM pages),
 pats AS ({_patterns('t')}), r AS (SELECT page_id, x, string_split(u, '') AS chars, length(u) AS n FROM t)
 SELECT page_id, CASE WHEN p.n = 0 THEN 0 ELSE {_score(_lcs('p', 'r'), 'p', 'r')} END AS score FROM r JOIN pats p USING (x)""",
    "title_edges": f"WITH {TITLES} SELECT a AS a_ord, b AS b_ord, ax AS a_text, bx AS b_text, score FROM edges",
    "title_groups": f"WITH {GROUPS} SELECT * FROM groups",
    "part_title_edges": f"WITH {_titles(PART_CATALOG, 75)} SELECT a AS a_ord, b AS b_ord, ax AS a_text, bx AS b_text, score FROM edges",
    "part_title_groups": f"WITH {_groups(PART_CATALOG, 75)} SELECT group_ord, base_title, dataset_id FROM groups",
    "title_groups_low": f"WITH {_groups(PAGE_CATALOG, 60)} SELECT group_ord, base_title, dataset_id FROM groups",
    "document_title_groups": f"WITH {_groups(LINE_CATALOG, 92)} SELECT group_ord, dataset_id, ord FROM groups",
    "sample_rows": f"""WITH {SENTENCES} SELECT dataset_id, row_no, md5(teks) AS md5 FROM sentences
 QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY row_no) <= 5""",
    "row_fingerprint": f"""WITH {CELLS} SELECT dataset_id, row_no, string_agg(k || '=' || lower(trim(v)), '|' ORDER BY k) FILTER (WHERE trim(coalesce(v, '')) <> '') AS fingerprint
 FROM cells GROUP BY 1, 2""",
    "pair_similarity": f"WITH {PAIRS} SELECT group_ord, a_class, b_class, round(similarity, 6) AS similarity FROM class_pairs WHERE similarity >= 98",
    "dup_pairs": f"""WITH {PAIRS} SELECT a_id AS ID_Tabel_A, a.judul AS Judul_Tabel_A, b_id AS ID_Tabel_B, b.judul AS Judul_Tabel_B, round_even(similarity, 1) AS Skor_Kemiripan,
 CASE WHEN similarity = 100 THEN '{IDENTICAL}' ELSE 'Isi data hampir identik (' || round_even(similarity, 1) || '%)' END AS Alasan_Duplikat, a.base_title AS Grup_Pencarian_Awal
 FROM dups JOIN groups a ON a.dataset_id = a_id JOIN groups b ON b.dataset_id = b_id""",
    "suspect_ids": f"WITH {PAIRS} SELECT a_id AS dataset_id FROM dups UNION SELECT b_id FROM dups",
    "skipped_report": f"""WITH {GROUPS}, {SENTENCES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY row_no) AS rk FROM sentences),
 seen AS (SELECT dataset_id, bool_or(length(teks) > 60) AS filled FROM ranked WHERE rk <= 5 GROUP BY 1),
 judged AS (SELECT g.*, lang = 'de' AS failed, filled FROM groups g JOIN documents ON doc_id = g.ord LEFT JOIN seen s ON s.dataset_id = g.dataset_id)
 SELECT dataset_id AS Dataset_ID_Gagal, judul AS Judul_Asli_Dataset, CASE WHEN failed THEN '{FETCH_ERROR}' WHEN filled IS NULL THEN '{EMPTY_DETAIL}' ELSE '{EMPTY_FINGERPRINT}' END AS Kategori_Error,
 CASE WHEN failed THEN 'timeout' WHEN filled IS NULL THEN '{EMPTY_DETAIL_MESSAGE}' ELSE '{EMPTY_FINGERPRINT_MESSAGE}' END AS Pesan_Detail, base_title AS Grup_Pencarian_Awal
 FROM judged WHERE failed OR filled IS NOT TRUE""",
    "audit_quality": f"""WITH {PAIRS}, suspects AS (SELECT a_id AS dataset_id FROM dups UNION SELECT b_id FROM dups),
 counted AS (SELECT dataset_id, count(*) AS n FROM sentences GROUP BY 1)
 SELECT id AS Dataset_Id, judul AS Judul_Tabel, s.dataset_id IS NOT NULL AS Catalog_Suspect, coalesce(n, 0) AS Total_Rows, cast(0 AS BIGINT) AS Baris_Bermasalah,
 coalesce(n, 0) AS Baris_Siap_Load, CASE WHEN n IS NULL THEN 'Tabel Kosong (0 baris)' ELSE '{NO_YEAR_ISSUE}' END AS Schema_Issues,
 CASE WHEN n IS NULL THEN 'skipped' WHEN s.dataset_id IS NOT NULL THEN 'manager_review_required' ELSE 'ready_for_load' END AS Load_Decision
 FROM cat LEFT JOIN suspects s ON s.dataset_id = id LEFT JOIN counted c ON c.dataset_id = id""",
    "automap": f"WITH {BEST} SELECT * FROM mapping",
    "automap_unmapped": f"""WITH {BEST} SELECT old_id, old_title, best.judul AS best_new_title_found, coalesce(score, 0) AS highest_score
 FROM old LEFT JOIN best USING (x) WHERE coalesce(score, 0) < 85""",
    "automap_collisions": f"WITH {BEST} SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY new_id) AS n_old FROM mapping) WHERE n_old > 1",
    "json_unpack": f"""WITH {BASE} SELECT dataset_id AS Dataset_Id, 'Data ' || c_name AS Judul_Tabel,
 CASE WHEN c IN (10, 11) OR c > 12 THEN nullif(trunc(try_cast(year_value AS double))::INTEGER, 0) END AS thn, row_no FROM base JOIN customer ON c_custkey = o_custkey""",
    "payload_groups": f"""WITH {CLASSIFIED} SELECT target_id, dataset_id AS old_id, tahun_data, count(*) AS n_rows, min(row_no) AS first_row, max(row_no) AS last_row
 FROM classified WHERE reject_reason IS NULL GROUP BY ALL""",
    "payload_documents": f"""WITH {CLASSIFIED}, placed AS (SELECT *, {N_KEYS_LAST} - 1 AS n_values,
 (row_number() OVER (PARTITION BY target_id, dataset_id, tahun_data ORDER BY row_no) - 1) // 2 AS chunk FROM classified WHERE reject_reason IS NULL)
 SELECT target_id, dataset_id AS old_id, tahun_data, chunk, cast(count(*) AS INTEGER) AS n_rows, string_agg(jml, ',' ORDER BY row_no) AS jumlah,
 string_agg(o_orderpriority, ',' ORDER BY row_no) AS prioritas, cast(sum(n_values) AS INTEGER) AS n_values FROM placed GROUP BY ALL""",
    "payload_rejects": f"WITH {CLASSIFIED} SELECT dataset_id AS old_id, row_no, reject_reason FROM classified WHERE reject_reason IS NOT NULL",
    "outcome_fold": f"WITH {FOLD} SELECT * FROM fold",
    "failed_payloads": f"WITH {OUTCOMES} SELECT target_id, old_id, tahun_data, chunk, props FROM outcomes WHERE NOT ok",
    "batch_totals": f"""WITH {FOLD} SELECT count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'partial') AS partial,
 count(*) FILTER (WHERE status = 'failed') AS failed, cast(coalesce(sum(rows_sent), 0) AS BIGINT) AS rows_sent FROM fold""",
    "progress_latest": f"WITH {LATEST} SELECT *, true AS no_title FROM latest",
    "next_batch": "SELECT cast(coalesce(max(day(ts)), 0) + 1 AS INTEGER) AS next_batch FROM events",
    "progress_summary": f"""WITH {LATEST} SELECT count(*) AS total_recorded, count(*) FILTER (WHERE status = 'done') AS done,
 count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'failed') AS failed FROM latest""",
    "done_ids": f"WITH {LATEST} SELECT new_id FROM latest WHERE status = 'done'",
    "remaining_catalog": f"WITH {STATUS} SELECT ord, id, judul FROM status WHERE status <> 'DONE'",
    "catalog_status": f"WITH {STATUS} SELECT id, judul, status FROM status",
    "overall_progress": f"""WITH {STATUS} SELECT count(*) AS n_targets, count(*) FILTER (WHERE status = 'DONE') AS n_done,
 count(*) FILTER (WHERE status <> 'DONE') AS n_remaining FROM status""",
    "year_counts": "SELECT cast(year(o_orderdate) AS INTEGER) AS tahun, count(*) AS count FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1",
    "availability_matrix": "SELECT 'Data ' || o_custkey AS Judul_Tabel, 'ds_' || o_custkey AS Dataset_Id, " + ", ".join(
        f"CASE WHEN bool_or(year(o_orderdate) = {year}) THEN 'Tersedia' ELSE 'Tidak Tersedia' END AS tahun_{year}" for year in range(1997, 2002)
    ) + " FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 2001 GROUP BY o_custkey",
    "availability_by_year": """SELECT 'Data ' || o_custkey AS Judul_Tabel, 'ds_' || o_custkey AS Dataset_Id, tahun, CASE WHEN bool_or(year(o_orderdate) = tahun) THEN 'Tersedia' ELSE 'Tidak Tersedia' END AS status
 FROM orders, (SELECT DISTINCT year(o_orderdate) AS tahun FROM orders WHERE year(o_orderdate) >= 1996) GROUP BY ALL HAVING max(year(o_orderdate)) >= 1996""",
    "keep_last": """SELECT 'ds_' || o_custkey AS Dataset_Id, 'Data ' || o_custkey AS Judul_Tabel, cast(year(o_orderdate) AS INTEGER) AS tahun, o_orderkey AS row_no
 FROM orders WHERE year(o_orderdate) >= 1999 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
}
