"""SQL counterparts of the extraction queries, in DuckDB's dialect over the same tables."""

from __future__ import annotations

_WS = "[\\s\\x{001C}-\\x{001F}\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


def _norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_WS}', ' ', 'g'))"


def _form(x: str) -> str:
    quotes, apostrophes, dashes = "„“”‟«»‹›″", "‘’‚‛`´ʼʹ′", "‐‑‒–—―−"
    to = '"' * len(quotes) + "''" * len(apostrophes) + "-" * len(dashes)
    folded = f"lower(translate(nfc_normalize(coalesce({x}, '')), '{quotes}{apostrophes}{dashes}', '{to}'))"
    return f"trim(regexp_replace({folded}, '{_WS}', ' ', 'g'))"


def _address(x: str) -> str:
    auth = "^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    host = f"regexp_replace(lower(regexp_extract({x}, '{auth}', 1)), '^www\\.', '')"
    path = f"regexp_replace(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"
    return f"nullif({host}, '') || {path}"


def _site(x: str) -> str:
    return f"nullif(regexp_replace(lower(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\\.', ''), '')"


_CUR = "['€', 'евро', 'лева', 'leva', 'eur', 'bgn', 'лв']"
_CURWORDS = "['евро', 'лева', 'leva', 'eur', 'bgn', 'лв']"


def _numbers(x: str) -> str:
    return f"list_filter(list_distinct(list_transform(regexp_extract_all({x}, '\\d[\\d.,]*'), lambda n: translate(n, '.,', ''))), lambda n: n <> '')"


def _words(x: str) -> str:
    return f"list_filter(list_distinct(regexp_extract_all({x}, '\\p{{L}}+')), lambda w: NOT list_contains({_CURWORDS}, w))"


def _missing(v: str, s: str, segs: str) -> str:
    """Unsupported tokens of v against the joined segments s; segs is the list of segments."""
    said = f"regexp_extract_all({s}, '\\p{{L}}+')"
    nums = f"list_filter({_numbers(v)}, lambda n: NOT list_contains({_numbers(s)}, n))"
    curs = f"list_filter({_CUR}, lambda c: contains({v}, c) AND NOT contains({s}, c))"
    words = f"list_filter({_words(v)}, lambda w: NOT list_contains({said}, w) AND (length(w) < 5 OR len(list_filter({said}, lambda z: length(z) >= 5 AND left(z, 5) = left(w, 5))) = 0))"
    return f"list_sort(list_concat(list_concat({nums}, {curs}), {words}))"


_LATEST = f"""
  SELECT address, artifact_id, text FROM (
    SELECT {_address('source_ref')} AS address, artifact_id, text, row_number() OVER (PARTITION BY {_address('source_ref')} ORDER BY rendered_at DESC NULLS LAST, artifact_id DESC) AS n
    FROM artifacts WHERE text IS NOT NULL AND {_address('source_ref')} IS NOT NULL
  ) WHERE n = 1
"""
_HARVEST = " UNION ALL ".join(
    f"""SELECT ref, '{field}' AS field, {_norm(f"coalesce({', '.join(f'CASE WHEN length({e}) BETWEEN 1 AND 400 THEN {e} END' for e in exprs)})")} AS value,
    'label:' || CASE WHEN length({exprs[0]}) BETWEEN 1 AND 400 THEN '{names[0]}' ELSE '{names[1]}' END AS method
    FROM h WHERE {' OR '.join(f'length({e}) BETWEEN 1 AND 400' for e in exprs)}"""
    for field, names, exprs in (
        ("degree", ("bg-degree", "en-degree"), ["regexp_extract(x, 'Степен: ([^;.]+)', 1)", "regexp_extract(x, 'Degree: ([^;.]+)', 1)"]),
        ("duration", ("bg-duration", "en-duration"), ["regexp_extract(x, 'Срок на обучение: ([^;]+?)[.;]', 1)", "regexp_extract(x, 'Duration: ([^;]+?)[.;]', 1)"]),
        ("tuition", ("bg-fee", "en-fee"), ["regexp_extract(x, 'Такса: ([^;]+?)(?:;|\\.?$|\\. )', 1)", "regexp_extract(x, 'Tuition: ([^;]+?)(?:;|\\.?$|\\. )', 1)"]),
    )
)
_HARVESTED = f"h AS (SELECT 'artifact:' || artifact_id AS ref, {_norm('text')} AS x FROM artifacts WHERE text IS NOT NULL), hits AS ({_HARVEST})"
_GATED = f"""
WITH d AS MATERIALIZED ({_LATEST}), k AS MATERIALIZED (
  SELECT entry_id, {_address('source_url')} AS address, expected_value AS value, {_form('expected_value')} AS v, {_form('snippet')} AS s FROM answer_key
), n AS MATERIALIZED (SELECT address, {_form('text')} AS body FROM d),
j AS MATERIALIZED (SELECT entry_id, value, v, s, body FROM k JOIN n USING (address)),
m AS MATERIALIZED (SELECT *, {_missing('v', 's', '[s]')} AS missing FROM j),
g AS MATERIALIZED (SELECT entry_id, CASE
    WHEN value IS NULL THEN 'NULL_OK'
    WHEN v = '' OR s = '' OR NOT (regexp_matches(v, '\\d') OR len(list_filter({_CUR}, lambda c: contains(v, c))) > 0 OR len({_words('v')}) > 0) THEN 'PARSE_FAILURE'
    WHEN NOT contains(body, s) THEN 'REJECT_CONTAINMENT'
    WHEN len(missing) > 0 THEN 'REJECT_SUPPORT' ELSE 'PASS' END AS status, missing FROM m)
"""
_CELLS = """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) + 1 AS r FROM part)
"""
_ADDR_ROWS = f"""
  SELECT program_id, 'page' AS route, 0 AS place, page AS url FROM programs
  UNION ALL SELECT program_id, 'extra_pages', 1000 + n - 1, url FROM (SELECT program_id, unnest(extra_pages) AS url, unnest(range(1, len(extra_pages) + 1)) AS n FROM programs)
  UNION ALL SELECT program_id, 'adm_page', 2000, adm_page FROM programs
  UNION ALL SELECT program_id, 'tuition_page', 3000, tuition_page FROM programs
"""
_ADDRESSES = f"a AS (SELECT *, {_address('url')} AS address FROM ({_ADDR_ROWS}) WHERE url IS NOT NULL)"
def _labelled(value: str, whole: str, field: str, method: str) -> str:
    """A label's claim: its value and the text around its match, from rows with x."""
    at = f"(strpos(x, {whole}) - 1)"
    first = f"greatest({at} - 90, 0)"
    around = _norm(f"substr(x, {first} + 1, {at} + length({whole}) + 90 - {first})")
    return f"'{field}' AS field, {_norm(value)} AS value, {around} AS segment, 'label:{method}' AS method"


def _said(pattern: str, group: int) -> str:
    return f"regexp_extract(x, '{pattern}', {group})"


_LABELS = (
    ("degree", (("bg-degree", "Степен: ([^;.]+)"), ("en-degree", "Degree: ([^;.]+)"))),
    ("duration", (("bg-duration", "Срок на обучение: ([^;]+?)[.;]"), ("en-duration", "Duration: ([^;]+?)[.;]"))),
    ("tuition", (("bg-fee", "Такса: ([^;]+?)(?:;|\\.?$|\\. )"), ("en-fee", "Tuition: ([^;]+?)(?:;|\\.?$|\\. )"))),
)
def harvested_of(rows: str, columns: str) -> str:
    """Claims of the fact labels over rows that have x, the text with blanks made one; their `columns` pass on."""
    return " UNION ALL ".join(
        f"SELECT {columns}, {_labelled(_said(p, 1), _said(p, 0), field, name)} FROM {rows} WHERE length({_said(p, 1)}) BETWEEN 1 AND 400" + "".join(f" AND NOT length({_said(q, 1)}) BETWEEN 1 AND 400" for _, q in own[:k])
        for field, own in _LABELS
        for k, (name, p) in enumerate(own)
    )


def gate_of(claims: str) -> str:
    """Rows of claims (value, segment, body, ...) with their status."""
    return f"""SELECT *, CASE WHEN value IS NULL THEN 'NULL_OK'
      WHEN v = '' OR NOT (regexp_matches(v, '\\d') OR len(list_filter({_CUR}, lambda c: contains(v, c))) > 0 OR len({_words('v')}) > 0) THEN 'PARSE_FAILURE'
      WHEN NOT contains(body, s) THEN 'REJECT_CONTAINMENT' WHEN len({_missing('v', 's', '[s]')}) > 0 THEN 'REJECT_SUPPORT' ELSE 'PASS' END AS status
      FROM (SELECT *, {_form('value')} AS v, {_form('segment')} AS s FROM {claims})"""


def latest() -> str:
    return _LATEST


def addresses() -> str:
    return _ADDRESSES


norm_sql, form, address = _norm, _form, _address
_Y1, _Y2 = "regexp_extract(academic_year, '(\\d{4})', 1)", "regexp_extract(academic_year, '\\d{4}\\D+(\\d{2,4})\\s*$', 1)"
_YEAR = f"CASE WHEN {_Y1} = '' THEN trim(academic_year) ELSE {_Y1} || '/' || CASE WHEN length({_Y2}) = 4 THEN {_Y2} WHEN length({_Y2}) = 2 THEN substr({_Y1}, 1, 2) || {_Y2} ELSE CAST(CAST({_Y1} AS INTEGER) + 1 AS VARCHAR) END END"
_RUN = f"""
r AS (SELECT uni_id, max(run_id) AS last, min(run_id) AS first FROM ledger GROUP BY uni_id),
f AS (SELECT lower(trim(program_id)) AS program_id, lower(trim(field)) AS field, {_YEAR} AS academic_year, arg_max(value, ledger_seq) AS value FROM ledger JOIN r ON run_id = r.first GROUP BY ALL),
l AS (SELECT lower(trim(program_id)) AS program_id, lower(trim(field)) AS field, {_YEAR} AS academic_year, arg_max(value, ledger_seq) AS value FROM ledger JOIN r ON run_id = r.last GROUP BY ALL)
"""
_DIFF = f"""
WITH {_RUN}, c AS (
  SELECT coalesce(f.program_id, l.program_id) AS program_id, coalesce(f.field, l.field) AS field, coalesce(f.academic_year, l.academic_year) AS academic_year,
    CASE WHEN f.program_id IS NULL THEN 'added' WHEN l.program_id IS NULL THEN 'removed' WHEN f.value IS DISTINCT FROM l.value THEN 'changed' END AS change
  FROM f FULL JOIN l ON f.program_id = l.program_id AND f.field = l.field AND f.academic_year = l.academic_year
)
"""
_FIELDS = "('degree', 'duration', 'language', 'tuition', 'admission')"
_GRADED = f"""
WITH r AS (SELECT uni_id, max(run_id) AS last FROM ledger GROUP BY uni_id),
k AS (SELECT lower(trim(program_id)) AS program_id, lower(trim(field)) AS field, expected_value AS expected FROM answer_key WHERE lower(trim(field)) IN {_FIELDS}
      QUALIFY row_number() OVER (PARTITION BY lower(trim(program_id)), lower(trim(field)) ORDER BY labelled_at DESC NULLS LAST, entry_id DESC) = 1),
s AS (SELECT lower(trim(program_id)) AS program_id, lower(trim(field)) AS field, value AS shipped FROM ledger JOIN r ON run_id = r.last
      QUALIFY row_number() OVER (PARTITION BY lower(trim(program_id)), lower(trim(field)) ORDER BY ledger_seq DESC) = 1),
b AS (SELECT coalesce(k.program_id, s.program_id) AS program_id, coalesce(k.field, s.field) AS field, expected, shipped, k.program_id IS NOT NULL AS in_key, s.program_id IS NOT NULL AS in_report,
      CASE WHEN shipped IS NULL THEN 'NULL_OK' ELSE 'PASS' END AS status
      FROM k FULL JOIN s ON k.program_id = s.program_id AND k.field = s.field),
c AS (SELECT *, CASE WHEN expected IS NULL THEN CASE WHEN status = 'PASS' THEN 'FABRICATION' ELSE 'OK_NULL' END
      WHEN status = 'PASS' THEN CASE WHEN lower({_norm('expected')}) = lower({_norm('shipped')}) THEN 'OK_VALUE' ELSE 'CHECK' END ELSE 'MISS' END AS base FROM b WHERE in_key AND in_report),
v AS (SELECT c.program_id, c.field, max(lower(trim(verdict))) AS verdict FROM c JOIN verdicts ON c.program_id = lower(trim(verdicts.program_id)) AND c.field = lower(trim(verdicts.field))
      WHERE base = 'CHECK' AND lower(trim(verdict)) IN ('ok', 'wrong') AND (shipped_value IS NULL OR shipped_value = shipped) GROUP BY ALL),
g AS (SELECT c.*, CASE verdict WHEN 'ok' THEN 'OK_MANUAL' WHEN 'wrong' THEN 'WRONG' ELSE base END AS category FROM c LEFT JOIN v ON c.program_id = v.program_id AND c.field = v.field)
"""
_VISITS = """
WITH a AS (SELECT DISTINCT url, retrieved_at, sha256, canonical_sha256 FROM snapshots WHERE sha256 IS NOT NULL),
n AS (SELECT sha256, arg_max(canonical_sha256, retrieved_at || canonical_sha256) AS canonical FROM a WHERE canonical_sha256 IS NOT NULL GROUP BY sha256),
s AS (SELECT DISTINCT url, retrieved_at, a.sha256, canonical FROM a LEFT JOIN n ON a.sha256 = n.sha256),
p AS (SELECT url, CASE WHEN canonical IS DISTINCT FROM lag(canonical) OVER w THEN 'ambiguous' WHEN sha256 <> lag(sha256) OVER w THEN 'raw' ELSE 'stable' END AS kind, row_number() OVER w AS n
      FROM s WINDOW w AS (PARTITION BY url ORDER BY retrieved_at, sha256))
"""
_COOKIES = "coalesce(array_to_string(list_sort(list_transform(map_entries(cookies), lambda e: e.key || '=' || e.value)), '&'), '')"
_FETCHES = f"""
WITH f AS (SELECT * FROM snapshots WHERE coalesce(kind, 'fetch') <> 'canonical'
  QUALIFY row_number() OVER (PARTITION BY url, {_COOKIES} ORDER BY retrieved_at DESC, coalesce(sha256, '') DESC, coalesce(error, '') DESC, coalesce(canonical_sha256, '') DESC) = 1)
"""
_UNSPLIT = "regexp_replace(text, '-\\n\\s*', '-', 'g')"
_USABLE = "error IS NULL AND coalesce(sha256, '') <> '' AND status IS NOT NULL AND status < 500"

ORACLE = {
    "norm_text": f"SELECT doc_id, {_norm('text')} AS normed FROM documents",
    "normalize_policy": f"SELECT doc_id, {_form('text')} AS form FROM documents",
    "token_index": f"SELECT item_id, array_to_string(list_sort({_numbers('v')}), ' ') AS numbers, array_to_string(list_sort({_words('v')}), ' ') AS words FROM (SELECT item_id, {_form('text')} AS v FROM heldout_items)",
    "snippet_window": f"SELECT doc_id, {_norm('substr(text, greatest(a - 40, 0) + 1, a + 41 - greatest(a - 40, 0))')} AS snippet FROM (SELECT doc_id, text, length(regexp_extract(text, '^([^0-9]*)[0-9]', 1)) AS a FROM documents WHERE regexp_matches(text, '[0-9]'))",
    "content_address": "SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "distinct_bodies": "SELECT DISTINCT sha256(text) AS sha256 FROM artifacts WHERE text IS NOT NULL",
    "latest_fetches": _FETCHES + "SELECT url, retrieved_at, status, sha256 FROM f",
    "latest_then_filter": _FETCHES + f"SELECT url, retrieved_at, status, sha256 FROM f WHERE {_USABLE}",
    "replay_misses": _FETCHES + f", {_ADDRESSES}, w AS (SELECT address, arg_min(url, lpad(CAST(place AS VARCHAR), 6, '0') || url) AS url FROM a WHERE address IS NOT NULL GROUP BY address) SELECT url FROM w WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.url = w.url AND {_COOKIES} = '' AND {_USABLE})",
    "routes": "SELECT CASE WHEN lower(content_type) LIKE '%html%' OR lower(content_type) LIKE 'text/%' THEN 'html' WHEN lower(content_type) LIKE '%pdf%' THEN 'prose-pdf' ELSE 'none' END AS route, count(*) AS n FROM snapshots GROUP BY 1",
    "retries": f"SELECT status, count(*) FILTER (WHERE coalesce(status >= 500, false) OR coalesce(lower(error) LIKE '%timeout%' OR lower(error) LIKE '%timed out%', false)) AS retried, count(*) FILTER (WHERE {_USABLE}) AS usable FROM snapshots GROUP BY status",
    "flagship": f"WITH d AS (SELECT {_norm('text')} AS x, {_form('text')} AS body FROM artifacts WHERE text IS NOT NULL), c AS ({harvested_of('d', 'body')}), g AS ({gate_of('c')}) SELECT field, status, count(*) AS n FROM g GROUP BY field, status",
    "label_harvest": f"WITH {_HARVESTED} SELECT * FROM hits",
    "suppress_labels": f"""WITH {_HARVESTED}, d AS ({_LATEST}), o AS (SELECT program_id, 'artifact:' || artifact_id AS ref FROM programs JOIN d ON {_address('page')} = d.address)
      SELECT program_id, field, ref, value, method FROM hits JOIN o USING (ref)
      WHERE NOT EXISTS (SELECT 1 FROM verdicts v WHERE lower(trim(verdict)) = 'wrong' AND lower(trim(v.program_id)) = o.program_id AND lower(trim(v.field)) = hits.field)""",
    "gate_verdicts": _GATED + "SELECT entry_id, status, CASE WHEN status = 'REJECT_SUPPORT' THEN array_to_string(missing, ' ') ELSE '' END AS missing FROM g",
    "gate_status_counts": _GATED + "SELECT s.status, count(g.status) AS n FROM (VALUES ('PASS'), ('REJECT_CONTAINMENT'), ('REJECT_SUPPORT'), ('NULL_OK'), ('PARSE_FAILURE')) s(status) LEFT JOIN g ON s.status = g.status GROUP BY s.status",
    "draft_tiers": f"""WITH k AS (SELECT entry_id, {_form('expected_value')} AS v, {_form('snippet')} AS s FROM answer_key WHERE expected_value IS NOT NULL),
      x AS (SELECT *, list_transform(regexp_extract_all(v, '\\d[\\d.,]*'), lambda n: regexp_replace(n, '[.,]+$', '')) AS nums, list_filter({_CUR}, lambda c: contains(v, c)) AS curs,
        list_filter(regexp_extract_all(v, '[\\p{{L}}\\p{{N}}_]{{4,}}'), lambda w: NOT list_contains(['with', 'from'], w)) AS toks FROM k)
      SELECT entry_id, CASE WHEN s = '' THEN 'HARD' WHEN contains(s, v) THEN 'OK' WHEN len(list_filter(nums, lambda n: NOT contains(s, n))) > 0 THEN 'HARD'
        WHEN len(curs) > 0 AND len(list_filter(curs, lambda c: contains(s, c))) = 0 THEN 'HARD' WHEN len(toks) > 0 AND len(list_filter(toks, lambda w: contains(s, w))) / len(toks) < 0.5 THEN 'HARD' ELSE 'SOFT' END AS tier FROM x""",
    "names_program": f"""WITH d AS ({_LATEST}), o AS (SELECT program_id, {_address('page')} AS address, lower(name) AS n, lower(trim(regexp_replace(name, '\\s*\\([^()]*\\)\\s*$', ''))) AS b FROM programs)
      SELECT program_id, artifact_id FROM o JOIN d USING (address) WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}])(' || regexp_replace(n, '([().+*?])', '\\\\\\1', 'g') || '|' || regexp_replace(b, '([().+*?])', '\\\\\\1', 'g') || ')($|[^\\p{{L}}])')""",
    "values_match": f"""WITH k AS (SELECT entry_id, lower(trim(program_id)) AS p, lower(trim(field)) AS f, {_form('expected_value')} AS e FROM answer_key),
      s AS (SELECT verdict_id, lower(trim(program_id)) AS p, lower(trim(field)) AS f, {_form('shipped_value')} AS s FROM verdicts), j AS (SELECT * FROM k JOIN s USING (p, f) WHERE s <> '')
      SELECT entry_id, verdict_id FROM j WHERE len({_missing('e', 's', '[s]')}) = 0 AND (regexp_matches(e, '\\d') OR len(list_filter({_CUR}, lambda c: contains(e, c))) > 0 OR len({_words('e')}) > 0)""",
    "table_cells": "WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS r FROM documents WHERE contains(text, chr(9))) SELECT doc_id, sum(len(string_split(line, chr(9)))) AS cells, max(r) AS last_row, max(len(string_split(line, chr(9)))) - 1 AS last_column FROM r GROUP BY doc_id",
    "grid_text": _CELLS + "SELECT p_brand AS ref, 'Price Part Price Type' || chr(10) || 'BGN EUR' || chr(10) || string_agg(printf('%.2f', p_retailprice * 1.95583) || ' ' || p_name || ' ' || printf('%.2f', p_retailprice) || ' ' || p_type, chr(10) ORDER BY r) AS text FROM p GROUP BY p_brand",
    "header_zones": "SELECT DISTINCT p_brand AS ref, 0 AS first, 1 AS last FROM part",
    "fee_row_join": _CELLS + ", a AS (SELECT p_brand, max(p_type) AS alias FROM part GROUP BY p_brand) SELECT p.p_brand AS program_id, r, printf('%.2f', p_retailprice) AS value FROM p JOIN a USING (p_brand) WHERE contains(p_type, alias) QUALIFY row_number() OVER (PARTITION BY p.p_brand ORDER BY r) = 1",
    "sectioned_join": """WITH l AS (SELECT user_id AS ref, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
      s AS (SELECT *, last_value(CASE event_type WHEN 'signup' THEN 'A' WHEN 'error' THEN 'B' END IGNORE NULLS) OVER (PARTITION BY ref ORDER BY r) AS track FROM l),
      h AS (SELECT ref, track, arg_max(event_type || ' ' || event_id, r) AS header FROM s WHERE event_type IN ('signup', 'error') GROUP BY ALL),
      p AS (SELECT ref, arg_min(event_id, r) AS id, arg_min(coalesce(track, ''), r) AS track, coalesce(max(CASE WHEN track = 'A' THEN 'A' END), '') AS tracks FROM s WHERE event_type = 'purchase' GROUP BY ref)
      SELECT p.ref, id || ' BGN' AS value, tracks, concat_ws('|', header, 'purchase ' || id) AS segments FROM p LEFT JOIN h ON p.ref = h.ref AND p.track = h.track""",
    "language_from_name": "SELECT program_id, regexp_extract(name, '((?:с частично обучение )?на английски език)', 1) AS value FROM programs WHERE contains(name, 'на английски език')",
    "document_plan": f"WITH {_ADDRESSES} SELECT address, arg_min(route, lpad(CAST(place AS VARCHAR), 6, '0') || url) AS route FROM a WHERE address IS NOT NULL GROUP BY address",
    "latest_artifacts": f"SELECT address, artifact_id FROM ({_LATEST})",
    "candidate_documents": f"""WITH {_ADDRESSES}, d AS ({_LATEST}), c AS (SELECT DISTINCT program_id, f.field, address FROM a, (VALUES ('degree'), ('duration'), ('language'), ('tuition'), ('admission')) f(field)
      WHERE route IN ('page', 'extra_pages') OR route = 'adm_page' AND f.field = 'admission' OR route = 'tuition_page' AND f.field = 'tuition') SELECT program_id, field, artifact_id FROM c JOIN d USING (address)""",
    "resolve_priority": f"""WITH u AS (
      SELECT lower(trim(program_id)) AS p, lower(trim(field)) AS f, 1 AS rank, shipped_value AS value, 'verdict' AS method FROM verdicts WHERE lower(trim(verdict)) = 'ok'
      UNION ALL SELECT lower(trim(program_id)), lower(trim(field)), 2, expected_value, 'key' FROM answer_key UNION ALL SELECT lower(trim(program_id)), lower(trim(field)), 3, value, 'ledger' FROM ledger),
      w AS (SELECT * FROM u WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p, f ORDER BY rank, value) = 1)
      SELECT program_id, x.field, value, method FROM programs CROSS JOIN (VALUES ('degree'), ('duration'), ('language'), ('tuition'), ('admission')) x(field) LEFT JOIN w ON w.p = program_id AND w.f = x.field""",
    "worksheet_groups": f"SELECT {_address('page')} AS address, string_agg(name, '; ' ORDER BY program_id) AS names FROM programs WHERE {_address('page')} IS NOT NULL GROUP BY 1",
    "ledger_latest": "SELECT program_id, field, academic_year, value FROM ledger WHERE run_id = (SELECT max(run_id) FROM ledger) QUALIFY row_number() OVER (PARTITION BY program_id, field, academic_year ORDER BY ledger_seq DESC) = 1",
    "ledger_diff": _DIFF + "SELECT * FROM c WHERE change IS NOT NULL",
    "ledger_diff_counts": _DIFF + "SELECT count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'removed') AS removed, count(*) FILTER (WHERE change = 'changed') AS changed FROM c",
    "set_change": f"WITH {_RUN} SELECT coalesce(x.program_id, y.program_id) AS program_id, CASE WHEN x.program_id IS NULL THEN 'added' WHEN y.program_id IS NULL THEN 'removed' ELSE 'stable' END AS change FROM (SELECT DISTINCT program_id FROM f) x FULL JOIN (SELECT DISTINCT program_id FROM l) y ON x.program_id = y.program_id",
    "verdict_upsert": """WITH k AS (SELECT lower(trim(program_id)) AS p, regexp_replace(lower(trim(field)), '[\\s\\-]+', '_', 'g') AS f FROM answer_key), v AS (SELECT lower(trim(program_id)) AS p, regexp_replace(lower(trim(field)), '[\\s\\-]+', '_', 'g') AS f FROM verdicts)
      SELECT 'key' AS origin, count(*) AS n FROM k WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.p = k.p AND v.f = k.f) UNION ALL SELECT 'verdict', count(*) FROM v""",
    "academic_year": "SELECT CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) || '/' || (year(o_orderdate) + 1) ELSE (year(o_orderdate) - 1) || '/' || year(o_orderdate) END AS academic_year, count(*) AS orders FROM orders GROUP BY 1",
    "stated_year": "SELECT entry_id, regexp_replace(y, '\\s', '', 'g') AS academic_year FROM (SELECT entry_id, regexp_extract(concat_ws(chr(10), expected_value, snippet), '\\b(20\\d\\d)\\s*/\\s*(20\\d\\d)\\b') AS y FROM answer_key) WHERE y <> ''",
    "coverage": "SELECT p.program_id, coalesce(bool_or(k.expected_value IS NOT NULL) FILTER (WHERE k.entry_id IS NOT NULL), false) AS covered, count(*) FILTER (WHERE k.entry_id IS NOT NULL AND k.expected_value IS NULL) AS empty, count(k.entry_id) AS fields FROM programs p LEFT JOIN answer_key k ON lower(trim(k.program_id)) = p.program_id GROUP BY p.program_id",
    "coverage_totals": "WITH c AS (SELECT p.program_id, bool_or(k.expected_value IS NOT NULL) AS covered, count(*) FILTER (WHERE k.entry_id IS NOT NULL AND k.expected_value IS NULL) AS empty, count(k.entry_id) AS fields FROM programs p LEFT JOIN answer_key k ON lower(trim(k.program_id)) = p.program_id GROUP BY p.program_id) SELECT count(*) AS programs, count(*) FILTER (WHERE covered) AS covered, count(*) FILTER (WHERE covered) / count(*) AS coverage, sum(empty) / sum(fields) AS empty_rate FROM c",
    "grade_matrix": _GRADED + "SELECT category, count(*) AS n FROM g GROUP BY category",
    "grade_orphans": _GRADED + "SELECT CASE WHEN in_key THEN 'key' ELSE 'report' END AS side, count(*) AS n FROM b WHERE NOT (in_key AND in_report) GROUP BY 1",
    "grade_rates": _GRADED + """, t AS (SELECT count(*) AS rows, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE category = 'CHECK') AS checks, count(*) FILTER (WHERE category = 'WRONG') AS wrong, count(*) FILTER (WHERE category = 'FABRICATION') AS fabrications FROM g)
      SELECT *, fabrications / greatest(rows, 1) AS fabrication_rate, CASE WHEN checks = 0 THEN wrong / greatest(passed, 1) END AS wrong_rate FROM t""",
    "visit_pairs": _VISITS + "SELECT kind, count(*) AS n FROM p WHERE n > 1 GROUP BY kind",
    "churn": _VISITS + f""", q AS (SELECT {_site('url')} AS site, count(*) AS pairs, count(*) FILTER (WHERE kind = 'raw') AS raw, count(*) FILTER (WHERE kind = 'ambiguous') AS ambiguous FROM p WHERE n > 1 GROUP BY 1),
      u AS (SELECT {_site('url')} AS site, count(*) AS pages, max(v) AS most_visits FROM (SELECT url, count(*) AS v FROM s GROUP BY url) GROUP BY 1)
      SELECT u.site, pages, most_visits, coalesce(pairs, 0) AS pairs, coalesce(raw, 0) AS raw, coalesce(ambiguous, 0) AS ambiguous, coalesce(ambiguous, 0) > 0.1 * coalesce(pairs, 0) AS threatens FROM u LEFT JOIN q ON u.site = q.site""",
    "version_drift": "WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS path, 'c' || (o_orderkey % 3000) AS code, CAST(o_custkey % 7 AS VARCHAR) AS pinned FROM orders), l AS (SELECT 'c' || p_partkey AS code, max(CAST(p_size % 7 AS VARCHAR)) AS current FROM part GROUP BY 1) SELECT path, pinned, current, CASE WHEN current IS NULL THEN 'unknown' ELSE 'superseded' END AS state FROM p LEFT JOIN l USING (code) WHERE current IS NULL OR current <> pinned",
    "discover_links": "SELECT DISTINCT doc_id, regexp_extract(url, '^https?://[^/]+') || unnest(regexp_extract_all(text, '<a href=\"([^\"]+)\"', 1)) AS link FROM documents WHERE starts_with(text, '<div')",
    "prose_composed": f"SELECT artifact_id, trim({_norm(_UNSPLIT)} || ' ' || {_norm('text')}) AS composed FROM artifacts WHERE renderer_id LIKE 'pdftotext%' AND text IS NOT NULL",
    "site_hosts": f"SELECT {_site('source_ref')} AS site, count(*) AS artifacts, count(DISTINCT regexp_replace(regexp_extract(source_ref, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/+$', '')) AS paths FROM artifacts GROUP BY 1",
    "event_means": "SELECT event_type, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY event_type",
}
