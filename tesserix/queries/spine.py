"""Queries of the spine and of what runs are held against, over the driver's tables, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserix.functions.quantity import key_id
from tesserix.functions.text import norm
from tesserix.operators import drift, expect, labels, ledger, resolve
from tesserix.plans import extraction as plan
from tesserix.queries.extraction import FACT_LABELS, FIELDS
from tesserix.queries.extraction_sql import address, addresses, form, gate_of, harvested_of, latest, norm_sql
from tesserix.session import table
from tesserix.sources import manifest, pages


def _documents(spark, sf):
    docs = resolve.latest_artifacts(table(spark, sf, "artifacts"))
    return docs.select("address", F.concat(F.lit("artifact:"), F.col("artifact_id")).alias("ref"), "text")


def page_emissions(spark, sf):
    """Every rule's claim on every candidate page, gated; pages are read whole."""
    found = plan.emissions(table(spark, sf, "programs"), FIELDS, _documents(spark, sf), FACT_LABELS, scoped=False)
    return found.select("program_id", "field", "ref", "rule", "value", "method", "status")


def resolved_cells(spark, sf):
    """Every programme's fields by the rule chain, shared pages read in the programme's own spans."""
    return plan.resolve_cells(table(spark, sf, "programs"), FIELDS, _documents(spark, sf), patterns=FACT_LABELS)


def verified_pages(spark, sf):
    """The newest rendering of each page that a programme configures, verified under the programme's name."""
    own = table(spark, sf, "programs").select("name", resolve.address_key(F.col("page")).alias("address")).groupBy("address").agg(F.min("name").alias("name"))
    return plan.verify_pages(_documents(spark, sf).join(own, "address").select("ref", "name", "text"), FACT_LABELS).select("ref", "field", "value", "method")


def _resolved(spark, sf):
    return plan.resolve_documents(table(spark, sf, "programs"), table(spark, sf, "snapshots"), table(spark, sf, "artifacts").select("sha256", "renderer_id", "text"))


def resolved_documents(spark, sf):
    return _resolved(spark, sf)[0].select("address", "ref", "kind", "renderer_id", F.sha2("text", 256).alias("text_sha256"))


def unresolved_documents(spark, sf):
    return _resolved(spark, sf)[1].select("address", "reason")


def usable_pages(spark, sf):
    """Fetches that brought a page, by status."""
    rows = table(spark, sf, "snapshots")
    return rows.groupBy("status").agg(F.count_if(manifest.is_ok(F.col("status"), F.col("error"))).alias("ok"), F.count("*").alias("fetches"))


def robots_hosts(spark, sf):
    return manifest.robots_by_host(table(spark, sf, "snapshots"))


def amounts(spark, sf):
    """The first amount of every stated value."""
    key = table(spark, sf, "answer_key").select(F.lit("answer_key").alias("src"), F.col("entry_id").alias("row_id"), F.col("expected_value").alias("value"))
    said = key.unionByName(table(spark, sf, "verdicts").select(F.lit("verdicts").alias("src"), F.col("verdict_id").alias("row_id"), F.col("shipped_value").alias("value")))
    return said.select("src", "row_id", expect.amount(F.col("value")).alias("a")).where("a is not null").select("src", "row_id", "a.number", "a.currency")


def currency_equivalents(spark, sf):
    """Expected and shipped values of one cell that state the same amount in another currency."""
    key = table(spark, sf, "answer_key").select("entry_id", key_id(F.col("program_id")).alias("p"), key_id(F.col("field")).alias("f"), "expected_value")
    said = table(spark, sf, "verdicts").select("verdict_id", key_id(F.col("program_id")).alias("p"), key_id(F.col("field")).alias("f"), "shipped_value")
    return key.join(said, ["p", "f"]).where(expect.currency_equivalent(F.col("expected_value"), F.col("shipped_value"))).select("entry_id", "verdict_id")


def common_measures(spark, sf):
    """First and last run of each site over the programmes in both."""
    rows = table(spark, sf, "ledger")
    ends = rows.groupBy("uni_id").agg(F.min("run_id").alias("first"), F.max("run_id").alias("last")).select("uni_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("run_id"))
    per = rows.join(ends, ["uni_id", "run_id"]).groupBy(F.col("uni_id").alias("site"), F.col("run_id").alias("run"), key_id(F.col("program_id")).alias("program_id"))
    found = expect.common_measures(per.agg((F.count("value") > 0).alias("covered"), F.count_if(F.col("value").isNull()).alias("empty"), F.count("*").alias("fields")))
    return found.select("site", "run", "programs", F.round("coverage", 9).alias("coverage"), F.round("empty_rate", 9).alias("empty_rate"))


def finding_counts(spark, sf):
    """Verdicts as findings of the programme's site; a wrong one is open."""
    site = table(spark, sf, "programs").select("program_id", "uni_id")
    rows = table(spark, sf, "verdicts").select(key_id(F.col("program_id")).alias("program_id"), F.when(key_id(F.col("verdict")) == "wrong", "open").otherwise("closed").alias("status"))
    return expect.finding_counts(rows.join(site, "program_id"))


def _calls(spark, sf):
    """Ledger rows that a model filled as calls; what they cost is the length of what they gave."""
    rows = table(spark, sf, "ledger").where("tier = 'llm-tail'")
    tag = F.when(F.col("ledger_seq") % 5 == 0, F.concat_ws(":", "uni_id", "program_id")).otherwise(F.concat_ws(":", "uni_id", "program_id", "field", "academic_year"))
    return rows.select("uni_id", tag.alias("tag"), (F.length("value") / 1000).alias("cost"))


def call_costs(spark, sf):
    return expect.call_costs(_calls(spark, sf)).select("uni_id", "calls", F.round("mean_cost", 9).alias("mean_cost"))


def cost_range(spark, sf):
    found = expect.cost_range(expect.call_costs(_calls(spark, sf)))
    return found.select(F.round("least", 9).alias("least"), F.round("most", 9).alias("most"), "sites")


def run_summaries(spark, sf):
    return ledger.run_summaries(table(spark, sf, "ledger"))


def inferred_year(spark, sf):
    """Of every key row the year it states, or 2025/2026, by the rule of its field."""
    rows = table(spark, sf, "answer_key")
    return rows.select("entry_id", ledger.inferred_year(key_id(F.col("field")), F.col("expected_value"), F.array("snippet"), F.lit("2025/2026")).alias("academic_year"))


def unconfigured_pages(spark, sf):
    """Fetched pages that no programme has."""
    return resolve.unconfigured(table(spark, sf, "snapshots").select("url").distinct(), table(spark, sf, "programs")).select("url")


def pinned_sources(spark, sf):
    """Pins of the programmes' pages; addresses of these tables have no versions, so those of some lengths are given one."""
    versioned = lambda c: F.when(F.length(c) % 3 == 0, F.concat(c, F.lit("?code=c1&version="), F.length(c))).otherwise(c)
    rows = table(spark, sf, "programs")
    rows = rows.withColumns({c: versioned(F.col(c)) for c in ("page", "adm_page", "tuition_page")}).withColumn("extra_pages", F.transform("extra_pages", versioned))
    return drift.pinned_sources(rows).select("path", "url", "code", "version")


def link_union(spark, sf):
    """Links of all crawled markup, each with the first seed that has it."""
    seeds = table(spark, sf, "documents").where("text like '<div%'").select("doc_id", F.explode(pages.discover_links("text", "url")).alias("link"))
    return seeds.groupBy(F.col("link.url").alias("link")).agg(F.min("doc_id").alias("first_seed"), F.count_distinct("doc_id").alias("seeds"))


def anchored_values(spark, sf):
    """Anchors that read the number of places, on pages that name the programme."""
    docs = resolve.latest_artifacts(table(spark, sf, "artifacts"))
    own = table(spark, sf, "programs").select("program_id", "name", resolve.address_key(F.col("page")).alias("address"))
    rows = own.join(docs, "address")
    named = F.contains(F.lower(norm(F.col("text"))), F.lower("name"))
    value = labels.anchor_value(norm(F.col("text")), F.lit(r"(?:Места|Places): ([0-9]+)"), named)
    return rows.select("program_id", "artifact_id", value.alias("value")).where("value is not null")


QUERIES = (
    page_emissions, resolved_cells, verified_pages, resolved_documents, unresolved_documents, usable_pages, robots_hosts, amounts, currency_equivalents, common_measures,
    finding_counts, call_costs, cost_range, run_summaries, inferred_year, unconfigured_pages, pinned_sources, link_union, anchored_values,
)

_WRITTEN = r"(?i)(\d[\d.,]*)\s*(лв\.?|leva|bgn|eur|€|евро)"
_AMOUNT = "(SELECT *, regexp_extract(value, '" + _WRITTEN + "', 1) AS w, lower(regexp_extract(value, '" + _WRITTEN + "', 2)) AS c FROM {0})"
_NUMBER = r"try_cast(CASE WHEN regexp_matches(w, '[.,]\d{2}$') THEN regexp_replace(left(w, length(w) - 3), '[.,]', '', 'g') || '.' || right(w, 2) ELSE replace(w, ',', '') END AS DOUBLE)"
_CURRENCY = "CASE WHEN c IN ('eur', '€', 'евро') THEN 'EUR' ELSE 'BGN' END"
_KEYED = "lower(trim(program_id)) AS p, lower(trim(field)) AS f"
_NAMED = "CASE WHEN contains(name, 'на английски език') THEN regexp_extract(name, '((?:с частично обучение )?на английски език)', 1) END"
_NAME_AT = r"greatest(strpos(text, regexp_extract(name, '^(.*?)( \(|$)', 1)), 1)"
_AROUND_NAME = norm_sql("substr(text, greatest(pos - 60, 1), pos + length(name) + 60 - greatest(pos - 60, 1))")
_DEGREE = r"(?i)придобиват\s+(?:образователната|образователно-квалификационна)\s+степен\s*[„\"«“]\s*([а-я][а-я ]*?)\s*[“”\"»]\s*по\s+специалност(?:та)?\s*[„\"«“]?\s*"
_FIELD_ROWS = ", ".join(f"('{f}')" for f in FIELDS)
_CLAIMS = f"""
WITH {addresses()}, d AS MATERIALIZED (SELECT address, 'artifact:' || artifact_id AS ref, text, {norm_sql('text')} AS x, {form('text')} AS body FROM ({latest()})),
e AS (SELECT DISTINCT program_id, f.field, address FROM a, (VALUES {_FIELD_ROWS}) f(field)
  WHERE address IS NOT NULL AND (route IN ('page', 'extra_pages') OR route = 'adm_page' AND f.field = 'admission' OR route = 'tuition_page' AND f.field = 'tuition')),
hits AS MATERIALIZED ({harvested_of('d', 'address, ref, body')}),
o AS (SELECT program_id, name, {address('page')} AS address FROM programs),
n AS (SELECT e.program_id, e.field, d.ref, body, name, text, x, {_NAME_AT} AS pos FROM e JOIN o USING (program_id, address) JOIN d USING (address) WHERE e.field IN ('language', 'degree')),
c AS (
  SELECT e.program_id, e.field, h.ref, 2 AS rule, h.value, h.segment, h.method, h.body FROM e JOIN hits h USING (address, field)
  UNION ALL SELECT program_id, field, ref, 3, {_NAMED}, {_AROUND_NAME}, 'name', body FROM n WHERE field = 'language' AND {_NAMED} IS NOT NULL
  UNION ALL SELECT program_id, field, ref, 4, {norm_sql('v')}, {norm_sql('w')}, 'sentence', body FROM (
    SELECT *, regexp_extract(x, '{_DEGREE}' || regexp_escape(name), 1) AS v, regexp_extract(x, '{_DEGREE}' || regexp_escape(name), 0) AS w FROM n WHERE field = 'degree') WHERE v <> ''
), g AS ({gate_of('c')})
"""
_PLANNED = f"""WITH {addresses()}, p AS (SELECT address FROM a WHERE address IS NOT NULL GROUP BY address),
f AS (SELECT {address('url')} AS address, sha256, canonical_sha256, lower(coalesce(content_type, '')) AS t FROM snapshots WHERE error IS NULL AND coalesce(sha256, '') <> '' AND status < 500
      QUALIFY row_number() OVER (PARTITION BY {address('url')} ORDER BY retrieved_at DESC, sha256 DESC, canonical_sha256 DESC NULLS LAST, content_type DESC NULLS LAST) = 1),
r AS (SELECT sha256, renderer_id, text FROM artifacts WHERE sha256 IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY renderer_id DESC NULLS LAST, text DESC) = 1),
x AS (SELECT p.address, f.sha256, CASE WHEN t LIKE '%html%' OR t LIKE 'text/%' THEN 'html' WHEN t LIKE '%pdf%' THEN 'prose-pdf' END AS kind, r.sha256 AS shown, renderer_id, text FROM p LEFT JOIN f USING (address) LEFT JOIN r ON r.sha256 = f.canonical_sha256)
"""
_RUNS_COSTS = "(SELECT uni_id, avg(coalesce(length(value) / 1000, 0.0)) AS m, count(*) AS calls FROM ledger WHERE tier = 'llm-tail' AND ledger_seq % 5 <> 0 AND len(string_split(concat_ws(':', uni_id, program_id, field, academic_year), ':')) >= 4 GROUP BY uni_id)"

ORACLE = {
    "page_emissions": _CLAIMS + "SELECT program_id, field, ref, rule, value, method, status FROM g",
    "verified_pages": f"""WITH o AS (SELECT {address('page')} AS address, min(name) AS name FROM programs GROUP BY 1),
      d AS MATERIALIZED (SELECT 'artifact:' || artifact_id AS ref, name, text, {norm_sql('text')} AS x, {form('text')} AS body, {_NAME_AT} AS pos FROM ({latest()}) JOIN o USING (address)),
      hits AS ({harvested_of('d', 'ref, body')}),
      c AS (SELECT ref, field, value, segment, method, body FROM hits UNION ALL SELECT ref, 'language', {_NAMED}, {_AROUND_NAME}, 'name', body FROM d WHERE {_NAMED} IS NOT NULL), g AS ({gate_of('c')})
      SELECT ref, field, value, method FROM g WHERE status = 'PASS'""",
    "resolved_documents": _PLANNED + "SELECT address, 'sha256:' || sha256 AS ref, kind, renderer_id, sha256(text) AS text_sha256 FROM x WHERE sha256 IS NOT NULL AND kind IS NOT NULL AND shown IS NOT NULL",
    "unresolved_documents": _PLANNED + "SELECT address, CASE WHEN sha256 IS NULL THEN 'no usable fetch' WHEN kind IS NULL THEN 'no renderer' ELSE 'no rendering' END AS reason FROM x WHERE sha256 IS NULL OR kind IS NULL OR shown IS NULL",
    "usable_pages": "SELECT status, count(*) FILTER (WHERE error IS NULL AND status < 400) AS ok, count(*) AS fetches FROM snapshots GROUP BY status",
    "robots_hosts": r"""WITH s AS (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) AS host, robots, retrieved_at FROM snapshots)
      SELECT host, count(*) AS fetches, arg_max(robots, retrieved_at || robots) AS note, coalesce(contains(arg_max(robots, retrieved_at || robots), 'permissive'), true) AS permissive FROM s GROUP BY host""",
    "amounts": f"""WITH v AS (SELECT 'answer_key' AS src, entry_id AS row_id, expected_value AS value FROM answer_key UNION ALL SELECT 'verdicts', verdict_id, shipped_value FROM verdicts)
      SELECT src, row_id, {_NUMBER} AS number, {_CURRENCY} AS currency FROM {_AMOUNT.format('v')} WHERE {_NUMBER} IS NOT NULL""",
    "currency_equivalents": f"""WITH k AS (SELECT entry_id, p, f, {_NUMBER} AS n, {_CURRENCY} AS cur FROM {_AMOUNT.format(f'(SELECT entry_id, {_KEYED}, expected_value AS value FROM answer_key)')}),
      v AS (SELECT verdict_id, p, f, {_NUMBER} AS n, {_CURRENCY} AS cur FROM {_AMOUNT.format(f'(SELECT verdict_id, {_KEYED}, shipped_value AS value FROM verdicts)')}),
      j AS (SELECT entry_id, verdict_id, CASE k.cur WHEN 'EUR' THEN k.n ELSE k.n / 1.95583 END AS x, CASE v.cur WHEN 'EUR' THEN v.n ELSE v.n / 1.95583 END AS y FROM k JOIN v USING (p, f) WHERE k.cur <> v.cur)
      SELECT entry_id, verdict_id FROM j WHERE x <> 0 AND abs(x - y) <= 0.02 * x""",
    "common_measures": """WITH e AS (SELECT uni_id, min(run_id) AS a, max(run_id) AS b FROM ledger GROUP BY uni_id),
      p AS (SELECT uni_id AS site, run_id AS run, lower(trim(program_id)) AS program_id, count(value) > 0 AS covered, count(*) FILTER (WHERE value IS NULL) AS empty, count(*) AS fields FROM ledger JOIN e USING (uni_id) WHERE run_id IN (a, b) GROUP BY ALL),
      n AS (SELECT site, count(DISTINCT run) AS runs FROM p GROUP BY site), c AS (SELECT site, program_id FROM p JOIN n USING (site) GROUP BY site, program_id, runs HAVING count(DISTINCT run) = runs)
      SELECT site, run, count(*) AS programs, round(count(*) FILTER (WHERE covered) / count(*), 9) AS coverage, round(coalesce(sum(empty) / nullif(sum(fields), 0), 0.0), 9) AS empty_rate FROM p JOIN c USING (site, program_id) GROUP BY site, run""",
    "finding_counts": "SELECT uni_id, count(*) AS findings, count(*) FILTER (WHERE lower(trim(verdict)) = 'wrong') AS open FROM verdicts v JOIN programs p ON lower(trim(v.program_id)) = p.program_id GROUP BY uni_id",
    "call_costs": f"SELECT uni_id, calls, round(m, 9) AS mean_cost FROM {_RUNS_COSTS}",
    "cost_range": f"SELECT round(min(m), 9) AS least, round(max(m), 9) AS most, count(*) AS sites FROM {_RUNS_COSTS}",
    "run_summaries": "SELECT uni_id, run_id, count(*) AS rows, count(value) AS filled, count(DISTINCT program_id) AS programs, count(DISTINCT academic_year) AS academic_years FROM ledger GROUP BY uni_id, run_id",
    "inferred_year": r"""SELECT entry_id, CASE WHEN lower(trim(field)) NOT IN ('tuition', 'admission') OR y = '' THEN '2025/2026' ELSE y END AS academic_year
      FROM (SELECT entry_id, field, regexp_replace(regexp_extract(concat_ws(chr(10), expected_value, snippet), '\b(20\d\d)\s*/\s*(20\d\d)\b'), '\s', '', 'g') AS y FROM answer_key)""",
    "unconfigured_pages": f"WITH {addresses()} SELECT DISTINCT url FROM snapshots s WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.address = {address('s.url')})",
    "pinned_sources": """WITH u AS (SELECT 'programs.' || program_id || '.page' AS path, page AS url FROM programs UNION ALL SELECT 'programs.' || program_id || '.adm_page', adm_page FROM programs
      UNION ALL SELECT 'programs.' || program_id || '.tuition_page', tuition_page FROM programs UNION ALL SELECT 'programs.' || program_id || '.extra_pages', unnest(extra_pages) FROM programs)
      SELECT path, url || '?code=c1&version=' || length(url) AS url, 'c1' AS code, CAST(length(url) AS VARCHAR) AS version FROM u WHERE length(url) % 3 = 0""",
    "link_union": """WITH l AS (SELECT doc_id, regexp_extract(url, '^https?://[^/]+') || unnest(regexp_extract_all(text, '<a href="([^"]+)"', 1)) AS link FROM documents WHERE starts_with(text, '<div'))
      SELECT link, min(doc_id) AS first_seed, count(DISTINCT doc_id) AS seeds FROM l GROUP BY link""",
    "anchored_values": f"""WITH o AS (SELECT program_id, name, {address('page')} AS address FROM programs), d AS (SELECT address, artifact_id, {norm_sql('text')} AS x FROM ({latest()}))
      SELECT program_id, artifact_id, regexp_extract(x, '(?:Места|Places): ([0-9]+)', 1) AS value FROM o JOIN d USING (address) WHERE contains(lower(x), lower(name)) AND regexp_matches(x, '(?:Места|Places): [0-9]+')""",
}
