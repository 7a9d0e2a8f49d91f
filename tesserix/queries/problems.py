"""Queries of the general training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserix.functions.quantity import key_id, key_name
from tesserix.operators import quantities, snapshot_changes, wide_table
from tesserix.session import table, write_once

def _statements(spark: SparkSession, sf: str) -> DataFrame:
    k = table(spark, sf, "answer_key").select(F.lit("answer_key").alias("src"), F.col("entry_id").alias("row_id"), "program_id", "field", F.col("expected_value").alias("text"), F.col("snippet").alias("context"), F.col("labelled_at").alias("stamp"))
    v = table(spark, sf, "verdicts").select(F.lit("verdicts").alias("src"), F.col("verdict_id").alias("row_id"), "program_id", "field", F.col("shipped_value").alias("text"), F.col("note").alias("context"), F.col("judged_at").alias("stamp"))
    return k.unionByName(v).select("src", "row_id", key_id(F.col("program_id")).alias("device"), key_id(F.col("field")).alias("field"), "text", "context", "stamp")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    common = write_once(quantities.common_units(_statements(spark, sf)), "common-units")
    pairs = quantities.equal_statements(common.where("src = 'answer_key'"), common.where("src = 'verdicts'"))
    return pairs.select(F.col("left_id").alias("entry_id"), F.col("right_id").alias("verdict_id"))


def p5_common_units(spark: SparkSession, sf: str) -> DataFrame:
    """Every stated fee in euros per academic year and every stated length in semesters."""
    return quantities.common_units(_statements(spark, sf)).select("src", "row_id", F.col("device").alias("program_id"), "field", "unit", F.round("value", 4).alias("value"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_changes.snapshot_changes(table(spark, sf, "ledger")).select("run_id", "program_id", "field", "academic_year", "change")


def p6_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The changes with old and new values."""
    return snapshot_changes.snapshot_changes(table(spark, sf, "ledger")).drop("site")


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    k = table(spark, sf, "answer_key")
    return k.select(key_id(F.col("program_id")).alias("entity"), key_name(F.col("field")).alias("attribute"), F.col("expected_value").alias("value"), F.col("labelled_at").alias("stamp"), F.col("entry_id").alias("id"))


def _wide(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, str]]:
    cells = _cells(spark, sf)
    types = wide_table.discover(cells)
    return wide_table.widen(cells, types), types


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    wide, types = _wide(spark, sf)
    return wide_table.filled_cells(wide, types).select(F.col("entity").alias("program_id"), F.col("attribute").alias("field"))


def p7_wide(spark: SparkSession, sf: str) -> DataFrame:
    """One row per programme with typed columns."""
    return _wide(spark, sf)[0].withColumnRenamed("entity", "program_id")


QUERIES = (p5_found, p5_common_units, p6_found, p6_changes, p7_found, p7_wide)

_BLANK = "'[\\s\\x{00A0}]+'"
_RUNS = """
WITH l AS (
  SELECT ledger_seq, lower(trim(uni_id)) AS site, trim(run_id) AS run_id, lower(trim(program_id)) AS program_id, lower(trim(field)) AS field,
         regexp_extract(academic_year, '(\\d{4})', 1) AS y1, regexp_extract(academic_year, '\\d{4}\\D+(\\d{2,4})\\s*$', 1) AS y2,
         trim(regexp_replace(value, '[\\s\\x{00A0}]+', ' ', 'g')) AS value
  FROM ledger
), n AS (
  SELECT *, y1 || '/' || CASE WHEN length(y2) = 4 THEN y2 WHEN length(y2) = 2 THEN substr(y1, 1, 2) || y2 ELSE CAST(CAST(y1 AS INTEGER) + 1 AS VARCHAR) END AS academic_year FROM l
), v AS (
  SELECT site, run_id, program_id, field, academic_year, value FROM n
  QUALIFY row_number() OVER (PARTITION BY site, run_id, program_id, field, academic_year ORDER BY ledger_seq DESC) = 1
), r AS (
  SELECT site, run_id, lag(run_id) OVER (PARTITION BY site ORDER BY regexp_extract(run_id, '\\d{8}T\\d{6}Z'), run_id) AS before FROM (SELECT DISTINCT site, run_id FROM v)
), b AS (
  SELECT r.site, r.run_id, v.program_id, v.field, v.academic_year, v.value FROM r JOIN v ON v.site = r.site AND v.run_id = r.before
), a AS (
  SELECT v.* FROM v JOIN r ON r.site = v.site AND r.run_id = v.run_id WHERE r.before IS NOT NULL
), c AS (
  SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.program_id, b.program_id) AS program_id, coalesce(a.field, b.field) AS field,
         coalesce(a.academic_year, b.academic_year) AS academic_year,
         CASE WHEN b.site IS NULL THEN 'added' WHEN a.site IS NULL THEN 'removed' WHEN a.value IS DISTINCT FROM b.value THEN 'changed' END AS change,
         b.value AS old_value, a.value AS new_value
  FROM a FULL JOIN b ON a.site = b.site AND a.run_id = b.run_id AND a.program_id = b.program_id AND a.field = b.field AND a.academic_year = b.academic_year
)
"""
_TYPED_CELLS = """
WITH k AS (
  SELECT lower(trim(program_id)) AS program_id, regexp_replace(lower(trim(field)), '[\\s\\-]+', '_', 'g') AS field, trim(regexp_replace(expected_value, '\\s+', ' ', 'g')) AS v, labelled_at, entry_id FROM answer_key
), t AS (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY program_id, field ORDER BY labelled_at DESC NULLS LAST, entry_id DESC) = 1
), f AS (
  SELECT program_id, field, v, lower(regexp_replace(v, ' ?г\\.?$', '')) AS d FROM t
  WHERE v IS NOT NULL AND lower(v) NOT IN ('', '-', '–', '—', '?', 'n/a', 'na', 'tbd', 'not stated', 'няма данни', 'none', 'null') AND NOT starts_with(lower(v), 'hand-judged')
), m AS (
  SELECT *, CASE regexp_extract(d, '([a-zа-я]+)')
    WHEN 'януари' THEN 1 WHEN 'january' THEN 1 WHEN 'jan' THEN 1 WHEN 'февруари' THEN 2 WHEN 'february' THEN 2 WHEN 'feb' THEN 2
    WHEN 'март' THEN 3 WHEN 'march' THEN 3 WHEN 'mar' THEN 3 WHEN 'април' THEN 4 WHEN 'april' THEN 4 WHEN 'apr' THEN 4 WHEN 'май' THEN 5 WHEN 'may' THEN 5
    WHEN 'юни' THEN 6 WHEN 'june' THEN 6 WHEN 'jun' THEN 6 WHEN 'юли' THEN 7 WHEN 'july' THEN 7 WHEN 'jul' THEN 7 WHEN 'август' THEN 8 WHEN 'august' THEN 8 WHEN 'aug' THEN 8
    WHEN 'септември' THEN 9 WHEN 'september' THEN 9 WHEN 'sep' THEN 9 WHEN 'октомври' THEN 10 WHEN 'october' THEN 10 WHEN 'oct' THEN 10
    WHEN 'ноември' THEN 11 WHEN 'november' THEN 11 WHEN 'nov' THEN 11 WHEN 'декември' THEN 12 WHEN 'december' THEN 12 WHEN 'dec' THEN 12 END AS mon FROM f
)
"""
_LATEST_CELLS = _TYPED_CELLS + """SELECT program_id, field FROM m WHERE CASE
  WHEN field IN ('credits', 'seats') THEN regexp_matches(v, '^\\d+([.,]0+)?( ?[A-Za-zА-Яа-я.]+){0,2}$')
  WHEN field = 'min_score' THEN regexp_matches(v, '^\\d+([.,]\\d+)?( ?[A-Za-zА-Яа-я.]+){0,2}$')
  WHEN field = 'distance' THEN lower(v) IN ('yes', 'true', '1', 'да', 'y', 'no', 'false', '0', 'не', 'n')
  WHEN field IN ('accredited_until', 'start_date') THEN CASE
    WHEN regexp_matches(d, '^\\d{4}-\\d{1,2}-\\d{1,2}$') THEN try_cast(d AS DATE) IS NOT NULL
    WHEN regexp_matches(d, '^\\d{1,2}[./]\\d{1,2}[./]\\d{4}$') THEN try_strptime(replace(d, '/', '.'), '%d.%m.%Y') IS NOT NULL
    WHEN regexp_matches(d, '^\\d{1,2} [a-zа-я]+ \\d{4}$') THEN try_strptime(regexp_extract(d, '^\\d+') || '.' || mon || '.' || regexp_extract(d, '\\d{4}$'), '%d.%m.%Y') IS NOT NULL
    WHEN regexp_matches(d, '^[a-zа-я]+ \\d{1,2}, \\d{4}$') THEN try_strptime(regexp_extract(d, ' (\\d+),', 1) || '.' || mon || '.' || regexp_extract(d, '\\d{4}$'), '%d.%m.%Y') IS NOT NULL
    ELSE false END
  WHEN field = 'tuition' THEN regexp_matches(v, '\\d') AND regexp_matches(lower(v), '€|eur|евро|bgn|lv|leva|лв|лева|^[\\d .,]+$')
  WHEN field = 'duration' THEN regexp_matches(lower(v), 'годин|годиш|семест|сем\\.|месец|мес\\.|г\\.|year|semest|month')
  ELSE true END
"""

_DATE = """CASE WHEN regexp_matches(d, '^\\d{4}-\\d{1,2}-\\d{1,2}$') THEN try_cast(d AS DATE)
    WHEN regexp_matches(d, '^\\d{1,2}[./]\\d{1,2}[./]\\d{4}$') THEN CAST(try_strptime(replace(d, '/', '.'), '%d.%m.%Y') AS DATE)
    WHEN regexp_matches(d, '^\\d{1,2} [a-zа-я]+ \\d{4}$') THEN CAST(try_strptime(regexp_extract(d, '^\\d+') || '.' || mon || '.' || regexp_extract(d, '\\d{4}$'), '%d.%m.%Y') AS DATE)
    WHEN regexp_matches(d, '^[a-zа-я]+ \\d{1,2}, \\d{4}$') THEN CAST(try_strptime(regexp_extract(d, ' (\\d+),', 1) || '.' || mon || '.' || regexp_extract(d, '\\d{4}$'), '%d.%m.%Y') AS DATE) END"""
_UNIT = "( ?[A-Za-zА-Яа-я.]+){0,2}$'"
_CELL = {
    **{f: f"try_cast(CASE WHEN regexp_matches(v, '^\\d+([.,]0+)?{_UNIT}) THEN regexp_extract(v, '^\\d+') END AS BIGINT)" for f in ("credits", "seats")},
    "min_score": f"try_cast(CASE WHEN regexp_matches(v, '^\\d+([.,]\\d+)?{_UNIT}) THEN replace(regexp_extract(v, '^\\d+([.,]\\d+)?'), ',', '.') END AS DECIMAL(18, 4))",
    "distance": "CASE WHEN lower(v) IN ('yes', 'true', '1', 'да', 'y') THEN true WHEN lower(v) IN ('no', 'false', '0', 'не', 'n') THEN false END",
    **dict.fromkeys(("accredited_until", "start_date"), _DATE),
    "tuition": "CASE WHEN regexp_matches(v, '\\d') AND regexp_matches(lower(v), '€|eur|евро|bgn|lv|leva|лв|лева|^[\\d .,]+$') THEN v END",
    "duration": "CASE WHEN regexp_matches(lower(v), 'годин|годиш|семест|сем\\.|месец|мес\\.|г\\.|year|semest|month') THEN v END",
    **dict.fromkeys(("admission", "campus", "degree", "language"), "v"),
}

ORACLE = {
    "p7_wide": _TYPED_CELLS
    + "SELECT k.program_id, "
    + ", ".join(f"any_value({cell}) FILTER (WHERE m.field = '{f}') AS {f}" for f, cell in _CELL.items())
    + " FROM (SELECT DISTINCT program_id FROM t WHERE program_id IS NOT NULL) k LEFT JOIN m ON m.program_id = k.program_id GROUP BY k.program_id",
    "p6_found": _RUNS + "SELECT run_id, program_id, field, academic_year, change FROM c WHERE change IS NOT NULL",
    "p6_changes": _RUNS + "SELECT run_id, program_id, field, academic_year, change, old_value, new_value FROM c WHERE change IS NOT NULL",
    "p7_found": _LATEST_CELLS,
}
