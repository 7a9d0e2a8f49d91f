"""Queries of the training-text operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserix.llm import boilerplate, leakage, lookalike, mixture, mojibake, sitelines, textstats
from tesserix.session import table


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """(src, row_id, text) of the texts that problems 1 and 4 are about."""
    a = table(spark, sf, "artifacts").select(F.lit("artifacts").alias("src"), F.col("artifact_id").alias("row_id"), "text")
    k = table(spark, sf, "answer_key").select(F.lit("answer_key").alias("src"), F.col("entry_id").alias("row_id"), F.col("snippet").alias("text"))
    return a.unionByName(k).where("text is not null")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).where(mojibake.is_garbled(F.col("text"))).select("src", "row_id")


def p1_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The garbled rows with their restored texts."""
    fixed = mojibake.repair_encoding(_texts(spark, sf), "text").where("encoding.garbled")
    return fixed.select("src", "row_id", F.col("encoding.repaired").alias("restored"), "encoding.restorable", "encoding.codecs")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, sf, "artifacts"), "artifact_id", "text", "source_ref", renderer="renderer_id").select(F.col("doc").alias("artifact_id"), "line_no")


def p2_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Each artifact's main body."""
    return boilerplate.main_body(table(spark, sf, "artifacts"), "artifact_id", "text", "source_ref", renderer="renderer_id").select(F.col("doc").alias("artifact_id"), "body")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return sitelines.frequent_lines(table(spark, sf, "artifacts"), "artifact_id", "text", "source_ref").select(F.col("doc").alias("artifact_id"), "line_no")


def p3_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The texts that held frequent lines, without them: all are rebuilt, for on a fresh state every frequent line has crossed."""
    docs = table(spark, sf, "artifacts")
    counts, crossed = sitelines.count_lines(docs, "artifact_id", "text", "source_ref")
    return sitelines.without_lines(docs, "artifact_id", "text", "source_ref", crossed, counts).select(F.col("doc").alias("artifact_id"), "cleaned")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = _texts(spark, sf)
    return rows.where(lookalike.looks_disguised(F.col("text")) & ~mojibake.is_garbled(F.col("text"))).select("src", "row_id")


def p4_unified(spark: SparkSession, sf: str) -> DataFrame:
    """Every text in its one consistent form."""
    return lookalike.unify_text(_texts(spark, sf), "text").select("src", "row_id", F.col("form.unified").alias("unified"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "heldout_items")).select("item_id", "doc_id")


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per leaked item: documents that hold it, the longest run, and documents that hold its answer too."""
    found = leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "heldout_items"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("run_words").alias("longest_run"), F.count_if(F.col("answer_found")).alias("with_answer"))


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mixture_targets")).documents()


def p9_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Every drawn copy in the order of the mixture."""
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mixture_targets")).sequence()


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mixture_targets")).shares()


def p9_capped_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Shares at a budget of a million tokens, where small sources come to their cap."""
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mixture_targets"), budget_tokens=1_000_000).shares()


def _profiles(spark: SparkSession, sf: str) -> dict:
    return textstats.profiles_from(table(spark, sf, "documents"), table(spark, sf, "doc_labels"), table(spark, sf, "common_words"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    stats = textstats.structural_profile(table(spark, sf, "documents"), "doc_id", "text", _profiles(spark, sf))
    return stats.where("label <> 'prose'").select("doc_id")


def p10_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return textstats.structural_profile(table(spark, sf, "documents"), "doc_id", "text", _profiles(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = (
        p1_found, p1_restored, p2_found, p2_bodies, p3_found, p3_cleaned, p4_found, p4_unified, p8_found, p8_report,
        p9_mixture, p9_sequence, p9_shares, p9_capped_shares, p10_found, p10_statistics,
    )
    return {f.__name__: f for f in names}


#: Lines compared with runs of spaces made one and outer spaces cut; site as in the operator.
_SITE_LINES = """
WITH a AS (
  SELECT artifact_id, text,
         regexp_replace(lower(regexp_extract(source_ref, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\\.', '') AS site
  FROM artifacts WHERE text IS NOT NULL
), d AS (SELECT * FROM a WHERE site <> ''),
l AS (
  SELECT artifact_id, site, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM d
), c AS (
  SELECT artifact_id, site, CAST(line_no AS INTEGER) AS line_no, trim(regexp_replace(line, ' +', ' ', 'g'), ' ') AS content FROM l
), f AS (
  SELECT c.site, content FROM c JOIN (SELECT site, count(*) AS docs FROM d GROUP BY site) t ON c.site = t.site
  WHERE content <> '' GROUP BY c.site, content, docs HAVING count(DISTINCT artifact_id) >= 4 AND count(DISTINCT artifact_id) >= 0.1 * docs
)
"""


_SPACE = "[\\s\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"


def _grams(name: str, key: str) -> str:
    """Distinct runs of 12 words of a table's texts."""
    words = f"list_filter(string_split(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]', '', 'g'), '{_SPACE}', ' ', 'g'), ' '), lambda x: x <> '')"
    return f"(SELECT DISTINCT {key}, array_to_string(w[i:i + 11], ' ') AS gram FROM (SELECT {key}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {key}, {words} AS w FROM {name})))"


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _SITE_LINES + "SELECT c.artifact_id, c.line_no FROM c JOIN f ON c.site = f.site AND c.content = f.content",
        "p3_cleaned": _SITE_LINES
        + """, m AS (SELECT l.artifact_id, l.line_no, l.line, f.content IS NOT NULL AS gone FROM l JOIN c ON c.artifact_id = l.artifact_id AND c.line_no = l.line_no LEFT JOIN f ON c.site = f.site AND c.content = f.content)
          SELECT artifact_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS cleaned FROM m GROUP BY artifact_id HAVING bool_or(gone)""",
        "p8_found": f"SELECT DISTINCT item_id, doc_id FROM {_grams('heldout_items', 'item_id')} a JOIN {_grams('documents', 'doc_id')} b USING (gram)",
    }
