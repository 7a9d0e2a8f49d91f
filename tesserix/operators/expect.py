"""What a run is held against: amounts and their equivalence in another currency, measures over common programmes, costs and findings.

Only the relations are here; which value of a measure is too much is the caller's affair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserix.functions.quantity import BGN_PER_EUR

# The wording of an amount with its currency.
AMOUNT = r"(?iu)(\d[\d.,]*)\s*(лв\.?|leva|bgn|eur|€|евро)"
EUROS = ("eur", "€", "евро")


def amount(text: Column) -> Column:
    """struct(number, currency) of the first amount; null without one.

    Two digits after a last mark are decimals and all earlier marks fall; otherwise
    commas fall and a point stays a point, so 1.500 is one and a half.  A number is
    read from its last blank on: "1 200 лв" is 200.
    """
    written, currency = F.regexp_extract(text, AMOUNT, 1), F.lower(F.regexp_extract(text, AMOUNT, 2))
    cents = F.concat(F.regexp_replace(F.regexp_replace(written, r"[.,]\d{2}$", ""), "[.,]", ""), F.lit("."), F.substring(written, -2, 2))
    number = F.when(written.rlike(r"[.,]\d{2}$"), cents).otherwise(F.replace(written, F.lit(","), F.lit(""))).try_cast("double")
    return F.when(number.isNotNull(), F.struct(number.alias("number"), F.when(currency.isin(*EUROS), "EUR").otherwise("BGN").alias("currency")))


def in_euros(found: Column) -> Column:
    return F.when(found["currency"] == "EUR", found["number"]).otherwise(found["number"] / F.lit(BGN_PER_EUR))


def currency_equivalent(old: Column, new: Column, tolerance: float = 0.02) -> Column:
    """True where two texts state the same amount in different currencies."""
    a, b = amount(old), amount(new)
    near = F.abs(in_euros(a) - in_euros(b)) <= F.lit(tolerance) * in_euros(a)
    return F.coalesce((a["currency"] != b["currency"]) & (in_euros(a) != 0) & near, F.lit(False))


def common_measures(runs: DataFrame) -> DataFrame:
    """Per run of (site, run, program_id, covered, empty, fields): programmes, coverage and share of empty cells over the programmes that all runs of the site have."""
    every = runs.groupBy("site").agg(F.count_distinct("run").alias("runs"))
    common = runs.groupBy("site", "program_id").agg(F.count_distinct("run").alias("in_runs")).join(every, "site").where("in_runs = runs").select("site", "program_id")
    rows = runs.join(common, ["site", "program_id"], "left_semi").groupBy("site", "run")
    return rows.agg(F.count("*").alias("programs"), (F.count_if("covered") / F.count("*")).alias("coverage"), F.coalesce(F.try_divide(F.sum("empty"), F.sum("fields")), F.lit(0.0)).alias("empty_rate"))


def call_costs(calls: DataFrame) -> DataFrame:
    """(uni_id, calls, mean_cost) of the calls (uni_id, tag, cost) whose tag names site, programme, field and attempt; a missing cost is nothing."""
    full = calls.where(F.size(F.split(F.coalesce("tag", F.lit("")), ":")) >= 4)
    return full.groupBy("uni_id").agg(F.count("*").alias("calls"), F.avg(F.coalesce("cost", F.lit(0.0))).alias("mean_cost"))


def cost_range(costs: DataFrame) -> DataFrame:
    return costs.agg(F.min("mean_cost").alias("least"), F.max("mean_cost").alias("most"), F.count("*").alias("sites"))


def finding_counts(findings: DataFrame) -> DataFrame:
    """(uni_id, findings, open) of findings (uni_id, status)."""
    return findings.groupBy("uni_id").agg(F.count("*").alias("findings"), F.count_if(F.col("status") == "open").alias("open"))
