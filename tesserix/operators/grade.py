"""Comparison with a frozen key: full outer by key, verdict overlay, three-valued rates, exact bounds."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORIES = ("OK_VALUE", "OK_NULL", "OK_MANUAL", "CHECK", "WRONG", "MISS", "MISS_GATE", "FABRICATION", "REJECTED_VS_NULL_KEY", "PARSE_FAILURE")


def read_key(key: DataFrame) -> DataFrame:
    """(program_id, field, expected) of a frozen key; a cell stated twice fails the job rather than picking one."""
    rows = key.groupBy("program_id", "field").agg(F.max("expected").alias("expected"), F.count("*").alias("n"))
    single = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("stated twice: "), "program_id", F.lit(" "), "field")).cast("string")).otherwise(F.col("expected"))
    return rows.select("program_id", "field", single.alias("expected"))


def category(expected: Column, status: Column, matches: Column) -> Column:
    """The decision table of a key cell against a status; null for an unknown status."""
    rejected = status.isin("REJECT_CONTAINMENT", "REJECT_SUPPORT")
    return F.when(expected.isNull(), F.when(status == "PASS", "FABRICATION").when(status == "NULL_OK", "OK_NULL").when(status == "PARSE_FAILURE", "PARSE_FAILURE").when(rejected, "REJECTED_VS_NULL_KEY")).otherwise(
        F.when(status == "PASS", F.when(matches, "OK_VALUE").otherwise("CHECK")).when(status == "NULL_OK", "MISS").when(status == "PARSE_FAILURE", "PARSE_FAILURE").when(rejected, "MISS_GATE")
    )


def grade(key: DataFrame, report: DataFrame, verdicts: DataFrame, matches) -> tuple[DataFrame, DataFrame]:
    """(graded, orphans): key (program_id, field, expected) against report (program_id, field, status, shipped).

    A verdict (program_id, field, verdict, shipped_value) settles a CHECK where it
    names no shipped value or the very one.  Rows on one side only are orphans.
    `matches(expected, shipped)` is the Column that compares two values.
    """
    on = ["program_id", "field"]
    k = key.select(*on, "expected", F.lit(True).alias("in_key"))
    r = report.select(*on, "status", "shipped", F.lit(True).alias("in_report"))
    both = k.join(r, on, "full_outer")
    orphans = both.where("in_key is null or in_report is null").select(*on, F.when(F.col("in_key").isNull(), "report").otherwise("key").alias("side"))
    own = both.where("in_key and in_report").withColumn("category", category(F.col("expected"), F.col("status"), matches(F.col("expected"), F.col("shipped"))))
    said = verdicts.select(*on, F.lower(F.trim("verdict")).alias("verdict"), "shipped_value").where("verdict in ('ok', 'wrong')")
    bound = own.where("category = 'CHECK'").join(said, on).where("shipped_value is null or shipped_value = shipped").groupBy(*on).agg(F.max("verdict").alias("verdict"))
    settled = own.join(bound, on, "left").withColumn("category", F.when(F.col("verdict") == "ok", "OK_MANUAL").when(F.col("verdict") == "wrong", "WRONG").otherwise(F.col("category")))
    return settled.select(*on, "expected", "status", "shipped", "category"), orphans


def rates(graded: DataFrame) -> DataFrame:
    """Counts and rates; what depends on an open CHECK is null, not zero."""
    n = F.count("*")
    passed = F.count_if(F.col("status") == "PASS")
    checks = F.count_if(F.col("category") == "CHECK")
    wrong = F.count_if(F.col("category") == "WRONG")
    made_up = F.count_if(F.col("category") == "FABRICATION")
    base = graded.agg(n.alias("rows"), passed.alias("passed"), checks.alias("checks"), wrong.alias("wrong"), made_up.alias("fabrications"))
    rate = F.when(F.col("checks") == 0, F.col("wrong") / F.greatest("passed", F.lit(1)))
    return base.withColumns({"fabrication_rate": F.col("fabrications") / F.greatest("rows", F.lit(1)), "wrong_rate": rate})


def binomial_upper(n: int, k: int, level: float = 0.95) -> float:
    """Exact one-sided upper bound of a share of which k in n were seen; 1 for n = 0 or k >= n."""
    if n <= 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(200):
        p = (low + high) / 2
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        if math.fsum(math.exp(x) for x in logs) > 1 - level:
            low = p
        else:
            high = p
        if high - low < 1e-15:
            break
    return high


@F.arrow_udf(T.DoubleType())
def binomial_upper_bound(n: pa.Array, k: pa.Array) -> pa.Array:
    """Column form of binomial_upper."""
    return pa.array([None if a is None or b is None else binomial_upper(a, b) for a, b in zip(n.to_pylist(), k.to_pylist(), strict=True)], pa.float64())
