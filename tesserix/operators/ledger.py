"""The append-only value ledger: load a run, compare two runs, year of a value, pointer."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ["program_id", "field", "academic_year"]


def run_values(ledger: DataFrame, run_id: str) -> DataFrame:
    """(key..., value): the last append of each key within one run."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("ledger_seq").desc())
    return ledger.where(F.col("run_id") == run_id).withColumn("__n", F.row_number().over(newest)).where("__n = 1").select(*KEY, "value")


def diff_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key..., change, old_value, new_value) between two sets of (key..., value); equal rows are dropped, null years are one year."""
    a = before.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEY], F.struct("value").alias("a"))
    b = after.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEY], F.struct("value").alias("b"))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(~F.col("a.value").eqNullSafe(F.col("b.value")), "changed")
    return a.join(b, KEY, "full_outer").withColumn("change", change).where("change is not null").select(*KEY, "change", F.col("a.value").alias("old_value"), F.col("b.value").alias("new_value"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.agg(*[F.count_if(F.col("change") == x).alias(x) for x in ("added", "removed", "changed")])


def academic_year_in(value: Column, segments: Column) -> Column:
    """The first YYYY/YYYY stated by the value, else by its segments; null without one."""
    stated = F.regexp_extract(F.concat_ws("\n", value, segments), r"\b(20\d\d)\s*/\s*(20\d\d)\b", 0)
    return F.when(stated != "", F.regexp_replace(stated, r"\s", ""))


#: Fields whose values change from year to year.
YEARLY = ("tuition", "admission")


def inferred_year(field: Column, value: Column, segments: Column, fallback: Column) -> Column:
    """The year a yearly field's value or segments state, else the run's; null fields are searched too."""
    return F.when(field.isNotNull() & ~field.isin(*YEARLY), fallback).otherwise(F.coalesce(academic_year_in(value, segments), fallback))


def run_summaries(ledger: DataFrame) -> DataFrame:
    """(uni_id, run_id, rows, filled, programs, academic_years): one row per run of what it wrote."""
    runs = ledger.groupBy("uni_id", "run_id")
    return runs.agg(F.count("*").alias("rows"), F.count("value").alias("filled"), F.count_distinct("program_id").alias("programs"), F.count_distinct("academic_year").alias("academic_years"))


def new_run_id(uni_id: str) -> str:
    """`<uni_id>-<UTC time>-<hex>`."""
    return f"{uni_id}-{datetime.now(UTC):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


class Pointer:
    """Which run of a site is current: moves are appended, the last one holds, so moving it back is a rollback."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _moves(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:
            return None

    def move(self, uni_id: str, run_id: str) -> None:
        moves = self._moves()
        n = 0 if moves is None else moves.agg(F.max("n")).first()[0]
        self.spark.createDataFrame([(uni_id, run_id, n + 1)], "uni_id string, run_id string, n long").coalesce(1).write.mode("append").parquet(self.path)

    def current(self, uni_id: str) -> str | None:
        moves = self._moves()
        last = None if moves is None else moves.where(F.col("uni_id") == uni_id).agg(F.max_by("run_id", "n").alias("run_id")).first()
        return last["run_id"] if last else None


def expected_year(day: Column) -> Column:
    """The academic year a day falls in; years begin in July."""
    first = F.year(day) - F.when(F.month(day) >= 7, 0).otherwise(1)
    return F.concat_ws("/", first.cast("string"), (first + 1).cast("string"))


def append_run(values: DataFrame, path: str) -> None:
    """Appends a run's rows, partitioned so that loading a run reads nothing else."""
    values.write.mode("append").partitionBy("uni_id", "run_id").parquet(path)


def load_run(spark: SparkSession, path: str, uni_id: str, run_id: str) -> DataFrame:
    """Rows of one run; partition pruning leaves the rest of the ledger unread."""
    return spark.read.parquet(path).where((F.col("uni_id") == uni_id) & (F.col("run_id") == run_id))


def set_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change) with added, removed or stable for the distinct keys of two tables."""
    a, b = before.select(key).distinct().withColumn("a", F.lit(1)), after.select(key).distinct().withColumn("b", F.lit(1))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("stable")
    return a.join(b, key, "full_outer").select(key, change.alias("change"))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The old rows whose key the new ones don't have, and the new ones."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def coverage(values: DataFrame, programs: DataFrame) -> DataFrame:
    """Per programme whether any value is there, and of those key fields how many are empty."""
    per = values.groupBy("program_id").agg(F.bool_or(F.col("value").isNotNull()).alias("covered"), F.count_if(F.col("value").isNull()).alias("empty"), F.count("*").alias("fields"))
    return programs.select("program_id").distinct().join(per, "program_id", "left").select("program_id", F.coalesce("covered", F.lit(False)).alias("covered"), F.coalesce("empty", F.lit(0)).alias("empty"), F.coalesce("fields", F.lit(0)).alias("fields"))


def coverage_totals(per_program: DataFrame) -> DataFrame:
    return per_program.agg(F.count("*").alias("programs"), F.count_if("covered").alias("covered"), (F.count_if("covered") / F.greatest(F.count("*"), F.lit(1))).alias("coverage"), (F.sum("empty") / F.greatest(F.sum("fields"), F.lit(1))).alias("empty_rate"))
