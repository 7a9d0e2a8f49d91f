"""What changed between consecutive full snapshots.

Method: snapshots are range-partitioned and sorted by key, and a two-pointer merge
streams over each range: of every site the snapshots follow each other in order of
their runs, one pointer runs over the snapshot before, the other over the next,
both in order of the key, columns are compared where the keys meet and typed
changes come out.  A range holds one snapshot's part of itself at a time.  A
snapshot without a row in a range is an empty one there: what stood before was
removed by it, what comes after was added.

One exchange carries the rows to their ranges; repeated appends meet there, for a
range never splits a key, and the last one holds.  A hot site is spread over
ranges, for ranges are cut by the whole key.

SnapshotStore keeps the newest snapshot of each site that way, so that runs
which arrive later are compared without the history before it.

Defined results: rows with a null site, run or key part take no part; a run id
without a time is ordered by its text after those with one; a null value is a
value of its own, equal to null only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.functions.quantity import key_id
from tesserix.session import fresh_path, write_once

KEY = ("program_id", "field", "academic_year")


def year_key(year: Column) -> Column:
    """Academic year as YYYY/YYYY, however its two years are joined; a single year stands for itself and the next; other text trimmed."""
    first = F.regexp_extract(year, r"(\d{4})", 1)
    second = F.regexp_extract(year, r"\d{4}\D+(\d{2,4})\s*$", 1)
    full = F.when(F.length(second) == 4, second).when(F.length(second) == 2, F.concat(F.substring(first, 1, 2), second)).otherwise((first.try_cast("int") + 1).cast("string"))
    return F.when(first != "", F.concat(first, F.lit("/"), full)).otherwise(F.trim(year))


def run_time(run_id: Column) -> Column:
    """The time inside a run id, as sortable text."""
    return F.regexp_extract(run_id, r"(\d{8}T\d{6}Z)", 1)


def _one_blank(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"[\s ]+", " "))


def keyed_rows(ledger: DataFrame) -> DataFrame:
    """(site, run_id, key..., seq, value) with keys and values in their compared form, parsed once and written: nothing below repeats an expression of it."""
    parsed = ledger.select(
        key_id(F.col("uni_id")).alias("site"),
        F.trim("run_id").alias("run_id"),
        key_id(F.col("program_id")).alias("program_id"),
        key_id(F.col("field")).alias("field"),
        year_key(F.col("academic_year")).alias("academic_year"),
        F.col("ledger_seq").cast("long").alias("seq"),
        _one_blank(F.col("value")).alias("value"),
    )
    return write_once(parsed, "keyed")


def run_order(rows: DataFrame) -> DataFrame:
    """(site, run_id, place, next_run) of rows (site, run_id, ...): the runs of each site in order of the time in their ids; one row a run."""
    runs = rows.select("site", "run_id").dropna().distinct()
    order = Window.partitionBy("site").orderBy(F.when(run_time(F.col("run_id")) == "", "~").otherwise(run_time(F.col("run_id"))), "run_id")
    return runs.select("site", "run_id", F.row_number().over(order).alias("place"), F.lead("run_id").over(order).alias("next_run"))


CHANGES = T.StructType([T.StructField(n, T.StringType()) for n in ("site", "run_id", *KEY, "change", "old_value", "new_value")])
Rows = list[tuple[tuple, str | None]]


def two_pointers(before: Rows, after: Rows) -> Iterator[tuple]:
    """(key, change, old, new) of two snapshots, each a list of (key, value) in order of distinct keys."""
    i = j = 0
    while i < len(before) and j < len(after):
        (a, old), (b, new) = before[i], after[j]
        if a == b:
            if old != new:
                yield a, "changed", old, new
            i, j = i + 1, j + 1
        elif a < b:
            yield a, "removed", old, None
            i += 1
        else:
            yield b, "added", None, new
            j += 1
    for a, old in before[i:]:
        yield a, "removed", old, None
    for b, new in after[j:]:
        yield b, "added", None, new


def _snapshots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(site, place, run_id, next_run, first, rows) of each snapshot's part of a range; of repeated keys the last row."""
    at, head, rows = None, None, []
    for b in batches:
        for site, place, run_id, next_run, first, *key, value in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (site, place) != at:
                if head:
                    yield *head, rows
                at, head, rows = (site, place), (site, place, run_id, next_run, first), []
            key = tuple(key)
            if rows and rows[-1][0] == key:
                rows[-1] = (key, value)
            else:
                rows.append((key, value))
    if head:
        yield *head, rows


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Output rows of one range."""
    site, place, next_run, before = None, 0, None, []
    for own, at, run_id, following, first, rows in _snapshots(batches):
        if own == site and at == place + 1:
            yield from ((own, run_id, *key, *change) for key, *change in two_pointers(before, rows))
        else:
            if next_run:
                yield from ((site, next_run, *key, *change) for key, *change in two_pointers(before, []))
            if not first:
                yield from ((own, run_id, *key, *change) for key, *change in two_pointers([], rows))
        site, place, next_run, before = own, at, following, rows
    if next_run:
        yield from ((site, next_run, *key, *change) for key, *change in two_pointers(before, []))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = _changes(batches)
    while some := list(islice(found, 50_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], names=CHANGES.names)


def merge_ranges(rows: DataFrame) -> DataFrame:
    """Changes of rows (site, place, run_id, next_run, first, key..., seq, value); `first` marks a run with none before it."""
    sorted_ranges = rows.dropna(subset=list(KEY)).repartitionByRange("site", *KEY).sortWithinPartitions("site", "place", *KEY, "seq")
    return sorted_ranges.select("site", "place", "run_id", "next_run", "first", *KEY, "value").mapInArrow(_merge, CHANGES)


def snapshot_changes(ledger: DataFrame) -> DataFrame:
    """(site, run_id, program_id, field, academic_year, change, old_value, new_value) of every run against the one before it."""
    rows = keyed_rows(ledger)
    # Written, so that Spark knows its size and need not shuffle the rows where it is small.
    runs = write_once(run_order(rows).withColumn("first", F.col("place") == 1), "runs")
    return merge_ranges(rows.join(runs, ["site", "run_id"]))


class SnapshotStore:
    """The newest snapshot of each site, kept in a folder range-partitioned and sorted by key.

    `advance` takes the rows of later runs and returns their changes against what
    is kept and each other; only the new rows and the newest snapshots of their
    sites are read and shuffled, never the history.  Rows of a run that isn't later
    than the one kept come too late and take no part.  An advance that fails leaves
    the state as it was, for a version holds once its pointer row is written.
    """

    SCHEMA = "site string, run_id string, program_id string, field string, academic_year string, seq long, value string"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "snapshots")
        try:
            self.version = spark.read.parquet(f"{self.path}/pointer").agg(F.max("version")).first()[0] or 0
        except AnalysisException:
            self.version = 0

    def newest(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/newest-{self.version}")

    def advance(self, ledger: DataFrame) -> DataFrame:
        kept = self.newest()
        last = kept.select("site", F.col("run_id").alias("kept_run")).distinct()  # one row a site
        stamp = lambda c: F.struct(F.when(run_time(c) == "", "~").otherwise(run_time(c)), c)
        rows = keyed_rows(ledger).join(last, "site", "left")
        rows = rows.where(F.col("kept_run").isNull() | (stamp(F.col("run_id")) > stamp(F.col("kept_run")))).drop("kept_run")
        runs = run_order(rows).join(last, "site", "left")
        runs = write_once(runs.withColumn("first", (F.col("place") == 1) & F.col("kept_run").isNull()), "runs")
        known = runs.where("place = 1 and kept_run is not null").select("site", F.col("kept_run").alias("run_id"), F.lit(0).alias("place"), F.col("run_id").alias("next_run"), F.lit(True).alias("first"))
        new = rows.join(runs.drop("kept_run"), ["site", "run_id"])
        changes = write_once(merge_ranges(new.unionByName(kept.join(known, ["site", "run_id"]))), "changes")
        latest = rows.dropna(subset=list(KEY)).join(runs.where("next_run is null").select("site", "run_id"), ["site", "run_id"]).groupBy("site", "run_id", *KEY).agg(F.max(F.struct("seq", "value")).alias("last"))
        latest = latest.select("site", "run_id", *KEY, "last.seq", "last.value").unionByName(kept.join(runs.select("site").distinct(), "site", "left_anti"))
        latest.repartitionByRange("site", *KEY).sortWithinPartitions("site", *KEY).write.mode("overwrite").parquet(f"{self.path}/newest-{self.version + 1}")
        self.version += 1
        self.spark.createDataFrame([(self.version,)], "version int").coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")
        return changes
