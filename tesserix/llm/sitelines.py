"""Lines that stand in very many texts of one site.

Method: per-site line-count tables are kept incrementally in a named folder.  A
new partition of documents is reduced to its line keys and to a delta (site, line
key, documents); the delta is merged into the counts of the touched buckets of
sites, the lines whose share crosses the threshold either way are detected, and
only documents holding a newly crossed line are rebuilt.  On a fresh state every
frequent line has newly crossed.

Keys are 128-bit digests of the line.  A text is split once: its keys are kept in
the order of its lines, so that neither counts nor lookups read texts again.
Counts are reduced map-side, so a line that stands in every document of a hot
site costs one row per task.

A line is frequent where it stands in at least `min_docs` and at least
`min_share` of the site's documents with a non-null text, each document once.
Lines are compared with runs of spaces (U+0020) made one and outer spaces cut;
empty lines never count.

Defined results: null text or an address without a host takes no part; an empty
text counts as a document without lines; an id delivered again for its site, in
the same partition or a later one, counts once, as first delivered.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserix.functions.urls import site_of
from tesserix.session import fresh_path

MIN_DOCS = 4
MIN_SHARE = 0.1
#: Buckets of sites in the kept counts.
BUCKETS = 64


def line_content(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, " +", " "))


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _documents(docs: DataFrame, doc_id: str, text: str, url: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc"), site_of(F.col(url)).alias("site"), F.col(text).alias("text")).where("site is not null and text is not null")


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc, site, keys) of (doc, site, text): the key of each line, null for blank ones; each id of a site once."""
    key = lambda x: F.when(x != "", line_key(x))
    keys = F.transform(F.transform(F.split("text", "\n"), line_content), key)
    return docs.select("doc", "site", keys.alias("keys")).dropDuplicates(["site", "doc"])


def delta(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(site, key, n) and (site, docs) of one partition of (doc, site, keys)."""
    counts = lines.select("site", F.explode(F.array_distinct(F.array_compact("keys"))).alias("key")).groupBy("site", "key").agg(F.count("*").alias("n"))
    return counts, lines.groupBy("site").agg(F.count("*").alias("docs"))


def _bucket(site: str = "site") -> Column:
    return F.pmod(F.xxhash64(site), F.lit(BUCKETS)).cast("int")


class LineCounts:
    """Counts of one corpus, grown a partition at a time and kept in a named folder.

    In it are `lines` (doc, site, keys), a folder for each partition merged, and
    for each version the buckets of `counts` and `sites` that its merge touched;
    a pointer table says which version of a bucket holds.  Opening the folder
    again goes on where the last merge ended; a merge that fails leaves no trace
    in the pointer.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE):
        self.spark, self.min_docs, self.min_share = spark, min_docs, min_share
        self.path = path or fresh_path(spark, "line-counts")
        try:
            kept = spark.read.parquet(f"{self.path}/pointer").orderBy(F.desc("version")).first()  # one row a merge
        except AnalysisException:
            kept = None
        self.version: int = kept["version"] if kept else 0
        self.holds: dict[int, int] = dict(kept["holds"]) if kept else {}

    def _read(self, what: str, buckets: set[int] | None = None, schema: str = "site string, key binary, n long") -> DataFrame:
        parts = [f"{self.path}/{what}/version={v}/bucket={b}" for b, v in sorted(self.holds.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def lines(self) -> DataFrame:
        """(doc, site, keys) of every document merged."""
        schema = "doc long, site string, keys array<binary>"
        parts = [f"{self.path}/lines/version={v}" for v in range(1, self.version + 1)]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def sites(self, buckets: set[int] | None = None) -> DataFrame:
        return self._read("sites", buckets, "site string, docs long")

    def merge(self, docs: DataFrame) -> DataFrame:
        """Merges a partition of (doc, site, text); returns the lines (site, key, frequent) that crossed the threshold."""
        version = self.version + 1
        new = line_keys(docs)
        if self.version:
            new = new.join(self.lines().select("site", "doc"), ["site", "doc"], "left_anti")
        at = f"{self.path}/lines/version={version}"
        new.write.mode("overwrite").parquet(at)
        new = self.spark.read.schema("doc long, site string, keys array<binary>").parquet(at)
        lines, sites = delta(new)
        touched = {r["b"] for r in sites.select(_bucket().alias("b")).distinct().collect()}  # at most BUCKETS rows
        before = self.frequent(touched)
        lines = lines.unionByName(self._read("counts", touched)).groupBy("site", "key").agg(F.sum("n").alias("n")) if self.version else lines
        sites = sites.unionByName(self.sites(touched)).groupBy("site").agg(F.sum("docs").alias("docs")) if self.version else sites
        for what, counted in (("counts", lines), ("sites", sites)):
            counted.withColumn("bucket", _bucket()).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{what}/version={version}")
        self.holds |= {b: version for b in touched}
        self.version = version
        self.spark.createDataFrame([(version, self.holds)], "version int, holds map<int,int>").coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")
        after = self.frequent(touched)
        if version == 1:
            return after.select("site", "key", F.lit(True).alias("frequent"))
        return (
            before.withColumn("was", F.lit(1))
            .join(after.withColumn("now", F.lit(1)), ["site", "key"], "full_outer")
            .where("was is null or now is null")
            .select("site", "key", F.col("now").isNotNull().alias("frequent"))
        )

    def frequent(self, buckets: set[int] | None = None) -> DataFrame:
        """(site, key, n, docs) of the lines over the threshold now.

        At most docs x lines-per-document / (min_share x docs) lines a site, whatever
        the number of its documents; Spark picks the join by their measured size.
        """
        at_least = self._read("counts", buckets).where(F.col("n") >= self.min_docs)
        return at_least.join(self.sites(buckets), "site").where(F.col("n") >= F.col("docs") * F.lit(self.min_share))


def count_lines(docs: DataFrame, doc_id: str, text: str, url: str, path: str | None = None, **limits) -> tuple[LineCounts, DataFrame]:
    """The counts kept at `path` with a table of documents merged, and the lines that crossed."""
    counts = LineCounts(docs.sparkSession, path, **limits)
    return counts, counts.merge(_documents(docs, doc_id, text, url))


def frequent_lines(docs: DataFrame, doc_id: str, text: str, url: str, path: str | None = None, **limits) -> DataFrame:
    """(doc, site, line_no) of every line over its site's threshold, in all documents merged so far."""
    counts, _ = count_lines(docs, doc_id, text, url, path, **limits)
    lines = counts.lines().select("doc", "site", F.posexplode("keys").alias("at", "key")).where("key is not null")
    return lines.join(counts.frequent().select("site", "key"), ["site", "key"], "left_semi").select("doc", "site", (F.col("at") + 1).alias("line_no"))


def without_lines(docs: DataFrame, doc_id: str, text: str, url: str, crossed: DataFrame, counts: LineCounts | None = None) -> DataFrame:
    """(doc, cleaned): rebuilds only the documents that hold a line of `crossed` (site, key, frequent).

    A document is rebuilt without all lines that are frequent now: those of the
    kept counts, or the newly frequent ones where none are given.  A line that fell
    below the threshold again (frequent = false) selects its documents too, but is
    kept in them.
    """
    own = _documents(docs, doc_id, text, url)
    keys = F.transform(F.split("text", "\n"), lambda x: line_key(line_content(x)))
    now = counts.frequent().select("site", "key") if counts else crossed.where("frequent").select("site", "key")
    gone = now.groupBy("site").agg(F.collect_set("key").alias("gone"))
    per_site = crossed.groupBy("site").agg(F.collect_set("key").alias("crossed")).join(gone, "site", "left")
    hit = own.join(per_site, "site").where(F.arrays_overlap(keys, "crossed"))
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.coalesce(F.array_contains("gone", line_key(line_content(x))), F.lit(False)))
    return hit.select("doc", F.array_join(kept, "\n").alias("cleaned"))
