"""The append-only fetch log: scan, newest-per-key views, bodies by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.functions.urls import host_of

RECORD = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("cookies", T.MapType(T.StringType(), T.StringType())),
        T.StructField("robots", T.StringType()),
        T.StructField("retrieved_at", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("canonical_sha256", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("renderer_id", T.StringType()),
        T.StructField("renderer_version", T.StringType()),
        T.StructField("recorded_at", T.StringType()),
    ]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines log in order of appending (`seq`); blank, broken and non-object lines are skipped.

    The order is file name, then place in the file; a torn last line is one broken line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    parsed = lines.withColumn("rec", F.from_json("value", RECORD)).where(F.coalesce(F.col("rec.url"), F.col("rec.sha256")).isNotNull())
    return parsed.select("rec.*", F.struct("file", "block", "at").alias("seq"))


def append_records(records: DataFrame, path: str) -> None:
    """Appends records to the log; a job that fails leaves nothing behind."""
    records.select(*[c for c in RECORD.names if c in records.columns]).write.mode("append").json(path)


def cookie_key(cookies: Column) -> Column:
    """One text per set of cookies, whatever their order; null and no cookies are the same."""
    entries = F.array_sort(F.map_entries(F.coalesce(cookies, F.create_map().cast("map<string,string>"))))
    return F.to_json(F.map_from_entries(entries))


def cacheable(status: Column, sha: Column, error: Column) -> Column:
    """A fetch that can be used again: no error, a body, and no server failure; 4xx is evidence."""
    return error.isNull() & (F.coalesce(sha, F.lit("")) != "") & status.isNotNull() & (status < 500)


def latest_fetches(records: DataFrame, seq: str = "seq") -> DataFrame:
    """The last appended fetch of each (url, cookies): position wins, not the time it states."""
    fetches = records.where(F.coalesce(F.col("kind"), F.lit("fetch")) != "canonical").withColumn("cookie_key", cookie_key(F.col("cookies")))
    newest = Window.partitionBy("url", "cookie_key").orderBy(F.col(seq).desc())
    return fetches.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def lookup(records: DataFrame, seq: str = "seq") -> DataFrame:
    """Usable newest fetches: newest first, then usable, so a later failure hides an older good fetch.

    The newest canonical digest recorded for the same body is merged in.
    """
    good = latest_fetches(records, seq).where(cacheable(F.col("status"), F.col("sha256"), F.col("error")))
    canonical = records.where("kind = 'canonical' and sha256 is not null").groupBy("sha256").agg(F.max_by("canonical_sha256", F.col(seq)).alias("__canonical"))
    merged = good.join(canonical, "sha256", "left").withColumn("canonical_sha256", F.coalesce("__canonical", "canonical_sha256")).drop("__canonical")
    return merged.withColumns({"attempts": F.coalesce("attempts", F.lit(1)), "final_url": F.coalesce("final_url", "url"), "from_cache": F.lit(True)})


def read_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """(sha256, content) of a folder of files named by their digest."""
    return spark.read.format("binaryFile").load(folder).select(F.substring_index("path", "/", -1).alias("sha256"), "content")


def distinct_bodies(bodies: DataFrame, content: str = "content") -> DataFrame:
    """One row per distinct content, keyed by its digest."""
    return bodies.withColumn("sha256", F.sha2(F.col(content), 256)).dropDuplicates(["sha256"])


def replay(wanted: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, missing) of wanted (url, cookies): offline fetching, in which a miss is never a null."""
    keyed = wanted.withColumn("cookie_key", cookie_key(F.col("cookies"))).drop("cookies")
    have = lookup(records)
    return keyed.join(have, ["url", "cookie_key"]), keyed.join(have, ["url", "cookie_key"], "left_anti")


def cache_name(url: Column, cookies: Column) -> Column:
    """File name of a cached address: its safe tail and a short digest of the address and its sorted cookies."""
    tail = F.regexp_replace(F.regexp_replace(url, r"^\w+://", ""), r"[^A-Za-z0-9._-]+", "_")
    return F.concat(F.when(F.length(tail) > 60, F.substring(tail, -60, 60)).otherwise(tail), F.lit("."), F.substring(F.sha1(F.concat_ws("|", url, cookie_key(cookies))), 1, 16))


def retry_schedule(status: Column, error: Column) -> Column:
    """True where a fetch deserves its one retry: a server failure or a timeout."""
    return F.coalesce(status >= 500, F.lit(False)) | F.coalesce(F.lower(error).contains("timeout") | F.lower(error).contains("timed out"), F.lit(False))


def is_ok(status: Column, error: Column) -> Column:
    """A fetch that brought a page: no error and a status below 400."""
    return F.coalesce(error.isNull() & (status < 400), F.lit(False))


def bodies_of(fetches: DataFrame, bodies: DataFrame) -> DataFrame:
    """Fetches (sha256, ...) with their content; a digest without a body fails the job, for a miss is never a null."""
    joined = fetches.join(bodies, "sha256", "left")
    return joined.withColumn("content", F.when(F.col("content").isNull(), F.raise_error(F.concat(F.lit("no body for "), F.coalesce("sha256", F.lit("null"))))).otherwise(F.col("content")))


def robots_by_host(fetches: DataFrame) -> DataFrame:
    """(host, fetches, note, permissive): per network location the last recorded note on its robots file; without one everything is permitted."""
    said = fetches.groupBy(host_of(F.col("url")).alias("host")).agg(F.count("*").alias("fetches"), F.max(F.when(F.col("robots").isNotNull(), F.struct("retrieved_at", "robots"))).alias("last"))
    return said.select("host", "fetches", F.col("last.robots").alias("note"), F.coalesce(F.col("last.robots").contains("permissive"), F.lit(True)).alias("permissive"))


def robots_allow(status: Column, error: Column) -> Column:
    """An unreachable or missing robots file permits."""
    return error.isNotNull() | status.isNull() | (status >= 400)


def route_of(content_type: Column, head: Column, hint: Column | None = None) -> Column:
    """html or prose-pdf by hint, declared type or magic bytes; grids are never guessed; null where nothing fits."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    sniffed = F.when(kind.contains("html") | kind.startswith("text/"), F.lit("html")).when(kind.contains("pdf") | (F.coalesce(F.hex(F.substring(head, 1, 5)), F.lit("")) == "255044462D"), F.lit("prose-pdf"))
    return sniffed if hint is None else F.coalesce(hint, sniffed)
