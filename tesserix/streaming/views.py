"""Streaming views over the append-only logs; additions to the batch operators, same results when a stream has drained."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tesserix.sources.manifest import RECORD, cookie_key


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New records of a folder of JSON-lines logs."""
    return spark.readStream.schema(RECORD).option("mode", "DROPMALFORMED").json(folder)


def latest_view(records: DataFrame, late: str = "30 days") -> DataFrame:
    """The newest fetch of each (url, cookies) by its stated time, and how many there were, in update mode; later than `late` is left out."""
    timed = records.withColumn("at", F.to_timestamp("retrieved_at")).withWatermark("at", late)
    key = timed.withColumn("cookie_key", cookie_key(F.col("cookies")))
    return key.groupBy("url", "cookie_key").agg(F.max(F.struct("retrieved_at", "status", "sha256", "error")).alias("last"), F.count("*").alias("fetches"))


def failures_per_day(records: DataFrame, late: str = "1 day") -> DataFrame:
    """Fetches and failures per day of their stated time, closed once the watermark has passed."""
    timed = records.withColumn("at", F.to_timestamp("retrieved_at")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 day")).agg(F.count("*").alias("fetches"), F.count_if(F.col("error").isNotNull() | (F.col("status") >= 500)).alias("failures"))


def drain(view: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes everything that is there now and stops; a restart goes on from the checkpoint."""
    if mode == "append":
        return view.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def replace(batch: DataFrame, n: int) -> None:
        batch.write.mode("append").parquet(f"{path}/batch={n}")

    return view.writeStream.outputMode(mode).foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
