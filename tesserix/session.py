"""Session helpers: the shared folder for cut lineage, and table reading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    The cluster names it in spark.checkpoint.dir; only where that is unset, as in
    tests on one machine, a temporary folder is set.
    """
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="tesserix-")
        spark.conf.set(_KEY, found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tesserix/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Writes df to a table in the shared folder and reads it back: lineage is cut, the copy survives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of the session, once."""
    import os
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_tesserix_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tesserix-"), "tesserix_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._tesserix_shipped = True
