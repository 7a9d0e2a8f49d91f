"""python -m tesserix QUERY TABLES OUT: runs a registered query over a folder of tables and writes Parquet."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tesserix.queries import core
from tesserix.session import ship


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tesserix", description=__doc__)
    parser.add_argument("query", choices=sorted(core.queries()))
    parser.add_argument("tables")
    parser.add_argument("out")
    given = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tesserix {given.query}").getOrCreate()
    ship(spark)
    core.queries()[given.query](spark, given.tables).write.mode("errorifexists").parquet(given.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
