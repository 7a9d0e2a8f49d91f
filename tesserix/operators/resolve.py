"""Which documents a programme's field may be read from, and which of several emissions holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserix.functions.urls import path_of, site_of

#: Address columns of a programme in order of preference, and the fields they may serve (None: all).
ROUTES = (("page", None), ("extra_pages", None), ("adm_page", ("admission",)), ("tuition_page", ("tuition",)))


def address_key(url: Column) -> Column:
    """One text per page, whatever the spelling of its address; null without a host."""
    return F.concat(site_of(url), path_of(url))


def program_addresses(programs: DataFrame) -> DataFrame:
    """(program_id, route, place, url): every address of every programme in order of preference."""
    parts = []
    for k, (name, _) in enumerate(ROUTES):
        one = F.col(name) if dict(programs.dtypes)[name].startswith("array") else F.array(name)
        parts.append(programs.select("program_id", F.lit(name).alias("route"), F.posexplode(one).alias("n", "url")).select("program_id", "route", (F.lit(k * 1_000_000) + F.col("n")).alias("place"), "url"))
    return reduce(DataFrame.unionByName, parts).where("url is not null")


def document_plan(programs: DataFrame) -> DataFrame:
    """(address, url, route): each page to fetch once; the best route's spelling of its address holds."""
    rows = program_addresses(programs).withColumn("address", address_key(F.col("url"))).where("address is not null")
    best = rows.groupBy("address").agg(F.min(F.struct("place", "url", "route")).alias("b"))
    return best.select("address", "b.url", "b.route")


def latest_artifacts(artifacts: DataFrame) -> DataFrame:
    """(address, artifact_id, text): the newest rendering of each page."""
    rows = artifacts.withColumn("address", address_key(F.col("source_ref"))).where("address is not null and text is not null")
    newest = Window.partitionBy("address").orderBy(F.col("rendered_at").desc_nulls_last(), F.col("artifact_id").desc())
    return rows.withColumn("__n", F.row_number().over(newest)).where("__n = 1").select("address", "artifact_id", "text")


def candidate_documents(programs: DataFrame, fields: list[str], documents: DataFrame) -> DataFrame:
    """(program_id, field, address, artifact_id, place): the pages a field may be read from, each once, at its best place."""
    served = F.lit(None).cast("array<string>")
    for name, only in ROUTES:
        served = F.when(F.col("route") == name, F.array(*map(F.lit, only or fields))).otherwise(served)
    rows = program_addresses(programs).select("program_id", F.explode(F.array_intersect(served, F.array(*map(F.lit, fields)))).alias("field"), address_key(F.col("url")).alias("address"), "place")
    return rows.groupBy("program_id", "field", "address").agg(F.min("place").alias("place")).join(documents.select("address", "artifact_id"), "address").select("program_id", "field", "address", "artifact_id", "place")


def first_by_rank(emissions: list[DataFrame], key: list[str]) -> DataFrame:
    """The emission of least rank per key; each rule's rows carry (key..., rank, value, method) and ties go to the lesser value."""
    every = reduce(DataFrame.unionByName, emissions).where("value is not null")
    return every.groupBy(*key).agg(F.min(F.struct("rank", "value", "method")).alias("w")).select(*key, "w.rank", "w.value", "w.method")


def every_cell(programs: DataFrame, fields: list[str], winners: DataFrame) -> DataFrame:
    """(program_id, field, ...winner) for all programmes and fields; cells without a winner are null."""
    cells = programs.select("program_id").distinct().select("program_id", F.explode(F.array(*map(F.lit, fields))).alias("field"))
    return cells.join(winners, ["program_id", "field"], "left")


def unconfigured(candidates: DataFrame, programs: DataFrame) -> DataFrame:
    """Candidate pages (url, ...) whose address no programme has, however it is written."""
    known = program_addresses(programs).select(address_key(F.col("url")).alias("address")).where("address is not null").distinct()
    return candidates.withColumn("address", address_key(F.col("url"))).join(known, "address", "left_anti")


def worksheet_groups(programs: DataFrame) -> DataFrame:
    """(address, programs): names of the programmes of each page in order of their ids."""
    rows = programs.select(address_key(F.col("page")).alias("address"), "program_id", "name").where("address is not null")
    return rows.groupBy("address").agg(F.transform(F.array_sort(F.collect_list(F.struct("program_id", "name"))), lambda x: x["name"]).alias("names"))
