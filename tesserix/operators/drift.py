"""Churn of fetched pages between visits, and pinned versions that a listing has superseded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserix.functions.urls import site_of


def visits(fetches: DataFrame) -> DataFrame:
    """(url, retrieved_at, sha256, canonical): fetches with a body, each repeated row once, with the newest canonical digest known for the body."""
    rows = fetches.where("sha256 is not null").select("url", "retrieved_at", "sha256", "canonical_sha256").distinct()
    newest = rows.where("canonical_sha256 is not null").groupBy("sha256").agg(F.max_by("canonical_sha256", F.struct("retrieved_at", "canonical_sha256")).alias("canonical"))
    return rows.drop("canonical_sha256").distinct().join(newest, "sha256", "left").select("url", "retrieved_at", "sha256", "canonical")


def visit_pairs(seen: DataFrame) -> DataFrame:
    """Consecutive visits of each address: stable, raw (only bytes changed) or ambiguous (the rendered text changed)."""
    order = Window.partitionBy("url").orderBy("retrieved_at", "sha256")
    pairs = seen.withColumns({"sha_before": F.lag("sha256").over(order), "canonical_before": F.lag("canonical").over(order), "n": F.row_number().over(order)}).where("n > 1")
    kind = F.when(~F.col("canonical").eqNullSafe(F.col("canonical_before")), "ambiguous").when(F.col("sha256") != F.col("sha_before"), "raw").otherwise("stable")
    return pairs.select("url", "retrieved_at", kind.alias("kind"))


def churn(seen: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Per site its pages, pairs of visits and their kinds, and whether changed texts exceed the threshold."""
    pairs = visit_pairs(seen).withColumn("site", site_of(F.col("url"))).groupBy("site").agg(F.count("*").alias("pairs"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("raw", "ambiguous")])
    pages = seen.groupBy("url").agg(F.count("*").alias("visits")).groupBy(site_of(F.col("url")).alias("site")).agg(F.count("*").alias("pages"), F.max("visits").alias("most_visits"))
    return pages.join(pairs, "site", "left").select("site", "pages", "most_visits", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("pairs", "raw", "ambiguous")]).withColumn("threatens", F.col("ambiguous") > F.lit(threshold) * F.col("pairs"))


def pin(url: Column) -> Column:
    """struct(code, version) of an address's query; null without a version."""
    version = F.try_parse_url(url, F.lit("QUERY"), F.lit("version"))
    return F.when(version.isNotNull(), F.struct(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit("code"))).alias("code"), F.try_url_decode(version).alias("version")))


def pinned_sources(programs: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """(path, url, code, version) of every pinned address: a programme's page columns, its extra pages, and `others` (path, url) such as anchors and shared sources; the path is where to change it."""
    parts = [] if others is None else [others.select("path", "url")]
    for name in ("page", "lang_page", "adm_page", "tuition_page", "extra_pages"):
        if name in programs.columns:
            one = F.col(name) if dict(programs.dtypes)[name].startswith("array") else F.array(name)
            parts.append(programs.select(F.concat(F.lit("programs."), F.col("program_id"), F.lit(f".{name}")).alias("path"), F.explode(one).alias("url")))
    rows = reduce(DataFrame.unionByName, parts).where("url is not null").withColumn("pin", pin(F.col("url")))
    return rows.where("pin.version is not null").select("path", "url", "pin.code", "pin.version")


def version_drift(pinned: DataFrame, listing: DataFrame) -> DataFrame:
    """Pinned addresses (path, url) whose version the listing (code, version) doesn't have as current: superseded, or unknown."""
    pins = pinned.withColumn("pin", pin(F.col("url"))).where("pin.code is not null").select("path", "url", F.col("pin.code").alias("code"), F.col("pin.version").alias("pinned"))
    current = listing.groupBy("code").agg(F.max("version").alias("current"))
    state = F.when(F.col("current").isNull(), "unknown").when(F.col("current") != F.col("pinned"), "superseded")
    return pins.join(current, "code", "left").withColumn("state", state).where("state is not null")
