"""Harvest, gate and record: the spine from fetched pages to field records.

A text's comparison form is made once, where the text is read; labels are harvested
and gated in the same projection, so no text is joined to its own claims again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserix.functions.text import norm, normalize
from tesserix.operators import gate as g
from tesserix.operators import region
from tesserix.operators.labels import anchor_value, degree_sentence, harvest_fields, language_from_name
from tesserix.operators.resolve import address_key, candidate_documents, document_plan, every_cell, first_by_rank
from tesserix.sources.manifest import cacheable, route_of

#: Ranks of the rules: a configured anchor, the labels, what the name says, a sentence that names the programme.
ANCHOR, LABEL, NAME, SENTENCE = 1, 2, 3, 4


def harvested(texts: DataFrame, patterns: dict[str, tuple[tuple[str, str], ...]] | None = None) -> DataFrame:
    """(ref, field, value, segments, method, tier) of all fields over (ref, text), in one pass."""
    return harvest_fields(texts, patterns)


def field_records(texts: DataFrame, patterns: dict[str, tuple[tuple[str, str], ...]] | None = None) -> DataFrame:
    """Gated emissions: status and missing tokens; the value is null unless it passed."""
    texts = texts.where("ref is not null and text is not null").withColumn("__form", normalize(F.col("text")))
    gated = g.judged(harvest_fields(texts, patterns, keep=("__form",)), "__form").drop("__form")
    return gated.withColumn("value", F.when(F.col("status") == g.PASS, F.col("value")))


def gate_failures(records: DataFrame) -> DataFrame:
    return records.where(~F.col("status").isin(g.PASS, g.NULL_OK))


def best_values(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """The passed value of the best placed candidate document per (program_id, field); candidates carry ref and place."""
    passed = candidates.join(records.where(F.col("status") == g.PASS), ["ref", "field"])
    return first_by_rank([passed.select("program_id", "field", F.col("place").alias("rank"), "value", "method")], ["program_id", "field"])


def resolve_documents(programs: DataFrame, fetches: DataFrame, renderings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, failed) pages of the plan: each address with its newest usable fetch and the rendering of that body.

    Fetches are (url, retrieved_at, status, sha256, canonical_sha256, error,
    content_type), renderings (sha256, renderer_id, text) with the digest of the
    canonical text.  A page's ref is its body's digest.  What has no
    usable fetch, no renderer for its route or no rendering comes out as failed with
    the reason, never as an empty text.
    """
    usable = fetches.where(cacheable(F.col("status"), F.col("sha256"), F.col("error"))).withColumn("address", address_key(F.col("url")))
    newest = usable.groupBy("address").agg(F.max(F.struct("retrieved_at", "sha256", "canonical_sha256", "content_type")).alias("f"))
    shown = renderings.where("sha256 is not null and text is not null").groupBy("sha256").agg(F.max(F.struct("renderer_id", "text")).alias("r"))
    kind = route_of(F.col("f.content_type"), F.lit(None).cast("binary"))
    rows = document_plan(programs).join(newest, "address", "left").withColumns({"kind": kind, "sha256": F.col("f.canonical_sha256")}).join(shown, "sha256", "left")
    reason = F.when(F.col("f").isNull(), "no usable fetch").when(F.col("kind").isNull(), "no renderer").when(F.col("r").isNull(), "no rendering")
    rows = rows.withColumn("reason", reason)
    resolved = rows.where("reason is null").select("address", F.concat(F.lit("sha256:"), "f.sha256").alias("ref"), "kind", "r.renderer_id", "r.text")
    return resolved, rows.where("reason is not null").select("address", "url", "reason")


def _claims(rows: DataFrame, rank: int, field: str, found, method: str) -> DataFrame:
    """Claims of a rule over (program_id, field, ref, place, __form, ...) from a struct(value, snippet)."""
    rows = rows.where(F.col("field") == field).withColumn("__found", found).where("__found is not null")
    return rows.select("program_id", "field", "ref", "__form", F.lit(rank).alias("rule"), "place", F.col("__found.value").alias("value"), F.array("__found.snippet").alias("segments"), F.lit(method).alias("method"))


def emissions(programs: DataFrame, fields: list[str], documents: DataFrame, patterns: dict | None = None, anchors: DataFrame | None = None, scoped: bool = True) -> DataFrame:
    """Every rule's claim for every programme and field, gated: (program_id, field, ref, rule, place, value, segments, method, status, missing).

    Documents are (address, ref, text), one per address.  A page that several
    programmes share is read only in a programme's own spans, in their order,
    where `scoped` is asked.  Anchors are (program_id, field, address, pattern,
    names_program); the value is the pattern's group.
    """
    texts = documents.withColumn("__form", normalize(F.col("text")))
    near = candidate_documents(programs, fields, documents.withColumn("artifact_id", F.col("ref")))
    read = near.select("program_id", "field", "address", "place")
    # Labels are harvested once per document, or per programme's span of a shared page.
    own = programs.select("program_id", "name", address_key(F.col("page")).alias("address"))
    sharing = own.groupBy("address").agg(F.array_sort(F.collect_set("name")).alias("names"), F.count("*").alias("sharers")).where("sharers > 1")
    open_pages = texts.join(sharing, "address", "left_anti") if scoped else texts
    hits = harvest_fields(open_pages, patterns, keep=("address", "__form"))
    labelled = read.join(hits, ["address", "field"]).select("program_id", "field", "ref", "__form", F.lit(LABEL).alias("rule"), "place", "value", "segments", "method")
    if scoped:
        spans = own.join(sharing, "address").join(texts, "address").withColumn("spans", region.spans("text", "name", "names"))
        parts = spans.select("program_id", "address", "ref", "__form", F.posexplode(region.scoped(F.col("text"), F.col("spans"))).alias("span", "part"))
        found = harvest_fields(parts.withColumnRenamed("part", "text"), patterns, keep=("program_id", "address", "span", "__form"))
        first = found.groupBy("program_id", "address", "field").agg(F.min_by(F.struct("ref", "__form", "value", "segments", "method"), "span").alias("h"))
        here = read.join(first, ["program_id", "address", "field"])
        labelled = labelled.unionByName(here.select("program_id", "field", "h.ref", "h.__form", F.lit(LABEL).alias("rule"), "place", "h.value", "h.segments", "h.method"))
    # What the name says needs the programme's own page only.
    pages = read.where(F.col("field").isin("language", "degree")).join(own, ["program_id", "address"]).join(texts, "address")
    every = labelled.unionByName(_claims(pages, NAME, "language", language_from_name(F.col("name"), F.col("text")), "name"))
    every = every.unionByName(_claims(pages, SENTENCE, "degree", degree_sentence(F.col("name"), norm(F.col("text"))), "sentence"))
    if anchors is not None:
        named = anchors.join(programs.select("program_id", "name"), "program_id").join(texts, "address")
        said = F.lower(norm(F.col("text")))
        names = F.contains(said, F.lower("name")) | F.contains(said, F.lower(F.regexp_replace("name", r"\s*\([^()]*\)\s*$", "")))
        value = anchor_value(norm(F.col("text")), F.col("pattern"), ~F.coalesce("names_program", F.lit(False)) | names)
        rows = named.withColumn("value", value).where("value is not null")
        every = every.unionByName(rows.select("program_id", "field", "ref", "__form", F.lit(ANCHOR).alias("rule"), F.lit(0).alias("place"), "value", F.array("value").alias("segments"), F.lit("anchor").alias("method")))
    return g.judged(every, "__form").drop("__form")


def resolve_cells(programs: DataFrame, fields: list[str], documents: DataFrame, **how) -> DataFrame:
    """(program_id, field, value, method, rule) of every programme and field: the first passed emission by rule and place; empty cells are left to a second reading."""
    passed = emissions(programs, fields, documents, **how).where(F.col("status") == g.PASS)
    best = passed.groupBy("program_id", "field").agg(F.min(F.struct("rule", "place", "value", "method")).alias("w"))
    return every_cell(programs, fields, best.select("program_id", "field", "w.value", "w.method", "w.rule"))


def verify_pages(pages: DataFrame, patterns: dict | None = None) -> DataFrame:
    """(ref, field, value, segments, method) that passed the gate on proposed pages (ref, name, text): labels, and the name's language where no label gives one."""
    texts = pages.withColumn("__form", normalize(F.col("text")))
    hits = harvest_fields(texts, patterns, keep=("__form",)).select("ref", "__form", "field", "value", "segments", "method")
    said = language_from_name(F.col("name"), F.col("text"))
    named = texts.withColumn("__found", said).where("__found is not null").select("ref", "__form", F.lit("language").alias("field"), F.col("__found.value").alias("value"), F.array("__found.snippet").alias("segments"), F.lit("name").alias("method"))
    named = named.join(hits.where("field = 'language'").select("ref"), "ref", "left_anti")
    return g.judged(hits.unionByName(named), "__form").where(F.col("status") == g.PASS).select("ref", "field", "value", "segments", "method")


def proposal_totals(verified: DataFrame, costs: DataFrame) -> DataFrame:
    """(ref, passed_fields, cost, adapter_errors) of proposals: verified fields, and sums over the calls (ref, cost, error) made for them."""
    fields = verified.groupBy("ref").agg(F.count_distinct("field").alias("passed_fields"))
    spent = costs.groupBy("ref").agg(F.sum(F.coalesce("cost", F.lit(0.0))).alias("cost"), F.count("error").alias("adapter_errors"))
    return spent.join(fields, "ref", "full_outer").select("ref", F.coalesce("passed_fields", F.lit(0)).alias("passed_fields"), F.coalesce("cost", F.lit(0.0)).alias("cost"), F.coalesce("adapter_errors", F.lit(0)).alias("adapter_errors"))
