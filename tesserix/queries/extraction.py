"""Queries of the extraction operators over the driver's tables, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserix.functions import text as t
from tesserix.functions.quantity import key_id, key_name
from tesserix.functions.urls import path_of, site_of
from tesserix.operators import drift, gate, grade, grid, labels, ledger, region, resolve, tail
from tesserix.operators.snapshot_changes import year_key
from tesserix.plans import extraction
from tesserix.session import table
from tesserix.sources import manifest, pages

FIELDS = ["degree", "duration", "language", "tuition", "admission"]
#: Labels of these pages' fact lines, in order of preference.
FACT_LABELS = {
    "degree": (("bg-degree", r"Степен: ([^;.]+)"), ("en-degree", r"Degree: ([^;.]+)")),
    "duration": (("bg-duration", r"Срок на обучение: ([^;]+?)[.;]"), ("en-duration", r"Duration: ([^;]+?)[.;]")),
    "tuition": (("bg-fee", r"Такса: ([^;]+?)(?:;|\.?$|\. )"), ("en-fee", r"Tuition: ([^;]+?)(?:;|\.?$|\. )")),
}


def _artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "artifacts")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return _artifacts(spark, sf).select(F.concat(F.lit("artifact:"), F.col("artifact_id")).alias("ref"), "text")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Fact labels harvested from every artifact, gated against it, counted by field and status."""
    return extraction.field_records(_texts(spark, sf), FACT_LABELS).groupBy("field", "status").agg(F.count("*").alias("n"))


def norm_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.norm(F.col("text")).alias("normed"))


def normalize_policy(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.normalize(F.col("text")).alias("form"))


def token_index(spark, sf):
    form = table(spark, sf, "heldout_items").select("item_id", t.normalize(F.col("text")).alias("form"))
    return form.select("item_id", F.array_join(F.array_sort(t.number_tokens(F.col("form"))), " ").alias("numbers"), F.array_join(F.array_sort(t.word_tokens(F.col("form"))), " ").alias("words"))


def snippet_window(spark, sf):
    docs = table(spark, sf, "documents").where("text is not null")
    at = F.length(F.regexp_extract("text", r"(?s)^([^0-9]*)[0-9]", 1))
    return docs.where(F.col("text").rlike("[0-9]")).select("doc_id", t.snippet_around(F.col("text"), at, at + 1, 40).alias("snippet"))


def content_address(spark, sf):
    docs = table(spark, sf, "documents").where("text is not null")
    return docs.groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))


def distinct_bodies(spark, sf):
    return manifest.distinct_bodies(_artifacts(spark, sf).where("text is not null").select(F.col("text").cast("binary").alias("content"))).select("sha256")


def _manifest(spark, sf):
    rows = table(spark, sf, "snapshots")
    order = F.struct("retrieved_at", F.coalesce("sha256", F.lit("")).alias("s"), F.coalesce("error", F.lit("")).alias("e"), F.coalesce("canonical_sha256", F.lit("")).alias("c"))
    return rows.withColumn("seq", order)


def latest_fetches(spark, sf):
    return manifest.latest_fetches(_manifest(spark, sf)).select("url", "cookie_key", "retrieved_at", "status", "sha256").select("url", "retrieved_at", "status", "sha256")


def latest_then_filter(spark, sf):
    return manifest.lookup(_manifest(spark, sf)).select("url", "retrieved_at", "status", "sha256")


def replay_misses(spark, sf):
    """Pages of the plan that no usable newest fetch serves, by their address as written."""
    wanted = resolve.document_plan(table(spark, sf, "programs")).select("url", F.lit(None).cast("map<string,string>").alias("cookies"))
    return manifest.replay(wanted, _manifest(spark, sf))[1].select("url")


def routes(spark, sf):
    rows = table(spark, sf, "snapshots")
    kind = manifest.route_of(F.col("content_type"), F.lit(None).cast("binary"))
    return rows.groupBy(F.coalesce(kind, F.lit("none")).alias("route")).agg(F.count("*").alias("n"))


def retries(spark, sf):
    rows = table(spark, sf, "snapshots")
    return rows.groupBy("status").agg(F.count_if(manifest.retry_schedule(F.col("status"), F.col("error"))).alias("retried"), F.count_if(manifest.cacheable(F.col("status"), F.col("sha256"), F.col("error"))).alias("usable"))


def label_harvest(spark, sf):
    hits = extraction.harvested(_texts(spark, sf).where("text is not null"), FACT_LABELS)
    return hits.select("ref", "field", "value", "method")


def label_library(spark, sf):
    """The fixed label library over all artifacts."""
    return extraction.harvested(_texts(spark, sf).where("text is not null")).select("ref", "field", "value", "method")


def suppress_labels(spark, sf):
    """Label hits of the pages' programmes without the fields that a verdict calls wrong."""
    hits = extraction.harvested(_texts(spark, sf).where("text is not null"), FACT_LABELS)
    refs = resolve.latest_artifacts(_artifacts(spark, sf)).select("address", F.concat(F.lit("artifact:"), F.col("artifact_id")).alias("ref"))
    own = table(spark, sf, "programs").select("program_id", resolve.address_key(F.col("page")).alias("address")).join(refs, "address")
    wrong = table(spark, sf, "verdicts").where("lower(trim(verdict)) = 'wrong'").select(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field"))
    suppressed = wrong.select("program_id", "field", F.explode(F.array(*[F.lit(label) for p in FACT_LABELS.values() for label, _ in p])).alias("label"))
    return labels.without_suppressed(hits.join(own, "ref"), suppressed).select("program_id", "field", "ref", "value", "method")


def _claims(spark, sf):
    docs = resolve.latest_artifacts(_artifacts(spark, sf)).select("address", F.concat(F.lit("artifact:"), F.col("artifact_id")).alias("ref"), "text")
    key = table(spark, sf, "answer_key").select("entry_id", resolve.address_key(F.col("source_url")).alias("address"), F.col("expected_value").alias("value"), F.array_compact(F.array("snippet")).alias("segments"))
    claims = key.join(docs.select("address", "ref"), "address").select("entry_id", "ref", "value", "segments")
    return claims, docs.select("ref", "text")


def gate_verdicts(spark, sf):
    claims, texts = _claims(spark, sf)
    return gate.gate(claims, texts).select("entry_id", "status", F.array_join("missing", " ").alias("missing"))


def gate_status_counts(spark, sf):
    claims, texts = _claims(spark, sf)
    return gate.status_counts(gate.gate(claims, texts))


def draft_tiers(spark, sf):
    rows = table(spark, sf, "answer_key").where("expected_value is not null").select("entry_id", t.normalize(F.col("expected_value")).alias("v"), t.normalize(F.col("snippet")).alias("s"))
    return rows.select("entry_id", gate.draft_tier(F.col("v"), F.col("s")).alias("tier"))


def values_match(spark, sf):
    key = table(spark, sf, "answer_key").select("entry_id", key_id(F.col("program_id")).alias("p"), key_id(F.col("field")).alias("f"), t.normalize(F.col("expected_value")).alias("e"))
    said = table(spark, sf, "verdicts").select("verdict_id", key_id(F.col("program_id")).alias("p"), key_id(F.col("field")).alias("f"), t.normalize(F.col("shipped_value")).alias("s"))
    return key.join(said, ["p", "f"]).where(gate.values_match(F.col("e"), F.col("s"))).select("entry_id", "verdict_id")


def _part_cells(spark, sf):
    """Each brand's parts as a table with a stacked header: name; price in two currencies; type."""
    parts = table(spark, sf, "part")
    row = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) + 1
    body = parts.select("p_brand", row.alias("r"), F.array(F.format_string("%.2f", F.col("p_retailprice") * 1.95583), "p_name", F.format_string("%.2f", "p_retailprice"), "p_type").alias("cells"))
    brands = parts.select("p_brand").distinct()
    head = brands.select("p_brand", F.lit(0).alias("r"), F.array(*map(F.lit, ("Price", "Part", "Price", "Type"))).alias("cells"))
    under = brands.select("p_brand", F.lit(1).alias("r"), F.array(*map(F.lit, ("BGN", "", "EUR", ""))).alias("cells"))
    rows = head.unionByName(under).unionByName(body)
    return rows.select(F.col("p_brand").alias("ref"), F.lit(0).alias("t"), "r", F.posexplode("cells").alias("c", "cell"))


def table_cells(spark, sf):
    """Cells of the tab-separated documents, counted per document."""
    docs = table(spark, sf, "documents").where(F.col("text").contains("\t")).select(F.col("doc_id").alias("ref"), "text")
    return grid.cells_of(docs).groupBy(F.col("ref").alias("doc_id")).agg(F.count("*").alias("cells"), F.max("r").alias("last_row"), F.max("c").alias("last_column"))


def grid_text(spark, sf):
    return grid.grid_text(_part_cells(spark, sf))


def header_zones(spark, sf):
    return grid.header_zone(_part_cells(spark, sf), ["price", "eur"]).select("ref", "first", "last")


def fee_row_join(spark, sf):
    cells = _part_cells(spark, sf)
    types = table(spark, sf, "part").groupBy("p_brand").agg(F.max("p_type").alias("alias")).select(F.col("p_brand").alias("program_id"), F.col("p_brand").alias("ref"), "alias")
    return grid.fee_rows(cells, types, "type", ["price", "eur"]).select("program_id", "r", "value")


def sectioned_join(spark, sf):
    """Each user's events as lines; signups and errors open sections; the first purchase after them is read."""
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    lines = table(spark, sf, "events").select(F.col("user_id").alias("ref"), F.lit(0).alias("t"), order.alias("r"), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("line"))
    users = lines.select(F.col("ref").alias("program_id"), "ref", F.lit("^purchase ").alias("alias_pattern")).distinct()
    found = grid.sectioned_fees(lines, [("A", "signup", False), ("B", "error", True)], users, r"^purchase (\d+)", "BGN")
    return found.select("ref", "value", "tracks", F.array_join("segments", "|").alias("segments"))


def region_spans(spark, sf):
    """Spans of every page that belong to each of the programmes configured for it."""
    docs = resolve.latest_artifacts(_artifacts(spark, sf))
    own = table(spark, sf, "programs").select("program_id", "name", resolve.address_key(F.col("page")).alias("address"))
    sharing = own.groupBy("address").agg(F.array_sort(F.collect_set("name")).alias("siblings"))
    rows = own.join(sharing, "address").join(docs, "address")
    return rows.select("program_id", "artifact_id", F.explode(region.spans("text", "name", "siblings")).alias("s")).select("program_id", "artifact_id", "s.start", "s.end")


def names_program(spark, sf):
    docs = resolve.latest_artifacts(_artifacts(spark, sf))
    own = table(spark, sf, "programs").select("program_id", "name", resolve.address_key(F.col("page")).alias("address"))
    return own.join(docs, "address").where(t.names(F.col("text"), F.col("name"))).select("program_id", "artifact_id")


def language_from_name(spark, sf):
    said = table(spark, sf, "programs").select("program_id", labels.language_from_name(F.col("name"), F.lit("")).alias("x")).where("x is not null")
    return said.select("program_id", F.col("x.value").alias("value"))


def document_plan(spark, sf):
    return resolve.document_plan(table(spark, sf, "programs")).select("address", "route")


def candidate_documents(spark, sf):
    docs = resolve.latest_artifacts(_artifacts(spark, sf))
    return resolve.candidate_documents(table(spark, sf, "programs"), FIELDS, docs).select("program_id", "field", "artifact_id")


def latest_artifacts(spark, sf):
    return resolve.latest_artifacts(_artifacts(spark, sf)).select("address", "artifact_id")


def resolve_priority(spark, sf):
    """Per programme and field: a shipped value judged ok, else the frozen key's, else the ledger's; all cells come out."""
    key = ["program_id", "field"]

    def rule(df, rank, value, method):
        named = df.select(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field"), F.col(value).alias("value"))
        return named.select(*key, F.lit(rank).alias("rank"), "value", F.lit(method).alias("method"))

    rules = [
        rule(table(spark, sf, "verdicts").where("lower(trim(verdict)) = 'ok'"), 1, "shipped_value", "verdict"),
        rule(table(spark, sf, "answer_key"), 2, "expected_value", "key"),
        rule(table(spark, sf, "ledger"), 3, "value", "ledger"),
    ]
    winners = resolve.first_by_rank(rules, key)
    return resolve.every_cell(table(spark, sf, "programs"), FIELDS, winners).select("program_id", "field", "value", "method")


def worksheet_groups(spark, sf):
    return resolve.worksheet_groups(table(spark, sf, "programs")).select("address", F.array_join("names", "; ").alias("names"))


def _last_runs(spark, sf):
    runs = table(spark, sf, "ledger").groupBy("uni_id").agg(F.max("run_id").alias("last"), F.min("run_id").alias("first"))
    return runs


def _run_rows(spark, sf, which):
    runs = _last_runs(spark, sf).select(F.col(which).alias("run_id"))
    rows = table(spark, sf, "ledger").join(runs, "run_id").select(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field"), year_key(F.col("academic_year")).alias("academic_year"), "ledger_seq", "value")
    return rows.groupBy("program_id", "field", "academic_year").agg(F.max_by("value", "ledger_seq").alias("value"))


def ledger_latest(spark, sf):
    first = table(spark, sf, "ledger").agg(F.max("run_id")).first()[0]
    return ledger.run_values(table(spark, sf, "ledger"), first)


def ledger_diff(spark, sf):
    return ledger.diff_runs(_run_rows(spark, sf, "first"), _run_rows(spark, sf, "last")).select("program_id", "field", "academic_year", "change")


def ledger_diff_counts(spark, sf):
    return ledger.change_counts(ledger.diff_runs(_run_rows(spark, sf, "first"), _run_rows(spark, sf, "last")))


def set_change(spark, sf):
    return ledger.set_changes(_run_rows(spark, sf, "first"), _run_rows(spark, sf, "last"), "program_id")


def verdict_upsert(spark, sf):
    """The key's cells with those a verdict says replaced by it, counted by where they come from."""
    old = table(spark, sf, "answer_key").select(key_id(F.col("program_id")).alias("program_id"), key_name(F.col("field")).alias("field"), F.lit("key").alias("origin"))
    new = table(spark, sf, "verdicts").select(key_id(F.col("program_id")).alias("program_id"), key_name(F.col("field")).alias("field"), F.lit("verdict").alias("origin"))
    return ledger.upsert(old, new, ["program_id", "field"]).groupBy("origin").agg(F.count("*").alias("n"))


def academic_year(spark, sf):
    return table(spark, sf, "orders").groupBy(ledger.expected_year(F.col("o_orderdate")).alias("academic_year")).agg(F.count("*").alias("orders"))


def stated_year(spark, sf):
    rows = table(spark, sf, "answer_key").select("entry_id", ledger.academic_year_in(F.col("expected_value"), F.array("snippet")).alias("academic_year"))
    return rows.where("academic_year is not null")


def _key_cells(spark, sf):
    return table(spark, sf, "answer_key").select(key_id(F.col("program_id")).alias("program_id"), F.col("expected_value").alias("value"))


def coverage(spark, sf):
    return ledger.coverage(_key_cells(spark, sf), table(spark, sf, "programs"))


def coverage_totals(spark, sf):
    return ledger.coverage_totals(ledger.coverage(_key_cells(spark, sf), table(spark, sf, "programs")))


def _graded(spark, sf):
    key = table(spark, sf, "answer_key").where(key_id(F.col("field")).isin(*FIELDS))
    cells = key.groupBy(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field")).agg(F.max_by("expected_value", F.struct("labelled_at", "entry_id")).alias("expected"))
    last = table(spark, sf, "ledger").join(_last_runs(spark, sf).select(F.col("last").alias("run_id")), "run_id")
    values = last.groupBy(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field")).agg(F.max_by("value", "ledger_seq").alias("shipped"))
    report = values.withColumn("status", F.when(F.col("shipped").isNull(), gate.NULL_OK).otherwise(gate.PASS))
    verdicts = table(spark, sf, "verdicts").select(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field"), "verdict", "shipped_value")
    same = lambda e, s: F.coalesce(F.lower(t.norm(e)) == F.lower(t.norm(s)), F.lit(False))
    return grade.grade(cells, report, verdicts, same)


def grade_matrix(spark, sf):
    return _graded(spark, sf)[0].groupBy("category").agg(F.count("*").alias("n"))


def grade_orphans(spark, sf):
    return _graded(spark, sf)[1].groupBy("side").agg(F.count("*").alias("n"))


def grade_rates(spark, sf):
    return grade.rates(_graded(spark, sf)[0])


def binomial_bounds(spark, sf):
    """Upper bound of the share of wrong verdicts per field."""
    rows = table(spark, sf, "verdicts").groupBy(key_id(F.col("field")).alias("field")).agg(F.count("*").cast("int").alias("n"), F.count_if(F.lower(F.trim("verdict")) == "wrong").cast("int").alias("k"))
    return rows.select("field", "n", "k", F.round(grade.binomial_upper_bound("n", "k"), 9).alias("upper"))


def visit_pairs(spark, sf):
    return drift.visit_pairs(drift.visits(table(spark, sf, "snapshots"))).groupBy("kind").agg(F.count("*").alias("n"))


def churn(spark, sf):
    return drift.churn(drift.visits(table(spark, sf, "snapshots")))


def version_drift(spark, sf):
    """Pins made of orders against a listing made of parts."""
    pins = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.concat(F.lit("https://x.example/doc?code=c"), F.col("o_orderkey") % 3000, F.lit("&version="), F.col("o_custkey") % 7).alias("url"))
    listing = table(spark, sf, "part").select(F.concat(F.lit("c"), F.col("p_partkey")).alias("code"), (F.col("p_size") % 7).cast("string").alias("version"))
    return drift.version_drift(pins, listing).select("path", "pinned", "current", "state")


def discover_links(spark, sf):
    docs = table(spark, sf, "documents").where("text like '<div%'").select("doc_id", F.explode(pages.discover_links("text", "url")).alias("link"))
    return docs.select("doc_id", F.col("link.url").alias("link"))


def html_canonical(spark, sf):
    docs = table(spark, sf, "documents").where("text like '<div%'").select("doc_id", pages.render_html("text").alias("page"))
    return docs.select("doc_id", "page.text", "page.mode")


def prose_composed(spark, sf):
    docs = _artifacts(spark, sf).where("renderer_id like 'pdftotext%' and text is not null")
    return docs.select("artifact_id", pages.compose_prose(F.col("text")).alias("composed"))


def site_hosts(spark, sf):
    rows = _artifacts(spark, sf)
    return rows.groupBy(site_of(F.col("source_ref")).alias("site")).agg(F.count("*").alias("artifacts"), F.count_distinct(path_of(F.col("source_ref"))).alias("paths"))


def event_means(spark, sf):
    per = table(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    return per.select("event_type", F.round("mean", 6).alias("mean"), "n")


def second_reading(spark, sf):
    """Cells the ledger leaves empty, read again by a canned adapter: it copies the page's first line, without evidence until it is asked again."""
    cells = resolve.candidate_documents(table(spark, sf, "programs"), FIELDS, resolve.latest_artifacts(_artifacts(spark, sf)))
    filled = table(spark, sf, "ledger").where("value is not null").select(key_id(F.col("program_id")).alias("program_id"), key_id(F.col("field")).alias("field")).distinct()
    texts = _artifacts(spark, sf).select("artifact_id", F.col("artifact_id").cast("string").alias("ref"), "text")
    docs = cells.join(filled, ["program_id", "field"], "left_anti").join(texts, "artifact_id").groupBy("program_id", "field").agg(F.array_sort(F.collect_list(F.struct("ref", "text"))).alias("documents"))

    def make():
        def call(prompt, model, tag):
            head, _, rest = prompt.partition("\n\n[")[2].partition("]\n")
            line = rest.split("\n", 1)[0]
            return {"value": line or None, "segments": [line] if "refused" in prompt else [], "ref": head}

        return call

    def check(answer):
        if answer.get("value") is None:
            return gate.NULL_OK, ""
        return (gate.PASS, "") if answer["segments"] else (gate.CONTAINMENT, "no evidence was copied")

    return tail.read_cells(docs, make, check)


QUERIES = (
    norm_text, normalize_policy, token_index, snippet_window, content_address, distinct_bodies, latest_fetches, latest_then_filter, replay_misses, routes, retries,
    label_harvest, label_library, suppress_labels, gate_verdicts, gate_status_counts, draft_tiers, values_match, table_cells, grid_text, header_zones, fee_row_join,
    sectioned_join, region_spans, names_program, language_from_name, document_plan, candidate_documents, latest_artifacts, resolve_priority, worksheet_groups, ledger_latest,
    ledger_diff, ledger_diff_counts, set_change, verdict_upsert, academic_year, stated_year, coverage, coverage_totals, grade_matrix, grade_orphans, grade_rates,
    binomial_bounds, visit_pairs, churn, version_drift, discover_links, html_canonical, prose_composed, site_hosts, event_means, second_reading, flagship,
)
