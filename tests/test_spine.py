"""The spine and what runs are held against: defined results on small fixtures."""


import pytest
from pyspark.sql import functions as F

from tesserix.operators import drift, expect, ledger, resolve
from tesserix.plans import extraction as plan
from tesserix.sources import manifest

PROGRAMS = "program_id string, name string, page string, extra_pages array<string>, adm_page string, tuition_page string"
PATTERNS = {"degree": (("degree", r"Degree: ([^;.]+)"),), "tuition": (("fee", r"Fee: ([^;.]+)"),)}


def programs(spark, rows):
    return spark.createDataFrame(rows, PROGRAMS)


def test_rules_by_rank_and_place(spark):
    own = programs(spark, [
        ("a", "Law (на английски език)", "https://S.example/law", ["https://s.example/more"], None, "http://www.s.example:80/fees"),
        ("b", "Botany", "https://s.example/shared", None, None, None),
        ("c", "Zoology", "https://s.example/shared", None, None, None),
        ("d", "Music", None, [], None, None),
    ])
    docs = spark.createDataFrame(
        [
            ("s.example/law", "r1", "Law (на английски език) Degree: ."),
            ("s.example/more", "r2", "Degree: Master; Fee: 5 EUR"),
            ("s.example/fees", "r3", "Fee: 900 EUR; Degree: Doctor"),
            ("s.example/shared", "r4", "BOTANY\nDegree: Bachelor.\nZOOLOGY\nDegree: Master. Fee: 70 EUR."),
        ],
        "address string, ref string, text string",
    )
    fields = ["degree", "tuition", "language"]
    got = {(r["program_id"], r["field"]): (r["value"], r["rule"]) for r in plan.resolve_cells(own, fields, docs, patterns=PATTERNS).collect()}
    assert len(got) == 12 and got["a", "degree"] == ("Master", plan.LABEL) and got["a", "tuition"] == ("5 EUR", plan.LABEL) and got["a", "language"] == ("на английски език", plan.NAME)
    # A shared page is read in the programme's own part only.
    assert got["b", "degree"] == ("Bachelor", plan.LABEL) and got["c", "degree"] == ("Master", plan.LABEL) and got["b", "tuition"] == (None, None) and got["c", "tuition"] == ("70 EUR", plan.LABEL)
    assert all(got["d", f] == (None, None) for f in fields)
    # An anchor comes first, unless its page doesn't name the programme.
    anchors = spark.createDataFrame([("a", "tuition", "s.example/fees", r"Fee: (\d+ EUR)", False), ("b", "tuition", "s.example/fees", r"Fee: (\d+ EUR)", True)], "program_id string, field string, address string, pattern string, names_program boolean")
    got = {(r["program_id"], r["field"]): (r["value"], r["rule"]) for r in plan.resolve_cells(own, fields, docs, patterns=PATTERNS, anchors=anchors).collect()}
    assert got["a", "tuition"] == ("900 EUR", plan.ANCHOR) and got["b", "tuition"] == (None, None)
    assert plan.resolve_cells(own, fields, docs.where("false"), patterns=PATTERNS).where("value is not null").count() == 0


def test_records_are_gated_against_their_own_text(spark):
    texts = spark.createDataFrame([("r", "Degree: Master; x"), ("s", None), (None, "Degree: Master;")], "ref string, text string")
    rows = plan.field_records(texts, PATTERNS).collect()
    assert [(r["ref"], r["field"], r["value"], r["status"]) for r in rows] == [("r", "degree", "Master", "PASS")]
    assert "Join" not in plan.field_records(texts, PATTERNS)._jdf.queryExecution().optimizedPlan().toString()


def test_documents_resolve_or_say_why_not(spark):
    own = programs(spark, [("a", "A", "https://s.example/1", ["https://s.example/2", "https://s.example/3", "https://s.example/4"], None, None)])
    fetches = spark.createDataFrame(
        [
            ("http://s.example/1", "2026-01-01", 200, "b1", "c1", None, "text/html"),
            ("http://s.example/1/", "2026-01-02", 200, "b2", "c2", None, "text/html"),
            ("http://s.example/1", "2026-01-03", 500, None, None, "boom", None),
            ("https://s.example/2", "2026-01-01", 200, "b3", "c3", None, "application/zip"),
            ("https://s.example/3", "2026-01-01", 200, "b4", "c4", None, "application/pdf"),
        ],
        "url string, retrieved_at string, status int, sha256 string, canonical_sha256 string, error string, content_type string",
    )
    shown = spark.createDataFrame([("c1", "x", "old"), ("c2", "x", "new"), ("c2", "x", None)], "sha256 string, renderer_id string, text string")
    found, failed = plan.resolve_documents(own, fetches, shown)
    assert [(r["address"], r["ref"], r["kind"], r["text"]) for r in found.collect()] == [("s.example/1", "sha256:b2", "html", "new")]
    assert {r["address"][-1]: r["reason"] for r in failed.collect()} == {"2": "no renderer", "3": "no rendering", "4": "no usable fetch"}


def test_verified_pages_and_their_totals(spark):
    pages = spark.createDataFrame([("r1", "Law на английски език", "Law на английски език. Degree: Master;"), ("r2", "Art", "nothing"), ("r3", None, None)], "ref string, name string, text string")
    got = plan.verify_pages(pages, PATTERNS)
    assert {(r["ref"], r["field"], r["value"]) for r in got.collect()} == {("r1", "degree", "Master"), ("r1", "language", "на английски език")}
    calls = spark.createDataFrame([("r1", 0.5, None), ("r1", None, None), ("r2", 1.0, "refused")], "ref string, cost double, error string")
    assert {tuple(r) for r in plan.proposal_totals(got, calls).collect()} == {("r1", 2, 0.5, 0), ("r2", 0, 1.0, 1)}


@pytest.mark.parametrize(
    "text,want",
    [("1200 лв.", (1200.0, "BGN")), ("fee: 1,500.50 EUR", (1500.5, "EUR")), ("1.234,56 евро", (1234.56, "EUR")), ("1.500 лв", (1.5, "BGN")), ("1 200 leva", (200.0, "BGN")), ("3 years", None), (None, None), ("1.2.3 EUR", None)],
)
def test_amounts(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(expect.amount(F.col("t")).alias("a")).first()["a"]
    assert (tuple(got) if got else None) == want


def test_equivalent_currencies(spark):
    rows = [("1200 лв", "613.55 EUR", True), ("1200 лв", "700 EUR", False), ("5 EUR", "5 EUR", False), ("0 лв", "0 EUR", False), (None, "5 EUR", False), ("613 EUR", "1200 BGN", True)]
    df = spark.createDataFrame([r[:2] for r in rows], "a string, b string")
    assert [r[0] for r in df.select(expect.currency_equivalent(F.col("a"), F.col("b"))).collect()] == [r[2] for r in rows]


def test_measures_over_common_programmes(spark):
    runs = [("s", "1", "a", True, 1, 4), ("s", "1", "b", False, 2, 2), ("s", "2", "a", False, 4, 4), ("t", "1", "z", True, 0, 0)]
    got = expect.common_measures(spark.createDataFrame(runs, "site string, run string, program_id string, covered boolean, empty long, fields long")).collect()
    assert {tuple(r) for r in got} == {("s", "1", 1, 1.0, 0.25), ("s", "2", 1, 0.0, 1.0), ("t", "1", 1, 1.0, 0.0)}


def test_costs_and_findings(spark):
    calls = spark.createDataFrame([("u", "U:p:f:1", 0.2), ("u", "U:p:f:2", None), ("u", "U:row", 9.0), ("v", None, 1.0), ("w", "W:p:f:1:x", 0.5)], "uni_id string, tag string, cost double")
    costs = expect.call_costs(calls)
    assert {tuple(r) for r in costs.collect()} == {("u", 2, 0.1), ("w", 1, 0.5)} and tuple(expect.cost_range(costs).first()) == (0.1, 0.5, 2)
    found = spark.createDataFrame([("u", "open"), ("u", "fixed"), ("v", None)], "uni_id string, status string")
    assert {tuple(r) for r in expect.finding_counts(found).collect()} == {("u", 2, 1), ("v", 1, 0)}


def test_pins_of_all_places(spark):
    own = programs(spark, [("p", "P", "https://x.example/d?code=c%201&version=2", ["https://x.example/e?version=3", "https://x.example/f"], None, "not an address")])
    anchors = spark.createDataFrame([("anchors.a", "https://x.example/g?code=q&version=1")], "path string, url string")
    got = {(r["path"], r["code"], r["version"]) for r in drift.pinned_sources(own, anchors).collect()}
    assert got == {("programs.p.page", "c 1", "2"), ("programs.p.extra_pages", None, "3"), ("anchors.a", "q", "1")}


def test_pages_no_programme_has(spark):
    own = programs(spark, [("p", "P", "https://WWW.x.example:443/d/", None, None, None)])
    seen = spark.createDataFrame([("http://x.example/d", 1), ("https://x.example/e", 2)], "url string, address int")
    assert [r["url"] for r in resolve.unconfigured(seen, own).collect()] == ["https://x.example/e"]


def test_pointer_moves_and_rolls_back(spark, tmp_path):
    at = ledger.Pointer(spark, str(tmp_path / "current"))
    assert at.current("u") is None
    for run in ("r1", "r2", "r1"):
        at.move("u", run)
    at.move("v", "r9")
    assert ledger.Pointer(spark, str(tmp_path / "current")).current("u") == "r1" and at.current("w") is None
    assert ledger.new_run_id("U").startswith("U-20") and ledger.new_run_id("U") != ledger.new_run_id("U")


def test_years_and_summaries(spark):
    rows = [("tuition", "5 EUR for 2026 / 2027", None, "2026/2027"), ("admission", "x", "exam 2024/2025", "2024/2025"), ("degree", "2026/2027", None, "now"), (None, "2026/2027", None, "2026/2027"), ("tuition", None, None, "now")]
    df = spark.createDataFrame([r[:3] for r in rows], "f string, v string, s string")
    assert [r[0] for r in df.select(ledger.inferred_year(F.col("f"), F.col("v"), F.array("s"), F.lit("now"))).collect()] == [r[3] for r in rows]
    runs = spark.createDataFrame([("u", "r", "p", "2025", "v"), ("u", "r", "q", "2025", None), ("u", "s", "p", "2026", "v")], "uni_id string, run_id string, program_id string, academic_year string, value string")
    assert {tuple(r) for r in ledger.run_summaries(runs).collect()} == {("u", "r", 2, 1, 2, 1), ("u", "s", 1, 1, 1, 1)}


def test_bodies_and_robots(spark):
    fetches = spark.createDataFrame([("https://A.example:1/x", "1", "robots.txt HTTP 404, permissive", "s1"), ("https://a.example:1/y", "2", "robots.txt HTTP 200, parsed", "s1"), ("https://b.example/", "1", None, "s2")], "url string, retrieved_at string, robots string, sha256 string")
    assert {tuple(r) for r in manifest.robots_by_host(fetches).collect()} == {("a.example:1", 2, "robots.txt HTTP 200, parsed", False), ("b.example", 1, None, True)}
    bodies = spark.createDataFrame([("s1", bytearray(b"x"))], "sha256 string, content binary")
    assert manifest.bodies_of(fetches.where("sha256 = 's1'"), bodies).count() == 2
    with pytest.raises(Exception, match="no body for s2"):
        manifest.bodies_of(fetches, bodies).collect()
    ok = spark.createDataFrame([(200, None), (404, None), (200, "late"), (None, None)], "status int, error string")
    assert [r[0] for r in ok.select(manifest.is_ok(F.col("status"), F.col("error"))).collect()] == [True, False, False, False]


def test_gate_takes_one_text_of_a_ref(spark):
    from tesserix.operators import gate

    claims = spark.createDataFrame([("r", "Master", ["Degree: Master"])], "ref string, value string, segments array<string>")
    texts = spark.createDataFrame([("r", "Degree: Master."), ("r", "Bachelor")], "ref string, text string")
    for rows in (texts, texts.orderBy("text"), texts.orderBy(F.desc("text"))):
        assert [r["status"] for r in gate.gate(claims, rows).collect()] == ["PASS"]
