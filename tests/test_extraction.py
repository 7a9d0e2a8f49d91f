"""Extraction operators on small cases, plain Python as the measure where there is one."""

import io
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from tesserix.functions import text as t
from tesserix.operators import drift, gate, grade, grid, labels, ledger, region, resolve, tail
from tesserix.plans import extraction
from tesserix.sources import configs, manifest, pages, workbook
from tesserix.streaming import views


@pytest.mark.parametrize(
    "value,segments,text,want",
    [
        ("8 семестра", ["Продължителност на обучението (брой семестри): 8"], None, "PASS"),
        ("6 семестра", ["Продължителност на обучението (брой семестри): 8"], None, "REJECT_SUPPORT"),
        ("8 семейни", ["Продължителност на обучението (брой семестри): 8"], None, "REJECT_SUPPORT"),
        ("до 4 години", ["Срок на обучение: 4 години"], None, "REJECT_SUPPORT"),
        ("на 4 години", ["Срок на обучение: 4 години"], None, "PASS"),
        ("46 EUR", ["Икономика 460 EUR"], None, "REJECT_SUPPORT"),
        ("6,900 лв", ["Годишна такса 6.900 лв за програмата"], None, "PASS"),
        ("€6,900/semester", ["The fee is 6,900/semester"], None, "REJECT_SUPPORT"),
        ("1200 лв", ["Годишна такса: 1200лв. за учебната година"], None, "PASS"),
        ("—?!", ["x"], "x", "PARSE_FAILURE"),
        ("  ", ["x"], "x", "PARSE_FAILURE"),
        ("460 EUR", [], "460 EUR", "PARSE_FAILURE"),
        ("460 EUR", [" "], "460 EUR", "PARSE_FAILURE"),
        (None, None, "x", "NULL_OK"),
        ("460 EUR", ["row one row two 460 EUR"], "row one 460 EUR\nrow two 460 EUR", "REJECT_CONTAINMENT"),
        ("„Да“", ["каза \"ДА\" днес"], "Той каза «да» днес", "PASS"),
    ],
)
def test_gate(spark, value, segments, text, want):
    claims = spark.createDataFrame([("a", value, segments, "clash")], "ref string, value string, segments array<string>, text string")
    texts = spark.createDataFrame([("a", text if text is not None else (segments or [""])[0])], "ref string, text string")
    row = gate.gate(claims, texts).first()
    assert row["status"] == want and row["text"] == "clash"


def test_unknown_artifact_contains_nothing(spark):
    claims = spark.createDataFrame([("zz", "4 години", ["4 години"])], "ref string, value string, segments array<string>")
    texts = spark.createDataFrame([], "ref string, text string")
    assert gate.gate(claims, texts).first()["status"] == "REJECT_CONTAINMENT"
    assert {r["status"]: r["n"] for r in gate.status_counts(gate.gate(claims, texts)).collect()} == {"PASS": 0, "REJECT_CONTAINMENT": 1, "REJECT_SUPPORT": 0, "NULL_OK": 0, "PARSE_FAILURE": 0}


@pytest.mark.parametrize("raw", ["a    b\t\nc", "", None, " x ", "　"])
def test_norm(spark, raw):
    assert spark.createDataFrame([(raw,)], "x string").select(t.norm(F.col("x"))).first()[0] == " ".join((raw or "").split())


def test_comparison_form():
    assert t.comparison_form("„Straße“ – й  ’x’") == "\"strasse\" - й 'x'"


@pytest.mark.parametrize(
    "text,name,siblings,want",
    [
        ("intro АЛФА alpha body БЕТА beta body", "АЛФА", ["БЕТА"], [(6, 22)]),
        ("intro АЛФА alpha body БЕТА beta body", "БЕТА", ["АЛФА"], [(22, 36)]),
        ("nav: БЕТА АЛФА | БЕТА real content АЛФА end", "БЕТА", ["АЛФА"], [(5, 10), (17, 35)]),
        ("АЛФА x АЛФА y БЕТА z", "АЛФА", ["БЕТА"], [(0, 14)]),
        ("АЛФА " + "x" * 3000, "АЛФА", ["БЕТА"], [(0, 2500)]),
        ("финансиране и финансите", "Финанси", ["Бета"], []),
        (None, "x", None, []),
        ("", "", [], []),
    ],
)
def test_regions(text, name, siblings, want):
    assert region.region_spans(text, name, siblings) == want


def cells(spark, rows):
    return spark.createDataFrame([("r", 0, i, j, c) for i, row in enumerate(rows) for j, c in enumerate(row)], "ref string, t int, r int, c int, cell string")


def test_fee_rows(spark):
    grid_cells = cells(spark, [["такса", "", "специалност"], ["лв.", "евро", ""], ["800", "–", "Право"], ["900", "460 EUR", "Право, задочно"], ["1", "2", "Икономика"]])
    alias = spark.createDataFrame([("p", "r", "Право"), ("q", "r", "Няма")], "program_id string, ref string, alias string")
    got = grid.fee_rows(grid_cells, alias, "специалност", ["евро"], r"(\d+ EUR)").collect()
    assert [(g["program_id"], g["r"], g["value"], g["segments"]) for g in got] == [("p", 3, "460 EUR", ["900 460 EUR Право, задочно"])]


def test_marker_is_a_whole_cell(spark):
    grid_cells = cells(spark, [["Приложение 10", ""], ["name", "fee"], ["Право", "5"]])
    alias = spark.createDataFrame([("p", "r", "Право")], "program_id string, ref string, alias string")
    assert grid.fee_rows(grid_cells, alias, "name", ["fee"], marker="Приложение 1").count() == 0
    assert grid.fee_rows(grid_cells, alias, "name", ["fee"], marker="Приложение 10").first()["segments"] == ["Право 5", "Приложение 10"]


def test_sectioned_fees(spark):
    lines = spark.createDataFrame([("r", 0, n, x) for n, x in enumerate(["На български", "Право 500", "In English", "Право 900", "Химия 7"])], "ref string, t int, r int, line string")
    alias = spark.createDataFrame([("p", "r", "^Право")], "program_id string, ref string, alias_pattern string")
    got = grid.sectioned_fees(lines, [("bg", "На български", False), ("en", "In English", True)], alias, r"(\d+)", "евро").first()
    assert (got["value"], got["segments"], got["tracks"]) == ("500 евро", ["На български", "Право 500"], "bg")


def test_labels_take_the_next_pattern_after_a_long_value(spark):
    df = spark.createDataFrame([("a", "Degree: " + "x" * 500 + "; Level: Master;"), ("b", None), ("c", "Level: Doctor;")], "ref string, text string")
    got = labels.harvest_field(df, "degree", (("one", r"Degree: ([^;]+)"), ("two", r"Level: ([^;]+)"))).collect()
    assert {(g["ref"], g["value"], g["method"]) for g in got} == {("a", "Master", "label:two"), ("c", "Doctor", "label:two")}


def test_label_library(spark):
    said = "Език на преподаване Български или английски. Срок на обучение: 8 семестъра (4 учебни години). Степен: ОКС „бакалавър”"
    df = spark.createDataFrame([("a", said)], "ref string, text string")
    got = {(r["field"], r["value"], r["status"]) for r in extraction.field_records(df).collect()}
    assert ("language", "Български или английски", "PASS") in got and ("degree", "ОКС „бакалавър”", "PASS") in got


def test_names(spark):
    df = spark.createDataFrame([("учи ПРАВО тук", "Право (задочно)"), ("правота", "Право"), (None, "Право"), ("a\\Eb", "a\\Eb")], "x string, n string")
    assert [r[0] for r in df.select(t.names(F.col("x"), F.col("n"))).collect()] == [True, False, False, True]


def test_newest_hides_older_good(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.jsonl").write_text('{"kind":"fetch","url":"u","status":200,"sha256":"s1","cookies":{"b":"1","a":"2"}}\n\nnot json\n{"kind":"fetch","url":"u","status":503,"sha256":"s2","cookies":{"a":"2","b":"1"}}\n{"kind":"fetch","url":"v","status":404,"sha256":"s3"}\n{"kind":"canonical","sha256":"s3","canonical_sha256":"c9"}\n{"torn')
    records = manifest.read_manifest(spark, str(log))
    assert records.count() == 4
    got = manifest.lookup(records).collect()
    assert [(r["url"], r["canonical_sha256"], r["attempts"], r["final_url"]) for r in got] == [("v", "c9", 1, "v")]
    wanted = spark.createDataFrame([("u", None), ("v", None)], "url string, cookies map<string,string>")
    found, missing = manifest.replay(wanted, records)
    assert [r["url"] for r in found.collect()] == ["v"] and [r["url"] for r in missing.collect()] == ["u"]


def test_append_and_stream(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([("fetch", "u", "2026-01-01T00:00:00Z", 200, "s1"), ("fetch", "u", "2026-01-02T00:00:00Z", 500, None)], "kind string, url string, retrieved_at string, status int, sha256 string")
    manifest.append_records(rows, log)
    out = str(tmp_path / "out")
    views.drain(views.latest_view(views.manifest_stream(spark, log)), out, str(tmp_path / "cp"), "update").awaitTermination()
    last = spark.read.parquet(out + "/batch=*").first()
    assert last["fetches"] == 2 and last["last"]["status"] == 500


def test_canonical_text_and_links():
    html = "<html><body><nav>menu</nav><div class='site-header x'>head</div><script>x()</script><p>" + "word " * 100 + "</p><ul>" + "<li>m</li>" * 25 + "</ul><a href='/a#x'>A <b>one</b></a><a href='mailto:q@x'>q</a><a href='https://h.example/a'>again</a><a href='https://other.example/'>o</a></body></html>"
    text, mode = pages.canonical_text(html)
    assert mode == "aggressive" and "menu" not in text and "head" not in text and "x()" not in text and "\nm\n" not in text
    assert pages.canonical_text("<p>short</p><nav>n</nav>") == ("short\nn", "light-fallback")
    assert pages.canonical_text(None) is None and pages.canonical_text("") == ("", "light-fallback")
    assert pages.links(html, "https://h.example/dir/p") == [("https://h.example/a", "A one")]
    assert pages.listed_versions('<a data-version="2" data-code="c1"></a><a data-code="c1" data-version=\'3\'>') == {"c1": "3"}
    assert pages.pin_of("https://x/?code=c&version=4") == ("c", "4") and pages.pin_of("https://x/?code=c") is None


def book():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="R"><sheets><sheet name="B" r:id="i2"/><sheet name="A" r:id="i1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="i1" Target="worksheets/sheet1.xml"/><Relationship Id="i2" Target="worksheets/sheet2.xml"/></R>')
        z.writestr("xl/sharedStrings.xml", "<sst><si><r><t>Spe</t></r><r><t>cial</t></r></si></sst>")
        z.writestr("xl/styles.xml", '<s><numFmts><numFmt numFmtId="164" formatCode="0.000"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="2"/><xf numFmtId="164"/></cellXfs></s>')
        z.writestr("xl/worksheets/sheet1.xml", '<w><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" s="1"><v>204.5168</v></c></row><row><c r="B3" t="inlineStr"><is><t>in</t></is></c><c r="C3" s="2"><v>1</v></c></row></sheetData><mergeCells><mergeCell ref="A1:B1"/><mergeCell ref="B3:C3"/></mergeCells></w>')
        z.writestr("xl/worksheets/sheet2.xml", '<w><sheetData><row><c r="A1"><v>7</v></c></row></sheetData></w>')
    return out.getvalue()


def test_workbook(spark):
    assert workbook.read_workbook(book()) == [[["7"]], [["Special", "Special", "204.52"], ["", "in", "1.000"]]]
    assert workbook.column_index("AB7") == 27
    df = spark.createDataFrame([("ok", bytearray(book())), ("bad", bytearray(b"zip?")), ("null", None)], "ref string, content binary")
    rows = workbook.workbook_cells(df).collect()
    assert {r["ref"] for r in rows if r["error"]} == {"bad", "null"} and sum(r["ref"] == "ok" for r in rows) == 7


def test_diff_runs(spark):
    schema = "program_id string, field string, academic_year string, value string"
    a = spark.createDataFrame([("p", "f", None, "1"), ("q", "f", "y", "1"), ("r", "f", "y", None)], schema)
    b = spark.createDataFrame([("p", "f", None, "2"), ("s", "f", "y", None), ("r", "f", "y", None)], schema)
    assert {(r["program_id"], r["change"]) for r in ledger.diff_runs(a, b).collect()} == {("p", "changed"), ("q", "removed"), ("s", "added")}


def test_ledger_store(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.append_run(spark.createDataFrame([("u", "r1", "p", 1)], "uni_id string, run_id string, program_id string, ledger_seq long"), path)
    ledger.append_run(spark.createDataFrame([("u", "r2", "p", 2)], "uni_id string, run_id string, program_id string, ledger_seq long"), path)
    one = ledger.load_run(spark, path, "u", "r2")
    assert [r["ledger_seq"] for r in one.collect()] == [2] and "PartitionFilters: [isnotnull(uni_id" in one._jdf.queryExecution().executedPlan().toString()


def test_grading(spark):
    on = "program_id string, field string, "
    key = spark.createDataFrame([("a", "f", "x"), ("b", "f", None), ("c", "f", "x"), ("d", "f", "x"), ("e", "f", None), ("k", "f", "x")], on + "expected string")
    report = spark.createDataFrame([("a", "f", "PASS", "x"), ("b", "f", "PASS", "y"), ("c", "f", "PASS", "z"), ("d", "f", "REJECT_SUPPORT", None), ("e", "f", "NULL_OK", None), ("r", "f", "PASS", "x")], on + "status string, shipped string")
    verdicts = spark.createDataFrame([("c", "f", " OK ", "other")], on + "verdict string, shipped_value string")
    graded, orphans = grade.grade(key, report, verdicts, lambda e, s: e.eqNullSafe(s))
    assert {r["program_id"]: r["category"] for r in graded.collect()} == {"a": "OK_VALUE", "b": "FABRICATION", "c": "CHECK", "d": "MISS_GATE", "e": "OK_NULL"}
    assert {(r["program_id"], r["side"]) for r in orphans.collect()} == {("k", "key"), ("r", "report")}
    assert grade.rates(graded).first()["wrong_rate"] is None
    settled, _ = grade.grade(key, report, spark.createDataFrame([("c", "f", "wrong", "z")], on + "verdict string, shipped_value string"), lambda e, s: e.eqNullSafe(s))
    assert grade.rates(settled).first()["wrong_rate"] == pytest.approx(1 / 3)


def test_binomial_bound():
    assert grade.binomial_upper(265, 6) == pytest.approx(0.0442, abs=5e-4)
    assert grade.binomial_upper(33, 0) == pytest.approx(1 - 0.05 ** (1 / 33), abs=1e-9)
    assert grade.binomial_upper(0, 0) == grade.binomial_upper(3, 3) == 1.0
    assert not math.isnan(grade.binomial_upper(10_000, 5))


def test_churn(spark):
    rows = [("http://h/a", f"2026-01-0{n}", sha, can) for n, (sha, can) in enumerate([("s1", "c1"), ("s1", "c1"), ("s2", "c1"), ("s3", "c2")], 1)]
    df = spark.createDataFrame(rows + rows + [("http://h/a", "2026-02-01", None, None)], "url string, retrieved_at string, sha256 string, canonical_sha256 string")
    r = drift.churn(drift.visits(df)).first()
    assert (r["pages"], r["pairs"], r["raw"], r["ambiguous"], r["most_visits"], r["threatens"]) == (1, 3, 1, 1, 4, True)


def test_second_reading():
    check = lambda a: ("NULL_OK", "") if a.get("value") is None else (("PASS", "") if a["value"] == "good" else ("REJECT_SUPPORT", "no"))
    docs = [("r", "text")]
    assert tail.second_reading("f", [], None, None) == tail.Outcome("NULL_OK", None, 0, False)
    say = lambda **k: tail.CannedCalls({t: {"value": v, "ref": "r"} for t, v in k.items()} | {("large", "x"): {"value": k.get("big"), "ref": "r"}})
    assert tail.second_reading("f", docs, say(x="good"), check, tag="x") == tail.Outcome("PASS", "good", 1, False)
    assert tail.second_reading("f", docs, say(x="bad", big="good"), check, tag="x") == tail.Outcome("PASS", "good", 3, True)
    assert tail.second_reading("f", docs, tail.CannedCalls({"x": {"value": "good", "ref": "elsewhere"}}), check, tag="x") == tail.Outcome("PARSE_FAILURE", None, 2, True)
    assert tail.second_reading("f", docs, tail.CannedCalls({}), check, tag="x") == tail.Outcome("PARSE_FAILURE", None, 2, True)


def test_configs(spark, tmp_path):
    good = {"uni_id": "U", "programs": [{"id": "p", "name": "N", "page": "https://x/p", "field_anchors": {"degree": "a"}, "suppress_labels": {"degree": ["bg-oks-label"]}}], "sources": {"s": {"url": "https://x/s"}}, "anchors": {"a": {"source": "s", "pattern": "(x)", "scope": "page-wide"}}}
    import copy
    import json

    (tmp_path / "U.json").write_text(json.dumps(good))
    sites = configs.load_sites(str(tmp_path))
    assert configs.programs_table(spark, sites).first()["program_id"] == "p" and configs.suppressed_table(spark, sites).count() == 1
    for change in (lambda c: c.update(odd=1), lambda c: c["anchors"]["a"].update(pattern="x"), lambda c: c["anchors"]["a"].pop("scope"), lambda c: c["programs"].append(c["programs"][0]), lambda c: c["programs"][0].pop("page"), lambda c: c["programs"][0]["field_anchors"].update(degree="zz")):
        bad = copy.deepcopy(good)
        change(bad)
        with pytest.raises(configs.ConfigError):
            configs.parse_site(bad)


def test_document_plan(spark):
    df = spark.createDataFrame([("p", "N", "http://WWW.x.example:80/a/", ["https://x.example/b"], "https://x.example/a", None)], "program_id string, name string, page string, extra_pages array<string>, adm_page string, tuition_page string")
    assert {(r["address"], r["route"]) for r in resolve.document_plan(df).collect()} == {("x.example/a", "page"), ("x.example/b", "extra_pages")}


def test_sentences(spark):
    text = "Право (задочно) срок 4 години.\nЧл. 5\n- изпит по история\n- изпит по право\nТакса за Право: 500 евро"
    df = spark.createDataFrame([(text, "Право"), ("nothing", "Право"), (None, "x")], "x string, a string")
    x, a = F.col("x"), F.col("a")
    got = df.select(
        grid.sentence_value(x, r"{alias} \([^)]*\) срок (?P<duration>\d+ години)", "duration", a)["value"].alias("duration"),
        grid.tail_of_match(x, r"{alias}[^:]*: (\d+ евро)", a, 8).alias("tail"),
        grid.near_section(t.norm(x), F.lit("Такса за"), r"\d+ евро").alias("near"),
        grid.clause_of_row(x, a, r"^{alias} \([^)]*\) срок (\d+) години", 1).alias("row"),
        grid.clause_of_row(x, a, r"^{alias} \([^)]*\) срок (\d+) години", 1, r"(?s)Чл\. 5\n(.*?)\nТакса", "право").alias("clause"),
    ).collect()
    assert got[0]["duration"] == "4 години" and got[0]["tail"]["value"] == "500 евро" and len(got[0]["tail"]["segment"]) == 8
    assert got[0]["near"] == "500 евро" and got[0]["row"] == "4" and got[0]["clause"] == "изпит по право"
    assert got[1]["duration"] is None and got[1]["tail"] is None and got[2]["near"] is None


def test_key_cells_are_stated_once(spark):
    schema = "program_id string, field string, expected string"
    assert grade.read_key(spark.createDataFrame([("p", "f", None)], schema)).first()["expected"] is None
    with pytest.raises(Exception, match="stated twice"):
        grade.read_key(spark.createDataFrame([("p", "f", "1"), ("p", "f", "2")], schema)).collect()


def test_command_line(spark, tmp_path):
    from tesserix.__main__ import main

    spark.createDataFrame([("click", 1.0), ("click", 3.0)], "event_type string, value double").write.parquet(str(tmp_path / "in/events.parquet"))
    assert main(["event_means", str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).first()["mean"] == 2.0


def test_names_and_anchors(spark):
    said = "Завършилите придобиват образователната степен „магистър“ по специалността „Право (задочно)“ тук"
    df = spark.createDataFrame([(said, "Право (задочно)", r"степен „(\w+)", "Право (на английски език)")], "x string, n string, p string, m string")
    r = df.select(labels.degree_from_name(F.col("n"), F.col("x")), labels.anchor_value(F.col("x"), F.lit("степен „([а-я]+)")), labels.anchor_value(F.col("x"), F.lit("степен „([а-я]+)"), F.lit(False)), labels.language_from_name(F.col("m"), F.col("x"))["value"]).first()
    assert list(r) == ["магистър", "магистър", None, "на английски език"]


def test_grid_text_renders_whole_tables(spark, tmp_path):
    from tesserix.queries import extraction as registered

    parts = [(k, f"Brand#{k % 2}", f"part  {k}", f"TYPE {k % 3}", 100.0 + k) for k in range(40)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string, p_type string, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    got = {r["ref"]: r["text"] for r in registered.grid_text(spark, str(tmp_path)).collect()}
    body = lambda b: [f"{p * 1.95583:.2f} part {k} {p:.2f} {kind}" for k, brand, _, kind, p in parts if brand == b]
    assert got == {b: "\n".join(["Price Part Price Type", "BGN EUR", *body(b)]) for b in ("Brand#0", "Brand#1")}
