"""Common units, snapshot changes, wide tables: results on small fixtures and by brute force."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tesserix.functions import quantity as q
from tesserix.operators import quantities, snapshot_changes, wide_table

LEDGER = "ledger_seq long, uni_id string, run_id string, program_id string, field string, academic_year string, value string"


def changes(spark, rows):
    df = spark.createDataFrame(rows, LEDGER).withColumns({"site": F.lit("clash"), "place": F.lit(9), "change": F.lit(None).cast("string")})
    return sorted(tuple(r) for r in snapshot_changes.snapshot_changes(df).drop("site").collect())


def test_changes_between_runs(spark):
    a, b, c = "U-20260101T000000Z-ff", "U-20260201T000000Z-00", "U-20260301T000000Z-aa"
    rows = [
        (1, "U", a, "p1", "degree", "2025/2026", "x"),
        (2, "U", a, " P1", "Degree", "2025-2026", "y  z"),  # the same key, appended later
        (3, "U", a, "p2", "degree", "2025/26", "old"),
        (9, "U", b, "p1", "degree", "2025/2026", " y z "),
        (4, "U", c, "p1", "degree", "2025/2026", None),
        (5, "U", c, "p2", "degree", "2025/2026", "old"),
        (6, None, c, "p9", "degree", "2025/2026", "no site"),
        (7, "U", None, "p9", "degree", "2025/2026", "no run"),
        (8, "V", "V-20260101T000000Z-1", "p1", "degree", "2025/2026", "first run has no cases"),
    ]
    assert changes(spark, rows + rows) == [
        (b, "p2", "degree", "2025/2026", "removed", "old", None),
        (c, "p1", "degree", "2025/2026", "changed", "y z", None),
        (c, "p2", "degree", "2025/2026", "added", None, "old"),
    ]


def test_changes_of_empty_ledger(spark):
    assert changes(spark, []) == []


def test_changes_by_brute_force(spark):
    rng = random.Random(5)
    runs = [f"S-202601{d:02d}T000000Z-{rng.randrange(999)}" for d in range(1, 7)]
    rows = [(n, "S", rng.choice(runs), f"p{rng.randrange(5)}", rng.choice(["degree", "tuition"]), "2025/2026", rng.choice(["a", "b", None])) for n in range(120)]
    state = {}
    for seq, _, run, p, f, y, v in rows:
        state.setdefault(run, {})[p, f, y] = v
    want = []
    for x, y in itertools.pairwise(sorted(state, key=lambda r: r[2:18])):
        for k in state[x].keys() | state[y].keys():
            if k not in state[x]:
                want.append((y, *k, "added"))
            elif k not in state[y]:
                want.append((y, *k, "removed"))
            elif state[x][k] != state[y][k]:
                want.append((y, *k, "changed"))
    assert [r[:5] for r in changes(spark, rows)] == sorted(want)


def test_kept_snapshots_give_the_same_changes(spark, tmp_path):
    """Runs delivered in parts, the state opened anew each time: together the changes of the whole history."""
    rng = random.Random(12)
    rows, n = [], 0
    for day in range(1, 9):
        for site in "ABC":
            for p in rng.sample(range(12), rng.randrange(0, 12)):
                for _ in range(rng.choice([1, 1, 2])):
                    n += 1
                    rows.append((n, site, f"{site}-202601{day:02d}T000000Z-{day}", f"p{p} Ж"[: rng.choice([2, 4])], "degree", "2025/2026", rng.choice(["a", "b ", None])))
    whole = changes(spark, rows)
    path, parts = str(tmp_path / "kept"), []
    for days in ((1, 2, 3), (4,), (), (5, 6, 7, 8)):
        part = [r for r in rows if int(r[2][8:10]) in days]
        got = snapshot_changes.SnapshotStore(spark, path).advance(spark.createDataFrame(part, LEDGER))
        parts += [tuple(r) for r in got.drop("site").collect()]
    assert sorted(map(str, parts)) == sorted(map(str, whole)) and len(whole) > 50
    again = snapshot_changes.SnapshotStore(spark, path)
    assert again.version == 4 and again.advance(spark.createDataFrame(rows, LEDGER)).count() == 0  # all too late


def test_two_pointers_by_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ({k: rng.choice([None, "x", "y"]) for k in rng.sample(range(9), rng.randrange(9))} for _ in range(2))
        got = list(snapshot_changes.two_pointers(sorted(a.items()), sorted(b.items())))
        want = [(k, "removed", a[k], None) for k in a if k not in b] + [(k, "added", None, b[k]) for k in b if k not in a] + [(k, "changed", a[k], b[k]) for k in a if k in b and a[k] != b[k]]
        assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0]) and [r[0] for r in got] == sorted(r[0] for r in got)


def test_range_merge_has_one_range_exchange_and_no_cross_join(spark):
    df = spark.createDataFrame([(1, "U", "U-20260101T000000Z-1", "p", "f", "2025/2026", "v")], LEDGER)
    plan = snapshot_changes.snapshot_changes(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") >= 1 and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize(
    "text,want",
    [
        ("2882", (2882.0, None, None)),
        ("4 780,00 евро", (4780.0, "EUR", None)),
        ("5.840 EUR на година", (5840.0, "EUR", "year")),
        ("2,620.81 lv.", (2620.81, "BGN", None)),
        ("6,64 хил. EUR", (6640.0, "EUR", None)),
        ("4.96k euro per year", (4960.0, "EUR", "year")),
        ("7.98 thousand BGN per year", (7980.0, "BGN", "year")),
        ("€1,730.00 each semester", (1730.0, "EUR", "semester")),
        ("17280 EUR за целия курс на обучение (4 години) съгласно заповед № 412", (17280.0, "EUR", "course")),
        ("2920.00 EUR за учебната 2026/2027 г.", (2920.0, "EUR", None)),
        ("12321.73 leva for first-year students", (12321.73, "BGN", None)),
        ("none here", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_money(spark, text, want):
    m = q.read_money(spark.createDataFrame([(text,)], "t string"), "t", "m").first()["m"]
    assert (m["amount"], m["currency"], m["period"]) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("8 семестъра (редовно)", (8.0, "semester")),
        ("2 години / 4 семестъра", (2.0, "year")),
        ("a 3-year course of study", (3.0, "year")),
        ("VIII семестъра", (8.0, "semester")),
        ("четири години", (4.0, "year")),
        ("2 години и половина", (2.5, "year")),
        ("1 and a half years", (1.5, "year")),
        ("обучението е 48 мес.", (48.0, "month")),
        ("4 г.", (4.0, "year")),
        ("", (None, None)),
    ],
)
def test_span(spark, text, want):
    s = q.read_span(spark.createDataFrame([(text,)], "t string"), "t", "s").first()["s"]
    assert (s["amount"], s["period"]) == want


STATEMENT = "src string, row_id long, device string, field string, text string, context string, stamp timestamp"


def statements(spark, rows):
    day = lambda n: datetime(2026, 1, 1) + timedelta(days=n)
    df = spark.createDataFrame([(s, i, d, f, x, c, day(n)) for n, (s, i, d, f, x, c) in enumerate(rows)], STATEMENT).withColumns({"amount": F.lit("clash"), "years": F.lit(0)})
    return {r["row_id"]: (r["unit"], round(r["value"], 2)) for r in quantities.common_units(df).collect()}


def test_common_units(spark):
    got = statements(spark, [
        ("k", 1, "p", "tuition", "1000 EUR на семестър", None),
        ("k", 2, "p", "tuition", "3911.66", "Годишна такса (в лева): 3911.66."),
        ("v", 3, "p", "tuition", "students pay 2000", "annual fee (in euro)"),
        ("v", 4, "p", "tuition", "2010", None),  # nothing says the unit: the level does
        ("v", 5, "p", "tuition", "8000 EUR for the whole course of 4 years", None),
        ("k", 6, "p", "duration", "24 months", None),
        ("v", 7, "p", "duration", "2 години и половина", None),
        ("v", 8, "p", "duration", "TBD", None),
        ("v", 9, "p", "tuition", None, None),
        ("v", 10, None, "tuition", "5 EUR", None),
        ("v", 11, "p", "language", "5 EUR", None),
        ("v", 12, "p", "tuition", "0 EUR", None),
    ])
    assert got == {1: ("EUR/semester", 2000.0), 2: ("BGN/year", 2000.0), 3: ("EUR/year", 2000.0), 4: ("EUR/year", 2010.0), 5: ("EUR/year", 2000.0), 6: ("month", 4.0), 7: ("year", 5.0)}


def test_viterbi_follows_a_level_through_a_unit_switch():
    d = quantities.Decoder("tuition")
    out = []
    for n, amount in enumerate([2000, 2010, 3930, 3940, 3950, 2030]):
        out += d.push((n,), amount, "EUR" if n in (0, 5) else None, "year" if n in (0, 5) else None, 1.0)
    out += d.settle()
    assert [u for _, u, _ in out] == ["EUR/year", "EUR/year", "BGN/year", "BGN/year", "BGN/year", "EUR/year"]


def test_viterbi_finds_units_whose_words_are_removed(spark):
    """A series of 40 statements that changes its unit now and then; of two in three the unit words are taken away."""
    rng = random.Random(6)
    units = {"EUR/year": 1.0, "BGN/year": 1.95583, "EUR/semester": 0.5}
    level, unit, rows, want = 3000.0, "EUR/year", [], {}
    for n in range(40):
        level *= 1 + rng.uniform(-0.02, 0.02)
        if n % 8 == 0:
            unit = rng.choice(sorted(units))
        money, _, per = unit.rpartition("/")
        said = n % 8 in (0, 4, 7)
        rows.append(("k", n, "p", "tuition", f"{level * units[unit]:.0f}" + (f" {money} per {per}" if said else ""), None))
        want[n] = unit
    got = {n: u for n, (u, _) in statements(spark, rows).items()}
    assert got == want


def test_viterbi_by_brute_force(monkeypatch):
    """Every path of short series: the decoder's is the cheapest, what it gives out early included.  With the last statement as level, where Viterbi is exact."""
    monkeypatch.setattr(quantities, "FRESH", 1.0)
    rng = random.Random(9)
    for _ in range(40):
        series = [(rng.choice([5, 10, 12, 60]) * rng.uniform(0.9, 1.1), None, rng.choice([None, None, "year", "semester", "month"]), rng.choice([None, "year"])) for _ in range(5)]
        d = quantities.Decoder("duration")
        got = []
        for n, (amount, _, said, near) in enumerate(series):
            got += d.push((n,), amount, None, said, 1.0, None, near)
        got += d.settle()
        best, best_path = None, None
        for path in itertools.product(range(3), repeat=5):
            cost, before, smooth = 0.0, None, None
            for s, (amount, _, said, near) in zip(path, series, strict=True):
                _, log, prior, *_ = d.states[s]
                at = log + quantities.math.log(amount)
                cost += d.evidence(None, said, None, near)[s]
                if before is None:
                    cost, smooth = cost + 0.9 * prior, at
                else:
                    cost += min(quantities.MOST, quantities.JUMP * abs(at - smooth)) + (quantities.SWITCH if s != before else 0.0)
                    smooth = (1 - quantities.FRESH) * smooth + quantities.FRESH * at
                before = s
            if best is None or cost < best:
                best, best_path = cost, path
        told = [d.states[s][0] for s in best_path]
        assert [u for _, u, _ in got] == told


def test_decoder_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(quantities, "LAG", 50)
    d = quantities.Decoder("tuition")
    held, out = 0, []
    for n in range(500):
        out += d.push((n,), 1000.0, None, None, 1.0)
        held = max(held, len(d.rows))
    out += d.settle()
    assert held <= 50 and [n for n, _, _ in out] == list(range(500)) and {u for _, u, _ in out} == {"EUR/year"}


def test_equal_statements_by_brute_force(spark):
    rng = random.Random(2)
    rows = [("p", "tuition", n, round(1000 * rng.choice([1, 1.005, 1.0099, 1.02, 1.5]) * (1 + rng.random() * 0.004), 3)) for n in range(60)]
    left, right = rows[:30], rows[30:]
    schema = "device string, field string, row_id long, value double"
    got = quantities.equal_statements(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    want = {(a[2], b[2]) for a in left for b in right if abs(a[3] - b[3]) <= 0.01 * max(a[3], b[3]) * (1 + 1e-9)}
    assert {(r["left_id"], r["right_id"]) for r in got.collect()} == want and got.count() == len(want)


CELLS = "entity string, attribute string, value string, stamp timestamp, id long"


def test_wide_table(spark):
    d = [datetime(2026, 1, n) for n in range(1, 4)]
    rows = [
        ("p1", "credits", "240 кредита", d[0], 1),
        ("p1", "credits", "180", d[0], 2),  # a tie of stamps: the larger id
        ("p1", "seats", "99", d[1], 3),
        ("p1", "seats", None, d[2], 1),  # newest, without a value
        ("p1", "start_date", "31.02.2028", d[0], 1),
        ("p1", "accredited_until", "7 май 2031 г.", d[0], 1),
        ("p1", "distance", "Да", d[0], 1),
        ("p1", "min_score", "27,09 бал", d[0], 1),
        ("p1", "tuition", "HAND-JUDGED see verdict", d[0], 1),
        ("p1", "entity", "an attribute of that name", d[0], 1),
        ("p1", None, "x", d[0], 1),
        (None, "credits", "1", d[0], 1),
        ("p2", "credits", "x" * 100_000, None, None),
    ]
    df = spark.createDataFrame(rows + rows, CELLS)
    declared = {"credits": "integer", "seats": "integer", "start_date": "date", "accredited_until": "date", "distance": "boolean", "min_score": "decimal", "tuition": "quantity"}
    types = wide_table.discover(df, declared)
    assert types["entity"] == "string" and types["credits"] == "integer"
    wide = wide_table.widen(df, types)
    one = {r["entity"]: r for r in wide.collect()}
    assert one["p1"]["credits"] == 180 and one["p1"]["seats"] is None and one["p1"]["start_date"] is None
    assert str(one["p1"]["accredited_until"]) == "2031-05-07" and one["p1"]["distance"] is True and float(one["p1"]["min_score"]) == 27.09
    assert one["p1"]["tuition"] is None and one["p1"]["entity_"] == "an attribute of that name" and one["p2"]["credits"] is None
    cells = {(r["entity"], r["attribute"]) for r in wide_table.filled_cells(wide, types).collect()}
    assert cells == {("p1", a) for a in ("credits", "accredited_until", "distance", "min_score", "entity")}


def test_types_are_discovered(spark):
    rows = [(f"p{n}", a, v, None, n) for n in range(9) for a, v in (("n", str(n)), ("x", f"{n},5"), ("when", f"0{n + 1}.03.2030"), ("yes", "да"), ("say", "word"), ("fee", f"{n}00 EUR"))]
    assert wide_table.discover(spark.createDataFrame(rows, CELLS)) == {"n": "integer", "x": "decimal", "when": "date", "yes": "boolean", "say": "string", "fee": "quantity"}


def test_empty_wide_table(spark):
    df = spark.createDataFrame([], CELLS)
    types = wide_table.discover(df)
    assert types == {} and wide_table.widen(df, types).count() == 0 and wide_table.filled_cells(wide_table.widen(df, types), types).count() == 0


def test_bare_amounts_take_years_and_units_from_the_words_around(spark):
    got = statements(spark, [
        ("k", 1, "p", "tuition", "8000", "Fee in EUR for the whole course of 4 years: 8000."),
        ("k", 2, "q", "duration", "3", "Tuition: 500 EUR per semester; Duration: 3 years; Places: 30"),
        ("v", 3, "r", "duration", "18", "срок в месеци: 18"),
        ("v", 4, "s", "duration", "4", None),
        ("v", 5, "t", "duration", "8", "Такса за година: 900 лв; Срок на обучение"),
    ])
    assert got == {1: ("EUR/year", 2000.0), 2: ("year", 6.0), 3: ("month", 3.0), 4: ("semester", 4.0), 5: ("semester", 8.0)}
