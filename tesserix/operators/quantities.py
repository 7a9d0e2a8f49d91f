"""Quantities stated in different units, brought to common ones.

Method: a hidden Markov model per device, here per (program, field) series of
statements in order of time.  The hidden state is the unit a statement is made
in (currency and period of a fee, period of a length of study).  What the text
says of its unit is evidence and makes the other states dear, most of all in the
value itself, less in the words around it; a fee with a currency and no period
leans to a year.  Between statements a change of unit costs something, and so
does a jump of the log value in common units from the level that the path has
smoothed over its statements so far.  Viterbi decodes the units of the whole
series, so the level settles what the words leave open.

The text is read in the JVM.  Series are decoded as streams of range-partitioned
sorted rows.  A path so much dearer than the best that a switch is cheaper can
never win again; once a single one is left all statements up to it are settled
and given out.  Statements that nothing settles are given out LAG later at the
latest, so memory doesn't grow with the series.  A hot series may span several
ranges (a range begins a series afresh).

Common units: euros per academic year, and semesters.  1 EUR is 1.95583 BGN; a
year is 2 semesters or 12 months; an amount for a whole course is divided by its
stated years.

Defined results: no number, a placeholder or a value not above zero gives null;
a series without any unit takes the likeliest (EUR per year, semesters).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.functions import quantity as q

#: State: (field, unit), common units in one of it, prior cost.
STATES = {
    "tuition": [("EUR/year", 1.0, 0.0), ("BGN/year", 1 / q.BGN_PER_EUR, 0.4), ("EUR/semester", 2.0, 0.7), ("BGN/semester", 2 / q.BGN_PER_EUR, 1.0), ("EUR/month", 12.0, 3.0), ("BGN/month", 12 / q.BGN_PER_EUR, 3.2)],
    "duration": [("semester", 1.0, 0.0), ("year", 2.0, 0.3), ("month", 1 / 6, 0.6)],
}
SWITCH = 0.5
#: Cost of a jump from the level by a factor e, and of any jump at most: values do change.
JUMP, MOST = 4.0, 2.5
#: Weight of a new statement in the level.
FRESH = 0.5
#: Cost of a unit other than the one said in the value, in the words around it, and other than a year where a currency is said alone.
SAID, AROUND, PLAIN = 9.0, 7.0, 6.0
#: Statements held at most while nothing settles their units.
LAG = 10_000
TOLERANCE = 0.01


def read_statements(rows: DataFrame) -> DataFrame:
    """Adds amount, years and what is said of the unit in the value (currency, period) and around it (near_currency, near_period) to (device, field, text, context) rows; null amounts for what states no quantity."""
    rows = rows.withColumn("text", F.when(~q.is_placeholder(F.col("text")), q.plain(F.col("text"))))
    # A bare amount: a number with or without words around it, but no currency and no unit of time.
    named = "|".join(p.replace("(?iu)", "") for p in (*q.CURRENCIES.values(), *q.PERIODS.values()))
    bare = F.coalesce(F.col("text").rlike(r"\d") & ~F.col("text").rlike(f"(?iu){named}"), F.lit(False))
    rows = rows.withColumn("context", F.when(bare, F.col("context")))
    rows = q.read_money(q.read_money(rows, "text", "fee"), "context", "around")
    # Of a bare duration's context the clause with its number counts, else the first without money: fees state periods as well.
    number = F.concat(F.lit(r"(?<![\d.,])\Q"), q.first_digits(F.col("text")), F.lit(r"\E(?!\d)"))
    money = "|".join(p.replace("(?iu)", "") for p in q.CURRENCIES.values())
    clauses = F.split("context", r"[;\n]|\. ")
    with_number = F.filter(clauses, lambda x: F.regexp_like(x, number))
    with_unit = F.filter(clauses, lambda x: x.rlike(q.LENGTH_UNIT) & ~x.rlike(f"(?iu){money}"))
    clause = F.coalesce(F.try_element_at(with_number, F.lit(1)), F.try_element_at(with_unit, F.lit(1)))
    rows = rows.withColumn("__clause", F.when(F.col("field") == "duration", clause))
    rows = q.read_span(q.read_span(rows, "text", "length"), "__clause", "lasting").drop("__clause")
    is_fee = F.col("field") == "tuition"
    amount = F.when(is_fee, F.when(F.col("fee.currency").isNotNull() | bare, F.col("fee.amount"))).when(F.col("length.period").isNotNull() | bare, F.col("length.amount"))
    rows = rows.withColumns({"amount": F.when(amount > 0, amount), "period": F.when(is_fee, F.col("fee.period")).otherwise(F.col("length.period")), "near_period": F.when(is_fee, F.col("around.period")).otherwise(F.col("lasting.period"))})
    # An amount for a whole course, divided by its years, is one per year.
    whole = is_fee & (F.coalesce("period", "near_period") == "course")
    return rows.withColumns(
        {
            "currency": F.when(is_fee, F.col("fee.currency")),
            "near_currency": F.when(is_fee, F.col("around.currency")),
            "period": F.when(F.col("period") == "course", "year").otherwise(F.col("period")),
            "near_period": F.when(F.col("near_period") == "course", "year").otherwise(F.col("near_period")),
            "years": F.when(whole, F.coalesce("fee.years", "around.years", F.lit(1.0))).otherwise(F.lit(1.0)),
        }
    )


class Decoder:
    """Viterbi over one series, giving out rows as soon as their states are settled."""

    def __init__(self, field: str):
        self.states = [(name, math.log(f), prior, *name.rpartition("/")[::2]) for name, f, prior in STATES[field]]
        self.costs: list[float] | None = None
        self.levels: list[float] = []
        self.back: list[list[int]] = []
        self.rows: list[tuple] = []

    def evidence(self, currency: str | None, period: str | None, near_currency: str | None = None, near_period: str | None = None) -> list[float]:
        """Cost of each state by what is said of the unit."""
        plain = (currency or near_currency) and not (period or near_period)
        out = []
        for _, _, prior, money, per in self.states:
            cost = 0.1 * prior
            for said, unit, weight in ((currency, money, SAID), (near_currency, money, AROUND), (period, per, SAID), (near_period, per, AROUND)):
                cost += weight * bool(said and unit and said != unit)
            out.append(cost + PLAIN * bool(plain and money and per != "year"))
        return out

    def push(self, row: tuple, amount: float, currency: str | None, period: str | None, years: float, near_currency: str | None = None, near_period: str | None = None) -> Iterator[tuple]:
        cost = self.evidence(currency, period, near_currency, near_period)
        log = math.log(amount / years)
        states = range(len(self.states))
        here = [log + s[1] for s in self.states]
        if self.costs is None:
            self.costs, levels, back = [c + 0.9 * s[2] for c, s in zip(cost, self.states, strict=True)], here, [-1] * len(here)
        else:
            costs, levels, back = [], [], []
            alive = [j for j in states if self.costs[j] < math.inf]
            for k in states:
                at = here[k]
                best, j = min((self.costs[j] + min(MOST, JUMP * abs(at - self.levels[j])) + (SWITCH if j != k else 0.0), j) for j in alive)
                costs.append(best + cost[k])
                levels.append((1 - FRESH) * self.levels[j] + FRESH * at)
                back.append(j)
            self.costs = costs
        self.rows.append((row, here))
        self.back.append(back)
        self.levels = levels
        least = min(self.costs)
        self.costs = [c - least if c - least <= SWITCH + MOST else math.inf for c in self.costs]
        if sum(c < math.inf for c in self.costs) == 1 or len(self.rows) >= LAG:
            yield from self.settle()

    def settle(self) -> Iterator[tuple]:
        """Rows held so far with their decoded unit and common value."""
        if not self.rows:
            return
        k = best = min(range(len(self.states)), key=lambda s: self.costs[s])
        path = []
        for back in reversed(self.back):
            path.append(k)
            k = back[k]
        for (row, here), s in zip(self.rows, reversed(path), strict=True):
            yield (*row, self.states[s][0], math.exp(here[s]))
        self.rows, self.back = [], []
        self.costs = [0.0 if s == best else math.inf for s in range(len(self.states))]


DECODED = T.StructType([T.StructField("device", T.StringType()), T.StructField("field", T.StringType()), T.StructField("src", T.StringType()), T.StructField("row_id", T.LongType()), T.StructField("unit", T.StringType()), T.StructField("value", T.DoubleType())])


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (device, field, src, row_id, amount, currency, period, years, near_currency, near_period), sorted by device, field and time."""
    schema = pa.schema([("device", pa.string()), ("field", pa.string()), ("src", pa.string()), ("row_id", pa.int64()), ("unit", pa.string()), ("value", pa.float64())])
    series = decoder = None
    for b in batches:
        out: list[tuple] = []
        for device, field, src, row_id, amount, *said in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if amount is None:
                continue
            if (device, field) != series:
                if decoder is not None:
                    out.extend(decoder.settle())
                series, decoder = (device, field), Decoder(field)
            out.extend(decoder.push((device, field, src, row_id), amount, *said))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if decoder is not None and (out := list(decoder.settle())):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def common_units(rows: DataFrame) -> DataFrame:
    """(device, field, src, row_id, unit, value) of the statements (device, field, text, context, stamp, src, row_id) that state a quantity."""
    # Rows without an amount are left to the decoder: a filter here would be pushed into the parsing, whole expressions with it.
    stated = read_statements(rows.where(F.col("device").isNotNull() & F.col("field").isin(*STATES)))
    order = ("device", "field", "stamp", "src", "row_id")
    # The exchange carries the parsed fields only.
    narrow = stated.select("device", "field", "src", "row_id", "amount", "currency", "period", "years", "near_currency", "near_period", "stamp")
    return narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("stamp").mapInArrow(_decode, DECODED)


def equal_statements(left: DataFrame, right: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(device, field, left_id, right_id) of statements that are equal within the tolerance of the larger.

    A band join: log values fall into buckets one tolerance wide, the left side
    stands in its own bucket and both neighbours, so the join is an equi-join
    that spreads a hot device over its values.
    """
    width = -math.log(1 - tolerance)
    bucket = F.floor(F.log("value") / F.lit(width))
    a = left.select("device", "field", F.col("row_id").alias("left_id"), F.col("value").alias("a"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
    b = right.select("device", "field", F.col("row_id").alias("right_id"), F.col("value").alias("b"), bucket.alias("bucket"))
    near = F.abs(F.col("a") - F.col("b")) <= F.lit(tolerance) * F.greatest("a", "b") * F.lit(1 + 1e-9)
    return a.join(b, ["device", "field", "bucket"]).where(near).select("device", "field", "left_id", "right_id")
