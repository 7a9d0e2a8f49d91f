"""Numbers, units and typed values out of text, as Columns.

Everything here stays in the JVM: no Python is called per row.  Null and text
without the thing asked for give null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks that group digits: no-break, thin, narrow no-break and figure spaces count as U+0020.
_BLANKS = "[\\u00A0\\u2007\\u2009\\u202F\\t\\n\\r]"
_NUMBER = r"(\d{1,3}(?:[ .,]\d{3})+(?!\d)(?:[.,]\d{1,2}(?!\d))?|\d+(?:[.,]\d+)?)"

#: Units and their wording.
CURRENCIES = {"EUR": r"(?iu)€|\beur\b|\beuro\b|(?<!\p{L})евро(?!\p{L})", "BGN": r"(?iu)\bbgn\b|\blv\b|\bleva\b|(?<!\p{L})(лв|лева|лев)(?!\p{L})"}
PERIODS = {
    "course": r"(?iu)целия курс|whole course|entire course",
    "semester": r"(?iu)семест|semest|(?<!\p{L})сем\.",
    "month": r"(?iu)месец|(?<!\p{L})мес\.|\bmonth",
    "year": r"(?iu)годин|годиш|\byear|\bannual|(?<!\p{L})г\.",
}
THOUSANDS = r"(?iu)(?<!\p{L})хил(?:яди|\.)?|\bthousand|\d ?k\b"
BGN_PER_EUR = 1.95583
SEMESTERS = {"semester": 1.0, "year": 2.0, "month": 1 / 6}
NUMBER_WORDS = {
    1: "един|една|едно|one", 2: "две|два|two", 3: "три|three", 4: "четири|four", 5: "пет|five", 6: "шест|six",
    7: "седем|seven", 8: "осем|eight", 9: "девет|nine", 10: "десет|ten", 11: "единадесет|eleven", 12: "дванадесет|twelve",
}
ROMAN = {1: "I", 2: "II", 3: "III", 4: "IV", 5: "V", 6: "VI", 7: "VII", 8: "VIII", 9: "IX", 10: "X", 11: "XI", 12: "XII"}
PLACEHOLDERS = ("", "-", "–", "—", "?", "n/a", "na", "tbd", "not stated", "няма данни", "none", "null")
MONTHS = (
    ("януари", "january", "jan"), ("февруари", "february", "feb"), ("март", "march", "mar"), ("април", "april", "apr"),
    ("май", "may", "may"), ("юни", "june", "jun"), ("юли", "july", "jul"), ("август", "august", "aug"),
    ("септември", "september", "sep"), ("октомври", "october", "oct"), ("ноември", "november", "nov"), ("декември", "december", "dec"),
)


def plain(text: Column) -> Column:
    """Blanks made ordinary, runs of them one, outer ones cut."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, _BLANKS, " "), " +", " "))


def is_placeholder(text: Column) -> Column:
    """Null, empty, a stand-in for no value, or a cell judged by hand."""
    t = F.lower(plain(text))
    return t.isNull() | t.isin(*PLACEHOLDERS) | t.startswith("hand-judged")


def _lookup(word: Column, values: dict) -> Column:
    """Value of a word in a fixed table; null for others."""
    pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
    return F.try_element_at(F.create_map(*pairs), word)


def to_number(digits: Column, scaled: Column | None = None) -> Column:
    """A written number as double; groups of three digits are thousands, unless a scale word follows."""
    grouped = digits.rlike(r"^\d{1,3}([ .,]\d{3})+$")
    if scaled is not None:
        grouped = grouped & ~(scaled & digits.rlike(r"^\d{1,3}[.,]\d{3}$"))
    # 1 234,56 and 1,234.56: the last mark before one or two digits is the decimal one.
    decimal = F.regexp_replace(F.regexp_replace(digits, r"[.,](?=\d+$)", "#"), "[ .,]", "")
    return F.when(grouped, F.regexp_replace(digits, "[ .,]", "").try_cast("double")).otherwise(F.regexp_replace(decimal, "#", ".").try_cast("double"))


def first_digits(text: Column) -> Column:
    """The first written number, as text; '' where there is none."""
    return F.regexp_extract(text, _NUMBER, 1)


def unit_of(text: Column, units: dict[str, str]) -> Column:
    """First unit in the order given whose wording stands in the text."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(units.items()):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


#: Mentions of an academic year, an order or a year of study: no period and no amount.
_ASIDE = r"(?iu)(за учебната|for) 20\d\d ?/ ?20\d\d( г\.)?|съгласно заповед.*$|under order.*$|за \d-ви курс|for first-year.*$|редовно обучение|full-time|part-time"
_SPELT = {w: float(k) for k, words in NUMBER_WORDS.items() for w in words.split("|")} | {r.lower(): float(k) for k, r in ROMAN.items()}
_SPELT_PATTERN = r"(?<![\p{L}\d])((?iu:" + "|".join("|".join(w.split("|")) for w in reversed(NUMBER_WORDS.values())) + ")|" + "|".join(reversed(ROMAN.values())) + r")(?![\p{L}\d])"
LENGTH_UNIT = r"(?iu)(месец|мес\.|month|семест|semest|сем\.|годин|годиш|year|(?<!\p{L})г\.)"
_LENGTH_PERIODS = {k: v for k, v in PERIODS.items() if k != "course"}


def read_money(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the struct `out` (amount, currency, period, years): an amount as written, its scale applied.

    The parts the text doesn't say are null.  Built in steps, so that no
    expression is repeated inside another.
    """
    t, core, digits, scaled = (f"__{out}_{x}" for x in ("text", "core", "digits", "scaled"))
    df = df.withColumn(t, plain(F.col(text)))
    df = df.withColumns({core: F.regexp_replace(t, _ASIDE, ""), scaled: F.col(t).rlike(THOUSANDS)})
    df = df.withColumn(digits, first_digits(F.col(core)))
    amount = F.when(F.col(digits) != "", to_number(F.col(digits), F.col(scaled)) * F.when(F.col(scaled), 1000.0).otherwise(1.0))
    years = F.regexp_extract(core, r"(?iu)(?:целия курс|whole course|entire course)[^\d]*(\d+)", 1).try_cast("double")
    made = F.struct(amount.alias("amount"), unit_of(F.col(core), CURRENCIES).alias("currency"), unit_of(F.col(core), PERIODS).alias("period"), years.alias("years"))
    return df.withColumn(out, made).drop(t, core, digits, scaled)


def read_span(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the struct `out` (amount, period): a length of study as first stated, in digits, words or Roman numerals, with halves."""
    t, digits, spelt, unit = (f"__{out}_{x}" for x in ("text", "digits", "spelt", "unit"))
    df = df.withColumn(t, plain(F.col(text)))
    # The unit next to the number counts, not one that follows in brackets or after a slash.
    df = df.withColumns({digits: first_digits(F.col(t)), spelt: F.lower(F.regexp_extract(t, _SPELT_PATTERN, 1)), unit: F.regexp_extract(t, LENGTH_UNIT, 1)})
    half = F.when(F.col(t).rlike(r"(?iu)и половина|and a half"), 0.5).otherwise(0.0)
    amount = F.coalesce(F.when(F.col(digits) != "", to_number(F.col(digits))), _lookup(F.col(spelt), _SPELT)) + half
    made = F.struct(amount.alias("amount"), F.when(F.col(unit) != "", unit_of(F.col(unit), _LENGTH_PERIODS)).alias("period"))
    return df.withColumn(out, made).drop(t, digits, spelt, unit)


def states_quantity(text: Column) -> Column:
    """True where a plain text states an amount of money or time: a number with its unit, or a bare number."""
    money = r"(?iu)^[^\p{L}\d]*[\d .,]+$|\d.*(€|eur|евро|bgn|\blv\b|leva|(?<!\p{L})(лв|лева|лев)(?!\p{L}))|(€|eur|евро|bgn|leva|лева|лв).*\d"
    number = r"(\d|" + _SPELT_PATTERN + ")"
    return text.rlike(money) | text.rlike(number + r".*" + LENGTH_UNIT.replace("(?iu)(", "(?iu:", 1))


def integer_value(text: Column) -> Column:
    """A whole number, possibly written with .0 and followed by a unit word."""
    t = plain(text)
    return F.regexp_extract(t, r"^(\d+)(?:[.,]0+)?(?: ?[\p{L}.]+){0,2}$", 1).try_cast("long")


def decimal_value(text: Column) -> Column:
    t = plain(text)
    found = F.regexp_replace(F.regexp_extract(t, r"^(\d+(?:[.,]\d+)?)(?: ?[\p{L}.]+){0,2}$", 1), ",", ".")
    return found.try_cast("decimal(18,4)")


def boolean_value(text: Column) -> Column:
    t = F.lower(plain(text))
    return F.when(t.isin("yes", "true", "1", "да", "y"), F.lit(True)).when(t.isin("no", "false", "0", "не", "n"), F.lit(False))


def date_value(text: Column) -> Column:
    """A calendar date written in one of the usual orders; dates that don't exist give null."""
    t = F.lower(F.regexp_replace(plain(text), r"(?iu) ?г\.?$", ""))
    month = _lookup(F.regexp_extract(t, r"(?u)(\p{L}+)", 1), {name: f"{k:02d}" for k, names in enumerate(MONTHS, 1) for name in dict.fromkeys(names)})

    def iso(y: Column, m: Column, d: Column) -> Column:
        return F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0")).try_cast("date")

    part = F.regexp_extract
    return (
        F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), iso(part(t, r"^(\d{4})", 1), part(t, r"-(\d{1,2})-", 1), part(t, r"-(\d{1,2})$", 1)))
        .when(t.rlike(r"^\d{1,2}[./]\d{1,2}[./]\d{4}$"), iso(part(t, r"(\d{4})$", 1), part(t, r"[./](\d{1,2})[./]", 1), part(t, r"^(\d{1,2})", 1)))
        .when(t.rlike(r"(?u)^\d{1,2} \p{L}+ \d{4}$"), iso(part(t, r"(\d{4})$", 1), month, part(t, r"^(\d{1,2})", 1)))
        .when(t.rlike(r"(?u)^\p{L}+ \d{1,2}, \d{4}$"), iso(part(t, r"(\d{4})$", 1), month, part(t, r" (\d{1,2}),", 1)))
    )


def key_id(text: Column) -> Column:
    """Ids compared trimmed and in lower case."""
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def key_name(text: Column) -> Column:
    """Names compared trimmed, in lower case, with _ for blanks and hyphens inside."""
    return F.regexp_replace(key_id(text), r"[\s\-]+", "_")
