"""Text policy as Columns: blanks, the comparison form, tokens and snippets.

Only the Unicode composition and case folding of the comparison form leave the
JVM, batch-wise through Arrow.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marks folded in the comparison form.
DOUBLE_QUOTES = "„“”‟«»‹›″"
APOSTROPHES = "‘’‚‛`´ʼʹ′"
DASHES = "‐‑‒–—―−"
CURRENCY_TOKENS = ("€", "евро", "лева", "leva", "eur", "bgn", "лв")
PREFIX = 5
PLACEHOLDERS = ("-", "–", "—", "n/a", "na")

_FOLD = str.maketrans(dict.fromkeys(DOUBLE_QUOTES, '"') | dict.fromkeys(APOSTROPHES, "'") | dict.fromkeys(DASHES, "-"))
#: Python's idea of a blank, spelt out for the JVM.
_SPACE = "[\\s\\u001C-\\u001F\\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"


def norm(text: Column) -> Column:
    """Runs of blanks of any kind made one space, outer ones cut; null gives ''; case kept."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " "))


def comparison_form(text: str | None) -> str:
    """Composed, quotes, apostrophes and dashes folded, case folded, blanks made one."""
    return " ".join(unicodedata.normalize("NFC", text or "").translate(_FOLD).casefold().split())


@F.arrow_udf(T.StringType())
def normalize(texts: pa.Array) -> pa.Array:
    """Column form of comparison_form; null gives ''."""
    return pa.array([comparison_form(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def normalize_all(lists: pa.Array) -> pa.Array:
    """comparison_form of every element; empty results dropped; null gives an empty list."""
    return pa.array([[x for t in row or [] if (x := comparison_form(t))] for row in lists.to_pylist()], pa.list_(pa.string()))


def number_tokens(form: Column) -> Column:
    """Numbers of a comparison form without their separators (6.5 and 65 are the same), empties dropped."""
    found = F.regexp_extract_all(form, F.lit(r"(\d[\d.,]*)"), 1)
    return F.filter(F.array_distinct(F.transform(found, lambda x: F.translate(x, ".,", ""))), lambda x: x != "")


def word_tokens(form: Column) -> Column:
    """Runs of letters, currency words left out."""
    found = F.array_distinct(F.regexp_extract_all(form, F.lit(r"(\p{L}+)"), 1))
    return F.filter(found, lambda x: ~x.isin(*[c for c in CURRENCY_TOKENS if c != "€"]))


def currency_tokens(form: Column) -> Column:
    return F.array_compact(F.array(*[F.when(form.contains(c), F.lit(c)) for c in CURRENCY_TOKENS]))


def snippet_around(text: Column, start: Column, end: Column, pad: int = 90) -> Column:
    """The text around [start, end) (0-based), clamped and normed."""
    first = F.greatest(start - pad, F.lit(0))
    return norm(F.substring(text, first + 1, end + pad - first))


def is_placeholder(cell: Column) -> Column:
    return F.lower(F.trim(cell)).isin(*PLACEHOLDERS)


def emitted(segments: Column) -> Column:
    """Segments without empty ones."""
    return F.filter(segments, lambda s: F.coalesce(s, F.lit("")) != "")


def quoted(text: Column) -> Column:
    """A literal inside a Java regular expression, whatever it holds."""
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def extract(text: Column, pattern: Column, group: int) -> Column:
    """regexp_extract with a pattern that differs from row to row."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def base_name(name: Column) -> Column:
    """A name without a parenthesis at its end."""
    return F.trim(F.regexp_replace(name, r"\s*\([^()]*\)\s*$", ""))


def names(text: Column, name: Column) -> Column:
    """True where the text says the name or its base name, bounded by non-letters, in any case."""

    def said(x: Column) -> Column:
        return F.regexp_like(text, F.concat(F.lit("(?iu)(?<!\\p{L})"), quoted(x), F.lit("(?!\\p{L})")))

    return F.coalesce(said(name) | said(base_name(name)), F.lit(False))
