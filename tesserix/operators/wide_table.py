"""Attribute-value rows into one wide, typed row per entity.

Method: the attribute list and the types are discovered first, by one small
aggregation; then the pivot is one conditional aggregation per attribute, with
duplicates resolved explicitly (newest stamp, then larger id, even if that row
has no value) and the winner cast.

Types: integer, decimal, date, boolean, quantity and string.  Declared types
hold for their attributes; others get the type that nearly all their values fit.

The aggregation groups by entity with map-side reduction, so an entity with any
number of repeated rows costs one row per task.  The number of attributes is
checked against MAX_ATTRIBUTES, because each becomes a column.

Defined results: rows with a null entity or attribute take no part; null, empty
and placeholder values and values unfit for the type give null; an entity all of
whose cells are null keeps its row; a stamp of null is older than any other.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserix.functions import quantity as q

MAX_ATTRIBUTES = 2_000
#: Share of the filled values that must fit for a type to be discovered.
FIT = 0.8
CASTS = {
    "integer": q.integer_value,
    "decimal": q.decimal_value,
    "date": q.date_value,
    "boolean": q.boolean_value,
}


def typed(text: Column, kind: str) -> Column:
    """A value cast to its type; a quantity stays as written, blanks made plain, where it states one."""
    value = F.when(~q.is_placeholder(text), text)
    if kind == "quantity":
        return F.when(q.states_quantity(q.plain(value)), q.plain(value))
    if kind == "string":
        return q.plain(value)
    return CASTS[kind](value)


def discover(rows: DataFrame, declared: dict[str, str] | None = None) -> dict[str, str]:
    """Attribute to type, of (entity, attribute, value, ...) rows: one row per attribute comes to the driver."""
    declared = declared or {}
    v = F.col("value")
    rows = rows.where("attribute is not null").select("attribute", F.when(~q.is_placeholder(v), q.plain(v)).alias("value"))
    # Booleans before integers: a column of yes, no and 1 is no number; amounts with units of money or time before both.
    order = ("boolean", "date", "quantity", "integer", "decimal")
    quantity = q.states_quantity(v) & v.rlike(r"[\p{L}€]")
    fit = rows.select("attribute", F.col("value").isNotNull().alias("filled"), *[F.coalesce(quantity if k == "quantity" else CASTS[k](v).isNotNull(), F.lit(False)).alias(k) for k in order])
    found = fit.groupBy("attribute").agg(*[F.count_if(k).alias(k) for k in ("filled", *order)]).orderBy("attribute").limit(MAX_ATTRIBUTES + 1).collect()
    if len(found) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes; give them as a list or keep the rows long")
    types = {}
    for r in found:
        kind = declared.get(r["attribute"])
        types[r["attribute"]] = kind or next((k for k in order if r["filled"] and r[k] >= FIT * r["filled"]), "string")
    return types


def widen(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row per entity; rows are (entity, attribute, value, stamp, id)."""
    rank = F.struct(F.col("stamp"), F.col("id"), F.col("value"))
    cells = [F.max(F.when(F.col("attribute") == a, rank)).alias(f"c{k}") for k, a in enumerate(types)]
    if not cells:
        return rows.where("entity is not null").select("entity").distinct()
    wide = rows.where("entity is not null").groupBy("entity").agg(*cells)
    return wide.select("entity", *[typed(F.col(f"c{k}.value"), kind).alias(column_name(a)) for k, (a, kind) in enumerate(types.items())])


def column_name(attribute: str) -> str:
    """A safe column name that never clashes with `entity`."""
    name = re.sub(r"\W+", "_", attribute)
    return f"{name}_" if name == "entity" else name


def filled_cells(wide: DataFrame, types: dict[str, str]) -> DataFrame:
    """(entity, attribute) of every cell that is not null."""
    if not types:
        return wide.select("entity", F.lit(None).cast("string").alias("attribute")).where("false")
    names = F.array(*[F.when(F.col(column_name(a)).isNotNull(), F.lit(a)) for a in types])
    return wide.select("entity", F.explode(F.array_compact(names)).alias("attribute"))
