"""Spans of a shared page that belong to one programme.

Occurrences of all names are found, one inside a longer name's falls, headings in
capitals anchor alone where there are any, a span runs to the next occurrence of
another name or `WINDOW` characters, and overlapping spans merge.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 2500
_THIN = "​﻿"


def find_all(text: str, name: str) -> list[int]:
    """Starts of a name, overlapping ones too, where no letter stands on either side."""
    out, at = [], text.find(name) if name else -1
    while at >= 0:
        end = at + len(name)
        if not (at and text[at - 1].isalpha()) and not (end < len(text) and text[end].isalpha()):
            out.append(at)
        at = text.find(name, at + 1)
    return out


def is_heading(text: str, at: int, size: int) -> bool:
    """An occurrence in capitals that has its line to itself."""
    said = text[at : at + size]
    if said != said.upper() or not any(c.isalpha() for c in said):
        return False
    begin, end = text.rfind("\n", 0, at) + 1, text.find("\n", at)
    line = text[begin : end if end >= 0 else len(text)]
    return line.translate(dict.fromkeys(map(ord, _THIN))).strip() == said.strip()


def region_spans(text: str | None, name: str | None, siblings: list[str] | None, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans [start, end) of the raw text; none where the name doesn't occur."""
    if not text or not name:
        return []
    low = text.lower()
    fold = str.lower if len(low) == len(text) else str
    hay = fold(text)
    own = fold(name)
    others = {fold(s) for s in siblings or [] if s} - {own}
    places = [(p, p + len(n), n) for n in {own, *others} for p in find_all(hay, n)]
    kept = [(s, e, n) for s, e, n in places if not any(len(m) > len(n) and s2 <= s and e <= e2 for s2, e2, m in places)]
    anchors = sorted(s for s, _, n in kept if n == own)
    headings = [s for s in anchors if is_heading(text, s, len(own))]
    anchors = headings or anchors
    borders = sorted(s for s, _, n in kept if n != own)
    spans: list[tuple[int, int]] = []
    for a in anchors:
        end = min(next((b for b in borders if b > a), len(text)), a + window)
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((a, end))
    return spans


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


@F.arrow_udf(SPANS)
def spans(texts: pa.Array, names: pa.Array, siblings: pa.Array) -> pa.Array:
    """Column form of region_spans over (text, name, siblings)."""
    rows = zip(texts.to_pylist(), names.to_pylist(), siblings.to_pylist(), strict=True)
    return pa.array([[{"start": a, "end": b} for a, b in region_spans(*r)] for r in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def scoped(text: Column, found: Column) -> Column:
    """The texts of the spans, in order."""
    return F.transform(found, lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]))
