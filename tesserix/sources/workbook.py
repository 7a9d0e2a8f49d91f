"""Workbooks (OOXML): one table per sheet in workbook order, as cells."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CELLS = T.StructType([T.StructField("ref", T.StringType()), T.StructField("t", T.IntegerType()), T.StructField("r", T.IntegerType()), T.StructField("c", T.IntegerType()), T.StructField("cell", T.StringType()), T.StructField("error", T.StringType())])
#: Built-in number formats and their decimals.
DECIMALS = {1: 0, 2: 2, 3: 0, 4: 2, 37: 0, 38: 0, 39: 2, 40: 2}


def column_index(ref: str) -> int:
    """0-based column of a cell address like AB12."""
    n = 0
    for ch in re.match(r"[A-Za-z]+", ref)[0].upper():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _local(node) -> str:
    return node.tag.rpartition("}")[2]


def _all(root, name: str):
    return (n for n in root.iter() if _local(n) == name)


def _said(node) -> str:
    return "".join(n.text or "" for n in node.iter() if _local(n) == "t")


def _formats(z: zipfile.ZipFile) -> list[int | None]:
    """Decimals shown by each cell style; None shows the stored text."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in _all(root, "numFmt")}
    styles = next(_all(root, "cellXfs"), None)
    out: list[int | None] = []
    for x in styles if styles is not None else ():
        k = int(x.get("numFmtId", 0))
        if k in custom:
            part = re.search(r"\.(0+)", custom[k])
            out.append(len(part[1]) if part else 0)
        else:
            out.append(DECIMALS.get(k))
    return out


def _sheets(z: zipfile.ZipFile) -> list[str]:
    relations = {n.get("Id"): n.get("Target") for n in _all(ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")), "Relationship")}
    out = []
    for s in _all(ElementTree.fromstring(z.read("xl/workbook.xml")), "sheet"):
        key = next(v for k, v in s.attrib.items() if k.rpartition("}")[2] == "id" and "}" in k)
        target = relations[key].lstrip("/")
        out.append(target if target.startswith("xl/") else f"xl/{target}")
    return out


def _sheet(root, shared: list[str], formats: list[int | None]) -> list[list[str]]:
    grid: dict[tuple[int, int], str] = {}
    for c in _all(root, "c"):
        ref = c.get("r")
        at = (int(re.search(r"\d+", ref)[0]) - 1, column_index(ref))
        kind = c.get("t")
        value = next((n.text for n in c if _local(n) == "v"), None)
        if kind == "inlineStr":
            text = _said(c)
        elif value is None:
            text = ""
        elif kind == "s":
            text = shared[int(value)]
        else:
            places = formats[int(c.get("s"))] if c.get("s") and int(c.get("s")) < len(formats) else None
            try:
                text = value if places is None or kind in ("str", "b", "e") else f"{float(value):.{places}f}"
            except ValueError:
                text = value
        grid[at] = " ".join(text.split())
    for m in _all(root, "mergeCell"):
        first, _, last = m.get("ref").partition(":")
        (r1, c1), (r2, c2) = ((int(re.search(r"\d+", x)[0]) - 1, column_index(x)) for x in (first, last or first))
        top = grid.get((r1, c1), "")
        for r in range(r1, r2 + 1):
            for c in range(c1, c2 + 1):
                # Only fills: a cell that says something keeps it.
                if top and not grid.get((r, c)):
                    grid[r, c] = top
    width = max((c for (_, c), v in grid.items() if v), default=-1) + 1
    rows = sorted({r for (r, _), v in grid.items() if v})
    return [[grid.get((r, c), "") for c in range(width)] for r in rows]


def read_workbook(content: bytes) -> list[list[list[str]]]:
    """Tables of rows of shown cell texts; ValueError for what is no workbook."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            shared = []
            if "xl/sharedStrings.xml" in z.namelist():
                shared = [_said(n) for n in _all(ElementTree.fromstring(z.read("xl/sharedStrings.xml")), "si")]
            formats = _formats(z)
            return [_sheet(ElementTree.fromstring(z.read(p)), shared, formats) for p in _sheets(z)]
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration) as e:
        raise ValueError(f"no workbook: {e}") from e


def workbook_cells(books: DataFrame, ref: str = "ref", content: str = "content") -> DataFrame:
    """Cells (ref, t, r, c, cell, error) of binary workbooks; a broken one gives a single row with its error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    tables = read_workbook(data or b"")
                except ValueError as e:
                    rows.append((name, None, None, None, None, str(e)))
                    continue
                rows.extend((name, t, r, c, cell, None) for t, table in enumerate(tables) for r, row in enumerate(table) for c, cell in enumerate(row))
            if rows:
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=CELLS.names)

    return books.select(ref, content).mapInArrow(read, CELLS)
