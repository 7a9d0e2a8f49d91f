"""Main body of rendered pages: furniture lines found by nearest-URL page differencing.

Method: the addresses of a host are sorted by URL path; each page is aligned with
the NEAREST addresses before and after its own by longest common subsequence of
lines, and the lines that pages near each other share fall.  No wording is known
to the module; without a shared line a page loses nothing.

Site templates share more than furniture: headings of the body and stock sentences
recur as well.  An exact check tells them apart by where a line stands in the pages
around (WINDOW addresses to each side): a body heading is followed by a line of the
body nearly always, a stock sentence comes after one mostly; a cookie notice, a
share prompt, a byline or a box heading stands anywhere.  Furniture whose wording
varies falls by what the alignment found next to it or under the same first words:
the items of a box after its aligned heading, lines that begin like aligned ones,
the rest of a block most of which is aligned, running heads beside page numbers.

Lines are compared in their repaired and unified form (mojibake, lookalike)
with digits masked, so a garbled footer still meets its neighbour's.

No host and no address is held in one task.  The sorted addresses are cut into
chunks of bounded size; each chunk gets its pages and, of the addresses around
it, one rendering for each renderer, since the furniture depends on it.  An
address larger than a chunk is cut into salted chunks, each with the same
neighbours.  Every page meets its whole neighbourhood, whatever the partitions
are; re-renderings of one address never pair with each other.

Defined results: null text has no rows; a page without a neighbour or without a
line shared with one keeps all its lines; a null address is its own host.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.functions.urls import path_of, site_of
from tesserix.llm.codepoints import slices
from tesserix.llm.lookalike import unify_array
from tesserix.llm.mojibake import repair_array
from tesserix.session import write_once

#: Addresses to each side that a page is aligned with.
NEAREST = 32
#: Addresses to each side whose lines tell where a recurring line stands.
WINDOW = 128
#: Pages in a chunk; a page counts one more for every 16,384 characters.
CHUNK = 2048
#: Addresses with an aligned copy of a line before it counts as shared, its own included.
SHARED_BY = 2
#: Share of the addresses around at which the line in the title's place must be aligned to be none.
OFTEN = 0.04
#: Share of a heading's copies that a line of the body follows, and the most that may end their block.
HEADS_BODY, ENDS_BLOCK = 0.8, 0.05
#: Share of a stock sentence's copies that follow a line of the body.
IN_BODY = 0.6
#: The same of lines that only begin like aligned ones.
BEGUN_IN_BODY = 0.5
#: Copies around from which these shares are taken; with fewer the line's own place decides.
SEEN = 4

_DIGITS = re.compile(r"\d+")
_ITEM = re.compile(r"[-–—•▪*] .*[^\W\d_]")
_FACTS = re.compile(r"\w: ?\S.*; \w")
_ROW = re.compile(r"[\d.,]+ [\d.,]+$")


def shared_lines(a: list, where: dict) -> list[int]:
    """Positions in `a` of a longest common subsequence with the lines at the places `where` (matching pairs and patience, not a full table)."""
    tails: list[int] = []
    nodes: list[tuple[int, int]] = []
    last: list[int] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(tails, j)
            nodes.append((i, last[k - 1] if k else -1))
            if k == len(tails):
                tails.append(j)
                last.append(len(nodes) - 1)
            else:
                tails[k] = j
                last[k] = len(nodes) - 1
    out = []
    n = last[-1] if last else -1
    while n >= 0:
        i, n = nodes[n]
        out.append(i)
    return out[::-1]


def places(lines: list) -> dict:
    """Where each line stands; blank lines (0) nowhere."""
    out: dict = {}
    for j, line in enumerate(lines):
        if line:
            out.setdefault(line, []).append(j)
    return out


def _digest(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") or 1


def _sentence(x: str) -> bool:
    end = x.rstrip("»”\"')")
    return x[-1] == ";" or x.count(" ") >= (3 if end[-1:] == "." else 4) and end[-1:] in {".", "!", "?"} and not end.endswith("...")


def _of_body(x: str, raw: str) -> bool:
    """Sentences, list items, facts and rows of tables, by their shape alone."""
    return _sentence(x) or "\t" in raw or bool(_ITEM.match(x)) or bool(_FACTS.search(x)) or "|" not in x and bool(_ROW.search(x))


def _title_like(x: str) -> bool:
    return x[-1] not in ".;:!?," and ": " not in x and " | " not in x and x.count(" ") <= 9


def _head(masked: str) -> str:
    """The first words of a line: up to a colon among the first three, else two."""
    words = masked.split(" ", 3)
    for n, w in enumerate(words[:3], 1):
        if w.endswith(":"):
            return " ".join(words[:n])
    return " ".join(words[:2])


class Page:
    """A text as line keys (0 for blank lines), the keys of their first words, and where each line stands."""

    __slots__ = ("lines", "keys", "heads", "body", "after_body", "before_body", "ends", "places")

    def __init__(self, text: str):
        raw = text.split("\n")
        self.lines = x = [" ".join(line.split()) for line in raw]
        masked = [_DIGITS.sub("#", line) for line in x]
        self.keys = [_digest(m) if m else 0 for m in masked]
        self.heads = [_digest("\n" + _head(m)) if m else 0 for m in masked]
        self.body = [bool(line) and _of_body(line, r) for line, r in zip(x, raw, strict=True)]
        self.after_body = [False, *self.body[:-1]]
        self.before_body = [*self.body[1:], False]
        self.ends = [not line for line in [*x[1:], ""]]
        self.places = places(self.keys)


class Around:
    """Counts over the pages of a sliding window of addresses: where the copies of a line, and of lines that begin alike, stand."""

    def __init__(self):
        self.lines: dict[int, list[int]] = {}  # copies, of the body, after one of the body, before one, ending a block
        self.aligned: Counter = Counter()  # addresses with an aligned copy, or one of a line that begins so

    def move(self, pages: list[Page], aligned: set[int], sign: int) -> None:
        lines = self.lines
        for p in pages:
            for k, h, *flags in zip(p.keys, p.heads, p.body, p.after_body, p.before_body, p.ends, strict=True):
                if k:
                    for key in (k, h):
                        v = lines.get(key)
                        if v is None:
                            v = lines[key] = [0] * 5
                        v[0] += sign
                        for n, flag in enumerate(flags, 1):
                            if flag:
                                v[n] += sign
                        if not v[0]:
                            del lines[key]
        counts = self.aligned
        for k in aligned:
            counts[k] += sign
            if not counts[k]:
                del counts[k]


def _heads_body(v: list[int]) -> bool:
    return v[3] >= HEADS_BODY * v[0] and v[4] <= ENDS_BLOCK * v[0]


def furniture(p: Page, own: set[int], around: Around, addresses: int) -> dict[int, str]:
    """Line index to the kind of furniture.

    `own` holds the indexes that the alignment with the nearest pages found,
    `around` what the window's pages say of their lines, of `addresses` addresses.
    """
    if not own:
        return {}
    n, x, body = len(p.lines), p.lines, p.body
    lines, aligned = around.lines, around.aligned
    none = [0] * 5
    of_line = [lines.get(k, none) for k in p.keys]
    of_head = [lines.get(h, none) for h in p.heads]

    def heading(i: int) -> bool:
        if body[i]:
            return of_line[i][0] >= SEEN and of_line[i][3] == of_line[i][0]  # the head of a table
        if not _title_like(x[i]):
            return False
        known = next((v for v in (of_line[i], of_head[i]) if v[0] >= SEEN), None)
        return _heads_body(known) if known else p.before_body[i] and not x[i][-1].isdigit()

    def known_heading(i: int) -> bool:
        return _title_like(x[i]) and any(v[0] >= SEEN and _heads_body(v) and v[1] <= 0.5 * v[0] for v in (of_line[i], of_head[i]))

    # The page's title: above its first line of the body; it meets the same title elsewhere now and then, furniture does so often.
    titled = next((i for i in range(n) if body[i]), 0) - 1
    while titled >= 0 and x[titled] and (not _title_like(x[titled]) or x[titled][-1].isdigit() or aligned[p.keys[titled]] >= max(SHARED_BY, OFTEN * addresses)):
        titled -= 1
    out: dict[int, str] = {}
    for i in range(n - 1, -1, -1):
        k = p.keys[i]
        # Shared: aligned here or moved out of order, and aligned at enough addresses around; a notice has no heading.
        if k and (out.get(i + 1) == "notice" or not heading(i)) and aligned[k] >= SHARED_BY:
            if not body[i]:
                if i != titled:
                    out[i] = "shared"
            elif _sentence(x[i]) and not _ITEM.match(x[i]) and of_line[i][0] >= SEEN and of_line[i][2] <= IN_BODY * of_line[i][0]:
                out[i] = "notice"
        # Numbered in the text itself, as printed pages are, and aligned anywhere around.
        elif k and aligned[k] and not body[i] and len({x[j] for j in p.places[k]}) > 1:
            out[i] = "shared"
    first = next((i for i in range(n) if body[i] and i not in out), n)
    # The items of a box: what follows an aligned line of no body, up to a line of the body or one known to head it.
    i = first + 1
    while i < n:
        i += 1
        if out.get(i - 1) == "shared":
            while i < n and x[i] and not body[i] and not known_heading(i):
                out.setdefault(i, "box")
                i += 1
    # Lines that begin like aligned ones.
    for i in range(n):
        if x[i] and i not in out and aligned[p.heads[i]] >= SHARED_BY and not heading(i):
            v = of_head[i]
            if v[2] <= BEGUN_IN_BODY * v[0] and not _heads_body(v) and (": " in x[i] and not _FACTS.search(x[i]) or not body[i] and (i > first or v[4] >= 0.3 * v[0])):
                out[i] = "begun"
    # The rest of a run of lines most of which is aligned.
    run: list[int] = []
    for i in range(n + 1):
        if i < n and x[i] and not body[i]:
            run.append(i)
            continue
        rest = [k for k in run if k not in out]
        if rest and 2 * len(rest) <= len(run):
            # The last one before a line of the body is its title or a heading.
            kept = rest[-1] if i < n and body[i] else -1
            out.update(dict.fromkeys([k for k in rest if k != kept and not heading(k)], "block"))
        run = []
    # Running heads: beside a line that fell, repeated with it from printed page to page or holding the page's title.
    title = next((x[i] for i in range(n) if x[i] and i not in out), "")
    for i in list(out):
        for m in (i - 1, i + 1):
            if 0 <= m < n and x[m] and m not in out and not body[m]:
                again = len(p.places[p.keys[m]]) > 1 and len(p.places[p.keys[i]]) > 1
                if again or title and x[m] != title and (x[m].startswith(title) or x[m].endswith(title)):
                    out[m] = "running"
    return out


def _one_form(texts: list[str]) -> list[str]:
    out: list[str] = []
    for part in slices(pa.array(texts, pa.string())):
        repaired = [r or t for r, t in zip(repair_array(part).field("repaired").to_pylist(), part.to_pylist(), strict=True)]
        out.extend(u if u is not None else r for u, r in zip(unify_array(pa.array(repaired, pa.string())).field("unified").to_pylist(), repaired, strict=True))
    return out


def _site(addresses: list[list[tuple]], reach: tuple[int, int] = (NEAREST, WINDOW), align=shared_lines) -> Iterator[tuple]:
    """(doc, text, {line index: kind}) of the owned pages of one site in one chunk; addresses are lists of (doc, text, form, owned, stands)."""
    n = len(addresses)
    nearest, window = reach
    forms = {t: Page(t) for a in addresses for *_, t, _, _ in a}
    stands = [[forms[t] for *_, t, _, s in a if s] for a in addresses]
    found: list[dict[str, set[int]]] = []
    for k, pages in enumerate(addresses):
        near = [q for j in range(max(0, k - nearest), min(n, k + nearest + 1)) if j != k for q in stands[j]]
        found.append({t: {i for q in near for i in align(forms[t].keys, q.places)} for t in {t for *_, t, _, _ in pages}})
    aligned = [{key for *_, t, _, s in a if s for i in f[t] for key in (forms[t].keys[i], forms[t].heads[i])} for a, f in zip(addresses, found, strict=True)]
    around, low, high = Around(), 0, 0
    for k, pages in enumerate(addresses):
        while high < n and high <= k + window:
            around.move(stands[high], aligned[high], 1)
            high += 1
        while low < k - window:
            around.move(stands[low], aligned[low], -1)
            low += 1
        done: dict[str, dict[int, str]] = {}
        for doc, text, form, owned, _ in pages:
            if owned:
                if form not in done:
                    done[form] = furniture(forms[form], found[k][form], around, high - low)
                yield doc, text, done[form]


def _chunks(batches: Iterable[pa.RecordBatch], reach: tuple[int, int]) -> Iterator[Iterator[tuple]]:
    """Results of each chunk's sites; rows (chunk, site, path, doc, text, owned, stands) come sorted."""
    at, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            key = (row[0], row[1])
            if key != at:
                yield _held(held, reach)
                at, held = key, []
            held.append(row)
    yield _held(held, reach)


def _held(rows: list[tuple], reach: tuple[int, int]) -> Iterator[tuple]:
    addresses: list[list[tuple]] = []
    at = None
    for (_, _, path, doc, text, owned, stands), form in zip(rows, _one_form([r[4] for r in rows]), strict=True):
        if path != at:
            at = path
            addresses.append([])
        addresses[-1].append((doc, text, form, owned, stands))
    return _site(addresses, reach) if addresses else iter(())


FURNITURE = T.StructType([T.StructField("doc", T.LongType()), T.StructField("line_no", T.IntegerType()), T.StructField("kind", T.StringType())])
BODIES = T.StructType([T.StructField("doc", T.LongType()), T.StructField("body", T.StringType())])


def _lines_out(batches: Iterator[pa.RecordBatch], reach: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc", pa.int64()), ("line_no", pa.int32()), ("kind", pa.string())])
    for pages in _chunks(batches, reach):
        rows = [(doc, i + 1, kind) for doc, _, found in pages for i, kind in sorted(found.items())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _bodies_out(batches: Iterator[pa.RecordBatch], reach: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc", pa.int64()), ("body", pa.string())])
    for pages in _chunks(batches, reach):
        rows = [(doc, "\n".join(line for i, line in enumerate(text.split("\n")) if i not in found)) for doc, text, found in pages]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def chunked_addresses(pages: DataFrame, reach: int, size: int) -> DataFrame:
    """One row per address of (doc, site, path, renderer, size): its chunk, number of salted chunks, the pages that stand for it, and all chunks it is near.

    The addresses are sorted in a range-partitioned table of their own; rows near
    the edge of a range are few and meet in a small table of all edges.
    """
    one = pages.groupBy("site", "path", "renderer").agg(F.min("doc").alias("doc"), F.sum(F.lit(1) + F.floor(F.col("size") / 16384)).alias("weight"))
    one = one.groupBy("site", "path").agg(F.collect_set("doc").alias("stands"), F.sum("weight").alias("weight"))
    placed = write_once(one.repartitionByRange("site", "path").withColumn("part", F.spark_partition_id()), "addresses")
    inside = Window.partitionBy("part").orderBy("site", "path")
    before = F.coalesce(F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunk = F.struct("part", F.floor(before / size).alias("chunk"), F.ceil(F.col("weight") / size).cast("int").alias("salts"))
    backwards = Window.partitionBy("part").orderBy(F.desc("site"), F.desc("path"))
    placed = placed.select("site", "path", "stands", chunk.alias("at"), (F.row_number().over(inside) <= reach).alias("early"), (F.row_number().over(backwards) <= reach).alias("late"))
    near = Window.partitionBy("site").orderBy("path").rowsBetween(-reach, reach)
    near_inside = Window.partitionBy("at.part", "site").orderBy("path").rowsBetween(-reach, reach)
    edges = placed.where("early or late").select("site", "path", F.collect_set("at").over(near).alias("over"))
    met = placed.select("site", "path", "stands", "at", F.collect_set("at").over(near_inside).alias("near")).join(edges, ["site", "path"], "left")
    return met.select("site", "path", "stands", "at", F.array_union("near", F.coalesce("over", F.array().cast("array<struct<part:int,chunk:bigint,salts:int>>"))).alias("near"))


def _chunk_id(at, salt):
    return F.concat_ws("-", at["part"].cast("string"), at["chunk"].cast("string"), salt.cast("string"))


def _spread(docs: DataFrame, doc_id: str, text: str, url: str, renderer: str | None, reach: tuple[int, int], chunk: int) -> DataFrame:
    """Rows (chunk, site, path, doc, text, owned, stands), each chunk whole and sorted."""
    doc = F.col(doc_id).cast("long")
    site = F.coalesce(site_of(F.col(url)), F.concat(F.lit("?"), doc.cast("string")))
    pages = docs.select(doc.alias("doc"), site.alias("site"), path_of(F.col(url)).alias("path"), F.col(text).alias("text"), (F.col(renderer) if renderer else F.lit(None)).cast("string").alias("renderer")).where("text is not null")
    addresses = write_once(chunked_addresses(pages.select("doc", "site", "path", "renderer", F.length("text").alias("size")), sum(reach), chunk), "chunks")
    own = _chunk_id(F.col("at"), F.pmod(F.xxhash64("doc"), F.col("at.salts")))
    there = F.flatten(F.transform("near", lambda a: F.transform(F.sequence(F.lit(0), a["salts"] - 1), lambda s: _chunk_id(a, s))))
    stands = F.array_contains("stands", F.col("doc"))
    rows = pages.drop("renderer").join(addresses, ["site", "path"]).select("doc", "site", "path", "text", own.alias("own"), F.when(stands, F.array_union(F.array(own), there)).otherwise(F.array(own)).alias("chunks"), stands.alias("stands"))
    rows = rows.select(F.explode("chunks").alias("chunk"), "site", "path", "doc", "text", "own", "stands")
    rows = rows.select("chunk", "site", "path", "doc", "text", (F.col("chunk") == F.col("own")).alias("owned"), "stands")
    return rows.repartition("chunk").sortWithinPartitions("chunk", "site", "path", "doc")


def furniture_lines(docs: DataFrame, doc_id: str, text: str, url: str, renderer: str | None = None, nearest: int = NEAREST, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """(doc, line_no, kind) of every non-blank line outside the main body."""
    reach = (nearest, window)
    return _spread(docs, doc_id, text, url, renderer, reach, chunk).mapInArrow(partial(_lines_out, reach=reach), FURNITURE)


def main_body(docs: DataFrame, doc_id: str, text: str, url: str, renderer: str | None = None, nearest: int = NEAREST, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """(doc, body): each text without its furniture lines; a text without furniture comes out as it is, null for null."""
    reach = (nearest, window)
    absent = docs.where(F.col(text).isNull()).select(F.col(doc_id).cast("long").alias("doc"), F.lit(None).cast("string").alias("body"))
    return _spread(docs, doc_id, text, url, renderer, reach, chunk).mapInArrow(partial(_bodies_out, reach=reach), BODIES).unionByName(absent)
