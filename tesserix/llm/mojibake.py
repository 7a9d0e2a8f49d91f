"""Text decoded with the wrong character encoding: detection and round-trip repair.

Method: re-encode the text under each candidate legacy encoding, decode the
bytes strictly as the intended encoding, repeat for nested layers, and accept a
step only where a garbling cost drops.  The unit of a step is a run of blank
separated words of one line, so that texts garbled only in places are repaired
in those places.

One pass of table lookups over the batch's code points screens the texts; only
those that hold a suspicious sequence are looked at one by one.

Defined results: null text gives garbled = false and a null repair; an empty
text is clean; U+FFFD and leftovers that no candidate can decode are garbled
but not restorable (the repaired text keeps what could not be decoded).
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.llm.codepoints import code_points, one_chunk, rows_of, slices

#: (encoding the bytes were wrongly read with, encoding they were written in)
CODECS = (
    ("cp1252", "utf-8"),
    ("cp1251", "utf-8"),
    ("mac_roman", "utf-8"),
    ("koi8-r", "utf-8"),
    ("cp866", "utf-8"),
    ("cp1250", "utf-8"),
    ("mac_cyrillic", "utf-8"),
    ("cp1252", "cp1251"),
    ("koi8-r", "cp1251"),
    ("cp866", "cp1251"),
    ("mac_roman", "cp1251"),
    ("mac_cyrillic", "cp1251"),
    ("cp1251", "koi8-r"),
    ("cp1252", "koi8-r"),
    ("cp1251", "cp866"),
    ("cp1252", "cp866"),
)
#: A step must lower the cost by this much.
MARGIN = 0.9

# Relative frequency of the Bulgarian letters in per mille (general language knowledge).
LETTER_PER_MILLE = {
    "а": 118, "б": 15, "в": 43, "г": 17, "д": 34, "е": 90, "ж": 8, "з": 21, "и": 95, "й": 6,
    "к": 34, "л": 33, "м": 23, "н": 75, "о": 86, "п": 28, "р": 51, "с": 54, "т": 79, "у": 17,
    "ф": 3, "х": 6, "ц": 8, "ч": 17, "ш": 7, "щ": 7, "ъ": 19, "ь": 0.5, "ю": 1.2, "я": 19,
}
_LETTER = {k: 0.15 * (-math.log(v / 1000) - 2.9) for k, v in LETTER_PER_MILLE.items()}
_LETTER |= {k.upper(): v for k, v in _LETTER.items()}
_FREE = set("„“”‘’«»–—•…€№©®°²³½¼¾·×§›‹™ѝЍ±−")


def _char_cost(ch: str) -> float:
    o = ord(ch)
    if o < 127:
        return 0.0 if o >= 32 or ch in "\t\r\n" else 1.0
    if ch in _LETTER:
        return _LETTER[ch]
    if ch in _FREE or o in (0xA0, 0xAD):
        return 0.0
    if o < 0xA0:
        return 2.0
    if ch == "\ufffd":
        return 3.0
    if ch in "ыэЫЭ":
        return 0.6
    if o < 0x100:
        return 0.3 if ch.isalpha() else 0.5
    if 0x400 <= o < 0x530:
        return 0.5
    if 0x370 <= o < 0x400:
        return 0.5
    if 0x300 <= o < 0x370 or 0x2000 <= o < 0x2010 or 0x202F == o or 0x205F <= o < 0x2070 or o in (0x3000, 0xFEFF) or 0xFF00 <= o < 0xFFF0 or o > 0xFFFF:
        return 0.1
    if 0x2190 <= o < 0x2600:
        return 1.0
    return 0.6


_COSTS: dict[str, float] = {}
#: Two neighbouring characters that legitimate text doesn't put side by side.
_PAIRS = re.compile(r"(?=[\u00a1-\u00ff\u0152-\u0192\u2020\u2021\u2030\u02c6\u02dc][\u0080-\u00ff\u0152-\u0192\u2018-\u2026\u2030\u2039\u203a\u20ac\u2122\u02c6\u02dc])(?![\u00b0-\u00b3\u00bb\u00a9].)")
_INVERTED = re.compile(r"(?=[а-я][А-Я])")
_MIXED = re.compile(r"(?=[A-Za-zÀ-ÖØ-öø-ÿ][а-яА-Я]|[а-яА-Я][A-Za-zÀ-ÖØ-öø-ÿ])")
_MATHS = re.compile(r"(?=[–—][^\W\d_]|[^\W\d_ ]–[^\W\d_ ])")


def garbling_cost(text: str) -> float:
    """Sum over the characters and neighbouring pairs that natural text avoids."""
    total = 0.0
    for ch in text:
        c = _COSTS.get(ch)
        if c is None:
            c = _COSTS[ch] = _char_cost(ch)
        total += c
    if not text.isascii():
        total += len(_PAIRS.findall(text)) + len(_INVERTED.findall(text)) + 0.7 * len(_MIXED.findall(text)) + 0.3 * len(_MATHS.findall(text))
    return total


@lru_cache(maxsize=None)
def _table(codec: str) -> dict[str, int]:
    """Character to byte; bytes the codec leaves undefined pass as C1 controls."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    if codec == "cp1252":
        # Readers that fall back to Latin-1 leave the bytes 80-9F as controls.
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), b)
    return out


def round_trip(text: str, wrong: str, right: str) -> str | None:
    """The text with its bytes under `wrong` strictly decoded as `right`, or None."""
    table = _table(wrong)
    try:
        raw = bytes([table[ch] for ch in text])
    except KeyError:
        return None
    try:
        if right == "utf-8":
            return raw.decode("utf-8")
        return raw.decode(right)
    except UnicodeDecodeError:
        return None


@lru_cache(maxsize=200_000)
def _steps(token: str) -> tuple[float, tuple]:
    """Cost of a token, and (converted, cost) under each pair of codecs that fits and changes it."""
    own = garbling_cost(token)
    found = []
    for n, (wrong, right) in enumerate(CODECS):
        s = round_trip(token, wrong, right)
        if s is not None and s != token:
            found.append((n, s, garbling_cost(s)))
    return own, tuple(found)


_BLANKS = re.compile(r"([ \t]+)")


def _paying(run: list[tuple[int, str, float]]) -> list[list[tuple[int, str, float]]]:
    """The stretches of a run whose summed gain is largest, left to right."""
    out, start, total, best, end = [], 0, 0.0, 0.0, -1
    for k, (_, _, gain) in enumerate(run):
        if total <= 0:
            if end >= start and best > 0:
                out.append(run[start : end + 1])
            start, total, best, end = k, 0.0, 0.0, -1
        total += gain
        if total > best:
            best, end = total, k
        elif total < best - 2 * MARGIN and end >= start:
            out.append(run[start : end + 1])
            start, total, best, end = k + 1, 0.0, 0.0, k
    if end >= start and best > 0:
        out.append(run[start : end + 1])
    return out


def _one_layer(line: str) -> tuple[str, int] | None:
    """The line after the best single step, and the step's number."""
    parts = _BLANKS.split(line)
    words = [k for k in range(0, len(parts), 2) if parts[k] and not parts[k].isascii()]
    if not words:
        return None
    info = {k: _steps(parts[k]) for k in words}
    best: tuple[tuple, int, list] | None = None
    for n, (wrong, right) in enumerate(CODECS):
        edits: list[tuple[int, str]] = []
        gain_all = 0.0
        run: list[tuple[int, str, float]] = []

        def close(right=right) -> float:
            nonlocal run
            got = 0.0
            for seg in _paying(run):
                gain = sum(g for _, _, g in seg)
                letters = sum(len(parts[k]) for k, _, _ in seg)
                # Both readings are plain letters there, so more evidence is asked.
                need = MARGIN if right == "utf-8" else max(MARGIN, 0.12 * letters)
                if gain >= need and (right == "utf-8" or letters >= 4):
                    edits.extend((k, s) for k, s, _ in seg)
                    got += gain
            run = []
            return got

        for k in words:
            own, steps = info[k]
            hit = next(((s, c) for m, s, c in steps if m == n), None)
            if hit is None:
                gain_all += close()
            else:
                run.append((k, hit[0], own - hit[1]))
        gain_all += close()
        # A strict UTF-8 decoding is far stronger evidence than a single-byte one.
        rank = (right == "utf-8", gain_all)
        if edits and (best is None or rank > best[0]):
            best = (rank, n, edits)
    if best is None:
        return None
    for k, s in best[2]:
        parts[k] = s
    return "".join(parts), best[1]


#: What stays unreadable after all steps.
_LEFT = re.compile(r"\ufffd|[\u0080-\u0084\u0086-\u009f]|[ÐÑ][\u00a1-\u00bf\u2010-\u203a\u20ac]|[ÃÂ][\u00a1-\u00bf\u201a-\u203a]|â€|вЂ|[РС][Ђ-ЏђѓљњќћџЎўЈҐ¤¦§Ёё©Є«¬®ЇІіґµ¶·№є»јЅѕї°±][РС]|—[А-ЯA-Z–—]?[а-я–∏≤≥]")
_RC, _FOLLOW, _LOWER, _UPPER, _CONSONANT, _DASH, _PLAIN, _TAIL, _ALONE, _LATIN, _VE, _VE_TAIL, _GE, _GAP, _LEAD, _CONT = (1 << k for k in range(16))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Bit flags of every code point, for the screen."""
    c = np.zeros(0x110000, dtype=np.uint16)

    def put(flag: int, *ranges) -> None:
        for r in ranges:
            lo, hi = r if isinstance(r, tuple) else (r, r)
            c[lo : hi + 1] |= flag

    put(_ALONE, 0xFFFD, (0x80, 0x84), (0x86, 0x9F), (0x400, 0x40C), (0x40E, 0x40F), (0x451, 0x45C), (0x45E, 0x45F), (0x490, 0x491), (0x2190, 0x25FF))
    put(_LATIN, (0xC0, 0xFF))
    put(_FOLLOW, (0x80, 0xFF), (0x152, 0x192), (0x2018, 0x2026), 0x2030, 0x2039, 0x203A, 0x20AC, 0x2122, 0x2C6, 0x2DC)
    put(_LOWER, (0x430, 0x44F))
    put(_UPPER, (0x410, 0x42F))
    for ch in "БВГЖЗЙКЛМНПРСТФХЦЧШЩЪЬЮЯ":
        put(_CONSONANT, ord(ch))
    put(_DASH, 0x2013, 0x2014)
    c[:] |= _PLAIN
    for cp in [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80), *map(ord, "„“”«»"), 0xA0, 0x2009, 0x200B, 0x202F, 0x3000]:
        c[cp] &= 0xFFFF ^ _PLAIN
    put(_RC, 0x420, 0x421)
    put(_TAIL, (0x80, 0xBF), (0x2018, 0x201B), (0x201D, 0x203A), 0x20AC, 0x2116, 0x2122)
    put(_VE, 0x432)
    put(_VE_TAIL, 0x402, 0x201E, 0x201A)
    put(_GE, 0x412, 0x413)
    put(_GAP, 0x20, 0x2C, 0x2E)
    # What the bytes of UTF-8 become, straight from CODECS; Cyrillic letters have classes of their own above.
    for wrong in {w for w, right in CODECS if right == "utf-8"}:
        for ch, byte in _table(wrong).items():
            if byte >= 0x80 and not 0x400 <= ord(ch) < 0x500:
                put(_CONT if byte < 0xC0 else _LEAD if 0xC2 <= byte <= 0xF4 else 0, ord(ch))
    return c


def suspicious_rows(texts: pa.Array) -> np.ndarray:
    """Rows that may be garbled; one pass of table lookups over all code points, never missing a row the repair would change."""
    cps, starts = code_points(texts)
    if len(cps) < 1:
        return np.zeros(0, np.int64)
    f = _classes()[np.concatenate([cps, np.zeros(6, np.uint32)])]
    n = len(cps)
    a, b, c = f[:n], f[1 : n + 1], f[2 : n + 2]

    def has(x, flag):
        return (x & flag) != 0

    hit = has(a, _LATIN) & has(b, _FOLLOW) | has(a, _LOWER) & has(b, _UPPER) | has(a, _DASH) & has(b, _PLAIN)
    hit |= has(a, _RC) & has(b, _TAIL) | has(a, _VE) & has(b, _VE_TAIL) | has(a, _GE) & has(b, _TAIL) & ~has(b, _DASH) & (cps > 0)
    hit |= has(a, _LEAD) & has(b, _CONT)
    hit |= has(a, _CONSONANT) & has(b, _CONSONANT) & has(c, _CONSONANT)
    up = np.flatnonzero(has(a, _UPPER) & has(b, _UPPER))
    if len(up):
        d, e, g = f[up + 2], f[np.minimum(up + 3, n + 5)], f[np.minimum(up + 4, n + 5)]
        long = has(d, _UPPER) & has(e, _UPPER) & has(g, _UPPER)
        pair = has(d, _GAP) & has(e, _UPPER) & has(g, _UPPER)
        hit[up[long | pair]] = True
    # Neighbours across two texts are none.
    hit[starts[1:][starts[1:] > 0] - 1] = False
    return rows_of(np.flatnonzero(hit | has(a, _ALONE)), starts)


def repair_text(text: str) -> tuple[str, bool, bool, str]:
    """(repaired, garbled, restorable, codecs) of one text."""
    used: dict[str, None] = {}
    garbled = False
    lines = text.split("\n")
    for k in suspicious_rows(pa.array(lines, pa.string())):
        line = lines[k]
        # Every step lowers the cost by MARGIN at least, so the steps come to an end.
        while (step := _one_layer(line)) is not None:
            line, n = step
            garbled = True
            used["%s>%s" % CODECS[n]] = None
        lines[k] = line
    repaired = "\n".join(lines)
    left = bool(_LEFT.search(repaired))
    return repaired, garbled or left, not left, ",".join(used)


REPAIR = T.StructType(
    [
        T.StructField("repaired", T.StringType()),
        T.StructField("garbled", T.BooleanType()),
        T.StructField("restorable", T.BooleanType()),
        T.StructField("codecs", T.StringType()),
    ]
)


def repair_array(texts: pa.Array) -> pa.StructArray:
    """Struct REPAIR per text; all null for clean texts, which nothing looks at one by one."""
    texts = one_chunk(texts)
    at = suspicious_rows(texts)
    found = [repair_text(t) for t in texts.take(pa.array(at)).to_pylist()]
    where = np.full(len(texts), -1, dtype=np.int64)
    where[at] = np.arange(len(at))
    take = pa.array(where, mask=where < 0)
    columns = zip(*found, strict=True) if found else ((), (), (), ())
    types = (pa.string(), pa.bool_(), pa.bool_(), pa.string())
    return pa.StructArray.from_arrays([pa.array(list(c), t).take(take) for c, t in zip(columns, types, strict=True)], REPAIR.names)


@F.arrow_udf(REPAIR)
def _repair(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([repair_array(part) for part in slices(texts)])


@F.arrow_udf(T.BooleanType())
def _garbled(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([repair_array(part).field("garbled").fill_null(False) for part in slices(texts)])


def is_garbled(text: Column) -> Column:
    """True where the text was garbled anywhere, restorable or not; null counts as false."""
    return _garbled(text)


def repair_encoding(df: DataFrame, text: str, out: str = "encoding") -> DataFrame:
    """Adds the struct `out` (repaired, garbled, restorable, codecs) for column `text`.

    Every other column passes untouched, whatever its name; a column already
    called `out` is replaced.  No shuffle: one projection over the scan.
    """
    raw = df.withColumn(out, _repair(F.col(text)))
    return raw.withColumn(
        out,
        F.struct(
            F.coalesce(F.col(f"{out}.repaired"), F.col(text)).alias("repaired"),
            F.coalesce(F.col(f"{out}.garbled"), F.lit(False)).alias("garbled"),
            F.coalesce(F.col(f"{out}.restorable"), F.lit(True)).alias("restorable"),
            F.coalesce(F.col(f"{out}.codecs"), F.lit("")).alias("codecs"),
        ),
    )
