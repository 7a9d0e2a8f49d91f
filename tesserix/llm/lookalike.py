"""One consistent form for text that looks the same but is made of other characters.

Method: the Arrow text is copied into one numpy array of code points per batch;
variant forms, blanks and invisible characters are mapped by lookup-table
gathers, longer replacements by expansion offsets, combining marks are composed
vectorially (pair keys looked up in a sorted array), and letters of another
alphabet inside a word are replaced from per-word script counts.  There is no
call per row and no call per character.

Kept as they are, because they look different or mean something: superscripts,
fractions, the numero sign, typographic quotes and dashes, the ellipsis, micro
and ohm signs, and whole words or symbols of another alphabet.

Defined results: null gives null and changed = false; an empty text stays empty;
a text that already has the one form comes back unchanged.  Applying the
operator twice gives what applying it once gives.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.llm.codepoints import arrow_text, code_points, one_chunk, rows_of, slices

_TOP = 0x110000
#: Pairs of letters that look the same (Latin, Cyrillic) and (Latin, Greek).
LATIN_CYRILLIC = "AА BВ CС EЕ HН IІ JЈ KК MМ OО PР SЅ TТ XХ YУ aа cс eе iі jј oо pр sѕ xх yу kк"
LATIN_GREEK = "AΑ BΒ EΕ ZΖ HΗ IΙ KΚ MΜ NΝ OΟ PΡ TΤ XΧ YΥ oο vν"
LATIN, CYRILLIC, GREEK, _ODD = 1, 2, 3, 9
_INVISIBLE = (0x00AD, 0x034F, 0x061C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x206A), 0xFEFF, *range(0xFE00, 0xFE10))
_BLANKS = (0x00A0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
#: Compatibility tags of characters that differ from their plain form only in style or width.
_STYLES = ("<wide>", "<narrow>", "<font>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")


@lru_cache(maxsize=1)
def _tables() -> dict:
    """Lookup tables, built from the Unicode database by rule once per worker."""
    one = np.arange(_TOP, dtype=np.uint32)
    grow: dict[int, tuple[int, ...]] = {}
    pairs: dict[int, int] = {}
    mark = np.zeros(_TOP, dtype=bool)
    letter = np.zeros(_TOP, dtype=bool)
    order = np.zeros(_TOP, dtype=np.uint8)  # of combining marks
    for cp in (*range(0x80, 0x20000), *range(0x2F800, 0x2FA20)):
        ch = chr(cp)
        order[cp] = unicodedata.combining(ch)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co", "Cs"):
            continue
        if cat[0] == "L":
            letter[cp] = True
        elif cat == "Mn":
            mark[cp] = True
        how = unicodedata.decomposition(ch)
        if not how:
            continue
        tag = how.split(" ", 1)[0]
        if tag[0] == "<":
            if tag in _STYLES and (cat in ("Nd", "Nl") or cat[0] == "L" or tag in ("<wide>", "<narrow>")):
                plain = tuple(ord(c) for c in unicodedata.normalize("NFKC", ch))
                if cp in (0xB5, 0x132, 0x133) or not plain or plain == (cp,):
                    continue
                if len(plain) == 1:
                    one[cp] = plain[0]
                else:
                    grow[cp] = plain
        elif (plain := tuple(map(ord, unicodedata.normalize("NFC", ch)))) != (cp,):
            # Canonical twins: one character that stands for another, or for several that never compose to it.
            if len(plain) == 1:
                one[cp] = plain[0]
            else:
                grow[cp] = plain
        elif " " in how:
            a, b = (int(x, 16) for x in how.split())
            pairs[a << 21 | b] = cp
    for cp in range(0x41, 0x7B):
        letter[cp] = chr(cp).isalpha()
    for cp in _BLANKS:
        one[cp] = 0x20
    drop = np.zeros(_TOP, dtype=bool)
    drop[list(_INVISIBLE)] = True
    script = np.zeros(_TOP, dtype=np.uint8)
    for lo, hi, s in ((0x41, 0x250, LATIN), (0x1E00, 0x1F00, LATIN), (0x400, 0x530, CYRILLIC), (0x370, 0x400, GREEK), (0x1F00, 0x2000, GREEK)):
        script[lo:hi][letter[lo:hi]] = s
    script[[0xAA, 0xBA, 0xB5]] = 0
    letter[[0xAA, 0xBA, 0xB5]] = False
    swap = {s: np.arange(_TOP, dtype=np.uint32) for s in (LATIN, CYRILLIC, GREEK)}
    for other, table in ((CYRILLIC, LATIN_CYRILLIC), (GREEK, LATIN_GREEK)):
        for a, b in table.split():
            swap[LATIN][ord(b)] = ord(a)
            swap[other][ord(a)] = ord(b)
    swap[LATIN][0x4BB] = ord("h")  # the other way would bring a letter into words that never have it
    # Greek against Cyrillic goes through the Latin letter both look like.
    for a, b in LATIN_GREEK.split():
        swap[CYRILLIC][ord(b)] = swap[CYRILLIC][ord(a)] if swap[CYRILLIC][ord(a)] != ord(a) else ord(b)
    keys = np.array(sorted(pairs), dtype=np.uint64)
    base, part = np.zeros(_TOP, dtype=np.uint32), np.zeros(_TOP, dtype=np.uint32)
    for k, cp in pairs.items():
        base[cp], part[cp] = k >> 21, k & 0x1FFFFF
    odd = (one != np.arange(_TOP)) | drop | mark | np.isin(np.arange(_TOP), list(grow))
    for first, end in ((0x1161, 0x1176), (0x11A8, 0x11C3)):  # a Hangul vowel or final may join what stands before it
        odd[first:end] = True
    return {
        "kind": np.where(odd, np.uint8(_ODD), script),
        "one": one, "grow": grow, "grows": np.isin(np.arange(_TOP), list(grow)), "drop": drop, "mark": mark, "letter": letter, "order": order, "base": base, "part": part, "script": script, "swap": swap,
        "keys": keys, "composed": np.array([pairs[int(k)] for k in keys], dtype=np.uint32),
        "odd": odd,
    }


def _keep(cps, row, keep):
    return cps[keep], row[keep]


def _drop_at(cps, row, at):
    keep = np.ones(len(cps), dtype=bool)
    keep[at] = False
    return cps[keep], row[keep]


def _ordered(cps, row, changed, t):
    """Marks of each run in canonical order; what has no order of its own begins the next run."""
    order = np.where(t["mark"][cps], t["order"][cps], 0).astype(np.int16)
    if not ((order[1:] > 0) & (order[:-1] > order[1:]) & (row[1:] == row[:-1])).any():
        return cps
    begins = order == 0
    begins[1:] |= row[1:] != row[:-1]
    sort = np.lexsort((np.arange(len(cps)), order, np.cumsum(begins)))
    changed[row[cps[sort] != cps]] = True
    return cps[sort]


def _compose(cps, row, changed, t):
    """Marks in canonical order, then composed with their base, one mark of every base at a time; Hangul syllables."""
    before_all, row_all, outer, taken = cps, row, changed, np.zeros(0, dtype=row.dtype)
    changed = np.zeros_like(outer)
    while t["mark"][cps].any():
        cps = _ordered(cps, row, changed, t)
        # A composed letter before a mark that belongs before its own is taken apart.
        part = t["part"][cps[:-1]]
        apart = np.flatnonzero((part > 0) & t["mark"][cps[1:]] & (row[1:] == row[:-1]))
        apart = apart[(t["order"][cps[apart + 1]] > 0) & (t["order"][cps[apart + 1]] < t["order"][part[apart]])]
        if not len(apart):
            break
        taken = np.union1d(taken, row[apart])
        cps, row = np.insert(cps, apart + 1, part[apart]), np.insert(row, apart + 1, row[apart])
        at = apart + np.arange(len(apart))
        cps[at] = t["base"][cps[at]]
    while True:
        at = np.flatnonzero(t["mark"][cps])
        if not len(at):
            break
        base = np.maximum.accumulate(np.where(t["mark"][cps], 0, np.arange(len(cps))))[at]
        near = at - 1 == base
        free = near | (t["order"][cps[at - 1]] > 0) & (t["order"][cps[at - 1]] < t["order"][cps[at]])
        key = cps[base].astype(np.uint64) << np.uint64(21) | cps[at]
        pos = np.minimum(np.searchsorted(t["keys"], key), len(t["keys"]) - 1)
        hit = np.flatnonzero((at > 0) & (base < at) & (row[base] == row[at]) & free & (t["keys"][pos] == key))
        if not len(hit):
            break
        hit = hit[np.unique(base[hit], return_index=True)[1]]
        changed[row[at[hit]]] = True
        cps = cps.copy()
        cps[base[hit]] = t["composed"][pos[hit]]
        cps, row = _drop_at(cps, row, at[hit])
    for first, size, final in ((0x1161, 21, False), (0x11A7, 28, True)):
        part = cps.astype(np.int64) - first
        at = np.flatnonzero((part >= final) & (part < size))
        at = at[at > 0]
        at = at[row[at] == row[at - 1]]
        before = cps[at - 1].astype(np.int64)
        fits = (before >= 0xAC00) & (before < 0xD7A4) & ((before - 0xAC00) % 28 == 0) if final else (before >= 0x1100) & (before < 0x1113)
        at, before = at[fits], before[fits]
        if len(at):
            changed[row[at]] = True
            cps = cps.copy()
            cps[at - 1] = before + part[at] if final else 0xAC00 + ((before - 0x1100) * 21 + part[at]) * 28
            cps, row = _drop_at(cps, row, at)
    for k in taken:  # few: what was taken apart may have come together again
        changed[k] = not np.array_equal(cps[row == k], before_all[row_all == k])
    outer |= changed
    return cps, row


def unify_points(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, starts, changed per text) of the one form."""
    t = _tables()
    n = len(starts) - 1
    changed = np.zeros(n, dtype=bool)
    if not len(cps):
        return cps, starts, changed
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
    script = t["script"][cps]
    odd = t["odd"][cps]
    # Two alphabets in one word: neighbouring letters of different alphabets (same text).
    if odd.any():
        drop = t["drop"][cps]
        # A joiner between two symbols belongs to the symbol.
        joiner = np.flatnonzero(cps == 0x200D)
        if len(joiner):
            inner = joiner[(joiner > 0) & (joiner < len(cps) - 1)]
            drop[inner[(cps[inner - 1] > 0x2300) & (cps[inner + 1] > 0x2300) & ~t["letter"][cps[inner - 1]]]] = False
        selector = np.flatnonzero((cps >= 0xFE00) & (cps < 0xFE10))
        if len(selector):
            after = selector[selector > 0]
            drop[after[(cps[after - 1] > 0x2000) & ~t["letter"][cps[after - 1]]]] = False
        mapped = t["one"][cps]
        changed[row[drop | (mapped != cps)]] = True
        cps = mapped
        if drop.any():
            cps, row = _keep(cps, row, ~drop)
        grows = t["grows"][cps]
        if grows.any():
            changed[row[grows]] = True
            parts = {int(c): t["grow"][int(c)] for c in np.unique(cps[grows])}
            size = np.ones(len(cps), dtype=np.int64)
            for c, plain in parts.items():
                size[cps == c] = len(plain)
            ends = np.cumsum(size)
            out = np.repeat(cps, size)
            for c, plain in parts.items():
                at = (ends - size)[cps == c]
                for k, p in enumerate(plain):
                    out[at + k] = p
            row = np.repeat(row, size)
            cps = out
        cps, row = _compose(cps, row, changed, t)
        script = t["script"][cps]
    clash = (script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0) & (row[1:] == row[:-1])
    if clash.any():
        inside = t["letter"][cps] | t["mark"][cps]
        edge = np.ones(len(cps), dtype=bool)
        edge[1:] = (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
        word = np.cumsum(edge, dtype=np.int32) - 1
        words = np.unique(word[1:][clash])
        where = np.full(word[-1] + 1, -1, dtype=np.int32)
        where[words] = np.arange(len(words), dtype=np.int32)
        at = np.flatnonzero(where[word] >= 0)
        w = where[word[at]]
        count = np.stack([np.bincount(w[script[at] == s], minlength=len(words)) for s in (LATIN, CYRILLIC, GREEK)])
        # Letters that can't be read as another alphabet speak for their own first.
        sure = np.stack([np.bincount(w[(script[at] == s) & ~_doubtful(cps[at], s, t)], minlength=len(words)) for s in (LATIN, CYRILLIC, GREEK)])
        own = np.argmax(sure * 1000.0 + count + np.array([[0.1], [0.2], [0.0]]), axis=0) + 1
        cps = cps.copy() if not cps.flags.writeable else cps
        for s in (LATIN, CYRILLIC, GREEK):
            go = at[(own[w] == s) & (script[at] != s)]
            new = t["swap"][s][cps[go]]
            hit = new != cps[go]
            changed[row[go[hit]]] = True
            cps[go[hit]] = new[hit]
    starts = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.bincount(row, minlength=n), out=starts[1:])
    return cps, starts, changed


def _doubtful(cps, s, t):
    """Letters of alphabet s that have a twin in another alphabet."""
    out = np.zeros(len(cps), dtype=bool)
    for o in (LATIN, CYRILLIC, GREEK):
        if o != s:
            out |= t["swap"][o][cps] != cps
    return out


def _candidates(texts: pa.Array) -> np.ndarray:
    """Rows that may not be in the one form: an odd character, or two alphabets side by side."""
    t = _tables()
    cps, starts = code_points(texts)
    if not len(cps):
        return np.zeros(0, np.int64)
    kind = t["kind"][cps]
    hit = kind == _ODD
    hit[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (kind[1:] < _ODD) & (kind[:-1] < _ODD)
    return rows_of(np.flatnonzero(hit), starts)


def unify_array(texts: pa.Array) -> pa.StructArray:
    """Struct (unified, changed) of an Arrow array of strings; `unified` is null where the text is in the one form already."""
    texts = one_chunk(texts)
    n = len(texts)
    at = _candidates(texts)
    cps, starts = code_points(texts.take(pa.array(at)))
    cps, starts, changed = unify_points(cps, starts)
    flags = np.zeros(n, dtype=bool)
    flags[at] = changed
    where = np.full(n, -1, dtype=np.int64)
    where[at[changed]] = np.flatnonzero(changed)
    out = arrow_text(cps, starts).take(pa.array(where, mask=where < 0))
    return pa.StructArray.from_arrays([out, pa.array(flags)], ["unified", "changed"])


FORM = T.StructType([T.StructField("unified", T.StringType()), T.StructField("changed", T.BooleanType())])


@F.arrow_udf(FORM)
def _unify(texts: pa.Array) -> pa.Array:
    return pa.concat_arrays([unify_array(part) for part in slices(texts)])


@F.arrow_udf(T.BooleanType())
def _differs(texts: pa.Array) -> pa.Array:
    """Only whether the one form differs: nothing is written back."""
    parts = []
    for part in slices(texts):
        at = _candidates(part)
        flags = np.zeros(len(part), dtype=bool)
        flags[at] = unify_points(*code_points(part.take(pa.array(at))))[2]
        parts.append(flags)
    return pa.array(np.concatenate(parts))


def unify_text(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Adds the struct `out` (unified, changed) for column `text`; no shuffle.

    Other columns pass untouched; a column already called `out` is replaced.
    """
    sent = df.withColumn(out, _unify(F.col(text)))
    return sent.withColumn(out, F.struct(F.coalesce(F.col(f"{out}.unified"), F.col(text)).alias("unified"), F.coalesce(F.col(f"{out}.changed"), F.lit(False)).alias("changed")))


def looks_disguised(text: Column) -> Column:
    """True where the text is not in the one form; null counts as false."""
    return _differs(text)
