"""Per-document text statistics, and the structural profile nearest to each document.

Method: function-word and character-class distributions of stretches of a text
are compared with profiles through the Jensen-Shannon divergence, alongside
basic counts.  A stretch is about `WINDOW` characters of whole lines.  Profiles
come from a bounded sample of labelled documents: their stretches are grouped
by divergence without looking at labels, each group's mean distribution is a
profile, and its label is what most of its stretches are labelled, so that a
few wrong labels don't count.  A stretch takes the label of its nearest
profile, or junk where it is far from all prose profiles; a document takes the
label that holds most of its text.

All counting is done on numpy arrays of code points, whole texts, a batch at a
time: no call per document, word or character.

Defined results: null text has null statistics and no label; an empty or blank
text has zero counts and no label; ties go to prose.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.llm.codepoints import code_points, slices

WINDOW = 400
#: Most labelled documents that a profile set is fitted on.
MAX_LABELLED = 5_000
#: Most stretches of one labelled document that they are fitted on, evenly spaced over its whole text.
MAX_STRETCHES = 64
#: Stretches closer than this belong to one group.
RADIUS = 0.05
#: A stretch further than this from every prose profile is not prose, whatever else is near.
FAR = 0.15
#: A stretch further than this from every profile is like nothing labelled: junk.
LOST = 0.4
#: A group this close to a heavier one of another label takes its label: single wrong labels make no profile.
NEAR = 0.11
LABELS = ("prose", "list", "table", "junk")

LOWER, UPPER, DIGIT, BLANK, NEWLINE, TAB, STOP, COMMA, COLON, QUOTE, SYMBOL = range(11)
(FUNCTION, LOWERWORD, CAPITAL, CAPITALS, NUMBER, MIXED, F_STOP, F_COMMA, F_COLON, F_QUOTE, F_SYMBOL, F_TAB, MARKER, START_UPPER, START_LOWER, START_DIGIT, START_OTHER,
 END_STOP, END_COMMA, END_WRAP, END_ITEM, REPEAT, REPEAT_WORD, N_FEATURES) = range(24)
_MULT = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case form of every code point."""
    cls = np.full(0x110000, SYMBOL, dtype=np.uint8)
    low = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x2FFFF):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        if ch.isalpha() or 0x300 <= cp < 0x370:
            cls[cp] = UPPER if ch.isupper() or ch.istitle() else LOWER
            x = ch.lower()
            if len(x) == 1:
                low[cp] = ord(x)
        elif ch.isdecimal():
            cls[cp] = DIGIT
        elif ch.isspace():
            cls[cp] = BLANK
    for chars, c in (("\n", NEWLINE), ("\t", TAB), (".!?…", STOP), (",;", COMMA), (":", COLON), ("\"'„“”‘’«»()[]-–—", QUOTE)):
        for ch in chars:
            cls[ord(ch)] = c
    return cls, low


def word_hash(words: list[str]) -> np.ndarray:
    """64-bit hashes of lower-case words, as made from code-point arrays."""
    if not words:
        return np.zeros(0, np.uint64)
    cps, starts = code_points(pa.array([w.lower() for w in words], pa.string()))
    return _hash_runs(cps, starts[:-1], np.diff(starts))


def _hash_runs(cps: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order-dependent hash of each run of code points: a prefix sum of mixed (code point, place) values."""
    place = np.arange(len(cps), dtype=np.int64)
    run = np.repeat(np.arange(len(begin)), size)
    inside = np.repeat(begin, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    v = cps[inside].astype(np.uint64) * np.uint64(0x10001) + (place[inside] - begin[run]).astype(np.uint64)
    v = (v + np.uint64(0x7F4A7C15)) * _MULT
    v ^= v >> np.uint64(29)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(32)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)])
    ends = np.cumsum(size)
    return total[ends] - total[ends - size]


def measure(texts: pa.Array, common: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text, and feature counts, text and size per stretch."""
    cls_of, low_of = _tables()
    cps, starts = code_points(texts)
    n = len(starts) - 1
    size = len(cps)
    if not size:
        zero = np.zeros(n, np.int64)
        return {"counts": np.zeros((n, 10), np.int64), "features": np.zeros((0, N_FEATURES)), "owner": zero[:0], "chars": zero[:0]}
    cls = cls_of[cps]
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
    # Lines: from one line feed or text start to the next.
    head = np.zeros(size, dtype=bool)
    head[starts[:-1][starts[:-1] < size]] = True
    head[1:] |= cls[:-1] == NEWLINE
    line_at = np.flatnonzero(head)
    line_of = np.cumsum(head) - 1
    line_doc = doc[line_at]
    line_size = np.diff(np.append(line_at, size))
    # Stretches: lines whose start falls into the same WINDOW characters of their text.
    place = line_at - starts[line_doc]
    key = line_doc.astype(np.int64) << 32 | place // WINDOW
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    stretch_of_line = np.cumsum(fresh) - 1
    owner = line_doc[fresh]
    ns = len(owner)
    # Words: runs of letters and digits.
    inside = cls <= DIGIT
    edge = np.zeros(size + 1, dtype=bool)
    edge[:-1] = inside
    edge[1:] ^= inside
    edge[:-1] |= inside & head
    flips = np.flatnonzero(edge)
    begin = flips[inside[np.minimum(flips, size - 1)] & (flips < size)]
    ends = np.append(begin[1:], size)
    inside_total = np.concatenate([[0], np.cumsum(inside)])
    width = inside_total[ends] - inside_total[begin]
    digits = np.concatenate([[0], np.cumsum(cls == DIGIT)])
    uppers = np.concatenate([[0], np.cumsum(cls == UPPER)])
    nd, nu = digits[begin + width] - digits[begin], uppers[begin + width] - uppers[begin]
    h = _hash_runs(low_of[cps], begin, width)
    is_common = np.zeros(len(h), dtype=bool)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        is_common = common[at] == h
    kind = np.full(len(h), LOWERWORD)
    kind[nu > 0] = CAPITAL
    kind[(nu == width) & (width > 1)] = CAPITALS
    kind[nd > 0] = MIXED
    kind[nd == width] = NUMBER
    kind[is_common & (nd == 0)] = FUNCTION
    word_line = line_of[begin]
    word_stretch = stretch_of_line[word_line]
    feats = np.zeros((ns, N_FEATURES))

    def add(stretch, feature, weight=1.0):
        feats.ravel()[:] += np.bincount(stretch * N_FEATURES + feature, minlength=ns * N_FEATURES) * weight

    add(word_stretch, kind)
    again = np.zeros(len(h), dtype=bool)
    for gap in range(1, 9):
        again[gap:] |= (h[gap:] == h[:-gap]) & (doc[begin[gap:]] == doc[begin[:-gap]])
    again &= ~is_common & (nd == 0)
    add(word_stretch[again], REPEAT_WORD, 3.0)
    for c, f in ((STOP, F_STOP), (COMMA, F_COMMA), (COLON, F_COLON), (QUOTE, F_QUOTE), (SYMBOL, F_SYMBOL), (TAB, F_TAB)):
        add(stretch_of_line[line_of[cls == c]], f)
    # Three blanks in a row set columns off as a tab does.
    wide = np.zeros(size, dtype=bool)
    if size > 3:
        blank = (cls == BLANK) | (cls == TAB)
        wide[3:] = blank[1:-2] & blank[2:-1] & blank[3:] & ~blank[:-3] & ~head[3:] & ~head[2:-1]
        wide[3:-1] &= cls[3:-1] != NEWLINE
    add(stretch_of_line[line_of[wide]], F_TAB, 2.0)
    # Line starts and ends.
    solid = (cls != BLANK) & (cls != NEWLINE) & (cls != TAB)
    at = np.flatnonzero(solid)
    filled_line = line_of[at]
    first = np.ones(len(at), dtype=bool)
    first[1:] = filled_line[1:] != filled_line[:-1]
    last = np.append(first[1:], True) if len(at) else first
    lines = filled_line[first]  # lines with anything on them
    a, z = at[first], at[last]
    st = stretch_of_line[lines]
    ca, cz = cls[a], cls[z]
    nxt = np.minimum(a + 1, size - 1)
    nxt2 = np.minimum(a + 2, size - 1)
    bullet = ((cps[a] == 0x2D) | (cps[a] == 0x2022) | (cps[a] == 0x2A) | (cps[a] == 0x2013)) & (cls[nxt] == BLANK)
    closing = (cps == 0x29) | (cps == 0x2E)
    numbered = (ca == DIGIT) & ((closing[nxt] & (cls[nxt2] == BLANK)) | ((cls[nxt] == DIGIT) & closing[nxt2]))
    mark = bullet | numbered
    add(st[mark], MARKER, 3.0)
    start = np.where(ca == UPPER, START_UPPER, np.where(ca == LOWER, START_LOWER, np.where(ca == DIGIT, START_DIGIT, START_OTHER)))
    add(st[~mark], start[~mark])
    # The line that follows, if any, starts in lower case: the sentence goes on.
    goes_on = np.zeros(len(lines), dtype=bool)
    if len(lines) > 1:
        goes_on[:-1] = (ca[1:] == LOWER) & (line_doc[lines[1:]] == line_doc[lines[:-1]])
    end = np.where((cz == STOP) | (cz == QUOTE) & False, END_STOP, np.where(cz == COMMA, END_COMMA, np.where(goes_on, END_WRAP, END_ITEM)))
    add(st, end)
    # Lines said before in the same text.
    lh = _hash_runs(cps, a, z - a + 1) if len(a) else np.zeros(0, np.uint64)
    pair = np.lexsort((np.arange(len(lh)), lh, line_doc[lines]))
    same = np.zeros(len(lh), dtype=bool)
    same[pair[1:]] = (lh[pair[1:]] == lh[pair[:-1]]) & (line_doc[lines][pair[1:]] == line_doc[lines][pair[:-1]])
    add(st[same], REPEAT, 4.0)
    chars = np.bincount(stretch_of_line, weights=line_size, minlength=ns).astype(np.int64)

    def per_doc(where, weights=None):
        return np.bincount(doc[where], weights=weights, minlength=n).astype(np.int64)

    word_doc = doc[begin]
    counts = np.stack([
        np.diff(starts),
        np.bincount(word_doc, minlength=n),
        np.bincount(word_doc, weights=width, minlength=n).astype(np.int64),
        per_doc(cls == SYMBOL),
        per_doc(cls == DIGIT),
        per_doc(cls == UPPER),
        np.bincount(line_doc[lines], minlength=n),
        np.bincount(line_doc[lines[end == END_STOP]], minlength=n),
        np.bincount(word_doc[is_common], minlength=n),
        np.bincount(line_doc[lines[mark]], minlength=n),
    ], axis=1)
    return {"counts": counts, "features": feats, "owner": owner, "chars": chars}


def distributions(features: np.ndarray) -> np.ndarray:
    total = features.sum(axis=1, keepdims=True)
    return features / np.maximum(total, 1e-12)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Divergence (bits) of every row of p from every row of q."""

    def xlog(x):
        return np.where(x > 0, x * np.log2(np.maximum(x, 1e-300)), 0.0)

    hp, hq = xlog(p).sum(1), xlog(q).sum(1)
    out = np.empty((len(p), len(q)))
    for k in range(len(q)):
        m = (p + q[k]) / 2
        out[:, k] = (hp + hq[k]) / 2 - xlog(m).sum(1)
    return out


def stretches(texts: pa.Array, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, characters, distribution) of every stretch worth comparing."""
    owners, chars, dists = [], [], []
    first = 0
    for part in slices(texts):
        m = measure(part, common)
        keep = m["chars"] >= 20
        owners.append(m["owner"][keep] + first)
        chars.append(m["chars"][keep])
        dists.append(distributions(m["features"][keep]))
        first += len(part)
    return np.concatenate(owners), np.concatenate(chars), np.concatenate(dists)


def fit_profiles(dist: np.ndarray, own: np.ndarray, weight: np.ndarray, table: np.ndarray) -> dict:
    """Profiles from the distributions, label numbers and sizes of labelled stretches."""
    # Groups by divergence: the heaviest stretch that is left leads, those near it follow; then once more around the means.
    order = np.argsort(-weight, kind="stable")
    dist, own, weight = dist[order], own[order], weight[order]
    if not len(dist):
        return {"common": table, "means": np.zeros((0, N_FEATURES)), "labels": []}
    means = np.zeros((0, N_FEATURES))
    for _ in range(2):
        group = np.full(len(dist), -1)
        if len(means):
            d = jensen_shannon(dist, means)
            group = np.where(d.min(axis=1) < RADIUS, d.argmin(axis=1), -1)
        n_groups = len(means)
        while (left := np.flatnonzero(group < 0)).size:
            group[left[jensen_shannon(dist[left], dist[left[:1]])[:, 0] < RADIUS]] = n_groups
            group[left[0]] = n_groups
            n_groups += 1
        kept, group = np.unique(group, return_inverse=True)
        votes = np.zeros((len(kept), 4))
        np.add.at(votes, (group, own), weight)
        mass = votes.sum(axis=1)
        means = np.zeros((len(kept), N_FEATURES))
        np.add.at(means, group, dist * weight[:, None])
        means /= mass[:, None]
    names = [LABELS[int(np.argmax(v))] for v in votes]
    between = jensen_shannon(means, means)
    settled: list[int] = []
    for k in np.argsort(-mass, kind="stable"):
        other = [(between[k, j], j) for j in settled if names[j] != names[k] and between[k, j] < NEAR]
        same = [between[k, j] for j in settled if names[j] == names[k]]
        if other and min(other)[0] < min(same, default=1.0):
            names[k] = names[min(other)[1]]
        settled.append(int(k))
    return {"common": table, "means": means, "labels": names}


def assign(m: dict, profiles: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(label index or -1, divergence from the nearest prose profile, weighted by text) per text."""
    label = np.full(n, -1)
    near = np.full(n, np.nan)
    if not len(m["owner"]) or not len(profiles["labels"]):
        return label, near
    d = jensen_shannon(distributions(m["features"]), profiles["means"])
    names = np.array([LABELS.index(x) for x in profiles["labels"]])
    prose = names == 0
    to_prose = d[:, prose].min(axis=1) if prose.any() else np.full(len(d), 1.0)
    own = names[d.argmin(axis=1)]
    own = np.where((own == 0) & (to_prose > FAR) | (d.min(axis=1) > LOST), 3, own)
    held = np.zeros((n, 4))
    np.add.at(held, (m["owner"], own), m["chars"])
    total = held.sum(axis=1)
    some = total > 0
    rest = held[:, 1:].sum(axis=1)
    label[some] = np.where(rest > held[:, 0], 1 + held[:, 1:].argmax(axis=1), 0)[some]
    near[some] = (np.bincount(m["owner"], weights=to_prose * m["chars"], minlength=n) / np.maximum(total, 1))[some]
    return label, near


STATS = T.StructType(
    [T.StructField(x, T.LongType()) for x in ("chars", "words", "word_chars", "symbols", "digits", "capitals", "lines", "stop_lines", "common_words", "marked_lines")]
    + [T.StructField("label", T.StringType()), T.StructField("prose_divergence", T.DoubleType())]
)


def _struct(texts: pa.Array, profiles: dict) -> pa.StructArray:
    null = np.asarray(texts.is_null())
    m = measure(texts, profiles["common"])
    blank = null | (m["counts"][:, 6] == 0)
    label, near = assign(m, profiles, len(texts))
    columns = [pa.array(m["counts"][:, k], pa.int64(), mask=null) for k in range(10)]
    names = [None if b or k < 0 else LABELS[k] for k, b in zip(label, blank, strict=True)]
    return pa.StructArray.from_arrays([*columns, pa.array(names, pa.string()), pa.array(near, pa.float64(), mask=blank | np.isnan(near))], STATS.names)


def profiles_from(docs: DataFrame, labels: DataFrame, common: DataFrame, max_labelled: int = MAX_LABELLED) -> dict:
    """Fits the profiles on at most `max_labelled` labelled documents (the lowest ids by hash, so the sample is the same each time) and MAX_STRETCHES of each, which bounds what is broadcast and fitted.

    Where a document has several labels most hold, then the least.  The documents are
    measured where they are; only their stretches' distributions come to the driver.
    The common words are a closed list, whole on the driver.
    """
    votes = labels.select("doc_id", "label").where("doc_id is not null and label is not null").groupBy("doc_id", "label").agg(F.count("*").alias("n"))
    sample = votes.groupBy("doc_id").agg(F.min_by("label", F.struct(-F.col("n"), "label")).alias("__label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    words = [r[0] for r in common.select("word").where("word is not null").distinct().collect()]
    table = np.sort(word_hash(sorted(set(words))))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, chars, dist = stretches(b.column(1), table)
            held = np.bincount(owner, minlength=b.num_rows)
            place, size = np.arange(len(owner)) - (np.cumsum(held) - held)[owner], held[owner]
            # One where the next of MAX_STRETCHES equal parts begins.
            kept = (size <= MAX_STRETCHES) | (place * MAX_STRETCHES // np.maximum(size, 1) != (place - 1) * MAX_STRETCHES // np.maximum(size, 1))
            owner, chars, dist = owner[kept], chars[kept], dist[kept]
            place = pa.array(owner, pa.int64())
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1, dtype=np.int32) * N_FEATURES), pa.array(dist.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(place), b.column(2).take(place), pa.array(chars, pa.int64()), flat], names=["doc_id", "label", "chars", "dist"])

    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "__label")
    found = rows.mapInArrow(measured, "doc_id long, label string, chars long, dist array<double>").toArrow()
    dist = np.asarray(pa.compute.list_flatten(found["dist"]).combine_chunks() if found.num_rows else [], dtype=float).reshape(-1, N_FEATURES)
    own = np.array([LABELS.index(x) if x in LABELS else 3 for x in found["label"].to_pylist()], dtype=np.int64)
    # One order whatever the partitions were.
    order = np.lexsort((*dist.T[::-1], np.asarray(found["doc_id"].to_numpy(), dtype=np.int64)))
    return fit_profiles(dist[order], own[order], found["chars"].to_numpy().astype(float)[order], table)


def text_statistics(docs: DataFrame, text: str, profiles: dict, out: str = "stats") -> DataFrame:
    """Adds the struct `out` (STATS); one projection, no shuffle.

    Shares are ratios of its counts, e.g. symbols / chars, stop_lines / lines,
    common_words / words, word_chars / words.
    """

    @F.arrow_udf(STATS)
    def stats(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([_struct(part, profiles) for part in slices(texts)])

    return docs.withColumn(out, stats(F.col(text)))


def structural_profile(docs: DataFrame, doc_id: str, text: str, profiles: dict) -> DataFrame:
    """(doc_id, stats.*) for every document."""
    return text_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", profiles).select("doc_id", "stats.*")
