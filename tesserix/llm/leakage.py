"""Evaluation passages inside training text.

Method: the test items make a BM25 inverted index, postings in blocks with the
largest impact of each block; every passage of every training document queries
it by block-max WAND and retrieves all items above a threshold; each retrieved
item is then verified word by word, and its answer looked for.

The threshold loses nothing: for each item it is the least BM25 weight that any
`MIN_WORDS` consecutive words of it have, so a passage that holds such a run
always scores at least that.  Impacts are divided by it, so one threshold of 1
serves all items; items are numbered in order of it, so that a block's largest
impact is close to its others.  A passage is a run of at least MIN_WORDS words
each two of which follow each other in some item as well, for no shared run can
cross another pair; a run longer than WINDOW words is queried in windows that
overlap by MIN_WORDS - 1, so a query stays small however many items there are.

Words: the text in lower case without punctuation, split at blanks of any kind.

The index is built on the executors, in blocks of at most BLOCK_WORDS words, and
kept in the shared folder.  One scan of the corpus meets all blocks: each worker
reads them from there and holds HELD of them; neither items nor index pass
through the driver.

Defined results: null or shorter texts match nothing; repeated items and
documents match each under their own id; answers null or empty give
answer_found = null.
"""

from __future__ import annotations

import heapq
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesserix.session import fresh_path

MIN_WORDS = 12
#: Words of a query at most.
WINDOW = 16
BLOCK_WORDS = 1_000_000
#: Blocks of the index that a worker holds; further ones are read again for every CORPUS_PART characters of documents.
HELD = 4
CORPUS_PART = 32_000_000
POSTINGS = 64
K1, B = 1.2, 0.75
_PUNCTUATION = re.compile(r"[^\w\s]+|_+")


def words_of(text: str | None) -> list[str]:
    return _PUNCTUATION.sub("", text.casefold()).split() if text else []


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit polynomial hash of every run of `size` words."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * _FACTOR + words[k : k + n].astype(np.uint64) + np.uint64(1)
    return out


class ItemIndex:
    """Inverted index of one block of items."""

    def __init__(self, items: list[tuple[int, str | None, str | None]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        kept = [(i, w, words_of(a)) for i, t, a in items if len(w := words_of(t)) >= min_words]
        n = len(kept)
        seen = Counter(t for _, w, _ in kept for t in set(w))
        mean = sum(len(w) for _, w, _ in kept) / n if n else 1.0
        weighed = []
        for i, w, answer in kept:
            size = K1 * (1 - B + B * len(w) / mean)
            impact = {t: math.log(1 + (n - seen[t] + 0.5) / (seen[t] + 0.5)) * c * (K1 + 1) / (c + size) for t, c in Counter(w).items()}
            least = min(sum(impact[t] for t in set(w[p : p + min_words])) for p in range(len(w) - min_words + 1))
            weighed.append((least, i, w, answer, impact))
        weighed.sort(key=lambda x: (x[0], x[1]))
        self.ids = [i for _, i, *_ in weighed]
        self.answers = [a for *_, a, _ in weighed]
        self.vocabulary: dict[str, int] = {}
        self.words = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w], dtype=np.int64) for _, _, w, _, _ in weighed]
        self.width = len(self.vocabulary) + 1
        pairs = [w[:-1] * self.width + w[1:] for w in self.words]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
        # Runs of each item, by hash; where they stand, for the check word by word.
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        for w in self.words:
            hashes = run_hashes(w, min_words)
            order = np.argsort(hashes, kind="stable")
            self.runs.append((hashes[order], order))
        postings: dict[int, list[tuple[int, float]]] = {}
        for k, (least, _, _, _, impact) in enumerate(weighed):
            for t, x in impact.items():
                postings.setdefault(self.vocabulary[t], []).append((k, x / least))
        # Blocks of (items, impacts, last item, largest impact); items ascend.
        self.blocks: dict[int, list[tuple]] = {}
        self.largest: dict[int, float] = {}
        for t, p in postings.items():
            parts = [p[s : s + POSTINGS] for s in range(0, len(p), POSTINGS)]
            self.blocks[t] = [(tuple(i for i, _ in q), tuple(x for _, x in q), q[-1][0], max(x for _, x in q)) for q in parts]
            self.largest[t] = max(x for _, x in p)

    def retrieve(self, terms: set[int], threshold: float = 1.0 - 1e-9) -> list[int]:
        """Items whose impacts over the terms sum to the threshold: block-max WAND."""
        blocks, largest = self.blocks, self.largest
        cursors = [[blocks[t][0][0][0], t, 0, 0] for t in terms]  # item, term, block, place
        heapq.heapify(cursors)
        found: list[int] = []
        if sum(largest[t] for t in terms) < threshold:
            return found
        while cursors:
            # Pivot: terms in order of their next item, until their bounds reach the threshold.
            taken: list[list] = []
            bound = 0.0
            while cursors and bound < threshold:
                c = heapq.heappop(cursors)
                taken.append(c)
                bound += largest[c[1]]
            if bound < threshold:
                break
            pivot = taken[-1][0]
            while cursors and cursors[0][0] == pivot:
                taken.append(heapq.heappop(cursors))
            # Bound by the blocks that hold the pivot.
            tight = 0.0
            skip = None
            for c in taken:
                b, row = c[2], blocks[c[1]]
                while b < len(row) and row[b][2] < pivot:
                    b += 1
                if b < len(row):
                    tight += row[b][3]
                    skip = row[b][2] if skip is None else min(skip, row[b][2])
            if tight < threshold:
                target = max(pivot, (skip if skip is not None else pivot)) + 1
                if cursors and cursors[0][0] < target:
                    target = max(pivot + 1, min(target, cursors[0][0]))
            else:
                target = pivot + 1
                score = 0.0
                for c in taken:
                    self._forward(c, pivot)
                    if c[0] == pivot:
                        score += blocks[c[1]][c[2]][1][c[3]]
                if score >= threshold:
                    found.append(pivot)
            for c in taken:
                self._forward(c, target)
                if c[0] is not None:
                    heapq.heappush(cursors, c)
        return found

    def _forward(self, c: list, item: int) -> None:
        """Moves a cursor to its first posting at or after the item; None at the end."""
        if c[0] is None or c[0] >= item:
            return
        row = self.blocks[c[1]]
        b, p = c[2], c[3]
        while b < len(row) and row[b][2] < item:
            b, p = b + 1, 0
        if b == len(row):
            c[0] = None
            return
        ids = row[b][0]
        while ids[p] < item:
            p += 1
        c[0], c[2], c[3] = ids[p], b, p

    def passages(self, known: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, end) of the runs of words in which each pair stands in some item; -1 is a word of none."""
        pair = np.where((known[:-1] >= 0) & (known[1:] >= 0), known[:-1] * self.width + known[1:], -1)
        at = np.searchsorted(self.pairs, pair)
        there = np.zeros(len(known) + 1, dtype=np.int8)
        there[1:-1] = (at < len(self.pairs)) & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair)
        # there[k]: words k - 1 and k follow each other; a run of m pairs is one of m + 1 words.
        edge = np.flatnonzero(np.diff(there))
        yield from ((int(a), int(b) + 1) for a, b in zip(edge[::2], edge[1::2], strict=True) if b + 1 - a >= self.min_words)

    def longest_run(self, item: int, passage: np.ndarray) -> int:
        """Words of the longest run that the passage shares with the item, from min_words on; else 0."""
        least = self.min_words
        hashes, where = self.runs[item]
        own = run_hashes(passage, least)
        at = np.searchsorted(hashes, own)
        hit = (at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == own)
        best = run = 0
        words = self.words[item]
        for p, h in enumerate(hit.tolist()):
            if h:
                q = int(where[at[p]])
                h = bool((words[q : q + least] == passage[p : p + least]).all())
            run = run + 1 if h else 0
            best = max(best, run)
        return best + least - 1 if best else 0

    def leaks(self, words: list[str]) -> list[tuple[int, int, bool | None]]:
        """(item id, longest shared run in words, answer found) of every item that the words hold a run of."""
        least, get = self.min_words, self.vocabulary.get
        if len(words) < least or not self.ids:
            return []
        known = np.array([get(w, -1) for w in words], dtype=np.int64)
        longest: dict[int, int] = {}
        for start, end in self.passages(known):
            found: set[int] = set()
            for s in range(start, max(start + 1, end - least + 1), WINDOW - least + 1):
                found.update(self.retrieve(set(known[s : min(end, s + WINDOW)].tolist())))
            for k in found:
                if run := self.longest_run(k, known[start:end]):
                    longest[k] = max(longest.get(k, 0), run)
        if not longest:
            return []
        said = f" {' '.join(words)} "
        return [(self.ids[k], run, f" {' '.join(self.answers[k])} " in said if self.answers[k] else None) for k, run in longest.items()]


LEAKS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("run_words", T.IntegerType()), T.StructField("answer_found", T.BooleanType())])


def _compiled(batches: Iterator[pa.RecordBatch], min_words: int, block_words: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the index, pickled, of a partition of items (item_id, text, answer)."""

    def block(items: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(ItemIndex(items, min_words), protocol=5)], pa.binary())], names=["block"])

    held, size = [], 0
    for b in batches:
        for item in zip(*(c.to_pylist() for c in b.columns), strict=True):
            words = item[1].count(" ") + 1
            if held and size + words > block_words:
                yield block(held)
                held, size = [], 0
            held.append(item)
            size += words
    if held:
        yield block(held)


@lru_cache(maxsize=HELD)
def _block(path: str, group: int) -> ItemIndex:
    files, at = pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)
    with files.open_input_file(at) as f:
        return pickle.loads(pq.ParquetFile(f).read_row_group(group).column(0)[0].as_py())


def _search(batches: Iterator[pa.RecordBatch], blocks: list[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Leaks of documents (doc_id, text), each part of the corpus against all blocks."""

    def found(part: list[tuple[int, list[str]]]) -> Iterator[pa.RecordBatch]:
        for at in blocks:
            rows = [(d, i, run, a) for d, words in part for i, run, a in _block(*at).leaks(words)]
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.bool_()), strict=True)], names=LEAKS.names)

    part, size = [], 0
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if text:
                part.append((doc, words_of(text)))
                size += len(text)
            # While all blocks are held at once a part needs not be large.
            if size > (CORPUS_PART if len(blocks) > HELD else 200_000):
                yield from found(part)
                part, size = [], 0
    yield from found(part)


def index_items(items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> list[tuple[str, int]]:
    """Builds the index on the executors into the shared folder; (file, row group) of each block."""
    spark = items.sparkSession
    rows = items.select("item_id", "text", "answer").where("item_id is not null and text is not null")
    words = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).alias("n")).first()["n"] or 0
    path = fresh_path(spark, "item-index")
    even = rows.repartitionByRange(max(1, -(-words // block_words)), "item_id").sortWithinPartitions("item_id")
    blocks = even.mapInArrow(partial(_compiled, min_words=min_words, block_words=block_words), "block binary")
    blocks.write.option("maxRecordsPerFile", 1).parquet(path)  # a block a file
    return [(r["file"], 0) for r in spark.read.schema("block binary").parquet(path).select(F.col("_metadata.file_path").alias("file")).orderBy("file").collect()]


def leaked_items(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, run_words, answer_found) of every document and item that share min_words consecutive words."""
    blocks = index_items(items, min_words, block_words)
    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(partial(_search, blocks=blocks), LEAKS)
