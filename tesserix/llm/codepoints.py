"""Arrow text as numpy code-point arrays and back: no call per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def one_chunk(texts) -> pa.Array:
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


#: Bytes of text that are turned into code points at a time; a longer text makes a slice of its own.
SLICE_BYTES = 1_500_000


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The array in consecutive slices of bounded size, so that memory follows the slice and not the Arrow batch."""
    texts = one_chunk(texts)
    n = len(texts)
    if texts.nbytes <= SLICE_BYTES or n <= 1:
        yield texts
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    start = 0
    while start < n:
        reach = (ends[start - 1] if start else 0) + SLICE_BYTES
        stop = max(start + 1, int(np.searchsorted(ends, reach, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and the start of each text (one more at the end); null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    if len(cps) == len(raw):
        return cps, offsets - offsets[0]
    heads = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    return cps, heads[offsets - offsets[0]]


def arrow_text(cps: np.ndarray, starts: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    """The texts of a code-point array; rows where `null` is true come out null."""
    raw = np.frombuffer(cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), dtype=np.uint8)
    ends = np.zeros(len(cps) + 1, dtype=np.int64)
    np.cumsum(1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000), dtype=np.int64, out=ends[1:])
    valid = None if null is None or not null.any() else pa.array(~null).buffers()[1]
    return pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [valid, pa.py_buffer(np.ascontiguousarray(ends[starts])), pa.py_buffer(raw)]).cast(pa.string())


def rows_of(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distinct rows that the positions fall in, ascending."""
    return np.unique(np.searchsorted(starts, positions, side="right") - 1)
