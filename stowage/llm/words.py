"""Words and word windows of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of characters other than space and the controls 9 to 13. Its hash depends on its bytes
only, so that hashes made by different tasks can be compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters between words, as Java and Python pattern classes.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers: two rounds of multiply and shift."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def chunks(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` text bytes; a longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and where each row starts, with the end of the last."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and where each row's words start, with the end of the last."""
    raw, at = text_bytes(column)
    if lower:
        raw = _LOWER[raw]
    solid = ~_IS_BLANK[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    rows = at[:-1][at[:-1] < len(raw)]
    first[rows] = solid[rows]
    starts = np.flatnonzero(first)
    # rows without bytes share their start with the next row, which searchsorted handles alike
    bounds = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    kept = np.flatnonzero(solid)
    begins = np.searchsorted(kept, starts)
    lengths = np.diff(np.append(begins, len(kept)))
    place = np.arange(len(kept)) - np.repeat(begins, lengths)
    step = powers(_STEP, int(lengths.max()))
    hashes = np.add.reduceat(_BYTE[raw[kept]] * step[place], begins)
    return mix(hashes + lengths.astype(np.uint64)), bounds


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, row by row; a row with fewer words has its whole sequence."""
    counts = np.diff(bounds)
    full = np.maximum(counts - width + 1, 0)
    step = powers(_STEP, width + 1)[1:]
    if len(hashes) >= width:
        sums = sum(hashes[k : len(hashes) - width + 1 + k] * step[k] for k in range(width))
    else:
        sums = np.zeros(0, dtype=np.uint64)
    sums = mix(sums)
    made = np.where(counts > 0, np.maximum(full, 1), 0)
    ends = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(ends[-1], dtype=np.uint64)
    whole = np.repeat(full > 0, made)
    inside = np.arange(ends[-1]) - np.repeat(ends[:-1], made) + np.repeat(bounds[:-1], made)
    out[whole] = sums[inside[whole]]
    for row in np.flatnonzero((full == 0) & (counts > 0)):
        words = hashes[bounds[row] : bounds[row + 1]]
        out[ends[row]] = mix_int(int((words * step[: len(words)]).sum(dtype=np.uint64)) ^ len(words) << 3)
    return out, ends


def mix_int(x: int) -> int:
    """``mix`` of one number."""
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))[0])
