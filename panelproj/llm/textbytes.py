"""Words, lines and rolling keys of many texts at once, as numpy arrays over one byte buffer.

A batch of texts is a byte array and its offsets; nothing crosses an offset. All keys are
64 bits wide: prefix sums of byte or word values times powers of an odd base, modulo 2^64,
so that a window's key costs one subtraction and one product, whatever its length.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit keys over all their bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    if where is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Ranges of whole rows of at most so many bytes each, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


class Roller:
    """Prefix sums with growing powers, and the keys of windows over them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            base, back = np.full(size, BASE, U64), np.full(size, pow(BASE, -1, 2**64), U64)
            base[0] = back[0] = 1
            self.up, self.down = np.multiply.accumulate(base), np.multiply.accumulate(back)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        self._grow(n + 1)
        out = np.zeros(n + 1, U64)
        np.cumsum(values * self.up[:n], out=out[1:])
        return out

    def keys(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((prefix[ends] - prefix[starts]) * self.down[starts])


class Words:
    """Words [^ \\t-\\r]+ of a slice: byte starts and ends, the row of each, and word counts by row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.solid = solid = ~SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate(([False], solid[:-1])))) if len(data) else np.zeros(0, np.int64)
        self.ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1 if len(data) else np.zeros(0, np.int64)
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.row, minlength=len(offsets) - 1)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def keys(self, roller: Roller, data: np.ndarray) -> np.ndarray:
        prefix = roller.prefix(BYTE_VALUES[data])
        return roller.keys(prefix, self.starts, self.ends)


def window_starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a window of this length fits into its row."""
    sizes = np.diff(offsets)
    steps = np.zeros(offsets[-1] + 1, np.int64)
    fits = sizes >= length
    steps[offsets[:-1][fits]] += 1
    steps[(offsets[1:] - length + 1)[fits]] -= 1
    return np.flatnonzero(np.cumsum(steps[:-1]))


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of the positions lie in a window of this length that begins at one of the distinct starts."""
    steps = np.zeros(total + 1, np.int32)
    steps[starts] += 1
    steps[starts + length] -= 1
    return np.cumsum(steps[:-1]) > 0


def run_counts(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Maximal runs of True in each row."""
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[offsets] = True
    first = mask & (edge[:-1] | ~np.concatenate(([False], mask[:-1]))) if len(mask) else mask
    return row_sums(first, offsets)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def sha256_rows(data: bytes, offsets: np.ndarray) -> list[str]:
    ends = offsets.tolist()
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
