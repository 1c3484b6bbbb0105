"""Vectorised scanning of Arrow text columns: bytes, words, rolling hashes, minimizers.

Everything here works on one Arrow batch (or one bounded group) inside a Spark task.
Texts are UTF-8 byte arrays; a null text counts as empty.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; one longer text is handled alone.
CHUNK_BYTES = 1 << 20

#: Hashes that decide are polynomials modulo the prime 2**31 - 1 at two random bases: two different spans of n values have one hash
#: with a probability of (n / 2**31)**2 at most, whatever their structure.
PRIME = np.uint64(2**31 - 1)
_BASES = (1283169405, 796241283)
#: Hashes that only name candidates (minimizers) are polynomials modulo 2**64; a false alarm costs time, no result.
_LOOSE = 0x9E3779B97F4A7C15
_LOOSE_INV = pow(_LOOSE, -1, 1 << 64)
_POWERS: dict[str, list[np.ndarray]] = {}

#: Random 62-bit value of each byte, 31 bits for each base.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**62, 256, dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Returns freed memory to the system at the end of a task's work: Python workers stay on when they are idle, and would hold it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _series(base: int, size: int) -> np.ndarray:
    """base to the powers 0..size-1 modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < size:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), int(PRIME))) % PRIME])
    return out[:size].astype(np.uint32)


def powers(n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each base and its inverse to the powers 0..n-1, modulo the prime."""
    if "up" not in _POWERS or len(_POWERS["up"][0]) < n:
        size = max(n, 1 << 16)
        _POWERS["up"] = [_series(b, size) for b in _BASES]
        _POWERS["down"] = [_series(pow(b, -1, int(PRIME)), size) for b in _BASES]
    return [p[:n] for p in _POWERS["up"]], [p[:n] for p in _POWERS["down"]]


def _fold(x: np.ndarray) -> np.ndarray:
    """A number below 2**33 with the same remainder; below 2**31 + 4 when folded again."""
    return (x & PRIME) + (x >> np.uint64(31))


def _least(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= PRIME, x - PRIME, x)


def _combined(lanes: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    return mix((lanes[0] << np.uint64(31) | lanes[1]) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Rolling-hash prefix sums of 62-bit values, a row for each base: out[:, i] covers values[:i]."""
    up, _ = powers(len(values))
    out = np.zeros((2, len(values) + 1), np.uint64)
    for lane in (0, 1):
        v = values & PRIME if lane == 0 else (values >> np.uint64(31)) & PRIME
        v *= up[lane]
        np.cumsum(_fold(v), out=out[lane, 1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of the hashed values, wherever it stands; spans of other lengths differ too."""
    _, down = powers(sums.shape[1])
    return _combined([_least(_fold(_fold(sums[k][ends] - sums[k][starts])) * down[k][starts]) for k in (0, 1)], ends - starts)


def spliced_hashes(sums: np.ndarray, starts: np.ndarray, gaps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span without the one value at its gap: what span_hashes gives for that sequence."""
    up, down = powers(sums.shape[1])
    lanes = []
    for k in (0, 1):
        before = _fold(_fold(_fold(_fold(sums[k][gaps] - sums[k][starts])) * down[k][starts]))
        behind = _fold(_fold(_fold(_fold(sums[k][ends] - sums[k][gaps + 1])) * down[k][gaps + 1]))
        lanes.append(_least(before + _fold(_fold(behind * up[k][gaps - starts]))))
    return _combined(lanes, ends - starts - 1)


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every window of n values, to choose minimizers by."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if "loose" not in _POWERS or len(_POWERS["loose"][0]) < len(values):
        size = max(len(values), 1 << 16)
        for b, name in ((_LOOSE, 0), (_LOOSE_INV, 1)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POWERS.setdefault("loose", [None, None])[name] = np.cumprod(steps, dtype=np.uint64)
    up, down = _POWERS["loose"]
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[n:] - sums[:count]) * down[:count] + np.uint64(n))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row offsets (rows + 1)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    rows = len(column)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + rows + 1].astype(np.int64) if rows else np.zeros(1, np.int64)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return all_bytes[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """(first row, end row) runs of rows of at most `limit` bytes, or one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and for each row the number of the first word of it (rows + 1)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    return span_hashes(prefix_sums(BYTE_VALUES[data]), starts, ends)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` neighbours."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def super_windows(values: np.ndarray, offsets: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups each row's windows of n values by their minimizer, the smallest hash of the k-grams inside.

    Equal windows hold equal k-grams at equal distances, so they have equal minimizers wherever they
    stand; the leftmost one is taken on ties. A super-window is a maximal run of neighbouring windows with one
    minimizer at one position; no two of its windows are equal.
    Returns (first window, last window, hash of the minimizer).
    """
    empty = np.zeros(0, np.int64)
    if len(values) < n:
        return empty, empty, empty.astype(np.uint64)
    gram = gram_hashes(values, k)
    bits = max(1, int(len(gram)).bit_length())
    low = np.uint64((1 << bits) - 1)
    packed = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    least = sliding_min(packed, n - k + 1)
    lengths = np.diff(offsets)
    docs = np.flatnonzero(lengths >= n)
    begin, stop = offsets[:-1][docs], offsets[1:][docs] - n + 1
    edge = np.zeros(len(least) + 1, np.int8)
    np.add.at(edge, begin, 1)
    np.add.at(edge, stop, -1)
    valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    change = valid.copy()
    change[1:] &= least[1:] != least[:-1]
    change[begin] = True
    lo = np.flatnonzero(change)
    if not len(lo):
        return empty, empty, empty.astype(np.uint64)
    # a run ends before the next one, or with its row
    ends = np.minimum(np.append(lo[1:], len(least)), stop[np.searchsorted(begin, lo, side="right") - 1])
    return lo, ends - 1, gram[(least[lo] & low).astype(np.int64)]


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every whole number of the ranges lo..hi, and the number of its range."""
    count = hi - lo + 1
    owner = np.repeat(np.arange(len(lo)), count)
    first = np.cumsum(count) - count
    return np.arange(len(owner)) - first[owner] + lo[owner], owner


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Marks the positions inside any window of `width` that begins at one of the starts."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, size), -1)
    return np.cumsum(edge[:-1]) > 0
