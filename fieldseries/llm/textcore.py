"""Vectorised byte-level text primitives shared by the operators.

Everything here works on the UTF-8 bytes of an Arrow string column, a bounded run of
documents at a time, so the memory of a task does not grow with its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M64 = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
#: One odd random multiplier a byte value; fixed seed, so hashes agree between tasks and runs.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE = [np.uint64(int(x) * 2 + 1) for x in _rng.integers(1, 1 << 63, 64, dtype=np.uint64) >> np.uint64(1)]
_powers: dict[str, np.ndarray] = {}
KEPT = 1 << 19


def powers(base: int, n: int, name: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; a table of up to KEPT numbers is kept between calls."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 18, 1 << int(n - 1).bit_length()) if n <= KEPT else n
        have = np.ones(size, np.uint64)
        done, step = 1, base
        while done < size:
            more = have[done : 2 * done]
            np.multiply(have[: len(more)], np.uint64(step), out=more)
            done, step = 2 * done, step * step & _M64
        if size <= KEPT:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums S with S[j] - S[i] = hash of data[i:j] times R**i; one longer than data."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(_R, len(data), "r"), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end); equal bytes hash alike wherever they stand."""
    inv = powers(_RINV, len(sums), "i")
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), offsets


def byte_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of documents of about limit bytes together; a longer one stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b
        a = b


def byte_class(word: str) -> np.ndarray:
    """256 flags. "space": all but white space [\\x20\\x09-\\x0D]; "alnum": 0-9, a-z, A-Z and >= 0x80."""
    flags = np.ones(256, bool)
    if word == "space":
        flags[[0x20, 9, 10, 11, 12, 13]] = False
    else:
        flags[:128] = False
        for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
            flags[a:b] = True
    return flags


NOT_SPACE, ALNUM = byte_class("space"), byte_class("alnum")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, bounds: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of flagged bytes; bounds (from 0 to len(data)) cut words."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = flags[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = bounds[:-1][bounds[:-1] < len(data)]
    first[cut] |= inside[cut]
    start = np.flatnonzero(first)
    stop = np.zeros(len(data) + 1, bool)
    stop[1:] = inside[:-1] & ~inside[1:]
    last = bounds[1:][bounds[1:] > 0]
    stop[last] |= inside[last - 1]
    end = np.flatnonzero(stop)
    return start, end, np.searchsorted(bounds, start, "right") - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words() with a 64-bit hash each; the case of A-Z does not matter."""
    low = LOWER[data]
    start, end, doc = words(low, bounds, flags)
    return start, end, doc, span_hash(prefix_hash(low), start, end)


def word_hashes_exact(data: np.ndarray, bounds: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words() with a 64-bit hash each, case and all."""
    start, end, doc = words(data, bounds, flags)
    return start, end, doc, span_hash(prefix_hash(data), start, end)


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of `size` words; a shorter document's whole sequence is one."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    total = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * SHINGLE[k]
    whole = doc[: len(total)] == doc[size - 1 :] if len(total) else np.zeros(0, bool)
    full, of = total[whole], doc[: len(total)][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        extra[has] += hashes[first[short[has]] + k] * SHINGLE[k]
    extra += count[short].astype(np.uint64) * SHINGLE[size]
    return mix(np.concatenate([full, extra])), np.concatenate([of, short])
