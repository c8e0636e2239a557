"""Array kernels shared by the operators: words, rolling hashes and ranges over byte arrays."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_BASES = (0xD1342543DE82EF95, 0xA0761D6478BD642F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=U)

#: Bytes of a word: everything but space and the control characters 09 to 0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word: ASCII letters and digits, and all bytes of other characters.
ALPHANUMERIC = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALPHANUMERIC[_low : _high + 1] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def release_memory() -> None:
    """Give freed memory back to the system, which a worker would keep for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values: every input bit reaches every output bit."""
    h = (h + U((_MULTIPLIER * (2 * seed + 1)) & (2**64 - 1))) * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def powers(n: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a hash base, and of its inverse, modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        up, down = np.ones(size, U), np.ones(size, U)
        up[1:] = U(_BASES[base])
        down[1:] = U(pow(_BASES[base], -1, 2**64))
        held = _POWERS[base] = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
    return held[0][:n], held[1][:n]


class Rolling:
    """Rabin-Karp prefix sums of a sequence: the hash of any slice in constant time."""

    def __init__(self, values: np.ndarray, base: int = 0):
        n = len(values)
        up, self.down = powers(n + 1, base)
        self.sums = np.zeros(n + 1, U)
        np.multiply(values, up[:n], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def flatten(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array in one array, and where each text begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    """Start and end of each word, and the first word of each text (with a final end).

    ``kind`` tells by byte value what belongs to a word. No word crosses texts.
    """
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    at = offsets[:-1][full]
    first[at] = inside[at]
    at = offsets[1:][full] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each word that ``words`` gives, in columns: the halves of its 128-bit XXH3.

    Each distinct word is hashed once. Of n distinct words, two agree in one of the halves with a
    probability of about n * n / 2**65 (one in 30,000 for 30 million words); unlike sums of powers modulo 2**64,
    which agree for some pairs of texts whatever the base.
    """
    if len(starts) == 0:
        return np.zeros((0, 2), U)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    flat = np.ascontiguousarray(data[kind[data]])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    digests = b"".join(map(xxhash.xxh3_128_digest, found.dictionary.to_pylist()))
    return np.frombuffer(digests, U).reshape(-1, 2)[found.indices.to_numpy()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n positions lie in a range of ``width`` from one of the starts, each given once."""
    edge = np.zeros(n + 1, np.int8)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge[:n], dtype=np.int32) > 0


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of the values between each bound and the next."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values that crosses none of the bounds."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among those of a sorted array."""
    if len(among) == 0:
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct ones of sorted values."""
    if len(values) == 0:
        return values
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def twice_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct ones of sorted values that stand there at least twice."""
    return distinct_sorted(values[1:][values[1:] == values[:-1]])
