"""Words of a text, and hashes of word runs for a whole batch of texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; that is what ``bytes.split()`` yields.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_KEEP = 250_000
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


class _Hashes(dict):
    """64-bit hash of each distinct word met so far."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    values = values ^ (values >> _U(30))
    values = values * _U(0xBF58476D1CE4E5B9)
    values = values ^ (values >> _U(27))
    values = values * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def split(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Words of a text in UTF-8; ``lower`` maps A-Z to a-z and nothing else."""
    if not text:
        return []
    return (text.lower() if lower else text).split()


def _concatenated(texts: pa.Array | list, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, a space and the next 8 bytes after each other; number of bytes before each text."""
    raw = [t or b"" for t in (texts if isinstance(texts, list) else texts.to_pylist())]
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.fromiter((len(t) + 1 for t in raw), np.int64, len(raw)))])
    joined = b" ".join([*raw, b" " * 8])
    return np.frombuffer(joined.lower() if lower else joined, np.uint8), offsets


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper and lower half of the 128-bit products, combined by exclusive or."""
    half, low = _U(32), _U(0xFFFFFFFF)
    al, ah, bl, bh = a & low, a >> half, b & low, b >> half
    middle = (al * bl >> half) + (ah * bl & low) + al * bh
    return (ah * bh + (ah * bl >> half) + (middle >> half)) ^ (a * b)


def _hash_all(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH3-64 of the words at ``begin``: those of up to 16 bytes all at once, by the three formulas that XXH3 has for them.

    At least eight bytes follow the last word.
    """
    fours, eights = (np.ndarray(len(data) - 7, kind, data, strides=(1,)) for kind in ("<u4", "<u8"))
    found = np.empty(len(begin), _U)
    of = np.flatnonzero(length <= 3)
    at, n = begin[of], length[of]
    first, middle, last = (data[i].astype(_U) for i in (at, at + (n >> 1), at + n - 1))
    h = (first << _U(16) | middle << _U(24) | last | n.astype(_U) << _U(8)) ^ _U(0x87275A9B)
    h = (h ^ (h >> _U(33))) * _U(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> _U(29))) * _U(0x165667B19E3779F9)
    found[of] = h ^ (h >> _U(32))
    of = np.flatnonzero((length > 3) & (length <= 8))
    at, n = begin[of], length[of]
    h = (fours[at + n - 4].astype(_U) + (fours[at].astype(_U) << _U(32))) ^ _U(0xC73AB174C5ECD5A2)
    h ^= (h << _U(49) | h >> _U(15)) ^ (h << _U(24) | h >> _U(40))
    h *= _U(0x9FB21C651E98DF25)
    h = (h ^ ((h >> _U(35)) + n.astype(_U))) * _U(0x9FB21C651E98DF25)
    found[of] = h ^ (h >> _U(28))
    of = np.flatnonzero((length > 8) & (length <= 16))
    at, n = begin[of], length[of]
    low, high = eights[at] ^ _U(0x6782737BEA4239B9), eights[at + n - 8] ^ _U(0xAF56BC3B0996523A)
    h = n.astype(_U) + low.byteswap() + high + _fold(low, high)
    h = (h ^ (h >> _U(37))) * _U(0x165667919E3779F9)
    found[of] = h ^ (h >> _U(32))
    for i in np.flatnonzero(length > 16).tolist():
        found[i] = xxhash.xxh3_64_intdigest(data[begin[i] : begin[i] + length[i]])
    return found


class Batch:
    """The words of a batch of texts as one array, text ``i`` from ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, texts: pa.Array | list, lower: bool = False):
        self._texts, self._lower = texts, lower
        data, offsets = _concatenated(texts, lower)
        inside = np.ones(len(data) + 1, bool)
        inside[0] = False
        np.not_equal(_SPACE[data], True, out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edges[::2], edges[1::2]
        self.starts = np.searchsorted(begin, offsets)
        self.counts = np.diff(self.starts)
        self.hashes = _hash_all(data, begin, end - begin)
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def words(self) -> list[list[bytes]]:
        return [split(t, self._lower) for t in (self._texts if isinstance(self._texts, list) else self._texts.to_pylist())]

    @property
    def text_of(self) -> np.ndarray:
        """Number of the text each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def _prefix(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        if which not in self._sums:
            base = _BASES[which]
            values = mix(self.hashes + _U(which * 0x632BE59BD9B4E019 & _MASK))
            n = len(values)
            powers = np.full(n + 1, _U(base))
            powers[0] = 1
            np.cumprod(powers, out=powers)
            inverse = np.full(n + 1, _U(pow(base, -1, 1 << 64)))
            inverse[0] = 1
            np.cumprod(inverse, out=inverse)
            sums = np.zeros(n + 1, _U)
            np.cumsum(values * powers[:n], out=sums[1:])
            self._sums[which] = (sums, inverse)
        return self._sums[which]

    def run_hash(self, first: np.ndarray, last: np.ndarray, which: int = 0) -> np.ndarray:
        """Hash of the words ``first`` to ``last`` (excluded); equal runs agree wherever they stand."""
        sums, inverse = self._prefix(which)
        lengths = (last - first).astype(_U)
        return mix((sums[last] - sums[first]) * inverse[first] + lengths * _U(0xA0761D6478BD642F))

    def run_starts(self, length: int) -> np.ndarray:
        """First words of all runs of ``length`` words that lie in one text."""
        index = np.arange(len(self.hashes))
        ends = np.repeat(self.starts[1:], self.counts)
        return index[index + length <= ends]


def shingle_sets(batch: Batch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted (text number, hash) columns.

    A text with fewer words than ``size`` has its whole sequence as its one shingle; one without
    words has none.
    """
    sizes = np.where(batch.counts < size, batch.counts > 0, batch.counts - size + 1)
    stops = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = batch.starts[text] + np.arange(len(text)) - (stops - sizes)[text]
    value = batch.run_hash(first, np.minimum(first + size, batch.starts[text + 1]))
    for begin, stop in zip((stops - sizes).tolist(), stops.tolist()):
        value[begin:stop].sort()
    if len(text):
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
        text, value = text[new], value[new]
    return text, value


def lists(counts: np.ndarray, values: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """Arrow lists of ``counts`` values each."""
    offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == _U else values, kind))
