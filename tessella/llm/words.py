"""Words of a column of texts as 64-bit hashes, by numpy over the column's bytes.

Words are runs of bytes other than white space (U+0020, U+0009 to U+000D). A word's hash is a
polynomial over random 64-bit values of its bytes, taken from one running sum, then mixed; so a
batch costs a few passes over its bytes and no Python object for any word. A second hash, where 64
bits are too few, sums random values for each byte at each place of the word (tabulation), so no
family of words collides in both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_SEGMENT = 1 << 16  # bytes hashed at once: what they need fits a core's cache
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_PLACES = 64
_TABLE = np.random.default_rng(21).integers(0, 1 << 64, _PLACES * 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


#: A-Z in lower case; other ASCII characters than letters and digits are blanks.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z in lower case."""
    return (text or b"").translate(PLAIN).split()


def plain_texts(texts: pa.Array) -> pa.Array:
    """The column with every byte put through ``PLAIN``, so that ``word_hashes`` splits it into ``plain_words``."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    n, offsets = len(texts), np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
    a, z = int(offsets[0]), int(offsets[-1])
    data = bytes(memoryview(texts.buffers()[2])[a:z]).translate(PLAIN) if z > a else b""
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((offsets - a).astype(np.int32)), pa.py_buffer(data)])


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n``."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, _SEGMENT)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        _powers = up, down
    return _powers


def _tabulated(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The second hash of the words ``data[s:e]``."""
    word = np.zeros(len(data), np.int64)
    word[s[1:]] = 1
    place = np.arange(len(data)) - s[np.cumsum(word)]
    values = _TABLE[(place % _PLACES) * 256 + data]
    if len(s) and int((e - s).max()) > _PLACES:  # each further stretch of a long word has a factor of its own, the first has 1
        values *= mix((place // _PLACES).astype(np.uint64)) | _U(1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return mix(total[e] - total[s] + (e - s).astype(np.uint64))


def word_hashes(texts: pa.Array, second: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes of all words in a row, and the place where each text's words begin (and the last ends).

    ``texts`` is a string or binary array; a null text has no words. With ``second`` the second
    hashes of the words come behind.
    """
    texts = texts.cast(pa.binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return (np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(0, np.uint64))[: 2 + second]
    data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0]))
    bounds = offsets - offsets[0]
    inside = ~_SPACE[data]
    before, behind = np.empty(size, bool), np.empty(size, bool)
    before[1:], before[0] = inside[:-1], False
    before[bounds[:-1][bounds[:-1] < size]] = False
    behind[:-1], behind[-1] = inside[1:], False
    behind[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~behind) + 1
    hashes, others = np.empty(len(starts), np.uint64), np.empty(len(starts) if second else 0, np.uint64)
    k = 0
    while k < len(starts):  # segments that begin at a word
        to = max(k + 1, int(np.searchsorted(starts, starts[k] + _SEGMENT)))
        if to < len(starts) or ends[to - 1] - starts[k] > _SEGMENT:
            to = max(k + 1, int(np.searchsorted(ends, starts[k] + _SEGMENT, side="right")))
        a, z = int(starts[k]), int(ends[to - 1])
        up, down = _tables(z - a)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data[a:z]] * up[: z - a])])
        s, e = starts[k:to] - a, ends[k:to] - a
        hashes[k:to] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        if second:
            others[k:to] = _tabulated(data[a:z], s, e)
        k = to
    return (mix(hashes), np.searchsorted(starts, bounds), others)[: 2 + second]


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, from the hashes of the words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, length):
        total *= _U(_BASE)
        total += hashes[k : k + n]
    return mix(total)


def within(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of ``length`` items that lie within one text, and each one's text."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(bounds[:-1] - ends + counts, counts), text
