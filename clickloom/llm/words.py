"""Words, shingles and signatures of whole texts, as numpy arrays, one Arrow batch at a time.

A word is a run of bytes other than the six ASCII white-space characters, its ASCII letters
lower-cased. Words become 64-bit hashes straight from the UTF-8 bytes of a batch, without a
Python object for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that one numpy pass works on; a longer text is a pass of its own.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))[_LOWER]
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64),
                                             np.full(size - 1, _BASE)]), dtype=np.uint64)
    return _powers


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts) and the bytes they point into; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return at, held


def runs(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive texts of at most CHUNK bytes together, or one text."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_hashes(data: np.ndarray, is_word: np.ndarray = _IS_WORD,
                starts: np.ndarray | None = None,
                width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word in ``data``; no word spans one of ``starts``.

    With ``width``: of the first bytes, so many, of every word that has them.
    """
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    if starts is not None:
        first[starts] = inside[starts]
    kept = np.flatnonzero(inside)
    if not len(kept):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    heads = np.flatnonzero(first[kept])
    lengths = np.diff(np.append(heads, len(kept)))
    place = np.arange(len(kept)) - np.repeat(heads, lengths)
    if width is not None:
        begins = (place < width) & np.repeat(lengths >= width, lengths)
        kept, place = kept[begins], place[begins]
        heads = np.flatnonzero(place == 0)
        if not len(heads):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = _BYTE_CODE[data[kept]] * _power_table(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, heads)), kept[heads]


def words_by_text(texts: pa.Array, is_word: np.ndarray = _IS_WORD,
                  width: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each run of texts: the first one's number, word hashes, and where each text's begin."""
    at, held = utf8(texts)
    for first, last in runs(at):
        low = at[first]
        data = held[low:at[last]]
        starts = at[first:last] - low
        hashes, places = word_hashes(data, is_word, starts[starts < len(data)], width)
        cuts = np.searchsorted(places, at[first:last + 1] - low)
        yield first, hashes, cuts


def shingle_codes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one text; fewer words than ``width`` make one shingle."""
    n = len(hashes)
    if not n:
        return hashes
    if n < width:
        code = np.full(1, n, dtype=np.uint64)
        for k in range(n):
            code = mix(code * _BASE + hashes[k:k + 1])
        return code
    codes = hashes[:n - width + 1].copy()
    for k in range(1, width):
        codes *= _BASE
        codes += hashes[k:n - width + 1 + k]
    return np.unique(mix(codes))
