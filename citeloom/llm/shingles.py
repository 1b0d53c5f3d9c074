"""Words and shingles of Arrow text batches, worked with numpy over the raw UTF-8 bytes.

Words are maximal runs of bytes other than ASCII white space; A-Z count as a-z. A word's hash takes
its bytes eight at a time into a keyed, scrambled state of 64 bits; long words are hashed by keyed
BLAKE2b. A shingle's hash mixes the hashes of its words. Where results depend on equality,
``exact_sets`` numbers the words themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time, so that memory stays bounded whatever the batch holds.
CHUNK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Odd factors without a common pattern, one for each word of a shingle.
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; a null text has no bytes."""
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(len(column), max(first + 1, last))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in order, and for each document the number of words before it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    is_word = ~_IS_SPACE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, key: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each document the number of words before it."""
    starts, ends, first = word_bounds(data, offsets)
    said = np.zeros(len(data) + 8, np.uint8)
    said[:-8] = _LOWER[data]
    eights = np.ndarray(len(data) + 1, np.uint64, said, strides=(1,))
    secret = np.frombuffer(hashlib.blake2b(key, digest_size=16).digest(), np.uint64)
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + secret[0])
    todo, at = np.flatnonzero(sizes <= LONG_WORD), 0
    while len(todo):
        left = np.minimum(sizes[todo] - at, 8).astype(np.uint64)
        part = eights[starts[todo] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[todo] = mix((out[todo] ^ part) + secret[1])
        at += 8
        todo = todo[sizes[todo] > at]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(said[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out, first


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words that start at each word (the last ones are too short to count)."""
    out = np.zeros(len(words), np.uint64)
    for k in range(min(width, len(words))):
        out[: len(words) - k] += words[k:] * _FACTORS[k]
    return mix(out)


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    ordered = np.sort(numbers)
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return ordered[first]


def documents_of(column: pa.Array, width: int, key: bytes = b"") -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words has one shingle, the whole sequence; a text without words has none.
    """
    for _, data, offsets in text_chunks(column):
        words, first = word_hashes(data, offsets, key)
        shingles = shingle_hashes(words, width)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                yield distinct(shingles[a : b - width + 1])
            elif b > a:
                yield mix(np.array([np.bitwise_xor.reduce(mix(words[a:b] + np.arange(b - a, dtype=np.uint64))) + np.uint64(b - a)]))
            else:
                yield shingles[:0]


def exact_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct numbers of its shingles; within one call equal numbers mean
    equal words.

    Words get the numbers of their places in a dictionary. A shingle's number is built word by word,
    number times base plus next word; before it would exceed 63 bits, the numbers so far are replaced
    by their ranks. A text of fewer words than a shingle shares its one number with no other text.
    """
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    starts, ends, first = word_bounds(data, offsets)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    said = _LOWER[data[~_IS_SPACE[data]]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(said)])
    coded = words.dictionary_encode()
    numbers, base = coded.indices.to_numpy().astype(np.int64), max(2, len(coded.dictionary))
    n = len(numbers)
    runs, bound = numbers, base
    for k in range(1, min(width, n)):
        if bound * base >= 1 << 63:
            values, runs = np.unique(runs, return_inverse=True)
            bound = len(values)
        runs, bound = runs[: n - k] * base + numbers[k:], bound * base
    out = []
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        out.append(distinct(runs[a : b - width + 1]) if b - a >= width else np.full(min(1, b - a), -1 - i, np.int64))
    return out
