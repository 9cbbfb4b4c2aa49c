"""Words of Arrow text columns as 64-bit hashes, in numpy.

Work goes on over pieces of bounded size, whatever the texts' lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; arrays over them fit in a core's cache.
PIECE = 1 << 16
_random = np.random.Generator(np.random.PCG64(20240229))
_PLACE = _random.integers(1, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Keeps the first 0 to 8 bytes of eight.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

#: A-Z as a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words: all but the white space 20 and 09 to 0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of a batch: ``hashes`` of all, ``first[i]:first[i + 1]`` of row i.

    ``starts`` and ``ends`` are places in ``data``, the bytes of all rows.
    """

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, part_of_word: np.ndarray = NOT_SPACE, lines: bool = False) -> Words:
    """The words of each text; with ``lines`` a newline ends a row instead, and
    ``first`` counts lines (:func:`line_rows` has their texts and numbers)."""
    data, offsets = _buffers(texts)
    if lines:
        offsets = line_rows(data, offsets)[0]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    breaks = np.unique(offsets)
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):  # go back to where no word is cut, else on
            row = breaks[np.searchsorted(breaks, end, side="right") - 1]
            place = max(_after_last_space(data, at, end, part_of_word), row)
            if place > at:
                end = place
                break
            end = min(end + PIECE, len(data))
        found.append(_piece(data, at, end, breaks, part_of_word))
        at = end
    hashes, starts, ends = (np.concatenate(x) if found else np.zeros(0, dtype=t)
                            for x, t in zip(list(zip(*found)) or [(), (), ()], (np.uint64, np.int64, np.int64)))
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data)


def line_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows, and the first line of each row (and the count)."""
    after = np.flatnonzero(data == 10) + 1
    bounds = np.concatenate([after, offsets[:-1]])  # a row's last, empty line comes before the next row
    order = np.argsort(bounds, kind="stable")
    first = np.append(np.flatnonzero(order >= len(after)), len(bounds))
    return np.append(bounds[order], len(data)), first


def _after_last_space(data: np.ndarray, at: int, end: int, part_of_word: np.ndarray) -> int:
    """Where the word that reaches ``end`` begins (``at`` if it is cut there)."""
    back = 64
    while True:
        begin = max(at, end - back)
        space = np.flatnonzero(~part_of_word[data[begin:end]])
        if len(space):
            return begin + int(space[-1]) + 1
        if begin == at:
            return at
        back *= 8


def _piece(data, at, end, breaks, part_of_word):
    here = data[at:end].tobytes()
    inside = np.frombuffer(here.translate(part_of_word.tobytes()), dtype=bool)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = breaks[np.searchsorted(breaks, at, side="right"):np.searchsorted(breaks, end)] - at
    opens[cut] |= inside[cut]
    closes[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return _hashes(here.translate(LOWER.tobytes()), starts, ends), starts + at, ends + at


def _hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, eight bytes at a time; bytes and length both count."""
    eights = np.frombuffer(text + bytes(16 - len(text) % 8), dtype="<u8")

    def eight(places, left):
        shift = ((places & 7) << 3).astype(np.uint64)
        cell = places >> 3
        value = (eights[cell] >> shift) | ((eights[cell + 1] << (np.uint64(63) - shift)) << np.uint64(1))
        return value & _FIRST_BYTES[np.minimum(left, 8)]

    lengths = ends - starts
    total = eight(starts, lengths) * _M2 + lengths.astype(np.uint64) * _PLACE[0]
    longer = np.flatnonzero(lengths > 8)
    if len(longer):
        more = (lengths[longer] - 1) >> 3
        first = np.cumsum(more) - more
        k = np.arange(1, int(more.sum()) + 1) - np.repeat(first, more)
        salt = _PLACE[k & 0xFFFF] * ((k >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        value = mix(eight(np.repeat(starts[longer], more) + 8 * k, np.repeat(lengths[longer], more) - 8 * k) + salt)
        total[longer] += np.add.reduceat(value, first)
    return mix(total)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive entries; rows aren't heeded."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    n = len(hashes) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += hashes[k:k + n] * _PLACE[k]
    return mix(total)


def shingles(w: Words, size: int = 5):
    """Distinct shingle hashes of each row, sorted; a row with fewer words has
    one, its whole sequence; a row without words none."""
    grams = windows(w.hashes, size)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield mix((w.hashes[a:b] * _PLACE[100:100 + b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Slices of the batch with about ``limit`` bytes of text, a row at least."""
    length = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(length, length[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task: the worker that ran it
    stays for later tasks, and beside others, at its peak size otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
