"""Words, shingles and lines of whole batches of texts as numpy arrays.

Everything works on the UTF-8 bytes of an Arrow string column: one pass finds
the words of all texts of a slice and hashes them, without a Python loop over
words.  Words, shingles and lines are compared by 64-bit hashes; two different
ones of one text collide with a probability of about ``n ** 2 / 2 ** 65``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes, so that the memory
# of a task does not depend on the size of its batches.
SLICE_BYTES = 1 << 20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over all bytes, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
# After lower-casing: digits, a to z and every byte of a character beyond ASCII.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
# First bytes of characters: one per code point.
LEADING = ~byte_class((0x80, 0xBF))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers of a seed."""
    begin = np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + begin)


_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = stream(1, 256) | np.uint64(1)
_WEIGHTS = stream(2, 64) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    size = 1 << bits
    out = []
    for base in (_BASE, _BASE_INVERSE):
        values = np.ones(size, np.uint64)
        filled, factor = 1, base
        while filled < size:
            np.multiply(values[:filled], np.uint64(factor), out=values[filled:2 * filled])
            filled, factor = 2 * filled, factor * factor % (1 << 64)
        out.append(values)
    return out[0], out[1]


@dataclass
class Texts:
    """UTF-8 bytes of several texts one after another, and where each begins."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> str:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes().decode()


def texts_of(column: pa.Array) -> Texts:
    """The bytes of an Arrow string column; NULL is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0]:bounds[-1]], bounds - bounds[0])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a per-byte mask over each text."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[bounds])


def _segment_hashes(data: np.ndarray, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start up to the next; bytes with code 0 do not count."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(max(20, int(len(data) - 1).bit_length()))
    weighted = codes[data]
    weighted *= power[:len(data)]
    return mix(np.add.reduceat(weighted, start) * inverse[start])


@dataclass
class Words:
    """Words of several texts: byte spans, hashes, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: Texts, inside: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes of the class ``inside``, after mapping bytes by ``fold``."""
    data = texts.data if fold is None else fold[texts.data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    part = inside[data]
    begins = part.copy()
    begins[1:] &= ~part[:-1]
    edge = texts.bounds[:-1]
    edge = edge[edge < n]
    begins[edge] = part[edge]
    ends = part.copy()
    ends[:-1] &= ~part[1:]
    edge = texts.bounds[1:] - 1
    edge = edge[edge >= 0]
    ends[edge] = part[edge]
    start = np.flatnonzero(begins)
    codes = np.where(inside, _CODES, np.uint64(0))
    return Words(start, np.flatnonzero(ends) + 1, _segment_hashes(data, codes, start),
                 np.searchsorted(start, texts.bounds))


def window_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` words inside one text, and the word each begins at."""
    total = len(words.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = total - n + 1
    acc = words.hash[:size] * _WEIGHTS[0]
    for j in range(1, n):
        acc += words.hash[j:j + size] * _WEIGHTS[j]
    acc += np.uint64(n)
    text = words.text_of_word
    at = np.flatnonzero(text[:size] == text[n - 1:])
    return mix(acc[at]), at


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words per text, sorted inside each text, and their bounds.

    A text with fewer words, but not none, has its whole sequence as its one shingle.
    """
    hashes, at = window_hashes(words, n)
    counts = words.counts
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(bounds[-1], np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    place = np.ones(len(out), bool)
    place[bounds[short]] = False
    out[place] = hashes
    if len(short):
        acc = counts[short].astype(np.uint64)
        for j in range(n - 1):
            more = counts[short] > j
            acc[more] += words.hash[words.first[short[more]] + j] * _WEIGHTS[j]
        out[bounds[short]] = mix(acc)
    edges = bounds.tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[bounds[:-1][size > 0]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], kept[bounds]


def repeated(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mask of the values that occur twice or more between the same two bounds."""
    hit = np.zeros(len(values), bool)
    copy = values.copy()
    edges = bounds.tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > 1:
            part = copy[a:b]
            part.sort()
            same = part[1:] == part[:-1]
            if same.any():
                hit[a:b] = np.isin(values[a:b], part[1:][same])
    return hit


@dataclass
class Lines:
    """Lines with at least one word: hashes, and the first line of each text."""

    hash: np.ndarray
    first: np.ndarray


_LINE_CODES = stream(3, 256) | np.uint64(1)
_LINE_CODES[ord("\n")] = 0


def lines_of(texts: Texts, words: Words) -> Lines:
    """Lines between newlines that hold a word, compared byte by byte through their hash."""
    data, n = texts.data, len(texts.data)
    begins = np.zeros(n + 1, bool)
    begins[1:] = np.concatenate((data == ord("\n"), []))[:n] if n else False
    begins[texts.bounds[:-1]] = True
    start = np.flatnonzero(begins[:n])
    hashes = _segment_hashes(data, _LINE_CODES, start)
    filled = np.zeros(len(start), bool)
    filled[np.searchsorted(start, words.start, "right") - 1] = True
    start = start[filled]
    return Lines(hashes[filled], np.searchsorted(start, texts.bounds))
