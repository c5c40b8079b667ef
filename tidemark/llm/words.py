"""Words of many texts at once: numpy over the bytes of an Arrow batch, no Python object per word.

A word is a longest run of bytes that a table maps to something other than 0; the table also lower-cases A-Z. Every word
gets a 64-bit hash of its mapped bytes. UTF-8 bytes of characters beyond ASCII are word bytes in both tables, so words
are the same as those that a regular expression over code points finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 19
_SEEDED = np.random.Generator(np.random.PCG64(20240229))
_VALUES = _SEEDED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_MIXERS = _SEEDED.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_table(separators: Iterator[int], lower: bool = True) -> np.ndarray:
    """What each byte counts as: 0 for the separators, else itself, A-Z in lower case if wanted."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


#: ``[^\\x20\\x09-\\x0D]+``. A byte 0 is an ordinary character here, so it is mapped to a byte that UTF-8 never has.
BLANKS = byte_table([])
BLANKS[0] = 0xFF
BLANKS[[0x20, *range(0x09, 0x0E)]] = 0
BLANKS_CASED = BLANKS.copy()
BLANKS_CASED[65:91] = np.arange(65, 91)
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
ALNUM = byte_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


@dataclass
class Words:
    """The words of ``len(first) - 1`` texts: text i has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array without nulls, and where each text begins in them."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch of at most ``limit`` bytes of text, each with its texts; null counts as empty."""
    texts = batch.column(column).fill_null("")
    if not len(texts):
        return
    _, offsets = raw(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a public finalizer: xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def split(texts: pa.Array, table: np.ndarray) -> Words:
    """Words of the texts of an Arrow string array without nulls."""
    data, offsets = raw(texts)
    mapped = table[data]
    inside = mapped != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if not len(start):
        empty = np.empty(0, np.int64)
        return Words(mapped, empty, empty, empty, first, np.empty(0, np.uint64))
    end = np.flatnonzero(ends) + 1
    length = (end - start).astype(np.int32)
    heads = np.cumsum(length) - length
    depth = np.arange(heads[-1] + length[-1], dtype=np.int32) - np.repeat(heads.astype(np.int32), length)
    powers = np.full(int(length.max()), _STEP, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    hashed = _VALUES[mapped[inside]]
    hashed *= powers[depth]
    return Words(mapped, start, end, doc, first, mix(np.add.reduceat(hashed, heads)))


def windows(words: Words, width: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words, and where each text's runs begin.

    A text with fewer words, but not none, has its whole sequence as one run if ``short``, else no run.
    """
    counts = words.counts
    runs = np.maximum(counts - width + 1, 0)
    total = len(words.hash)
    out = np.zeros(max(total - width + 1, 0), np.uint64)
    for k in range(width):
        out += words.hash[k:k + len(out)] * _MIXERS[k]
    out = mix(out)
    if short:
        brief = np.flatnonzero((counts > 0) & (counts < width))
        runs[brief] = 1
    first = np.concatenate([[0], np.cumsum(runs)])
    # Position of run j of text i among all words: first word of the text plus j.
    doc = np.repeat(np.arange(len(counts)), runs)
    place = words.first[doc] + np.arange(first[-1]) - first[doc]
    values = np.zeros(len(place), np.uint64)
    whole = counts[doc] >= width
    values[whole] = out[place[whole]]
    if short:
        for i in brief:
            own = words.hash[words.first[i]:words.first[i + 1]]
            values[first[i]] = mix(np.atleast_1d((own * _MIXERS[32:32 + len(own)]).sum(dtype=np.uint64)))[0]
    return values, first


def sorted_sets(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and where each text's begin. Sorts ``values`` in place."""
    for i in range(len(first) - 1):
        values[first[i]:first[i + 1]].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[first[:-1][np.diff(first) > 0]] = True
    sizes = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], sizes[first]


def signed(values: np.ndarray) -> np.ndarray:
    """As Spark's bigint."""
    return np.ascontiguousarray(values).view(np.int64)
