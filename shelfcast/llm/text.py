"""Words, lines and their hashes over the raw UTF-8 bytes of many texts at once (numpy).

A word is a maximal run of bytes outside the separators of a class table, so that no text is
decoded.  Hashes are 64-bit polynomials over random byte values, mixed at the end."""

from __future__ import annotations

import numpy as np

#: ``[^\x20\x09-\x0D]+``: everything except space, tab, line feed, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over lower-cased text: digits, a-z and all beyond ASCII.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True

#: Bytes that begin a code point.
HEADS = np.ones(256, bool)
HEADS[0x80:0xC0] = False

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the multiplier, kept for the next call."""
    global _POWERS
    if len(_POWERS) < n:
        more = np.full(2 * n, _MULT, np.uint64)
        more[0] = 1
        _POWERS = np.multiply.accumulate(more)
    return _POWERS[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else as it is."""
    return raw + (((raw >= 0x41) & (raw <= 0x5A)) * np.uint8(32))


def runs(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the n + 1 word offsets of the rows."""
    inside = ~separator[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    before[edge], after[edge - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span; the spans are ascending and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    if len(starts) > 1 and (starts[1:] == ends[:-1]).all():
        raw, first = raw[starts[0]:ends[-1]], starts - starts[0]
        at = np.arange(len(raw)) - np.repeat(first, lengths)
    else:
        first = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        raw = raw[at + np.repeat(starts, lengths)]
    values = _BYTE[raw] * powers(int(lengths.max()) + 1)[at]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words, one for each start; the caller drops those across rows."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, np.uint64)
    for j in range(n):
        h = h * _MULT + words[j:j + count]
    return mix(h)


def row_of(word_offsets: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))


def window_starts(word_offsets: np.ndarray, n: int) -> np.ndarray:
    """Starts of all windows of n words that lie within one row."""
    rows = row_of(word_offsets)
    count = max(0, len(rows) - n + 1)
    return np.flatnonzero(rows[:count] == rows[n - 1:n - 1 + count])


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of n words that begins at one of ``starts``."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, starts, 1) if len(starts) < 64 else step.__iadd__(np.bincount(starts, minlength=total + 1)[:total + 1])
    ends = starts + n
    step -= np.bincount(ends, minlength=total + 1)[:total + 1] if len(ends) else 0
    return np.cumsum(step[:total]) > 0


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each row; rows may be empty."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = keys[order[1:]] == keys[order[:-1]]
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
    return same
