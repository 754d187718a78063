"""Words and word shingles of whole Arrow text columns as 64-bit hashes (numpy, no per-word Python).

A word is a maximal run of characters other than space and ``\\x09-\\x0D``, with A-Z lower-cased. Null text
counts as empty text. Memory is bounded by ``CHUNK`` bytes of working arrays plus eight bytes a word, however
long a text is: long texts are cut between words, never shortened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = [np.uint64(x | 1) for x in np.random.default_rng(7).integers(1, 1 << 62, 64).tolist()]
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < size:
        n = max(size, CHUNK + 1)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null is empty."""
    col = col.cast(pa.large_string()).fill_null("")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _is_space(d: np.ndarray) -> np.ndarray:
    return (d == 32) | ((d >= 9) & (d <= 13))


def _chunks(offsets: np.ndarray, data: np.ndarray):
    """Byte ranges of at most CHUNK bytes that end between words (longer only for one longer word)."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + CHUNK, end)
        if to < end:
            i = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[i] > at:
                to = int(offsets[i])
            else:  # inside one long text
                cut = np.flatnonzero(_is_space(data[at:to]))
                if len(cut):
                    to = at + int(cut[-1]) + 1
                else:
                    stop = int(offsets[i + 1])
                    while to < stop and not _is_space(data[to : to + 1])[0]:
                        to += 1
        yield at, to
        at = to


def word_hashes(col: pa.Array, suffixes: bool = False) -> tuple[np.ndarray, ...]:
    """(word offsets by row, uint64 hash of each word) of a string column; with ``suffixes`` also the last three
    bytes of each word as one number."""
    offsets, data = utf8(col)
    hashes, starts_at, last = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, to in _chunks(offsets, data):
        d = data[at:to].copy()
        d[(d >= 65) & (d <= 90)] += 32
        gap = _is_space(d)
        lo, hi = np.searchsorted(offsets, (at, to), "left")
        edges = offsets[lo:hi] - at
        before = np.empty(len(d), bool)
        before[0], before[1:] = True, gap[:-1]
        before[edges] = True
        after = np.empty(len(d), bool)
        after[-1], after[:-1] = True, gap[1:]
        after[edges[edges > 0] - 1] = True
        word = ~gap
        starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
        up, down = _power_tables(len(d) + 1)
        total = np.zeros(len(d) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[d] * up[: len(d)], out=total[1:])
        hashes.append(mix64((total[ends] - total[starts]) * down[starts]))
        starts_at.append(starts + at)
        if suffixes:
            code = d[ends - 1].astype(np.int64)
            for k in (2, 3):
                code = code * 256 + np.where(ends - k >= starts, d[np.maximum(ends - k, 0)], 0)
            last.append(code)
    starts, hashed = np.concatenate(starts_at), np.concatenate(hashes)
    by_row = np.searchsorted(starts, offsets, "left")
    return (by_row, hashed, np.concatenate(last)) if suffixes else (by_row, hashed)


def shingle_hashes(offsets: np.ndarray, words: np.ndarray, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hash of each run of ``width`` words, in text order). With ``short``, a row with fewer words
    gives its whole sequence as one shingle; a row without words gives none."""
    n = len(words)
    counts = np.diff(offsets)
    full = np.maximum(counts - width + 1, 0)
    mixed = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        mixed += (words[k : k + len(mixed)] ^ _STEPS[20 + k]) * _STEPS[k]
    few = (counts > 0) & (counts < width) if short else np.zeros(len(counts), bool)
    sizes = np.where(few, 1, full)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.empty(int(out_offsets[-1]), np.uint64)
    row = np.repeat(np.arange(len(counts)), full)
    place = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
    out[out_offsets[row] + place] = mixed[offsets[row] + place]
    for i in np.flatnonzero(few):
        h = np.array([counts[i]], np.uint64)
        for k in range(offsets[i], offsets[i + 1]):
            h = mix64(h * _STEPS[40] + words[k : k + 1])
        out[out_offsets[i]] = h[0]
    return out_offsets, mix64(out)
