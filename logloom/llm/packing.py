"""Integer sequences as compressed bytes, for rows that travel through a shuffle."""

from __future__ import annotations

import numpy as np
import zstandard

_ONE, _TWO = 200, 40  # first bytes below _ONE are a value; the next _TWO open two bytes; the rest open four


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**32. Small values (words numbered by frequency, differences) cost about one byte."""
    x = np.asarray(values).astype(np.uint32)
    one, two = x < _ONE, (x >= _ONE) & (x < _ONE + _TWO * 256)
    first = np.where(one, x, np.where(two, _ONE + ((x - _ONE) >> 8), _ONE + _TWO)).astype(np.uint8)
    second = ((x[two] - _ONE) & 255).astype(np.uint8)
    rest = np.ascontiguousarray(x[~one & ~two].view(np.uint8).reshape(-1, 4).T)
    head = np.array([len(first), len(second), rest.shape[1]], np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(b"".join((head.tobytes(), first.tobytes(), second.tobytes(), rest.tobytes())))


def unpack_ints(data: bytes) -> np.ndarray:
    """The uint32 values that ``pack_ints`` got."""
    raw = unzip(data)
    n, n2, n4 = np.frombuffer(raw, np.uint32, 3).tolist()
    first = np.frombuffer(raw, np.uint8, n, 12)
    out = first.astype(np.uint32)
    two = (first >= _ONE) & (first < _ONE + _TWO)
    out[two] = _ONE + ((out[two] - _ONE) << 8) + np.frombuffer(raw, np.uint8, n2, 12 + n)
    rest = np.frombuffer(raw, np.uint8, 4 * n4, 12 + n + n2).reshape(4, n4)
    out[first >= _ONE + _TWO] = np.ascontiguousarray(rest.T).view(np.uint32).ravel()
    return out


def zip_bytes(data) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(bytes(data))


def unzip(data: bytes) -> bytes:
    """``zip_bytes`` of any size, undone."""
    return zstandard.ZstdDecompressor().decompress(data)
