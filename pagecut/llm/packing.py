"""Compact cells: many small values that travel as one binary value."""

from __future__ import annotations

import numpy as np
import zstandard

#: A byte that no UTF-8 text holds.
_END = b"\xff"


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2^32 - 1; equal bytes stand together, so small numbers cost little."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(w.encode() + _END for w in words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(_END)[:-1]


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``start``, one after the other."""
    upto = np.cumsum(size)
    return flat[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]
