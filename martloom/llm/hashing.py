"""64-bit hashes of word windows, computed for a whole text at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np

# Words of a text hashed together; longer texts go in overlapping pieces.
PIECE = 4096
# A longer word is replaced by a digest of itself, which bounds the memory of a piece.
LONG_WORD = 256
_BASE = 0x9E3779B97F4A7C55


@cache
def _bytes_table() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(np.uint64)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(_BASE, -1, 1 << 64)
            for name, factor in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bounded(word: bytes) -> bytes:
    return b"\x00" + hashlib.blake2b(word, digest_size=24).digest() if len(word) > LONG_WORD else word


def ascii_words(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, split at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each given span of a byte array; equal bytes hash alike wherever they stand."""
    up, down = _powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_bytes_table()[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def windows(words: list[bytes], n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    if lens.max(initial=0) > LONG_WORD:
        words = [_bounded(w) for w in words]
        lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    raw = np.frombuffer(b" ".join(words), np.uint8)
    return spans(raw, starts[: len(words) - n + 1], ends[n - 1 :])


def _pieces(words: list[bytes], n: int) -> Iterator[list[bytes]]:
    for at in range(0, max(1, len(words) - n + 1), PIECE):
        yield words[at : at + PIECE + n - 1]


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words of a text.

    A text with fewer words is one run; a text without words has none. Two
    different runs agree in 64 bits with a chance of 2**-64.
    """
    words = ascii_words(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    n = min(n, len(words))
    return np.unique(np.concatenate([windows(piece, n) for piece in _pieces(words, n)]))
