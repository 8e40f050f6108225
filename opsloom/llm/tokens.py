"""Words of UTF-8 texts as numpy arrays, and hashes of words and word windows.

A word is a run of bytes other than 0x20 and 0x09-0x0D; these bytes never occur inside a multi-byte
character. What is decided by equal hashes uses `digests`: every word has a 128-bit XXH3 hash, and a
window's hash is a sum of its words' hashes, each times a random odd factor of its place. Factors of
different places are independent, so no regular sequence of words makes two windows equal.
`range_hashes` are polynomials modulo 2^64, which some regular texts share; they only pick a column
of a model's feature table, where equal hashes share a weight.
"""

from __future__ import annotations

from functools import cache, lru_cache

import numpy as np
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


@cache
def factors(size: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(np.random.default_rng(1).integers(1 << 61, 1 << 63)) * 2 + 1
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a fixed odd base and of its inverse, modulo 2^64."""
    return _powers(1 << max(16, (n + 1).bit_length()))


@cache
def byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng([seed, 2]).integers(0, 1 << 64, 256, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, a line feed after each, and the place of each text's start."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return buffer, np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(texts) else np.zeros(0, np.int64)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Words:
    """The words of several texts: byte ranges and the index of each word's text."""

    def __init__(self, texts: list[bytes]):
        self.buffer, self.text_starts = joined(texts)
        self.starts, self.ends = runs(~SPACE[self.buffer])
        self.text = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)[:-1]])

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int) -> np.ndarray:
        """Feature hashes; different words may share one."""
        return range_hashes(self.buffer, self.starts, self.ends, seed)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each word."""
        raw = b"".join(map(xxhash.xxh3_128_digest, self.buffer.tobytes().split()))
        both = np.frombuffer(raw, "<u8").reshape(-1, 2)
        return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])

    def place(self) -> np.ndarray:
        """Each word's index in its text."""
        return np.arange(len(self.starts)) - self.first[self.text]

    def windows(self, hashes: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of `size` words inside one text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        sums = np.zeros(n, np.uint64)
        for place, factor in enumerate(factors(size, seed)):
            sums += hashes[place : place + n] * factor
        return first, sums[first]


def range_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    up, down = powers(len(buffer))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_values(seed)[buffer] * up[: len(buffer)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
