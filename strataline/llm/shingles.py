"""Word shingles of whole texts as 64-bit hashes, computed in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
#: Texts are joined to blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_MULT = np.random.default_rng(6).integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, up to n."""
    global _powers, _inverses
    if len(_powers) <= n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n + 1, BLOCK_BYTES + 1)
        _powers, _inverses = np.full(size, _BASE), np.full(size, inverse)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


def word_runs(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each run of bytes that are not blank, in a block that ends in a blank."""
    gap = blank[data]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a block of lower-cased bytes that ends in a blank."""
    starts, _, hashes = word_runs(data, _BLANK)
    return starts, hashes


def blocks(texts: list[str | None]) -> Iterator[list[int]]:
    """Indexes of the texts, block by block."""
    some: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        some.append(i)
        size += len(t or "")
        if size >= BLOCK_BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, ascending. Fewer words than WIDTH make one shingle; none, none."""
    with np.errstate(over="ignore"):
        for some in blocks(texts):
            coded = [(texts[i] or "").encode("utf-8", "replace") + b" " for i in some]
            data = _LOWER[np.frombuffer(b"".join(coded), np.uint8)]
            starts, words = word_hashes(data)
            bounds = np.searchsorted(starts, np.cumsum([0, *map(len, coded)]))
            n = len(words)
            whole = np.zeros(max(0, n - WIDTH + 1), np.uint64)
            for k in range(WIDTH):
                whole += words[k : k + len(whole)] * _MULT[k]
            whole = mix(whole)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a >= WIDTH:
                    yield np.unique(whole[a : b - WIDTH + 1])
                elif b > a:
                    yield mix(np.array([np.sum(words[a:b] * _MULT[: b - a]) + np.uint64(b - a)], np.uint64))
                else:
                    yield whole[:0]


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of shingles, as two signed numbers."""
    import xxhash

    raw = xxhash.xxh3_128_digest(np.ascontiguousarray(shingles).tobytes())
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)
