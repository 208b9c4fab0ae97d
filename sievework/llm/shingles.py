"""Hashes of words and of runs of words, vectorised over the bytes of many texts.

A word hash is a polynomial over 64 random bits per byte value, scaled so that it does not depend
on the word's place, and then mixed. Equal words always have equal hashes; different ones share a
hash with a chance of about 2^-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5  # words of a shingle
# Texts are hashed in pieces of about this many bytes, which bounds the memory of a task.
PIECE = 1 << 19

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# A-Z count as a-z, and these bytes separate words.
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLACES = _RANDOM.integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts]), starts


def word_hashes(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text in turn; none for a missing or empty text."""
    held: list[bytes] = []
    size = 0

    def joined() -> Iterator[np.ndarray]:
        hashes, starts = _hash_words(b" ".join(held))
        ends = np.cumsum([len(t) + 1 for t in held])
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))

    for text in texts:
        text = text or b""
        if len(text) > PIECE:
            if held:
                yield from joined()
            held, size = [], 0
            yield _long_text(text)
            continue
        if size + len(text) > PIECE:
            yield from joined()
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield from joined()


def _long_text(text: bytes) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not _SPACE[text[end]]:  # never inside a word
            end += 1
        parts.append(_hash_words(text[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_hashes(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hash of each run of ``width`` (at most five) words, repeats included; a shorter text is one run as a whole."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, width)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total += mixed(hashes[i : n - width + 1 + i]) * _PLACES[i]
    return mixed(total)
