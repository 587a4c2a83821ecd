"""Hashes of the words of a text and of their shingles, with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

#: Longer words are hashed by BLAKE2: sums of powers modulo 2^64 are equal for some long words that differ.
LONG_WORD = 64
#: Bytes worked on at a time: temporary arrays stay below some 30 MB.
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)

_BLANKS = b" \t\n\x0b\x0c\r"
#: Odd factors for the places of a shingle.
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_powers = np.ones((2, 1), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = (x ^ (x >> _HALF)) * _ODD
    x = (x ^ (x >> _HALF)) * _ODD
    return x ^ (x >> _HALF)


def _tables(n: int) -> np.ndarray:
    global _powers
    if _powers.shape[1] < n:
        size = 1 << (n - 1).bit_length()
        _powers = np.full((2, size), 1, np.uint64)
        _powers[0, 1:], _powers[1, 1:] = _BASE, _INVERSE
        np.multiply.accumulate(_powers, axis=1, out=_powers)
    return _powers


def _chunk(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    letters = np.frombuffer(data, np.uint8)
    if not len(letters):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    blank = ((letters - np.uint8(9)) < 5) | (letters == 32)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = (edges[1::2], edges[::2]) if not blank[0] else (edges[::2], edges[1::2])
    if not blank[0]:
        starts = np.concatenate([[0], starts])
    if len(ends) < len(starts):
        ends = np.append(ends, len(letters))
    powers, inverse = _tables(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.multiply(letters, powers[: len(letters)], out=sums[1:])
    np.cumsum(sums, out=sums)
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes += (ends - starts).astype(np.uint64) * _ODD
    hashes = mix(hashes)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest()
        hashes[k] = np.frombuffer(digest, np.uint64)[0]
    return hashes, starts, ends


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of UTF-8 text."""
    if len(data) <= CHUNK:
        return _chunk(data)
    found, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and data[end] not in _BLANKS:
            end += 1  # a cut falls on white space only
        part = _chunk(data[at:end])
        found.append((part[0], part[1] + at, part[2] + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; with fewer words, of all of them; none without words."""
    n = len(words)
    if n == 0:
        return words
    count = max(n - size + 1, 1)
    used = min(n, size)
    out = words[:count] * _FACTORS[used]
    for k in range(1, used):
        out += words[k : k + count] * _FACTORS[k - 1]
    return mix(out)


def shingles_at(words: np.ndarray, first: np.ndarray, used: int) -> np.ndarray:
    """Hash of the ``used`` words from each of the words ``first`` on, as :func:`shingles` has it."""
    out = words[first] * _FACTORS[used]
    for k in range(1, used):
        out += words[first + k] * _FACTORS[k - 1]
    return mix(out)
