"""Vectorised 64-bit hashes of words and of runs of bytes or words (numpy, inside tasks)."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_rng = np.random.default_rng(20240229)
#: A random value per byte and odd multipliers.
BYTE_VALUE = _rng.integers(0, 1 << 63, 256, dtype=U) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
RUN_BASE = U(0xD6E8FEB86659FD93)
#: Bytes that part words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that are hashed at once; longer words are hashed by themselves.
CHUNK = 1 << 18
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _powers:
        inverse = U(pow(int(BASE), -1, 1 << 64))
        for base in (BASE, inverse):
            steps = np.full(CHUNK, base, dtype=U)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=U))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are not white space."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[np.frombuffer(data, dtype=np.uint8)]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One value per word; equal words have equal values wherever they stand."""
    power, inverse = _tables()
    values = BYTE_VALUE[np.frombuffer(data, dtype=np.uint8)]
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = int(np.searchsorted(ends, low + CHUNK, side="right"))
        if stop <= at:  # one word longer than a chunk
            word = data[starts[at]:ends[at]]
            out[at] = U(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
            at += 1
            continue
        high = int(ends[stop - 1])
        total = np.zeros(high - low + 1, dtype=U)
        np.cumsum(values[low:high] * power[:high - low], out=total[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (total[e] - total[s]) * inverse[s] + (e - s).astype(U)
        at = stop
    return mix(out)


def run_hashes(values: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A hash of every run of ``length`` consecutive values (by doubling; empty if there are too few)."""
    if len(values) < length:
        return np.empty(0, dtype=U)
    base = int(RUN_BASE) + 2 * seed
    done, out = 0, None
    span, power = values, base           # hashes of runs of 1, 2, 4, ... and base to that length
    width, rest = 1, length
    count = len(values) - length + 1
    while rest:
        if rest & 1:
            part = span[done:done + count]
            out = part.copy() if out is None else out * U(power) + part
            done += width
        rest >>= 1
        if rest:
            span = span[:-width] * U(power) + span[width:]
            power = power * power % (1 << 64)
            width *= 2
    return mix(out)


def shingles(data: bytes, words: int = 5) -> np.ndarray:
    """The set of word n-grams, sorted; a text of fewer words is one shingle, one without words none."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=U)
    return np.unique(run_hashes(word_hashes(data, starts, ends), min(words, len(starts))))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
