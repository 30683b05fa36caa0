"""Whole texts as arrays: word places and hashes of many texts at once, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Bytes of text that are worked on at once; a longer text makes a block of its own.
BLOCK = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2**64
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            tables.append(np.cumprod(factors, dtype=np.uint64))
        _powers = tuple(tables)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (an invertible finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring words, by where it begins."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    place = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    return mix(sum(hashes[i : n + i] * place[i] for i in range(size)))


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts, one separator after each
    lower: np.ndarray  # the same, A-Z lower-cased
    text_at: np.ndarray  # where each text begins, and the end of the last
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray  # of the lower-cased words
    first: np.ndarray  # the first word of each text, and the number of words


def blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about BLOCK bytes."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield begin, i
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def encode(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def encoded(texts) -> Iterator[tuple[int, int, list[bytes]]]:
    """The texts of a column block by block, encoded as they are needed: (begin, end, bytes)."""
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    begin = 0
    while begin < len(texts):
        held = np.cumsum(sizes[begin : begin + BLOCK])
        end = begin + max(1, int(np.searchsorted(held + np.arange(len(held)), BLOCK)))
        yield begin, end, encode(texts[begin:end])
        begin = end


def words(texts: list[bytes]) -> Words:
    """Words are runs of anything but white space (ASCII)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_at = np.concatenate([[0], np.cumsum(sizes)])
    low, space = LOWER[data], SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)  # the last byte is a separator
    power, inverse = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return Words(data, low, text_at, starts, ends, hashes, np.searchsorted(starts, text_at))
