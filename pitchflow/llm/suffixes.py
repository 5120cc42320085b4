"""Suffix arrays and common prefixes in numpy, to a limited depth."""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one big-endian number; zeros follow the text."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    return np.ndarray((len(text),), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(sa, rank): suffixes of ``text`` (uint8) in the order of their first ``depth``
    bytes (at least 8); equal beginnings share a rank.

    Larsson-Sadakane refinement: once suffixes are sorted by h bytes, the rank of
    the suffix h positions further sorts them by 2h bytes, and only groups that
    are still unsorted are touched again.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = words_at(text)
    sa = np.argsort(key)
    key = key[sa]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    rank = np.zeros(n + depth, np.int64)  # past the end: the rank of an empty suffix
    h = 8
    while True:
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa] = first + 1
        if h >= depth:
            return sa, rank[:n]
        lone = new & np.concatenate((new[1:], [True]))
        rows = np.flatnonzero(~lone)
        if not len(rows):
            return sa, rank[:n]
        step = min(h, depth - h)
        own = sa[rows]
        key = first[rows].astype(np.uint64) << np.uint64(32) | rank[own + step].astype(np.uint64)
        order = np.argsort(key)
        key = key[order]
        sa[rows] = own[order]
        new[rows] = np.concatenate(([True], key[1:] != key[:-1]))
        h += step


def common_prefixes(text: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``sa``, up to ``limit``.

    Kasai's observation, for all positions at once: where the suffix at i + 1
    follows the one after that at j, i's neighbour, the two share one byte less.
    So only the last position of each such run is compared byte by byte (eight at
    a time); the others count up from it.
    """
    n = len(sa)
    if not n:
        return np.zeros(0, np.int64)
    near = np.full(n, -1, np.int64)
    near[sa[1:]] = sa[:-1]
    ends = np.concatenate(((near[1:] != near[:-1] + 1) | (near[:-1] < 0), [True]))
    last = np.flatnonzero(ends & (near >= 0))
    whole = np.concatenate((text, np.zeros(limit + 16, np.uint8)))
    words = words_at(whole)
    length = np.zeros(len(last), np.int64)
    going = np.arange(len(last))
    for at in range(0, limit, 8):
        x = words[last[going] + at] ^ words[near[last[going]] + at]
        same = x == 0
        bits = np.where(same, 0, 63 - np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64))
        length[going] += np.where(same, 8, np.clip(bits, 0, 63) // 8)
        going = going[same]
        if not len(going):
            break
    # End of the common bytes, as a position; earlier positions of a run stop at their first mismatch.
    stop = np.full(n, np.iinfo(np.int64).max)
    stop[last] = last + length
    differs = (near >= 0) & ~ends & (text != text[np.maximum(near, 0)])
    stop[differs] = np.flatnonzero(differs)
    # Nearest stop at or after each position of the same run.
    run = np.cumsum(np.concatenate(([0], ends[:-1])))
    shared = np.where(near >= 0, np.clip(_nearest(stop, run) - np.arange(n), 0, limit), 0)
    return shared[sa]


def _nearest(stop: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Smallest of ``stop`` from each position to the end of its run."""
    known = stop != np.iinfo(np.int64).max
    at = np.where(known, np.arange(len(stop)), len(stop) - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # the nearest stop is the smallest: stops rise with the position
    return np.where(run[at] == run, stop[at], np.arange(len(stop)))


def merge_sorted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of two ascending arrays without repeats, by binary search, and what both hold."""
    at = np.searchsorted(a, b)
    both = np.zeros(len(b), bool)
    inside = at < len(a)
    both[inside] = a[at[inside]] == b[inside]
    return np.insert(a, at[~both], b[~both]), b[both]
