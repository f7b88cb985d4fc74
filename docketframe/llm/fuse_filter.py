"""A static binary fuse filter over 64-bit keys: three slots a key in neighbouring segments, 16-bit fingerprints.

Built by peeling in numpy rounds, probed in numpy. A key of the set is always found; another key is found with a
chance of about 2**-16.
"""

from __future__ import annotations

import numpy as np


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments for ``n`` keys."""
    length = 1 << int(np.clip(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25), 2, 18))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    return length, max(1, int(np.ceil(n * factor / length)) - 2) + 2


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2)) >> np.uint64(32)
    base = first.astype(np.int64) * length
    mask = np.uint64(length - 1)
    return np.stack([base + k * length + ((h >> np.uint64(18 * k % 31)) & mask).astype(np.int64) for k in range(3)])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) & np.uint64(0xFFFF)).astype(np.uint16)


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each key owns); None if some keys cannot be peeled."""
    n = slots.shape[1]
    degree = np.bincount(slots.ravel(), minlength=size)
    holders = np.zeros(size, dtype=np.int64)  # the exclusive or of the keys at a slot: the key itself where there is one
    for row in slots:
        np.bitwise_xor.at(holders, row, np.arange(n))
    rounds, left = [], n
    ready = np.flatnonzero(degree == 1)
    while len(ready):
        keys, at = np.unique(holders[ready], return_index=True)
        own = ready[at]
        rounds.append((keys, own))
        left -= len(keys)
        touched = slots[:, keys]
        for row in touched:
            np.subtract.at(degree, row, 1)
            np.bitwise_xor.at(holders, row, keys)
        near = np.unique(touched)
        ready = near[degree[near] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) for distinct uint64 keys."""
    length, segments = _shape(len(keys))
    for seed in range(1, 10_000):
        h = _mix(keys, seed)
        slots = _slots(h, length, segments)
        rounds = _peel(slots, length * segments)
        if rounds is not None:
            break
        if seed % 5 == 0:
            segments += max(1, segments // 10)
    prints, table = _prints(h), np.zeros(length * segments, dtype=np.uint16)
    for chosen, own in reversed(rounds):
        table[own] = 0
        table[own] = prints[chosen] ^ table[slots[0, chosen]] ^ table[slots[1, chosen]] ^ table[slots[2, chosen]]
    return seed, length, segments, table.tobytes()


def contains(keys: np.ndarray, seed: int, length: int, segments: int, fingerprints: bytes) -> np.ndarray:
    table = np.frombuffer(fingerprints, dtype=np.uint16)
    h = _mix(keys, seed)
    slots = _slots(h, length, segments)
    return _prints(h) == table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]
