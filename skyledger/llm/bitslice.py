"""Hamming distances of many fingerprints at once, on vertical bit planes.

Plane p holds bit p of 64 fingerprints per word. Distances are counted in
vertical binary counters, one carry-save step per plane, that start so that
they overflow exactly beyond the radius. Words whose 64 fingerprints have all
overflowed are dropped between steps.
"""

from __future__ import annotations

import numpy as np

BITS = 64
#: Planes between looks for words to drop.
STRIDE = 4


def planes(values: np.ndarray) -> np.ndarray:
    """``(BITS, words)`` planes of uint64 values; bits past the last value are 0."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, "<u8")
    padded[: len(values)] = values
    out = np.empty((BITS, words), "<u8")
    for p in range(BITS):
        bit = ((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        out[p] = np.packbits(bit, bitorder="little").view("<u8")
    return out


def _near(differences, order: list[int], words: int, radius: int) -> np.ndarray:
    """Words of lanes that differ in at most ``radius`` planes; ``differences(p, kept)`` gives plane p."""
    size = max(1, radius.bit_length())
    kept, over = np.arange(words), np.zeros(words, "<u8")
    start = (1 << size) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = [np.full(words, full if start >> k & 1 else 0, "<u8") for k in range(size)]
    for step, p in enumerate(order, 1):
        carry = differences(p, kept)
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over = over | carry
        if step % STRIDE == 0 and (live := over != full).sum() < len(kept):
            kept, over, counter = kept[live], over[live], [c[live] for c in counter]
            if not len(kept):
                break
    out = np.zeros(words, "<u8")
    out[kept] = ~over
    return out


def lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little")[:n])


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Where ``left[i]`` and ``right[i]`` differ in at most ``radius`` bits."""
    a = planes(left ^ right)
    return lanes(_near(lambda p, kept: a[p, kept], list(range(BITS)), a.shape[1], radius), len(left))


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect exactly what links within ``radius`` connect; ``values`` are distinct.

    Each value is compared with all not yet reached, so a component of m values
    gives m - 1 edges however dense its links are.
    """
    heads: list[np.ndarray] = []
    tails: list[np.ndarray] = []
    left, todo = values, np.zeros(0, "<u8")
    vary = int(np.bitwise_or.reduce(values ^ values[0])) if len(values) else 0
    order = [p for p in range(BITS) if vary >> p & 1]
    sliced = planes(left)
    gone = np.zeros(len(left), bool)
    at = 0
    full, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    while True:
        if len(todo):
            value, todo = todo[-1], todo[:-1]
        else:
            while at < len(left) and gone[at]:
                at += 1
            if at == len(left):
                break
            value, gone[at] = left[at], True
        bits = int(value)
        found = _near(lambda p, kept: sliced[p, kept] ^ (full if bits >> p & 1 else none), order, sliced.shape[1], radius)  # noqa: B023
        near = lanes(found, len(left))
        near = near[~gone[near]]
        if len(near):
            gone[near] = True
            heads.append(np.full(len(near), value, "<u8"))
            tails.append(left[near])
            todo = np.concatenate([todo, left[near]])
        if gone.sum() * 2 > len(left) > 64:  # compare only with what is left
            left = left[~gone]
            sliced, gone, at = planes(left), np.zeros(len(left), bool), 0
    nothing = np.zeros(0, "<u8")
    return np.concatenate([nothing, *heads]), np.concatenate([nothing, *tails])
