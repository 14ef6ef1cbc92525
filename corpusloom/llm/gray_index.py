"""Pairs of 64-bit fingerprints within a few bits, by a hierarchy over Gray order.

Fingerprints sorted by Gray rank have few differing bits between neighbours. Runs of them become
nodes that keep the bits all members share, as a mask and a pattern; runs of nodes become upper
nodes in the same way. Two nodes are compared on the bits both share: those of the upper nodes
count once and are left out further down, and a pair of nodes is dropped with all below it as soon
as the differences added up on the way exceed the limit.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
BLOCK = 1 << 20  # node pairs expanded at a time


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(group: np.ndarray, codes: np.ndarray) -> list[tuple]:
    """Bottom up: (mask, pattern, first child, end child) of the nodes; the top has one per group."""
    levels = [(np.full(len(codes), ~np.uint64(0)), codes, None, None)]
    while True:
        first_of_group = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if len(first_of_group) == len(group) and len(levels) > 1:
            return levels
        place = np.arange(len(group)) - np.repeat(first_of_group, np.diff(np.r_[first_of_group, len(group)]))
        start = np.flatnonzero(place % FANOUT == 0)
        end = np.r_[start[1:], len(group)]
        mask, pattern = levels[-1][0], levels[-1][1]
        unlike = np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[start], end - start), start)
        shared = np.bitwise_and.reduceat(mask, start) & ~unlike
        levels.append((shared, pattern[start] & shared, start, end))
        group = group[start]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b: ``label`` ends with each set's smallest index."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        la, lb = la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def linked(group: np.ndarray, codes: np.ndarray, limit: int) -> np.ndarray:
    """For each code the index of the representative of its linked set within its group.

    ``group`` ascends and codes ascend by Gray rank within a group. Codes of one group link at ``limit`` or
    fewer differing bits; a set is what links reach. Every link is found; pairs are not returned.
    """
    label = np.arange(len(codes))
    if not len(codes):
        return label
    levels = _levels(group, codes)
    tops = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, tops, tops, np.zeros(len(tops), np.int64))]
    while stack:
        level, a, b, gone = stack.pop()
        if level == 0:
            apart = a != b
            _merge(label, a[apart], b[apart])
            continue
        mask, _, start, end = levels[level]
        wide = (end[a] - start[a]) * (end[b] - start[b])
        if len(a) > 1 and wide.sum() > BLOCK:
            half = len(a) // 2
            stack.append((level, a[:half], b[:half], gone[:half]))
            stack.append((level, a[half:], b[half:], gone[half:]))
            continue
        of = np.repeat(np.arange(len(a)), wide)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(wide) - wide, wide)
        width = (end[b] - start[b])[of]
        x, y = start[a][of] + nth // width, start[b][of] + nth % width
        once = x <= y
        x, y, of = x[once], y[once], of[once]
        below, pattern = levels[level - 1][0], levels[level - 1][1]
        fresh_bits = below[x] & below[y] & ~(mask[a] & mask[b])[of]
        total = gone[of] + np.bitwise_count((pattern[x] ^ pattern[y]) & fresh_bits)
        near = total <= limit
        stack.append((level - 1, x[near], y[near], total[near]))
    return label
