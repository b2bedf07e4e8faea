"""Signature trees: nodes with OR-combined bitmaps and size ranges, traversed two at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

FANOUT = 8
WORDS_AT_ONCE = 1 << 18
_POPULATION = np.bitwise_count


@dataclass
class Sets:
    """Sorted token arrays, end to end; rows of side 0 come before those of side 1."""

    nodes: np.ndarray
    sides: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Sets:
        tokens = table.column("tokens").combine_chunks()
        if isinstance(tokens, pa.ChunkedArray):
            tokens = pa.concat_arrays(tokens.chunks)
        sizes = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return cls(
            table.column("node").to_numpy(),
            table.column("side").to_numpy(),
            table.column("label").to_numpy(),
            np.concatenate([[0], np.cumsum(sizes)]),
            tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
        )

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


class Tree:
    """Levels from single sets up to the root; each has bitmaps and ranges of its nodes.

    ``extra`` is the largest excess of a set's size over the bits it sets: a set shares at most
    ``extra`` plus the common bits with any set below another node.
    """

    def __init__(self, sets: Sets, rows: np.ndarray, words: int):
        lengths = sets.sizes[rows]
        bits = np.zeros((len(rows), words), np.uint64)
        owner = np.repeat(np.arange(len(rows)), lengths)
        starts = sets.starts[rows]
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        tokens = sets.tokens[np.repeat(starts, lengths) + place]
        slots = (tokens >> np.uint64(7)) % np.uint64(words * 64)
        word, bit = slots // np.uint64(64), np.uint64(1) << (slots % np.uint64(64))
        np.bitwise_or.at(bits, (owner, word.astype(np.int64)), bit)
        order = np.lexsort((*[bits[:, w] for w in range(min(words, 4))], lengths))
        self.rows = rows[order]
        bits, lengths = bits[order], lengths[order]
        extra = lengths - _POPULATION(bits).sum(1).astype(np.int64)
        self.levels = [(bits, lengths, lengths, extra)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, extra = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(extra, at),
                )
            )

    def label_ranges(self, labels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Smallest and largest label below each node, by level."""
        low = high = labels[self.rows]
        ranges = [(low, high)]
        for _ in self.levels[1:]:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            ranges.append((low, high))
        return ranges


class _Labels:
    """Which sets are connected: the smaller component takes the larger one's label."""

    def __init__(self, labels: np.ndarray):
        self.of = np.unique(labels, return_inverse=True)[1].astype(np.int64)
        self.members = {}
        order = np.argsort(self.of, kind="stable")
        cuts = np.flatnonzero(np.diff(self.of[order])) + 1
        for part in np.split(order, cuts):
            if len(part):
                self.members[int(self.of[part[0]])] = [part]
        self.count = np.bincount(self.of)

    def join(self, one: int, other: int) -> None:
        small, large = sorted((int(self.of[one]), int(self.of[other])), key=lambda x: self.count[x])
        for part in self.members.pop(small):
            self.of[part] = large
            self.members[large].append(part)
        self.count[large] += self.count[small]


def linked(sets: Sets, threshold) -> np.ndarray:
    """Pairs of nodes that link sets which were not connected before, by a dual traversal.

    With both sides present, pairs have one set of each; else both sets are of the one side. A
    pair of tree nodes is left if the size ranges or the largest possible overlap exclude a
    link, or if all sets below both are connected already. Pairs of sets that remain are
    compared exactly.
    """
    if len(sets.nodes) < 2:
        return np.zeros((0, 2), np.int64)
    sides = [np.flatnonzero(sets.sides == side) for side in (0, 1)]
    words = max(1, -(-2 * int(sets.sizes.max()) // 64))
    one = Tree(sets, sides[0] if len(sides[0]) else sides[1], words)
    own = not (len(sides[0]) and len(sides[1]))
    other = one if own else Tree(sets, sides[1], words)
    labels = _Labels(sets.labels)
    local = np.unique(sets.tokens, return_inverse=True)[1]
    marked = np.zeros(int(local.max()) + 1 if len(local) else 1, bool)
    found: list[tuple[int, int]] = []
    levels = [len(one.levels) - 1, len(other.levels) - 1]
    stack = [(levels[0], levels[1], np.zeros(1, np.int64), np.zeros(1, np.int64))]
    at_once = max(64, WORDS_AT_ONCE // words)
    ranges, unions = None, -1
    while stack:
        la, lb, a, b = stack.pop()
        if len(a) > at_once:
            stack.append((la, lb, a[at_once:], b[at_once:]))
            a, b = a[:at_once], b[:at_once]
        if unions != len(found):
            ranges = [one.label_ranges(labels.of), other.label_ranges(labels.of)]
            unions = len(found)
        keep = _may_link(one.levels[la], other.levels[lb], a, b, threshold)
        (low_a, high_a), (low_b, high_b) = ranges[0][la], ranges[1][lb]
        keep &= (low_a[a] != high_b[b]) | (high_a[a] != low_b[b])
        if own and la == lb:
            keep &= (a < b) if la == 0 else (a <= b)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if la == lb == 0:
            _compare(sets, local, marked, one.rows[a], other.rows[b], labels, threshold, found)
            continue
        if la >= lb:
            children = _children(a, len(one.levels[la - 1][0]))
            a, b, la = children[0], b[children[1]], la - 1
        if lb > la:
            children = _children(b, len(other.levels[lb - 1][0]))
            b, a, lb = children[0], a[children[1]], lb - 1
        stack.append((la, lb, a, b))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return np.stack([sets.nodes[pairs[:, 0]], sets.nodes[pairs[:, 1]]], 1)


def _children(parents: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Children of each node, and which place of ``parents`` each came from."""
    every = (parents[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    origin = np.repeat(np.arange(len(parents)), FANOUT)
    there = every < count
    return every[there], origin[there]


def _may_link(one, other, a: np.ndarray, b: np.ndarray, threshold) -> np.ndarray:
    bits_a, low_a, high_a, extra_a = one
    bits_b, low_b, high_b, extra_b = other
    keep = threshold.least_overlap(low_a[a] + low_b[b]) <= np.minimum(high_a[a], high_b[b])
    left = np.flatnonzero(keep)
    common = _POPULATION(bits_a[a[left]] & bits_b[b[left]]).sum(1, dtype=np.int64)
    most = common + np.minimum(extra_a[a[left]], extra_b[b[left]])
    keep[left] = threshold.least_overlap(low_a[a[left]] + low_b[b[left]]) <= most
    return keep


def _compare(sets, local, marked, rows_a, rows_b, labels, threshold, found) -> None:
    """Compare each set exactly with its candidates that are not yet connected with it."""
    order = np.argsort(rows_a, kind="stable")
    rows_a, rows_b = rows_a[order], rows_b[order]
    cuts = np.flatnonzero(np.diff(rows_a)) + 1
    for start, stop in zip([0, *cuts], [*cuts, len(rows_a)], strict=True):
        x = rows_a[start]
        ys = rows_b[start:stop]
        ys = ys[labels.of[ys] != labels.of[x]]
        if not len(ys):
            continue
        mine = local[sets.starts[x] : sets.starts[x + 1]]
        marked[mine] = True
        parts = [marked[local[sets.starts[y] : sets.starts[y + 1]]] for y in ys]
        common = np.array([np.count_nonzero(p) for p in parts])
        marked[mine] = False
        total = len(mine) + sets.sizes[ys]
        for y in ys[common >= threshold.least_overlap(total)]:
            if labels.of[x] != labels.of[y]:
                labels.join(int(x), int(y))
                found.append((int(x), int(y)))
