"""Context-tree weighting over byte grams, on arrays.

A gram is ``DEPTH`` context bytes and the byte they precede, packed into a 64-bit
number. A byte is eight binary decisions, each a node of a binary tree; every
context of every depth has such a tree with a Krichevsky-Trofimov estimate per
node. The weighted probability of a node is the half-and-half mix of its own
estimate and of the product over its longer contexts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEPTH = 5
TOP = 2  # contexts of so many bytes begin a subtree that is worked out on its own
_HALF = np.log(0.5)


def lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma of positive numbers, to about 1e-10."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    tail = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * y * y)) / (y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + tail - shift


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the estimate that gives n0 zeros and n1 ones their probability."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - np.log(np.pi)


@dataclass
class Nodes:
    """The nodes of one depth and one bit: which each gram is in, counts, weighted logs."""

    of: np.ndarray  # node of each gram
    key: np.ndarray  # (context, bits so far) of each node
    n0: np.ndarray
    n1: np.ndarray
    own: np.ndarray
    weighted: np.ndarray = field(default_factory=lambda: np.empty(0))


def nodes(grams: np.ndarray, counts: np.ndarray, depth: int) -> list[Nodes]:
    """Of all eight bits, for contexts of ``depth`` bytes."""
    kept = np.uint64((1 << (8 * depth + 8)) - 1)
    keyed = grams & kept
    order = np.argsort(keyed, kind="stable")
    keyed, n, byte = keyed[order], counts[order], (grams[order] & np.uint64(255)).astype(np.int64)
    out = []
    for bit in range(8):
        key = keyed >> np.uint64(8 - bit)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        one = (byte >> (7 - bit)) & 1
        n1 = np.add.reduceat(n * one, first).astype(float)
        n0 = np.add.reduceat(n, first).astype(float) - n1
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)]))
        out.append(Nodes(of, key[first], n0, n1, kt(n0, n1)))
    return out


def weigh(levels: dict[int, list[Nodes]], top: int, below: list[np.ndarray] | None = None) -> None:
    """Fill in the weighted logs from the deepest level of ``levels`` up to ``top``.

    ``below`` gives the sums over longer contexts for the deepest level where that
    isn't the end of the tree.
    """
    deepest = max(levels)
    for depth in range(deepest, top - 1, -1):
        for bit, own in enumerate(levels[depth]):
            if depth == deepest and below is None:
                own.weighted = own.own
                continue
            if depth == deepest:
                longer = below[bit]
            else:
                child = levels[depth + 1][bit]
                up = np.empty(len(child.key), np.int64)
                up[child.of] = own.of
                longer = np.bincount(up, child.weighted, len(own.key))
            own.weighted = np.logaddexp(_HALF + own.own, _HALF + longer)


def mix(
    levels: dict[int, list[Nodes]], bits: np.ndarray, start: list[np.ndarray] | None = None
) -> list[np.ndarray]:
    """Probability of each gram's bits, mixed over the depths of ``levels`` from the longest.

    ``start`` gives what still longer contexts say, nan where none has been seen.
    A context that has not been seen has no say.
    """
    out = []
    for bit in range(8):
        p = start[bit] if start is not None else np.full(bits.shape[1], np.nan)
        for depth in sorted(levels, reverse=True):
            own = levels[depth][bit]
            n0, n1 = own.n0[own.of], own.n1[own.of]
            said = (np.where(bits[bit] == 1, n1, n0) + 0.5) / (n0 + n1 + 1.0)
            weight = np.exp(_HALF + own.own - own.weighted)[own.of]
            mixed = np.where(np.isnan(p), said, weight * said + (1 - weight) * p)
            p = np.where((n0 + n1 > 0) | (depth == 0), mixed, p)
        out.append(p)
    return out


def bits_of(grams: np.ndarray) -> np.ndarray:
    byte = (grams & np.uint64(255)).astype(np.int64)
    return np.array([(byte >> (7 - bit)) & 1 for bit in range(8)])


def pack(data: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The gram that ends at each byte from the ``depth``-th on."""
    out = np.zeros(len(data) - depth, np.uint64)
    for i in range(depth + 1):
        out = (out << np.uint64(8)) | data[i : len(data) - depth + i].astype(np.uint64)
    return out
