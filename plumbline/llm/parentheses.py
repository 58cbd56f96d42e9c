"""Balanced parentheses of a forest: range min-max excess blocks, findclose and rank, in numpy."""

from __future__ import annotations

import numpy as np

#: Bits of a block.
BLOCK = 64


class Parentheses:
    """A forest as bits in depth-first order: 1 opens a node, 0 closes it.

    Kept besides the bits: the excess (opened less closed) before each block, the least excess inside it, a tree of these
    minima, and the opened bits and leaf pairs (a 1 followed by a 0) before each block.
    """

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        blocks = max(1, -(-self.size // BLOCK))
        levels = max(1, int(np.ceil(np.log2(blocks)))) if blocks > 1 else 0
        self.width = 1 << levels
        # Closed bits fill the last block: they can only lower the excess after the end.
        padded = np.zeros(self.width * BLOCK, dtype=np.int8)
        padded[: self.size] = bits
        self.steps = (2 * padded - 1).reshape(-1, BLOCK)
        inside = np.cumsum(self.steps, axis=1, dtype=np.int32)
        totals = inside[:, -1].astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(totals)[:-1]])
        least = self.before + inside.min(axis=1)
        # Node i of the tree has the nodes 2i and 2i + 1 below it; the blocks are its leaves.
        self.tree = np.concatenate([np.zeros(self.width, np.int64), least])
        for i in range(levels):
            at = self.width >> (i + 1)
            self.tree[at : 2 * at] = self.tree[2 * at : 4 * at].reshape(-1, 2).min(axis=1)
        flat = padded.reshape(-1)
        pairs = np.zeros(len(flat), dtype=np.int8)
        pairs[:-1] = (flat[:-1] == 1) & (flat[1:] == 0)
        self.bits, self.pairs = padded.reshape(-1, BLOCK), pairs.reshape(-1, BLOCK)
        self.ones_before = np.concatenate([[0], np.cumsum(self.bits.sum(axis=1, dtype=np.int64))[:-1]])
        self.pairs_before = np.concatenate([[0], np.cumsum(self.pairs.sum(axis=1, dtype=np.int64))[:-1]])

    @staticmethod
    def _rank(rows: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block, inside = at // BLOCK, at % BLOCK
        out = before[block].copy()
        for some in _parts(len(at)):
            own = np.cumsum(rows[block[some]], axis=1, dtype=np.int64)
            out[some] += np.where(inside[some] > 0, own[np.arange(len(own)), inside[some] - 1], 0)
        return out

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Opened nodes before each place."""
        return self._rank(self.bits, self.ones_before, at)

    def rank_leaves(self, at: np.ndarray) -> np.ndarray:
        """Leaf pairs that begin before each place."""
        return self._rank(self.pairs, self.pairs_before, at)

    def excess(self, at: np.ndarray) -> np.ndarray:
        """Opened less closed bits up to and including each place."""
        return 2 * self.rank_open(at + 1) - (at + 1)

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The place at which each node opened at ``opens`` is closed: the first later one with an excess less by one."""
        wanted = self.excess(opens) - 1
        block = opens // BLOCK
        out = self._in_block(block, wanted, opens % BLOCK + 1)
        far = np.flatnonzero(out < 0)
        if len(far):
            # Up to the first subtree to the right whose minimum is low enough, and down to its first block.
            node, low = block[far] + self.width, wanted[far]
            climbing = np.ones(len(far), dtype=bool)
            while climbing.any():
                left = node % 2 == 0
                sibling = np.where(left, node + 1, node)
                found = climbing & left & (self.tree[sibling] <= low)
                node = np.where(found, sibling, np.where(climbing, node // 2, node))
                climbing &= ~found
            while (node < self.width).any():
                inner = node < self.width
                left = np.where(inner, 2 * node, node)
                node = np.where(inner, left + (self.tree[left] > low), node)
            out[far] = self._in_block(node - self.width, low, np.zeros(len(far), np.int64))
        return out

    def _in_block(self, block: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The first place from ``start`` on in each block with the wanted excess, or -1."""
        out = np.full(len(block), -1, dtype=np.int64)
        for some in _parts(len(block)):
            b = block[some]
            excess = self.before[b][:, None] + np.cumsum(self.steps[b], axis=1, dtype=np.int64)
            fits = (excess == wanted[some][:, None]) & (np.arange(BLOCK)[None, :] >= start[some][:, None])
            first = fits.argmax(axis=1)
            out[some] = np.where(fits[np.arange(len(b)), first], b * BLOCK + first, -1)
        return out


def _parts(n: int, size: int = 20_000):
    return [slice(at, min(at + size, n)) for at in range(0, n, size)]
