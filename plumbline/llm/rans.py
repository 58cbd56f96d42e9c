"""Static range asymmetric numeral system (rANS) for token ids, in numpy.

Format of a block: ``lanes`` interleaved coders share one stream of 32-bit words; token i belongs to lane i mod lanes.
States are 64-bit in [2^31, 2^63); frequencies of a shared table add up to 2^scale. Every CHECKPOINT_STEPS steps the
block keeps the lanes' states and the place in the stream, so a decoder can start there: all checkpointed segments of
all blocks at hand are decoded side by side. A block carries the crc32 of its ids.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 32
CHECKPOINT_STEPS = 256
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Table:
    """Symbols in ascending order with frequencies that add up to 2^scale."""

    scale: int
    symbols: np.ndarray
    freqs: np.ndarray

    @staticmethod
    def of_counts(symbols: np.ndarray, counts: np.ndarray, least_scale: int = 16) -> Table:
        """Frequencies in proportion to counts, at least one each; the largest take up what rounding leaves."""
        order = np.argsort(symbols)
        symbols, counts = symbols[order].astype(np.int64), counts[order].astype(np.float64)
        n = max(1, len(symbols))
        scale = max(least_scale, int(np.ceil(np.log2(n))) + 3)
        total = 1 << scale
        freqs = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * total)).astype(np.int64)
        if len(freqs):
            excess = int(freqs.sum()) - total
            if excess <= 0:
                freqs[np.argmax(freqs)] -= excess
            else:
                for i in np.argsort(-freqs):
                    cut = min(excess, int(freqs[i] // 2))
                    freqs[i] -= cut
                    excess -= cut
                    if not excess:
                        break
        return Table(scale, symbols, freqs)

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.freqs)[:-1]]) if len(self.freqs) else np.zeros(0, np.int64)

    def places(self) -> np.ndarray:
        """The symbol's index at each slot."""
        return np.repeat(np.arange(len(self.freqs), dtype=np.uint32), self.freqs)


@dataclass
class Block:
    n_tokens: int
    lanes: int
    states: np.ndarray  # segments x lanes
    offsets: np.ndarray  # first word of each segment
    words: np.ndarray
    crc32: int


def encode(blocks: list[np.ndarray], table: Table, lanes: int = LANES) -> list[Block]:
    """Each array of ids as a block; the blocks are coded side by side."""
    places = np.full(int(table.symbols[-1]) + 1 if len(table.symbols) else 0, len(table.symbols), dtype=np.uint32)
    places[table.symbols] = np.arange(len(table.symbols), dtype=np.uint32)
    index = []
    for b in blocks:
        i = places[b] if len(b) and b.min() >= 0 and b.max() < len(places) else np.full(len(b), len(table.symbols), dtype=np.uint32)
        if len(b) and i.max() >= len(table.symbols):
            raise ValueError("a token id is missing from the frequency table")
        index.append(i)
    steps = [-(-len(b) // lanes) for b in blocks]
    most, n = max(steps, default=0), len(blocks)
    # One symbol more, with the whole range as its frequency, changes no state: it fills the lanes without a token.
    freqs = np.append(table.freqs, 1 << table.scale).astype(np.uint64)
    starts = np.append(table.starts(), 0).astype(np.uint64)
    tokens = np.full((most, n, lanes), len(table.freqs), dtype=np.uint32)
    for k, i in enumerate(index):
        full = np.full(steps[k] * lanes, len(table.freqs), dtype=np.uint32)
        full[: len(i)] = i
        tokens[: steps[k], k] = full.reshape(steps[k], lanes)
    state = np.full((n, lanes), _LOW, dtype=np.uint64)
    words = np.zeros((most, n, lanes), dtype=np.uint32)
    written = np.zeros((most, n, lanes), dtype=bool)
    kept = np.zeros((-(-most // CHECKPOINT_STEPS), n, lanes), dtype=np.uint64)
    scale = np.uint64(table.scale)
    bound = np.uint64(63 - table.scale)
    for t in range(most - 1, -1, -1):
        f, c = freqs[tokens[t]], starts[tokens[t]]
        out = (state >> bound) >= f
        if out.any():
            written[t] = out
            words[t][out] = (state[out] & _MASK).astype(np.uint32)
            state = np.where(out, state >> _WORD, state)
        whole = state // f
        state = (whole << scale) + (state - whole * f) + c
        if t % CHECKPOINT_STEPS == 0:
            kept[t // CHECKPOINT_STEPS] = state
    result = []
    for k, b in enumerate(blocks):
        segments = -(-steps[k] // CHECKPOINT_STEPS)
        mask = written[: steps[k], k]
        per_step = np.concatenate([[0], np.cumsum(mask.sum(axis=1))])
        offsets = per_step[np.arange(segments) * CHECKPOINT_STEPS]
        crc = zlib.crc32(np.ascontiguousarray(b, dtype="<u4").tobytes())
        result.append(Block(len(b), lanes, kept[:segments, k].copy(), offsets, words[: steps[k], k][mask], crc))
    return result


_DAMAGED = "a block of token ids does not match its checksum"


def _check(block: Block, lanes: int, table: Table) -> None:
    """What a decoder relies on before it has ids to check: sizes that fit, states in range, places inside the stream."""
    segments = -(-(-(-block.n_tokens // lanes)) // CHECKPOINT_STEPS)
    sound = (
        block.lanes == lanes
        and block.n_tokens >= 0
        and block.states.shape == (segments, lanes)
        and len(block.offsets) == segments
        and (not segments or len(table.symbols))
        and bool(((block.states >= _LOW) & (block.states < _LOW << _WORD)).all())
        and bool(((block.offsets >= 0) & (block.offsets <= len(block.words))).all())
    )
    if not sound:
        raise ValueError(_DAMAGED)


def decode(blocks: list[Block], table: Table, places: np.ndarray | None = None) -> list[np.ndarray]:
    """The ids of each block, checked against its crc32; all blocks have the same number of lanes.

    Any damage to a block (its words, states, places, sizes or checksum) raises ValueError.
    """
    if not blocks:
        return []
    for b in blocks:
        _check(b, blocks[0].lanes, table)
    places = table.places() if places is None else places
    lanes = blocks[0].lanes
    freqs, starts = table.freqs.astype(np.uint64), table.starts().astype(np.uint64)
    segments = [len(b.states) for b in blocks]
    base = np.concatenate([[0], np.cumsum([len(b.words) for b in blocks])[:-1]]).astype(np.int64)
    total = sum(segments)
    out: list[np.ndarray] = []
    if total:
        state = np.concatenate([b.states for b in blocks if len(b.states)])
        at = np.concatenate([b.offsets + o for b, o in zip(blocks, base, strict=True)]).astype(np.int64)
        stream = np.concatenate([*[b.words for b in blocks], np.zeros(1, np.uint32)]).astype(np.uint64)
        ends = np.repeat(base + [len(b.words) for b in blocks], segments)[:, None]
        left = []
        for b in blocks:
            tokens = b.n_tokens - np.arange(len(b.states)) * CHECKPOINT_STEPS * lanes
            left.append(np.minimum(tokens, CHECKPOINT_STEPS * lanes))
        left = np.concatenate(left)
        found = np.zeros((CHECKPOINT_STEPS, total, lanes), dtype=np.uint32)
        mask = np.uint64((1 << table.scale) - 1)
        scale = np.uint64(table.scale)
        lane = np.arange(lanes)
        for t in range(CHECKPOINT_STEPS):
            live = (t * lanes + lane)[None, :] < left[:, None]
            if not live.any():
                break
            slot = state & mask
            symbol = places[slot]
            found[t] = symbol
            after = freqs[symbol] * (state >> scale) + slot - starts[symbol]
            need = (after < _LOW) & live
            if need.any():
                order = np.cumsum(need, axis=1)
                place = at[:, None] + order - 1
                if (need & (place >= ends)).any():
                    raise ValueError(_DAMAGED)
                fresh = (after << _WORD) | stream[np.where(need, place, len(stream) - 1)]
                after = np.where(need, fresh, after)
                at = at + order[:, -1]
            state = np.where(live, after, state)
        # A segment ends where the next one begins, the last one in the state that the coder began with.
        final = [x for b in blocks if len(b.states) for x in (b.states[1:], np.full((1, lanes), _LOW))]
        if not np.array_equal(state, np.concatenate(final)):
            raise ValueError(_DAMAGED)
        ids = table.symbols[found.transpose(1, 0, 2)] if len(table.symbols) else found.transpose(1, 0, 2)
    first = 0
    for b, n in zip(blocks, segments, strict=True):
        ids_of = ids[first : first + n].reshape(-1)[: b.n_tokens] if n else np.zeros(0, np.int64)
        first += n
        ids_of = np.ascontiguousarray(ids_of, dtype="<u4")
        if zlib.crc32(ids_of.tobytes()) != b.crc32:
            raise ValueError(_DAMAGED)
        out.append(ids_of)
    return out
