"""Linear-chain conditional random field over discrete features, in numpy.

Scores of a sequence: a start weight, an emission weight for each feature of each token, a weight for each pair of
neighbouring labels. Training maximises the regularised log-likelihood by gradient ascent with momentum-free adaptive
steps; decoding is Viterbi over many sequences at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Crf:
    """``emission`` is buckets x labels, ``transition`` from x to; forbidden transitions are very negative."""

    labels: list[str]
    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray


def _packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences in order of falling length; how many are left at each step; where each begins."""
    order = np.argsort(-lengths, kind="stable")
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    sorted_lengths = lengths[order]
    live = np.searchsorted(-sorted_lengths, -np.arange(1, (sorted_lengths[0] if len(lengths) else 0) + 1), side="right")
    return order, live, begins


def viterbi(scores: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best label of every token; ``scores`` has the sequences one after another. All lengths are positive."""
    out = np.zeros(len(scores), dtype=np.int8)
    if not len(lengths):
        return out
    _, live, begins = _packed(lengths)
    n_labels = scores.shape[1]
    best = scores[begins] + start
    back = np.zeros((len(scores), n_labels), dtype=np.int8)
    for t in range(1, len(live)):
        n = live[t]
        # The best label before, for each label now.
        options = best[:n, :, None] + transition[None]
        before = options.argmax(axis=1)
        at = begins[:n] + t
        back[at] = before
        best[:n] = np.take_along_axis(options, before[:, None, :], axis=1)[:, 0] + scores[at]
    last = best.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = begins[:n] + t
        out[at] = last[:n]
        if t:
            last[:n] = back[at, last[:n]]
    return out


def outside_bound(transition: np.ndarray, start: np.ndarray, kinds: int) -> float:
    """The most that transitions can gain by any label but 0 at a place, against label 0 there.

    Labels are 0 and, for each kind, a begin and an inside label; after label 0 an inside label becomes the begin of its
    kind. Taken over all allowed labels before, at and two places after, and over beginnings and ends of a line.
    """
    n = 1 + 2 * kinds
    begin_of = np.array([label - 1 if label and label % 2 == 0 else label for label in range(n)])
    # What comes before: a label, or the beginning of the line.
    into = np.concatenate([transition, start[None]])
    # What comes after: nothing, or a label and then nothing or another label.
    two = np.concatenate([transition, np.zeros((n, 1))], axis=1)
    gain = -np.inf
    for label in range(1, n):
        before = (into[:, label] - into[:, 0])[into[:, label] > -5e3]
        after = [0.0]
        for b in range(n):
            if transition[label, b] > -5e3:
                kept = two[b] > -5e3
                change = transition[label, b] - transition[0, begin_of[b]] + two[b][kept] - two[begin_of[b]][kept]
                after.append(change.max())
        if len(before):
            gain = max(gain, before.max() + max(after))
    return float(gain)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (np.log(np.exp(values - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _expected(scores, lengths, transition, start):
    """Log-partition of all sequences together, label probabilities of tokens, and expected transitions and starts."""
    _, live, begins = _packed(lengths)
    n_labels = scores.shape[1]
    forward = np.zeros((len(scores), n_labels))
    backward = np.zeros((len(scores), n_labels))
    forward[begins] = scores[begins] + start
    for t in range(1, len(live)):
        at = begins[: live[t]] + t
        forward[at] = _log_sum(forward[at - 1][:, :, None] + transition[None], 1) + scores[at]
    for t in range(len(live) - 2, -1, -1):
        at = begins[: live[t + 1]] + t
        backward[at] = _log_sum(transition[None] + (scores[at + 1] + backward[at + 1])[:, None, :], 2)
    ends = begins + np.sort(lengths)[::-1] - 1
    total = _log_sum(forward[ends], 1)
    whole = np.zeros(len(scores))
    pairs = np.zeros((n_labels, n_labels))
    for t in range(len(live)):
        whole[begins[: live[t]] + t] = total[: live[t]]
    marginal = np.exp(forward + backward - whole[:, None])
    inner = np.ones(len(scores), dtype=bool)
    inner[begins] = False
    at = np.flatnonzero(inner)
    for some in np.array_split(at, max(1, len(at) // 50_000)):
        joint = forward[some - 1][:, :, None] + transition[None] + (scores[some] + backward[some])[:, None, :]
        pairs += np.exp(joint - whole[some][:, None, None]).sum(axis=0)
    return total.sum(), marginal, pairs, marginal[begins].sum(axis=0)


def train(
    features: np.ndarray,
    lengths: np.ndarray,
    gold: np.ndarray,
    labels: list[str],
    allowed: np.ndarray,
    n_buckets: int,
    rounds: int = 80,
    rate: float = 0.3,
    penalty: float = 1e-3,
) -> Crf:
    """``features`` is tokens x kinds of feature buckets; ``allowed`` the transitions that may happen."""
    n_labels = len(labels)
    emission = np.zeros((n_buckets, n_labels))
    transition, start = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    never = np.where(allowed, 0.0, -1e4)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inner = np.ones(len(gold), dtype=bool)
    inner[begins] = False
    at = np.flatnonzero(inner)
    seen_pairs = np.zeros((n_labels, n_labels))
    np.add.at(seen_pairs, (gold[at - 1], gold[at]), 1)
    seen_start = np.bincount(gold[begins], minlength=n_labels).astype(float)
    squares = [np.zeros_like(x) + 1e-6 for x in (emission, transition, start)]
    hot = np.zeros((len(gold), n_labels))
    hot[np.arange(len(gold)), gold] = 1
    for _ in range(rounds):
        scores = emission[features].sum(axis=1)
        _, marginal, pairs, starts = _expected(scores, lengths, transition + never, start)
        slope = np.zeros_like(emission)
        for kind in range(features.shape[1]):
            for label in range(n_labels):
                weights = hot[:, label] - marginal[:, label]
                slope[:, label] += np.bincount(features[:, kind], weights=weights, minlength=n_buckets)
        slopes = [slope, seen_pairs - pairs, seen_start - starts]
        for value, g, square in zip((emission, transition, start), slopes, squares, strict=True):
            g = g / len(lengths) - penalty * value
            square += g * g
            value += rate * g / np.sqrt(square)
    return Crf(labels, emission, transition + never, start)
