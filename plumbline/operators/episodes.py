"""Fixed-length episodes over a contiguous capture and their embargoed chronological split."""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

EPISODE_LEN = 4096
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
EMBARGO_EPISODES = 1
EPISODE_PREFIX = "gpu"
SPLITS = ("train", "validation", "test")


class BuildError(RuntimeError):
    """A precondition or a fidelity check of a build failed; nothing is marked complete."""


@dataclass(frozen=True)
class SplitLayout:
    """Chronological blocks of whole episodes: lengths in order, with the split each belongs to (None: to none)."""

    blocks: tuple[tuple[str | None, int], ...]

    @property
    def edges(self) -> list[int]:
        """Where each block begins, and where the last one ends."""
        return list(accumulate((n for _, n in self.blocks), initial=0))

    @property
    def n_episodes(self) -> int:
        return self.edges[-1]

    @property
    def embargo(self) -> tuple[int, ...]:
        edges = self.edges
        return tuple(e for i, (name, n) in enumerate(self.blocks) if name is None for e in range(edges[i], edges[i] + n))

    def bounds(self, split: str) -> tuple[int, int]:
        at = [name for name, _ in self.blocks].index(split)
        return self.edges[at], self.edges[at + 1]

    def split_of(self, episode: int) -> str | None:
        block = bisect_right(self.edges, episode) - 1
        if block not in range(len(self.blocks)):
            raise BuildError(f"there is no episode {episode} in a layout of {self.n_episodes}")
        return self.blocks[block][0]

    def split_column(self, episode: Column) -> Column:
        """Split name per row, null in the embargo, an error outside the layout."""
        edges = self.edges
        inside = (episode >= edges[0]) & (episode < edges[-1])
        names = F.array(*[F.lit(name).cast("string") for name, _ in self.blocks])
        block = sum(((episode >= edge).cast("int") for edge in edges[1:-1]), F.lit(0))
        refused = F.raise_error(F.concat(F.lit("episode outside the split layout: "), episode.cast("string")))
        return F.when(episode.isNotNull() & ~inside, refused.cast("string")).otherwise(F.get(names, block))


def split_episodes(
    n_episodes: int,
    train_fraction: float = TRAIN_FRACTION,
    validation_fraction: float = VALIDATION_FRACTION,
    embargo: int = EMBARGO_EPISODES,
) -> SplitLayout:
    """Three chronological blocks with ``embargo`` whole episodes left out between them; the test block takes the rest."""
    lengths = [math.floor(n_episodes * share) for share in (train_fraction, validation_fraction)]
    rest = n_episodes - sum(lengths) - 2 * embargo
    if n_episodes < len(SPLITS) + 2 * embargo or rest < 1:
        raise BuildError(f"{n_episodes} episodes with gaps of {embargo} leave no episode for one of the three blocks")
    gap = (None, embargo)
    train, validation, test = zip(SPLITS, [*lengths, rest], strict=True)
    return SplitLayout((train, gap, validation, gap, test))


def episode_count(rows: int, episode_len: int = EPISODE_LEN) -> int:
    return -(-rows // episode_len)


def episode_number(row_index: Column, episode_len: int = EPISODE_LEN) -> Column:
    return F.call_function("div", row_index, F.lit(episode_len))


def episode_id(episode: Column, prefix: str = EPISODE_PREFIX) -> Column:
    return F.format_string(f"{prefix}-%06d", episode)


def episode_name(episode: int, prefix: str = EPISODE_PREFIX) -> str:
    return f"{prefix}-{episode:06d}"


def step_index(row_index: Column, episode_len: int = EPISODE_LEN) -> Column:
    return (row_index % F.lit(episode_len)).cast("int")


def add_episodes(df: DataFrame, order_by: str, episode_len: int = EPISODE_LEN) -> DataFrame:
    """Add ``episode, episode_id, step_idx`` derived from a contiguous row index."""
    episode = episode_number(F.col(order_by), episode_len)
    return df.withColumns(
        {
            "episode": episode,
            "episode_id": episode_id(episode),
            "step_idx": step_index(F.col(order_by), episode_len),
        }
    )


def split_rows(
    df: DataFrame, layout: SplitLayout, split: str, order_by: str, episode_len: int = EPISODE_LEN
) -> DataFrame:
    """Rows of one split as a plain range on the row index, so Parquet can skip the other row groups."""
    low, high = layout.bounds(split)
    return df.filter((F.col(order_by) >= low * episode_len) & (F.col(order_by) < high * episode_len))


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split).isNotNull()).groupBy(split).agg(F.count("*").alias("n"))
