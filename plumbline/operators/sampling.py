"""Reproducible samples that are spread over the whole table and come back in source order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEED = 20260803
# Up to here one top-n does; larger draws first find the digest range that holds the n smallest rows.
TOP_N_ROWS = 100_000
DIGEST_RANGES = 65_536
# Parts of a stratum that are ranked by themselves first, where positions are no integers.
RANK_PARTS = 64
# Up to here tasks rank their own first rows; larger samples are cut at positions found in histograms.
RANKED_ROWS = 100
# Ranges of positions that a histogram counts.
POSITION_RANGES = 4_096


def draw_key(order_by: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(order_by).cast("string")))


def seeded_sample(
    df: DataFrame, n: int, order_by: str, seed: int = SEED, top_n_rows: int = TOP_N_ROWS
) -> DataFrame:
    """Exactly ``n`` rows (all of them if there are fewer), ordered by ``order_by``.

    Rows are ranked by a seeded digest of their order value, so the draw does not depend on partitioning. Null order
    values are drawn like any other. Of rows with equal order values, which only the last place can split, any are drawn.
    """
    # Only keys are ranked; the rows are fetched by a join with the keys that were drawn.
    keyed = df.select(draw_key(order_by, seed).alias("_draw"), F.col(order_by))
    smallest = lambda rows, k: rows.orderBy("_draw", order_by).limit(k)
    if n <= top_n_rows:
        picked = smallest(keyed, n)
    else:
        keyed = keyed.withColumn(
            "_range", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int")
        )
        taken, boundary = 0, None
        for r in keyed.groupBy("_range").count().orderBy("_range").collect():  # <= DIGEST_RANGES rows
            if taken + r["count"] > n:
                boundary = r["_range"]
                break
            taken += r["count"]
        if boundary is None:
            picked = keyed
        else:
            picked = keyed.filter(F.col("_range") < boundary).unionByName(
                smallest(keyed.filter(F.col("_range") == boundary), n - taken)
            )
    keys = picked.select(F.col(order_by).alias("_key")).distinct()
    drawn = df.join(keys, F.col(order_by).eqNullSafe(F.col("_key")), "left_semi")
    if n <= top_n_rows:
        drawn = drawn.withColumn("_draw", draw_key(order_by, seed)).orderBy("_draw", order_by).limit(n)
    return drawn.select(*df.columns).orderBy(order_by)


def _cuts(rows: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """``_of, _cut, _more``: for each stratum of ``rows`` (``_stratum, _at``) the last position of its first ``n`` rows, and how
    many rows at that position are among them; and whether some stratum has others there.

    Positions are integers. Counts per stratum and range of positions are added up to find the range in which the n-th row
    lies, and that range is cut into ranges again, until ranges are single positions: rows are counted, never ordered.
    """
    span = rows.agg(F.min("_at").alias("low"), F.max("_at").alias("high")).first()
    if span.low is None:
        return rows.select(F.col("_stratum").alias("_of"), F.col("_at").alias("_cut"), F.lit(0).alias("_more")).limit(0), False
    width = 1
    while width * POSITION_RANGES <= span.high - span.low:
        width *= POSITION_RANGES
    # What is still open: each stratum's range and the rows wanted from it.
    open_ = rows.select(F.col("_stratum").alias("_of")).distinct().select("_of", F.lit(span.low).alias("_low"), F.lit(n).cast("bigint").alias("_want"))
    size = None
    while True:
        same = F.col("_stratum").eqNullSafe(F.col("_of"))
        inside = rows.join(open_, same)
        if size is not None:
            inside = inside.filter((F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_low") + size))
        begin = F.col("_low") + F.call_function("div", F.col("_at") - F.col("_low"), F.lit(width)) * width
        counts = inside.groupBy("_of", "_want", begin.alias("_begin")).agg(F.count("*").alias("_n"))
        # At most POSITION_RANGES rows a stratum are ordered here.
        in_order = Window.partitionBy("_of").orderBy("_begin")
        upto = counts.withColumn("_upto", F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        # The range of the n-th row, or the last one if there are fewer.
        last = F.lead("_begin").over(in_order).isNull()
        found = upto.withColumn("_last", last).filter((F.col("_upto") - F.col("_n") < F.col("_want")) & ((F.col("_upto") >= F.col("_want")) | F.col("_last")))
        found = found.select("_of", F.col("_begin").alias("_low"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_want"), "_n")
        if width == 1:
            break
        open_, size, width = found.drop("_n"), width, width // POSITION_RANGES
    cuts = found.select("_of", F.col("_low").alias("_cut"), F.col("_want").alias("_more"), (F.col("_n") > F.col("_want")).alias("_split"))
    return cuts.drop("_split"), not cuts.filter("_split").isEmpty()


def _first_rows(df: DataFrame, stratum: str, n: int, position: Column, nulls_at: Column) -> DataFrame:
    """The ``n`` first rows of each stratum by integer position, by one filter at each stratum's cut."""
    placed = df.withColumn("_at", F.coalesce(position, nulls_at).cast("bigint"))
    cuts, split = _cuts(placed.select(F.col(stratum).alias("_stratum"), "_at"), n)
    met = placed.join(cuts, F.col(stratum).eqNullSafe(F.col("_of")))
    if not split:
        return met.filter(F.col("_at") <= F.col("_cut")).select(*df.columns)
    # Equal positions at a cut: as many of them as are wanted.
    before = met.filter(F.col("_at") < F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("_of").orderBy(F.xxhash64(*df.columns)))
    tied = met.filter(F.col("_at") == F.col("_cut")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_more"))
    return before.select(*df.columns).unionByName(tied.select(*df.columns))


def _beyond(df: DataFrame, order_by: str) -> Column:
    """A position behind that of every row, from either end."""
    far = df.agg(F.max(F.abs(F.col(order_by).cast("bigint")))).first()[0]
    return F.lit((far or 0) + 1)


def stratified_sample(
    df: DataFrame,
    stratum: str,
    n: int,
    order_by: str,
    *,
    strata_order: Sequence[str],
    take_last: Iterable[str] = (),
    take_all: Iterable[str] = (),
) -> DataFrame:
    """First ``n`` rows of each stratum (last ``n`` for ``take_last``, every row for ``take_all``).

    Rows come out in ``strata_order`` and source order; strata that it does not name follow in the order of their
    names, rows without a stratum come last; a null order value is behind all others. Strata taken whole are never ranked.
    Of others, small samples are ranked where the rows are first. Large ones by an integer order are not ranked at all: a
    histogram of positions tells where to cut each stratum. By any other order they are ranked twice, in RANK_PARTS parts of
    a stratum and then over the parts' first rows. So no task ever orders a stratum that holds most of the table.
    """
    last, whole = list(take_last), list(take_all)
    kind = F.col(stratum)
    position = F.when(kind.isin(last), -F.col(order_by)).otherwise(F.col(order_by)) if last else F.col(order_by)
    in_whole = F.coalesce(kind.isin(whole), F.lit(False))
    first = df.filter(~in_whole) if whole else df
    integer = df.schema[order_by].dataType.typeName() in ("byte", "short", "integer", "long")
    if integer and n > RANKED_ROWS:
        picked = _first_rows(first, stratum, n, position, _beyond(first, order_by))
    else:
        first = first.withColumn("_position", position).withColumn(
            "_part", F.pmod(F.xxhash64(order_by), F.lit(RANK_PARTS))
        )
        for groups in ((stratum,),) if n <= RANKED_ROWS else ((stratum, "_part"), (stratum,)):
            rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.col("_position").asc_nulls_last()))
            first = first.withColumn("_rank", rank).filter(F.col("_rank") <= n)
        picked = first.drop("_position", "_part", "_rank")
    if whole:
        picked = picked.unionByName(df.filter(in_whole))
    place = F.array_position(F.array(*[F.lit(s) for s in strata_order]), kind)
    unlisted = len(strata_order) + 1
    place = F.when(kind.isNull(), unlisted + 1).when(place > 0, place).otherwise(unlisted)
    return picked.orderBy(place, F.when(place == unlisted, kind), order_by)


def marker_filter(
    df: DataFrame, column: str, markers: Sequence[str], order_by: str, limit: int | None = None
) -> DataFrame:
    """Rows whose text contains any marker, in source order; ``limit`` keeps the first ones."""
    hit = F.lit(False)
    for marker in markers:
        hit = hit | F.contains(F.col(column), F.lit(marker))
    found = df.filter(hit).orderBy(order_by)
    return found if limit is None else found.limit(limit)


def mixed_fixture(sample: DataFrame, forced: DataFrame) -> DataFrame:
    """A sample followed by the rows that must be in it whatever the draw."""
    return sample.unionByName(forced)
