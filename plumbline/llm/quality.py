"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Every text is measured (words, characters in words, symbols, repeated lines, repeated five-word windows). Base rules
reject texts that are too short or repeat themselves. The rest of the verdict comes from minimum-covariance-determinant
estimates: per language and source, concentration steps look for the ``support`` share of rows whose covariance has the
smallest determinant, and a row is rejected if its Mahalanobis distance under that estimate is beyond ``cutoff``.

* A concentration step is one aggregate. Rows are summed by group and by the bin of their log distance; a cumulative
  sum over at most MAX_BINS bins of a group finds the share nearest the centre, and the sums of those bins give the
  next mean and covariance. No group is ever gathered, so a group with a third of all rows costs its partial sums.
* The starts are deterministic: medians and median absolute deviations of each measure; the half of the rows nearest to
  them; all rows. They are improved side by side, and each group takes the one with the smallest determinant.
* The estimate is then reweighted: means and covariances of all rows within the REWEIGHT_QUANTILE of the distances.
* Shares are skewed and mostly zero, so they enter as log(1 + share / unit). Variances have a floor, about what a few
  words or symbols more or less make out, since the covariance of a group without any would be singular.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.common import SPACE_CLASS, row_and, scratch, stratum_key, text_or_empty

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Share of a group that the estimate is taken from, steps towards it, and the smallest group with an own estimate.
SUPPORT = 0.75
STEPS = 4
MIN_GROUP = 50
#: A row is rejected beyond this quantile of the chi-squared distribution of squared distances.
CUTOFF_QUANTILE = 0.999
#: Rows within this quantile make the reweighted estimate; times it is made.
REWEIGHT_QUANTILE = 0.975
REWEIGHTS = 2
MAX_BINS = 4096

#: Name and floor of the standard deviation of each transformed measure.
FEATURES = {
    "log_words": 0.05,
    "log_word_length": 0.05,
    "symbol_rate": 0.3,
    "dup_line_rate": 0.3,
    "repeat_rate": 0.3,
}
#: Units of the shares; lines added to a text's own, so that one repeated line of three is no large share.
UNITS = {"symbol_rate": 0.02, "dup_line_rate": 0.1, "repeat_rate": 0.05}
MORE_LINES = 3
_F = list(FEATURES)
_P = len(_F)
_ESTIMATE = [*[f"m_{i}" for i in range(_P)], *[f"w_{i}_{j}" for i in range(_P) for j in range(i + 1)]]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more in the array, by sorting window hashes."""

    def covered(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        pairs = F.sort_array(
            F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("p")))
        )

        def of_pairs(p: Column) -> Column:
            twice = F.filter(
                p,
                lambda x, i: ((i > 0) & F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False)))
                | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(twice, lambda x: x["p"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - x, F.lit(width))))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return _let(_let(pairs, of_pairs), length)

    def of_hashes(hashes: Column) -> Column:
        any_twice = _let(
            F.sort_array(hashes), lambda s: F.exists(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: a == b), lambda x: x)
        )
        return F.when(any_twice, covered(hashes)).otherwise(F.lit(0))

    def of_words(w: Column) -> Column:
        def windows(h: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.size(h) - width),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]),
            )

        hashes = F.transform(w, lambda x: F.xxhash64(x))
        return F.when(F.size(w) > width, _let(_let(hashes, windows), of_hashes)).otherwise(F.lit(0))

    return of_words(words)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the measures of each text; the words are split once, in a step of their own."""
    text = text_or_empty()
    words = F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    base = docs.select(
        *keep,
        stratum_key("lang", "source").alias("_group"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
        _let(
            words, lambda w: F.struct(F.size(w).alias("n"), repeated_window_words(w).alias("r"))
        ).alias("_words"),
    )
    return base.select(
        *keep,
        "_group",
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
        F.col("_words.r").cast("long").alias("n_repeat_words"),
        F.col("_lines.n").cast("long").alias("_n_lines"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _features(table: DataFrame) -> DataFrame:
    at_least_one = F.greatest(F.lit(1), F.col("n_words"))
    chars = F.greatest(F.lit(1), F.col("word_chars"))
    values = {
        "log_words": F.log1p(F.col("n_words")),
        "log_word_length": F.log(chars / at_least_one),
        "symbol_rate": F.col("n_symbols") / chars,
        "dup_line_rate": F.col("n_dup_lines") / (F.col("_n_lines") + MORE_LINES),
        "repeat_rate": F.col("n_repeat_words") / at_least_one,
    }
    values |= {k: F.log1p(values[k] / unit) for k, unit in UNITS.items()}
    return table.withColumns({k: v.cast("double") for k, v in values.items()})


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution function by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 1
    while term > total * 1e-16:
        term *= half / (a + n)
        total += term
        n += 1
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def _whitening(table: DataFrame) -> DataFrame:
    """From means ``m_i`` and covariances ``c_ij`` to ``w_ij``, the inverse of the Cholesky factor; and the determinant."""
    for i in range(_P):
        for j in range(i + 1):
            left = F.col(f"c_{i}_{j}")
            for k in range(j):
                left = left - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            value = F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l_{j}_{j}")
            table = table.withColumn(f"l_{i}_{j}", value)
    for i in range(_P):
        for j in range(i + 1):
            if i == j:
                value = 1 / F.col(f"l_{i}_{i}")
            else:
                value = F.lit(0.0)
                for k in range(j, i):
                    value = value - F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}")
                value = value / F.col(f"l_{i}_{i}")
            table = table.withColumn(f"w_{i}_{j}", value)
    return table.select(
        "_g",
        "_s",
        *_ESTIMATE,
        sum((F.log(f"l_{i}_{i}") for i in range(_P)), F.lit(0.0)).alias("_log_det"),
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined to its group's estimate."""
    total = F.lit(0.0)
    for i in range(_P):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"w_{i}_{j}") * (F.col(_F[j]) - F.col(f"m_{j}"))
        total = total + z * z
    return total


def _start(rows: DataFrame, work) -> DataFrame:
    """Medians and squared scaled median absolute deviations as a first estimate without correlations."""
    medians = rows.groupBy("_g").agg(*[F.percentile_approx(f, 0.5, 1000).alias(f"m_{i}") for i, f in enumerate(_F)])
    medians = work.stage(medians, "medians")
    spread = rows.join(medians, "_g").groupBy("_g").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(_P)],
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{i}")), 0.5, 1000).alias(f"d_{i}") for i, f in enumerate(_F)],
    )
    return spread.withColumns(
        {
            f"c_{i}_{j}": F.pow(1.4826 * F.col(f"d_{i}"), 2) + FEATURES[_F[i]] ** 2 if i == j else F.lit(0.0)
            for i in range(_P)
            for j in range(i + 1)
        }
    )


def _sums() -> dict[str, Column]:
    """What means and covariances are made of."""
    sums = {"_n": F.count("*").cast("double")}
    sums |= {f"s_{i}": F.sum(_F[i]) for i in range(_P)}
    return sums | {f"q_{i}_{j}": F.sum(F.col(_F[i]) * F.col(_F[j])) for i in range(_P) for j in range(i + 1)}


def _moments(total: DataFrame, share: float) -> DataFrame:
    """Means and covariances from sums over the ``share`` of rows nearest the centre."""
    consistency = share / chi2_cdf(chi2_quantile(share, _P), _P + 2) if share < 1 else 1.0
    means = total.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("_n") for i in range(_P)})
    return means.withColumns(
        {
            f"c_{i}_{j}": (F.col(f"q_{i}_{j}") / F.col("_n") - F.col(f"m_{i}") * F.col(f"m_{j}")) * consistency
            + (FEATURES[_F[i]] ** 2 if i == j else 0.0)
            for i in range(_P)
            for j in range(i + 1)
        }
    )


def _step(rows: DataFrame, estimate: DataFrame, support: float) -> DataFrame:
    """One concentration step of every start: means and covariances of the ``support`` share of rows nearest the estimate."""
    sums = _sums()
    bins = F.floor(F.log(_distance() + 1e-6) * 64).cast("int")
    low, high = -14 * 64, -14 * 64 + MAX_BINS - 1
    by_bin = (
        rows.join(estimate, "_g")
        .withColumn("_bin", F.least(F.greatest(bins, F.lit(low)), F.lit(high)))
        .groupBy("_g", "_s", "_bin")
        .agg(*[v.alias(k) for k, v in sums.items()])
    )
    group = Window.partitionBy("_g", "_s")
    upto = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # The bins up to the one in which the share is reached.
    inside = by_bin.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0.0))).withColumn(
        "_all", F.sum("_n").over(group)
    )
    total = inside.filter(F.col("_before") < support * F.col("_all")).groupBy("_g", "_s").agg(
        *[F.sum(k).alias(k) for k in sums]
    )
    return _moments(total, support)


def _reweighted(rows: DataFrame, estimate: DataFrame, quantile: float) -> DataFrame:
    """Means and covariances of the rows within the ``quantile`` of the distances from the estimate."""
    near = rows.join(estimate, "_g").filter(_distance() <= chi2_quantile(quantile, _P))
    return _moments(near.groupBy("_g", "_s").agg(*[v.alias(k) for k, v in _sums().items()]), quantile)


def estimates(table: DataFrame, work, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """The estimate of each group of ``table`` (with ``_g`` and the features); written at each step."""
    rows = table.filter(~F.col("base_failed")).select("_g", *_F)
    first = work.stage(_whitening(_start(rows, work).withColumn("_s", F.lit(0))), "estimate")
    half = _whitening(_step(rows, first, 0.5)).withColumn("_s", F.lit(1))
    every = rows.groupBy("_g").agg(*[v.alias(k) for k, v in _sums().items()]).withColumn("_s", F.lit(2))
    estimate = work.stage(first.unionByName(half).unionByName(_whitening(_moments(every, 1.0))), "estimate")
    for _ in range(steps):
        estimate = work.stage(_whitening(_step(rows, estimate, support)), "estimate")
    best = F.min_by(F.struct("_s", *_ESTIMATE), F.struct("_log_det", "_s"))
    estimate = estimate.groupBy("_g").agg(best.alias("_best")).select("_g", "_best.*")
    for _ in range(REWEIGHTS):
        estimate = work.stage(_whitening(_reweighted(rows, estimate, REWEIGHT_QUANTILE)), "estimate")
    return estimate.drop("_s", "_log_det")


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _grouped(table: DataFrame, own: DataFrame, shared) -> DataFrame:
    return _features(table.join(own, "_group", "left")).withColumn("_g", F.coalesce("_own", shared))


def _estimated(table: DataFrame, work, min_group: int, support: float, steps: int) -> tuple[DataFrame, DataFrame, object]:
    """From written measures: the estimates, the groups that have their own, and the name of the one the others share."""
    passing = table.filter(~F.col("base_failed")).groupBy("_group").agg(F.count("*").alias("_rows"))
    own = passing.filter(F.col("_rows") >= min_group).select("_group", F.col("_group").alias("_own"))
    own = work.stage(own, "groups")
    rest = passing.filter(F.col("_rows") < min_group).agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    shared = F.lit("*") if rest >= min_group else F.lit(None).cast("string")
    return estimates(_grouped(table, own, shared), work, support, steps), own, shared


def _judged(table: DataFrame, estimated: tuple[DataFrame, DataFrame, object], cutoff: float) -> DataFrame:
    estimate, own, shared = estimated
    judged = _grouped(table, own, shared).join(estimate, "_g", "left").withColumn("_distance", F.sqrt(_distance()))
    fits = F.coalesce(F.col("_distance") <= math.sqrt(chi2_quantile(cutoff, _P)), F.lit(True))
    return judged.withColumn("_kept", ~F.col("base_failed") & fits)


def quality_verdicts(
    docs: DataFrame,
    cutoff: float = CUTOFF_QUANTILE,
    min_group: int = MIN_GROUP,
    support: float = SUPPORT,
    steps: int = STEPS,
) -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``kept`` and ``distance`` of every row.

    A null text is empty and so fails the base rules. Null languages and sources form groups of their own. Groups with
    fewer than ``min_group`` rows that pass the base rules share one estimate; if these rows together are still fewer,
    they have none, ``distance`` is null and the base rules alone decide. Equal rows get equal verdicts; an empty table
    gives an empty result; other columns are ignored.
    """
    work = scratch(docs.sparkSession)
    table = work.stage(measured(docs, ["doc_id"]), "measures")
    judged = _judged(table, _estimated(table, work, min_group, support, steps), cutoff)
    return judged.select(
        "doc_id", *_MEASURES, F.col("_kept").alias("kept"), F.round("_distance", 4).alias("distance")
    )


def of_quality(
    docs: DataFrame,
    cutoff: float = CUTOFF_QUANTILE,
    min_group: int = MIN_GROUP,
    support: float = SUPPORT,
    steps: int = STEPS,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names.

    Texts are read twice: the measures that the estimates are made of are written without them, and a second reading measures
    each row and judges it at once, so no text is written before it is judged.
    """
    work = scratch(docs.sparkSession)
    rows = row_and(docs, "text", "lang", "source")
    estimated = _estimated(work.stage(measured(rows, []), "measures"), work, min_group, support, steps)
    return _judged(measured(rows, ["_row"]), estimated, cutoff).filter("_kept").select("_row.*")
