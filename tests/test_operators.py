from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import health, integrity, profile, sampling, sequence
from plumbline.operators.history import over_episodes
from plumbline.operators.labels import label_actions, label_states
from plumbline.operators.outcomes import build_outcomes, horizon_delta, step_flags, typed_projection
from plumbline.operators.trajectory import trajectories
from plumbline.plans import contracts as C
from plumbline.plans.gates import GateConfig, assert_publishable, check_all

SEC = 1_000_000


def stamps(spark, seconds, step=1):
    """Rows with their position as order; None is an unstamped row."""
    rows = [(i * step, None if s is None else round(s * SEC)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "pos bigint, us bigint")


def brute_gaps(rows):
    out, prev = {}, None
    for pos, us in rows:
        if us is None:
            continue
        if prev is not None:
            out[pos] = us - prev
        prev = us
    return out


# --- Sequence --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("step", [1, 1_000_003], ids=["dense", "sparse"])
@pytest.mark.parametrize("fill", [1.0, 0.05])
def test_gaps_match_a_plain_loop(spark, workspace, step, fill):
    rng = random.Random(7)
    seconds = [rng.uniform(-1e5, 1e5) if rng.random() < fill else None for _ in range(3000)]
    df = stamps(spark, seconds, step).repartition(7)
    gaps = sequence.timestamp_gaps(df, "pos", "us", min_bucket_rows=64, workspace=workspace)
    got = {r.pos: r.gap_us for r in gaps.collect()}
    assert got == brute_gaps([(i * step, None if s is None else round(s * SEC)) for i, s in enumerate(seconds)])


def test_gap_plan_moves_no_rows_into_one_task(spark):
    df = spark.range(0, 200_000).select(F.col("id").alias("pos"), (F.col("id") * 7).alias("us"))
    gaps = sequence.timestamp_gaps(df, "pos", "us", min_bucket_rows=1000)
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    # The only single-partition exchange carries one row per bucket.
    assert plan.count("SinglePartition") == 1
    assert plan.index("SinglePartition") > plan.index("BroadcastExchange")


def test_jumps_and_tolerance(spark):
    df = stamps(spark, [0, 1, 1, 0.9, 2, 3, 2.5, 4])
    gaps = sequence.timestamp_gaps(df, "pos", "us")
    assert sequence.ordering_breaks(gaps, "pos").first().n_breaks == 0
    assert sequence.ordering_breaks(gaps, "pos", 0.05).first() == (2, 3, 100_000)
    jumps = sequence.backward_jumps(gaps, "pos", 0.05).orderBy("pos").collect()
    assert [tuple(r) for r in jumps] == [(3, 100_000), (6, 500_000)]


@pytest.mark.parametrize(
    "seconds, expected",
    [
        ([15 * i for i in range(80)], True),
        ([0, 1, 2, 11, 12, 21, 22, 23], False),
        ([0, 10], False),
        ([], False),
        ([0, 10, 20], True),
        ([20, 10, 0], True),
        ([1e9 * i + (0.000001 if i == 3 else 0) for i in range(9)], True),
    ],
)
def test_fabrication(spark, seconds, expected):
    gaps = sequence.timestamp_gaps(stamps(spark, seconds), "pos", "us")
    assert sequence.fabrication_check(gaps, "pos").first().fabricated is expected


@pytest.mark.parametrize(
    "seconds, cut",
    [
        ([3 * i for i in range(120)] + [-40000 + 2 * i for i in range(60)], None),  # a third of the rows
        ([0, 4, -71000, 9, 13], None),  # breaks again before the end: the run is 60 %
        (list(range(300)) + [-75600 + i for i in range(12)], 300),
        (list(range(300)) + [-75600, None, -75590], None),  # unstamped row in the run
        (list(range(300)) + [-75600 + i for i in range(12)] + [None], None),
        ([None] * 200 + list(range(100)) + [-75600, -75599], 300),
        (list(range(900)) + [-75600 + i for i in range(65)], None),  # one row too long
        (list(range(900)) + [-75600 + i for i in range(64)], 900),
        ([1], None),
        ([], None),
    ],
)
def test_trailing_disorder(spark, seconds, cut):
    df = stamps(spark, seconds)
    tail = sequence.trailing_disorder(df, "pos", "us")
    assert tail.first().cut == cut
    kept, late = sequence.split_tail(df, "pos", cut)
    assert late.count() == (0 if cut is None else len(seconds) - cut)
    assert kept.count() + late.count() == len(seconds)


# --- Health, profiles, gates -----------------------------------------------------------------------------


def test_health_of_odd_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 1.0, nan, nan, 1.0, None, "x"), (2, 1.0, nan, None, nan, None, None), (3, 1.0, nan, None, None, None, "x")],
        "id int, one double, nans double, lone_nan double, mixed double, empty double, text string",
    )
    h = health.measure_columns(df)
    dead = {c for c, v in h.items() if v.is_dead}
    # Repeated NaN readings are distinct observations; a single one is one value.
    assert dead == {"one", "lone_nan", "empty", "text"}
    assert {c for c, v in h.items() if v.is_constant} == {"one", "nans", "empty"}
    assert {c for c, v in h.items() if v.is_all_null} == {"empty"}
    rows = {r.column: r for r in health.column_health(df).collect()}
    assert {c for c, r in rows.items() if r.is_dead} == dead
    assert rows["text"].nulls == 1 and rows["text"].n == 3
    assert health.find_dead_columns(df.limit(0)) == set()
    assert health.dead_column_drift({"a", "b"}, {"b", "c"}) == [("c", "carries_signal"), ("a", "newly_dead")]


def test_distinct_counts_nulls_as_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (None, None)], "a int, b int")
    assert health.distinct_payload(df, ["a", "b"]).first() == (4, 3)


def test_profile(spark):
    df = spark.createDataFrame(
        [(i % 7, None if i % 2 else f"v{i:02d}") for i in range(20)], "a int, b string"
    )
    p = {r.column: r for r in profile.column_profile(profile.column_value_counts(df)).collect()}
    assert (p["a"].n_distinct, p["a"].nulls, p["a"].fill_rate) == (7, 0, 1.0)
    assert (p["b"].n_distinct, p["b"].nulls, p["b"].fill_rate) == (10, 10, 0.5)
    assert list(p["b"]["sample"]) == ["v00", "v02", "v04", "v06", "v08"]
    plan = profile.column_profile(profile.column_value_counts(df))._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_gates_collect_every_failure(spark):
    rows = [(i, 0.0, None, 10 * i * SEC) for i in range(200)]
    df = spark.createDataFrame(rows, "row_index bigint, power_w double, note string, us bigint")
    v = check_all(
        df,
        "t",
        n_in=400,
        expected_columns=["row_index", "power_w", "missing"],
        order_by="row_index",
        stamps="us",
    )
    assert [f.gate for f in v.failures] == [
        "distinct_rows",
        "no_constant_columns",
        "no_constant_columns",
        "no_all_null_columns",
        "row_count_delta",
        "schema_matches",
        "schema_matches",
        "timestamps_not_fabricated",
    ]
    assert {f.column for f in v.failures if f.gate == "no_constant_columns"} == {"note", "power_w"}
    assert v.to_frame(spark).count() == 8
    with pytest.raises(Exception, match="8 gate"):
        assert_publishable(v)


def test_gate_exemptions_and_empty_output(spark):
    df = spark.createDataFrame([(i, "x", i) for i in range(10)], "row_index bigint, tag string, v int")
    ok = check_all(df, "t", n_in=10, config=GateConfig(allow_constant=frozenset({"tag"})))
    assert ok.ok
    empty = check_all(df.limit(0), "t", n_in=10)
    assert [f.gate for f in empty.failures] == ["not_empty", "row_count_delta"]
    identity_only = check_all(df.select("row_index"), "t", n_in=10)
    assert [f.gate for f in identity_only.failures] == ["payload_columns_remain"]
    back = spark.createDataFrame([(0, 1, 0), (1, 2, -100 * SEC), (2, 3, 7)], "row_index bigint, v int, us bigint")
    failed = check_all(back, "t", n_in=3, order_by="row_index", stamps="us")
    assert [f.gate for f in failed.failures] == ["timestamps_ordered"]


# --- Samples ---------------------------------------------------------------------------------------------


def test_sample_is_exact_stable_and_spread(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    want = sorted(
        sorted(range(5000), key=lambda k: (hashlib.md5(f"20260803:{k}".encode()).hexdigest(), k))[:300]
    )
    small = [r.k for r in sampling.seeded_sample(df.repartition(9), 300, "k").collect()]
    large = [r.k for r in sampling.seeded_sample(df, 300, "k", top_n_rows=10).collect()]
    assert small == large == want and small != list(range(300))
    assert [r.k for r in sampling.seeded_sample(df.limit(50), 300, "k").collect()] == list(range(50))
    assert sampling.seeded_sample(df, 9000, "k", top_n_rows=10).count() == 5000


def test_unlisted_strata_follow_the_listed_ones(spark):
    kinds = ["b"] * 3 + ["a"] * 3 + [None] * 2 + ["d"] * 3 + ["c"] * 2000
    df = spark.createDataFrame(list(enumerate(kinds)), "k bigint, kind string")
    out = sampling.stratified_sample(df, "kind", 2, "k", strata_order=["d", "a"])
    assert [r.k for r in out.collect()] == [8, 9, 3, 4, 0, 1, 11, 12, 6, 7]
    many = sampling.stratified_sample(df, "kind", 1500, "k", strata_order=["c"], take_all=["d"])
    assert many.filter("kind = 'c'").count() == 1500 and many.count() == 1511


def test_stratified_sample(spark):
    kinds = ["a"] * 50 + ["b"] * 50 + ["tail"] * 7 + ["c"] * 3
    df = spark.createDataFrame(list(enumerate(kinds)), "k bigint, kind string")
    out = sampling.stratified_sample(
        df, "kind", 5, "k", strata_order=["b", "a", "c", "tail"], take_last=["a"], take_all=["tail"]
    )
    got = [r.k for r in out.collect()]
    assert got == [50, 51, 52, 53, 54, 45, 46, 47, 48, 49, 107, 108, 109, *range(100, 107)]


def test_markers_and_mixed_fixture(spark):
    df = spark.createDataFrame([(i, f"kaspa_{i}" if i % 10 == 3 else "x") for i in range(100)], "k bigint, t string")
    found = sampling.marker_filter(df, "t", ["kaspa_", "monero_"], "k", limit=4)
    assert [r.k for r in found.collect()] == [3, 13, 23, 33]
    assert sampling.mixed_fixture(df.limit(2), found).count() == 6


# --- Integrity -------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "values, ok",
    [
        (list(range(70_000)), True),
        ([0], True),
        ([1, 2], False),
        ([0, 1, 1], False),
        ([0, 2, 3], False),
        ([0, 1, None], False),
        ([-1, 0, 1], False),
        ([0, 0, 2, 3], False),
        ([], False),
    ],
)
def test_contiguity(spark, values, ok):
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "i bigint")
    row = integrity.contiguity_check(df, "i").first()
    assert row.contiguous is ok and row.n_rows == len(values)
    assert row.n_distinct == len({v for v in values if v is not None})


def test_column_equality_needs_both_sides(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0), (None, None), (nan, nan), (1.0, None)], "a double, b double")
    assert integrity.columns_equal(df, "a", "b").first() == (4, 1, False)


def test_row_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    assert integrity.same_rows(a, a.orderBy("i"))
    assert integrity.row_differences(a, a).isEmpty()
    for other in ([(1, "x"), (2, None), (2, None)], [(1, "x"), (1, "x"), (None, "x")], [(1, "x"), (2, None)]):
        b = spark.createDataFrame(other, "i int, s string")
        assert not integrity.same_rows(a, b)
        assert not integrity.row_differences(a, b).isEmpty()


def test_split_fill_reports_absent_splits(spark):
    df = spark.createDataFrame([("train", 1, None), ("test", None, 2)], "split string, a int, b int")
    rows = {(r.split, r.column): (r.n_rows, r.degenerate) for r in integrity.split_fill(df, ["a", "b"]).collect()}
    assert rows == {
        ("train", "a"): (1, False),
        ("train", "b"): (1, True),
        ("validation", "a"): (0, True),
        ("validation", "b"): (0, True),
        ("test", "a"): (1, True),
        ("test", "b"): (1, False),
    }


# --- Episode windows and labels --------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{"episode_rows": 500}, {"chunk_steps": 16}, {"chunk_steps": 7}])
def test_chunked_windows_equal_whole_ones(spark, how):
    rows = [(f"e{e}", s, float((e * 37 + s * s) % 101)) for e in range(3) for s in range((500, 16, 33)[e])]
    df = spark.createDataFrame(rows, "episode_id string, step_idx int, v double").repartition(5)
    got = {
        (r.episode_id, r.step_idx): r.d for r in horizon_delta(df, "v", "d", horizon=5, **how).collect()
    }
    values = {(e, s): v for e, s, v in rows}
    assert got == {
        k: (values[(k[0], k[1] + 5)] - v if (k[0], k[1] + 5) in values else None) for k, v in values.items()
    }


@pytest.mark.parametrize("how", [{"episode_rows": 500}, {"chunk_steps": 10}, {"chunk_steps": 3}])
def test_missing_steps_are_not_counted(spark, how):
    """Windows count rows: a chunk that ends in a gap is no end of the episode."""
    steps = [s for s in range(80) if s % 10 != 9 and not 30 <= s < 45]
    df = spark.createDataFrame([("e", s, float(s * s % 37)) for s in steps], "episode_id string, step_idx int, v double")
    got = step_flags(horizon_delta(df, "v", "d", horizon=2, **how), **how).orderBy("step_idx").collect()
    values = [float(s * s % 37) for s in steps]
    assert [r.is_last for r in got] == [False] * (len(steps) - 1) + [True]
    assert [r.d for r in got] == [values[i + 2] - v if i + 2 < len(values) else None for i, v in enumerate(values)]


def test_window_must_fit_its_chunk(spark):
    df = spark.createDataFrame([("e", 0, 1.0)], "episode_id string, step_idx int, v double")
    with pytest.raises(ValueError):
        over_episodes(df, lambda w: {}, after=64, chunk_steps=16)


SIGNALS = (
    "episode_id string, step_idx int, throttle_reasons bigint, ecc_dbe_vol bigint, gpu_cache_usage_perc float, "
    "num_requests_waiting int, tokens_per_s float, num_preemptions_total bigint"
)


def history(spark, rows):
    base = {"m": 0, "e": 0, "kv": None, "q": None, "t": None, "p": None}
    data = []
    for i, r in enumerate(rows):
        r = base | r
        rate = None if r["t"] is None else float(r["t"])
        data.append(("e", i, r["m"], r["e"], r["kv"], r["q"], rate, r["p"]))
    return spark.createDataFrame(data, SIGNALS)


NAN = float("nan")
HISTORIES = {
    "nominal": ([{}], "TR-000-NOMINAL"),
    "power cap is normal": ([{"m": 0x04}], "TR-000-NOMINAL"),
    "no mask": ([{"m": None}], None),
    "no ecc": ([{"e": None}], None),
    "ecc first": ([{"m": 0xFF, "e": 1}], "TR-001-ECC-DBE"),
    "brake before thermal": ([{"m": 0x80 | 0x40 | 0x08 | 0x20}], "TR-002-HW-POWER-BRAKE"),
    "thermal": ([{"m": 0x40 | 0x08 | 0x20}], "TR-003-HW-THERMAL"),
    "slowdown": ([{"m": 0x08 | 0x20}], "TR-004-HW-SLOWDOWN"),
    "soft thermal": ([{"m": 0x20}], "TR-005-SW-THERMAL"),
    "kv 2": ([{"kv": 0.98}] * 2, "TR-000-NOMINAL"),
    "kv 3": ([{"kv": 0.98}] * 3, "TR-006-KV-PRESSURE-EVICT"),
    "kv 5": ([{"kv": 0.98}] * 5, "TR-006-KV-PRESSURE-EVICT"),
    "kv 6": ([{"kv": 0.98}] * 6, "TR-007-KV-PRESSURE-BATCH"),
    "kv gap": ([{"kv": 0.98}, {}, {"kv": 0.98}, {"kv": 0.98}], "TR-000-NOMINAL"),
    "kv nan": ([{"kv": 0.98}, {"kv": NAN}, {"kv": 0.98}], "TR-000-NOMINAL"),
    # The widened float 0.95 lies under the double 0.95.
    "kv threshold": ([{"kv": 0.95}] * 3, "TR-000-NOMINAL"),
    "kv through unlabelled row": ([{"kv": 0.98}, {"kv": 0.98, "m": None}, {"kv": 0.98}], "TR-006-KV-PRESSURE-EVICT"),
    "queue flat": ([{"q": q, "t": t} for q, t in zip([2, 6, 13], [80, 82, 81])], "TR-008-QUEUE-GROWTH"),
    "queue flat preempting": (
        [{"q": q, "t": t, "p": p} for q, t, p in zip([2, 6, 13], [80, 82, 81], [4, 6, 15])],
        "TR-009-QUEUE-PREEMPT",
    ),
    "preempt middle missing": (
        [{"q": q, "t": 100, "p": p} for q, p in zip([2, 6, 13], [4, None, 15])],
        "TR-009-QUEUE-PREEMPT",
    ),
    "preempt level": ([{"q": q, "t": 100, "p": 3} for q in [2, 6, 13]], "TR-008-QUEUE-GROWTH"),
    "queue with rising rate": ([{"q": q, "t": t} for q, t in zip([2, 6, 13], [80, 150, 310])], "TR-000-NOMINAL"),
    "queue stalls": ([{"q": q, "t": 100} for q in [4, 7, 7]], "TR-000-NOMINAL"),
    "queue, zero rate": ([{"q": q, "t": 0} for q in [1, 2, 3]], "TR-008-QUEUE-GROWTH"),
    "queue, missing rate": ([{"q": q, "t": t} for q, t in zip([1, 2, 3], [100, None, 100])], "TR-000-NOMINAL"),
    "queue, nan rate": ([{"q": q, "t": t} for q, t in zip([1, 2, 3], [100, NAN, 100])], "TR-000-NOMINAL"),
    "queue too short": ([{"q": q, "t": 100} for q in [1, 2]], "TR-000-NOMINAL"),
}


def test_label_rules(spark):
    frames = []
    for name, (rows, _) in HISTORIES.items():
        frames.append(history(spark, rows).withColumn("episode_id", F.lit(name)))
    state = frames[0]
    for f in frames[1:]:
        state = state.unionByName(f)
    state = state.checkpoint()
    for how in ({"episode_rows": 16}, {"chunk_steps": 6}):
        rows = label_states(state, **how).collect()
        last = {}
        for r in sorted(rows, key=lambda r: r.step_idx):
            last[r.episode_id] = r.label.rule_id if r.label else None
        assert last == {name: want for name, (_, want) in HISTORIES.items()}
    first = {r.episode_id: r for r in label_states(state, episode_rows=16).collect() if r.step_idx == 0}
    ecc = first["ecc first"].label
    assert (ecc.action, ecc.action_id, ecc.paired_action) == ("escalate_to_human", 13, "migrate_workload")


def test_one_window_gives_the_joined_trajectory(spark):
    signals = {"throttle_reasons": "bigint", "ecc_dbe_vol": "bigint", "gpu_temp_c": "float", "gpu_cache_usage_perc": "float"}
    known = {
        "episode_id": F.format_string("e%d", F.col("id") % 3),
        "step_idx": F.call_function("div", F.col("id"), F.lit(3)).cast("int"),
        "throttle_reasons": F.when(F.col("id") % 11 != 4, F.element_at(F.array(*map(F.lit, (4, 32, 8))), (F.col("id") % 3 + 1).cast("int"))),
        "ecc_dbe_vol": F.lit(0),
        "gpu_temp_c": F.col("id") * 7 % 23,
        "gpu_cache_usage_perc": F.when(F.col("id") % 40 > 9, 0.99),
    }
    state = spark.range(180).select(typed_projection(C.state_schema(), known))
    assert set(signals) <= set(state.columns)
    how = {"horizon": 5, "episode_rows": 60}
    joined = integrity.assemble_trajectories(
        state,
        label_actions(state, C.proposals_schema(), "v", episode_rows=60),
        build_outcomes(state, C.outcomes_schema(), "v", **how),
    )
    whole = trajectories(state, C.proposals_schema(), C.outcomes_schema(), "v", **how)
    assert whole.dtypes == joined.dtypes
    text = lambda df: sorted(r.j for r in df.select(F.to_json(F.struct(*df.columns)).alias("j")).collect())
    assert text(whole) == text(joined)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("ties", [False, True])
def test_large_strata_are_cut_without_ranking(spark, monkeypatch, ties):
    """One stratum of 90 %, sparse and negative positions, nulls; every size against a plain sort."""
    monkeypatch.setattr(sampling, "POSITION_RANGES", 16)
    monkeypatch.setattr(sampling, "RANKED_ROWS", 0)
    rows = [((i * 7919) % 100_003 - 40_000 if not ties else i % 37, None if i % 50 == 7 else "hot" if i % 10 else f"s{i % 3}") for i in range(3_000)]
    rows += [(None, "hot"), (None, "s1"), (None, None)]
    df = spark.createDataFrame(rows, "k bigint, kind string").repartition(5)
    strata = {kind: sorted((r[0] is None, r[0] or 0) for r in rows if r[1] == kind) for kind in {r[1] for r in rows}}
    for n in (1, 7, 1_000, 10_000):
        out = sampling.stratified_sample(df, "kind", n, "k", strata_order=["s2"], take_last=["hot"])
        got = {}
        for r in out.collect():
            got.setdefault(r.kind, []).append((r.k is None, r.k or 0))
        for kind, own in strata.items():
            known = [x for x in own if not x[0]]
            nulls = [x for x in own if x[0]]
            want = ((known[::-1] if kind == "hot" else known) + nulls)[:n]
            assert sorted(got[kind]) == sorted(want), (n, kind)


def test_no_rows_are_ordered_at_any_size(spark):
    df = spark.range(300_000).select("id", F.when(F.col("id") % 10 == 0, "few").otherwise("most").alias("kind"))
    out = sampling.stratified_sample(df, "kind", 100_000, "id", strata_order=["few", "most"])
    assert {r.kind: r["count"] for r in out.groupBy("kind").count().collect()} == {"few": 30_000, "most": 100_000}
    assert out.agg(F.max("id")).first()[0] == 299_990
    # The one window of the plan orders histogram rows: it stands above the counts.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:], strict=False):
        if "Window [" in line:
            assert "Aggregate" in below or "Window" in below or "Project" in below


def test_null_and_equal_order_values_are_drawn(spark):
    rows = [(i if i % 9 else None, str(i)) for i in range(90)] + [(5, "again")] * 4
    df = spark.createDataFrame(rows, "k bigint, v string")
    assert sampling.seeded_sample(df, 1_000, "k").count() == 94
    for n in (1, 20, 50, 93):
        assert sampling.seeded_sample(df, n, "k").count() == n
    assert sampling.seeded_sample(df.filter("false"), 5, "k").count() == 0
