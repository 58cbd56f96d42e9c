"""

Every query reads whole given tables, or data Spark derives from them, and runs the package's own operators.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.functions.instants import normalize_timestamps, timestamp_form  # noqa: E402
from plumbline.operators import health, integrity, profile, sampling, sequence  # noqa: E402
from plumbline.operators.episodes import (  # noqa: E402
    SPLITS,
    add_episodes,
    episode_count,
    split_counts,
    split_episodes,
    split_rows,
)
from plumbline.operators.labels import label_actions  # noqa: E402
from plumbline.operators.outcomes import (  # noqa: E402
    build_outcomes,
    horizon_delta,
    step_flags,
    typed_projection,
)
from plumbline.operators.ranges import feature_ranges  # noqa: E402
from plumbline.operators.trajectory import trajectories  # noqa: E402
from plumbline.operators.scaling import derived_tick_columns, minmax_scaled  # noqa: E402
from plumbline.plans import contracts as C  # noqa: E402
from plumbline.plans.cleaners import ROW  # noqa: E402
from plumbline.plans.conversion import write_verified  # noqa: E402
from plumbline.plans.gates import GateConfig, gate_table  # noqa: E402
from plumbline.plans.publishing import SOURCES, run_all  # noqa: E402
from plumbline.plans.trajectories import (  # noqa: E402
    OUTPUT_DIR as BUILD_DIR,
    build_trajectories,
    gpu_telemetry,
    read_table,
    read_trajectories,
)
from plumbline.session import freed_shuffles  # noqa: E402
from plumbline.sources import storage  # noqa: E402
from plumbline.sources.closed_records import classify, error_examples  # noqa: E402
from plumbline.sources.jsonl import count_lines, read_jsonl  # noqa: E402
from plumbline.sources.sinks import in_source_order, jsonl_text, write_jsonl  # noqa: E402
from plumbline.sources.workspace import Workspace  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
EPISODE_STEPS = 64
HORIZON = 8
WINDOW = {"episode_rows": EPISODE_STEPS}
VERSION = C.TRAJECTORY_SCHEMA_VERSION

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str) -> Column:
    """Epoch microseconds of a zone-less timestamp, read as UTC whatever the session zone is."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return F.unix_micros(local.cast("timestamp"))


# --- Column health, profiles and gates -------------------------------------------------------------------


def orders_with_dead_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        F.when(status == "P", status).alias("pending_mark"),
        F.lit(None).cast("double").alias("never_filled"),
        F.upper(F.substring(F.lit("order"), 1, 5)).alias("record_kind"),
    )


def column_health(spark, sf_dir):
    return health.column_health(orders_with_dead_columns(spark, sf_dir))


def dead_column_drift(spark, sf_dir):
    measured = health.column_health(orders_with_dead_columns(spark, sf_dir))
    return health.dead_drift_table(measured, ["o_totalprice", "never_filled", "record_kind"])


def distinct_payload_ratio(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    payload = health.payload_columns(events.columns, {"event_id"})
    return health.distinct_payload(events, payload).withColumn(
        "ratio", F.round(F.col("n_distinct") / F.col("n_rows"), 8)
    )


PART_PROFILE = ["p_brand", "p_type", "p_size", "p_name"]


def column_value_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.column_value_counts(
        lines.withColumn(
            "returned", F.when(F.col("l_returnflag") == "R", F.col("l_linestatus"))
        ),
        ["l_returnflag", "l_linestatus", "l_linenumber", "returned"],
    )


def column_profile(spark, sf_dir):
    counts = profile.column_value_counts(
        table(spark, sf_dir, "part").withColumn(
            "p_size", F.when(F.col("p_size") > 5, F.col("p_size"))
        ),
        PART_PROFILE,
    )
    return profile.column_profile(counts).withColumn("sample", F.array_join("sample", "|"))


def whole_row_distinct(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return health.distinct_payload(orders, orders.columns).withColumn(
        "distinct_ratio", F.round(F.col("n_distinct") / F.col("n_rows"), 8)
    )


def gate_report(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_index"),
        micros("ts").alias("stamp_us"),
        "event_type",
        "user_id",
        "value",
        F.lower(F.lit("CAPTURE")).alias("origin"),
        F.lit(None).cast("string").alias("note"),
    )
    checks = gate_table(
        events,
        n_in=table(spark, sf_dir, "events").agg(F.count("*").alias("n_in")),
        order_by="row_index",
        stamps="stamp_us",
        columns=["row_index", "event_type", "user_id", "value", "origin", "note"],
        expected_columns=["row_index", "event_type", "user_id", "value", "origin", "region"],
        config=GateConfig(allow_constant=frozenset({"note"})),
    )
    # Absent and undeclared columns are two findings with one figure.
    return checks.select("gate", "column", "observed", "passed").distinct()


# --- Order and time --------------------------------------------------------------------------------------


def orders_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", micros("o_orderdate").alias("stamp_us"))


def timestamp_gaps(spark, sf_dir):
    return sequence.timestamp_gaps(orders_by_key(spark, sf_dir), "o_orderkey", "stamp_us")


def backward_jumps(spark, sf_dir):
    return sequence.backward_jumps(timestamp_gaps(spark, sf_dir), "o_orderkey")


def ordering_breaks(spark, sf_dir):
    return sequence.ordering_breaks(timestamp_gaps(spark, sf_dir), "o_orderkey")


def sparse_stamp_gaps(spark, sf_dir):
    """Only error events carry a stamp; each gap reaches back to the nearest earlier one."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", micros("ts")).alias("stamp_us")
    )
    return sequence.timestamp_gaps(events, "event_id", "stamp_us")


def fabrication_check(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    real = events.select("event_id", micros("ts").alias("stamp_us"))
    made = events.select(
        "event_id", (F.lit(1_773_000_000_000_000) + F.col("event_id") * 10_000_000).alias("stamp_us")
    )
    out = [
        sequence.fabrication_check(
            sequence.timestamp_gaps(df, "event_id", "stamp_us"), "event_id"
        ).withColumn("series", F.lit(name))
        for name, df in (("observed", real), ("generated", made))
    ]
    return out[0].unionByName(out[1])


LATE_ROWS, LATE_HOURS = 12, 21


def events_with_late_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", micros("ts").alias("stamp_us"))
    last = events.agg(F.max("event_id")).scalar()
    late = F.col("event_id") > last - LATE_ROWS
    shift = F.when(late, F.lit(LATE_HOURS * 3_600_000_000)).otherwise(F.lit(0))
    return events.select("event_id", (F.col("stamp_us") - shift).alias("stamp_us"))


def trailing_disorder(spark, sf_dir):
    return sequence.trailing_disorder(events_with_late_tail(spark, sf_dir), "event_id", "stamp_us")


def quarantined_tail(spark, sf_dir):
    events = events_with_late_tail(spark, sf_dir)
    tail = sequence.trailing_disorder(events, "event_id", "stamp_us")
    _, late = sequence.split_tail(events, "event_id", tail.first().cut)
    return late


def event_time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven shapes of timestamp text, one per event."""
    shape, eid = F.col("event_id") % 7, F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(shape == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(shape == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("458")))
        .when(shape == 2, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00")))
        .when(shape == 3, F.concat(F.lit("Dynex:9"), eid))
        .when(shape == 4, F.concat(F.lit("qubic:204:46"), eid))
        .when(shape == 5, (F.lit(1_700_000_000) + F.col("event_id")).cast("string"))
        .otherwise(F.concat(F.lit("12:30:00 "), eid))
        .alias("stamp"),
    )


def timestamp_normalize(spark, sf_dir):
    read = normalize_timestamps(event_time_texts(spark, sf_dir), "stamp")
    return read.drop("moment")


def timestamp_forms(spark, sf_dir):
    texts = event_time_texts(spark, sf_dir)
    return texts.groupBy(timestamp_form(F.col("stamp")).alias("form")).agg(F.count("*").alias("n"))


def numeric_epochs(spark, sf_dir):
    ticks = table(spark, sf_dir, "events").select(
        "event_id", (F.lit(1_700_000_000) + F.col("event_id") * 3).alias("ts")
    )
    return normalize_timestamps(ticks, "ts").select("event_id", "ts_ok", "ts_micros", "iso", "form")


def chain_attribution(spark, sf_dir):
    return profile.attribution_counts(
        normalize_timestamps(event_time_texts(spark, sf_dir), "stamp"), "coin"
    )


def unreadable_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = normalize_timestamps(event_time_texts(spark, sf_dir), "stamp")
    return read.select(
        F.col("event_id").alias("row_index"),
        F.col("stamp").alias("raw"),
        F.when(~F.col("ts_ok"), F.lit("unparseable")).alias("reason"),
    )


def quarantine_counts(spark, sf_dir):
    return profile.quarantine_counts(unreadable_stamps(spark, sf_dir)).filter("reason is not null")


# --- Ingest ----------------------------------------------------------------------------------------------

EVENT_LINE = T.StructType([T.StructField("k", T.LongType(), False)])


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' JSON texts, most of them damaged in one of nine ways."""
    way, props = F.col("event_id") % 10, F.col("props")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_index"),
        F.when(way == 1, F.regexp_replace(props, r"(\d+)", '"$1"'))
        .when(way == 2, F.expr("left(props, length(props) - 1)"))
        .when(way == 3, F.regexp_replace(props, r"\}$", ', "z": 2}'))
        .when(way == 4, F.regexp_replace(props, r"\d+", '"x"'))
        .when(way == 5, F.lit("  "))
        .when(way == 6, F.concat(props, props))
        .when(way == 7, F.lit("{}"))
        .when(way == 8, F.regexp_replace(props, r"\d+", "null"))
        .when(way == 9, F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
        .alias("value"),
    )


def json_validate(spark, sf_dir):
    return classify(event_lines(spark, sf_dir), EVENT_LINE).select(
        "row_index", "error_class", "error_detail", F.col("record.k").alias("k")
    )


def ingest_counts(spark, sf_dir):
    return classify(event_lines(spark, sf_dir), EVENT_LINE).groupBy("error_class").agg(
        F.count("*").alias("n")
    )


def ingest_examples(spark, sf_dir):
    return error_examples(classify(event_lines(spark, sf_dir), EVENT_LINE))


def _write_event_lines(spark: SparkSession, sf_dir: str, workspace: Workspace) -> tuple[str, int]:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    path = workspace.path("event-lines")
    n = events.count()
    write_jsonl(events, path, order_by="event_id", n_rows=n)
    return path, n


def jsonl_scan(spark, sf_dir):
    """Events written as JSON Lines in source order and scanned back with their line numbers."""
    workspace = Workspace(spark)
    path, _ = _write_event_lines(spark, sf_dir, workspace)
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return read_jsonl(spark, path, workspace).select(
        "row_index", F.from_json("value", schema).alias("r")
    ).select("row_index", "r.*")


def raw_line_sample(spark, sf_dir):
    """A seeded sample of raw JSON lines by their line numbers, the lines unparsed."""
    workspace = Workspace(spark)
    path, _ = _write_event_lines(spark, sf_dir, workspace)
    drawn = sampling.seeded_sample(read_jsonl(spark, path, workspace), 100, "row_index")
    return drawn.select("row_index", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


def raw_lines_by_form(spark, sf_dir):
    """Raw lines stratified by the shape of their timestamp text."""
    workspace = Workspace(spark)
    texts = event_time_texts(spark, sf_dir)
    path = workspace.path("stamped-lines")
    write_jsonl(texts, path, order_by="event_id", n_rows=texts.count())
    stamp = F.get_json_object("value", "$.stamp")
    lines = read_jsonl(spark, path, workspace).withColumn("form", timestamp_form(stamp))
    drawn = sampling.stratified_sample(
        lines, "form", 25, "row_index", strata_order=["datetime", "coin_height"], take_last=["coin_height"]
    )
    return drawn.select("row_index", "form", stamp.alias("stamp"))


def line_count(spark, sf_dir):
    with Workspace(spark) as workspace:
        path, n = _write_event_lines(spark, sf_dir, workspace)
        return spark.createDataFrame([(count_lines(spark, path), n)], "n_lines bigint, n_rows bigint")


def jsonl_render(spark, sf_dir):
    """The JSON text of each row, nulls kept."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("priority"),
    )
    return jsonl_text(orders)


def roundtrip_verify(spark, sf_dir):
    with Workspace(spark) as workspace:
        events = table(spark, sf_dir, "events")
        rows = write_verified("events", events, workspace.path("events"), exact=True)
        return spark.createDataFrame([("events", rows)], "config string, n_rows bigint")


def row_differences(spark, sf_dir):
    """Two versions of the orders table, one with every 'F' priority rewritten, compared row by row."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    changed = orders.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.lit("9-NONE")).otherwise(F.col("o_orderpriority")),
    )
    return integrity.row_differences(orders, changed)


# --- Scaling, samples, filters ---------------------------------------------------------------------------


def minmax_normalized(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return part.select(
        "p_partkey",
        minmax_scaled(part, "p_partkey").alias("trace"),
        minmax_scaled(part, "p_retailprice").alias("rate"),
    )


def derived_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    scaled = part.withColumn("_rate", minmax_scaled(part, "p_size"))
    return scaled.select(
        "p_partkey", *[e.alias(n) for n, e in derived_tick_columns(F.col("_rate")).items()]
    )


def seeded_sample(spark, sf_dir):
    return sampling.seeded_sample(
        table(spark, sf_dir, "events").select("event_id", "event_type"), 100, "event_id"
    )


def large_seeded_sample(spark, sf_dir):
    """The same draw through the digest ranges that large samples use."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sampling.seeded_sample(orders, 1000, "o_orderkey", top_n_rows=1)


def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(
        table(spark, sf_dir, "events").select("event_id", "event_type"),
        "event_type",
        20,
        "event_id",
        strata_order=["view", "click", "purchase", "signup", "error"],
        take_last=["purchase"],
        take_all=["error"],
    )


def unlisted_strata(spark, sf_dir):
    """Strata that the given order does not name, null among them, are sampled after those that it names."""
    kind = F.nullif("event_type", F.lit("signup"))
    events = table(spark, sf_dir, "events").select("event_id", kind.alias("event_type"))
    return sampling.stratified_sample(
        events, "event_type", 30, "event_id", strata_order=["click"], take_all=["error"]
    )


def marker_filter(spark, sf_dir):
    found = sampling.marker_filter(
        table(spark, sf_dir, "documents"), "text", ["http", "License", "@"], "doc_id"
    )
    return found.select("doc_id", "lang", "n_chars")


def mixed_fixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    sample = sampling.seeded_sample(docs, 50, "doc_id")
    forced = sampling.marker_filter(docs, "text", ["License"], "doc_id", limit=20)
    return sampling.mixed_fixture(sample, forced).select("doc_id", "n_chars")


# --- Trajectories ----------------------------------------------------------------------------------------


def layout_of(spark: SparkSession, sf_dir: str):
    rows = table(spark, sf_dir, "events").count()  # answered from the Parquet footers
    return split_episodes(episode_count(rows, EPISODE_STEPS))


def event_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_episodes(table(spark, sf_dir, "events"), "event_id", EPISODE_STEPS)


def event_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = layout_of(spark, sf_dir)
    return event_episodes(spark, sf_dir).withColumn("split", layout.split_column(F.col("episode")))


def episodes(spark, sf_dir):
    return event_splits(spark, sf_dir).select("event_id", "episode", "episode_id", "step_idx", "split")


def split_row_counts(spark, sf_dir):
    return split_counts(event_splits(spark, sf_dir))


def nondegenerate_splits(spark, sf_dir):
    placed = event_splits(spark, sf_dir).withColumn(
        "late_value", F.when(F.col("split") != "train", F.col("value"))
    )
    return integrity.split_fill(placed, ["value", "user_id", "late_value"])


def horizon_deltas(spark, sf_dir):
    events = event_episodes(spark, sf_dir).select("event_id", "episode_id", "step_idx", "value")
    return horizon_delta(events, "value", "d_value", HORIZON, **WINDOW)


def long_episode_deltas(spark, sf_dir):
    """The whole capture as one episode, which the window cuts into chunks with shared edges."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.lit("capture").alias("episode_id"), F.col("event_id").alias("step_idx"), "value"
    )
    return horizon_delta(events, "value", "d_value", HORIZON, chunk_steps=1000).drop("step_idx")


def step_structure(spark, sf_dir):
    events = event_episodes(spark, sf_dir).select("event_id", "episode_id", "step_idx")
    return step_flags(events, **WINDOW)


def gapped_episode_flags(spark, sf_dir):
    """Every tenth step missing, and chunks that end inside the gaps: windows count rows."""
    events = event_episodes(spark, sf_dir).filter(F.col("event_id") % 10 != 3)
    rows = events.select("event_id", "episode_id", "step_idx", "value")
    chunked = {"chunk_steps": 16}
    return step_flags(horizon_delta(rows, "value", "d_value", HORIZON, **chunked), **chunked)


def gapped_capture_flags(spark, sf_dir):
    """The same over the whole capture as one episode."""
    events = table(spark, sf_dir, "events").filter(F.col("event_id") % 10 != 3)
    rows = events.select(F.lit("capture").alias("episode_id"), F.col("event_id").alias("step_idx"), "value")
    chunked = {"chunk_steps": 1000}
    return step_flags(horizon_delta(rows, "value", "d_value", HORIZON, **chunked), **chunked)


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the full state schema, with the signals the label rules read."""
    e = F.col("event_id")
    block = lambda n: F.call_function("div", e, F.lit(n))
    mask = (
        F.when((e * 7919) % 97 == 1, F.lit(0x80))
        .when((e * 7919) % 97 == 2, F.lit(0x40))
        .when((e * 7919) % 97 == 3, F.lit(0x08))
        .when((e * 7919) % 97 == 4, F.lit(0x20))
        .when((e * 7919) % 97 == 5, F.lit(None))
        .otherwise(F.lit(0x04))
    )
    known = {
        "episode_id": F.col("episode_id"),
        "step_idx": F.col("step_idx"),
        "schema_version": F.lit(VERSION),
        "synthetic": F.lit(False),
        "gpu_temp_c": F.col("value"),
        "throttle_reasons": mask,
        "ecc_dbe_vol": F.when((e * 31) % 101 == 0, F.lit(2)).when((e * 31) % 101 == 1, F.lit(None)).otherwise(0),
        "gpu_cache_usage_perc": F.when(
            (block(8) % 5 == 0) & (e % 53 != 0), F.lit(0.97)
        ).when(e % 53 != 0, F.lit(0.5)),
        "num_requests_waiting": e % 5,
        "tokens_per_s": F.when(block(16) % 3 == 0, F.lit(100) + e % 3)
        .when(block(16) % 3 == 1, F.lit(0))
        .otherwise(F.lit(100) * (e % 4 + 1)),
        "num_preemptions_total": block(6),
    }
    return event_episodes(spark, sf_dir).select(typed_projection(C.state_schema(), known))


def state_projection(spark, sf_dir):
    return state_table(spark, sf_dir).select(
        "episode_id",
        "step_idx",
        "ts_utc",
        "schema_version",
        "gpu_temp_c",
        "throttle_reasons",
        "num_requests_waiting",
        "fpga_membrane_q88",
        "regime",
        "synthetic",
    )


def action_labels(spark, sf_dir):
    return label_actions(state_table(spark, sf_dir), C.proposals_schema(), VERSION, **WINDOW).select(
        "episode_id",
        "step_idx",
        "schema_version",
        "proposed_action",
        "teacher_action",
        "teacher_action_id",
        "teacher_rule_id",
        F.col("proposed_params.paired_action").alias("paired_action"),
        "label_source",
        "label_confidence",
    )


def label_counts(spark, sf_dir):
    return action_labels(spark, sf_dir).groupBy("teacher_rule_id", "teacher_action").agg(
        F.count("*").alias("n")
    )


def outcome_table(spark, sf_dir):
    state = state_table(spark, sf_dir)
    return build_outcomes(state, C.outcomes_schema(), VERSION, HORIZON, **WINDOW).select(
        "episode_id", "step_idx", "d_gpu_temp_c", "discount", "is_terminal", "is_first", "is_last", "reward"
    )


def trajectory_join(spark, sf_dir):
    whole = trajectories(
        state_table(spark, sf_dir), C.proposals_schema(), C.outcomes_schema(), VERSION, HORIZON, **WINDOW
    )
    return whole.select("episode_id", "step_idx", "gpu_temp_c", "teacher_rule_id", "d_gpu_temp_c", "is_last")


def key_uniqueness(spark, sf_dir):
    keys = ["episode_id", "step_idx"]
    sets = {
        "episode_steps": event_episodes(spark, sf_dir).select(*keys),
        "order_lines": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").alias("step_idx")
        ),
    }
    parts = [
        integrity.key_uniqueness(df, keys).withColumn("key_set", F.lit(name)) for name, df in sets.items()
    ]
    return parts[0].unionByName(parts[1])


def duplicate_keys(spark, sf_dir):
    return integrity.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def contiguity_check(spark, sf_dir):
    sets = {
        "events": table(spark, sf_dir, "events").select(F.col("event_id").alias("idx")),
        "orders": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")),
        "lineitem": table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("idx")),
    }
    out = None
    for name, df in sets.items():
        row = integrity.contiguity_check(df, "idx").withColumn("source", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def columns_equal(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("value"),
        (F.col("value") * 1.0).alias("same"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("holes"),
    )
    same = integrity.columns_equal(events, "value", "same").withColumn("pair", F.lit("same"))
    return same.unionByName(
        integrity.columns_equal(events, "value", "holes").withColumn("pair", F.lit("holes"))
    )


def feature_extremes(spark, sf_dir):
    rows = split_rows(
        table(spark, sf_dir, "events"), layout_of(spark, sf_dir), "train", "event_id", EPISODE_STEPS
    )
    train = add_episodes(rows, "event_id", EPISODE_STEPS).withColumn(
        "empty_feature", F.lit(None).cast("bigint")
    )
    return feature_ranges(train, ["value", "user_id", "step_idx", "empty_feature"])


def flat_signals(spark, sf_dir):
    """The flat table: base columns as constants and typed nulls plus the kept sensors."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "row_index")
    return gpu_telemetry(events.drop("ts", "props")).drop("ts_synthetic_offset_ms")


# --- Whole jobs over sources derived from the events -----------------------------------------------------


def gpu_lines(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    # Multiples of a power of two, so that sums and differences are exact.
    spread = lambda factor, modulus, unit, low=0: low + ((e * factor) % modulus) / F.lit(float(unit))
    clock = spread(13, 37, 1, 900)
    signal = {
        "vddcr_gfx_v": spread(17, 29, 64, 0.5),
        "vram_temp_c": spread(7, 43, 2, 20),
        "gpu_temp_c": F.col("value"),
        "power_w": F.col("user_id").cast("double"),
        "gpu_clock_mhz": clock,
        "mem_clock_mhz": spread(11, 17, 1, 400),
        "clock_mhz": clock,
        "fan_speed_pct": spread(19, 83, 1),
        "mem_util_pct": spread(23, 59, 2),
        "qubic_tick_trace": spread(3, 31, 1),
        "qubic_tick_rate": spread(5, 23, 8),
        "qubic_epoch_progress": spread(29, 47, 64),
        "hashrate_mh": F.lit(0.0),
        "rejected_shares": F.lit(0),
    }
    telemetry = F.struct(*[c.alias(n) for n, c in signal.items()])
    return events.select("event_id", F.to_json(F.struct(telemetry.alias("telemetry"))).alias("value"))


def mining_lines(events: DataFrame) -> DataFrame:
    e, eid = F.col("event_id"), F.col("event_id").cast("string")
    stamp = (
        F.when(e % 50 == 6, F.lit("12:30:00"))
        .when(e % 7 == 3, F.concat(F.lit("dynex:9"), eid))
        .when(e % 7 == 4, F.concat(F.lit("Qubic:204:46"), eid))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    telemetry = F.struct(
        F.col("value").alias("hashrate_mh"),
        F.col("user_id").cast("double").alias("power_w"),
        F.lit(0.0).alias("clock_mhz"),
    )
    record = F.struct(stamp.alias("timestamp"), telemetry.alias("telemetry"))
    return events.select("event_id", F.to_json(record).alias("value"))


def tick_lines(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    record = F.struct(
        (F.lit(1_700_000_000) + e * 3 + e % 2).alias("ts"),
        (e * 5 + 100).alias("tick"),
        F.lit(205).alias("epoch"),
        F.col("value").alias("tick_rate"),
        F.lit(1.0).alias("epoch_progress"),
    )
    return events.select("event_id", F.to_json(record).alias("value"))


def market_lines(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    numbers = [
        (F.col("value") + k).alias(n) for k, n in enumerate(C.MARKET_NUMBERS)
    ]
    record = F.struct(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("521+00:00")).alias("timestamp"),
        e.alias("step"),
        F.element_at(F.array(F.lit("buy"), F.lit("sell"), F.lit("observe")), (e % 3 + 1).cast("int")).alias(
            "action"
        ),
        F.col("event_type").alias("asset"),
        *numbers,
        F.when(e % 2 == 0, "NVDA").otherwise("AMD").alias("ch2_mode"),
        F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("reason"),
    )
    return events.select("event_id", F.to_json(record).alias("value"))


# The largest source comes first, while there is little else on disk.
RAW_LINES = {
    "ghost_market_log": market_lines,
    "neuromorphic_data": gpu_lines,
    "node_sync_harvest": mining_lines,
    "qubic_ticks_snn": tick_lines,
}
SPEC = {s.key: s for s in SOURCES}
# Texts of the whole jobs are packed. A packed file is one task's work, so raw sources come in files of few events.
PACKED = "lz4"
RAW_FILE_BYTES = 8 << 20


def raw_source(spark: SparkSession, sf_dir: str, key: str, root: str) -> str:
    """Write one raw source, its lines in event order."""
    events = table(spark, sf_dir, "events")
    # Ordered first: texts are longer than the events they are made of.
    lines = RAW_LINES[key](in_source_order(events, "event_id", events.count(), RAW_FILE_BYTES))
    path = f"{root}/{SPEC[key].filename}"
    with freed_shuffles(spark):
        lines.select("value").write.mode("overwrite").option("compression", PACKED).text(path)
    return path


def cleaned(key: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        workspace = Workspace(spark)
        path = raw_source(spark, sf_dir, key, workspace.path("raw"))
        rows = SPEC[key].cleaner(spark, path, workspace).published()
        workspace.drop("raw")  # its lines are parsed and stored
        return rows

    return query


def publish_outcomes(spark, sf_dir):
    """All four sources through cleaning, gates, reports, outputs and samples; a raw source is kept until it is parsed."""
    rows = []
    with Workspace(spark) as workspace:
        root = workspace.path("publish")
        for key in RAW_LINES:
            raw_source(spark, sf_dir, key, f"{root}/in")
            outcomes = run_all(
                spark, f"{root}/in", f"{root}/out", f"{root}/reports", only=[key], compression=PACKED, discard_input=True
            )
            rows += [(o.key, o.ok, o.validation.n_in, o.validation.n_out, len(o.sample_paths)) for o in outcomes]
    return spark.createDataFrame(
        rows, "source string, ok boolean, n_in bigint, n_out bigint, n_samples bigint"
    )


def built_tree(spark: SparkSession, sf_dir: str, workspace: Workspace):
    """All published sources, the trajectory tree over them, and its report. Of a source that is published no scratch is kept."""
    root = workspace.path("tree")
    for key in RAW_LINES:
        with freed_shuffles(spark), Workspace(spark) as scratch:
            path = raw_source(spark, sf_dir, key, scratch.path("raw"))
            result = SPEC[key].cleaner(spark, path, scratch)
            scratch.drop("raw")  # its lines are parsed and stored
            write_jsonl(
                result.rows,
                f"{root}/{SPEC[key].output}",
                order_by=ROW,
                n_rows=result.n_in,
                columns=result.columns,
                compression=PACKED,
            )
    return root, build_trajectories(spark, root, episode_len=EPISODE_STEPS, horizon=HORIZON)


def stored_trajectories(spark, sf_dir):
    """The joined rows of all splits, read back from the bucketed tables of a build."""
    root, _ = built_tree(spark, sf_dir, Workspace(spark))
    # The result is read from the build alone, as late as the program likes.
    for other in set(storage.children(spark, root)) - {BUILD_DIR}:
        storage.remove(spark, f"{root}/{other}")
    parts = [read_trajectories(spark, root, split, verify="content").withColumn("split", F.lit(split)) for split in SPLITS]
    known = [F.col(c).cast("double").alias(c) for c in ("gpu_temp_c", "sm_clock_mhz", "vddcr_gfx_v", "d_gpu_temp_c")]
    rows = [p.select("split", "episode_id", "step_idx", *known, "teacher_rule_id", "is_first", "is_last") for p in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def stored_encoders(spark, sf_dir):
    """The encoder rows of a build, read back: one for each feature, so that nothing of the tree need be kept for them."""
    with Workspace(spark) as workspace:
        root, _ = built_tree(spark, sf_dir, workspace)
        encoders = read_table(spark, root, "encoding_params", "train").select(
            "feature_name", "encoder_type", *[F.col(c).cast("double").alias(c) for c in ("min", "max", "threshold")]
        )
        return spark.createDataFrame(encoders.collect(), encoders.schema)


def trajectory_build(spark, sf_dir):
    """Published sources to the whole trajectory tree; row counts per table and split."""
    with Workspace(spark) as workspace:
        _, report = built_tree(spark, sf_dir, workspace)
    rows = [(c, s, n) for c, splits in report.configs.items() for s, n in splits.items()]
    return spark.createDataFrame(rows, "config string, split string, n bigint")


QUERIES: dict[str, Query] = {
    "column_health": column_health,
    "dead_column_drift": dead_column_drift,
    "distinct_payload_ratio": distinct_payload_ratio,
    "column_value_counts": column_value_counts,
    "column_profile": column_profile,
    "whole_row_distinct": whole_row_distinct,
    "gate_report": gate_report,
    "timestamp_gaps": timestamp_gaps,
    "backward_jumps": backward_jumps,
    "ordering_breaks": ordering_breaks,
    "sparse_stamp_gaps": sparse_stamp_gaps,
    "fabrication_check": fabrication_check,
    "trailing_disorder": trailing_disorder,
    "quarantined_tail": quarantined_tail,
    "timestamp_normalize": timestamp_normalize,
    "timestamp_forms": timestamp_forms,
    "numeric_epochs": numeric_epochs,
    "chain_attribution": chain_attribution,
    "quarantine_counts": quarantine_counts,
    "json_validate": json_validate,
    "ingest_counts": ingest_counts,
    "ingest_examples": ingest_examples,
    "jsonl_scan": jsonl_scan,
    "raw_line_sample": raw_line_sample,
    "raw_lines_by_form": raw_lines_by_form,
    "line_count": line_count,
    "jsonl_render": jsonl_render,
    "roundtrip_verify": roundtrip_verify,
    "row_differences": row_differences,
    "minmax_normalized": minmax_normalized,
    "derived_columns": derived_columns,
    "seeded_sample": seeded_sample,
    "large_seeded_sample": large_seeded_sample,
    "stratified_sample": stratified_sample,
    "unlisted_strata": unlisted_strata,
    "marker_filter": marker_filter,
    "mixed_fixture": mixed_fixture,
    "episodes": episodes,
    "split_row_counts": split_row_counts,
    "nondegenerate_splits": nondegenerate_splits,
    "horizon_deltas": horizon_deltas,
    "long_episode_deltas": long_episode_deltas,
    "step_structure": step_structure,
    "gapped_episode_flags": gapped_episode_flags,
    "gapped_capture_flags": gapped_capture_flags,
    "state_projection": state_projection,
    "action_labels": action_labels,
    "label_counts": label_counts,
    "outcome_table": outcome_table,
    "trajectory_join": trajectory_join,
    "key_uniqueness": key_uniqueness,
    "duplicate_keys": duplicate_keys,
    "contiguity_check": contiguity_check,
    "columns_equal": columns_equal,
    "feature_extremes": feature_extremes,
    "flat_signals": flat_signals,
    "clean_gpu": cleaned("neuromorphic_data"),
    "clean_mining": cleaned("node_sync_harvest"),
    "clean_ticks": cleaned("qubic_ticks_snn"),
    "clean_market": cleaned("ghost_market_log"),
    "publish_outcomes": publish_outcomes,
    "trajectory_build": trajectory_build,
    "stored_trajectories": stored_trajectories,
    "stored_encoders": stored_encoders,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every publication gate over a table, as one lazy plan."""
    return gate_report(spark, SMOKE_DIR)


def training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, as far as they are installed."""
    found: tuple[dict[str, Query], dict[str, str]] = ({}, {})
    try:
        from plumbline.llm import queries as operators
        import corpus_pipeline as pipeline
    except ModuleNotFoundError as absent:
        if absent.name not in ("plumbline.llm", "corpus_pipeline"):
            raise
        return found
    found[0].update(operators.QUERIES, pipeline=pipeline.run)
    found[1].update(operators.ORACLE_SQL)
    if pipeline.ORACLE_SQL is not None:
        found[1]["pipeline"] = pipeline.ORACLE_SQL
    return found


def queries() -> dict[str, Query]:
    return QUERIES | training_data()[0]


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE

    return dict(ORACLE) | training_data()[1]
