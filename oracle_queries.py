"""DuckDB counterparts of the registered queries, written independently of the Spark code."""

from __future__ import annotations

from plumbline.plans import contracts as C

STEPS, HORIZON = 64, 8

ORDERS_DEAD = """
dead AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN o_orderstatus END AS pending_mark,
         CAST(NULL AS DOUBLE) AS never_filled, 'ORDER' AS record_kind
  FROM orders)
"""

DEAD_COLUMNS = (
    "o_orderkey o_custkey o_orderstatus o_totalprice o_orderpriority pending_mark never_filled record_kind"
).split()


def health_rows(table: str, columns: list[str]) -> str:
    one = """
  SELECT '{c}' AS "column", count(*) AS n, count({c}) AS filled, count(*) - count({c}) AS nulls,
         count(DISTINCT {c}) <= 1 AS is_dead,
         (count(DISTINCT {c}) = 1 AND count({c}) = count(*)) OR count({c}) = 0 AS is_constant,
         count({c}) = 0 AS is_all_null
  FROM {t}"""
    return "\n  UNION ALL".join(one.format(c=c, t=table) for c in columns)


EVENT_US = "SELECT event_id, epoch_us(ts) AS stamp_us FROM events"

LATE = f"""
late AS (
  SELECT event_id, stamp_us - CASE WHEN event_id > (SELECT max(event_id) FROM events) - 12
                                   THEN 75600000000 ELSE 0 END AS stamp_us
  FROM ({EVENT_US})),
late_gaps AS (
  SELECT event_id, stamp_us, lag(stamp_us) OVER (ORDER BY event_id) AS previous FROM late),
late_run AS (
  SELECT max(event_id) AS r0 FROM late_gaps WHERE previous - stamp_us > 60000000),
late_figures AS (
  SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_id >= r0) AS run_rows,
         count(*) FILTER (WHERE event_id >= r0 AND stamp_us IS NULL) AS unstamped, max(r0) AS run_start
  FROM late, late_run),
late_cut AS (
  SELECT *, CASE WHEN run_rows > 0 AND unstamped = 0 AND run_rows <= 64
                  AND run_rows / total_rows <= 0.10 THEN run_start END AS cut
  FROM late_figures)
"""

TEXTS = """
texts AS (
  SELECT event_id,
    CASE event_id % 7
      WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.') || left(strftime(ts, '%f'), 3)
      WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '458'
      WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '-05:00'
      WHEN 3 THEN 'Dynex:9' || event_id
      WHEN 4 THEN 'qubic:204:46' || event_id
      WHEN 5 THEN CAST(1700000000 + event_id AS VARCHAR)
      ELSE '12:30:00 ' || event_id END AS stamp
  FROM events)
"""

READ = f"""
WITH {TEXTS},
shaped AS (
  SELECT *,
    regexp_full_match(stamp, '[A-Za-z][A-Za-z0-9_-]*:[0-9]+(:[0-9]+)?') AS is_tag,
    regexp_full_match(stamp, '[0-9]{{9,11}}') AS is_epoch,
    regexp_full_match(stamp,
      '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]+)?([+-][0-9]{{2}}:[0-9]{{2}})?'
    ) AS is_datetime,
    CASE WHEN length(stamp) - length(replace(stamp, ':', '')) = 2 THEN split_part(stamp, ':', 2) END AS mid,
    rpad(left(regexp_extract(stamp, '[.]([0-9]+)', 1), 6), 6, '0') AS frac,
    regexp_extract(stamp, '[+-][0-9]{{2}}:[0-9]{{2}}$') AS off
  FROM texts),
read AS (
  SELECT *,
    CASE WHEN is_epoch THEN CAST(stamp AS BIGINT) * 1000000
         WHEN is_datetime THEN
           epoch_us(strptime(replace(left(stamp, 19), 'T', ' '), '%Y-%m-%d %H:%M:%S')) + CAST(frac AS BIGINT)
           - CASE WHEN off = '' THEN 0
                  ELSE (CASE WHEN left(off, 1) = '-' THEN -1 ELSE 1 END)
                       * (CAST(substr(off, 2, 2) AS BIGINT) * 3600 + CAST(substr(off, 5, 2) AS BIGINT) * 60)
                       * 1000000 END
         END AS ts_micros,
    CASE WHEN is_epoch THEN strftime(make_timestamp(CAST(stamp AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')
         WHEN is_datetime THEN replace(left(stamp, 19), ' ', 'T')
           || CASE WHEN frac = '000000' THEN '' ELSE '.' || frac END || off END AS iso
  FROM shaped)
"""

FORM = """
CASE WHEN regexp_full_match(left({0}, 4), '[0-9]+') THEN
       CASE WHEN regexp_matches({0}, '[+-][0-9][0-9]:[0-9][0-9]$') THEN 'placeholder_tail' ELSE 'datetime' END
     WHEN length({0}) - length(replace({0}, ':', '')) = 2 THEN 'coin_epoch_tick'
     WHEN contains({0}, ':') THEN 'coin_height' ELSE 'other' END
""".format("stamp")

LINES = r"""
lines AS (
  SELECT event_id AS row_index, event_id % 10 AS way, CAST(json_extract(props, '$.k') AS BIGINT) AS k0,
    CASE event_id % 10
      WHEN 1 THEN regexp_replace(props, '([0-9]+)', '"\1"')
      WHEN 2 THEN left(props, length(props) - 1)
      WHEN 3 THEN replace(props, '}', ', "z": 2}')
      WHEN 4 THEN regexp_replace(props, '[0-9]+', '"x"')
      WHEN 5 THEN '  '
      WHEN 6 THEN props || props
      WHEN 7 THEN '{}'
      WHEN 8 THEN regexp_replace(props, '[0-9]+', 'null')
      WHEN 9 THEN '[' || props || ']'
      ELSE props END AS value
  FROM events),
judged AS (
  SELECT row_index, value,
    CASE WHEN trim(value) = '' THEN 'blank'
         WHEN NOT json_valid(value) THEN 'malformed'
         WHEN json_type(value) <> 'OBJECT' THEN 'schema'
         WHEN len(list_filter(json_keys(value), lambda x: x <> 'k')) > 0 THEN 'schema'
         WHEN NOT list_contains(json_keys(value), 'k') THEN 'schema'
         WHEN TRY_CAST(json_extract_string(value, '$.k') AS BIGINT) IS NULL THEN 'schema'
         ELSE 'ok' END AS error_class
  FROM lines),
lines_read AS (
  SELECT row_index, error_class,
    CASE error_class
      WHEN 'malformed' THEN 'malformed JSON'
      WHEN 'schema' THEN 'schema violation: ' ||
        CASE WHEN json_type(value) <> 'OBJECT' THEN 'Input should be a valid object'
             WHEN list_contains(json_keys(value), 'z') THEN 'z: Extra inputs are not permitted'
             WHEN NOT list_contains(json_keys(value), 'k') THEN 'k: Field required'
             ELSE 'k: Input should be a valid integer' END END AS error_detail,
    CASE WHEN error_class = 'ok' THEN CAST(json_extract_string(value, '$.k') AS BIGINT) END AS k
  FROM judged)
"""

#: Encoded features, and whether by changes.
ENCODED = [*((f, False) for f in C.RATE_FEATURES), *((f, True) for f in C.DELTA_FEATURES)]

LAYOUT = f"""
size AS (SELECT (count(*) + {STEPS - 1}) // {STEPS} AS n FROM events),
layout AS (
  SELECT n, CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) AS t,
         CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) + 1 AS v0,
         CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) + 1
           + CAST(floor(n * CAST(0.15 AS DOUBLE)) AS BIGINT) AS v1
  FROM size),
placed AS (
  SELECT e.*, event_id // {STEPS} AS episode,
         'gpu-' || lpad(CAST(event_id // {STEPS} AS VARCHAR), 6, '0') AS episode_id,
         CAST(event_id % {STEPS} AS INTEGER) AS step_idx,
         CASE WHEN event_id // {STEPS} < t THEN 'train'
              WHEN event_id // {STEPS} >= v0 AND event_id // {STEPS} < v1 THEN 'validation'
              WHEN event_id // {STEPS} >= v1 + 1 THEN 'test' END AS split
  FROM events e, layout)
"""

STATE = f"""
state AS (
  SELECT 'gpu-' || lpad(CAST(event_id // {STEPS} AS VARCHAR), 6, '0') AS episode_id,
    CAST(event_id % {STEPS} AS INTEGER) AS step_idx, CAST(value AS FLOAT) AS gpu_temp_c,
    CASE (event_id * 7919) % 97 WHEN 1 THEN 128 WHEN 2 THEN 64 WHEN 3 THEN 8 WHEN 4 THEN 32
         WHEN 5 THEN NULL ELSE 4 END AS mask,
    CASE (event_id * 31) % 101 WHEN 0 THEN 2 WHEN 1 THEN NULL ELSE 0 END AS ecc,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN (event_id // 8) % 5 = 0 THEN CAST(0.97 AS FLOAT)
         ELSE CAST(0.5 AS FLOAT) END AS kv,
    CAST(event_id % 5 AS INTEGER) AS q,
    CAST(CASE (event_id // 16) % 3 WHEN 0 THEN 100 + event_id % 3 WHEN 1 THEN 0
              ELSE 100 * (event_id % 4 + 1) END AS DOUBLE) AS rate,
    event_id // 6 AS pre
  FROM events),
seen AS (
  SELECT *,
    sum(CASE WHEN kv >= CAST(0.95 AS DOUBLE) THEN 1 ELSE 0 END)
      OVER (PARTITION BY episode_id ORDER BY step_idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS kv3,
    sum(CASE WHEN kv >= CAST(0.95 AS DOUBLE) THEN 1 ELSE 0 END)
      OVER (PARTITION BY episode_id ORDER BY step_idx ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS kv6,
    lag(q, 1) OVER w AS q1, lag(q, 2) OVER w AS q2, lag(rate, 1) OVER w AS r1, lag(rate, 2) OVER w AS r2,
    lag(pre, 2) OVER w AS p2
  FROM state WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)),
ruled AS (
  SELECT *,
    coalesce(q1 > q2 AND q > q1 AND r1 IS NOT NULL AND r2 IS NOT NULL
      AND (greatest(rate, r1, r2) <= 0
           OR (greatest(rate, r1, r2) - least(rate, r1, r2)) / greatest(rate, r1, r2) <= 0.05), FALSE) AS flat,
    coalesce(pre > p2, FALSE) AS rising
  FROM seen),
labels_all AS (
  SELECT *,
    CASE WHEN mask IS NULL OR ecc IS NULL THEN NULL
         WHEN ecc > 0 THEN 'TR-001-ECC-DBE'
         WHEN mask & 128 <> 0 THEN 'TR-002-HW-POWER-BRAKE'
         WHEN mask & 64 <> 0 THEN 'TR-003-HW-THERMAL'
         WHEN mask & 8 <> 0 THEN 'TR-004-HW-SLOWDOWN'
         WHEN mask & 32 <> 0 THEN 'TR-005-SW-THERMAL'
         WHEN kv6 = 6 THEN 'TR-007-KV-PRESSURE-BATCH'
         WHEN kv3 = 3 THEN 'TR-006-KV-PRESSURE-EVICT'
         WHEN flat AND rising THEN 'TR-009-QUEUE-PREEMPT'
         WHEN flat THEN 'TR-008-QUEUE-GROWTH'
         ELSE 'TR-000-NOMINAL' END AS rule
  FROM ruled),
labelled AS (
  SELECT episode_id, step_idx, rule,
    CASE left(rule, 6) WHEN 'TR-001' THEN 'escalate_to_human' WHEN 'TR-002' THEN 'cap_power'
      WHEN 'TR-003' THEN 'throttle_clocks' WHEN 'TR-004' THEN 'throttle_clocks' WHEN 'TR-005' THEN 'raise_fan'
      WHEN 'TR-007' THEN 'reduce_batch_size' WHEN 'TR-006' THEN 'evict_kv_cache'
      WHEN 'TR-009' THEN 'reroute_request' WHEN 'TR-008' THEN 'shed_load' ELSE 'no_op' END AS action,
    CASE left(rule, 6) WHEN 'TR-001' THEN 13 WHEN 'TR-002' THEN 10 WHEN 'TR-003' THEN 1 WHEN 'TR-004' THEN 1
      WHEN 'TR-005' THEN 11 WHEN 'TR-007' THEN 4 WHEN 'TR-006' THEN 5 WHEN 'TR-009' THEN 8
      WHEN 'TR-008' THEN 7 ELSE 0 END AS action_id
  FROM labels_all WHERE rule IS NOT NULL),
outcome AS (
  SELECT episode_id, step_idx,
    CAST(CAST(lead(gpu_temp_c, {HORIZON}) OVER w AS DOUBLE) - CAST(gpu_temp_c AS DOUBLE) AS FLOAT) AS d_gpu_temp_c,
    lead(step_idx) OVER w IS NULL AS is_last
  FROM state WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx))
"""


def gaps(source: str, key: str) -> str:
    return f"""
  SELECT {key}, stamp_us, previous, stamp_us - previous AS gap_us
  FROM (SELECT {key}, stamp_us, lag(stamp_us) OVER (ORDER BY {key}) AS previous
        FROM ({source}) WHERE stamp_us IS NOT NULL)
  WHERE previous IS NOT NULL"""


ORDER_GAPS = gaps("SELECT o_orderkey, epoch_us(o_orderdate) AS stamp_us FROM orders", "o_orderkey")


def fabrication(source: str) -> str:
    return f"""
  count(*) AS n_gaps, min(gap_us) AS min_gap_us, max(gap_us) AS max_gap_us,
  count(*) >= 2 AND (min(gap_us) = max(gap_us)
    OR (avg(gap_us) > 0 AND stddev_pop(gap_us) / avg(gap_us) < 1e-9)) AS fabricated
  FROM ({gaps(source, "event_id")})"""


def value_counts(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY 2"""
        for c in columns
    )


LINE_COLUMNS = "(SELECT *, CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS returned FROM lineitem)"
PART_COLUMNS = "(SELECT * REPLACE (CASE WHEN p_size > 5 THEN p_size END AS p_size) FROM part)"

MARKET_NUMBERS = (
    "price_usd",
    "quantity",
    "trade_value_usdt",
    "realized_pnl_usdt",
    "balance_usdt",
    "balance_dnx",
    "balance_sol",
    "balance_render",
    "balance_asi",
    "balance_near",
    "balance_btc",
    "balance_pepe",
    "render_qty",
    "asi_qty",
    "near_qty",
    "btc_qty",
    "pepe_qty",
    "cumulative_pnl",
    "portfolio_value",
)

ORACLE: dict[str, str] = {
    "column_health": f"WITH {ORDERS_DEAD} {health_rows('dead', DEAD_COLUMNS)}",
    "dead_column_drift": f"""
WITH {ORDERS_DEAD}, measured AS ({health_rows('dead', DEAD_COLUMNS)})
SELECT "column", CASE WHEN is_dead THEN 'newly_dead' ELSE 'carries_signal' END AS kind FROM measured
WHERE is_dead <> ("column" IN ('o_totalprice', 'never_filled', 'record_kind'))""",
    "distinct_payload_ratio": """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, round(count(*) / sum(c), 8) AS ratio
FROM (SELECT count(*) AS c FROM events GROUP BY event_type, user_id)""",
    "column_value_counts": value_counts(
        LINE_COLUMNS, ["l_returnflag", "l_linestatus", "l_linenumber", "returned"]
    ),
    "column_profile": f"""
WITH counts AS ({value_counts(PART_COLUMNS, ["p_brand", "p_type", "p_size", "p_name"])})
SELECT "column", count(value) AS n_distinct,
  CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS nulls,
  round(1.0 - CAST(coalesce(sum(n) FILTER (WHERE value IS NULL), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6)
    AS fill_rate,
  array_to_string(list_sort(list(value) FILTER (WHERE value IS NOT NULL))[1:5], '|') AS sample
FROM counts GROUP BY "column" """,
    "whole_row_distinct": """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, round(count(*) / sum(c), 8) AS distinct_ratio
FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)""",
    "gate_report": f"""
WITH rows_out AS (
  SELECT event_id AS row_index, epoch_us(ts) AS stamp_us, event_type, user_id, value, 'capture' AS origin,
         CAST(NULL AS VARCHAR) AS note FROM events),
measured AS ({health_rows('rows_out', 'row_index event_type user_id value origin note'.split())}),
groups AS (SELECT count(*) AS c FROM rows_out GROUP BY event_type, user_id, value, origin, note),
distincts AS (SELECT count(*) AS n_distinct, CAST(sum(c) AS BIGINT) AS n_rows FROM groups),
spaced AS ({gaps('SELECT row_index, stamp_us FROM rows_out', 'row_index')})
SELECT 'no_constant_columns' AS gate, "column", CASE WHEN is_constant THEN 'true' ELSE 'false' END AS observed,
       NOT is_constant AS passed FROM measured WHERE "column" <> 'note'
UNION ALL SELECT 'no_all_null_columns', "column", CASE WHEN is_all_null THEN 'true' ELSE 'false' END,
       NOT is_all_null FROM measured
UNION ALL SELECT 'not_empty', NULL, CAST(n_rows AS VARCHAR), n_rows > 0 FROM distincts
UNION ALL SELECT 'payload_columns_remain', NULL, '5', TRUE
UNION ALL SELECT 'distinct_rows', NULL, CAST(n_distinct AS VARCHAR), n_distinct / n_rows >= 0.01 FROM distincts
UNION ALL SELECT 'row_count_delta', NULL, CAST((SELECT count(*) FROM events) - n_rows AS VARCHAR),
       abs((SELECT count(*) FROM events) - n_rows) / (SELECT count(*) FROM events) <= 0.05 FROM distincts
UNION ALL SELECT 'schema_matches', NULL, 'region,note', FALSE
UNION ALL SELECT 'timestamps_ordered', NULL, CAST(count(*) FILTER (WHERE gap_us < -60000000) AS VARCHAR),
       count(*) FILTER (WHERE gap_us < -60000000) = 0 FROM spaced
UNION ALL SELECT 'timestamps_not_fabricated', NULL, CAST(max(gap_us) - min(gap_us) AS VARCHAR),
       NOT (min(gap_us) = max(gap_us) OR (avg(gap_us) > 0 AND stddev_pop(gap_us) / avg(gap_us) < 1e-9))
       FROM spaced""",
    "timestamp_gaps": ORDER_GAPS,
    "backward_jumps": f"SELECT o_orderkey, -gap_us AS backward_us FROM ({ORDER_GAPS}) WHERE -gap_us > 60000000",
    "ordering_breaks": f"""
SELECT count(*) AS n_breaks, min(o_orderkey) AS first_break, arg_min(-gap_us, o_orderkey) AS first_backward_us
FROM ({ORDER_GAPS}) WHERE -gap_us > 60000000""",
    "sparse_stamp_gaps": gaps(
        "SELECT event_id, CASE WHEN event_type = 'error' THEN epoch_us(ts) END AS stamp_us FROM events",
        "event_id",
    ),
    "fabrication_check": f"""
SELECT {fabrication(EVENT_US).replace('AS fabricated', "AS fabricated, 'observed' AS series")}
UNION ALL SELECT {fabrication(
    "SELECT event_id, 1773000000000000 + event_id * 10000000 AS stamp_us FROM events"
).replace('AS fabricated', "AS fabricated, 'generated' AS series")}""",
    "trailing_disorder": f"WITH {LATE} SELECT * FROM late_cut",
    "quarantined_tail": f"WITH {LATE} SELECT late.* FROM late, late_cut WHERE event_id >= cut",
    "timestamp_normalize": f"""{READ}
SELECT event_id, stamp, is_tag OR ts_micros IS NOT NULL AS ts_ok, ts_micros, iso,
  CASE WHEN is_tag THEN lower(split_part(stamp, ':', 1)) END AS coin,
  CASE WHEN is_tag THEN CAST(split_part(stamp, ':', -1) AS BIGINT) END AS height,
  CASE WHEN is_tag THEN CAST(mid AS BIGINT) END AS chain_epoch, {FORM} AS form
FROM read""",
    "timestamp_forms": f"WITH {TEXTS} SELECT {FORM} AS form, count(*) AS n FROM texts GROUP BY 1",
    "numeric_epochs": """
SELECT event_id, TRUE AS ts_ok, (1700000000 + event_id * 3) * 1000000 AS ts_micros,
  strftime(make_timestamp((1700000000 + event_id * 3) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
  'epoch_number' AS form FROM events""",
    "chain_attribution": f"""{READ}
SELECT CASE WHEN is_tag THEN lower(split_part(stamp, ':', 1)) ELSE '__unattributed__' END AS chain,
  count(*) AS n FROM read GROUP BY 1""",
    "quarantine_counts": f"""{READ}
SELECT 'unparseable' AS reason, count(*) AS n FROM read WHERE NOT is_tag AND ts_micros IS NULL""",
    "json_validate": f"WITH {LINES} SELECT * FROM lines_read",
    "ingest_counts": f"WITH {LINES} SELECT error_class, count(*) AS n FROM lines_read GROUP BY 1",
    "ingest_examples": f"""WITH {LINES} SELECT row_index, error_class, error_detail FROM lines_read
WHERE error_class IN ('malformed', 'schema') ORDER BY row_index LIMIT 5""",
    "jsonl_scan": """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_index, event_id, user_id, event_type, value FROM events""",
    "raw_line_sample": """
SELECT row_index, event_id FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_index, event_id FROM events)
ORDER BY md5('20260803:' || row_index), row_index LIMIT 100""",
    "raw_lines_by_form": f"""
WITH {TEXTS}, lines AS (
  SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_index, {FORM} AS form, stamp FROM texts)
SELECT row_index, form, stamp FROM (SELECT *, row_number() OVER (
  PARTITION BY form ORDER BY CASE WHEN form = 'coin_height' THEN -row_index ELSE row_index END) AS rn FROM lines)
WHERE rn <= 25""",
    "line_count": "SELECT count(*) AS n_lines, count(*) AS n_rows FROM events",
    "jsonl_render": """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","priority":'
  || CASE WHEN o_orderstatus = 'F' THEN '"' || o_orderpriority || '"' ELSE 'null' END || '}' AS value
FROM orders""",
    "roundtrip_verify": "SELECT 'events' AS config, count(*) AS n_rows FROM events",
    "row_differences": """
SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(sum(side) AS BIGINT) AS surplus FROM (
  SELECT o_custkey, o_orderstatus, o_orderpriority, 1 AS side FROM orders
  UNION ALL SELECT o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN '9-NONE' ELSE o_orderpriority END, -1 FROM orders)
GROUP BY 1, 2, 3 HAVING sum(side) <> 0""",
    "minmax_normalized": """
SELECT p_partkey, CAST(p_partkey - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) AS trace,
  (p_retailprice - plo) / (phi - plo) AS rate
FROM part, (SELECT min(p_partkey) AS lo, max(p_partkey) AS hi, min(p_retailprice) AS plo,
                   max(p_retailprice) AS phi FROM part)""",
    "derived_columns": """
SELECT p_partkey, round(1.0 + r, 6) AS hashrate_mh_derived, round(300.0 + 100.0 * r, 6) AS power_w_derived,
  round(60.0 + 15.0 * r, 6) AS gpu_temp_c_derived, round(r, 6) AS reward_hint_derived
FROM (SELECT p_partkey, CAST(p_size - lo AS DOUBLE) / CAST(hi - lo AS DOUBLE) AS r
      FROM part, (SELECT min(p_size) AS lo, max(p_size) AS hi FROM part))""",
    "seeded_sample": """
SELECT event_id, event_type FROM events ORDER BY md5('20260803:' || event_id), event_id LIMIT 100""",
    "large_seeded_sample": """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('20260803:' || o_orderkey), o_orderkey LIMIT 1000""",
    "stratified_sample": """
SELECT event_id, event_type FROM (
  SELECT event_id, event_type, row_number() OVER (
    PARTITION BY event_type
    ORDER BY CASE WHEN event_type = 'purchase' THEN -event_id ELSE event_id END) AS rn FROM events)
WHERE rn <= 20 OR event_type = 'error'""",
    "unlisted_strata": """
SELECT event_id, kind AS event_type FROM (
  SELECT event_id, kind, row_number() OVER (PARTITION BY kind ORDER BY event_id) AS rn
  FROM (SELECT event_id, nullif(event_type, 'signup') AS kind FROM events))
WHERE rn <= 30 OR kind = 'error'""",
    "marker_filter": """
SELECT doc_id, lang, n_chars FROM documents
WHERE contains(text, 'http') OR contains(text, 'License') OR contains(text, '@')""",
    "mixed_fixture": """
(SELECT doc_id, n_chars FROM documents ORDER BY md5('20260803:' || doc_id), doc_id LIMIT 50)
UNION ALL
(SELECT doc_id, n_chars FROM documents WHERE contains(text, 'License') ORDER BY doc_id LIMIT 20)""",
    "episodes": f"WITH {LAYOUT} SELECT event_id, episode, episode_id, step_idx, split FROM placed",
    "split_row_counts": f"""
WITH {LAYOUT} SELECT split, count(*) AS n FROM placed WHERE split IS NOT NULL GROUP BY split""",
    "nondegenerate_splits": f"""
WITH {LAYOUT}, marked AS (SELECT *, CASE WHEN split <> 'train' THEN value END AS late_value FROM placed)
SELECT split, 'value' AS "column", count(*) AS n_rows, count(value) AS filled, count(value) = 0 AS degenerate
FROM marked WHERE split IS NOT NULL GROUP BY split
UNION ALL SELECT split, 'user_id', count(*), count(user_id), count(user_id) = 0
FROM marked WHERE split IS NOT NULL GROUP BY split
UNION ALL SELECT split, 'late_value', count(*), count(late_value), count(late_value) = 0
FROM marked WHERE split IS NOT NULL GROUP BY split""",
    "horizon_deltas": f"""
WITH {LAYOUT} SELECT event_id, episode_id, step_idx, value,
  lead(value, {HORIZON}) OVER (PARTITION BY episode_id ORDER BY step_idx) - value AS d_value FROM placed""",
    "long_episode_deltas": f"""
SELECT event_id, 'capture' AS episode_id, value,
  lead(value, {HORIZON}) OVER (ORDER BY event_id) - value AS d_value FROM events""",
    "step_structure": f"""
WITH {LAYOUT} SELECT event_id, episode_id, step_idx, step_idx = 0 AS is_first,
  lead(step_idx) OVER (PARTITION BY episode_id ORDER BY step_idx) IS NULL AS is_last FROM placed""",
    "gapped_episode_flags": f"""
WITH {LAYOUT} SELECT event_id, episode_id, step_idx, value,
  lead(value, {HORIZON}) OVER w - value AS d_value, step_idx = 0 AS is_first, lead(step_idx) OVER w IS NULL AS is_last
FROM placed WHERE event_id % 10 <> 3 WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)""",
    "gapped_capture_flags": f"""
SELECT 'capture' AS episode_id, event_id AS step_idx, value, lead(value, {HORIZON}) OVER w - value AS d_value,
  event_id = 0 AS is_first, lead(event_id) OVER w IS NULL AS is_last
FROM events WHERE event_id % 10 <> 3 WINDOW w AS (ORDER BY event_id)""",
    "state_projection": f"""
WITH {STATE} SELECT episode_id, step_idx, CAST(NULL AS BIGINT) AS ts_utc, '3.0.0' AS schema_version, gpu_temp_c,
  CAST(mask AS BIGINT) AS throttle_reasons, q AS num_requests_waiting,
  CAST(NULL AS SMALLINT) AS fpga_membrane_q88, CAST(NULL AS VARCHAR) AS regime, FALSE AS synthetic FROM state""",
    "action_labels": f"""
WITH {STATE} SELECT episode_id, step_idx, '3.0.0' AS schema_version, CAST(NULL AS VARCHAR) AS proposed_action,
  action AS teacher_action, CAST(action_id AS SMALLINT) AS teacher_action_id, rule AS teacher_rule_id,
  CASE WHEN action_id = 13 THEN 'migrate_workload' END AS paired_action, 'teacher_rule' AS label_source,
  CAST(1.0 AS FLOAT) AS label_confidence FROM labelled""",
    "label_counts": f"""
WITH {STATE} SELECT rule AS teacher_rule_id, action AS teacher_action, count(*) AS n
FROM labelled GROUP BY 1, 2""",
    "outcome_table": f"""
WITH {STATE} SELECT episode_id, step_idx, d_gpu_temp_c, CAST(1.0 AS FLOAT) AS discount, FALSE AS is_terminal,
  step_idx = 0 AS is_first, is_last, CAST(NULL AS FLOAT) AS reward FROM outcome""",
    "trajectory_join": f"""
WITH {STATE} SELECT s.episode_id, s.step_idx, s.gpu_temp_c, l.rule AS teacher_rule_id, o.d_gpu_temp_c, o.is_last
FROM state s LEFT JOIN labelled l USING (episode_id, step_idx) LEFT JOIN outcome o USING (episode_id, step_idx)""",
    "key_uniqueness": """
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_keys, sum(c) = count(*) AS is_unique,
  'episode_steps' AS key_set
FROM (SELECT count(*) AS c FROM events GROUP BY event_id // 64, event_id % 64)
UNION ALL SELECT CAST(sum(c) AS BIGINT), count(*), sum(c) = count(*), 'order_lines'
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "contiguity_check": " UNION ALL ".join(
        f"""SELECT count(*) AS n_rows, count({c}) AS n_filled, min({c}) AS low, max({c}) AS high,
  count(DISTINCT {c}) AS n_distinct,
  count({c}) = count(*) AND min({c}) = 0 AND max({c}) = count(*) - 1 AND count(DISTINCT {c}) = count(*)
    AS contiguous, '{t}' AS source FROM {t}"""
        for t, c in (("events", "event_id"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"))
    ),
    "columns_equal": """
SELECT count(*) AS n_rows, count(*) AS n_equal, TRUE AS all_equal, 'same' AS pair FROM events
UNION ALL SELECT count(*), count(*) FILTER (WHERE event_type <> 'error'),
  count(*) = count(*) FILTER (WHERE event_type <> 'error'), 'holes' FROM events""",
    "feature_extremes": f"""
WITH {LAYOUT}, train AS (SELECT * FROM placed WHERE split = 'train')
SELECT 'value' AS feature_name, min(value) AS min, max(value) AS max FROM train
UNION ALL SELECT 'user_id', CAST(min(user_id) AS DOUBLE), CAST(max(user_id) AS DOUBLE) FROM train
UNION ALL SELECT 'step_idx', CAST(min(step_idx) AS DOUBLE), CAST(max(step_idx) AS DOUBLE) FROM train
UNION ALL SELECT 'empty_feature', NULL, NULL""",
    "flat_signals": """
SELECT event_id AS row_index, CAST(NULL AS BIGINT) AS ts_utc, '3.0.0' AS schema_version, user_id, event_type, value
FROM events""",
    "clean_gpu": """
SELECT 0.5::DOUBLE + (event_id * 17 % 29) / 64 AS vddcr_gfx_v, 20::DOUBLE + (event_id * 7 % 43) / 2 AS vram_temp_c,
  value AS gpu_temp_c, user_id::DOUBLE AS power_w, (900 + event_id * 13 % 37)::DOUBLE AS gpu_clock_mhz,
  (400 + event_id * 11 % 17)::DOUBLE AS mem_clock_mhz, (900 + event_id * 13 % 37)::DOUBLE AS clock_mhz,
  (event_id * 19 % 83)::DOUBLE AS fan_speed_pct, (event_id * 23 % 59) / 2 AS mem_util_pct,
  (event_id * 3 % 31)::DOUBLE AS qubic_tick_trace, (event_id * 5 % 23) / 8 AS qubic_tick_rate,
  (event_id * 29 % 47) / 64 AS qubic_epoch_progress, event_id AS row_index FROM events""",
    "clean_mining": """
SELECT value AS hashrate_mh, user_id::DOUBLE AS power_w,
  CASE WHEN event_id % 7 NOT IN (3, 4) THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN left(strftime(ts, '%f'), 3) = '000' THEN ''
            ELSE '.' || left(strftime(ts, '%f'), 3) || '000' END END AS timestamp,
  CASE event_id % 7 WHEN 3 THEN 'dynex' WHEN 4 THEN 'qubic' END AS blockchain,
  CASE event_id % 7 WHEN 3 THEN CAST('9' || event_id AS BIGINT) WHEN 4 THEN CAST('46' || event_id AS BIGINT) END
    AS block_height,
  CASE WHEN event_id % 7 = 4 THEN CAST(204 AS BIGINT) END AS chain_epoch
FROM events WHERE event_id % 50 <> 6""",
    "clean_ticks": """
SELECT strftime(make_timestamp((1700000000 + event_id * 3 + event_id % 2) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00')
    AS timestamp, event_id * 5 + 100 AS tick, value AS tick_rate,
  (event_id * 5)::DOUBLE / ((SELECT max(event_id) FROM events) * 5)::DOUBLE AS qubic_tick_trace,
  round(1.0 + r, 6) AS hashrate_mh_derived, round(300.0 + 100.0 * r, 6) AS power_w_derived,
  round(60.0 + 15.0 * r, 6) AS gpu_temp_c_derived, round(r, 6) AS reward_hint_derived
FROM (SELECT *, (value - lo) / (hi - lo) AS r
      FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events))""",
    "clean_market": f"""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '521+00:00' AS timestamp, event_id AS step,
  CASE event_id % 3 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' ELSE 'observe' END AS action, event_type AS asset,
  {", ".join(f"value + {k} AS {n}" for k, n in enumerate(MARKET_NUMBERS))},
  CASE WHEN event_id % 2 = 0 THEN 'NVDA' ELSE 'AMD' END AS ch2_mode, 'r' || user_id AS reason FROM events""",
    "publish_outcomes": """
SELECT source, TRUE AS ok, n AS n_in, n - lost AS n_out, 2 AS n_samples
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 50 = 6) AS junk FROM events),
LATERAL (VALUES ('neuromorphic_data', 0), ('node_sync_harvest', junk), ('qubic_ticks_snn', 0),
                ('ghost_market_log', 0)) AS v(source, lost)""",
    "trajectory_build": f"""
WITH {LAYOUT}, per AS (SELECT split, count(*) AS n FROM placed WHERE split IS NOT NULL GROUP BY split)
SELECT t.config, split, CASE WHEN t.filled THEN n ELSE 0 END AS n
FROM per, (VALUES ('state_telemetry', TRUE), ('outcomes', TRUE), ('action_proposals', FALSE),
                  ('safety_filter_log', FALSE)) AS t(config, filled)
UNION ALL SELECT c, 'full', (SELECT count(*) FROM events)
FROM (VALUES ('gpu_telemetry_v3'), ('qubic_signals')) AS f(c)
UNION ALL SELECT 'encoding_params', 'train', 36
UNION ALL SELECT c, 'train', (SELECT count(*) FROM events)
FROM (VALUES ('gpu_telemetry'), ('hft'), ('qubic_ticks')) AS v(c)
UNION ALL SELECT 'mining', 'train', count(*) FROM events WHERE event_id % 50 <> 6""",
    "stored_trajectories": f"""
WITH {LAYOUT}, state AS (
  SELECT *, CAST(CAST(value AS FLOAT) AS DOUBLE) AS gpu_temp_c FROM placed WHERE split IS NOT NULL)
SELECT split, episode_id, step_idx, gpu_temp_c, (900 + event_id * 13 % 37)::DOUBLE AS sm_clock_mhz,
  0.5::DOUBLE + (event_id * 17 % 29) / 64 AS vddcr_gfx_v,
  CAST(CAST(lead(gpu_temp_c, 8) OVER w - gpu_temp_c AS FLOAT) AS DOUBLE) AS d_gpu_temp_c,
  CAST(NULL AS VARCHAR) AS teacher_rule_id, step_idx = 0 AS is_first, lead(step_idx) OVER w IS NULL AS is_last
FROM state WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)""",
    "stored_encoders": f"""
WITH {LAYOUT}, train AS (
  SELECT CAST(value AS FLOAT) AS t, CAST(user_id AS FLOAT) AS p, event_id AS e FROM placed WHERE split = 'train'),
known AS (
  SELECT 'gpu_temp_c' AS feature_name, min(t)::DOUBLE AS lo, max(t)::DOUBLE AS hi FROM train
  UNION ALL SELECT 'power_w', min(p)::DOUBLE, max(p)::DOUBLE FROM train
  UNION ALL SELECT 'mem_util_pct', min(e * 23 % 59) / 2, max(e * 23 % 59) / 2 FROM train
  UNION ALL SELECT 'vram_temp_c', 20 + min(e * 7 % 43) / 2, 20 + max(e * 7 % 43) / 2 FROM train
  UNION ALL SELECT 'sm_clock_mhz', 900 + min(e * 13 % 37), 900 + max(e * 13 % 37) FROM train
  UNION ALL SELECT 'mem_clock_mhz', 400 + min(e * 11 % 17), 400 + max(e * 11 % 17) FROM train
  UNION ALL SELECT 'fan_speed_pct', min(e * 19 % 83), max(e * 19 % 83) FROM train
  UNION ALL SELECT 'vddcr_gfx_v', 0.5::DOUBLE + min(e * 17 % 29) / 64, 0.5::DOUBLE + max(e * 17 % 29) / 64 FROM train)
SELECT feature_name, CASE WHEN delta THEN 'delta' ELSE 'rate' END AS encoder_type, lo AS min, hi AS max,
  CASE WHEN delta THEN 1.0::DOUBLE END AS threshold
FROM (VALUES {", ".join(f"('{name}', {delta})" for name, delta in ENCODED)}) AS f(feature_name, delta)
LEFT JOIN known USING (feature_name)""",
}
