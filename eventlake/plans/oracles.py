"""The SQL each registered query must agree with, on the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Restated, not imported: feature -> (counter, bucket column, bucket ms, whole buckets before the current one).
TRAILING = {
    "plays_1h": ("plays", "minute", 60_000, 60), "plays_24h": ("plays", "minute", 60_000, 1440),
    "browses_1h": ("browses", "minute", 60_000, 60), "browses_24h": ("browses", "minute", 60_000, 1440),
    "searches_1h": ("searches", "minute", 60_000, 60), "searches_24h": ("searches", "minute", 60_000, 1440),
    "messages_sent_24h": ("sent", "hour", 3_600_000, 24), "opens_7d": ("opens", "hour", 3_600_000, 168),
    "clicks_7d": ("clicks", "hour", 3_600_000, 168),
}


def _floor(expr: str, seconds: int) -> str:
    """Start of the tumbling window around a timestamp expression."""
    size = seconds * 1_000_000
    return f"make_timestamp((epoch_us({expr}) // {size}) * {size})"


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- shared derivations --------------------------------------------------------------------------

EVENTS = """ev AS (
  SELECT event_id, event_type, event_type AS metric, value, ts,
    CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE 'u-' || user_id END AS user_id,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN ''
         ELSE 'u-' || user_id END AS raw_user_id,
    'cust_' || (CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 10) AS customer_id,
    CASE event_id % 5 WHEN 0 THEN '/v1/find' WHEN 1 THEN '/v1/basket' WHEN 2 THEN '/v1/help'
         WHEN 3 THEN '/v1/enter' ELSE '/v1/account' END AS endpoint,
    CASE event_id % 7 WHEN 0 THEN '201' WHEN 1 THEN '204' WHEN 2 THEN '302' WHEN 3 THEN '409'
         WHEN 4 THEN '422' WHEN 5 THEN '503' ELSE NULL END AS status
  FROM events)"""

JSON_DIMS = {
    "customer_id": "'\"customer_id\":\"' || customer_id || '\"'",
    "endpoint": "'\"endpoint\":\"' || endpoint || '\"'",
    "event_type": "'\"event_type\":\"' || event_type || '\"'",
    "status": "'\"status\":\"' || status || '\"'",
}
ALL_DIMS = ("customer_id", "endpoint", "event_type", "status")


def _dims(names: tuple[str, ...]) -> str:
    """Compact JSON of dimension columns; concat_ws leaves out the null ones."""
    if not names:
        return "'{}'"
    return "'{' || concat_ws(',', " + ", ".join(JSON_DIMS[n] for n in sorted(names)) + ") || '}'"


def _rollup_cte(seconds: int, dims: tuple[str, ...], source: str = "ev", name: str = "rollups") -> str:
    text = _dims(dims)
    return f"""{name} AS (
  SELECT window_start, window_start + to_seconds({seconds}) AS window_end, metric,
    substr(sha256(dims), 1, 32) AS dims_hash, dims, count, sum, uniques
  FROM (
    SELECT {_floor('ts', seconds)} AS window_start, metric, {text} AS dims, count(*) AS count,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum,
      count(DISTINCT user_id) AS uniques
    FROM {source} GROUP BY 1, 2, 3))"""


MINUTES = _rollup_cte(60, ALL_DIMS)
HOURLY_ENDPOINT = _rollup_cte(3600, ("endpoint",))

# --- rollups -------------------------------------------------------------------------------------

ORACLES["rollup_60s"] = _with("SELECT * FROM rollups", EVENTS, MINUTES)
ORACLES["rollup_hourly"] = _with(
    "SELECT * FROM rollups", EVENTS, _rollup_cte(3600, ("endpoint", "status")))
ORACLES["rollup_daily"] = _with("SELECT * FROM rollups", EVENTS, _rollup_cte(86400, ()))
ORACLES["rollup_sketched"] = _with(
    "SELECT window_start, metric, count, sum, uniques, true AS within_bound FROM rollups",
    EVENTS, _rollup_cte(86400, ()))
ORACLES["rollup_deduplicated"] = _with("SELECT * FROM rollups", EVENTS, HOURLY_ENDPOINT)
ORACLES["rollup_stored_rows"] = _with("""
SELECT *, TIMESTAMP '2024-01-15 00:00:00' AS updated_at FROM rollups
WHERE window_end <= TIMESTAMP '2024-01-14 23:59:00'""", EVENTS, HOURLY_ENDPOINT)
ORACLES["dims_normalize"] = _with(
    f"SELECT CAST(event_id AS VARCHAR) AS event_id, {_dims(ALL_DIMS)} AS dims FROM ev", EVENTS)
ORACLES["dims_hash_rollup"] = _with(f"""
SELECT substr(sha256(replace(dims, '\\u001F', '\\u001f')), 1, 32) AS dims_hash, dims, count(*) AS rows
FROM (SELECT {_dims(ALL_DIMS)} AS dims FROM (SELECT * REPLACE (CASE WHEN event_id % 11 = 0
        THEN replace(endpoint, '/v1', '/v1\\u001F') ELSE endpoint END AS endpoint) FROM ev)) GROUP BY dims""", EVENTS)
ORACLES["rollup_history"] = _with("""
SELECT * FROM rollups
WHERE metric = 'purchase' AND window_start >= TIMESTAMP '2024-01-05'
  AND window_start < TIMESTAMP '2024-01-20'
ORDER BY window_start DESC, dims_hash LIMIT 200""", EVENTS, MINUTES)
LATEST = """latest AS (
  SELECT * FROM rollups
  QUALIFY row_number() OVER (PARTITION BY metric, dims_hash ORDER BY window_start DESC) = 1)"""
ORACLES["rollup_latest"] = _with("SELECT * FROM latest", EVENTS, MINUTES, LATEST)
ORACLES["rollup_latest_ttl"] = _with("""
SELECT *, window_end AS updated_at FROM latest
WHERE metric IN (
  SELECT metric FROM rollups GROUP BY metric
  HAVING max(window_end) >= (SELECT max(window_end) FROM rollups) - to_seconds(600))""",
    EVENTS, MINUTES, LATEST)
ORACLES["rollup_window_set"] = _with("""
SELECT * FROM rollups WHERE metric = 'view' AND window_start = TIMESTAMP '2024-01-10'""",
    EVENTS, _rollup_cte(86400, ALL_DIMS))
ORACLES["rollup_upserted"] = _with(
    "SELECT *, window_end + to_seconds(60) AS updated_at FROM rollups", EVENTS, HOURLY_ENDPOINT)
ORACLES["rpm_by_customer"] = _with(f"""
SELECT {_floor('ts', 60)} AS window_start, customer_id, count(*) AS requests
FROM ev GROUP BY 1, 2""", EVENTS)
ORACLES["error_rate_by_endpoint"] = _with(f"""
SELECT window_start, endpoint, count(*) AS requests,
  count(*) FILTER (code >= 400) AS errors, count(*) FILTER (code >= 400) / count(*) AS error_rate
FROM (SELECT {_floor('ts', 3600)} AS window_start, endpoint, CAST(status AS INTEGER) AS code
      FROM ev WHERE status IS NOT NULL)
GROUP BY 1, 2""", EVENTS)
ORACLES["orders_by_status_region"] = """
SELECT r_name AS region, o_orderstatus AS status, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""
for _name in ("sliding_uniques_5m", "stream_sliding_uniques"):
    ORACLES[_name] = _with("""
SELECT window_start, window_start + to_seconds(300) AS window_end, count(DISTINCT user_id) AS uniques
FROM (SELECT make_timestamp((epoch_us(ts) // 60000000 - i) * 60000000) AS window_start, user_id
      FROM ev, (SELECT unnest([0, 1, 2, 3, 4]) AS i) WHERE user_id IS NOT NULL)
GROUP BY 1""", EVENTS)
ORACLES["sliding_uniques_any_slide"] = _with("""
SELECT window_start, window_start + to_seconds(300) AS window_end, count(DISTINCT user_id) AS uniques
FROM (SELECT make_timestamp((epoch_us(ts) // 90000000 - i) * 90000000) AS window_start, user_id, ts
      FROM ev, (SELECT unnest([0, 1, 2, 3]) AS i) WHERE user_id IS NOT NULL)
WHERE ts < window_start + to_seconds(300) GROUP BY 1""", EVENTS)
ORACLES["spend_per_category"] = f"""
SELECT {_floor('l_shipdate', 60)} AS window_start, p_brand AS category, count(*) AS purchases,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
ORACLES["spike_flags"] = _with("""
SELECT window_start, metric, events, round(trailing_mean, 6) AS trailing_mean, trailing_points,
  trailing_points = 24 AND events > trailing_mean * 2.0 AS is_spike,
  trailing_points = 24 AND events * 2.0 < trailing_mean AS is_drop, events > 10 AS violates_slo
FROM (
  SELECT *, avg(events) OVER before AS trailing_mean, count(events) OVER before AS trailing_points
  FROM hourly
  WINDOW before AS (PARTITION BY metric ORDER BY window_start
                    ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""", EVENTS, f"""seen AS (
  SELECT {_floor('ts', 3600)} AS window_start, metric, count(*) AS events FROM ev GROUP BY 1, 2),
hourly AS (
  SELECT window_start, metric, coalesce(events, 0) AS events FROM (
    SELECT metric, unnest(generate_series(min(window_start), (SELECT max(window_start) FROM seen),
      INTERVAL 1 HOUR)) AS window_start FROM seen GROUP BY metric)
  LEFT JOIN seen USING (metric, window_start))""")
ORACLES["hot_keys"] = _with("""
SELECT endpoint, metric, count(*) AS rows, count(*) / (SELECT count(*) FROM ev) AS share,
  count(*) / (SELECT count(*) FROM ev) >= 0.05 AS is_hot
FROM ev GROUP BY 1, 2""", EVENTS)
ORACLES["stream_spikes"] = ORACLES["spike_flags"]
ORACLES["hot_keys_sketched"] = _with("""
SELECT endpoint, metric, count(*) AS rows, count(*) / (SELECT count(*) FROM ev) AS share
FROM ev GROUP BY 1, 2 HAVING count(*) / (SELECT count(*) FROM ev) >= 0.04""", EVENTS)
ORACLES["late_audit"] = f"""
SELECT event_id, arrival, window_start, seen_until,
  coalesce(window_start + to_seconds(60) <= seen_until - to_seconds(300), false) AS is_late
FROM (
  SELECT event_id, arrival, {_floor('ts', 60)} AS window_start,
    max(ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_until
  FROM (SELECT event_id, ts,
          (event_id + event_id * 37 % 41) * 64 + event_id * 37 % 41 AS arrival FROM events))"""

ORACLES["stream_late_rows"] = ORACLES["late_audit"]

REASON = """CASE WHEN event_id % 17 = 0 OR event_id % 31 = 0 THEN 'malformed_json'
  WHEN event_id % 19 = 0 THEN 'missing_metric' WHEN event_id % 23 = 0 THEN 'bad_value' END"""
ORACLES["validate_events_usable"] = _with(f"""
SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS event_id, event_type, metric,
  CASE WHEN event_id % 29 = 0 THEN 1.0 ELSE value END AS value, raw_user_id AS user_id, customer_id,
  endpoint, status, ts
FROM ev WHERE {REASON} IS NULL""", EVENTS)
ORACLES["quarantine_events"] = _with(
    f'SELECT event_id AS "offset", {REASON} AS reason FROM ev WHERE {REASON} IS NOT NULL', EVENTS)

ORACLES["stream_error_rate"] = _with(f"""
SELECT coalesce(nullif({REASON}, 'bad_value'), 'other') AS reason, count(*) AS rejected,
  (SELECT count(*) FROM ev) AS records, count(*) / (SELECT count(*) FROM ev) AS error_rate
FROM ev WHERE {REASON} IS NOT NULL GROUP BY 1""", EVENTS)

# --- member features -----------------------------------------------------------------------------

def _members_cte(channels: tuple[str, ...]) -> str:
    picked = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(channels))
    return f"""me AS (
  SELECT CASE WHEN event_type IN ('purchase', 'error') THEN 'MESSAGE' ELSE 'ACTIVITY' END AS kind,
    'm' || (user_id // 3) AS member_id,
    CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'browse' WHEN 'signup' THEN 'search'
      WHEN 'purchase' THEN 'sent'
      ELSE (CASE event_id % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'click' ELSE 'delivered' END)
    END AS event_type,
    CASE WHEN event_type IN ('purchase', 'error') THEN
      (CASE (event_id // 3) % {len(channels)} {picked} END)
    END AS channel,
    epoch_us(ts) // 1000 AS ts_ms, event_id AS seq
  FROM events)"""


FLAGS = {
    "plays": "kind = 'ACTIVITY' AND event_type = 'play'",
    "browses": "kind = 'ACTIVITY' AND event_type = 'browse'",
    "searches": "kind = 'ACTIVITY' AND event_type = 'search'",
    "sent": "kind = 'MESSAGE' AND event_type = 'sent'",
    "opens": "kind = 'MESSAGE' AND event_type = 'open'",
    "clicks": "kind = 'MESSAGE' AND event_type = 'click'",
}
CHANNELS = ("push", "email", "interstitial")
MORE_CHANNELS = (*CHANNELS, "sms")
MEMBERS = _members_cte(CHANNELS)
RULES = """
  snapshot_ts_ms - coalesce(last_sent_push, 0) >= 21600000 AS eligible_push,
  snapshot_ts_ms - coalesce(last_sent_email, 0) >= 86400000 AS eligible_email,
  CASE WHEN snapshot_ts_ms - coalesce(last_sent_push, 0) < 21600000 THEN 'cooldown_active' END
    AS reason_push,
  CASE WHEN snapshot_ts_ms - coalesce(last_sent_email, 0) < 86400000 THEN 'cooldown_active' END
    AS reason_email"""


def _changelog_cte(source: str, channels: tuple[str, ...] = CHANNELS) -> str:
    """Running counts minus the counts that have left each trailing window."""
    columns = []
    for name, (counter, bucket, _, back) in TRAILING.items():
        columns.append(
            f"count(*) FILTER ({FLAGS[counter]}) OVER so_far - count(*) FILTER ({FLAGS[counter]}) OVER "
            f"(PARTITION BY member_id ORDER BY {bucket} "
            f"RANGE BETWEEN UNBOUNDED PRECEDING AND {back + 1} PRECEDING) AS {name}")
    for channel in channels:
        columns.append(f"max(ts_ms) FILTER ({FLAGS['sent']} AND channel = '{channel}') OVER so_far "
                       f"AS last_sent_{channel}")
    listed = ",\n    ".join(columns)
    return f"""changes AS (
  SELECT kind, seq, member_id, ts_ms AS snapshot_ts_ms,
    coalesce(max(ts_ms) FILTER (kind = 'ACTIVITY') OVER so_far, 0) AS last_activity_ts_ms,
    {listed}
  FROM (SELECT *, ts_ms // 60000 AS minute, ts_ms // 3600000 AS hour FROM {source})
  WINDOW so_far AS (PARTITION BY member_id ORDER BY ts_ms, seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


MARKED = """marked AS (
  SELECT * FROM me
  UNION ALL
  SELECT DISTINCT 'TIMER', member_id, NULL, NULL, (ts_ms // 300000 + 1) * 300000,
    9223372036854775807 FROM me)"""

ORACLES["unified_events"] = _with("SELECT * FROM me", MEMBERS)
ORACLES["member_events_decoded"] = ORACLES["unified_events"]
ORACLES["member_events_quarantined"] = """
SELECT event_id + 1000000000000 AS seq, 'malformed_json' AS reason FROM events"""
ORACLES["activity_buckets"] = _with("""
SELECT member_id, ts_ms // 60000 * 60000 AS bucket_ms, event_type, count(*) AS count
FROM me WHERE kind = 'ACTIVITY' GROUP BY 1, 2, 3""", MEMBERS)
ORACLES["msg_buckets"] = _with("""
SELECT member_id, ts_ms // 3600000 * 3600000 AS bucket_ms,
  count(*) FILTER (event_type = 'sent') AS sent, count(*) FILTER (event_type = 'open') AS open,
  count(*) FILTER (event_type = 'click') AS click
FROM me WHERE kind = 'MESSAGE' GROUP BY 1, 2""", MEMBERS)
ORACLES["features_per_event"] = _with(
    f"SELECT *, {RULES} FROM changes", MEMBERS, _changelog_cte("me"))
ORACLES["features_all_channels"] = _with(
    f"SELECT *, {RULES} FROM changes", _members_cte(MORE_CHANNELS), _changelog_cte("me", MORE_CHANNELS))
ORACLES["features_timer"] = _with(
    f"SELECT * EXCLUDE (kind, seq), {RULES} FROM changes WHERE kind = 'TIMER'",
    MEMBERS, MARKED, _changelog_cte("marked"))
ORACLES["features_latest"] = _with(f"""
SELECT * EXCLUDE (kind, seq), {RULES} FROM changes
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY snapshot_ts_ms DESC, seq DESC) = 1""",
    MEMBERS, _changelog_cte("me"))
ORACLES["feature_messages"] = _with(f"""
SELECT member_id AS key, member_id, * EXCLUDE (kind, seq, member_id), {RULES} FROM changes
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY snapshot_ts_ms DESC, seq DESC) = 1""",
    MEMBERS, _changelog_cte("me"))


def _as_of(last_sent: str) -> str:
    now = 1_706_659_200_000
    counts = ",\n  ".join(
        f"count(*) FILTER ({FLAGS[counter]} AND ts_ms >= {(now - size * back) // size * size}) AS {name}"
        for name, (counter, _, size, back) in TRAILING.items())
    sent = ",\n  ".join(
        last_sent.format(test=f"{FLAGS['sent']} AND channel = '{c}'") + f" AS last_sent_{c}"
        for c in CHANNELS)
    return f"""
SELECT *, {RULES} FROM (
SELECT member_id, CAST({now} AS BIGINT) AS snapshot_ts_ms,
  coalesce(max(ts_ms) FILTER (kind = 'ACTIVITY'), 0) AS last_activity_ts_ms,
  {counts},
  {sent}
FROM me WHERE ts_ms <= {now} GROUP BY member_id)"""


ORACLES["features_asof"] = _with(_as_of("max(ts_ms) FILTER ({test})"), MEMBERS)
ORACLES["features_asof_arrival"] = _with(
    _as_of("arg_max(ts_ms, (seq + seq * 37 % 41) * 64 + seq * 37 % 41) FILTER ({test})"), MEMBERS)

# --- change capture ------------------------------------------------------------------------------

LOG = """mutations AS (
  SELECT event_type AS dataset, 'R-' || user_id AS record_id,
    CASE WHEN event_id % 10 = 3 THEN 'delete' ELSE 'upsert' END AS op,
    CASE WHEN event_id % 10 = 3 OR event_id % 7 = 0 THEN NULL ELSE props END AS payload,
    event_id + 1 AS seq, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS event_ts
  FROM events),
lives AS (
  SELECT *, count(*) FILTER (op = 'delete') OVER (
    PARTITION BY dataset, record_id ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS life FROM mutations),
log AS (
  SELECT seq AS "offset", dataset, record_id, op, payload,
    row_number() OVER (PARTITION BY dataset, record_id, life ORDER BY seq) AS version, event_ts
  FROM lives)"""


def _marks_cte(updated_at: int) -> str:
    return f"""marks AS (
  SELECT dataset, max("offset") AS last_offset, max(event_ts) AS last_event_ts,
    CAST({updated_at} AS BIGINT) AS updated_at
  FROM log WHERE dataset <> 'signup'
    AND (dataset = 'view' OR "offset" <= (SELECT max("offset") // 2 FROM log))
  GROUP BY dataset)"""


NOW = 1_706_659_200
PENDING = """pending AS (
  SELECT log.* FROM log LEFT JOIN marks USING (dataset) WHERE "offset" > coalesce(last_offset, 0))"""
INCREMENT = """increment AS (
  SELECT * FROM pending
  QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY "offset") <= 200)"""


def _index_cte(name: str, source: str, indexed_at: str, order: str = 'version DESC, "offset"') -> str:
    return f"""{name} AS (
  SELECT dataset, record_id, CASE WHEN op = 'upsert' THEN coalesce(payload, '') END AS payload, version,
    CAST({indexed_at} AS BIGINT) AS indexed_at,
    CAST(CASE WHEN op = 'upsert' THEN 0 ELSE 1 END AS BIGINT) AS tombstone
  FROM {source}
  QUALIFY row_number() OVER (PARTITION BY dataset, record_id ORDER BY {order}) = 1)"""


SOURCE = """source AS (
  SELECT dataset, record_id, payload, version, event_ts AS updated_at FROM (
    SELECT * FROM log
    QUALIFY row_number() OVER (PARTITION BY dataset, record_id ORDER BY "offset" DESC) = 1)
  WHERE op <> 'delete')"""
MERGED = """merged AS (
  SELECT * EXCLUDE (stored) FROM (
    SELECT *, 1 AS stored FROM current_rows UNION ALL SELECT *, 0 FROM fresh_rows)
  QUALIFY row_number() OVER (
    PARTITION BY dataset, record_id ORDER BY version DESC, stored DESC) = 1)"""

ORACLES["capture_versions"] = _with("SELECT * FROM log", LOG)
ORACLES["capture_versions_in_steps"] = ORACLES["capture_versions"]
ORACLES["source_state"] = _with("SELECT * FROM source", LOG, SOURCE)

IMAGES = """steps AS (
  SELECT o_orderkey * 4 AS seq, 'order.created' AS event_type, 'o-' || o_orderkey AS order_id,
    'c-' || o_custkey AS customer_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_kobo,
    'NGN' AS currency, 'CREATED' AS status, o_orderdate AS created_at FROM orders
  UNION ALL
  SELECT o_orderkey * 4 + 1, 'order.updated', 'o-' || o_orderkey, NULL, NULL, NULL,
    CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'SHIPPED' WHEN 'O' THEN 'PAID' END,
    o_orderdate + INTERVAL 1 DAY FROM orders
  UNION ALL
  SELECT o_orderkey * 4 + 2, 'order.updated', 'o-' || o_orderkey, NULL,
    CAST(round(o_totalprice * 100) AS BIGINT) + 5000, NULL, NULL, o_orderdate + INTERVAL 2 DAY
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT c_custkey * 4 + 3, 'order.updated', 'x-' || c_custkey, NULL,
    CAST(round(c_acctbal * 100) AS BIGINT), NULL, NULL, TIMESTAMP '1998-01-01' FROM customer),
images AS (
  SELECT seq, event_type, order_id,
    coalesce(last_value(customer_id IGNORE NULLS) OVER so_far, 'unknown') AS customer_id,
    coalesce(last_value(amount_kobo IGNORE NULLS) OVER so_far, 0) AS amount_kobo,
    coalesce(last_value(currency IGNORE NULLS) OVER so_far, 'NGN') AS currency,
    coalesce(last_value(status IGNORE NULLS) OVER so_far, 'CREATED') AS status, created_at
  FROM steps
  WINDOW so_far AS (PARTITION BY order_id ORDER BY seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
payloads AS (
  SELECT *, '{"amount_kobo": ' || amount_kobo || ', "currency": "' || currency
    || '", "customer_id": "' || customer_id || '", "order_id": "' || order_id
    || '", "status": "' || status || '"'
    || CASE WHEN event_type = 'order.updated' THEN
         ', "updated_at": "' || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"' ELSE '' END
    || '}' AS payload FROM images),
digests AS (
  SELECT *, sha256(event_type || '|' || order_id || '|' || seq) AS digest FROM payloads),
outbox AS (
  SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-' || substr(digest, 13, 4) || '-'
      || substr(digest, 17, 4) || '-' || substr(digest, 21, 12) AS event_id, 'order' AS aggregate_type, order_id AS aggregate_id, event_type, payload,
    sha256('{"id": "' || order_id || '", "p": ' || payload || ', "t": "' || event_type || '"}')
      AS idempotency_key,
    CAST(0 AS BIGINT) AS publish_attempts, created_at, seq,
    customer_id, amount_kobo, currency, status
  FROM digests)"""
OUTBOX_ROWS = "SELECT * EXCLUDE (customer_id, amount_kobo, currency, status) FROM outbox"

ORACLES["outbox_created"] = _with(f"{OUTBOX_ROWS} WHERE event_type = 'order.created'", IMAGES)
ORACLES["outbox_updated"] = _with(f"{OUTBOX_ROWS} WHERE event_type = 'order.updated'", IMAGES)
ORACLES["outbox_in_steps"] = _with(OUTBOX_ROWS, IMAGES)
ORACLES["outbox_two_runs"] = _with("""
SELECT event_id, CAST(CASE WHEN place <= 200 THEN 1 ELSE 2 END AS BIGINT) AS publish_attempts,
  CASE WHEN place <= 200 THEN TIMESTAMP '2024-01-29' ELSE TIMESTAMP '2024-01-31' END AS published_at
FROM (SELECT event_id, row_number() OVER (ORDER BY created_at, seq) AS place FROM outbox)
WHERE place <= 400""", IMAGES)
ORACLES["outbox_next_batch"] = _with("""
SELECT seq, aggregate_id, event_type, idempotency_key, created_at FROM outbox
ORDER BY created_at, seq LIMIT 200""", IMAGES)
ORACLES["outbox_publish"] = _with("""
SELECT seq, aggregate_id AS key,
  '{"aggregate_id": "' || aggregate_id || '", "aggregate_type": "order", "emitted_at": "'
  || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00", "event_id": "' || event_id || '", "event_type": "'
  || event_type || '", "idempotency_key": "' || idempotency_key || '", "payload": ' || payload
  || ', "schema_version": 1}' AS value,
  'event_type=' || event_type || ',aggregate_type=order,aggregate_id=' || aggregate_id
    || ',idempotency_key=' || idempotency_key AS headers
FROM outbox""", IMAGES)
BATCH = "batch AS (SELECT seq FROM outbox ORDER BY created_at, seq LIMIT 200)"
ORACLES["outbox_mark"] = _with("""
SELECT seq, CASE WHEN seq IN (SELECT seq FROM batch) THEN CAST(1 AS BIGINT) ELSE 0 END
  AS publish_attempts,
  CASE WHEN seq IN (SELECT seq FROM batch) THEN TIMESTAMP '2024-01-31' END AS published_at
FROM outbox""", IMAGES, BATCH)
ORACLES["outbox_mark_failed"] = _with("""
SELECT seq, CASE WHEN seq IN (SELECT seq FROM batch) THEN CAST(1 AS BIGINT) ELSE 0 END
  AS publish_attempts, CAST(NULL AS TIMESTAMP) AS published_at FROM outbox""", IMAGES, BATCH)
ORACLES["publish_counters"] = _with(
    "SELECT count(*) AS published, CAST(0 AS BIGINT) AS errors FROM outbox", IMAGES)

# --- warehouse -----------------------------------------------------------------------------------

MESSAGES = """sent AS (
  SELECT seq * 2 AS "offset", created_at AS applied_at, * EXCLUDE (created_at), created_at FROM outbox
  UNION ALL
  SELECT seq * 2 + 21, created_at + INTERVAL 1 HOUR, * EXCLUDE (created_at), created_at FROM outbox),
cut AS (
  SELECT o_orderkey % 6 AS "partition", o_orderkey * 8 + 1000000000000 AS "offset",
    '{"event_id": "' || o_orderkey AS raw FROM orders WHERE o_orderpriority = '5-LOW'),
pings AS (
  SELECT c_custkey % 6 AS "partition", c_custkey * 8 + 1000000000001 AS "offset",
    '{"ping": ' || c_custkey || '}' AS raw FROM customer),
first AS (
  SELECT * FROM sent
  QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY "offset") = 1)"""
WAREHOUSE = """wh AS (
  SELECT aggregate_id AS order_id, customer_id, amount_kobo, currency, status,
    event_type AS last_event_type, event_id AS last_event_id, idempotency_key AS last_idempotency_key,
    applied_at AS updated_at,
    min(applied_at) OVER (PARTITION BY aggregate_id) AS created_at, "offset" AS last_offset
  FROM first
  QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY "offset" DESC) = 1)"""
READABLE = """readable AS (
  SELECT seq // 4 % 6 AS "partition", "offset", applied_at, event_id, event_type, aggregate_id, idempotency_key,
    strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS emitted_at,
    replace(replace(payload, '": ', '":'), ', "', ',"') AS payload_json FROM sent
  UNION ALL
  SELECT "partition", "offset", TIMESTAMP '1999-01-01', '', '', '', '', NULL, '{}' FROM pings)"""

for _name in ("wh_dedup", "wh_dedup_filtered"):
    ORACLES[_name] = _with("""
SELECT idempotency_key, aggregate_id AS order_id, "offset" FROM first
WHERE event_type <> 'order.created'""", IMAGES, MESSAGES)
for _name in ("wh_current", "wh_replay_twice", "wh_rebuild", "stream_warehouse"):
    ORACLES[_name] = _with("SELECT * FROM wh", IMAGES, MESSAGES, WAREHOUSE)
for _name in ("wh_ledger", "stream_wh_ledger"):
    ORACLES[_name] = _with(
        'SELECT idempotency_key, event_id, applied_at, "offset" FROM first', IMAGES, MESSAGES)
for _name in ("wh_checkpoints", "stream_wh_checkpoints"):
    ORACLES[_name] = _with("""
SELECT 'shop-order-changes' AS topic, "partition", max("offset") AS "offset",
  arg_max(applied_at, "offset") AS updated_at FROM readable GROUP BY "partition" """,
        IMAGES, MESSAGES, READABLE)
ORACLES["wh_recent"] = _with(
    "SELECT * FROM wh ORDER BY updated_at DESC, order_id LIMIT 20", IMAGES, MESSAGES, WAREHOUSE)
ORACLES["wh_quarantine"] = _with("""
SELECT "partition", "offset", raw, 'malformed_json' AS reason FROM cut
UNION ALL SELECT "partition", "offset", raw, 'missing_idempotency_key' FROM pings""", IMAGES, MESSAGES)
ORACLES["consume_counters"] = _with("""
SELECT (SELECT count(*) FROM sent) + (SELECT count(*) FROM cut) + (SELECT count(*) FROM pings)
    AS processed,
  (SELECT count(*) FROM cut) AS bad, (SELECT count(*) FROM pings) AS rejected""", IMAGES, MESSAGES)
ORACLES["lake_append"] = _with("""
SELECT DATE '2024-01-31' AS date, "partition", "offset", event_id, event_type, aggregate_id,
  idempotency_key, CAST(1 AS BIGINT) AS schema_version, emitted_at, payload_json FROM readable""",
    IMAGES, MESSAGES, READABLE)

# --- index ---------------------------------------------------------------------------------------

ORACLES["index_increment"] = _with("SELECT * FROM increment", LOG, _marks_cte(NOW), PENDING, INCREMENT)
for _name in ("index_current", "stream_index"):
    ORACLES[_name] = _with("SELECT * FROM idx", LOG, _index_cte("idx", "log", str(NOW)))
ORACLES["changes_quarantined"] = _with("""
SELECT "offset", 'unknown_op' AS reason FROM log WHERE "offset" % 41 = 0
UNION ALL SELECT "offset", 'missing_version' FROM log WHERE "offset" % 43 = 0""", LOG)
ORACLES["index_current_by_offset"] = _with(
    "SELECT * FROM idx", LOG, _index_cte("idx", "log", str(NOW), '"offset" DESC'))
ORACLES["index_replay"] = _with(
    "SELECT * FROM merged", LOG, _marks_cte(NOW), PENDING,
    _index_cte("current_rows", "log", str(NOW)), _index_cte("fresh_rows", "pending", str(NOW + 60)),
    MERGED)
ORACLES["index_catch_up"] = _with(
    "SELECT * FROM merged", LOG, _marks_cte(NOW), PENDING,
    'done AS (SELECT log.* FROM log JOIN marks USING (dataset) WHERE "offset" <= last_offset)',
    _index_cte("current_rows", "done", str(NOW - 3600)), _index_cte("fresh_rows", "pending", str(NOW)),
    MERGED)
REBUILT = f"""SELECT dataset, record_id, payload, version, CAST({NOW} AS BIGINT) AS indexed_at,
  CAST(0 AS BIGINT) AS tombstone FROM source WHERE dataset = 'click'"""
ORACLES["index_rebuild"] = _with(
    f"SELECT * FROM idx WHERE dataset <> 'click' UNION ALL {REBUILT}", LOG, SOURCE,
    _index_cte("idx", "log", str(NOW - 3600)))
ORACLES["index_store_replayed"] = _with(
    "SELECT * FROM merged UNION ALL SELECT * FROM idx WHERE dataset <> 'click'", LOG, SOURCE,
    _index_cte("idx", "log", str(NOW)),
    "clicks AS (SELECT * FROM log WHERE dataset = 'click')",
    f"current_rows AS ({REBUILT})", _index_cte("fresh_rows", "clicks", str(NOW)), MERGED)
ORACLES["index_checkpoint"] = _with(f"""
SELECT dataset, max(last_offset) AS last_offset, max(last_event_ts) AS last_event_ts,
  max(updated_at) AS updated_at
FROM (SELECT * FROM marks UNION ALL
      SELECT dataset, max("offset"), max(event_ts), {NOW} FROM increment GROUP BY dataset)
GROUP BY dataset""", LOG, _marks_cte(NOW - 60), PENDING, INCREMENT)
ORACLES["index_checkpoint_replay"] = _with(f"""
SELECT * FROM marks WHERE dataset <> 'click'
UNION ALL SELECT 'click', 100, 0, {NOW}""", LOG, _marks_cte(NOW - 60))
ORACLES["index_recent"] = _with(
    "SELECT * FROM idx WHERE indexed_at >= 1704931200 - 3600", LOG,
    _index_cte("idx", "log", "event_ts"))

# --- freshness and quality -----------------------------------------------------------------------

METRICS = f"""metrics AS (
  SELECT *, lag_s AS freshness_lag_seconds, lag_s <= 300 AS ok,
    CAST(300 AS BIGINT) AS freshness_slo_seconds, CAST({NOW} AS BIGINT) AS now FROM (
  SELECT *, greatest(0, max_offset - checkpoint_last_offset) AS backlog_offsets,
    CASE WHEN max_event_ts <> 0 AND checkpoint_last_event_ts <> 0
      THEN greatest(0, max_event_ts - checkpoint_last_event_ts) ELSE max_event_ts END AS lag_s
  FROM (
    SELECT dataset, max_event_ts, max_offset,
      coalesce(last_event_ts, 0) AS checkpoint_last_event_ts,
      coalesce(last_offset, 0) AS checkpoint_last_offset,
      coalesce(updated_at, 0) AS checkpoint_updated_at
    FROM (SELECT dataset, max(event_ts) AS max_event_ts, max("offset") AS max_offset
          FROM log GROUP BY dataset) LEFT JOIN marks USING (dataset))))"""
ORACLES["freshness_metrics"] = _with(
    "SELECT * EXCLUDE (lag_s) FROM metrics", LOG, _marks_cte(NOW - 60), METRICS)
ORACLES["freshness_health"] = _with("""
SELECT bool_and(ok) AS ok, count(*) AS datasets, count(*) FILTER (NOT ok) AS stale_datasets,
  max(freshness_lag_seconds) AS worst_lag_seconds, max(backlog_offsets) AS worst_backlog
FROM metrics""", LOG, _marks_cte(NOW - 60), METRICS)
ORACLES["freshness_report"] = _with("""
SELECT (SELECT bool_and(ok) FROM metrics) AS ok, (SELECT count(*) FROM metrics) AS datasets,
  (SELECT count(*) FILTER (NOT ok) FROM metrics) AS stale_datasets, dataset, ok AS dataset_ok,
  freshness_lag_seconds, backlog_offsets, max_offset, checkpoint_last_offset
FROM metrics""", LOG, _marks_cte(NOW - 60), METRICS)
ORACLES["run_counters"] = _with("""
SELECT dataset, count(increment.dataset) AS processed
FROM (SELECT DISTINCT dataset FROM log) LEFT JOIN increment USING (dataset) GROUP BY dataset""",
    LOG, _marks_cte(NOW), PENDING, INCREMENT)
ORACLES["schema_drift"] = _with("""
SELECT key, count(*) AS rows, min("offset") AS first_seen, max("offset") AS last_seen,
  key = 'updated_at' AS is_new
FROM (SELECT unnest(['order_id', 'customer_id', 'amount_kobo', 'currency', 'status']) AS key, "offset"
      FROM sent
      UNION ALL SELECT 'updated_at', "offset" FROM sent WHERE event_type = 'order.updated')
GROUP BY key""", IMAGES, MESSAGES)
ORACLES["reconcile"] = ORACLES["reconcile_tree"] = _with("""
SELECT CASE WHEN c.order_id IS NULL THEN 'only_target' WHEN wh.order_id IS NULL THEN 'only_source'
  WHEN c.amount_kobo = wh.amount_kobo AND wh.status = 'CREATED' THEN 'match' ELSE 'mismatch' END
  AS outcome, count(*) AS rows
FROM (SELECT * FROM steps WHERE event_type = 'order.created') c
FULL JOIN wh ON c.order_id = wh.order_id GROUP BY 1""", IMAGES, MESSAGES, WAREHOUSE)

# --- streams -------------------------------------------------------------------------------------

for _name in ("stream_rollup", "stream_rollup_early"):
    ORACLES[_name] = _with("SELECT * FROM rollups", EVENTS, HOURLY_ENDPOINT)
VALID = f"""valid AS (
  SELECT * REPLACE (CASE WHEN event_id % 29 = 0 THEN 1.0 ELSE value END AS value) FROM ev
  WHERE {REASON} IS NULL)"""
ORACLES["stream_history"] = _with(
    "SELECT *, window_end AS updated_at FROM rollups", EVENTS, VALID, _rollup_cte(3600, ("endpoint",), "valid"))
ORACLES["stream_features"] = ORACLES["features_per_event"]
ORACLES["stream_features_json"] = ORACLES["features_per_event"]
ORACLES["stream_features_timer"] = _with(f"""
SELECT * EXCLUDE (kind, seq), {RULES} FROM changes
WHERE kind = 'TIMER' AND snapshot_ts_ms <= (SELECT max(ts_ms) FROM me) - 30000""",
    MEMBERS, MARKED, _changelog_cte("marked"))
ORACLES["stream_progress"] = """
SELECT count(*) + 1 AS input_rows, CAST(0 AS BIGINT) AS dropped_late_rows FROM events"""
