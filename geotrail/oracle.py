"""Independent SQL formulations (DuckDB dialect) of the registered queries.

These are brute-force statements: one window per vehicle, the running mean
folded over *all* accepted segments (no horizon), everything recomputed from
the ``events`` table. They check the Spark plans, which are chunked and
bounded, against the plain definition.
"""

from __future__ import annotations

from geotrail.config import EVENTS_AS_OF_MS, EVENTS_PARAMS, HISTORY_AS_OF_MS

K = "0.017453292519943295"
T = EVENTS_PARAMS
RUN1_AS_OF_MS = 1_705_363_200_000  # 2024-01-16T00:00:00Z


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    hd = f"((({lat2}) - ({lat1})) * {K}) / 2"
    hl = f"((({lon2}) - ({lon1})) * {K}) / 2"
    a = f"(sin({hd}) * sin({hd}) + (cos(({lat1}) * {K}) * cos(({lat2}) * {K})) * sin({hl}) * sin({hl}))"
    return f"({T.earth_radius_m * 2!r} * atan2(sqrt({a}), sqrt(1.0 - {a})))"


def kph(m: str, t1: str, t2: str) -> str:
    dt = f"((({t2}) - ({t1})) / 1000.0)"
    return f"(CASE WHEN {dt} <= 0 THEN 0.0 ELSE (({m}) / {dt}) * 3.6 END)"


def r2(x: str) -> str:
    y = f"(({x}) * 100.0)"
    return f"((floor({y}) + CASE WHEN {y} - floor({y}) >= 0.5 THEN 1 ELSE 0 END) / 100.0)"


def r3(x: str) -> str:
    y = f"(({x}) * 1000.0)"
    return f"((floor({y}) + CASE WHEN {y} - floor({y}) >= 0.5 THEN 1 ELSE 0 END) / 1000.0)"


def fold(speeds_list: str, seed_n: str = "0", seed_avg: str = "0.0") -> str:
    step = r2("(a.avg * a.n + x) / (a.n + 1)")
    return (
        f"(list_reduce({speeds_list}, lambda a, x: {{'n': a.n + 1, 'avg': {step}}}, "
        f"{{'n': ({seed_n})::BIGINT, 'avg': ({seed_avg})::DOUBLE}})).avg"
    )


POS_COLUMNS = """
    printf('VIN%06d', user_id) AS vin,
    epoch_us(ts) // 1000 AS timestamp,
    30.266::DOUBLE + ((event_id * 7919) % 1000) / 100.0::DOUBLE AS latitude,
    -97.730::DOUBLE + ((event_id * 104729) % 1000) / 100.0::DOUBLE AS longitude,
    value::DOUBLE AS speed,
    180.0::DOUBLE + ((event_id * 31) % 400) / 10.0::DOUBLE AS engine_temp,
    ((event_id * 17) % 1001) / 1000.0::DOUBLE AS gas_tank_level,
    CASE WHEN event_type = 'error' THEN 'P0420' ELSE '' END AS obd2_error_code,
    event_id AS arrival_seq"""

POS = f"pos AS (SELECT {POS_COLUMNS}, false AS processed FROM events)"
POSX = (
    f"posx AS (SELECT {POS_COLUMNS}, false AS processed, "
    "ts < TIMESTAMP '2024-01-16 00:00:00' AS early FROM events)"
)
RESEND_COLUMNS = (
    POS_COLUMNS.replace("AS latitude", "+ 1.0 AS latitude").replace(
        "event_id AS arrival_seq", "event_id + 1000000000 AS arrival_seq"
    )
)
RAW = (
    f"raw AS (SELECT {POS_COLUMNS} FROM events UNION ALL "
    f"SELECT {RESEND_COLUMNS} FROM events WHERE event_id % 50 = 0)"
)


def segments_cte(src: str, name: str = "seg", gap_ms: int | None = None, bridge: bool = False) -> str:
    """Per-fix rows with the incoming segment measured; one window per vehicle.

    ``src`` has vin, ts, seq, lat, lon (and is_bridge when ``bridge``).
    """
    w = "PARTITION BY vin ORDER BY ts, seq"
    brk = f"(pts IS NOT NULL AND ts - pts > {gap_ms})" if gap_ms is not None else "false"
    jump = f"(seg_m > {T.jump_distance_m} AND dt < {T.jump_window_s})"
    return f"""
{name}_l AS (
  SELECT *, lag(ts) OVER ({w}) AS pts, lag(lat) OVER ({w}) AS plat, lag(lon) OVER ({w}) AS plon,
         lead(ts) OVER ({w}) AS nts, lead(lat) OVER ({w}) AS nlat, lead(lon) OVER ({w}) AS nlon,
         count(*) OVER (PARTITION BY vin) AS key_rows
  FROM {src}),
{name}_b AS (
  SELECT *, {brk} AS is_break FROM {name}_l),
{name}_t AS (
  SELECT *, (sum(CASE WHEN is_break THEN 1 ELSE 0 END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS trip_no,
         {hav('plat', 'plon', 'lat', 'lon')} AS seg_m,
         (ts - pts) / 1000.0 AS dt,
         {hav('lat', 'lon', 'nlat', 'nlon')} AS nseg_m,
         (nts - ts) / 1000.0 AS ndt
  FROM {name}_b),
{name}_k AS (
  SELECT *, {kph('seg_m', 'pts', 'ts')} AS seg_kph, {kph('nseg_m', 'ts', 'nts')} AS nseg_kph FROM {name}_t),
{name} AS (
  SELECT *,
    (pts IS NOT NULL AND NOT is_break) AS has_segment,
    (pts IS NOT NULL AND NOT is_break AND seg_kph > {T.anomaly_speed_kph}) AS is_anomaly,
    (pts IS NOT NULL AND NOT is_break AND NOT (seg_kph > {T.anomaly_speed_kph}) AND {jump}) AS is_jump,
    (pts IS NOT NULL AND NOT is_break AND NOT (seg_kph > {T.anomaly_speed_kph}) AND NOT {jump}) AS acc,
    CASE WHEN nts IS NULL THEN NULL
         ELSE NOT (nseg_kph > {T.anomaly_speed_kph}) AND NOT (nseg_m > {T.jump_distance_m} AND ndt < {T.jump_window_s})
    END AS next_accepted
  FROM {name}_k)"""


def rollup_select(src: str, group: str = "vin", seeded: bool = False) -> str:
    """Trip columns per group from a segments CTE (optionally seeded by a bridge row)."""
    o = "ORDER BY ts, seq"
    first_ts = f"first(ts {o})"
    last_ts = f"coalesce(last(ts {o}) FILTER (WHERE acc), {first_ts})"
    last_lat = f"coalesce(last(lat {o}) FILTER (WHERE acc), first(lat {o}))"
    last_lon = f"coalesce(last(lon {o}) FILTER (WHERE acc), first(lon {o}))"
    speeds = f"coalesce(list(seg_kph {o}) FILTER (WHERE acc), []::DOUBLE[])"
    extra = ""
    if seeded:
        extra = "bool_or(is_bridge) AS has_bridge,"
        sn, sa = "coalesce(max(seed_n), 0)", "coalesce(max(seed_avg), 0.0)"
        start_ts = f"coalesce(max(seed_start_ts), {first_ts})"
        start_lat = f"coalesce(max(seed_start_lat), first(lat {o}))"
        start_lon = f"coalesce(max(seed_start_lon), first(lon {o}))"
        dist0, max0 = "coalesce(max(seed_distance), 0.0)", "coalesce(max(seed_max), 0.0)"
    else:
        sn, sa = "0", "0.0"
        start_ts, start_lat, start_lon = first_ts, f"first(lat {o})", f"first(lon {o})"
        dist0, max0 = "0.0", "0.0"
    return f"""
  SELECT {group},
    count(*) AS n_rows, {extra}
    {start_ts} AS trip_start_timestamp,
    {last_ts} AS last_update_timestamp,
    {start_lat} AS start_lat, {start_lon} AS start_lon,
    {last_lat} AS last_lat, {last_lon} AS last_lon,
    {dist0} + coalesce(sum(seg_m) FILTER (WHERE acc), 0.0) AS total_distance_meters,
    {fold(speeds, sn, sa)} AS average_speed_kph,
    greatest({max0}, coalesce({r2('max(seg_kph) FILTER (WHERE acc)')}, 0.0)) AS max_speed_kph,
    ({sn} + count(*) FILTER (WHERE acc))::INTEGER AS total_readings
  FROM {src} GROUP BY {group}"""


def fix_rows_cte(src: str = "pos", name: str = "fx") -> str:
    return f"{name} AS (SELECT vin, timestamp AS ts, arrival_seq AS seq, latitude AS lat, longitude AS lon FROM {src})"


R3_TRIP = [
    "total_distance_meters",
    "average_speed_kph",
    "max_speed_kph",
    "start_lat",
    "start_lon",
    "last_lat",
    "last_lon",
]


def rounded(cols: list[str], r3cols: list[str]) -> str:
    return ", ".join(f"{r3(c)} AS {c}" if c in r3cols else c for c in cols)


TRIP_COLS = [
    "vin",
    "trip_start_timestamp",
    "last_update_timestamp",
    "start_lat",
    "start_lon",
    "last_lat",
    "last_lon",
    "total_distance_meters",
    "average_speed_kph",
    "max_speed_kph",
    "total_readings",
]


def q_trip_rollup() -> str:
    return f"""WITH {POS}, {fix_rows_cte()}, {segments_cte('fx')},
roll AS ({rollup_select('seg')})
SELECT {rounded(TRIP_COLS, R3_TRIP)} FROM roll WHERE n_rows >= 2"""


# ---- helpers for the registered statements --------------------------------------------------


def final(src: str, cols: list[str], doubles: list[str], where: str = "") -> str:
    sel = ", ".join(f"{r3(c)} AS {c}" if c in doubles else c for c in cols)
    return f"SELECT {sel} FROM {src}" + (f" WHERE {where}" if where else "")


SEG_TABLE = """seg_table AS (
  SELECT vin, pts AS from_ts, ts AS to_ts, plat AS from_lat, plon AS from_lon, lat AS to_lat, lon AS to_lon,
         seg_m AS distance_m, dt AS dt_s, seg_kph AS speed_kph, is_anomaly, is_jump, acc AS accepted
  FROM seg WHERE has_segment)"""

SINGLE_RUN = f"WITH {POS}, {fix_rows_cte()}, {segments_cte('fx')}, {SEG_TABLE}"


def q_segments() -> str:
    cols = ["vin", "from_ts", "to_ts", "from_lat", "from_lon", "to_lat", "to_lon", "distance_m", "dt_s",
            "speed_kph", "is_anomaly", "is_jump", "accepted"]
    return f"{SINGLE_RUN}\n{final('seg_table', cols, ['from_lat', 'from_lon', 'to_lat', 'to_lon', 'distance_m', 'dt_s', 'speed_kph'])}"


def q_haversine() -> str:
    return f"{SINGLE_RUN}\n{final('seg_table', ['vin', 'from_ts', 'to_ts', 'distance_m'], ['distance_m'])}"


def q_segment_speed() -> str:
    return f"{SINGLE_RUN}\n{final('seg_table', ['vin', 'to_ts', 'dt_s', 'speed_kph'], ['dt_s', 'speed_kph'])}"


def q_gps_anomalies() -> str:
    return f"{SINGLE_RUN}\n" + final(
        "seg_table", ["vin", "from_ts", "to_ts", "distance_m", "speed_kph"], ["distance_m", "speed_kph"], "is_anomaly"
    )


def q_position_jumps() -> str:
    return (
        f"WITH {RAW}, {fix_rows_cte('raw')}, {segments_cte('fx')}, {SEG_TABLE}\n"
        + final("seg_table", ["vin", "from_ts", "to_ts", "distance_m", "dt_s"], ["distance_m", "dt_s"], "is_jump")
    )


def alerts_cte(seg: str, name: str) -> str:
    return (
        f"{name} AS (SELECT vin, ts AS timestamp, lat AS latitude, lon AS longitude, "
        f"{r2('seg_kph')} AS computed_speed_kph, {T.speed_limit_kph} AS speed_limit_kph "
        f"FROM {seg} WHERE acc AND seg_kph > {T.speed_limit_kph})"
    )


ALERT_COLS = ["vin", "timestamp", "latitude", "longitude", "computed_speed_kph", "speed_limit_kph"]
ALERT_DOUBLES = ["latitude", "longitude", "computed_speed_kph", "speed_limit_kph"]


def q_speed_alerts() -> str:
    return f"{SINGLE_RUN}, {alerts_cte('seg', 'al')}\n{final('al', ALERT_COLS, ALERT_DOUBLES)}"


def q_running_average() -> str:
    return f"""{SINGLE_RUN},
roll AS ({rollup_select('seg')}),
plain AS (SELECT vin, avg(seg_kph) AS plain_average_kph FROM seg WHERE acc GROUP BY vin),
j AS (SELECT r.vin, r.total_readings, r.average_speed_kph, p.plain_average_kph
      FROM roll r LEFT JOIN plain p ON r.vin = p.vin WHERE r.n_rows >= 2)
{final('j', ['vin', 'total_readings', 'average_speed_kph', 'plain_average_kph'], ['average_speed_kph', 'plain_average_kph'])}"""


POSITION_COLS = ["vin", "timestamp", "latitude", "longitude", "speed", "engine_temp", "gas_tank_level",
                 "obd2_error_code", "processed", "arrival_seq"]
POSITION_DOUBLES = ["latitude", "longitude", "speed", "engine_temp", "gas_tank_level"]


def q_ingest_normalize() -> str:
    return f"WITH {POS}\n{final('pos', POSITION_COLS, POSITION_DOUBLES)}"


def q_ingest_dedupe() -> str:
    return f"""WITH {RAW},
d AS (SELECT *, false AS processed FROM raw
      QUALIFY row_number() OVER (PARTITION BY vin, timestamp ORDER BY arrival_seq) = 1)
{final('d', POSITION_COLS, POSITION_DOUBLES)}"""


def q_ingest_outcomes() -> str:
    return f"""WITH {RAW},
o AS (SELECT vin, timestamp, arrival_seq,
             arrival_seq = min(arrival_seq) OVER (PARTITION BY vin, timestamp) AS success FROM raw)
SELECT vin, timestamp, arrival_seq, success,
       CASE WHEN success THEN 'Saved successfully' ELSE 'Duplicate position ignored' END AS message FROM o"""


# ---- the incremental run, three times ---------------------------------------------------------

STATE0 = (
    "s1 AS (SELECT * FROM (VALUES (NULL::VARCHAR, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, NULL::DOUBLE, "
    "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::INTEGER)) "
    "t(vin, trip_start_timestamp, last_update_timestamp, start_lat, start_lon, last_lat, last_lon, "
    "total_distance_meters, average_speed_kph, max_speed_kph, total_readings) WHERE false)"
)


def run_ctes(k: int, pos: str, state: str, as_of: int) -> str:
    """CTEs of run ``k``: r{k}_lu (rows + is_late), r{k}_seg, r{k}_trip, r{k}_cur, r{k}_done,
    r{k}_alerts, r{k}_marks."""
    to = T.trip_timeout_ms
    trip_cols = ", ".join(TRIP_COLS)
    return f"""
r{k}_rows AS (
  SELECT vin, timestamp AS ts, arrival_seq AS seq, latitude AS lat, longitude AS lon, false AS is_bridge,
         NULL::BIGINT AS seed_start_ts, NULL::DOUBLE AS seed_start_lat, NULL::DOUBLE AS seed_start_lon,
         NULL::DOUBLE AS seed_distance, NULL::DOUBLE AS seed_avg, NULL::DOUBLE AS seed_max, NULL::BIGINT AS seed_n
  FROM {pos} WHERE NOT processed
  UNION ALL
  SELECT vin, last_update_timestamp, 9223372036854775807, last_lat, last_lon, true, trip_start_timestamp, start_lat, start_lon,
         total_distance_meters, average_speed_kph, max_speed_kph, total_readings::BIGINT
  FROM {state}),
r{k}_lu AS (
  SELECT r.*, (NOT r.is_bridge AND s.last_update_timestamp IS NOT NULL AND r.ts <= s.last_update_timestamp) AS is_late
  FROM r{k}_rows r LEFT JOIN {state} s ON r.vin = s.vin),
r{k}_kept AS (SELECT * EXCLUDE (is_late) FROM r{k}_lu WHERE NOT is_late),
{segments_cte(f'r{k}_kept', f'r{k}_seg')},
r{k}_trip AS ({rollup_select(f'r{k}_seg', seeded=True)}),
r{k}_cur AS (
  SELECT {trip_cols} FROM r{k}_trip
  WHERE n_rows >= 2 OR (has_bridge AND NOT ({as_of} - last_update_timestamp > {to}))),
r{k}_done AS (
  SELECT vin, trip_start_timestamp, last_update_timestamp AS trip_end_timestamp, start_lat, start_lon,
         last_lat AS end_lat, last_lon AS end_lon, total_distance_meters, average_speed_kph, max_speed_kph,
         total_readings, (last_update_timestamp - trip_start_timestamp) // 60000 AS duration_minutes
  FROM r{k}_trip WHERE n_rows < 2 AND has_bridge AND {as_of} - last_update_timestamp > {to}),
{alerts_cte(f'r{k}_seg', f'r{k}_alerts')},
r{k}_marks AS (
  SELECT DISTINCT vin, ts AS timestamp, true AS hit FROM r{k}_seg
  WHERE NOT is_bridge AND key_rows >= 2 AND (nts IS NULL OR next_accepted)),
p{k + 1} AS (
  SELECT a.vin, a.timestamp, a.latitude, a.longitude, a.arrival_seq, (a.processed OR coalesce(m.hit, false)) AS processed
  FROM {'pall' if k == 1 else f'p{k}'} a LEFT JOIN r{k}_marks m ON a.vin = m.vin AND a.timestamp = m.timestamp)"""


RUN2_AS_OF_MS = EVENTS_AS_OF_MS
RUN3_AS_OF_MS = 1_709_251_200_000


def chain(upto: int = 3) -> str:
    parts = [
        POSX,
        "pall AS (SELECT vin, timestamp, latitude, longitude, arrival_seq, processed FROM posx)",
        "p1 AS (SELECT vin, timestamp, latitude, longitude, arrival_seq, processed FROM posx "
        "WHERE early AND arrival_seq % 13 <> 0)",
        STATE0,
        run_ctes(1, "p1", "s1", RUN1_AS_OF_MS),
    ]
    if upto >= 2:
        parts.append(run_ctes(2, "p2", "r1_cur", RUN2_AS_OF_MS))
    if upto >= 3:
        parts.append(run_ctes(3, "p3", "r2_cur", RUN3_AS_OF_MS))
    return "WITH " + ",\n".join(parts)


def q_processed_flags() -> str:
    marks = " UNION ALL ".join(f"SELECT vin, timestamp FROM r{k}_marks" for k in (1, 2, 3))
    return f"{chain(3)}\n{marks}"


def q_unprocessed_positions() -> str:
    return f"{chain(1)}\n" + final(
        "p2", ["vin", "timestamp", "latitude", "longitude"], ["latitude", "longitude"], "NOT processed"
    )


def q_late_discard() -> str:
    return f"{chain(2)}\nSELECT vin, ts AS timestamp FROM r2_lu WHERE is_late"


def q_segments_with_bridge() -> str:
    return f"""{chain(2)},
sb AS (SELECT vin, pts AS from_ts, ts AS to_ts, (lag(seq) OVER (PARTITION BY vin ORDER BY ts, seq) = 9223372036854775807) AS from_bridge,
              seg_m AS distance_m, seg_kph AS speed_kph, acc AS accepted, has_segment FROM r2_seg)
{final('sb', ['vin', 'from_ts', 'to_ts', 'from_bridge', 'distance_m', 'speed_kph', 'accepted'], ['distance_m', 'speed_kph'], 'has_segment')}"""


def q_run_gate() -> str:
    return f"{chain(2)}\nSELECT vin, n_rows AS kept_rows, n_rows >= 2 AS gated_in FROM r2_trip"


def q_run_current_trips() -> str:
    return f"{chain(2)}\n{final('r2_cur', TRIP_COLS, R3_TRIP)}"


def q_run_alerts() -> str:
    return f"""{chain(2)},
al AS (SELECT * FROM r1_alerts UNION ALL SELECT * FROM r2_alerts)
{final('al', ALERT_COLS, ALERT_DOUBLES)}"""


def q_trip_timeouts() -> str:
    return f"""{chain(3)}
SELECT vin, last_update_timestamp, {RUN3_AS_OF_MS} - last_update_timestamp AS idle_ms
FROM r3_trip WHERE n_rows < 2 AND has_bridge AND {RUN3_AS_OF_MS} - last_update_timestamp > {T.trip_timeout_ms}"""


COMPLETED_COLS = ["vin", "trip_start_timestamp", "trip_end_timestamp", "start_lat", "start_lon", "end_lat", "end_lon",
                  "total_distance_meters", "average_speed_kph", "max_speed_kph", "total_readings", "duration_minutes"]
COMPLETED_DOUBLES = ["start_lat", "start_lon", "end_lat", "end_lon", "total_distance_meters", "average_speed_kph",
                     "max_speed_kph"]


def q_run_completed_trips() -> str:
    return f"{chain(3)}\n{final('r3_done', COMPLETED_COLS, COMPLETED_DOUBLES)}"


# ---- history split into trips, and the read views ----------------------------------------------


def history() -> str:
    return f"""WITH {POS}, {fix_rows_cte()}, {segments_cte('fx', 'hs', gap_ms=T.trip_timeout_ms)},
ht AS ({rollup_select('hs', group='vin, trip_no')}),
htl AS (SELECT *, trip_no = max(trip_no) OVER (PARTITION BY vin) AS is_last FROM ht),
trips AS (
  SELECT vin, trip_no, trip_start_timestamp, last_update_timestamp AS trip_end_timestamp, start_lat, start_lon,
         last_lat AS end_lat, last_lon AS end_lon, total_distance_meters, average_speed_kph, max_speed_kph,
         total_readings, (last_update_timestamp - trip_start_timestamp) // 60000 AS duration_minutes,
         (is_last AND {HISTORY_AS_OF_MS} - last_update_timestamp <= {T.trip_timeout_ms}) AS is_open
  FROM htl WHERE n_rows >= 2),
cur AS (
  SELECT vin, trip_start_timestamp, trip_end_timestamp AS last_update_timestamp, start_lat, start_lon,
         end_lat AS last_lat, end_lon AS last_lon, total_distance_meters, average_speed_kph, max_speed_kph,
         total_readings FROM trips WHERE is_open),
done AS (SELECT * EXCLUDE (is_open, trip_no) FROM trips WHERE NOT is_open),
{alerts_cte('hs', 'halerts')},
stats AS (SELECT vin, count(*) AS completed_trips_count, sum(total_distance_meters) AS total_distance_meters,
                 CAST(sum(CAST(round(average_speed_kph * 1e6) AS BIGINT)) AS DOUBLE) / (count(average_speed_kph) * 1e6::DOUBLE) AS average_speed_kph
          FROM done GROUP BY vin),
acounts AS (SELECT vin, count(*) AS speed_alerts_count FROM halerts GROUP BY vin)"""


def q_trip_segmentation() -> str:
    return f"{history()}\n" + final(
        "trips", ["vin", "trip_no"] + COMPLETED_COLS[1:] + ["is_open"], COMPLETED_DOUBLES
    )


def q_vehicles() -> str:
    return f"WITH {POS}\nSELECT DISTINCT vin FROM pos"


def q_current_trip() -> str:
    return f"{history()}\n{final('cur', TRIP_COLS, R3_TRIP)}"


def q_completed_trips() -> str:
    return f"{history()}\n{final('done', COMPLETED_COLS, COMPLETED_DOUBLES)}"


def q_alerts_recent() -> str:
    return f"{history()}\n{final('halerts', ALERT_COLS, ALERT_DOUBLES)}"


def q_recent_positions(n: int = 100) -> str:
    return f"""WITH {POS},
rk AS (SELECT vin, timestamp, latitude, longitude,
              (row_number() OVER (PARTITION BY vin ORDER BY timestamp DESC))::INTEGER AS rank FROM pos)
{final('rk', ['vin', 'timestamp', 'latitude', 'longitude', 'rank'], ['latitude', 'longitude'], f'rank <= {n}')}"""


def q_alert_counts() -> str:
    return f"{history()}\nSELECT vin, speed_alerts_count FROM acounts"


def q_trip_stats_by_vin() -> str:
    return f"{history()}\n" + final(
        "stats", ["vin", "completed_trips_count", "total_distance_meters", "average_speed_kph"],
        ["total_distance_meters", "average_speed_kph"],
    )


def q_vehicle_summary() -> str:
    return f"""{history()},
vs AS (
  SELECT v.vin,
         coalesce(s.completed_trips_count, 0)::BIGINT AS completed_trips_count,
         coalesce(s.total_distance_meters, 0.0) AS total_distance_meters,
         s.average_speed_kph,
         coalesce(a.speed_alerts_count, 0)::BIGINT AS speed_alerts_count,
         {HISTORY_AS_OF_MS}::BIGINT AS last_computed_at,
         c.trip_start_timestamp AS current_trip_start_timestamp,
         c.last_update_timestamp AS current_last_update_timestamp,
         c.total_distance_meters AS current_total_distance_meters,
         c.total_readings AS current_total_readings
  FROM (SELECT DISTINCT vin FROM pos) v
  LEFT JOIN cur c ON v.vin = c.vin
  LEFT JOIN stats s ON v.vin = s.vin
  LEFT JOIN acounts a ON v.vin = a.vin)
{final('vs', ['vin', 'completed_trips_count', 'total_distance_meters', 'average_speed_kph', 'speed_alerts_count', 'last_computed_at', 'current_trip_start_timestamp', 'current_last_update_timestamp', 'current_total_distance_meters', 'current_total_readings'], ['total_distance_meters', 'average_speed_kph', 'current_total_distance_meters'])}"""


def q_fleet_summary() -> str:
    return f"""{history()}
SELECT (SELECT count(DISTINCT vin) FROM pos)::BIGINT AS total_vehicles,
       (SELECT count(*) FROM cur)::BIGINT AS active_trips,
       (SELECT count(*) FROM done)::BIGINT AS completed_trips,
       (SELECT count(*) FROM halerts)::BIGINT AS total_speed_alerts,
       {HISTORY_AS_OF_MS}::BIGINT AS last_computed_at"""


STORE_DONE = "sdone AS (SELECT * FROM r1_done UNION ALL SELECT * FROM r2_done UNION ALL SELECT * FROM r3_done)"
STORE_ALERTS = "salerts AS (SELECT * FROM r1_alerts UNION ALL SELECT * FROM r2_alerts UNION ALL SELECT * FROM r3_alerts)"


def q_store_fleet_summary() -> str:
    return f"""{chain(3)}, {STORE_DONE}, {STORE_ALERTS}
SELECT (SELECT count(DISTINCT vin) FROM pall)::BIGINT AS total_vehicles,
       (SELECT count(*) FROM r3_cur)::BIGINT AS active_trips,
       (SELECT count(*) FROM sdone)::BIGINT AS completed_trips,
       (SELECT count(*) FROM salerts)::BIGINT AS total_speed_alerts,
       {RUN3_AS_OF_MS}::BIGINT AS last_computed_at"""


def q_store_vehicle_summary() -> str:
    return f"""{chain(3)}, {STORE_DONE}, {STORE_ALERTS},
st AS (SELECT vin, count(*) AS n, sum(total_distance_meters) AS m,
              CAST(sum(CAST(round(average_speed_kph * 1e6) AS BIGINT)) AS DOUBLE) / (count(average_speed_kph) * 1e6::DOUBLE) AS v
       FROM sdone GROUP BY vin),
ac AS (SELECT vin, count(*) AS n FROM salerts GROUP BY vin),
sv AS (SELECT v.vin, coalesce(st.n, 0)::BIGINT AS completed_trips_count, coalesce(st.m, 0.0) AS total_distance_meters,
              st.v AS average_speed_kph, coalesce(ac.n, 0)::BIGINT AS speed_alerts_count, {RUN3_AS_OF_MS}::BIGINT AS last_computed_at
       FROM (SELECT DISTINCT vin FROM pall) v LEFT JOIN st ON v.vin = st.vin LEFT JOIN ac ON v.vin = ac.vin)
{final('sv', ['vin', 'completed_trips_count', 'total_distance_meters', 'average_speed_kph', 'speed_alerts_count', 'last_computed_at'], ['total_distance_meters', 'average_speed_kph'])}"""


def q_unknown_vins() -> str:
    return f"""WITH {POS}
SELECT DISTINCT printf('VIN%06d', c_custkey) AS vin FROM customer
WHERE printf('VIN%06d', c_custkey) NOT IN (SELECT vin FROM pos)"""


def statements() -> dict[str, str]:
    return {
        "trip_rollup": q_trip_rollup(),
        "stream_trip_rollup": q_trip_rollup(),
        "stream_ingest_rollup": q_trip_rollup(),
        "stream_outcomes": q_ingest_outcomes(),
        "stream_retry_trips": q_run_current_trips(),
        "haversine": q_haversine(),
        "segment_speed": q_segment_speed(),
        "segments": q_segments(),
        "gps_anomalies": q_gps_anomalies(),
        "position_jumps": q_position_jumps(),
        "speed_alerts": q_speed_alerts(),
        "running_average": q_running_average(),
        "ingest_normalize": q_ingest_normalize(),
        "ingest_dedupe": q_ingest_dedupe(),
        "ingest_outcomes": q_ingest_outcomes(),
        "processed_flags": q_processed_flags(),
        "unprocessed_positions": q_unprocessed_positions(),
        "late_discard": q_late_discard(),
        "segments_with_bridge": q_segments_with_bridge(),
        "run_gate": q_run_gate(),
        "run_current_trips": q_run_current_trips(),
        "run_alerts": q_run_alerts(),
        "trip_timeouts": q_trip_timeouts(),
        "run_completed_trips": q_run_completed_trips(),
        "trip_segmentation": q_trip_segmentation(),
        "vehicles": q_vehicles(),
        "current_trip": q_current_trip(),
        "completed_trips": q_completed_trips(),
        "alerts_recent": q_alerts_recent(),
        "recent_positions": q_recent_positions(),
        "alert_counts": q_alert_counts(),
        "trip_stats_by_vin": q_trip_stats_by_vin(),
        "vehicle_summary": q_vehicle_summary(),
        "fleet_summary": q_fleet_summary(),
        "store_fleet_summary": q_store_fleet_summary(),
        "store_vehicle_summary": q_store_vehicle_summary(),
        "store_recent_positions": q_recent_positions(),
        "store_history": q_trip_segmentation(),
        "unknown_vins": q_unknown_vins(),
    }
