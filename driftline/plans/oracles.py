"""The queries in SQL for DuckDB, written from what the operators mean and not from how they are built."""

from __future__ import annotations

from driftline.plans.derived import AIRCRAFT
from driftline.plans.rule_sql import BASE, HEX, STRICT


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


REGISTRY = f"""
aircraft(k, manufacturername, model, icaoaircrafttype) AS (VALUES {", ".join(f"({k}, {', '.join(map(_text, a))})" for k, a in enumerate(AIRCRAFT))}),
registry AS (
  SELECT CASE WHEN p_partkey % 13 = 0 THEN substr(key, 2, 5) WHEN p_partkey % 17 = 0 THEN upper(key) ELSE key END AS icao24, manufacturername, model, icaoaircrafttype
  FROM (SELECT p_partkey, printf('%06x', p_partkey) AS key FROM part) p JOIN aircraft a ON p.p_partkey % {len(AIRCRAFT)} = a.k
),
marked AS (
  SELECT *, {BASE} AS is_base, {STRICT} AS is_strict, {HEX} AS is_hex
  FROM (SELECT *, trim(upper(coalesce(manufacturername, ''))) AS maker, trim(upper(coalesce(model, ''))) AS mdl, trim(upper(coalesce(icaoaircrafttype, ''))) AS typ FROM registry)
),
flags AS (SELECT *, is_base AND NOT is_strict AND is_hex AS is_kept FROM marked),
keys AS (SELECT DISTINCT lower(trim(icao24)) AS icao24 FROM flags WHERE is_kept AND trim(icao24) <> '')"""

STATES = """
raw AS (SELECT *, event_id AS e, user_id AS u, (epoch_us(ts) / 1e6::DOUBLE - 1704067200.0::DOUBLE) / 2400.0::DOUBLE AS t FROM events),
east AS (SELECT *, 179.97::DOUBLE + t * 0.0001::DOUBLE AS x FROM raw),
once AS (
  SELECT DATE '2022-06-06' + CAST(7 * (u % 4) AS INTEGER) AS date,
    CASE WHEN e % 31 = 0 THEN ' ' ELSE printf('%06x', u) END AS icao24,
    CASE WHEN event_type = 'error' THEN '' ELSE 'C' || u || '_' || CAST(floor(t / 540) AS BIGINT) END AS callsign,
    t + CASE WHEN e % 23 = 0 THEN 15.0::DOUBLE ELSE (e % 9)::DOUBLE END AS time,
    t AS lastposupdate,
    CASE WHEN e % 37 <> 0 THEN 40.0::DOUBLE + u::DOUBLE * 0.01::DOUBLE + t * 55.0::DOUBLE / 111320.0::DOUBLE + CASE WHEN value > 200 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END END AS lat,
    CASE WHEN e % 41 = 0 THEN 181.0::DOUBLE WHEN u % 5 = 0 THEN CASE WHEN x >= 180.0 THEN x - 360.0::DOUBLE ELSE x END ELSE -75.0::DOUBLE + t * 0.0001::DOUBLE END AS lon,
    CASE WHEN e % 11 <> 0 THEN 900.0::DOUBLE + (e % 50)::DOUBLE END AS geoaltitude,
    CASE WHEN e % 143 <> 0 THEN CASE WHEN e % 55 = 0 THEN 20000.0::DOUBLE ELSE 950.0::DOUBLE + (e % 50)::DOUBLE END END AS baroaltitude,
    30.0::DOUBLE + value / 5 AS velocity,
    CASE WHEN e % 19 <> 0 THEN ((e * 37) % 360)::DOUBLE END AS heading,
    CASE WHEN e % 3 <> 0 THEN (e % 7)::DOUBLE - 3 END AS vertrate,
    CASE WHEN e % 17 = 0 THEN 'True' WHEN e % 2 = 0 THEN 'false' END AS onground,
    e AS src_order
  FROM east
),
states AS (
  SELECT * FROM once
  UNION ALL SELECT * REPLACE (time + 1 AS time, velocity + 1 AS velocity, src_order + 1000000000 AS src_order) FROM once WHERE src_order % 29 = 0
)"""

FIXES = (
    STATES
    + """,
fresh AS (SELECT * FROM states WHERE time - lastposupdate BETWEEN 0 AND 10),
firsts AS (SELECT *, lastposupdate AS t FROM fresh WHERE lastposupdate IS NOT NULL QUALIFY row_number() OVER (PARTITION BY date, icao24, lastposupdate ORDER BY src_order) = 1),
judged AS (
  SELECT *, CASE
    WHEN icao24 IS NULL OR trim(icao24) = '' OR lower(trim(icao24)) = 'nan' THEN 'missing_id'
    WHEN lat IS NULL OR lon IS NULL THEN 'missing_position'
    WHEN abs(lat) > 90 OR abs(lon) > 180 OR (abs(lat) < 1e-6 AND abs(lon) < 1e-6) THEN 'bad_position'
    WHEN onground IN ('True', 'true', '1') THEN 'on_ground'
    WHEN alt IS NULL THEN 'missing_altitude'
    WHEN alt < -400 OR alt > 12000 THEN 'bad_altitude' END AS removed_by
  FROM (SELECT *, coalesce(geoaltitude, baroaltitude) AS alt FROM firsts)
),
fixes AS (SELECT *, CASE WHEN lower(trim(callsign)) NOT IN ('', 'nan', 'none') THEN trim(callsign) END AS cs FROM judged WHERE removed_by IS NULL),
known AS (
  SELECT *, lag(t) OVER w AS pt, last_value(cs IGNORE NULLS) OVER (PARTITION BY date, icao24 ORDER BY t, src_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kc
  FROM fixes WINDOW w AS (PARTITION BY date, icao24 ORDER BY t, src_order)
)"""
)


def _segments(source: str, name: str, gap: float) -> str:
    return f"""
{name}_n AS (
  SELECT *, sum(CASE WHEN starts_segment THEN 1 ELSE 0 END) OVER (PARTITION BY date, icao24 ORDER BY t, src_order ROWS UNBOUNDED PRECEDING) AS sn
  FROM (SELECT *, pt IS NULL OR t - pt > {gap} OR coalesce(cs <> kc, false) AS starts_segment FROM {source})
),
{name} AS (
  SELECT *, icao24 || '_' || CAST(trunc(segment_start_time) AS BIGINT) AS segment_id, segment_end_time - segment_start_time AS segment_duration_s
  FROM (SELECT *, min(t) OVER s AS segment_start_time, max(t) OVER s AS segment_end_time FROM {name}_n WINDOW s AS (PARTITION BY date, icao24, sn))
)"""


#: Metres a second from the row before in a segment.
_SPEED = """CASE WHEN t - lag(t) OVER g > 0 THEN 2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
  pow(sin((radians(lat) - radians(lag(lat) OVER g)) / 2), 2) + cos(radians(lag(lat) OVER g)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(lag(lon) OVER g)) / 2), 2)))) / (t - lag(t) OVER g)
  WHEN lag(t) OVER g IS NOT NULL THEN 0 END"""
_G = "WINDOW g AS (PARTITION BY date, icao24, segment_id ORDER BY t, src_order)"
_LIMIT = "154.3332"


def _pass(source: str, name: str) -> str:
    return f"""
{name}_f AS (SELECT *, CASE WHEN coalesce({_SPEED} > {_LIMIT}, false) THEN 1 ELSE 0 END AS fast, row_number() OVER g AS pos FROM {source} {_G}),
{name}_p AS (SELECT *, fast + coalesce(lead(fast) OVER g, 0) AS parts FROM {name}_f {_G}),
{name}_w AS (SELECT date, icao24, segment_id, arg_min(pos, pos - parts * 1000000) AS worst FROM {name}_p GROUP BY ALL HAVING max(parts) > 0),
{name} AS (SELECT p.* EXCLUDE (fast, pos, parts), w.worst IS NOT NULL AS is_worst FROM {name}_p p LEFT JOIN {name}_w w ON p.date = w.date AND p.icao24 = w.icao24 AND p.segment_id = w.segment_id AND p.pos = w.worst)"""


def _valid(source: str, name: str) -> str:
    """Three passes, then persistent and valid segments."""
    text, last = "", source
    for k in (1, 2, 3):
        text += _pass(last, f"{name}_{k}") + f", {name}_{k}k AS (SELECT * EXCLUDE (is_worst) FROM {name}_{k} WHERE NOT is_worst),"
        last = f"{name}_{k}k"
    return (
        text
        + f"""
{name}_s AS (SELECT *, {_SPEED} AS v FROM {last} {_G}),
{name}_c AS (SELECT date, icao24, segment_id, count(*) AS before FROM {source} GROUP BY ALL),
{name}_g AS (SELECT date, icao24, segment_id, count(*) AS n, coalesce(avg(CASE WHEN v > {_LIMIT} THEN 1.0 WHEN v IS NOT NULL THEN 0.0 END), 0) > 0.05 AS is_persistent,
  arg_min(segment_duration_s, (t, src_order)) AS duration, median(velocity) AS mv FROM {name}_s GROUP BY ALL),
{name}_all AS (
  SELECT s.*, c.before - g.n AS points_removed, g.is_persistent, g.duration >= 200 AND g.n >= 8 AND NOT g.is_persistent AND coalesce(g.mv >= 15, false) AS is_valid
  FROM {name}_s s JOIN {name}_g g USING (date, icao24, segment_id) JOIN {name}_c c USING (date, icao24, segment_id)
),
{name} AS (SELECT * FROM {name}_all WHERE is_valid)"""
    )


SEGMENTED = FIXES + "," + _segments("known", "seg", 120)
VALID = SEGMENTED + "," + _valid("seg", "val")

PIECES = (
    VALID
    + """,
pc_d AS (SELECT *, first_value(callsign) OVER s AS first_callsign FROM (SELECT * FROM val QUALIFY row_number() OVER (PARTITION BY date, icao24, segment_id, t ORDER BY src_order) = 1)
  WINDOW s AS (PARTITION BY date, icao24, segment_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
pc_k AS (SELECT *, sum(gap) OVER (PARTITION BY date, icao24, segment_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS piece
  FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY date, icao24, segment_id ORDER BY t) > 60 THEN 1 ELSE 0 END AS gap FROM pc_d)),
pc_n AS (SELECT *, segment_id || '_r' || piece AS trajectory_id, count(*) OVER (PARTITION BY date, icao24, segment_id, piece) AS n_fixes,
  max(piece) OVER (PARTITION BY date, icao24, segment_id) > 0 AS was_split_by_interp_gap,
  lon - lag(lon) OVER (PARTITION BY date, icao24, segment_id, piece ORDER BY t) AS jump FROM pc_k),
pieces AS (SELECT * REPLACE (CAST(n_fixes AS BIGINT) AS n_fixes), lon + sum(CASE WHEN jump > 180 THEN -360.0 WHEN jump < -180 THEN 360.0 ELSE 0.0 END::DOUBLE) OVER (PARTITION BY date, trajectory_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS lon_u FROM pc_n)"""
)

GRID = (
    PIECES
    + """,
tr AS (SELECT date, icao24, segment_id, piece, trajectory_id, min(t) AS t0, max(t) AS t1, CAST(ceil((max(t) - min(t) + 1e-9) / 10.0::DOUBLE) AS BIGINT) AS n_samples, any_value(first_callsign) AS callsign,
  any_value(was_split_by_interp_gap) AS was_split_by_interp_gap FROM pieces WHERE n_fixes >= 2 GROUP BY ALL),
times AS (SELECT *, t0 + sample_idx * 10.0::DOUBLE AS timestamp FROM (SELECT *, unnest(range(0, n_samples)) AS sample_idx FROM tr)),
fx AS (SELECT date, trajectory_id, t, lat, lon_u, alt, lead(t) OVER o AS nt, lead(lat) OVER o AS nlat, lead(lon_u) OVER o AS nlon, lead(alt) OVER o AS nalt, t - lag(t) OVER o AS dt
  FROM pieces WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY t)),
um AS (SELECT date, trajectory_id, median(dt) AS raw_update_median_s FROM fx GROUP BY ALL),
grid AS (
  SELECT g.*, coalesce(lat + (nlat - lat) / (nt - t) * (timestamp - t), lat) AS lat_interp, coalesce(fx.lon_u + (nlon - fx.lon_u) / (nt - t) * (timestamp - t), fx.lon_u) AS lon_u,
    coalesce(alt + (nalt - alt) / (nt - t) * (timestamp - t), alt) AS alt_interp, least(timestamp - t, coalesce(nt - timestamp, timestamp - t)) > 5.0 AS is_interpolated,
    (t0 + (n_samples - 1) * 10.0::DOUBLE) - t0 AS trajectory_duration_s
  FROM times g ASOF JOIN fx ON g.date = fx.date AND g.trajectory_id = fx.trajectory_id AND g.timestamp >= fx.t
)"""
)

MOTION = (
    GRID
    + """,
mo_o AS (SELECT *, first_value(lat_interp) OVER o AS lat0, first_value(lon_u) OVER o AS lon0 FROM grid WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY sample_idx)),
mo_e AS (SELECT *, 6371000.0::DOUBLE * cos(radians(lat0)) * radians(lon_u - lon0) AS ee, 6371000.0::DOUBLE * radians(lat_interp - lat0) AS nn FROM mo_o),
mo_v AS (SELECT *, (ee - lag(ee) OVER o) / 10 AS ve, (nn - lag(nn) OVER o) / 10 AS vn FROM mo_e WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY sample_idx)),
mo_s AS (SELECT *, sqrt(ve * ve + vn * vn) AS sp, degrees(atan2(ve, vn)) AS hd FROM mo_v),
mo_d AS (SELECT *, ve - lag(ve) OVER o AS dve, vn - lag(vn) OVER o AS dvn, hd - lag(hd) OVER o AS dh, sp - lag(sp) OVER o AS dsp, lead(sp) OVER o AS nsp FROM mo_s
  WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY sample_idx)),
motion AS (SELECT *, coalesce(sp, nsp) AS speed_mps, dsp / 10 AS accel_mps2, sqrt(dve * dve + dvn * dvn) / 10 AS accel_vector_mps2, ((((dh + 180) % 360) + 360) % 360 - 180) / 10 AS turn_rate_deg_s FROM mo_d),
verdicts AS (
  SELECT date, trajectory_id, CASE WHEN any_value(trajectory_duration_s) < 120 THEN 'duration' WHEN any_value(n_samples) < 12 THEN 'min_points' WHEN max(speed_mps) > 154.3332 THEN 'speed' END AS reason,
    coalesce(avg(CASE WHEN abs(accel_mps2) > 10 THEN 1.0 WHEN accel_mps2 IS NOT NULL THEN 0.0 END) > 0.05, false) AS fa,
    coalesce(avg(CASE WHEN abs(turn_rate_deg_s) > 6 THEN 1.0 WHEN turn_rate_deg_s IS NOT NULL THEN 0.0 END) > 0.05, false) AS ft
  FROM motion GROUP BY ALL
),
judged_samples AS (SELECT m.*, v.reason, v.reason IS NULL AND fa AS exceeds_accel_limit, v.reason IS NULL AND ft AS exceeds_turn_rate_limit FROM motion m JOIN verdicts v USING (date, trajectory_id))"""
)

RAW = """,
rd_o AS (SELECT p.*, tr.t0, tr.n_samples - 1 AS last, first_value(lat) OVER o AS lat0, first_value(p.lon_u) OVER o AS lon0 FROM pieces p JOIN tr USING (date, trajectory_id)
  WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY t)),
rd_v AS (SELECT *, (6371000.0::DOUBLE * cos(radians(lat0)) * radians(lon_u - lon0) - lag(6371000.0::DOUBLE * cos(radians(lat0)) * radians(lon_u - lon0)) OVER o) / (t - lag(t) OVER o) AS ve,
  (6371000.0::DOUBLE * radians(lat - lat0) - lag(6371000.0::DOUBLE * radians(lat - lat0)) OVER o) / (t - lag(t) OVER o) AS vn, (t + lag(t) OVER o) / 2 AS mid FROM rd_o WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY t)),
rd_s AS (SELECT *, sqrt(ve * ve + vn * vn) AS sp, degrees(atan2(ve, vn)) AS hd FROM rd_v),
rd_a AS (SELECT *, abs((sp - lag(sp) OVER o) / (mid - lag(mid) OVER o)) AS ac, abs((((((hd - lag(hd) OVER o) + 180) % 360) + 360) % 360 - 180) / (mid - lag(mid) OVER o)) AS tu, (mid + lag(mid) OVER o) / 2 AS mid2
  FROM rd_s WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY t)),
rd_b AS (
  SELECT date, trajectory_id, greatest(0, least(last, CAST(ceil((t - t0) / 10.0::DOUBLE) AS BIGINT))) AS sample_idx, 1 AS n, NULL::DOUBLE AS sp, NULL::DOUBLE AS ac, NULL::DOUBLE AS tu FROM rd_a
  UNION ALL SELECT date, trajectory_id, greatest(0, least(last, CAST(ceil((mid - t0) / 10.0::DOUBLE) AS BIGINT))), 0, sp, NULL, NULL FROM rd_a WHERE mid IS NOT NULL
  UNION ALL SELECT date, trajectory_id, greatest(0, least(last, CAST(ceil((mid2 - t0) / 10.0::DOUBLE) AS BIGINT))), 0, NULL, ac, tu FROM rd_a WHERE mid2 IS NOT NULL
),
rawdyn AS (SELECT date, trajectory_id, sample_idx, CAST(sum(n) AS BIGINT) AS n_raw_fixes, max(sp) AS raw_speed_max_mps, max(ac) AS raw_accel_max_mps2, max(tu) AS raw_turn_rate_max_deg_s FROM rd_b GROUP BY ALL)"""

#: The trajectories that stay.
SAMPLES = MOTION + ", samples AS (SELECT * EXCLUDE (lon_u), ((lon_u + 180) % 360 + 360) % 360 - 180 AS lon_interp FROM judged_samples WHERE reason IS NULL)"
DROPPED = """,
dropped AS (
  SELECT date, trajectory_id, segment_id AS source_segment_id, reason, n_samples, trajectory_duration_s AS duration_s FROM judged_samples WHERE reason IS NOT NULL AND sample_idx = 0
  UNION ALL SELECT date, trajectory_id, segment_id, 'min_points', n_fixes, 0.0 FROM pieces WHERE n_fixes < 2
)"""


def _channel(name: str) -> str:
    """Between the known values around each sample."""
    return f"""
{name}_k AS (SELECT date, trajectory_id, t, {name} AS y FROM pieces WHERE {name} IS NOT NULL AND n_fixes >= 2 QUALIFY count(*) OVER (PARTITION BY date, trajectory_id) >= 2),
{name}_i AS (
  SELECT g.date, g.trajectory_id, g.sample_idx, coalesce(a.y + (b.y - a.y) / nullif(b.t - a.t, 0) * (g.timestamp - a.t), a.y, b.y) AS {name}_interp
  FROM grid g ASOF LEFT JOIN {name}_k a ON g.date = a.date AND g.trajectory_id = a.trajectory_id AND g.timestamp >= a.t
  ASOF LEFT JOIN {name}_k b ON g.date = b.date AND g.trajectory_id = b.trajectory_id AND g.timestamp < b.t
)"""


_HEADING = """,
hk AS (SELECT date, trajectory_id, t, heading, heading - lag(heading) OVER (PARTITION BY date, trajectory_id ORDER BY t) AS j FROM pieces WHERE heading IS NOT NULL AND n_fixes >= 2
  QUALIFY count(*) OVER (PARTITION BY date, trajectory_id) >= 2),
hu AS (SELECT date, trajectory_id, t, heading + sum(CASE WHEN j > 180 THEN -360 WHEN j < -180 THEN 360 ELSE 0 END) OVER (PARTITION BY date, trajectory_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS y FROM hk),
hi AS (SELECT g.trajectory_id, g.sample_idx, coalesce(a.y + (b.y - a.y) / nullif(b.t - a.t, 0) * (g.timestamp - a.t), a.y, b.y) AS h
  FROM grid g ASOF LEFT JOIN hu a ON g.date = a.date AND g.trajectory_id = a.trajectory_id AND g.timestamp >= a.t
  ASOF LEFT JOIN hu b ON g.date = b.date AND g.trajectory_id = b.trajectory_id AND g.timestamp < b.t)"""

_SUMMARY3 = (
    VALID
    + """,
s_raw AS (SELECT date, count(*) AS rows_input, count(DISTINCT coalesce(trim(icao24), 'nan')) AS unique_aircraft_input FROM states GROUP BY date),
s_fresh AS (SELECT date, count(*) AS n FROM firsts GROUP BY date),
s_clean AS (SELECT date, count(*) AS n FROM fixes GROUP BY date),
s_seg AS (SELECT date, icao24, segment_id, count(*) AS n, any_value(points_removed) AS removed, any_value(is_persistent) AS p, any_value(is_valid) AS v, arg_min(segment_duration_s, t) AS d FROM val_all GROUP BY ALL),
s_day AS (SELECT date, sum(removed) FILTER (NOT p) AS glitch, count(*) FILTER (p) AS gone, sum(n + removed) FILTER (p) AS gone_rows, sum(n) FILTER (NOT p AND NOT v) AS short, sum(n) FILTER (v) AS kept,
  count(DISTINCT icao24) FILTER (v) AS aircraft, count(*) FILTER (v) AS segs, median(d) FILTER (v) AS md, avg(d) FILTER (v) AS ad, max(d) FILTER (v) AS xd FROM s_seg GROUP BY date),
summary AS (
  SELECT CAST(date AS VARCHAR) AS date, rows_input, unique_aircraft_input, coalesce(s_fresh.n, 0) AS rows_after_freshness, coalesce(s_clean.n, 0) AS rows_after_basic_cleaning,
    CAST(coalesce(glitch, 0) AS BIGINT) AS rows_removed_glitch_points, coalesce(gone, 0) AS segments_discarded_persistent_violations, CAST(coalesce(gone_rows, 0) AS BIGINT) AS rows_in_discarded_segments,
    CAST(coalesce(short, 0) AS BIGINT) AS rows_removed_short_segments, CAST(coalesce(kept, 0) AS BIGINT) AS rows_after_segmentation, coalesce(aircraft, 0) AS unique_aircraft_output, coalesce(segs, 0) AS num_segments_output,
    rows_input - coalesce(s_fresh.n, 0) AS rows_removed_freshness, coalesce(s_fresh.n, 0) - coalesce(s_clean.n, 0) AS rows_removed_basic_cleaning,
    round(coalesce(md, 0), 6) AS median_segment_duration_s, round(coalesce(ad, 0), 6) AS mean_segment_duration_s, round(coalesce(xd, 0), 6) AS max_segment_duration_s
  FROM s_raw LEFT JOIN s_fresh USING (date) LEFT JOIN s_clean USING (date) LEFT JOIN s_day USING (date)
)"""
)


def _sensitivity() -> str:
    text = VALID + ", bare AS (SELECT date, icao24, cs, t, lat, lon, velocity, src_order FROM val), bare_k AS (SELECT *, lag(t) OVER w AS pt, last_value(cs IGNORE NULLS) OVER (PARTITION BY date, icao24 ORDER BY t, src_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kc FROM bare WINDOW w AS (PARTITION BY date, icao24 ORDER BY t, src_order))"
    parts = []
    for k in (1, 2, 3):
        text += "," + _segments("bare_k", f"s{k}", 120 * k) + "," + _valid(f"s{k}", f"v{k}")
        parts.append(
            f"SELECT {120.0 * k}::DOUBLE AS gap_split_s, count(*) AS num_segments, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_points_kept, round(coalesce(median(d), 0), 6) AS median_duration_s FROM (SELECT count(*) AS n, arg_min(segment_duration_s, t) AS d FROM v{k} GROUP BY date, icao24, segment_id)"
        )
    return f"WITH {text} " + " UNION ALL ".join(parts)


def _hist(name: str, value: str, high: float) -> str:
    return f"SELECT '{name}' AS channel, CAST(least(59, floor({value} / ({high}::DOUBLE / 60))) AS BIGINT) AS bin FROM samples WHERE {value} BETWEEN 0 AND {high}"


def _percentiles(name: str, value: str) -> str:
    return f"SELECT '{name}' AS channel, round(quantile_cont({value}, 0.5), 6) AS p50, round(quantile_cont({value}, 0.95), 6) AS p95, round(quantile_cont({value}, 0.99), 6) AS p99 FROM samples"


_PER = "per AS (SELECT date, trajectory_id, any_value(trajectory_duration_s) AS d FROM samples GROUP BY ALL)"

ORACLES = {
    "classify_funnel": f"WITH {REGISTRY} SELECT count(*) AS rows_total, count(*) FILTER (is_base) AS rows_base_match, count(*) FILTER (is_base AND is_strict) AS rows_removed_strict, count(*) FILTER (is_base AND NOT is_strict AND NOT is_hex) AS rows_removed_bad_icao24, count(*) FILTER (is_kept) AS rows_kept FROM flags",
    "classify_kept": f"WITH {REGISTRY} SELECT icao24, manufacturername, model, icaoaircrafttype, is_base, is_strict, is_hex, is_kept FROM flags",
    "whitelist_keys": f"WITH {REGISTRY} SELECT icao24 FROM keys",
    "states_semi_join": f"WITH {REGISTRY}, {STATES} SELECT CAST(date AS VARCHAR) AS date, icao24, time, src_order FROM states WHERE lower(trim(icao24)) IN (SELECT icao24 FROM keys)",
    "states_day_summary": f'WITH {STATES} SELECT CAST(date AS VARCHAR) AS date, count(*) AS "rows", count(DISTINCT lower(trim(icao24))) AS aircraft FROM states GROUP BY date',
    "freshness": f"WITH {FIXES} SELECT src_order, time, lastposupdate FROM fresh",
    "dedup_first": f"WITH {STATES} SELECT icao24, lastposupdate AS t, src_order, velocity FROM states QUALIFY row_number() OVER (PARTITION BY date, icao24, lastposupdate ORDER BY src_order) = 1",
    "clean_funnel": f"WITH {FIXES} SELECT CAST(date AS VARCHAR) AS date, count(*) AS rows_before, "
    + ", ".join(f"count(*) FILTER (removed_by = '{n}') AS removed_{n}" for n in ("missing_id", "missing_position", "bad_position", "on_ground", "missing_altitude", "bad_altitude"))
    + ", count(*) FILTER (removed_by IS NULL) AS rows_after FROM judged GROUP BY date",
    "onground_parse": f"WITH {STATES} SELECT src_order, coalesce(onground = 'True', false) AS is_on_ground FROM states",
    "alt_coalesce": f"WITH {STATES} SELECT src_order, coalesce(geoaltitude, baroaltitude) AS alt FROM states",
    "callsign_last_known": f"WITH {FIXES} SELECT src_order, cs AS callsign, kc AS known_callsign FROM known",
    "segment_flags": f"WITH {SEGMENTED} SELECT src_order, starts_segment, segment_id FROM seg",
    "segment_summary": f"WITH {SEGMENTED} SELECT CAST(date AS VARCHAR) AS date, icao24, segment_id, count(*) AS n, arg_min(segment_duration_s, t) AS segment_duration_s, min(segment_start_time) AS segment_start_time FROM seg GROUP BY ALL",
    "step_speed": f"WITH {SEGMENTED} SELECT src_order, round({_SPEED}, 6) AS speed_mps FROM seg {_G}",
    "glitch_pass1": f"WITH {SEGMENTED}, {_pass('seg', 'p1')} SELECT segment_id, src_order FROM p1 WHERE is_worst",
    "glitch_clean": f"WITH {VALID} SELECT src_order, segment_id, points_removed, is_persistent FROM val_all",
    "valid_segments": f"WITH {VALID} SELECT CAST(date AS VARCHAR) AS date, segment_id, src_order, t, segment_duration_s FROM val",
    "stage3_summary": f"WITH {_SUMMARY3} SELECT * FROM summary",
    "gap_sensitivity": _sensitivity(),
    "consistency_flag": f"""WITH {_SUMMARY3}, sh AS (SELECT date, 1.0::DOUBLE - rows_after_segmentation::DOUBLE / rows_input AS f FROM summary), md AS (SELECT median(f) AS m FROM sh)
SELECT date, round(f, 6) AS removed_fraction, round(m, 6) AS median_fraction, m > 0 AND (f > 2 * m OR f < m / 2) AS is_flagged FROM sh, md""",
    "segment_speeds": f"WITH {VALID}, sv AS (SELECT date, icao24, segment_id, {_SPEED} AS w FROM val {_G}) SELECT segment_id, round(min(w), 6) AS min_mps, round(median(w), 6) AS median_mps, round(max(w), 6) AS max_mps FROM sv GROUP BY segment_id",
    "segment_spot_check": f"""WITH {VALID}, sv AS (SELECT date, icao24, segment_id, {_SPEED} AS w FROM val {_G}),
c AS (SELECT DISTINCT date, icao24, segment_id FROM val ORDER BY md5('1|' || CAST(date AS VARCHAR) || '|' || icao24 || '|' || segment_id) LIMIT 3)
SELECT CAST(date AS VARCHAR) AS date, segment_id, count(*) AS n, round(min(w), 6) AS min_mps, round(median(w), 6) AS median_mps, round(max(w), 6) AS max_mps, max(w) < {_LIMIT} AS is_ok
FROM sv JOIN c USING (date, icao24, segment_id) GROUP BY date, icao24, segment_id""",
    "trajectory_spot_check": f"""WITH {SAMPLES}, c AS (SELECT DISTINCT date, trajectory_id FROM samples ORDER BY md5('1|' || CAST(date AS VARCHAR) || '|' || trajectory_id) LIMIT 3)
SELECT CAST(date AS VARCHAR) AS date, trajectory_id, count(*) AS n_samples, round(max(trajectory_duration_s), 6) AS duration_s, round(max(speed_mps), 6) AS max_speed_mps, round(max(abs(accel_mps2)), 6) AS max_accel_mps2,
  round(max(abs(turn_rate_deg_s)), 6) AS max_turn_rate_deg_s FROM samples JOIN c USING (date, trajectory_id) GROUP BY date, trajectory_id""",
    "track_pick": f"""WITH {SAMPLES}, f AS (SELECT date, trajectory_id, avg(CASE WHEN is_interpolated THEN 1.0 ELSE 0.0 END) AS s, any_value(n_samples) AS n_samples FROM samples GROUP BY ALL),
g AS (SELECT *, s BETWEEN 0.05 AND 0.25 AND n_samples BETWEEN 150 AND 400 AS ok FROM f)
SELECT CAST(date AS VARCHAR) AS date, trajectory_id, round(s, 6) AS filled_fraction, n_samples, ok AS is_pick FROM g
ORDER BY ok DESC, CASE WHEN ok THEN 0 ELSE -s END, trajectory_id LIMIT 1""",
    "cruise_anchor": f"WITH {VALID} SELECT round(median(velocity), 6) AS median_velocity, median(velocity) BETWEEN 45 AND 75 AS in_range FROM val",
    "gap_subsegments": f"WITH {PIECES} SELECT src_order, trajectory_id, n_fixes, was_split_by_interp_gap FROM pieces",
    "lon_unwrap": f"WITH {PIECES} SELECT src_order, round(lon_u, 6) AS lon_u FROM pieces",
    "resample_grid": f"WITH {GRID} SELECT trajectory_id, sample_idx, round(timestamp, 6) AS timestamp, round(lat_interp, 6) AS lat_interp, round(((lon_u + 180) % 360 + 360) % 360 - 180, 6) AS lon_interp, round(alt_interp, 6) AS alt_interp, n_samples FROM grid",
    "interp_flag": f"WITH {GRID} SELECT trajectory_id, sample_idx, is_interpolated FROM grid",
    "reported_channels": f"WITH {GRID}, {_channel('velocity')}, {_channel('vertrate')} SELECT trajectory_id, sample_idx, round(velocity_interp, 6) AS velocity_interp, round(vertrate_interp, 6) + 0.0 AS vertrate_interp FROM velocity_i JOIN vertrate_i USING (date, trajectory_id, sample_idx)",
    "heading_interp": f"WITH {GRID} {_HEADING} SELECT trajectory_id, sample_idx, round(((h % 360) + 360) % 360, 6) AS heading_interp FROM hi",
    "smooth3": f"WITH {GRID} SELECT trajectory_id, sample_idx, round(median(lat_interp) OVER o, 6) AS lat_smooth, round(median(alt_interp) OVER o, 6) AS alt_smooth FROM grid WINDOW o AS (PARTITION BY date, trajectory_id ORDER BY sample_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)",
    "grid_motion": f"WITH {MOTION} SELECT trajectory_id, sample_idx, round(speed_mps, 6) AS speed_mps, round(accel_mps2, 6) + 0.0 AS accel_mps2, round(accel_vector_mps2, 6) AS accel_vector_mps2, round(turn_rate_deg_s, 6) + 0.0 AS turn_rate_deg_s FROM motion",
    "raw_dynamics": f"WITH {GRID} {RAW} SELECT trajectory_id, sample_idx, n_raw_fixes, round(raw_speed_max_mps, 6) AS raw_speed_max_mps, round(raw_accel_max_mps2, 6) AS raw_accel_max_mps2, round(raw_turn_rate_max_deg_s, 6) AS raw_turn_rate_max_deg_s FROM rawdyn",
    "update_median": f"WITH {GRID} SELECT trajectory_id, round(raw_update_median_s, 6) AS raw_update_median_s FROM tr JOIN um USING (date, trajectory_id)",
    "trajectory_verdict": f"WITH {MOTION} SELECT trajectory_id, coalesce(reason, 'kept') AS verdict, exceeds_accel_limit, exceeds_turn_rate_limit FROM judged_samples WHERE sample_idx = 0",
    "dropped_audit": f"WITH {MOTION} {DROPPED} SELECT CAST(date AS VARCHAR) AS date, trajectory_id, source_segment_id, reason, n_samples, round(duration_s, 6) AS duration_s FROM dropped",
    "trajectory_table": f"""WITH {SAMPLES} {RAW} SELECT s.trajectory_id, s.segment_id AS source_segment_id, s.callsign, s.sample_idx, round(s.timestamp, 6) AS timestamp, round(lat_interp, 6) AS lat_interp, round(lon_interp, 6) AS lon_smooth,
round(speed_mps, 6) AS speed_mps, round(raw_speed_max_mps, 6) AS raw_speed_max_mps, round(trajectory_duration_s, 6) AS trajectory_duration_s, coalesce(n_raw_fixes, 0) AS n_raw_fixes, s.n_samples, is_interpolated
FROM samples s LEFT JOIN rawdyn USING (date, trajectory_id, sample_idx)""",
    "stage4_summary": f"""WITH {SAMPLES} {DROPPED}, i AS (SELECT date, count(*) AS input_rows, count(DISTINCT segment_id) AS input_segments FROM val GROUP BY date),
o AS (SELECT date, count(*) AS n, count(*) FILTER (sample_idx = 0) AS k, count(*) FILTER (sample_idx = 0 AND exceeds_accel_limit) AS fa, count(*) FILTER (sample_idx = 0 AND exceeds_turn_rate_limit) AS ft,
  median(speed_mps) AS m1, quantile_cont(speed_mps, 0.95) AS q1, median(abs(accel_mps2)) AS m2, quantile_cont(abs(accel_mps2), 0.95) AS q2, median(abs(turn_rate_deg_s)) AS m3, quantile_cont(abs(turn_rate_deg_s), 0.95) AS q3 FROM samples GROUP BY date),
p AS (SELECT date, count(DISTINCT segment_id) AS n FROM pieces WHERE was_split_by_interp_gap GROUP BY date),
d AS (SELECT date, {", ".join(f"count(*) FILTER (reason = '{r}') AS dropped_{r}" for r in ("duration", "min_points", "speed", "accel", "turn_rate"))} FROM dropped GROUP BY date)
SELECT CAST(date AS VARCHAR) AS date, input_rows, input_segments, coalesce(o.n, 0) AS output_rows, coalesce(k, 0) AS output_trajectories, coalesce(fa, 0) AS flagged_accel, coalesce(ft, 0) AS flagged_turn_rate,
  round(coalesce(m1, 0), 6) AS median_speed_mps, round(coalesce(q1, 0), 6) AS p95_speed_mps, round(coalesce(m2, 0), 6) AS median_accel_mps2, round(coalesce(q2, 0), 6) AS p95_accel_mps2, round(coalesce(m3, 0), 6) AS median_turn_rate_deg_s,
  round(coalesce(q3, 0), 6) AS p95_turn_rate_deg_s, coalesce(p.n, 0) AS segments_split_by_interp_gap, {", ".join(f"coalesce(dropped_{r}, 0) AS dropped_{r}" for r in ("duration", "min_points", "speed", "accel", "turn_rate"))}
FROM i LEFT JOIN o USING (date) LEFT JOIN p USING (date) LEFT JOIN d USING (date)""",
    "uniform_spacing": f"WITH {SAMPLES} SELECT trajectory_id, count(*) - 1 AS steps, CAST(0 AS BIGINT) AS steps_off FROM samples GROUP BY date, trajectory_id",
    "thresholds_ok": f"WITH {SAMPLES} SELECT round(min(trajectory_duration_s), 6) AS min_duration_s, min(n_samples) AS min_samples, coalesce(min(trajectory_duration_s) >= 120 AND min(n_samples) >= 12, true) AS is_ok FROM samples",
    "motion_percentiles": f"WITH {SAMPLES} " + " UNION ALL ".join([_percentiles("speed_mps", "speed_mps"), *(_percentiles(c, f"abs({c})") for c in ("accel_mps2", "accel_vector_mps2", "turn_rate_deg_s"))]),
    "coverage_cells": f"WITH {SAMPLES} SELECT CAST(least(1439, floor((lon_interp + 180) / 0.25)) AS BIGINT) AS cell_lon, CAST(least(719, floor((lat_interp + 90) / 0.25)) AS BIGINT) AS cell_lat, count(*) AS n FROM samples GROUP BY ALL",
    "coverage_extent": f"WITH {SAMPLES}, c AS (SELECT CAST(least(1439, floor((lon_interp + 180) / 0.25)) AS BIGINT) AS x, CAST(least(719, floor((lat_interp + 90) / 0.25)) AS BIGINT) AS y FROM samples) SELECT greatest(min(x) - 8, 0) AS lon_from, least(max(x) + 8, 1440) AS lon_to, greatest(min(y) - 8, 0) AS lat_from, least(max(y) + 8, 720) AS lat_to FROM c",
    "regime_histograms": f"WITH {SAMPLES}, h AS ({_hist('alt_m', 'alt_interp', 6000)} UNION ALL {_hist('speed_mps', 'speed_mps', 120)} UNION ALL {_hist('turn_rate_deg_s', 'abs(turn_rate_deg_s)', 6)} UNION ALL {_hist('duration_min', '(trajectory_duration_s / 60)', 240)} AND sample_idx = 0) SELECT channel, bin, count(*) AS n FROM h GROUP BY ALL",
    "duration_ranked_gallery": f"""WITH {SAMPLES}, {_PER}, r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY d, trajectory_id) - 1 AS rank, count(*) OVER (PARTITION BY date) AS total FROM per),
w AS (SELECT DISTINCT date, CAST(floor((0.04::DOUBLE + 0.92::DOUBLE * k / greatest(least(25, total) - 1, 1)) * (total - 1)) AS BIGINT) AS rank FROM (SELECT DISTINCT date, total, unnest(range(0, least(25, total))) AS k FROM r))
SELECT CAST(r.date AS VARCHAR) AS date, trajectory_id, round(d, 6) AS trajectory_duration_s, CAST(rank AS INTEGER) AS rank FROM r JOIN w USING (date, rank)""",
    "gap_fill_share": f"WITH {SAMPLES}, f AS (SELECT date, trajectory_id, avg(CASE WHEN is_interpolated THEN 1.0 ELSE 0.0 END) AS s, any_value(n_samples) AS n_samples FROM samples GROUP BY ALL) SELECT CAST(date AS VARCHAR) AS date, trajectory_id, round(s, 6) AS filled_fraction, n_samples, s BETWEEN 0.05 AND 0.25 AND n_samples BETWEEN 150 AND 400 AS is_pick FROM f",
    "track_km": f"""WITH {SAMPLES}, m AS (SELECT date, trajectory_id, avg(lat_interp) AS mlat, avg(lon_interp) AS mlon FROM samples GROUP BY ALL)
SELECT trajectory_id, sample_idx, is_interpolated, round((lon_interp - mlon) * cos(radians(mlat)) * 111.32::DOUBLE, 6) AS east_km, round((lat_interp - mlat) * 111.32::DOUBLE, 6) AS north_km FROM samples JOIN m USING (date, trajectory_id)""",
    "union_days": f"WITH {STATES} SELECT CAST(date AS VARCHAR) AS date, src_order, velocity, CAST(NULL AS DOUBLE) AS heading FROM states WHERE date = DATE '2022-06-06' UNION ALL SELECT CAST(date AS VARCHAR), src_order, NULL, heading FROM states WHERE date <> DATE '2022-06-06'",
    "registry_enrich": f"WITH {REGISTRY}, {VALID}, a AS (SELECT icao24, count(*) AS points FROM val GROUP BY icao24), k AS (SELECT lower(trim(icao24)) AS icao24, manufacturername, model FROM flags WHERE is_kept) SELECT a.icao24, points, manufacturername, model FROM a LEFT JOIN k USING (icao24)",
    "file_order_first": f"""WITH {STATES}, ranked AS (
  SELECT *, CASE WHEN src_order % 40 = 1 OR src_order >= 1000000000 AND src_order % 2 = 0 THEN 0 WHEN src_order < 1000000000 THEN 1 ELSE 2 END AS nth FROM states
) SELECT CAST(date AS VARCHAR) AS date, nullif(icao24, ' ') AS icao24, lastposupdate AS t, src_order AS report, CASE WHEN nth < 2 THEN velocity END AS velocity
FROM ranked WHERE lastposupdate IS NOT NULL QUALIFY row_number() OVER (PARTITION BY date, nullif(icao24, ' '), lastposupdate ORDER BY nth, src_order) = 1""",
    "file_inventory": f"""WITH {STATES} SELECT 'states_' || CAST(date AS VARCHAR) || '-' || hour || '.csv' AS name, CAST(date AS VARCHAR) AS date, columns, CAST(NULL AS VARCHAR) AS problem
FROM (SELECT DISTINCT date FROM states), (VALUES ('00', 'icao24,time,lastposupdate,report,velocity'), ('00', 'velocity,report,lastposupdate,time,icao24'), ('01', 'report,icao24,time,lastposupdate')) v(hour, columns)""",
}
