"""DuckDB SQL for every registered query: an independent SQL statement of the same rules.

Tables ``events`` etc. are views in the checking DuckDB session. The fixture
expressions are shared text (they define the *input*), and so are plain values
(field names, thresholds, placeholder ids). Every rule -- what white space, a number
and a time are, the checks and the aggregates -- is written here in SQL's own terms.
"""

from __future__ import annotations

from wakeline.config import FIELD_KINDS, FIELDS, NAV_STATUS_STORED_REJECT, PLACEHOLDER_MMSI, DEFAULT_CONFIG
from wakeline.sources.fixture import duckdb_fixture_sql

CFG = DEFAULT_CONFIG
# Code points of Unicode white space, and the four separators below space.
SPACE_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
WS = "||".join(f"chr({c})" for c in SPACE_CODES)
SPACE = "[" + "".join(f"\\x{{{c:X}}}" for c in SPACE_CODES) + "]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _float(t: str) -> str:
    """Sign, digits with at most one point and one of them before or after it, exponent; or a name of no number."""
    digits = f"regexp_full_match({t}, '[-+]?[0-9]+([.][0-9]*)?([eE][-+]?[0-9]+)?')"
    point_first = f"regexp_full_match({t}, '[-+]?[.][0-9]+([eE][-+]?[0-9]+)?')"
    name = f"lower(ltrim({t}, '+-')) IN ('inf', 'infinity', 'nan') AND length({t}) - length(ltrim({t}, '+-')) <= 1"
    return (f"CASE WHEN {digits} OR {point_first} THEN CAST({t} AS DOUBLE) "
            f"WHEN {name} THEN CASE WHEN lower({t}) LIKE '%nan' THEN CAST('nan' AS DOUBLE) "
            f"WHEN starts_with({t}, '-') THEN CAST('-inf' AS DOUBLE) ELSE CAST('inf' AS DOUBLE) END END")


def _int(t: str) -> str:
    return f"TRY_CAST(trunc({_float(t)}) AS BIGINT)"


def _ts(t: str) -> str:
    """Day, month, four-digit year, white space, hour, minute, second; numbers in range, the date a real one."""
    part = lambda k: f"TRY_CAST(regexp_extract({t}, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){SPACE}+([0-9]{{1,2}}):([0-9]{{1,2}}):([0-9]{{1,2}})$', {k}) AS BIGINT)"
    d, m, y, hh, mi, ss = (part(k) for k in range(1, 7))
    leap = f"(({y} % 4 = 0 AND {y} % 100 <> 0) OR {y} % 400 = 0)"
    last = f"CASE WHEN {m} IN (4, 6, 9, 11) THEN 30 WHEN {m} = 2 AND {leap} THEN 29 WHEN {m} = 2 THEN 28 ELSE 31 END"
    return (f"CASE WHEN {y} >= 1 AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND {last} AND {hh} <= 23 AND {mi} <= 59 AND {ss} <= 59 "
            f"THEN make_timestamp({y}, {m}, {d}, {hh}, {mi}, CAST({ss} AS DOUBLE)) END")


_TYPED = {"ts": _ts, "int": _int, "float": _float, "text": lambda t: f"coalesce({t}, '')"}


def _gt(x, c):
    return f"(NOT isnan({x}) AND {x} > {c})"


def _ge(x, c):
    return f"(NOT isnan({x}) AND {x} >= {c})"


def _lt(x, c):
    return f"(NOT isnan({x}) AND {x} < {c})"


def _in_list(vals) -> str:
    return ", ".join(_q(v) for v in vals)


_CHECKS = [
    ("P1_coordinates", "lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0 "
                       f"AND NOT {_gt('abs(lat)', 90)} AND NOT {_gt('abs(lon)', 180)}"),
    ("P2_distance", f"NOT {_gt('dist', CFG.max_distance_nm)} AND NOT {_gt('hav_a', 1)}"),
    ("P3_mmsi_shape", "regexp_full_match(mmsi_text, '[0-9]{9}')"),
    ("P4_mmsi_repeated", "mmsi_text <> repeat(substr(mmsi_text, 1, 1), 9)"),
    ("P5_mmsi_placeholder", f"mmsi_text NOT IN ({_in_list(PLACEHOLDER_MMSI)})"),
    ("P6_nav_status", "nav_status <> '' AND NOT regexp_full_match(nav_status, '(?i)(unknown|undefined|not available)')"),
    ("P7_rot", f"rot IS NOT NULL AND NOT {_lt('rot', -127)} AND NOT {_gt('rot', 127)}"),
    ("P8_sog", f"sog IS NOT NULL AND NOT {_lt('sog', 0)} AND NOT {_ge('sog', 102.3)}"),
    ("P9_cog", f"cog IS NOT NULL AND NOT {_lt('cog', 0)} AND NOT {_ge('cog', 360)}"),
    ("P10_heading", f"heading IS NOT NULL AND NOT {_lt('heading', 0)} AND NOT {_gt('heading', 359)}"),
    ("P11_unparsed_key", "ts IS NOT NULL AND mmsi IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL"),
]

_REASON = "CASE " + " ".join(f"WHEN NOT coalesce({c}, false) THEN {_q(r)}" for r, c in _CHECKS) + " ELSE 'ok' END"

_COUNTED = (
    "mmsi IS NOT NULL AND NOT isnan(lat) AND lat BETWEEN -90 AND 90 AND NOT isnan(lon) AND lon BETWEEN -180 AND 180 "
    f"AND nav_status NOT IN ({_in_list(NAV_STATUS_STORED_REJECT)}) "
    "AND NOT isnan(rot) AND rot BETWEEN -127 AND 127 "
    "AND NOT isnan(sog) AND sog >= 0 AND sog < 102.3 "
    "AND NOT isnan(cog) AND cog >= 0 AND cog < 360 "
    "AND NOT isnan(heading) AND heading BETWEEN 0 AND 359"
)

COLS = ", ".join(["row_id", *FIELDS])

_HAV_A = (f"(power(sin((radians({CFG.centre_lat}) - radians(lat)) / 2), 2) + cos(radians(lat)) * "
          f"cos(radians({CFG.centre_lat})) * power(sin((radians({CFG.centre_lon}) - radians(lon)) / 2), 2))")


def _dist(a: str) -> str:
    return f"({CFG.earth_radius_nm} * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


PRELUDE = f"""WITH src AS (
{duckdb_fixture_sql()}
),
stripped AS (
  SELECT row_id, {", ".join(f"trim({f}, {WS}) AS {f}" for f in FIELDS)} FROM src
),
typed AS (
  SELECT row_id, {", ".join(f"{_TYPED[FIELD_KINDS[f]](f)} AS {f}" for f in FIELDS)},
         coalesce(mmsi, '') AS mmsi_text
  FROM stripped
),
geo AS (
  SELECT *, {_HAV_A} AS hav_a FROM typed
),
checked AS (
  SELECT *, {_dist('hav_a')} AS dist FROM geo
),
reasoned AS (
  SELECT *, {_REASON} AS reason FROM checked
),
raw AS (
  SELECT {COLS} FROM reasoned WHERE reason = 'ok'
),
counted AS (
  SELECT mmsi, count(*) AS n_reports FROM raw WHERE {_COUNTED} GROUP BY mmsi
),
valid AS (
  SELECT mmsi, n_reports FROM counted WHERE n_reports >= {CFG.min_reports}
),
clean AS (
  SELECT {COLS} FROM raw WHERE mmsi IN (SELECT mmsi FROM valid)
),
lagged AS (
  SELECT *, lag(ts) OVER (PARTITION BY mmsi ORDER BY ts, row_id) AS prev_ts FROM clean
),
dt AS (
  SELECT {COLS}, prev_ts, date_diff('millisecond', prev_ts, ts) AS delta_t_ms
  FROM lagged WHERE prev_ts IS NOT NULL
)
"""

_BIN_W = CFG.hist_range_ms // CFG.hist_bins

_BINS = f"""
SELECT b.bin, b.bin_start_ms, b.bin_end_ms, coalesce(c.n, 0) AS n
FROM (SELECT CAST(i AS INTEGER) AS bin, i * {_BIN_W} AS bin_start_ms, (i + 1) * {_BIN_W} AS bin_end_ms
      FROM range({CFG.hist_bins}) t(i)) b
LEFT JOIN (SELECT CAST(least(delta_t_ms // {_BIN_W}, {CFG.hist_bins - 1}) AS INTEGER) AS bin, count(*) AS n
           FROM dt WHERE delta_t_ms BETWEEN 0 AND {CFG.hist_range_ms} GROUP BY 1) c USING (bin)"""

_SUMMARY = f"""
SELECT count(*) AS n_plotted,
       count(*) FILTER (WHERE delta_t_ms <= {CFG.hist_range_ms}) AS n_in_range,
       count(*) FILTER (WHERE delta_t_ms > {CFG.hist_range_ms}) AS n_above_range,
       count(*) FILTER (WHERE delta_t_ms = 0) AS n_zero,
       min(delta_t_ms) AS min_delta_ms, max(delta_t_ms) AS max_delta_ms
FROM dt WHERE delta_t_ms >= 0"""

_REPORT = """
SELECT 'rows_read' AS metric, count(*) AS value FROM src
UNION ALL SELECT 'rows_malformed', 0
UNION ALL SELECT 'rows_inserted_raw', count(*) FROM raw
UNION ALL SELECT 'valid_vessels', count(*) FROM valid
UNION ALL SELECT 'rows_clean', count(*) FROM clean
UNION ALL SELECT 'rows_delta', count(*) FROM dt"""

MERGE_FROM, MERGE_TO = "TIMESTAMP '2026-04-19 00:00:00'", "TIMESTAMP '2026-04-19 00:30:00'"

ORACLE_SQL: dict[str, str] = {
    "ais_csv_scan": f"WITH src AS ({duckdb_fixture_sql()}) SELECT {', '.join(FIELDS)} FROM src",
    "ais_typed_rows": PRELUDE + f"SELECT {COLS} FROM typed",
    "ais_scalar_battery": PRELUDE + f"""
SELECT s.row_id, s.nav_status AS nav_stripped, t.lat AS lat_f, t.mmsi AS mmsi_i, t.ts AS ts_parsed,
       coalesce(regexp_full_match(s.mmsi, '[0-9]{{9}}'), false) AS mmsi_shape_ok,
       coalesce(s.mmsi = repeat(substr(s.mmsi, 1, 1), 9), false) AS mmsi_one_digit,
       lower(s.nav_status) IN ('unknown', 'undefined', 'not available') AS nav_unknown,
       round({_dist('t.hav_a')}, 6) AS dist_nm,
       abs(t.lat) AS abs_lat,
       date_diff('millisecond', TIMESTAMP '2026-04-18 00:00:00', t.ts) AS ms_of_day,
       ((t.mmsi % 3) + 3) % 3 AS mmsi_mod3
FROM stripped s JOIN geo t USING (row_id)""",
    "ais_distance_nm": PRELUDE + f"""
SELECT r.row_id, r.mmsi, r.lat, r.lon, round({_dist('g.hav_a')}, 6) AS distance_nm
FROM raw r JOIN geo g USING (row_id)""",
    "ais_positions_raw": PRELUDE + "SELECT * FROM raw",
    "ais_reject_reasons": PRELUDE + "SELECT reason, count(*) AS n_rows FROM reasoned GROUP BY reason",
    "ais_vessel_counts": PRELUDE + "SELECT * FROM counted",
    "ais_valid_vessels": PRELUDE + "SELECT * FROM valid",
    "ais_positions_clean": PRELUDE + "SELECT * FROM clean",
    "ais_delta_t": PRELUDE + "SELECT * FROM dt",
    "ais_delta_histogram": PRELUDE + _BINS,
    "ais_delta_summary": PRELUDE + _SUMMARY,
    "ais_load_report": PRELUDE + _REPORT,
    "ais_pipeline_tables": PRELUDE + f"""
SELECT 'load_report' AS table_name, metric AS name, value FROM ({_REPORT})
UNION ALL SELECT 'delta_histogram', 'bin_' || lpad(CAST(bin AS VARCHAR), 2, '0'), n FROM ({_BINS})
UNION ALL SELECT 'delta_summary', name, value FROM (UNPIVOT ({_SUMMARY}) ON COLUMNS(*) INTO NAME name VALUE value)""",
    "ais_table_profile": PRELUDE + """
SELECT 'positions_raw' AS table_name, count(*) AS n_rows, count(DISTINCT mmsi) AS n_vessels FROM raw
UNION ALL SELECT 'positions_clean', count(*), count(DISTINCT mmsi) FROM clean
UNION ALL SELECT 'positions_dt', count(*), count(DISTINCT mmsi) FROM dt""",
    "ais_slice_profile": PRELUDE + """
SELECT 'positions_raw' AS table_name, CAST(((mmsi % 3) + 3) % 3 AS INTEGER) AS slice, count(*) AS n_rows FROM raw GROUP BY 2
UNION ALL
SELECT 'positions_clean', CAST(((mmsi % 3) + 3) % 3 AS INTEGER), count(*) FROM clean GROUP BY 2""",
    "ais_layout_profile": PRELUDE + """
SELECT 'positions_raw' AS table_name, CAST(ts AS DATE) AS day, count(*) AS n_rows, count(DISTINCT mmsi) AS n_vessels FROM raw GROUP BY 2
UNION ALL
SELECT 'positions_clean', CAST(ts AS DATE), count(*), count(DISTINCT mmsi) FROM clean GROUP BY 2""",
    "ais_sample_mmsi": PRELUDE + """
SELECT * FROM (SELECT 'positions_raw' AS table_name, mmsi FROM raw WHERE mmsi IS NOT NULL AND mmsi <> 0
               ORDER BY mmsi, ts, row_id LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'positions_clean' AS table_name, mmsi FROM clean WHERE mmsi IS NOT NULL AND mmsi <> 0
               ORDER BY mmsi, ts, row_id LIMIT 10)""",
    "ais_vessel_lookup": PRELUDE + """
SELECT row_id, mmsi, ts FROM clean WHERE mmsi = (SELECT min(mmsi) FROM clean)
ORDER BY ts, row_id LIMIT 5""",
    "events_inter_arrival": """
SELECT event_id, user_id, ts, prev_ts, epoch_us(ts) // 1000 - epoch_us(prev_ts) // 1000 AS delta_ms
FROM (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events)
WHERE prev_ts IS NOT NULL""",
    "ais_stream_ingest": PRELUDE + f"SELECT {', '.join(FIELDS)} FROM raw",
    "ais_append_loads": PRELUDE + f"SELECT {', '.join(FIELDS)}, CAST(1 AS BIGINT) AS n_ids FROM raw",
    "ais_valid_incremental": PRELUDE + f"SELECT {', '.join(FIELDS)} FROM clean",
    "ais_delta_merge": PRELUDE + "SELECT mmsi, ts, prev_ts, delta_t_ms FROM dt",
    "ais_file_profile": PRELUDE + """
SELECT 'positions_raw' AS table_name, CAST(ts AS DATE) AS day, count(*) AS n_rows, true AS has_files, true AS has_bytes
FROM raw GROUP BY 2""",
    "ais_gap_lookup": PRELUDE + f"""
SELECT 'vessel' AS lookup, row_id, mmsi, ts, delta_t_ms FROM dt WHERE mmsi = (SELECT min(mmsi) FROM dt)
UNION ALL SELECT 'time', row_id, mmsi, ts, delta_t_ms FROM dt WHERE ts >= {MERGE_FROM} AND ts < {MERGE_TO}
UNION ALL SELECT 'gap', row_id, mmsi, ts, delta_t_ms FROM dt WHERE delta_t_ms > 900000""",
    "ais_versioned_merge": PRELUDE + f"""
SELECT * REPLACE (CASE WHEN ts < {MERGE_FROM} THEN nav_status WHEN ts < {MERGE_TO} THEN nav_status || ' (new)'
                  ELSE nav_status || ' (kept out)' END AS nav_status) FROM raw""",
    "ais_bucketed_clean": PRELUDE + "SELECT * FROM clean",
    "merge_keep_existing": PRELUDE + f"""
, tgt AS (SELECT * FROM raw WHERE ts < {MERGE_TO}),
new AS (SELECT * REPLACE (nav_status || ' (new)' AS nav_status) FROM raw WHERE ts >= {MERGE_FROM})
SELECT {COLS} FROM tgt
UNION ALL SELECT {COLS} FROM new WHERE row_id NOT IN (SELECT row_id FROM tgt)""",
    "merge_replace": PRELUDE + f"""
, tgt AS (SELECT * FROM raw WHERE ts < {MERGE_TO}),
new AS (SELECT * REPLACE (nav_status || ' (new)' AS nav_status) FROM raw WHERE ts >= {MERGE_FROM})
SELECT {COLS} FROM tgt WHERE row_id NOT IN (SELECT row_id FROM new)
UNION ALL SELECT {COLS} FROM new""",
}
