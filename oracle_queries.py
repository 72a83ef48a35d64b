"""DuckDB oracle SQL for every registered query.

Each string starts with the fixture mapping of FIXTURES.md §3 (the same
text as the Spark mapping in ``pitlane.sources.fixtures``) and then states
the query in plain SQL, in a different form from the Spark plan where one
exists (``rank()`` instead of a join-back, self-join instead of a window).
"""

FIXTURE_CTES = """WITH
base AS (
  SELECT CAST((year(o_orderdate) - 1990) * 100 + CAST(substr(o_orderpriority, 1, 1) AS INT) * 10
              + CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 1 ELSE 2 END AS INT) AS session_id,
         CAST(year(o_orderdate) AS INT) AS year,
         CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS track_key,
         CASE WHEN o_orderstatus = 'P' THEN 'Qualifying' ELSE 'Race' END AS session_type,
         CAST(l_suppkey AS INT) AS driver_id,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY session_id, driver_id
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS INT) AS lap_number
  FROM base
),
timed AS (
  SELECT session_id, year, track_key, session_type, driver_id, lap_number, l_quantity, l_discount,
         CAST(1 + floor((lap_number - 1) / 4.0) AS INT) AS stint_no,
         CASE WHEN l_tax = 0.0 THEN NULL
              ELSE CAST(80000 + (CAST(floor(l_extendedprice) AS INT) % 50) * 97 AS INT) END AS lap_time_ms
  FROM numbered
),
cum AS (
  SELECT *, CASE WHEN lap_time_ms IS NULL THEN NULL
            ELSE CAST(sum(lap_time_ms) OVER (PARTITION BY session_id, driver_id ORDER BY lap_number
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) END AS cum_ms
  FROM timed
),
pos AS MATERIALIZED (
  SELECT *, CASE WHEN l_quantity = 50.0 THEN NULL
            ELSE CAST(row_number() OVER (PARTITION BY session_id, lap_number
                 ORDER BY coalesce(cum_ms, 2000000000), driver_id) AS INT) END AS position
  FROM cum
),
laps AS (
  SELECT session_id, driver_id, lap_number,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE stint_no END AS stint_id,
         CASE (driver_id * 3 + stint_no) % 7 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HARD'
              WHEN 3 THEN 'INTERMEDIATE' WHEN 4 THEN 'WET' WHEN 5 THEN 'UNKNOWN' ELSE NULL END AS compound,
         lap_time_ms,
         CAST(floor(lap_time_ms * 0.25) AS INT) AS sector1_ms,
         CAST(floor(lap_time_ms * 0.5) AS INT) AS sector2_ms,
         CAST(lap_time_ms - floor(lap_time_ms * 0.25) - floor(lap_time_ms * 0.5) AS INT) AS sector3_ms,
         position,
         CASE WHEN l_quantity <= 5.0 THEN NULL ELSE CAST(position * 1371 AS INT) END AS gap_to_leader_ms,
         CASE WHEN l_quantity <= 5.0 THEN NULL ELSE CAST(1371 AS INT) END AS interval_to_next_ms
  FROM pos
),
drivers AS (
  SELECT CAST(s_suppkey AS INT) AS driver_id,
         'D' || CAST(s_suppkey AS VARCHAR(10)) AS driver_code,
         CASE WHEN s_suppkey % 10 = 9 THEN 'Supplier#' || lpad(CAST(s_suppkey - 1 AS VARCHAR(10)), 9, '0') ELSE s_name END AS full_name,
         CASE WHEN s_suppkey % 25 = 24 THEN NULL ELSE n_name END AS team
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
sessions AS (
  SELECT t.session_id, t.year, r_name AS track, t.session_type, CAST(max(t.lap_number) AS INT) AS total_laps
  FROM timed t JOIN region ON r_regionkey = t.track_key
  GROUP BY t.session_id, t.year, r_name, t.session_type
  UNION ALL SELECT 9991, 2002, 'UNRACED', 'Race', 0
),
raw_laps AS MATERIALIZED (
  SELECT session_id, CAST(driver_id AS BIGINT) * 1000000 + lap_number AS seq,
         CASE WHEN driver_id % 20 = 7 THEN 'X' ELSE 'D' END || CAST(driver_id AS VARCHAR(10)) AS driver,
         CAST(lap_number AS DOUBLE) AS lap_number,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE CAST(stint_no AS DOUBLE) END AS stint,
         CASE (driver_id * 3 + stint_no) % 7 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HARD'
              WHEN 3 THEN 'INTERMEDIATE' WHEN 4 THEN 'WET' WHEN 5 THEN 'UNKNOWN' ELSE NULL END AS compound,
         CAST(lap_time_ms AS BIGINT) * 1000 + (CAST(l_quantity AS INT) % 2) * 600 AS lap_time_us,
         CAST(floor(lap_time_ms * 0.25) AS BIGINT) * 1000 AS sector1_us,
         CAST(floor(lap_time_ms * 0.5) AS BIGINT) * 1000 AS sector2_us,
         CAST(lap_time_ms - floor(lap_time_ms * 0.25) - floor(lap_time_ms * 0.5) AS BIGINT) * 1000 AS sector3_us,
         CAST(position AS DOUBLE) AS position,
         CASE WHEN l_quantity <= 5.0 THEN CAST(l_quantity AS BIGINT) * 1371000 ELSE NULL END AS gap_to_leader_us,
         CASE WHEN l_quantity <= 3.0 THEN CAST(l_quantity AS BIGINT) * 137000 ELSE NULL END AS interval_to_ahead_us,
         CASE WHEN lap_number % 4 = 0 THEN CAST(lap_number AS BIGINT) * 90000000 ELSE NULL END AS pit_in_us,
         CASE WHEN lap_number % 8 = 0 AND l_quantity > 45.0 THEN CAST(lap_number AS BIGINT) * 90000000 - 60000000
              WHEN lap_number % 4 = 1 AND lap_number > 1 THEN CAST(lap_number - 1 AS BIGINT) * 90000000 + 20000000 + CAST(l_quantity AS BIGINT) * 100000
              ELSE NULL END AS pit_out_us
  FROM pos
),
raw_results AS (
  SELECT DISTINCT p.session_id,
         CASE WHEN p.driver_id % 20 = 7 THEN '' ELSE ' D' || CAST(p.driver_id AS VARCHAR(10)) || ' ' END AS abbreviation,
         CASE WHEN p.driver_id % 10 = 3 THEN NULL ELSE d.full_name END AS full_name,
         CASE WHEN p.driver_id % 25 = 24 THEN '' ELSE d.team END AS team_name,
         'Team ' || CAST(p.driver_id % 5 AS VARCHAR(10)) AS team
  FROM pos p JOIN drivers d ON d.driver_id = p.driver_id
),
schedule AS (
  SELECT CAST(year(o_orderdate) AS INT) AS year, r_name AS event_name, max(o_orderdate) AS event_date
  FROM orders JOIN region ON r_regionkey = CAST(substr(o_orderpriority, 1, 1) AS INT) - 1
  GROUP BY CAST(year(o_orderdate) AS INT), r_name
)
"""


def with_fixture(sql: str) -> str:
    """Prefix ``sql`` (a SELECT, optionally starting with extra CTEs after a comma) with the mapping."""
    sql = sql.strip()
    if sql.startswith(","):
        return FIXTURE_CTES + sql
    return FIXTURE_CTES + "\n" + sql


# ---- views: cars reduced by id first, then named ------------------------------
#
# A view's group is a set of (session, car id, stint, tyre) groups with equal names. So the laps of the races
# are reduced per id to counts, sums and extremes, and what has the same name is merged.

_PARTS = """,
races AS (SELECT session_id, year, track, session_type FROM sessions WHERE session_type = 'Race'),
parts AS MATERIALIZED (
  SELECT session_id, driver_id, stint_id, compound, lap_time_ms IS NOT NULL AS timed,
         count(*) AS n, count(lap_number) AS numbered, min(lap_number) AS lap_lo, max(lap_number) AS lap_hi,
         sum(lap_time_ms) AS ms, min(lap_time_ms) AS ms_lo, max(lap_time_ms) AS ms_hi,
         sum(gap_to_leader_ms) AS gap, count(gap_to_leader_ms) AS gaps
  FROM laps WHERE session_id IN (SELECT session_id FROM races)
  GROUP BY ALL
),
named AS (
  SELECT parts.*, full_name, team, year, track, session_type
  FROM parts, drivers, races
  WHERE parts.driver_id = drivers.driver_id AND parts.session_id = races.session_id
)"""
_LAPS, _NUMBERED = "CAST(sum(n) AS BIGINT)", "CAST(sum(numbered) AS BIGINT)"
_MEAN_MS, _MEAN_GAP = "sum(ms) / nullif(sum(n) FILTER (timed), 0)", "sum(gap) / sum(gaps)"


def _merged(keys: str, only: str = "TRUE", **measures: str) -> str:
    """The named parts that a view counts, merged by its keys."""
    columns = ", ".join(f"{what} AS {name}" for name, what in measures.items())
    return f"{_PARTS}\nSELECT {keys}, {columns} FROM named WHERE {only} GROUP BY ALL"


_A = "full_name, session_id"
_B = "year, track, session_type, full_name AS driver"

VIEWS_A = {
    "va1_avg_gap_to_leader": _merged(_A, "gaps > 0", avg_gap_ms=_MEAN_GAP),
    "va2_best_laps": _merged(_A, best_lap_ms="min(ms_lo)"),
    "va3_driver_avg_by_compound": _merged(f"{_A}, compound", avg_lap_time_ms=_MEAN_MS),
    "va4_driver_avg_laptime": _merged(_A, avg_lap_time_ms=_MEAN_MS),
    # A session that nobody drove is there with no driver and, as its NULL row is counted, one lap.
    "va5_session_summary": _PARTS + """,
entered AS (SELECT session_id, count(*) AS cars, sum(n) AS n FROM (SELECT session_id, driver_id, sum(n) AS n FROM parts GROUP BY ALL) GROUP BY session_id)
SELECT session_id, year, track, coalesce(cars, 0) AS drivers_count, CAST(coalesce(n, 1) AS BIGINT) AS total_laps
FROM races LEFT JOIN entered USING (session_id)""",
    "va6_stint_summary": _merged(f"{_A}, stint_id, compound", laps_in_stint=_LAPS, avg_stint_lap_ms=_MEAN_MS),
    "va7_tyre_degradation": _merged(
        f"{_A}, stint_id, compound", "timed", degradation_ms_per_lap="(max(ms_hi) - min(ms_lo)) / nullif(max(lap_hi) - min(lap_lo), 0)",
        laps_in_stint=_LAPS, stint_start_lap="min(lap_lo)", stint_end_lap="max(lap_hi)",
    ),
}

_EXTREMES = {"best_lap_time_ms": "min(ms_lo)", "worst_lap_time_ms": "max(ms_hi)", "stint_start_lap": "min(lap_lo)", "stint_end_lap": "max(lap_hi)"}
_ROUNDED = f"round({_MEAN_MS}, 2)"

VIEWS_B = {
    "vb1_driver_avg_by_compound": _merged(f"{_B}, compound", "timed", avg_lap_time_ms=_ROUNDED),
    "vb2_driver_avg_laptime": _merged(f"{_B}, team", "timed", avg_lap_time_ms=_ROUNDED),
    "vb3_stint_summary": _merged(
        f"{_B}, stint_id, compound", "timed AND stint_id IS NOT NULL", total_laps=_NUMBERED, avg_lap_time_ms=_ROUNDED, **_EXTREMES),
    "vb4_tyre_degradation": _merged(f"{_B}, compound, stint_id", "timed", laps_in_stint=_LAPS, avg_lap_time_ms=_ROUNDED, **_EXTREMES),
    "vb6_avg_gap_to_leader": _merged(_B, "gaps > 0", avg_gap_to_leader_ms=f"round({_MEAN_GAP}, 2)"),
    "vb7_session_summary": _merged(_B, "timed", total_laps=_NUMBERED, best_lap_time_ms="min(ms_lo)", avg_lap_time_ms=_ROUNDED),
    "vb5_best_laps": """
SELECT year, track, session_type, driver, best_lap_time_ms, best_lap_compound, best_lap_number
FROM (
    SELECT s.year, s.track, s.session_type, d.full_name AS driver, l.lap_time_ms AS best_lap_time_ms,
           l.compound AS best_lap_compound, l.lap_number AS best_lap_number,
           rank() OVER (PARTITION BY l.session_id, l.driver_id ORDER BY l.lap_time_ms) AS rk
    FROM laps l JOIN sessions s ON l.session_id = s.session_id JOIN drivers d ON d.driver_id = l.driver_id
    WHERE l.lap_time_ms IS NOT NULL AND s.session_type = 'Race'
) WHERE rk = 1""",
    "vb8_pitstops": """
SELECT year, track, session_type, driver, pit_lap, new_compound, stint_id
FROM (
    SELECT s.year, s.track, s.session_type, d.full_name AS driver, l.lap_number AS pit_lap,
           l.compound AS new_compound, l.stint_id,
           rank() OVER (PARTITION BY l.session_id, l.driver_id, l.stint_id ORDER BY l.lap_number) AS rk
    FROM laps l JOIN sessions s ON l.session_id = s.session_id JOIN drivers d ON d.driver_id = l.driver_id
    WHERE l.stint_id IS NOT NULL AND l.lap_number IS NOT NULL AND s.session_type = 'Race'
) WHERE rk = 1""",
}


# ---- timing (self-joins where Spark uses windows) ---------------------------

_CUM = """,
rcum AS MATERIALIZED (
  SELECT a.session_id, a.driver, a.lap_number, a.position, a.gap_to_leader_us, a.interval_to_ahead_us,
         CASE WHEN a.lap_time_us IS NULL THEN NULL
              ELSE CAST(round_even(CAST(sum(b.lap_time_us) AS DOUBLE) / 1000, 0) AS BIGINT) END AS cum_ms
  FROM raw_laps a
  JOIN raw_laps b ON b.session_id = a.session_id AND b.driver = a.driver AND b.lap_number <= a.lap_number
  GROUP BY a.session_id, a.driver, a.lap_number, a.position, a.gap_to_leader_us, a.interval_to_ahead_us, a.lap_time_us
),
rleader AS (
  SELECT session_id, lap_number, cum_ms AS leader_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id, lap_number ORDER BY driver) AS rn
    FROM rcum WHERE position = 1) WHERE rn = 1
),
rahead AS (
  SELECT session_id, lap_number, position, cum_ms AS ahead_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id, lap_number, position ORDER BY driver) AS rn
    FROM rcum WHERE position IS NOT NULL) WHERE rn = 1
),
rgaps AS (
  SELECT c.session_id, c.driver, c.lap_number, c.position, c.cum_ms,
         CAST(CASE WHEN c.gap_to_leader_us IS NOT NULL THEN round_even(c.gap_to_leader_us / 1000.0, 0)
                   ELSE c.cum_ms - ld.leader_ms END AS BIGINT) AS gap_to_leader_ms,
         CAST(CASE WHEN c.interval_to_ahead_us IS NOT NULL THEN round_even(c.interval_to_ahead_us / 1000.0, 0)
                   ELSE c.cum_ms - ah.ahead_ms END AS BIGINT) AS interval_to_next_ms
  FROM rcum c
  LEFT JOIN rleader ld ON ld.session_id = c.session_id AND ld.lap_number = c.lap_number
  LEFT JOIN rahead ah ON ah.session_id = c.session_id AND ah.lap_number = c.lap_number
                    AND ah.position = c.position - 1
)
"""


def _ms_round(c: str) -> str:
    return f"CAST(round_even({c} / 1000.0, 0) AS INT)"


def _ms_trunc(c: str) -> str:
    return f"CAST(trunc({c} / 1000.0) AS INT)"


_N2_BODY = f"""
SELECT r.session_id, d.driver_id, CAST(r.lap_number AS INT) AS lap_number, CAST(r.stint AS INT) AS stint_id,
       r.compound, {_ms_round('r.lap_time_us')} AS lap_time_ms, {_ms_round('r.sector1_us')} AS sector1_ms,
       {_ms_round('r.sector2_us')} AS sector2_ms, {_ms_round('r.sector3_us')} AS sector3_ms,
       CAST(r.position AS INT) AS position, CAST(g.gap_to_leader_ms AS INT) AS gap_to_leader_ms,
       CAST(g.interval_to_next_ms AS INT) AS interval_to_next_ms
FROM raw_laps r
JOIN rgaps g ON g.session_id = r.session_id AND g.driver = r.driver AND g.lap_number = r.lap_number
JOIN drivers d ON d.driver_code = r.driver AND d.driver_id <> 0"""

_W4_BODY = """
SELECT p.session_id, d.driver_id, CAST(p.lap_number AS INT) AS lap_number,
       p.compound AS compound_in, n.compound AS compound_out,
       CAST(round_even((coalesce(p.pit_out_us, n.pit_out_us) - p.pit_in_us) / 1000.0, 0) AS BIGINT) AS stop_time_ms
FROM raw_laps p
JOIN drivers d ON d.driver_code = p.driver AND d.driver_id <> 0
LEFT JOIN raw_laps n ON n.session_id = p.session_id AND n.driver = p.driver AND n.lap_number = p.lap_number + 1
WHERE p.pit_in_us IS NOT NULL"""

TIMING = {
    "w1_cumulative_time": _CUM + "SELECT session_id, driver, lap_number, cum_ms FROM rcum",
    "w2_w3_gaps": _CUM + "SELECT * FROM rgaps",
    # Materialised, so that a statement around it cannot unfold it again.
    "w4_n3_pitstops": ",\nw4 AS MATERIALIZED (" + _W4_BODY + ")\nSELECT * FROM w4",
    "n1_laps_simple": f"""
SELECT r.session_id, d.driver_id, CAST(r.lap_number AS INT) AS lap_number, CAST(r.stint AS INT) AS stint_id,
       r.compound, {_ms_trunc('r.lap_time_us')} AS lap_time_ms, {_ms_trunc('r.sector1_us')} AS sector1_ms,
       {_ms_trunc('r.sector2_us')} AS sector2_ms, {_ms_trunc('r.sector3_us')} AS sector3_ms,
       CAST(r.position AS INT) AS position, {_ms_trunc('r.gap_to_leader_us')} AS gap_to_leader_ms,
       {_ms_trunc('r.interval_to_ahead_us')} AS interval_to_next_ms
FROM raw_laps r JOIN drivers d ON d.driver_code = r.driver AND d.driver_id <> 0""",
    "n2_laps_full": _CUM + ",\nn2 AS (" + _N2_BODY + ")\nSELECT * FROM n2",
    "f10_rejected_laps": """
SELECT r.* FROM raw_laps r
WHERE NOT EXISTS (SELECT 1 FROM drivers d WHERE d.driver_code = r.driver AND d.driver_id <> 0)""",
}


# ---- upserts, keys and integrity --------------------------------------------

_CLEAN_RESULTS = """,
res AS (
  SELECT session_id,
         trim(coalesce(nullif(abbreviation, ''), '')) AS driver_code,
         trim(coalesce(nullif(full_name, ''), nullif(trim(coalesce(nullif(abbreviation, ''), '')), ''), '')) AS full_name,
         trim(coalesce(nullif(team_name, ''), '')) AS team,
         trim(coalesce(nullif(team_name, ''), nullif(team, ''), '')) AS team_any
  FROM raw_results
)
"""

INGEST = {
    "u1_upsert_sessions": """,
old AS (SELECT session_id, year, track, session_type, total_laps - 1 AS total_laps FROM sessions WHERE year <> 1995),
upd AS (
  SELECT s.year, s.track, s.session_type,
         CAST(coalesce(nullif(max(CAST(r.lap_number AS INT)), 0), 0) AS INT) AS total_laps
  FROM raw_laps r JOIN sessions s ON s.session_id = r.session_id
  GROUP BY s.year, s.track, s.session_type
)
SELECT s.session_id, s.year, s.track, s.session_type,
       CASE WHEN u.year IS NULL THEN s.total_laps ELSE u.total_laps END AS total_laps,
       '{}' AS weather, 0 AS safety_car_count
FROM old s
LEFT JOIN upd u ON u.year = s.year AND u.track = s.track AND u.session_type = s.session_type
UNION ALL
SELECT CAST((SELECT max(session_id) FROM old) + row_number() OVER (ORDER BY year, track, session_type) AS INT),
       year, track, session_type, total_laps, '{}', 0
FROM upd WHERE year = 1995""",
    "u2_upsert_drivers": _CLEAN_RESULTS + """,
old AS (SELECT * FROM drivers WHERE driver_id % 7 <> 3),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY driver_code ORDER BY session_id DESC, full_name DESC, team DESC) AS rn
    FROM res WHERE driver_code <> '') WHERE rn = 1
)
SELECT d.driver_id, d.driver_code,
       CASE WHEN u.driver_code IS NULL THEN d.full_name ELSE u.full_name END AS full_name,
       CASE WHEN u.driver_code IS NULL THEN d.team ELSE u.team END AS team
FROM old d LEFT JOIN latest u ON u.driver_code = d.driver_code
UNION ALL
SELECT CAST((SELECT max(driver_id) FROM old) + row_number() OVER (ORDER BY u.driver_code) AS INT),
       u.driver_code, u.full_name, u.team
FROM latest u WHERE u.driver_code NOT IN (SELECT driver_code FROM old)""",
    "u3_insert_teams": _CLEAN_RESULTS + """
SELECT trim(team) AS team_name FROM drivers WHERE trim(coalesce(team, '')) <> ''
UNION
SELECT team_any FROM res WHERE team_any <> ''""",
    "u4_upsert_laps": _CUM + ",\nn2 AS MATERIALIZED (" + _N2_BODY + """)
SELECT * FROM n2
UNION ALL
SELECT l.* REPLACE (CASE WHEN lap_number % 3 = 0 THEN 'OLD' ELSE compound END AS compound) FROM laps l
WHERE l.lap_number % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM n2 WHERE n2.session_id = l.session_id AND n2.driver_id = l.driver_id
                                      AND n2.lap_number = l.lap_number)""",
    "u5_upsert_pitstops": ",\nw4 AS MATERIALIZED (" + _W4_BODY + """)
SELECT * FROM w4
UNION ALL
SELECT session_id, driver_id, lap_number + 1000, compound_in, compound_out, stop_time_ms
FROM w4 WHERE lap_number % 3 = 0""",
    "u6_surrogate_keys": """
SELECT CAST((SELECT max(driver_id) FROM drivers) + row_number() OVER (ORDER BY driver) AS INT) AS driver_id,
       driver AS driver_code
FROM (SELECT DISTINCT driver FROM raw_laps WHERE driver NOT IN (SELECT driver_code FROM drivers))""",
    "q1_duplicate_keys": _CLEAN_RESULTS + """
SELECT session_id, driver_code, count(*) AS row_count
FROM res GROUP BY session_id, driver_code HAVING count(*) > 1""",
    "q2_orphans": """
SELECT l.* FROM laps l
WHERE l.session_id NOT IN (SELECT session_id FROM sessions WHERE session_type = 'Race')""",
    "q3_cascade_delete": """
SELECT l.* FROM laps l
WHERE l.session_id NOT IN (SELECT session_id FROM sessions WHERE session_type = 'Qualifying')""",
    "q4_null_report": """
SELECT 'sessions' AS table_name, 'year' AS column_name, count(*) - count(year) AS null_count FROM sessions
UNION ALL SELECT 'sessions', 'track', count(*) - count(track) FROM sessions
UNION ALL SELECT 'sessions', 'session_type', count(*) - count(session_type) FROM sessions
UNION ALL SELECT 'drivers', 'driver_code', count(*) - count(driver_code) FROM drivers
UNION ALL SELECT 'drivers', 'full_name', count(*) - count(full_name) FROM drivers
UNION ALL SELECT 'laps', 'session_id', count(*) - count(session_id) FROM laps
UNION ALL SELECT 'laps', 'driver_id', count(*) - count(driver_id) FROM laps
UNION ALL SELECT 'raw_results', 'abbreviation', count(*) - count(abbreviation) FROM raw_results
UNION ALL SELECT 'raw_results', 'full_name', count(*) - count(full_name) FROM raw_results
UNION ALL SELECT 'raw_results', 'team_name', count(*) - count(team_name) FROM raw_results""",
    "s8_missing_sessions": """
SELECT s.* FROM sessions s
WHERE NOT EXISTS (SELECT 1 FROM raw_laps r WHERE r.session_id = s.session_id)""",
    "s10_ingest_audit": _CUM + ",\nn2 AS (" + _N2_BODY + "),\nw4 AS (" + _W4_BODY + """)
SELECT f.session_id, f.laps_found,
       coalesce(w.laps_written, 0) AS laps_written, coalesce(w.drivers_written, 0) AS drivers_written,
       coalesce(p.pitstops_written, 0) AS pitstops_written
FROM (SELECT session_id, count(*) AS laps_found FROM raw_laps GROUP BY session_id) f
LEFT JOIN (SELECT session_id, count(*) AS laps_written, count(DISTINCT driver_id) AS drivers_written
           FROM n2 GROUP BY session_id) w ON w.session_id = f.session_id
LEFT JOIN (SELECT session_id, count(*) AS pitstops_written FROM w4 GROUP BY session_id) p
       ON p.session_id = f.session_id""",
    "l3_latest_event": """
SELECT year, event_name, event_date FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY event_date DESC, event_name DESC) AS rn
  FROM schedule WHERE CAST(event_date AS DATE) <= DATE '2001-07-15') WHERE rn = 1""",
}

# ---- strategy chart data ----------------------------------------------------

_BOUNDS = """,
sb AS (
  SELECT d.full_name, s.session_id, l.stint_id, l.compound,
         min(l.lap_number) AS stint_start_lap, max(l.lap_number) AS stint_end_lap
  FROM laps l JOIN drivers d ON l.driver_id = d.driver_id JOIN sessions s ON l.session_id = s.session_id
  WHERE s.session_type = 'Race'
  GROUP BY d.full_name, s.session_id, l.stint_id, l.compound
),
sbr AS (
  SELECT sb.*, CAST(dense_rank() OVER (PARTITION BY session_id ORDER BY full_name DESC) - 1 AS INT) AS driver_row
  FROM sb
)
"""

STRATEGY = {
    "g1_strategy_bars": _BOUNDS + """
SELECT session_id, full_name, driver_row, compound, stint_id, stint_start_lap,
       stint_end_lap - stint_start_lap AS width,
       CASE compound WHEN 'HARD' THEN '#D9D9D9' WHEN 'MEDIUM' THEN 'yellow' WHEN 'SOFT' THEN 'red'
                     WHEN 'INTERMEDIATE' THEN 'green' WHEN 'WET' THEN 'blue' ELSE 'grey' END AS colour
FROM sbr""",
    "g2_strategy_pit_markers": _BOUNDS + """
SELECT b.session_id, b.full_name, b.driver_row, b.stint_id, b.stint_end_lap AS pit_lap
FROM sbr b JOIN sessions s ON s.session_id = b.session_id
WHERE b.stint_end_lap < s.total_laps""",
    "g3_strategy_total_pitstops": _BOUNDS + """
SELECT b.session_id, count(CASE WHEN b.stint_end_lap < s.total_laps THEN 1 END) AS total_pitstops
FROM sb b JOIN sessions s ON s.session_id = b.session_id
GROUP BY b.session_id""",
    "g4_strategy_header": """
SELECT session_id, track, year, session_type, total_laps,
       track || ' – Pit Stop Strategy' AS title,
       CAST(year AS VARCHAR) || ' ' || session_type AS subtitle,
       'Lap ' || CAST(total_laps AS VARCHAR) AS final_lap_label
FROM sessions""",
}

# ---- outliers and standardisation -------------------------------------------

QUALITY = {
    "x1_outlier_filter": """,
fence AS (
  SELECT session_id, compound,
         quantile_cont(lap_time_ms, 0.25) AS q1, quantile_cont(lap_time_ms, 0.75) AS q3
  FROM laps WHERE lap_time_ms IS NOT NULL GROUP BY session_id, compound
)
SELECT l.* FROM laps l
JOIN fence f ON f.session_id = l.session_id AND f.compound IS NOT DISTINCT FROM l.compound
WHERE l.lap_time_ms BETWEEN f.q1 - 1.5 * (f.q3 - f.q1) AND f.q3 + 1.5 * (f.q3 - f.q1)""",
    "x2_standardise": """,
st AS (
  SELECT session_id, avg(lap_time_ms) AS m, stddev_samp(lap_time_ms) AS sd
  FROM laps WHERE lap_time_ms IS NOT NULL GROUP BY session_id
)
SELECT l.session_id, l.driver_id, l.lap_number, upper(trim(l.compound)) AS compound, l.lap_time_ms,
       (l.lap_time_ms - st.m) / nullif(st.sd, 0) AS lap_time_ms_z
FROM laps l LEFT JOIN st ON st.session_id = l.session_id""",
}

# ---- more single operators ----------------------------------------------------

MORE = {
    "s2_driver_results": _CLEAN_RESULTS + """
SELECT session_id, driver_code, full_name, team FROM res WHERE driver_code <> ''""",
    "u7_session_ids": """,
upd AS (
  SELECT s.year, s.track, s.session_type,
         CAST(coalesce(nullif(max(CAST(r.lap_number AS INT)), 0), 0) AS INT) AS total_laps
  FROM raw_laps r JOIN sessions s ON s.session_id = r.session_id
  GROUP BY s.year, s.track, s.session_type
)
SELECT u.year, u.track, u.session_type, u.total_laps, s.session_id
FROM upd u JOIN sessions s ON s.year = u.year AND s.track = u.track AND s.session_type = u.session_type""",
    "w5_driver_rows": _BOUNDS + """
SELECT DISTINCT session_id, full_name, driver_row FROM sbr""",
    "l4_first_timed_lap": """
SELECT session_id, driver_id, lap_number, stint_id, compound, lap_time_ms, sector1_ms, sector2_ms, sector3_ms,
       position, gap_to_leader_ms, interval_to_next_ms
FROM (SELECT *, row_number() OVER (PARTITION BY session_id, driver_id ORDER BY lap_number) AS rn
      FROM laps WHERE lap_time_ms IS NOT NULL) WHERE rn = 1""",
    "f6_past_events": """
SELECT year, event_name, event_date FROM schedule WHERE CAST(event_date AS DATE) <= DATE '2001-07-15'""",
}

# ---- landing, write paths and the whole ingest ---------------------------------

_RAW_COLS = """r.seq, r.driver, r.lap_number, r.stint, r.compound, r.lap_time_us, r.sector1_us, r.sector2_us,
       r.sector3_us, r.position, r.gap_to_leader_us, r.interval_to_ahead_us, r.pit_in_us, r.pit_out_us"""

LANDING = {
    "s1_landed_laps": f"""
SELECT s.year, 'GP ' || s.track AS event_name, s.track AS official_event_name, s.session_type AS session_name, {_RAW_COLS}
FROM raw_laps r JOIN sessions s ON s.session_id = r.session_id
WHERE s.year = 1995 AND s.track = 'ASIA' AND s.session_type = 'Race'""",
    "s2_read_results": "SELECT * FROM raw_results WHERE session_id IN (521, 631)",
    "s3_read_schedule": "SELECT * FROM schedule WHERE year = 1996",
    "s5_write_table": "SELECT * FROM sessions",
    "s6_s7_init_tables": """,
n AS (SELECT 'sessions' AS table_name, count(*) AS n FROM sessions
      UNION ALL SELECT 'drivers', count(*) FROM drivers UNION ALL SELECT 'laps', count(*) FROM laps)
SELECT table_name, 'kept' AS step, n FROM n
UNION ALL SELECT table_name, 'created', 0 FROM n UNION ALL SELECT table_name, 'replaced', 0 FROM n""",
    "f5_one_session": """
SELECT d.full_name, s.session_id, l.stint_id, l.compound,
       min(l.lap_number) AS stint_start_lap, max(l.lap_number) AS stint_end_lap
FROM laps l JOIN drivers d ON l.driver_id = d.driver_id JOIN sessions s ON l.session_id = s.session_id
WHERE s.session_type = 'Race' AND l.session_id = 521
GROUP BY d.full_name, s.session_id, l.stint_id, l.compound""",
    "c1_text_durations": """
SELECT session_id, seq, CASE WHEN seq % 4 = 3 THEN NULL ELSE lap_time_us END AS lap_time_us
FROM raw_laps WHERE lap_time_us IS NOT NULL""",
    "c8_event_names": """
SELECT year, track, session_type, total_laps FROM sessions WHERE session_id <> 9991""",
    # Ids are given in the order of the natural keys, names are the latest session's.
    "x3_run_ingest": _CLEAN_RESULTS + """,
latest AS (
  SELECT driver_code, full_name FROM (
    SELECT *, row_number() OVER (PARTITION BY driver_code ORDER BY session_id DESC, full_name DESC, team DESC) AS rn
    FROM res WHERE driver_code <> '') WHERE rn = 1
),
ids AS (
  SELECT session_id, session_type, CAST(row_number() OVER (ORDER BY year, track, session_type) AS INT) AS new_id
  FROM sessions WHERE session_id <> 9991
)
SELECT d.full_name, i.new_id AS session_id, avg(CAST(round_even(r.lap_time_us / 1000.0, 0) AS INT)) AS avg_lap_time_ms
FROM raw_laps r JOIN latest d ON d.driver_code = r.driver JOIN ids i ON i.session_id = r.session_id
WHERE i.session_type = 'Race'
GROUP BY d.full_name, i.new_id""",
}

# ---- X5: weather and stops (as-of join and all pairs where Spark cuts time into buckets) ----

_WEATHER = """,
weather AS (
  SELECT CAST((user_id % 7 + 2) * 100 + (user_id // 7 % 5 + 1) * 10 + CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS INT) AS session_id,
         CASE WHEN event_id % 50 <> 0 THEN epoch_us(ts) // 10000000 % 100 * 10000 + 100000 END AS at_ms,
         event_id AS sample, value AS track_temp, event_type = 'purchase' AS rainfall,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS wind
  FROM events
)"""
_LAP_WEATHER = _CUM + _WEATHER + """,
latest AS (
  SELECT session_id, at_ms, max_by(sample, sample) AS sample, arg_max(track_temp, sample) AS track_temp,
         arg_max(rainfall, sample) AS rainfall, arg_max(wind, sample) AS wind
  FROM weather WHERE at_ms IS NOT NULL GROUP BY session_id, at_ms
),
lap_weather AS MATERIALIZED (
  SELECT r.session_id, r.driver, r.lap_number, r.stint, r.compound, r.lap_time_us, c.cum_ms, w.at_ms, w.sample, w.track_temp, w.rainfall, w.wind
  FROM raw_laps r JOIN rcum c ON c.session_id = r.session_id AND c.driver = r.driver AND c.lap_number = r.lap_number
  ASOF LEFT JOIN latest w ON w.session_id = c.session_id AND w.at_ms <= c.cum_ms
)"""
_STOPS = _CUM + """,
stops AS MATERIALIZED (
  SELECT p.session_id, p.driver, CAST(p.lap_number AS INT) AS lap_number, CAST(p.position AS INT) AS position, c.cum_ms AS from_ms,
         c.cum_ms + CAST(round_even((coalesce(p.pit_out_us, n.pit_out_us) - p.pit_in_us) / 1000.0, 0) AS BIGINT) AS to_ms
  FROM raw_laps p JOIN rcum c ON c.session_id = p.session_id AND c.driver = p.driver AND c.lap_number = p.lap_number
  LEFT JOIN raw_laps n ON n.session_id = p.session_id AND n.driver = p.driver AND n.lap_number = p.lap_number + 1
  WHERE p.pit_in_us IS NOT NULL
)"""

RACE = {
    "x5_lap_weather": _LAP_WEATHER + "\nSELECT * FROM lap_weather",
    "x5_weather_pace": _LAP_WEATHER + """
SELECT session_id, compound, rainfall, count(*) AS laps, avg(lap_time_us) AS avg_lap_us, max(wind) AS max_wind
FROM lap_weather WHERE at_ms IS NOT NULL AND lap_time_us IS NOT NULL GROUP BY ALL""",
    "x5_pit_traffic": _STOPS + """
SELECT a.*, CASE WHEN a.to_ms > a.from_ms THEN (SELECT count(*) FROM stops b WHERE b.session_id = a.session_id AND b.to_ms > b.from_ms
    AND b.from_ms < a.to_ms AND a.from_ms < b.to_ms) - 1 END AS others
FROM stops a""",
    "x5_pit_battles": _STOPS + """
SELECT b.session_id, b.position - 1 AS place, b.driver AS behind, b.lap_number AS behind_lap, a.driver AS ahead, a.lap_number AS ahead_lap,
       CASE WHEN b.from_ms < a.from_ms THEN 'undercut' WHEN b.from_ms > a.from_ms THEN 'overcut' ELSE 'together' END AS kind,
       greatest(least(a.to_ms, b.to_ms) - greatest(a.from_ms, b.from_ms), 0) AS both_in_ms, y.position < x.position AS gained
FROM stops b JOIN stops a ON a.session_id = b.session_id AND a.position = b.position - 1
  AND a.from_ms < a.to_ms AND b.from_ms < b.to_ms AND a.from_ms < b.to_ms + 30000 AND b.from_ms < a.to_ms + 30000
LEFT JOIN raw_laps x ON x.session_id = a.session_id AND x.driver = a.driver AND x.lap_number = greatest(a.lap_number, b.lap_number) + 1
LEFT JOIN raw_laps y ON y.session_id = b.session_id AND y.driver = b.driver AND y.lap_number = greatest(a.lap_number, b.lap_number) + 1""",
}

VARIANT = {
    "c17_weather_variant": _WEATHER + """,
per AS (SELECT session_id, count(*) AS samples, min(track_temp) AS track_min, max(track_temp) AS track_max, bool_or(rainfall) AS wet
        FROM weather WHERE session_id % 7 <> 0 GROUP BY session_id)
SELECT s.session_id, CAST(p.samples AS INT) AS samples, p.track_min, p.track_max, p.wet
FROM sessions s LEFT JOIN per p ON p.session_id = s.session_id""",
    "q4_malformed_weather": _WEATHER + """
SELECT 'sessions' AS table_name, 'weather' AS column_name, count(DISTINCT w.session_id) AS malformed_count
FROM weather w JOIN sessions s ON s.session_id = w.session_id WHERE w.session_id % 7 = 0""",
}

# ---- X4: what the streams must have kept ------------------------------------

_KEY = "session_id || '/' || driver || '/' || seq"

STREAMS = {
    "x4_messages": f"""
SELECT {_KEY} AS key, CASE WHEN seq % 97 = 0 OR (seq % 79 = 3) THEN 'corrupt' WHEN seq % 83 = 2 THEN 'no identity' END AS reason,
       CASE WHEN reason IS NULL THEN lap_number END AS lap_number, CASE WHEN reason IS NULL THEN lap_time_us END AS lap_time_us,
       CASE WHEN reason IS NULL THEN compound END AS compound,
       CASE WHEN reason IS NULL THEN CASE WHEN seq % 89 = 1 THEN 'sensor' ELSE '' END END AS unknown
FROM raw_laps""",
    "x4_deduplicated": f""",
sent AS (SELECT {_KEY} AS key, seq % 1000000 AS lap, seq // 1000000 % 10 AS car FROM raw_laps)
SELECT key, CASE WHEN lap = 2 AND car = 3 THEN 'late' ELSE 'accepted' END AS status,
       CASE WHEN lap IN (4, 8) AND car = 1 THEN 2 ELSE 1 END AS landed
FROM sent""",
    "x4_results_join": """
SELECT l.session_id, l.driver, l.seq, r.team_name
FROM raw_laps l LEFT JOIN raw_results r ON r.session_id = l.session_id AND trim(r.abbreviation) = l.driver""",
}

SQL: dict[str, str] = {}
SQL.update(VIEWS_A)
SQL.update(VIEWS_B)
SQL.update(TIMING)
SQL.update(INGEST)
SQL.update(STRATEGY)
SQL.update(QUALITY)
SQL.update(MORE)
SQL.update(RACE)
SQL.update(STREAMS)
SQL.update(VARIANT)
SQL.update(LANDING)
# An order is no part of a set of rows: the tests hold it.
SQL["l1_ordered_pitstops"] = SQL["vb8_pitstops"]
SQL["l2_ordered_bars"] = SQL["g1_strategy_bars"]
# Forced plans answer the same questions.
for _name in ("va4_driver_avg_laptime", "vb3_stint_summary", "w1_cumulative_time", "w2_w3_gaps", "w4_n3_pitstops", "u4_upsert_laps",
              "x5_lap_weather", "u6_surrogate_keys"):
    SQL[_name + "_forced"] = SQL[_name]
# Registered v_session_summary read back through spark.sql: the VB7 result.
SQL["s9_sql_view"] = SQL["vb7_session_summary"]
# The streaming ingest must land exactly what the batch ingest (N2) computes.
SQL["x4_stream_ingest"] = SQL["n2_laps_full"]
SQL["s1_session_source"] = "SELECT * FROM raw_laps WHERE session_id IN (521, 631) AND lap_number <= 5"
# Views over refreshed parts are the views over the laps.
for _name, _of in {"va1": "va1_avg_gap_to_leader", "va3": "va3_driver_avg_by_compound", "va5": "va5_session_summary",
                   "va7": "va7_tyre_degradation", "vb3": "vb3_stint_summary", "vb7": "vb7_session_summary"}.items():
    SQL[f"s9_refreshed_{_name}"] = SQL[_of]
SQL["s9_refreshed_seasons"] = """
SELECT s.year, s.session_type, count(*) AS total_laps, count(DISTINCT l.driver_id) AS drivers_count
FROM laps l JOIN sessions s ON s.session_id = l.session_id GROUP BY s.year, s.session_type"""
# And so must the timing from state.
SQL["x4_stateful_timing"] = SQL["n2_laps_full"]


def oracle_sql() -> dict[str, str]:
    return {k: with_fixture(v) for k, v in SQL.items()}
