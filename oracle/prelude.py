"""DuckDB CTEs: stand-in raw tables, era filter and cleaned tables.

Written independently of the Spark code, in plain SQL over the test tables
(lineitem, orders, customer, supplier, nation, region, events are views).
A query is ``WITH <needed CTEs> <final select>``; ``sql(final, needs)``
pulls in the transitive CTE dependencies in a valid order.
"""

from __future__ import annotations

import re

N = "'\\N'"  # the raw missing marker as a SQL literal
ERA = (1996, 2024)


def _nn(c: str) -> str:
    """Raw text with the missing marker mapped to NULL."""
    return f"NULLIF({c}, {N})"


def _race_id(ts: str) -> str:
    return f"CAST(date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE)) + 1 AS BIGINT)"


CTES: dict[str, str] = {}


def _again(body: str, when: str, changed: str) -> str:
    """The rows and, later in source order, changed copies of some."""
    return (f"SELECT * FROM ({body}) UNION ALL BY NAME SELECT * REPLACE ({changed} || ' (again)' AS {changed}, "
            f"_seq + 1000000000000 AS _seq) FROM ({body}) WHERE {when}")

# --------------------------------------------------------------------------
# Raw stand-ins
# --------------------------------------------------------------------------
CTES["race_days"] = f"""
SELECT {_race_id('d')} AS race_id, d, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""

CTES["lines"] = f"""
SELECT 9007199254740992 + l_orderkey * 10 + l_linenumber AS result_id, {_race_id('o_orderdate')} AS race_id,
       CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       CAST(CASE WHEN l_returnflag = 'R' OR l_partkey % 20 <> 0 OR year(o_orderdate) % 3 = 2 THEN o_custkey
                 WHEN year(o_orderdate) % 3 = 0 THEN 1 ELSE o_custkey % 4 + 1 END AS BIGINT) AS driver_id, CAST(s_nationkey AS BIGINT) AS constructor_id,
       CAST(l_linenumber AS BIGINT) AS grid,
       CASE WHEN l_returnflag = 'R' THEN 'R' ELSE CAST(1 + l_partkey % 20 AS VARCHAR) END AS position,
       CAST(CASE WHEN l_returnflag = 'R' THEN 21 ELSE 1 + l_partkey % 20 END AS BIGINT) AS position_order,
       CAST(l_quantity AS BIGINT) AS qty, l_partkey, l_suppkey, l_returnflag, l_linestatus,
       {{'a': l_partkey, 'b': l_suppkey, 'c': l_quantity, 'd': l_returnflag, 'e': l_linestatus}} AS _seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""

_fp = ", ".join(f"{N} AS {s}_{k}" for s in ("fp1", "fp2", "fp3", "quali", "sprint") for k in ("date", "time"))
CTES["races_raw"] = _again(f"""
SELECT CAST(race_id AS VARCHAR) AS "raceId", CAST(year AS VARCHAR) AS year,
       CAST(row_number() OVER (PARTITION BY year ORDER BY d) AS VARCHAR) AS round,
       CAST(race_id % 25 AS VARCHAR) AS "circuitId", 'Race ' || CAST(race_id AS VARCHAR) AS name,
       CAST(d AS VARCHAR) AS date, {N} AS time, 'race/' || CAST(race_id AS VARCHAR) AS url, {_fp},
       race_id AS _seq
FROM race_days""", "_seq % 50 = 0", "name")


def _results_raw(where: str = "", drop: tuple[str, ...] = ()) -> str:
    cols = [
        ("resultId", "CASE l_suppkey % 3 WHEN 0 THEN '0' || CAST(result_id AS VARCHAR) "
                     "WHEN 1 THEN CAST(result_id AS VARCHAR) || '.0' ELSE CAST(result_id AS VARCHAR) END"), ("raceId", "CAST(race_id AS VARCHAR)"),
        ("driverId", f"CASE WHEN l_partkey % 101 = 0 THEN {N} ELSE CAST(driver_id AS VARCHAR) END"), ("constructorId", "CAST(constructor_id AS VARCHAR)"),
        ("number", "CAST(driver_id % 100 AS VARCHAR)"), ("grid", "CAST(grid AS VARCHAR)"),
        ("position", "position"), ("positionText", "position"),
        ("positionOrder", "CAST(position_order AS VARCHAR)"), ("points", "CAST(qty AS VARCHAR)"),
        ("laps", "CAST(50 + l_suppkey % 20 AS VARCHAR)"), ("time", N),
        ("milliseconds", "CAST(l_partkey * 1000 + l_suppkey AS VARCHAR)"),
        ("fastestLap", "CAST(40 + grid AS VARCHAR)"), ("rank", "CAST(grid AS VARCHAR)"),
        ("fastestLapTime", N), ("fastestLapSpeed", N),
        ("statusId", "CAST(ascii(l_returnflag) * 100 + ascii(l_linestatus) AS VARCHAR)"),
    ]
    sel = ", ".join(f'{e} AS "{n}"' for n, e in cols if n not in drop)
    return f"SELECT {sel}, _seq FROM lines {where}"


CTES["results_raw"] = _results_raw()
CTES["sprint_results_raw"] = _results_raw("WHERE grid = 1", ("rank", "fastestLapSpeed"))

CTES["drivers_raw"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS "driverId", 'drv_' || CAST(c_custkey AS VARCHAR) AS "driverRef",
       CASE WHEN c_custkey % 3 = 0 THEN {N} ELSE CAST(c_custkey % 100 AS VARCHAR) END AS number,
       upper(substr(c_mktsegment, 1, 3)) AS code, 'Driver' AS forename,
       CASE WHEN c_custkey % 7 = 0 THEN ['Hamilton', 'Vettel', 'Alonso', 'Rosberg'][c_custkey % 4 + 1] ELSE c_name END AS surname,
       CASE WHEN c_custkey % 50 = 0 THEN 'unknown'
            ELSE CAST(DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS VARCHAR) END AS dob,
       n_name AS nationality, 'drivers/' || CAST(c_custkey AS VARCHAR) AS url, c_custkey AS _seq
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

CTES["constructors_raw"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS "constructorId", lower(n_name) AS "constructorRef", n_name AS name,
       r_name AS nationality, 'constructors/' || lower(n_name) AS url, CAST(n_nationkey AS BIGINT) AS _seq
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["circuits_raw"] = _again(f"""
SELECT CAST(n_nationkey AS VARCHAR) AS "circuitId", lower(n_name) || '_circuit' AS "circuitRef",
       'Circuit ' || n_name AS name, n_name AS location, r_name AS country,
       CAST(n_nationkey * 2 - 25 AS VARCHAR) AS lat, CAST(n_nationkey * 7 - 90 AS VARCHAR) AS lng,
       CASE WHEN n_nationkey % 4 = 0 THEN {N} ELSE CAST(n_nationkey * 10 AS VARCHAR) END AS alt,
       'circuits/' || lower(n_name) AS url, CAST(n_nationkey AS BIGINT) AS _seq
FROM nation JOIN region ON n_regionkey = r_regionkey""", "_seq % 5 = 0", "name")


def _standings(entity: str, id_name: str, entity_name: str) -> str:
    return _again(f"""
SELECT CAST(sid AS VARCHAR) AS "{id_name}", CAST(CASE WHEN snap = 1 THEN last1 ELSE last2 END AS VARCHAR) AS "raceId",
       CAST({entity} AS VARCHAR) AS "{entity_name}", CAST(pts AS VARCHAR) AS points,
       CAST(pos AS VARCHAR) AS position, CAST(pos AS VARCHAR) AS "positionText",
       CAST(wins AS VARCHAR) AS wins, sid AS _seq
FROM (
  SELECT *, {entity} * 100000 + year * 10 + snap AS sid,
         row_number() OVER (PARTITION BY year, snap ORDER BY pts DESC, {entity}) AS pos
  FROM (
    SELECT year, {entity}, CAST(sum(qty) AS BIGINT) AS pts,
           CAST(sum(CASE WHEN position = '1' THEN 1 ELSE 0 END) AS BIGINT) AS wins, 1 AS snap
    FROM lines WHERE month <= 6 GROUP BY year, {entity}
    UNION ALL
    SELECT year, {entity}, CAST(sum(qty) AS BIGINT), CAST(sum(CASE WHEN position = '1' THEN 1 ELSE 0 END) AS BIGINT), 2
    FROM lines GROUP BY year, {entity}
  )
) s JOIN (
  SELECT year AS ly, max(CASE WHEN month <= 6 THEN race_id END) AS last1, max(race_id) AS last2
  FROM race_days GROUP BY year
) l ON s.year = l.ly""", "_seq % 100000 % 20 = 2", '"positionText"')


CTES["driver_standings_raw"] = _standings("driver_id", "driverStandingsId", "driverId")
CTES["constructor_standings_raw"] = _standings("constructor_id", "constructorStandingsId", "constructorId")

CTES["qualifying_raw"] = f"""
SELECT CAST(qid AS VARCHAR) AS "qualifyId", CAST(race_id AS VARCHAR) AS "raceId",
       CAST(driver_id AS VARCHAR) AS "driverId", CAST(constructor_id AS VARCHAR) AS "constructorId",
       CAST(driver_id % 100 AS VARCHAR) AS number, CAST(1 + (l_partkey * 7) % 20 AS VARCHAR) AS position,
       CASE WHEN l_partkey % 97 = 0 THEN '1:02:03.456' ELSE lap END AS q1,
       CASE WHEN l_linestatus = 'F' THEN {N} ELSE lap END AS q2,
       CASE WHEN l_linestatus = 'F' OR grid > 3 THEN {N} ELSE lap END AS q3,
       {{'a': qid, 'b': driver_id}} AS _seq
FROM (SELECT *, result_id * 2 + unnest(CASE WHEN l_partkey % 41 = 0 THEN [0, 1] ELSE [0] END) AS qid FROM (
  SELECT *, CAST(1 + constructor_id % 2 AS VARCHAR) || ':' || lpad(CAST(qty + 5 AS VARCHAR), 2, '0') || '.'
            || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS lap,
         row_number() OVER (PARTITION BY race_id, driver_id
                            ORDER BY result_id, _seq, constructor_id, qty, l_linestatus, grid, l_partkey) AS rn
  FROM lines
) WHERE rn = 1 AND l_partkey % 29 <> 0)"""

_fine = "CAST(floor(value * 10000.0 + 0.5) AS BIGINT)"
_ms = "CAST(floor(value * 1000.0 + 0.5) AS BIGINT)"
CTES["pit_stops_raw"] = f"""
SELECT CAST(1 + event_id % 2400 AS VARCHAR) AS "raceId", CAST(user_id AS VARCHAR) AS "driverId",
       CAST(1 + (event_id // 1000) % 4 AS VARCHAR) AS stop, CAST(1 + event_id % 70 AS VARCHAR) AS lap,
       strftime(ts, '%H:%M:%S') AS time,
       CASE WHEN value > 100 THEN '1:' || txt ELSE txt END AS duration,
       CAST({_ms} AS VARCHAR) AS milliseconds, event_id AS _seq
FROM (SELECT *, CAST({_fine} // 10000 AS VARCHAR) || '.' || lpad(CAST({_fine} % 10000 AS VARCHAR), 4, '0') AS txt
      FROM events)"""

CTES["lap_times_raw"] = f"""
SELECT CAST(1 + event_id % 2400 AS VARCHAR) AS "raceId", CAST(user_id AS VARCHAR) AS "driverId",
       CAST(event_id AS VARCHAR) AS lap, CAST(1 + event_id % 20 AS VARCHAR) AS position,
       strftime(ts, '%-M:%S.%g') AS time, CAST({_ms} AS VARCHAR) AS milliseconds, event_id AS _seq
FROM events"""

CTES["status_raw"] = _again("""
SELECT CAST(ascii(l_returnflag) * 100 + ascii(l_linestatus) AS VARCHAR) AS "statusId",
       l_returnflag || '/' || l_linestatus AS status,
       CAST(ascii(l_returnflag) * 100 + ascii(l_linestatus) AS BIGINT) AS _seq
FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)""", "_seq % 2 = 0", "status")

CTES["constructor_results_raw"] = f"""
SELECT CAST(constructor_id * 1000000 + race_id AS VARCHAR) AS "constructorResultsId",
       CAST(race_id AS VARCHAR) AS "raceId", CAST(constructor_id AS VARCHAR) AS "constructorId",
       CAST(pts AS VARCHAR) AS points, {N} AS status, constructor_id * 1000000 + race_id AS _seq
FROM (SELECT race_id, constructor_id, CAST(sum(qty) AS BIGINT) AS pts FROM lines GROUP BY race_id, constructor_id)"""

CTES["seasons_raw"] = """
SELECT CAST(year AS VARCHAR) AS year, 'seasons/' || CAST(year AS VARCHAR) AS url, year AS _seq
FROM (SELECT DISTINCT year FROM race_days)"""

# --------------------------------------------------------------------------
# Era filter (races by year, race-linked tables by race id)
# --------------------------------------------------------------------------
CTES["races_era"] = f"SELECT * FROM races_raw WHERE TRY_CAST(year AS BIGINT) BETWEEN {ERA[0]} AND {ERA[1]}"
for _t in ("results", "driver_standings", "constructor_standings", "qualifying", "pit_stops",
           "lap_times", "constructor_results", "sprint_results"):
    CTES[f"{_t}_era"] = (f'SELECT * FROM {_t}_raw WHERE TRY_CAST("raceId" AS BIGINT) IN '
                         f'(SELECT TRY_CAST("raceId" AS BIGINT) FROM races_era)')


# --------------------------------------------------------------------------
# Cleaned tables
# --------------------------------------------------------------------------
def _first(src: str, *key: str) -> str:
    """The first row in source order for each key, typed as a number."""
    typed = ", ".join(f"TRY_CAST({c} AS BIGINT)" for c in key)
    return f"(SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {typed} ORDER BY _seq) = 1)"


def _long(c: str) -> str:
    return f"TRY_CAST({c} AS BIGINT)"


def _dbl(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _lap_ms(c: str) -> str:
    parts = f"string_split({c}, ':')"
    return (f"CASE WHEN trim({c}) <> '' AND len({parts}) = 2 THEN "
            f"CAST(trunc((TRY_CAST({parts}[1] AS DOUBLE) * 60.0 + TRY_CAST({parts}[2] AS DOUBLE)) * 1000.0) AS BIGINT) END")


CTES["results"] = f"""
SELECT {_long('"resultId"')} AS result_id, {_long('"raceId"')} AS race_id, {_long(_nn('"driverId"'))} AS driver_id,
       {_long('"constructorId"')} AS constructor_id, number, {_long('grid')} AS grid, position,
       "positionText" AS position_text, {_long('"positionOrder"')} AS position_order, {_dbl('points')} AS points,
       {_long('laps')} AS laps, {_nn('time')} AS time, {_dbl('milliseconds')} AS milliseconds,
       {_dbl('"fastestLap"')} AS fastest_lap, {_dbl('rank')} AS rank, {_nn('"fastestLapTime"')} AS fastest_lap_time,
       {_nn('"fastestLapSpeed"')} AS fastest_lap_speed, {_long('"statusId"')} AS status_id,
       {_dbl('position')} AS position_numeric, CAST({_dbl('position')} IS NOT NULL AS INTEGER) AS finished
FROM {_first('results_era', '"resultId"')}"""

CTES["drivers"] = f"""
SELECT {_long('"driverId"')} AS driver_id, "driverRef" AS driver_ref, {_long(_nn('number'))} AS number, code,
       forename, surname, TRY_CAST(TRY_STRPTIME(dob, '%Y-%m-%d') AS DATE) AS dob, nationality,
       trim(forename) || ' ' || trim(surname) AS full_name
FROM {_first('drivers_raw', '"driverId"')}"""

CTES["constructors"] = f"""
SELECT {_long('"constructorId"')} AS constructor_id, "constructorRef" AS constructor_ref, name, nationality
FROM {_first('constructors_raw', '"constructorId"')}"""

CTES["races"] = f"""
SELECT {_long('"raceId"')} AS race_id, {_long('year')} AS year, {_long('round')} AS round,
       {_long('"circuitId"')} AS circuit_id, name, TRY_CAST(TRY_STRPTIME(date, '%Y-%m-%d') AS DATE) AS date,
       CASE WHEN {_long('year')} IS NOT NULL AND {_long('round')} IS NOT NULL
            THEN CAST({_long('year')} AS VARCHAR) || '_R' || CASE WHEN {_long('round')} < 10 THEN '0' ELSE '' END
                 || CAST({_long('round')} AS VARCHAR) END AS season_round
FROM {_first('races_era', '"raceId"')}"""

CTES["circuits"] = f"""
SELECT {_long('"circuitId"')} AS circuit_id, "circuitRef" AS circuit_ref, name, location, country,
       {_dbl('lat')} AS lat, {_dbl('lng')} AS lng, {_long(_nn('alt'))} AS alt
FROM {_first('circuits_raw', '"circuitId"')}"""


def _standings_clean(src: str, key: str, key_col: str, entity: str, entity_col: str) -> str:
    return f"""
SELECT {_long(f'"{key}"')} AS {key_col}, {_long('"raceId"')} AS race_id, {_long(f'"{entity}"')} AS {entity_col},
       {_dbl('points')} AS points, {_long('position')} AS position, "positionText" AS position_text,
       {_long('wins')} AS wins
FROM {_first(src, f'"{key}"')}"""


CTES["driver_standings"] = _standings_clean("driver_standings_era", "driverStandingsId",
                                            "driver_standings_id", "driverId", "driver_id")
CTES["constructor_standings"] = _standings_clean("constructor_standings_era", "constructorStandingsId",
                                                 "constructor_standings_id", "constructorId", "constructor_id")

CTES["qualifying"] = f"""
SELECT {_long('"qualifyId"')} AS qualify_id, {_long('"raceId"')} AS race_id, {_long('"driverId"')} AS driver_id,
       {_long('"constructorId"')} AS constructor_id, {_long('number')} AS number, {_long('position')} AS position,
       {_nn('q1')} AS q1, {_nn('q2')} AS q2, {_nn('q3')} AS q3,
       {_lap_ms(_nn('q1'))} AS q1_ms, {_lap_ms(_nn('q2'))} AS q2_ms, {_lap_ms(_nn('q3'))} AS q3_ms
FROM {_first('qualifying_era', '"qualifyId"')}"""

CTES["pit_stops"] = f"""
SELECT {_long('"raceId"')} AS race_id, {_long('"driverId"')} AS driver_id, {_long('stop')} AS stop,
       {_long('lap')} AS lap, time, {_dbl('duration')} AS duration, {_long('milliseconds')} AS milliseconds,
       CAST(COALESCE({_dbl('duration')} > 60, false) AS INTEGER) AS is_long_stop
FROM {_first('pit_stops_era', '"raceId"', '"driverId"', 'stop')}"""

CTES["lap_times"] = f"""
SELECT {_long('"raceId"')} AS race_id, {_long('"driverId"')} AS driver_id, {_long('lap')} AS lap,
       {_long('position')} AS position, time, {_long('milliseconds')} AS milliseconds
FROM lap_times_era"""

CTES["status"] = f"""SELECT {_long('"statusId"')} AS status_id, status FROM {_first('status_raw', '"statusId"')}"""


def _refs(body: str, name: str) -> bool:
    return re.search(rf"\b(?:FROM|JOIN)\s+{re.escape(name)}\b", body, re.IGNORECASE) is not None


def sql(final: str, needs: list[str] | None = None) -> str:
    """WITH-prefix ``final`` with every CTE it (transitively) references."""
    names = list(CTES)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        body = CTES[n]
        for dep in names:
            if dep != n and _refs(body, dep):
                visit(dep)
        order.append(n)

    roots = needs if needs is not None else [n for n in names if _refs(final, n)]
    for r in roots:
        visit(r)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final


def add(name: str, body: str) -> None:
    """Register a further CTE (marts build on the cleaned tables)."""
    CTES[name] = body
