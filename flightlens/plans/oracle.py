"""DuckDB SQL for each contract query: the independent check of the Spark plans.

The views ``region nation customer supplier part orders lineitem ...`` are
registered by the caller. ``ADAPTER_SQL`` builds the same flight-shaped tables
as ``flightlens.sources.testbed``, written as plain SQL; every query below
starts from it. Times are parsed as TIMESTAMPTZ and read back in UTC, so the
result does not depend on the DuckDB session zone.
"""

from __future__ import annotations

from ..sources.testbed import HUB_CODES
from .contract import HUB_COUNTRY, LOOKUP_ICAO

ADAPTER_SQL = """
WITH airports_raw AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS airport_name,
         CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE n_name END AS country_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 17 <> 0
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, n_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 10 = 1 AND s_suppkey % 13 <> 0 AND s_suppkey % 17 <> 0
  UNION ALL
  SELECT 'C' || CAST(c_custkey AS VARCHAR), c_name, n_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), flights_raw AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS id,
         l_linestatus AS status, c_mktsegment AS airline_name,
         'S' || CAST(l_suppkey AS VARCHAR) AS dep_icao,
         'C' || CAST(c_custkey AS VARCHAR) AS arr_icao,
         o_orderdate + INTERVAL '1' HOUR * CAST(l_partkey % 24 AS INT) AS dep_sched,
         1 + CAST(l_partkey % 9 AS INT) AS hours,
         CAST(l_quantity AS INT) - 10 + 5 * CAST(l_suppkey % 4 AS INT) AS dep_late,
         CAST(l_quantity AS INT) - 15 AS arr_late,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INT) END AS delay,
         l_orderkey, l_linenumber, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
), dim AS (
  SELECT id, MIN(country_name) AS country_name, MIN(airport_name) AS airport_name
  FROM airports_raw WHERE country_name <> '' GROUP BY id
), records AS (
  SELECT f.id, status, CAST(CAST(dep_sched AS DATE) AS VARCHAR) AS flight_date, airline_name,
         dep_icao, arr_icao, 'UTC' AS departure_timezone,
         replace(CAST(dep_sched AS VARCHAR), ' ', 'T') || '+00:00' AS departure_scheduled_time,
         CASE WHEN status = 'F' THEN replace(CAST(dep_sched + INTERVAL '1' MINUTE * dep_late AS VARCHAR), ' ', 'T') || '+00:00' END AS departure_actual_time,
         'UTC' AS arrival_timezone,
         replace(CAST(dep_sched + INTERVAL '1' HOUR * hours AS VARCHAR), ' ', 'T') || '+00:00' AS arrival_scheduled_time,
         CASE WHEN status = 'F' THEN replace(CAST(dep_sched + INTERVAL '1' HOUR * hours + INTERVAL '1' MINUTE * arr_late AS VARCHAR), ' ', 'T') || '+00:00' END AS arrival_actual_time,
         delay, l_orderkey, l_linenumber, l_discount, l_tax
  FROM flights_raw f
), enriched AS (
  SELECT r.*, d.airport_name AS departure_airport, d.country_name AS departure_country,
         a.airport_name AS arrival_airport, a.country_name AS arrival_country,
         COALESCE(delay, 0) AS delay_time
  FROM records r JOIN dim d ON r.dep_icao = d.id JOIN dim a ON r.arr_icao = a.id
), landed AS (
  SELECT id, flight_date, airline_name, departure_airport, departure_country, departure_timezone,
         departure_scheduled_time, departure_actual_time, arrival_airport, arrival_country,
         arrival_timezone, arrival_scheduled_time, arrival_actual_time, delay_time
  FROM enriched WHERE status = 'F'
), scheduled AS (
  SELECT id, flight_date, airline_name, departure_airport, departure_country, departure_timezone,
         departure_scheduled_time, arrival_airport, arrival_country, arrival_timezone,
         arrival_scheduled_time
  FROM enriched WHERE status = 'O'
), training AS (
  SELECT *,
    (epoch(CAST(departure_actual_time AS TIMESTAMPTZ)) - epoch(CAST(departure_scheduled_time AS TIMESTAMPTZ))) / 60 AS departure_delay_minutes,
    (epoch(CAST(arrival_actual_time AS TIMESTAMPTZ)) - epoch(CAST(arrival_scheduled_time AS TIMESTAMPTZ))) / 60 AS arrival_delay_minutes,
    CAST(hour(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_hour,
    CAST(dayofweek(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') + 1 AS INTEGER) AS scheduled_day_of_week,
    CAST(month(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_month
  FROM landed
  WHERE departure_actual_time IS NOT NULL AND arrival_actual_time IS NOT NULL
    AND departure_scheduled_time IS NOT NULL AND arrival_scheduled_time IS NOT NULL
), scoring AS (
  SELECT *,
    CAST(hour(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_hour,
    CAST(dayofweek(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') + 1 AS INTEGER) AS scheduled_day_of_week,
    CAST(month(CAST(departure_scheduled_time AS TIMESTAMPTZ) AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_month,
    0 AS delay_time
  FROM scheduled
), means AS (
  SELECT airline_name, avg(departure_delay_minutes) AS predicted_departure_delay,
         avg(arrival_delay_minutes) AS predicted_arrival_delay
  FROM training GROUP BY airline_name
), predictions AS (
  SELECT id, flight_date, airline_name, departure_airport, arrival_airport,
         departure_scheduled_time, arrival_scheduled_time,
         make_timestamp(CAST(trunc((epoch(CAST(departure_scheduled_time AS TIMESTAMPTZ)) + predicted_departure_delay * 60) * 1000000) AS BIGINT)) AS departure_estimated_time,
         make_timestamp(CAST(trunc((epoch(CAST(arrival_scheduled_time AS TIMESTAMPTZ)) + predicted_arrival_delay * 60) * 1000000) AS BIGINT)) AS arrival_estimated_time,
         predicted_departure_delay, predicted_arrival_delay
  FROM scoring JOIN means USING (airline_name)
), vocab AS (
  SELECT column_name, value,
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS INTEGER) AS category_index
  FROM (SELECT column_name, value, count(*) AS n FROM (
          SELECT 'airline_name' AS column_name, airline_name AS value FROM training
          UNION ALL SELECT 'departure_airport', departure_airport FROM training
          UNION ALL SELECT 'arrival_airport', arrival_airport FROM training
          UNION ALL SELECT 'departure_country', departure_country FROM training
          UNION ALL SELECT 'arrival_country', arrival_country FROM training) t
        WHERE value IS NOT NULL GROUP BY column_name, value) c
), merged AS (
  SELECT s.*,
         CASE WHEN p.id IS NOT NULL THEN p.departure_estimated_time END AS departure_estimated_time,
         CASE WHEN p.id IS NOT NULL THEN p.arrival_estimated_time END AS arrival_estimated_time
  FROM scheduled s LEFT JOIN predictions p ON s.id = p.id
)
"""



def _stump(target: str, label: str, rows: str, numeric: list[str]) -> str:
    """CTEs of an exact depth-1 regression fit on ``rows``: candidates, the best one, the mean label of its sides.

    Candidates: midpoints between neighbouring values of each numeric feature, and each category against the rest.
    The best has the largest sum of squared sums over counts, which is the largest reduction of variance.
    """
    values = "\n UNION ALL ".join(
        [f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CAST(NULL AS VARCHAR) AS category, {label} AS y FROM {rows}" for c in numeric]
        + [f"SELECT '{c}', NULL, {c}, {label} FROM {rows} WHERE {c} IS NOT NULL"
           for c in ("airline_name", "departure_airport", "arrival_airport", "departure_country", "arrival_country")])
    return f"""
        , {target}_values AS ({values}),
        {target}_all AS (SELECT count(*) AS n, sum({label}) AS s FROM {rows}),
        {target}_groups AS (SELECT feature, x, category, count(*) AS n, sum(y) AS s FROM {target}_values GROUP BY ALL),
        {target}_sides AS (
          SELECT feature, category, CAST(NULL AS DOUBLE) AS threshold, n, s FROM {target}_groups WHERE category IS NOT NULL
          UNION ALL
          SELECT feature, NULL, (x + lead(x) OVER w) / 2, sum(n) OVER w, sum(s) OVER w
          FROM {target}_groups WHERE category IS NULL WINDOW w AS (PARTITION BY feature ORDER BY x)
        ),
        {target}_best AS (
          SELECT feature, category, threshold, d.s / d.n AS inside, (a.s - d.s) / (a.n - d.n) AS outside
          FROM {target}_sides d, {target}_all a
          WHERE (category IS NOT NULL OR threshold IS NOT NULL) AND d.n < a.n
          ORDER BY d.s * d.s / d.n + (a.s - d.s) * (a.s - d.s) / (a.n - d.n) DESC LIMIT 1
        )"""


def _stump_score(target: str, numeric: list[str]) -> str:
    """The prediction of ``{target}_best`` (as ``b``) for a row."""
    number = " ".join(f"WHEN '{c}' THEN {c} <= b.threshold" for c in numeric)
    named = " ".join(f"WHEN '{c}' THEN coalesce({c} = b.category, false)" for c in
                     ("airline_name", "departure_airport", "arrival_airport", "departure_country", "arrival_country"))
    return f"CASE WHEN CASE b.feature {number} {named} END THEN b.inside ELSE b.outside END"


_CALENDAR = ["scheduled_hour", "scheduled_day_of_week", "scheduled_month"]
_NUMERIC = ["delay_time", *_CALENDAR]
_TRAINS = "CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) < 3435973836"
_PARTS = f""", train_part AS (SELECT * FROM training WHERE {_TRAINS}),
        test_part AS (SELECT * FROM training WHERE NOT ({_TRAINS}))"""

def _time_text(column: str) -> str:
    return f"""CASE l_orderkey % 6 WHEN 0 THEN left({column}, 19) || '+00:00' WHEN 1 THEN left({column}, 19) || 'Z'
        WHEN 2 THEN left({column}, 19) || '-06:00' WHEN 3 THEN left({column}, 19) || '.5+00:00' WHEN 4 THEN 'soon' END"""


def _wall(column: str) -> str:
    return f"string_split(string_split({column}, 'T')[1] || ' ' || string_split({column}, 'T')[2], '+')[1]"


_QUERIES = {
    "time_text_labels": f"""
        , texts AS (SELECT *, TRY_CAST({_time_text('departure_scheduled_time')} AS TIMESTAMPTZ) AS dst
                    FROM enriched WHERE status = 'F' AND l_orderkey % 11 <> 0)
        SELECT id, (epoch(CAST(departure_actual_time AS TIMESTAMPTZ)) - floor(epoch(dst))) / 60 AS departure_delay_minutes,
               (epoch(CAST(arrival_actual_time AS TIMESTAMPTZ)) - epoch(CAST(arrival_scheduled_time AS TIMESTAMPTZ))) / 60 AS arrival_delay_minutes,
               CAST(hour(dst AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_hour,
               CAST(dayofweek(dst AT TIME ZONE 'UTC') + 1 AS INTEGER) AS scheduled_day_of_week,
               CAST(month(dst AT TIME ZONE 'UTC') AS INTEGER) AS scheduled_month
        FROM texts WHERE dst IS NOT NULL""",
    "time_text_dashboard": f"""
        , texts AS (SELECT id, {_time_text('departure_scheduled_time')} AS d, {_time_text('arrival_scheduled_time')} AS a
                    FROM enriched WHERE status = 'O'),
        walls AS (SELECT id, {_wall('d')} AS d, {_wall('a')} AS a FROM texts)
        SELECT id, d AS departure_scheduled_time,
               (epoch(try_strptime(d, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS departure_scheduled_time_number,
               a AS arrival_scheduled_time,
               (epoch(try_strptime(a, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS arrival_scheduled_time_number
        FROM walls""",
    "requested_flights": f"""
        , hub AS (SELECT * FROM enriched WHERE status = 'F' AND l_linenumber NOT IN (5, 6))
        SELECT flight_date, airline_name, departure_country, departure_scheduled_time, departure_actual_time,
               arrival_country, arrival_scheduled_time, arrival_actual_time, delay_time
        FROM (SELECT * FROM hub WHERE arr_icao IN {HUB_CODES}
              UNION ALL SELECT * FROM hub WHERE dep_icao IN {HUB_CODES})""",
    "load_counts": """
        SELECT 'airports' AS table_name, 'loaded' AS stage, count(*) AS row_count FROM airports_raw
        UNION ALL SELECT 'flights', 'extracted', count(*) FROM records WHERE status = 'F'
        UNION ALL SELECT 'flights', 'transformed', count(*) FROM enriched WHERE status = 'F' AND l_linenumber NOT IN (5, 6)""",
    "rejected_rows": """
        SELECT request_id, flight_code, reject_reason FROM (
          SELECT 'year-' || substr(flight_date, 1, 4) AS request_id, r.id AS flight_code,
                 CASE WHEN l_linenumber = 6 THEN 'airline is no object'
                      WHEN l_linenumber = 5 THEN 'departure code is missing'
                      WHEN d.id IS NULL THEN 'departure airport is unknown'
                      WHEN a.id IS NULL THEN 'arrival airport is unknown' END AS reject_reason
          FROM records r LEFT JOIN dim d ON r.dep_icao = d.id LEFT JOIN dim a ON r.arr_icao = a.id
          WHERE status = 'F') WHERE reject_reason IS NOT NULL""",
    "evaluation_split": f"SELECT id, CAST({_TRAINS} AS INTEGER) AS trains FROM training",
    "gbt_stump_departure": _stump("dep", "departure_delay_minutes", "training", _CALENDAR) + f"""
        SELECT id, round({_stump_score('dep', _CALENDAR)}, 6) AS predicted_departure_delay FROM scoring, dep_best b""",
    "gbt_stump_arrival": _PARTS + _stump("arr", "arrival_delay_minutes", "train_part", _NUMERIC) + f"""
        SELECT id, round({_stump_score('arr', _NUMERIC)}, 6) AS predicted_arrival_delay FROM test_part, arr_best b""",
    "evaluate_stumps": _PARTS + _stump("dep", "departure_delay_minutes", "train_part", _NUMERIC)
        + _stump("arr", "arrival_delay_minutes", "train_part", _NUMERIC) + f"""
        , errors AS (
          SELECT 'departure' AS model, {_stump_score('dep', _NUMERIC)} - departure_delay_minutes AS e FROM test_part, dep_best b
          UNION ALL
          SELECT 'arrival', {_stump_score('arr', _NUMERIC)} - arrival_delay_minutes FROM test_part, arr_best b)
        SELECT model, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, count(*) AS rows
        FROM errors GROUP BY model""",
    "prediction_job": _stump("dep", "departure_delay_minutes", "training", _NUMERIC)
        + _stump("arr", "arrival_delay_minutes", "training", _NUMERIC) + f"""
        , dep_scored AS (SELECT id, {_stump_score('dep', _NUMERIC)} AS d FROM scoring, dep_best b),
        arr_scored AS (SELECT id, {_stump_score('arr', _NUMERIC)} AS a FROM scoring, arr_best b)
        SELECT s.*,
          make_timestamp(CAST(trunc((epoch(CAST(departure_scheduled_time AS TIMESTAMPTZ)) + d * 60) * 1000000) AS BIGINT)) AS departure_estimated_time,
          make_timestamp(CAST(trunc((epoch(CAST(arrival_scheduled_time AS TIMESTAMPTZ)) + a * 60) * 1000000) AS BIGINT)) AS arrival_estimated_time
        FROM scheduled s JOIN dep_scored USING (id) JOIN arr_scored USING (id)""",
    "scheduled_reload": f"""
        , pulled AS (SELECT * EXCLUDE (id) FROM scheduled)
        SELECT *, 'pull-1' AS after_pull FROM pulled WHERE arrival_country = '{HUB_COUNTRY}' AND flight_date LIKE '1997%'
        UNION ALL
        SELECT *, 'pull-2' FROM pulled WHERE arrival_country = '{HUB_COUNTRY}' AND flight_date LIKE '1997%'
        UNION ALL
        SELECT *, 'pull-3' FROM pulled WHERE departure_country = '{HUB_COUNTRY}' AND flight_date LIKE '1998%'""",
    "airports_dim": "SELECT id, airport_name, country_name FROM dim",
    "flights_enriched": "SELECT * FROM landed",
    "scheduled_enriched": "SELECT * FROM scheduled",
    "hub_union": f"""
        SELECT 'arr' AS request_id, id, flight_date, airline_name, departure_country, arrival_country
        FROM landed WHERE arrival_country = '{HUB_COUNTRY}'
        UNION ALL
        SELECT 'dep' AS request_id, id, flight_date, airline_name, departure_country, arrival_country
        FROM landed WHERE departure_country = '{HUB_COUNTRY}'""",
    "landed_load": f"""
        SELECT flight_date, airline_name, departure_airport, departure_country, departure_timezone,
               departure_scheduled_time, departure_actual_time, arrival_airport, arrival_country,
               arrival_timezone, arrival_scheduled_time, arrival_actual_time, delay_time
        FROM (SELECT *, 'arr-' || substr(flight_date, 1, 4) AS request_id FROM enriched
              WHERE status = 'F' AND arrival_country = '{HUB_COUNTRY}'
              UNION ALL
              SELECT *, 'dep-' || substr(flight_date, 1, 4) FROM enriched
              WHERE status = 'F' AND departure_country = '{HUB_COUNTRY}')
        WHERE request_id <> 'dep-1993' AND l_linenumber NOT IN (5, 6)""",
    "training_labels": """
        SELECT id, departure_delay_minutes, arrival_delay_minutes, delay_time FROM training""",
    "calendar_features": """
        SELECT id, scheduled_hour, scheduled_day_of_week, scheduled_month,
               CAST(delay_time AS INTEGER) AS delay_time FROM scoring""",
    "delay_default": """
        SELECT id, delay_time, CAST(delay IS NULL AS INTEGER) AS delay_defaulted
        FROM enriched WHERE status = 'F'""",
    "country_lookup": f"SELECT id, country_name FROM dim WHERE id = '{LOOKUP_ICAO}'",
    "estimated_times": "SELECT * FROM predictions",
    "combine_predictions": """
        SELECT a.id, d.predicted_departure_delay, a.predicted_arrival_delay
        FROM predictions a JOIN (SELECT id, predicted_departure_delay FROM predictions) d ON a.id = d.id""",
    "merge_estimates": "SELECT * FROM merged",
    "dashboard": """
        SELECT id, flight_date, airline_name, departure_airport, departure_country,
               departure_timezone, arrival_airport, arrival_country, arrival_timezone,
               dst AS departure_scheduled_time,
               (epoch(try_strptime(dst, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS departure_scheduled_time_number,
               det AS departure_estimated_time,
               (epoch(try_strptime(det, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS departure_estimated_time_number,
               ast AS arrival_scheduled_time,
               (epoch(try_strptime(ast, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS arrival_scheduled_time_number,
               aet AS arrival_estimated_time,
               (epoch(try_strptime(aet, '%Y-%m-%d %H:%M:%S')) - 1771000000) / 10 AS arrival_estimated_time_number
        FROM (
          SELECT *,
            string_split(string_split(departure_scheduled_time, 'T')[1] || ' ' || string_split(departure_scheduled_time, 'T')[2], '+')[1] AS dst,
            string_split(CAST(departure_estimated_time AS VARCHAR), '.')[1] AS det,
            string_split(string_split(arrival_scheduled_time, 'T')[1] || ' ' || string_split(arrival_scheduled_time, 'T')[2], '+')[1] AS ast,
            string_split(CAST(arrival_estimated_time AS VARCHAR), '.')[1] AS aet
          FROM merged)""",
    "verify_sample": """
        SELECT id, airline_name, departure_airport, arrival_airport, departure_scheduled_time,
               departure_estimated_time, arrival_scheduled_time, arrival_estimated_time
        FROM merged ORDER BY id LIMIT 10""",
    "regression_metrics": """
        SELECT 'departure' AS model,
               round(sqrt(avg(power(predicted_departure_delay - departure_delay_minutes, 2))), 6) AS rmse,
               round(avg(abs(predicted_departure_delay - departure_delay_minutes)), 6) AS mae
        FROM training JOIN means USING (airline_name)
        UNION ALL
        SELECT 'arrival',
               round(sqrt(avg(power(predicted_arrival_delay - arrival_delay_minutes, 2))), 6),
               round(avg(abs(predicted_arrival_delay - arrival_delay_minutes)), 6)
        FROM training JOIN means USING (airline_name)""",
    "batch_counts": """
        SELECT 'flights_extracted' AS stage, count(*) AS row_count FROM records WHERE status = 'F'
        UNION ALL SELECT 'scheduled_extracted', count(*) FROM records WHERE status = 'O'
        UNION ALL SELECT 'flights_loaded', count(*) FROM enriched WHERE status = 'F'
        UNION ALL SELECT 'scheduled_loaded', count(*) FROM enriched WHERE status = 'O'
        UNION ALL SELECT 'training_rows', count(*) FROM training
        UNION ALL SELECT 'predicted_rows', count(*) FROM predictions""",
    "complete_requests": """
        , lines AS (
          SELECT l_orderkey, id, CAST(floor((l_linenumber - 1) / 2) * 2 AS INTEGER) AS page_offset,
                 l_discount >= 0.095 AS broken, l_tax >= 0.075 AS null_data,
                 flight_date, airline_name, dep_icao, arr_icao, departure_scheduled_time,
                 COALESCE(delay, 0) AS delay_time
          FROM records WHERE status = 'F'
        ), totals AS (
          SELECT l_orderkey, count(*) AS total FROM lines GROUP BY l_orderkey
        ), pages AS (
          SELECT l_orderkey, page_offset, total, NOT (bool_or(broken) OR bool_or(null_data)) AS ok
          FROM lines JOIN totals USING (l_orderkey) GROUP BY l_orderkey, page_offset, total
        ), stops AS (
          SELECT l_orderkey, min(page_offset) AS stop FROM pages
          WHERE ok AND page_offset + 2 >= total GROUP BY l_orderkey
        ), complete AS (
          SELECT l_orderkey, stop FROM pages JOIN stops USING (l_orderkey)
          WHERE page_offset <= stop GROUP BY l_orderkey, stop
          HAVING count(DISTINCT CASE WHEN ok AND page_offset % 2 = 0 THEN page_offset END) = stop / 2 + 1
             AND stop % 2 = 0
        ), positioned AS (
          SELECT l.*, CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.page_offset ORDER BY id) - 1 AS INTEGER) AS pos
          FROM lines l JOIN complete c ON l.l_orderkey = c.l_orderkey AND l.page_offset <= c.stop
        )
        SELECT CAST(l_orderkey AS VARCHAR) AS request_id, page_offset, pos,
               sha256(concat_ws(':', 'flights', 'testbed', CAST(l_orderkey AS VARCHAR),
                                CAST(page_offset AS VARCHAR), CAST(pos AS VARCHAR))) AS record_id,
               id AS flight_code, flight_date, airline_name, dep_icao, arr_icao,
               departure_scheduled_time, CAST(delay_time AS INTEGER) AS delay_time
        FROM positioned""",
    "category_index": "SELECT column_name, value, category_index FROM vocab",
    "one_hot_slots": """
        SELECT s.id,
               v1.category_index AS airline_name_slot,
               v2.category_index AS departure_airport_slot,
               v3.category_index AS arrival_airport_slot,
               v4.category_index AS departure_country_slot,
               v5.category_index AS arrival_country_slot
        FROM scheduled s
        LEFT JOIN vocab v1 ON v1.column_name = 'airline_name' AND v1.value = s.airline_name
        LEFT JOIN vocab v2 ON v2.column_name = 'departure_airport' AND v2.value = s.departure_airport
        LEFT JOIN vocab v3 ON v3.column_name = 'arrival_airport' AND v3.value = s.arrival_airport
        LEFT JOIN vocab v4 ON v4.column_name = 'departure_country' AND v4.value = s.departure_country
        LEFT JOIN vocab v5 ON v5.column_name = 'arrival_country' AND v5.value = s.arrival_country""",
    "reset_then_load": "SELECT * FROM scheduled WHERE flight_date >= '1998-01-01'",
}

# The same rows by another way: requests gated by the stream, models kept and read again.
_QUERIES["streamed_requests"] = _QUERIES["complete_requests"]
_QUERIES["kept_models"] = _QUERIES["gbt_stump_departure"]


def oracle_sql() -> dict[str, str]:
    # A body starting with "," continues the adapter's WITH list.
    return {name: ADAPTER_SQL + ("" if body.lstrip().startswith(",") else "\n") + body
            for name, body in _QUERIES.items()}
