"""The same results in DuckDB's SQL, from the driver's tables alone."""

from __future__ import annotations

# Stations made from customers; twice, as a third of them share a place in the second form.
_STATIONS = """
stations AS (
    SELECT c_name AS "Reporting area",
           ['CA','OR','WA','NV','AZ','CO'][c_nationkey % 6 + 1] AS "State code",
           'US' AS "Country code",
           CASE WHEN c_acctbal < 0 THEN 'No' ELSE 'Yes' END AS "Forecasts",
           CAST(NULL AS VARCHAR) AS "Action Day name",
           CAST({latitude} AS FLOAT) AS "Latitude",
           CAST({longitude} AS FLOAT) AS "Longitude",
           CAST(-8.0 AS FLOAT) AS "GMT offset",
           'Yes' AS "Daylight savings",
           'PST' AS "Standard time zone label",
           'PDT' AS "Daylight savings time zone label",
           'TWC' || c_custkey AS "TWC code",
           CAST(NULL AS VARCHAR) AS "USA Today",
           'Año ' || c_mktsegment AS "Forecast Source"
    FROM customer
)"""
_LATITUDE = "32.5::DOUBLE + (({key} * 7919) % 170000) / 10000.0::DOUBLE"
_LONGITUDE = "-124.5::DOUBLE + (({key} * 104729) % 100000) / 10000.0::DOUBLE"
_AT = {
    "latitude": _LATITUDE.format(key="c_custkey"),
    "longitude": _LONGITUDE.format(key="c_custkey"),
}
_STATION_CTE = "WITH" + _STATIONS.format(**_AT)
_SHARED_CTE = "WITH" + _STATIONS.format(
    latitude=f"CASE WHEN c_custkey % 3 = 0 THEN 34.05::DOUBLE ELSE {_AT['latitude']} END",
    longitude=f"CASE WHEN c_custkey % 3 = 0 THEN -118.25::DOUBLE ELSE {_AT['longitude']} END",
)
_WEST = """ WHERE "State code" = 'CA' OR "State code" = 'OR' OR "State code" = 'WA'"""

_PARAMETER = """CASE event_type WHEN 'view' THEN 'PM2.5' WHEN 'click' THEN 'O3'
    WHEN 'purchase' THEN 'PM10' WHEN 'signup' THEN 'NO2' WHEN 'error' THEN 'CO' END"""
_K = "CAST(props->>'$.k' AS BIGINT)"
_OBSERVATIONS = f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS "DateObserved",
       CAST(hour(ts) AS VARCHAR) AS "HourObserved", {_PARAMETER} AS "ParameterName",
       CAST(value AS FLOAT) AS "AQI", {_K} AS k
FROM events"""
_PM25 = f"SELECT * FROM ({_OBSERVATIONS}) WHERE \"ParameterName\" = 'PM2.5'"

_EVENT_LATITUDE = _LATITUDE.format(key="event_id")
_EVENT_LONGITUDE = _LONGITUDE.format(key="event_id")
_PLACE = f"""'Area ' || event_id AS "ReportingArea", 'CA' AS "StateCode",
       CAST({_EVENT_LATITUDE} AS FLOAT) AS "Latitude",
       CAST({_EVENT_LONGITUDE} AS FLOAT) AS "Longitude",
       {_PARAMETER} AS "ParameterName", CAST(value AS FLOAT) AS "AQI\""""
_DECLARED_OBSERVATIONS = f"""
SELECT strftime(ts, '%Y-%m-%d') AS "DateObserved", CAST(hour(ts) AS VARCHAR) AS "HourObserved",
       'PST' AS "LocalTimeZone", {_PLACE}
FROM events"""
_DECLARED_FORECASTS = f"""
SELECT strftime(ts, '%Y-%m-%d') AS "DateIssue",
       strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS "DateForecast", {_PLACE}
FROM events"""

_URL = """'{path}?format=application/json&latitude=' || lat || '&longitude=' || lon
    || '&date=2024-01-01&distance=1'"""
_OBSERVATION_URL = _URL.format(path="aq/observation/latLong/current/")
_FORECAST_URL = _URL.format(path="aq/forecast/latLong/")
_REQUESTS = f""", requests AS (
    SELECT "TWC code",
           CAST(round_even(CAST("Latitude" AS DOUBLE), 4) AS VARCHAR) AS lat,
           CAST(round_even(CAST("Longitude" AS DOUBLE), 4) AS VARCHAR) AS lon
    FROM stations{_WEST}
)"""
_READINGS = """, answered AS (
    SELECT * FROM requests WHERE right(lat, 1) NOT IN ('7', '8', '9')
), readings AS (
    SELECT lat, lon, 'O3' AS parameter, CAST(floor(CAST(lat AS DOUBLE)) AS FLOAT) AS aqi
    FROM answered
    UNION ALL
    SELECT lat, lon, 'PM2.5', CAST(abs(CAST(lon AS DOUBLE)) AS FLOAT) FROM answered
)"""
_READING_COLUMNS = """'Area ' || lat AS "ReportingArea", 'CA' AS "StateCode",
       CAST(lat AS FLOAT) AS "Latitude", CAST(lon AS FLOAT) AS "Longitude",
       parameter AS "ParameterName", aqi AS "AQI\""""
_FETCHED_OBSERVATIONS = f"""{_SHARED_CTE}{_REQUESTS}{_READINGS}
SELECT '2024-01-01 ' AS "DateObserved", '12' AS "HourObserved", 'PST' AS "LocalTimeZone",
       {_READING_COLUMNS}
FROM readings"""
_FETCHED_FORECASTS = f"""{_SHARED_CTE}{_REQUESTS}{_READINGS}
SELECT '2024-01-01' AS "DateIssue", '2024-01-01' AS "DateForecast", {_READING_COLUMNS}
FROM readings"""

_ALL_STATIONS = f"{_STATION_CTE} SELECT * FROM stations"
_WEST_STATIONS = _ALL_STATIONS + _WEST

_MALFORMED = """
        SELECT c_name AS "Reporting area",
               CASE WHEN state IN ('CA','OR','WA','CO') AND c_acctbal >= 0 THEN 'C|A' ELSE state END
                   AS "State code",
               CAST(CASE WHEN c_acctbal < 0 OR state = 'NV' THEN NULL ELSE 1.5 END AS FLOAT)
                   AS "Latitude",
               CAST(CASE WHEN c_acctbal < 0 THEN NULL WHEN state = 'NV' THEN 100 ELSE 2.5 END
                   AS FLOAT) AS "Longitude",
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 'T' END AS "TWC code",
               CASE WHEN c_acctbal < 0 THEN c_name || '|' || state
                    WHEN state = 'NV'
                        THEN c_name || '|NV|US|Yes||north|1e2|-8.0|Yes|PST|PDT|T|No|S'
                    WHEN state = 'AZ'
                        THEN c_name || '|AZ|US|Yes||1.5|2.5|-8.0|Yes|PST|PDT|T|No|S|more'
               END AS line
        FROM (SELECT *, ['CA','OR','WA','NV','AZ','CO'][c_nationkey % 6 + 1] AS state
              FROM customer)"""
_INFERRED = f"""
        SELECT value AS "AQI", {_K} AS "CategoryNumber", 'level ' || {_K} AS "CategoryName",
               strftime(ts, '%Y-%m-%d') AS "DateObserved", hour(ts) AS "HourObserved",
               {_EVENT_LATITUDE} AS "Latitude", 'PST' AS "LocalTimeZone",
               {_EVENT_LONGITUDE} AS "Longitude", {_PARAMETER} AS "ParameterName",
               'Area ' || event_id AS "ReportingArea", 'CA' AS "StateCode"
        FROM events"""

_FETCH_COUNTS = f"""{_SHARED_CTE}{_REQUESTS}
        SELECT {_FORECAST_URL} AS url, count(*) AS n_requests,
               CAST(CASE WHEN right(lat, 1) = '9' THEN 503 ELSE 200 END AS INTEGER) AS status,
               CASE WHEN right(lat, 1) = '9' THEN 'HTTP 503' END AS error
        FROM requests GROUP BY lat, lon"""

_LANDED_BYTES = f"""{_STATION_CTE}
        SELECT CAST(sum(1 + length(concat_ws('|', "Reporting area", "State code", "Country code",
               "Forecasts", '', CAST("Latitude" AS VARCHAR), CAST("Longitude" AS VARCHAR),
               CAST("GMT offset" AS VARCHAR), "Daylight savings", "Standard time zone label",
               "Daylight savings time zone label", "TWC code", '', "Forecast Source"))) AS BIGINT)
               AS bytes
        FROM stations"""
_EVENT_LINES = "SELECT event_id || '|' || event_type || '|' || props AS value FROM events"

ORACLE: dict[str, str] = {
    "station_scan": _ALL_STATIONS,
    "station_scan_latin1": _ALL_STATIONS,
    "landed_stations": _ALL_STATIONS,
    "station_scan_undecoded": f"""{_STATION_CTE}
        SELECT * REPLACE (replace("Forecast Source", 'ñ', chr(65533)) AS "Forecast Source")
        FROM stations""",
    "station_malformed": _MALFORMED,
    "station_two_step_rejects": f"SELECT * FROM ({_MALFORMED}) WHERE line IS NOT NULL",
    "station_two_step_damaged": f"""SELECT * EXCLUDE (line) FROM ({_MALFORMED})
        WHERE "State code" IN ('C|A', 'AZ')""",
    "stations_listed": f"""{_STATION_CTE} SELECT "TWC code", "Reporting area", "State code"
        FROM stations WHERE "TWC code" IN ('TWC1', 'TWC7', 'TWC42', 'TWC1000000000')""",
    "station_raw_lines": f"""{_STATION_CTE}
        SELECT CAST(14 AS INTEGER) AS n_fields,
               * REPLACE ('' AS "Action Day name", '' AS "USA Today",
                          CAST("Latitude" AS VARCHAR) AS "Latitude",
                          CAST("Longitude" AS VARCHAR) AS "Longitude",
                          CAST("GMT offset" AS VARCHAR) AS "GMT offset")
        FROM stations""",
    "station_filter": _WEST_STATIONS,
    "station_two_step": _WEST_STATIONS,
    "station_filter_one_state": f"""{_ALL_STATIONS} WHERE "State code" = 'CA'""",
    "station_locations": f"""{_STATION_CTE}
        SELECT "TWC code", "Latitude", "Longitude" FROM stations{_WEST}""",
    "station_shape": f"""{_STATION_CTE}
        SELECT count(*) AS "rows", CAST(14 AS INTEGER) AS "columns" FROM stations{_WEST}""",
    "landed_bytes": _LANDED_BYTES,
    "landed_files": f"SELECT bytes, TRUE AS same FROM ({_LANDED_BYTES})",
    "landed_gz_lines": _EVENT_LINES,
    "request_urls": f"""{_STATION_CTE}{_REQUESTS}
        SELECT "TWC code", {_FORECAST_URL} AS url FROM requests""",
    "request_rejects": f"""{_STATION_CTE}
        SELECT "TWC code" FROM stations WHERE "State code" IN ('NV', 'AZ')""",
    "rounded_values": """
        SELECT event_id,
               CAST(round_even(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS VARCHAR) AS value_text,
               CAST(round_even((event_id - 500) / 32.0::DOUBLE, 4) AS VARCHAR) AS tie_text
        FROM events""",
    "observation_fetch": _FETCHED_OBSERVATIONS,
    "forecast_fetch": _FETCHED_FORECASTS,
    "observation_fetch_ranked": f"""SELECT * FROM ({_FETCHED_OBSERVATIONS})
        WHERE "ParameterName" = 'PM2.5' ORDER BY "AQI" DESC NULLS LAST""",
    "decoded_bodies": """
        SELECT DISTINCT 'event/' || event_id AS url, CAST(200 AS INTEGER) AS status,
               CASE WHEN event_id % 3 <> 0 THEN '["é ' || event_id || '"]' END AS body,
               CASE WHEN event_id % 3 = 0 THEN 'body is not UTF-8' END AS error
        FROM events""",
    "fused_forecasts": _FETCHED_FORECASTS,
    "whole_run": f"SELECT * FROM ({_FETCHED_OBSERVATIONS}) WHERE \"ParameterName\" = 'PM2.5'",
    "fetch_counts": _FETCH_COUNTS,
    "replies_resumed": _FETCH_COUNTS,
    "committed_run": _FETCHED_OBSERVATIONS,
    "cut_off_entries": f"""
        SELECT event_id, {_PARAMETER} AS "ParameterName", CAST(value AS FLOAT) AS "AQI", {_K} AS k
        FROM (SELECT *, unnest(range(event_id % 3 + 1)) AS copy FROM events)
        WHERE event_type NOT IN ('error', 'signup', 'purchase')""",
    "cut_off_rejects": """
        SELECT 'event/' || event_id AS url,
               CAST(CASE event_type WHEN 'error' THEN 503 ELSE 200 END AS INTEGER) AS status,
               CASE event_type WHEN 'error' THEN 'HTTP 503' WHEN 'purchase' THEN 'body is not a JSON array'
                    ELSE 'array is cut off at' END AS reason
        FROM events WHERE event_type <> 'signup'""",
    "response_entries": f"""
        WITH replies AS (
            SELECT *, {_K} AS k, unnest(range(event_id % 3 + 1)) AS copy
            FROM events WHERE event_type NOT IN ('error', 'signup', 'purchase')
        )
        SELECT event_id, {_PARAMETER} AS "ParameterName", CAST(value AS FLOAT) AS "AQI", k,
               'level ' || k AS level
        FROM replies
        UNION ALL
        SELECT event_id, 'second', CAST(1.5 AS FLOAT), k, 'level ' || k FROM replies""",
    "response_failures": """
        SELECT 'event/' || event_id AS url,
               CAST(CASE event_type WHEN 'error' THEN 503 ELSE 200 END AS INTEGER) AS status,
               CASE event_type WHEN 'error' THEN 'HTTP 503' ELSE 'body is not a JSON array' END
                   AS reason
        FROM events WHERE event_type IN ('error', 'purchase')""",
    "observations_declared": _DECLARED_OBSERVATIONS,
    "observations_with_terminator": f"SELECT *, TRUE AS one_per_file FROM ({_DECLARED_OBSERVATIONS})",
    "terminator_dropped": _DECLARED_OBSERVATIONS,
    "observations_document": _DECLARED_OBSERVATIONS,
    "observations_table": _DECLARED_OBSERVATIONS,
    "observations_one_line_arrays": _DECLARED_OBSERVATIONS,
    "observations_brackets_on_lines": _DECLARED_OBSERVATIONS,
    "observations_inferred": _INFERRED,
    "observations_inferred_one_line": _INFERRED,
    "observations_inferred_brackets": _INFERRED,
    "observations_pinned": _INFERRED,
    "forecasts_pretty_table": _DECLARED_FORECASTS,
    "forecasts_split_documents": _DECLARED_FORECASTS,
    "forecast_entries": _DECLARED_FORECASTS,
    "forecasts_table": _DECLARED_FORECASTS,
    "forecasts_ranked_sql": f"""
        SELECT * FROM ({_DECLARED_FORECASTS}) WHERE "ParameterName" = 'PM2.5'
        ORDER BY "AQI" DESC NULLS LAST""",
    "forecasts_top20": f"""
        SELECT * FROM ({_DECLARED_FORECASTS}) WHERE "ParameterName" = 'PM2.5'
        ORDER BY "AQI" DESC NULLS LAST, "ReportingArea" LIMIT 20""",
    "entry_rows": f"""
        SELECT 'Area ' || event_id AS "ReportingArea",
               CAST(CASE WHEN event_type <> 'signup' THEN {_K} END AS FLOAT) AS "AQI"
        FROM events WHERE event_type <> 'error'""",
    "entry_rejects": """
        SELECT CASE WHEN event_type = 'signup' THEN 'Area ' || event_id END AS "ReportingArea",
               CAST(NULL AS FLOAT) AS "AQI",
               '{"ReportingArea":"Area ' || event_id || '","AQI":'
                   || CASE WHEN event_type = 'signup' THEN '"high"}' ELSE '' END AS line
        FROM events WHERE event_type IN ('error', 'signup')""",
    "json_lines_roundtrip": _OBSERVATIONS,
    "table_kept": _OBSERVATIONS,
    "pm25_ranked": f"{_PM25} ORDER BY \"AQI\" DESC NULLS LAST",
    "pm25_ranked_table": f"{_PM25} ORDER BY \"AQI\" DESC NULLS LAST",
    "pm25_ranked_sql": f"{_PM25} ORDER BY \"AQI\" DESC NULLS LAST",
    "pm25_top20": f"{_PM25} ORDER BY \"AQI\" DESC NULLS LAST, event_id LIMIT 20",
    "repartitioned_write": _OBSERVATIONS,
    "repartitioned_files": "SELECT count(*) AS readings, TRUE AS as_asked FROM events",
    "gz_lines": _EVENT_LINES,
    "latest_delivery": f"SELECT NULL::VARCHAR AS \"DateObserved\", NULL::VARCHAR AS \"HourObserved\", "
        f"NULL::VARCHAR AS \"LocalTimeZone\", {_PLACE} FROM events",
    "incremental_load": f"""{_DECLARED_OBSERVATIONS}
        UNION ALL
        SELECT NULL, NULL, NULL, {_PLACE} FROM events""",
}
