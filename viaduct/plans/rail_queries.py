"""Queries of feeds, distances, places, factors and the gold layer, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import gold, places, rail
from ..sources.layers import by_buckets, by_folders
from ..sources.tables import settled
from .views import Views, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def hav(a: str, b: str, c: str, d: str) -> str:
    x = f"pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)"
    return f"2 * {K.EARTH_RADIUS_M} * asin(sqrt(CASE WHEN {x} > 1 THEN 1 ELSE {x} END))"


def half_up(c: str, digits: int) -> str:
    return f"floor(({c}) * CAST({10**digits} AS DOUBLE) + CAST(0.500001 AS DOUBLE)) / CAST({10**digits} AS DOUBLE)"


def units(c: str, scale: int) -> str:
    return f"CAST(round({c} * CAST({10**scale} AS DOUBLE)) AS BIGINT)"


def total(c: str, scale: int, digits: int, only: str = "") -> str:
    """An exact sum of numbers of `scale` decimals, rounded once. only: a FILTER clause."""
    return half_up(f"CAST(sum({units(c, scale)}) {only} AS DOUBLE) / CAST({10**scale} AS DOUBLE)", digits)


def mean(c: str, scale: int, digits: int, only: str = "") -> str:
    return half_up(f"CAST(sum({units(c, scale)}) {only} AS DOUBLE) / CAST({10**scale} AS DOUBLE) / nullif(count({c}) {only}, 0)", digits)


def seconds(c: str) -> str:
    part = lambda k: f"TRY_CAST(nullif(split_part(split_part({c}, ' ', -1), ':', {k}), '') AS INTEGER)"
    return f"({part(1)} * 3600 + coalesce({part(2)}, 0) * 60 + coalesce({part(3)}, 0))"


def lookup(c: str, table: dict) -> str:
    q = lambda x: f"'{x}'" if isinstance(x, str) else str(x)
    return f"CASE {c} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + " END"


TYPES = ", ".join(map(str, K.RAIL_TYPES))
MASK = " || ".join(f"coalesce({d}, '0')" for d in K.DAYS)
OR_MASK = " || ".join(f"max(substr(coalesce(days_of_week, '0000000'), {i}, 1))" for i in range(1, 8))
MINUTES = half_up(f"coalesce(({seconds('arrival_time')} - {seconds('departure_time')} + CASE WHEN {seconds('arrival_time')} < {seconds('departure_time')} THEN 86400 ELSE 0 END) / CAST(60 AS DOUBLE), distance_km / {K.RAIL_SPEED_KMH} * CAST(60 AS DOUBLE))", 1)
CITY = "departure_city, departure_country, arrival_city, arrival_country"
_TRIP_COLUMNS = ("trip_short_name", "agency_name", "agency_timezone", "service_id", "route_id", "route_type", "route_short_name", "route_long_name", "days_of_week", "start_date", "end_date")
_KEYS = "source, mode, departure_station, departure_city, departure_country, departure_parent_station, departure_time, arrival_station, arrival_city, arrival_country, arrival_parent_station, arrival_time, route_type"
_REST = [c for c in K.GOLD_COLUMNS if c not in _KEYS.split(", ") and c != "days_of_week"]

AGENCY_NAMES = "(SELECT agency_id, min(agency_name) AS agency_name FROM v_agency GROUP BY 1)"


def events_sql(calendar: str) -> str:
    return f"""
        SELECT t.source, t.trip_id, t.route_id, t.service_id, t.trip_short_name, t.trip_headsign, r.route_type, r.route_short_name, r.route_long_name,
            r.agency_id, a.agency_name, a.agency_timezone, st.stop_id, s.stop_name, s.stop_lat, s.stop_lon, s.parent_station, st.stop_sequence,
            st.arrival_time, st.departure_time, c.days_of_week, c.start_date, c.end_date, substr(t.source, 1, 2) AS country
        FROM v_trips t JOIN rail_routes r USING (source, route_id) JOIN v_stop_times st USING (source, trip_id)
        LEFT JOIN v_stops s USING (source, stop_id) LEFT JOIN v_agency a ON a.source = t.source AND a.agency_id = r.agency_id
        LEFT JOIN {calendar} c USING (source, service_id)
        QUALIFY row_number() OVER (PARTITION BY t.source, t.trip_id, st.stop_sequence, st.stop_id ORDER BY arrival_time NULLS FIRST, departure_time NULLS FIRST) = 1"""


def good_sql(name: str) -> str:
    return f"""SELECT * FROM {name} e WHERE NOT EXISTS (SELECT 1 FROM {name} b WHERE b.source = e.source AND b.trip_id = e.trip_id
        AND (b.stop_lat IS NULL OR b.stop_lon IS NULL OR abs(b.stop_lat) > 90 OR abs(b.stop_lon) > 180 OR (abs(b.stop_lat) < 1e-9 AND abs(b.stop_lon) < 1e-9)))"""


def numbered_sql(name: str) -> str:
    return f"""SELECT * EXCLUDE (n_here, again) REPLACE (CAST(CASE WHEN again THEN row_number() OVER (PARTITION BY source, trip_id ORDER BY coalesce({seconds('arrival_time')}, -1), stop_sequence, stop_id) - 1 ELSE stop_sequence END AS INTEGER) AS stop_sequence)
        FROM (SELECT *, max(n_here) OVER (PARTITION BY source, trip_id) > 1 AS again FROM (SELECT *, count(*) OVER (PARTITION BY source, trip_id, stop_sequence) AS n_here FROM {name}))"""


def segments_sql(name: str) -> str:
    return f"SELECT *, round(({hav('stop_lat', 'stop_lon', 'lead(stop_lat) OVER w', 'lead(stop_lon) OVER w')}) * {K.DETOUR}) AS segment_dist_m FROM {name} WINDOW w AS (PARTITION BY source, trip_id ORDER BY stop_sequence)"


def fresh_sql(name: str) -> str:
    fresh = f"coalesce(TRY_CAST(end_date AS INTEGER) >= {K.EXPIRED_BEFORE}, true)"
    return f"""SELECT * FROM {name} WHERE {fresh} OR country NOT IN (
        SELECT country FROM {name} WHERE {fresh} GROUP BY country HAVING count(DISTINCT source || '|' || trip_id) >= {LEAST_TRIPS})"""


def night_sql(columns: str) -> str:
    return f"SELECT {columns}, coalesce(a.agency_name, split_part(n.agency_id, '/', 1)) || ' / ' || coalesce(b.agency_name, split_part(n.agency_id, '/', 2)) AS agency_name FROM v_night n LEFT JOIN {AGENCY_NAMES} a ON a.agency_id = split_part(n.agency_id, '/', 1) LEFT JOIN {AGENCY_NAMES} b ON b.agency_id = split_part(n.agency_id, '/', 2)"


def timetable_sql() -> str:
    return f"SELECT t.source, t.trip_id, t.trip_short_name, a.agency_name FROM v_trips t JOIN v_routes r USING (source, route_id) LEFT JOIN {AGENCY_NAMES} a ON a.agency_id = r.agency_id"


#: So many fresh trips a country of the given tables must keep for its expired ones to go.
LEAST_TRIPS = 200

#: The same steps for DuckDB, by name.
STEPS: dict[str, str] = {
    "rail_routes": f"SELECT * REPLACE (TRY_CAST(route_type AS INTEGER) AS route_type) FROM v_routes WHERE TRY_CAST(route_type AS INTEGER) IN ({TYPES})",
    "s_calendar": f"""SELECT source, service_id, coalesce(c.days_of_week, m.days_of_week) AS days_of_week, coalesce(c.start_date, m.start_date) AS start_date, coalesce(c.end_date, m.end_date) AS end_date
        FROM (SELECT source, service_id, {MASK} AS days_of_week, start_date, end_date FROM v_calendar) c FULL JOIN (
            SELECT source, service_id, {' || '.join(f"max(CASE WHEN isodow(day) = {k} THEN '1' ELSE '0' END)" for k in range(1, 8))} AS days_of_week, strftime(min(day), '%Y%m%d') AS start_date, strftime(max(day), '%Y%m%d') AS end_date
            FROM (SELECT source, service_id, CAST(strptime(replace(date, '-', ''), '%Y%m%d') AS DATE) AS day FROM v_calendar_dates WHERE exception_type = 1) GROUP BY source, service_id) m USING (source, service_id)""",
    "s_events": events_sql(f"(SELECT source, service_id, {MASK} AS days_of_week, start_date, end_date FROM v_calendar)"),
    "s_timetable_events": events_sql("s_calendar"),
    "s_typed": "SELECT * REPLACE (CASE WHEN route_type = 2 THEN coalesce(min(CASE WHEN route_type <> 2 THEN route_type END) OVER (PARTITION BY source, route_id), route_type) ELSE route_type END AS route_type) FROM s_timetable_events",
    "s_fresh": fresh_sql("s_typed"),
    "s_night": night_sql("n.source, n.trip_id, n.trip_short_name"),
    "s_night_events": f"""SELECT n.source, n.trip_id, n.route_id, n.service_id, n.trip_short_name, n.trip_headsign, 105 AS route_type, route_short_name, route_long_name, n.agency_id, agency_name,
            {lookup('country', K.ZONES)} AS agency_timezone, stop_id, stop_name, stop_lat, stop_lon, CAST(NULL AS VARCHAR) AS parent_station, stop_sequence, split_part(arrival_time, ' ', -1) AS arrival_time,
            split_part(departure_time, ' ', -1) AS departure_time, coalesce(days, '0000000') AS days_of_week, start_date, end_date, country, true AS is_night_train
        FROM v_night n JOIN (SELECT trip_id, agency_name FROM s_night) USING (trip_id) LEFT JOIN v_night_routes USING (route_id) JOIN v_night_times USING (trip_id)
        JOIN (SELECT *, CASE stop_country WHEN 'UK' THEN 'GB' ELSE stop_country END AS country FROM v_night_stops WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL) USING (stop_id)
        LEFT JOIN (SELECT service_id, {MASK} AS days, replace(start_date, '-', '') AS start_date, replace(end_date, '-', '') AS end_date FROM v_night_calendar) USING (service_id)
        WHERE stop_sequence IS NOT NULL""",
    "s_merged": "SELECT * FROM s_night_events UNION ALL BY NAME SELECT *, route_type = 105 AS is_night_train FROM s_fresh WHERE (source, trip_id) NOT IN (SELECT (source, trip_id) FROM s_l1 UNION ALL SELECT (source, trip_id) FROM s_l2)",
    "s_good": good_sql("s_events"),
    "s_numbered": numbered_sql("s_good"),
    "s_segments": segments_sql("s_numbered"),
    "s_merged_good": good_sql("s_merged"),
    "s_merged_numbered": numbered_sql("s_merged_good"),
    "s_merged_segments": segments_sql("s_merged_numbered"),
    "s_clean": """SELECT *, coalesce(sum(segment_dist_m) OVER (PARTITION BY source, trip_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS DOUBLE)) AS cumul_m
        FROM (SELECT * FROM s_merged_segments QUALIFY max(CASE WHEN segment_dist_m <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source, trip_id) = 0 AND count(*) OVER (PARTITION BY source, trip_id) > 1)""",
    "s_pairs": f"""SELECT a.source, a.trip_id, a.stop_sequence AS dep_stop_sequence, a.stop_id AS dep_stop_id, a.stop_name AS dep_stop_name, a.parent_station AS dep_parent_station,
            a.departure_time AS dep_departure_time, a.country AS dep_country, b.stop_sequence AS arr_stop_sequence, b.stop_id AS arr_stop_id, b.stop_name AS arr_stop_name, b.parent_station AS arr_parent_station,
            b.arrival_time AS arr_arrival_time, b.country AS arr_country, {half_up('(b.cumul_m - a.cumul_m) / CAST(1000 AS DOUBLE)', 2)} AS distance_km
        FROM s_clean a JOIN s_clean b ON a.source = b.source AND a.trip_id = b.trip_id AND a.stop_sequence < b.stop_sequence""",
    "s_timetable": timetable_sql(),
    "s_l1": "SELECT * FROM s_timetable WHERE lower(trim(trip_short_name)) IN (SELECT lower(trim(trip_short_name)) FROM s_night WHERE trip_short_name IS NOT NULL)",
    "s_l2": r"SELECT * FROM s_timetable t WHERE EXISTS (SELECT 1 FROM s_night n WHERE regexp_extract(n.trip_short_name, '\d{3,6}') = regexp_extract(t.trip_short_name, '\d{3,6}') AND regexp_extract(t.trip_short_name, '\d{3,6}') <> '' AND lower(split_part(n.agency_name, ' ', 1)) = lower(split_part(t.agency_name, ' ', 1)))",
    "s_stop_city": f"""SELECT source, stop_id, geonameid AS city_id, asciiname AS city_name, country_code AS city_country, metres FROM (
            SELECT s.source, s.stop_id, c.*, round({hav('stop_lat', 'stop_lon', 'latitude', 'longitude')}, 3) AS metres
            FROM v_stops s JOIN v_cities c ON {hav('stop_lat', 'stop_lon', 'latitude', 'longitude')} < {K.CITY_RADIUS_M})
        QUALIFY row_number() OVER (PARTITION BY source, stop_id ORDER BY metres, population DESC NULLS LAST, geonameid) = 1""",
    "s_night_city": f"""SELECT 'night' AS source, stop_id, geonameid AS city_id, asciiname AS city_name, country_code AS city_country, metres FROM (
            SELECT s.stop_id, c.*, round({hav('stop_lat', 'stop_lon', 'latitude', 'longitude')}, 3) AS metres
            FROM v_night_stops s JOIN v_cities c ON {hav('stop_lat', 'stop_lon', 'latitude', 'longitude')} < {K.CITY_RADIUS_M})
        QUALIFY row_number() OVER (PARTITION BY stop_id ORDER BY metres, population DESC NULLS LAST, geonameid) = 1""",
    "s_any_city": "SELECT * FROM s_stop_city UNION ALL SELECT * FROM s_night_city",
    "s_airports": f"""SELECT * FROM v_airports WHERE type IN ('small_airport', 'medium_airport', 'large_airport') AND iso_country IN ({', '.join(repr(c) for c in K.AIR_COUNTRIES)})
        AND (iso_country <> 'RU' OR (latitude_deg BETWEEN {K.EUROPE_BOX[0]} AND {K.EUROPE_BOX[1]} AND longitude_deg BETWEEN {K.EUROPE_BOX[2]} AND {K.EUROPE_BOX[3]}))""",
    "s_airport_city": f"""SELECT ident, geonameid AS city_id, asciiname AS city_name, country_code AS city_country, metres FROM (
            SELECT a.ident, c.*, round({hav('latitude_deg', 'longitude_deg', 'latitude', 'longitude')}, 3) AS metres
            FROM s_airports a JOIN v_cities c ON {hav('latitude_deg', 'longitude_deg', 'latitude', 'longitude')} < {K.CITY_RADIUS_M})
        QUALIFY row_number() OVER (PARTITION BY ident ORDER BY metres, population DESC NULLS LAST, geonameid) = 1""",
    "s_station_airport": f"""SELECT source, stop_id, ident, distance_km FROM (
            SELECT s.source, s.stop_id, a.ident, round({hav('stop_lat', 'stop_lon', 'latitude_deg', 'longitude_deg')} / CAST(1000 AS DOUBLE), 2) AS distance_km
            FROM v_stops s JOIN s_airports a ON {hav('stop_lat', 'stop_lon', 'latitude_deg', 'longitude_deg')} < {K.AIRPORT_RADIUS_M})
        QUALIFY row_number() OVER (PARTITION BY source, stop_id ORDER BY distance_km, ident) = 1 OR row_number() OVER (PARTITION BY ident ORDER BY distance_km, source, stop_id) = 1""",
    "s_air_pairs": f"""SELECT * FROM (SELECT a.ident AS origin_id, a.name AS origin_name, a.type AS origin_type, a.iso_country AS origin_country, b.ident AS dest_id, b.name AS dest_name, b.type AS dest_type, b.iso_country AS dest_country,
            round({hav('a.latitude_deg', 'a.longitude_deg', 'b.latitude_deg', 'b.longitude_deg')} / CAST(1000 AS DOUBLE), 2) AS distance_km
        FROM s_airports a JOIN s_airports b ON a.ident <> b.ident) WHERE distance_km >= {K.MIN_FLIGHT_KM}""",
    "s_air_typed": f"""SELECT *, CAST({lookup('trajet_type', {k: i for k, (i, _) in K.AIR_BLENDS.items()})} AS BIGINT) AS emission_ref FROM (SELECT *,
            CASE WHEN origin_type = 'small_airport' AND dest_type = 'small_airport' THEN CASE WHEN distance_km <= 1000 THEN 'small_small_1000km' END
                 WHEN 'small_airport' IN (origin_type, dest_type) AND 'medium_airport' IN (origin_type, dest_type) THEN CASE WHEN distance_km <= 1000 THEN 'small_medium_1000km' END
                 WHEN 'small_airport' IN (origin_type, dest_type) THEN CASE WHEN distance_km <= 1000 THEN 'small_large_1000km' END
                 WHEN dest_type = 'large_airport' THEN CASE origin_type WHEN 'medium_airport' THEN 'medium_large_unlimited' ELSE 'large_large_unlimited' END
                 WHEN distance_km <= 5000 THEN CASE origin_type WHEN 'medium_airport' THEN 'medium_medium_5000km' ELSE 'large_medium_5000km' END END AS trajet_type
        FROM s_air_pairs) WHERE trajet_type IS NOT NULL""",
    "s_latest": "SELECT entity_code, CAST(max(date) AS INTEGER) AS year, max_by(emissions_intensity_gco2_per_kwh, date) AS intensity FROM v_intensity WHERE entity_code NOT LIKE 'EU%' GROUP BY entity_code",
    "s_known": f"SELECT coalesce({lookup('entity_code', K.ISO2)}, entity_code) AS country_code, intensity FROM s_latest WHERE entity_code NOT IN {K.MICRO_CODES}",
    "s_intensity": f"""SELECT * FROM s_known UNION ALL SELECT * FROM (SELECT {lookup('country_code', {v: k for k, v in K.MICRO_STATES.items()})} AS country_code, intensity FROM s_known) WHERE country_code IS NOT NULL
        UNION ALL SELECT 'AD', avg(intensity) FROM s_known WHERE country_code IN ('FR', 'ES') HAVING count(*) = 2""",
    "s_air_base": """SELECT class, avg(kg_per_pkm) AS kg_per_pkm FROM (SELECT CASE split_part(label, ' ', 1) WHEN '20-50' THEN 'small' WHEN '51-100' THEN 'medium' WHEN '101-220' THEN 'medium' WHEN '>220' THEN 'large' END || '_' ||
            CASE split_part(label, ' ', 3) WHEN '<500' THEN 'short' WHEN '500-1000' THEN 'short' WHEN '1000-2000' THEN 'medium' WHEN '2000-5000' THEN 'medium' WHEN '>5000' THEN 'long' END AS class, kg_per_pkm
        FROM v_air_factors WHERE status = 'Valid generic' AND post_type IS NULL) GROUP BY class""",
    "s_air_factors": "SELECT emission_ref, trajet_type, round(sum(weight * coalesce(kg_per_pkm, 0.0)) * 1000, 3) AS g_per_pkm FROM (VALUES "
    + ", ".join(f"(CAST({i} AS BIGINT), '{k}', '{c}', CAST({w} AS DOUBLE))" for k, (i, b) in K.AIR_BLENDS.items() for c, w in b.items())
    + ") w(emission_ref, trajet_type, class, weight) LEFT JOIN s_air_base USING (class) GROUP BY emission_ref, trajet_type",
    "s_air_table": "SELECT CAST(row_number() OVER (ORDER BY class) AS BIGINT) AS emission_ref, round(kg_per_pkm * 1000, 3) AS g_per_pkm, 'Air ' || class || ', mean' AS detail FROM s_air_base WHERE class IS NOT NULL UNION ALL SELECT emission_ref, g_per_pkm, 'Air ' || trajet_type || ', ' || "
    + lookup("trajet_type", {k: " + ".join(f"{w} x {c}" for c, w in b.items()) for k, (_, b) in K.AIR_BLENDS.items()}) + " FROM s_air_factors",
    "s_rail_factors": f"""SELECT country_code, route_type, round(CASE WHEN route_type IN {K.ELECTRIC_TYPES} THEN p ELSE e * p + (1 - e) * {K.DIESEL_G_PKM} END, 3) AS g_per_pkm FROM (
            SELECT country_code, route_type, CAST(coalesce({lookup('country_code', K.ELECTRIFIED)}, {sum(K.ELECTRIFIED.values()) / len(K.ELECTRIFIED)}) AS DOUBLE) AS e,
                CAST(coalesce({lookup('route_type', K.ENERGY_USE)}, {K.ENERGY_USE_ELSE}) AS DOUBLE) * coalesce(intensity, (SELECT avg(intensity) FROM s_intensity)) AS p
            FROM (SELECT DISTINCT substr(source, 1, 2) AS country_code FROM v_feeds) c CROSS JOIN (VALUES {', '.join(f'({t})' for t in K.EMISSION_ROUTE_TYPES)}) t(route_type) LEFT JOIN s_intensity USING (country_code))""",
    "s_gold_rows": f"""SELECT p.source, p.trip_id, 'train' AS mode, coalesce(route_long_name, trip_short_name) AS destination, trip_short_name, agency_name, agency_timezone, service_id, route_id,
            CAST(t.route_type AS VARCHAR) AS route_type, route_short_name, route_long_name, dep_stop_name AS departure_station, d.city_name AS departure_city, dep_country AS departure_country,
            dep_departure_time AS departure_time, dep_parent_station AS departure_parent_station, arr_stop_name AS arrival_station, a.city_name AS arrival_city, arr_country AS arrival_country,
            arr_arrival_time AS arrival_time, arr_parent_station AS arrival_parent_station, start_date AS service_start_date, end_date AS service_end_date, days_of_week,
            t.route_type = 105 AS is_night_train, distance_km, g_per_pkm AS co2_per_pkm, {half_up('distance_km * g_per_pkm', 3)} AS emissions_co2
        FROM s_pairs p JOIN (SELECT source, trip_id, {', '.join(f'min({c}) AS {c}' for c in _TRIP_COLUMNS)} FROM s_clean GROUP BY source, trip_id) t USING (source, trip_id)
        LEFT JOIN s_any_city d ON d.source = p.source AND d.stop_id = dep_stop_id LEFT JOIN s_any_city a ON a.source = p.source AND a.stop_id = arr_stop_id
        LEFT JOIN s_rail_factors f ON f.country_code = dep_country AND f.route_type = t.route_type""",
    "s_train": "SELECT " + ", ".join(K.GOLD_COLUMNS) + f" FROM (SELECT {_KEYS}, {OR_MASK} AS days_of_week, " + ", ".join(f"arg_min({c}, row(trip_id, distance_km)) FILTER ({c} IS NOT NULL) AS {c}" for c in _REST) + f" FROM s_gold_rows GROUP BY {_KEYS})",
    "s_flown": """SELECT p.*, o.city_name AS origin_city, d.city_name AS dest_city, g_per_pkm AS co2_per_pkm FROM s_air_typed p
        LEFT JOIN s_airport_city o ON o.ident = origin_id LEFT JOIN s_airport_city d ON d.ident = dest_id LEFT JOIN s_air_factors f ON f.emission_ref = p.emission_ref""",
    "s_flight": "SELECT " + ", ".join({
        "source": "'ourairports' AS source", "trip_id": "origin_id || '__' || dest_id AS trip_id", "mode": "'flight' AS mode",
        "destination": "origin_name || ' - ' || dest_name AS destination", "trip_short_name": "origin_id || ' - ' || dest_id AS trip_short_name",
        "route_long_name": f"coalesce({lookup("split_part(trajet_type, '_', 3)", K.HAUL_LABELS)}, '{K.HAUL_ELSE}') || ' - ' || {lookup("split_part(trajet_type, '_', 1)", K.AIRPORT_LABELS)} || ' to ' || {lookup("split_part(trajet_type, '_', 2)", K.AIRPORT_LABELS)} AS route_long_name",
        "route_type": "trajet_type AS route_type", "departure_station": "origin_name AS departure_station", "departure_city": "origin_city AS departure_city", "departure_country": "origin_country AS departure_country",
        "arrival_station": "dest_name AS arrival_station", "arrival_city": "dest_city AS arrival_city", "arrival_country": "dest_country AS arrival_country", "is_night_train": "CAST(NULL AS BOOLEAN) AS is_night_train",
        "distance_km": "distance_km", "co2_per_pkm": "co2_per_pkm", "emissions_co2": f"{half_up('distance_km * co2_per_pkm', 3)} AS emissions_co2",
    }.get(c, f"CAST(NULL AS VARCHAR) AS {c}") for c in K.GOLD_COLUMNS) + " FROM s_flown",
    "s_gold": "SELECT * FROM s_train UNION ALL SELECT * FROM s_flight",
    "s_best_air": f"""SELECT origin_id AS dep_airport, dest_id AS arr_airport, distance_km, {half_up(f'distance_km / {K.FLIGHT_SPEED_KMH} * 60 + {K.FLIGHT_GROUND_MIN}', 1)} AS flight_min, {half_up('distance_km * co2_per_pkm', 3)} AS flight_co2 FROM s_flown
        QUALIFY row_number() OVER (PARTITION BY origin_id, dest_id ORDER BY distance_km) = 1""",
    "s_access": "SELECT city_name, substr(m.source, 1, 2) AS country, ident, min(distance_km) AS access_km FROM s_station_airport m JOIN s_stop_city c USING (source, stop_id) GROUP BY 1, 2, 3",
    "s_rail_best": f"""SELECT {CITY}, trip_id AS train_trip_id, distance_km AS train_distance_km, minutes AS train_duration_min, emissions_co2 AS train_emissions_co2
        FROM (SELECT *, {MINUTES} AS minutes FROM s_train WHERE departure_city IS NOT NULL AND arrival_city IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY {CITY} ORDER BY emissions_co2 NULLS LAST, minutes NULLS LAST, source, trip_id, departure_station, arrival_station, departure_time NULLS FIRST, arrival_time NULLS FIRST) = 1""",
    "s_city_flights": f"""SELECT {CITY}, dep_airport || '__' || arr_airport AS flight_candidate_id, 2 AS flight_correspondence_count, total_min AS flight_duration_min, km AS flight_distance_km, flight_co2 AS flight_emissions_co2 FROM (
            SELECT {CITY}, dep_airport, arr_airport, {half_up('f.distance_km + d.access_km + a.access_km', 2)} AS km, flight_co2, {half_up(f'flight_min + (d.access_km + a.access_km) / {K.ACCESS_SPEED_KMH} * 60', 1)} AS total_min
            FROM s_rail_best r JOIN s_access d ON d.city_name = departure_city AND d.country = departure_country JOIN s_access a ON a.city_name = arrival_city AND a.country = arrival_country
            JOIN s_best_air f ON f.dep_airport = d.ident AND f.arr_airport = a.ident)
        QUALIFY row_number() OVER (PARTITION BY {CITY} ORDER BY flight_co2 NULLS LAST, total_min, dep_airport, arr_airport) = 1""",
    "s_lone_flights": f"""SELECT 'ourairports' AS source, dep_airport || '__' || arr_airport AS trip_id, departure_station, departure_city, departure_country, arrival_station, arrival_city, arrival_country,
            dep_airport || '__' || arr_airport AS flight_candidate_id, 0 AS flight_correspondence_count, CAST(NULL AS DOUBLE) AS flight_duration_min, flight_distance_km, flight_emissions_co2 FROM (
            SELECT origin_name AS departure_station, dest_name AS arrival_station, origin_city AS departure_city, origin_country AS departure_country, dest_city AS arrival_city, dest_country AS arrival_country, origin_id AS dep_airport, dest_id AS arr_airport,
                distance_km AS flight_distance_km, {half_up('distance_km * co2_per_pkm', 3)} AS flight_emissions_co2
            FROM s_flown WHERE origin_city IS NOT NULL AND dest_city IS NOT NULL) ANTI JOIN s_rail_best USING ({CITY})
        QUALIFY row_number() OVER (PARTITION BY {CITY} ORDER BY flight_emissions_co2 NULLS LAST, flight_distance_km, dep_airport, arr_airport) = 1""",
    "s_connections": f"""SELECT source, trip_id, departure_station, departure_city, departure_country, arrival_station, arrival_city, arrival_country, departure_parent_station, arrival_parent_station, days_of_week,
            {MINUTES} AS train_duration_min, distance_km AS train_distance_km, emissions_co2 AS train_emissions_co2 FROM s_train WHERE departure_city IS NOT NULL AND arrival_city IS NOT NULL""",
    "s_compare": f"""SELECT *, CASE WHEN train_emissions_co2 IS NULL THEN 'flight' WHEN flight_emissions_co2 < train_emissions_co2 THEN 'flight' ELSE 'train' END AS best_mode FROM (
            SELECT * FROM s_connections LEFT JOIN s_city_flights USING ({CITY}) UNION ALL BY NAME SELECT * FROM s_lone_flights)""",
}


class Data(Views):
    """Views and the layers above them, for one run."""

    def stops_at(self) -> DataFrame:
        return self.stops.where(F.col("stop_lat").isNotNull()).select("source", "stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))

    def events_all(self) -> DataFrame:
        return rail.stop_events(self.trips, self.routes, self.stop_times, self.stops, self.agency, self.calendar)

    def full_calendar(self) -> DataFrame:
        return rail.reconstruct_calendar(self.calendar, self.calendar_dates)

    def agency_names(self) -> DataFrame:
        return self.agency.groupBy("agency_id").agg(F.min("agency_name").alias("agency_name"))

    def named_night(self) -> DataFrame:
        return rail.resolve_composite_ids(self.night, self.agency_names())

    def named_trips(self) -> DataFrame:
        named = self.trips.join(self.routes.select("source", "route_id", "agency_id"), ["source", "route_id"]).join(self.agency_names(), "agency_id", "left")
        return named.select("source", "trip_id", "trip_short_name", "agency_name")

    def night_stops_at(self) -> DataFrame:
        return self.night_stops.where("stop_lat is not null").select("stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))

    def night_events(self, cities: bool = True) -> DataFrame:
        """Stop events of night trains, with the cities of their stops where they are asked for."""
        stops = rail.with_city(self.night_stops, places.nearest_city(self.night_stops_at(), self.cities, ["stop_id"]), ("stop_id",)) if cities else self.night_stops
        return rail.night_stop_events(self.night, self.night_routes, self.night_times, stops, self.agency_names(), self.night_calendar)

    def merged(self, cities: bool = True) -> DataFrame:
        """The timetable's events with full calendars, specific route types and agencies, without expired services and trips
        that night trains match, and the night trains' events; with the cities of their stops where they are asked for.

        All of this is settled for trips, before the stop times are joined once.
        """
        rows = rail.enrich_route_type(rail.trip_rows(self.trips, self.routes, self.agency, self.full_calendar()))
        rows = rail.propagate_first_nonnull(rows, ["source", "route_id"], ["agency_id", "agency_name", "agency_timezone"], "trip_id")
        rows = settled(rows, "trip-rows")  # read three times below
        used = self.stop_times.where("stop_sequence is not null").select(*rail.TRIP)
        fresh = rail.expiry_filter_with_rescue(rows, LEAST_TRIPS, counted=rows.join(used, rail.TRIP, "left_semi"))
        kept = fresh.join(rail.matched_trips(self.named_night(), self.named_trips()), rail.TRIP, "left_anti")
        stops = rail.with_city(self.stops, self.stop_city()) if cities else self.stops
        timetable = rail.events_of(kept, self.stop_times, stops).withColumn("is_night_train", F.col("route_type") == 105)
        return timetable.unionByName(self.night_events(cities))

    def clean(self, cities: bool = True) -> DataFrame:
        return rail.clean_events(self.merged(cities))

    def ends(self) -> DataFrame:
        return rail.first_last_stop(self.clean(cities=False))

    def any_city(self) -> DataFrame:
        night = self.night_stops_at().withColumn("source", F.lit("night"))
        return places.nearest_city(self.stops_at().unionByName(night), self.cities, ["source", "stop_id"])

    def stop_city(self) -> DataFrame:
        return places.nearest_city(self.stops_at(), self.cities, ["source", "stop_id"])

    def air(self) -> DataFrame:
        return places.airport_filter(self.airports)

    def airport_city(self) -> DataFrame:
        return places.nearest_city(self.air().select("ident", F.col("latitude_deg").alias("lat"), F.col("longitude_deg").alias("lon")), self.cities, ["ident"])

    def matched(self) -> DataFrame:
        return places.station_airport_match(self.stops_at(), self.air())

    def rail_price(self) -> DataFrame:
        return places.rail_factors(self.feeds.select(F.substring("source", 1, 2).alias("country_code")).distinct(), places.intensity_by_country(self.intensity))

    def air_price(self) -> DataFrame:
        return places.air_factor_weighted(places.air_factor_base(self.air_factors))

    def train(self) -> DataFrame:
        return gold.gold_train(self.clean(), self.rail_price())

    def flown(self) -> DataFrame:
        return gold.flights(places.air_scenarios(places.airport_pairs(self.air())), self.airport_city(), self.air_price())

    def access(self) -> DataFrame:
        return gold.city_airport_access(self.matched(), self.stop_city())

    def layer(self, name: str) -> DataFrame:
        """A layer that several queries read, written once for each application and state of the given tables."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.fingerprint, name)
        if key not in _written:
            made = getattr(self, name)()
            _written[key] = by_folders(made, name, FOLDERS[name]) if name in FOLDERS else settled(made, name)
        return _written[key]

    def by_trip(self) -> DataFrame:
        """The gold layer in buckets of trip_id, for look-ups of a trip."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.fingerprint, "by_trip")
        if key not in _written:
            rows = self.gold()
            _written[key] = by_buckets(rows, "gold_by_trip", "trip_id", ["departure_time"], rows.count())
        return _written[key]

    def gold(self) -> DataFrame:
        return self.layer("train").unionByName(gold.gold_flight(self.layer("flown")))

    def compare(self) -> DataFrame:
        return gold.compare_best(self.layer("train"), self.access(), self.layer("flown"))


#: Layers that lie in folders, and the column that filters name. A flight's departure country is that of its origin.
FOLDERS = {"train": "departure_country", "flown": "origin_country", "compare": "departure_country"}

#: Layers already written in this process.
_written: dict[tuple[str, str, str, str], DataFrame] = {}


def query(name: str, make: Callable[[Data], DataFrame], sql: str | None) -> None:
    """Register a query and its SQL over views and steps."""
    QUERIES[name] = lambda spark, sf_dir: make(Data(spark, sf_dir))
    if sql is not None:
        SQL[name] = with_views(sql, STEPS)


EVENT = "source, trip_id, stop_sequence, stop_id"
query("gtfs_stop_events", lambda d: d.events_all().select(*EVENT.split(", "), "route_type", "agency_name", "days_of_week", "arrival_time"), f"SELECT {EVENT}, route_type, agency_name, days_of_week, arrival_time FROM s_events")
query("rail_filter", lambda d: rail.rail_filter(d.routes), "SELECT * FROM rail_routes")
query("drop_bad_coord_trips", lambda d: rail.drop_bad_coord_trips(d.events_all()).select(*EVENT.split(", ")), f"SELECT {EVENT} FROM s_good")
query("renumber_sequences", lambda d: rail.renumbered(rail.drop_bad_coord_trips(d.events_all())).select(*EVENT.split(", ")), f"SELECT {EVENT} FROM s_numbered")
query("segment_distance", lambda d: rail.segment_distance(rail.renumbered(rail.drop_bad_coord_trips(d.events_all()))).select(*EVENT.split(", "), "segment_dist_m"), f"SELECT {EVENT}, segment_dist_m FROM s_segments")
query("drop_zero_segment_trips", lambda d: rail.drop_zero_segment_trips(rail.segment_distance(rail.renumbered(rail.drop_bad_coord_trips(d.events_all())))).select(*EVENT.split(", ")), f"SELECT {EVENT} FROM s_segments QUALIFY max(CASE WHEN segment_dist_m <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY source, trip_id) = 0")
query("drop_single_stop_trips", lambda d: rail.drop_single_stop_trips(d.events_all()).select(*EVENT.split(", ")), f"SELECT {EVENT} FROM s_events QUALIFY count(*) OVER (PARTITION BY source, trip_id) > 1")
query("cumulative_distance", lambda d: d.clean(cities=False).select(*EVENT.split(", "), "cumul_m"), f"SELECT {EVENT}, cumul_m FROM s_clean")
query("od_pairs", lambda d: rail.od_pairs(d.clean(cities=False)).select("source", "trip_id", "dep_stop_sequence", "arr_stop_sequence", "distance_km"), "SELECT source, trip_id, dep_stop_sequence, arr_stop_sequence, distance_km FROM s_pairs")
query("enrich_route_type", lambda d: rail.enrich_route_type(d.events_all()).select(*EVENT.split(", "), "route_type"), f"SELECT {EVENT}, CASE WHEN route_type = 2 THEN coalesce(min(CASE WHEN route_type <> 2 THEN route_type END) OVER (PARTITION BY source, route_id), route_type) ELSE route_type END AS route_type FROM s_events")
query("propagate_first_nonnull", lambda d: rail.propagate_first_nonnull(d.trips, ["source", "route_id"], ["trip_short_name"], "trip_id").select("source", "trip_id", "trip_short_name"),
      "SELECT source, trip_id, coalesce(trip_short_name, arg_min(trip_short_name, trip_id) FILTER (trip_short_name IS NOT NULL) OVER (PARTITION BY source, route_id)) AS trip_short_name FROM v_trips")
query("reconstruct_calendar", lambda d: d.full_calendar(), "SELECT * FROM s_calendar")
query("expiry_filter_with_rescue", lambda d: rail.expiry_filter_with_rescue(d.events_all(), LEAST_TRIPS).select(*EVENT.split(", ")), f"SELECT {EVENT} FROM ({fresh_sql('s_events')})")
query("rescue_top_recent", lambda d: rail.rescue_top_recent(d.events_all(), 100).select(*EVENT.split(", ")),
      f"""SELECT {EVENT} FROM (SELECT *, TRY_CAST(end_date AS INTEGER) AS fin FROM s_events) QUALIFY coalesce(fin >= {K.EXPIRED_BEFORE}, true) OR
        row_number() OVER (PARTITION BY country, coalesce(fin >= {K.EXPIRED_BEFORE}, true) ORDER BY fin DESC, {EVENT}) <= 100""")
query("first_last_stop", lambda d: d.ends(), "SELECT source, trip_id, count(*) AS n_stops, " + ", ".join(f"{f}(stop_{c}, stop_sequence) AS {e}_stop_{c}" for e, f in (("first", "arg_min"), ("last", "arg_max")) for c in ("id", "name", "lat", "lon")) + " FROM s_clean GROUP BY source, trip_id")
query("resolve_composite_ids", lambda d: d.named_night().select("trip_id", "agency_name"), "SELECT trip_id, agency_name FROM s_night")
NIGHT = f"{EVENT}, trip_short_name, agency_name, agency_timezone, route_type, arrival_time, departure_time, days_of_week, start_date, end_date, country, is_night_train"
query("night_stop_events", lambda d: d.night_events(cities=False).select(*NIGHT.split(", ")), f"SELECT {NIGHT} FROM s_night_events")
query("silver_events", lambda d: d.merged(cities=False).select(*NIGHT.split(", ")), f"SELECT {NIGHT} FROM s_merged")


def _named(d: Data) -> tuple[DataFrame, DataFrame]:
    return d.named_night(), d.named_trips()


query("match_l1", lambda d: rail.match_l1(*_named(d)), "SELECT * FROM s_l1")
query("match_l2", lambda d: rail.match_l2(*_named(d)), "SELECT * FROM s_l2")
query("merge_prefer_night", lambda d: rail.merge_prefer(*_named(d)).select("source", "trip_id", "trip_short_name", "agency_name"), "SELECT * FROM s_night UNION ALL SELECT * FROM s_timetable WHERE (source, trip_id) NOT IN (SELECT (source, trip_id) FROM s_l1 UNION ALL SELECT (source, trip_id) FROM s_l2)")
query("upsert_by_source", lambda d: rail.upsert_by_source(d.trips.select("source", "trip_id", "route_id"), d.trips.where("source in ('DE/feed-1', 'CH/feed-2')").select("source", F.concat(F.lit("x"), "trip_id").alias("trip_id"), "route_id")),
      "SELECT source, CASE WHEN source IN ('DE/feed-1', 'CH/feed-2') THEN 'x' ELSE '' END || trip_id AS trip_id, route_id FROM v_trips")
query("nearest_city", lambda d: d.stop_city(), "SELECT * FROM s_stop_city")
query("nearest_city_airports", lambda d: d.airport_city(), "SELECT * FROM s_airport_city")
query("station_airport_match", lambda d: d.matched(), "SELECT * FROM s_station_airport")
query("with_unmatched", lambda d: places.with_unmatched(d.matched(), d.stops_at(), d.air()), "SELECT * FROM s_station_airport UNION ALL BY NAME SELECT source, stop_id FROM v_stops ANTI JOIN s_station_airport USING (source, stop_id) UNION ALL BY NAME SELECT ident FROM s_airports ANTI JOIN s_station_airport USING (ident)")
query("airport_filter", lambda d: d.air(), "SELECT * FROM s_airports")
query("airport_pairs", lambda d: places.airport_pairs(d.air()), "SELECT * FROM s_air_pairs")
query("air_scenarios", lambda d: places.air_scenarios(places.airport_pairs(d.air())), "SELECT * FROM s_air_typed")
query("air_emission_ref", lambda d: places.air_scenarios(places.airport_pairs(d.air())).groupBy("trajet_type", "emission_ref").agg(F.count(F.lit(1)).alias("n")), "SELECT trajet_type, emission_ref, count(*) AS n FROM s_air_typed GROUP BY 1, 2")
query("latest_per_country", lambda d: places.latest_per_country(d.intensity), "SELECT * FROM s_latest")
query("iso3_to_iso2", lambda d: places.intensity_by_country(d.intensity), "SELECT * FROM s_intensity")
query("air_factor_base", lambda d: places.air_factor_base(d.air_factors).select("class", F.round("kg_per_pkm", 6).alias("kg_per_pkm")), "SELECT class, round(kg_per_pkm, 6) AS kg_per_pkm FROM s_air_base")
query("air_factor_weighted", lambda d: d.air_price(), "SELECT * FROM s_air_factors")
query("air_factor_table", lambda d: places.air_factor_table(places.air_factor_base(d.air_factors)), "SELECT * FROM s_air_table")
query("rail_factor_table", lambda d: places.emission_table(d.rail_price(), places.air_factor_table(places.air_factor_base(d.air_factors))),
      "SELECT (SELECT max(emission_ref) FROM s_air_table) + row_number() OVER (ORDER BY country_code, route_type) AS emission_ref, country_code, route_type, g_per_pkm, 'Rail type ' || CAST(route_type AS VARCHAR) || ', ' || country_code AS detail FROM s_rail_factors UNION ALL BY NAME SELECT emission_ref, g_per_pkm, detail FROM s_air_table")
query("gold_train", lambda d: d.train(), "SELECT * FROM s_train")
query("gold_flight", lambda d: gold.gold_flight(d.flown()), "SELECT * FROM s_flight")
query("gold_union", lambda d: d.gold(), "SELECT * FROM s_gold")
query("best_flight_per_airport_pair", lambda d: gold.best_flight_per_airport_pair(d.flown()), "SELECT * FROM s_best_air")
query("city_airport_access", lambda d: d.access(), "SELECT * FROM s_access")
query("best_flight_per_city_pair", lambda d: gold.best_flight_per_city_pair(gold.train_city_pairs(d.layer("train")), d.access(), d.layer("flown")), "SELECT * FROM s_city_flights")
query("flights_without_rail", lambda d: gold.flights_without_rail(d.layer("flown"), gold.train_city_pairs(d.layer("train"))), "SELECT * FROM s_lone_flights")
query("compare_best", lambda d: d.compare(), "SELECT * FROM s_compare")
_ENDS = "source, trip_id, departure_station, departure_city, departure_country, arrival_station, arrival_city, arrival_country, departure_parent_station, arrival_parent_station, days_of_week"
query("compare_candidates", lambda d: gold.compare_candidates(d.layer("train"), d.access(), d.layer("flown")),
      f"""SELECT {_ENDS}, 'train' AS candidate_mode, trip_id AS candidate_id, 0 AS correspondence_count, train_duration_min AS duration_min, train_distance_km AS comparison_distance_km, train_emissions_co2 AS comparison_emissions_co2 FROM s_connections
      UNION ALL SELECT {_ENDS}, 'flight', flight_candidate_id, flight_correspondence_count, flight_duration_min, flight_distance_km, flight_emissions_co2 FROM s_connections JOIN s_city_flights USING ({CITY})""")
