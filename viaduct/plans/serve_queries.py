"""Read queries over the gold tables and audits of the feeds, each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators import audit, places, rail, serve
from .rail_queries import CITY, EVENT, MASK, MINUTES, Data, mean, query, seconds, total


def gold(d: Data) -> DataFrame:
    return d.gold()


def compare(d: Data) -> DataFrame:
    return d.layer("compare")


def pct(part: str, whole: str) -> str:
    return f"round(CAST(100 AS DOUBLE) * {part} / nullif({whole}, 0), 2)"



#: A trip that the look-ups show: source and trip id.
TRIP_SHOWN = ("FR/feed-0", "t789")
_LIST = "source, trip_id, mode, departure_station, departure_time, arrival_station, arrival_time, route_type, distance_km"
_NIGHT = "coalesce(is_night_train, false)"
_WEEK, _END = "substr(days_of_week, 1, 5)", "substr(days_of_week, 6, 2)"
_SEARCH = "source, trip_id, departure_station, departure_time, arrival_station, arrival_time, route_type"

query("list_routes_page", lambda d: serve.page(gold(d).select(*_LIST.split(", ")), [F.desc("distance_km"), *[F.col(c).asc_nulls_first() for c in _LIST.split(", ")[:8]]], 2, 50),
      f"SELECT {_LIST} FROM s_gold ORDER BY distance_km DESC, {', '.join(c + ' NULLS FIRST' for c in _LIST.split(', ')[:8])} LIMIT 50 OFFSET 50")
query("search_routes", lambda d: serve.search_routes(gold(d), "Supplier#00000000", "Supplier#00000001", "2023-06-01", 1).select(*_SEARCH.split(", "), "direction"),
      f"""SELECT {_SEARCH}, 'outbound' AS direction FROM s_gold WHERE service_start_date <= '20230601' AND service_end_date >= '20230601' AND substr(days_of_week, 1, 1) = '1' AND contains(departure_station, 'Supplier#00000000') AND contains(arrival_station, 'Supplier#00000001')
      UNION ALL SELECT {_SEARCH}, 'return' FROM s_gold WHERE service_start_date <= '20230601' AND service_end_date >= '20230601' AND substr(days_of_week, 1, 1) = '1' AND contains(departure_station, 'Supplier#00000001') AND contains(arrival_station, 'Supplier#00000000')""")
_TRIP_ROWS = "SELECT {0} FROM s_gold WHERE trip_id = '{1}' AND source = '{2}'"
query("route_detail", lambda d: serve.route_detail(d.by_trip(), TRIP_SHOWN[1], TRIP_SHOWN[0]), _TRIP_ROWS.format("*", TRIP_SHOWN[1], TRIP_SHOWN[0]))
query("route_detail_country", lambda d: serve.route_detail(d.by_trip(), TRIP_SHOWN[1], departure_country=TRIP_SHOWN[0][:2].lower()).select(*_LIST.split(", ")), f"SELECT {_LIST} FROM s_gold WHERE trip_id = '{TRIP_SHOWN[1]}' AND departure_country = '{TRIP_SHOWN[0][:2]}'")
query("carbon_trip", lambda d: serve.carbon_trip(d.by_trip(), TRIP_SHOWN[1], TRIP_SHOWN[0], TRIP_SHOWN[0][:2]), _TRIP_ROWS.format(", ".join(serve.CARBON), TRIP_SHOWN[1], TRIP_SHOWN[0]) + f" AND departure_country = '{TRIP_SHOWN[0][:2]}'")
query("routes_from", lambda d: serve.routes_from(gold(d).where("mode = 'train'"), places.intensity_by_country(d.intensity).where("intensity < 300")).select(*_LIST.split(", ")),
      f"SELECT {_LIST} FROM s_gold WHERE mode = 'train' AND departure_country IN (SELECT country_code FROM s_intensity WHERE intensity < 300)")
query("carbon_ranking", lambda d: serve.carbon_ranking(compare(d), 100), f"SELECT {CITY}, round(CAST(100 AS DOUBLE) * (flight_emissions_co2 - train_emissions_co2) / flight_emissions_co2, 2) AS co2_saving_pct FROM s_compare WHERE train_emissions_co2 IS NOT NULL AND flight_emissions_co2 > 0 ORDER BY co2_saving_pct DESC, {CITY} LIMIT 100")
query("carbon_factors", lambda d: serve.carbon_factors(gold(d)), "SELECT departure_country, mode, is_night_train, co2_per_pkm, count(*) AS n, string_agg(DISTINCT route_type, ',' ORDER BY route_type) AS route_types FROM s_gold GROUP BY 1, 2, 3, 4")
query("day_night_coverage", lambda d: serve.day_night_coverage(gold(d)), "SELECT departure_country, is_night_train, count(*) AS n, count(DISTINCT agency_name) AS agencies, count(DISTINCT departure_city) AS cities, count(DISTINCT arrival_country) AS countries, " + mean('distance_km', 2, 1) + " AS mean_km FROM s_gold WHERE mode = 'train' GROUP BY 1, 2")
query("day_night_emissions", lambda d: serve.day_night_emissions(gold(d)), f"SELECT departure_country, {mean('emissions_co2', 3, 2, 'FILTER (is_night_train)')} AS night_co2, {mean('emissions_co2', 3, 2, 'FILTER (NOT is_night_train)')} AS day_co2, count(*) FILTER (is_night_train) AS n_night, count(*) FILTER (NOT is_night_train) AS n_day FROM s_gold WHERE mode = 'train' GROUP BY 1 HAVING count(*) FILTER (is_night_train) > 0")
query("day_night_summary", lambda d: serve.day_night_summary(gold(d)), "SELECT is_night_train, count(DISTINCT departure_station || '|' || arrival_station) AS pairs, " + mean('distance_km', 2, 1) + " AS mean_km, round(quantile_cont(distance_km, 0.5), 2) AS median_km, count(*) AS n FROM s_gold WHERE mode = 'train' GROUP BY 1")
query("completeness", lambda d: serve.completeness(gold(d), []), "SELECT count(*) AS n, " + ", ".join(f"{pct(f'count({c})', 'count(*)')} AS {c}_pct" for c in serve.FILLED) + " FROM s_gold")
query("completeness_by_country", lambda d: serve.completeness(gold(d).where("mode = 'train'"), ["departure_country"]), "SELECT departure_country, count(*) AS n, " + ", ".join(f"{pct(f'count({c})', 'count(*)')} AS {c}_pct" for c in serve.FILLED if c != "departure_country") + " FROM s_gold WHERE mode = 'train' GROUP BY 1")
query("coverage_countries", lambda d: serve.coverage_countries(gold(d)), f"SELECT *, {pct('trains', 'n')} AS train_pct, {pct('nights', 'trains')} AS night_pct FROM (SELECT departure_country, count(*) AS n, count(*) FILTER (mode = 'train') AS trains, count(*) FILTER (mode = 'flight') AS flights, count(*) FILTER ({_NIGHT}) AS nights FROM s_gold GROUP BY 1)")
query("coverage_cities", lambda d: serve.coverage_cities(gold(d), "departure", 30), "SELECT departure_city AS city, departure_country AS country, count(*) AS n, count(DISTINCT arrival_country) AS other_countries FROM s_gold WHERE departure_city IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, city, country LIMIT 30")
query("coverage_cities_arrival", lambda d: serve.coverage_cities(gold(d), "arrival", 30), "SELECT arrival_city AS city, arrival_country AS country, count(*) AS n, count(DISTINCT departure_country) AS other_countries FROM s_gold WHERE arrival_city IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, city, country LIMIT 30")
query("schedule_patterns", lambda d: serve.schedule_patterns(gold(d)), f"SELECT departure_country, CASE WHEN days_of_week = '1111111' THEN 'daily' WHEN days_of_week = '0000000' OR days_of_week IS NULL THEN 'none' WHEN {_WEEK} <> '00000' AND {_END} = '00' THEN 'weekdays only' WHEN {_WEEK} = '00000' AND {_END} <> '00' THEN 'weekend only' ELSE 'other' END AS pattern, count(*) AS n FROM s_gold WHERE mode = 'train' GROUP BY 1, 2")
query("compare_coverage", lambda d: serve.compare_coverage(gold(d), compare(d)), f"SELECT departure_country, trips, coalesce(compared, 0) AS compared, {pct('coalesce(compared, 0)', 'trips')} AS compared_pct, {pct('train_wins', 'compared')} AS train_win_pct FROM (SELECT departure_country, count(DISTINCT trip_id) AS trips FROM s_gold WHERE mode = 'train' GROUP BY 1) LEFT JOIN (SELECT departure_country, count(*) AS compared, count(*) FILTER (best_mode = 'train') AS train_wins FROM s_compare GROUP BY 1) USING (departure_country)")
_FIGURES = {
    "total_routes": "count(*)", "total_train": "count(*) FILTER (mode = 'train')", "total_flight": "count(*) FILTER (mode = 'flight')", **{k: f"count(DISTINCT {c})" for k, c in serve.DISTINCT_FIGURES.items()},
    "night_train_routes": "count(*) FILTER (mode = 'train' AND is_night_train)", "day_train_routes": "count(*) FILTER (mode = 'train' AND NOT is_night_train)",
    "unclassified_routes": "count(*) FILTER (mode = 'train' AND is_night_train IS NULL)", **{k: pct(f"count({c})", "count(*)") for k, c in serve.FILLED_FIGURES.items()},
}
query("quality_summary", lambda d: serve.quality_summary(gold(d), compare(d)),
      "SELECT * FROM (SELECT " + ", ".join(f"{v} AS {k}" for k, v in _FIGURES.items()) + " FROM s_gold), (SELECT count(*) AS total_comparisons, count(*) FILTER (best_mode = 'train') AS train_wins_total, count(*) FILTER (best_mode = 'flight') AS flight_wins_total FROM s_compare)")
_CITIES = """SELECT *, stations > 0 AS has_station, flights > 0 AS has_airport FROM (SELECT departure_city AS city, departure_country AS country, count(DISTINCT departure_station) AS stations, count(*) FILTER (mode = 'train') AS trains,
      count(*) FILTER (mode = 'flight') AS flights, count(DISTINCT CASE WHEN mode = 'train' AND is_night_train THEN trip_id END) AS nights, count(DISTINCT arrival_city) AS destinations FROM s_gold WHERE departure_city IS NOT NULL GROUP BY 1, 2)"""
query("list_cities", lambda d: serve.list_cities(gold(d)), _CITIES)
query("list_cities_filtered", lambda d: serve.list_cities(gold(d), country="fr", search="city 1", has_station=True, has_airport=False), f"SELECT * FROM ({_CITIES}) WHERE country = 'FR' AND contains(lower(city), 'city 1') AND has_station AND NOT has_airport")
_STATIONS = f"""SELECT departure_station AS station, departure_city AS city, departure_country AS country, departure_parent_station AS parent_station, count(*) AS departures, count(DISTINCT arrival_city) AS destinations, count(DISTINCT arrival_station) AS stops,
      count(DISTINCT arrival_country) AS countries, count(*) FILTER ({_NIGHT}) AS nights, count(*) FILTER (NOT {_NIGHT}) AS days, {mean('distance_km', 2, 1)} AS mean_km, coalesce(string_agg(DISTINCT agency_name, ', ' ORDER BY agency_name), '') AS operators
      FROM s_gold WHERE departure_station IS NOT NULL AND """
for _mode, _name in (("train", "list_stations"), ("flight", "list_airports")):
    query(_name, lambda d, m=_mode: serve.list_stations(gold(d), m), f"{_STATIONS} mode = '{_mode}' GROUP BY 1, 2, 3, 4")
query("list_stations_filtered", lambda d: serve.list_stations(gold(d), "train", city="City", country="fr", search="Supplier#00000000"), f"{_STATIONS} mode = 'train' AND departure_country = 'FR' AND contains(lower(departure_city), 'city') AND contains(departure_station, 'Supplier#00000000') GROUP BY 1, 2, 3, 4")
query("stats_operators", lambda d: serve.stats_operators(gold(d)), f"SELECT agency_name, count(*) AS n, count(DISTINCT trip_id) AS trips, {total('distance_km', 2, 2)} AS km, {mean('co2_per_pkm', 3, 2)} AS mean_co2_per_pkm FROM s_gold WHERE mode = 'train' AND agency_name IS NOT NULL GROUP BY 1")
query("stats_distances", lambda d: serve.stats_distances(gold(d), 250), "SELECT CAST(floor(distance_km / 250) * 250 AS BIGINT) AS from_km, mode, is_night_train, count(*) AS n FROM s_gold GROUP BY 1, 2, 3")
query("emissions_by_distance", lambda d: serve.emissions_by_distance(gold(d)), f"SELECT CAST(floor(distance_km / 100) * 100 AS BIGINT) AS from_km, {mean('emissions_co2', 3, 1, "FILTER (mode = 'train')")} AS train, {mean('emissions_co2', 3, 1, "FILTER (mode = 'flight')")} AS flight FROM s_gold GROUP BY 1")
query("country_balance_two_sided", lambda d: serve.country_balance_two_sided(gold(d), 20), "SELECT departure_country AS country, count(*) FILTER (is_night_train) AS nights, count(*) FILTER (NOT is_night_train) AS days FROM (SELECT departure_country, is_night_train FROM s_gold WHERE mode = 'train' UNION ALL SELECT arrival_country, is_night_train FROM s_gold WHERE mode = 'train' AND arrival_country <> departure_country) GROUP BY 1 ORDER BY nights + days DESC, country LIMIT 20")

# ---- audits
query("null_profile", lambda d: audit.null_profile(d.trips), " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, {pct(f'(count(*) - count({c}))', 'count(*)')} AS pct_null FROM v_trips" for c in ("source", "trip_id", "route_id", "service_id", "trip_short_name", "trip_headsign")))
query("column_presence", lambda d: audit.column_presence(d.trips), " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {pct('count(*) FILTER (a)', 'count(*)')} AS pct_feeds FROM (SELECT source, bool_or({c} IS NOT NULL) AS a FROM v_trips GROUP BY source)" for c in ("trip_id", "route_id", "service_id", "trip_short_name", "trip_headsign")))
query("feed_volumetry", lambda d: audit.feed_volumetry(d.trips), "SELECT count(*) AS feeds, CAST(sum(n) AS BIGINT) AS rows, quantile_cont(n, 0.5) AS median, round(avg(n), 2) AS mean, max(n) AS largest FROM (SELECT source, count(*) AS n FROM v_trips GROUP BY source)")
query("rail_share", lambda d: audit.rail_share(d.routes, rail.rail_filter(d.routes)), f"SELECT source, routes, rail_routes, {pct('(routes - rail_routes)', 'routes')} AS other_pct FROM (SELECT source, count(*) AS routes FROM v_routes GROUP BY 1) JOIN (SELECT source, count(*) AS rail_routes FROM rail_routes GROUP BY 1) USING (source)")
query("cross_source_collisions", lambda d: audit.cross_source_collisions(d.stops, "stop_id"), "SELECT stop_id, count(DISTINCT source) AS sources FROM v_stops GROUP BY 1 HAVING count(DISTINCT source) > 1")
query("cardinality_violations", lambda d: audit.cardinality_violations(d.stop_times, ["source", "trip_id", "stop_sequence"]), "SELECT source, trip_id, stop_sequence, count(*) AS n FROM v_stop_times GROUP BY 1, 2, 3 HAVING count(*) > 1")
query("semantic_duplicates", lambda d: audit.semantic_duplicates(d.stop_times, ["source", "trip_id", "stop_sequence", "stop_id"]), "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, round(CAST(100 AS DOUBLE) * (sum(n) - count(*)) / sum(n), 3) AS repeat_pct FROM (SELECT count(*) AS n FROM v_stop_times GROUP BY source, trip_id, stop_sequence, stop_id)")
query("trip_topology", lambda d: audit.trip_topology(d.stop_times), "SELECT n AS stops, count(*) AS trips FROM (SELECT count(*) AS n FROM v_stop_times GROUP BY source, trip_id) GROUP BY n")
query("mode_distribution", lambda d: audit.mode_distribution(d.events_all()), f"SELECT route_type, count(*) AS n, count(DISTINCT source || '|' || trip_id) AS trips, {pct('count(*)', 'CAST(sum(count(*)) OVER () AS BIGINT)')} AS pct FROM s_events GROUP BY route_type")
query("fill_rate_by_country", lambda d: audit.fill_rate(d.events_all(), "agency_name", "country"), f"SELECT country, count(*) AS n, {pct('count(agency_name)', 'count(*)')} AS pct_filled FROM s_events GROUP BY 1")
query("top_values", lambda d: audit.top_values(d.trips, "trip_short_name", 20), "SELECT trip_short_name, count(*) AS n FROM v_trips GROUP BY 1 ORDER BY n DESC, trip_short_name NULLS FIRST LIMIT 20")
query("case_variants", lambda d: audit.case_variants(d.trips.select("trip_short_name").unionByName(d.night.select("trip_short_name")), "trip_short_name"), "SELECT lower(x) AS lowered, string_agg(DISTINCT x, '|' ORDER BY x) AS variants FROM (SELECT trip_short_name AS x FROM v_trips UNION ALL SELECT trip_short_name FROM v_night) WHERE x IS NOT NULL GROUP BY 1 HAVING count(DISTINCT x) > 1")
query("naming_contract", lambda d: d.routes.where(C.blank_to_null(F.col("route_short_name")).isNull() & C.blank_to_null(F.col("route_long_name")).isNull()).select("source", "route_id"), f"SELECT source, route_id FROM v_routes WHERE coalesce(trim(route_short_name) IN {K.BLANKS}, true) AND coalesce(trim(route_long_name) IN {K.BLANKS}, true)")
query("time_format_audit", lambda d: audit.time_format_audit(d.stop_times, "departure_time"), rf"SELECT source, count(*) AS n, count(*) - count(departure_time) AS missing, count(*) FILTER (NOT regexp_matches(departure_time, '^\d{{1,2}}:\d{{2}}:\d{{2}}$')) AS bad, count(*) FILTER ({seconds('departure_time')} >= 86400) AS past_midnight, CAST(max(floor({seconds('departure_time')} / CAST(3600 AS DOUBLE))) AS INTEGER) AS max_hour FROM v_stop_times GROUP BY 1")
query("bbox_audit", lambda d: audit.bbox_audit(d.stops), "SELECT source, min(stop_lat) AS south, max(stop_lat) AS north, min(stop_lon) AS west, max(stop_lon) AS east, count(*) FILTER (stop_lat IS NULL OR stop_lon IS NULL OR (abs(stop_lat) < 1e-9 AND abs(stop_lon) < 1e-9)) AS bad FROM v_stops GROUP BY 1")
query("timezone_audit", lambda d: audit.timezone_audit(d.agency), "SELECT agency_timezone, count(*) AS n, count(DISTINCT source) AS sources, count(DISTINCT agency_id) AS operators FROM v_agency WHERE agency_timezone IS NULL OR agency_timezone NOT LIKE 'Europe/%' GROUP BY 1")
query("calendar_audit", lambda d: audit.calendar_audit(d.calendar, K.EXPIRED_BEFORE), f"SELECT {MASK} AS days_of_week, count(*) AS n, min(start_date) AS first, max(end_date) AS last, count(*) FILTER (start_date > end_date) AS reversed, count(*) FILTER (TRY_CAST(end_date AS INTEGER) < {K.EXPIRED_BEFORE}) AS expired FROM v_calendar GROUP BY 1")
query("threshold_sensitivity", lambda d: audit.threshold_sensitivity(d.events_all(), [20230101, 20240101, 20250101, 20260101]), " UNION ALL ".join(f"SELECT {c} AS cutoff, count(*) FILTER (coalesce(TRY_CAST(end_date AS INTEGER) >= {c}, true)) AS kept FROM s_events" for c in (20230101, 20240101, 20250101, 20260101)))
query("attrition_by_country", lambda d: audit.attrition(d.events_all(), rail.drop_bad_coord_trips(d.events_all()), "country"), f"SELECT country, before, after, before - after AS lost, {pct('after', 'before')} AS pct_kept FROM (SELECT country, count(*) AS before FROM s_events GROUP BY 1) JOIN (SELECT country, count(*) AS after FROM s_good GROUP BY 1) USING (country)")
query("country_coverage_sets", lambda d: audit.country_coverage_sets(d.feeds.select(F.substring("source", 1, 2).alias("country")), ["FR", "DE", "PT", "NO", "CH"]), "SELECT x AS country, 'absent' AS status FROM (VALUES ('FR'), ('DE'), ('PT'), ('NO'), ('CH')) t(x) WHERE x NOT IN (SELECT substr(source, 1, 2) FROM v_feeds) UNION ALL SELECT DISTINCT substr(source, 1, 2), 'extra' FROM v_feeds WHERE substr(source, 1, 2) NOT IN ('FR', 'DE', 'PT', 'NO', 'CH')")
query("mask_subsumes", lambda d: audit.mask_subsumes(d.events_all(), ["source", "route_id"]), "SELECT DISTINCT a.source, a.route_id, a.days_of_week AS outer_mask, b.days_of_week AS inner_mask FROM (SELECT DISTINCT source, route_id, days_of_week FROM s_events WHERE days_of_week IS NOT NULL) a JOIN (SELECT DISTINCT source, route_id, days_of_week FROM s_events WHERE days_of_week IS NOT NULL) b ON a.source = b.source AND a.route_id = b.route_id AND a.days_of_week <> b.days_of_week AND " + " AND ".join(f"substr(a.days_of_week, {i}, 1) >= substr(b.days_of_week, {i}, 1)" for i in range(1, 8)))
query("duplicate_groups", lambda d: audit.duplicate_groups(d.events_all(), ["stop_name", "arrival_time"]), "SELECT stop_name, arrival_time, count(*) AS n, count(DISTINCT source) AS sources FROM s_events GROUP BY 1, 2 HAVING count(*) > 1")
query("similar_names", lambda d: audit.similar_names(d.cities, "asciiname"), "SELECT a.x AS name, b.x AS other, round(1 - levenshtein(a.x, b.x) / CAST(greatest(length(a.x), length(b.x)) AS DOUBLE), 4) AS similarity FROM (SELECT DISTINCT asciiname AS x FROM v_cities) a JOIN (SELECT DISTINCT asciiname AS x FROM v_cities) b ON a.x < b.x AND abs(length(a.x) - length(b.x)) <= 3 WHERE 1 - levenshtein(a.x, b.x) / CAST(greatest(length(a.x), length(b.x)) AS DOUBLE) > 0.8")
query("route_type_cast", lambda d: d.routes.groupBy("route_type", F.col("route_type").try_cast("int").alias("as_int")).agg(F.count(F.lit(1)).alias("n")), "SELECT route_type, TRY_CAST(route_type AS INTEGER) AS as_int, count(*) AS n FROM v_routes GROUP BY 1, 2")

# ---- columns
query("blank_to_null", lambda d: d.routes.select("source", "route_id", C.blank_to_null(F.col("route_short_name")).alias("route_short_name"), C.blank_to_null(F.col("route_long_name")).alias("route_long_name")), f"SELECT source, route_id, CASE WHEN trim(route_short_name) NOT IN {K.BLANKS} THEN route_short_name END AS route_short_name, CASE WHEN trim(route_long_name) NOT IN {K.BLANKS} THEN route_long_name END AS route_long_name FROM v_routes")
query("fix_timezone", lambda d: d.agency.select("source", "agency_id", C.fix_timezone(F.col("agency_timezone"), F.substring("source", 1, 2)).alias("agency_timezone")), "SELECT source, agency_id, CASE WHEN agency_timezone IS NULL OR agency_timezone IN ('CET', 'UTC') THEN coalesce(CASE substr(source, 1, 2) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.ZONES.items()) + " END, agency_timezone) ELSE agency_timezone END AS agency_timezone FROM v_agency")
query("hms_to_seconds", lambda d: d.stop_times.select(*EVENT.split(", "), C.hms_to_seconds(F.col("departure_time")).alias("s")), f"SELECT {EVENT}, {seconds('departure_time')} AS s FROM v_stop_times")
query("norm_date8", lambda d: d.calendar_dates.select("source", "service_id", "exception_type", C.norm_date8(F.col("date")).alias("date")), "SELECT source, service_id, exception_type, replace(date, '-', '') AS date FROM v_calendar_dates")
query("days_mask", lambda d: d.calendar.select("source", "service_id", C.days_mask().alias("days_of_week")), f"SELECT source, service_id, {MASK} AS days_of_week FROM v_calendar")
query("mask_or", lambda d: d.calendar.select("source", C.days_mask().alias("m")).groupBy("source").agg(C.mask_or(F.col("m")).alias("m")), "SELECT source, " + " || ".join(f"max({c})" for c in K.DAYS) + " AS m FROM v_calendar GROUP BY source")
query("haversine_m", lambda d: d.airports.select("ident", F.round(C.haversine_m(F.col("latitude_deg"), F.col("longitude_deg"), F.lit(48.85), F.lit(2.35)), 1).alias("m")), "SELECT ident, round(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(48.85 - latitude_deg) / 2), 2) + cos(radians(latitude_deg)) * cos(radians(48.85)) * pow(sin(radians(2.35 - longitude_deg) / 2), 2)))), 1) AS m FROM v_airports")
query("train_numbers", lambda d: d.trips.select("source", "trip_id", C.train_number(F.col("trip_short_name")).alias("number")), r"SELECT source, trip_id, regexp_extract(trip_short_name, '\d{3,6}') AS number FROM v_trips")
query("title_case", lambda d: d.routes.select("source", "route_id", C.selective_title(F.col("route_long_name")).alias("route_long_name")), "SELECT source, route_id, CASE WHEN route_long_name = upper(route_long_name) AND contains(route_long_name, ' - ') THEN array_to_string(list_transform(string_split(route_long_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') ELSE route_long_name END AS route_long_name FROM v_routes")
query("trip_duration_min", lambda d: gold(d).where("mode = 'train'").groupBy("departure_country").agg(C.exact_mean(C.trip_duration_min(F.col("departure_time"), F.col("arrival_time"), F.col("distance_km")), 1, 2).alias("mean_min")), f"SELECT departure_country, {mean(MINUTES, 1, 2)} AS mean_min FROM s_gold WHERE mode = 'train' GROUP BY 1")
