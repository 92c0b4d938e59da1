"""Queries of the further operators, each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import audit, extra
from .rail_queries import CITY, EVENT, OR_MASK, Data, hav, half_up, mean, query
from .serve_queries import compare, gold, pct

AGENCIES = {"FR/feed-0": ("X", "Line X", "Europe/Paris"), "DE/feed-1": ("Y", "Line Y", "Europe/Berlin")}


def _case(i: int) -> str:
    return "CASE source " + " ".join(f"WHEN '{k}' THEN '{v[i]}'" for k, v in AGENCIES.items()) + " END"


def _agency(d: Data):
    return d.agency.select("source", F.col("agency_id").alias("id"), "agency_id", "agency_name", "agency_timezone")


def _priced(d: Data):
    """Trips with a factor that every fifth operator lacks."""
    known = F.when(F.col("stop_sequence") % 2 == 0, F.col("route_type") / 10.0)
    return d.events_all().select(*EVENT.split(", "), "agency_name", "country", known.alias("factor"))


_GEO = "SELECT source, trip_id, " + ", ".join(f"{f}(stop_{c}, stop_sequence) AS {e}_{c}" for e, f in (("f", "arg_min"), ("l", "arg_max")) for c in ("lat", "lon")) + " FROM s_clean WHERE {} GROUP BY source, trip_id"
_PRICED = f"SELECT {EVENT}, agency_name, country, CASE WHEN stop_sequence % 2 = 0 THEN route_type / CAST(10 AS DOUBLE) END AS factor FROM s_events"
_PAIR_KEYS = "departure_station, arrival_station, departure_time, arrival_time"

for _fill in (False, True):
    query("override_agency" + "_fill" * _fill, lambda d, f=_fill: extra.override_agency(_agency(d), AGENCIES, f),
          "SELECT source, agency_id AS id, " + ", ".join(f"coalesce({c if _fill else _case(i)}, {_case(i) if _fill else c}) AS {c}" for i, c in enumerate(("agency_id", "agency_name", "agency_timezone"))) + " FROM v_agency")
query("canon_agency_name", lambda d: d.agency.select("source", "agency_id", extra.canon_name(F.col("agency_name"), {"operator 3 rail": "Operator Three"}).alias("agency_name")), "SELECT source, agency_id, CASE WHEN lower(agency_name) = 'operator 3 rail' THEN 'Operator Three' ELSE agency_name END AS agency_name FROM v_agency")
query("multi_calendar_groups", lambda d: extra.multi_calendar_groups(d.events_all(), ["source", "stop_id", "arrival_time"]), "SELECT source, stop_id, arrival_time, CAST(count(DISTINCT days_of_week) AS INTEGER) AS n, string_agg(DISTINCT days_of_week, ',' ORDER BY days_of_week) AS masks FROM s_events WHERE days_of_week IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT days_of_week) > 1")
query("fallback_factor", lambda d: extra.fallback_factor(_priced(d), "factor", "agency_name", "country").select(*EVENT.split(", "), "factor"),
      f"SELECT {EVENT}, round(coalesce(factor, CASE WHEN agency_name IS NOT NULL THEN avg(factor) OVER (PARTITION BY agency_name) END, avg(factor) OVER (PARTITION BY country), avg(factor) OVER ()), 4) AS factor FROM ({_PRICED})")
query("segment_emissions", lambda d: extra.segment_emissions(d.clean(cities=False).withColumn("f", F.col("route_type") / 10.0), "f").select(*EVENT.split(", "), "segment_kg"), f"SELECT {EVENT}, {half_up('route_type / CAST(10 AS DOUBLE) * segment_dist_m / CAST(1000000 AS DOUBLE)', 2)} AS segment_kg FROM s_clean")
query("surrogate_keys", lambda d: extra.surrogate_keys(d.stop_city().select("city_name", "city_country").distinct(), ["city_country", "city_name"], "city_id"), "SELECT city_name, city_country, CAST(row_number() OVER (ORDER BY city_country, city_name) AS INTEGER) AS city_id FROM (SELECT DISTINCT city_name, city_country FROM s_stop_city)")
query("orphan_filter", lambda d: extra.orphan_filter(d.shapes, d.trips.where("source = 'FR/feed-0'").select("source", F.concat(F.lit("sh"), F.substring("trip_id", 2, 20)).alias("shape_id")), ["source", "shape_id"]).select("source", "shape_id", "shape_pt_sequence"), "SELECT source, shape_id, shape_pt_sequence FROM v_shapes WHERE shape_id IN (SELECT 'sh' || substr(trip_id, 2) FROM v_trips WHERE source = 'FR/feed-0')")
query("country_dissonance_filter", lambda d: extra.country_dissonance_filter(d.stops, d.stop_city()).select("source", "stop_id"), "SELECT s.source, s.stop_id FROM v_stops s LEFT JOIN s_stop_city c USING (source, stop_id) WHERE city_country IS NULL OR city_country = substr(s.source, 1, 2)")
query("od_geo_match", lambda d: extra.od_geo_match(d.layer("ends").where("source = 'FR/feed-0'"), d.layer("ends").where("source <> 'FR/feed-0'")),
      f"SELECT a.source AS a_source, a.trip_id AS a_trip_id, b.source AS b_source, b.trip_id AS b_trip_id FROM ({_GEO.format('source = ' + repr('FR/feed-0'))}) a JOIN ({_GEO.format('source <> ' + repr('FR/feed-0'))}) b ON abs(a.f_lat - b.f_lat) < 0.1 AND {hav('a.f_lat', 'a.f_lon', 'b.f_lat', 'b.f_lon')} < 5000 AND {hav('a.l_lat', 'a.l_lon', 'b.l_lat', 'b.l_lon')} < 5000")
query("dedupe_best_row", lambda d: extra.dedupe_best_row(gold(d).where("mode = 'train'"), _PAIR_KEYS.split(", ")),
      f"""SELECT {_PAIR_KEYS}, source, trip_id, days_of_week FROM (SELECT {_PAIR_KEYS}, source, trip_id FROM s_train WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {_PAIR_KEYS} ORDER BY distance_km IS NULL, trip_short_name IS NULL, emissions_co2 IS NULL, trip_id, source, departure_parent_station NULLS FIRST, arrival_parent_station NULLS FIRST, route_type) = 1)
      JOIN (SELECT {_PAIR_KEYS}, {OR_MASK} AS days_of_week FROM s_train GROUP BY {_PAIR_KEYS}) USING ({_PAIR_KEYS})""")
query("factor_comparison", lambda d: extra.factor_comparison(compare(d), "train_emissions_co2", "flight_emissions_co2"), f"SELECT round(min(g), 2) AS lowest, round(quantile_cont(g, 0.25), 2) AS q1, round(quantile_cont(g, 0.5), 2) AS median, {mean('g', 4, 2)} AS mean, round(quantile_cont(g, 0.75), 2) AS q3, round(max(g), 2) AS highest FROM (SELECT CAST(100 AS DOUBLE) * (train_emissions_co2 - flight_emissions_co2) / flight_emissions_co2 AS g FROM s_compare WHERE flight_emissions_co2 > 0)")
query("shape_length_ratio", lambda d: extra.shape_length_ratio(d.shapes), f"SELECT source, shape_id, points, metres, declared, round(declared / nullif(metres, 0), 4) AS ratio FROM (SELECT source, shape_id, count(*) AS points, round(sum(step)) AS metres, max(shape_dist_traveled) AS declared FROM (SELECT *, {hav('lag(shape_pt_lat) OVER w', 'lag(shape_pt_lon) OVER w', 'shape_pt_lat', 'shape_pt_lon')} AS step FROM v_shapes WINDOW w AS (PARTITION BY source, shape_id ORDER BY shape_pt_sequence)) GROUP BY 1, 2)")
query("fastest_option", lambda d: extra.fastest_option(compare(d)).select("source", "trip_id", *CITY.split(", "), "fastest"), f"SELECT source, trip_id, {CITY}, CASE WHEN train_duration_min IS NULL THEN 'flight' WHEN flight_duration_min IS NULL THEN 'train' WHEN train_duration_min < flight_duration_min OR (train_duration_min = flight_duration_min AND train_emissions_co2 <= flight_emissions_co2) THEN 'train' ELSE 'flight' END AS fastest FROM s_compare")
query("day_night_balance", lambda d: extra.day_night_balance(gold(d)), f"SELECT *, {pct('nights', 'n')} AS night_pct, CASE WHEN nights = 0 THEN 'day only' WHEN nights = n THEN 'night only' ELSE 'both' END AS class FROM (SELECT departure_city, arrival_city, departure_country, count(*) FILTER (is_night_train) AS nights, count(*) AS n FROM s_gold WHERE mode = 'train' AND departure_city IS NOT NULL AND arrival_city IS NOT NULL GROUP BY 1, 2, 3)")
query("drop_incomplete", lambda d: d.trips.dropna(subset=["trip_id", "route_id", "trip_short_name"]).select("source", "trip_id"), "SELECT source, trip_id FROM v_trips WHERE trip_short_name IS NOT NULL AND route_id IS NOT NULL")
query("invalid_coord", lambda d: d.stops.where(C.invalid_coord(F.col("stop_lat"), F.col("stop_lon"))).select("source", "stop_id"), "SELECT source, stop_id FROM v_stops WHERE stop_lat IS NULL OR stop_lon IS NULL OR (abs(stop_lat) < 1e-9 AND abs(stop_lon) < 1e-9)")
query("clean_text", lambda d: d.routes.select("source", "route_id", C.clean_text(F.col("route_long_name")).alias("route_long_name")), "SELECT source, route_id, lower(trim(trim(trim(route_long_name), '\"'))) AS route_long_name FROM v_routes")
query("ref_stations", lambda d: extra.last_wins(d.stops.select("source", "stop_id", "stop_name"), d.stops.where("stop_lat = 0").select("source", "stop_id", F.lit("moved").alias("stop_name")), ["source", "stop_id"]), "SELECT source, stop_id, CASE WHEN stop_lat = 0 THEN 'moved' ELSE stop_name END AS stop_name FROM v_stops")
query("cities_by_country", lambda d: gold(d).where("departure_country = 'FR' and departure_city is not null").groupBy("departure_city").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("departure_station").alias("stations")), "SELECT departure_city, count(*) AS n, count(DISTINCT departure_station) AS stations FROM s_gold WHERE departure_country = 'FR' AND departure_city IS NOT NULL GROUP BY 1")
query("top_pairs_by_country", lambda d: audit.top_values(gold(d).where("mode = 'train'"), "departure_station", 25), "SELECT departure_station, count(*) AS n FROM s_gold WHERE mode = 'train' GROUP BY 1 ORDER BY n DESC, departure_station LIMIT 25")
