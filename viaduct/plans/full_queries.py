"""Queries of sources and sinks, matching, dimensions, serving by filters and further audits, each with its SQL for DuckDB."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..operators import audit, extra, gold, places, rail, serve
from ..sources import files, layers
from ..sources.tables import settled, shared_dir
from .rail_queries import CITY, EVENT, STEPS, Data, half_up, hav, lookup, mean, query, total
from .serve_queries import compare, pct

STEPS["s_city_table"] = f"SELECT CAST(row_number() OVER (ORDER BY city_country, city_name) AS INTEGER) AS city_id, city_name, city_country AS country_code, {lookup('city_country', K.COUNTRY_NAMES)} AS country_name FROM (SELECT city_name, city_country FROM s_stop_city UNION SELECT city_name, city_country FROM s_airport_city) WHERE length(city_country) = 2"

# ---- sources and sinks: each query writes and reads back in the shared folder


def place(d: Data, name: str) -> str:
    return f"{shared_dir(d.spark)}/{name}-{uuid.uuid4().hex}"


def written_csv(d: Data) -> DataFrame:
    """Stops as feed text files of two layouts: the columns in different order, and spelled differently."""
    out = place(d, "feed-csv")
    stops = d.stops.select("stop_id", "stop_name", F.col("stop_lat").cast("string").alias("stop_lat"))
    stops.where("stop_id < 'st5'").write.option("header", True).csv(f"{out}/a")
    stops.where("stop_id >= 'st5'").select(F.col("stop_lat").alias(" STOP_LAT "), F.col("stop_name").alias("Stop_Name"), "stop_id", F.lit("x").alias("extra")).write.option("header", True).csv(f"{out}/b")
    return files.read_feed_csv(d.spark, [f"{out}/a/*.csv", f"{out}/b/*.csv"], ["stop_id", "stop_name", "stop_lat", "parent_station"]).drop("_corrupt_record")


def written_gazetteer(d: Data) -> DataFrame:
    out = place(d, "gazetteer")
    empty = {c.split(" ")[0]: F.lit(None).cast("string") for c in files.GAZETTEER.split(", ")}
    own = empty | {c: F.col(c) for c in ("geonameid", "asciiname", "latitude", "longitude", "country_code", "population")}
    d.cities.select(*[v.alias(k) for k, v in own.items()]).write.option("sep", "\t").csv(out)
    return files.read_gazetteer_tsv(d.spark, out).select("geonameid", "asciiname", "latitude", "longitude", "country_code", "population")


def written_json(d: Data) -> DataFrame:
    out = place(d, "json")
    files.write_json_pages(d.intensity, out, "data")
    return files.read_json_records(d.spark, out, "data", "date", [2019, 2021]).select("entity_code", F.col("date").cast("long").alias("date"), "emissions_intensity_gco2_per_kwh")


def written_parquet(d: Data) -> DataFrame:
    out = place(d, "parquet")
    files.convert_to_parquet(written_csv(d), out)
    return d.spark.read.parquet(out)


def written_feeds(d: Data) -> DataFrame:
    """Two feeds whose tables differ in column types, order and spelling."""
    out = place(d, "feeds")
    routes = d.routes.select("source", "route_id", "route_type", "route_long_name")
    routes.where("source = 'FR/feed-0'").drop("source").write.parquet(f"{out}/FR/feed-0/routes")
    other = routes.where("source = 'DE/feed-1'").select(F.col("route_type").cast("int").alias("route_type"), F.col("route_id").alias('"ROUTE_ID"'))
    other.write.parquet(f"{out}/DE/feed-1/routes")
    return files.load_feed_table(d.spark, out, "routes", ["route_id", "route_type", "route_long_name"])


def written_star(d: Data) -> DataFrame:
    out = place(d, "star")
    cities = places.city_dimension(d.stop_city(), d.airport_city())
    files.write_star({"trips": d.named_trips(), "cities": cities}, out, facts=("trips",))
    read = lambda t: d.spark.read.parquet(f"{out}/{t}").agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("n"))
    return read("trips").unionByName(read("cities"))


def written_gold(d: Data) -> DataFrame:
    out = place(d, "gold-partitioned")
    files.write_gold_partitioned(d.gold(), out)
    rows = d.spark.read.parquet(out)
    return rows.groupBy(F.col("country_partition").cast("string").alias("country_partition"), "departure_country").agg(F.count(F.lit(1)).alias("n"), C.exact_sum("distance_km", 2, 1).alias("km"))


def upserted(d: Data) -> DataFrame:
    """A table that two batches fill; the second one replaces two sources, adds rows without a source, and is run twice."""
    table = layers.SourceTable(d.spark, place(d, "by-source"), "trip_id string, route_id string, source string")
    trips = d.trips.select("trip_id", "route_id", "source")
    table.upsert(trips, "first")
    again = trips.where(F.col("source").isin("DE/feed-1", "CH/feed-2")).withColumn("trip_id", F.concat(F.lit("x"), "trip_id"))
    unsourced = trips.where("source = 'FR/feed-0'").select(F.concat(F.lit("n"), "trip_id").alias("trip_id"), "route_id", F.lit(None).cast("string").alias("source"))
    for _ in range(2):
        table.upsert(again.unionByName(unsourced), "second")
    return table.rows()


def written_database(d: Data) -> DataFrame:
    """Through the database that comes with Spark. It is one file that one process opens, so this runs where Spark is local."""
    url = f"jdbc:derby:{place(d, 'derby').removeprefix('file://')};create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    files.write_jdbc(d.feeds.select(F.col("f").cast("long").alias("f"), "source"), url, "feeds", "overwrite", options=options)
    files.write_jdbc(d.feeds.select((F.col("f") + 100).cast("long").alias("f"), "source"), url, "feeds", "append", options=options)
    return d.spark.read.format("jdbc").options(url=url, dbtable="feeds", **options).load()


def exported(d: Data) -> DataFrame:
    out = place(d, "export")
    files.export_csv(d.cities, out, 100_000_000, where=F.col("country_code") == "FR", order=["geonameid"])
    return d.spark.read.option("header", True).schema(d.cities.schema).csv(out)


query("read_feed_csv", written_csv, "SELECT stop_id, stop_name, CAST(stop_lat AS VARCHAR) AS stop_lat, CAST(NULL AS VARCHAR) AS parent_station FROM v_stops")
query("convert_to_parquet", written_parquet, "SELECT stop_id, stop_name, CAST(stop_lat AS VARCHAR) AS stop_lat, CAST(NULL AS VARCHAR) AS parent_station FROM v_stops")
query("read_gazetteer_tsv", written_gazetteer, "SELECT geonameid, asciiname, latitude, longitude, country_code, population FROM v_cities")
query("read_json_records", written_json, "SELECT entity_code, CAST(date AS BIGINT) AS date, emissions_intensity_gco2_per_kwh FROM v_intensity WHERE date IN (2019, 2021)")
query("load_feed_table", written_feeds, "SELECT source, route_id, route_type, CASE WHEN source = 'FR/feed-0' THEN lower(trim(trim(trim(route_long_name), '\"'))) END AS route_long_name FROM v_routes WHERE source IN ('FR/feed-0', 'DE/feed-1')")
query("align_schema", lambda d: files.align_schema(d.routes.select("route_id", "route_type", "route_short_name"), {"route_id": "string", "route_type": "int", "route_short_name": "int", "route_color": "string"}), "SELECT route_id, TRY_CAST(route_type AS INTEGER) AS route_type, TRY_CAST(route_short_name AS INTEGER) AS route_short_name, CAST(NULL AS VARCHAR) AS route_color FROM v_routes")
query("write_star", written_star, "SELECT 'trips' AS \"table\", count(*) AS n FROM s_timetable UNION ALL SELECT 'cities', count(*) FROM s_city_table")
query("write_gold_partitioned", written_gold, f"SELECT CASE WHEN departure_country IN {K.GOLD_COUNTRIES} THEN departure_country ELSE '{K.OTHER_COUNTRY}' END AS country_partition, coalesce(departure_country, '{K.OTHER_COUNTRY}') AS departure_country, count(*) AS n, {total('distance_km', 2, 1)} AS km FROM s_gold GROUP BY 1, 2")
_LOADED = "source, trip_id, departure_country, arrival_country, route_type, is_night_train, distance_km"
query("final_load_clean", lambda d: files.final_load_clean(d.gold().select(*_LOADED.split(", "))), f"SELECT source, trip_id, coalesce(upper(trim(departure_country)), 'XX') AS departure_country, coalesce(upper(trim(arrival_country)), 'XX') AS arrival_country, TRY_CAST(route_type AS SMALLINT) AS route_type, coalesce(is_night_train, false) AS is_night_train, distance_km FROM s_gold WHERE trip_id IS NOT NULL")
query("upsert_by_source_table", upserted, "SELECT CASE WHEN source IN ('DE/feed-1', 'CH/feed-2') THEN 'x' ELSE '' END || trip_id AS trip_id, route_id, source FROM v_trips UNION ALL SELECT 'n' || trip_id, route_id, NULL FROM v_trips WHERE source = 'FR/feed-0'")
query("write_jdbc", written_database, "SELECT CAST(f AS BIGINT) AS f, source FROM v_feeds UNION ALL SELECT CAST(f + 100 AS BIGINT), source FROM v_feeds")
query("export_csv", exported, "SELECT * FROM v_cities WHERE country_code = 'FR'")

# ---- columns
_WORDS = "CASE CAST(substr(service_id, 2) AS BIGINT) % 5 WHEN 0 THEN 'Daily' WHEN 1 THEN 'daily except Sat' WHEN 2 THEN 'Fri (Oct-Jun)' WHEN 3 THEN 'Son' ELSE 'on demand' END"
_MASKS = "CASE CAST(substr(service_id, 2) AS BIGINT) % 5 WHEN 0 THEN '1111111' WHEN 1 THEN '1111101' WHEN 2 THEN '0000100' WHEN 3 THEN '0000001' END"
query("mask_from_text", lambda d: d.trips.select("source", "trip_id", C.known_mask(F.expr(_WORDS.replace("BIGINT", "LONG"))).alias("mask")), f"SELECT source, trip_id, {_MASKS} AS mask FROM v_trips")
query("country_alias", lambda d: d.night_stops.select("stop_id", C.country_alias(F.col("stop_country")).alias("country")), "SELECT stop_id, CASE stop_country WHEN 'UK' THEN 'GB' ELSE stop_country END AS country FROM v_night_stops")
query("time_part", lambda d: d.night_times.select("trip_id", "stop_id", "stop_sequence", C.time_part(F.col("arrival_time")).alias("arrival_time")), "SELECT trip_id, stop_id, stop_sequence, split_part(arrival_time, ' ', -1) AS arrival_time FROM v_night_times")
query("train_numbers_all", lambda d: d.trips.select("source", "trip_id", F.explode(C.train_number_list(F.concat_ws(" / ", "trip_short_name", F.substring("trip_id", 2, 9)))).alias("number")), r"SELECT source, trip_id, unnest(regexp_extract_all(coalesce(trip_short_name || ' / ', '') || substr(trip_id, 2, 9), '\d{3,6}')) AS number FROM v_trips")
query("column_name_normalise", lambda d: audit.null_profile(d.trips).select(C.column_name(F.concat(F.lit(' "'), F.upper("column"), F.lit('"')), {"trip_headsign": "headsign"}).alias("column"), "n_null"), " UNION ALL ".join(f"SELECT '{c.removeprefix('trip_') if c == 'trip_headsign' else c}' AS \"column\", count(*) - count({c}) AS n_null FROM v_trips" for c in ("source", "trip_id", "route_id", "service_id", "trip_short_name", "trip_headsign")))
query("filled_sequences", lambda d: rail.filled_sequences(d.events_all().withColumn("stop_sequence", F.when(F.col("stop_sequence") == 4, 99).when(F.col("stop_id") == "st7", F.lit(None).cast("int")).otherwise(F.col("stop_sequence")))).select("source", "trip_id", "stop_id", "arrival_time", "stop_sequence"),
      """SELECT source, trip_id, stop_id, arrival_time, CAST(CASE WHEN missing THEN row_number() OVER (PARTITION BY source, trip_id ORDER BY coalesce(q, 9999), coalesce(departure_time, arrival_time) NULLS FIRST, stop_id) - 1
        WHEN q = 99 THEN max(CASE WHEN q <> 99 THEN q END) OVER (PARTITION BY source, trip_id) + 1 ELSE q END AS INTEGER) AS stop_sequence
      FROM (SELECT *, bool_or(q IS NULL) OVER (PARTITION BY source, trip_id) AS missing FROM (SELECT *, CASE WHEN stop_sequence = 4 THEN 99 WHEN stop_id = 'st7' THEN NULL ELSE stop_sequence END AS q FROM s_events))""")

# ---- matching


def keyed(d: Data, night: bool) -> dict[str, DataFrame]:
    """Trips with a key for each level of matching; trips without a key are left out."""
    rows = d.named_night() if night else d.named_trips()
    name = rows.withColumn("key", F.lower(F.trim("trip_short_name"))).where("key is not null")
    operator = F.lower(F.substring_index("agency_name", " ", 1))
    token = rows.withColumn("key", F.concat_ws("|", C.train_number(F.col("trip_short_name")), operator)).where(C.train_number(F.col("trip_short_name")) != "").where("agency_name is not null")
    return {"1": name, "2": token}


def best_matches(d: Data) -> DataFrame:
    """The best match of each night trip. Of each key only the first trip of the timetable can win, so no pairs are made."""
    night, day, out = keyed(d, True), keyed(d, False), None
    for level in ("1", "2"):
        first = day[level].groupBy("key").agg(F.min(F.struct("source", "trip_id")).alias("x"))
        rows = night[level].select(F.col("trip_id").alias("night_id"), "key").join(first, "key").select("night_id", "x.source", "x.trip_id", F.lit(int(level)).alias("level"))
        out = rows if out is None else out.unionByName(rows)
    return extra.best_match_level(out)


CRITERIA = ("trip_id", "trip_short_name", "route_short_name", "operator", "trip_headsign", "cities")


def profiles(d: Data, night: bool) -> DataFrame:
    """source, trip_id and a key for each criterion of the match report."""
    if night:
        trips = d.named_night().join(d.night_routes.select("route_id", "route_short_name"), "route_id", "left")
    else:
        trips = d.trips.join(d.routes.select("source", "route_id", "route_short_name", "agency_id"), ["source", "route_id"]).join(d.agency_names(), "agency_id", "left")
    own = (F.col("source") == "night") if night else (F.col("source") != "night")
    at = d.layer("any_city")
    ends = d.layer("ends").where(own).join(at.select("source", F.col("stop_id").alias("first_stop_id"), F.col("city_name").alias("a")), ["source", "first_stop_id"]).join(at.select("source", F.col("stop_id").alias("last_stop_id"), F.col("city_name").alias("b")), ["source", "last_stop_id"])
    rows = trips.join(ends.select("source", "trip_id", F.concat_ws(" > ", "a", "b").alias("cities")), ["source", "trip_id"], "left")
    return rows.select("source", F.col("trip_id").alias("id"), F.regexp_replace("trip_id", "^[a-z]", "").alias("trip_id"), F.lower(F.trim("trip_short_name")).alias("trip_short_name"), "route_short_name", F.lower(F.substring_index("agency_name", " ", 1)).alias("operator"), "trip_headsign", "cities", "agency_id")


def match_rates(d: Data) -> DataFrame:
    """Profiles are written, as each criterion reads them."""
    night, day, out = settled(profiles(d, True), "night-profiles"), settled(profiles(d, False), "day-profiles"), None
    for c in CRITERIA:
        hits = night.join(day.select(c).where(F.col(c).isNotNull()).distinct(), c, "left_semi").agg(F.lit(c).alias("criterion"), F.countDistinct("id").alias("night_trips"))
        out = hits if out is None else out.unionByName(hits)
    return out


def unmatched(d: Data, examples: int = 3) -> DataFrame:
    """Night trips whose name no trip of the timetable has, by operator, with the first names as examples."""
    rows = d.named_night().join(d.named_trips().select(F.lower(F.trim("trip_short_name")).alias("k")).distinct(), F.lower(F.trim("trip_short_name")) == F.col("k"), "left_anti")
    order = F.array_join(F.slice(F.array_sort(F.collect_set("trip_short_name")), 1, examples), ",").alias("examples")
    return rows.groupBy("agency_id").agg(F.count(F.lit(1)).alias("n"), order)


_NUMBER = r"regexp_extract({0}.trip_short_name, '\d{{3,6}}')"
STEPS["s_matches"] = rf"""SELECT n.trip_id AS night_id, t.source, t.trip_id, 1 AS level FROM s_night n JOIN s_timetable t ON lower(trim(n.trip_short_name)) = lower(trim(t.trip_short_name))
    UNION ALL SELECT n.trip_id, t.source, t.trip_id, 2 FROM s_night n JOIN s_timetable t ON {_NUMBER.format('n')} = {_NUMBER.format('t')} AND {_NUMBER.format('t')} <> '' AND lower(split_part(n.agency_name, ' ', 1)) = lower(split_part(t.agency_name, ' ', 1))"""
STEPS["s_ends"] = "SELECT source, trip_id, arg_min(stop_id, stop_sequence) AS f, arg_max(stop_id, stop_sequence) AS l FROM s_clean GROUP BY source, trip_id"
STEPS["s_end_cities"] = "SELECT e.source, e.trip_id, a.city_name || ' > ' || b.city_name AS cities FROM s_ends e JOIN s_any_city a ON a.source = e.source AND a.stop_id = f JOIN s_any_city b ON b.source = e.source AND b.stop_id = l"
_PROFILE = "substr({0}.trip_id, 2) AS trip_id, lower(trim({0}.trip_short_name)) AS trip_short_name, {1}.route_short_name, lower(split_part({2}.agency_name, ' ', 1)) AS operator, {0}.trip_headsign, cities"
STEPS["s_night_profile"] = f"SELECT n.trip_id AS id, {_PROFILE.format('n', 'r', 's')} FROM v_night n JOIN s_night s USING (trip_id) LEFT JOIN v_night_routes r USING (route_id) LEFT JOIN s_end_cities e ON e.source = 'night' AND e.trip_id = n.trip_id"
STEPS["s_day_profile"] = f"SELECT t.trip_id AS id, {_PROFILE.format('t', 'r', 'a')} FROM v_trips t JOIN v_routes r USING (source, route_id) LEFT JOIN (SELECT agency_id, min(agency_name) AS agency_name FROM v_agency GROUP BY 1) a ON a.agency_id = r.agency_id LEFT JOIN s_end_cities e ON e.source = t.source AND e.trip_id = t.trip_id"
query("best_match_level", best_matches, "SELECT * FROM s_matches QUALIFY row_number() OVER (PARTITION BY night_id ORDER BY level, source, trip_id) = 1")
query("flag_night", lambda d: extra.flag_night(d.events_all(), rail.matched_trips(d.named_night(), d.named_trips())).select(*EVENT.split(", "), "is_night_train"), f"SELECT {EVENT}, route_type = 105 OR (source, trip_id) IN (SELECT (source, trip_id) FROM s_l1 UNION ALL SELECT (source, trip_id) FROM s_l2) AS is_night_train FROM s_events")
query("match_rate_report", match_rates, " UNION ALL ".join(f"SELECT '{c}' AS criterion, count(DISTINCT id) AS night_trips FROM s_night_profile WHERE {c} IN (SELECT {c} FROM s_day_profile WHERE {c} IS NOT NULL)" for c in CRITERIA))
query("match_unmatched", unmatched, "SELECT agency_id, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT trip_short_name) FILTER (trip_short_name IS NOT NULL))[1:3], ','), '') AS examples FROM v_night WHERE trip_short_name IS NULL OR lower(trim(trip_short_name)) NOT IN (SELECT lower(trim(trip_short_name)) FROM s_timetable WHERE trip_short_name IS NOT NULL) GROUP BY 1")

# ---- dimensions and keys
STEPS["s_emission"] = "SELECT (SELECT max(emission_ref) FROM s_air_table) + row_number() OVER (ORDER BY country_code, route_type) AS emission_ref, country_code, route_type FROM s_rail_factors"


def city_table(d: Data) -> DataFrame:
    return places.city_dimension(d.stop_city(), d.airport_city())


def city_keys(d: Data) -> DataFrame:
    return city_table(d).select("city_id", "city_name", F.col("country_code").alias("city_country"))


query("city_dimension", city_table, "SELECT * FROM s_city_table")
query("replace_with_fk", lambda d: extra.replace_both_ends(d.layer("flown"), city_keys(d)).select("origin_id", "dest_id", "emission_ref", "distance_km", "origin_city_id", "dest_city_id"),
      "SELECT origin_id, dest_id, emission_ref, distance_km, o.city_id AS origin_city_id, d.city_id AS dest_city_id FROM s_flown LEFT JOIN s_city_table o ON o.city_name = origin_city AND o.country_code = origin_country LEFT JOIN s_city_table d ON d.city_name = dest_city AND d.country_code = dest_country")
query("replace_with_fk_events", lambda d: extra.with_emission_ref(d.events_all(), places.emission_table(d.rail_price(), places.air_factor_table(places.air_factor_base(d.air_factors)))).select(*EVENT.split(", "), "emission_ref"), f"SELECT {EVENT}, emission_ref FROM s_events LEFT JOIN s_emission ON country_code = country AND s_emission.route_type = s_events.route_type")
query("gold_train_mapped", lambda d: gold.gold_train(d.clean(), d.rail_price(), prefer_mapped=True).groupBy("departure_country", "arrival_country").agg(F.count(F.lit(1)).alias("n"), C.exact_sum("distance_km", 2, 1).alias("km")),
      f"""SELECT departure_country, arrival_country, count(*) AS n, {total('distance_km', 2, 1)} AS km FROM (
        SELECT coalesce(d.city_country, dep_country) AS departure_country, coalesce(a.city_country, arr_country) AS arrival_country, arg_min(distance_km, row(p.trip_id, distance_km)) AS distance_km
        FROM s_pairs p JOIN (SELECT source, trip_id, min(route_type) AS route_type FROM s_clean GROUP BY 1, 2) t USING (source, trip_id)
        LEFT JOIN s_any_city d ON d.source = p.source AND d.stop_id = dep_stop_id LEFT JOIN s_any_city a ON a.source = p.source AND a.stop_id = arr_stop_id
        GROUP BY p.source, dep_stop_name, d.city_name, 1, dep_parent_station, dep_departure_time, arr_stop_name, a.city_name, 2, arr_parent_station, arr_arrival_time, t.route_type) GROUP BY 1, 2""")
query("ref_cities", lambda d: extra.insert_if_absent(d.cities.where("country_code in ('FR', 'DE', 'CH')").select(F.col("asciiname").alias("city"), F.col("country_code").alias("country")).distinct(), d.gold().where("departure_city is not null").select(F.col("departure_city").alias("city"), F.col("departure_country").alias("country")), ["city", "country"]),
      "SELECT asciiname AS city, country_code AS country FROM v_cities WHERE country_code IN ('FR', 'DE', 'CH') UNION SELECT departure_city, departure_country FROM s_gold WHERE departure_city IS NOT NULL")
_CHOICE = "SELECT {0}, 'train' AS mode, 0 AS connections, train_duration_min AS m, train_emissions_co2 AS e FROM s_rail_best UNION ALL SELECT {0}, 'flight', 2, flight_duration_min, flight_emissions_co2 FROM s_city_flights".format(CITY)


def city_options(d: Data) -> DataFrame:
    best = settled(gold.train_city_pairs(d.layer("train")), "best-trains")  # read twice below
    return extra.ranked_options(extra.city_candidates(best, gold.best_flight_per_city_pair(best, d.access(), d.layer("flown"))), list(gold.CITY_PAIR))


query("fastest_option_ranked", lambda d: city_options(d).where("rank = 1").select(*gold.CITY_PAIR, "mode"), f"SELECT {CITY}, mode FROM ({_CHOICE}) QUALIFY row_number() OVER (PARTITION BY {CITY} ORDER BY m NULLS LAST, connections, e NULLS LAST, mode DESC) = 1")

# ---- serving
#: A country whose airports have cities.
AIRPORTS_SHOWN = "ES"
_ROUTES = "SELECT * FROM s_gold WHERE mode = 'train' AND source = 'FR/feed-0' AND departure_country = 'FR' AND arrival_country = 'FR' AND contains(lower(departure_station), 'supplier') AND contains(lower(agency_name), 'operator') AND NOT is_night_train AND days_of_week LIKE '1%' AND distance_km BETWEEN 100 AND 2000 AND emissions_co2 BETWEEN 1 AND 100000 AND service_start_date >= '20220101' AND service_end_date <= '20261231'"
_CHOSEN = {"mode": "train", "source": "FR/feed-0", "departure_country": "fr", "arrival_country": "fr", "departure_station": "Supplier", "agency_name": "operator", "is_night_train": False, "days_of_week": "1%", "min_distance_km": 100, "max_distance_km": 2000, "min_co2": 1, "max_co2": 100000, "service_start_after": "2022-01-01", "service_end_before": "2026-12-31"}
query("list_routes", lambda d: serve.list_routes(d.gold(), **_CHOSEN), _ROUTES)
_BY = ["distance_km", *K.GOLD_COLUMNS[:2], "departure_station", "arrival_station", "departure_time", "arrival_time", "route_type"]
query("list_routes_total", lambda d: serve.counted_page(serve.list_routes(d.gold(), **_CHOSEN).select(*_BY), [F.col(c).asc_nulls_last() for c in _BY], 1, 20), f"SELECT {', '.join(_BY)}, (SELECT count(*) FROM ({_ROUTES})) AS total FROM ({_ROUTES}) ORDER BY {', '.join(c + ' NULLS LAST' for c in _BY)} LIMIT 20")
_COMPARED = "SELECT * FROM s_compare WHERE best_mode = 'train' AND contains(lower(departure_city), 'city') AND train_duration_min BETWEEN 10 AND 3000"
query("list_compare", lambda d: serve.list_compare(compare(d), best_mode="train", departure_city="City", min_train_duration=10, max_train_duration=3000), _COMPARED)
query("list_compare_days", lambda d: serve.list_compare(compare(d), days_of_week="1_____1", departure_country="fr", max_flight_duration=2000), "SELECT * FROM s_compare WHERE days_of_week LIKE '1_____1' AND departure_country = 'FR' AND flight_duration_min <= 2000")
query("list_compare_total", lambda d: serve.counted_page(serve.list_compare(compare(d), best_mode="train", departure_city="City", min_train_duration=10, max_train_duration=3000).select(*CITY.split(", ")), CITY.split(", "), 2, 10), f"SELECT {CITY}, (SELECT count(*) FROM ({_COMPARED})) AS total FROM ({_COMPARED}) ORDER BY {CITY} LIMIT 10 OFFSET 10")
_DAY_NIGHT = "departure_city, departure_country, arrival_city, arrival_country, agency_name, route_long_name, is_night_train, days_of_week, departure_time, arrival_time, distance_km, co2_per_pkm, emissions_co2"
query("day_night_routes", lambda d: serve.day_night_routes(d.gold(), is_night_train=True, min_distance_km=50), f"SELECT {_DAY_NIGHT} FROM s_gold WHERE mode = 'train' AND is_night_train AND distance_km >= 50")
_PAGE = _DAY_NIGHT.split(", ")
_ORDERED = ["departure_country", "is_night_train", "departure_time", *[c for c in _PAGE if c not in ("departure_country", "is_night_train", "departure_time")]]
query("day_night_routes_page", lambda d: serve.counted_page(serve.day_night_routes(d.gold(), departure_country="DE"), [F.col(c).asc_nulls_last() for c in _ORDERED], 1, 50), f"SELECT {_DAY_NIGHT}, (SELECT count(*) FROM s_gold WHERE mode = 'train' AND departure_country = 'DE') AS total FROM s_gold WHERE mode = 'train' AND departure_country = 'DE' ORDER BY {', '.join(c + ' NULLS LAST' for c in _ORDERED)} LIMIT 50")
_CORRIDOR = f"""SELECT is_night_train, count(*) AS options, {mean('distance_km', 2, 1)} AS mean_km, {mean('co2_per_pkm', 3, 2)} AS mean_co2_per_pkm, {mean('emissions_co2', 3, 1)} AS mean_co2, {half_up('min(emissions_co2)', 1)} AS least_co2,
      {half_up('max(emissions_co2)', 1)} AS most_co2, min(departure_time) AS earliest, max(departure_time) AS latest, coalesce(string_agg(DISTINCT agency_name, ', ' ORDER BY agency_name), '') AS operators
      FROM s_gold WHERE mode = 'train' AND contains(lower(departure_city), 'city') AND contains(lower(arrival_city), 'city') GROUP BY 1"""
query("day_night_compare", lambda d: serve.day_night_compare(d.gold(), "City", "City"),
      f"SELECT *, CASE WHEN (SELECT count(*) FROM ({_CORRIDOR})) = 2 THEN CASE WHEN (SELECT mean_co2 FROM ({_CORRIDOR}) WHERE NOT is_night_train) <= (SELECT mean_co2 FROM ({_CORRIDOR}) WHERE is_night_train) THEN 'day' ELSE 'night' END END AS best FROM ({_CORRIDOR})")
query("stations_by_city", lambda d: serve.stations_by_city(d.gold(), "fr", "City"), "SELECT departure_station AS station, departure_parent_station AS parent_station, count(*) AS departures, count(DISTINCT arrival_city) AS destinations, count(DISTINCT agency_name) AS n_operators, coalesce(string_agg(DISTINCT agency_name, ', ' ORDER BY agency_name), '') AS operators, count(*) FILTER (is_night_train) AS nights, count(*) FILTER (NOT is_night_train) AS days FROM s_gold WHERE mode = 'train' AND departure_country = 'FR' AND contains(lower(departure_city), 'city') GROUP BY 1, 2")
query("airports_by_city", lambda d: serve.airports_by_city(d.gold(), AIRPORTS_SHOWN, "City"), f"SELECT departure_station AS airport, count(*) AS flights, count(DISTINCT arrival_city) AS destinations, count(DISTINCT arrival_country) AS countries, {mean('distance_km', 2, 1)} AS mean_km FROM s_gold WHERE mode = 'flight' AND departure_country = '{AIRPORTS_SHOWN}' AND contains(lower(departure_city), 'city') GROUP BY 1")
_ESTIMATE = ", ".join(f"count({m}_emissions_co2) AS n_{m}, {mean(f'{m}_distance_km', 2, 1)} AS {m}_km, {mean(f'{m}_duration_min', 1, 1)} AS {m}_min, {mean(f'{m}_emissions_co2', 3, 1)} AS {m}_co2, {half_up(f'min({m}_emissions_co2)', 1)} AS {m}_co2_least, {half_up(f'max({m}_emissions_co2)', 1)} AS {m}_co2_most" for m in ("train", "flight"))
_MODE = "CASE WHEN count(*) FILTER (best_mode = 'flight') >= count(*) FILTER (best_mode = 'train') THEN 'flight' ELSE 'train' END AS best_mode"
_SAVED = "CASE WHEN flight_co2 > 0 THEN floor((1 - train_co2 / flight_co2) * CAST(1000 AS DOUBLE) + CAST(0.500001 AS DOUBLE)) / CAST(10 AS DOUBLE) END AS co2_saving_pct"
query("carbon_estimate", lambda d: serve.carbon_estimate(compare(d), "City 1", "City"), f"SELECT *, {_SAVED} FROM (SELECT count(*) AS corridors, {_ESTIMATE}, {_MODE} FROM s_compare WHERE contains(lower(departure_city), 'city 1') AND contains(lower(arrival_city), 'city'))")
query("carbon_estimate_by_country", lambda d: serve.carbon_estimate(compare(d), by=("departure_country",)), f"SELECT *, {_SAVED} FROM (SELECT departure_country, count(*) AS corridors, {_ESTIMATE}, {_MODE} FROM s_compare GROUP BY 1)")
query("coverage_cities_both", lambda d: serve.coverage_cities(d.gold(), "both", 30), "SELECT departure_city AS city, departure_country AS country, count(*) AS n, count(DISTINCT arrival_country) AS other_countries FROM s_gold WHERE departure_city IS NOT NULL GROUP BY 1, 2 ORDER BY n DESC, city, country LIMIT 30")
query("max_factor_by_label", lambda d: serve.highest_factors(d.gold()), "SELECT departure_country AS label, max(co2_per_pkm) AS highest FROM s_gold GROUP BY 1")
query("max_factor_day_night", lambda d: serve.highest_factors(d.gold(), "fr"), "SELECT CASE WHEN is_night_train THEN 'night' ELSE 'day' END AS label, max(co2_per_pkm) AS highest FROM s_gold WHERE mode = 'train' AND departure_country = 'FR' GROUP BY 1")
query("kpi_overview", lambda d: extra.kpi_overview(d.gold()), f"SELECT count(*) AS rows, count(*) FILTER (mode = 'train') AS trains, count(*) FILTER (mode <> 'train') AS flights, {pct('count(*) FILTER (is_night_train)', "count(*) FILTER (mode = 'train')")} AS night_pct, {mean('emissions_co2', 3, 2, "FILTER (mode = 'train')")} AS mean_train_co2, count(DISTINCT departure_country) AS countries, round(({' + '.join(f'count({c})' for c in extra.KPI_COLUMNS)}) * CAST(100 AS DOUBLE) / (5 * count(*)), 2) AS mean_filled_pct FROM s_gold")
query("global_coverage_kpi", lambda d: serve.compare_coverage(d.gold(), compare(d)).agg(F.sum("compared").alias("compared"), F.sum("trips").alias("trips"), F.round(100.0 * F.sum("compared") / F.sum("trips"), 2).alias("compared_pct")).crossJoin(d.gold().agg(F.count_if(F.col("emissions_co2").isNull()).alias("no_co2"))),
      "SELECT CAST(sum(compared) AS BIGINT) AS compared, CAST(sum(trips) AS BIGINT) AS trips, round(CAST(100 AS DOUBLE) * sum(compared) / sum(trips), 2) AS compared_pct, (SELECT count(*) FROM s_gold WHERE emissions_co2 IS NULL) AS no_co2 FROM (SELECT trips, coalesce(compared, 0) AS compared FROM (SELECT departure_country, count(DISTINCT trip_id) AS trips FROM s_gold WHERE mode = 'train' GROUP BY 1) LEFT JOIN (SELECT departure_country, count(*) AS compared FROM s_compare GROUP BY 1) USING (departure_country))")

# ---- audits
query("feed_sizes", lambda d: audit.feed_sizes(d.shapes, d.feeds), "SELECT f.source, count(s.source) AS n FROM v_feeds f LEFT JOIN v_shapes s ON s.source = f.source GROUP BY 1")
query("semantic_duplicates_exact", lambda d: audit.exact_duplicates(d.stop_times), "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, round(CAST(100 AS DOUBLE) * (sum(n) - count(*)) / sum(n), 3) AS repeat_pct FROM (SELECT count(*) AS n FROM v_stop_times GROUP BY ALL)".replace("GROUP BY ALL", "GROUP BY source, trip_id, stop_id, stop_sequence, arrival_time, departure_time"))
query("trip_topology_summary", lambda d: audit.topology_summary(d.stop_times, 6), "SELECT count(*) AS trips, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, max(n) AS most, count(*) FILTER (n = 1) AS single, count(*) FILTER (n > 6) AS long FROM (SELECT count(*) AS n FROM v_stop_times GROUP BY source, trip_id)")
query("first_sequences", lambda d: audit.first_sequences(d.stop_times), "SELECT f AS first, count(*) AS trips FROM (SELECT min(stop_sequence) AS f FROM v_stop_times GROUP BY source, trip_id) GROUP BY 1")
query("od_explosion_estimate", lambda d: audit.od_explosion_estimate(d.stop_times), "SELECT count(*) AS trips, CAST(sum(n) AS BIGINT) AS stops, CAST(sum(n * (n - 1) // 2) AS BIGINT) AS pairs, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.75) AS q3, max(n) AS most, round(sum(n * (n - 1) // 2) / CAST(sum(n) AS DOUBLE), 4) AS ratio FROM (SELECT count(DISTINCT stop_sequence) AS n FROM v_stop_times GROUP BY source, trip_id)")
query("od_explosion_top", lambda d: audit.largest_trips(d.stop_times, 15), "SELECT source, trip_id, n AS stops, n * (n - 1) // 2 AS pairs FROM (SELECT source, trip_id, count(DISTINCT stop_sequence) AS n FROM v_stop_times GROUP BY 1, 2) ORDER BY n DESC, source, trip_id LIMIT 15")
query("modes_by_country", lambda d: audit.modes_by_country(d.events_all()), "SELECT country, string_agg(DISTINCT CAST(route_type AS VARCHAR), ',' ORDER BY CAST(route_type AS VARCHAR)) AS route_types FROM s_events GROUP BY 1".replace("string_agg(DISTINCT CAST(route_type AS VARCHAR), ',' ORDER BY CAST(route_type AS VARCHAR))", "array_to_string(list_sort(list(DISTINCT route_type)), ',')"))
query("top_hubs", lambda d: audit.hubs(d.events_all(), 20), "SELECT source, stop_id, count(DISTINCT route_id) AS routes, count(DISTINCT trip_id) AS trips FROM s_events GROUP BY 1, 2 ORDER BY routes DESC, trips DESC, source, stop_id LIMIT 20")
query("timezone_conflicts", lambda d: audit.timezone_conflicts(d.agency.withColumn("agency_timezone", F.when(F.col("source") == "DE/feed-1", "Europe/Berlin").otherwise(F.col("agency_timezone")))), "SELECT agency_name, string_agg(DISTINCT z, ',' ORDER BY z) AS zones, count(DISTINCT source) AS sources FROM (SELECT source, agency_name, coalesce(CASE WHEN source = 'DE/feed-1' THEN 'Europe/Berlin' ELSE agency_timezone END, 'none') AS z FROM v_agency) GROUP BY 1 HAVING count(DISTINCT z) > 1")
_CUTS, _SAVES = (20230101, 20240101, 20260101), (0, 50, 1000)
query("threshold_scenarios", lambda d: audit.threshold_scenarios(d.events_all(), list(_CUTS), list(_SAVES)), " UNION ALL ".join(f"SELECT {c} AS cutoff, {m} AS rescued, CAST(sum(fresh + least(n - fresh, {m})) AS BIGINT) AS kept FROM (SELECT count(*) AS n, count(*) FILTER (coalesce(TRY_CAST(end_date AS INTEGER) >= {c}, true)) AS fresh FROM s_events GROUP BY country)" for c in _CUTS for m in _SAVES))
query("alias_groups", lambda d: audit.alias_groups(d.events_all(), ["stop_id", "arrival_time"], "agency_name"), "SELECT stop_id, arrival_time, count(*) AS n, string_agg(DISTINCT agency_name, '|' ORDER BY agency_name) AS names FROM s_events GROUP BY 1, 2 HAVING count(DISTINCT agency_name) > 1")
query("duplicates_by_source", lambda d: audit.duplicates_by_source(d.events_all().where("arrival_time is not null"), ["stop_name", "arrival_time"]), "SELECT source, count(*) AS rows FROM (SELECT source, count(*) OVER (PARTITION BY stop_name, arrival_time) AS n FROM s_events WHERE arrival_time IS NOT NULL) WHERE n > 1 GROUP BY 1")
query("similar_names_together", lambda d: audit.together(audit.similar_names(d.cities, "asciiname"), d.cities, "asciiname", "country_code"), "SELECT a.x AS name, b.x AS other, round(1 - levenshtein(a.x, b.x) / CAST(greatest(length(a.x), length(b.x)) AS DOUBLE), 4) AS similarity, (SELECT count(*) FROM (SELECT country_code FROM v_cities WHERE asciiname = a.x INTERSECT SELECT country_code FROM v_cities WHERE asciiname = b.x)) AS together FROM (SELECT DISTINCT asciiname AS x FROM v_cities) a JOIN (SELECT DISTINCT asciiname AS x FROM v_cities) b ON a.x < b.x AND abs(length(a.x) - length(b.x)) <= 3 WHERE 1 - levenshtein(a.x, b.x) / CAST(greatest(length(a.x), length(b.x)) AS DOUBLE) > 0.8")
_KINDS = {"trips": ("route_id", "service_id", "trip_short_name"), "routes": ("route_id", "route_type", "route_short_name"), "stops": ("stop_id", "stop_lat", "parent_station")}
_KIND = "CASE WHEN regexp_matches(CAST({0} AS VARCHAR), '^-?\\d+$') THEN 'int' WHEN TRY_CAST(CAST({0} AS VARCHAR) AS DOUBLE) IS NOT NULL THEN 'double' WHEN {0} IS NOT NULL THEN 'string' END"
STEPS["s_kinds"] = " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS tab, '{c}' AS col, {_KIND.format(c)} AS kind FROM v_{t}" for t, cs in _KINDS.items() for c in cs)


def kinds(d: Data) -> DataFrame:
    out = None
    for t, cs in _KINDS.items():
        rows = audit.value_kinds(getattr(d, t).select(*cs), t)
        out = rows if out is None else out.unionByName(rows)
    return out


query("value_kinds", kinds, 'SELECT tab AS "table", col AS "column", kind AS type FROM s_kinds WHERE kind IS NOT NULL')
query("type_conflicts", lambda d: extra.type_conflicts(kinds(d).unionByName(audit.value_kinds(d.night_stops.select(F.col("stop_country").alias("stop_id"), F.lit("1").alias("route_id")), "night"))), "SELECT col AS \"column\", string_agg(DISTINCT kind, ',' ORDER BY kind) AS types, count(DISTINCT tab) AS tables FROM (SELECT * FROM s_kinds UNION ALL SELECT DISTINCT 'night', 'stop_id', 'string' FROM v_night_stops UNION ALL SELECT DISTINCT 'night', 'route_id', 'int' FROM v_night_stops) WHERE kind IS NOT NULL GROUP BY 1 HAVING count(DISTINCT kind) > 1")
_GAP = "(SELECT *, CAST(100 AS DOUBLE) * (train_emissions_co2 - flight_emissions_co2) / flight_emissions_co2 AS g FROM s_compare WHERE flight_emissions_co2 > 0 AND train_emissions_co2 IS NOT NULL)"
query("factor_comparison_by_country", lambda d: extra.factor_comparison(compare(d).where("train_emissions_co2 is not null"), "train_emissions_co2", "flight_emissions_co2", ["departure_country"]), f"SELECT departure_country, round(min(g), 2) AS lowest, round(quantile_cont(g, 0.25), 2) AS q1, round(quantile_cont(g, 0.5), 2) AS median, {mean('g', 4, 2)} AS mean, round(quantile_cont(g, 0.75), 2) AS q3, round(max(g), 2) AS highest FROM {_GAP} GROUP BY 1")
query("factor_gaps_top", lambda d: extra.factor_gaps(compare(d).where("train_emissions_co2 is not null"), "train_emissions_co2", "flight_emissions_co2").select(*CITY.split(", "), F.round("gap", 2).alias("gap")).orderBy(F.desc("gap"), *CITY.split(", ")).limit(10), f"SELECT {CITY}, round(g, 2) AS gap FROM {_GAP} ORDER BY gap DESC, {CITY} LIMIT 10")
_RATIO = f"(SELECT source, shape_id, round(max(shape_dist_traveled) / nullif(round(sum(step)), 0), 4) AS ratio FROM (SELECT *, {hav('lag(shape_pt_lat) OVER w', 'lag(shape_pt_lon) OVER w', 'shape_pt_lat', 'shape_pt_lon')} AS step FROM v_shapes WINDOW w AS (PARTITION BY source, shape_id ORDER BY shape_pt_sequence)) GROUP BY 1, 2)"
_UNITS = f"(SELECT source, round(avg(ratio), 6) AS mean_ratio, count(*) AS shapes FROM {_RATIO} GROUP BY 1)"
_UNIT = "CASE WHEN mean_ratio BETWEEN 0.0005 AND 0.002 THEN 'km' WHEN mean_ratio BETWEEN 0.5 AND 2.0 THEN 'm' ELSE 'unknown' END"
query("shape_units", lambda d: extra.shape_units(extra.shape_length_ratio(d.shapes)), f"SELECT *, {_UNIT} AS unit FROM {_UNITS}")
query("rescaled_shapes", lambda d: extra.rescaled_shapes(d.shapes, extra.shape_units(extra.shape_length_ratio(d.shapes))).select("source", "shape_id", "shape_pt_sequence", F.round("shape_dist_traveled", 3).alias("shape_dist_traveled")), f"SELECT s.source, shape_id, shape_pt_sequence, round(CASE {_UNIT} WHEN 'km' THEN shape_dist_traveled * 1000 WHEN 'm' THEN shape_dist_traveled END, 3) AS shape_dist_traveled FROM v_shapes s JOIN {_UNITS} USING (source)")
query("full_calendar_masks", lambda d: d.full_calendar().groupBy("days_of_week").agg(F.count(F.lit(1)).alias("n")), "SELECT days_of_week, count(*) AS n FROM s_calendar GROUP BY 1")
