"""Radius joins on a grid, airports, flights and emission factors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import (
    AIR_BLENDS, AIR_COUNTRIES, AIRPORT_RADIUS_M, CITY_CELL_DEG, CITY_RADIUS_M, DIESEL_G_PKM, ELECTRIC_TYPES, ELECTRIFIED,
    COUNTRY_NAMES, EMISSION_ROUTE_TYPES, ENERGY_USE, ENERGY_USE_ELSE, EUROPE_BOX, ISO2, MICRO_CODES, MICRO_STATES, MIN_FLIGHT_KM,
)
from ..functions import columns as C
from ..sources.tables import settled
from . import spread

#: Metres of a degree of latitude, a little low so that no cell is missed.
DEGREE_M = 111_000.0


def cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("int")


def within(a: DataFrame, b: DataFrame, radius: float, size: float) -> DataFrame:
    """Pairs of a (lat, lon) and b (lat2, lon2) within a radius, with metres: exact at any latitude.

    Each row of a visits the cells that its circle can touch: the span of longitudes widens with the latitude.
    """
    up = radius / DEGREE_M
    wide = F.least(F.lit(180.0), up / F.greatest(F.cos(F.radians(F.least(F.abs("lat") + up, F.lit(89.9)))), F.lit(0.01)))
    rows = a.withColumn("cy", F.explode(F.sequence(cell(F.col("lat") - up, size), cell(F.col("lat") + up, size))))
    rows = rows.withColumn("cx", F.explode(F.sequence(cell(F.col("lon") - wide, size), cell(F.col("lon") + wide, size))))
    other = b.withColumn("cy", cell(F.col("lat2"), size)).withColumn("cx", cell(F.col("lon2"), size))
    metres = C.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return rows.join(other, ["cy", "cx"]).drop("cy", "cx").withColumn("metres", metres).where(F.col("metres") < radius)


def nearest_city(points: DataFrame, cities: DataFrame, keys: list[str], radius: float = CITY_RADIUS_M, size: float = CITY_CELL_DEG) -> DataFrame:
    """keys, city_id, city_name, city_country, metres of the nearest city; of equal distances the larger one.

    Places meet, not rows: of the cities at one place only the largest can be the nearest, and points at one place have the
    same nearest city, so each place of either side takes part in the radius join once.
    """
    order = [F.col("population").desc_nulls_last(), F.col("city_id")]
    best = lambda df, by, first: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*first, *order))).where("rank = 1").drop("rank")
    b = cities.select(F.col("geonameid").alias("city_id"), F.col("asciiname").alias("city_name"), F.col("country_code").alias("city_country"), "population", F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"))
    pairs = within(points.select("lat", "lon").distinct(), best(b, ["lat2", "lon2"], []), radius, size).withColumn("metres", F.round("metres", 3))
    near = best(pairs, ["lat", "lon"], ["metres"]).drop("lat2", "lon2")
    return best(points.select(*keys, "lat", "lon").join(near, ["lat", "lon"]), keys, ["metres"]).select(*keys, "city_id", "city_name", "city_country", "metres")


def station_airport_match(stations: DataFrame, airports: DataFrame, radius: float = AIRPORT_RADIUS_M) -> DataFrame:
    """The nearest airport of each station and the nearest station of each airport, distance in km.

    Both sides are numbered in the order of their names, so a pair is one whole number for either end: hundredths of km,
    then the number of the other end, which decides ties. Of these a hash aggregate keeps the least for each station and
    each airport, on the map side first; pairs within the radius are never sorted or exchanged.
    """
    near = spread.numbered(stations.select("source", "stop_id", "lat", "lon"), ["source", "stop_id", "lat", "lon"], "station")
    ports = spread.numbered(airports.select("ident", F.col("latitude_deg").alias("lat2"), F.col("longitude_deg").alias("lon2")), ["ident", "lat2", "lon2"], "airport")
    near, ports = settled(near, "stations"), settled(ports, "airports")
    pairs = within(near.select("station", "lat", "lon"), ports.select("airport", "lat2", "lon2"), radius, 1.0)
    far = C.units(F.round(F.col("metres") / 1000.0, 2), 2)
    end = lambda k, own, other: F.struct(F.lit(k).alias("side"), F.col(own).alias("own"), (F.shiftleft(far, _NUMBER_BITS) + F.col(other)).alias("pair"))
    best = pairs.select(F.explode(F.array(end(0, "station", "airport"), end(1, "airport", "station"))).alias("x")).groupBy("x.side", "x.own").agg(F.min("x.pair").alias("pair"))
    other, by_station = F.col("pair").bitwiseAND(2**_NUMBER_BITS - 1), F.col("side") == 0
    found = best.select(
        F.when(by_station, F.col("own")).otherwise(other).alias("station"), F.when(by_station, other).otherwise(F.col("own")).alias("airport"),
        (F.shiftright("pair", _NUMBER_BITS) / 100.0).alias("distance_km"),
    ).distinct()
    return found.join(near, "station").join(ports, "airport").select("source", "stop_id", "ident", "distance_km")


#: Bits of a pair for the number of a station or airport.
_NUMBER_BITS = 40


def with_unmatched(matched: DataFrame, stations: DataFrame, airports: DataFrame) -> DataFrame:
    lone_stations = stations.select("source", "stop_id").join(matched, ["source", "stop_id"], "left_anti")
    lone_airports = airports.select("ident").join(matched, "ident", "left_anti")
    return matched.unionByName(lone_stations, allowMissingColumns=True).unionByName(lone_airports, allowMissingColumns=True)


def airport_filter(airports: DataFrame) -> DataFrame:
    south, north, west, east = EUROPE_BOX
    inside = F.col("latitude_deg").between(south, north) & F.col("longitude_deg").between(west, east)
    sizes = F.col("type").isin("small_airport", "medium_airport", "large_airport")
    return airports.where(sizes & F.col("iso_country").isin(*AIR_COUNTRIES) & ((F.col("iso_country") != "RU") | inside)).dropDuplicates(["ident"])


def airport_pairs(airports: DataFrame, least_km: float = MIN_FLIGHT_KM) -> DataFrame:
    """Ordered pairs of airports and their flight class. This product is the result itself: all routes between airports.

    The register of airports has a fixed extent (some thousand rows), whatever the timetables grow to.
    """
    side = lambda p: airports.select(F.col("ident").alias(f"{p}_id"), F.col("name").alias(f"{p}_name"), F.col("type").alias(f"{p}_type"), F.col("iso_country").alias(f"{p}_country"), F.col("latitude_deg").alias(f"{p}_lat"), F.col("longitude_deg").alias(f"{p}_lon"))
    pairs = side("origin").join(side("dest"), F.col("origin_id") != F.col("dest_id"))
    km = F.round(C.haversine_m(F.col("origin_lat"), F.col("origin_lon"), F.col("dest_lat"), F.col("dest_lon")) / 1000.0, 2)
    return pairs.withColumn("distance_km", km).where(F.col("distance_km") >= least_km).drop("origin_lat", "origin_lon", "dest_lat", "dest_lon")


def air_scenarios(pairs: DataFrame) -> DataFrame:
    """The class of each pair from the two sizes and the distance; pairs out of every class are dropped."""
    size = lambda c: F.regexp_replace(c, "_airport$", "")
    o, d, km = size(F.col("origin_type")), size(F.col("dest_type")), F.col("distance_km")
    other = F.when(o == "small", d).when(d == "small", o)
    kind = (
        F.when(other.isNotNull(), F.when(km <= 1000, F.concat(F.lit("small_"), other, F.lit("_1000km"))))
        .when(d == "large", F.concat(o, F.lit("_large_unlimited")))
        .when(km <= 5000, F.concat(o, F.lit("_medium_5000km")))
    )
    ref = F.create_map(*[F.lit(x) for k, (i, _) in AIR_BLENDS.items() for x in (k, i)])
    return pairs.withColumn("trajet_type", kind).where("trajet_type is not null").withColumn("emission_ref", ref[F.col("trajet_type")].cast("long"))


# ---- factors


def latest_per_country(intensity: DataFrame) -> DataFrame:
    kept = intensity.where(~F.col("entity_code").startswith("EU"))
    return kept.groupBy("entity_code").agg(F.max("date").cast("int").alias("year"), F.max_by("emissions_intensity_gco2_per_kwh", "date").alias("intensity"))


def intensity_by_country(intensity: DataFrame) -> DataFrame:
    """country_code, intensity: two-letter codes; micro-states take their neighbour's value, AD the mean of FR and ES.

    A code that the table lacks stays as it is, so no row is lost and it can be reported.
    """
    code = F.create_map(*[F.lit(x) for kv in ISO2.items() for x in kv])
    known = latest_per_country(intensity).where(~F.col("entity_code").isin(*MICRO_CODES))
    known = known.select(F.coalesce(code[F.col("entity_code")], "entity_code").alias("country_code"), "intensity")
    near = F.create_map(*[F.lit(x) for n in sorted(set(MICRO_STATES.values())) for x in (n, [m for m, k in MICRO_STATES.items() if k == n][0])])
    micro = known.select(near[F.col("country_code")].alias("country_code"), "intensity").where("country_code is not null")
    both = known.where("country_code in ('FR', 'ES')").agg(F.avg("intensity").alias("intensity"), F.count(F.lit(1)).alias("n")).where("n = 2")
    return known.unionByName(micro).unionByName(both.select(F.lit("AD").alias("country_code"), "intensity"))


def air_factor_base(factors: DataFrame) -> DataFrame:
    """Mean kg per passenger km for each seat and distance class of generic, valid rows without post type."""
    seats = F.regexp_extract("label", r"^(\S+) seats", 1)
    far = F.regexp_extract("label", r", (\S+) km", 1)
    seat = F.when(seats == "20-50", "small").when(seats.isin("51-100", "101-220"), "medium").when(seats == ">220", "large")
    dist = F.when(far.isin("<500", "500-1000"), "short").when(far.isin("1000-2000", "2000-5000"), "medium").when(far == ">5000", "long")
    good = factors.where("status = 'Valid generic' and post_type is null").select(F.concat_ws("_", seat, dist).alias("class"), "kg_per_pkm")
    return good.groupBy("class").agg(F.avg("kg_per_pkm").alias("kg_per_pkm"))


def air_factor_weighted(base: DataFrame) -> DataFrame:
    """emission_ref, trajet_type, g per passenger km of each flight class; a missing base class counts as 0."""
    weights = [(i, kind, c, w) for kind, (i, blend) in AIR_BLENDS.items() for c, w in blend.items()]
    table = base.sparkSession.createDataFrame(weights, "emission_ref long, trajet_type string, class string, weight double")
    grams = F.round(F.sum(F.col("weight") * F.coalesce("kg_per_pkm", F.lit(0.0))) * 1000, 3)
    return table.join(base, "class", "left").groupBy("emission_ref", "trajet_type").agg(grams.alias("g_per_pkm"))


def air_factor_table(base: DataFrame) -> DataFrame:
    """emission_ref, g_per_pkm, detail: the base classes numbered from 1 by name, then the flight classes from 100 on."""
    own = base.where("class is not null").withColumn("emission_ref", F.row_number().over(Window.orderBy("class")).cast("long"))
    own = own.select("emission_ref", F.round(F.col("kg_per_pkm") * 1000, 3).alias("g_per_pkm"), F.concat(F.lit("Air "), "class", F.lit(", mean")).alias("detail"))
    parts = {kind: " + ".join(f"{w} x {c}" for c, w in blend.items()) for kind, (_, blend) in AIR_BLENDS.items()}
    text = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    mixed = air_factor_weighted(base).select("emission_ref", "g_per_pkm", F.concat(F.lit("Air "), "trajet_type", F.lit(", "), text[F.col("trajet_type")]).alias("detail"))
    return own.unionByName(mixed)


def rail_factors(countries: DataFrame, intensity: DataFrame) -> DataFrame:
    """country_code, route_type, g per passenger km. countries: country_code; intensity: of intensity_by_country()."""
    known = intensity.groupBy("country_code").agg(F.avg("intensity").alias("intensity"))
    use = F.coalesce(F.create_map(*[F.lit(x) for kv in ENERGY_USE.items() for x in kv])[F.col("route_type")], F.lit(ENERGY_USE_ELSE))
    share = F.coalesce(F.create_map(*[F.lit(x) for kv in ELECTRIFIED.items() for x in kv])[F.col("country_code")], F.lit(sum(ELECTRIFIED.values()) / len(ELECTRIFIED)))
    mean = intensity.agg(F.coalesce(F.avg("intensity"), F.lit(60.0)).alias("mean_intensity"))  # one row
    rows = countries.withColumn("route_type", F.explode(F.array(*map(F.lit, EMISSION_ROUTE_TYPES)))).join(known, "country_code", "left").crossJoin(mean)
    power = use * F.coalesce("intensity", "mean_intensity")
    grams = F.when(F.col("route_type").isin(*ELECTRIC_TYPES), power).otherwise(share * power + (1 - share) * DIESEL_G_PKM)
    return rows.select("country_code", "route_type", F.round(grams, 3).alias("g_per_pkm"))


def emission_table(rail: DataFrame, air: DataFrame) -> DataFrame:
    """emission_ref, country_code, route_type, g_per_pkm, detail: air_factor_table() and, numbered after it, rail_factors().

    Both are dimensions of a few hundred rows.
    """
    last = air.agg(F.coalesce(F.max("emission_ref"), F.lit(0)).alias("last"))
    number = F.row_number().over(Window.orderBy("country_code", "route_type"))
    numbered = rail.withColumn("number", number).crossJoin(last).withColumn("emission_ref", F.col("number") + F.col("last"))
    detail = F.concat(F.lit("Rail type "), F.col("route_type").cast("string"), F.lit(", "), "country_code")
    return numbered.select("emission_ref", "country_code", "route_type", "g_per_pkm", detail.alias("detail")).unionByName(air, allowMissingColumns=True)


def country_names(spark: SparkSession, own: dict[str, str] = COUNTRY_NAMES) -> DataFrame:
    """country_code, country_name of all countries of ISO 3166, in English: those of the Java library, but for our own."""
    java = spark._jvm.java.util.Locale
    codes = {c: java("", c).getDisplayCountry(java.ENGLISH) for c in java.getISOCountries()}
    return spark.createDataFrame(sorted((codes | own).items()), "country_code string, country_name string")


def city_dimension(*places: DataFrame) -> DataFrame:
    """city_id, city_name, country_code, country_name: the cities of all places (city_name, city_country), by country and name."""
    each = [p.select("city_name", F.col("city_country").alias("country_code")).dropna() for p in places]
    rows = reduce(DataFrame.unionByName, each).distinct().where(F.length("country_code") == 2)
    ids = spread.numbered(rows, ["country_code", "city_name"], "city_id").join(F.broadcast(country_names(rows.sparkSession)), "country_code", "left")
    return ids.select(F.col("city_id").cast("int").alias("city_id"), "city_name", "country_code", "country_name")
