"""Further operators on feeds, matches, factors and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import spread
from .places import DEGREE_M, cell
from .rail import TRIP


def override_agency(df: DataFrame, table: dict[str, tuple[str, str, str]], fill_only: bool = False) -> DataFrame:
    """Agency id, name and zone of some sources: replaced, or with fill_only set where they are null."""
    names = ("agency_id", "agency_name", "agency_timezone")
    out = []
    for c in df.columns:
        if c in names:
            new = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v[names.index(c)])])[F.col("source")]
            out.append((F.coalesce(c, new) if fill_only else F.coalesce(new, c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def canon_name(c: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[F.lower(c)], c)


def multi_calendar_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    out = df.where("days_of_week is not null").groupBy(*keys).agg(F.array_sort(F.collect_set("days_of_week")).alias("masks"))
    return out.where(F.size("masks") > 1).select(*keys, F.size("masks").alias("n"), F.array_join("masks", ",").alias("masks"))


def fallback_factor(df: DataFrame, factor: str, operator: str, country: str) -> DataFrame:
    """A missing factor is the mean of its operator, else of its country, else of all; rounded to 4 digits."""
    mean = F.avg(factor)
    by_operator = df.groupBy(operator).agg(mean.alias("by_operator")).where(F.col(operator).isNotNull())
    by_country = df.groupBy(country).agg(mean.alias("by_country")).where(F.col(country).isNotNull())
    out = df.join(by_operator, operator, "left").join(by_country, country, "left").crossJoin(df.agg(mean.alias("by_all")))
    return out.withColumn(factor, F.round(F.coalesce(factor, "by_operator", "by_country", "by_all"), 4)).drop("by_operator", "by_country", "by_all")


def segment_emissions(df: DataFrame, factor: str) -> DataFrame:
    """kg of each segment: g per km times metres."""
    return df.withColumn("segment_kg", C.half_up(F.col(factor) * F.col("segment_dist_m") / 1e6, 2))


def replace_with_fk(fact: DataFrame, cities: DataFrame, city: str, country: str, key: str) -> DataFrame:
    """The two columns of a place become its id. cities: city_id, city_name, city_country."""
    dim = cities.select(F.col("city_name").alias(city), F.col("city_country").alias(country), F.col("city_id").alias(key))
    return fact.join(dim, [city, country], "left").drop(city, country)


def replace_both_ends(flights: DataFrame, cities: DataFrame) -> DataFrame:
    """Flights with the city ids of both ends in place of names and countries; emission_ref stays. cities: as above."""
    out = replace_with_fk(flights, cities, "origin_city", "origin_country", "origin_city_id")
    return replace_with_fk(out, cities, "dest_city", "dest_country", "dest_city_id")


def with_emission_ref(events: DataFrame, table: DataFrame) -> DataFrame:
    """Events with the emission_ref of their country and route type. table: of emission_table()."""
    keys = table.where("country_code is not null").select(F.col("country_code").alias("country"), "route_type", "emission_ref")
    return events.join(keys, ["country", "route_type"], "left")


def surrogate_keys(dim: DataFrame, order: list[str], name: str) -> DataFrame:
    """Numbers from 1 without gaps, by an order that must be total."""
    return spread.numbered(dim, order, name)


def orphan_filter(shapes: DataFrame, used: DataFrame, keys: list[str]) -> DataFrame:
    return shapes.join(used.select(*keys).distinct(), keys, "left_semi")


def country_dissonance_filter(stops: DataFrame, found: DataFrame) -> DataFrame:
    """Stops whose feed's country is the one of their nearest city, or that have none near."""
    out = stops.join(found.select("source", "stop_id", "city_country"), ["source", "stop_id"], "left")
    return out.where(F.col("city_country").isNull() | (F.col("city_country") == F.substring("source", 1, 2))).drop("city_country")


def od_geo_match(a: DataFrame, b: DataFrame, radius: float = 5000.0, size: float = 0.1) -> DataFrame:
    """Trips of a and b whose first stops, and whose last stops, are within a radius. Input: first_last_stop().

    a visits the cells around its first stop; b stands in its own, so pairs meet on the first stop's cell alone.
    """
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in (*TRIP, "first_stop_lat", "first_stop_lon", "last_stop_lat", "last_stop_lon")])
    x, y = side(a, "a"), side(b, "b")
    up = radius / DEGREE_M
    wide = up / F.greatest(F.cos(F.radians(F.abs("a_first_stop_lat") + up)), F.lit(0.01))
    x = x.withColumn("cy", F.explode(F.sequence(cell(F.col("a_first_stop_lat") - up, size), cell(F.col("a_first_stop_lat") + up, size))))
    x = x.withColumn("cx", F.explode(F.sequence(cell(F.col("a_first_stop_lon") - wide, size), cell(F.col("a_first_stop_lon") + wide, size))))
    y = y.withColumn("cy", cell(F.col("b_first_stop_lat"), size)).withColumn("cx", cell(F.col("b_first_stop_lon"), size))
    near = lambda e: C.haversine_m(F.col(f"a_{e}_stop_lat"), F.col(f"a_{e}_stop_lon"), F.col(f"b_{e}_stop_lat"), F.col(f"b_{e}_stop_lon")) < radius
    return x.join(y, ["cy", "cx"]).where(near("first") & near("last")).select("a_source", "a_trip_id", "b_source", "b_trip_id")


def best_match_level(matches: DataFrame) -> DataFrame:
    """matches: night_id, source, trip_id, level. The best level of each night trip; ties by source and trip."""
    order = Window.partitionBy("night_id").orderBy("level", "source", "trip_id")
    return matches.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def flag_night(events: DataFrame, matched: DataFrame) -> DataFrame:
    keys = matched.select(*TRIP).distinct().withColumn("hit", F.lit(True))
    return events.join(keys, TRIP, "left").withColumn("is_night_train", F.coalesce("hit", F.lit(False)) | (F.col("route_type") == 105)).drop("hit")


def dedupe_best_row(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The best row of each group (distance, then name, then CO2, then trip id), with the days of all."""
    order = Window.partitionBy(*keys).orderBy(F.col("distance_km").isNull(), F.col("trip_short_name").isNull(), F.col("emissions_co2").isNull(), "trip_id", "source", "departure_parent_station", "arrival_parent_station", "route_type")
    best = rows.withColumn("rank", F.row_number().over(order)).where("rank = 1").select(*keys, "source", "trip_id")
    days = rows.groupBy(*keys).agg(C.mask_or(F.col("days_of_week")).alias("days_of_week"))
    return best.join(days, keys)


def factor_gaps(df: DataFrame, a: str, b: str) -> DataFrame:
    """df with gap: by how many per cent a is over b."""
    return df.where(F.col(b) > 0).withColumn("gap", 100.0 * (F.col(a) - F.col(b)) / F.col(b))


def factor_comparison(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """The spread of the gap, for all rows or for each group."""
    p = lambda q: F.round(F.percentile("gap", q), 2)
    return factor_gaps(df, a, b).groupBy(*(by or [])).agg(F.round(F.min("gap"), 2).alias("lowest"), p(0.25).alias("q1"), p(0.5).alias("median"), C.exact_mean("gap", 4, 2).alias("mean"), p(0.75).alias("q3"), F.round(F.max("gap"), 2).alias("highest"))


def shape_length_ratio(shapes: DataFrame) -> DataFrame:
    """Declared length over the length of the line, for each shape."""
    w = Window.partitionBy("source", "shape_id").orderBy("shape_pt_sequence")
    step = C.haversine_m(F.lag("shape_pt_lat").over(w), F.lag("shape_pt_lon").over(w), F.col("shape_pt_lat"), F.col("shape_pt_lon"))
    out = shapes.withColumn("step", step).groupBy("source", "shape_id").agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("step")).alias("metres"), F.max("shape_dist_traveled").alias("declared"))
    return out.withColumn("ratio", F.round(F.col("declared") / F.nullif("metres", F.lit(0.0)), 4))


def shape_units(ratios: DataFrame) -> DataFrame:
    """source, mean_ratio, unit: km where declared lengths are about a thousandth of the metres, m where about equal."""
    mean = ratios.groupBy("source").agg(F.round(F.avg("ratio"), 6).alias("mean_ratio"), F.count(F.lit(1)).alias("shapes"))
    unit = F.when(F.col("mean_ratio").between(0.0005, 0.002), "km").when(F.col("mean_ratio").between(0.5, 2.0), "m").otherwise("unknown")
    return mean.withColumn("unit", unit)


def rescaled_shapes(shapes: DataFrame, units: DataFrame) -> DataFrame:
    """Declared lengths in metres; those of feeds whose unit makes no sense are dropped."""
    out = shapes.join(units.select("source", "unit"), "source", "left")
    metres = F.when(F.col("unit") == "km", F.col("shape_dist_traveled") * 1000.0).when(F.col("unit") == "m", F.col("shape_dist_traveled"))
    return out.withColumn("shape_dist_traveled", metres).drop("unit")


def ranked_options(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """candidates (mode, duration_min, connections, emissions_co2) ranked in each group: time, then changes, then CO2."""
    order = Window.partitionBy(*keys).orderBy(F.col("duration_min").asc_nulls_last(), "connections", F.col("emissions_co2").asc_nulls_last(), F.desc("mode"))
    return candidates.withColumn("rank", F.row_number().over(order))


def fastest_option(compare: DataFrame) -> DataFrame:
    """train or flight by duration, then CO2; the one that exists if there is one alone."""
    t, f = F.col("train_duration_min"), F.col("flight_duration_min")
    train_first = (t < f) | ((t == f) & (F.col("train_emissions_co2") <= F.col("flight_emissions_co2")))
    return compare.withColumn("fastest", F.when(t.isNull(), "flight").when(f.isNull(), "train").when(train_first, "train").otherwise("flight"))


def city_candidates(rail: DataFrame, flights: DataFrame) -> DataFrame:
    """One row for each mode that serves a city pair: the best trains and the best flights, stacked."""
    keys = ["departure_city", "departure_country", "arrival_city", "arrival_country"]
    side = lambda df, m, n: df.select(*keys, F.lit(m).alias("mode"), F.lit(n).alias("connections"), *[F.col(f"{m}_{c}").alias(c) for c in ("distance_km", "duration_min", "emissions_co2")])
    return side(rail, "train", 0).unionByName(side(flights, "flight", 2))


def day_night_balance(gold: DataFrame) -> DataFrame:
    rows = gold.where("mode = 'train' and departure_city is not null and arrival_city is not null")
    out = rows.groupBy("departure_city", "arrival_city", "departure_country").agg(F.count_if("is_night_train").alias("nights"), F.count(F.lit(1)).alias("n"))
    pct = F.round(100.0 * F.col("nights") / F.col("n"), 2)
    return out.withColumn("night_pct", pct).withColumn("class", F.when(F.col("nights") == 0, "day only").when(F.col("nights") == F.col("n"), "night only").otherwise("both"))


KPI_COLUMNS = ("departure_city", "arrival_city", "agency_name", "distance_km", "emissions_co2")


def kpi_overview(gold: DataFrame) -> DataFrame:
    filled = sum((F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0) for c in KPI_COLUMNS), F.lit(0.0))
    train, night = F.col("mode") == "train", F.coalesce("is_night_train", F.lit(False))
    return gold.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(train).alias("trains"), F.count_if(~train).alias("flights"), F.round(100.0 * F.count_if(night) / F.nullif(F.count_if(train), F.lit(0)), 2).alias("night_pct"),
        C.exact_mean(F.when(train, F.col("emissions_co2")), 3, 2).alias("mean_train_co2"), F.countDistinct("departure_country").alias("countries"),
        F.round(F.sum(filled) * 100.0 / (len(KPI_COLUMNS) * F.nullif(F.count(F.lit(1)), F.lit(0))), 2).alias("mean_filled_pct"),
    )


def type_conflicts(catalogue: DataFrame) -> DataFrame:
    """catalogue: table, column, type. Columns seen with several types."""
    out = catalogue.groupBy("column").agg(F.array_sort(F.collect_set("type")).alias("types"), F.countDistinct("table").alias("tables"))
    return out.where(F.size("types") > 1).select("column", F.array_join("types", ",").alias("types"), "tables")


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(new.dropDuplicates(keys).join(old, keys, "left_anti"))


def last_wins(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    both = old.withColumn("age", F.lit(1)).unionByName(new.withColumn("age", F.lit(0)))
    order = Window.partitionBy(*keys).orderBy("age")
    return both.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank", "age")
