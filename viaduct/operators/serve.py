"""Read queries over the gold tables, and the filters they share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GOLD_COLUMNS
from ..functions import columns as C


def where_all(df: DataFrame, *, exact: dict | None = None, contains: dict | None = None, like: dict | None = None, least: dict | None = None, most: dict | None = None) -> DataFrame:
    """Optional filters: equality, case-insensitive literal containment, patterns, bounds. None values are skipped."""
    given = lambda d: [(F.col(c), v) for c, v in (d or {}).items() if v is not None]
    tests: list[Column] = [c == v for c, v in given(exact)] + [F.contains(F.lower(c), F.lit(v.lower())) for c, v in given(contains)]
    tests += [c.like(v) for c, v in given(like)] + [c >= v for c, v in given(least)] + [c <= v for c, v in given(most)]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def counted_page(df: DataFrame, order: list[Column | str], number: int, size: int) -> DataFrame:
    """A page, each row with `total`, the number of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return page(df, order, number, size).crossJoin(total)


def upper(code: str | None) -> str | None:
    return code and code.upper()


def list_routes(
    gold: DataFrame, *, mode: str | None = None, source: str | None = None, departure_country: str | None = None, arrival_country: str | None = None,
    departure_city: str | None = None, arrival_city: str | None = None, departure_station: str | None = None, arrival_station: str | None = None,
    agency_name: str | None = None, route_type: int | str | None = None, is_night_train: bool | None = None, days_of_week: str | None = None,
    min_distance_km: float | None = None, max_distance_km: float | None = None, min_co2: float | None = None, max_co2: float | None = None,
    service_start_after: str | None = None, service_end_before: str | None = None,
) -> DataFrame:
    """Connections by up to 18 filters; dates as YYYY-MM-DD or eight digits."""
    day = lambda d: d and d.replace("-", "")
    dated = gold.withColumns({"__start": C.norm_date8(F.col("service_start_date")), "__end": C.norm_date8(F.col("service_end_date"))}) if service_start_after or service_end_before else gold
    out = where_all(
        dated,
        exact={"mode": mode, "source": source, "departure_country": upper(departure_country), "arrival_country": upper(arrival_country), "route_type": None if route_type is None else str(route_type), "is_night_train": is_night_train},
        contains={"departure_city": departure_city, "arrival_city": arrival_city, "departure_station": departure_station, "arrival_station": arrival_station, "agency_name": agency_name},
        like={"days_of_week": days_of_week},
        least={"distance_km": min_distance_km, "emissions_co2": min_co2, "__start": day(service_start_after)},
        most={"distance_km": max_distance_km, "emissions_co2": max_co2, "__end": day(service_end_before)},
    )
    return out.select(*gold.columns)


def list_compare(
    compare: DataFrame, *, departure_city: str | None = None, departure_country: str | None = None, arrival_city: str | None = None, arrival_country: str | None = None, best_mode: str | None = None, days_of_week: str | None = None,
    min_train_duration: float | None = None, max_train_duration: float | None = None, min_flight_duration: float | None = None, max_flight_duration: float | None = None,
) -> DataFrame:
    """Comparisons by up to 10 filters; days_of_week is a pattern of seven characters, such as `1____11`."""
    return where_all(
        compare,
        exact={"departure_country": upper(departure_country), "arrival_country": upper(arrival_country), "best_mode": best_mode},
        contains={"departure_city": departure_city, "arrival_city": arrival_city},
        like={"days_of_week": days_of_week},
        least={"train_duration_min": min_train_duration, "flight_duration_min": min_flight_duration},
        most={"train_duration_min": max_train_duration, "flight_duration_min": max_flight_duration},
    )


def day_night_routes(gold: DataFrame, **filters: object) -> DataFrame:
    """Trains by the filters of list_routes()."""
    names = ("departure_city", "departure_country", "arrival_city", "arrival_country", "agency_name", "route_long_name", "is_night_train", "days_of_week", "departure_time", "arrival_time", "distance_km", "co2_per_pkm", "emissions_co2")
    return list_routes(gold, mode="train", **filters).select(*names)


def corridor(df: DataFrame, origin: str, destination: str) -> DataFrame:
    return where_all(df, contains={"departure_city": origin, "arrival_city": destination})


def day_night_compare(gold: DataFrame, origin: str, destination: str) -> DataFrame:
    """Day and night trains of a corridor, with `best`: the kind of less mean emissions, where there are both."""
    rows = corridor(gold.where("mode = 'train'"), origin, destination).groupBy("is_night_train").agg(
        F.count(F.lit(1)).alias("options"), C.exact_mean("distance_km", 2, 1).alias("mean_km"), C.exact_mean("co2_per_pkm", 3, 2).alias("mean_co2_per_pkm"), C.exact_mean("emissions_co2", 3, 1).alias("mean_co2"),
        C.half_up(F.min("emissions_co2"), 1).alias("least_co2"), C.half_up(F.max("emissions_co2"), 1).alias("most_co2"), F.min("departure_time").alias("earliest"), F.max("departure_time").alias("latest"),
        F.array_join(F.array_sort(F.collect_set("agency_name")), ", ").alias("operators"),
    )
    day, night = (F.max(F.when(F.col("is_night_train") == k, F.coalesce("mean_co2", F.lit(float("inf"))))) for k in (False, True))
    best = rows.agg(F.when(day.isNotNull() & night.isNotNull(), F.when(day <= night, "day").otherwise("night")).alias("best"))
    return rows.crossJoin(best)


def stations_by_city(gold: DataFrame, country: str, city: str) -> DataFrame:
    night = F.col("is_night_train")
    rows = list_routes(gold, mode="train", departure_country=country, departure_city=city).where("departure_station is not null")
    return rows.groupBy(F.col("departure_station").alias("station"), F.col("departure_parent_station").alias("parent_station")).agg(
        F.count(F.lit(1)).alias("departures"), F.countDistinct("arrival_city").alias("destinations"), F.countDistinct("agency_name").alias("n_operators"),
        F.array_join(F.array_sort(F.collect_set("agency_name")), ", ").alias("operators"), F.count_if(night).alias("nights"), F.count_if(~night).alias("days"),
    )


def airports_by_city(gold: DataFrame, country: str, city: str) -> DataFrame:
    rows = list_routes(gold, mode="flight", departure_country=country, departure_city=city).where("departure_station is not null")
    return rows.groupBy(F.col("departure_station").alias("airport")).agg(F.count(F.lit(1)).alias("flights"), F.countDistinct("arrival_city").alias("destinations"), F.countDistinct("arrival_country").alias("countries"), C.exact_mean("distance_km", 2, 1).alias("mean_km"))


def highest_factors(gold: DataFrame, country: str | None = None) -> DataFrame:
    """The largest factor by country, or by day and night for one country's trains."""
    if country is None:
        return gold.groupBy(F.col("departure_country").alias("label")).agg(F.max("co2_per_pkm").alias("highest"))
    rows = list_routes(gold, mode="train", departure_country=country)
    return rows.groupBy(F.when(F.col("is_night_train"), "night").otherwise("day").alias("label")).agg(F.max("co2_per_pkm").alias("highest"))


def page(df: DataFrame, order: list[Column | str], number: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), digits)



def search_routes(gold: DataFrame, a: str, b: str, day: str | None = None, weekday: int | None = None) -> DataFrame:
    """Connections between two places (city or station), both ways, running on a date and a weekday (1 is Monday)."""
    at = lambda end, place: F.lower(F.coalesce(f"{end}_city", F.lit(""))).contains(place.lower()) | F.lower(f"{end}_station").contains(place.lower())
    rows = gold
    if day:
        date = day.replace("-", "")
        rows = rows.where((C.norm_date8(F.col("service_start_date")) <= date) & (C.norm_date8(F.col("service_end_date")) >= date))
    if weekday:
        rows = rows.where(F.substring("days_of_week", weekday, 1) == "1")
    there = rows.where(at("departure", a) & at("arrival", b)).withColumn("direction", F.lit("outbound"))
    return there.unionByName(rows.where(at("departure", b) & at("arrival", a)).withColumn("direction", F.lit("return")))


def carbon_ranking(compare: DataFrame, n: int) -> DataFrame:
    both = compare.where("train_emissions_co2 is not null and flight_emissions_co2 > 0")
    saving = F.round(100.0 * (F.col("flight_emissions_co2") - F.col("train_emissions_co2")) / F.col("flight_emissions_co2"), 2)
    out = both.select("departure_city", "departure_country", "arrival_city", "arrival_country", saving.alias("co2_saving_pct"))
    return out.orderBy(F.desc("co2_saving_pct"), "departure_city", "departure_country", "arrival_city", "arrival_country").limit(n)


def carbon_factors(gold: DataFrame) -> DataFrame:
    return gold.groupBy("departure_country", "mode", "is_night_train", "co2_per_pkm").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("route_type")), ",").alias("route_types"))


def day_night_coverage(gold: DataFrame) -> DataFrame:
    rows = gold.where("mode = 'train'")
    return rows.groupBy("departure_country", "is_night_train").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("agency_name").alias("agencies"), F.countDistinct("departure_city").alias("cities"),
        F.countDistinct("arrival_country").alias("countries"), C.exact_mean("distance_km", 2, 1).alias("mean_km"),
    )


def day_night_emissions(gold: DataFrame) -> DataFrame:
    night = F.col("is_night_train")
    mean = lambda test, c: C.exact_mean(F.when(test, F.col(c)), 3, 2)
    out = gold.where("mode = 'train'").groupBy("departure_country").agg(
        mean(night, "emissions_co2").alias("night_co2"), mean(~night, "emissions_co2").alias("day_co2"), F.count_if(night).alias("n_night"), F.count_if(~night).alias("n_day")
    )
    return out.where("n_night > 0")


def day_night_summary(gold: DataFrame) -> DataFrame:
    return gold.where("mode = 'train'").groupBy("is_night_train").agg(
        F.countDistinct(F.struct("departure_station", "arrival_station")).alias("pairs"), C.exact_mean("distance_km", 2, 1).alias("mean_km"), F.round(F.percentile("distance_km", 0.5), 2).alias("median_km"), F.count(F.lit(1)).alias("n")
    )


FILLED = [c for c in GOLD_COLUMNS if c not in ("source", "mode")]


def completeness(gold: DataFrame, by: list[str]) -> DataFrame:
    """Share of filled values of each column, in one scan."""
    return gold.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[share(F.count(c), F.count(F.lit(1))).alias(f"{c}_pct") for c in FILLED if c not in by])


def coverage_countries(gold: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    train, flight, night = F.count_if(F.col("mode") == "train"), F.count_if(F.col("mode") == "flight"), F.count_if(F.coalesce("is_night_train", F.lit(False)))
    return gold.groupBy("departure_country").agg(n.alias("n"), train.alias("trains"), flight.alias("flights"), night.alias("nights"), share(train, n).alias("train_pct"), share(night, train).alias("night_pct"))


def coverage_cities(gold: DataFrame, role: str, n: int) -> DataFrame:
    """The cities with most connections as departure or arrival; other_countries counts distinct departure countries."""
    role = "departure" if role == "both" else role
    out = gold.where(F.col(f"{role}_city").isNotNull()).groupBy(F.col(f"{role}_city").alias("city"), F.col(f"{role}_country").alias("country"))
    other = "arrival_country" if role == "departure" else "departure_country"
    return out.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(other).alias("other_countries")).orderBy(F.desc("n"), "city", "country").limit(n)


def schedule_patterns(gold: DataFrame) -> DataFrame:
    week, end = F.substring("days_of_week", 1, 5), F.substring("days_of_week", 6, 2)
    kind = F.when(F.col("days_of_week") == "1111111", "daily").when((F.col("days_of_week") == "0000000") | F.col("days_of_week").isNull(), "none").when((week != "00000") & (end == "00"), "weekdays only").when((week == "00000") & (end != "00"), "weekend only").otherwise("other")
    return gold.where("mode = 'train'").groupBy("departure_country", kind.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def compare_coverage(gold: DataFrame, compare: DataFrame) -> DataFrame:
    trips = gold.where("mode = 'train'").groupBy("departure_country").agg(F.countDistinct("trip_id").alias("trips"))
    won = compare.groupBy("departure_country").agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("best_mode") == "train").alias("train_wins"))
    return trips.join(won, "departure_country", "left").select("departure_country", "trips", F.coalesce("compared", F.lit(0)).alias("compared"), share(F.coalesce("compared", F.lit(0)), F.col("trips")).alias("compared_pct"), share(F.col("train_wins"), F.col("compared")).alias("train_win_pct"))


def quality_summary(gold: DataFrame, compare: DataFrame) -> DataFrame:
    """The 19 figures of both tables in one row, with one scan of each."""
    n, train = F.count(F.lit(1)), F.col("mode") == "train"
    night = F.col("is_night_train")
    routes = gold.agg(
        n.alias("total_routes"), F.count_if(train).alias("total_train"), F.count_if(F.col("mode") == "flight").alias("total_flight"),
        *[F.countDistinct(c).alias(k) for k, c in DISTINCT_FIGURES.items()],
        F.count_if(train & night).alias("night_train_routes"), F.count_if(train & ~night).alias("day_train_routes"), F.count_if(train & night.isNull()).alias("unclassified_routes"),
        *[share(F.count(c), n).alias(k) for k, c in FILLED_FIGURES.items()],
    )
    wins = compare.agg(n.alias("total_comparisons"), *[F.count_if(F.col("best_mode") == m).alias(f"{m}_wins_total") for m in ("train", "flight")])
    return routes.crossJoin(wins)


DISTINCT_FIGURES = {"countries_departure": "departure_country", "countries_arrival": "arrival_country", "unique_dep_cities": "departure_city", "unique_arr_cities": "arrival_city", "unique_agencies": "agency_name"}
FILLED_FIGURES = {
    "distance_completeness_pct": "distance_km", "emissions_completeness_pct": "emissions_co2", "schedule_completeness_pct": "days_of_week",
    "dep_city_completeness_pct": "departure_city", "arr_city_completeness_pct": "arrival_city",
}


def list_cities(gold: DataFrame, country: str | None = None, search: str | None = None, has_station: bool | None = None, has_airport: bool | None = None) -> DataFrame:
    """Figures of each departure city. Stations are places of departure of either mode; nights are trips of night trains."""
    rows = where_all(gold.where("departure_city is not null"), exact={"departure_country": upper(country)}, contains={"departure_city": search})
    night = F.when((F.col("mode") == "train") & F.col("is_night_train"), F.col("trip_id"))
    out = rows.groupBy(F.col("departure_city").alias("city"), F.col("departure_country").alias("country")).agg(
        F.countDistinct("departure_station").alias("stations"), F.count_if(F.col("mode") == "train").alias("trains"), F.count_if(F.col("mode") == "flight").alias("flights"),
        F.countDistinct(night).alias("nights"), F.countDistinct("arrival_city").alias("destinations"),
    )
    out = out.withColumn("has_station", F.col("stations") > 0).withColumn("has_airport", F.col("flights") > 0)
    return where_all(out, exact={"has_station": has_station, "has_airport": has_airport})


def list_stations(gold: DataFrame, mode: str, city: str | None = None, country: str | None = None, search: str | None = None) -> DataFrame:
    """Figures of each station (train) or airport (flight): departures by day and night, what can be reached, operators."""
    night = F.coalesce("is_night_train", F.lit(False))
    rows = where_all(gold.where((F.col("mode") == mode) & F.col("departure_station").isNotNull()), exact={"departure_country": upper(country)}, contains={"departure_city": city, "departure_station": search})
    place = {"station": "departure_station", "city": "departure_city", "country": "departure_country", "parent_station": "departure_parent_station"}
    return rows.groupBy(*[F.col(c).alias(k) for k, c in place.items()]).agg(
        F.count(F.lit(1)).alias("departures"), F.countDistinct("arrival_city").alias("destinations"), F.countDistinct("arrival_station").alias("stops"), F.countDistinct("arrival_country").alias("countries"),
        F.count_if(night).alias("nights"), F.count_if(~night).alias("days"), C.exact_mean("distance_km", 2, 1).alias("mean_km"), F.array_join(F.array_sort(F.collect_set("agency_name")), ", ").alias("operators"),
    )


def route_detail(routes: DataFrame, trip_id: str, source: str | None = None, departure_country: str | None = None) -> DataFrame:
    """All connections of a trip by departure time. On a table in buckets of trip_id one bucket is read."""
    return where_all(routes, exact={"trip_id": trip_id, "source": source, "departure_country": upper(departure_country)}).orderBy("departure_time", "distance_km", "arrival_station")


CARBON = ("source", "trip_id", "mode", "departure_city", "arrival_city", "departure_country", "arrival_country", "distance_km", "co2_per_pkm", "emissions_co2", "is_night_train")


def carbon_trip(routes: DataFrame, trip_id: str, source: str | None = None, departure_country: str | None = None) -> DataFrame:
    """The emissions of each connection of a trip, by departure time."""
    return route_detail(routes, trip_id, source, departure_country).select(*CARBON)


def routes_from(gold: DataFrame, countries: DataFrame) -> DataFrame:
    """Connections that leave from the countries of a table (country_code). With a gold table that lies in folders by
    departure country, Spark reads only the folders that the table turns out to name."""
    codes = countries.select(F.col("country_code").alias("departure_country"))
    return gold.join(codes, "departure_country", "left_semi").select(*gold.columns)


def stats_operators(gold: DataFrame) -> DataFrame:
    rows = gold.where("mode = 'train' and agency_name is not null")
    return rows.groupBy("agency_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("trip_id").alias("trips"), C.exact_sum("distance_km", 2, 2).alias("km"), C.exact_mean("co2_per_pkm", 3, 2).alias("mean_co2_per_pkm"))


def stats_distances(gold: DataFrame, bucket: int) -> DataFrame:
    return gold.groupBy((F.floor(F.col("distance_km") / bucket) * bucket).cast("long").alias("from_km"), "mode", "is_night_train").agg(F.count(F.lit(1)).alias("n"))


def emissions_by_distance(gold: DataFrame) -> DataFrame:
    """Mean emissions by bands of 100 km, one column for each mode."""
    band = (F.floor(F.col("distance_km") / 100) * 100).cast("long").alias("from_km")
    return gold.groupBy(band).agg(*[C.exact_mean(F.when(F.col("mode") == m, F.col("emissions_co2")), 3, 1).alias(m) for m in ("train", "flight")])


def country_balance_two_sided(gold: DataFrame, n: int) -> DataFrame:
    rows = gold.where("mode = 'train'").select(F.explode(F.array_distinct(F.array("departure_country", "arrival_country"))).alias("country"), "is_night_train")
    return rows.groupBy("country").agg(F.count_if("is_night_train").alias("nights"), F.count_if(~F.col("is_night_train")).alias("days")).orderBy(F.desc(F.col("nights") + F.col("days")), "country").limit(n)


def carbon_estimate(compare: DataFrame, origin: str | None = None, destination: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Corridors between two places (or groups of them): figures of both modes, the usual best mode and the saving."""
    rows = where_all(compare, contains={"departure_city": origin, "arrival_city": destination})
    figures = []
    for m in ("train", "flight"):
        co2 = f"{m}_emissions_co2"
        figures += [F.count(co2).alias(f"n_{m}"), C.exact_mean(f"{m}_distance_km", 2, 1).alias(f"{m}_km"), C.exact_mean(f"{m}_duration_min", 1, 1).alias(f"{m}_min"), C.exact_mean(co2, 3, 1).alias(f"{m}_co2"), C.half_up(F.min(co2), 1).alias(f"{m}_co2_least"), C.half_up(F.max(co2), 1).alias(f"{m}_co2_most")]
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("corridors"), *figures, F.mode("best_mode", True).alias("best_mode"))
    saving = F.when(F.col("flight_co2") > 0, F.floor((1 - F.col("train_co2") / F.col("flight_co2")) * 1000.0 + 0.500001) / 10.0)
    return out.withColumn("co2_saving_pct", saving)
