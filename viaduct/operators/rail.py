"""From feed tables to clean stop events, distances and origin-destination pairs.

One exchange by (source, trip_id) serves the windows and the pair expansion: everything from `renumbered` to `od_pairs`
is keyed by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DETOUR, EXPIRED_BEFORE, RAIL_TYPES
from ..functions import columns as C
from . import spread

TRIP = ["source", "trip_id"]


def rail_filter(routes: DataFrame, types: tuple[int, ...] = RAIL_TYPES) -> DataFrame:
    return routes.withColumn("route_type", F.col("route_type").try_cast("int")).where(F.col("route_type").isin(*types))


def trip_rows(trips: DataFrame, routes: DataFrame, agency: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each rail trip, with what its route, operator and service say. Routes are cut to rail first."""
    days = F.col("days_of_week") if "days_of_week" in calendar.columns else C.days_mask().alias("days_of_week")
    out = trips.join(rail_filter(routes), ["source", "route_id"]).join(agency, ["source", "agency_id"], "left")
    out = out.join(calendar.select("source", "service_id", days, "start_date", "end_date"), ["source", "service_id"], "left")
    return out.withColumn("country", F.substring("source", 1, 2))


def events_of(rows: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """One row for each stop of each trip of trip_rows(); of equal stops one stays."""
    out = rows.join(stop_times.where("stop_sequence is not null"), TRIP).join(stops, ["source", "stop_id"], "left")
    order = Window.partitionBy(*TRIP, "stop_sequence", "stop_id").orderBy("arrival_time", "departure_time")
    return out.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def stop_events(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, stops: DataFrame, agency: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each stop of each rail trip."""
    return events_of(trip_rows(trips, routes, agency, calendar), stop_times, stops)


def with_city(stops: DataFrame, stop_city: DataFrame, keys: tuple[str, ...] = ("source", "stop_id")) -> DataFrame:
    """Stops with city_name and city_country of their nearest city. Cities join the few stops, not what is made of them."""
    return stops.join(stop_city.select(*keys, "city_name", "city_country"), list(keys), "left")


def night_stop_events(trips: DataFrame, routes: DataFrame, stop_times: DataFrame, stops: DataFrame, agencies: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each stop of each night train, in the columns of stop_events() and with is_night_train. The tables have no
    source of their own. Stops may have the columns of with_city()."""
    named = resolve_composite_ids(trips, agencies).join(routes.select("route_id", "route_short_name", "route_long_name"), "route_id", "left")
    days = calendar.select("service_id", C.days_mask().alias("days"), *[C.norm_date8(F.col(c), strict=False).alias(c) for c in ("start_date", "end_date")])
    out = named.join(stop_times.where(F.col("stop_sequence").try_cast("int").isNotNull()), "trip_id").join(stops.where("stop_lat is not null and stop_lon is not null"), "stop_id").join(days, "service_id", "left")
    country = C.country_alias(F.col("stop_country"))
    return out.select(
        "source", "trip_id", "route_id", "service_id", "trip_short_name", "trip_headsign", F.lit(105).alias("route_type"), "route_short_name", "route_long_name", "agency_id", "agency_name",
        C.fix_timezone(F.lit(None).cast("string"), country).alias("agency_timezone"), "stop_id", "stop_name", F.col("stop_lat").cast("double").alias("stop_lat"), F.col("stop_lon").cast("double").alias("stop_lon"),
        F.lit(None).cast("string").alias("parent_station"), F.col("stop_sequence").try_cast("int").alias("stop_sequence"), C.time_part(F.col("arrival_time")).alias("arrival_time"),
        C.time_part(F.col("departure_time")).alias("departure_time"), F.coalesce("days", F.lit("0000000")).alias("days_of_week"), "start_date", "end_date", country.alias("country"), F.lit(True).alias("is_night_train"),
        *[c for c in ("city_name", "city_country") if c in stops.columns],
    )


def drop_bad_coord_trips(events: DataFrame) -> DataFrame:
    """A window over the trip, not an anti-join: it reuses the exchange of the steps around it."""
    bad = F.max(C.invalid_coord(F.col("stop_lat"), F.col("stop_lon"))).over(Window.partitionBy(*TRIP))
    return events.withColumn("bad", bad).where("not bad").drop("bad")


def renumbered(events: DataFrame) -> DataFrame:
    """Trips with two stops at one sequence are renumbered from 0 by time, old sequence and stop."""
    seconds = F.coalesce(C.hms_to_seconds(F.col("arrival_time")), F.lit(-1))
    trip = Window.partitionBy(*TRIP)
    again = F.max("n_here").over(trip) > 1
    rank = F.row_number().over(trip.orderBy("seconds", "stop_sequence", "stop_id")) - 1
    out = events.withColumn("seconds", seconds).withColumn("n_here", F.count(F.lit(1)).over(Window.partitionBy(*TRIP, "stop_sequence")))
    return out.withColumn("again", again).withColumn("rank", rank).withColumn("stop_sequence", F.when(F.col("again"), F.col("rank")).otherwise(F.col("stop_sequence")).cast("int")).drop("seconds", "n_here", "again", "rank")


def filled_sequences(events: DataFrame, sentinel: int = 99) -> DataFrame:
    """Trips with a missing sequence are numbered from 0 by the old sequence, missing ones last, and time; in others the
    sentinel becomes one more than the largest real sequence."""
    trip = Window.partitionBy(*TRIP)
    missing = F.max(F.col("stop_sequence").isNull()).over(trip)
    order = trip.orderBy(F.coalesce("stop_sequence", F.lit(9999)), F.coalesce("departure_time", "arrival_time"), "stop_id")
    out = events.withColumn("missing", missing).withColumn("rank", F.row_number().over(order) - 1)
    out = out.withColumn("real", F.max(F.when(F.col("stop_sequence") != sentinel, F.col("stop_sequence"))).over(trip))
    filled = F.when(F.col("missing"), F.col("rank")).when(F.col("stop_sequence") == sentinel, F.col("real") + 1).otherwise(F.col("stop_sequence"))
    return out.withColumn("stop_sequence", filled.cast("int")).drop("missing", "rank", "real")


def segment_distance(events: DataFrame) -> DataFrame:
    """Whole metres to the next stop, with the detour factor; null at the last stop."""
    after = Window.partitionBy(*TRIP).orderBy("stop_sequence")
    metres = C.haversine_m(F.col("stop_lat"), F.col("stop_lon"), F.lead("stop_lat").over(after), F.lead("stop_lon").over(after))
    return events.withColumn("segment_dist_m", F.round(metres * DETOUR))


def drop_zero_segment_trips(events: DataFrame) -> DataFrame:
    bad = F.max(F.when((F.col("segment_dist_m") <= 0) | F.isnan("segment_dist_m"), 1).otherwise(0)).over(Window.partitionBy(*TRIP))
    return events.withColumn("bad", bad).where("bad = 0").drop("bad")


def drop_single_stop_trips(events: DataFrame) -> DataFrame:
    return events.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*TRIP))).where("n > 1").drop("n")


def cumulative_distance(events: DataFrame) -> DataFrame:
    """Metres since the first stop."""
    before = Window.partitionBy(*TRIP).orderBy("stop_sequence").rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("cumul_m", F.coalesce(F.sum("segment_dist_m").over(before), F.lit(0.0)))


def clean_events(events: DataFrame) -> DataFrame:
    return cumulative_distance(drop_single_stop_trips(drop_zero_segment_trips(segment_distance(renumbered(drop_bad_coord_trips(events))))))


STOP = ("stop_sequence", "stop_id", "stop_name", "parent_station", "departure_time", "arrival_time", "cumul_m", "country", "city_name", "co2_per_pkm")


def od_pairs(events: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Every two stops of a trip, the first before the second, with attributes of the trip (smallest values).

    A trip's stops are few, so they are gathered in one row, on the partitioning that the windows before it have, and
    expanded there: no self-join and no further exchange.
    """
    return pairs_of(trip_stops(events, attributes), attributes)


def trip_stops(events: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """A row for each trip, with its stops in their order."""
    stops = F.sort_array(F.collect_list(F.struct(*[c for c in STOP if c in events.columns]))).alias("stops")
    return events.groupBy(*TRIP).agg(stops, *[F.min(c).alias(c) for c in attributes])


def pairs_of(trips: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """od_pairs() of trip_stops()."""
    known = trips.schema["stops"].dataType.elementType.names
    pairs = trips.select(*TRIP, *attributes, "stops", F.posexplode("stops").alias("at", "dep"))
    pairs = pairs.select(*TRIP, *attributes, "dep", F.explode(F.slice("stops", F.col("at") + 2, F.size("stops"))).alias("arr"))
    pairs = pairs.select(*TRIP, *attributes, *[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("dep", "arr") for c in known])
    return pairs.withColumn("distance_km", C.half_up((F.col("arr_cumul_m") - F.col("dep_cumul_m")) / 1000.0, 2))


def enrich_route_type(events: DataFrame) -> DataFrame:
    """The generic type 2 becomes the lowest specific type that the same route has anywhere.

    The types seen are grouped first, with partial sums, and joined back: a route of very many rows is never gathered.
    """
    own = events.where("route_type != 2").groupBy("source", "route_id").agg(F.min("route_type").alias("own_type"))
    out = events.join(own, ["source", "route_id"], "left")
    kind = F.when(F.col("route_type") == 2, F.coalesce("own_type", "route_type")).otherwise(F.col("route_type"))
    return out.select(*[kind.alias(c) if c == "route_type" else c for c in events.columns])


def propagate_first_nonnull(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """Nulls are filled with the value of the first row of the group, by `order`, that has one."""
    known = df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"known_{c}") for c in columns])
    out = df.join(known, keys, "left")
    return out.select(*[F.coalesce(c, f"known_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def reconstruct_calendar(calendar: DataFrame, dates: DataFrame) -> DataFrame:
    """Services without a calendar get one from their added dates: first and last day, and the weekdays seen."""
    day = F.to_date(C.norm_date8(F.col("date")), "yyyyMMdd")
    seen = dates.where("exception_type = 1").withColumn("day", day).where("day is not null")
    bits = F.concat(*[F.max(F.when(F.weekday("day") == k, "1").otherwise("0")) for k in range(7)])
    made = seen.groupBy("source", "service_id").agg(F.date_format(F.min("day"), "yyyyMMdd").alias("made_start"), F.date_format(F.max("day"), "yyyyMMdd").alias("made_end"), bits.alias("made_mask"))
    own = calendar.select("source", "service_id", C.days_mask().alias("days_of_week"), "start_date", "end_date")
    out = own.join(made, ["source", "service_id"], "full")
    return out.select("source", "service_id", F.coalesce("days_of_week", "made_mask").alias("days_of_week"), F.coalesce("start_date", "made_start").alias("start_date"), F.coalesce("end_date", "made_end").alias("end_date"))


def expiry_filter_with_rescue(rows: DataFrame, least_trips: int, before: int = EXPIRED_BEFORE, counted: DataFrame | None = None) -> DataFrame:
    """Expired services go, but only in countries that keep `least_trips` trips after that.

    rows: trips or stop events; counted: other rows to count the trips on, such as those of trips that have stops.
    """
    fresh = F.coalesce(F.col("end_date").try_cast("int") >= before, F.lit(True))
    left = (rows if counted is None else counted).where(fresh).groupBy("country").agg(F.countDistinct("source", "trip_id").alias("n_left"))
    rich = left.where(F.col("n_left") >= least_trips).select("country", F.lit(True).alias("rich"))
    return rows.join(rich, "country", "left").where(fresh | F.col("rich").isNull()).drop("rich")


def rescue_top_recent(events: DataFrame, most: int, before: int = EXPIRED_BEFORE) -> DataFrame:
    """Fresh rows stay; of expired ones the `most` newest of each country.

    Counts by end date give the date at which the country's quota runs out, and only rows of that date are ranked, by ranges
    and prefix sums, so that no country and no date is in one task.
    """
    keyed = events.withColumn("end", F.col("end_date").try_cast("int")).withColumn("fresh", F.coalesce(F.col("end") >= before, F.lit(True)))
    stale = keyed.where("not fresh")
    newer = F.sum("n").over(Window.partitionBy("country").orderBy(F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1))
    room = stale.groupBy("country", "end").agg(F.count(F.lit(1)).alias("n")).withColumn("room", most - F.coalesce(newer, F.lit(0))).where("room > 0")
    stale = stale.join(room, ["country", "end"])
    whole, edge = stale.where("n <= room"), stale.where("n > room")
    edge = spread.first_of_groups(edge, ["country", "end"], ["source", "trip_id", "stop_sequence", "stop_id"], "room")
    return keyed.where("fresh").select(*events.columns).unionByName(whole.select(*events.columns)).unionByName(edge.select(*events.columns))


def first_last_stop(events: DataFrame) -> DataFrame:
    ends = F.struct("stop_id", "stop_name", "stop_lat", "stop_lon")
    out = events.groupBy(*TRIP).agg(F.min_by(ends, "stop_sequence").alias("first"), F.max_by(ends, "stop_sequence").alias("last"), F.count(F.lit(1)).alias("n_stops"))
    return out.select(*TRIP, "n_stops", *[F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("first", "last") for c in ("stop_id", "stop_name", "stop_lat", "stop_lon")])


def resolve_composite_ids(trips: DataFrame, agencies: DataFrame) -> DataFrame:
    """`a/b` becomes `Name a / Name b`; unknown parts stay. agencies: agency_id, agency_name."""
    parts = trips.select("trip_id", F.posexplode(F.split("agency_id", "/")).alias("at", "part"))
    named = parts.join(agencies.select(F.col("agency_id").alias("part"), "agency_name"), "part", "left")
    each = named.groupBy("trip_id").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("agency_name", "part").alias("name")))).alias("names"))
    return trips.join(each.select("trip_id", F.array_join(F.col("names.name"), " / ").alias("agency_name")), "trip_id", "left")


# ---- matching of two timetables


def match_l1(a: DataFrame, b: DataFrame) -> DataFrame:
    """Trips of b whose short name is one of a's."""
    names = a.select(F.lower(F.trim("trip_short_name")).alias("name")).where("name is not null").distinct()
    return b.join(names, F.lower(F.trim(b["trip_short_name"])) == names["name"], "left_semi")


def match_l2(a: DataFrame, b: DataFrame) -> DataFrame:
    """Trips of b that share a train number and the operator's first word with one of a. Names without number don't match."""
    token = lambda df: df.withColumn("number", C.train_number(F.col("trip_short_name"))).withColumn("operator", F.lower(F.substring_index("agency_name", " ", 1))).where("number <> ''")
    keys = token(a).select("number", "operator").distinct()
    return token(b).join(keys, ["number", "operator"], "left_semi").select(*b.columns)


def merge_prefer(a: DataFrame, b: DataFrame) -> DataFrame:
    """All of a, and the trips of b that no trip of a matches."""
    return b.join(matched_trips(a, b), TRIP, "left_anti").unionByName(a, allowMissingColumns=True)


def matched_trips(night: DataFrame, trips: DataFrame) -> DataFrame:
    """source, trip_id of the timetable's trips that a night train matches by name or by number and operator."""
    return match_l1(night, trips).select(*TRIP).unionByName(match_l2(night, trips).select(*TRIP)).distinct()


def upsert_by_source(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.join(new.select("source").distinct(), "source", "left_anti").unionByName(new)
