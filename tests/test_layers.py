"""Salted joins, ranks by ranges, exact sums, layers in folders and buckets, and the table that is replaced by source."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from viaduct.functions import columns as C
from viaduct.operators import gold, places, rail, serve, spread
from viaduct.sources import files, layers

KEYS = ["a", "b"]


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("part_rows", [7, 100, 10**6])
def test_salted_join_is_a_left_join(spark, part_rows):
    rnd = random.Random(part_rows)
    rows = [(rnd.choice(["x", "x", "x", "y", None]), rnd.choice([1, 1, 2, None]), k) for k in range(400)] + [("x", 1, 5)] * 3
    left = spark.createDataFrame(rows, "a string, b int, v int")
    right = spark.createDataFrame([("x", 1, "one"), ("y", 2, "two"), ("z", 9, "none")], "a string, b int, w string")
    sizes = left.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    got = spread.salted_left_join(left, right, KEYS, sizes, part_rows)
    assert got.columns == ["a", "b", "v", "w"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, KEYS, "left").select("a", "b", "v", "w").collect()))


def test_hot_keys_are_dealt_over_tasks(spark):
    left = spark.range(5000).select(F.lit("x").alias("a"), F.lit(1).alias("b"), F.col("id").alias("v"))
    right = spark.createDataFrame([("x", 1, "one")], "a string, b int, w string")
    parts = spread.salted_left_join(left, right, KEYS, left.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), 500)
    assert parts.count() == 5000 and "__part" in plan(parts)


def test_ranks_are_those_of_one_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", "x", "y", None]), rnd.randrange(50), k) for k in range(1000)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(7)
    want = {k: n for g in ("x", "y", None) for n, (_, k) in enumerate(sorted((v, k) for h, v, k in rows if h == g), 1)}
    out = spread.ranked(df, ["g"], ["v", "k"], "rank")
    assert {r.k: r["rank"] for r in out.collect()} == want and out.columns == ["g", "v", "k", "rank"]
    ids = sorted((r.id, r.v, r.k) for r in spread.numbered(df, ["v", "k"], "id").collect())
    assert [i for i, _, _ in ids] == list(range(1, 1001)) and [(v, k) for _, v, k in ids] == sorted((v, k) for _, v, k in rows)
    first = spread.first_of_groups(df.withColumn("room", F.lit(4)), ["g"], ["v", "k"], "room")
    assert {r.k for r in first.collect()} == {k for k, n in want.items() if n <= 4}
    assert spread.numbered(df.limit(0), ["v", "k"], "id").count() == 0


def test_no_task_gets_a_whole_group_to_rank(spark):
    out = spread.ranked(spark.range(1000).withColumn("g", F.lit(1)), ["g"], ["id"], "rank")
    assert out.agg(F.max("rank")).first()[0] == 1000
    assert not re.search(r"SinglePartition|Window \[row_number", plan(out))


def test_sums_do_not_depend_on_tasks(spark):
    rnd = random.Random(8)
    rows = [(float(f"{rnd.randrange(10**7)}.{rnd.randrange(100):02d}"),) for _ in range(4000)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    hundredths = sum(round(v * 100) for (v,) in rows if v is not None)
    for tasks in (1, 4, 8, 31):
        got = df.repartition(tasks).agg(C.exact_sum("x", 2, 1).alias("s"), C.exact_mean("x", 2, 1).alias("m")).first()
        assert got.s == (hundredths + 5) // 10 / 10
        assert abs(got.m - hundredths / 100 / 4000) <= 0.0500001
    assert len({df.repartition(t).agg(C.exact_mean("x", 2, 1)).first()[0] for t in (1, 4, 8, 31)}) == 1


def gold_rows(spark, n=200):
    names = {"distance_km": "double", "co2_per_pkm": "double", "emissions_co2": "double", "is_night_train": "boolean"}
    rnd, rows = random.Random(2), []
    for k in range(n):
        r = dict.fromkeys(gold.GOLD_COLUMNS) | {
            "source": f"s{k % 3}", "trip_id": f"t{k % 40}", "mode": "train", "departure_station": f"a{k % 9}", "arrival_station": f"b{k % 7}", "departure_country": ["FR", "DE", "US", None][k % 4],
            "departure_city": rnd.choice(["A", "B", None]), "arrival_city": rnd.choice(["C", "D"]), "arrival_country": "IT", "departure_time": f"{k % 24:02d}:00:00", "arrival_time": "23:30:00",
            "days_of_week": rnd.choice(["1111111", "1000001", None]), "distance_km": float(k), "co2_per_pkm": 10.0, "emissions_co2": 10.0 * k, "is_night_train": k % 5 == 0,
        }
        rows.append(tuple(r[c] for c in gold.GOLD_COLUMNS))
    return spark.createDataFrame(rows, ", ".join(f"{c} {names.get(c, 'string')}" for c in gold.GOLD_COLUMNS))


def test_layer_in_folders_is_pruned_by_filters_and_by_other_tables(spark):
    df = gold_rows(spark)
    layer = layers.by_folders(df, "test-layer", "departure_country")
    assert layer.columns == df.columns and Counter(layer.collect()) == Counter(df.collect())
    for found in (serve.list_routes(layer, departure_country="fr"), serve.day_night_routes(layer, departure_country="FR"), serve.list_stations(layer, "train", country="fr")):
        assert re.search(r"PartitionFilters: \[.*departure_country", plan(found)) and found.count() > 0
    assert serve.list_routes(layer, departure_country="fr").count() == df.where("departure_country = 'FR'").count()
    countries = layers.by_folders(spark.createDataFrame([("FR", 50.0), ("DE", 400.0)], "country_code string, intensity double"), "test-countries", "country_code")
    found = serve.routes_from(layer, countries.where("intensity < 100"))
    assert "dynamicpruning" in plan(found) and Counter(found.collect()) == Counter(df.where("departure_country = 'FR'").collect())
    assert layers.by_folders(df.limit(0), "test-layer", "departure_country").count() == 0


def test_look_ups_of_a_trip_read_one_bucket(spark):
    df = gold_rows(spark)
    table = layers.by_buckets(df, "test_by_trip", "trip_id", ["departure_time"], df.count())
    got = serve.route_detail(table, "t5", "s1", "de")
    want = df.where("trip_id = 't5' and source = 's1' and departure_country = 'DE'")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else buckets are pruned without being named in the plan
    text = plan(serve.route_detail(table, "t5", "s1", "de"))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in text and "EqualTo(trip_id,t5)" in text
    rows = got.collect()
    assert Counter(rows) == Counter(want.collect()) and rows == sorted(rows, key=lambda r: (r.departure_time, r.distance_km)) and rows
    assert serve.carbon_trip(table, "t5").columns == list(serve.CARBON) and serve.carbon_trip(table, "t5").count() == df.where("trip_id = 't5'").count()
    assert serve.carbon_trip(table, "none").count() == 0


SOURCED = "x int, source string"


def content(table):
    return sorted((r.source or "-", r.x) for r in table.rows().collect())


def test_upsert_replaces_the_sources_of_a_batch(spark, tmp_path):
    table, frame = layers.SourceTable(spark, f"{tmp_path}/t", SOURCED), lambda rows: spark.createDataFrame(rows, SOURCED)
    assert content(table) == []
    table.upsert(frame([(1, "a"), (2, "b"), (3, "b"), (4, None)]), "one")
    assert content(table) == [("-", 4), ("a", 1), ("b", 2), ("b", 3)]
    assert table.upsert(frame([]), "empty") == 0 and table.upsert(frame([(9, None)]), "nulls") == 0
    assert content(table) == [("-", 4), ("a", 1), ("b", 2), ("b", 3)]
    for _ in range(2):  # a batch that is run again changes nothing more
        assert table.upsert(frame([(5, "b"), (6, "c"), (7, None)]), "two") == 3
        assert content(table) == [("-", 4), ("-", 7), ("a", 1), ("b", 5), ("c", 6)]
    assert content(layers.SourceTable(spark, f"{tmp_path}/t", SOURCED)) == content(table)


def test_upsert_is_repeated_after_a_crash(spark, tmp_path, monkeypatch):
    table, frame = layers.SourceTable(spark, f"{tmp_path}/t", SOURCED), lambda rows: spark.createDataFrame(rows, SOURCED)
    table.upsert(frame([(1, "a"), (2, "b")]), "one")
    before = content(table)
    batch = frame([(5, "b"), (6, "c"), (7, None)])
    broken = batch.withColumn("x", F.when(F.col("source") == "c", F.raise_error("lost").cast("int")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):  # after files of b are written, before they are moved
        table.upsert(broken, "two")
    assert [r for r in content(table) if r[0] != "-"] == before  # no source is replaced in part
    stale = tmp_path / "t" / "rows" / ".spark-staging-dead" / "source=b"
    stale.mkdir(parents=True)
    (stale / "part-0.parquet").write_bytes(b"half a file")
    table.upsert(batch, "two")
    assert content(table) == [("-", 7), ("a", 1), ("b", 5), ("c", 6)]


def test_headers_end_where_their_record_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_text('"stop_id","stop, name","note\non two lines"\n1,"x, y","a\nb"\n')
    (tmp_path / "b.txt").write_text("\nstop_id\n2\n")
    (tmp_path / "c.txt").write_text("")
    assert set(files.layouts(spark, f"{tmp_path}/*.txt")) == {("stop_id", "stop, name", "note\non two lines"), ("stop_id",)}
    rows = files.read_feed_csv(spark, f"{tmp_path}/*.txt", ["stop_id", "stop, name"]).collect()
    assert sorted((r[0], r[1]) for r in rows) == [("1", "x, y"), ("2", None)]


def test_every_country_has_a_name(spark):
    from viaduct.constants import AIR_COUNTRIES

    names = {r.country_code: r.country_name for r in places.country_names(spark).collect()}
    assert len(names) > 240 and all(names.get(c) for c in AIR_COUNTRIES) and names["CY"] == "Cyprus"
    cities = spark.createDataFrame([("B", "CY"), ("A", "CY"), ("Z", "AL"), ("A", "CY"), ("A", "XYZ"), (None, "FR")], "city_name string, city_country string")
    assert [tuple(r) for r in places.city_dimension(cities).orderBy("city_id").collect()] == [(1, "Z", "AL", "Albania"), (2, "A", "CY", "Cyprus"), (3, "B", "CY", "Cyprus")]


def test_station_airport_match_is_brute_force(spark):
    rnd = random.Random(12)
    stations = [(rnd.choice("pq"), f"s{k}", rnd.uniform(44, 47), rnd.uniform(4, 8)) for k in range(60)] + [("p", "twin", 45.0, 5.0), ("q", "twin", 45.0, 5.0)]
    airports = [(f"A{k}", rnd.uniform(44, 47), rnd.uniform(4, 8)) for k in range(15)] + [("B1", 45.1, 5.0), ("B2", 44.9, 5.0)]
    a = spark.createDataFrame(stations, "source string, stop_id string, lat double, lon double")
    b = spark.createDataFrame(airports, "ident string, latitude_deg double, longitude_deg double")
    km = F.round(C.haversine_m(F.col("lat"), F.col("lon"), F.col("latitude_deg"), F.col("longitude_deg")) / 1000, 2)
    pairs = [tuple(r) for r in a.crossJoin(b).select("source", "stop_id", "ident", km.alias("km")).where("km < 100").collect()]
    want = {min((p for p in pairs if p[:2] == s), key=lambda p: (p[3], p[2])) for s in {p[:2] for p in pairs}} | {min((p for p in pairs if p[2] == i), key=lambda p: (p[3], *p[:2])) for i in {p[2] for p in pairs}}
    got = places.station_airport_match(a, b)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert "row_number" not in plan(got)


def test_cities_are_attached_before_pairs_are_made(spark):
    cols = "source string, trip_id string, stop_sequence int, stop_id string, stop_name string, parent_station string, stop_lat double, stop_lon double, arrival_time string, departure_time string, country string, city_name string, city_country string, is_night_train boolean, route_type int"
    text = [c for c in gold.ATTRIBUTES if c not in ("route_type", "is_night_train")]
    rows = [("s", "t", k, f"x{k}", f"X{k}", None, 45.0 + k, 5.0, f"{k:02d}:00:00", f"{k:02d}:00:00", "FR", ["A", None, "C"][k], ["FR", None, "IT"][k], False, 100) for k in range(3)]
    events = rail.clean_events(spark.createDataFrame(rows, cols).withColumns({c: F.lit(None).cast("string") for c in text}))
    factors = spark.createDataFrame([("FR", 100, 10.0), ("IT", 100, 20.0)], "country_code string, route_type int, g_per_pkm double")
    out = gold.gold_train(events, factors)
    got = {(r.departure_station, r.arrival_station): (r.departure_city, r.arrival_city, r.co2_per_pkm) for r in out.collect()}
    assert got == {("X0", "X1"): ("A", None, 10.0), ("X0", "X2"): ("A", "C", 10.0), ("X1", "X2"): (None, "C", 10.0)}
    mapped = {(r.departure_country, r.arrival_country) for r in gold.gold_train(events, factors, prefer_mapped=True).collect()}
    assert mapped == {("FR", "FR"), ("FR", "IT")}
    text = out._jdf.queryExecution().executedPlan().toString()
    made = text.index("Generate explode")  # the plan is written from its end to its start
    assert "Join" not in text[:made]


def test_candidates_and_comparison_at_the_connection(spark):
    train = gold_rows(spark).where("departure_country = 'FR'")
    access = spark.createDataFrame([("A", "FR", "P", 40.0), ("C", "IT", "Q", 10.0)], "city_name string, country string, ident string, access_km double")
    flown = spark.createDataFrame([("P", "Q", "Pp", "Qq", "A", "FR", "C", "IT", 700.0, 1.0), ("Q", "P", "Qq", "Pp", "C", "IT", "A", "FR", 700.0, 1.0)], "origin_id string, dest_id string, origin_name string, dest_name string, origin_city string, origin_country string, dest_city string, dest_country string, distance_km double, co2_per_pkm double")
    cities = train.where("departure_city is not null and arrival_city is not null")
    for part_rows in (3, 10**6):
        best = gold.compare_best(train, access, flown, part_rows=part_rows).collect()
        served = [r for r in best if r.train_emissions_co2 is not None]
        assert Counter((r.source, r.trip_id, r.departure_station, r.train_distance_km) for r in served) == Counter((r.source, r.trip_id, r.departure_station, r.distance_km) for r in cities.collect())
        flights = [r for r in served if r.flight_candidate_id]
        assert flights and all((r.departure_city, r.arrival_city) == ("A", "C") for r in flights)
        assert {(r.flight_candidate_id, r.flight_correspondence_count, r.flight_distance_km, r.flight_duration_min, r.flight_emissions_co2) for r in flights} == {("P__Q", 2, 750.0, 210.0, 700.0)}
        assert {r.best_mode for r in flights} == {"train", "flight"}
        (lone,) = [r for r in best if r.train_emissions_co2 is None]
        assert (lone.source, lone.trip_id, lone.departure_station, lone.flight_correspondence_count, lone.best_mode) == ("ourairports", "Q__P", "Qq", 0, "flight")
    every = gold.compare_best(train, access, flown, cities_only=False).where("train_emissions_co2 is not null")
    assert every.count() == train.count()
    ways = gold.compare_candidates(train, access, flown).collect()
    assert Counter(r.candidate_mode for r in ways) == {"train": cities.count(), "flight": len(flights)}
    listed = serve.list_compare(gold.compare_best(train, access, flown), days_of_week="1_____1", departure_country="fr")
    assert {r.days_of_week for r in listed.collect()} == {"1111111", "1000001"}
    assert {r.days_of_week for r in serve.list_compare(gold.compare_best(train, access, flown), days_of_week="10%").collect()} == {"1000001"}


def test_cities_and_stations_by_filters(spark):
    df = gold_rows(spark)
    cities = serve.list_cities(df, country="fr", search="a", has_station=True, has_airport=False).collect()
    assert {(r.city, r.country) for r in cities} == {("A", "FR")} and cities[0].nights == df.where("departure_city = 'A' and departure_country = 'FR' and is_night_train").select("trip_id").distinct().count()
    assert serve.list_cities(df, has_airport=True).count() == 0
    for r in serve.list_stations(df, "train", country="de", search="A1").collect():
        assert r.departures == r.nights + r.days and r.station == "a1"
