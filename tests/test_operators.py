"""Rules of the operators on small hand-made inputs, and their properties."""

import random

from pyspark.sql import functions as F

from viaduct.operators import audit, gold, places, rail, serve
from viaduct.sources import files

EVENT = "source string, trip_id string, stop_sequence int, stop_id string, stop_name string, parent_station string, stop_lat double, stop_lon double, arrival_time string, departure_time string"


def events(spark, rows):
    return spark.createDataFrame([("s", t, q, i, i, None, la, lo, a, a) for t, q, i, la, lo, a in rows], EVENT)


def test_pairs_are_all_ordered_pairs_and_sums_of_segments(spark):
    rows = [("t", k, f"st{k}", 45 + k / 10, 5.0, f"{k:02d}:00:00") for k in range(12)]
    clean = rail.clean_events(events(spark, rows))
    pairs = rail.od_pairs(clean)
    assert pairs.count() == 12 * 11 // 2
    total = clean.agg(F.sum("segment_dist_m")).first()[0]
    longest = pairs.agg(F.max("distance_km")).first()[0]
    assert abs(total / 1000 - longest) < 0.01


def test_double_sequence_is_renumbered_by_time(spark):
    rows = [("t", 1, "a", 45.0, 5.0, "08:00:00"), ("t", 1, "b", 46.0, 5.0, "07:00:00"), ("t", 2, "c", 47.0, 5.0, "09:00:00"), ("u", 99, "a", 45.0, 5.0, "08:00:00"), ("u", 7, "b", 46.0, 5.0, "07:00:00")]
    got = {(r.trip_id, r.stop_id): r.stop_sequence for r in rail.renumbered(events(spark, rows)).collect()}
    assert got == {("t", "b"): 0, ("t", "a"): 1, ("t", "c"): 2, ("u", "a"): 99, ("u", "b"): 7}


def test_trips_with_a_bad_stop_zero_segment_or_one_stop_go(spark):
    rows = [("bad", 1, "a", 0.0, 0.0, "08:00:00"), ("bad", 2, "b", 46.0, 5.0, "09:00:00"), ("zero", 1, "a", 45.0, 5.0, "08:00:00"), ("zero", 2, "b", 45.0, 5.0, "09:00:00"), ("one", 1, "a", 45.0, 5.0, "08:00:00"), ("ok", 1, "a", 45.0, 5.0, "08:00:00"), ("ok", 2, "b", 46.0, 5.0, "09:00:00")]
    assert {r.trip_id for r in rail.clean_events(events(spark, rows)).collect()} == {"ok"}


def test_radius_join_is_exact_at_high_latitude(spark):
    rnd = random.Random(1)
    a = [(i, rnd.uniform(60, 72), rnd.uniform(10, 30)) for i in range(150)]
    b = [(i, rnd.uniform(60, 72), rnd.uniform(10, 30)) for i in range(150)]
    left = spark.createDataFrame(a, "i int, lat double, lon double")
    right = spark.createDataFrame(b, "j int, lat2 double, lon2 double")
    got = {(r.i, r.j) for r in places.within(left, right, 100_000.0, 1.0).collect()}
    from viaduct.functions.columns import haversine_m

    every = left.crossJoin(right).where(haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) < 100_000)
    assert got == {(r.i, r.j) for r in every.collect()} and got


def test_nearest_city_ties_and_colliding_stop_ids(spark):
    points = spark.createDataFrame([("A", "s", 45.0, 5.0), ("B", "s", 50.0, 5.0)], "source string, stop_id string, lat double, lon double")
    cities = spark.createDataFrame([(1, "low", "FR", 45.05, 5.0, 10), (2, "big", "FR", 44.95, 5.0, 99), (3, "far", "BE", 50.1, 5.0, 1)], "geonameid long, asciiname string, country_code string, latitude double, longitude double, population long")
    got = {r.source: r.city_name for r in places.nearest_city(points, cities, ["source", "stop_id"]).collect()}
    assert got == {"A": "big", "B": "far"}


def test_matching_needs_a_number_and_ignores_case(spark):
    cols = "source string, trip_id string, trip_short_name string, agency_name string"
    night = spark.createDataFrame([("N", "n1", "NJ 401", "Alpha rail"), ("N", "n2", "Comet", "Beta rail")], cols)
    day = spark.createDataFrame([("D", "1", "nj 401", "Other"), ("D", "2", "EN 401", "ALPHA x"), ("D", "3", "star", "Beta rail"), ("D", "4", "EN 999", "Alpha rail")], cols)
    assert {r.trip_id for r in rail.match_l1(night, day).collect()} == {"1"}
    assert {r.trip_id for r in rail.match_l2(night, day).collect()} == {"2"}
    assert {r.trip_id for r in rail.merge_prefer(night, day).collect()} == {"n1", "n2", "3", "4"}


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "source string, x int")
    new = spark.createDataFrame([("b", 2), ("c", 2), (None, 2)], "source string, x int")
    out = rail.upsert_by_source(old, new)
    assert sorted(map(tuple, out.fillna("-").collect())) == [("-", 1), ("-", 2), ("a", 1), ("b", 2), ("c", 2)]
    assert sorted(rail.upsert_by_source(old, new.limit(0)).fillna("-").collect()) == sorted(old.fillna("-").collect())


def test_rescue_keeps_the_newest_with_total_order(spark):
    rows = [("s", f"t{k}", 1, "a", "FR", str(20230101 + k % 5)) for k in range(50)] + [("s", "new", 1, "a", "FR", "20250101")]
    df = spark.createDataFrame(rows, "source string, trip_id string, stop_sequence int, stop_id string, country string, end_date string")
    got = [r.end_date for r in rail.rescue_top_recent(df, 13).collect()]
    assert len(got) == 14 and sorted(got)[:3] == ["20230104"] * 3


def test_intensity_of_micro_states_and_andorra(spark):
    df = spark.createDataFrame([("FRA", 2020, 50.0), ("FRA", 2019, 70.0), ("ESP", 2020, 150.0), ("EU27", 2020, 1.0), ("ITA", 2020, 300.0)], "entity_code string, date int, emissions_intensity_gco2_per_kwh double")
    got = {r.country_code: r.intensity for r in places.intensity_by_country(df).collect()}
    assert got == {"FR": 50.0, "MC": 50.0, "ES": 150.0, "IT": 300.0, "VA": 300.0, "AD": 100.0}


def test_literal_filters(spark):
    df = spark.createDataFrame([("50%_off",), ("50 off",), ("ÉTÉ",)], "s string")
    assert [r.s for r in serve.where_all(df, contains={"s": "%_"}).collect()] == ["50%_off"]
    assert [r.s for r in serve.where_all(df, contains={"s": "été"}).collect()] == ["ÉTÉ"]


def test_similar_names_as_brute_force(spark):
    rnd = random.Random(2)
    names = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(2, 12))) for _ in range(150)})
    got = {(r.name, r.other) for r in audit.similar_names(spark.createDataFrame([(n,) for n in names], "n string"), "n").collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {(a, b) for a in names for b in names if a < b and abs(len(a) - len(b)) <= 3 and 1 - distance(a, b) / max(len(a), len(b)) > 0.8}
    assert got == want


def test_compare_ties_go_to_the_train(spark):
    cols = ", ".join(f"{c} {'double' if c in ('distance_km', 'co2_per_pkm', 'emissions_co2') else 'boolean' if c == 'is_night_train' else 'string'}" for c in gold.GOLD_COLUMNS)
    row = dict.fromkeys(gold.GOLD_COLUMNS) | {"source": "s", "trip_id": "t", "mode": "train", "departure_station": "a", "arrival_station": "b", "departure_city": "A", "departure_country": "FR", "arrival_city": "B", "arrival_country": "FR", "departure_time": "08:00:00", "arrival_time": "10:00:00", "distance_km": 100.0, "emissions_co2": 1000.0}
    train = spark.createDataFrame([tuple(row[c] for c in gold.GOLD_COLUMNS)], cols)
    access = spark.createDataFrame([("A", "FR", "P", 40.0), ("B", "FR", "Q", 0.0)], "city_name string, country string, ident string, access_km double")
    flown = spark.createDataFrame([("P", "Q", "A", "FR", "B", "FR", 100.0, 10.0), ("Q", "P", "B", "FR", "A", "FR", 100.0, 10.0)], "origin_id string, dest_id string, origin_city string, origin_country string, dest_city string, dest_country string, distance_km double, co2_per_pkm double")
    got = {(r.departure_city, r.best_mode, r.flight_duration_min) for r in gold.compare_best(train, access, flown).collect()}
    assert got == {("A", "train", 143.6), ("B", "flight", None)}  # no way to the airports is known where no train runs


def test_feed_csv(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name\n1,"two\nlines"\n2,"a ""b"""\n3,NULL\n')
    rows = files.read_feed_csv(spark, str(tmp_path / "stops.txt"), ["stop_id", "stop_name"]).collect()
    assert [(r.stop_id, r.stop_name) for r in rows] == [("1", "two\nlines"), ("2", 'a "b"'), ("3", None)]


def test_load_feed_table_and_partitioned_write(spark, tmp_path):
    for feed, cols in (("FR/f1", "stop_id string, stop_name string"), ("DE/f2", "stop_id string")):
        spark.createDataFrame([("1", ' "Lyon" ')[: cols.count(",") + 1]], cols).write.parquet(f"{tmp_path}/{feed}/stops")
    got = {tuple(r) for r in files.load_feed_table(spark, str(tmp_path), "stops", ["stop_id", "stop_name"]).collect()}
    assert got == {("FR/f1", "1", "lyon"), ("DE/f2", "1", None)}
    df = spark.createDataFrame([("t1", None), ("t2", "FR")], "trip_id string, departure_country string")
    files.write_gold_partitioned(df, f"{tmp_path}/gold")
    assert {r.departure_country for r in spark.read.parquet(f"{tmp_path}/gold").collect()} == {"XX", "FR"}


def test_export_is_refused_above_the_limit(spark, tmp_path):
    import pytest

    assert files.export_csv(spark.range(5).toDF("x"), f"{tmp_path}/a", 5) == 5
    with pytest.raises(ValueError, match="over 4"):
        files.export_csv(spark.range(5).toDF("x"), f"{tmp_path}/b", 4)


def test_json_records(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"date": "2024", "a": 1}, {"date": "2010", "b": 2}]}')
    assert [(r.a, r.b) for r in files.read_json_records(spark, str(tmp_path / "p.json"), "data", "date", [2024]).collect()] == [(1, None)]


def test_feed_csv_of_several_layouts_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.txt").write_text("stop_name,stop_id,extra\nLyon,1,x\n")
    (tmp_path / "a" / "two.txt").write_text('\ufeff"Stop_Id", stop_name \n2,Paris\n')
    (tmp_path / "a" / "three.txt").write_text("stop_id\n3\n")
    rows = files.read_feed_csv(spark, str(tmp_path / "a"), ["stop_id", "stop_name"]).collect()
    assert sorted((r.stop_id, r.stop_name) for r in rows) == [("1", "Lyon"), ("2", "Paris"), ("3", None)]


def test_feeds_that_type_a_column_differently(spark, tmp_path):
    spark.createDataFrame([("1", "2")], "stop_id string, stop_lat string").write.parquet(f"{tmp_path}/FR/f1/stops")
    spark.createDataFrame([(3.5, 7)], "`Stop_Lat` double, stop_id int").write.parquet(f"{tmp_path}/DE/f2/stops")
    got = {tuple(r) for r in files.load_feed_table(spark, str(tmp_path), "stops", ["stop_id", "stop_lat"]).collect()}
    assert got == {("FR/f1", "1", "2"), ("DE/f2", "7", "3.5")}


def test_rare_countries_share_the_default_partition(spark, tmp_path):
    df = spark.createDataFrame([("t1", None), ("t2", "FR"), ("t3", "US")], "trip_id string, departure_country string")
    files.write_gold_partitioned(df, f"{tmp_path}/gold")
    got = {(r.trip_id, r.departure_country, r.country_partition) for r in spark.read.parquet(f"{tmp_path}/gold").collect()}
    assert got == {("t1", "XX", "XX"), ("t2", "FR", "FR"), ("t3", "US", "XX")}


def test_star_and_sorted_export(spark, tmp_path):
    files.write_star({"fact": spark.range(100), "dim": spark.range(3)}, f"{tmp_path}/star", facts=("fact",))
    files.write_star({"fact": spark.range(10), "dim": spark.range(3)}, f"{tmp_path}/star", facts=("fact",))
    assert (spark.read.parquet(f"{tmp_path}/star/fact").count(), spark.read.parquet(f"{tmp_path}/star/dim").count()) == (10, 3)
    assert files.export_csv(spark.range(9).toDF("x"), f"{tmp_path}/c", 9, where=F.col("x") > 5, order=[F.desc("x")]) == 3
    assert [r.x for r in spark.read.option("header", True).csv(f"{tmp_path}/c").collect()] == ["8", "7", "6"]


def test_json_pages_round_trip(spark, tmp_path):
    files.write_json_pages(spark.range(25).selectExpr("id as a", "2000 + id % 3 as year"), f"{tmp_path}/p", "data", size=4)
    got = files.read_json_records(spark, f"{tmp_path}/p", "data", "year", [2001]).collect()
    assert sorted(r.a for r in got) == [x for x in range(25) if x % 3 == 1]


def test_route_types_are_enriched_where_the_route_has_a_specific_one(spark):
    rows = spark.createDataFrame([("s", "r", 2), ("s", "r", 106), ("s", "r", 103), ("s", "q", 2), ("t", "r", 2)], "source string, route_id string, route_type int")
    assert sorted(tuple(r) for r in rail.enrich_route_type(rows).collect()) == [("s", "q", 2), ("s", "r", 103), ("s", "r", 103), ("s", "r", 106), ("t", "r", 2)]


def test_missing_and_sentinel_sequences(spark):
    rows = [("a", "t", None, "x", "09:00:00"), ("a", "t", 1, "y", "08:00:00"), ("a", "u", 1, "x", "08:00:00"), ("a", "u", 5, "z", "09:00:00"), ("a", "u", 99, "y", "10:00:00")]
    df = spark.createDataFrame(rows, "source string, trip_id string, stop_sequence int, stop_id string, departure_time string").withColumn("arrival_time", F.col("departure_time"))
    got = {(r.trip_id, r.stop_id): r.stop_sequence for r in rail.filled_sequences(df).collect()}
    assert got == {("t", "y"): 0, ("t", "x"): 1, ("u", "x"): 1, ("u", "z"): 5, ("u", "y"): 6}


def test_unknown_codes_stay_and_micro_states_take_their_neighbour(spark):
    df = spark.createDataFrame([("FRA", 2023, 10.0), ("ESP", 2023, 30.0), ("MCO", 2023, 99.0), ("XYZ", 2023, 5.0), ("EU27", 2023, 1.0)], "entity_code string, date int, emissions_intensity_gco2_per_kwh double")
    got = {r.country_code: r.intensity for r in places.intensity_by_country(df).collect()}
    assert got == {"FR": 10.0, "ES": 30.0, "MC": 10.0, "AD": 20.0, "XYZ": 5.0}


def test_labels_of_flights_come_from_tables(spark):
    row = [("A", "B", "Aa", "Bb", "small_large_1000km", "FR", "DE", "c", "d", 100.0, 2.0)]
    flown = spark.createDataFrame(row, "origin_id string, dest_id string, origin_name string, dest_name string, trajet_type string, origin_country string, dest_country string, origin_city string, dest_city string, distance_km double, co2_per_pkm double")
    got = gold.gold_flight(flown).first()
    assert (got.destination, got.trip_short_name, got.route_long_name) == ("Aa - Bb", "A - B", "Short haul - Small airport to Large airport")
    assert gold.gold_flight(flown, hauls={"1000km": "Near"}).first().route_long_name.startswith("Near - ")


def test_city_flights_equal_all_combinations(spark):
    rnd = random.Random(4)
    access = [(f"c{c}", "FR", f"p{p}", float(rnd.randrange(90))) for c in range(6) for p in rnd.sample(range(8), 3)]
    flown = [(f"p{a}", f"p{b}", float(rnd.randrange(100, 900)), float(rnd.choice([10, 20]))) for a in range(8) for b in range(8) if a != b and rnd.random() < 0.8]
    pairs = [(f"c{a}", "FR", f"c{b}", "FR") for a in range(6) for b in range(6) if a != b]
    got = gold.best_flight_per_city_pair(spark.createDataFrame(pairs, gold.CITY_PAIR), spark.createDataFrame(access, "city_name string, country string, ident string, access_km double"), spark.createDataFrame(flown, "origin_id string, dest_id string, distance_km double, co2_per_pkm double"))
    want = {}
    for a, _, b, _ in pairs:
        options = [(round(km * f, 3), km / 700 * 60 + 75 + (x + y) / 40 * 60, p, q) for c, _, p, x in access if c == a for d, _, q, y in access if d == b for o, e, km, f in flown if (o, e) == (p, q)]
        if options:
            want[a, b] = min(options)[0]
    assert {(r.departure_city, r.arrival_city): r.flight_emissions_co2 for r in got.collect()} == want


def test_database_round_trip(spark, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for mode in ("overwrite", "append"):
        files.write_jdbc(spark.range(4).toDF("x"), url, "t", mode, options=options)
    assert spark.read.format("jdbc").options(url=url, dbtable="t", **options).load().count() == 8
