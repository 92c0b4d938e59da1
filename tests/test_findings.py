"""What the reviewer's larger tables showed, on small inputs."""

import random
import re
import time

from pyspark.sql import functions as F

from viaduct.operators import audit, gold, places
from viaduct.plans import registry
from viaduct.sources.tables import settled

SF = "/root/testdata/sf0.001"


def joined_rows(df):
    """The most rows that a join of df makes."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    nodes, most = [execution.executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            if "Join" in name:
                most = max(most, node.metrics().apply("numOutputRows").value())
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_places_meet_once_however_many_cities_and_points_they_have(spark, monkeypatch):
    seen, within = [], places.within
    monkeypatch.setattr(places, "within", lambda *a: seen.append(within(*a)) or seen[-1])
    points = spark.range(40).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("stop_id"), F.lit(45.0).alias("lat"), F.lit(5.0).alias("lon"))
    cities = spark.range(30).select(F.col("id").alias("geonameid"), F.concat(F.lit("c"), "id").alias("asciiname"), F.lit("FR").alias("country_code"), F.lit(45.01).alias("latitude"), F.lit(5.0).alias("longitude"), F.when(F.col("id") > 5, F.col("id") % 7).alias("population"))
    got = places.nearest_city(points, cities, ["source", "stop_id"]).collect()
    assert len(got) == 40 and {r.city_id for r in got} == {6}
    assert seen[0].count() == 1


def test_stop_events_do_not_look_for_cities(spark):
    for name in ("silver_events", "first_last_stop"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "7907" not in plan, name  # a number of the cities' view


def test_flights_of_equal_time_go_by_the_name_of_the_airport(spark):
    """Minutes count as they are rounded, as in SQL, not the way to one airport before."""
    pairs = spark.createDataFrame([("a", "A", "b", "B")], ", ".join(f"{c} string" for c in gold.CITY_PAIR))
    access = spark.createDataFrame([("a", "A", "P", 10.01), ("a", "A", "Q", 10.0), ("b", "B", "Z", 5.0)], "city_name string, country string, ident string, access_km double")
    flown = spark.createDataFrame([("P", "Z", 700.0, 100.0), ("Q", "Z", 700.0, 100.0)], "origin_id string, dest_id string, distance_km double, co2_per_pkm double")
    assert [r.flight_candidate_id for r in gold.best_flight_per_city_pair(pairs, access, flown).collect()] == ["P__Z"]


def test_city_pairs_decide_how_many_flights_are_weighed(spark):
    """A hundred cities at each airport, one train: no step makes a row for each two cities."""
    side = lambda k: [(f"{k}{i}", k.upper(), k, 1.0) for i in range(100)]
    access = spark.createDataFrame(side("p") + side("q"), "city_name string, country string, ident string, access_km double")
    flown = spark.createDataFrame([("p", "q", 700.0, 100.0)], "origin_id string, dest_id string, distance_km double, co2_per_pkm double")
    pairs = spark.createDataFrame([("p1", "P", "q7", "Q")], ", ".join(f"{c} string" for c in gold.CITY_PAIR))
    out = gold.best_flight_per_city_pair(pairs, access, flown)
    assert out.count() == 1 and 0 < joined_rows(out) <= 4


def test_shuffle_files_go_with_the_write(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    there = lambda: set(re.findall(r"shuffle_\d+_\w+\.data", disk.getAllFiles().mkString(",")))
    before = there()
    kept = settled(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    for _ in range(50):  # they go a moment later
        if there() <= before:
            break
        time.sleep(0.1)
    assert there() <= before and kept.count() == 7


def test_names_meet_that_are_near_not_all_of_common_letters(spark):
    names = spark.range(10000, 13000).select(F.concat(F.lit("City "), "id").alias("n"), (F.col("id") % 3).alias("g"))
    out = audit.similar_names(names, "n")
    assert out.count() == sum(1 for a in range(10000, 13000) for k in range(5) for x in range(10) if a < (b := a - (a // 10**k % 10) * 10**k + x * 10**k) and 10000 <= b < 13000)
    assert joined_rows(out) < 5 * out.count()


def test_names_of_all_lengths_as_brute_force(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 19))) for _ in range(260)} | {"a" * k for k in range(1, 20)}
    names = spark.createDataFrame([(w, k % 3 or None) for k, w in enumerate(sorted(words))], "n string, g int")
    longer = F.greatest(F.length("a.n"), F.length("b.n"))
    every = names.alias("a").join(names.alias("b"), F.expr("a.n < b.n and abs(length(a.n) - length(b.n)) <= 3")).where(1 - F.levenshtein("a.n", "b.n") / longer > 0.8)
    expected = {(r.x, r.y): r.both for r in every.select(F.col("a.n").alias("x"), F.col("b.n").alias("y"), F.expr("cast(a.g <=> b.g as int)").alias("both")).collect()}
    pairs = audit.similar_names(names, "n")
    got = {(r.name, r.other): r.together for r in audit.together(pairs, names, "n", "g").collect()}
    assert got == expected and got


def test_match_rates_look_for_cities_once(spark, monkeypatch):
    calls, nearest = [], places.nearest_city
    monkeypatch.setattr(places, "nearest_city", lambda *a, **b: calls.append(a) or nearest(*a, **b))
    assert registry.queries()["match_rate_report"](spark, SF).count() == 6
    assert len(calls) <= 1
