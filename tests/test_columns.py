"""Hand-made edge rows for column builders."""

from pyspark.sql import functions as F

from viaduct.functions import columns as C


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_times(spark):
    cases = {"25:10:00": 90600, "57:40:00": 207600, "8:05": 29100, "": None, None: None, "2024-01-01 08:00:00": 28800}
    assert {k: one(spark, k, C.hms_to_seconds) for k in cases} == cases


def test_dates(spark):
    cases = {"2024-02-29": "20240229", "20240229": "20240229", "2024/02/29": None, "": None, "2024013x": None}
    assert {k: one(spark, k, C.norm_date8) for k in cases} == cases
    assert one(spark, "2024/02/29", lambda c: C.norm_date8(c, strict=False)) == "2024/02/29"


def test_masks(spark):
    cases = {"Daily": "1111111", "daily except Sat": "1111101", "Fri (Oct-Jun)": "0000100", "Son": "0000001", "--": "0000000", None: "0000000"}
    assert {k: one(spark, k, C.mask_from_text) for k in cases} == cases
    rows = spark.createDataFrame([("1100110",), ("1010101",), (None,)], "m string")
    assert rows.agg(C.mask_or(F.col("m"))).first()[0] == "1110111"


def test_coordinates(spark):
    rows = [(0.0, 0.0, True), (91.0, 1.0, True), (1.0, -181.0, True), (None, 1.0, True), (48.0, 0.0, False)]
    df = spark.createDataFrame(rows, "lat double, lon double, bad boolean")
    assert df.where(C.invalid_coord(F.col("lat"), F.col("lon")) != F.col("bad")).count() == 0
    far = spark.range(1).select(C.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()[0]
    assert abs(far - 3.141592653589793 * 6_371_000) < 1


def test_text(spark):
    assert one(spark, ' "Gare DU Nord" ', C.clean_text) == "gare du nord"
    assert one(spark, "PARIS - LYON", C.selective_title) == "Paris - Lyon"
    assert one(spark, "Paris - LYON", C.selective_title) == "Paris - LYON"
    assert one(spark, "CET", lambda c: C.fix_timezone(c, F.lit("FR"))) == "Europe/Paris"
    assert one(spark, " -/- ", C.blank_to_null) is None


def test_midnight_wrap_and_missing_time(spark):
    df = spark.createDataFrame([("23:00:00", "01:00:00", 90.0), (None, "01:00:00", 90.0)], "d string, a string, km double")
    assert [r[0] for r in df.select(C.trip_duration_min(F.col("d"), F.col("a"), F.col("km"))).collect()] == [120.0, 60.0]
