"""Input views over the given tables, in SQL that Spark and DuckDB read alike, and how the queries get them."""

from __future__ import annotations

import hashlib
import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: Feeds, trips, stops, cities, airports and factors derived from the given tables.
VIEWS: dict[str, str] = {
    "v_feeds": """
SELECT f, split_part('FR,DE,CH,IT,ES,AT,BE,NL,PL,GB,SE,DK', ',', CAST(f + 1 AS INT)) || '/feed-' || CAST(f AS STRING) AS source
FROM (SELECT DISTINCT o_orderkey % 12 AS f FROM orders) x
""",
    "v_trips": """
SELECT v.source, 't' || CAST(o.o_orderkey AS STRING) AS trip_id,
       'r' || CAST(o.o_custkey % 150 AS STRING) AS route_id,
       's' || CAST(o.o_custkey % 400 AS STRING) AS service_id,
       CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(NULL AS STRING)
            WHEN o.o_orderkey % 7 = 0 THEN 'express'
            ELSE 'ic ' || CAST(100 + o.o_orderkey % 3000 AS STRING) END AS trip_short_name,
       o.o_orderpriority AS trip_headsign
FROM orders o JOIN v_feeds v
  ON v.f = CASE WHEN o.o_orderkey % 3 = 0 THEN 0 ELSE o.o_orderkey % 12 END
""",
    "v_routes": """
SELECT v.source, 'r' || CAST(r AS STRING) AS route_id,
       split_part('2,100,101,102,103,105,106,3', ',', CAST(r % 8 + 1 AS INT)) AS route_type,
       CASE WHEN r % 6 = 0 THEN '-/-' ELSE 'L' || CAST(r AS STRING) END AS route_short_name,
       CASE WHEN r % 4 = 0 THEN '' ELSE 'NORTH ' || CAST(r AS STRING) || ' - SOUTH' END AS route_long_name,
       CASE WHEN r % 11 = 0 THEN CAST(NULL AS STRING) ELSE 'a' || CAST(r % 20 AS STRING) END AS agency_id
FROM (SELECT DISTINCT p_partkey % 150 AS r FROM part) x CROSS JOIN v_feeds v
""",
    "v_agency": """
SELECT v.source, 'a' || CAST(a AS STRING) AS agency_id,
       'operator ' || CAST(a AS STRING) || ' rail' AS agency_name,
       CASE a % 4 WHEN 0 THEN 'CET' WHEN 1 THEN 'UTC' WHEN 2 THEN CAST(NULL AS STRING) ELSE 'Europe/Paris' END AS agency_timezone
FROM (SELECT DISTINCT p_partkey % 20 AS a FROM part) x CROSS JOIN v_feeds v
""",
    "v_stops": """
SELECT v.source, 'st' || CAST(s.s_suppkey AS STRING) AS stop_id, s.s_name AS stop_name,
       CASE WHEN s.s_suppkey % 97 = 96 THEN CAST(0 AS DOUBLE)
            ELSE 45 + ((s.s_suppkey * 7919 + v.f * 613) % 6000) / CAST(1000 AS DOUBLE) END AS stop_lat,
       CASE WHEN s.s_suppkey % 97 = 96 THEN CAST(0 AS DOUBLE)
            ELSE 2 + ((s.s_suppkey * 104729 + v.f * 877) % 9000) / CAST(1000 AS DOUBLE) END AS stop_lon,
       CASE WHEN s.s_suppkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'p' || CAST(s.s_suppkey % 50 AS STRING) END AS parent_station
FROM supplier s CROSS JOIN v_feeds v
""",
    "v_stop_times": """
SELECT source, trip_id, stop_id, stop_sequence,
       lpad(CAST(CAST(floor(a / CAST(3600 AS DOUBLE)) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(CAST(floor((a % 3600) / CAST(60 AS DOUBLE)) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(a % 60 AS STRING), 2, '0') AS arrival_time,
       CASE WHEN a % 13 = 0 THEN CAST(NULL AS STRING) ELSE
       lpad(CAST(CAST(floor((a + 60) / CAST(3600 AS DOUBLE)) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(CAST(floor(((a + 60) % 3600) / CAST(60 AS DOUBLE)) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST((a + 60) % 60 AS STRING), 2, '0') END AS departure_time
FROM (SELECT v.source, 't' || CAST(l.l_orderkey AS STRING) AS trip_id,
             'st' || CAST(l.l_suppkey AS STRING) AS stop_id, l.l_linenumber AS stop_sequence,
             (l.l_orderkey % 20) * 3600 + l.l_linenumber * 5400 + l.l_partkey % 600 AS a
      FROM lineitem l JOIN v_feeds v
        ON v.f = CASE WHEN l.l_orderkey % 3 = 0 THEN 0 ELSE l.l_orderkey % 12 END) x
""",
    "v_calendar": """
SELECT v.source, 's' || CAST(s AS STRING) AS service_id,
       CAST(CAST(floor((s * 37 % 128) / CAST(64 AS DOUBLE)) AS INT) % 2 AS STRING) AS monday,
       CAST(CAST(floor((s * 37 % 128) / CAST(32 AS DOUBLE)) AS INT) % 2 AS STRING) AS tuesday,
       CAST(CAST(floor((s * 37 % 128) / CAST(16 AS DOUBLE)) AS INT) % 2 AS STRING) AS wednesday,
       CAST(CAST(floor((s * 37 % 128) / CAST(8 AS DOUBLE)) AS INT) % 2 AS STRING) AS thursday,
       CAST(CAST(floor((s * 37 % 128) / CAST(4 AS DOUBLE)) AS INT) % 2 AS STRING) AS friday,
       CAST(CAST(floor((s * 37 % 128) / CAST(2 AS DOUBLE)) AS INT) % 2 AS STRING) AS saturday,
       CAST(s * 37 % 2 AS STRING) AS sunday,
       '20230101' AS start_date,
       CASE WHEN s % 5 = 0 THEN '20231231' ELSE '20251231' END AS end_date
FROM (SELECT DISTINCT c_custkey % 400 AS s FROM customer) x CROSS JOIN v_feeds v
WHERE s % 3 <> 0
""",
    "v_calendar_dates": """
SELECT DISTINCT t.source, t.service_id,
       CASE WHEN l.l_linenumber % 2 = 0 THEN substr(CAST(l.l_shipdate AS STRING), 1, 10)
            ELSE replace(substr(CAST(l.l_shipdate AS STRING), 1, 10), '-', '') END AS date,
       CAST(1 + l.l_quantity % 2 AS INT) AS exception_type
FROM lineitem l JOIN v_trips t ON t.trip_id = 't' || CAST(l.l_orderkey AS STRING)
""",
    "v_cities": """
SELECT c_custkey AS geonameid, 'City ' || CAST(c_custkey AS STRING) AS asciiname,
       split_part('FR,DE,CH,IT,ES,AT,BE,NL,PL,GB,SE,DK', ',', CAST(c_nationkey % 12 + 1 AS INT)) AS country_code,
       45 + (c_custkey * 7907 % 6000) / CAST(1000 AS DOUBLE) AS latitude,
       2 + (c_custkey * 104723 % 9000) / CAST(1000 AS DOUBLE) AS longitude,
       CAST(floor(c_acctbal * 10) AS BIGINT) AS population
FROM customer
""",
    "v_airports": """
SELECT k AS id, 'AP' || CAST(k AS STRING) AS ident, 'Airport ' || CAST(k AS STRING) || ' ' || name AS name,
       CASE WHEN band <= 2 THEN 'small_airport' WHEN band = 3 THEN 'medium_airport' ELSE 'large_airport' END AS type,
       36 + (k * 7919 % 30000) / CAST(1000 AS DOUBLE) AS latitude_deg,
       -9 + (k * 104729 % 40000) / CAST(1000 AS DOUBLE) AS longitude_deg,
       split_part('FR,DE,CH,IT,ES,AT,BE,NL,PL,GB,RU,US', ',', CAST(k % 12 + 1 AS INT)) AS iso_country
FROM (SELECT CAST(substr(p_brand, 7) AS BIGINT) * 10 + CAST(floor(p_size / CAST(10 AS DOUBLE)) AS BIGINT) AS k,
             CAST(floor(p_size / CAST(10 AS DOUBLE)) AS BIGINT) AS band, min(p_name) AS name
      FROM part GROUP BY 1, 2) x
""",
    "v_intensity": """
SELECT DISTINCT split_part('FRA,DEU,CHE,ITA,ESP,AUT,BEL,NLD,POL,GBR,SWE,DNK,EU27,MCO,VAT,LIE,TUR,UKR,SRB,ISL,MKD,GRC,XKX,USA,ROU', ',', CAST(n_nationkey % 25 + 1 AS INT)) AS entity_code,
       2018 + y AS date, CAST(50 + (n_nationkey % 25 * 97 + y * 31) % 650 AS DOUBLE) AS emissions_intensity_gco2_per_kwh
FROM nation CROSS JOIN (SELECT DISTINCT o_orderkey % 6 AS y FROM orders) x
""",
    "v_air_factors": """
SELECT split_part('20-50,51-100,101-220,>220', ',', CAST(p_size % 4 + 1 AS INT)) || ' seats, ' ||
       split_part('<500,500-1000,1000-2000,2000-5000,>5000', ',', CAST(p_partkey % 5 + 1 AS INT)) || ' km' AS label,
       p_retailprice / CAST(5000 AS DOUBLE) AS kg_per_pkm,
       CASE WHEN p_partkey % 9 = 0 THEN 'Archived' ELSE 'Valid generic' END AS status,
       CASE WHEN p_partkey % 10 = 0 THEN 'Post' ELSE CAST(NULL AS STRING) END AS post_type
FROM part
""",
    "v_shapes": """
SELECT 'FR/feed-0' AS source, 'sh' || CAST(user_id AS STRING) AS shape_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS shape_pt_sequence,
       45 + (event_id * 7 % 6000) / CAST(1000 AS DOUBLE) AS shape_pt_lat,
       2 + (event_id * 11 % 9000) / CAST(1000 AS DOUBLE) AS shape_pt_lon,
       value AS shape_dist_traveled
FROM events
""",
    "v_night": """
SELECT 'night' AS source, 'n' || substr(trip_id, 2) AS trip_id, route_id, service_id, upper(trip_short_name) AS trip_short_name,
       trip_headsign,
       CASE WHEN CAST(substr(trip_id, 2) AS BIGINT) % 2 = 0 THEN 'a1/a2' ELSE 'a3/zz' END AS agency_id
FROM v_trips WHERE trip_headsign = '5-LOW'
""",
    "v_night_routes": """
SELECT route_id, route_short_name, route_long_name FROM v_routes WHERE source = 'FR/feed-0'
""",
    "v_night_times": """
SELECT 'n' || substr(s.trip_id, 2) AS trip_id, s.stop_id, s.stop_sequence,
       '2024-05-01 ' || s.arrival_time AS arrival_time, '2024-05-01 ' || s.departure_time AS departure_time
FROM v_stop_times s JOIN v_trips t ON t.source = s.source AND t.trip_id = s.trip_id WHERE t.trip_headsign = '5-LOW'
""",
    "v_night_stops": """
SELECT stop_id, stop_name, stop_lat, stop_lon,
       CASE CAST(substr(stop_id, 3) AS BIGINT) % 3 WHEN 0 THEN 'UK' WHEN 1 THEN 'DE' ELSE 'FR' END AS stop_country
FROM v_stops WHERE source = 'FR/feed-0'
""",
    "v_night_calendar": """
SELECT service_id, monday, tuesday, wednesday, thursday, friday, saturday, sunday,
       substr(start_date, 1, 4) || '-' || substr(start_date, 5, 2) || '-' || substr(start_date, 7, 2) AS start_date, end_date
FROM v_calendar WHERE source = 'FR/feed-0'
""",
}


def uses(sql: str, names: dict[str, str]) -> list[str]:
    """The names that a statement needs, each after those that it needs itself."""
    out: list[str] = []
    for name in names:
        if re.search(rf"\b{name}\b", sql):
            for x in [*uses(names[name], {k: v for k, v in names.items() if k != name}), name]:
                if x not in out:
                    out.append(x)
    return out


def with_views(sql: str, more: dict[str, str] | None = None) -> str:
    """A statement with the views that it names as common table expressions."""
    known = VIEWS | (more or {})
    needed = uses(sql, known)
    return (("WITH " + ",\n".join(f"{n} AS ({known[n].strip()})" for n in needed) + "\n") if needed else "") + sql.strip()


class Views:
    """The input views of one folder of tables as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in TABLES}

    @cached_property
    def fingerprint(self) -> str:
        """Tells states of the given tables apart: paths, sizes and times of their files."""
        files = self.spark.read.format("binaryFile").load([f"{self.sf_dir}/{t}.parquet" for t in TABLES]).select("path", "length", "modificationTime").collect()
        return hashlib.sha256(repr(sorted(map(tuple, files))).encode()).hexdigest()

    def sql(self, sql: str) -> DataFrame:
        """A statement over the given tables, which it gets as parameters, and the views."""
        text = with_views(sql)
        named = [t for t in TABLES if re.search(rf"(?<![\w'.])(FROM|JOIN)\s+{t}\b", text)]
        for t in named:
            text = re.sub(rf"(?<![\w'.])(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
        return self.spark.sql(text, **{t: self._tables[t] for t in named})

    def __getattr__(self, name: str) -> DataFrame:
        if f"v_{name}" not in VIEWS:
            raise AttributeError(name)
        return self.sql(f"SELECT * FROM v_{name}")
