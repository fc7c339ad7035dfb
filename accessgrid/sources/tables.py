"""The given tables, and the shapes the operators work on, derived from them.

Each shape is one SELECT that Spark and any ANSI engine can run, so the same text feeds
the queries and their SQL checks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Shape -> (tables or shapes it reads, SELECT text).
SHAPES: dict[str, tuple[list[str], str]] = {
    "zones": (
        ["customer", "nation", "region"],
        """
SELECT lpad(cast(c_custkey AS string), cast(greatest(5, length(cast(c_custkey AS string))) AS int), '0') AS zone, n_name AS state, r_name AS region,
       cast((c_custkey * 7919) % 50000 AS double) AS population,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 20000 + (c_acctbal + 1000) * 10 END AS income,
       cast(1 + (c_custkey * 31) % 5000 AS double) AS area_km2,
       30 + ((c_custkey * 613) % 12007) / cast(1000 AS double) AS lat,
       -110 + ((c_custkey * 1511) % 20011) / cast(1000 AS double) AS lon,
       cast((c_custkey * 37) % 3000 AS double) AS elevation_m,
       ((c_custkey * 104729) % 1000) / cast(1000 AS double) AS score
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    ),
    "sites": (
        ["supplier"],
        """
SELECT s_suppkey AS site_id,
       30 + ((s_suppkey * 977) % 11987) / cast(1000 AS double) AS lat,
       -110 + ((s_suppkey * 2113) % 19997) / cast(1000 AS double) AS lon
FROM {supplier}""",
    ),
    "segments": (
        ["sites"],
        """
SELECT a.site_id AS seg_id, a.lat AS lat1, a.lon AS lon1, b.lat AS lat2, b.lon AS lon2
FROM {sites} a JOIN {sites} b ON b.site_id = a.site_id + 1""",
    ),
    "stations_raw": (
        ["orders", "lineitem", "customer", "nation"],
        """
SELECT o_orderkey AS id, concat('Station ', cast(o_orderkey AS string)) AS station_name,
       CASE WHEN o_orderkey % 499 = 0 THEN NULL ELSE concat('  ', lower(c_mktsegment), ' ') END AS city,
       concat(' ', lower(n_name)) AS state,
       CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE cast(o_custkey AS string) END AS zip,
       30 + ((o_custkey * 613) % 12007) / cast(1000 AS double) + (o_orderkey % 21 - 10) / cast(1000 AS double) AS latitude,
       -110 + ((o_custkey * 1511) % 20011) / cast(1000 AS double) AS longitude,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'private' ELSE 'public' END AS access_code,
       CASE WHEN o_orderstatus = 'P' THEN 'P' ELSE 'E' END AS status_code,
       CASE WHEN o_orderkey % 331 = 0 THEN 'not-a-date' ELSE cast(cast(o_orderdate AS date) AS string) END AS open_date,
       level1_ports, level2_ports, dcfc_ports,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE concat('Network ', cast(o_custkey % 12 AS string)) END AS ev_network,
       CASE WHEN o_orderkey % 997 = 0 THEN 'CA' ELSE 'US' END AS country
FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
LEFT JOIN (SELECT l_orderkey,
                  cast(sum(CASE WHEN l_returnflag = 'A' THEN 1 END) AS int) AS level1_ports,
                  cast(sum(CASE WHEN l_returnflag = 'N' THEN 1 END) AS int) AS level2_ports,
                  cast(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 END) AS int) AS dcfc_ports
           FROM {lineitem} GROUP BY l_orderkey) p ON l_orderkey = o_orderkey""",
    ),
    "weather_daily": (
        ["events"],
        """
SELECT concat('NATION_', cast(user_id % 25 AS string)) AS state, cast(ts AS date) AS day, value / 10 AS tmean,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 5 END AS tmax,
       CASE WHEN event_type = 'error' THEN NULL ELSE value / 20 END AS precip
FROM {events}""",
    ),
    "labels_scored": (
        ["labels", "documents"],
        """
SELECT doc_id, source AS state, lang AS region, quality AS y, (n_chars % 1000) / cast(1000 AS double) AS score
FROM {labels} JOIN {documents} USING (doc_id)""",
    ),
    "state_regions": (
        ["nation", "region"],
        """
SELECT n_name AS state, r_name AS region
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    ),
    # Three dimensions with gaps: zones without a key, states without a name or a region.
    "census": (
        ["zones", "customer"],
        """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE zone END AS zip, population, income
FROM {zones} JOIN {customer} ON cast(zone AS bigint) = c_custkey""",
    ),
    "states_named": (
        ["state_regions"],
        "SELECT CASE WHEN region = 'ASIA' THEN NULL ELSE state END AS state, region FROM {state_regions}",
    ),
    "states_placed": (
        ["state_regions"],
        "SELECT state, CASE WHEN region = 'EUROPE' THEN NULL ELSE region END AS region FROM {state_regions}",
    ),
}


_schemas: dict[str, T.StructType] = {}


def _given(spark: SparkSession, path: str) -> DataFrame:
    """A given table; its footer is looked at once per process, not once per query."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, or one derived shape."""
    if name not in SHAPES:
        return _given(spark, f"{sf_dir}/{name}.parquet")
    needs, text = SHAPES[name]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in needs})
