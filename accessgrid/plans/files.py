"""Queries that go through files: tables written in the published file formats and read back."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.operators import reports
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import cleaned_stations, rounded
from accessgrid.sources import readers
from accessgrid.sources.tables import table
from accessgrid.storage import removed_at_exit, shared_folder

REPORT_SCHEMA = "state string, station_count bigint, total_ports bigint"


def _new_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/accessgrid/{uuid.uuid4().hex}"


def _as_text(df: DataFrame, sep: str = ",") -> str:
    """The frame as delimited text files with a header, blanks and line breaks kept; their path."""
    path = _new_path(df.sparkSession)
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(header="true", sep=sep, escape='"', **kept).csv(path)
    removed_at_exit(df.sparkSession, path)
    return path


def stations_from_csv(spark, sf_dir):
    """Quoted values with line breaks and quotes in them."""
    named = F.concat("station_name", F.lit('\n"'), "id", F.lit('"'))
    raw = table(spark, sf_dir, "stations_raw").withColumn("station_name", named)
    source = [
        (F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(header)
        for header, c in readers.STATION_COLUMNS.items()
    ]
    back = readers.read_stations(spark, _as_text(raw.select(*source)))
    return rounded(back.drop("connector_types"))


def census_from_csv(spark, sf_dir):
    zones = table(spark, sf_dir, "zones").select(
        F.col("zone").cast("bigint").alias("zcta"),
        F.col("population").cast("bigint").alias("total_population"),
        F.col("income").alias("median_household_income"),
    )
    return rounded(readers.read_census(spark, _as_text(zones)))


def gazetteer_from_tsv(spark, sf_dir):
    """Blanks around header names and values."""
    zones = table(spark, sf_dir, "zones").select(
        F.concat(F.col("zone"), F.lit(" ")).alias("GEOID"),
        F.col("area_km2").cast("string").alias("ALAND_SQMI"),
        F.concat(F.lit(" "), F.col("lat")).alias("INTPTLAT"),
        F.concat(F.col("lon"), F.lit("   ")).alias("INTPTLONG   "),
    )
    back = readers.read_gazetteer(spark, _as_text(zones, "\t"))
    return rounded(back.withColumn("ALAND_SQMI", F.col("ALAND_SQMI").cast("double")))


def zones_from_first_path(spark, sf_dir):
    """Parquet by region, counted, and found behind a path that is not there."""
    path = _new_path(spark)
    zones = table(spark, sf_dir, "zones").select("zone", "state", "region", "lat", "lon")
    written = readers.write_parquet(zones, path, ["region"])
    removed_at_exit(spark, path)
    found = readers.read_first(spark, [path + "-newer", path])
    return rounded(found.withColumn("rows_written", F.lit(written).cast("bigint")))


def state_report_file(spark, sf_dir):
    path = _new_path(spark)
    readers.write_report(reports.count_report(cleaned_stations(spark, sf_dir), ["state"]), path)
    removed_at_exit(spark, path)
    return readers.read_csv(spark, path, REPORT_SCHEMA)


def daily_from_json(spark, sf_dir):
    """One document per state and year, with an array for each measure."""
    daily = table(spark, sf_dir, "weather_daily").groupBy("state", "day")
    daily = daily.agg(F.min("tmean").alias("tmean"), F.max("tmax").alias("tmax"), F.max("precip").alias("precip"))
    days = F.array_sort(F.collect_list(F.struct("day", "tmean", "tmax", "precip"))).alias("o")  # a year's at most
    documents = daily.groupBy("state", F.year("day")).agg(days).select("state", "o.day", "o.tmean", "o.tmax", "o.precip")
    path = _new_path(spark)
    readers.write_metrics(documents, path)
    removed_at_exit(spark, path)
    return rounded(readers.read_daily(spark, path))


QUERIES = {
    "daily_from_json": daily_from_json,
    "stations_from_csv": stations_from_csv,
    "census_from_csv": census_from_csv,
    "gazetteer_from_tsv": gazetteer_from_tsv,
    "zones_from_first_path": zones_from_first_path,
    "state_report_file": state_report_file,
}

ORACLES = {
    "daily_from_json": pick(
        "(SELECT state, day, min(tmean) AS tmean, max(tmax) AS tmax, max(precip) AS precip FROM [weather_daily] GROUP BY state, day)",
        "state day", "tmean tmax precip",
    ),
    "stations_from_csv": pick(
        "(SELECT * REPLACE (concat(station_name, chr(10), '\"', cast(id AS varchar), '\"') AS station_name) FROM [stations_raw])",
        "id station_name city state zip access_code status_code open_date level1_ports level2_ports dcfc_ports "
        "ev_network country",
        "latitude longitude",
    ),
    "census_from_csv": pick(
        "(SELECT zone, cast(population AS bigint) AS population, income FROM [zones])", "zone population", "income"
    ),
    "gazetteer_from_tsv": pick(
        '(SELECT zone, area_km2 AS "ALAND_SQMI", lat AS zone_lat, lon AS zone_lon FROM [zones])',
        "zone", "ALAND_SQMI zone_lat zone_lon",
    ),
    "zones_from_first_path": pick(
        "(SELECT *, (SELECT count(*) FROM [zones]) AS rows_written FROM [zones])",
        "zone state region rows_written", "lat lon",
    ),
    "state_report_file": check(
        "SELECT state, count(*) AS station_count, cast(sum(total_ports) AS bigint) AS total_ports "
        "FROM [stations] WHERE state IS NOT NULL GROUP BY state"
    ),
}
