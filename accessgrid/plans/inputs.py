"""Tables that several queries start from."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accessgrid.operators import cleaning, panel, siting, zones
from accessgrid.operators.lookup import lookup_small
from accessgrid.operators.spatial import nearest_point
from accessgrid.sources.tables import table
from accessgrid.storage import materialize

DIGITS = 6
EXCLUDED_STATE = "NATION_24"
# The given states that stand for those outside the continental scope.
OUT_OF_SCOPE = ["NATION_3", "NATION_7", "NATION_24"]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles at a fixed number of digits, for results compared across engines.

    Whole numbers are left alone: decimals are made, at some cost, of the others only.
    """

    def cut(x: Column) -> Column:
        return F.when(F.rint(x) == x, x).otherwise(F.round(x, digits)) + F.lit(0.0)

    cols = [
        cut(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def cleaned_stations(spark: SparkSession, sf_dir: str, with_region: bool = False) -> DataFrame:
    """Clean stations with features (and region), out-of-scope state removed."""
    stations = cleaning.clean_stations(table(spark, sf_dir, "stations_raw"))
    stations = cleaning.exclude_value(stations, "state", EXCLUDED_STATE)
    stations = cleaning.add_station_features(stations)
    if not with_region:
        return stations
    return lookup_small(stations, table(spark, sf_dir, "state_regions"), ["state"])


def covered_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with the nearest site, desert flag and status."""
    near = nearest_point(table(spark, sf_dir, "zones"), table(spark, sf_dir, "sites"), "site_id")
    near = near.withColumn("is_desert", zones.desert_flag(F.col("nearest_miles")))
    return zones.label_coverage(near)


def event_panel(spark: SparkSession, sf_dir: str, zones_in: DataFrame | None = None) -> DataFrame:
    """Zone-by-month panel with temporal features, of all zones or those given."""
    monthly = materialize(panel.monthly_events(cleaned_stations(spark, sf_dir)))
    return panel.temporal_panel(table(spark, sf_dir, "zones") if zones_in is None else zones_in, monthly)


def latest_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence forecast per zone: the twelve months before its last month."""
    latest = panel.latest_per_key(event_panel(spark, sf_dir), "zone", "month_start", ["ports_lag_12m"])
    return latest.select("zone", F.col("ports_lag_12m").alias("forecast"))


def scored_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with coverage, weather, predicted distance, residual and forecast."""
    base = covered_zones(spark, sf_dir).withColumn("predicted_miles", F.col("elevation_m") / 30)
    base = base.withColumn("residual_miles", F.col("nearest_miles") - F.col("predicted_miles"))
    weather = zones.weather_by_state(table(spark, sf_dir, "weather_daily"))
    base = lookup_small(base, weather, ["state"])
    return materialize(base.join(latest_forecast(spark, sf_dir), "zone", "left"))


def candidates(scored: DataFrame) -> DataFrame:
    return materialize(siting.generate_candidates(siting.priority_zones(scored)))


def scored_candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored zones, candidates, scored candidates)."""
    zones_scored = scored_zones(spark, sf_dir)
    cands = candidates(zones_scored)
    coverage = siting.candidate_coverage(cands, zones_scored)
    return zones_scored, cands, materialize(siting.score_candidates(coverage))
