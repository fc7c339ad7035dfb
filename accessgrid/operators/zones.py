"""Zone tables: station rollup, coverage, context joins and model features."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx
from accessgrid.functions.constants import (
    ADEQUATE_LABEL,
    DAYS_PER_YEAR,
    DESERT_LABEL,
    DESERT_MILES,
    HEAT_DAY_C,
    HEAVY_PRECIP_MM,
    PREFIX_RANGES,
    RURAL_PEOPLE_PER_KM2,
    UNKNOWN_LABEL,
)
from accessgrid.operators.lookup import lookup_small
from accessgrid.operators.ranking import exact_quantiles

ROLLUP_COUNTS = [
    "total_stations", "dcfc_stations", "total_ports", "total_level2_ports", "total_dcfc_ports",
]


def station_rollup(stations: DataFrame, keys: list[str]) -> DataFrame:
    """Station and port totals with the mean coordinate per key."""
    return stations.groupBy(*keys).agg(
        F.count("id").alias("total_stations"),
        F.sum("is_dcfc").alias("dcfc_stations"),
        F.sum("total_ports").alias("total_ports"),
        F.sum("level2_ports").alias("total_level2_ports"),
        F.sum("dcfc_ports").alias("total_dcfc_ports"),
        F.avg("latitude").alias("station_lat"),
        F.avg("longitude").alias("station_lon"),
    )


def full_coverage(zones: DataFrame, rollup: DataFrame, zone: str, rollup_key: str) -> DataFrame:
    """Every zone with its rollup rows; zones without stations count zero."""
    right = rollup.withColumnRenamed(rollup_key, zone)
    joined = zones.join(right, zone, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ROLLUP_COUNTS})


def prefer(df: DataFrame, out: str, *choices: str) -> DataFrame:
    """First value that is not NULL."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in choices]))


def desert_flag(miles: Column, threshold: float = DESERT_MILES) -> Column:
    """1 beyond the threshold, 0 within, NULL when the distance is unknown."""
    return fx.flag_or_null(miles > threshold)


def coverage_status(flag: Column) -> Column:
    return (
        F.when(flag == 1, DESERT_LABEL).when(flag == 0, ADEQUATE_LABEL).otherwise(UNKNOWN_LABEL)
    )


def label_coverage(df: DataFrame, out: str = "coverage_status") -> DataFrame:
    """Status text from whichever label the table has; NULL labels are unknown."""
    names = df.columns
    if "coverage_status" in names:
        label = F.coalesce(F.col("coverage_status").cast("string"), F.lit(UNKNOWN_LABEL))
    elif "charging_desert" in names:
        label = coverage_status(F.col("charging_desert").cast("int"))
    elif "is_desert" in names:
        label = coverage_status(F.col("is_desert"))
    elif "dcfc_ports" in names:
        label = coverage_status(fx.flag(F.coalesce(F.col("dcfc_ports"), F.lit(0)) == 0))
    else:
        raise ValueError("no coverage label and no fast-charger count in the table")
    return df.withColumn(out, label)


def find_column(df: DataFrame, names: list[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def standard_region(df: DataFrame, state_region: DataFrame | None, out: str = "region_std") -> DataFrame:
    """Region from the table if it has one, else looked up by state, else unknown."""
    found = find_column(df, ["region", "Region", "census_region", "Census Region"])
    if found:
        text = fx.title_text(F.col(found))
        return df.withColumn(out, F.coalesce(text, F.lit(UNKNOWN_LABEL)))
    state = find_column(df, ["state", "State", "state_code", "STATE", "stusps"])
    if state is None or state_region is None:
        raise ValueError("no region and no state to look it up by")
    dim = state_region.select(F.col("state").alias(state), fx.title_text(F.col("region")).alias(out))
    joined = lookup_small(df, dim, [state])
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(UNKNOWN_LABEL)))


def dedupe_zones(df: DataFrame, zone: str = "zone") -> DataFrame:
    """One row per zone: known state first, then the larger population, then a fixed order."""
    rest = [c for c in df.columns if c not in (zone, "state", "population")]
    size = F.coalesce(-F.col("population"), F.lit(float("inf")))
    packed = F.struct(
        F.col("state").isNull().alias("_no_state"),
        size.alias("_size"),
        F.col("state"),
        F.col("population"),
        *rest,
    )
    best = df.groupBy(zone).agg(F.min(packed).alias("_row"))
    kept = [c for c in df.columns if c != zone]
    return best.select(zone, *[F.col(f"_row.{c}").alias(c) for c in kept])


def prefix_states(df: DataFrame) -> DataFrame:
    """The fixed prefix ranges as rows (prefix, prefix_state)."""
    spark = df.sparkSession
    ranges = spark.createDataFrame(PREFIX_RANGES, "lo int, hi int, prefix_state string")
    each = ranges.select(F.explode(F.sequence("lo", "hi")).alias("number"), "prefix_state")
    return each.select(fx.padded_key(F.col("number"), 3).alias("prefix"), "prefix_state")


def add_prefix_state(df: DataFrame, zone: str) -> DataFrame:
    """State by the first three characters of the padded key; NULL where no range holds it."""
    keyed = df.withColumn("prefix", F.substring(fx.padded_key(F.col(zone)), 1, 3))
    # At most 1,000 three-digit prefixes.
    return keyed.join(F.broadcast(prefix_states(df)), "prefix", "left")


def weather_by_state(daily: DataFrame) -> DataFrame:
    """Means over the days with a value; day counts per year over all days."""

    def days_per_year(test: Column) -> Column:
        return F.avg(F.when(test, 1.0).otherwise(0.0)) * DAYS_PER_YEAR

    return daily.groupBy("state").agg(
        F.avg("tmean").alias("avg_temp_c"),
        F.avg("precip").alias("avg_precip_mm_day"),
        days_per_year(F.col("tmax") >= HEAT_DAY_C).alias("heat_days_year"),
        days_per_year(F.col("precip") >= HEAVY_PRECIP_MM).alias("heavy_precip_days_year"),
    )


def terrain_by_state(samples: DataFrame, elevation: str) -> DataFrame:
    return samples.groupBy("state").agg(
        F.avg(elevation).alias("mean_elevation_m"), F.stddev_samp(elevation).alias("ruggedness")
    )


def group_statistics(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Median density and income, rural share and population total per key."""
    medians = None
    for column, name in (("density", "median_density"), ("income", "median_income")):
        part = exact_quantiles(df, column, {f"{prefix}_{name}": 0.5}, [key])
        part = part.withColumnRenamed(key, f"_{column}_key")
        medians = (column, part) if medians is None else (*medians, column, part)
    base = df.groupBy(key).agg(
        F.avg("rural").alias(f"{prefix}_rural_share"),
        F.coalesce(F.sum("population"), F.lit(0.0)).alias(f"{prefix}_population"),
    )
    for column, part in zip(medians[::2], medians[1::2]):
        same = base[key].eqNullSafe(part[f"_{column}_key"])
        base = base.join(part, same, "left").drop(f"_{column}_key")
    return base


def add_group_statistics(df: DataFrame) -> DataFrame:
    """State and region statistics joined back to the rows."""
    with_state = lookup_small(df, group_statistics(df, "state", "state"), ["state"], null_safe=True)
    return lookup_small(
        with_state, group_statistics(df, "region", "region"), ["region"], null_safe=True
    )


def zone_features(
    zones: DataFrame,
    weather: DataFrame,
    line_distance: DataFrame | None = None,
    zone_terrain: DataFrame | None = None,
    state_terrain: DataFrame | None = None,
    non_continental: list[str] | None = None,
) -> DataFrame:
    """One row per zone: density, rurality, scope and context columns; missing inputs give NULL."""
    density = fx.safe_ratio(F.col("population"), F.col("area_km2"))
    state = F.col("state")
    out = dedupe_zones(zones).withColumns(
        {"zone": fx.numeric_key(F.col("zone")), "density": density}
    )
    continental = fx.flag(state.isNotNull() & ~state.isin(non_continental or []))
    out = out.withColumns(
        {
            "rural": fx.flag_or_null(F.col("density") < RURAL_PEOPLE_PER_KM2),
            "is_continental": continental.cast("tinyint"),
        }
    )
    if line_distance is None:
        out = out.withColumn("line_miles", F.lit(None).cast("double"))
    else:
        nearest = line_distance.groupBy("zone").agg(F.min("line_miles").alias("line_miles"))
        out = out.join(nearest, "zone", "left")
    terrain = ["ruggedness", "mean_elevation_m"]
    sources: dict[str, list[Column]] = {c: [] for c in terrain}
    if zone_terrain is not None:
        means = zone_terrain.groupBy("zone").agg(*[F.avg(c).alias(f"_zone_{c}") for c in terrain])
        out = out.join(means, "zone", "left")
        for c in terrain:
            sources[c].append(F.col(f"_zone_{c}"))
    if state_terrain is not None:
        dim = state_terrain.select("state", *[F.col(c).alias(f"_state_{c}") for c in terrain])
        out = lookup_small(out, dim, ["state"])
        for c in terrain:
            sources[c].append(F.col(f"_state_{c}"))
    for c in terrain:
        value = F.coalesce(*sources[c]) if sources[c] else F.lit(None).cast("double")
        out = out.withColumn(c, value)
    out = out.drop(*[f"_{p}_{c}" for p in ("zone", "state") for c in terrain])
    return lookup_small(out, weather, ["state"])
