"""Queries on zone context: scope, area, weather, terrain, prefixes, feature tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.functions import scalars as fx
from accessgrid.operators import cleaning, quality, zones
from accessgrid.operators.spatial import nearest_segment, neighbour_spread
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import OUT_OF_SCOPE, covered_zones, rounded
from accessgrid.sources.tables import table
from accessgrid.storage import materialize


def scoped_zones(spark, sf_dir):
    """Continental scope, finite coordinates, five-digit keys, numbers read from text."""
    base = table(spark, sf_dir, "zones").withColumn(
        "income_text", F.coalesce(F.col("income").cast("string"), F.lit("n/a"))
    )
    kept = base.where(
        F.col("state").isNotNull()
        & ~F.col("state").isin(OUT_OF_SCOPE)
        & F.col("zone").rlike(r"^\d{5,}$")
        & fx.finite(F.col("lat"))
        & fx.finite(F.col("lon"))
    )
    kept = kept.withColumn("income", F.col("income_text").try_cast("double"))
    wanted = cleaning.filled_columns(kept, ["population", "income", "elevation_m", "not_there"])
    return rounded(kept.select("zone", "state", *wanted))


def area_units(spark, sf_dir):
    """Area by each column a source may have it in."""
    base = table(spark, sf_dir, "zones").select("zone", "area_km2")
    sqmi = base.select("zone", F.col("area_km2").cast("string").alias("ALAND_SQMI"))
    mixed = base.select("zone", (F.col("area_km2") * 10_000).alias("ALAND"))
    meters = base.select("zone", (F.col("area_km2") * 1_000_000).alias("AREALAND"))
    out = cleaning.area_km2(sqmi, "from_sqmi").join(cleaning.area_km2(mixed, "from_aland"), "zone")
    out = out.join(cleaning.area_km2(meters, "from_arealand"), "zone")
    return rounded(out.select("zone", "from_sqmi", "from_aland", "from_arealand"))


def dedupe_zone_keys(spark, sf_dir):
    """Three rows per key, some without state or population, cut to one."""
    number = F.col("zone").cast("bigint")
    rows = table(spark, sf_dir, "zones").select(
        fx.padded_key(F.floor(number / 3)).alias("zone"),
        F.when(number % 7 != 0, F.col("state")).alias("state"),
        F.when(number % 5 != 0, F.col("population")).alias("population"),
        "area_km2",
    )
    return rounded(zones.dedupe_zones(rows))


def prefix_state_lookup(spark, sf_dir):
    out = zones.add_prefix_state(table(spark, sf_dir, "zones").select("zone"), "zone")
    region = F.create_map(*[F.lit(x) for item in k.STATE_REGION.items() for x in item])
    out = out.withColumn("prefix_region", region[F.col("prefix_state")])
    return out.select("zone", "prefix", "prefix_state", "prefix_region")


def weather_by_state(spark, sf_dir):
    return rounded(zones.weather_by_state(table(spark, sf_dir, "weather_daily")))


def terrain_by_state(spark, sf_dir):
    return rounded(zones.terrain_by_state(table(spark, sf_dir, "zones"), "elevation_m"))


def key_min_mean(spark, sf_dir):
    """Smallest and mean reading per key."""
    daily = table(spark, sf_dir, "weather_daily")
    return rounded(
        daily.groupBy("state", "day").agg(F.min("tmean").alias("min_tmean"), F.avg("tmax").alias("mean_tmax"))
    )


def column_coverage(spark, sf_dir):
    daily = table(spark, sf_dir, "weather_daily")
    return rounded(quality.column_coverage(daily, ["tmean", "tmax", "precip"]))


def _features(spark, sf_dir):
    base = materialize(covered_zones(spark, sf_dir))
    roads = nearest_segment(base, table(spark, sf_dir, "segments")).select("zone", "line_miles")
    rough = neighbour_spread(base, "zone", "elevation_m")
    terrain = rough.select("zone", "ruggedness", F.col("elevation_m").alias("mean_elevation_m"))
    state_terrain = zones.terrain_by_state(base, "elevation_m")
    weather = zones.weather_by_state(table(spark, sf_dir, "weather_daily"))
    return zones.zone_features(base, weather, roads, terrain, state_terrain, OUT_OF_SCOPE)


FEATURE_COLUMNS = [
    "population", "income", "area_km2", "density", "line_miles", "ruggedness", "mean_elevation_m",
    "avg_temp_c", "avg_precip_mm_day", "heat_days_year", "heavy_precip_days_year", "nearest_miles",
    "lat", "lon",
]


def zone_features(spark, sf_dir):
    out = _features(spark, sf_dir)
    quality.require_columns(out, FEATURE_COLUMNS)
    return rounded(
        out.select("zone", "state", "region", "is_continental", "rural", "is_desert", *FEATURE_COLUMNS)
    )


def state_region_stats(spark, sf_dir):
    weather = zones.weather_by_state(table(spark, sf_dir, "weather_daily"))
    base = zones.zone_features(table(spark, sf_dir, "zones"), weather)
    out = zones.add_group_statistics(base)
    stats = [
        f"{p}_{c}"
        for p in ("state", "region")
        for c in ("median_density", "median_income", "rural_share", "population")
    ]
    return rounded(out.select("zone", "state", "region", *stats))


QUERIES = {
    "scoped_zones": scoped_zones,
    "area_units": area_units,
    "dedupe_zone_keys": dedupe_zone_keys,
    "prefix_state_lookup": prefix_state_lookup,
    "weather_by_state": weather_by_state,
    "terrain_by_state": terrain_by_state,
    "key_min_mean": key_min_mean,
    "column_coverage": column_coverage,
    "zone_features": zone_features,
    "state_region_stats": state_region_stats,
}

_SCOPE_LIST = ", ".join(f"'{s}'" for s in OUT_OF_SCOPE)
_PREFIX_VALUES = ", ".join(f"({lo}, {hi}, '{s}')" for lo, hi, s in k.PREFIX_RANGES)
_REGION_VALUES = ", ".join(f"('{s}', '{r}')" for s, r in k.STATE_REGION.items())
_WEATHER = "avg_temp_c avg_precip_mm_day heat_days_year heavy_precip_days_year"


def _line_per_zone() -> str:
    from accessgrid.plans.coverage import ORACLES as other

    sql = other["nearest_line_distance"]
    return f"({sql})"


def _knn_per_zone() -> str:
    return (
        "(SELECT zone, stddev_pop(e) AS ruggedness FROM (SELECT a.zone, b.elevation_m AS e, row_number() OVER ("
        "PARTITION BY a.zone ORDER BY (a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon), b.zone) AS n "
        "FROM [zones] a, [zones] b) WHERE n <= 9 GROUP BY zone)"
    )


def _stats_sql() -> str:
    parts = []
    for p, key in (("state", "state"), ("region", "region")):
        parts.append(
            f"(SELECT {key} AS {p}_key, quantile_cont(density, 0.5) AS {p}_median_density, quantile_cont(income, 0.5) AS {p}_median_income, "
            f"avg(rural) AS {p}_rural_share, coalesce(sum(population), 0) AS {p}_population FROM [zone_features] GROUP BY {key})"
        )
    return (
        f"(SELECT z.zone, z.state, z.region, s.*, r.* FROM [zone_features] z JOIN {parts[0]} s ON s.state_key = z.state "
        f"JOIN {parts[1]} r ON r.region_key = z.region)"
    )


ORACLES = {
    "scoped_zones": pick(
        f"(SELECT * FROM [zones] WHERE state NOT IN ({_SCOPE_LIST}))", "zone state", "population income elevation_m"
    ),
    "area_units": pick(
        "(SELECT zone, area_km2 * 2.58999::DOUBLE AS from_sqmi, CASE WHEN area_km2 * 10000 > 1000000 THEN area_km2 * 10000 / 1000000 "
        "ELSE area_km2 * 10000 * 2.58999::DOUBLE END AS from_aland, area_km2 * 1000000 / 1000000 AS from_arealand FROM [zones])",
        "zone", "from_sqmi from_aland from_arealand",
    ),
    "dedupe_zone_keys": pick(
        "(SELECT * FROM (SELECT lpad(cast(cast(zone AS bigint) // 3 AS varchar), 5, '0') AS zone, "
        "CASE WHEN cast(zone AS bigint) % 7 <> 0 THEN state END AS state, "
        "CASE WHEN cast(zone AS bigint) % 5 <> 0 THEN population END AS population, area_km2 FROM [zones]) "
        "QUALIFY row_number() OVER (PARTITION BY zone ORDER BY state IS NULL, population DESC NULLS LAST, state, area_km2) = 1)",
        "zone state", "population area_km2",
    ),
    "prefix_state_lookup": check(
        "SELECT z.zone, substr(z.zone, 1, 3) AS prefix, p.s AS prefix_state, g.r AS prefix_region FROM [zones] z "
        f"LEFT JOIN (VALUES {_PREFIX_VALUES}) p(lo, hi, s) ON cast(substr(z.zone, 1, 3) AS int) BETWEEN p.lo AND p.hi "
        f"LEFT JOIN (VALUES {_REGION_VALUES}) g(s, r) ON g.s = p.s"
    ),
    "weather_by_state": pick("[weather]", "state", _WEATHER),
    "terrain_by_state": pick(
        "(SELECT state, avg(elevation_m) AS mean_elevation_m, stddev_samp(elevation_m) AS ruggedness FROM [zones] GROUP BY state)",
        "state", "mean_elevation_m ruggedness",
    ),
    "key_min_mean": pick(
        "(SELECT state, day, min(tmean) AS min_tmean, avg(tmax) AS mean_tmax FROM [weather_daily] GROUP BY state, day)",
        "state day", "min_tmean mean_tmax",
    ),
    "column_coverage": check(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(count({c}) / count(*) * 100, 6) + 0.0 AS coverage_percent FROM [weather_daily]"
            for c in ("tmean", "tmax", "precip")
        )
    ),
    "zone_features": pick(
        "(SELECT f.*, cast(CASE WHEN f.state NOT IN (" + _SCOPE_LIST + ") THEN 1 ELSE 0 END AS tinyint) AS is_continental, "
        f"c.nearest_miles, c.is_desert, l.line_miles, n.ruggedness, f.elevation_m AS mean_elevation_m, {', '.join('w.' + c for c in _WEATHER.split())} "
        f"FROM [zone_features] f JOIN [covered] c USING (zone) JOIN {_line_per_zone()} l USING (zone) JOIN {_knn_per_zone()} n USING (zone) "
        "LEFT JOIN [weather] w ON w.state = f.state)",
        "zone state region is_continental rural is_desert", " ".join(FEATURE_COLUMNS),
    ),
    "state_region_stats": pick(
        _stats_sql(), "zone state region",
        " ".join(f"{p}_{c}" for p in ("state", "region") for c in ("median_density", "median_income", "rural_share", "population")),
    ),
}
