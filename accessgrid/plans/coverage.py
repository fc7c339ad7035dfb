"""Queries on access: nearest site, desert labels, coverage reports, lines and neighbours."""
from __future__ import annotations

from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.operators import reports, zones
from accessgrid.operators.ranking import top_n
from accessgrid.operators.spatial import nearest_segment, neighbour_spread
from accessgrid.plans.checks import albers, check, pick
from accessgrid.plans.inputs import covered_zones, rounded
from accessgrid.sources.tables import table
from accessgrid.storage import materialize


def zone_nearest_site(spark, sf_dir):
    out = covered_zones(spark, sf_dir)
    return rounded(out.select("zone", "state", "region", "nearest_id", "nearest_miles", "is_desert"))


def desert_share_by_region(spark, sf_dir):
    return rounded(reports.flag_share_by(covered_zones(spark, sf_dir), "region", "is_desert"))


def desert_counts(spark, sf_dir):
    return rounded(reports.flag_counts(covered_zones(spark, sf_dir), "is_desert"))


def distance_distribution(spark, sf_dir):
    covered = materialize(covered_zones(spark, sf_dir).select("nearest_miles"))
    return rounded(reports.distance_summary(covered, "nearest_miles"))


def distance_distribution_sketch(spark, sf_dir):
    return rounded(reports.approximate_distance_summary(covered_zones(spark, sf_dir), "nearest_miles"))


def most_remote_zones(spark, sf_dir):
    deserts = covered_zones(spark, sf_dir).where(F.col("is_desert") == 1)
    out = top_n(deserts, "nearest_miles", "zone", 10)
    return rounded(out.select("zone", "state", "region", "nearest_miles"))


def status_label(spark, sf_dir):
    """Status by each way a table may carry it: flag column, yes/no column, charger count."""
    base = materialize(covered_zones(spark, sf_dir).select("zone", "is_desert"))
    by_flag = zones.label_coverage(base, "from_flag")
    yes_no = base.select("zone", (F.col("is_desert") == 1).alias("charging_desert"))
    by_yes_no = zones.label_coverage(yes_no, "from_yes_no").drop("charging_desert")
    counts = base.select("zone", F.when(F.col("is_desert") == 0, 2).alias("dcfc_ports"))
    by_count = zones.label_coverage(counts, "from_count").drop("dcfc_ports")
    return by_flag.join(by_yes_no, "zone").join(by_count, "zone")


def region_fallback(spark, sf_dir):
    """Region taken from the table, and looked up by state when the table has none."""
    base = table(spark, sf_dir, "zones")
    own = zones.standard_region(base, None, "region_own").select("zone", "region_own")
    known = table(spark, sf_dir, "states_placed")
    found = zones.standard_region(base.drop("region"), known, "region_found")
    return own.join(found.select("zone", "region_found"), "zone")


def _pivot(key):
    def run(spark, sf_dir):
        return rounded(reports.status_pivot(covered_zones(spark, sf_dir), key))

    return run


def coverage_long(spark, sf_dir):
    wide = reports.status_pivot(covered_zones(spark, sf_dir), "region")
    return rounded(reports.status_long(wide, "region"))


def nearest_line_distance(spark, sf_dir):
    out = nearest_segment(table(spark, sf_dir, "zones"), table(spark, sf_dir, "segments"))
    return rounded(out.select("zone", "line_miles"))


def knn_ruggedness(spark, sf_dir):
    out = neighbour_spread(table(spark, sf_dir, "zones"), "zone", "elevation_m")
    return rounded(out.select("zone", "elevation_m", "ruggedness"))


QUERIES = {
    "desert_share_by_region": desert_share_by_region,
    "zone_nearest_site": zone_nearest_site,
    "desert_counts": desert_counts,
    "distance_distribution": distance_distribution,
    "distance_distribution_sketch": distance_distribution_sketch,
    "most_remote_zones": most_remote_zones,
    "status_label": status_label,
    "region_fallback": region_fallback,
    "coverage_pivot_state": _pivot("state"),
    "coverage_pivot_region": _pivot("region"),
    "coverage_long": coverage_long,
    "nearest_line_distance": nearest_line_distance,
    "knn_ruggedness": knn_ruggedness,
}


def _pivot_sql(key: str) -> str:
    return (
        f"(SELECT {key}, count(*) FILTER (WHERE is_desert = 1) AS desert_count, count(*) FILTER (WHERE is_desert = 0) AS adequate_count, "
        "count(*) FILTER (WHERE is_desert IS NULL) AS unknown_count, count(is_desert) AS total_areas, "
        "CASE WHEN count(is_desert) > 0 THEN count(*) FILTER (WHERE is_desert = 1) / count(is_desert) * 100 END AS desert_percent "
        f"FROM [covered] GROUP BY {key})"
    )


PIVOT_PLAIN = "desert_count adequate_count unknown_count total_areas"


def _line_sql() -> str:
    px, py = albers("z.lat", "z.lon")
    x1, y1 = albers("lat1", "lon1")
    x2, y2 = albers("lat2", "lon2")
    return check(
        f"SELECT zone, round(min(sqrt(pow(px - (x1 + t * dx), 2) + pow(py - (y1 + t * dy), 2))) / 1609.344, 6) AS line_miles "
        "FROM (SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, "
        "((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy))) ELSE 0.0::DOUBLE END AS t "
        f"FROM (SELECT *, x2 - x1 AS dx, y2 - y1 AS dy FROM (SELECT zone, {px} AS px, {py} AS py FROM [zones] z), "
        f"(SELECT {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM [segments]))) GROUP BY zone"
    )


ORACLES = {
    "zone_nearest_site": pick("[covered]", "zone state region nearest_id is_desert", "nearest_miles"),
    "desert_share_by_region": pick(
        "(SELECT region, cast(coalesce(sum(is_desert), 0) AS bigint) AS desert_zones, count(*) AS total_zones, "
        "coalesce(sum(is_desert), 0) / count(*) * 100 AS desert_percent FROM [covered] WHERE region IS NOT NULL GROUP BY region)",
        "region desert_zones total_zones", "desert_percent",
    ),
    "desert_counts": pick(
        "(SELECT count(*) AS total, count(*) FILTER (WHERE is_desert = 1) AS deserts, count(*) FILTER (WHERE is_desert = 0) AS adequate, "
        "count(*) FILTER (WHERE is_desert IS NULL) AS unknown, count(*) FILTER (WHERE is_desert = 1) / count(*) * 100 AS desert_percent FROM [covered])",
        "total deserts adequate unknown", "desert_percent",
    ),
    "distance_distribution": pick(
        "(SELECT min(nearest_miles) AS min_miles, avg(nearest_miles) AS avg_miles, max(nearest_miles) AS max_miles, "
        "quantile_cont(nearest_miles, 0.5) AS median_miles, quantile_cont(nearest_miles, 0.9) AS p90_miles FROM [covered])",
        "", "min_miles avg_miles max_miles median_miles p90_miles",
    ),
    "distance_distribution_sketch": pick(
        "(SELECT min(nearest_miles) AS min_miles, avg(nearest_miles) AS avg_miles, max(nearest_miles) AS max_miles, "
        "quantile_disc(nearest_miles, 0.5) AS median_miles, quantile_disc(nearest_miles, 0.9) AS p90_miles FROM [covered])",
        "", "min_miles avg_miles max_miles median_miles p90_miles",
    ),
    "most_remote_zones": pick(
        "(SELECT zone, state, region, nearest_miles FROM [covered] WHERE is_desert = 1 ORDER BY nearest_miles DESC, zone LIMIT 10)",
        "zone state region", "nearest_miles",
    ),
    "status_label": check(
        "SELECT zone, is_desert, coverage_status AS from_flag, coverage_status AS from_yes_no, "
        f"CASE WHEN is_desert = 0 THEN '{k.ADEQUATE_LABEL}' ELSE '{k.DESERT_LABEL}' END AS from_count FROM [covered]"
    ),
    "region_fallback": check(
        "SELECT zone, CASE region WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE concat(upper(substr(region, 1, 1)), lower(substr(region, 2))) END AS region_own, "
        "CASE region WHEN 'EUROPE' THEN 'Unknown' WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE concat(upper(substr(region, 1, 1)), lower(substr(region, 2))) END AS region_found FROM [zones]"
    ),
    "coverage_pivot_state": pick(_pivot_sql("state"), f"state {PIVOT_PLAIN}", "desert_percent"),
    "coverage_pivot_region": pick(_pivot_sql("region"), f"region {PIVOT_PLAIN}", "desert_percent"),
    "coverage_long": check(
        f"SELECT region, total_areas, round(desert_percent, 6) + 0.0 AS desert_percent, 'desert_count' AS coverage_status, desert_count AS area_count FROM {_pivot_sql('region')} "
        f"UNION ALL SELECT region, total_areas, round(desert_percent, 6) + 0.0, 'adequate_count', adequate_count FROM {_pivot_sql('region')}"
    ),
    "nearest_line_distance": _line_sql(),
    "knn_ruggedness": pick(
        "(SELECT q.zone, any_value(q.elevation_m) AS elevation_m, stddev_pop(e) AS ruggedness FROM [zones] q JOIN ("
        "SELECT a.zone, b.elevation_m AS e, row_number() OVER (PARTITION BY a.zone ORDER BY (a.lat - b.lat) * (a.lat - b.lat) "
        "+ (a.lon - b.lon) * (a.lon - b.lon), b.zone) AS n FROM [zones] a, [zones] b) p ON p.zone = q.zone AND p.n <= 9 GROUP BY q.zone)",
        "zone", "elevation_m ruggedness",
    ),
}
