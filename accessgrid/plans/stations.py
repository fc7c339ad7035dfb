"""Queries on stations: profiling, cleaning, rollup and reports."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.functions import scalars as fx
from accessgrid.operators import cleaning, quality, ranking, reports, zones
from accessgrid.operators.lookup import lookup_left
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import EXCLUDED_STATE, cleaned_stations, rounded
from accessgrid.sources.tables import table

RAW_COLUMNS = [
    "id", "station_name", "city", "state", "zip", "latitude", "longitude", "access_code",
    "status_code", "open_date", "level1_ports", "level2_ports", "dcfc_ports", "ev_network", "country",
]
LAT_BOX, LON_BOX = (31.0, 41.0), (-108.0, -92.0)
MAP_LAT, MAP_LON = (24.0, 50.0), (-125.0, -66.0)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "stations_raw")


def null_profile(spark, sf_dir):
    return rounded(quality.null_profile(_raw(spark, sf_dir), RAW_COLUMNS))


def value_distribution(spark, sf_dir):
    return quality.value_distribution(_raw(spark, sf_dir), "ev_network", top=20)


def status_distribution(spark, sf_dir):
    return quality.value_distribution(_raw(spark, sf_dir), "status_code")


def range_profile(spark, sf_dir):
    return rounded(quality.range_profile(_raw(spark, sf_dir), ["latitude", "longitude", "dcfc_ports"]))


def key_length_distribution(spark, sf_dir):
    return quality.length_distribution(_raw(spark, sf_dir), "zip")


def all_null_rows(spark, sf_dir):
    return cleaning.all_null_rows(_raw(spark, sf_dir), cleaning.PORTS).select("id", "state", "zip")


def out_of_bounds_rows(spark, sf_dir):
    out = cleaning.outside_box(_raw(spark, sf_dir), "latitude", "longitude", LAT_BOX, LON_BOX)
    return rounded(out.select("id", "latitude", "longitude"))


def cleaning_funnel(spark, sf_dir):
    scope = ("in_scope_state", fx.upper_text(F.col("state")) != EXCLUDED_STATE)
    return quality.funnel(_raw(spark, sf_dir), [*cleaning.station_steps(), scope])


def install_summary(spark, sf_dir):
    stations = cleaned_stations(spark, sf_dir)
    return rounded(quality.numeric_summary(stations, ["install_year", "install_month"]))


def clean_stations(spark, sf_dir):
    out = cleaned_stations(spark, sf_dir).select(
        "id", "station_name", "city", "state", "zip", "latitude", "longitude", "level1_ports",
        "level2_ports", "dcfc_ports", "ev_network", "opened", "install_year", "install_month",
    )
    return rounded(out)


def station_features(spark, sf_dir):
    return cleaned_stations(spark, sf_dir, with_region=True).select(
        "id", "total_ports", "charger_level", "is_dcfc", "state", "region"
    )


def distinct_states(spark, sf_dir):
    return quality.distinct_sorted(cleaned_stations(spark, sf_dir), "state")


def distinct_keep_last(spark, sf_dir):
    stations = cleaned_stations(spark, sf_dir).select("zip", "id", "opened", "total_ports")
    return cleaning.drop_duplicates_last(stations.where(F.col("opened").isNotNull()), ["zip"], ["opened", "id"])


def unmapped_keys(spark, sf_dir):
    return quality.unmapped_keys(
        cleaned_stations(spark, sf_dir), table(spark, sf_dir, "states_named"), "state"
    )


def enriched_stations(spark, sf_dir):
    joined = lookup_left(
        cleaned_stations(spark, sf_dir).select("id", "zip", "state", "total_ports"),
        table(spark, sf_dir, "census"),
        ["zip"],
    )
    return rounded(joined)


def join_match_review(spark, sf_dir):
    return quality.match_review(
        cleaned_stations(spark, sf_dir), table(spark, sf_dir, "census"), "zip", "state", "income"
    )


def zone_station_rollup(spark, sf_dir):
    out = zones.station_rollup(
        cleaned_stations(spark, sf_dir, with_region=True), ["zip", "state", "region"]
    )
    return rounded(out)


def _full(spark, sf_dir):
    rollup = zones.station_rollup(
        cleaned_stations(spark, sf_dir, with_region=True), ["zip", "state", "region"]
    )
    base = table(spark, sf_dir, "zones").select("zone", "population", "income", "lat", "lon")
    return zones.full_coverage(base, rollup, "zone", "zip")


def zone_full_coverage(spark, sf_dir):
    return rounded(_full(spark, sf_dir).drop("lat", "lon"))


def zone_coordinates(spark, sf_dir):
    full = _full(spark, sf_dir)
    full = zones.prefer(zones.prefer(full, "final_lat", "station_lat", "lat"), "final_lon", "station_lon", "lon")
    return rounded(full.select("zone", "final_lat", "final_lon"))


def _report(keys, **options):
    def run(spark, sf_dir):
        return reports.count_report(cleaned_stations(spark, sf_dir), keys)

    return run


def report_by_city(spark, sf_dir):
    out = reports.count_report(cleaned_stations(spark, sf_dir), ["city", "state"])
    return out.withColumn("city_state", F.concat("city", F.lit(", "), "state"))


def report_by_month(spark, sf_dir):
    out = reports.count_report(cleaned_stations(spark, sf_dir), ["install_month"])
    name = F.date_format(F.make_date(F.lit(2000), F.col("install_month"), F.lit(1)), "MMM")
    return out.withColumn("month_name", name)


def report_type_by_year(spark, sf_dir):
    return reports.count_report(cleaned_stations(spark, sf_dir), ["install_year", "charger_level"])


def report_by_network(spark, sf_dir):
    stations = cleaned_stations(spark, sf_dir)
    named = F.coalesce(F.col("ev_network"), F.lit(k.NO_NETWORK_LABEL))
    return reports.count_report(stations.withColumn("ev_network", named), ["ev_network"])


def report_by_type_share(spark, sf_dir):
    out = reports.count_report(cleaned_stations(spark, sf_dir), ["charger_level"])
    return rounded(reports.add_share(out, "station_count", "share_percent"))


def map_sample(spark, sf_dir):
    stations = cleaning.in_box(cleaned_stations(spark, sf_dir), "latitude", "longitude", MAP_LAT, MAP_LON)
    named = F.coalesce(F.col("ev_network"), F.lit(k.NO_NETWORK_LABEL))
    stations = stations.withColumn("ev_network", named)
    out = ranking.seeded_sample(stations, "id", 42, 8000)
    return rounded(out.select("id", "city", "state", "charger_level", "ev_network", "latitude", "longitude"))


def _count_report_sql(key_sql: str, where: str = "TRUE") -> str:
    names = [p.split(" AS ")[-1].strip() for p in key_sql.split(",")]
    exprs = [p.split(" AS ")[0].strip() for p in key_sql.split(",")]
    keep = " AND ".join(f"{e} IS NOT NULL" for e in exprs)
    return check(
        f"SELECT {key_sql}, count(*) AS station_count, cast(sum(total_ports) AS bigint) AS total_ports "
        f"FROM [stations] WHERE {keep} AND {where} GROUP BY {', '.join(exprs)}"
    )


def _sum(c: str, name: str | None = None) -> str:
    return f"cast(sum({c}) AS bigint) AS {name or c}"


ROLLUP_SQL = (
    "(SELECT zip, state, region, count(id) AS total_stations, "
    + ", ".join([_sum("is_dcfc", "dcfc_stations"), _sum("total_ports"), _sum("level2_ports", "total_level2_ports"), _sum("dcfc_ports", "total_dcfc_ports")])
    + ", avg(latitude) AS station_lat, avg(longitude) AS station_lon FROM [stations] GROUP BY zip, state, region)"
)
FULL_SQL = (
    "(SELECT z.zone, z.population, z.income, z.lat, z.lon, r.state, r.region, "
    + ", ".join(f"coalesce(r.{c}, 0) AS {c}" for c in zones.ROLLUP_COUNTS)
    + f", r.station_lat, r.station_lon FROM [zones] z LEFT JOIN {ROLLUP_SQL} r ON r.zip = z.zone)"
)

QUERIES = {
    "null_profile": null_profile,
    "value_distribution": value_distribution,
    "status_distribution": status_distribution,
    "range_profile": range_profile,
    "key_length_distribution": key_length_distribution,
    "all_null_rows": all_null_rows,
    "out_of_bounds_rows": out_of_bounds_rows,
    "cleaning_funnel": cleaning_funnel,
    "install_summary": install_summary,
    "clean_stations": clean_stations,
    "station_features": station_features,
    "distinct_states": distinct_states,
    "distinct_keep_last": distinct_keep_last,
    "unmapped_keys": unmapped_keys,
    "enriched_stations": enriched_stations,
    "join_match_review": join_match_review,
    "zone_station_rollup": zone_station_rollup,
    "zone_full_coverage": zone_full_coverage,
    "zone_coordinates": zone_coordinates,
    "report_by_state": _report(["state"]),
    "report_by_city": report_by_city,
    "report_by_year": _report(["install_year"]),
    "report_by_month": report_by_month,
    "report_type_by_year": report_type_by_year,
    "report_by_network": report_by_network,
    "report_by_type_share": report_by_type_share,
    "map_sample": map_sample,
}

_FUNNEL = [
    ("raw", "TRUE"),
    ("open_public_us", "status_code = 'E' AND access_code = 'public' AND country = 'US'"),
    ("has_city_and_zip", "city IS NOT NULL AND zip IS NOT NULL"),
    ("has_ports", "coalesce(level1_ports, 0) + coalesce(level2_ports, 0) + coalesce(dcfc_ports, 0) > 0"),
    ("in_scope_state", f"upper(trim(state)) <> '{EXCLUDED_STATE}'"),
]


def _funnel_sql() -> str:
    def passed(i: int) -> str:
        return " AND ".join(f"({t})" for _, t in _FUNNEL[: i + 1])

    parts = [
        f"SELECT cast({i} AS int) AS step_no, '{name}' AS step, "
        f"count(*) FILTER (WHERE {passed(i)}) AS rows_left, "
        f"count(*) FILTER (WHERE {passed(max(i - 1, 0))}) - count(*) FILTER (WHERE {passed(i)}) AS rows_removed "
        "FROM [stations_raw]"
        for i, (name, _) in enumerate(_FUNNEL)
    ]
    return check(" UNION ALL ".join(parts))


def _null_profile_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) / count(*) * 100, 6) + 0.0 AS null_percent FROM [stations_raw]"
        for c in RAW_COLUMNS
    ]
    return check(" UNION ALL ".join(parts))


def _range_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, round(cast(min({c}) AS double), 6) AS min_value, "
        f"round(cast(max({c}) AS double), 6) AS max_value, count(*) - count({c}) AS null_count FROM [stations_raw]"
        for c in ("latitude", "longitude", "dcfc_ports")
    ]
    return check(" UNION ALL ".join(parts))


def _summary_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean_value, "
        f"round(stddev_samp({c}), 6) AS std_value, cast(min({c}) AS double) AS min_value, "
        f"cast(max({c}) AS double) AS max_value FROM [stations]"
        for c in ("install_year", "install_month")
    ]
    return check(" UNION ALL ".join(parts))


ORACLES = {
    "null_profile": _null_profile_sql(),
    "value_distribution": check(
        "SELECT ev_network, count(*) AS n FROM [stations_raw] GROUP BY ev_network ORDER BY n DESC, ev_network NULLS FIRST LIMIT 20"
    ),
    "status_distribution": check("SELECT status_code, count(*) AS n FROM [stations_raw] GROUP BY status_code"),
    "range_profile": _range_sql(),
    "key_length_distribution": check(
        "SELECT cast(length(zip) AS int) AS key_length, count(*) AS n FROM [stations_raw] GROUP BY 1"
    ),
    "all_null_rows": check(
        "SELECT id, state, zip FROM [stations_raw] WHERE level1_ports IS NULL AND level2_ports IS NULL AND dcfc_ports IS NULL"
    ),
    "out_of_bounds_rows": pick(
        "(SELECT * FROM [stations_raw] WHERE latitude < 31 OR latitude > 41 OR longitude < -108 OR longitude > -92)",
        "id", "latitude longitude",
    ),
    "cleaning_funnel": _funnel_sql(),
    "install_summary": _summary_sql(),
    "clean_stations": pick(
        "[stations]",
        "id station_name city state zip level1_ports level2_ports dcfc_ports ev_network opened install_year install_month",
        "latitude longitude",
    ),
    "station_features": pick("[stations]", "id total_ports charger_level is_dcfc state region"),
    "distinct_states": check("SELECT DISTINCT state FROM [stations]"),
    "distinct_keep_last": check(
        "SELECT zip, id, opened, total_ports FROM [stations] WHERE opened IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY zip ORDER BY opened DESC, id DESC) = 1"
    ),
    "unmapped_keys": check(
        "SELECT DISTINCT state FROM [stations] WHERE state IN (SELECT state FROM [state_regions] WHERE region = 'ASIA')"
    ),
    "enriched_stations": pick(
        f"(SELECT s.id, s.zip, s.state, s.total_ports, c.population, c.income FROM [stations] s LEFT JOIN [census] c ON c.zip = s.zip)",
        "id zip state total_ports", "population income",
    ),
    "join_match_review": check(
        "SELECT s.state, count(*) AS rows_total, count(c.zip) AS rows_matched, count(c.income) AS rows_with_value, "
        f"count(*) - count(c.zip) AS rows_unmatched FROM [stations] s LEFT JOIN [census] c ON c.zip = s.zip GROUP BY s.state"
    ),
    "zone_station_rollup": pick(
        ROLLUP_SQL, "zip state region " + " ".join(zones.ROLLUP_COUNTS), "station_lat station_lon"
    ),
    "zone_full_coverage": pick(
        FULL_SQL, "zone state region " + " ".join(zones.ROLLUP_COUNTS), "population income station_lat station_lon"
    ),
    "zone_coordinates": pick(
        f"(SELECT zone, coalesce(station_lat, lat) AS final_lat, coalesce(station_lon, lon) AS final_lon FROM {FULL_SQL})",
        "zone", "final_lat final_lon",
    ),
    "report_by_state": _count_report_sql("state"),
    "report_by_city": check(
        "SELECT *, concat(city, ', ', state) AS city_state FROM (SELECT city, state, count(*) AS station_count, "
        "cast(sum(total_ports) AS bigint) AS total_ports FROM [stations] GROUP BY city, state)"
    ),
    "report_by_year": _count_report_sql("install_year"),
    "report_by_month": check(
        "SELECT *, strftime(make_date(2000, install_month, 1), '%b') AS month_name FROM (SELECT install_month, count(*) AS station_count, "
        "cast(sum(total_ports) AS bigint) AS total_ports FROM [stations] WHERE install_month IS NOT NULL GROUP BY install_month)"
    ),
    "report_type_by_year": _count_report_sql("install_year, charger_level"),
    "report_by_network": check(
        f"SELECT coalesce(ev_network, '{k.NO_NETWORK_LABEL}') AS ev_network, count(*) AS station_count, "
        "cast(sum(total_ports) AS bigint) AS total_ports FROM [stations] GROUP BY 1"
    ),
    "report_by_type_share": check(
        "SELECT *, round(station_count / sum(station_count) OVER () * 100, 2) AS share_percent FROM (SELECT charger_level, "
        "count(*) AS station_count, cast(sum(total_ports) AS bigint) AS total_ports FROM [stations] GROUP BY charger_level)"
    ),
    "map_sample": pick(
        f"(SELECT id, city, state, charger_level, coalesce(ev_network, '{k.NO_NETWORK_LABEL}') AS ev_network, latitude, longitude "
        "FROM [stations] WHERE latitude BETWEEN 24 AND 50 AND longitude BETWEEN -125 AND -66 "
        "ORDER BY md5(concat(cast(id AS varchar), ':', '42')), id LIMIT 8000)",
        "id city state charger_level ev_network", "latitude longitude",
    ),
}
