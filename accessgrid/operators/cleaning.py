"""Row cleaning and derived station columns."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx
from accessgrid.functions.constants import KM2_PER_SQUARE_MILE, SQUARE_METERS_PER_KM2

PORTS = ["level1_ports", "level2_ports", "dcfc_ports"]


def station_steps() -> list[tuple[str, Column]]:
    """Cleaning steps in order, each with the condition for a raw row to stay."""
    in_scope = (
        (F.col("status_code") == "E") & (F.col("access_code") == "public") & (F.col("country") == "US")
    )
    ports = reduce(Column.__add__, [F.coalesce(F.col(p), F.lit(0)) for p in PORTS])
    return [
        ("open_public_us", in_scope),
        ("has_city_and_zip", F.col("city").isNotNull() & F.col("zip").isNotNull()),
        ("has_ports", ports > 0),
    ]


def clean_stations(raw: DataFrame) -> DataFrame:
    """Keep usable rows; standard keys, text and dates."""
    kept = raw.where(reduce(Column.__and__, [test for _, test in station_steps()]))
    opened = fx.parsed_date(F.col("open_date"))
    return (
        kept.fillna(0, subset=PORTS)
        .withColumns(
            {
                "zip": fx.padded_key(F.col("zip")),
                "state": fx.upper_text(F.col("state")),
                "city": fx.title_text(F.col("city")),
                "ev_network": F.trim("ev_network"),
                "opened": opened,
            }
        )
        .withColumns({"install_year": F.year("opened"), "install_month": F.month("opened")})
    )


def add_station_features(stations: DataFrame) -> DataFrame:
    """Port total, main charger type, fast-charger flag."""
    return stations.withColumns(
        {
            "total_ports": fx.total(*PORTS),
            "charger_level": fx.first_positive(
                [("dcfc_ports", "DCFC"), ("level2_ports", "Level2")], "Level1"
            ),
            "is_dcfc": fx.flag(F.col("dcfc_ports") > 0),
        }
    )


def exclude_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows known to differ from ``value``; NULL is not known to differ, so it goes too."""
    return df.where(F.col(column) != value)


def in_box(
    df: DataFrame, lat: str, lon: str, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> DataFrame:
    return df.where(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def outside_box(
    df: DataFrame, lat: str, lon: str, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> DataFrame:
    """Rows beyond the box on any side; rows without coordinates are not counted as outside."""
    return df.where(
        (F.col(lat) < lat_range[0])
        | (F.col(lat) > lat_range[1])
        | (F.col(lon) < lon_range[0])
        | (F.col(lon) > lon_range[1])
    )


def all_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(Column.__and__, [F.col(c).isNull() for c in columns]))


def drop_duplicates_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that is last by ``order``; folds before the shuffle, so hot keys are safe."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    last = df.groupBy(*keys).agg(F.max(packed).alias("_row"))
    return last.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def area_km2(df: DataFrame, out: str = "area_km2") -> DataFrame:
    """Land area in km2 from whichever area column the source has."""
    names = set(df.columns)
    if "ALAND_SQMI" in names:
        area = F.col("ALAND_SQMI").try_cast("double") * KM2_PER_SQUARE_MILE
    elif "ALAND" in names:
        raw = F.col("ALAND").try_cast("double")
        in_meters = raw > SQUARE_METERS_PER_KM2
        area = F.when(in_meters, raw / SQUARE_METERS_PER_KM2).otherwise(raw * KM2_PER_SQUARE_MILE)
    elif "AREALAND" in names:
        area = F.col("AREALAND").try_cast("double") / SQUARE_METERS_PER_KM2
    else:
        raise ValueError("no area column: expected ALAND_SQMI, ALAND or AREALAND")
    return df.withColumn(out, area)


def filled_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist and hold any value (one pass, one row to the driver)."""
    present = [c for c in wanted if c in df.columns]
    if not present:
        return []
    counts = df.agg(*[F.count(c).alias(c) for c in present]).first()
    return [c for c in present if counts[c] > 0]
