"""Grouped, pivoted and share reports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx
from accessgrid.functions.constants import (
    ADEQUATE_LABEL,
    DESERT_LABEL,
    INCOME_BANDS,
    UNKNOWN_LABEL,
)
from accessgrid.operators.lookup import lookup_few
from accessgrid.operators.ranking import exact_quantiles

STATUSES = [DESERT_LABEL, ADEQUATE_LABEL, UNKNOWN_LABEL]


def count_report(df: DataFrame, keys: list[str], measure: str = "total_ports") -> DataFrame:
    """Rows and the sum of a measure per key, most rows first; rows without a key are left out."""
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("station_count"), F.sum(measure).alias(measure))
        .orderBy(F.col("station_count").desc(), *keys)
    )


def add_share(report: DataFrame, count: str, out: str) -> DataFrame:
    """Percent of the column's total over a finished report."""
    whole = report.agg(F.sum(count)).scalar()
    return report.withColumn(out, F.round(F.col(count) / whole * 100, 2))


def distance_summary(df: DataFrame, miles: str) -> DataFrame:
    """Minimum, mean, maximum, exact median and 90th percentile."""
    ends = df.agg(
        F.struct(F.min(miles).alias("lo"), F.avg(miles).alias("mean"), F.max(miles).alias("hi")).alias("s")
    )
    spread = exact_quantiles(df, miles, {"median_miles": 0.5, "p90_miles": 0.9})
    return spread.withColumn("s", ends.scalar()).select(
        F.col("s.lo").alias("min_miles"),
        F.col("s.mean").alias("avg_miles"),
        F.col("s.hi").alias("max_miles"),
        "median_miles",
        "p90_miles",
    )


def approximate_distance_summary(df: DataFrame, miles: str) -> DataFrame:
    """The same with sketch quantiles, in one pass."""
    return df.agg(
        F.min(miles).alias("min_miles"),
        F.avg(miles).alias("avg_miles"),
        F.max(miles).alias("max_miles"),
        F.percentile_approx(miles, 0.5).alias("median_miles"),
        F.percentile_approx(miles, 0.9).alias("p90_miles"),
    )


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    """One row: total, deserts, adequate, unknown and the percent of deserts."""
    n = F.count(F.lit(1))
    deserts = F.count(F.when(F.col(flag) == 1, 1))
    return df.agg(
        n.alias("total"),
        deserts.alias("deserts"),
        F.count(F.when(F.col(flag) == 0, 1)).alias("adequate"),
        F.count(F.when(F.col(flag).isNull(), 1)).alias("unknown"),
        F.when(n > 0, deserts / n * 100).alias("desert_percent"),
    )


def flag_share_by(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Flagged rows, rows and the flagged percent per known key, highest first."""
    out = df.where(F.col(key).isNotNull()).groupBy(key)
    out = out.agg(
        F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0)).alias("desert_zones"),
        F.count(F.lit(1)).alias("total_zones"),
    )
    out = out.withColumn("desert_percent", F.col("desert_zones") / F.col("total_zones") * 100)
    return out.orderBy(F.col("desert_percent").desc(), key)


def status_pivot(df: DataFrame, key: str, status: str = "coverage_status") -> DataFrame:
    """A column per status (absent ones zero), the labelled total and the desert percent."""
    wide = df.dropna(subset=[key, status]).groupBy(key).pivot(status, STATUSES)
    wide = wide.agg(F.count(F.lit(1))).fillna(0, subset=STATUSES)
    wide = wide.withColumnsRenamed(
        {DESERT_LABEL: "desert_count", ADEQUATE_LABEL: "adequate_count", UNKNOWN_LABEL: "unknown_count"}
    )
    both = F.col("desert_count") + F.col("adequate_count")
    share = F.when(both > 0, F.col("desert_count") / both * 100)
    return wide.withColumn("total_areas", both).withColumn("desert_percent", share)


def status_long(pivoted: DataFrame, key: str) -> DataFrame:
    return pivoted.unpivot(
        [key, "total_areas", "desert_percent"],
        ["desert_count", "adequate_count"],
        "coverage_status",
        "area_count",
    )


def banded_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows per income band; every band is listed."""
    # One row per band whether or not any row falls into it: a handful of output rows.
    per_band = df.groupBy(fx.income_band(F.col(value)).alias("income_band"))
    per_band = per_band.agg(F.count(F.lit(1)).alias("n"))
    labels = [label for label, _ in INCOME_BANDS] + [UNKNOWN_LABEL]
    bands = df.sparkSession.createDataFrame([(x,) for x in labels], "income_band string")
    listed = bands.join(per_band, "income_band", "left")
    return listed.select("income_band", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def kpi_row(df: DataFrame, flag: str, score: str, threshold: float, sites: DataFrame) -> DataFrame:
    row = df.agg(
        F.count(F.lit(1)).alias("zones"),
        F.sum(F.col(flag).cast("bigint")).alias("deserts"),
        F.count(F.when(F.col(score) >= threshold, 1)).alias("high_risk"),
    )
    return row.withColumn("sites_scored", sites.agg(F.countDistinct("candidate_id")).scalar())


def flag_rates(df: DataFrame, key: str, flag: str, score: str, threshold: float) -> DataFrame:
    """Actual and flagged rate per key, one row per key and metric."""
    n = F.count(F.lit(1))
    rates = df.groupBy(key).agg(
        (F.sum(F.col(flag).cast("bigint")) / n).alias("actual_rate"),
        (F.count(F.when(F.col(score) >= threshold, 1)) / n).alias("flagged_rate"),
    )
    return rates.unpivot([key], ["actual_rate", "flagged_rate"], "metric", "rate")


def additionality(df: DataFrame, score: str, forecast: str, threshold: float, p: float = 0.25) -> DataFrame:
    """Flag for high risk where little is forecast (at most the p-quantile)."""
    cut = exact_quantiles(df, forecast, {"q": p}).scalar()
    both = (F.col(score) >= threshold) & (F.col(forecast) <= cut)
    return df.withColumn("additionality_flag", fx.flag(both))


def capped(df: DataFrame, value: str, out: str, p: float = 0.95) -> DataFrame:
    """Value cut off at its p-quantile."""
    cut = exact_quantiles(df, value, {"q": p}).scalar()
    return df.withColumn(out, fx.clip(F.col(value), high=cut))


def regional_priority(
    df: DataFrame,
    sites: DataFrame,
    flag: str,
    score: str,
    residual: str,
    threshold: float,
) -> DataFrame:
    """Counts, rates, mean risk and recommended sites per region, most urgent first."""
    cut = exact_quantiles(df, residual, {"q": 0.9}).scalar()
    flagged = F.col(score) >= threshold
    n = F.count(F.lit(1))

    def counted(test: Column) -> Column:
        return F.count(F.when(test, 1))

    deserts = F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0))
    marked = df.withColumn("_urgent", flagged & (F.col(residual) >= cut))
    out = marked.groupBy("region").agg(
        n.alias("zones"),
        deserts.alias("actual_deserts"),
        counted(flagged).alias("model_flagged"),
        counted(F.col("_urgent")).alias("priority_zones"),
        F.avg(score).alias("avg_risk"),
        (deserts / n).alias("actual_rate"),
        (counted(flagged) / n).alias("flagged_rate"),
        (counted(F.col("_urgent")) / n).alias("priority_rate"),
    )
    parents = df.select(F.col("zone").alias("parent_zone"), F.col("region").alias("_site_region"))
    per_region = lookup_few(sites.select("parent_zone"), parents, "parent_zone")
    per_region = per_region.groupBy(F.col("_site_region").alias("region"))
    per_region = per_region.agg(F.count(F.lit(1)).alias("recommended_sites"))
    out = out.join(per_region, "region", "left").fillna(0, subset=["recommended_sites"])
    return out.orderBy(
        F.col("priority_zones").desc(), F.col("actual_deserts").desc(), F.col("avg_risk").desc()
    )


def missed_by(df: DataFrame, key: str, flag: str, score: str, threshold: float) -> DataFrame:
    """Missed positives and the miss rate per key."""
    actual = F.count(F.when(F.col(flag) == 1, 1))
    missed = F.count(F.when((F.col(flag) == 1) & (F.col(score) < threshold), 1))
    return df.groupBy(key).agg(
        actual.alias("actual"),
        missed.alias("missed"),
        fx.ratio_or_zero(missed, actual).alias("miss_rate"),
    )
