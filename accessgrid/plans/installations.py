"""Queries on the zone-by-month panel and forecast baselines."""
from __future__ import annotations

from pyspark.sql import functions as F

from accessgrid.operators import evaluation as ev
from accessgrid.operators import panel
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import cleaned_stations, event_panel, rounded
from accessgrid.sources.tables import table
from accessgrid.storage import materialize

TARGET = "ports_trailing_incl_next_12m"
LAGS = "ports_lag_1m ports_lag_3m ports_lag_6m ports_lag_12m ports_cum_to_date"


def monthly_events(spark, sf_dir):
    return rounded(panel.monthly_events(cleaned_stations(spark, sf_dir)))


def zone_month_panel(spark, sf_dir):
    monthly = materialize(panel.monthly_events(cleaned_stations(spark, sf_dir)))
    return rounded(panel.calendar_panel(table(spark, sf_dir, "zones"), monthly))


def panel_lags(spark, sf_dir):
    out = event_panel(spark, sf_dir)
    return rounded(out.select("zone", "month_start", "year_month", "month_num", "year_num", *LAGS.split()))


def forward_sum(spark, sf_dir):
    out = event_panel(spark, sf_dir).select("zone", "month_start", "ports_next_12m")
    return rounded(out.where(F.col("ports_next_12m").isNotNull()))


def trailing_incl_next(spark, sf_dir):
    out = event_panel(spark, sf_dir).select("zone", "month_start", TARGET)
    return rounded(out.where(F.col(TARGET).isNotNull()))


def latest_per_zone(spark, sf_dir):
    out = panel.latest_per_key(
        event_panel(spark, sf_dir), "zone", "month_start", ["ports_cum_to_date", "ports_lag_12m"]
    )
    return rounded(out)


def _split_panel(spark, sf_dir):
    known = event_panel(spark, sf_dir).where(F.col(TARGET).isNotNull())
    return panel.mark_test_period(materialize(known.select("zone", "month_start", TARGET, "ports_lag_12m")))


def temporal_split_counts(spark, sf_dir):
    counts = _split_panel(spark, sf_dir).groupBy("is_test_period")
    return counts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("month_start").alias("first_month"),
        F.max("month_start").alias("last_month"),
    )


def _test_rows(spark, sf_dir):
    return materialize(
        _split_panel(spark, sf_dir).where("is_test_period").select("zone", "month_start", TARGET, "ports_lag_12m")
    )


def forecast_baselines(spark, sf_dir):
    test = _test_rows(spark, sf_dir)
    mean = test.agg(F.avg(TARGET)).scalar()
    persistence = F.coalesce(F.col("ports_lag_12m"), F.lit(0.0))
    with_mean = test.withColumn("_mean", mean)
    out = ev.error_metrics(
        with_mean,
        TARGET,
        {"constant_zero": F.lit(0.0), "constant_mean": F.col("_mean"), "persistence": persistence},
    )
    return rounded(out)


def selected_baseline(spark, sf_dir):
    return ev.better_model(forecast_baselines(spark, sf_dir), "persistence")


def forecast_confusion(spark, sf_dir):
    test = _test_rows(spark, sf_dir).select(
        F.when(F.col(TARGET) >= 1, 1).otherwise(0).alias("y"),
        F.coalesce(F.col("ports_lag_12m"), F.lit(0.0)).alias("forecast"),
    )
    return rounded(ev.confusion(test, "y", "forecast", 0.5))


def target_distribution(spark, sf_dir):
    return rounded(ev.target_distribution(_test_rows(spark, sf_dir), TARGET))


def forecast_spearman(spark, sf_dir):
    test = _test_rows(spark, sf_dir).withColumn("forecast", F.coalesce("ports_lag_12m", F.lit(0.0)))
    return rounded(ev.spearman(test, TARGET, "forecast"))


QUERIES = {
    "monthly_events": monthly_events,
    "zone_month_panel": zone_month_panel,
    "panel_lags": panel_lags,
    "forward_sum": forward_sum,
    "trailing_incl_next": trailing_incl_next,
    "latest_per_zone": latest_per_zone,
    "temporal_split_counts": temporal_split_counts,
    "forecast_baselines": forecast_baselines,
    "selected_baseline": selected_baseline,
    "forecast_confusion": forecast_confusion,
    "target_distribution": target_distribution,
    "forecast_spearman": forecast_spearman,
}

SPLIT = (
    f"(SELECT *, month_start > (SELECT max(month_start) - INTERVAL 12 MONTH FROM [panel_features] WHERE {TARGET} IS NOT NULL) AS is_test_period "
    f"FROM [panel_features] WHERE {TARGET} IS NOT NULL)"
)
TEST = f"(SELECT {TARGET} AS y, coalesce(ports_lag_12m, 0) AS p FROM {SPLIT} WHERE is_test_period)"
BASELINES = (
    "(SELECT 'constant_zero' AS model, avg(abs(y)) AS mae, sqrt(avg(y * y)) AS rmse FROM {t} UNION ALL "
    "SELECT 'constant_mean', avg(abs(y - m)), sqrt(avg((y - m) * (y - m))) FROM (SELECT y, avg(y) OVER () AS m FROM {t}) UNION ALL "
    "SELECT 'persistence', avg(abs(y - p)), sqrt(avg((y - p) * (y - p))) FROM {t})"
).format(t=TEST)

ORACLES = {
    "monthly_events": pick("[monthly]", "zone month_start", "new_ports new_stations"),
    "zone_month_panel": pick("[panel]", "zone month_start", "new_ports new_stations"),
    "panel_lags": pick(
        "(SELECT *, strftime(month_start, '%Y-%m') AS year_month, cast(month(month_start) AS int) AS month_num, "
        "cast(year(month_start) AS int) AS year_num FROM [panel_features])",
        "zone month_start year_month month_num year_num", LAGS,
    ),
    "forward_sum": pick("(SELECT * FROM [panel_features] WHERE ports_next_12m IS NOT NULL)", "zone month_start", "ports_next_12m"),
    "trailing_incl_next": pick(f"(SELECT * FROM [panel_features] WHERE {TARGET} IS NOT NULL)", "zone month_start", TARGET),
    "latest_per_zone": pick(
        "(SELECT * FROM [panel_features] QUALIFY row_number() OVER (PARTITION BY zone ORDER BY month_start DESC) = 1)",
        "zone month_start", "ports_cum_to_date ports_lag_12m",
    ),
    "temporal_split_counts": check(
        f"SELECT is_test_period, count(*) AS n_rows, min(month_start) AS first_month, max(month_start) AS last_month FROM {SPLIT} GROUP BY is_test_period"
    ),
    "forecast_baselines": pick(BASELINES, "model", "mae rmse"),
    "selected_baseline": pick(
        f"(SELECT * FROM {BASELINES} ORDER BY rmse, CASE WHEN model = 'persistence' THEN 0 ELSE 1 END, model LIMIT 1)", "model", "mae rmse"
    ),
    "forecast_confusion": pick(
        "(SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1, "
        "(tp + tn) / (tp + fp + fn + tn) AS accuracy FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS precision, "
        "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS recall FROM (SELECT count(*) FILTER (WHERE y >= 1 AND p >= 0.5) AS tp, "
        "count(*) FILTER (WHERE y < 1 AND p >= 0.5) AS fp, count(*) FILTER (WHERE y >= 1 AND p < 0.5) AS fn, "
        f"count(*) FILTER (WHERE y < 1 AND p < 0.5) AS tn FROM {TEST})))",
        "tp fp fn tn", "precision recall f1 accuracy",
    ),
    "target_distribution": pick(
        "(SELECT avg(CASE WHEN y >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS prevalence, avg(y) AS mean_value, quantile_cont(y, 0.5) AS median_value, "
        f"quantile_cont(y, 0.95) AS p95_value FROM {TEST})",
        "", "prevalence mean_value median_value p95_value",
    ),
    "forecast_spearman": pick(
        "(SELECT corr(ry, rp) AS spearman_rho FROM (SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry, "
        f"rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rp FROM {TEST}))",
        "", "spearman_rho",
    ),
}
