"""Queries that train models, with the operators' full tree counts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.operators import evaluation as ev
from accessgrid.operators import modeling as m
from accessgrid.operators import panel, ranking, siting, splits, zones
from accessgrid.plans import inputs
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import OUT_OF_SCOPE, covered_zones, event_panel, rounded
from accessgrid.plans.scores import split_sql
from accessgrid.sources.tables import table
from accessgrid.storage import materialize

FEATURES = [
    "population", "income", "area_km2", "density", "rural", "elevation_m", "avg_temp_c",
    "avg_precip_mm_day", "state_median_density", "state_median_income", "state_rural_share",
    "state_population", "region_median_density", "region_median_income", "region_rural_share",
    "region_population",
]
PANEL_FEATURES = [
    "ports_lag_1m", "ports_lag_3m", "ports_lag_6m", "ports_lag_12m", "ports_cum_to_date",
    "month_num", "year_num", "population", "income", "density", "rural", "avg_temp_c",
    "avg_precip_mm_day",
]
TARGET = "ports_next_12m"
HOLDOUT_SEED = 7
SIZES = [2, 3]
PRIMARY_SEED = 42


def _in_scope(spark, sf_dir, base):
    """Features of the zones inside the continental scope."""
    weather = zones.weather_by_state(table(spark, sf_dir, "weather_daily"))
    features = zones.zone_features(base, weather, non_continental=OUT_OF_SCOPE)
    return features.where(F.col("is_continental") == 1)


def _modelled(spark, sf_dir):
    features = materialize(_in_scope(spark, sf_dir, covered_zones(spark, sf_dir)))
    return materialize(zones.add_group_statistics(features))


def _accepted(rows):
    """The accepted seeds of both holdout sizes (at most ten rows); an error if there are too few."""
    accepted = materialize(splits.seed_acceptance(rows, "is_desert", SIZES))
    splits.require_seeds(accepted, SIZES)
    return accepted.orderBy("per_region", "seed").collect()


def _held(rows, folds):
    """(fold, state) of the states that each (per_region, seed) holds out."""
    drawn = [
        splits.holdout_states(rows, per_region, seed).select(F.lit(n).alias("fold"), "state")
        for n, (per_region, seed) in enumerate(folds)
    ]
    return materialize(reduce(DataFrame.unionByName, drawn))


def _folds(rows, folds):
    """Models of all folds (per_region, seed), trained together unless the session has them."""
    return m.stored_folds(rows, _held(rows, folds), [seed for _, seed in folds], FEATURES)


def _primary_seed(rows):
    """The primary seed of the larger holdout, else its first accepted one."""
    larger = [a for a in _accepted(rows) if a["per_region"] == max(SIZES)]
    return min(larger, key=lambda a: (a["seed"] != PRIMARY_SEED, a["seed"]))


def _primary(spark, sf_dir):
    """All rows in scope, and models and medians that know the primary fold's inner train rows only."""
    rows = _modelled(spark, sf_dir)
    primary = _primary_seed(rows)
    return rows, _folds(rows, [(primary["per_region"], primary["seed"])])


def _fold_members(rows):
    """Each row with its part in the primary fold: train, validation or test."""
    primary = _primary_seed(rows)
    members = m.fold_members(rows, _held(rows, [(primary["per_region"], primary["seed"])]), 1)
    return rows.join(members.select("zone", "split"), "zone")


def primary_fold(spark, sf_dir):
    return _fold_members(_modelled(spark, sf_dir)).select("zone", "state", "is_desert", "split")


def primary_medians(spark, sf_dir):
    """Medians of the inner train rows, by which all rows are imputed."""
    train = _fold_members(_modelled(spark, sf_dir)).where(F.col("split") == "train")
    return rounded(m.medians(train, FEATURES))


def classifier_scores(spark, sf_dir):
    rows, fold = _primary(spark, sf_dir)
    return fold.score(rows).select("zone", "is_desert", "predicted_prob")


def regressor_scores(spark, sf_dir):
    rows, fold = _primary(spark, sf_dir)
    return fold.score(rows).select("zone", "nearest_miles", "predicted_miles", "residual_miles")


def feature_importance(spark, sf_dir):
    """Mean gain of each feature's splits in the primary fold's classifier."""
    _, folds = _primary(spark, sf_dir)
    return folds.models.importance("classifier 0")


def spatial_fold(spark, sf_dir):
    rows = _modelled(spark, sf_dir)
    return m.spatial_fold(rows, _folds(rows, [(3, HOLDOUT_SEED)]))


def trained_seed_results(spark, sf_dir):
    """Models trained and evaluated anew for each accepted seed of both holdout sizes, all in one pass."""
    rows = _modelled(spark, sf_dir)
    accepted = _accepted(rows)
    folds = _folds(rows, [(a["per_region"], a["seed"]) for a in accepted])
    known = [(n, a["per_region"], a["seed"], a["test_positives"]) for n, a in enumerate(accepted)]
    about = spark.createDataFrame(known, "fold int, per_region int, seed int, test_positives long")
    return about.join(m.fold_test_rows(folds, rows), "fold").drop("fold")


def density_baseline(spark, sf_dir):
    scoped = _modelled(spark, sf_dir)
    scoped = materialize(splits.spatial_scope(scoped, splits.holdout_states(scoped, 3, HOLDOUT_SEED)))
    train, test = (scoped.where(F.col("scope") == s) for s in ("train_side", "test"))
    scored = materialize(m.one_feature_baseline(train, test, "density", "is_desert"))
    return ev.average_precision(scored, "is_desert", "baseline_score")


def _panel(spark, sf_dir):
    static = materialize(_in_scope(spark, sf_dir, table(spark, sf_dir, "zones")))
    wanted = [c for c in PANEL_FEATURES if c in static.columns]
    laid_out = event_panel(spark, sf_dir, static.select("zone"))
    rows = laid_out.join(static.select("zone", "state", "region", *wanted), "zone", "left")
    return panel.mark_test_period(materialize(rows.where(F.col(TARGET).isNotNull())))


def forecast_panel(spark, sf_dir):
    """The rows that forecasts are fitted on and made for."""
    rows = _panel(spark, sf_dir)
    return rounded(rows.select("zone", "month_start", "is_test_period", "ports_lag_1m", "ports_lag_12m", TARGET))


def _forecast(rows, stage):
    out = m.forecast(rows, TARGET, PANEL_FEATURES, stage, "forecast")
    return out.select("zone", "month_start", "state", "region", TARGET, "forecast")


def poisson_forecast(spark, sf_dir):
    return _forecast(_panel(spark, sf_dir), m.poisson)


def _boosted(rows):
    out = m.boosted_forecast(rows, TARGET, PANEL_FEATURES, ["zone", "month_start"], "forecast")
    return out.select("zone", "month_start", "state", "region", TARGET, "forecast")


def boosted_forecast(spark, sf_dir):
    return _boosted(_panel(spark, sf_dir))


def _both_forecasts(spark, sf_dir):
    """The forecasts of both models with their names, and a row of errors for each model."""
    rows = _panel(spark, sf_dir)
    made = {"poisson": materialize(_forecast(rows, m.poisson)), "boosted": materialize(_boosted(rows))}
    errors = [ev.error_metrics(out, TARGET, {name: F.col("forecast")}) for name, out in made.items()]
    named = [out.withColumn("model_choice", F.lit(name)) for name, out in made.items()]
    return reduce(DataFrame.unionByName, named), materialize(reduce(DataFrame.unionByName, errors))


def forecast_selection(spark, sf_dir):
    """Errors of both forecasts and the one with the lower rmse."""
    _, errors = _both_forecasts(spark, sf_dir)
    chosen = ev.better_model(errors, "boosted").select("model", F.lit(True).alias("selected"))
    return rounded(errors.join(chosen, "model", "left").fillna(False, subset=["selected"]))


def chosen_forecast(spark, sf_dir):
    """The test period's forecasts by the model with the lower rmse."""
    made, errors = _both_forecasts(spark, sf_dir)
    return made.where(F.col("model_choice") == ev.better_model(errors, "boosted").select("model").scalar())


def latest_chosen_forecast(spark, sf_dir):
    """The last of those of each zone."""
    kept = ["state", "region", TARGET, "forecast", "model_choice"]
    return panel.latest_per_key(chosen_forecast(spark, sf_dir), "zone", "month_start", kept)


def _predicted_zones(spark, sf_dir):
    """Zones in scope with risk, predicted distance, residual and the latest chosen forecast."""
    rows, fold = _primary(spark, sf_dir)
    scores = fold.score(rows).select("zone", F.col("predicted_prob").alias("score"), "predicted_miles", "residual_miles")
    latest = latest_chosen_forecast(spark, sf_dir).select("zone", "forecast")
    return materialize(rows.drop("score").join(scores, "zone").join(latest, "zone", "left"))


def predicted_candidates(spark, sf_dir):
    """Candidate sites of the zones that the trained models or their distance call for."""
    return rounded(inputs.candidates(_predicted_zones(spark, sf_dir)))


def predicted_top_n(spark, sf_dir):
    """Top-N sites with scores from the models' tables."""
    known = _predicted_zones(spark, sf_dir)
    coverage = siting.candidate_coverage(inputs.candidates(known), known)
    scored = materialize(siting.score_candidates(coverage))
    ranked = ranking.top_n_scenarios(scored, "composite_score", "candidate_id", k.TOP_N_SCENARIOS)
    return rounded(ranked.select("candidate_id", "scenario_top_n", "selection_order", "region", "composite_score"))


def model_agreement(spark, sf_dir):
    rows, fold = _primary(spark, sf_dir)
    return ev.agreement(fold.score(rows), "predicted_prob", "predicted_miles", k.RISK_THRESHOLD, k.DESERT_MILES)


QUERIES = {
    "primary_fold": primary_fold,
    "primary_medians": primary_medians,
    "classifier_scores": classifier_scores,
    "regressor_scores": regressor_scores,
    "feature_importance": feature_importance,
    "spatial_fold": spatial_fold,
    "trained_seed_results": trained_seed_results,
    "density_baseline": density_baseline,
    "forecast_panel": forecast_panel,
    "poisson_forecast": poisson_forecast,
    "boosted_forecast": boosted_forecast,
    "forecast_selection": forecast_selection,
    "chosen_forecast": chosen_forecast,
    "latest_chosen_forecast": latest_chosen_forecast,
    "predicted_candidates": predicted_candidates,
    "predicted_top_n": predicted_top_n,
    "model_agreement": model_agreement,
}

_SCOPED = f"(SELECT * FROM [covered] WHERE state NOT IN ({', '.join(repr(s) for s in OUT_OF_SCOPE)}))"
# The larger holdout drawn on the zones in scope, as [seed_draw] does on all.
_DRAWN = f"""(SELECT g.seed, s.*, row_number() OVER (PARTITION BY g.seed, region ORDER BY md5(concat(state, ':', cast(g.seed AS varchar))), state) AS n
 FROM (SELECT region, state, sum(CASE WHEN is_desert = 1 THEN 1 ELSE 0 END) AS positives FROM {_SCOPED} GROUP BY region, state) s,
      (SELECT unnest(range({splits.MAX_SEEDS})) AS seed) g)"""
_SEEDS = f"""(SELECT seed FROM {_DRAWN} WHERE n <= {max(SIZES)} GROUP BY seed
 HAVING sum(positives) >= {splits.MIN_POSITIVES} ORDER BY seed LIMIT {splits.WANTED_SEEDS})"""
_SEED = f"(SELECT seed FROM {_SEEDS} ORDER BY seed <> {PRIMARY_SEED}, seed LIMIT 1)"
_HELD = f"(SELECT state FROM {_DRAWN} WHERE n <= {max(SIZES)} AND seed = {_SEED})"
_FOLD = (
    f"(SELECT zone, state, is_desert, split FROM {split_sql(f'(SELECT * FROM {_SCOPED} WHERE state NOT IN {_HELD})', 0)} "
    f"UNION ALL SELECT zone, state, is_desert, 'test' FROM {_SCOPED} WHERE state IN {_HELD})"
)


def _medians_sql() -> str:
    """Group statistics are of all zones in scope, medians of the train rows alone."""
    scoped = f"(SELECT z.*, w.avg_temp_c, w.avg_precip_mm_day FROM [zone_features] z LEFT JOIN [weather] w USING (state) WHERE zone IN (SELECT zone FROM {_SCOPED}))"
    stats = [
        f"(SELECT {key}, quantile_cont(density, 0.5) AS {key}_median_density, quantile_cont(income, 0.5) AS {key}_median_income, "
        f"avg(rural) AS {key}_rural_share, coalesce(sum(population), 0) AS {key}_population FROM {scoped} GROUP BY {key})"
        for key in ("state", "region")
    ]
    rows = f"(SELECT * FROM {scoped} JOIN {stats[0]} USING (state) JOIN {stats[1]} USING (region) WHERE zone IN (SELECT zone FROM {_FOLD} WHERE split = 'train'))"
    each = [f"SELECT '{c}' AS column_name, round(quantile_cont(cast({c} AS double), 0.5), 6) + 0.0 AS median FROM {rows}" for c in FEATURES]
    return check(" UNION ALL ".join(each))


# What models predict depends on the engine that trains them; what they are given does not.
ORACLES = {
    "primary_fold": check(f"SELECT * FROM {_FOLD}"),
    "primary_medians": _medians_sql(),
    "forecast_panel": pick(
        "(SELECT *, month_start > (SELECT max(month_start) FROM [panel_features] WHERE ports_next_12m IS NOT NULL) - INTERVAL 12 MONTH AS is_test_period "
        f"FROM [panel_features] WHERE ports_next_12m IS NOT NULL AND zone IN (SELECT zone FROM {_SCOPED}))",
        "zone month_start is_test_period", f"ports_lag_1m ports_lag_12m {TARGET}",
    ),
}
