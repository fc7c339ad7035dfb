"""Queries on candidate sites: coverage, scores, Top-N and weight sensitivity."""
from __future__ import annotations

from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.operators import ranking, reports, siting
from accessgrid.operators.spatial import pairs_within
from accessgrid.plans import inputs
from accessgrid.plans.checks import check, miles, pick
from accessgrid.plans.inputs import rounded, scored_candidates, scored_zones
from accessgrid.sources.tables import table

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
COVERAGE_COLUMNS = (
    "population_covered distance_reduction mean_neighbor_miles equity_weight avg_forecast "
    "market_gap_raw weather_weight log_population"
)
SCORE_COLUMNS = (
    "reduction_per_zone log_population_norm distance_reduction_norm mean_neighbor_miles_norm "
    "equity_weight_norm market_gap_pct score_without_market composite_score"
)


def zones_within_radius(spark, sf_dir):
    """Zones within 25 miles of each site."""
    sites = table(spark, sf_dir, "sites")
    return rounded(pairs_within(sites, table(spark, sf_dir, "zones"), k.COVERAGE_MILES, "site_id", "zone"))


def candidates(spark, sf_dir):
    return rounded(inputs.candidates(scored_zones(spark, sf_dir)))


def radius_coverage(spark, sf_dir):
    zones = scored_zones(spark, sf_dir)
    out = siting.candidate_coverage(inputs.candidates(zones), zones)
    return rounded(out.select("candidate_id", "covered_zones", *COVERAGE_COLUMNS.split()))


def site_scores(spark, sf_dir):
    _, _, scored = scored_candidates(spark, sf_dir)
    return rounded(scored.select("candidate_id", "parent_zone", "region", *SCORE_COLUMNS.split()))


def _ranked(spark, sf_dir):
    zones, cands, scored = scored_candidates(spark, sf_dir)
    return zones, cands, ranking.top_n_scenarios(scored, "composite_score", "candidate_id", k.TOP_N_SCENARIOS)


def top_n_sites(spark, sf_dir):
    _, _, ranked = _ranked(spark, sf_dir)
    return rounded(ranked.select("candidate_id", "scenario_top_n", "selection_order", "region", "composite_score"))


def top_500_sites(spark, sf_dir):
    _, _, ranked = _ranked(spark, sf_dir)
    as_text = ranked.withColumn("scenario_top_n", F.col("scenario_top_n").cast("string"))
    return siting.scenario(as_text, 500).select("candidate_id", "selection_order")


def topn_checks(spark, sf_dir):
    _, _, ranked = _ranked(spark, sf_dir)
    return siting.scenario_checks(ranked)


def topn_by_region(spark, sf_dir):
    _, cands, ranked = _ranked(spark, sf_dir)
    return siting.scenario_regions(ranked, cands)


def ranking_sensitivity(spark, sf_dir):
    _, _, scored = scored_candidates(spark, sf_dir)
    return siting.ranking_sensitivity(scored)


def weight_grid(spark, sf_dir):
    _, _, scored = scored_candidates(spark, sf_dir)
    return siting.weight_grid(scored, k.WEIGHT_GRID, REGIONS)


def additionality(spark, sf_dir):
    out = reports.additionality(scored_zones(spark, sf_dir), "score", "forecast", k.RISK_THRESHOLD)
    return rounded(out.select("zone", "region", "score", "forecast", "additionality_flag"))


def forecast_clipped(spark, sf_dir):
    out = reports.capped(scored_zones(spark, sf_dir), "forecast", "forecast_clipped")
    return rounded(out.select("zone", "forecast", "forecast_clipped"))


def regional_priority(spark, sf_dir):
    zones, _, ranked = _ranked(spark, sf_dir)
    sites = siting.scenario(ranked, 100)
    out = reports.regional_priority(zones, sites, "is_desert", "score", "residual_miles", k.RISK_THRESHOLD)
    return rounded(out)


def kpi_row(spark, sf_dir):
    zones, _, ranked = _ranked(spark, sf_dir)
    return reports.kpi_row(zones, "is_desert", "score", k.RISK_THRESHOLD, ranked)


QUERIES = {
    "zones_within_radius": zones_within_radius,
    "candidates": candidates,
    "radius_coverage": radius_coverage,
    "site_scores": site_scores,
    "top_n_sites": top_n_sites,
    "top_500_sites": top_500_sites,
    "topn_checks": topn_checks,
    "topn_by_region": topn_by_region,
    "ranking_sensitivity": ranking_sensitivity,
    "weight_grid": weight_grid,
    "additionality": additionality,
    "forecast_clipped": forecast_clipped,
    "regional_priority": regional_priority,
    "kpi_row": kpi_row,
}


def _sensitivity_sql() -> str:
    base = (
        "(SELECT *, (rank() OVER (ORDER BY reduction_per_zone) + (count(*) OVER (PARTITION BY reduction_per_zone) - 1) / 2.0::DOUBLE) "
        "/ count(*) OVER () AS reduction_rank FROM [site_scores])"
    )
    scores = {"current": "composite_score"}
    for name, weights in siting.sensitivity_weightings().items():
        scores[name] = " + ".join(f"{w}::DOUBLE * {c}" for c, w in weights.items())
    parts = [
        f"SELECT '{name}' AS weighting, region, count(*) AS n_sites FROM (SELECT candidate_id, region FROM {base} "
        f"ORDER BY {score} DESC, candidate_id LIMIT 100) GROUP BY region"
        for name, score in scores.items()
    ]
    return check(" UNION ALL ".join(parts))


def _grid_sql() -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE region = '{r}') AS {siting.column_name(r)}" for r in REGIONS
    )
    parts = []
    for i, (g, n, p, e) in enumerate(k.WEIGHT_GRID):
        score = (
            f"{g}::DOUBLE * distance_reduction_norm + {n}::DOUBLE * mean_neighbor_miles_norm + {p}::DOUBLE * log_population_norm "
            f"+ {e}::DOUBLE * equity_weight_norm + {k.SCORE_WEIGHTS['market']}::DOUBLE * market_gap_pct"
        )
        parts.append(
            f"SELECT cast({i} AS int) AS grid_no, {g}::DOUBLE AS w_gap, {n}::DOUBLE AS w_need, {p}::DOUBLE AS w_pop, {e}::DOUBLE AS w_equity, {counts} "
            f"FROM (SELECT candidate_id, region FROM [site_scores] ORDER BY {score} DESC, candidate_id LIMIT 100) HAVING count(*) > 0"
        )
    return check(" UNION ALL ".join(parts))


ORACLES = {
    "zones_within_radius": pick(
        f"(SELECT site_id, zone, d AS miles FROM (SELECT s.site_id, z.zone, {miles('s', 'z')} AS d FROM [sites] s, [zones] z) WHERE d <= 25)",
        "site_id zone", "miles",
    ),
    "candidates": pick(
        "[candidates]", "candidate_id candidate_type rank_hint parent_zone state region is_desert",
        "lat lon score residual_miles population income",
    ),
    "radius_coverage": pick("[site_coverage]", "candidate_id covered_zones", COVERAGE_COLUMNS),
    "site_scores": pick("[site_scores]", "candidate_id parent_zone region", SCORE_COLUMNS),
    "top_n_sites": pick("[ranked_sites]", "candidate_id scenario_top_n selection_order region", "composite_score"),
    "top_500_sites": check("SELECT candidate_id, selection_order FROM [ranked_sites] WHERE scenario_top_n = 500"),
    "topn_checks": check(
        "SELECT scenario_top_n, count(*) AS n_rows, count(DISTINCT candidate_id) AS n_ids, "
        "count(DISTINCT (lat, lon)) AS n_places FROM [ranked_sites] GROUP BY scenario_top_n"
    ),
    "topn_by_region": check(
        "SELECT scenario_top_n, region AS site_region, count(*) AS n_sites FROM [ranked_sites] GROUP BY scenario_top_n, region"
    ),
    "ranking_sensitivity": _sensitivity_sql(),
    "weight_grid": _grid_sql(),
    "additionality": pick(
        "(SELECT *, CASE WHEN score >= 0.5 AND forecast <= (SELECT quantile_cont(forecast, 0.25) FROM [scored_zones]) "
        "THEN 1 ELSE 0 END AS additionality_flag FROM [scored_zones])",
        "zone region additionality_flag", "score forecast",
    ),
    "forecast_clipped": pick(
        "(SELECT zone, forecast, least(forecast, (SELECT quantile_cont(forecast, 0.95) FROM [scored_zones])) AS forecast_clipped FROM [scored_zones])",
        "zone", "forecast forecast_clipped",
    ),
    "regional_priority": pick(
        "(SELECT r.*, actual_deserts / zones AS actual_rate, model_flagged / zones AS flagged_rate, priority_zones / zones AS priority_rate, "
        "coalesce(s.recommended_sites, 0) AS recommended_sites FROM ("
        "SELECT region, count(*) AS zones, cast(coalesce(sum(is_desert), 0) AS bigint) AS actual_deserts, "
        "count(*) FILTER (WHERE score >= 0.5) AS model_flagged, count(*) FILTER (WHERE score >= 0.5 AND residual_miles >= "
        "(SELECT quantile_cont(residual_miles, 0.9) FROM [scored_zones])) AS priority_zones, avg(score) AS avg_risk FROM [scored_zones] GROUP BY region) r "
        "LEFT JOIN (SELECT z.region, count(*) AS recommended_sites FROM [ranked_sites] t JOIN [scored_zones] z ON z.zone = t.parent_zone "
        "WHERE scenario_top_n = 100 GROUP BY z.region) s USING (region))",
        "region zones actual_deserts model_flagged priority_zones recommended_sites",
        "avg_risk actual_rate flagged_rate priority_rate",
    ),
    "kpi_row": check(
        "SELECT count(*) AS zones, cast(sum(is_desert) AS bigint) AS deserts, count(*) FILTER (WHERE score >= 0.5) AS high_risk, "
        "(SELECT count(DISTINCT candidate_id) FROM [ranked_sites]) AS sites_scored FROM [scored_zones]"
    ),
}
