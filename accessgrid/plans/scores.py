"""Queries that evaluate scores: curves, thresholds, holdouts, seeds, baselines."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.functions import scalars as fx
from accessgrid.operators import evaluation as ev
from accessgrid.operators import ranking, reports, splits
from accessgrid.plans.checks import check, pick
from accessgrid.plans.inputs import covered_zones, rounded
from accessgrid.sources import readers
from accessgrid.sources.tables import table
from accessgrid.storage import materialize, shared_folder

SIZES = [2, 3]
RULE_REGION = "AMERICA"
TARGET_RECALL = 0.8


def _scored(spark, sf_dir):
    return table(spark, sf_dir, "labels_scored")


def _zones(spark, sf_dir):
    base = covered_zones(spark, sf_dir).withColumn("predicted_miles", F.col("elevation_m") / 30)
    return materialize(base.select("zone", "state", "region", "income", "score", "is_desert", "nearest_miles", "predicted_miles"))


def average_precision(spark, sf_dir):
    return rounded(ev.average_precision(_scored(spark, sf_dir), "y", "score"))


def average_precision_by_region(spark, sf_dir):
    return rounded(ev.average_precision(_scored(spark, sf_dir), "y", "score", ["region"]))


def roc_auc(spark, sf_dir):
    return rounded(ev.roc_auc(_scored(spark, sf_dir), "y", "score"))


def precision_at_recall(spark, sf_dir):
    return rounded(ev.precision_at_recall(_scored(spark, sf_dir), "y", "score", TARGET_RECALL))


def confusion(spark, sf_dir):
    return rounded(ev.confusion(_scored(spark, sf_dir), "y", "score", k.RISK_THRESHOLD))


def threshold_sweep(spark, sf_dir):
    return rounded(ev.threshold_sweep(_scored(spark, sf_dir), "y", "score", k.SWEEP_THRESHOLDS))


def threshold_recommendation(spark, sf_dir):
    return rounded(ev.recommend_threshold(_scored(spark, sf_dir), "y", "score", TARGET_RECALL))


def average_rank(spark, sf_dir):
    out = ranking.average_rank(_scored(spark, sf_dir), "score", "score_pct", ["region"])
    return rounded(out.select("doc_id", "region", "score", "score_pct"))


def holdout_states(spark, sf_dir):
    return splits.holdout_states(table(spark, sf_dir, "zones"), 3, 7)


def scope_label(spark, sf_dir):
    base = table(spark, sf_dir, "zones")
    out = splits.spatial_scope(base, splits.holdout_states(base, 3, 7))
    return out.select("zone", "state", "scope")


def validation_split(spark, sf_dir):
    out = splits.stratified_split(_zones(spark, sf_dir), "zone", "is_desert", seed=42)
    return out.select("zone", "is_desert", "split")


def split_summary(spark, sf_dir):
    return splits.split_summary(_zones(spark, sf_dir), "zone", "is_desert", 3, 7)


def seed_acceptance(spark, sf_dir):
    return splits.seed_acceptance(_zones(spark, sf_dir), "is_desert", SIZES)


def _seed_results(spark, sf_dir):
    """Each accepted seed evaluated on the rows of its held-out states."""
    zones = _zones(spark, sf_dir)
    accepted = materialize(splits.seed_acceptance(zones, "is_desert", SIZES))
    # At most five seeds of two sizes: every row meets at most ten of them.
    held = accepted.select("per_region", "seed", F.explode(F.split("test_states", ", ")).alias("state"))
    rows = zones.join(held, "state").select("per_region", "seed", "score", "is_desert")
    rows = materialize(rows)
    keys = ["per_region", "seed"]
    curve = ev.average_precision(rows, "is_desert", "score", keys, out="pr_auc")
    y, hit = F.col("is_desert") == 1, F.col("score") >= k.RISK_THRESHOLD
    tp, fp, fn = (F.count(F.when(t, 1)) for t in (y & hit, ~y & hit, y & ~hit))
    half = rows.groupBy(*keys).agg(
        fx.ratio_or_zero(tp, tp + fp).alias("precision_at_half"),
        fx.ratio_or_zero(tp, tp + fn).alias("recall_at_half"),
    )
    return accepted.drop("accepted_no").join(curve, keys).join(half, keys)


def seed_results(spark, sf_dir):
    return rounded(_seed_results(spark, sf_dir))


def seed_summary(spark, sf_dir):
    out = splits.seed_summary(_seed_results(spark, sf_dir), ["pr_auc", "precision_at_half", "recall_at_half"])
    return rounded(out)


def metrics_flatten(spark, sf_dir):
    """Seed results written as one nested document, read back and flattened."""
    path = f"{shared_folder(spark)}/accessgrid/metrics-{uuid.uuid4().hex}"
    results = _seed_results(spark, sf_dir).withColumn("test_states", F.split("test_states", ", "))
    per_seed = F.struct("seed", "test_states", "test_positives", "pr_auc")
    # At most five accepted seeds per holdout size.
    configs = results.groupBy("per_region").agg(F.array_sort(F.collect_list(per_seed)).alias("seeds"))
    document = configs.agg(F.collect_list(F.struct("per_region", "seeds")).alias("configurations"))
    readers.write_metrics(document, path)
    return rounded(readers.seed_rows(readers.read_metrics(spark, path)))


def holdout_comparison(spark, sf_dir):
    return rounded(readers.holdout_comparison(_seed_results(spark, sf_dir)))


def rule_baselines(spark, sf_dir):
    """Average precision of a constant and of a one-region rule on the held-out states."""
    zones = _zones(spark, sf_dir)
    test = splits.spatial_scope(zones, splits.holdout_states(zones, 3, 7)).where(F.col("scope") == "test")
    test = materialize(test)
    prevalence = test.agg(F.avg(F.col("is_desert").cast("double"))).scalar()
    constant = test.withColumn("rule_score", prevalence)
    rule = test.withColumn("rule_score", fx.flag(F.col("region") == RULE_REGION).cast("double"))
    parts = [
        ev.average_precision(df, "is_desert", "rule_score").withColumn("model", F.lit(name))
        for name, df in (("constant_prevalence", constant), ("one_region", rule))
    ]
    return rounded(parts[0].unionByName(parts[1]))


def agreement(spark, sf_dir):
    out = ev.agreement(_zones(spark, sf_dir), "score", "predicted_miles", k.RISK_THRESHOLD, k.DESERT_MILES)
    return rounded(out)


def mae_rmse(spark, sf_dir):
    zones = _zones(spark, sf_dir)
    return rounded(ev.error_metrics(zones, "nearest_miles", {"by_elevation": F.col("predicted_miles")}))


def spearman(spark, sf_dir):
    return rounded(ev.spearman(_zones(spark, sf_dir), "nearest_miles", "predicted_miles"))


def flag_rates_long(spark, sf_dir):
    return rounded(reports.flag_rates(_zones(spark, sf_dir), "region", "is_desert", "score", k.RISK_THRESHOLD))


def missed_profile(spark, sf_dir):
    return rounded(reports.missed_by(_zones(spark, sf_dir), "region", "is_desert", "score", k.RISK_THRESHOLD))


def missed_by_income(spark, sf_dir):
    missed = _zones(spark, sf_dir).where((F.col("is_desert") == 1) & (F.col("score") < k.RISK_THRESHOLD))
    return reports.banded_counts(missed, "income")


def score_labels(spark, sf_dir):
    """Counts and rates as text, the way reports print them."""
    zones = _zones(spark, sf_dir).groupBy("region")
    n, rate = F.count(F.lit(1)), F.avg(F.col("is_desert").cast("double"))
    return zones.agg(fx.count_label(n).alias("zones_text"), fx.decimals(rate, 1).alias("rate_text"))


QUERIES = {
    "average_precision": average_precision,
    "average_precision_by_region": average_precision_by_region,
    "roc_auc": roc_auc,
    "precision_at_recall": precision_at_recall,
    "confusion": confusion,
    "threshold_sweep": threshold_sweep,
    "threshold_recommendation": threshold_recommendation,
    "average_rank": average_rank,
    "holdout_states": holdout_states,
    "scope_label": scope_label,
    "validation_split": validation_split,
    "split_summary": split_summary,
    "seed_acceptance": seed_acceptance,
    "seed_results": seed_results,
    "seed_summary": seed_summary,
    "metrics_flatten": metrics_flatten,
    "holdout_comparison": holdout_comparison,
    "rule_baselines": rule_baselines,
    "agreement": agreement,
    "mae_rmse": mae_rmse,
    "spearman": spearman,
    "flag_rates_long": flag_rates_long,
    "missed_profile": missed_profile,
    "missed_by_income": missed_by_income,
    "score_labels": score_labels,
}

RATIOS = (
    "(SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1, "
    "(tp + tn) / (tp + fp + fn + tn) AS accuracy FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS precision, "
    "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS recall FROM (SELECT threshold, "
    "count(*) FILTER (WHERE y = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND score >= threshold) AS fp, "
    "count(*) FILTER (WHERE y = 1 AND score < threshold) AS fn, count(*) FILTER (WHERE y = 0 AND score < threshold) AS tn "
    "FROM [labels_scored], (SELECT unnest([{grid}])::DOUBLE AS threshold) GROUP BY threshold)))"
)
_GRID = ", ".join(str(round(0.1 + i * 0.01, 4)) for i in range(81))
_DRAW = (
    "(SELECT region, state, row_number() OVER (PARTITION BY region ORDER BY md5(concat(state, ':7')), state) AS n "
    "FROM (SELECT DISTINCT region, state FROM [zones]))"
)
_HELD = f"(SELECT region, state FROM {_DRAW} WHERE n <= 3)"


def split_sql(source: str, seed: int) -> str:
    return (
        "(SELECT zone, state, is_desert, CASE WHEN row_number() OVER (PARTITION BY is_desert ORDER BY md5(concat(zone, ':"
        f"{seed}')), zone) <= floor(0.2::DOUBLE * count(*) OVER (PARTITION BY is_desert) + 0.5) THEN 'validation' ELSE 'train' END AS split FROM {source})"
    )


def _curve_sql(source: str, label: str, score: str) -> str:
    return (
        "(SELECT coalesce(sum(pos / all_pos * (cum_pos / cum_n)), 0.0::DOUBLE) AS average_precision FROM (SELECT *, "
        "sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER () AS all_pos FROM ("
        f"SELECT {score} AS s, sum({label}) AS pos, count(*) AS n FROM {source} GROUP BY 1) "
        "WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"
    )


_TEST = f"(SELECT * FROM [covered] WHERE state IN (SELECT state FROM {_HELD}))"
_SEED_PLAIN = "per_region seed test_states test_positives test_rows"

ORACLES = {
    "average_precision": pick(
        "(SELECT sum(pos / all_pos * (cum_pos / cum_n)) AS average_precision FROM [curve])", "", "average_precision"
    ),
    "average_precision_by_region": pick(
        "(SELECT region, coalesce(sum(CASE WHEN all_pos > 0 THEN pos / all_pos * (cum_pos / cum_n) END), 0.0::DOUBLE) AS average_precision "
        "FROM (SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER (PARTITION BY region) AS all_pos FROM ("
        "SELECT region, score, sum(y) AS pos, count(*) AS n FROM [labels_scored] GROUP BY region, score) "
        "WINDOW w AS (PARTITION BY region ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY region)",
        "region", "average_precision",
    ),
    "roc_auc": pick(
        "(SELECT avg(CASE WHEN p.score > n.score THEN 1.0::DOUBLE WHEN p.score = n.score THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS roc_auc "
        "FROM [labels_scored] p, [labels_scored] n WHERE p.y = 1 AND n.y = 0)",
        "", "roc_auc",
    ),
    "precision_at_recall": pick(
        f"(SELECT max(cum_pos / cum_n) AS best_precision FROM [curve] WHERE cum_pos / all_pos >= {TARGET_RECALL})", "", "best_precision"
    ),
    "confusion": pick(RATIOS.format(grid=k.RISK_THRESHOLD), "tp fp fn tn", "precision recall f1 accuracy"),
    "threshold_sweep": pick(
        RATIOS.format(grid=", ".join(map(str, k.SWEEP_THRESHOLDS))), "threshold tp fp fn tn", "precision recall f1 accuracy"
    ),
    "threshold_recommendation": pick(
        f"(SELECT *, recall >= {TARGET_RECALL} AS feasible FROM {RATIOS.format(grid=_GRID)} "
        f"ORDER BY recall >= {TARGET_RECALL} DESC, CASE WHEN recall >= {TARGET_RECALL} THEN precision ELSE recall END DESC, "
        f"CASE WHEN recall >= {TARGET_RECALL} THEN f1 ELSE precision END DESC, "
        f"CASE WHEN recall >= {TARGET_RECALL} THEN threshold ELSE f1 END DESC, threshold LIMIT 1)",
        "threshold tp fp fn tn feasible", "precision recall f1 accuracy",
    ),
    "average_rank": pick(
        "(SELECT doc_id, region, score, (rank() OVER (PARTITION BY region ORDER BY score) + (count(*) OVER (PARTITION BY region, score) - 1) / 2) "
        "/ count(*) OVER (PARTITION BY region) AS score_pct FROM [labels_scored])",
        "doc_id region", "score score_pct",
    ),
    "holdout_states": check(f"SELECT region, state FROM {_HELD}"),
    "scope_label": check(
        f"SELECT zone, state, CASE WHEN state IN (SELECT state FROM {_HELD}) THEN 'test' ELSE 'train_side' END AS scope FROM [zones]"
    ),
    "validation_split": check(f"SELECT zone, is_desert, split FROM {split_sql('[covered]', 42)}"),
    "split_summary": check(
        "SELECT split, count(*) AS n_rows, count(DISTINCT state) AS n_states FROM (SELECT state, split FROM "
        + split_sql(f"(SELECT * FROM [covered] WHERE state NOT IN (SELECT state FROM {_HELD}))", 7)
        + f" UNION ALL SELECT state, 'test' FROM {_TEST}) GROUP BY split"
    ),
    "seed_acceptance": check(
        "SELECT cast(per_region AS int) AS per_region, cast(seed AS int) AS seed, cast(test_positives AS bigint) AS test_positives, "
        "cast(test_rows AS bigint) AS test_rows, test_states, cast(accepted_no AS int) AS accepted_no FROM [seeds]"
    ),
    "seed_results": pick(
        "(SELECT cast(per_region AS int) AS per_region, cast(seed AS int) AS seed, test_states, cast(test_positives AS bigint) AS test_positives, "
        "cast(test_rows AS bigint) AS test_rows, pr_auc, precision_at_half, recall_at_half FROM [seed_results])",
        _SEED_PLAIN, "pr_auc precision_at_half recall_at_half",
    ),
    "seed_summary": pick(
        "(SELECT cast(per_region AS int) AS per_region, count(*) AS n_seeds, "
        + ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std" for m in ("pr_auc", "precision_at_half", "recall_at_half"))
        + " FROM [seed_results] GROUP BY per_region)",
        "per_region n_seeds",
        " ".join(f"{m}_{s}" for m in ("pr_auc", "precision_at_half", "recall_at_half") for s in ("mean", "std")),
    ),
    "metrics_flatten": pick(
        "(SELECT cast(per_region AS bigint) AS per_region, cast(seed AS bigint) AS seed, test_states, cast(test_positives AS bigint) AS test_positives, pr_auc FROM [seed_results])",
        "per_region seed test_states test_positives", "pr_auc",
    ),
    "holdout_comparison": pick(
        "(SELECT cast(per_region AS int) AS per_region, count(*) AS n_seeds, avg(test_positives) AS avg_test_positives, avg(pr_auc) AS pr_auc_mean, "
        "stddev_pop(pr_auc) AS pr_auc_std, min(pr_auc) AS pr_auc_min, max(pr_auc) AS pr_auc_max FROM [seed_results] GROUP BY per_region)",
        "per_region n_seeds", "avg_test_positives pr_auc_mean pr_auc_std pr_auc_min pr_auc_max",
    ),
    "rule_baselines": pick(
        f"(SELECT 'constant_prevalence' AS model, average_precision FROM {_curve_sql(_TEST, 'is_desert', '1')} UNION ALL "
        f"SELECT 'one_region', average_precision FROM "
        + _curve_sql(_TEST, "is_desert", f"CASE WHEN region = '{RULE_REGION}' THEN 1 ELSE 0 END")
        + ")",
        "model", "average_precision",
    ),
    "agreement": pick(
        "(SELECT count(*) FILTER (WHERE a) AS classifier_flagged, count(*) FILTER (WHERE b) AS regressor_flagged, "
        "count(*) FILTER (WHERE a AND b) / count(*) AS both_rate, count(*) FILTER (WHERE a AND b) / count(*) FILTER (WHERE a) AS regressor_given_classifier, "
        "count(*) FILTER (WHERE a AND b) / count(*) FILTER (WHERE b) AS classifier_given_regressor "
        f"FROM (SELECT score >= {k.RISK_THRESHOLD} AS a, elevation_m / 30 > {k.DESERT_MILES} AS b FROM [zones]))",
        "classifier_flagged regressor_flagged", "both_rate regressor_given_classifier classifier_given_regressor",
    ),
    "mae_rmse": pick(
        "(SELECT 'by_elevation' AS model, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM (SELECT nearest_miles - elevation_m / 30 AS e FROM [covered]))",
        "model", "mae rmse",
    ),
    "spearman": pick(
        "(SELECT corr(a, b) AS spearman_rho FROM (SELECT rank() OVER (ORDER BY nearest_miles) + (count(*) OVER (PARTITION BY nearest_miles) - 1) / 2 AS a, "
        "rank() OVER (ORDER BY elevation_m) + (count(*) OVER (PARTITION BY elevation_m) - 1) / 2 AS b FROM [covered]))",
        "", "spearman_rho",
    ),
    "flag_rates_long": pick(
        "(SELECT region, 'actual_rate' AS metric, sum(is_desert) / count(*) AS rate FROM [covered] GROUP BY region UNION ALL "
        "SELECT region, 'flagged_rate', count(*) FILTER (WHERE score >= 0.5) / count(*) FROM [covered] GROUP BY region)",
        "region metric", "rate",
    ),
    "missed_profile": pick(
        "(SELECT *, CASE WHEN actual > 0 THEN missed / actual ELSE 0.0::DOUBLE END AS miss_rate FROM (SELECT region, count(*) FILTER (WHERE is_desert = 1) AS actual, "
        "count(*) FILTER (WHERE is_desert = 1 AND score < 0.5) AS missed FROM [covered] GROUP BY region))",
        "region actual missed", "miss_rate",
    ),
    "missed_by_income": check(
        "SELECT b.band AS income_band, count(z.zone) AS n FROM (VALUES ('<40k', 0, 40000), ('40-60k', 40000, 60000), ('60-80k', 60000, 80000), "
        "('80-100k', 80000, 100000), ('100k+', 100000, 1e18), ('Unknown', NULL, NULL)) b(band, lo, hi) LEFT JOIN [covered] z "
        "ON z.is_desert = 1 AND z.score < 0.5 AND ((b.lo IS NULL AND (z.income IS NULL OR z.income < 0)) "
        "OR (z.income <= b.hi AND (z.income > b.lo OR (b.lo = 0 AND z.income = 0)))) GROUP BY b.band"
    ),
    "score_labels": check(
        "SELECT region, format('{:,}', count(*)) AS zones_text, format('{:.1f}', sum(is_desert) / count(*)) AS rate_text FROM [covered] GROUP BY region"
    ),
}
