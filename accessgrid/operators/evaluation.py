"""Scores against labels as relational queries.

Rows without a label take no part.  A row without a score is not flagged at any threshold and
ranks below all rows with one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx
from accessgrid.operators.lookup import HOT_SALTS, hot_keys, lookup_left
from accessgrid.operators.ranking import exact_quantiles, running_totals


def confusion(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: tp, fp, fn, tn and the ratios built from them."""
    y, hit = F.col(label) == 1, F.coalesce(F.col(score) >= threshold, F.lit(False))
    row = df.agg(
        F.count(F.when(y & hit, 1)).alias("tp"),
        F.count(F.when(~y & hit, 1)).alias("fp"),
        F.count(F.when(y & ~hit, 1)).alias("fn"),
        F.count(F.when(~y & ~hit, 1)).alias("tn"),
    )
    return with_ratios(row)


def with_ratios(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = counts.withColumn("precision", fx.ratio_or_zero(tp, tp + fp))
    out = out.withColumn("recall", fx.ratio_or_zero(tp, tp + fn))
    p, r = F.col("precision"), F.col("recall")
    out = out.withColumn("f1", fx.ratio_or_zero(2 * p * r, p + r))
    return out.withColumn("accuracy", fx.ratio_or_zero(tp + tn, tp + fp + fn + tn))


def score_curve(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """Per distinct score, best first and NULL last: rows and positives at it, before it and overall."""
    weights = {"n": F.lit(1), "pos": (F.col(label) == 1).cast("bigint")}
    labelled = df.where(F.col(label).isNotNull())
    return running_totals(labelled, score, weights, groups, descending=True, keep_null=True)


def _precision() -> Column:
    return (F.col("before_pos") + F.col("pos")) / (F.col("before_n") + F.col("n"))


def average_precision(
    df: DataFrame, label: str, score: str, groups: list[str] | None = None, out: str = "average_precision"
) -> DataFrame:
    """Precision at every distinct score, weighted by the recall gained there."""
    groups = groups or []
    curve = score_curve(df, label, score, groups)
    flagged = F.col(score).isNotNull() & (F.col("all_pos") > 0)
    gained = F.when(flagged, F.col("pos") / F.col("all_pos"))
    return curve.groupBy(*groups).agg(F.coalesce(F.sum(gained * _precision()), F.lit(0.0)).alias(out))


def roc_auc(
    df: DataFrame, label: str, score: str, groups: list[str] | None = None, out: str = "roc_auc"
) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half."""
    groups = groups or []
    curve = score_curve(df, label, score, groups)
    negatives_below = (F.col("all_n") - F.col("all_pos")) - (
        F.col("before_n") + F.col("n") - F.col("before_pos") - F.col("pos")
    )
    ties = F.col("n") - F.col("pos")
    won = F.sum(F.col("pos") * (negatives_below + ties / 2))
    possible = F.max(F.col("all_pos") * (F.col("all_n") - F.col("all_pos")))
    return curve.groupBy(*groups).agg(F.when(possible > 0, won / possible).alias(out))


def precision_at_recall(
    df: DataFrame, label: str, score: str, target: float, out: str = "best_precision"
) -> DataFrame:
    """Best precision over the score cuts that reach the target recall; NULL if none does."""
    curve = score_curve(df, label, score)
    recall = (F.col("before_pos") + F.col("pos")) / F.col("all_pos")
    possible = F.col(score).isNotNull() & (F.col("all_pos") > 0)
    reached = F.when(possible & (recall >= target), _precision())
    return curve.agg(F.max(reached).alias(out))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Confusion counts and ratios at each threshold, from one pass over the rows.

    A row counts for every threshold its score reaches, so rows are only counted by how
    many thresholds that is; the running sums are over that handful of counts.
    """
    grid = sorted(thresholds)
    levels = F.array(*[F.lit(t) for t in grid])
    # A comparison with NULL passes no filter, so a row without score reaches none.
    reached = F.size(F.filter(levels, lambda t: F.col(score) >= t))
    by_level = df.groupBy(reached.alias("level")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
    )
    every = df.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate([None, *grid])], "level int, threshold double"
    )
    # len(grid) + 1 rows from here on.
    listed = every.join(by_level, "level", "left").fillna(0, subset=["pos", "neg"])
    whole = Window.partitionBy()
    from_here = whole.orderBy(F.col("level").desc())
    counts = listed.select(
        "threshold",
        F.sum("pos").over(from_here).alias("tp"),
        F.sum("neg").over(from_here).alias("fp"),
        (F.sum("pos").over(whole) - F.sum("pos").over(from_here)).alias("fn"),
        (F.sum("neg").over(whole) - F.sum("neg").over(from_here)).alias("tn"),
    )
    return with_ratios(counts.where(F.col("threshold").isNotNull()))


def recommend_threshold(
    df: DataFrame,
    label: str,
    score: str,
    target_recall: float,
    low: float = 0.10,
    high: float = 0.90,
    step: float = 0.01,
) -> DataFrame:
    """The most precise threshold that reaches the target recall, else the best recall.

    Ties go to the better f1 and then the higher threshold.
    """
    steps = round((high - low) / step) + 1
    sweep = threshold_sweep(df, label, score, [round(low + i * step, 4) for i in range(steps)])
    feasible = F.col("recall") >= target_recall
    by_need = F.when(feasible, F.col("precision")).otherwise(F.col("recall"))
    then = F.when(feasible, F.col("f1")).otherwise(F.col("precision"))
    last = F.when(feasible, F.col("threshold")).otherwise(F.col("f1"))
    return (
        sweep.withColumn("feasible", feasible)
        .orderBy(F.col("feasible").desc(), by_need.desc(), then.desc(), last.desc(), "threshold")
        .limit(1)
    )


def error_metrics(df: DataFrame, actual: str, predictions: dict[str, Column]) -> DataFrame:
    """model, mae, rmse: one pass for all predictions."""
    entries = []
    for name, predicted in predictions.items():
        error = F.col(actual) - predicted
        entries.append(
            F.struct(
                F.lit(name).alias("model"),
                F.avg(F.abs(error)).alias("mae"),
                F.sqrt(F.avg(error * error)).alias("rmse"),
            )
        )
    return df.agg(F.array(*entries).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def spearman(df: DataFrame, a: str, b: str, out: str = "spearman_rho") -> DataFrame:
    """Correlation of average ranks; NULL when either column is constant."""
    known = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    # Only the pair of values matters, so equal pairs travel as one row with a count.
    pairs = known.groupBy(a, b).agg(F.count(F.lit(1)).alias("_w"))
    ranked = average_pair_ranks(known, pairs, a, b)
    w, x, y = F.col("_w"), F.col("_rank_a"), F.col("_rank_b")
    # Centred on the mean rank, which is (n + 1) / 2 for both columns.
    mean = (known.agg((F.count(F.lit(1)) + 1) / 2)).scalar()
    centred = ranked.select("_w", (x - mean).alias("_rank_a"), (y - mean).alias("_rank_b"))
    sxx, syy, sxy = F.sum(w * x * x), F.sum(w * y * y), F.sum(w * x * y)
    rho = F.when((sxx > 0) & (syy > 0), sxy / F.sqrt(sxx * syy))
    return centred.agg(rho.alias(out))


def average_pair_ranks(known: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    out = pairs
    for column, name in ((a, "_rank_a"), (b, "_rank_b")):
        totals = running_totals(known, column, {"n": F.lit(1)})
        rank = F.col("before_n") + (F.col("n") + 1) / 2
        ranks = totals.select(column, rank.alias(name))
        # A frequent value meets many values of the other column.
        partners = pairs.groupBy(column).agg(F.count(F.lit(1)).alias("_pairs"))
        hot = hot_keys(partners, [column], "_pairs")
        out = lookup_left(out, ranks, [column], salts=HOT_SALTS, hot=hot)
    return out


def agreement(
    df: DataFrame, score: str, predicted: str, threshold: float, predicted_threshold: float
) -> DataFrame:
    """How often classifier and regressor flag the same rows."""
    a, b = F.col(score) >= threshold, F.col(predicted) > predicted_threshold
    both = F.count(F.when(a & b, 1))
    n_a, n_b = F.count(F.when(a, 1)), F.count(F.when(b, 1))
    return df.agg(
        n_a.alias("classifier_flagged"),
        n_b.alias("regressor_flagged"),
        (both / F.count(F.lit(1))).alias("both_rate"),
        F.when(n_a > 0, both / n_a).alias("regressor_given_classifier"),
        F.when(n_b > 0, both / n_b).alias("classifier_given_regressor"),
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    stats = exact_quantiles(df, target, {"median_value": 0.5, "p95_value": 0.95})
    known = df.where(F.col(target).isNotNull())
    mean = known.agg(
        F.struct(
            F.avg(F.when(F.col(target) >= 1, 1.0).otherwise(0.0)).alias("p"), F.avg(target).alias("m")
        )
    )
    return stats.withColumn("_s", mean.scalar()).select(
        F.col("_s.p").alias("prevalence"), F.col("_s.m").alias("mean_value"), "median_value", "p95_value"
    )


def better_model(metrics: DataFrame, preferred: str) -> DataFrame:
    """The model with the lower rmse; the preferred one on a tie."""
    return metrics.orderBy("rmse", F.when(F.col("model") == preferred, 0).otherwise(1), "model").limit(1)
