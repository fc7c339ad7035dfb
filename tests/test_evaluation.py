import pytest
from pyspark.sql import functions as F

from accessgrid.operators import evaluation as ev
from accessgrid.operators import reports, splits

ROWS = [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.7), (0, 0.7), (0, 0.3), (1, 0.2), (0, 0.1)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(ROWS, "y int, score double")


def test_average_precision(scored):
    assert ev.average_precision(scored, "y", "score").first()[0] == pytest.approx(0.692857, abs=1e-6)


def test_roc_auc(scored):
    assert ev.roc_auc(scored, "y", "score").first()[0] == 0.625


def test_roc_auc_of_one_class_is_null(scored):
    assert ev.roc_auc(scored.where("y = 1"), "y", "score").first()[0] is None


def test_precision_at_recall(scored):
    assert ev.precision_at_recall(scored, "y", "score", 0.7).first()[0] == pytest.approx(0.6)
    assert ev.precision_at_recall(scored.where("y = 0"), "y", "score", 0.8).first()[0] is None


def test_sweep_equals_single_confusions(scored):
    sweep = {r["threshold"]: r for r in ev.threshold_sweep(scored, "y", "score", [0.1, 0.3, 0.7, 0.95]).collect()}
    assert set(sweep) == {0.1, 0.3, 0.7, 0.95}
    for t, row in sweep.items():
        want = ev.confusion(scored, "y", "score", t).first()
        for c in ("tp", "fp", "fn", "tn", "precision", "recall", "f1", "accuracy"):
            assert row[c] == want[c], (t, c)


def test_rows_without_score_or_label(scored, spark):
    """No label: no part.  No score: never flagged, below all others."""
    gaps = spark.createDataFrame([(1, None), (0, None), (None, 0.95), (None, None)], "y int, score double")
    rows = scored.unionByName(gaps)
    lowest = scored.unionByName(gaps.where("y is not null").fillna(-1.0, subset=["score"]))
    for t in (0.5, 0.7):
        want = ev.confusion(lowest, "y", "score", t).first()
        assert ev.confusion(rows, "y", "score", t).first() == want
        swept = ev.threshold_sweep(rows, "y", "score", [t]).first()
        assert all(swept[c] == want[c] for c in ("tp", "fp", "fn", "tn", "precision", "recall"))
    assert ev.roc_auc(rows, "y", "score").first() == ev.roc_auc(lowest, "y", "score").first()
    flagged = ev.average_precision(scored, "y", "score").first()[0]
    assert ev.average_precision(rows, "y", "score").first()[0] == pytest.approx(flagged * 4 / 5)
    assert ev.precision_at_recall(rows, "y", "score", 0.6).first()[0] == pytest.approx(0.6)
    assert ev.precision_at_recall(rows, "y", "score", 1.0).first()[0] is None


def test_recommended_threshold(scored):
    row = ev.recommend_threshold(scored, "y", "score", 0.7).first()
    assert row["feasible"] and row["threshold"] == 0.7 and row["precision"] == pytest.approx(0.6)
    row = ev.recommend_threshold(scored, "y", "score", 0.9, low=0.5, high=0.9).first()
    assert not row["feasible"] and row["recall"] == 0.75


def test_spearman(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (2.0, 4.0), (3.0, 9.0), (None, 1.0)], "a double, b double")
    assert ev.spearman(df, "a", "b").first()[0] == pytest.approx(1.0)
    assert ev.spearman(df.withColumn("b", F.lit(1.0)), "a", "b").first()[0] is None


def test_model_choice_prefers_on_tie(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "model string, rmse double")
    assert ev.better_model(df, "b").first()["model"] == "b"


def test_banded_counts_list_every_band(spark):
    df = spark.createDataFrame([(0.0,), (40000.0,), (None,)], "income double")
    got = {r["income_band"]: r["n"] for r in reports.banded_counts(df, "income").collect()}
    assert got == {"<40k": 2, "40-60k": 0, "60-80k": 0, "80-100k": 0, "100k+": 0, "Unknown": 1}


def zones(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("zone"),
        F.concat(F.lit("S"), F.col("id") % 20).alias("state"),
        F.concat(F.lit("R"), F.col("id") % 4).alias("region"),
        (F.col("id") % 5 == 0).cast("int").alias("is_desert"),
    )


def test_holdout_takes_states_of_each_region(spark):
    held = splits.holdout_states(zones(spark), 2, 3).groupBy("region").count().collect()
    assert [r["count"] for r in held] == [2] * 4


def test_stratified_split_takes_a_fifth_of_each_class(spark):
    out = splits.stratified_split(zones(spark), "zone", "is_desert", seed=1)
    got = {(r["is_desert"], r["split"]): r["count"] for r in out.groupBy("is_desert", "split").count().collect()}
    assert got == {(0, "train"): 256, (0, "validation"): 64, (1, "train"): 64, (1, "validation"): 16}


def test_seed_acceptance_and_floor(spark):
    rows = splits.seed_acceptance(zones(spark), "is_desert", [2, 3], max_seeds=30, min_positives=60).toPandas()
    assert rows[rows.per_region == 2].seed.tolist() == [0, 1, 2, 3, 4]
    assert (rows[rows.per_region == 3].test_positives >= 60).all()
    with pytest.raises(RuntimeError):
        splits.require_seeds(splits.seed_acceptance(zones(spark), "is_desert", [3], 10, 5, 10**6), [3])


def test_status_pivot_has_every_column(spark):
    df = spark.createDataFrame([("a", "Adequate Coverage"), ("a", "Adequate Coverage"), ("b", "Unknown")], "region string, coverage_status string")
    rows = {r["region"]: r for r in reports.status_pivot(df, "region").collect()}
    assert (rows["a"]["desert_count"], rows["a"]["adequate_count"], rows["a"]["desert_percent"]) == (0, 2, 0.0)
    assert rows["b"]["total_areas"] == 0 and rows["b"]["desert_percent"] is None
