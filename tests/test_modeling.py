from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from accessgrid.operators import boosting, registry
from accessgrid.operators import modeling as m
from accessgrid.plans import models


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(300).select(
        F.col("id").cast("string").alias("zone"),
        F.concat(F.lit("S"), F.col("id") % 12).alias("state"),
        F.concat(F.lit("R"), F.col("id") % 4).alias("region"),
        F.when(F.col("id") % 10 != 0, (F.col("id") % 50).cast("double")).alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 50 > 35).cast("int").alias("is_desert"),
        ((F.col("id") % 50) * 2.0).alias("nearest_miles"),
    )


def test_medians_are_exact(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, 7.0)], "a double, b double")
    got = {r["column_name"]: r["median"] for r in m.medians(df, ["a", "b"]).collect()}
    assert got == {"a": 2.5, "b": 7.0}


def test_class_weights(rows):
    n = rows.groupBy("is_desert").count().collect()
    n = {r["is_desert"]: r["count"] for r in n}
    got = {r["is_desert"]: r["class_weight"] for r in m.class_weights(rows, "is_desert").select("is_desert", "class_weight").distinct().collect()}
    assert got == {0: 1.0, 1: n[0] / n[1]}


FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def held(rows):
    """Two folds: S0 and S5, and S1."""
    states = rows.select("state").distinct()
    first = states.where(F.col("state").isin("S0", "S5")).withColumn("fold", F.lit(0))
    return first.unionByName(states.where("state = 'S1'").withColumn("fold", F.lit(1)))


@pytest.fixture(scope="module")
def folds(rows, held):
    return m.fit_folds(rows, held, [4, 9], FEATURES, trees=5)


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_members_of_all_folds(rows, held, folds):
    got = {(r["zone"], r["fold"]): r["split"] for r in folds.members.collect()}
    state = {r["zone"]: r["state"] for r in rows.collect()}
    out = {(r["fold"], r["state"]) for r in held.collect()}
    assert len(got) == 2 * len(state)
    assert all((split == "test") == ((fold, state[zone]) in out) for (zone, fold), split in got.items())
    for fold in (0, 1):
        inside = [s for (_, f), s in got.items() if f == fold and s != "test"]
        assert inside.count("validation") / len(inside) == pytest.approx(0.2, abs=0.02)


def test_folds_in_one_pass_equal_each_alone(rows, held, folds):
    one = held.where("fold = 1").withColumn("fold", F.lit(0))
    alone = m.fit_folds(rows, one, [9], FEATURES, trees=5)
    assert as_rows(alone.members.select("zone", "split")) == as_rows(folds.members.where("fold = 1").select("zone", "split"))
    for kind in ("classifier", "regressor"):
        trees = [f.models.trees.where(F.col("model") == f"{kind} {n}").drop("model") for f, n in ((alone, 0), (folds, 1))]
        assert as_rows(trees[0]) == as_rows(trees[1])


def test_scores(rows, folds):
    scored = folds.score(rows).cache()
    assert scored.where(~F.col("predicted_prob").between(0, 1)).count() == 0
    means = {r[0]: r[1] for r in scored.groupBy("is_desert").agg(F.avg("predicted_prob")).collect()}
    assert means[1] > means[0]
    assert scored.where(F.abs(F.col("nearest_miles") - F.col("predicted_miles") - F.col("residual_miles")) > 1e-9).count() == 0
    assert folds.models.importance("classifier 0").first()["feature"] == "a"


def test_each_fold_scores_its_own_test_rows(rows, folds):
    got = {(r["zone"], r["fold"]): r["predicted_prob"] for r in folds.test_scores(rows).collect()}
    test = {(r["zone"], r["fold"]) for r in folds.members.where("split = 'test'").collect()}
    assert got.keys() == test
    for fold in (0, 1):
        whole = {r["zone"]: r["predicted_prob"] for r in folds.score(rows, fold).collect()}
        assert all(p == pytest.approx(whole[z]) for (z, f), p in got.items() if f == fold)
    counts = {r["fold"]: r["test_rows"] for r in m.fold_test_rows(folds, rows).collect()}
    assert counts == {0: sum(f == 0 for _, f in test), 1: sum(f == 1 for _, f in test)}


def test_saved_models_score_alike(spark, rows, folds, tmp_path):
    m.save_model(folds.models, str(tmp_path / "models"))
    again = m.load_model(spark, str(tmp_path / "models"))
    assert again.specs == folds.models.specs and again.features == FEATURES
    p = [x.margins(rows, {"regressor 0": "p"}).agg(F.sum("p")).first()[0] for x in (folds.models, again)]
    assert p[0] == pytest.approx(p[1])


def test_spatial_fold_reports_all_metrics(rows, folds):
    out = m.spatial_fold(rows, folds).first().asDict()
    assert len(out) == 9 and all(v is not None for v in out.values())


def test_trained_once_for_the_same_rows_and_parameters(rows, held, monkeypatch):
    trained = []
    real = boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda *a, **b: trained.append(1) or real(*a, **b))
    first = m.stored_folds(rows, held, [4, 9], FEATURES, trees=2)
    assert as_rows(m.stored_folds(rows.repartition(3), held, [4, 9], FEATURES, trees=2).models.trees) == as_rows(first.models.trees)
    assert len(trained) == 1
    changed = rows.withColumn("a", F.when(F.col("zone") == "7", 99.0).otherwise(F.col("a")))
    for n, again in enumerate(
        (
            lambda: m.stored_folds(changed, held, [4, 9], FEATURES, trees=2),
            lambda: m.stored_folds(rows, held, [4, 8], FEATURES, trees=2),
            lambda: m.stored_folds(rows, held, [4, 9], FEATURES, trees=1),
            lambda: m.stored_folds(rows, held.where("state <> 'S5'"), [4, 9], FEATURES, trees=2),
        ),
        2,
    ):
        again()
        assert len(trained) == n


def test_fingerprints(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    assert registry.fingerprint(rows) == registry.fingerprint(rows.repartition(3))
    assert registry.fingerprint(rows) != registry.fingerprint(rows.distinct())
    assert registry.fingerprint(rows) != registry.fingerprint(rows.withColumnRenamed("x", "z"))


def test_forecast_is_never_negative(spark):
    df = spark.range(200).select(
        "id",
        (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 10 - 2.0).alias("y"),
        (F.col("id") >= 150).alias("is_test_period"),
    )
    made = [m.forecast(df, "y", ["x"], m.poisson, "f"), m.boosted_forecast(df, "y", ["x"], ["id"], "f", replace(m.COUNT_PARAMS, trees=3))]
    for out in made:
        assert out.count() == 50 and out.agg(F.min("f")).first()[0] >= 0


def test_queries_ask_for_all_trees(spark, monkeypatch):
    """The counts and parameters the registered queries train with; one tree is grown in the test."""
    asked, real = [], boosting.fit

    def one(rows, key, folds, features, specs, *rest):
        asked.extend((s.params.trees, s.params.l2, s.params.min_hessian) for s in specs)
        return real(rows, key, folds, features, [replace(s, params=replace(s.params, trees=1)) for s in specs], *rest)

    monkeypatch.setattr(boosting, "fit", one)
    models.QUERIES["spatial_fold"](spark, "/root/testdata/sf0.01").count()
    assert sorted(asked) == [(500, 1.2, 4.0), (600, 1.2, 4.0)]
    asked.clear()
    models.QUERIES["boosted_forecast"](spark, "/root/testdata/sf0.01").count()
    assert asked == [(400, 1.0, 1.0)]
