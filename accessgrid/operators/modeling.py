"""Median imputation, boosted models of risk, distance and installations, and MLlib's linear ones."""
from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.functions.constants import RISK_THRESHOLD
from accessgrid.operators import boosting, registry
from accessgrid.operators import evaluation as ev
from accessgrid.operators.boosting import Params, Spec
from accessgrid.operators.lookup import lookup_small
from accessgrid.operators.ranking import exact_quantiles
from accessgrid.operators.splits import stratified_split
from accessgrid.storage import materialize

# Training parameters.
CLASSIFIER_PARAMS = Params(trees=500, depth=5, rate=0.04, subsample=0.9, columns=0.85, l2=1.2, min_hessian=4.0)
REGRESSOR_PARAMS = replace(CLASSIFIER_PARAMS, trees=600)
COUNT_PARAMS = Params(trees=400, depth=5, rate=0.05, subsample=0.9, columns=0.9)
POISSON_REG = 1e-4


def medians(train: DataFrame, columns: list[str], within: list[str] | None = None) -> DataFrame:
    """column_name, median: exact, all columns in one long pass, for each group of ``within``."""
    within = within or []
    numeric = train.select(*within, *[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot(within, columns, "column_name", "value").where(F.col("value").isNotNull())
    return exact_quantiles(long, "value", {"median": 0.5}, [*within, "column_name"])


def impute(df: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs replaced by the fitted medians (one number per column; 0 where none was fitted)."""
    values = {r["column_name"]: r["median"] for r in fitted.collect()}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(values.get(c, 0.0)))) for c in columns}
    return df.withColumns(filled)


def class_weights(train: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Positives weigh negatives / positives, so both classes count the same."""
    one = train.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"), F.count(F.when(F.col(label) == 1, 1)).alias("pos")
    )
    ratio = one.select(F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).otherwise(F.lit(1.0))).scalar()
    return train.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def assembled(columns: list[str], stage: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), stage])


def poisson(label: str, max_iter: int = 2000) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        family="poisson", link="log", labelCol=label, regParam=POISSON_REG, maxIter=max_iter
    )


def probability(model: Model, df: DataFrame, out: str) -> DataFrame:
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def prediction(model: Model, df: DataFrame, out: str, lowest: float | None = None) -> DataFrame:
    value = F.col("prediction")
    if lowest is not None:
        value = F.greatest(value, F.lit(lowest))
    return model.transform(df).withColumn(out, value).drop("features", "prediction")


@dataclass(frozen=True)
class Boosted:
    """Trained models: what they are, their trees, and the features they split on."""

    specs: list[Spec]
    trees: DataFrame
    features: list[str]

    def margins(self, df: DataFrame, out: dict[str, str], wanted: Column | None = None) -> DataFrame:
        """Adds the margin of each model in ``out``; nulls count as the model's medians."""
        fills = {s.model: s.fills for s in self.specs}
        return boosting.with_margins(df, self.trees, self.features, fills, out, wanted)

    def importance(self, model: str, top: int = 20) -> DataFrame:
        """feature, importance (mean gain of its splits), splits, total_gain; largest first, unused ones at 0."""
        own = boosting.gains(self.trees).where(F.col("model") == model)
        known = self.trees.sparkSession.createDataFrame([(f,) for f in self.features], "feature string")
        each = known.join(own, "feature", "left").select(
            "feature",
            F.coalesce("gain", F.lit(0.0)).alias("importance"),
            F.coalesce("splits", F.lit(0)).alias("splits"),
            F.coalesce("total_gain", F.lit(0.0)).alias("total_gain"),
        )
        return each.orderBy(F.col("importance").desc(), "feature").limit(top)


def save_model(model: Boosted, path: str) -> None:
    """The trees as a table, and one row that says what they belong to."""
    about = json.dumps({"specs": [asdict(s) for s in model.specs], "features": model.features})
    model.trees.write.mode("overwrite").parquet(f"{path}/trees")
    model.trees.sparkSession.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> Boosted:
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    specs = [Spec(**{**s, "params": Params(**s["params"]), "fills": tuple(s["fills"])}) for s in about["specs"]]
    return Boosted(specs, spark.read.schema(boosting.TREES).parquet(f"{path}/trees"), about["features"])


def risk(margin: str) -> Column:
    """The probability that a logistic margin stands for."""
    return 1 / (1 + F.exp(-F.col(margin)))


def fold_members(df: DataFrame, held_out: DataFrame, folds: int, key: str = "zone", label: str = "is_desert") -> DataFrame:
    """(key, label, fold, split): each row's part in each fold, all folds at once.

    held_out has fold and state.  Rows of held-out states are test; of the others a share of each
    class is validation, the rest train.
    """
    numbers = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    marks = held_out.select(F.col("fold").cast("int").alias("fold"), "state").distinct().withColumn("_held", F.lit(True))
    scoped = materialize(lookup_small(df.select(key, "state", label, numbers), marks, ["fold", "state"]))
    inside = stratified_split(scoped.where(F.col("_held").isNull()), key, label, within=["fold"])
    test = scoped.where(F.col("_held")).withColumn("split", F.lit("test"))
    return inside.unionByName(test).select(key, label, "fold", "split")


@dataclass(frozen=True)
class Folds:
    """Models fitted on the inner train rows of spatial holdouts, and every row's part in each fold."""

    members: DataFrame
    models: Boosted

    def score(self, rows: DataFrame, fold: int = 0) -> DataFrame:
        """All rows with a fold's risk, predicted distance and residual (actual - predicted)."""
        out = self.models.margins(rows, {f"classifier {fold}": "predicted_prob", f"regressor {fold}": "predicted_miles"})
        out = out.withColumn("predicted_prob", risk("predicted_prob"))
        return out.withColumn("residual_miles", F.col("nearest_miles") - F.col("predicted_miles"))

    def test_scores(self, rows: DataFrame, key: str = "zone", label: str = "is_desert") -> DataFrame:
        """(key, label, fold, predicted_prob): each fold's held-out rows by that fold's classifier."""
        names = {s.model: f"_margin {s.fold}" for s in self.models.specs if s.objective == "logistic"}
        test = self.members.where(F.col("split") == "test")
        asked = test.groupBy(key).agg(F.collect_list(F.concat(F.lit("classifier "), F.col("fold").cast("string"))).alias("_asked"))
        scored = self.models.margins(rows.join(asked, key), names, F.col("_asked"))
        folds = sorted(s.fold for s in self.models.specs if s.objective == "logistic")
        each = F.posexplode(F.array(*[F.col(f"_margin {f}") for f in folds])).alias("fold", "_margin")
        long = scored.select(key, label, each).where(F.col("_margin").isNotNull())
        return long.select(key, label, F.col("fold"), risk("_margin").alias("predicted_prob"))


def fit_folds(
    df: DataFrame,
    held_out: DataFrame,
    seeds: list[int],
    features: list[str],
    key: str = "zone",
    trees: int | None = None,
) -> Folds:
    """Classifier of deserts and regressor of distance for each fold, all of them trained together.

    held_out has fold (place in ``seeds``) and state.  Medians, class weights and first guesses are those
    of a fold's inner train rows; rows without a label train nothing.
    """
    members = materialize(fold_members(df, held_out, len(seeds), key))
    inner = members.where(F.col("split") == "train").select(key, "fold")
    train = materialize(df.select(key, "is_desert", "nearest_miles", *features).join(inner, key))
    fitted = {(r["fold"], r["column_name"]): r["median"] for r in medians(train, features, ["fold"]).collect()}

    known = F.col("is_desert").isNotNull() & F.col("nearest_miles").isNotNull()
    one = train.where(known).groupBy("fold").agg(
        F.count(F.when(F.col("is_desert") == 0, 1)).alias("neg"),
        F.count(F.when(F.col("is_desert") == 1, 1)).alias("pos"),
        F.avg(F.col("nearest_miles").cast("double")).alias("miles"),
    )
    stats = {r["fold"]: r for r in one.collect()}  # a row for each fold
    specs = []
    for fold, seed in enumerate(seeds):
        fills = tuple(float(fitted.get((fold, c)) or 0.0) for c in features)
        found = stats.get(fold)
        weight = found["neg"] / found["pos"] if found and found["pos"] and found["neg"] else 1.0
        clf, reg = (p if trees is None else replace(p, trees=trees) for p in (CLASSIFIER_PARAMS, REGRESSOR_PARAMS))
        specs.append(Spec(f"classifier {fold}", fold, "is_desert", "logistic", clf, seed, weight, 0.0, fills))
        specs.append(Spec(f"regressor {fold}", fold, "nearest_miles", "squared", reg, seed, 1.0, float(found["miles"]) if found else 0.0, fills))
    used = inner.groupBy(key).agg(F.collect_list("fold").alias("_folds"))
    rows = df.where(known).select(key, "is_desert", "nearest_miles", *features).join(used, key)
    grown = boosting.fit(rows, F.col(key), F.col("_folds"), features, specs)
    return Folds(members, Boosted(specs, grown, features))


def stored_folds(df: DataFrame, held_out: DataFrame, seeds: list[int], features: list[str], key: str = "zone", trees: int | None = None) -> Folds:
    """fit_folds once for the same rows, holdouts, seeds, features and parameters; then from the shared folder."""
    columns = [key, "state", "is_desert", "nearest_miles", *features]
    name = registry.registry_key(
        registry.fingerprint(df.select(*columns)), registry.fingerprint(held_out.select("fold", "state")),
        seeds, features, trees, asdict(CLASSIFIER_PARAMS), asdict(REGRESSOR_PARAMS), boosting.BINS,
    )

    def save(made: Folds, path: str) -> None:
        made.members.write.parquet(f"{path}/members")
        save_model(made.models, f"{path}/models")

    def load(spark: SparkSession, path: str) -> Folds:
        return Folds(spark.read.parquet(f"{path}/members"), load_model(spark, f"{path}/models"))

    return registry.stored(df.sparkSession, "folds", name, lambda: fit_folds(df, held_out, seeds, features, key, trees), save, load)


def fold_test_rows(folds: Folds, rows: DataFrame) -> DataFrame:
    """fold, pr_auc, precision, recall and test_rows on each fold's held-out states."""
    y, p = "is_desert", "predicted_prob"
    test = materialize(folds.test_scores(rows))
    counts = test.groupBy("fold").agg(
        F.count(F.lit(1)).alias("test_rows"),
        *[F.count(F.when(hit, 1)).alias(n) for n, hit in {
            "tp": (F.col(y) == 1) & (F.col(p) >= RISK_THRESHOLD), "fp": (F.col(y) != 1) & (F.col(p) >= RISK_THRESHOLD),
            "fn": (F.col(y) == 1) & (F.col(p) < RISK_THRESHOLD), "tn": (F.col(y) != 1) & (F.col(p) < RISK_THRESHOLD),
        }.items()],
    )
    out = ev.with_ratios(counts).join(ev.average_precision(test, y, p, ["fold"], out="pr_auc"), "fold")
    return out.select("fold", "precision", "recall", "pr_auc", "test_rows")


def spatial_fold(df: DataFrame, folds: Folds, key: str = "zone", fold: int = 0) -> DataFrame:
    """One row: a fold's models on its validation share and its held-out states."""
    parts = folds.members.where(F.col("fold") == fold).select(key, "split")
    scored = materialize(folds.score(df, fold).join(parts, key))
    val, test = (scored.where(F.col("split") == s) for s in ("validation", "test"))
    y, p = "is_desert", "predicted_prob"
    miles = {"regressor": F.col("predicted_miles")}
    at_half = ev.confusion(test, y, p, RISK_THRESHOLD).select(F.struct("precision", "recall")).scalar()
    out = ev.average_precision(val, y, p, out="validation_pr_auc")
    return (
        out.withColumn("validation_roc_auc", ev.roc_auc(val, y, p).scalar())
        .withColumn("validation_precision_at_recall", ev.precision_at_recall(val, y, p, 0.8).scalar())
        .withColumn("test_pr_auc", ev.average_precision(test, y, p).scalar())
        .withColumn("validation_mae", ev.error_metrics(val, "nearest_miles", miles).select("mae").scalar())
        .withColumn("validation_rmse", ev.error_metrics(val, "nearest_miles", miles).select("rmse").scalar())
        .withColumn("test_mae", ev.error_metrics(test, "nearest_miles", miles).select("mae").scalar())
        .withColumn("_half", at_half)
        .withColumn("test_precision", F.col("_half.precision"))
        .withColumn("test_recall", F.col("_half.recall"))
        .drop("_half")
    )


def one_feature_baseline(
    train: DataFrame, test: DataFrame, feature: str, label: str, out: str = "baseline_score"
) -> DataFrame:
    """Logistic score from a single feature."""
    known = train.where(F.col(feature).isNotNull() & F.col(label).isNotNull())
    known = known.withColumn(label, F.col(label).cast("double"))
    model = assembled([feature], LogisticRegression(labelCol=label, maxIter=2000)).fit(known)
    return probability(model, test.where(F.col(feature).isNotNull()), out)


def forecast(
    panel: DataFrame, target: str, features: list[str], stage: Callable[[str], Estimator], out: str
) -> DataFrame:
    """Fit on the months before the test period, predict the test period, never below zero."""
    known = panel.where(F.col(target).isNotNull())
    train = materialize(known.where(~F.col("is_test_period")))
    test = known.where(F.col("is_test_period"))
    fitted = materialize(medians(train, features))
    labelled = impute(train, fitted, features).withColumn("_label", F.greatest(F.col(target), F.lit(0.0)))
    model = assembled(features, stage("_label")).fit(labelled)
    return prediction(model, impute(test, fitted, features), out, lowest=0.0)


def boosted_forecast(
    panel: DataFrame, target: str, features: list[str], key: list[str], out: str, params: Params = COUNT_PARAMS, seed: int = 42
) -> DataFrame:
    """As :func:`forecast`, by boosted trees; key tells the rows apart that each tree draws."""
    known = panel.where(F.col(target).isNotNull())
    fold = F.when(F.col("is_test_period"), F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))
    rows = materialize(known.withColumn("_label", F.greatest(F.col(target).cast("double"), F.lit(0.0))).withColumn("_folds", fold))
    train = rows.where(~F.col("is_test_period"))
    fitted = {r["column_name"]: r["median"] for r in medians(train, features).collect()}
    fills = tuple(float(fitted.get(c) or 0.0) for c in features)
    base = train.agg(F.avg("_label")).first()[0] or 0.0
    spec = Spec("counts", 0, "_label", "squared", params, seed, 1.0, float(base), fills)
    grown = boosting.fit(rows, F.struct(*key), F.col("_folds"), features, [spec])
    scored = Boosted([spec], grown, features).margins(rows.where(F.col("is_test_period")), {"counts": out})
    return scored.withColumn(out, F.greatest(F.col(out), F.lit(0.0))).drop("_label", "_folds")
