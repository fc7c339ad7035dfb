"""Holdouts that any engine repeats: seeded hash order instead of a random generator."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.operators.lookup import lookup_small
from accessgrid.operators.ranking import hash_position, seeded_hash

MAX_SEEDS = 200
WANTED_SEEDS = 5
MIN_POSITIVES = 100
NO_FLOOR_SIZE = 2


def _states(df: DataFrame, label: str | None = None) -> DataFrame:
    """One row per (region, state) with its rows and positives."""
    positives = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)) if label else F.lit(0)
    known = df.where(F.col("state").isNotNull() & F.col("region").isNotNull())
    return known.groupBy("region", "state").agg(
        F.count(F.lit(1)).alias("state_rows"), positives.alias("state_positives")
    )


def holdout_states(df: DataFrame, per_region: int, seed: int | Column = 0) -> DataFrame:
    """Up to ``per_region`` states of each region."""
    states = _states(df).withColumn("_hash", seeded_hash(F.col("state"), seed))
    drawn = F.row_number().over(Window.partitionBy("region").orderBy("_hash", "state"))
    return states.withColumn("_n", drawn).where(F.col("_n") <= per_region).select("region", "state")


def spatial_scope(df: DataFrame, held_out: DataFrame, out: str = "scope") -> DataFrame:
    """Rows of held-out states are 'test', the others 'train_side'."""
    marks = held_out.select("state").distinct().withColumn(out, F.lit("test"))
    marked = lookup_small(df, marks, ["state"])
    return marked.withColumn(out, F.coalesce(F.col(out), F.lit("train_side")))


def stratified_split(
    df: DataFrame, key: str, label: str, share: float = 0.2, seed: int = 0, out: str = "split", within: list[str] | None = None
) -> DataFrame:
    """``share`` of each class (of each group of ``within``) goes to 'validation', the rest to 'train'."""
    placed = hash_position(df, key, seed, [*(within or []), label], "_position")
    taken = F.col("_position") <= F.floor(F.lit(share) * F.col("_group_rows") + 0.5)
    split = placed.withColumn(out, F.when(taken, "validation").otherwise("train"))
    return split.drop("_position", "_group_rows")


def split_summary(df: DataFrame, key: str, label: str, per_region: int, seed: int) -> DataFrame:
    """Rows and states per split."""
    known = df.where(F.col("state").isNotNull())
    scoped = spatial_scope(known, holdout_states(known, per_region, seed))
    train_side = stratified_split(scoped.where(F.col("scope") != "test"), key, label, seed=seed)
    parts = train_side.select("state", "split").unionByName(
        scoped.where(F.col("scope") == "test").select("state", F.lit("test").alias("split"))
    )
    return parts.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("state").alias("n_states")
    )


def seed_acceptance(
    df: DataFrame,
    label: str,
    per_region_sizes: list[int],
    max_seeds: int = MAX_SEEDS,
    wanted: int = WANTED_SEEDS,
    min_positives: int = MIN_POSITIVES,
) -> DataFrame:
    """The first seeds per holdout size whose held-out states have enough positives.

    All seeds of all sizes are drawn at once on the (region, state) totals; the rows
    themselves are read a single time.  The smallest size takes every seed.
    """
    sizes = F.explode(F.array(*[F.lit(s) for s in per_region_sizes])).alias("per_region")
    states = _states(df, label).select("*", sizes)
    states = states.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_seeds - 1))).alias("seed"))
    states = states.withColumn("_hash", seeded_hash(F.col("state"), F.col("seed")))
    draw = Window.partitionBy("per_region", "seed", "region").orderBy("_hash", "state")
    drawn = states.withColumn("_n", F.row_number().over(draw)).where(F.col("_n") <= F.col("per_region"))
    folds = drawn.groupBy("per_region", "seed").agg(
        F.sum("state_positives").alias("test_positives"),
        F.sum("state_rows").alias("test_rows"),
        F.array_join(F.array_sort(F.collect_list("state")), ", ").alias("test_states"),
    )
    enough = (F.col("per_region") == NO_FLOOR_SIZE) | (F.col("test_positives") >= min_positives)
    first = Window.partitionBy("per_region").orderBy("seed")
    accepted = folds.where(enough).withColumn("accepted_no", F.row_number().over(first))
    return accepted.where(F.col("accepted_no") <= wanted)


def require_seeds(accepted: DataFrame, per_region_sizes: list[int], wanted: int = WANTED_SEEDS) -> None:
    """Raise when a holdout size has too few accepted seeds (a handful of counts)."""
    found = {r["per_region"]: r["n"] for r in accepted.groupBy("per_region").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = [s for s in per_region_sizes if found.get(s, 0) < wanted]
    if short:
        raise RuntimeError(f"fewer than {wanted} accepted seeds for holdout sizes {short}")


def seed_summary(results: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean and population deviation of each metric per holdout size."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return results.groupBy("per_region").agg(F.count(F.lit(1)).alias("n_seeds"), *aggs)
