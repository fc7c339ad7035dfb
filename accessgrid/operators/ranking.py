"""Ranks, quantiles, normalisation and top-N that never sort a whole group in one task.

Equal values are folded into one row with a count first.  What is left is split into ranges
of about equal size; each range is sorted on its own and the range totals give every range
its offset.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.operators.lookup import HOT_SALTS, hot_keys, lookup_left, lookup_small
from accessgrid.storage import materialize


def running_totals(
    df: DataFrame,
    value: str,
    weights: dict[str, Column],
    groups: list[str] | None = None,
    descending: bool = False,
    keep_null: bool = False,
) -> DataFrame:
    """Per distinct (groups, value): each weight's sum, ``before_<w>`` and ``all_<w>``.

    ``before_<w>`` is the sum over the values that come first, ``all_<w>`` the group's sum.
    NULL values are left out, or with ``keep_null`` are one more value below all others.
    """
    groups, names = groups or [], list(weights)
    order = F.col(value).desc() if descending else F.col(value).asc()
    rows = df if keep_null else df.where(F.col(value).isNotNull())
    folded = rows.groupBy(*groups, value).agg(*[F.sum(w).alias(n) for n, w in weights.items()])
    ranged = numbered_ranges(folded, [*groups, value], "_range")

    in_range = Window.partitionBy(*groups, "_range").orderBy(order)
    in_range = in_range.rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged
    for n in names:
        inner = inner.withColumn(f"_in_{n}", F.coalesce(F.sum(n).over(in_range), F.lit(0)))

    # One row per group and range it reaches into: at most groups + ranges of them.
    totals = ranged.groupBy(*groups, "_range").agg(*[F.sum(n).alias(f"_sum_{n}") for n in names])
    by_group = Window.partitionBy(*groups)
    first = F.col("_range").desc() if descending else F.col("_range").asc()
    earlier = by_group.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    for n in names:
        totals = totals.withColumn(
            f"_start_{n}", F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0))
        ).withColumn(f"all_{n}", F.sum(f"_sum_{n}").over(by_group))
    totals = totals.drop(*[f"_sum_{n}" for n in names])
    joined = lookup_small(inner, totals, [*groups, "_range"], null_safe=True)
    for n in names:
        joined = joined.withColumn(f"before_{n}", F.col(f"_in_{n}") + F.col(f"_start_{n}"))
    extra = [f"{p}_{n}" for n in names for p in ("_in", "_start")]
    return joined.drop("_range", *extra)


def numbered_ranges(df: DataFrame, by: list[str], out: str) -> DataFrame:
    """Rows with the number of the range they fall in; ranges follow the order of ``by``.

    The ranges are those of a sorted table's partitions: Spark draws the cuts from a sample and
    makes as many as the session and the size ask for, whatever the groups.  The numbers are
    written down, so that every later step sees the same ones.
    """
    return materialize(df.repartitionByRange(*by).withColumn(out, F.spark_partition_id()))


def average_rank(
    df: DataFrame, value: str, out: str, groups: list[str] | None = None, share: bool = True
) -> DataFrame:
    """Rank of each row's value with ties averaged; divided by the group size if ``share``."""
    groups = groups or []
    totals = running_totals(df, value, {"n": F.lit(1)}, groups)
    rank = F.col("before_n") + (F.col("n") + 1) / 2
    keys = [*groups, value]
    ranks = totals.select(*keys, (rank / F.col("all_n") if share else rank).alias(out))
    hot = hot_keys(totals, keys, "n")
    return lookup_left(df, ranks, keys, null_safe=True, salts=HOT_SALTS, hot=hot)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], groups: list[str] | None = None
) -> DataFrame:
    """Linear-interpolation quantiles, one row per group (one row without groups)."""
    groups = groups or []
    totals = running_totals(df, value, {"n": F.lit(1)}, groups)
    out = []
    for name, p in probs.items():
        position = F.lit(p) * (F.col("all_n") - 1)
        floor, ceil = F.floor(position), F.ceil(position)

        def at(k: Column) -> Column:
            hit = (F.col("before_n") <= k) & (k < F.col("before_n") + F.col("n"))
            return F.max(F.when(hit, F.col(value).cast("double")))

        part = F.max(position - floor)
        out.append((at(floor) + (at(ceil) - at(floor)) * part).alias(name))
    return totals.groupBy(*groups).agg(*out)


def min_max_normalise(df: DataFrame, columns: list[str], suffix: str = "_norm") -> DataFrame:
    """Columns scaled to 0..1 over all rows; a flat column gives 0."""
    ends = [
        F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
        for c in columns
    ]
    stats = df.agg(F.struct(*ends).alias("s")).scalar()
    out = df.withColumn("_stats", stats)
    for c in columns:
        lo, hi = F.col(f"_stats.{c}.lo"), F.col(f"_stats.{c}.hi")
        scaled = F.when(hi - lo < 1e-9, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo))
        out = out.withColumn(c + suffix, scaled)
    return out.drop("_stats")


def top_n(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """The n best rows in order; ties go to the smaller key."""
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).limit(n)


def top_n_scenarios(df: DataFrame, score: str, key: str, sizes: list[int]) -> DataFrame:
    """One row per scenario and selected row, numbered from 1 in each scenario."""
    best = top_n(df, score, key, max(sizes))
    ordered = Window.orderBy(F.col(score).desc(), F.col(key).asc())
    numbered = best.withColumn("selection_order", F.row_number().over(ordered))
    fits = F.filter(F.array(*[F.lit(s) for s in sizes]), lambda s: F.col("selection_order") <= s)
    return numbered.withColumn("scenario_top_n", F.explode(fits))


def seeded_hash(key: Column, seed: int | Column) -> Column:
    """Text that orders keys at random, the same on any engine."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.md5(F.concat(key.cast("string"), F.lit(":"), seed.cast("string")))


def hash_position(df: DataFrame, key: str, seed: int, groups: list[str], out: str) -> DataFrame:
    """Position 1..n of each row within its group in seeded hash order.

    Hash order is cut into ranges that are numbered on their own and shifted by the sizes of
    the ranges before.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed))
    hashed = numbered_ranges(hashed, [*groups, "_hash", key], "_part")
    within = Window.partitionBy(*groups, "_part").orderBy("_hash", key)
    numbered = hashed.withColumn("_at", F.row_number().over(within))
    sizes = hashed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = (
        Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    group_rows = F.sum("_size").over(Window.partitionBy(*groups))
    starts = sizes.select(
        *groups,
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        group_rows.alias("_group_rows"),
    )
    joined = lookup_small(numbered, starts, [*groups, "_part"], null_safe=True)
    return joined.withColumn(out, F.col("_at") + F.col("_start")).drop(
        "_hash", "_part", "_at", "_start"
    )


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows at random, the same ones for the same seed."""
    return df.orderBy(seeded_hash(F.col(key), seed), key).limit(n)
