"""Equi-joins against dimension tables whose keys may be very uneven on the fact side."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8
HOT_SALTS = 64
HOT_SHARE = 0.01


def hot_keys(counts: DataFrame, keys: list[str], count: str, share: float = HOT_SHARE) -> Column:
    """Hashes of the keys that hold more than ``share`` of all rows, as a scalar subquery.

    ``counts`` has one row per key; at most 1 / share keys can pass.
    """
    whole = counts.agg(F.sum(count)).scalar()
    hot = counts.where(F.col(count) > F.lit(share) * whole)
    return hot.agg(F.collect_list(F.xxhash64(*keys))).scalar()


def lookup_small(fact: DataFrame, dim: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Left join to a dimension of a few rows (states, regions), which goes out by broadcast.

    The size check is the optimizer's; nothing is forced.
    """
    if not null_safe:
        return fact.join(dim, keys, "left")
    renamed = dim.withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    same = [fact[k].eqNullSafe(renamed[f"_dim_{k}"]) for k in keys]
    joined = fact.join(renamed, reduce(Column.__and__, same), "left")
    return joined.drop(*[f"_dim_{k}" for k in keys])


def lookup_left(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    salts: int = SALTS,
    hot: Column | None = None,
) -> DataFrame:
    """Left join ``fact`` to ``dim`` on ``keys``; every fact row stays.

    Without ``hot`` it is a plain join: the size-checked broadcast serves small dimensions with
    no exchange of the fact side.  With ``hot`` (see :func:`hot_keys`), for dimensions as large as
    the fact table, rows of those keys are spread over ``salts`` slots by the partition they are
    read in, and the dimension row is present in all slots, so no task gets a whole hot key; NULL
    keys, which match nothing, are spread too.

    The partition number is the same when a task runs again, so a lost executor does not
    move rows between slots, and it keeps no column in the scan that nobody asked for.
    """
    if hot is None:
        return lookup_small(fact, dim, keys, null_safe)
    fact, dim = fact.withColumn("_hot", hot), dim.withColumn("_dim_hot", hot)
    spread = F.array_contains("_hot", F.xxhash64(*keys))
    if not null_safe:
        spread = spread | reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    slot = F.when(spread, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0))
    all_slots = F.sequence(F.lit(0), F.lit(salts - 1))
    is_hot = F.array_contains("_dim_hot", F.xxhash64(*keys))
    slots = F.when(is_hot, all_slots).otherwise(F.array(F.lit(0)))
    left = fact.withColumn("_slot", slot).drop("_hot")
    right = dim.select(
        *[c for c in dim.columns if c != "_dim_hot"], F.explode(slots).alias("_slot")
    )
    return lookup_small(left, right, [*keys, "_slot"], null_safe).drop("_slot")


def lookup_few(few: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a short list to a large dimension: the dimension is cut to its keys first."""
    wanted = dim.join(few.select(key).distinct(), key, "left_semi").dropDuplicates([key])
    return few.join(wanted, key, "left")


def match_flag(fact: DataFrame, dim: DataFrame, key: str, flag: str = "matched") -> DataFrame:
    """Whether the key exists in the dimension, apart from what its columns hold."""
    known = dim.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return lookup_left(fact, known, [key]).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
