"""Profiles and checks, each in one pass over the data."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.operators.lookup import lookup_left, match_flag


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, null_count, null_percent: all columns from one aggregate row."""
    columns = columns or df.columns
    one_row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns],
    )
    long = one_row.unpivot(["_rows"], columns, "column_name", "null_count")
    percent = F.when(F.col("_rows") > 0, F.col("null_count") / F.col("_rows") * 100)
    return long.select("column_name", "null_count", percent.alias("null_percent"))


def value_distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Value and count, most frequent first; NULL is a value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.col("n").desc(), F.col(column).asc_nulls_first())
    return counts if top is None else counts.limit(top)


def range_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, min_value, max_value, null_count."""
    one_row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.min(c).cast("double").alias("min_value"),
                    F.max(c).cast("double").alias("max_value"),
                    F.count(F.when(F.col(c).isNull(), 1)).alias("null_count"),
                )
                for c in columns
            ]
        ).alias("p")
    )
    return one_row.select(F.explode("p").alias("p")).select("p.*")


def length_distribution(df: DataFrame, column: str) -> DataFrame:
    length = F.length(F.col(column).cast("string")).alias("key_length")
    return df.groupBy(length).agg(F.count(F.lit(1)).alias("n")).orderBy("key_length")


def funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each step and rows it removed, in one pass."""
    passed, kept = F.lit(True), [F.count(F.lit(1)).alias("raw")]
    for name, test in steps:
        passed = passed & test
        kept.append(F.count(F.when(passed, 1)).alias(name))
    names = ["raw"] + [name for name, _ in steps]
    entries = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(name).alias("rows_left"),
            (F.col(names[max(i - 1, 0)]) - F.col(name)).alias("rows_removed"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*kept).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def match_review(
    fact: DataFrame, dim: DataFrame, key: str, group: str, value: str
) -> DataFrame:
    """Per group: rows, rows whose key is known, rows with a value behind the key."""
    values = dim.select(key, F.col(value).alias("_value"))
    joined = lookup_left(match_flag(fact, dim, key), values, [key])
    return joined.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count(F.when(F.col("matched"), 1)).alias("rows_matched"),
        F.count("_value").alias("rows_with_value"),
        F.count(F.when(~F.col("matched"), 1)).alias("rows_unmatched"),
    )


def rows_preserved(before: DataFrame, after: DataFrame) -> bool:
    return before.count() == after.count()


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def unmapped_keys(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct known keys without a dimension row."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(dim.select(key), key, "left_anti")


def distinct_sorted(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n, mean, sample deviation, min, max."""
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean_value"),
            F.stddev_samp(c).alias("std_value"),
            F.min(c).cast("double").alias("min_value"),
            F.max(c).cast("double").alias("max_value"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def column_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name and the percent of rows with a value."""
    row = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns])
    long = row.unpivot([], columns, "column_name", "share")
    return long.select("column_name", (F.col("share") * 100).alias("coverage_percent"))

