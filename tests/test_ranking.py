import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from accessgrid.operators import lookup, ranking


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def ranges(spark):
    """Sets the number of ranges; small tables are one range otherwise."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = {n: spark.conf.get(n) for n in names}

    def use(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "false")

    yield use
    for n, value in before.items():
        spark.conf.set(n, value)


def test_average_rank_share(spark):
    df = frame(spark, [(1, 1.0), (2, 2.0), (3, 2.0), (4, 4.0)], "k int, v double")
    got = [r["r"] for r in ranking.average_rank(df, "v", "r").orderBy("k").collect()]
    assert got == [0.25, 0.625, 0.625, 1.0]


def test_average_rank_of_one_tie(spark):
    df = frame(spark, [("a", 5.0), ("a", 5.0), ("a", 5.0), (None, 1.0), ("b", None)], "g string, v double")
    rows = ranking.average_rank(df, "v", "r", ["g"]).collect()
    assert [round(r["r"], 4) for r in rows if r["g"] == "a"] == [0.6667] * 3
    assert [r["r"] for r in rows if r["g"] is None] == [1.0]
    assert [r["r"] for r in rows if r["g"] == "b"] == [None]


def test_min_max_constant_is_zero(spark):
    df = frame(spark, [(1.0, 3.0), (5.0, 3.0)], "a double, b double")
    rows = ranking.min_max_normalise(df, ["a", "b"]).orderBy("a").collect()
    assert [(r["a_norm"], r["b_norm"]) for r in rows] == [(0.0, 0.0), (1.0, 0.0)]


def test_quantiles_are_linear(spark):
    df = frame(spark, [(x,) for x in (4.0, 1.0, 3.0, 2.0, None)], "v double")
    row = ranking.exact_quantiles(df, "v", {"p90": 0.9, "median": 0.5}).first()
    assert row["p90"] == pytest.approx(3.7) and row["median"] == 2.5


def test_quantiles_of_nothing(spark):
    df = frame(spark, [(None,)], "v double")
    assert ranking.exact_quantiles(df, "v", {"m": 0.5}).first()["m"] is None


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_many_ranges_and_one_agree(spark, groups, descending, ranges):
    rng = np.random.default_rng(5)
    n = 3000
    v = np.where(rng.random(n) < 0.34, 0.5, rng.exponential(1, n).round(3))
    g = np.where(rng.random(n) < 0.5, "a", np.where(rng.random(n) < 0.5, "b", None))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v}))
    weights = {"n": F.lit(1), "big": F.when(F.col("v") > 1, 1).otherwise(0)}

    def run(partitions):
        ranges(partitions)
        out = ranking.running_totals(df, "v", weights, groups, descending)
        cols = sorted(out.columns)
        return sorted(out.select(*cols).collect(), key=str)

    assert run(13) == run(1)


def test_null_value_comes_last_when_kept(spark, ranges):
    ranges(4)
    df = frame(spark, [(float(i % 7),) for i in range(40)] + [(None,), (None,)], "v double")
    out = ranking.running_totals(df, "v", {"n": F.lit(1)}, descending=True, keep_null=True).toPandas()
    assert out[out["v"].isna()][["n", "before_n", "all_n"]].values.tolist() == [[2, 40, 42]]


def test_hash_position_is_a_permutation(spark, ranges):
    ranges(11)
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    rows = ranking.hash_position(df, "id", 7, ["g"], "at").toPandas()
    for _, part in rows.groupby("g"):
        assert sorted(part["at"]) == list(range(1, len(part) + 1))
        assert (part["_group_rows"] == len(part)).all()
        ordered = part.sort_values("at")
        import hashlib

        hashes = [hashlib.md5(f"{i}:7".encode()).hexdigest() for i in ordered["id"]]
        assert hashes == sorted(hashes)


def test_scenarios_are_prefixes(spark):
    df = spark.range(30).select(F.col("id").alias("k"), (F.col("id") % 4).cast("double").alias("s"))
    rows = ranking.top_n_scenarios(df, "s", "k", [5, 10, 100]).toPandas()
    assert rows.groupby("scenario_top_n").size().to_dict() == {5: 5, 10: 10, 100: 30}
    small = rows[rows.scenario_top_n == 5].sort_values("selection_order").k.tolist()
    large = rows[rows.scenario_top_n == 10].sort_values("selection_order").k.tolist()
    assert small == large[:5] == [3, 7, 11, 15, 19]


def test_seeded_sample_repeats(spark):
    df = spark.range(100)
    a = {r["id"] for r in ranking.seeded_sample(df, "id", 1, 10).collect()}
    b = {r["id"] for r in ranking.seeded_sample(df.repartition(5), "id", 1, 10).collect()}
    assert a == b and len(a) == 10


@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_and_null_keys_find_their_row(spark, null_safe):
    fact = spark.range(1000).repartition(6).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k")
    )
    dim = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for hot in (None, lookup.hot_keys(dim, ["k"], "n")):
        out = lookup.lookup_left(fact, dim, ["k"], null_safe=null_safe, hot=hot).toPandas()
        assert len(out) == 1000 and out.id.is_unique
        assert (out[out.k == "hot"].n == 500).all()
        nulls = out[out.k.isna()].n
        assert (nulls == 167).all() if null_safe else nulls.isna().all()
        assert (out[out.k.notna() & (out.k != "hot")].n == 1).all()
    assert len(dim.limit(1).select(lookup.hot_keys(dim, ["k"], "n").alias("h")).first()["h"]) == 2


def test_lookup_few(spark):
    few = frame(spark, [("a",), ("a",), ("z",)], "k string")
    dim = frame(spark, [("a", 1), ("b", 2)], "k string, v int")
    assert sorted((r["k"], r["v"]) for r in lookup.lookup_few(few, dim, "k").collect()) == [("a", 1), ("a", 1), ("z", None)]
