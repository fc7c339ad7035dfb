import pytest
from pyspark.sql import functions as F

from accessgrid.functions import constants as k
from accessgrid.functions import geodesy as g
from accessgrid.functions import scalars as fx
from accessgrid.operators import zones


def one(spark, expr, schema="x double", row=(0.0,)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_haversine_city_pair(spark):
    d = g.haversine_miles(*[F.lit(v) for v in (40.7128, -74.0060, 34.0522, -118.2437)])
    assert one(spark, d) == pytest.approx(2445.5866, abs=1e-4)


def test_haversine_null(spark):
    d = g.haversine_miles(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0), F.lit(3.0))
    assert one(spark, d) is None


def test_haversine_antipodes_do_not_fail(spark):
    d = g.haversine_miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))
    assert one(spark, d) == pytest.approx(3.141592653589793 * g.EARTH_RADIUS_MILES)


def test_albers_origin_and_known_point(spark):
    x, y = g.albers_xy(F.lit(23.0), F.lit(-96.0))
    assert abs(one(spark, x)) < 1e-6 and abs(one(spark, y)) < 1e-6
    # Worked example for the Clarke ellipsoid lies within a few hundred metres of GRS80.
    x, y = g.albers_xy(F.lit(35.0), F.lit(-75.0))
    assert one(spark, x) == pytest.approx(1885472.7, abs=300)
    assert one(spark, y) == pytest.approx(1535925.0, abs=300)


@pytest.mark.parametrize("miles, want", [(50.0, 0), (50.1, 1), (None, None)])
def test_desert_flag(spark, miles, want):
    assert one(spark, zones.desert_flag(F.col("x")), row=(miles,)) == want


@pytest.mark.parametrize("raw, want", [("601", "00601"), ("12345-6789", "12345"), ("123456", "123456"), (None, None)])
def test_padded_key(spark, raw, want):
    assert one(spark, fx.padded_key(F.col("x")), "x string", (raw,)) == want


@pytest.mark.parametrize("raw, want", [("601", "00601"), ("150000", "150000"), ("abc", None), (None, None)])
def test_numeric_key(spark, raw, want):
    assert one(spark, fx.numeric_key(F.col("x")), "x string", (raw,)) == want


@pytest.mark.parametrize(
    "income, want",
    [(0.0, "<40k"), (40000.0, "<40k"), (40001.0, "40-60k"), (100000.0, "80-100k"), (1e6, "100k+"), (None, "Unknown"), (-1.0, "Unknown")],
)
def test_income_band(spark, income, want):
    assert one(spark, fx.income_band(F.col("x")), row=(income,)) == want


@pytest.mark.parametrize("dc, l2, want", [(1, 5, "DCFC"), (0, 5, "Level2"), (0, 0, "Level1")])
def test_charger_category(spark, dc, l2, want):
    expr = fx.first_positive([("dc", "DCFC"), ("l2", "Level2")], "Level1")
    assert one(spark, expr, "dc int, l2 int", (dc, l2)) == want


def test_bad_date_is_null(spark):
    assert one(spark, fx.parsed_date(F.col("x")), "x string", ("not-a-date",)) is None


def test_safe_ratio_zero_area(spark):
    assert one(spark, fx.safe_ratio(F.lit(3.0), F.col("x"))) is None


def test_nan_becomes_null(spark):
    assert one(spark, fx.not_nan(F.col("x")), row=(float("nan"),)) is None


def test_clip_keeps_null(spark):
    assert one(spark, fx.clip(F.col("x"), F.lit(0.0)), row=(None,)) is None
    assert one(spark, fx.clip(F.col("x"), F.lit(0.0), F.lit(2.0)), row=(9.0,)) == 2.0


def test_prefix_ranges_do_not_overlap():
    ranges = sorted(k.PREFIX_RANGES)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(k.STATE_REGION) == 51


def test_prefix_states(spark):
    rows = spark.createDataFrame([("10001",), ("90210",), ("60601",), ("00601",), ("99501",), ("88600",)], "zone string")
    got = {r["zone"]: r["prefix_state"] for r in zones.add_prefix_state(rows, "zone").collect()}
    assert got == {"10001": "NY", "90210": "CA", "60601": "IL", "00601": None, "99501": "AK", "88600": "PR"}
