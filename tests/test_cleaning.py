import pytest
from pyspark.sql import functions as F

from accessgrid.operators import cleaning, quality, zones
from accessgrid.sources.tables import table


def test_not_equal_drops_null(spark):
    df = spark.createDataFrame([(None,), ("PR",), ("CA",)], "state string")
    assert [r["state"] for r in cleaning.exclude_value(df, "state", "PR").collect()] == ["CA"]


def test_dedupe_prefers_known_state(spark):
    df = spark.createDataFrame([("z", None, 9.0), ("z", "CA", 1.0), ("z", "CA", None)], "zone string, state string, population double")
    rows = zones.dedupe_zones(df).collect()
    assert [(r["zone"], r["state"], r["population"]) for r in rows] == [("z", "CA", 1.0)]


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in cleaning.drop_duplicates_last(df, ["k"], ["t"]).collect()} == {("a", "y"), ("b", "z")}


@pytest.mark.parametrize("column, raw, want", [("ALAND_SQMI", "2", 5.17998), ("ALAND", 3e6, 3.0), ("ALAND", 2.0, 5.17998), ("AREALAND", 5e6, 5.0)])
def test_area_units(spark, column, raw, want):
    kind = "string" if isinstance(raw, str) else "double"
    df = spark.createDataFrame([(raw,)], f"{column} {kind}")
    assert cleaning.area_km2(df).first()["area_km2"] == pytest.approx(want)


def test_area_needs_a_known_column(spark):
    with pytest.raises(ValueError):
        cleaning.area_km2(spark.range(1))


def test_cleaning_funnel_matches_known_counts(spark, sf_dir):
    rows = quality.funnel(table(spark, sf_dir, "stations_raw"), cleaning.station_steps()).orderBy("step_no").collect()
    assert [r["rows_left"] for r in rows] == [1500, 799, rows[2]["rows_left"], 760]
    assert cleaning.clean_stations(table(spark, sf_dir, "stations_raw")).count() == 760


def test_lookup_keeps_rows(spark, sf_dir):
    from accessgrid.operators.lookup import lookup_left

    stations = table(spark, sf_dir, "stations_raw").select("id", F.col("zip").alias("zone"))
    assert quality.rows_preserved(stations, lookup_left(stations, table(spark, sf_dir, "zones"), ["zone"]))


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing"):
        quality.require_columns(spark.range(1), ["id", "nope"])


def test_null_profile_of_empty_table(spark):
    rows = quality.null_profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["null_count"], r["null_percent"]) for r in rows] == [(0, None), (0, None)]


def test_filled_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert cleaning.filled_columns(df, ["a", "b", "c"]) == ["a"]


def test_label_fallbacks(spark):
    base = spark.createDataFrame([(1,), (0,), (None,)], "is_desert int")
    assert [r[-1] for r in zones.label_coverage(base, "s").collect()] == ["Charging Desert", "Adequate Coverage", "Unknown"]
    ports = spark.createDataFrame([(0,), (3,), (None,)], "dcfc_ports int")
    assert [r[-1] for r in zones.label_coverage(ports, "s").collect()] == ["Charging Desert", "Adequate Coverage", "Charging Desert"]
    with pytest.raises(ValueError):
        zones.label_coverage(spark.range(1))


def test_zone_features_without_optional_inputs(spark):
    base = spark.createDataFrame([("1", "CA", "West", 500.0, 10.0), ("2", None, None, 5.0, 0.0), ("3", "AK", "West", None, 4.0)], "zone string, state string, region string, population double, area_km2 double")
    weather = spark.createDataFrame([("CA", 1.0)], "state string, avg_temp_c double")
    rows = {r["zone"]: r for r in zones.zone_features(base, weather, non_continental=["AK"]).collect()}
    assert rows["00001"]["rural"] == 1 and rows["00001"]["is_continental"] == 1 and rows["00001"]["avg_temp_c"] == 1.0
    assert rows["00002"]["density"] is None and rows["00002"]["rural"] is None and rows["00002"]["is_continental"] == 0
    assert rows["00003"]["is_continental"] == 0 and rows["00003"]["line_miles"] is None
