import math

import pytest
from pyspark.sql import functions as F

from accessgrid.sources import readers, tables
from accessgrid.storage import materialize, shared_folder


def test_station_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        'Fuel,ID,Station Name,City,State,ZIP,Latitude,Longitude,Access Code,Status Code,Open Date,EV Level1 EVSE Num,EV Level2 EVSE Num,EV DC Fast Count,EV Network,EV Connector Types,Country\n'
        'ELEC,1,"A ""big""\nstation",Town,CA,601,34.5,-118.25,public,E,1999-10-15,,2,bad,Net,J1772,US\n'
    )
    row = readers.read_stations(spark, str(path)).first()
    assert row["station_name"] == 'A "big"\nstation' and row["zip"] == "601"
    assert row["level1_ports"] is None and row["level2_ports"] == 2 and row["dcfc_ports"] is None


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,y\n")
    assert dict(readers.read_csv(spark, str(tmp_path / "a.csv")).dtypes) == {"a": "int", "b": "string"}


def test_census_keys_are_padded(spark, tmp_path):
    (tmp_path / "c.csv").write_text("zcta,total_population,median_household_income\n601,17000,\n")
    row = readers.read_census(spark, str(tmp_path / "c.csv")).first()
    assert (row["zone"], row["population"], row["income"]) == ("00601", 17000, None)


def test_gazetteer_header_blanks(spark, tmp_path):
    (tmp_path / "g.txt").write_text("GEOID\tALAND_SQMI\tINTPTLAT\tINTPTLONG        \n601\t64.3\t18.18\t-66.75      \n")
    row = readers.read_gazetteer(spark, str(tmp_path / "g.txt")).first()
    assert (row["zone"], row["zone_lat"], row["zone_lon"], row["ALAND_SQMI"]) == ("00601", 18.18, -66.75, "64.3")


def test_fallback_order(spark, tmp_path):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    assert readers.read_first(spark, [new, old], "a int").count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_first(spark, [new, old])
    spark.range(2).write.parquet(old)
    assert readers.read_first(spark, [new, old]).count() == 2
    spark.range(3).write.parquet(new)
    assert readers.read_first(spark, [new, old]).count() == 3


def test_metrics_document_with_nan(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"configurations": [{"per_region": 2, "seeds": [{"seed": 0, "test_states": ["CA", "NV"], "test_positives": 7, "pr_auc": NaN}, {"seed": 1, "test_states": ["TX"], "test_positives": 9, "pr_auc": 0.5}]}]}')
    rows = readers.seed_rows(readers.read_metrics(spark, str(path))).orderBy("seed").collect()
    assert math.isnan(rows[0]["pr_auc"]) and rows[0]["test_states"] == "CA, NV"
    compared = readers.holdout_comparison(readers.seed_rows(readers.read_metrics(spark, str(path)))).first()
    assert compared["avg_test_positives"] == 8.0 and compared["n_seeds"] == 2


def test_sinks(spark, tmp_path):
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    assert readers.write_parquet(df, str(tmp_path / "p")) == 5
    assert readers.write_parquet(df.limit(2), str(tmp_path / "p"), ["p"]) == 2
    assert readers.read_parquet(spark, str(tmp_path / "p"), ["id"]).columns == ["id"]
    readers.write_report(df, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1
    readers.write_metrics(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 5


def test_daily_observations(spark):
    df = spark.createDataFrame([("CA", ["d1", "d2"], [1.0, None], [2.0, 3.0], [0.0, 0.1])], "state string, day array<string>, tmean array<double>, tmax array<double>, precip array<double>")
    assert [(r["day"], r["tmean"]) for r in readers.daily_observations(df).collect()] == [("d1", 1.0), ("d2", None)]


def test_materialize_uses_the_sessions_folder(spark):
    out = materialize(spark.range(3))
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2]
    assert all(shared_folder(spark).split(":")[-1] in f for f in out.inputFiles())


def test_many_customers_keep_their_zones(spark, tmp_path):
    """Keys of six digits stay whole: as many zones as customers."""
    customers = spark.range(1, 150_001).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey", "cast(0 AS double) AS c_acctbal")
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(25).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name", "id % 5 AS n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.range(5).selectExpr("id AS r_regionkey", "concat('R', id) AS r_name").write.parquet(str(tmp_path / "region.parquet"))
    assert tables.table(spark, str(tmp_path), "zones").select("zone").distinct().count() == 150_000
