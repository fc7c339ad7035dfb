import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from accessgrid.operators import panel


def months(spark, n=20, zones=("a", "b")):
    return spark.createDataFrame(
        [(z, datetime.date(2000 + i // 12, i % 12 + 1, 1), float(i + 1), 0.0) for z in zones for i in range(n)],
        "zone string, month_start date, new_ports double, new_stations double",
    )


def column(df, name, zone="b"):
    return [r[name] for r in df.where(F.col("zone") == zone).orderBy("month_start").collect()]


def test_trailing_sum_starts_anew_in_each_zone(spark):
    out = panel.add_temporal_features(months(spark))
    assert column(out, "ports_lag_3m")[:6] == [None, None, None, 6.0, 9.0, 12.0]
    assert column(out, "ports_lag_1m")[:3] == [None, 1.0, 2.0]
    assert column(out, "ports_cum_to_date")[:4] == [0.0, 1.0, 3.0, 6.0]


def test_forward_sum(spark):
    got = column(panel.add_temporal_features(months(spark)), "ports_next_12m")
    assert got[0] == 90.0 and got[7] == 174.0 and got[8:] == [None] * 12


def test_trailing_including_next(spark):
    got = column(panel.add_temporal_features(months(spark)), "ports_trailing_incl_next_12m")
    assert got[:11] == [None] * 11 and got[11] == 90.0 and got[18] == 174.0 and got[19] is None


def test_calendar_covers_all_months(spark):
    monthly = spark.createDataFrame(
        [("a", datetime.date(1995, 8, 1), 2.0, 1.0), ("zz", datetime.date(2026, 3, 1), 5.0, 1.0)],
        "zone string, month_start date, new_ports double, new_stations double",
    )
    zones = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "zone string")
    out = panel.calendar_panel(zones, monthly)
    assert out.groupBy("zone").count().collect() and out.count() == 2 * 368
    assert out.agg(F.sum("new_ports")).first()[0] == 2.0


def test_monthly_events_drop_unusable_rows(spark):
    rows = [("00601", 2020, 1, 2, 1), ("601", 2020, 1, None, 1), (None, 2020, 1, 9, 1), ("x", 2020, 1, 9, 1), ("601", None, 1, 9, 1), ("601", 2020, 13, 9, 1)]
    df = spark.createDataFrame(rows, "zip string, install_year int, install_month int, dcfc_ports int, is_dcfc int")
    got = panel.monthly_events(df).collect()
    assert [(r["zone"], r["month_start"], r["new_ports"], r["new_stations"]) for r in got] == [("00601", datetime.date(2020, 1, 1), 2.0, 2.0)]


def test_test_period_is_the_last_year(spark):
    out = panel.mark_test_period(months(spark, 30))
    assert column(out, "is_test_period").count(True) == 12


def test_latest_per_key(spark):
    got = panel.latest_per_key(months(spark), "zone", "month_start", ["new_ports"]).collect()
    assert {(r["zone"], r["new_ports"]) for r in got} == {("a", 20.0), ("b", 20.0)}


def events(spark, n, zones=40, share=0.3, seed=2):
    """Events of some zones in some months, the first and last month among them."""
    rng = random.Random(seed)
    day = lambda m: datetime.date(1800 + m // 12, m % 12 + 1, 1)
    rows = [(f"z{z}", day(m), float(rng.randint(0, 9)), float(rng.randint(0, 3))) for z in range(zones) for m in range(n) if rng.random() < share]
    rows += [("z0", day(0), 1.0, 1.0)] * (not any(r[:2] == ("z0", day(0)) for r in rows)) + [("z1", day(n - 1), 1.0, 1.0)] * (not any(r[:2] == ("z1", day(n - 1)) for r in rows))
    return spark.createDataFrame(rows, "zone string, month_start date, new_ports double, new_stations double")


@pytest.mark.parametrize("n", [1, 2, 12, 13, 16, 17, 60])
def test_arrays_equal_windows(spark, n):
    monthly = events(spark, n)
    zones = spark.createDataFrame([(f"z{z}",) for z in range(45)] + [("z1",), (None,)], "zone string")
    want = panel.add_temporal_features(panel.calendar_panel(zones, monthly))
    got = panel.temporal_panel(zones, monthly)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 45 * n


def test_calendar_by_brute_force(spark):
    monthly = events(spark, 30)
    known = {(r["zone"], r["month_start"]): (r["new_ports"], r["new_stations"]) for r in monthly.collect()}
    got = panel.calendar_panel(monthly.select("zone"), monthly).collect()
    assert {(r["zone"], r["month_start"]): (r["new_ports"], r["new_stations"]) for r in got} == {
        (z, datetime.date(1800 + m // 12, m % 12 + 1, 1)): known.get((z, datetime.date(1800 + m // 12, m % 12 + 1, 1)), (0.0, 0.0))
        for z in {k[0] for k in known} for m in range(30)
    }


def test_no_events_no_months(spark):
    none = events(spark, 3).limit(0)
    zones = spark.createDataFrame([("a",)], "zone string")
    assert panel.calendar_panel(zones, none).count() == 0 and panel.temporal_panel(zones, none).count() == 0


def test_no_window_and_time_linear_in_months(spark):
    zones, took = spark.createDataFrame([(f"z{z}",) for z in range(160)], "zone string"), {}
    for n in (24, 240, 2400):
        monthly = events(spark, n, zones=160, share=0.1).cache()
        monthly.count()
        out = panel.temporal_panel(zones, monthly)
        plan = out._jdf.queryExecution().toString()
        assert "Window" not in plan and "map_from_entries" not in plan
        out.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        took[n] = time.perf_counter() - start
    # Ten times the months: at most some more than ten times the time.
    assert took[2400] < 20 * max(took[240], 0.3)


def test_few_bytes_of_zones_become_months_in_all_partitions(spark):
    """Zones without events, too, and sums of events in the first and last month."""
    monthly = events(spark, 30, share=0.1)
    zones = spark.createDataFrame([(f"z{z}",) for z in range(200)], "zone string")
    out = panel.temporal_panel(zones, monthly)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = out.withColumn("part", F.spark_partition_id())
    assert rows.agg(F.countDistinct("part")).first()[0] == parts
    want = panel.add_temporal_features(panel.calendar_panel(zones, monthly))
    assert out.exceptAll(want).count() == 0 and out.count() == 200 * 30


def test_month_labels_are_made_once_for_a_month(spark):
    monthly = months(spark, 20, ("a",)).where("month_start != '2000-03-01'")
    out = panel.temporal_panel(spark.createDataFrame([("a",), ("b",), ("b",)], "zone string"), monthly)
    want = [datetime.date(2000 + i // 12, i % 12 + 1, 1) for i in range(20)]
    for zone in "ab":
        assert [tuple(r) for r in out.where(F.col("zone") == zone).orderBy("month_start").select("month_start", "month_num", "year_num", "year_month").collect()] == [
            (d, d.month, d.year, f"{d:%Y-%m}") for d in want
        ]
    # What follows the explode, for each row, formats and adds no dates.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    rows = plan[: plan.index("Generate explode")]
    main = "\n".join(line for line in rows.split("\n") if "scalar-subquery" in line)
    assert main and "date_format" not in main and "add_months" not in main
