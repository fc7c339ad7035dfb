from pyspark.sql import functions as F

from accessgrid.operators.panel import monthly_events
from accessgrid.plans.inputs import cleaned_stations
from accessgrid.streaming.monthly import monthly_event_stream


def test_stream_ends_at_the_batch_result(spark, sf_dir, tmp_path):
    stations = cleaned_stations(spark, sf_dir).select("zip", "install_year", "install_month", "dcfc_ports", "is_dcfc")
    stations.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(stations.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = monthly_event_stream(stream, "complete").format("memory").queryName("monthly").start()
    query.processAllAvailable()
    query.stop()
    want = monthly_events(stations)
    got = spark.table("monthly").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.agg(F.count(F.lit(1))).first()[0] > 0
