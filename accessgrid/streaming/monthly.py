"""The monthly event rollup kept up to date while stations arrive.

The batch operator is used as it is.  State is one row per zone and month, the size of the
result itself, so no watermark is needed to bound it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.readwriter import DataStreamWriter

from accessgrid.operators.panel import monthly_events


def monthly_event_stream(stations: DataFrame, mode: str = "update") -> DataStreamWriter:
    """Writer for the rollup of a station stream; the caller picks sink and checkpoint."""
    return monthly_events(stations).writeStream.outputMode(mode)
