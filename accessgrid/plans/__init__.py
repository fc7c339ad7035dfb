"""Named queries over the given tables, and the SQL their results are compared with."""
from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FAMILIES = ["stations", "coverage", "context", "sites", "installations", "scores", "models", "files"]


def _merged(name: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        part = getattr(import_module(f"accessgrid.plans.{family}"), name)
        twice = out.keys() & part.keys()
        if twice:
            raise ValueError(f"query registered twice: {sorted(twice)}")
        out.update(part)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def check_sql() -> dict[str, str]:
    return _merged("ORACLES")
