"""Every query with a check SQL agrees with it on the smallest tables."""
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
from compare import TABLES, compare

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()
# The smallest tables have too few deserts for a holdout that models are trained on.
LARGER = {"primary_fold", "primary_medians"}
LARGER_DIR = "/root/testdata/sf0.01"


def _views(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def dbs(sf_dir):
    return {folder: _views(folder) for folder in (sf_dir, LARGER_DIR)}


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, sf_dir, dbs, name):
    folder = LARGER_DIR if name in LARGER else sf_dir
    status, _, detail = compare(spark, folder, name, QUERIES[name], CHECKS[name], dbs[folder])
    assert status == "ok", f"{status} {detail}"
