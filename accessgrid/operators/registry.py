"""Things that are made once and kept in the shared folder under a hash of all they depend on."""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.storage import removed_at_exit, shared_folder

T = TypeVar("T")


def fingerprint(df: DataFrame) -> str:
    """Names, row count and order-free checksums of a frame: changes with any value of any row.

    Two independent 64-bit hashes are added up; rows that are there twice count twice.
    """
    rows = df.select(F.xxhash64(*df.columns).alias("a"), F.xxhash64(F.lit(1), *df.columns).alias("b"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string") for c in ("a", "b")]
    return json.dumps([df.dtypes, *rows.agg(F.count("*").cast("string"), *sums).first()])


def registry_key(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, default=str).encode()).hexdigest()


def stored(spark: SparkSession, kind: str, key: str, make: Callable[[], T], save: Callable[[T, str], None], load: Callable[[SparkSession, str], T]) -> T:
    """What is kept under the key, made and saved first where nothing is.

    It is saved in a folder of its own, which takes the key's place in one step; of two sessions that
    make the same thing the first one's stays.  It goes when the application that made it ends.
    """
    home = f"{shared_folder(spark)}/accessgrid/{kind}"
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/{key}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        thing, draft = make(), f"{home}/.{uuid.uuid4().hex}"
        save(thing, draft)
        removed_at_exit(spark, draft)
        if not files.exists(place):
            files.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), place)
            removed_at_exit(spark, f"{home}/{key}")
    return load(spark, f"{home}/{key}")
