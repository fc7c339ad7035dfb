"""Permutation-filled lookup table: placement of rows on shards.

The shards take turns claiming slots of a prime-sized table, each in its own order of preference
(offset + j * skip modulo the size).  A key's slot is its hash modulo the size, so placing a row is
one look-up in a broadcast table whose size is the parameter `slots`, whatever the data holds.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accessgrid.llm.common import scratch

#: Prime, and more than 100 times the shards, so that shards differ by about 1 % of their slots.
SLOTS = 65_537
#: Rows that one file of a shard holds on average when the shards are written.
PART_ROWS = 100_000


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be there, and differ")
    if not _prime(slots) or slots < len(shards):
        raise ValueError("the table's size must be a prime of at least the number of shards")
    steps = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        offset = int.from_bytes(digest[:8], "big") % slots
        skip = int.from_bytes(digest[8:], "big") % max(1, slots - 1) + 1
        steps.append([offset, skip])
    owner, left = [-1] * slots, slots
    while left:
        for shard, step in enumerate(steps):
            while owner[step[0]] >= 0:
                step[0] = (step[0] + step[1]) % slots
            owner[step[0]] = shard
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The filled table as rows (slot, shard): exactly `slots` rows."""
    owners, names = ",".join(map(str, fill(shards, slots))), F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return rows.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Adds `slot` int and `shard` string.

    Equal keys go to one shard, repeated rows too.  Rows without a key are spread by the hash of
    their other values (all-null rows share a slot).  Empty tables give empty results.  A column
    named slot or shard is replaced.
    """
    values = [F.col(f"`{c}`") for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    hashed = F.coalesce(F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key))), F.xxhash64(*values))
    bare = df.withColumn("_slot", F.pmod(hashed, F.lit(slots)).cast("int")).drop("slot", "shard")
    found = F.broadcast(lookup_table(df.sparkSession, shards, slots))  # `slots` rows, whatever the data
    return bare.join(found, bare["_slot"] == found["slot"]).drop("_slot")


def parts(placed: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Adds `part` int: shards with more than part_rows rows are cut by row hash, so that no task
    holds a shard whole, also if one key holds most rows of it."""
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("_parts"))
    sized = placed.join(F.broadcast(sizes), "shard")  # a row for each shard
    spread = F.xxhash64(F.monotonically_increasing_id())
    return sized.withColumn("part", F.pmod(spread, F.col("_parts")).cast("int")).drop("_parts")


def write_shards(placed: DataFrame, path: str, part_rows: int = PART_ROWS) -> None:
    """One folder for each shard, its parts as files of even size."""
    parts(placed, part_rows).repartition("shard", "part").write.partitionBy("shard").parquet(path)


def through_shards(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, part_rows: int = PART_ROWS) -> DataFrame:
    """Whole rows placed, written to their shards in the shared folder, and read from there.

    All columns of df with slot, shard and part; columns of these names are replaced.  Rows, repeated
    and null ones too, come back as often as they were there; an empty table comes back empty.
    """
    placed = place(df.drop("part"), key, shards, slots)
    path = scratch(df.sparkSession)
    write_shards(placed, path, part_rows)
    found = df.sparkSession.read.schema(parts(placed, part_rows).schema).parquet(path)
    return found.select(*placed.columns, "part")
