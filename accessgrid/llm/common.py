"""What the operators of this folder share: tables, scratch folders, row keys, tokens."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accessgrid.storage import shared_folder


#: Column for the key of a row beside all columns of its table; not a name that a table has.
KEY = "key of this step"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share; it goes when the application ends."""
    path = f"{shared_folder(spark)}/accessgrid/{uuid.uuid4().hex}"
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return path


def written(df: DataFrame, **options: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here, the rows outlive executors."""
    path = scratch(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Remove a table made by written() as soon as nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, by: list[Column], out: str) -> DataFrame:
    """The rows, written, with their place from 0 in the order `by`; rows that agree in it, in any order.

    Ranges are cut by Spark and sorted on their own; each begins after the rows of those before it.
    Rows that agree in all of `by` are spread over ranges, too.
    """
    keys = [f"order {n} of this step" for n in range(len(by))] + ["spread of this step"]
    rows = df.withColumns(dict(zip(keys, [*by, F.monotonically_increasing_id()])))
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    rows = written(ranged.withColumn(out, F.monotonically_increasing_id()))
    # The upper bits number the range, the lower 33 the row in it.
    cut = rows.withColumn("range of this step", F.shiftright(out, 33))
    sizes = cut.groupBy("range of this step").agg(F.count("*").alias("rows of this step"))
    earlier = Window.orderBy("range of this step").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    starts = sizes.select("range of this step", F.coalesce(F.sum("rows of this step").over(earlier), F.lit(0)).alias("start of this step"))
    placed = cut.join(starts, "range of this step")
    place = F.col("start of this step") + F.col(out).bitwiseAND((1 << 33) - 1)
    return placed.select(*df.columns, place.alias(out))


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a document: id and hash of its text, so that equal ids with other texts stay apart.

    Rows that agree in both are one document.  Nulls inside the struct compare as equal.
    """
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow; when a task ends, the memory that Arrow keeps for later goes back.

    Python workers outlive their task, so that an executor would hold it through stages without Python.
    """

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def ascii_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts, A-Z lower-cased, with the row each stands in."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    words, rows = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.not_equal(pc.binary_length(words), 0)
    return words.filter(full), rows.filter(full).to_numpy(zero_copy_only=False)
