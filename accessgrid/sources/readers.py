"""File sources and report sinks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accessgrid.functions.scalars import padded_key

STATION_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Station Name", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("ZIP", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Access Code", T.StringType()),
        T.StructField("Status Code", T.StringType()),
        T.StructField("Open Date", T.StringType()),
        T.StructField("EV Level1 EVSE Num", T.IntegerType()),
        T.StructField("EV Level2 EVSE Num", T.IntegerType()),
        T.StructField("EV DC Fast Count", T.IntegerType()),
        T.StructField("EV Network", T.StringType()),
        T.StructField("EV Connector Types", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

# Source column -> column the operators work on.
STATION_COLUMNS = {
    "ID": "id",
    "Station Name": "station_name",
    "City": "city",
    "State": "state",
    "ZIP": "zip",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Access Code": "access_code",
    "Status Code": "status_code",
    "Open Date": "open_date",
    "EV Level1 EVSE Num": "level1_ports",
    "EV Level2 EVSE Num": "level2_ports",
    "EV DC Fast Count": "dcfc_ports",
    "EV Network": "ev_network",
    "EV Connector Types": "connector_types",
    "Country": "country",
}
DAILY_SCHEMA = "state string, day array<date>, tmean array<double>, tmax array<double>, precip array<double>"
CENSUS_SCHEMA = "zcta string, total_population bigint, median_household_income double"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, quoted_lines: bool = False
) -> DataFrame:
    """CSV with a header; ``quoted_lines`` for values that hold line breaks.

    Columns are matched by name when a schema is given, so it may list a part of the file.
    A file with line breaks inside values cannot be split, so it is one task per file.
    """
    options = {"header": "true", "enforceSchema": "false"}
    if quoted_lines:
        options |= {"multiLine": "true", "escape": '"'}
    reader = spark.read.options(**options)
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = reader.csv(path)
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STATION_SCHEMA, quoted_lines=True).withColumnsRenamed(STATION_COLUMNS)


def read_census(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, CENSUS_SCHEMA)
    return df.select(
        padded_key(F.col("zcta")).alias("zone"),
        F.col("total_population").alias("population"),
        F.col("median_household_income").alias("income"),
    )


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text with blanks around the header names; all columns as text."""
    raw = spark.read.options(header="true", sep="\t").csv(path)
    return raw.toDF(*[c.strip() for c in raw.columns])


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Zone centroids with whichever area columns the file has."""
    df = read_tsv(spark, path)
    area = [c for c in df.columns if c in ("ALAND_SQMI", "ALAND", "AREALAND")]
    return df.select(
        padded_key(F.trim("GEOID")).alias("zone"),
        F.trim("INTPTLAT").try_cast("double").alias("zone_lat"),
        F.trim("INTPTLONG").try_cast("double").alias("zone_lon"),
        *[F.trim(c).alias(c) for c in area],
    )


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_first(spark: SparkSession, paths: list[str], empty_schema: str | None = None) -> DataFrame:
    """The first path that exists; an empty frame if none does and a schema is given."""
    for path in paths:
        if path_exists(spark, path):
            return spark.read.parquet(path)
    if empty_schema is None:
        raise FileNotFoundError(f"none of {paths} exists")
    return spark.createDataFrame([], empty_schema)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Nested metric documents; a bare NaN is read as a number."""
    return spark.read.options(multiLine="true", allowNonNumericNumbers="true").json(path)


def seed_rows(
    metrics: DataFrame, per_region: str = "per_region", positives: str = "test_positives"
) -> DataFrame:
    """configurations[].seeds[] as flat rows; documents differ in the names of two fields."""
    configs = metrics.select(F.explode("configurations").alias("c"))
    size = F.col(f"c.{per_region}").alias("per_region")
    seeds = configs.select(size, F.explode("c.seeds").alias("s"))
    return seeds.select(
        "per_region",
        "s.seed",
        F.array_join("s.test_states", ", ").alias("test_states"),
        F.col(f"s.{positives}").alias("test_positives"),
        "s.pr_auc",
    )


def holdout_comparison(seeds: DataFrame) -> DataFrame:
    """Mean score and mean positives per holdout size."""
    return seeds.groupBy("per_region").agg(
        F.count(F.lit(1)).alias("n_seeds"),
        F.avg("test_positives").alias("avg_test_positives"),
        F.avg("pr_auc").alias("pr_auc_mean"),
        F.stddev_pop("pr_auc").alias("pr_auc_std"),
        F.min("pr_auc").alias("pr_auc_min"),
        F.max("pr_auc").alias("pr_auc_max"),
    )


def daily_observations(payloads: DataFrame) -> DataFrame:
    """One row per state and day from rows that hold parallel arrays of daily values."""
    zipped = F.arrays_zip("day", "tmean", "tmax", "precip")
    return payloads.select("state", F.explode(zipped).alias("o")).select("state", "o.*")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """One row per state and day from JSON documents, one on each line, that hold daily arrays."""
    return daily_observations(spark.read.schema(DAILY_SCHEMA).json(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Overwrite, then read back and count."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.parquet(path).count()


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header; reports are small, so one file, and what makes them stays parallel."""
    df.repartition(1).write.mode("overwrite").option("header", "true").csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """JSON documents, one per row."""
    df.write.mode("overwrite").json(path)
