"""Statistical tables and processed tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airshed import fixed_values as fv

WHO_FILE = "mortalitydata.csv"
WHO_COLUMNS = ["country", "cause", "year", "deaths1"]

OUTCOME_SCHEMA = T.StructType([
    T.StructField("nuts3_code", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("deaths", T.DoubleType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("year", T.IntegerType()),
])

#: The weather grid as a long table, one row per node and hour.
GRID_SCHEMA = T.StructType(
    [T.StructField("time", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in ("latitude", "longitude", *fv.GRID_VARIABLES)])


def wide_table(spark: SparkSession, path: str) -> DataFrame:
    """A table with one column per period."""
    return spark.read.parquet(path)


def processed_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A partitioned table; a schema keeps codes that look like numbers as text."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def who_table(spark: SparkSession, folder: str, file_name: str = WHO_FILE) -> DataFrame:
    """The mortality CSV from anywhere below a folder, as text columns.

    No file gives an empty table: this source is optional.
    """
    reader = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_name)
        .option("header", True)
    )
    try:
        return reader.csv(folder)
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        schema = ", ".join(f"{c} string" for c in WHO_COLUMNS)
        return spark.createDataFrame([], schema)
