"""What has landed in a folder, file by file: size, rows and columns.

Reading files, grid months, statistical tables and the mortality file are checked alike;
a contract says which columns each must have and how large it must be at least.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from airshed import fixed_values as fv
from airshed.sources.manifest import landed_files, name_below


@dataclass(frozen=True)
class Contract:
    """What a kind of file must be like; ``format`` is a Spark source with a header option."""

    required: tuple[str, ...]
    min_bytes: int
    pattern: str = "*.parquet"
    format: str = "parquet"


READINGS = Contract(tuple(fv.REQUIRED_READING_COLUMNS), fv.MIN_READING_BYTES)
GRID = Contract(tuple(fv.GRID_VARIABLES), fv.MIN_GRID_BYTES)
OUTCOMES = Contract(("geo",), 1)
MORTALITY = Contract(("country", "cause", "year"), 1, "*.csv", "csv")


def file_columns(spark: SparkSession, folder: str, contract: Contract) -> DataFrame:
    """Rows (file_name, columns): the columns of each file by its own schema.

    Only footers and header lines are read.  The driver goes through the list of landed
    datasets, which is as long as the landing contract, not as the data.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", contract.pattern).load(folder)
        .select(F.regexp_replace("path", r"/part-[^/]*$", "").alias("path")).distinct()
        .select("path", name_below(folder, F.col("path")).alias("file_name")).collect()
    )
    rows = []
    for r in listed:
        try:
            found = spark.read.option("header", True).format(contract.format).load(r["path"]).columns
        except (PySparkException, Py4JError):  # no readable footer or header
            found = []
        rows.append((r["file_name"], found))
    return spark.createDataFrame(rows, "file_name string, columns array<string>")


def inspect(spark: SparkSession, folder: str, expected: DataFrame, contract: Contract) -> DataFrame:
    """Expected files (file_name) with what was found: size, rows, missing columns."""
    sizes = landed_files(spark, folder, contract.pattern).select("file_name", "size_bytes")
    columns = file_columns(spark, folder, contract)
    path = F.regexp_replace("_metadata.file_path", r"/part-[^/]*$", "")
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", contract.pattern).option("ignoreCorruptFiles", True)
    # Rows are only counted: no column is read, and no schema is looked for in broken files.
    rows = reader.schema(f"`{contract.required[0]}` string").format(contract.format).load(folder).groupBy(
        name_below(folder, path).alias("file_name")).agg(F.count("*").alias("n_rows"))
    needed = F.array(*[F.lit(c) for c in contract.required])
    joined = expected.join(sizes, "file_name", "left").join(columns, "file_name", "left").join(
        rows, "file_name", "left")
    found = F.col("size_bytes").isNotNull()
    return joined.select(
        "file_name", found.alias("found"), "size_bytes",
        F.when(found, F.coalesce("n_rows", F.lit(0))).alias("n_rows"),
        F.array_except(needed, F.coalesce("columns", F.array().cast("array<string>"))).alias("missing_columns"),
    )
