"""Change propagation: from changed reading files to the folders that depend on them.

Beside the tables, an update keeps the partial sums of every reading file by station,
pollutant, day and level.  When files have landed, changed or gone:

1. The sums of just these files are made anew.  Where they differ from the kept ones lie the
   touched station-days; they are noted before anything is replaced, so an update that was
   broken off is taken up by the next.
2. The station-day folders (country, year) of touched days are rebuilt from kept sums.
3. A touched day reaches ``AHEAD`` rows on by lags and rolling means and ``BACK`` rows back by
   targets; the folders of the feature store and its yearly summary that hold such rows are
   rebuilt from the written station-days of their countries.

Folders that depend on no changed file are neither written nor, apart from the histories of
touched countries, read.  The manifest is written last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from airshed import fixed_values as fv
from airshed.operators import features, readings as rd, summary
from airshed.session import kept
from airshed.sources import manifest as mf, tables
from airshed.sources.readings import load_readings
from airshed.sources.sinks import PARTITION_KEYS, remove_partitions, write_partitioned

AHEAD = max(*fv.LAG_DAYS, *fv.ROLLING_DAYS)
BACK = 2
PLACE = ["country_code", "year"]


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


TEXT, WHOLE, NUMBER, DAY = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType()
PARTIALS = _schema(station_id=TEXT, pollutant=TEXT, date=DAY, rank=WHOLE, total=NUMBER, n=T.LongType(), top=NUMBER,
                   country_code=TEXT, year=WHOLE, source=TEXT)
NOTED = _schema(station_id=TEXT, date=DAY, country_code=TEXT, year=WHOLE)
MANIFEST = _schema(file_name=TEXT, size_bytes=T.LongType(), modified=T.TimestampType())


@dataclass(frozen=True)
class Tables:
    """Where an update keeps its tables."""

    base: str

    def __getattr__(self, name: str) -> str:
        return f"{self.base}/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def file_partials(spark: SparkSession, raw: str, names: list[str], schema: T.StructType | None,
                  levels: tuple[str, ...]) -> DataFrame:
    """Partial sums of the named files, and for each name one row without a station, so that
    a file that has gone or has no valid reading replaces its sums too."""
    marks = spark.createDataFrame([(n,) for n in names], "source string")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in PARTIALS.fields[:-1]]
    marks = marks.select(*empty, "source")
    landed = mf.landed_files(spark, raw).select("file_name")
    if landed.filter(F.col("file_name").isin(names)).isEmpty():
        return marks
    source = mf.name_below(raw, F.col("_metadata.file_path"))
    rows = load_readings(spark, raw, schema).withColumn("source", source).filter(F.col("source").isin(names))
    sums = rd.level_partials(rd.prepared(rows), levels, "source")
    sums = sums.withColumns({"country_code": rd.fx.country_of(F.col("station_id")), "year": F.year("date")})
    return sums.select(*PARTIALS.fieldNames()).unionByName(marks)


def touched_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Station-days whose partial sums are not the same in both."""
    same = [*rd.KEYS, "rank", F.round("total", 6).alias("total"), "n", "top", "source", *PLACE]
    sides = old.select(*same, F.lit(1).alias("side")).unionByName(new.select(*same, F.lit(-1).alias("side")))
    differ = (
        sides.filter("station_id is not null")
        .groupBy(*rd.KEYS, "rank", "total", "n", "top", "source", *PLACE).agg(F.sum("side").alias("side"))
        .filter("side <> 0")
    )
    return differ.select(*NOTED.fieldNames()).distinct()


def reached_places(clean: DataFrame, touched: DataFrame, ahead: int = AHEAD, back: int = BACK) -> DataFrame:
    """Folders with rows of a station whose history or targets include a touched day.

    A touched day counts as a row even if it has gone, so the rows behind it are found.
    """
    days = clean.join(touched.select("station_id").distinct(), "station_id", "left_semi")
    rows = days.select(*NOTED.fieldNames(), F.lit(0).alias("hit")).unionByName(touched.withColumn("hit", F.lit(1)))
    rows = rows.groupBy(*NOTED.fieldNames()).agg(F.max("hit").alias("hit"))
    near = Window.partitionBy("station_id").orderBy("date").rowsBetween(-ahead, back)
    return rows.withColumn("hit", F.max("hit").over(near)).filter("hit = 1").select(*PLACE).distinct()


def _replace(df: DataFrame, path: str, places: list[tuple]) -> None:
    """Rewrite the folders of ``places``; those that have no row any more go."""
    df = kept(df, "rebuilt")
    there = {tuple(r) for r in df.select(*PLACE).distinct().collect()}
    write_partitioned(df, path, replace="partitions")
    remove_partitions(df.sparkSession, path, PARTITION_KEYS, [p for p in places if p not in there])


def update(spark: SparkSession, raw: str, weather: str, weekly: str, base: str,
           schema: T.StructType | None = None, levels: tuple[str, ...] = fv.VERIFICATION_LEVELS) -> DataFrame:
    """Bring ``clean``, ``store`` and ``years`` below ``base`` up to date with the reading files.

    Returns rows (table, country_code, year) of the folders that were rebuilt.  The first
    update builds everything; one without changes rebuilds nothing.  Driver state is the
    names of changed files and the touched (country, year) pairs.
    """
    at = Tables(base)
    now = kept(mf.landed_files(spark, raw), "landed")
    diff = mf.manifest_diff(now, _table(spark, at.manifest, MANIFEST))
    names = [r["file_name"] for r in diff.filter("status <> 'unchanged'").collect()]
    if names:
        new = kept(file_partials(spark, raw, names, schema, levels), "partials")
        old = _table(spark, at.partials, PARTIALS).filter(F.col("source").isin(names))
        touched_days(old, new).write.mode("append").parquet(at.pending)
        (new.repartition("source", *PLACE).sortWithinPartitions("source", *PLACE, "station_id").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(at.partials))
    touched = _table(spark, at.pending, NOTED).distinct()
    places = [tuple(r) for r in touched.select(*PLACE).distinct().collect()]
    if not places:
        now.write.mode("overwrite").parquet(at.manifest)
        return spark.createDataFrame([], "table string, country_code string, year int")

    def chosen(pairs: list[tuple]) -> DataFrame:
        return spark.createDataFrame(pairs, "country_code string, year int")

    def of(df: DataFrame, pairs: list[tuple]) -> DataFrame:
        """Rows in the folders; the lists prune what is read."""
        values = [sorted({p[i] for p in pairs}) for i in (0, 1)]
        return df.filter(F.col("country_code").isin(values[0]) & F.col("year").isin(values[1])).join(
            chosen(pairs), PLACE, "left_semi")

    sums = of(_table(spark, at.partials, PARTIALS).filter("station_id is not null"), places)
    days = rd.pivot_levels(rd.merged_partials(sums))
    _replace(days, at.clean, places)

    countries = sorted({c for c, _ in places})
    clean = tables.processed_table(spark, at.clean, days.schema).filter(F.col("country_code").isin(countries))
    reached = [tuple(r) for r in reached_places(clean, touched).collect()]
    weather_days = spark.read.parquet(weather)
    joined = features.join_weather(clean, weather_days)
    history = features.add_calendar(features.add_history(joined))
    deaths = tables.processed_table(spark, weekly, tables.OUTCOME_SCHEMA)
    store = features.join_outcomes(of(history, reached), deaths)
    _replace(store, at.store, reached)
    written = of(tables.processed_table(spark, at.store, store.schema), reached)
    _replace(summary.station_year(written), at.years, reached)

    now.write.mode("overwrite").parquet(at.manifest)
    _remove(spark, at.pending)
    rebuilt = [("clean", *p) for p in places] + [(t, *p) for t in ("store", "years") for p in reached]
    return spark.createDataFrame(rebuilt, "table string, country_code string, year int")
