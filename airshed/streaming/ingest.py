"""Readings as they arrive: each landed file once, and daily statistics kept current.

Every query here runs with ``availableNow``: it takes what has landed since its
checkpoint and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airshed import fixed_values as fv
from airshed.operators import readings as rd
from airshed.sources.readings import with_level


def reading_stream(spark: SparkSession, folder: str, schema: T.StructType,
                   files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_level(reader.parquet(f"{folder}/*.parquet"))


def ingest_new_files(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append rows of files not seen before; re-running without new files adds nothing."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


#: Runs of one level that are merged into a run of the next.
FAN = 8


def _folder(spark: SparkSession, path: str):
    """The path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _runs(spark: SparkSession, target: str) -> list[tuple[int, int, str]]:
    """(first batch, last batch, path) of every run that was written to its end."""
    root, files = _folder(spark, target)
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        path, name = status.getPath().toString(), status.getPath().getName()
        if name.startswith("run=") and files.exists(_folder(spark, f"{path}/_SUCCESS")[0]):
            first, last = name.removeprefix("run=").split("-")
            found.append((int(first), int(last), path))
    return found


def live_runs(runs: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The runs that count, oldest first: a run within a longer one was merged into it."""
    live = [r for r in runs if not any(o[0] <= r[0] and r[1] <= o[1] and o[:2] != r[:2] for o in runs)]
    return sorted(live)


def _merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*rd.KEYS, "rank").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("top").alias("top"))


def _level(run: tuple[int, int, str], fan: int) -> int:
    size, level = run[1] - run[0] + 1, 0
    while size >= fan ** (level + 1):
        level += 1
    return level


def compact(spark: SparkSession, target: str, fan: int = FAN) -> int:
    """Merge runs like the digits of a counter: ``fan`` neighbours of a level become one.

    After n batches at most (fan - 1) * log(n) runs are left, each with a row per station,
    pollutant, day and level, so reading costs the same however many batches there were.  A
    merged run is complete before its parts go; if a driver is lost in between, the parts
    are left out by ``live_runs``.  Returns the number of live runs.
    """
    runs = _runs(spark, target)
    live = live_runs(runs)
    for _, _, path in set(runs) - set(live):
        place, files = _folder(spark, path)
        files.delete(place, True)
    while True:
        levels = [_level(r, fan) for r in live]
        at = next((i for i in range(len(live) - fan + 1) if len(set(levels[i:i + fan])) == 1), None)
        if at is None:
            return len(live)
        parts = live[at:at + fan]
        path = f"{target}/run={parts[0][0]:012}-{parts[-1][1]:012}"
        _merged(spark.read.parquet(*[p for *_, p in parts])).write.mode("overwrite").parquet(path)
        for *_, part in parts:
            place, files = _folder(spark, part)
            files.delete(place, True)
        live[at:at + fan] = [(parts[0][0], parts[-1][1], path)]


def accumulate_daily(stream: DataFrame, target: str, checkpoint: str,
                     levels: tuple[str, ...] = fv.VERIFICATION_LEVELS, fan: int = FAN) -> StreamingQuery:
    """Write mergeable daily partial sums of each batch as a run of its own, and merge runs.

    Verified values may follow months after the unverified ones, so no watermark
    is used and no state is held: nothing arrives too late.  A batch that is
    repeated after a failure overwrites its own run; one that had been merged already
    is left out.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"{target}/run={batch_id:012}-{batch_id:012}"
        rd.level_partials(rd.prepared(batch), levels).write.mode("overwrite").parquet(run)
        compact(batch.sparkSession, target, fan)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def current_daily(spark: SparkSession, target: str,
                  levels: tuple[str, ...] = fv.VERIFICATION_LEVELS) -> DataFrame:
    """Merge the partial sums of the live runs: equals the batch result over the same files."""
    merged = _merged(spark.read.parquet(*[path for *_, path in live_runs(_runs(spark, target))]))
    best = merged.groupBy(*rd.KEYS).agg(
        F.min_by(F.col("total") / F.col("n"), "rank").alias("value_mean"),
        F.min_by("top", "rank").alias("value_max"),
        F.min_by("n", "rank").alias("reading_count"),
        F.min("rank").alias("rank"),
    )
    return rd.with_level_name(best, levels)


def windowed_means(stream: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Event-time daily means with a watermark: for a live view that may ignore stragglers.

    State older than the watermark is dropped, so its size follows the stations
    and days in flight, not the history.
    """
    cleaned = rd.clip(rd.valid_only(rd.with_country(rd.standardise(stream))))
    timed = cleaned.withColumn("ts", F.col("timestamp_start").cast("timestamp"))
    return (
        timed.withWatermark("ts", lateness)
        .groupBy("station_id", "pollutant", F.window("ts", "1 day").alias("day"))
        .agg(F.avg("value").alias("value_mean"), F.max("value").alias("value_max"),
             F.count("value").alias("reading_count"))
        .select("station_id", "pollutant", F.to_date("day.start").alias("date"),
                "value_mean", "value_max", "reading_count")
    )


def run_windowed(stream: DataFrame, target: str, checkpoint: str,
                 lateness: str = "3 days") -> StreamingQuery:
    """Append each day once its watermark has passed."""
    return ingest_new_files(windowed_means(stream, lateness), target, checkpoint)
