"""Queries that go through files: landing folder, manifests, sinks and streams.

The landing folder is written from the readings, one dataset per pollutant and
level, below the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from airshed import fixed_values as fv
from airshed.operators import grid, profile as pf, quality as ql
from airshed.plans import incremental
from airshed.registry.cleaning import STORE, STORE_SQL
from airshed.registry.core import query
from airshed.registry.inputs import Inputs
from airshed.session import kept, scratch_path
from airshed.sources import landing as ld
from airshed.sources import manifest as mf
from airshed.sources import quarantine as qr
from airshed.sources import readings as sr
from airshed.sources.sinks import write_partitioned
from airshed.sources.tables import GRID_SCHEMA, WHO_FILE, processed_table, who_table
from airshed.streaming import ingest as si

RAW_COLUMNS = ["AirQualityStationEoICode", "AirPollutant", "Start", "Value", "Validity"]


def _landing(t: Inputs) -> str:
    """All raw readings as files, written in one job."""
    folder = scratch_path(t.spark, "landing")
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    rows = t.raw.select(*RAW_COLUMNS, name.alias("source"))
    rows.hint("rebalance", "source").write.partitionBy("source").parquet(folder)
    return folder


@query("""select AirPollutant as pollutant, verification_level, count(*) as n_rows,
  count(Value) as n_values, min(cast(Start as date)) as first_date,
  max(cast(Start as date)) as last_date from fx_readings group by 1,2""")
def load_readings_by_level(t: Inputs) -> DataFrame:
    return _levels(sr.load_readings(t.spark, _landing(t)))


def _levels(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("AirPollutant").alias("pollutant"), "verification_level").agg(
        F.count("*").alias("n_rows"), F.count("Value").alias("n_values"),
        F.min(F.to_date("Start")).alias("first_date"), F.max(F.to_date("Start")).alias("last_date"),
    )


@query("""select AirQualityStationEoICode, AirPollutant, cast(Start as date) as start_date, Value,
  Validity, verification_level from fx_readings""")
def load_readings(t: Inputs) -> DataFrame:
    return sr.load_readings(t.spark, _landing(t)).select(
        "AirQualityStationEoICode", "AirPollutant", F.to_date("Start").alias("start_date"),
        "Value", "Validity", "verification_level",
    )


@query("""select country_code, year, count(*) as n, count(pm25_mean) as n_pm25,
  max(pm25_max) as top from wide where country_code in ('FR','DE')
  and date between date '2024-01-05' and date '2024-01-25' group by 1,2""", "top")
def scan_pruned(t: Inputs) -> DataFrame:
    folder = scratch_path(t.spark, "clean")
    write_partitioned(t.wide, folder)
    scanned = pf.scan(processed_table(t.spark, folder, t.wide.schema), ["FR", "DE"],
                      "2024-01-05", "2024-01-25")
    return scanned.groupBy("country_code", "year").agg(
        F.count("*").alias("n"), F.count("pm25_mean").alias("n_pm25"), F.max("pm25_max").alias("top")
    )


@query("""select station_id, country_code, year, pm25_mean, date from wide""", "pm25_mean")
def sink_roundtrip(t: Inputs) -> DataFrame:
    """Written, then one half of the countries written again over the same folders."""
    folder = scratch_path(t.spark, "clean")
    slim = t.wide.select("station_id", "date", "pm25_mean", "country_code", "year")
    write_partitioned(slim, folder)
    again = slim.filter(F.col("country_code") < "F")
    write_partitioned(again, folder, replace="partitions")
    return processed_table(t.spark, folder, slim.schema)


@query("""select country, cause, cast(year as varchar) as year, cast(deaths1 as varchar) as deaths1
  from fx_who""")
def load_who(t: Inputs) -> DataFrame:
    folder = scratch_path(t.spark, "who")
    t.view("fx_who").write.option("header", True).csv(f"{folder}/extracted/{WHO_FILE}")
    return who_table(t.spark, folder, "*.csv").select("country", "cause", "year", "deaths1")


MANIFEST = """select concat(AirPollutant, '_', verification_level, '.parquet') as file_name,
  count(*) as size_bytes, max(Start) as modified from fx_readings {where} group by 1"""


def _manifest(rows: DataFrame) -> DataFrame:
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    return rows.groupBy(name.alias("file_name")).agg(
        F.count("*").alias("size_bytes"), F.max("Start").alias("modified")
    )


OLD = "where cast(Start as date) < date '2024-01-20' and AirPollutant <> 'SO2' or AirPollutant = 'O3'"


def _previous(t: Inputs) -> DataFrame:
    """The state some days ago: SO2 had not landed and O3 was complete."""
    early = F.to_date("Start") < F.lit("2024-01-20").cast("date")
    return _manifest(t.raw.filter(
        (early & (F.col("AirPollutant") != "SO2")) | (F.col("AirPollutant") == "O3")
    ))


@query(f"""select c.file_name, c.size_bytes, case when p.file_name is null then 'new'
    when c.size_bytes = p.size_bytes and c.modified <= p.modified then 'unchanged'
    else 'changed' end as status
  from ({MANIFEST.format(where='')}) c left join ({MANIFEST.format(where=OLD)}) p
    on p.file_name = c.file_name""")
def manifest_diff(t: Inputs) -> DataFrame:
    return mf.manifest_diff(_manifest(t.raw), _previous(t)).drop("modified")


@query(f"""select c.file_name, case when p.file_name is null or p.modified < c.modified
    then 'take' else 'skip' end as decision
  from ({MANIFEST.format(where='')}) c left join ({MANIFEST.format(where=OLD)}) p
    on p.file_name = c.file_name""")
def ingest_decision(t: Inputs) -> DataFrame:
    return mf.ingest_decision(_manifest(t.raw), _previous(t), "newer")


@query(f"""select n.pollutant, n.verification_level,
    concat(n.pollutant, '_', n.verification_level, '.parquet') as file_name
  from (select p.pollutant, l.verification_level from
    (select distinct AirPollutant as pollutant from fx_readings) p,
    (select distinct verification_level from fx_readings) l) n
  where concat(n.pollutant, '_', n.verification_level, '.parquet') not in
    (select file_name from ({MANIFEST.format(where=OLD)}))""")
def missing_files(t: Inputs) -> DataFrame:
    pollutants = t.raw.select(F.col("AirPollutant").alias("pollutant")).distinct()
    expected = ql.expected_files(pollutants, t.raw.select("verification_level").distinct())
    return ql.missing_files(expected, _previous(t))


# A file lacks a column, one has no rows, one has not landed.
COLUMN_LESS, EMPTY, ABSENT = "O3_E1a.parquet", "SO2_E1a.parquet", "NO2_E1a.parquet"
CONTRACT = ld.Contract(tuple(RAW_COLUMNS), 1)


def _faulty_landing(t: Inputs) -> str:
    folder = scratch_path(t.spark, "landing")
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    rows = t.raw.select(*RAW_COLUMNS, name.alias("source"))
    good = rows.filter(~F.col("source").isin(COLUMN_LESS, EMPTY, ABSENT))
    good.hint("rebalance", "source").write.partitionBy("source").parquet(folder)
    for file, part in ((COLUMN_LESS, rows.filter(F.col("source") == COLUMN_LESS).drop("Validity")),
                       (EMPTY, rows.limit(0))):
        part.drop("source").coalesce(1).write.parquet(f"{folder}/source={file}")
    return folder


def _report(t: Inputs, folder: str) -> DataFrame:
    pollutants = t.raw.select(F.col("AirPollutant").alias("pollutant")).distinct()
    expected = ql.expected_files(pollutants, t.raw.select("verification_level").distinct())
    found = ld.inspect(t.spark, folder, expected.select("file_name"), CONTRACT)
    return ql.landing_report(found, min_bytes=CONTRACT.min_bytes)


EXPECTED = """select p.pollutant || '_' || l.level || '.parquet' as file_name, n from
    (select distinct AirPollutant as pollutant from fx_readings) p
    cross join (select distinct verification_level as level from fx_readings) l
    left join (select AirPollutant, verification_level, count(*) as n from fx_readings group by 1, 2) r
      on r.AirPollutant = p.pollutant and r.verification_level = l.level"""
VERDICTS = f"""select file_name, n is not null and file_name <> '{ABSENT}' as found,
    case when file_name = '{EMPTY}' then 0 when file_name <> '{ABSENT}' then n end as n_rows,
    n is not null and file_name <> '{ABSENT}' as size_ok,
    n is not null and file_name not in ('{ABSENT}', '{COLUMN_LESS}') as columns_ok,
    n is not null and file_name not in ('{ABSENT}', '{EMPTY}') as rows_ok from ({EXPECTED})"""


@query(f"select *, found and size_ok and columns_ok and rows_ok as passed from ({VERDICTS})")
def landing_report(t: Inputs) -> DataFrame:
    return _report(t, _faulty_landing(t))


@query(f"""select n_landed, all_passed, all_passed and n_landed > 0 as run_downstream from
  (select count(*) as n_landed from ({MANIFEST.format(where='')}) c
    left join ({MANIFEST.format(where=OLD)}) p on p.file_name = c.file_name
    where p.file_name is null or not (c.size_bytes = p.size_bytes and c.modified <= p.modified)),
  (select bool_and(n is not null) as all_passed from ({EXPECTED}))""")
def new_data_gate(t: Inputs) -> DataFrame:
    return ql.new_data_gate(mf.manifest_diff(_manifest(t.raw), _previous(t)), _report(t, _landing(t)))


# --- quarantine ---------------------------------------------------------------------------

# A grid file holds text where a number is declared, one is no Parquet file at all.
MISTYPED, BROKEN = "day_3.parquet", "day_7.parquet"


def _grid_files(t: Inputs) -> str:
    folder = scratch_path(t.spark, "grid")
    name = F.concat(F.lit("day_"), F.dayofmonth("time"), F.lit(".parquet"))
    rows = t.grid.withColumn("source", name)
    good = rows.filter(~F.col("source").isin(MISTYPED, BROKEN))
    good.hint("rebalance", "source").write.partitionBy("source").parquet(folder)
    rows.filter(F.col("source") == MISTYPED).drop("source").withColumn(
        "t2m", F.concat("t2m", F.lit(" K"))).write.parquet(f"{folder}/source={MISTYPED}")
    jvm = t.spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/source={BROKEN}/part-0.parquet")
    out = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.writeBytes("broken off")
    out.close()
    return folder


GRID_DAY = "'day_' || (day_idx + 1) || '.parquet'"


@query(f"""select * from (select file_name, count(*) as n_rows, count(*) as n_kept, cast(null as varchar) as reason
    from (select {GRID_DAY} as file_name from fx_grid) where file_name not in ('{MISTYPED}', '{BROKEN}') group by 1)
  union all select '{MISTYPED}', count(*), 0, '{qr.ROWS}' from fx_grid where {GRID_DAY} = '{MISTYPED}'
  union all select '{BROKEN}', 0, 0, '{qr.FOOTER}'""")
def grid_quarantine(t: Inputs) -> DataFrame:
    """Datasets of the grid with what each holds, what is kept of it and why not more."""
    folder = _grid_files(t)
    report = kept(qr.file_report(t.spark, folder, GRID_SCHEMA), "report")
    rows = qr.sound_rows(t.spark, folder, GRID_SCHEMA, report)
    taken = rows.groupBy(F.dayofmonth("time").alias("day")).agg(F.count(F.lit(1)).alias("n_kept"))
    taken = taken.select(F.concat(F.lit("day_"), "day", F.lit(".parquet")).alias("file_name"), "n_kept")
    return report.groupBy("file_name").agg(
        F.sum("n_footer").alias("n_rows"), F.max("reason").alias("reason")).join(taken, "file_name", "left").select(
        "file_name", "n_rows", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), "reason")


@query("""select station_id, date, temp_2m, precipitation from weather
  where day(date) not in (3, 7)""", "temp_2m precipitation")
def weather_quarantined(t: Inputs) -> DataFrame:
    """Station-days of a grid with two bad files: the other days as ever."""
    folder = _grid_files(t)
    report = kept(qr.file_report(t.spark, folder, GRID_SCHEMA), "report")
    hours = qr.sound_rows(t.spark, folder, GRID_SCHEMA, report)
    return grid.station_weather(hours, t.stations).select("station_id", "date", "temp_2m", "precipitation")


# --- incremental rebuild ------------------------------------------------------------------

def early_state(t: Inputs) -> DataFrame:
    """Reading files as they were: one had not landed, one lacked the last days of Germany,
    one held other French values and days that were withdrawn."""
    day, country = F.to_date("Start"), F.substring("AirQualityStationEoICode", 1, 2)
    file = F.concat("AirPollutant", F.lit("_"), "verification_level")
    late = (file == "PM2.5_E1a") & (country == "DE") & (day >= F.lit("2024-01-20").cast("date"))
    rows = t.raw.filter((file != "NO2_E1a") & ~late)
    altered = (file == "PM10_E1a") & (country == "FR")
    more = rows.filter(altered & (F.dayofmonth(day) <= 3)).withColumn(
        "Start", F.expr("cast(Start as timestamp) + interval 400 days").cast(rows.schema["Start"].dataType))
    changed = F.when(altered, (F.col("Value").try_cast("double") + 1).cast(rows.schema["Value"].dataType)).otherwise(F.col("Value"))
    return rows.withColumn("Value", changed).unionByName(more)


def write_readings(rows: DataFrame, folder: str) -> None:
    """One dataset per pollutant and level; those that have rows are replaced."""
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    (rows.select(*RAW_COLUMNS, name.alias("source")).hint("rebalance", "source").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(folder))


def prepare_update(t: Inputs, base: str) -> dict[str, str]:
    """The other inputs of an update, written below ``base``."""
    paths = {k: f"{base}/{k}" for k in ("weather", "weekly")}
    write_partitioned(t.weather, paths["weather"])
    write_partitioned(t.weekly, paths["weekly"])
    return paths


@query(*STORE_SQL)
def incremental_store(t: Inputs) -> DataFrame:
    """Built from an early state of the files, then brought up to date with those that changed."""
    base = scratch_path(t.spark, "update")
    inputs, raw = prepare_update(t, base), f"{base}/raw"
    changed = ["NO2_E1a", "PM2.5_E1a", "PM10_E1a"]
    write_readings(early_state(t), raw)
    incremental.update(t.spark, raw, inputs["weather"], inputs["weekly"], base)
    file = F.concat("AirPollutant", F.lit("_"), "verification_level")
    write_readings(t.raw.filter(file.isin(changed)), raw)
    incremental.update(t.spark, raw, inputs["weather"], inputs["weekly"], base)
    return processed_table(t.spark, f"{base}/store", t.store.schema).select(*STORE)


# --- streams ------------------------------------------------------------------------------

def _stream(t: Inputs, files_per_batch: int | None = None) -> DataFrame:
    schema = T.StructType([f for f in t.raw.schema.fields if f.name in RAW_COLUMNS])
    return si.reading_stream(t.spark, _landing(t), schema, files_per_batch)


@query("""select AirPollutant as pollutant, verification_level, count(*) as n_rows,
  count(Value) as n_values, min(cast(Start as date)) as first_date,
  max(cast(Start as date)) as last_date from fx_readings group by 1,2""")
def stream_ingest(t: Inputs) -> DataFrame:
    target, state = scratch_path(t.spark, "ingested"), scratch_path(t.spark, "state")
    si.ingest_new_files(_stream(t), target, state)
    return _levels(t.spark.read.parquet(target))


@query("""select station_id, pollutant, date, value_mean, value_max, reading_count,
  verification_level from daily""", "value_mean value_max")
def stream_daily(t: Inputs) -> DataFrame:
    """Fed a few files at a time; the merged result is that of the batch."""
    target, state = scratch_path(t.spark, "partials"), scratch_path(t.spark, "state")
    si.accumulate_daily(_stream(t, files_per_batch=4), target, state)
    return si.current_daily(t.spark, target).select(
        "station_id", "pollutant", "date", "value_mean", "value_max", "reading_count",
        "verification_level",
    )


@query()
def stream_windowed(t: Inputs) -> DataFrame:
    """Days whose watermark has passed; the last days stay open."""
    target, state = scratch_path(t.spark, "windows"), scratch_path(t.spark, "state")
    si.run_windowed(_stream(t), target, state)
    return t.spark.read.parquet(target)
