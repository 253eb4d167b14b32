"""Checks of landed files and of the feature store.  Each check is a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from airshed import fixed_values as fv
from airshed.functions import columns as fx


def check(name: str, condition: Column, observed: Column, threshold: float,
          critical: bool = False) -> Column:
    """One check as a struct; a condition that cannot be decided has failed."""
    return F.struct(
        F.lit(name).alias("check_name"),
        F.coalesce(condition, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(critical).alias("critical"),
    )


def _rows(aggregated: DataFrame, checks: list[Column]) -> DataFrame:
    return aggregated.select(F.inline(F.array(*checks)))


KEY_COLUMNS = ["station_id", "date", "country_code"]
TARGETS = ["pm25_exceedance_t1", "pm25_exceedance_t2"]


def series_rows(df: DataFrame) -> DataFrame:
    """One row per station-day with its neighbours in time, from one pass over the table.

    Copies of a key are merged before the windows, so however many copies there
    are, a station's window holds one row per day.  What has to be counted per row
    of the table (copies, missing values) is carried along as sums.  Rows with a
    missing key stay in the counts but have no neighbours.
    """
    measures = ["pm25_mean", TARGETS[0], "boundary_layer_height", "pm25_mean_rolling7d",
                *[f"pm25_mean_lag{n}" for n in fv.LAG_DAYS],
                *[f"boundary_layer_height_lag{n}" for n in fv.LAG_DAYS]]
    counted = [c for c in [*KEY_COLUMNS, *TARGETS, "pm25_mean", "temp_2m"] if c in df.columns]
    targets = [c for c in TARGETS if c in df.columns]
    days = df.groupBy("station_id", "date").agg(
        F.count("*").alias("copies"),
        *[F.count(c).alias(f"n_{c}") for c in counted],
        *[F.count_if(~F.col(c).isin(0, 1)).alias(f"odd_{c}") for c in targets],
        *[F.sum(c).alias(f"sum_{c}") for c in targets],
        *[F.max(c).alias(c) for c in measures if c in df.columns],
    )
    w = Window.partitionBy("station_id").orderBy("date")
    known = F.col("station_id").isNotNull() & F.col("date").isNotNull()
    neighbours = {
        "previous_date": F.lag("date").over(w),
        "pm25_yesterday": F.lag("pm25_mean").over(w),
        "pm25_tomorrow": F.lead("pm25_mean").over(w),
        "pm25_past_max": F.max("pm25_mean").over(w.rowsBetween(-7, -1)),
        "next_date": F.lead("date").over(w),
        "date_six_back": F.lag("date", 6).over(w),
    }
    rows = days.select("*", known.alias("known"), *[
        F.when(known, c).alias(name) for name, c in neighbours.items()
    ])
    return rows.withColumn("gap_days", F.datediff("date", "previous_date"))


def _days_apart(later: str, earlier: str, days: int, filtered: bool) -> Column:
    """In a store without the rows that lack targets, only rows of consecutive days are
    sure to have been neighbours when the features were made."""
    apart = F.datediff(later, earlier)
    return F.coalesce(apart == days, F.lit(False)) if filtered else F.lit(True)


def lag_errors(filtered: bool = True) -> Column:
    """lag1 must be the previous row's value; a first row has nothing to compare."""
    later = F.col("previous_date").isNotNull() & _days_apart("date", "previous_date", 1, filtered)
    return later & ~fx.near(F.col("pm25_mean_lag1"), F.col("pm25_yesterday"))


def tomorrow_known(filtered: bool = True) -> Column:
    return F.col("pm25_tomorrow").isNotNull() & _days_apart("next_date", "date", 1, filtered)


def target_errors(limit: float = fv.EU_DAILY_LIMIT, filtered: bool = True) -> Column:
    """Target against tomorrow's value, where tomorrow has one."""
    known = tomorrow_known(filtered) & F.col("pm25_exceedance_t1").isNotNull()
    return known & (fx.exceeds(F.col("pm25_tomorrow"), limit) != F.col("pm25_exceedance_t1"))


def bound_errors(filtered: bool = True) -> Column:
    """A mean of past values cannot exceed their maximum."""
    above = F.col("pm25_mean_rolling7d") > F.col("pm25_past_max") + 1e-6
    return above & _days_apart("date", "date_six_back", 6, filtered)


def temporal_gaps(df: DataFrame, long_gap: int = 30) -> DataFrame:
    """Per station: gaps between consecutive dates, long ones, and the longest (shown <= 60)."""
    gap = F.col("gap_days")
    longest = F.max(F.when(gap > 1, gap))
    return series_rows(df).filter("known").groupBy("station_id").agg(
        F.count("*").alias("n_days"),
        F.count_if(gap > 1).alias("n_gaps"),
        F.count_if(gap > long_gap).alias("n_long_gaps"),
        longest.alias("longest_gap"),
        F.least(longest, F.lit(60)).alias("longest_gap_shown"),
    )


def store_checks(df: DataFrame, min_rows: int = 500_000, limit: float = fv.EU_DAILY_LIMIT,
                 filtered: bool = True) -> DataFrame:
    """Keys, missing values, leakage, targets and continuity, on every row of the store.

    ``filtered`` says that rows lacking a target were dropped (strict targets);
    neighbours are then compared only across consecutive days.

    The table is read once; one shuffle brings copies of a key together and one
    brings the days of a station together.
    """
    by_station = Window.partitionBy("station_id")
    gap = F.col("gap_days")
    rows = series_rows(df).withColumn(
        "station_has_gap", F.max(fx.flag(gap > 1)).over(by_station)
    )
    lag_pairs = [(s, f"{s}_lag{n}") for s in ("pm25_mean", "boundary_layer_height")
                 for n in fv.LAG_DAYS if f"{s}_lag{n}" in df.columns]
    first = F.col("known") & F.col("previous_date").isNull()
    positive = (F.col(TARGETS[0]) == 1) & tomorrow_known(filtered)
    needed = [*KEY_COLUMNS, *TARGETS]
    found = rows.agg(
        F.sum("copies").alias("n"),
        F.sum(F.col("copies") - 1).alias("surplus"),
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in [*needed, "pm25_mean", "temp_2m"]],
        *[F.sum(f"odd_{c}").alias(f"odd_{c}") for c in TARGETS],
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in TARGETS],
        F.count_if(lag_errors(filtered)).alias("lag_errors"),
        fx.correlation(F.col("pm25_mean"), F.col("pm25_mean_rolling7d")).alias("r_rolling"),
        F.count_if(target_errors(limit, filtered)).alias("target_errors"),
        F.count_if(positive).alias("positives"),
        F.count_if(positive & (F.col("pm25_tomorrow") > limit)).alias("right_positives"),
        F.count_if(bound_errors(filtered)).alias("bound_errors"),
        F.count_if(first).alias("stations"),
        F.count_if(first & (F.col("station_has_gap") == 1)).alias("gap_stations"),
        F.count_if(gap > 1).alias("gaps"),
        F.count_if(gap > 30).alias("long_gaps"),
        *[fx.correlation(F.col(a), F.col(b)).alias(f"r_{b}") for a, b in lag_pairs],
    )
    n = F.col("n")
    rate = [fx.ratio(F.col(f"sum_{c}"), F.col(f"n_{c}")) * 100 for c in TARGETS]
    apart = F.abs(rate[0] - rate[1])
    pm25_null = fx.ratio(n - F.col("n_pm25_mean"), n) * 100
    weather = fx.ratio(F.col("n_temp_2m"), n) * 100
    lag_r = [F.col(f"r_{b}") for _, b in lag_pairs]
    highest = F.greatest(*lag_r, F.lit(None).cast("double")) if lag_r else F.lit(None)
    # A pair whose correlation cannot be told leaves the check undecided: failed.
    lag_told = fx.all_of([r.isNotNull() for r in lag_r]) if lag_r else F.lit(False)
    right = fx.ratio(F.col("right_positives"), F.col("positives")) * 100
    gap_share = fx.ratio(F.col("gap_stations"), F.col("stations")) * 100
    long_share = F.coalesce(fx.ratio(F.col("long_gaps"), F.col("gaps")) * 100, F.lit(0.0))

    def none(name: str, count: Column, critical: bool = False) -> Column:
        return check(name, count == 0, count, 0, critical)

    return _rows(found, [
        check("enough_rows", n > min_rows, n, min_rows),
        *[none(f"no_null_{c}", n - F.col(f"n_{c}"), critical=True) for c in needed],
        check("pm25_null_rate_below_30", pm25_null < 30, pm25_null, 30),
        check("weather_hit_rate_above_90", weather > 90, weather, 90),
        *[none(f"binary_{c}", F.col(f"odd_{c}")) for c in TARGETS],
        check("target_rates_differ", apart > 0.01, apart, 0.01),
        none("no_duplicate_keys", F.col("surplus"), critical=True),
        none("lags_look_back", F.col("lag_errors"), critical=True),
        check("rolling_excludes_today", F.col("r_rolling") < 0.99, F.col("r_rolling"), 0.99),
        none("target_looks_forward", F.col("target_errors"), critical=True),
        check("positive_targets_exceed", right > 99, right, 99, critical=True),
        check("lag_correlations_below_99", lag_told & (highest < 0.99), highest, 0.99),
        none("rolling_mean_within_bound", F.col("bound_errors")),
        check("stations_with_gaps_below_20", gap_share < 20, gap_share, 20),
        check("long_gaps_below_5", long_share < 5, long_share, 5),
    ])


def model_checks(metrics: DataFrame, importance: DataFrame) -> DataFrame:
    """Gates on the baseline model: AUC, recall, and a PM2.5 feature on top."""
    gates = _rows(metrics, [
        check("baseline_auc_above_075", F.col("roc_auc") > 0.75, F.col("roc_auc"), 0.75,
              critical=True),
        check("baseline_recall_above_50", F.col("recall") > 0.5, F.col("recall") * 100, 50,
              critical=True),
    ])
    top = importance.orderBy(F.desc("importance"), "feature").limit(1)
    lead = F.col("feature").contains("pm25")
    return gates.unionByName(_rows(top, [
        check("top_feature_is_pm25", lead, lead.cast("int"), 1)
    ]))


def schema_checks(df: DataFrame) -> DataFrame:
    """One check per type family: all its columns are there, with a fitting type."""
    wrong = F.count_if(~(F.col("present") & F.col("type_ok")))
    found = schema_report(df).groupBy("expected").agg(wrong.alias("wrong"))
    return found.select(
        F.concat(F.lit("schema_of_"), "expected", F.lit("_columns")).alias("check_name"),
        (F.col("wrong") == 0).alias("passed"), F.col("wrong").cast("double").alias("observed"),
        F.lit(0.0).alias("threshold"), F.lit(False).alias("critical"),
    )


def quality_report(df: DataFrame, min_rows: int = 500_000, model: DataFrame | None = None,
                   filtered: bool = True, schema: bool = False) -> DataFrame:
    """The checks of a feature store.  With ``schema`` and the model checks these are all 27,
    of which 11 are critical."""
    report = store_checks(df, min_rows, filtered=filtered)
    if schema:
        report = report.unionByName(schema_checks(df))
    return report if model is None else report.unionByName(model)


def gate(report: DataFrame) -> DataFrame:
    """Totals of a report, and whether every critical check passed."""
    return report.agg(
        F.count("*").alias("n_checks"),
        F.count_if("passed").alias("n_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.count_if(F.col("critical") & ~F.col("passed")).alias("n_critical_failed"),
        F.bool_and(F.col("passed") | ~F.col("critical")).alias("safe_to_train"),
    )


# --- schema -------------------------------------------------------------------------------

FAMILIES = {
    "string": (T.StringType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    "float": (T.FloatType, T.DoubleType, T.LongType),
}


def expected_columns() -> dict[str, str]:
    """Every column a feature store must have, with its type family.

    An int column may be float (nullable ints), and a sum of whole numbers may be long.
    """
    expected = dict(fv.EXPECTED_TYPES)
    for c in fv.FEATURE_POLLUTANTS + fv.FEATURE_WEATHER:
        expected |= {f"{c}_lag{n}": "int" for n in fv.LAG_DAYS}
    for c in fv.ROLLING_COLUMNS:
        expected |= {f"{c}_rolling{n}d": "float" for n in fv.ROLLING_DAYS}
    return expected


def schema_report(df: DataFrame) -> DataFrame:
    """Presence and type family of every expected column.  Reads the schema only."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for name, family in expected_columns().items():
        found = actual.get(name)
        rows.append((name, family, found.simpleString() if found else None, found is not None,
                     isinstance(found, FAMILIES[family])))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected string, actual string, present boolean, type_ok boolean"
    )


# --- landed files -------------------------------------------------------------------------

def expected_files(pollutants: DataFrame, levels: DataFrame) -> DataFrame:
    """Every pollutant and level that should have landed, as a file name.

    Both inputs are the short fixed lists of the landing contract.
    """
    names = levels.agg(F.sort_array(F.collect_set("verification_level")).alias("levels"))
    listed = pollutants.select("pollutant", names.scalar().alias("levels")).distinct()
    exploded = listed.select("pollutant", F.explode("levels").alias("verification_level"))
    name = F.concat_ws("_", "pollutant", "verification_level")
    return exploded.withColumn("file_name", F.concat(name, F.lit(".parquet")))


def missing_files(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    return expected.join(manifest, ["file_name"], "left_anti")


def landing_report(files: DataFrame, min_bytes: int = fv.MIN_READING_BYTES) -> DataFrame:
    """Files (file_name, found, size_bytes, n_rows, missing_columns) with their verdict."""
    enough = F.coalesce(F.col("size_bytes") >= min_bytes, F.lit(False))
    complete = F.coalesce(F.size("missing_columns") == 0, F.lit(False))
    filled = F.coalesce(F.col("n_rows") > 0, F.lit(False))
    return files.select(
        "file_name", "found", "n_rows", enough.alias("size_ok"), complete.alias("columns_ok"),
        filled.alias("rows_ok"), (F.col("found") & enough & complete & filled).alias("passed"),
    )


def new_data_gate(diff: DataFrame, report: DataFrame) -> DataFrame:
    """Run downstream only if something landed and every file passed."""
    landed = diff.filter(F.col("status").isin("new", "changed")).agg(F.count("*").alias("n_landed"))
    passed = report.agg(F.bool_and("passed").alias("all_passed"))
    df = landed.select("n_landed", passed.scalar().alias("all_passed"))
    run = (F.col("n_landed") > 0) & F.coalesce("all_passed", F.lit(False))
    return df.withColumn("run_downstream", run)
