"""Exploratory figures of the feature store, each a distributed aggregation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx, tails
from airshed.operators.ordered import quantiles
from airshed.session import cut_lineage


def scan(df: DataFrame, countries: list[str] | None = None, start: str | None = None,
         end: str | None = None) -> DataFrame:
    """Countries in scope and a date range; both predicates reach the scan."""
    if countries is not None:
        df = df.filter(F.col("country_code").isin(countries))
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


def with_country_name(df: DataFrame) -> DataFrame:
    return df.withColumn("country", fx.lookup(fv.COUNTRY_NAMES, F.col("country_code")))


def stations_per_country(df: DataFrame) -> DataFrame:
    counted = df.groupBy("country_code").agg(F.countDistinct("station_id").alias("n_stations"))
    return with_country_name(counted).orderBy(F.desc("n_stations"), "country_code")


def completeness(df: DataFrame, column: str = "pm25_mean") -> DataFrame:
    counted = df.groupBy("country_code").agg(
        F.count("date").alias("total_rows"), F.count(column).alias("rows_with_value")
    )
    pct = fx.ratio(F.col("rows_with_value"), F.col("total_rows")) * 100
    return with_country_name(counted.withColumn("completeness_pct", F.round(pct, 1)))


def monthly_coverage(df: DataFrame) -> DataFrame:
    """Reporting stations per country and month."""
    month = F.trunc("date", "MM").alias("month_start")
    return df.groupBy("country_code", month).agg(
        F.countDistinct("station_id").alias("stations_reporting")
    )


def monthly_coverage_matrix(df: DataFrame, months: list[str]) -> DataFrame:
    """The same with one column per listed month (``YYYY-MM``)."""
    label = F.date_format("month_start", "yyyy-MM")
    return monthly_coverage(df).groupBy("country_code").agg(*[
        F.max(F.when(label == m, F.col("stations_reporting"))).alias(m) for m in months
    ])


PERCENTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def describe_by(df: DataFrame, keys: list[str], column: str = "pm25_mean") -> DataFrame:
    """count, mean, std, min, max and exact percentiles per group."""
    moments = df.filter(fx.all_of([F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"), F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return moments.join(quantiles(df, keys, column, PERCENTILES), keys, "left")


def medians_by(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Exact median of each column per group, one row per group and column."""
    long = df.select(*keys, *columns).unpivot(keys, columns, "variable", "value")
    return quantiles(long, [*keys, "variable"], "value", {"median": 0.5})


def class_balance(df: DataFrame, target: str = "pm25_exceedance_t1") -> DataFrame:
    """Positives and negatives per country, and over all as country ``ALL``."""
    counted = df.filter(F.col("country_code").isNotNull()).rollup("country_code").agg(
        F.count(target).alias("n_total"), F.sum(target).cast("long").alias("n_positive")
    )
    negative = F.col("n_total") - F.col("n_positive")
    return counted.select(
        F.coalesce("country_code", F.lit("ALL")).alias("country_code"),
        "n_total", "n_positive", negative.alias("n_negative"),
        F.round(fx.ratio(F.col("n_positive"), F.col("n_total")) * 100, 2).alias("positive_rate"),
        F.round(fx.ratio(negative, F.col("n_positive")), 1).alias("scale_pos_weight"),
    )


def seasonal_trend(df: DataFrame, column: str = "pm25_mean") -> DataFrame:
    """Country-month and country-year means in one pass (grouping sets)."""
    sets = [[F.col("country_code"), F.col("month")], [F.col("country_code"), F.col("year")]]
    return df.groupingSets(sets, "country_code", "month", "year").agg(
        F.avg(column).alias("mean"), F.count(column).alias("n")
    )


def _pairs(values: dict[tuple[str, str], tuple[Column, Column]]) -> tuple[list, Column]:
    aggregates, rows = [], []
    for i, ((a, b), (r, n)) in enumerate(values.items()):
        aggregates += [r.alias(f"r{i}"), n.alias(f"n{i}")]
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                             F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n")))
    return aggregates, F.array(*rows)


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of every pair over the rows that have all columns, in one pass."""
    complete = df.select(*columns).dropna()
    pairs = {(a, b): (fx.correlation(F.col(a), F.col(b)), F.count("*"))
             for a, b in combinations(columns, 2)}
    aggregates, rows = _pairs(pairs)
    return complete.agg(*aggregates).select(F.inline(rows))


# Physically expected sign of the correlation with PM2.5.
EXPECTED_SIGNS = {"pm10_mean": "+", "no2_mean": "+", "o3_mean": "-", "so2_mean": "+"}


def sign_check(pairs: DataFrame, anchor: str = "pm25_mean") -> DataFrame:
    observed = F.when(F.col("r") > 0, "+").otherwise("-")
    expected = fx.lookup(EXPECTED_SIGNS, F.col("b"))
    return pairs.filter(F.col("a") == anchor).select(
        F.col("b").alias("pollutant"), "r", expected.alias("expected"),
        observed.alias("observed"), (expected == observed).alias("as_expected"),
    )


def instrument_relevance(df: DataFrame, instrument: str = "boundary_layer_height",
                         exposure: str = "pm25_mean", minimum: float = 0.15) -> DataFrame:
    """Pearson r of instrument and exposure, t statistic, and |r| against the minimum."""
    both = df.filter(F.col(instrument).isNotNull() & F.col(exposure).isNotNull())
    r, n = F.col("r"), F.col("n")
    found = both.agg(
        fx.correlation(F.col(instrument), F.col(exposure)).alias("r"), F.count("*").alias("n")
    )
    t = fx.ratio(r * F.sqrt(n - 2), F.sqrt(1 - r * r))
    return found.select("r", "n", t.alias("t"), (F.abs(r) >= minimum).alias("relevant"))


def with_p_value(df: DataFrame, t: str = "t", freedom: Column | None = None) -> DataFrame:
    """Two-sided p of a t statistic: Student's with ``freedom`` degrees, else the normal tail."""
    p = 2 * normal_tail(F.abs(F.col(t))) if freedom is None else tails.student_two_sided(F.col(t), freedom)
    return df.withColumn("p_value", p)


def normal_cdf(z: Column) -> Column:
    """Normal distribution function of z >= 0; absolute error under 1e-9."""
    return 1 - normal_tail(z)


def normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution at z >= 0.

    From the power series below 3, from the continued fraction above, which keeps its
    relative accuracy however small the tail is.
    """
    density = F.exp(-z * z / 2) / F.lit((2 * 3.141592653589793) ** 0.5)
    series, term = z, z
    for k in range(1, 40):
        term = term * z * z / (2 * k + 1)
        series = series + term
    fraction = z
    for k in range(24, 0, -1):
        fraction = z + F.lit(float(k)) / fraction
    return F.when(z < 3, F.lit(0.5) - density * series).otherwise(density / fraction)


def simple_fit(df: DataFrame, partners: list[str], y: str = "pm25_mean") -> DataFrame:
    """Least-squares line of y on each partner: slope, intercept, r, n."""
    aggregates, rows = [], []
    for i, x in enumerate(partners):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggregates += [
            F.regr_slope(y, x).alias(f"s{i}"), F.regr_intercept(y, x).alias(f"i{i}"),
            fx.correlation(F.col(x), F.col(y)).alias(f"r{i}"), F.count_if(both).alias(f"n{i}"),
        ]
        rows.append(F.struct(
            F.lit(x).alias("x"), F.col(f"s{i}").alias("slope"), F.col(f"i{i}").alias("intercept"),
            F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the upper end belongs to the last bin."""
    width = (high - low) / bins
    raw = F.floor(F.try_divide(value - low, width))
    return F.coalesce(F.least(raw, F.lit(bins - 1)), F.lit(0)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 60, by: str | None = None) -> DataFrame:
    """Equal-width counts and densities between the overall minimum and maximum.

    Density is per class when ``by`` is given.  Bins without rows are absent.
    """
    keys = [by] if by else []
    known = df.filter(fx.all_of([F.col(c).isNotNull() for c in [*keys, column]]))
    # Span and bins both come from the distinct values, so the table is read once.
    counts = cut_lineage(known.groupBy(*keys, column).agg(F.count("*").alias("n")))
    span = counts.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    place = _bin(F.col(column), low, high, bins).alias("bin")
    grouped = counts.groupBy(*keys, place).agg(F.sum("n").alias("n"))
    width = (high - low) / bins
    # One row per class and bin, so this window is short.
    whole = F.sum("n").over(Window.partitionBy(*keys))
    return grouped.select(*keys, "bin", "n", whole.alias("whole")).select(
        *keys, "bin", (low + F.col("bin") * width).alias("bin_start"), "n",
        fx.ratio(F.col("n"), F.col("whole") * width).alias("density"),
    )


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 40) -> DataFrame:
    """Counts over a grid of equal-width square bins."""
    both = df.select(x, y).dropna()
    span = both.agg(*[f(c).alias(f"{name}_{c}") for c in (x, y)
                      for name, f in (("lo", F.min), ("hi", F.max))])

    def position(c: str) -> Column:
        return _bin(F.col(c), span.select(f"lo_{c}").scalar(), span.select(f"hi_{c}").scalar(),
                    bins)

    return both.groupBy(position(x).alias("x_bin"), position(y).alias("y_bin")).agg(
        F.count("*").alias("n")
    )


def autocorrelation(series: DataFrame, keys: list[str], value: str, lags: int = 14) -> DataFrame:
    """Correlation of a daily series with itself k rows back; one row per day and key."""
    w = Window.partitionBy(*keys).orderBy("date")
    shifted = series.select(*keys, value, *[
        F.lag(value, k).over(w).alias(f"lag{k}") for k in range(1, lags + 1)
    ])
    wide = shifted.groupBy(*keys).agg(*[
        fx.correlation(F.col(value), F.col(f"lag{k}")).alias(str(k)) for k in range(1, lags + 1)
    ])
    rows = F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(str(k)).alias("autocorr"))
        for k in range(1, lags + 1)
    ])
    return wide.select(*keys, F.inline(rows))


def null_rates(df: DataFrame) -> DataFrame:
    """Missing share of every column in percent, from one pass over the table."""
    columns = df.columns
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(c)).alias("n_null"),
                 (fx.ratio(F.col("_rows") - F.col(c), F.col("_rows")) * 100).alias("null_pct"))
        for c in columns
    ])
    return counted.select(F.inline(rows))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counted.filter(F.col("copies") > 1)


def worst_duplicates(df: DataFrame, keys: list[str], top: int = 10) -> DataFrame:
    return duplicate_keys(df, keys).orderBy(F.desc("copies"), *keys).limit(top)


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, stations, date range and countries of a table.

    Reduced to station level first; then only two-letter codes are collected.
    """
    stations = df.groupBy("station_id", "country_code").agg(
        F.count("*").alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    per_country = stations.groupBy("country_code").agg(
        F.sum("n").alias("n"), F.count("station_id").alias("stations"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    return per_country.agg(
        F.sum("n").alias("n_rows"), F.sum("stations").alias("n_stations"),
        F.min("lo").alias("min_date"), F.max("hi").alias("max_date"),
        F.array_join(F.array_sort(F.collect_set("country_code")), ",").alias("countries"),
    )


def target_rates(df: DataFrame) -> DataFrame:
    rates = df.agg(
        (F.avg("pm25_exceedance_t1") * 100).alias("rate_t1"),
        (F.avg("pm25_exceedance_t2") * 100).alias("rate_t2"),
    )
    return rates.withColumn("difference", F.abs(F.col("rate_t1") - F.col("rate_t2")))


def seeded_sample(df: DataFrame, size: int, keys: list[str], seed: int = 42) -> DataFrame:
    """A sample of exactly ``size`` rows that is the same on every run.

    The smallest hashes win; Spark keeps only ``size`` rows per task on the way.
    """
    order = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(order, *keys).limit(size)


def column_families(df: DataFrame) -> dict[str, list[str]]:
    """Columns of a feature store by what their names say they are."""
    weather = ("temp", "wind", "blh", "boundary", "precip", "pressure")
    families: dict[str, list[str]] = {k: [] for k in
                                      ("lag", "rolling", "target", "pollutant", "weather", "other")}
    for name in df.columns:
        if "_lag" in name:
            families["lag"].append(name)
        elif "_rolling" in name:
            families["rolling"].append(name)
        elif "exceedance" in name:
            families["target"].append(name)
        elif any(name.startswith(s) for s in fv.POLLUTANT_SLUGS.values()):
            families["pollutant"].append(name)
        elif any(w in name for w in weather):
            families["weather"].append(name)
        else:
            families["other"].append(name)
    return families
