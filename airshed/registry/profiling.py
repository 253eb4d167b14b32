"""Queries that profile and check the station-day table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from airshed.operators import features as fe, profile as pf, quality as ql
from airshed.registry.core import query
from airshed.registry.inputs import Inputs

NAME = ("case country_code when 'FR' then 'France' when 'ES' then 'Spain' when 'BE' then 'Belgium' "
        "when 'NL' then 'Netherlands' when 'DE' then 'Germany' end as country")
MEANS = ["pm25_mean", "pm10_mean", "no2_mean", "o3_mean", "so2_mean"]
BY_DATE = "partition by station_id order by date"


@query(f"""select country_code, count(distinct station_id) as n_stations, {NAME}
  from wide group by country_code""")
def stations_per_country(t: Inputs) -> DataFrame:
    return pf.stations_per_country(t.wide)


@query(f"""select country_code, count(date) as total_rows, count(pm25_mean) as rows_with_value,
  round(count(pm25_mean)*100.0/count(date), 1) as completeness_pct, {NAME}
  from wide group by country_code""", "completeness_pct")
def completeness(t: Inputs) -> DataFrame:
    return pf.completeness(t.wide)


@query("""select country_code, cast(date_trunc('month', date) as date) as month_start,
  count(distinct station_id) as stations_reporting from wide group by 1,2""")
def monthly_coverage(t: Inputs) -> DataFrame:
    return pf.monthly_coverage(t.wide)


@query("""select country_code,
  max(case when m = date '2024-01-01' then n end) as "2024-01",
  max(case when m = date '2024-02-01' then n end) as "2024-02" from (
    select country_code, cast(date_trunc('month', date) as date) as m,
      count(distinct station_id) as n from wide group by 1,2) group by 1""")
def monthly_coverage_matrix(t: Inputs) -> DataFrame:
    return pf.monthly_coverage_matrix(t.wide, ["2024-01", "2024-02"])


QUANTILES = ", ".join(f"quantile_cont(pm25_mean, {q}) as {n}" for n, q in pf.PERCENTILES.items())


@query(f"""select country_code, count(pm25_mean) as n, avg(pm25_mean) as mean,
  stddev_samp(pm25_mean) as std, min(pm25_mean) as min, max(pm25_mean) as max, {QUANTILES}
  from wide group by country_code""", "mean std min max p50 p75 p90 p95 p99")
def describe_by_country(t: Inputs) -> DataFrame:
    return pf.describe_by(t.wide, ["country_code"])


MEDIAN_OF = ["boundary_layer_height", "wind_speed", "precipitation", "temp_2m"]
LED = f"""select *, case when v1 > 25 then 1 when v1 is not null then 0 end as pm25_exceedance_t1,
  case when v2 > 25 then 1 when v2 is not null then 0 end as pm25_exceedance_t2 from (
    select *, lead(pm25_mean,1) over ({BY_DATE}) as v1, lead(pm25_mean,2) over ({BY_DATE}) as v2
    from days)"""


@query(" union all ".join(
    f"select pm25_exceedance_t1, '{c}' as variable, median({c}) as median from ({LED}) "
    "where v1 is not null and v2 is not null group by 1" for c in MEDIAN_OF), "median")
def class_medians(t: Inputs) -> DataFrame:
    return pf.medians_by(fe.add_targets(t.days), ["pm25_exceedance_t1"], MEDIAN_OF)


@query(f"""select coalesce(country_code, 'ALL') as country_code,
  count(pm25_exceedance_t1) as n_total, cast(sum(pm25_exceedance_t1) as bigint) as n_positive,
  cast(count(*) - sum(pm25_exceedance_t1) as bigint) as n_negative,
  round(avg(pm25_exceedance_t1)*100, 2) as positive_rate,
  round((count(*) - sum(pm25_exceedance_t1)) * 1.0 / sum(pm25_exceedance_t1), 1)
    as scale_pos_weight
  from ({LED}) where v1 is not null and v2 is not null group by rollup(country_code)""",
       "positive_rate scale_pos_weight")
def class_balance(t: Inputs) -> DataFrame:
    return pf.class_balance(fe.add_targets(t.days))


@query("""select country_code, month, year, avg(pm25_mean) as mean, count(pm25_mean) as n
  from wide group by grouping sets ((country_code, month), (country_code, year))""", "mean")
def seasonal_trend(t: Inputs) -> DataFrame:
    return pf.seasonal_trend(t.wide)


def _pairs_sql(columns: list[str], source: str) -> str:
    return " union all ".join(
        f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as r, count(*) as n from {source}"
        for a, b in combinations(columns, 2)
    )


CORR_COLUMNS = ["pm25_mean", "temp_2m", "wind_speed", "boundary_layer_height", "precipitation"]
COMPLETE = "(select * from days where " + " and ".join(
    f"{c} is not null" for c in CORR_COLUMNS) + ")"
COUNTRY_DAY = "(select * from (select country_code, date, " + ", ".join(
    f"avg({c}) as {c}" for c in MEANS) + " from wide group by 1,2) where " + " and ".join(
    f"{c} is not null" for c in MEANS) + ")"


@query(_pairs_sql(MEANS, COUNTRY_DAY), "r")
def pollutant_corr(t: Inputs) -> DataFrame:
    """Pollutants rarely share a station-day here, so country-days are correlated."""
    country_days = t.wide.groupBy("country_code", "date").agg(*[F.avg(c).alias(c) for c in MEANS])
    return pf.correlation_pairs(country_days, MEANS)


@query(f"""select b as pollutant, r, case b when 'o3_mean' then '-' else '+' end as expected,
  case when r > 0 then '+' else '-' end as observed,
  (case b when 'o3_mean' then '-' else '+' end) = (case when r > 0 then '+' else '-' end)
    as as_expected
  from ({_pairs_sql(MEANS, COUNTRY_DAY)}) where a = 'pm25_mean'""", "r")
def correlation_signs(t: Inputs) -> DataFrame:
    return pf.sign_check(pollutant_corr(t))


@query(_pairs_sql(CORR_COLUMNS, COMPLETE), "r")
def weather_corr(t: Inputs) -> DataFrame:
    return pf.correlation_pairs(t.days, CORR_COLUMNS)


@query("""select r, n, r*sqrt(n-2)/sqrt(1-r*r) as t, abs(r) >= 0.15 as relevant from (
  select corr(boundary_layer_height, pm25_mean) as r, count(*) as n from days
  where boundary_layer_height is not null and pm25_mean is not null)""", "r t")
def iv_relevance(t: Inputs) -> DataFrame:
    return pf.instrument_relevance(t.days)


# Student's distribution for v whole degrees of freedom is a finite sum of terms in the cosine
# of th = atan(t / sqrt(v)); each is the one before times cos(th)^2 (k + 1) / (k + 2).
@query("""with recursive f as (
  select r, n, n - 2 as v, r*sqrt(n-2)/sqrt(1-r*r) as t, abs(r) >= 0.15 as relevant from (
    select corr(boundary_layer_height, pm25_mean) as r, count(*) as n from days
    where boundary_layer_height is not null and pm25_mean is not null)),
s(k, v, th, term, total) as (
  select v % 2, v, atan(t / sqrt(v)), case when v % 2 = 0 then 1.0::double else cos(atan(t / sqrt(v))) end,
    case when v = 1 then 0.0::double when v % 2 = 0 then 1.0 else cos(atan(t / sqrt(v))) end from f
  union all select k + 2, v, th, term * cos(th) * cos(th) * (k + 1.0) / (k + 2.0),
    total + term * cos(th) * cos(th) * (k + 1.0) / (k + 2.0) from s where k + 2 <= v - 2)
select r, n, t, relevant, 1 - abs(case when s.v % 2 = 0 then sin(th) * total
  else 2 / pi() * (th + sin(th) * total) end) as p_value from f cross join (select * from s order by k desc limit 1) s""",
       "r t p_value")
def iv_relevance_p(t: Inputs) -> DataFrame:
    found = pf.instrument_relevance(t.days)
    return pf.with_p_value(found, freedom=F.col("n") - 2)


PARTNERS = ["temp_2m", "wind_speed", "boundary_layer_height"]


@query(" union all ".join(
    f"""select '{x}' as x, regr_slope(pm25_mean, {x}) as slope,
    regr_intercept(pm25_mean, {x}) as intercept, corr({x}, pm25_mean) as r,
    count(case when {x} is not null and pm25_mean is not null then 1 end) as n from days"""
    for x in PARTNERS), "slope intercept r")
def simple_fit(t: Inputs) -> DataFrame:
    return pf.simple_fit(t.days, PARTNERS)


def _bin_sql(column: str, bins: int, low: str, high: str) -> str:
    return (f"cast(least(floor(({column}-{low})/(({high}-{low})/{bins}.0)), {bins - 1}) as int)")


@query(f"""select country_code, bin, low + bin*(high-low)/60.0 as bin_start, n,
    n / (sum(n) over (partition by country_code) * (high-low)/60.0) as density from (
  select country_code, {_bin_sql('pm25_mean', 60, 'low', 'high')} as bin, low, high,
    count(*) as n from wide, (select min(pm25_mean) as low, max(pm25_mean) as high from wide) s
  where pm25_mean is not null group by all)""", "bin_start density")
def histogram(t: Inputs) -> DataFrame:
    return pf.histogram(t.wide, "pm25_mean", 60, by="country_code")


@query(f"""select {_bin_sql('boundary_layer_height', 40, 'lx', 'hx')} as x_bin,
    {_bin_sql('pm25_mean', 40, 'ly', 'hy')} as y_bin, count(*) as n from days, (
  select min(boundary_layer_height) as lx, max(boundary_layer_height) as hx,
    min(pm25_mean) as ly, max(pm25_mean) as hy from days
  where boundary_layer_height is not null and pm25_mean is not null) s
  where boundary_layer_height is not null and pm25_mean is not null group by 1,2""")
def hist2d(t: Inputs) -> DataFrame:
    return pf.histogram_2d(t.days, "boundary_layer_height", "pm25_mean", 40)


SERIES = """(select country_code, date, pm25_mean, {lags} from (
  select country_code, date, avg(pm25_mean) as pm25_mean from wide group by 1,2))""".format(
    lags=", ".join(f"lag(pm25_mean,{k}) over (partition by country_code order by date) as l{k}"
                   for k in range(1, 15)))


@query(" union all ".join(
    f"select country_code, {k} as lag, corr(pm25_mean, l{k}) as autocorr from {SERIES} group by 1"
    for k in range(1, 15)), "autocorr")
def autocorr(t: Inputs) -> DataFrame:
    series = t.wide.groupBy("country_code", "date").agg(F.avg("pm25_mean").alias("pm25_mean"))
    return pf.autocorrelation(series, ["country_code"], "pm25_mean")


NULLABLE = ["station_id", "date", *MEANS, "temp_2m", "boundary_layer_height", "low_blh_flag"]


@query(" union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_null, "
    f"(count(*) - count({c}))*100.0/count(*) as null_pct from days" for c in NULLABLE), "null_pct")
def null_rates(t: Inputs) -> DataFrame:
    return pf.null_rates(t.days.select(*NULLABLE))


@query("""select station_id, date, count(*) as copies from clean group by 1,2
  having count(*) > 1 order by copies desc, station_id, date limit 10""")
def duplicate_keys(t: Inputs) -> DataFrame:
    """Readings are not unique per station-day; the ten most repeated keys."""
    from airshed.operators import readings as rd

    return pf.worst_duplicates(rd.prepared(t.raw), ["station_id", "date"])


@query("""select count(*) as n_rows, count(distinct station_id) as n_stations,
  min(date) as min_date, max(date) as max_date,
  string_agg(distinct country_code, ',' order by country_code) as countries from wide""")
def dataset_summary(t: Inputs) -> DataFrame:
    return pf.dataset_summary(t.wide)


@query(f"""select *, abs(rate_t1 - rate_t2) as difference from (
  select avg(pm25_exceedance_t1)*100 as rate_t1, avg(pm25_exceedance_t2)*100 as rate_t2
  from ({LED}) where v1 is not null and v2 is not null)""", "rate_t1 rate_t2 difference")
def target_rates(t: Inputs) -> DataFrame:
    return pf.target_rates(fe.add_targets(t.wide))


@query("""select station_id, date, pm25_mean from wide
  order by md5('42|' || station_id || '|' || cast(date as varchar)), station_id, date limit 1000""",
       "pm25_mean")
def seeded_sample(t: Inputs) -> DataFrame:
    return pf.seeded_sample(t.wide.select("station_id", "date", "pm25_mean"), 1000,
                            ["station_id", "date"])


# --- checks -------------------------------------------------------------------------------

@query(f"""select station_id, count(*) as n_days, count(case when gap > 1 then 1 end) as n_gaps,
  count(case when gap > 30 then 1 end) as n_long_gaps,
  cast(max(case when gap > 1 then gap end) as int) as longest_gap,
  cast(least(max(case when gap > 1 then gap end), 60) as int) as longest_gap_shown from (
    select station_id, date, date - lag(date) over ({BY_DATE}) as gap from wide) group by 1""")
def temporal_gaps(t: Inputs) -> DataFrame:
    return ql.temporal_gaps(t.wide)


HISTORY = f"""select *, lag(pm25_mean,1) over ({BY_DATE}) as pm25_mean_lag1,
  avg(pm25_mean) over ({BY_DATE} rows between 6 preceding and 1 preceding) as roll,
  max(pm25_mean) over ({BY_DATE} rows between 7 preceding and 1 preceding) as past_max from days"""


@query(f"""select count(*) as n_rows, count(case when roll is not null and past_max is not null
  then 1 end) as n_checked, count(case when roll > past_max + 1e-6 then 1 end) as n_violations
  from ({HISTORY})""")
def rolling_bound_check(t: Inputs) -> DataFrame:
    rows = ql.series_rows(fe.add_rolling(t.wide))
    both = F.col("pm25_mean_rolling7d").isNotNull() & F.col("pm25_past_max").isNotNull()
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(both).alias("n_checked"),
                    F.count_if(ql.bound_errors(filtered=False)).alias("n_violations"))


@query(f"""select station_id, count(*) as n_days, cast(0 as bigint) as n_errors
  from ({HISTORY}) group by 1""")
def lag_direction_check(t: Inputs) -> DataFrame:
    rows = ql.series_rows(fe.add_lags(t.wide))
    return rows.groupBy("station_id").agg(
        F.count("*").alias("n_days"), F.count_if(ql.lag_errors(filtered=False)).alias("n_errors")
    )


@query()
def schema_report(t: Inputs) -> DataFrame:
    return ql.schema_report(t.store)


LAGS = [(s, n) for s in ("pm25_mean", "boundary_layer_height") for n in (1, 2, 7)]
STORE = f"""select * from (select *, {', '.join(
    f"lag({s},{n}) over ({BY_DATE}) as {s}_lag{n}" for s, n in LAGS)},
  avg(pm25_mean) over ({BY_DATE} rows between 6 preceding and 1 preceding) as pm25_mean_rolling7d,
  case when lead(pm25_mean,1) over ({BY_DATE}) > 25 then 1
    when lead(pm25_mean,1) over ({BY_DATE}) is not null then 0 end as pm25_exceedance_t1,
  case when lead(pm25_mean,2) over ({BY_DATE}) > 25 then 1
    when lead(pm25_mean,2) over ({BY_DATE}) is not null then 0 end as pm25_exceedance_t2
  from days) where pm25_exceedance_t1 is not null and pm25_exceedance_t2 is not null"""
WATCHED = f"""select *, lag(pm25_mean) over ({BY_DATE}) as yesterday,
  case when lead(date) over ({BY_DATE}) - date = 1 then lead(pm25_mean) over ({BY_DATE}) end
    as tomorrow, date - lag(date) over ({BY_DATE}) as gap,
  date - lag(date,6) over ({BY_DATE}) = 6 as full_week,
  max(pm25_mean) over ({BY_DATE} rows between 7 preceding and 1 preceding) as past_max
  from ({STORE})"""
N_LAG = ", ".join(
    f"corr({s}, {s}_lag{n}) as r_{s}_{n}" for s, n in LAGS)
FOUND = f"""select count(*) as n, count(distinct (station_id, date)) as n_keys,
  count(station_id) as k1, count(date) as k2, count(country_code) as k3,
  count(pm25_exceedance_t1) as k4, count(pm25_exceedance_t2) as k5,
  count(pm25_mean) as n_pm25, count(temp_2m) as n_temp,
  count(case when pm25_exceedance_t1 not in (0,1) then 1 end) as odd1,
  count(case when pm25_exceedance_t2 not in (0,1) then 1 end) as odd2,
  abs(avg(pm25_exceedance_t1)*100 - avg(pm25_exceedance_t2)*100) as rate_gap,
  count(case when gap = 1 and pm25_mean_lag1 is distinct from yesterday then 1 end)
    as lag_err,
  corr(pm25_mean, pm25_mean_rolling7d) as r_roll,
  count(case when tomorrow is not null and (case when tomorrow > 25 then 1 else 0 end)
    <> pm25_exceedance_t1 then 1 end) as target_err,
  100.0*count(case when pm25_exceedance_t1 = 1 and tomorrow > 25 then 1 end)
    / nullif(count(case when pm25_exceedance_t1 = 1 and tomorrow is not null then 1 end), 0)
    as right_pct,
  count(case when pm25_mean_rolling7d > past_max + 1e-6 and full_week then 1 end)
    as bound_err,
  100.0*count(distinct case when gap > 1 then station_id end)/count(distinct station_id)
    as gap_pct,
  coalesce(100.0*count(case when gap > 30 then 1 end)
    / nullif(count(case when gap > 1 then 1 end), 0), 0) as long_pct, {N_LAG}
  from ({WATCHED})"""
HIGHEST = f"greatest({', '.join(f'r_{s}_{n}' for s, n in LAGS)})"
TOLD = " and ".join(f"r_{s}_{n} is not null" for s, n in LAGS)
CHECKS = [
    ("enough_rows", "n > 500000", "n", 500000, False),
    ("no_null_station_id", "n - k1 = 0", "n - k1", 0, True),
    ("no_null_date", "n - k2 = 0", "n - k2", 0, True),
    ("no_null_country_code", "n - k3 = 0", "n - k3", 0, True),
    ("no_null_pm25_exceedance_t1", "n - k4 = 0", "n - k4", 0, True),
    ("no_null_pm25_exceedance_t2", "n - k5 = 0", "n - k5", 0, True),
    ("pm25_null_rate_below_30", "(n-n_pm25)*100.0/n < 30", "(n-n_pm25)*100.0/n", 30, False),
    ("weather_hit_rate_above_90", "n_temp*100.0/n > 90", "n_temp*100.0/n", 90, False),
    ("binary_pm25_exceedance_t1", "odd1 = 0", "odd1", 0, False),
    ("binary_pm25_exceedance_t2", "odd2 = 0", "odd2", 0, False),
    ("target_rates_differ", "rate_gap > 0.01", "rate_gap", 0.01, False),
    ("no_duplicate_keys", "n - n_keys = 0", "n - n_keys", 0, True),
    ("lags_look_back", "lag_err = 0", "lag_err", 0, True),
    ("rolling_excludes_today", "r_roll < 0.99", "r_roll", 0.99, False),
    ("target_looks_forward", "target_err = 0", "target_err", 0, True),
    ("positive_targets_exceed", "right_pct > 99", "right_pct", 99, True),
    ("lag_correlations_below_99", f"{HIGHEST} < 0.99 and {TOLD}", HIGHEST, 0.99, False),
    ("rolling_mean_within_bound", "bound_err = 0", "bound_err", 0, False),
    ("stations_with_gaps_below_20", "gap_pct < 20", "gap_pct", 20, False),
    ("long_gaps_below_5", "long_pct < 5", "long_pct", 5, False),
]


@query(f"""select c.* from (select unnest([{', '.join(
    f"{{'check_name': '{n}', 'passed': coalesce({p}, false), 'observed': cast({o} as double), "
    f"'threshold': cast({t} as double), 'critical': {str(c).lower()}}}"
    for n, p, o, t, c in CHECKS)}]) as c from ({FOUND}) f)""", "observed threshold")
def quality_report(t: Inputs) -> DataFrame:
    """Every check over the store as it stands after the target filter."""
    return ql.quality_report(fe.add_history(t.days))


GATE = " union all ".join(
    f"select coalesce({p}, false) as passed, {str(c).lower()} as critical from ({FOUND}) f"
    for _, p, _, _, c in CHECKS)


@query(f"""select count(*) as n_checks, count(case when passed then 1 end) as n_passed,
  count(case when not passed then 1 end) as n_failed,
  count(case when critical and not passed then 1 end) as n_critical_failed,
  bool_and(passed or not critical) as safe_to_train from ({GATE})""")
def quality_gate(t: Inputs) -> DataFrame:
    return ql.gate(quality_report(t))
