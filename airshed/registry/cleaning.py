"""Queries over readings, weather, outcomes and the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airshed.operators import features as fe, grid as gr, outcomes as oc, readings as rd
from airshed.operators import summary as sm
from airshed.registry.core import query
from airshed.registry.inputs import Inputs
from airshed.registry.sql import CALENDAR, SEASON, WEATHER

DAILY = "station_id, pollutant, date, value_mean, value_max, reading_count, verification_level"
LONG_CALENDAR = f"upper(substr(station_id,1,2)) as country_code, {CALENDAR}"
MEANS = ["pm25_mean", "pm10_mean", "no2_mean", "o3_mean", "so2_mean"]
LAGGED = MEANS + ["temp_2m", "wind_speed", "surface_pressure", "precipitation",
                  "boundary_layer_height", "low_blh_flag"]
ROLLED = MEANS + ["boundary_layer_height", "temp_2m"]
WIDE_DOUBLES = " ".join(f"{p}_{s}" for s in ("mean", "max")
                        for p in ("pm25", "pm10", "no2", "o3", "so2"))
BY_DATE = "partition by station_id order by date"


# --- readings -----------------------------------------------------------------------------

@query("""select station_id, pollutant, date, value, validity, verification_level, country_code
  from valid""", "value")
def filter_invalid(t: Inputs) -> DataFrame:
    df = rd.valid_only(rd.with_country(rd.with_calendar(rd.standardise(t.raw))))
    return df.select("station_id", "pollutant", "date", "value", "validity",
                     "verification_level", "country_code")


@query("select station_id, pollutant, date, value from clean", "value")
def clip_outliers(t: Inputs) -> DataFrame:
    return rd.prepared(t.raw).select("station_id", "pollutant", "date", "value")


@query(f"select {DAILY}, {LONG_CALENDAR} from mixed", "value_mean value_max")
def aggregate_daily(t: Inputs) -> DataFrame:
    return rd.daily_mixed(rd.prepared(t.raw))


@query(f"select {DAILY}, {LONG_CALENDAR} from daily", "value_mean value_max")
def dedup_verified(t: Inputs) -> DataFrame:
    return rd.daily_verified_first(rd.prepared(t.raw))


@query("select * from wide", WIDE_DOUBLES)
def pivot_pollutants(t: Inputs) -> DataFrame:
    return rd.pivot_pollutants(rd.daily_verified_first(rd.prepared(t.raw)))


@query("select * from wide", WIDE_DOUBLES)
def clean_readings(t: Inputs) -> DataFrame:
    return t.wide


@query("select station_id, latitude, longitude, country_code from fx_stations",
       "latitude longitude")
def station_dim(t: Inputs) -> DataFrame:
    """Stations out of the readings, which carry their coordinates."""
    located = t.raw.withColumnRenamed("AirQualityStationEoICode", "station_id").join(
        t.stations.drop("country_code"), ["station_id"]
    )
    return rd.station_dimension(located)


# --- weather ------------------------------------------------------------------------------

@query("select * from grid_days", "t2m u10 v10 sp blh tp blh_min latitude longitude")
def grid_daily(t: Inputs) -> DataFrame:
    return gr.daily_grid(t.grid)


@query("""select date, latitude, longitude, count(*) as n_hours, avg(t2m) as t2m from (
  select *, date '2024-01-01' + day_idx as date from fx_grid
  where latitude between 45.2 and 45.3 and longitude between 1.9 and 2.3)
  group by 1,2,3""", "latitude longitude t2m")
def grid_crop(t: Inputs) -> DataFrame:
    box = {"north": 45.3, "south": 45.2, "west": 1.9, "east": 2.3}
    return gr.crop(t.grid, box).groupBy(
        F.to_date("time").alias("date"), "latitude", "longitude"
    ).agg(F.count("*").alias("n_hours"), F.avg("t2m").alias("t2m"))


@query("select * from station_grid", "t2m u10 v10 sp blh tp blh_min")
def bilinear_interp(t: Inputs) -> DataFrame:
    return gr.interpolate(gr.daily_grid(t.grid), t.stations)


IDW = """select station_id, date, {sums} from (
    select *, case when hit then (case when d2 = 0 then 1.0 else 0.0 end) else 1/d2 end as w from (
      select *, bool_or(d2 = 0) over (partition by station_id, date) as hit from (
        select station_id, g.*,
          case when power(s.latitude-g.latitude,2)+power(s.longitude-g.longitude,2) < 1e-16 then 0
            else (power(s.latitude-g.latitude,2)+power(s.longitude-g.longitude,2))/0.0625 end as d2
        from fx_stations s join grid_days g
          on g.latitude in (floor(s.latitude/0.25+1e-9)*0.25, floor(s.latitude/0.25+1e-9)*0.25+0.25)
          and g.longitude in (floor(s.longitude/0.25+1e-9)*0.25,
            floor(s.longitude/0.25+1e-9)*0.25+0.25))))
  group by 1,2"""
IDW_SUMS = ", ".join(f"sum(w*{c})/sum(w) as {c}"
                     for c in ("t2m", "u10", "v10", "sp", "blh", "tp", "blh_min"))


@query(IDW.format(sums=IDW_SUMS), "t2m u10 v10 sp blh tp blh_min")
def idw_interp(t: Inputs) -> DataFrame:
    return gr.interpolate(gr.daily_grid(t.grid), t.stations, method="idw")


@query("""select station_id, date, t2m, u10, v10, sp, blh, tp, blh_min from (
  select *, row_number() over (partition by station_id, date order by w desc, latitude, longitude)
    as k from weights where w > 1e-9) where k = 1""", "t2m u10 v10 sp blh tp blh_min")
def nearest_interp(t: Inputs) -> DataFrame:
    return gr.interpolate(gr.daily_grid(t.grid), t.stations, method="nearest")


@query("select * from weather", " ".join(WEATHER[:-1]))
def weather_station_day(t: Inputs) -> DataFrame:
    return t.weather


@query(f"select station_id, date, pm25_mean, pm10_mean, {', '.join(WEATHER)} from days",
       "pm25_mean pm10_mean " + " ".join(WEATHER[:-1]))
def join_weather(t: Inputs) -> DataFrame:
    joined = fe.join_weather(t.wide, t.weather)
    return joined.select("station_id", "date", "pm25_mean", "pm10_mean", *WEATHER)


# --- history features ---------------------------------------------------------------------

def _lags(expression: str) -> str:
    columns = [expression.format(c=c, n=n) + f" as {c}_lag{n}" for c in LAGGED for n in (1, 2, 7)]
    return f"select station_id, date, {', '.join(columns)} from days"


LAG_NAMES = [f"{c}_lag{n}" for c in LAGGED for n in (1, 2, 7)]
LAG_DOUBLES = " ".join(n for n in LAG_NAMES if not n.startswith("low_blh"))
ROLL_NAMES = [f"{c}_rolling{n}d" for c in ROLLED for n in (7, 14)]


@query(_lags(f"lag({{c}}, {{n}}) over ({BY_DATE})"), LAG_DOUBLES)
def lag_features(t: Inputs) -> DataFrame:
    return fe.add_lags(t.days).select("station_id", "date", *LAG_NAMES)


@query(_lags(f"max({{c}}) over ({BY_DATE} range between interval {{n}} day preceding "
             "and interval {n} day preceding)"), LAG_DOUBLES)
def lag_calendar(t: Inputs) -> DataFrame:
    return fe.add_lags(t.days, "calendar").select("station_id", "date", *LAG_NAMES)


def _rolls(frame) -> str:
    columns = [f"avg({c}) over ({BY_DATE} {frame(n)}) as {c}_rolling{n}d"
               for c in ROLLED for n in (7, 14)]
    return f"select station_id, date, {', '.join(columns)} from days"


@query(_rolls(lambda n: f"rows between {n - 1} preceding and 1 preceding"), " ".join(ROLL_NAMES))
def rolling_features(t: Inputs) -> DataFrame:
    return fe.add_rolling(t.days).select("station_id", "date", *ROLL_NAMES)


@query(_rolls(lambda n: f"range between interval {n} day preceding and interval 1 day preceding"),
       " ".join(ROLL_NAMES))
def rolling_calendar(t: Inputs) -> DataFrame:
    return fe.add_rolling(t.days, "calendar").select("station_id", "date", *ROLL_NAMES)


def _targets(strict: bool) -> str:
    rest = "when v{h} is null then null else 0" if strict else "else 0"
    flags = ", ".join(
        f"case when v{h} > 25 then 1 {rest.format(h=h)} end as pm25_exceedance_t{h}"
        for h in (1, 2)
    )
    return f"""select * from (select station_id, date, pm25_mean, {flags} from (
      select *, lead(pm25_mean,1) over ({BY_DATE}) as v1, lead(pm25_mean,2) over ({BY_DATE}) as v2
      from days)) where pm25_exceedance_t1 is not null and pm25_exceedance_t2 is not null"""


TARGETS = ["station_id", "date", "pm25_mean", "pm25_exceedance_t1", "pm25_exceedance_t2"]


@query(_targets(False), "pm25_mean")
def targets(t: Inputs) -> DataFrame:
    return fe.add_targets(t.wide, "as_coded").select(*TARGETS)


@query(_targets(True), "pm25_mean")
def targets_strict(t: Inputs) -> DataFrame:
    return fe.add_targets(t.wide, "strict").select(*TARGETS)


@query(f"""select station_id, date, {SEASON} as season,
  case when day_of_week in (1,7) then 1 else 0 end as is_weekend,
  case when month in (10,11,12,1,2,3) then 1 else 0 end as heating_season from wide""")
def calendar_features(t: Inputs) -> DataFrame:
    return fe.add_calendar(t.wide).select("station_id", "date", "season", "is_weekend",
                                          "heating_season")


@query("""select cast(o_orderdate as date) as date,
  cast(isoyear(cast(o_orderdate as date)) as int) as iso_year,
  cast(week(cast(o_orderdate as date)) as int) as week_of_year, count(*) as n
  from orders group by 1,2,3""")
def iso_week(t: Inputs) -> DataFrame:
    dated = t.table("orders").select(F.to_date("o_orderdate").alias("date"))
    return fe.add_week(dated).groupBy("date", "iso_year", "week_of_year").agg(
        F.count("*").alias("n")
    )


@query("""select d.station_id, d.date, d.nuts3_code, d.pm25_mean,
  cast(isoyear(d.date) as int) as iso_year, cast(week(d.date) as int) as week_of_year,
  w.deaths as weekly_deaths from days d left join weekly w on w.nuts3_code = d.nuts3_code
    and w.year = isoyear(d.date) and w.week = week(d.date)""", "pm25_mean weekly_deaths")
def join_outcomes(t: Inputs) -> DataFrame:
    joined = fe.join_outcomes(t.wide, t.weekly)
    return joined.select("station_id", "date", "nuts3_code", "pm25_mean", "iso_year",
                         "week_of_year", "weekly_deaths")


STORE = ["station_id", "date", "season", "pm25_mean", "pm25_mean_lag1", "pm25_mean_lag7",
         "pm25_mean_rolling7d", "boundary_layer_height_lag2", "temp_2m_rolling14d", "wind_speed",
         "pm25_exceedance_t1", "pm25_exceedance_t2", "weekly_deaths"]


STORE_SQL = (f"""select s.*, w.deaths as weekly_deaths from (
  select station_id, date, {SEASON} as season, pm25_mean, pm25_mean_lag1, pm25_mean_lag7,
    pm25_mean_rolling7d, boundary_layer_height_lag2, temp_2m_rolling14d, wind_speed,
    case when v1 > 25 then 1 else 0 end as pm25_exceedance_t1,
    case when v2 > 25 then 1 else 0 end as pm25_exceedance_t2 from (
    select *, lag(pm25_mean,1) over ({BY_DATE}) as pm25_mean_lag1,
      lag(pm25_mean,7) over ({BY_DATE}) as pm25_mean_lag7,
      avg(pm25_mean) over ({BY_DATE} rows between 6 preceding and 1 preceding)
        as pm25_mean_rolling7d,
      lag(boundary_layer_height,2) over ({BY_DATE}) as boundary_layer_height_lag2,
      avg(temp_2m) over ({BY_DATE} rows between 13 preceding and 1 preceding)
        as temp_2m_rolling14d,
      lead(pm25_mean,1) over ({BY_DATE}) as v1, lead(pm25_mean,2) over ({BY_DATE}) as v2
    from days) where v1 is not null and v2 is not null) s
  left join weekly w on w.nuts3_code = substr(s.station_id,1,5) and w.year = isoyear(s.date)
    and w.week = week(s.date)""",
    "pm25_mean pm25_mean_lag1 pm25_mean_lag7 pm25_mean_rolling7d boundary_layer_height_lag2 "
    "temp_2m_rolling14d wind_speed weekly_deaths")


@query(*STORE_SQL)
def feature_store(t: Inputs) -> DataFrame:
    return t.store.select(*STORE)


@query("""select country_code, station_id, year, avg(pm25_mean) as pm25_annual_mean,
  count(case when pm25_mean > 25 then 1 end) as days_above_eu_limit,
  count(case when pm25_mean > 5 then 1 end) as days_above_who_guideline,
  avg(boundary_layer_height) as mean_blh, count(*) as days_with_data,
  count(pm25_mean) as days_with_pm25 from days group by 1,2,3""", "pm25_annual_mean mean_blh")
def station_year_summary(t: Inputs) -> DataFrame:
    return sm.station_year(t.days)


@query("""select station_id, count(date) as total, count(pm25_mean) as with_pm25,
  100.0*count(pm25_mean)/count(date) as pct from days group by 1
  having 100.0*count(pm25_mean)/count(date) < 70""", "pct")
def low_coverage_stations(t: Inputs) -> DataFrame:
    return fe.low_coverage_stations(t.wide)


FRAME = ["pm25_mean", "pm25_mean_lag1", "boundary_layer_height", "wind_speed", "temp_2m"]


@query(f"""select station_id, date, {', '.join(FRAME)}, pm25_exceedance_t1 from (
  select station_id, date, {', '.join(FRAME)},
    case when v1 > 25 then 1 when v1 is not null then 0 end as pm25_exceedance_t1 from (
    select *, lag(pm25_mean,1) over ({BY_DATE}) as pm25_mean_lag1,
      lead(pm25_mean,1) over ({BY_DATE}) as v1, lead(pm25_mean,2) over ({BY_DATE}) as v2
    from days) where v2 is not null)
  where pm25_exceedance_t1 is not null and pm25_mean is not null and pm25_mean_lag1 is not null
    and boundary_layer_height is not null and wind_speed is not null and temp_2m is not null""",
       " ".join(FRAME))
def model_frame(t: Inputs) -> DataFrame:
    history = fe.add_history(t.days)
    return fe.model_frame(history, FRAME).select("station_id", "date", *FRAME,
                                                 "pm25_exceedance_t1")


# --- outcomes -----------------------------------------------------------------------------

@query("""select nuts3_code as geo, sex, age, cast(deaths as double) as deaths, year, week,
  cast(strptime('2024 '||cast(week as varchar)||' 1', '%G %V %u') as date) as date
  from fx_health""", "deaths")
def unpivot_weeks(t: Inputs) -> DataFrame:
    return oc.unpivot_weeks(t.health_wide)


@query("select geo, icd10, year, cast(deaths as double) as deaths from fx_causes", "deaths")
def unpivot_years(t: Inputs) -> DataFrame:
    return oc.unpivot_years(t.causes_wide)


@query("select * from weekly", "deaths")
def outcomes_weekly(t: Inputs) -> DataFrame:
    return t.weekly


@query("select * from causes", "deaths")
def cause_deaths(t: Inputs) -> DataFrame:
    return t.causes


@query("""select geo as nuts2_code, upper(substr(geo,1,2)) as country_code, year,
  case when substr(icd10,1,1) = 'J' then 'respiratory' else 'cardiovascular' end as cause_group,
  cast(sum(deaths) as double) as deaths from fx_causes
  where icd10 in ('J00-J99','J40-J47','J09-J18','I00-I99','I20-I25','I60-I69')
  group by 1,2,3,4""", "deaths")
def cause_deaths_as_coded(t: Inputs) -> DataFrame:
    return oc.cause_deaths(t.causes_wide, "as_coded")


@query("""select upper(substr(geo,1,2)) as country_code, year,
  case when icd10 = 'J00-J99' then 'respiratory' else 'cardiovascular' end as cause_group,
  cast(sum(deaths) as double) as admissions from fx_causes
  where icd10 in ('J00-J99','I00-I99') group by 1,2,3""", "admissions")
def hospital_admissions(t: Inputs) -> DataFrame:
    admissions = t.causes_wide.withColumn("geo", F.lower(F.substring("geo", 1, 2)))
    return oc.hospital_admissions(admissions)


@query("""select case country when '4130' then 'NO' when '4190' then 'CH' when '4210' then 'TR'
    when '4070' then 'UA' else 'RS' end as country_code, year,
  case when cause like 'J%' then 'respiratory' else 'cardiovascular' end as cause_group,
  cast(deaths1 as double) as deaths from fx_who
  where country <> '9999' and (cause like 'I%' or cause like 'J%')""", "deaths")
def who_mortality(t: Inputs) -> DataFrame:
    return oc.who_mortality(t.view("fx_who"))


@query("""select country_code, date, sum(deaths) as deaths from weekly group by 1,2""", "deaths")
def weekly_deaths(t: Inputs) -> DataFrame:
    return oc.country_weeks(t.weekly)


@query("""select c.country_code, m.date from (select distinct country_code from weekly) c,
  (select cast(unnest(generate_series(date '2024-01-01', date '2024-03-31', interval 7 day))
    as date) as date) m
  where not exists (select 1 from weekly w where w.country_code = c.country_code
    and w.date = m.date)""")
def missing_weeks(t: Inputs) -> DataFrame:
    return oc.missing_weeks(t.weekly, t.weekly, "2024-01-01", "2024-03-31")


@query("""select country_code, count(distinct date) as weeks_present, cast(13 as bigint) as expected,
  13 - count(distinct date) as missing, round(count(distinct date)*100.0/13, 1) as pct,
  round(count(distinct date)*100.0/13, 1) < 90 as flagged from weekly group by 1""", "pct")
def outcome_completeness(t: Inputs) -> DataFrame:
    return oc.completeness(t.weekly, "2024-01-01", "2024-03-31")


@query("""select w.nuts3_code, w.year, w.week, w.deaths, p.population,
  w.deaths/p.population*100000 as rate_per_100k
  from weekly w left join fx_population p using (nuts3_code)""", "deaths rate_per_100k")
def rate_per_100k(t: Inputs) -> DataFrame:
    rated = oc.rate_per_100k(t.weekly, t.population, ["nuts3_code"])
    return rated.select("nuts3_code", "year", "week", "deaths", "population", "rate_per_100k")


@query("""select w.nuts3_code, w.year, w.week, w.deaths,
  w.deaths * r.deaths / a.all_deaths as respiratory_deaths,
  w.deaths * c.deaths / a.all_deaths as cardiovascular_deaths from weekly w
  join (select substr(nuts3_code,1,4) as nuts2_code, year, sum(deaths) as all_deaths
    from weekly group by 1,2) a on a.nuts2_code = substr(w.nuts3_code,1,4) and a.year = w.year
  left join causes r on r.nuts2_code = a.nuts2_code and r.year = w.year
    and r.cause_group = 'respiratory'
  left join causes c on c.nuts2_code = a.nuts2_code and c.year = w.year
    and c.cause_group = 'cardiovascular'""",
       "deaths respiratory_deaths cardiovascular_deaths")
def cause_split_weekly(t: Inputs) -> DataFrame:
    return oc.split_by_cause(t.weekly, t.causes).select(
        "nuts3_code", "year", "week", "deaths", "respiratory_deaths", "cardiovascular_deaths"
    )


@query("""select case when right(nuts3_code,1) = '1' and year = 2024 then
    concat(left(nuts3_code,4),'9') else nuts3_code end as nuts3_code, year, week, deaths
  from weekly""", "deaths")
def nuts_harmonise(t: Inputs) -> DataFrame:
    """Codes ending in 1 of vintage 2024 were renumbered to end in 9."""
    vintages = t.weekly.withColumn("vintage", F.col("year"))
    old = vintages.select("nuts3_code", "vintage").distinct()
    table = old.filter(F.col("nuts3_code").endswith("1")).select(
        F.col("nuts3_code").alias("old_code"), "vintage",
        F.concat(F.substring("nuts3_code", 1, 4), F.lit("9")).alias("new_code"),
    )
    return oc.harmonise_codes(vintages, table).select("nuts3_code", "year", "week", "deaths")


BOXES = """select concat('NZ', lpad(cast(s_nationkey as string),3,'0')) as nuts3_code,
  45.0 + (s_nationkey%5)*0.1 as south, 45.1 + (s_nationkey%5)*0.1 as north,
  2.0 + floor(s_nationkey/5)*0.1 as west, 2.1 + floor(s_nationkey/5)*0.1 as east
  from (select distinct s_nationkey from {supplier}) u"""


@query(f"""select s.station_id, min(b.nuts3_code) as nuts3_code from fx_stations s left join (
  {BOXES.format(supplier='supplier')}) b on s.latitude between b.south and b.north
  and s.longitude between b.west and b.east group by 1""")
def station_region(t: Inputs) -> DataFrame:
    boxes = t.spark.sql(BOXES, supplier=t.table("supplier")).select(
        "nuts3_code", *[F.round(F.col(c).cast("double"), 6).alias(c)
                        for c in ("south", "north", "west", "east")])
    return oc.regions_by_box(t.stations, boxes, cell=0.25)


# --- summaries ----------------------------------------------------------------------------

@query("select * from runs", "peak")
def episodes(t: Inputs) -> DataFrame:
    return sm.episodes(sm.region_days(t.days))


@query("select * from region_week",
       "pm25_mean temp_2m wind_speed precipitation boundary_layer_height")
def region_week_exposure(t: Inputs) -> DataFrame:
    return sm.region_week_exposure(t.days)


@query(f"""select country_code, year, {SEASON} as season, avg(pm25_mean) as pm25_mean,
  count(pm25_mean) as n from days group by 1,2,3""", "pm25_mean")
def seasonal_means(t: Inputs) -> DataFrame:
    return sm.seasonal_means(t.wide)


CD = "(select country_code, date, avg(pm25_mean) as pm25_mean from days group by 1,2)"


@query(f"""select cast(year(a.date) as int) as year, a.country_code as country_a,
  b.country_code as country_b, case when count(case when a.date = b.date and a.pm25_mean is not null
    and b.pm25_mean is not null then 1 end) > 1 then corr(case when a.date = b.date then a.pm25_mean end,
    case when a.date = b.date then b.pm25_mean end) end as r,
  count(case when a.date = b.date and a.pm25_mean is not null and b.pm25_mean is not null then 1 end)
    as n_days
  from {CD} a join {CD} b on year(a.date) = year(b.date) and a.country_code < b.country_code
  group by 1,2,3""", "r")
def cross_border_corr(t: Inputs) -> DataFrame:
    return sm.cross_border_corr(t.wide)
