"""Queries over the region-week panel, and the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airshed.operators import causal as cs, features as fe, metrics as mt, models as md, outcomes as oc
from airshed.operators import summary as sm
from airshed.registry.core import query
from airshed.registry.inputs import Inputs
from airshed.session import cut_lineage, scratch_path

PANEL = """nuts3_code, monday, iso_year, iso_week, country_code, pm25_mean, temp_2m, wind_speed,
  precipitation, boundary_layer_height, station_days, treated, deaths, population, rate_per_100k"""
PANEL_DOUBLES = ("pm25_mean temp_2m wind_speed precipitation boundary_layer_height deaths "
                 "rate_per_100k")
LIMIT = 45.0
HIGH_PANEL = "panel_high"


def _panel(t: Inputs, limit: float = 25.0) -> DataFrame:
    return cs.panel(t.days, t.weekly, t.population, limit)


@query(f"select {PANEL} from panel", PANEL_DOUBLES)
def causal_panel(t: Inputs) -> DataFrame:
    return _panel(t)


CAUSES = """join (select substr(nuts3_code,1,4) as nuts2_code, year, sum(deaths) as all_deaths
    from weekly group by 1,2) a on a.nuts2_code = substr(p.nuts3_code,1,4) and a.year = p.iso_year
  left join causes {0} on {0}.nuts2_code = a.nuts2_code and {0}.year = a.year and {0}.cause_group = '{1}'"""


@query(" union all ".join(f"""select p.nuts3_code, p.monday, p.treated, '{g}' as cause,
    p.deaths * c.deaths / a.all_deaths as cause_deaths,
    p.deaths * c.deaths / a.all_deaths / p.population * 100000 as cause_rate from panel p {CAUSES.format('c', g)}
    where p.deaths is not null""" for g in ("respiratory", "cardiovascular")), "cause_deaths cause_rate")
def causal_panel_causes(t: Inputs) -> DataFrame:
    """Weekly deaths by cause as outcomes of the panel."""
    rows = cs.panel(t.days, oc.split_by_cause(t.weekly, t.causes), t.population)
    return rows.filter("deaths is not null").select("nuts3_code", "monday", "treated", F.inline(F.array(*[
        F.struct(F.lit(g).alias("cause"), F.col(f"{g}_deaths").alias("cause_deaths"),
                 F.col(f"{g}_per_100k").alias("cause_rate")) for g in ("respiratory", "cardiovascular")])))


@query("""select p.nuts3_code, p.monday, p.treated, case when (p.monday - f.first)/7
    between -4 and 8 then cast((p.monday - f.first)/7 as int) end as event_week
  from panel_high p left join (select nuts3_code, min(monday) as first from panel_high
    where treated = 1 group by 1) f on f.nuts3_code = p.nuts3_code""")
def event_time(t: Inputs) -> DataFrame:
    timed = cs.event_time(_panel(t, LIMIT))
    return timed.select("nuts3_code", "monday", "treated", "event_week")


BASE = """select p.*, b.baseline from panel_high p join (
    select m.nuts3_code, m.monday, avg(r.pm25_mean) as baseline from panel_high m
    join region_day r on r.nuts3_code = m.nuts3_code and r.date between m.monday - 30
      and m.monday - 1 group by 1,2) b on b.nuts3_code = p.nuts3_code and b.monday = p.monday
  where baseline is not null"""


@query(f"""select a.country_code, a.monday, a.nuts3_code, a.baseline, a.rate_per_100k,
  count(c.nuts3_code) as n_controls, avg(c.rate_per_100k) as control_rate,
  a.rate_per_100k - avg(c.rate_per_100k) as difference
  from (select * from ({BASE}) where treated = 1) a
  left join (select * from ({BASE}) where treated = 0) c on c.country_code = a.country_code
    and c.monday = a.monday and c.baseline between a.baseline*0.8 and a.baseline*1.2
  group by 1,2,3,4,5""", "baseline rate_per_100k control_rate difference")
def match_controls(t: Inputs) -> DataFrame:
    totals = cut_lineage(sm.region_day_totals(t.days))
    rows = cs.panel_of_totals(totals, t.weekly, t.population, LIMIT)
    return cs.match_controls(rows, cs.baselines(sm.daily_means(totals)))


@query(f"""select a.country_code, a.monday, a.nuts3_code, a.baseline, a.rate_per_100k, count(c.nuts3_code) as n_controls,
  string_agg(c.nuts3_code, ',' order by rank) as controls, avg(c.rate_per_100k) as control_rate,
  a.rate_per_100k - avg(c.rate_per_100k) as difference
  from (select * from ({BASE}) where treated = 1) a left join (
    select t.nuts3_code as of_code, t.monday as of_monday, c.*,
      row_number() over (partition by t.nuts3_code, t.monday order by abs(c.baseline - t.baseline), c.nuts3_code) as rank
    from (select * from ({BASE}) where treated = 1) t join (select * from ({BASE}) where treated = 0) c
      on c.country_code = t.country_code and c.monday = t.monday) c
    on c.of_code = a.nuts3_code and c.of_monday = a.monday and c.rank <= 3
  group by 1,2,3,4,5""", "baseline rate_per_100k control_rate difference")
def nearest_controls(t: Inputs) -> DataFrame:
    totals = cut_lineage(sm.region_day_totals(t.days))
    rows = cs.panel_of_totals(totals, t.weekly, t.population, LIMIT)
    return cs.nearest_controls(rows, cs.baselines(sm.daily_means(totals)))


@query("""select *, (treated_post - treated_pre) - (control_post - control_pre) as did from (
  select avg(case when ever = 1 and not post then rate_per_100k end) as treated_pre,
    avg(case when ever = 1 and post then rate_per_100k end) as treated_post,
    avg(case when ever = 0 and not post then rate_per_100k end) as control_pre,
    avg(case when ever = 0 and post then rate_per_100k end) as control_post from (
    select *, max(treated) over (partition by nuts3_code) as ever,
      monday >= date '2024-01-15' as post from panel_high))""",
       "treated_pre treated_post control_pre control_post did")
def did_2x2(t: Inputs) -> DataFrame:
    return cs.did_2x2(_panel(t, LIMIT), "2024-01-15")


@query()
def did_att(t: Inputs) -> DataFrame:
    return cs.did_att(_panel(t, LIMIT))


@query()
def did_limits(t: Inputs) -> DataFrame:
    """Robustness: other limits, deaths by cause, and rain as an outcome that cannot respond."""
    return cs.limit_runs(sm.region_day_totals(t.days), oc.split_by_cause(t.weekly, t.causes), t.population,
                         [LIMIT, 25.0, 15.0, 5.0], ["rate_per_100k", "respiratory_per_100k", "precipitation"],
                         ["temp_2m", "wind_speed"])


@query()
def pretrend_test(t: Inputs) -> DataFrame:
    return cs.pretrend_test(_panel(t, LIMIT))


@query()
def event_study(t: Inputs) -> DataFrame:
    return cs.event_study(_panel(t, LIMIT))


@query("""select country_code, count(pm25_mean) as n, k as limit_value,
  count(case when pm25_mean > k then 1 end) as n_above,
  1.0*count(case when pm25_mean > k then 1 end)/count(pm25_mean) as share
  from days, (values (25.0), (15.0), (5.0)) v(k) group by 1, 3""", "limit_value share")
def threshold_sensitivity(t: Inputs) -> DataFrame:
    return cs.threshold_sensitivity(t.wide, [25.0, 15.0, 5.0])


IV = "rate_per_100k is not null and pm25_mean is not null and boundary_layer_height is not null"


@query(f"""select covar_samp(boundary_layer_height, rate_per_100k)
    / covar_samp(boundary_layer_height, pm25_mean) as iv_estimate,
  regr_slope(rate_per_100k, pm25_mean) as ols_estimate, count(*) as n
  from panel where {IV}""", "iv_estimate ols_estimate")
def iv_wald(t: Inputs) -> DataFrame:
    return cs.iv_wald(_panel(t), "rate_per_100k", "pm25_mean", "boundary_layer_height")


@query("""select r*r*(n-2)/(1-r*r) as f, n, r*r*(n-2)/(1-r*r) > 10 as strong from (
  select corr(boundary_layer_height, pm25_mean) as r, count(*) as n from panel
  where pm25_mean is not null and boundary_layer_height is not null)""", "f")
def first_stage_f(t: Inputs) -> DataFrame:
    return cs.first_stage_f(_panel(t), "pm25_mean", "boundary_layer_height")


@query()
def iv_2sls(t: Inputs) -> DataFrame:
    return cs.iv_2sls(_panel(t), instruments=["boundary_layer_height", "wind_speed"])


@query()
def cate_by_group(t: Inputs) -> DataFrame:
    return cs.cate_by_group(_panel(t), "country_code")


@query("""select case when iso_week <= 2 then 'early' else 'late' end as group_value,
  regr_slope(rate_per_100k, pm25_mean) as effect,
  count(case when rate_per_100k is not null and pm25_mean is not null then 1 end) as n
  from panel group by 1""", "effect")
def cate_two_season(t: Inputs) -> DataFrame:
    """The data span one month, so its early and late weeks stand for two seasons."""
    season = F.when(F.col("iso_week") <= 2, "early").otherwise("late")
    return cs.slopes_by_group(_panel(t), season, "rate_per_100k", "pm25_mean")


@query(f"""select nuts3_code, pm25_mean, population, greatest(pm25_mean - 5, 0) as exposure_change,
  (select covar_samp(boundary_layer_height, rate_per_100k) / covar_samp(boundary_layer_height, pm25_mean)
    from panel where {IV}) * greatest(pm25_mean - 5, 0) * population / 100000 as deaths_avoided
  from (select nuts3_code, avg(pm25_mean) as pm25_mean, max(population) as population
    from panel group by 1)""", "pm25_mean exposure_change deaths_avoided")
def health_impact(t: Inputs) -> DataFrame:
    """By the effect that the instrument identifies."""
    rows = cut_lineage(_panel(t))  # read for the regions and for the effect
    regions = rows.groupBy("nuts3_code").agg(
        F.avg("pm25_mean").alias("pm25_mean"), F.max("population").alias("population")
    )
    effect = cs.iv_wald(rows, "rate_per_100k", "pm25_mean", "boundary_layer_height").select("iv_estimate")
    return cs.health_impact(regions, effect.scalar())


# --- classifiers --------------------------------------------------------------------------

MODEL_FEATURES = ["pm25_mean", "pm25_mean_lag1", "boundary_layer_height", "wind_speed", "temp_2m"]
SPLIT = ("2024-01-18", "2024-01-24")


def _split(t: Inputs, known_targets: bool = True) -> DataFrame:
    history = fe.add_calendar(fe.add_history(t.days, known_targets=known_targets))
    return mt.temporal_split(history, *SPLIT).select(
        "station_id", "date", *MODEL_FEATURES, "pm25_exceedance_t1", "pm25_exceedance_t2", "split"
    )


@query()
def model_scores(t: Inputs) -> DataFrame:
    rows = _split(t)
    return md.score(md.train(rows, MODEL_FEATURES), rows, MODEL_FEATURES)


@query()
def logistic_scores(t: Inputs) -> DataFrame:
    rows = _split(t)
    return md.score(md.train(rows, MODEL_FEATURES, kind="logistic"), rows, MODEL_FEATURES)


@query()
def feature_importance(t: Inputs) -> DataFrame:
    rows = _split(t)
    return md.importance(md.train(rows, MODEL_FEATURES), rows, MODEL_FEATURES)


@query()
def batch_score(t: Inputs) -> DataFrame:
    """Every station-day, the newest included, for tomorrow and the day after: each with its
    own stored model, at the threshold chosen on the validation rows and stored beside it."""
    rows = cut_lineage(_split(t, known_targets=False))
    scored = rows
    for h in (1, 2):
        target, path = f"pm25_exceedance_t{h}", scratch_path(t.spark, f"model-t{h}")
        model = md.train(rows, MODEL_FEATURES, target)
        checked = md.score(model, rows.filter("split = 'validation'"), MODEL_FEATURES)
        chosen = mt.threshold_precision_floor(checked.withColumn("label", F.col(target)))
        md.save(model, MODEL_FEATURES, chosen.first()["threshold"], path)
        stored, features, threshold = md.load(path)
        scored = md.score(stored, scored.drop("missing"), features, threshold).withColumnsRenamed(
            {"score": f"score_t{h}", "predicted": f"predicted_t{h}"})
    return scored.select("station_id", "date", "missing", "score_t1", "predicted_t1", "score_t2", "predicted_t2")


MISSING = ", ".join(f"case when {c} is null then '{c}' end" for c in MODEL_FEATURES)


@query(f"""select station_id, date, concat_ws(',', {MISSING}) as missing from (
  select *, lag(pm25_mean) over (partition by station_id order by date) as pm25_mean_lag1 from days)""")
def batch_score_reasons(t: Inputs) -> DataFrame:
    """The rows that batch scoring covers, and what each lacks."""
    rows = _split(t, known_targets=False)
    return rows.select("station_id", "date", md.missing_features(rows, MODEL_FEATURES).alias("missing"))
