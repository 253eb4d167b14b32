"""Queries over scored frames: thresholds, metrics, drift and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from airshed import fixed_values as fv
from airshed.operators import drift as dr, metrics as mt, sketches as sk
from airshed.registry.core import query
from airshed.registry.inputs import Inputs
from airshed.session import kept, scratch_path

CURVE = """select score, 1.0*sum(p) over w / (sum(p) over w + sum(q) over w) as precision,
  1.0*sum(p) over w / sum(p) over () as recall from (
    select score, sum(label) as p, sum(1-label) as q from fx_scores group by score)
  window w as (order by score desc)"""


@query(f"""select coalesce(max(score), 0.5) as threshold, max(recall) as recall,
  max(precision) as precision from (select * from ({CURVE}) where precision > 0.55
  order by recall desc, score limit 1)""", "threshold recall precision")
def threshold_precision_floor(t: Inputs) -> DataFrame:
    """A floor of 0.55, since at 0.20 the lowest score of this data already qualifies."""
    return mt.threshold_precision_floor(t.scores, floor=0.55)


SWEEP = """select k/100.0 as threshold,
  count(case when label = 1 and score >= cast(k as double)/100.0 then 1 end) as tp,
  count(case when label = 0 and score >= cast(k as double)/100.0 then 1 end) as fp,
  1.0*count(case when label = 1 and score >= cast(k as double)/100.0 then 1 end)
    / sum(label) as recall,
  1.0*count(case when label = 1 and score >= cast(k as double)/100.0 then 1 end)
    / count(case when score >= cast(k as double)/100.0 then 1 end) as precision
  from fx_scores, range(30, 70) r(k) group by k"""


@query(SWEEP.replace("k/100.0 as threshold", "cast(k as double)/100.0 as threshold"),
       "threshold recall precision")
def threshold_sweep(t: Inputs) -> DataFrame:
    return mt.threshold_sweep(t.scores)


@query(f"""select coalesce(max(case when recall >= 0.9 then threshold end), 0.5) as threshold
  from ({SWEEP.replace("k/100.0 as threshold", "cast(k as double)/100.0 as threshold")})""",
       "threshold")
def threshold_selected(t: Inputs) -> DataFrame:
    return mt.select_threshold(mt.threshold_sweep(t.scores))


COUNTS = """count(case when label=1 and score>=0.5 then 1 end) as tp,
  count(case when label=0 and score>=0.5 then 1 end) as fp,
  count(case when label=1 and score<0.5 then 1 end) as fn,
  count(case when label=0 and score<0.5 then 1 end) as tn,
  avg((score-label)*(score-label)) as brier"""
AUC = """select sum(p*(below + q/2.0)) / (sum(p)*sum(q)) as roc_auc from (
  select p, q, coalesce(sum(q) over (order by score rows between unbounded preceding
    and 1 preceding), 0) as below from (
    select score, cast(sum(label) as double) as p, cast(sum(1-label) as double) as q
    from fx_scores group by score))"""


@query(f"""select tp, fp, fn, tn, brier, 1.0*tp/(tp+fn) as recall, 1.0*tp/(tp+fp) as precision,
  2.0*tp/(2*tp+fp+fn) as f1, 1.0*(tp+tn)/(tp+fp+fn+tn) as accuracy, 1.0*tn/(tn+fp) as safe_recall,
  1.0*tn/(tn+fn) as safe_precision, (select roc_auc from ({AUC})) as roc_auc
  from (select {COUNTS} from fx_scores)""",
       "brier recall precision f1 accuracy safe_recall safe_precision roc_auc")
def classification_metrics(t: Inputs) -> DataFrame:
    return mt.classification_metrics(t.scores)


@query(f"""select country_code, tp, fn, 1.0*tp/(tp+fn) as recall, 1.0*tp/(tp+fn) >= 0.85 as meets
  from (select country_code, {COUNTS} from fx_scores group by 1)""", "recall")
def recall_by_country(t: Inputs) -> DataFrame:
    return mt.recall_by(t.scores, ["country_code"])


PREDICTED = """(select station_id, date, max(case when score >= 0.5 then 1 else 0 end) as predicted
  from fx_scores group by 1,2)"""
TRUTH = """(select station_id, date, max(label) as label from fx_scores group by 1,2
  having count(*) > 1)"""


def _rolling(n: int) -> str:
    w = f"over (order by date range between interval {n - 1} day preceding and current row)"
    return (f"1.0*sum(tp) {w} / nullif(sum(tp) {w} + sum(fn) {w}, 0) as recall_{n}d, "
            f"1.0*sum(tp) {w} / nullif(sum(tp) {w} + sum(fp) {w}, 0) as precision_{n}d")


@query(f"""select date, tp, fn, fp, {_rolling(7)}, {_rolling(30)} from (
  select p.date, count(case when label=1 and predicted=1 then 1 end) as tp,
    count(case when label=1 and predicted=0 then 1 end) as fn,
    count(case when label=0 and predicted=1 then 1 end) as fp
  from {PREDICTED} p left join {TRUTH} y on p.station_id = y.station_id and p.date = y.date
  group by 1)""", "recall_7d precision_7d recall_30d precision_30d")
def rolling_recall(t: Inputs) -> DataFrame:
    """Predictions per station-day; truth has arrived for days with two readings or more."""
    daily = t.scores.groupBy("station_id", "date").agg(
        F.max((F.col("score") >= 0.5).cast("int")).alias("predicted"),
        F.max("label").alias("label"), F.count("*").alias("n"),
    )
    truth = daily.filter(F.col("n") > 1).select("station_id", "date", "label")
    return mt.rolling_recall(daily.select("station_id", "date", "predicted"), truth)


@query("""select split, count(*) as n, min(date) as first_date, max(date) as last_date,
  cast(sum(label) as bigint) as n_positive from (
    select *, case when date <= date '2024-01-18' then 'train'
      when date <= date '2024-01-24' then 'validation' else 'test' end as split from fx_scores)
  group by 1""")
def temporal_split(t: Inputs) -> DataFrame:
    split = mt.temporal_split(t.scores, "2024-01-18", "2024-01-24")
    return split.groupBy("split").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.sum("label").cast("long").alias("n_positive"),
    )


RUNS = """select event_type, 1.0*count(case when label=1 and score>=0.5 and is_current then 1 end)
    / count(case when label=1 and is_current then 1 end) as new_recall,
  1.0*count(case when label=1 and score>=0.5 and not is_current then 1 end)
    / count(case when label=1 and not is_current then 1 end) as current_recall,
  abs(avg(case when is_current then score end) - avg(case when not is_current then score end))*10
    as new_psi from fx_scores group by 1"""


def _runs(t: Inputs) -> DataFrame:
    """A table of model runs, one per event type."""
    hit = (F.col("label") == 1) & (F.col("score") >= 0.5)
    positive, now = F.col("label") == 1, F.col("is_current")
    moved = F.avg(F.when(now, F.col("score"))) - F.avg(F.when(~now, F.col("score")))
    return t.scores.groupBy("event_type").agg(
        (F.count_if(hit & now) / F.count_if(positive & now)).alias("new_recall"),
        (F.count_if(hit & ~now) / F.count_if(positive & ~now)).alias("current_recall"),
        (F.abs(moved) * 10).alias("new_psi"),
    )


@query(f"""select *, new_recall >= 0.7 and new_psi <= 0.25 and new_recall >= current_recall - 0.02
  as deploy from ({RUNS})""", "new_recall current_recall new_psi")
def select_champion(t: Inputs) -> DataFrame:
    return mt.select_champion(_runs(t), recall_min=0.7)


@query("""select *, reason not in ('no new data', 'no trigger met') as retrain from (
  select *, case when not new_data then 'no new data'
    when rolling_recall < 0.8 then 'recall degradation' when max_psi > 0.25 then 'feature drift'
    when weeks_since >= 4 then 'scheduled retrain' else 'no trigger met' end as reason from (
    select date, count(*) > 300 as new_data,
      0.3 + 1.0*count(case when label=1 and score>=0.5 then 1 end)
        / count(case when label=1 then 1 end) as rolling_recall,
      abs(avg(score) - 0.5)*4 as max_psi, cast(day(date) % 6 as int) as weeks_since
    from fx_scores group by 1))""", "rolling_recall max_psi")
def retrain_decision(t: Inputs) -> DataFrame:
    """A table of weekly states, one per day of the data."""
    hit = (F.col("label") == 1) & (F.col("score") >= 0.5)
    runs = t.scores.groupBy("date").agg(
        (F.count("*") > 300).alias("new_data"),
        (F.lit(0.3) + F.count_if(hit) / F.count_if(F.col("label") == 1)).alias("rolling_recall"),
        (F.abs(F.avg("score") - 0.5) * 4).alias("max_psi"),
        (F.dayofmonth("date") % 6).cast("int").alias("weeks_since"),
    )
    return mt.retrain_decision(runs)


# --- drift --------------------------------------------------------------------------------

FEATURES = ["pm25_mean", "score"]
LONG = " union all ".join(f"select '{f}' as feature, {f} as value, is_current from fx_scores"
                          for f in FEATURES)


def _psi_sql(rows: str) -> str:
    return f"""select feature, sum((p-q)*ln(p/q)) as psi, case when sum((p-q)*ln(p/q)) > 0.25
    then 'alert' when sum((p-q)*ln(p/q)) >= 0.1 then 'warning' else 'stable' end as level from (
  select feature, bin, greatest(1e-4, 1.0*count(case when is_current then 1 end)
      / sum(count(case when is_current then 1 end)) over (partition by feature)) as p,
    greatest(1e-4, 1.0*count(case when not is_current then 1 end)
      / sum(count(case when not is_current then 1 end)) over (partition by feature)) as q
  from (select l.feature, is_current, len(list_filter(e.edges, lambda x: x < l.value)) as bin
    from ({rows}) l join (
      select feature, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) as edges
      from ({rows}) where not is_current group by 1) e on e.feature = l.feature)
  group by 1,2) group by 1"""


@query(_psi_sql(LONG), "psi")
def psi(t: Inputs) -> DataFrame:
    return dr.psi(t.scores, FEATURES)


@query(f"""select feature, psi, true as close from ({_psi_sql(LONG)})""", "psi")
def psi_sketch(t: Inputs) -> DataFrame:
    """The index from sketches of weeks, merged, beside the exact one: within 0.02."""
    week = F.date_trunc("week", "date").alias("week")
    parts = sk.value_sketches(t.scores.select("*", week), FEATURES, ("is_current", "week"))
    merged = kept(sk.merge_values(kept(parts, "sketches"), ("is_current",)), "merged")
    found = sk.psi(merged.filter("not is_current"), merged.filter("is_current"))
    return sk.within(found, dr.psi(t.scores, FEATURES), "feature", "psi", 0.02)


KS_P = " + ".join(f"{2 * (-1) ** (k - 1)} * exp(-2.0*{k * k}*z*z)" for k in range(1, 31))


def _ks_sql(rows: str) -> str:
    return f"""select feature, statistic, n_base, n_current, case when z < 0.2 then 1.0
    else greatest(0.0, least(1.0, {KS_P})) end as p_value,
  (case when z < 0.2 then 1.0 else greatest(0.0, least(1.0, {KS_P})) end) < 0.01 as alert from (
  select *, sqrt(1.0*n_base*n_current/(n_base+n_current))*statistic as z from (
    select feature, max(abs(cb/nb - cc/nc)) as statistic, cast(max(nb) as bigint) as n_base,
      cast(max(nc) as bigint) as n_current from (
      select feature, value, cast(sum(b) over w as double) as cb,
        cast(sum(c) over w as double) as cc,
        cast(sum(b) over (partition by feature) as double) as nb,
        cast(sum(c) over (partition by feature) as double) as nc from (
          select feature, value, count(case when not is_current then 1 end) as b,
            count(case when is_current then 1 end) as c from ({rows}) group by 1,2)
      window w as (partition by feature order by value)) group by 1))"""


@query(_ks_sql(LONG), "statistic p_value")
def ks_test(t: Inputs) -> DataFrame:
    return dr.ks_test(t.scores, FEATURES)


SINCE = "2024-01-20"
MEASURES = [*fv.FEATURE_POLLUTANTS, *[c for c in fv.FEATURE_WEATHER if c != "low_blh_flag"]]


def _days_long(features: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as feature, cast({c} as double) as value, date >= date '{SINCE}' as is_current "
        f"from days where {c} is not null" for c in features)


@query(_psi_sql(_days_long(MEASURES)), "psi")
def psi_store(t: Inputs) -> DataFrame:
    """The newest days against the stored baseline of the days before."""
    path = scratch_path(t.spark, "baseline")
    dr.baseline_table(t.days.filter(F.col("date") < SINCE), MEASURES).write.parquet(path)
    return dr.psi_against(t.days.filter(F.col("date") >= SINCE), t.spark.read.parquet(path))


WATCHED_BY_KS = ["pm25_mean", "boundary_layer_height", "temp_2m"]


@query(_ks_sql(_days_long(WATCHED_BY_KS)), "statistic p_value")
def ks_store(t: Inputs) -> DataFrame:
    return dr.ks_test(t.days.withColumn("is_current", F.col("date") >= SINCE), WATCHED_BY_KS)


@query("""select sum(p*ln(p/q)) as kl, sum(p*ln(p/q)) > 0.1 as alert from (
  select bin, greatest(1e-4, 1.0*count(case when is_current then 1 end)
      / sum(count(case when is_current then 1 end)) over ()) as p,
    greatest(1e-4, 1.0*count(case when not is_current then 1 end)
      / sum(count(case when not is_current then 1 end)) over ()) as q
  from (select is_current, cast(least(floor(score*10), 9) as int) as bin from fx_scores)
  group by 1)""", "kl")
def kl_divergence(t: Inputs) -> DataFrame:
    return dr.kl_divergence(t.scores)


@query("""select *, current_pct - base_pct as difference, abs(current_pct - base_pct) > 10 as alert
  from (select avg(case when not is_current then label end)*100 as base_pct,
    avg(case when is_current then label end)*100 as current_pct from fx_scores)""",
       "base_pct current_pct difference")
def label_drift(t: Inputs) -> DataFrame:
    return dr.label_drift(t.scores)


@query("""select date, count(*) as n_predictions, 400.0 as expected, count(*)/400.0 as share,
  count(*)/400.0 < 0.5 as alert from fx_scores group by 1""", "expected share")
def prediction_volume(t: Inputs) -> DataFrame:
    return dr.prediction_volume(t.scores, F.lit(400.0))
