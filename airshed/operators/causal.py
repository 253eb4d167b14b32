"""Region-week panel and the effect estimates made from it."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx, tails
from airshed.operators import regression as rg
from airshed.operators import summary
from airshed.operators.ordered import sums_in_ranges
from airshed.session import cut_lineage

OUTCOMES = ["deaths", "respiratory_deaths", "cardiovascular_deaths"]
COVARIATES = ["temp_2m", "wind_speed", "precipitation", "boundary_layer_height"]


def treated_weeks(runs: DataFrame) -> DataFrame:
    """Regions and Mondays of the weeks an episode touches."""
    mondays = F.sequence(
        fx.monday_of(F.col("start_date")), fx.monday_of(F.col("end_date")),
        F.expr("interval 7 days"),
    )
    return runs.select("nuts3_code", F.explode(mondays).alias("monday")).distinct()


def panel(days: DataFrame, weekly: DataFrame, population: DataFrame,
          limit: float = fv.EU_DAILY_LIMIT, min_days: int = 3) -> DataFrame:
    """One row per region and ISO week: exposure, weather, treatment, outcome rate."""
    return panel_of_totals(summary.region_day_totals(days), weekly, population, limit, min_days)


def panel_of_totals(totals: DataFrame, weekly: DataFrame, population: DataFrame,
                    limit: float = fv.EU_DAILY_LIMIT, min_days: int = 3) -> DataFrame:
    """The panel from region-day totals.

    Several panels, or a panel and its baselines, can share one kept table of totals.
    """
    exposure = summary.weekly_means(totals)
    exposure = exposure.withColumn("monday", fx.iso_monday(F.col("iso_year"), F.col("iso_week")))
    runs = summary.episodes(summary.daily_means(totals), limit, min_days)
    treated = treated_weeks(runs).withColumn("treated", F.lit(1))
    # Deaths by cause too, where the weekly table has them.
    counted = [c for c in OUTCOMES if c in weekly.columns]
    outcome = weekly.groupBy("nuts3_code", F.col("date").alias("monday")).agg(
        *[F.sum(c).alias(c) for c in counted]
    )
    joined = (
        exposure.join(treated, ["nuts3_code", "monday"], "left")
        .join(outcome, ["nuts3_code", "monday"], "left")
        .join(population.select("nuts3_code", "population"), ["nuts3_code"], "left")
    )
    return joined.withColumns({
        "country_code": fx.country_of(F.col("nuts3_code")),
        "treated": F.coalesce("treated", F.lit(0)),
        "rate_per_100k": fx.ratio(F.col("deaths"), F.col("population")) * 100_000,
        **{c.replace("_deaths", "_per_100k"): fx.ratio(F.col(c), F.col("population")) * 100_000
           for c in counted if c != "deaths"},
    })


def limit_runs(totals: DataFrame, weekly: DataFrame, population: DataFrame, limits: list[float],
               outcomes: list[str], covariates: list[str] | None = None) -> DataFrame:
    """Effect of treatment under each exposure limit and on each outcome (a placebo among
    them), with the number of treated region-weeks behind it."""
    totals = cut_lineage(totals)
    table = None
    for limit in limits:
        rows = cut_lineage(panel_of_totals(totals, weekly, population, limit))
        treated = rows.filter("treated = 1").count()
        for outcome in outcomes:
            found = did_att(rows, outcome, covariates).filter("term = 'treated'").drop("term").select(
                F.lit(float(limit)).alias("limit_value"), F.lit(outcome).alias("outcome"), "*",
                F.lit(treated).alias("n_treated"))
            table = found if table is None else table.unionByName(found)
    return table


def baselines(region_day: DataFrame, days: int = 30) -> DataFrame:
    """Mean PM2.5 of the days before each Monday.

    A region-day counts towards the four or five Mondays that follow it within
    the period, so no window over the history is needed.
    """
    following = F.sequence(
        F.date_add(fx.monday_of(F.col("date")), 7), F.date_add("date", days),
        F.expr("interval 7 days"),
    )
    spread = region_day.select("nuts3_code", "pm25_mean", F.explode(following).alias("monday"))
    return spread.groupBy("nuts3_code", "monday").agg(F.avg("pm25_mean").alias("baseline"))


def match_controls(panel_rows: DataFrame, base: DataFrame, band: float = 0.20) -> DataFrame:
    """Controls of each treated region-week, as totals.

    A control is an untreated region of the same country and week whose baseline
    is within the band around the treated one's.  Counts and mean outcome come
    from running totals over the baselines; treated and controls are not paired.
    """
    joined = panel_rows.join(base, ["nuts3_code", "monday"])
    # Points and ranges both come from these rows; keep them so they are made once.
    rows = cut_lineage(joined.filter(F.col("baseline").isNotNull()))
    keys = ["country_code", "monday"]
    controls = rows.filter(F.col("treated") == 0)
    wanted = rows.filter(F.col("treated") == 1).select(
        *keys, "nuts3_code", "baseline", "rate_per_100k",
        (F.col("baseline") * (1 - band)).alias("low"),
        (F.col("baseline") * (1 + band)).alias("high"),
    )
    known = F.col("rate_per_100k").isNotNull()
    sums = sums_in_ranges(
        controls, wanted, keys, "baseline", ["nuts3_code"], "low", "high",
        {
            "n_controls": F.lit(1.0),
            "n_rates": known.cast("double"),
            "rate_sum": F.coalesce("rate_per_100k", F.lit(0.0)),
        },
    )
    joined = wanted.select(*keys, "nuts3_code", "baseline", "rate_per_100k").join(
        sums, [*keys, "nuts3_code"]
    )
    control_rate = F.when(F.col("n_rates") > 0, F.col("rate_sum") / F.col("n_rates"))
    return joined.select(
        *keys, "nuts3_code", "baseline", "rate_per_100k",
        F.col("n_controls").cast("long").alias("n_controls"),
        control_rate.alias("control_rate"),
        (F.col("rate_per_100k") - control_rate).alias("difference"),
    )


def nearest_controls(panel_rows: DataFrame, base: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` controls of each treated region-week with the nearest baselines, ties by code.

    Untreated regions of a country and week are numbered in order of their baseline.  The
    nearest ones of a treated region lie next to its place in that order, at most ``k`` to
    either side, so it looks up 2 k numbers; no pairs are formed.  A window holds the regions
    of one country.
    """
    keys = ["country_code", "monday"]
    joined = panel_rows.join(base, ["nuts3_code", "monday"]).filter(F.col("baseline").isNotNull())
    group = Window.partitionBy(*keys)
    # From below the smallest code of equal baselines comes last, from above it comes first.
    order = {"down": ["baseline", F.desc("nuts3_code")], "up": ["baseline", "nuts3_code"]}
    upto = group.orderBy("baseline").rangeBetween(Window.unboundedPreceding, 0)
    is_control = F.col("treated") == 0
    rows = joined.withColumn("upto", F.count(F.when(is_control, 1)).over(upto))
    rows = cut_lineage(rows.withColumns({
        side: F.when(is_control, F.count(F.when(is_control, 1)).over(group.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)))
        for side, by in order.items()}))
    controls = rows.filter(is_control)

    def beside(side: str) -> Column:
        steps = F.sequence(F.lit(0), F.lit(k - 1))
        return F.transform(steps, lambda i: F.struct(
            F.lit(side).alias("side"), (F.col("upto") + (-i if side == "down" else i + 1)).alias("place")))

    places = F.inline(F.concat(*[beside(side) for side in order]))
    wanted = rows.filter(F.col("treated") == 1).select(*keys, "nuts3_code", "baseline", "rate_per_100k", places)
    known = controls.select(*keys, F.inline(F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("place")) for side in order])),
                            F.col("nuts3_code").alias("control"), F.col("baseline").alias("control_baseline"),
                            F.col("rate_per_100k").alias("rate"))
    # Of the controls up to its own baseline those numbered downwards count, of the others those upwards.
    near = wanted.join(known, [*keys, "side", "place"], "left")
    near = near.filter(F.col("control").isNotNull() & ((F.col("side") == "down") == (F.col("control_baseline") <= F.col("baseline"))))
    gap = F.abs(F.col("control_baseline") - F.col("baseline"))
    rank = F.row_number().over(Window.partitionBy(*keys, "nuts3_code").orderBy(gap, "control"))
    found = near.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy(*keys, "nuts3_code").agg(
        F.count(F.lit(1)).alias("n_controls"), F.avg("rate").alias("control_rate"),
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("rank", "control"))), lambda c: c["control"])).alias("controls"))
    treated = rows.filter(F.col("treated") == 1).select(*keys, "nuts3_code", "baseline", "rate_per_100k")
    return treated.join(found, [*keys, "nuts3_code"], "left").select(
        *keys, "nuts3_code", "baseline", "rate_per_100k", F.coalesce("n_controls", F.lit(0)).alias("n_controls"), "controls",
        "control_rate", (F.col("rate_per_100k") - F.col("control_rate")).alias("difference"))


def event_time(panel_rows: DataFrame, before: int = 4, after: int = 8) -> DataFrame:
    """Weeks since the region's first treated week; outside the span, or never treated, null."""
    own = Window.partitionBy("nuts3_code")
    first = F.min(F.when(F.col("treated") == 1, F.col("monday"))).over(own)
    weeks = (F.datediff("monday", first) / 7).cast("int")
    return panel_rows.withColumn("event_week", weeks).withColumn(
        "event_week", F.when(F.col("event_week").between(-before, after), F.col("event_week"))
    )


def did_2x2(panel_rows: DataFrame, first_post_monday: str) -> DataFrame:
    """Difference in differences of group means: ever treated or not, before or after."""
    own = Window.partitionBy("nuts3_code")
    ever = F.max("treated").over(own) == 1
    post = F.col("monday") >= F.lit(first_post_monday).cast("date")
    rows = panel_rows.select("rate_per_100k", ever.alias("ever"), post.alias("post"))
    cells = {
        "treated_pre": F.col("ever") & ~F.col("post"), "treated_post": F.col("ever") & F.col("post"),
        "control_pre": ~F.col("ever") & ~F.col("post"),
        "control_post": ~F.col("ever") & F.col("post"),
    }
    means = rows.agg(*[F.avg(F.when(c, F.col("rate_per_100k"))).alias(n)
                       for n, c in cells.items()])
    effect = (F.col("treated_post") - F.col("treated_pre")) - (
        F.col("control_post") - F.col("control_pre")
    )
    return means.withColumn("did", effect)


def did_att(panel_rows: DataFrame, outcome: str = "rate_per_100k",
            covariates: list[str] | None = None) -> DataFrame:
    """Effect of treatment with region and week-of-year effects and weather covariates.

    Another outcome (a placebo) or a panel built with another limit is the same call.
    """
    x = ["treated", *(COVARIATES if covariates is None else covariates)]
    fit = rg.two_way_fit(panel_rows, outcome, x, "nuts3_code", F.col("iso_week"))
    return rg.fit_table(panel_rows, fit, x)


def event_study(panel_rows: DataFrame, outcome: str = "rate_per_100k", before: int = 4,
                after: int = 8, covariates: list[str] | None = None) -> DataFrame:
    """Coefficient per week relative to the first episode; the week before it is the base."""
    fit, names = _event_fit(panel_rows, outcome, before, after, covariates)
    return rg.fit_table(panel_rows, fit, list(names.values()))


def pretrend_test(panel_rows: DataFrame, outcome: str = "rate_per_100k", before: int = 4, after: int = 8,
                  covariates: list[str] | None = None, level: float = 0.05) -> DataFrame:
    """Joint test that the weeks before the base have no effect: one row with the Wald
    statistic, its degrees of freedom, p by chi-square, and whether trends count as parallel."""
    fit, names = _event_fit(panel_rows, outcome, before, after, covariates)
    statistic, freedom = fit.joint([n for k, n in names.items() if k < -1])
    row = panel_rows.sparkSession.createDataFrame([(statistic, freedom, fit.n)], "statistic double, freedom int, n long")
    p = tails.chi_square_tail(F.col("statistic"), F.col("freedom"))
    return row.withColumn("p_value", p).withColumn("parallel", F.col("p_value") >= level)


def _event_fit(panel_rows: DataFrame, outcome: str, before: int, after: int,
               covariates: list[str] | None) -> tuple[rg.Fit, dict[int, str]]:
    """The fit of the event study and the name of each week's coefficient."""
    # Weeks of treated regions outside the span belong neither to a week of the study nor to
    # the base; only never treated regions serve beside them.
    timed = event_time(panel_rows, before, after)
    ever = F.max("treated").over(Window.partitionBy("nuts3_code")) == 1
    timed = timed.withColumn("_ever", ever).filter(~F.col("_ever") | F.col("event_week").isNotNull())
    relative = [k for k in range(-before, after + 1) if k != -1]
    names = {k: f"week_{'m' if k < 0 else 'p'}{abs(k)}" for k in relative}
    dummies = timed.withColumns({
        name: fx.flag(F.col("event_week") == k) for k, name in names.items()
    })
    x = [*names.values(), *(COVARIATES if covariates is None else covariates)]
    return rg.two_way_fit(dummies, outcome, x, "nuts3_code", F.col("iso_week")), names


def iv_wald(rows: DataFrame, y: str, d: str, z: str) -> DataFrame:
    """One instrument, no controls: covariance ratio, and the plain slope beside it."""
    complete = rows.select(y, d, z).dropna()
    return complete.agg(
        fx.ratio(F.covar_samp(z, y), F.covar_samp(z, d)).alias("iv_estimate"),
        F.regr_slope(y, d).alias("ols_estimate"),
        F.count("*").alias("n"),
    )


def first_stage_f(rows: DataFrame, d: str, z: str, minimum: float = 10.0) -> DataFrame:
    complete = rows.select(d, z).dropna()
    found = complete.agg(fx.correlation(F.col(z), F.col(d)).alias("r"), F.count("*").alias("n"))
    f = fx.ratio(F.col("r") * F.col("r") * (F.col("n") - 2), 1 - F.col("r") * F.col("r"))
    return found.select(f.alias("f"), "n", (f > minimum).alias("strong"))


def iv_2sls(rows: DataFrame, y: str = "rate_per_100k", d: str = "pm25_mean",
            instruments: list[str] | None = None, controls: list[str] | None = None,
            scale: float = 10.0, exclude_months: list[int] | None = None) -> DataFrame:
    """2SLS effect of a 10 ug/m3 rise, OLS beside it, first-stage F, Sargan statistic and its p.

    Overidentified with a second instrument; ``exclude_months=[6, 7, 8]`` is the
    sensitivity run without summer.
    """
    instruments = instruments or ["boundary_layer_height"]
    controls = ["temp_2m", "precipitation"] if controls is None else controls
    if exclude_months:
        rows = rows.filter(~F.month("monday").isin(exclude_months))
    m = rg.moments(rows, [y, d, *instruments, *controls])
    found = rg.two_stage(m, y, d, instruments, controls)
    table = [
        (kind, found[kind] * scale, found[f"{kind}_se"] * scale,
         (found[kind] - 1.96 * found[f"{kind}_se"]) * scale,
         (found[kind] + 1.96 * found[f"{kind}_se"]) * scale,
         found["first_stage_f"], found["sargan"] if found["sargan_df"] > 0 else None,
         int(found["sargan_df"]), int(found["n"]))
        for kind in ("iv", "ols")
    ]
    made = rows.sparkSession.createDataFrame(
        table, "estimator string, effect double, std_error double, ci_low double, "
               "ci_high double, first_stage_f double, sargan double, sargan_df int, n long"
    )
    return made.withColumn("sargan_p", tails.chi_square_tail(F.col("sargan"), F.col("sargan_df")))


def _fold(column: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(folds)).cast("int")


def _tree_residuals(folded: DataFrame, targets: dict[str, str], controls: list[str], folds: int,
                    rounds: int, depth: int) -> DataFrame:
    """The rows with each target less its prediction by boosted trees fitted on the other folds."""
    ready = VectorAssembler(inputCols=controls, outputCol="_x").transform(folded)
    parts = []
    for k in range(folds):
        part = ready.filter(F.col("_fold") == k)
        for name, target in targets.items():
            trees = GBTRegressor(featuresCol="_x", labelCol=target, predictionCol=f"_p{name}", maxIter=rounds,
                                 maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=7)
            model = trees.fit(ready.filter(F.col("_fold") != k))
            part = model.transform(part).withColumn(name, F.col(target) - F.col(f"_p{name}")).drop(f"_p{name}")
        parts.append(part.drop("_x"))
    return reduce(DataFrame.unionByName, parts)


def cate_by_group(rows: DataFrame, modifier: str, y: str = "rate_per_100k", d: str = "pm25_mean",
                  controls: list[str] | None = None, folds: int = 2, nuisance: str = "linear",
                  rounds: int = 40, depth: int = 4) -> DataFrame:
    """Effect of the exposure per value of an effect modifier, with 95 % intervals.

    Exposure and outcome are each predicted from the controls by a model fitted
    on the other folds (regions are assigned to folds whole); the effect is the
    slope between the two residuals within each group.  ``nuisance``: linear models, or
    boosted ``trees`` where confounders act in curves.
    """
    if nuisance not in ("linear", "trees"):
        raise ValueError(f"unknown nuisance {nuisance!r}")
    controls = COVARIATES if controls is None else controls
    complete = rows.select("nuts3_code", y, d, modifier, *[c for c in controls if c != modifier])
    complete = complete.dropna(subset=[y, d, modifier, *controls])
    folded = cut_lineage(complete.withColumn("_fold", _fold("nuts3_code", folds)))

    def residual(target: str) -> Column:
        fits = rg.fold_fits(folded, "_fold", folds, target, controls)
        predicted = F.lit(None).cast("double")
        for k, (slopes, intercept) in fits.items():
            value = rg.linear(controls, slopes) + F.lit(float(intercept))
            predicted = F.when(F.col("_fold") == k, value).otherwise(predicted)
        return F.col(target) - predicted

    if nuisance == "trees":
        res = cut_lineage(_tree_residuals(folded, {"ry": y, "rd": d}, controls, folds, rounds, depth).select(modifier, "ry", "rd"))
    else:
        res = folded.select(modifier, residual(y).alias("ry"), residual(d).alias("rd"))
    ry, rd = F.col("ry"), F.col("rd")
    sums = res.groupBy(modifier).agg(
        F.sum(ry * rd).alias("yd"), F.sum(rd * rd).alias("dd"), F.sum(ry * ry).alias("yy"),
        F.count("*").alias("n"),
    )
    effect = fx.ratio(F.col("yd"), F.col("dd"))
    left = F.greatest(F.col("yy") - effect * F.col("yd"), F.lit(0.0))
    se = F.sqrt(fx.ratio(left, F.greatest(F.col("n") - 1, F.lit(1)) * F.col("dd")))
    return sums.select(
        modifier, effect.alias("effect"), se.alias("std_error"),
        (effect - 1.96 * se).alias("ci_low"), (effect + 1.96 * se).alias("ci_high"), "n",
    )


def slopes_by_group(rows: DataFrame, modifier: Column, y: str, d: str) -> DataFrame:
    """Plain slope of y on d per group."""
    both = F.col(y).isNotNull() & F.col(d).isNotNull()
    return rows.groupBy(modifier.alias("group_value")).agg(
        F.regr_slope(y, d).alias("effect"), F.count_if(both).alias("n")
    )


def health_impact(regions: DataFrame, effect_per_unit: Column,
                  target: float = fv.WHO_ANNUAL_GUIDELINE) -> DataFrame:
    """Deaths avoided if each region's exposure came down to the target.

    Needs nuts3_code, pm25_mean, population; the effect is a rate per 100,000
    and ug/m3.
    """
    change = F.greatest(F.col("pm25_mean") - target, F.lit(0.0))
    avoided = effect_per_unit * change * F.col("population") / 100_000
    return regions.select("nuts3_code", "pm25_mean", "population",
                          change.alias("exposure_change"), avoided.alias("deaths_avoided"))


def threshold_sensitivity(days: DataFrame, limits: list[float]) -> DataFrame:
    """Exceedance days and share under other limits, all in one pass."""
    pm25 = F.col("pm25_mean")
    found = days.groupBy("country_code").agg(
        F.count(pm25).alias("n"), *[F.count_if(pm25 > x).alias(f"above_{i}")
                                    for i, x in enumerate(limits)]
    )
    rows = F.array(*[
        F.struct(F.lit(float(x)).alias("limit_value"), F.col(f"above_{i}").alias("n_above"),
                 fx.ratio(F.col(f"above_{i}"), F.col("n")).alias("share"))
        for i, x in enumerate(limits)
    ])
    return found.select("country_code", "n", F.inline(rows))
