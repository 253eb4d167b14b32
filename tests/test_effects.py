"""Panel, matching and estimators against numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.operators import causal as cs, profile as pf, regression as rg, summary as sm

MONDAY = dt.date(2024, 1, 1)


def make_panel(regions=12, weeks=30, seed=4, drop=0.1):
    rng = np.random.default_rng(seed)
    rows = []
    for r in range(regions):
        level = rng.normal(50, 10)
        start = 8 + r if r % 2 else None
        for w in range(weeks):
            temp, wind, rain, blh = rng.normal(size=4)
            treated = int(start is not None and w >= start)
            pm = 20 + 5 * treated - 3 * blh + rng.normal()
            y = level + 0.5 * w + 4 * treated + 2 * temp - wind + rng.normal()
            if rng.random() > drop:
                monday = MONDAY + dt.timedelta(weeks=w)
                rows.append((f"CC{r:03d}", ("FR", "DE")[r % 2], monday, monday.isocalendar()[1],
                             treated, float(pm), float(temp), float(wind), float(rain), float(blh),
                             float(y)))
    return rows


COLUMNS = ("nuts3_code string, country_code string, monday date, iso_week int, treated int, "
           "pm25_mean double, temp_2m double, wind_speed double, precipitation double, "
           "boundary_layer_height double, rate_per_100k double")
ROWS = make_panel()


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def design(rows, x_of):
    regions = sorted({r[0] for r in rows})
    weeks = sorted({r[3] for r in rows})
    x = np.array([[*x_of(r), *[float(r[0] == g) for g in regions],
                   *[float(r[3] == w) for w in weeks[1:]]] for r in rows])
    y = np.array([r[10] for r in rows])
    return x, y, regions


def test_two_way_effects_match_full_dummies(panel):
    x, y, regions = design(ROWS, lambda r: [r[4], *r[6:10]])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rows = {r.term: r for r in cs.did_att(panel).collect()}
    for i, name in enumerate(["treated", *cs.COVARIATES]):
        assert rows[name].estimate == pytest.approx(beta[i], abs=1e-6)
    e = y - x @ beta
    bread = np.linalg.pinv(x.T @ x)
    scores = np.array([sum(x[i] * e[i] for i in range(len(y)) if ROWS[i][0] == g)
                       for g in regions])
    g = len(regions)
    v = g / (g - 1) * bread @ scores.T @ scores @ bread
    assert rows["treated"].std_error == pytest.approx(np.sqrt(v[0, 0]), rel=1e-5)
    assert rows["treated"].ci_low < 4 < rows["treated"].ci_high


def test_event_study_finds_no_pre_trend(panel):
    rows = {r.term: r for r in cs.event_study(panel).collect()}
    assert len(rows) == 12 and "week_m1" not in rows
    assert abs(rows["week_m3"].estimate) < 4 * rows["week_m3"].std_error + 1e-9
    assert rows["week_p2"].estimate > 2


def test_weeks_outside_the_event_window_do_not_move_the_base(spark):
    """No effect inside the window, a large one after it: every estimate is zero."""
    rng = random.Random(3)
    rows = []
    for r in range(12):
        for w in range(30):
            start = 6 + r % 3 if r < 6 else None
            late = start is not None and w - start > 8
            rows.append((f"R{r}", MONDAY + dt.timedelta(weeks=w), w + 1, int(start is not None and w == start),
                         float(10 * r + w % 7 + (100 if late else 0)), rng.random()))
    df = spark.createDataFrame(rows, "nuts3_code string, monday date, iso_week int, treated int, "
                                     "rate_per_100k double, temp_2m double")
    found = cs.event_study(df, covariates=["temp_2m"]).collect()
    assert len(found) == 12 and all(abs(r.estimate) < 1e-6 for r in found)


def test_event_time_is_bounded(panel):
    weeks = {r.event_week for r in cs.event_time(panel).collect()}
    assert weeks - {None} == set(range(-4, 9))


def test_two_stage_matches_numpy(panel):
    y = np.array([r[10] for r in ROWS])
    d = np.array([r[5] for r in ROWS])
    one = np.ones(len(y))
    w = np.array([[r[6], r[8]] for r in ROWS])
    z = np.column_stack([[r[9] for r in ROWS], [r[7] for r in ROWS], w, one])
    x = np.column_stack([d, w, one])
    fitted = z @ np.linalg.lstsq(z, x, rcond=None)[0]
    beta = np.linalg.lstsq(fitted, y, rcond=None)[0]
    e = y - x @ beta
    pz = z @ np.linalg.lstsq(z, e, rcond=None)[0]
    table = {r.estimator: r for r in cs.iv_2sls(
        panel, instruments=["boundary_layer_height", "wind_speed"]).collect()}
    assert table["iv"].effect == pytest.approx(10 * beta[0], rel=1e-6)
    assert table["ols"].effect == pytest.approx(10 * np.linalg.lstsq(x, y, rcond=None)[0][0])
    assert table["iv"].sargan == pytest.approx(float(e @ pz / (e @ e / len(y))), rel=1e-5)
    narrow = np.column_stack([w, one])
    r1 = d - narrow @ np.linalg.lstsq(narrow, d, rcond=None)[0]
    r2 = d - z @ np.linalg.lstsq(z, d, rcond=None)[0]
    f = ((r1 @ r1 - r2 @ r2) / 2) / (r2 @ r2 / (len(y) - 5))
    assert table["iv"].first_stage_f == pytest.approx(f, rel=1e-6)


def test_summer_can_be_left_out(panel):
    some = cs.iv_2sls(panel, exclude_months=[6, 7, 8]).first().n
    assert some == sum(1 for r in ROWS if r[2].month not in (6, 7, 8))


def test_grouped_effects_recover_the_slope(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(2000):
        group = "ab"[i % 2]
        t = rng.normal()
        d = 2 * t + rng.normal()
        y = (1.0 if group == "a" else 3.0) * d + 5 * t + 0.1 * rng.normal()
        rows.append((f"R{i % 40}", group, float(t), float(d), float(y)))
    df = spark.createDataFrame(rows, "nuts3_code string, season string, t double, d double, y double")
    found = {r.season: r for r in cs.cate_by_group(df, "season", "y", "d", ["t"]).collect()}
    assert found["a"].effect < found["b"].effect and found["a"].ci_low < found["a"].ci_high
    assert found["b"].effect - found["a"].effect == pytest.approx(2.0, abs=0.3)


def test_moments_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("a"),
                                  (F.col("id") % 11).cast("double").alias("b")).repartition(9)
    m = rg.moments(df, ["a", "b"])
    a, b = np.arange(1000) % 7, np.arange(1000) % 11
    assert m.n == 1000
    assert np.allclose(m.cross, np.cov(np.vstack([a, b]), bias=True) * 1000)


def test_episodes_need_consecutive_days(spark):
    above = [0, 1, 2, 4, 5, 7, 8, 9, 10]
    rows = [("R", MONDAY + dt.timedelta(days=i), 30.0 + i if i in above else 10.0)
            for i in range(12)]
    df = spark.createDataFrame(rows, "nuts3_code string, date date, pm25_mean double")
    got = sorted(((r.start_date - MONDAY).days, r.days, r.peak) for r in sm.episodes(df).collect())
    assert got == [(0, 3, 32.0), (7, 4, 40.0)]


def test_treated_weeks_cover_the_whole_episode(spark):
    runs = spark.createDataFrame([("R", dt.date(2024, 1, 7), dt.date(2024, 1, 15))],
                                 "nuts3_code string, start_date date, end_date date")
    assert [r.monday.day for r in cs.treated_weeks(runs).orderBy("monday").collect()] == [1, 8, 15]


def test_baseline_covers_thirty_days(spark):
    rows = [("R", MONDAY + dt.timedelta(days=i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "nuts3_code string, date date, pm25_mean double")
    found = {r.monday: r.baseline for r in cs.baselines(df).collect()}
    for w in range(1, 9):
        m = MONDAY + dt.timedelta(weeks=w)
        past = [i for i in range(60) if -30 <= i - 7 * w <= -1]
        assert found[m] == pytest.approx(sum(past) / len(past))


def test_matching_equals_pairing(spark):
    rng = random.Random(6)
    rows = [(f"R{i}", rng.choice(["FR", "DE"]), MONDAY, rng.randint(0, 1), float(rng.randint(1, 9)))
            for i in range(300)]
    base = [(r[0], MONDAY, float(rng.randint(10, 60))) for r in rows]
    panel_rows = spark.createDataFrame(
        rows, "nuts3_code string, country_code string, monday date, treated int, "
              "rate_per_100k double")
    baselines = spark.createDataFrame(base, "nuts3_code string, monday date, baseline double")
    of = {b[0]: b[2] for b in base}
    found = cs.match_controls(panel_rows, baselines).collect()
    assert len(found) == sum(r[3] for r in rows)
    for r in found:
        rates = [x[4] for x in rows if not x[3] and x[1] == r.country_code
                 and of[r.nuts3_code] * 0.8 <= of[x[0]] <= of[r.nuts3_code] * 1.2]
        assert r.n_controls == len(rates)
        if rates:
            assert r.control_rate == pytest.approx(np.mean(rates))
        else:
            assert r.control_rate is None


def test_normal_distribution_function(spark):
    from math import erf, sqrt

    zs = [0.0, 0.5, 1.0, 1.96, 2.99, 3.0, 4.0, 8.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in df.select("z", pf.normal_cdf(F.col("z")).alias("p")).collect():
        assert r.p == pytest.approx(0.5 * (1 + erf(r.z / sqrt(2))), abs=1e-8)


def test_p_value_keeps_its_tail(spark):
    from math import erfc, sqrt

    ts = [0.0, 1.5, -2.5, 9.0, 12.0, 30.0]
    for r in pf.with_p_value(spark.createDataFrame([(t,) for t in ts], "t double")).collect():
        assert r.p_value == pytest.approx(erfc(abs(r.t) / sqrt(2)), rel=1e-6)


def test_every_pair_of_countries_is_there(spark):
    rows = [(c, dt.date(2024, 1, 1 + d), float(d * k + d % 3)) for k, c in enumerate(("FR", "PT", "IT"), 1) for d in range(6)]
    rows += [("ZZ", dt.date(2024, 1, 2), 1.0), ("YY", dt.date(2024, 2, 2), 1.0)]
    df = spark.createDataFrame(rows, "country_code string, date date, pm25_mean double")
    found = {(r.country_a, r.country_b): (r.r, r.n_days) for r in sm.cross_border_corr(df).collect()}
    assert len(found) == 10 and found["FR", "PT"][1] == 6
    assert found["FR", "ZZ"] == (None, 1) and found["YY", "ZZ"] == (None, 0)
