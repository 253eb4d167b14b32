"""Tail probabilities against tables and sums, sketches against exact values, joint tests."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_effects import make_panel

from airshed.functions import tails
from airshed.operators import causal as cs, drift as dr, readings as rd, sketches as sk
from airshed.plans import jobs
from airshed.registry.inputs import Inputs

# Published points of the chi-square and Student distributions.
CHI_SQUARE = [(3.841458821, 1, 0.05), (18.307038053, 10, 0.05), (23.209251159, 10, 0.01), (124.342113405, 100, 0.05),
              (0.0, 3, 1.0), (2.705543454, 1, 0.10), (1.145476226, 5, 0.95)]
STUDENT = [(12.706204736, 1, 0.05), (2.228138852, 10, 0.05), (3.169272667, 10, 0.01), (1.983971519, 100, 0.05), (0.0, 7, 1.0),
           (-2.228138852, 10, 0.05)]


def test_tails_are_those_of_the_tables(spark):
    chi = spark.createDataFrame([(float(x), v, p) for x, v, p in CHI_SQUARE], "x double, v int, p double")
    for r in chi.withColumn("got", tails.chi_square_tail(F.col("x"), F.col("v"))).collect():
        assert abs(r.got - r.p) < 1e-8, r
    t = spark.createDataFrame([(float(x), v, p) for x, v, p in STUDENT], "x double, v int, p double")
    for r in t.withColumn("got", tails.student_two_sided(F.col("x"), F.col("v"))).collect():
        assert abs(r.got - r.p) < 1e-8, r
    # A squared t is an F with one degree above.
    for r in t.withColumn("got", tails.f_tail(F.col("x") * F.col("x"), F.lit(1), F.col("v"))).collect():
        assert abs(r.got - r.p) < 1e-8, r


def test_tails_far_out_and_beyond_their_domain(spark):
    rows = [(x, v) for x in (0.5, 30.0, 400.0, 1500.0) for v in (2, 4, 40)]
    df = spark.createDataFrame(rows, "x double, v int").withColumn("p", tails.chi_square_tail(F.col("x"), F.col("v")))
    for x, v, p in df.collect():  # for even freedom a finite Poisson sum
        logs = [-x / 2 + k * math.log(x / 2) - math.lgamma(k + 1) for k in range(v // 2)]
        want = sum(math.exp(q) for q in logs)
        assert p == pytest.approx(want, rel=1e-8, abs=1e-300)
    odd = spark.createDataFrame([(None, 3), (1.0, 0), (1.0, None)], "x double, v int")
    assert [r[0] for r in odd.select(tails.chi_square_tail(F.col("x"), F.col("v"))).collect()] == [None] * 3
    assert [r[0] for r in odd.select(tails.student_two_sided(F.col("x"), F.col("v"))).collect()] == [None] * 3


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 3.0, 10.25, 171.0, 5000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.withColumn("g", tails.log_gamma(F.col("x"))).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)


def panel_frame(spark, rows):
    names = "nuts3_code string, country_code string, monday date, iso_week int, treated int, pm25_mean double, temp_2m double, " \
            "wind_speed double, precipitation double, boundary_layer_height double, rate_per_100k double"
    return spark.createDataFrame(rows, names)


def test_pretrends_are_parallel_unless_they_are_not(spark):
    rows = make_panel(regions=16, weeks=40)
    flat = cs.pretrend_test(panel_frame(spark, rows)).first()
    assert flat.freedom == 3 and flat.parallel and 0.05 <= flat.p_value <= 1
    first = {}
    for r in rows:
        if r[4]:
            first[r[0]] = min(first.get(r[0], r[2]), r[2])
    drifting = [(*r[:-1], r[-1] - 6.0 * (first[r[0]] - r[2]).days / 7 if r[0] in first and r[2] < first[r[0]]
                 and (first[r[0]] - r[2]).days <= 28 else r[-1]) for r in rows]
    bent = cs.pretrend_test(panel_frame(spark, drifting)).first()
    assert not bent.parallel and bent.p_value < 1e-6 and bent.statistic > flat.statistic


def test_sketched_index_and_distinct_counts(spark):
    rng = random.Random(3)
    rows = [(i % 5, i >= 30_000, rng.gauss(0.3 if i >= 30_000 else 0, 1), None if i % 50 else float("nan"), f"s{rng.randrange(3000)}")
            for i in range(60_000)]
    df = spark.createDataFrame(rows, "part int, is_current boolean, a double, b double, station string")
    parts = sk.value_sketches(df, ["a", "b"], ("is_current", "part"))
    assert parts.count() == 20
    merged = sk.merge_values(parts, ("is_current",)).cache()
    points = sk.quantiles(merged.filter("not is_current and feature = 'a'"), {"p10": 0.1, "p50": 0.5, "p90": 0.9}).first()
    values = np.array([r[2] for r in rows if not r[1]])
    for name, share in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        assert abs((values <= points[name]).mean() - share) < 0.005
    found = {r.feature: r for r in sk.psi(merged.filter("not is_current"), merged.filter("is_current")).collect()}
    exact = {r.feature: r for r in dr.psi(df, ["a"]).collect()}
    assert set(found) == {"a"} and found["a"].level == exact["a"].level and abs(found["a"].psi - exact["a"].psi) < 0.01
    counts = sk.distinct_counts(sk.distinct_sketches(df, "station", ("part",))).first()
    assert abs(counts.n_distinct - 3000) < 150
    # Values never cross a shuffle: what is exchanged are sketches.
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "kll_sketch_agg_double" in plan.split("Exchange")[1]


def test_removal_is_counted_by_the_pass_that_writes(spark, tmp_path):
    raw = Inputs(spark, "/root/testdata/sf0.001").raw
    name = F.concat("AirPollutant", F.lit("_"), "verification_level", F.lit(".parquet"))
    raw.withColumn("source", name).drop("verification_level").write.partitionBy("source").parquet(f"{tmp_path}/raw")
    jobs.clean_readings(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    got = spark.read.parquet(f"{tmp_path}/clean_counts").first().asDict()
    assert got == rd.removed(raw).first().asDict()
    valid, _ = rd.observed(spark.read.parquet(f"{tmp_path}/raw").withColumn("verification_level", F.lit("E1a")), "again")
    assert rd.days_of(valid)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_nearest_controls_are_those_of_all_pairs(spark):
    draw = random.Random(8)
    day = [r[2] for r in make_panel(2, 3, drop=0)][:3]
    rows, base = [], []
    for country in ("AA", "BB"):
        for i in range(30):
            for monday in day:
                value = draw.choice([1.0, 2.0, 2.5, 7.0, draw.random() * 9])
                rows.append((f"{country}{i:02}", country, monday, int(draw.random() < (0.3 if country == "AA" else 0.97)),
                             None if draw.random() < 0.1 else draw.random()))
                base.append((f"{country}{i:02}", monday, None if draw.random() < 0.05 else value))
    panel = spark.createDataFrame(rows, "nuts3_code string, country_code string, monday date, treated int, rate_per_100k double")
    got = cs.nearest_controls(panel, spark.createDataFrame(base, "nuts3_code string, monday date, baseline double"), 4).collect()
    known = {(c, m): b for c, m, b in base if b is not None}
    want = {}
    for code, country, monday, treated, _ in rows:
        if treated and (code, monday) in known:
            near = sorted((abs(known[c, m] - known[code, m]), c) for c, k, m, t, _ in rows
                          if k == country and m == monday and not t and (c, m) in known)[:4]
            want[code, monday] = ",".join(c for _, c in near) or None
    assert {(r.nuts3_code, r.monday): r.controls for r in got} == want
    assert all(r.n_controls == len((r.controls or "").split(",")) * bool(r.controls) for r in got)


def test_curved_confounding_needs_trees(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(4000):
        z, w = rng.uniform(-2, 2), rng.normal()
        group = i % 2
        d = z * z + rng.normal()
        rows.append((f"R{i % 200:03}", "summer" if group else "winter", float(d), float(z), float(w),
                     float((1.0 if group else 3.0) * d + 3 * z * z + w + rng.normal())))
    df = spark.createDataFrame(rows, "nuts3_code string, season string, pm25_mean double, z double, w double, rate_per_100k double")
    found = {n: {r.season: r.effect for r in cs.cate_by_group(df, "season", controls=["z", "w"], nuisance=n).collect()}
             for n in ("linear", "trees")}
    for season, true in (("summer", 1.0), ("winter", 3.0)):
        assert abs(found["linear"][season] - true) > 1 and abs(found["trees"][season] - true) < 0.35
