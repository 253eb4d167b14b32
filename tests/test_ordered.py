"""Running totals, quantiles and range sums against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.operators.ordered import (quantiles, running_totals, sums_in_ranges,
                                       with_order_digits)


def awkward_values(n=3000):
    rng = random.Random(3)
    values = [rng.uniform(-500, 500) for _ in range(n)]
    values += [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)]
    values += [s * float(np.nextafter(2.0**k, d)) for k in range(-30, 31) for d in (0, 1e9)
               for s in (-1, 1)]
    values += [s * 2.0**k for k in range(-1022, 1023, 37) for s in (-1, 1)]
    values += [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7976931348623157e308]
    return values


def test_digits_sort_like_values(spark):
    values = awkward_values()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = with_order_digits(df, "v").collect()
    ordered = sorted(rows, key=lambda r: (r._high, r._mid, r._low))
    got = [r.v for r in ordered if abs(r.v) > 1e-300]
    assert got == sorted(got)
    keys = {(r._high, r._mid, r._low) for r in rows if abs(r.v) > 1e-300}
    assert len(keys) == len(set(got))
    assert max(abs(r._mid) for r in rows) < 2**21 and max(abs(r._low) for r in rows) < 2**21


def test_running_totals_with_a_hot_value_and_a_hot_key(spark):
    rng = random.Random(5)
    rows = [("a" if i % 3 else rng.choice("bcd"), 7.5 if i % 3 == 1 else rng.gauss(0, 100),
             rng.randint(0, 5)) for i in range(4000)]
    rows += [(None, 1.0, 1), ("a", None, 1)]
    df = spark.createDataFrame(rows, "k string, v double, w int")
    found = running_totals(df, ["k"], "v", {"w": F.col("w"), "n": F.lit(1)}).collect()
    clean = [r for r in rows if r[0] is not None and r[1] is not None]
    assert len(found) == len({(k, v) for k, v, _ in clean})
    for r in random.Random(1).sample(found, 60):
        group = [x for x in clean if x[0] == r.k]
        assert r.w == sum(w for _, v, w in group if v == r.v)
        assert r.w_before == sum(w for _, v, w in group if v < r.v)
        assert r.n_total == len(group)


def test_quantiles_match_numpy(spark):
    rng = random.Random(9)
    groups = {k: [round(rng.expovariate(0.05), 2) for _ in range(n)]
              for k, n in (("a", 1), ("b", 2), ("c", 777), ("d", 1000))}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in quantiles(df, ["k"], "v", points).collect():
        for name, q in points.items():
            assert r[name] == pytest.approx(np.quantile(groups[r.k], q))


def test_quantiles_without_keys(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert quantiles(df, [], "v", {"m": 0.5}).first().m == 50.0


def test_range_sums_match_pairs(spark):
    rng = random.Random(2)
    points = [(rng.choice("ab"), float(rng.randint(0, 40)), rng.random()) for _ in range(400)]
    ranges = [(rng.choice("ab"), i, float(rng.randint(0, 40))) for i in range(80)]
    p = spark.createDataFrame(points, "k string, v double, y double")
    q = spark.createDataFrame([(k, i, lo, lo + 5.0) for k, i, lo in ranges],
                              "k string, i int, lo double, hi double")
    found = {r.i: (r.n, r.y) for r in sums_in_ranges(
        p, q, ["k"], "v", ["i"], "lo", "hi", {"n": F.lit(1), "y": F.col("y")}).collect()}
    for k, i, lo in ranges:
        inside = [y for kk, v, y in points if kk == k and lo <= v <= lo + 5]
        assert found[i][0] == len(inside) and found[i][1] == pytest.approx(sum(inside))
