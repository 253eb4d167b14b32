"""Change propagation and merged runs of a stream, against full rebuilds."""

import os
import random

import pytest
from pyspark.sql import functions as F

from airshed.plans import incremental
from airshed.registry import landing
from airshed.registry.inputs import Inputs
from airshed.streaming import ingest

FOLDER = "/root/testdata/sf0.001"
TABLES = ("clean", "store", "years")


def rows(spark, path):
    df = spark.read.parquet(path)
    doubles = [F.round(c, 6).alias(c) if k == "double" else c for c, k in sorted(df.dtypes)]
    return sorted(map(str, df.select(*doubles).collect()))


def files(path):
    return {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def by_place(path):
    return {d: sorted(n for n in os.listdir(f"{path}/{d}/{y}") if n.startswith("part-"))
            for d in os.listdir(path) if d.startswith("country_code=") for y in os.listdir(f"{path}/{d}")}


@pytest.fixture()
def landed(spark, tmp_path):
    t, base = Inputs(spark, FOLDER), str(tmp_path)
    inputs = landing.prepare_update(t, base)
    landing.write_readings(landing.early_state(t), f"{base}/raw")

    def run(at=base):
        return incremental.update(spark, f"{base}/raw", inputs["weather"], inputs["weekly"], at).collect()

    return t, base, run


def test_an_update_equals_a_full_rebuild(spark, landed):
    t, base, run = landed
    run()
    before = {n: by_place(f"{base}/{n}") for n in TABLES}
    held = files(f"{base}/store")
    # One file gets more German days: other countries stay as they are.
    file = F.concat("AirPollutant", F.lit("_"), "verification_level")
    landing.write_readings(t.raw.filter(file == "PM2.5_E1a"), f"{base}/raw")
    rebuilt = run()
    assert {r["country_code"] for r in rebuilt} == {"DE"}
    for name in TABLES:
        now = by_place(f"{base}/{name}")
        for place, names in before[name].items():
            assert (now[place] == names) == (place != "country_code=DE")
    kept = files(f"{base}/store")
    assert all(kept[f] == m for f, m in held.items() if f in kept) and set(held) & set(kept)
    # The rest changes: other values, withdrawn days, a file that had not landed.
    landing.write_readings(t.raw.filter(file.isin("NO2_E1a", "PM10_E1a")), f"{base}/raw")
    run()
    run(f"{base}/full")
    for name in TABLES:
        assert rows(spark, f"{base}/{name}") == rows(spark, f"{base}/full/{name}")
    assert run() == []


def test_a_file_that_goes_takes_its_days(spark, landed):
    t, base, run = landed
    run()
    files_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/raw/source=PM10_E1a.parquet")
    files_of.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(files_of, True)
    run()
    run(f"{base}/full")
    for name in TABLES:
        assert rows(spark, f"{base}/{name}") == rows(spark, f"{base}/full/{name}")


def test_an_update_that_was_broken_off_is_taken_up(spark, landed, monkeypatch):
    t, base, run = landed
    run()
    landing.write_readings(t.raw, f"{base}/raw")
    real, calls = incremental._replace, []

    def fails(df, path, places):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(df, path, places)

    monkeypatch.setattr(incremental, "_replace", fails)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.setattr(incremental, "_replace", real)
    assert run()
    run(f"{base}/full")
    for name in TABLES:
        assert rows(spark, f"{base}/{name}") == rows(spark, f"{base}/full/{name}")


def test_reached_places_hold_all_rows_that_change(spark):
    draw = random.Random(5)
    schema = "station_id string, date date, country_code string, year int"
    days = spark.sql("select explode(sequence(date'2022-10-01', date'2024-03-01')) as date").collect()
    for _ in range(3):
        clean = [(s, d["date"], "XX", d["date"].year) for s in "ab" for d in days if draw.random() < 0.05]
        touched = [(s, d, c, y) for s, d, c, y in clean if draw.random() < 0.04] + [("a", days[80]["date"], "XX", 2022)]
        got = {r["year"] for r in incremental.reached_places(
            spark.createDataFrame(clean, schema), spark.createDataFrame(touched, schema), 14, 2).collect()}
        want = {d.year for _, d, _, _ in touched}
        for s in "ab":
            order = sorted({d for x, d, *_ in clean + touched if x == s})
            hit = [i for i, d in enumerate(order) if any(x == s and d == e for x, e, *_ in touched)]
            want |= {order[j].year for i in hit for j in range(max(0, i - 2), min(len(order), i + 15))}
        assert got == want


def test_runs_are_merged_and_counted_once(spark, tmp_path):
    target, draw = str(tmp_path / "runs"), random.Random(1)
    schema = "station_id string, pollutant string, date date, rank int, total double, n long, top double"
    day = spark.sql("select date'2024-01-01' as d").first()["d"]
    total = {}
    for batch in range(70):
        part = [(f"s{draw.randrange(5)}", "PM2.5", day, draw.randrange(2), float(draw.randrange(9)), 1, float(batch))]
        for s, _, _, r, v, n, top in part:
            a, b, c = total.get((s, r), (0.0, 0, 0.0))
            total[s, r] = (a + v, b + n, max(c, top))
        spark.createDataFrame(part, schema).write.parquet(f"{target}/run={batch:012}-{batch:012}")
        assert ingest.compact(spark, target, 4) <= 3 * 4
    # A driver lost between the merge and the removal, and one lost while writing.
    runs = ingest.live_runs(ingest._runs(spark, target))
    first = spark.read.parquet(runs[0][2])
    first.write.parquet(f"{target}/run={runs[0][0]:012}-{runs[0][0]:012}")
    first.write.parquet(f"{target}/run={0:012}-{99:012}")
    os.remove(f"{target}/run={0:012}-{99:012}/_SUCCESS")
    merged = ingest._merged(spark.read.parquet(*[p for *_, p in ingest.live_runs(ingest._runs(spark, target))]))
    got = {(r["station_id"], r["rank"]): (r["total"], r["n"], r["top"]) for r in merged.collect()}
    assert got == total
    assert ingest.compact(spark, target, 4) == len(runs)
