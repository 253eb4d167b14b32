import datetime as dt

from airshed.operators import outcomes as oc


def test_unpivot_weeks_drops_impossible_weeks_and_bad_numbers(spark):
    wide = spark.createDataFrame(
        [("FR101", "T", "TOTAL", "10", "11", "12", ":", "x"),
         ("fr102", "M", "TOTAL", "1", "1", "1", "1", "1")],
        "geo string, sex string, age string, `2020W53` string, `2021W53` string, `2024W01` string, "
        "`2024W02` string, `2024W99` string")
    rows = oc.weekly_deaths(wide).collect()
    assert {(r.year, r.week, r.date, r.deaths) for r in rows} == {
        (2020, 53, dt.date(2020, 12, 28), 10.0), (2024, 1, dt.date(2024, 1, 1), 12.0)}
    assert rows[0].country_code == "FR"


def test_cause_modes(spark):
    wide = spark.createDataFrame(
        [("FR10", "J00-J99", "10", None), ("FR10", "J40-J47", "4", "1"), ("FR10", "I00-I99", "7", "8"),
         ("FR10", "C00", "99", "99")], "geo string, icd10 string, `2019` string, `2020` string")
    def table(mode):
        return {(r.year, r.cause_group): r.deaths for r in oc.cause_deaths(wide, mode).collect()}
    assert table("chapters") == {(2019, "respiratory"): 10.0, (2019, "cardiovascular"): 7.0,
                                 (2020, "cardiovascular"): 8.0}
    assert table("as_coded")[(2019, "respiratory")] == 14.0


def test_who_rows(spark):
    table = spark.createDataFrame(
        [("4130", "J10", "2001", "5"), ("9999", "J10", "2001", "5"), ("4190", "C10", "2001", "5"),
         ("4190", "I10", "x", "5"), ("4190", "I10", "2002", "6")],
        "country string, cause string, year string, deaths1 string")
    rows = {(r.country_code, r.year, r.cause_group, r.deaths)
            for r in oc.who_mortality(table).collect()}
    assert rows == {("NO", 2001, "respiratory", 5.0), ("CH", 2002, "cardiovascular", 6.0)}


def test_split_by_cause_uses_the_share_of_all_deaths(spark):
    weekly = spark.createDataFrame(
        [("FR101", 2020, 1, 60.0), ("FR102", 2020, 1, 40.0), ("DE101", 2020, 1, 5.0)],
        "nuts3_code string, year int, week int, deaths double")
    causes = spark.createDataFrame([("FR10", 2020, "respiratory", 20.0)],
                                   "nuts2_code string, year int, cause_group string, deaths double")
    rows = {r.nuts3_code: (r.respiratory_deaths, r.cardiovascular_deaths)
            for r in oc.split_by_cause(weekly, causes).collect()}
    assert rows == {"FR101": (12.0, None), "FR102": (8.0, None), "DE101": (None, None)}


def test_regions_by_box(spark):
    stations = spark.createDataFrame([("a", 0.5, 0.5), ("b", 2.5, 2.5), ("c", 9.0, 9.0)],
                                     "station_id string, latitude double, longitude double")
    boxes = spark.createDataFrame(
        [("BIG", 0.0, 3.0, 0.0, 3.0), ("SMALL", 0.0, 1.0, 0.0, 1.0)],
        "nuts3_code string, south double, north double, west double, east double")
    rows = {r.station_id: r.nuts3_code for r in oc.regions_by_box(stations, boxes).collect()}
    assert rows == {"a": "SMALL", "b": "BIG", "c": None}


def test_calendar_and_missing_weeks(spark):
    weekly = spark.createDataFrame([("FR", dt.date(2024, 1, 8))], "country_code string, date date")
    missing = oc.missing_weeks(weekly, weekly, "2024-01-02", "2024-01-22")
    assert [r.date.day for r in missing.orderBy("date").collect()] == [15, 22]
    row = oc.completeness(weekly, "2024-01-02", "2024-01-22").first()
    assert (row.expected, row.missing, row.pct, row.flagged) == (3, 2, 33.3, True)


def test_harmonise_codes(spark):
    rows = spark.createDataFrame([("OLD", 2013, 1), ("OLD", 2021, 2), ("NEW", 2013, 3)],
                                 "nuts3_code string, vintage int, n int")
    table = spark.createDataFrame([("OLD", 2013, "NEW")],
                                  "old_code string, vintage int, new_code string")
    assert {(r.nuts3_code, r.n) for r in oc.harmonise_codes(rows, table).collect()} == {
        ("NEW", 1), ("OLD", 2), ("NEW", 3)}


def test_split_codes_share_their_values(spark):
    rows = spark.createDataFrame([("A", "2016", 10.0), ("B", "2016", 4.0)], "nuts3_code string, vintage string, n double")
    table = [("A", "2016", "A1"), ("A", "2016", "A2")]
    even = spark.createDataFrame(table, "old_code string, vintage string, new_code string")
    got = {r.nuts3_code: r.n for r in oc.harmonise_codes(rows, even, values=("n",)).collect()}
    assert got == {"A1": 5.0, "A2": 5.0, "B": 4.0}
    named = spark.createDataFrame([(*t, s) for t, s in zip(table, (0.8, 0.2))],
                                  "old_code string, vintage string, new_code string, share double")
    got = {r.nuts3_code: r.n for r in oc.harmonise_codes(rows, named, values=("n",)).collect()}
    assert got == {"A1": 8.0, "A2": 2.0, "B": 4.0}
