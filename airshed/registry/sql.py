"""SQL shared by the input views and the oracles.

``VIEWS`` is the same text on both engines; ``{name}`` stands for a table.
``CTES`` restate the chain of operators in plain SQL for the oracles.
"""

from __future__ import annotations

import re

COUNTRY = "substr('FRESBENLDE', cast(1+2*({key}%5) as int), 2)"
STATION = f"concat({COUNTRY.format(key='user_id')}, lpad(cast(user_id as string),5,'0'))"
SCORE = "(event_id*7919 % 1000)/cast(2000.0 as double) + value/(value+25)/2"

VIEWS = {
    "fx_readings": f"""
        select {STATION} as AirQualityStationEoICode,
          case event_type when 'view' then 'PM2.5' when 'click' then 'PM10'
            when 'purchase' then 'NO2' when 'signup' then 'O3' else 'SO2' end as AirPollutant,
          ts as Start,
          cast(case when event_id%31=0 then null when event_id%37=0 then -1.0
            else cast(value as double) end as string) as Value,
          cast(case when event_id%20=0 then -1 when event_id%33=0 then -99
            else 1+event_id%2 end as string) as Validity,
          case when event_id%3=0 then 'E2a' else 'E1a' end as verification_level
        from {{events}}""",
    "fx_stations": f"""
        select {STATION} as station_id, {COUNTRY.format(key='user_id')} as country_code,
          cast(45.0 as double)+(user_id%20)/cast(40.0 as double) as latitude,
          cast(2.0 as double)+(user_id%7)/cast(14.0 as double) as longitude
        from (select distinct user_id from {{events}}) u""",
    "fx_grid": """
        select cast(l_orderkey%30 as int) as day_idx, cast(l_linenumber as int) as hour,
          cast(45.0 as double)+(l_suppkey%3)*cast(0.25 as double) as latitude,
          cast(2.0 as double)+(l_partkey%3)*cast(0.25 as double) as longitude,
          248.15+l_quantity as t2m, l_discount*100-5 as u10, l_tax*100-4 as v10,
          100000+l_extendedprice/100 as sp, l_discount/1000 as tp, l_quantity*30 as blh
        from {lineitem}""",
    "fx_health": f"""
        select concat({COUNTRY.format(key='o_custkey')},'00',cast(o_custkey%2 as string))
            as nuts3_code,
          2024 as year, cast(1+o_orderkey%5 as int) as week,
          case o_orderstatus when 'F' then 'T' when 'O' then 'M' else 'F' end as sex,
          case when o_orderpriority like '1%' or o_orderpriority like '2%' then 'TOTAL'
            else 'Y65' end as age,
          count(*) as deaths
        from {{orders}} group by 1,2,3,4,5""",
    "fx_causes": f"""
        select concat({COUNTRY.format(key='o_custkey')},'00') as geo,
          case substr(o_orderpriority,1,1) when '1' then 'J00-J99' when '2' then 'J40-J47'
            when '3' then 'I00-I99' when '4' then 'I20-I25' else 'C00-C97' end as icd10,
          cast(year(o_orderdate)+24 as int) as year, count(*) as deaths
        from {{orders}} group by 1,2,3""",
    "fx_who": """
        select case o_custkey%6 when 0 then '4130' when 1 then '4190' when 2 then '4210'
            when 3 then '4070' when 4 then '4150' else '9999' end as country,
          case substr(o_orderpriority,1,1) when '1' then 'J10' when '2' then 'I21'
            when '3' then 'J45' when '4' then 'I64' else 'C34' end as cause,
          cast(year(o_orderdate) as int) as year, count(*) as deaths1
        from {orders} group by 1,2,3""",
    "fx_population": f"""
        select concat({COUNTRY.format(key='c_custkey')},'00',cast(c_custkey%2 as string))
            as nuts3_code, count(*)*1000 as population
        from {{customer}} group by 1""",
    "fx_scores": f"""
        select event_id, {STATION} as station_id, {COUNTRY.format(key='user_id')} as country_code,
          cast(ts as date) as date, event_type, value as pm25_mean,
          case when value > 25 then 1 else 0 end as label, {SCORE} as score,
          cast(ts as date) > date '2024-01-20' as is_current
        from {{events}}""",
}

POLLUTANTS = {"PM2.5": "pm25", "PM10": "pm10", "NO2": "no2", "O3": "o3", "SO2": "so2"}
WEATHER = ["temp_2m", "wind_u10", "wind_v10", "wind_speed", "surface_pressure", "precipitation",
           "boundary_layer_height", "boundary_layer_height_min", "low_blh_flag"]
SEASON = ("case when month in (12,1,2) then 'winter' when month in (3,4,5) then 'spring' "
          "when month in (6,7,8) then 'summer' else 'autumn' end")


def _pivot() -> str:
    parts = []
    for suffix, source in (("mean", "value_mean"), ("max", "value_max"),
                           ("readings", "reading_count")):
        parts += [f"max(case when pollutant='{p}' then {source} end) as {s}_{suffix}"
                  for p, s in POLLUTANTS.items()]
    return ", ".join(parts)


CALENDAR = ("cast(year(date) as int) as year, cast(month(date) as int) as month, "
            "cast(dayofweek(date)+1 as int) as day_of_week")

CTES = {
    "raw": """select AirQualityStationEoICode as station_id, AirPollutant as pollutant,
        cast(Start as date) as date, try_cast(Value as double) as value,
        try_cast(Validity as int) as validity, verification_level from fx_readings""",
    "valid": """select *, upper(substr(station_id,1,2)) as country_code from raw
        where validity >= 1 and value >= 0""",
    "clean": """select * replace (least(value, case pollutant when 'PM2.5' then 900
        when 'PM10' then 1500 when 'NO2' then 1000 when 'O3' then 400 else 2000 end) as value)
        from valid""",
    "daily": """select station_id, pollutant, date, avg(value) as value_mean,
        max(value) as value_max, count(*) as reading_count, min(verification_level)
        as verification_level
        from (select *, min(verification_level) over (partition by station_id, pollutant, date)
          as best from clean) where verification_level = best group by 1,2,3""",
    "mixed": """select station_id, pollutant, date, avg(value) as value_mean,
        max(value) as value_max, count(*) as reading_count,
        min(verification_level) as verification_level from clean group by 1,2,3""",
    "wide": f"""select station_id, date, {_pivot()}, upper(substr(station_id,1,2))
        as country_code, {CALENDAR} from daily group by station_id, date""",
    "grid_days": """select latitude, longitude, date '2024-01-01' + day_idx as date,
        avg(t2m)-273.15 as t2m, avg(u10) as u10, avg(v10) as v10, avg(sp)/100 as sp,
        avg(blh) as blh, sum(tp)*1000 as tp, min(blh) as blh_min
        from fx_grid group by 1,2,3""",
    "weights": """select station_id, g.*,
        greatest(0, 1-abs(s.latitude-g.latitude)/0.25) *
        greatest(0, 1-abs(s.longitude-g.longitude)/0.25) as w
        from fx_stations s join grid_days g on abs(s.latitude-g.latitude) < 0.25
          and abs(s.longitude-g.longitude) < 0.25""",
    "station_grid": """select station_id, date, sum(w*t2m) as t2m, sum(w*u10) as u10,
        sum(w*v10) as v10, sum(w*sp) as sp, sum(w*blh) as blh, sum(w*tp) as tp,
        sum(w*blh_min) as blh_min from weights where w > 1e-9 group by 1,2""",
    "weather": """select station_id, upper(substr(station_id,1,2)) as country_code, date,
        cast(year(date) as int) as year, cast(month(date) as int) as month, t2m as temp_2m,
        u10 as wind_u10, v10 as wind_v10, sqrt(u10*u10+v10*v10) as wind_speed,
        sp as surface_pressure, tp as precipitation, blh as boundary_layer_height,
        blh_min as boundary_layer_height_min,
        case when blh < 500 then 1 else 0 end as low_blh_flag from station_grid""",
    "days": f"""select wide.*, {', '.join('weather.' + c for c in WEATHER)},
        substr(wide.station_id,1,5) as nuts3_code
        from wide left join weather using (station_id, date)""",
    "weekly": """select nuts3_code, upper(substr(nuts3_code,1,2)) as country_code, year, week,
        cast(strptime(cast(year as varchar)||' '||cast(week as varchar)||' 1', '%G %V %u') as date)
        as date, cast(deaths as double) as deaths
        from fx_health where sex in ('T','TOTAL') and age in ('TOTAL','Y_GE0')""",
    "causes": """select geo as nuts2_code, upper(substr(geo,1,2)) as country_code, year,
        case when icd10 = 'J00-J99' then 'respiratory' else 'cardiovascular' end as cause_group,
        cast(sum(deaths) as double) as deaths from fx_causes
        where icd10 in ('J00-J99','I00-I99') group by 1,2,3,4""",
    "region_day": """select nuts3_code, date, avg(pm25_mean) as pm25_mean from days
        group by 1,2""",
    "runs": """select nuts3_code, min(date) as start_date, max(date) as end_date,
        count(*) as days, max(pm25_mean) as peak from (
          select *, date - cast(row_number() over (partition by nuts3_code order by date) as int)
            as run
          from region_day where pm25_mean > 25) group by nuts3_code, run having count(*) >= 3""",
    "region_week": """select nuts3_code, cast(isoyear(date) as int) as iso_year,
        cast(week(date) as int) as iso_week, avg(pm25_mean) as pm25_mean, avg(temp_2m) as temp_2m,
        avg(wind_speed) as wind_speed, avg(precipitation) as precipitation,
        avg(boundary_layer_height) as boundary_layer_height, count(pm25_mean) as station_days
        from days group by 1,2,3""",
    "panel": """select r.*, substr(r.nuts3_code,1,2) as country_code,
        case when exists (select 1 from runs where runs.nuts3_code = r.nuts3_code
          and date_trunc('week', start_date) <= r.monday
          and end_date >= r.monday) then 1 else 0 end as treated,
        w.deaths, p.population, w.deaths / p.population * 100000 as rate_per_100k
        from (select *, cast(strptime(cast(iso_year as varchar)||' '||
            cast(iso_week as varchar)||' 1', '%G %V %u') as date) as monday from region_week) r
        left join weekly w on w.nuts3_code = r.nuts3_code and w.year = r.iso_year
          and w.week = r.iso_week
        left join fx_population p on p.nuts3_code = r.nuts3_code""",
}

# The same panel with a higher limit, so that some regions stay untreated.
CTES["runs_high"] = CTES["runs"].replace("> 25", "> 45")
CTES["panel_high"] = CTES["panel"].replace("runs", "runs_high")


def _duck(name: str) -> str:
    tables = ["events", "lineitem", "orders", "customer"]
    return VIEWS[name].format(**{t: t for t in tables})


def with_ctes(body: str) -> str:
    """Prefix the views and CTEs that a query uses, in dependency order."""
    texts = {**{n: _duck(n) for n in VIEWS}, **CTES}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in texts:
            if name not in ordered and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                need(texts[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({texts[n]})" for n in ordered) + "\n" + body
