"""Gridded weather to station-days.  The cube is a long table: one row per node and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from airshed import fixed_values as fv
from airshed.functions import columns as fx

NODE = ["iy", "ix"]
DAILY = ["t2m", "u10", "v10", "sp", "blh", "tp", "blh_min"]


def crop(grid: DataFrame, box: dict[str, float] | None = None) -> DataFrame:
    """Nodes inside a bounding box; the predicate reaches the Parquet scan."""
    box = box or fv.EUROPE_BOX
    return grid.filter(
        F.col("latitude").between(box["south"], box["north"])
        & F.col("longitude").between(box["west"], box["east"])
    )


def daily_grid(grid: DataFrame) -> DataFrame:
    """Hourly to daily (UTC days) with unit conversion.

    Means of temperature, wind, pressure and boundary layer; the sum of
    precipitation; the minimum of the boundary layer.  Out: degrees C, hPa, mm.
    """
    mean = {c: F.avg(fx.nan_to_null(F.col(c))) for c in ("t2m", "u10", "v10", "sp", "blh")}
    # Whatever the session's time zone is.
    day = F.to_date(F.to_utc_timestamp("time", F.current_timezone())).alias("date")
    daily = grid.groupBy("latitude", "longitude", day).agg(
        (mean["t2m"] - 273.15).alias("t2m"),
        mean["u10"].alias("u10"),
        mean["v10"].alias("v10"),
        (mean["sp"] / 100).alias("sp"),
        mean["blh"].alias("blh"),
        (F.sum(fx.nan_to_null(F.col("tp"))) * 1000).alias("tp"),
        F.min(fx.nan_to_null(F.col("blh"))).alias("blh_min"),
    )
    return daily


def _steps(value: Column, step: float) -> Column:
    """Position in grid steps; a position within noise of a node is that node."""
    position = value / step
    nearest = F.round(position)
    return F.when(F.abs(position - nearest) < 1e-9, nearest).otherwise(position)


def corners(stations: DataFrame, step: float = fv.GRID_STEP, method: str = "bilinear",
            power: float = 2.0) -> DataFrame:
    """The surrounding nodes of each station with their weights (up to four rows each).

    ``bilinear`` weights by area, ``idw`` by inverse distance, ``nearest`` keeps
    the node with the largest bilinear weight.  Nodes of weight zero are left
    out, so a station on a node or on the grid edge needs only the nodes that count.
    """
    y, x = _steps(F.col("latitude"), step), _steps(F.col("longitude"), step)
    df = stations.select("station_id", "latitude", "longitude", y.alias("y"), x.alias("x"))
    df = df.select("*", F.floor("y").cast("int").alias("y0"), F.floor("x").cast("int").alias("x0"))
    fy, fx_ = F.col("y") - F.col("y0"), F.col("x") - F.col("x0")

    def corner(dy: int, dx: int) -> Column:
        area = (fy if dy else 1 - fy) * (fx_ if dx else 1 - fx_)
        distance2 = (fy - dy) * (fy - dy) + (fx_ - dx) * (fx_ - dx)
        return F.struct(
            (F.col("y0") + dy).alias("iy"), (F.col("x0") + dx).alias("ix"),
            area.alias("area"), distance2.alias("distance2"),
        )

    nodes = F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))
    if method == "bilinear":
        kept = F.transform(nodes, lambda n: _weighted(n, n["area"]))
    elif method == "nearest":
        best = F.array_max(F.transform(nodes, lambda n: n["area"]))
        first = F.array_position(F.transform(nodes, lambda n: n["area"]), best)
        chosen = F.element_at(nodes, first.cast("int"))
        kept = F.array(_weighted(chosen, F.lit(1.0)))
    elif method == "idw":
        # A station on a node takes that node alone.
        on_node = F.exists(nodes, lambda n: n["distance2"] == 0)
        inverse = F.transform(nodes, lambda n: _weighted(
            n, F.when(on_node, (n["distance2"] == 0).cast("double"))
            .otherwise(F.try_divide(F.lit(1.0), F.pow(n["distance2"], F.lit(power / 2))))
        ))
        whole = F.aggregate(inverse, F.lit(0.0), lambda s, n: s + n["weight"])
        kept = F.transform(inverse, lambda n: _weighted(n, n["weight"] / whole))
    else:
        raise ValueError(f"unknown method {method!r}")
    kept = F.filter(kept, lambda n: n["weight"] > 0)
    df = df.select("station_id", F.size(kept).alias("needed"), F.explode(kept).alias("n"))
    return df.select("station_id", "needed", "n.iy", "n.ix", "n.weight")


def _weighted(node: Column, weight: Column) -> Column:
    return F.struct(node["iy"].alias("iy"), node["ix"].alias("ix"), weight.alias("weight"))


def _stations_by_place(stations: DataFrame, step: float, method: str) -> DataFrame:
    """One row per station: ``own``, its nodes with their weights, and ``place``, the nodes alone.

    Rows that share a station's name are added up node by node first, so copies do not
    lengthen ``own``.
    """
    nodes = corners(stations, step, method).groupBy("station_id", *NODE).agg(
        F.sum("weight").alias("weight"), F.count("*").alias("copies"), F.max("needed").alias("needed")
    )
    own = F.array_sort(F.collect_list(F.struct(*NODE, "weight", "copies", "needed"))).alias("own")
    place = F.transform("own", lambda n: F.struct(n["iy"].alias("iy"), n["ix"].alias("ix")))
    return nodes.groupBy("station_id").agg(own).withColumn("place", place)


def interpolate(daily: DataFrame, stations: DataFrame, step: float = fv.GRID_STEP,
                method: str = "bilinear", salts: int = 64) -> DataFrame:
    """Daily grid to station-days by equi-joins on integer node numbers.

    A value is null when any node it needs is missing or null.  The values of all nodes
    of a place (those one station needs) are gathered by day first: there are as many
    places as cells in use, however many stations stand in them.  A station-day then is
    one row of one join and no task holds station-days.  Many stations may share a place,
    and each brings every day of it: the stations of a place are cut into ``salts`` and its
    days go to each salt that has stations.  This join makes far more rows than it reads, so
    the bytes it reads say nothing about its tasks: both sides are dealt to the session's
    number of shuffle partitions, which AQE does not merge.
    The rows are dealt by (station_id, date), as readings are.
    """
    nodes = daily.filter(F.col("date").isNotNull()).select(
        F.round(F.col("latitude") / step).cast("int").alias("iy"),
        F.round(F.col("longitude") / step).cast("int").alias("ix"),
        "date", *DAILY,
    )
    placed = _stations_by_place(stations, step, method).withColumn(
        "_salt", F.pmod(F.xxhash64("station_id"), F.lit(salts)))
    of_place = placed.groupBy("place").agg(F.array_sort(F.collect_set("_salt")).alias("_salts"))
    of_place = of_place.select("place", "_salts", F.posexplode("place").alias("at", "n"))
    values = of_place.select("place", "_salts", "at", "n.iy", "n.ix").join(nodes, NODE)
    days = values.groupBy("place", "_salts", "date").agg(
        F.array_sort(F.collect_list(F.struct("at", *DAILY))).alias("there")
    )
    days = days.select("place", F.explode("_salts").alias("_salt"), "date", "there")
    tasks, key = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["place", "_salt"]
    joined = placed.repartition(tasks, *key).join(days.repartition(tasks, *key), key)

    def own(n: Column, field: str) -> Column:
        return F.get("own", n["at"])[field]

    needed = F.array_max(F.transform("there", lambda n: own(n, "needed")))

    def total(c: str) -> Column:
        found = F.aggregate("there", F.lit(0).cast("long"), lambda s, n: s + F.when(
            n[c].isNotNull(), own(n, "copies")).otherwise(0))
        whole = F.aggregate("there", F.lit(0.0), lambda s, n: s + F.coalesce(own(n, "weight") * n[c], F.lit(0.0)))
        return F.when(found == F.col("needed"), whole).alias(c)

    values = joined.withColumn("needed", needed).select("station_id", "date", *[total(c) for c in DAILY])
    return values.repartition("station_id", "date")


def station_weather(grid: DataFrame, stations: DataFrame, step: float = fv.GRID_STEP,
                    method: str = "bilinear") -> DataFrame:
    """Hourly grid to the station-day weather table, derived columns included.

    Wind speed is taken from the daily mean components (the vector mean).
    """
    values = interpolate(daily_grid(grid), stations, step, method)
    u, v, blh = F.col("u10"), F.col("v10"), F.col("blh")
    return values.select(
        "station_id",
        fx.country_of(F.col("station_id")).alias("country_code"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.col("t2m").alias("temp_2m"),
        u.alias("wind_u10"),
        v.alias("wind_v10"),
        F.sqrt(u * u + v * v).alias("wind_speed"),
        F.col("sp").alias("surface_pressure"),
        F.col("tp").alias("precipitation"),
        blh.alias("boundary_layer_height"),
        F.col("blh_min").alias("boundary_layer_height_min"),
        fx.flag(blh < fv.LOW_BLH_METRES).alias("low_blh_flag"),
    )
