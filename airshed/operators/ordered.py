"""Running totals in value order, and what follows from them: exact quantiles and ranks.

A plain ordered window over all rows would gather them in one task.  Here rows
are first collapsed to distinct values, then the running total is assembled from
three levels of digits (``with_order_digits``): a window never spans more than the
distinct digits below one prefix, at most two million rows, and in practice far
fewer.  Nothing is sampled, and nothing depends on how Spark cut the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.functions import columns as fx
from airshed.session import cut_lineage


def with_order_digits(df: DataFrame, value: str) -> DataFrame:
    """Add three integers that sort, in turn, like the finite double they come from.

    ``_high`` holds sign, exponent and the first 10 bits of the mantissa, ``_mid``
    and ``_low`` 21 bits each.  Scaling by powers of two is exact, so two values
    share all three exactly when they are equal.  Each step is a projection of its
    own, so no intermediate is computed twice.
    """
    v, two = F.col(value), F.lit(2.0)
    df = df.select("*", F.abs(v).alias("_s"))
    df = df.select("*", F.greatest(F.floor(F.log2("_s")), F.lit(-1022)).cast("double").alias("_g"))
    df = df.select("*", (F.col("_s") * F.pow(two, -F.col("_g"))).alias("_c"))
    # The logarithm may be off by one next to a power of two.
    exponent = F.when(F.col("_c") < 1, F.col("_g") - 1).when(F.col("_c") >= 2, F.col("_g") + 1)
    exponent = F.greatest(exponent.otherwise(F.col("_g")), F.lit(-1022.0))
    df = df.select("*", exponent.alias("_e"))
    df = df.select("*", ((F.col("_s") * F.pow(two, -F.col("_e")) - 1) * 1024).alias("_m"))
    df = df.select("*", F.floor("_m").alias("_h"))
    df = df.select("*", ((F.col("_m") - F.col("_h")) * 2**21).alias("_r"))
    df = df.select("*", F.floor("_r").alias("_f"))
    sign = F.signum(v).cast("long")
    whole = (F.col("_e").cast("long") + 1024) * 1024 + F.col("_h")
    return df.select(
        "*",
        (sign * whole).alias("_high"),
        (sign * F.col("_f")).alias("_mid"),
        (sign * F.floor((F.col("_r") - F.col("_f")) * 2**21)).alias("_low"),
    ).drop("_s", "_g", "_c", "_e", "_m", "_h", "_r", "_f")


def running_totals(df: DataFrame, keys: list[str], value: str,
                   weights: dict[str, Column]) -> DataFrame:
    """One row per (keys, value) with, for each weight ``w``:

    ``w``: its sum on this value, ``w_before``: over smaller values of the same
    keys, ``w_total``: over all values of the same keys.  Rows with a missing key
    or value, or with one that is not finite, are left out.

    The distinct values are read by three branches, so they are kept in the shared
    folder rather than derived three times.
    """
    names = list(weights)
    finite = F.abs(F.col(value)) < float("inf")  # false for NaN, which Spark sorts above all
    known = fx.all_of([*[F.col(c).isNotNull() for c in [*keys, value]], finite])
    distinct = (
        df.filter(known)
        .groupBy(*keys, value)
        .agg(*[F.sum(w).alias(name) for name, w in weights.items()])
    )
    leaf = with_order_digits(cut_lineage(distinct), value)
    sums = [F.sum(n).alias(n) for n in names]
    middle = leaf.groupBy(*keys, "_high", "_mid").agg(*sums)
    top = middle.groupBy(*keys, "_high").agg(*sums)

    def before(w: Window, name: str) -> Column:
        return F.coalesce(F.sum(name).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                          F.lit(0))

    by_high = Window.partitionBy(*keys).orderBy("_high")
    everything = Window.partitionBy(*keys)
    top = top.select(
        *keys, "_high",
        *[before(by_high, n).alias(f"_{n}_top") for n in names],
        *[F.sum(n).over(everything).alias(f"{n}_total") for n in names],
    )
    by_mid = Window.partitionBy(*keys, "_high").orderBy("_mid")
    middle = middle.select(
        *keys, "_high", "_mid", *[before(by_mid, n).alias(f"_{n}_mid") for n in names]
    ).join(top, [*keys, "_high"])
    by_low = Window.partitionBy(*keys, "_high", "_mid").orderBy("_low")
    out = leaf.select("*", *[before(by_low, n).alias(f"_{n}_low") for n in names]).join(
        middle, [*keys, "_high", "_mid"]
    )
    return out.select(
        *keys, value, *names,
        *[(F.col(f"_{n}_top") + F.col(f"_{n}_mid") + F.col(f"_{n}_low")).alias(f"{n}_before")
          for n in names],
        *[f"{n}_total" for n in names],
    )


def quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float],
              count: Column | None = None) -> DataFrame:
    """Exact quantiles per group, linear between the two neighbouring order statistics.

    With ``count`` a row stands for that many equal values, possibly none.
    """
    totals = running_totals(df, keys, value, {"n": F.lit(1) if count is None else count})
    n, before = F.col("n_total"), F.col("n_before")

    def at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < before + F.col("n")), F.col(value)))

    picked, result = [], []
    for name, q in points.items():
        position = F.lit(q) * (n - 1)
        low, high = F.floor(position), F.ceil(position)
        picked += [at(low).alias(f"_{name}_lo"), at(high).alias(f"_{name}_hi"),
                   F.max(position - low).alias(f"_{name}_f")]
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        result.append((lo + (hi - lo) * F.col(f"_{name}_f")).alias(name))
    return totals.groupBy(*keys).agg(*picked).select(*keys, *result)


def sums_in_ranges(points: DataFrame, ranges: DataFrame, keys: list[str], value: str,
                   range_id: list[str], low: str, high: str,
                   weights: dict[str, Column]) -> DataFrame:
    """For each range row: the weights of the points with low <= value <= high, same keys.

    Range ends and points are put on one axis and a running total is taken, so no
    point meets a range and no pair is formed.
    """
    names = list(weights)
    zero = [F.lit(0.0).alias(n) for n in names]
    axis = points.select(*keys, F.col(value).alias("_at"),
                         *[w.cast("double").alias(n) for n, w in weights.items()])
    for end in (low, high):
        axis = axis.unionByName(ranges.select(*keys, F.col(end).alias("_at"), *zero))
    totals = running_totals(axis, keys, "_at", {n: F.col(n) for n in names})

    ends = ranges.select(
        *keys, *range_id,
        F.inline(F.array(
            F.struct(F.col(low).alias("_at"), F.lit(-1).alias("_sign")),
            F.struct(F.col(high).alias("_at"), F.lit(1).alias("_sign")),
        )),
    )
    upto = [
        F.sum(F.when(F.col("_sign") > 0, F.col(f"{n}_before") + F.col(n))
              .otherwise(-F.col(f"{n}_before"))).alias(n)
        for n in names
    ]
    return ends.join(totals, [*keys, "_at"]).groupBy(*keys, *range_id).agg(*upto)
