"""Least squares from cross-products.

Rows never leave Spark: tasks add up cross-products of their Arrow batches, Spark
sums them, and only the k x k matrix (k columns) reaches the driver to be solved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from airshed.session import cut_lineage


@dataclass(frozen=True)
class Moments:
    """Count, means and centred cross-products of named columns."""

    names: list[str]
    n: int
    means: np.ndarray
    cross: np.ndarray

    def block(self, rows: list[str], columns: list[str]) -> np.ndarray:
        at = {name: i for i, name in enumerate(self.names)}
        return self.cross[np.ix_([at[r] for r in rows], [at[c] for c in columns])]

    def mean_of(self, names: list[str]) -> np.ndarray:
        at = {name: i for i, name in enumerate(self.names)}
        return self.means[[at[n] for n in names]]


def cross_products(df: DataFrame, columns: list[str], shift: list[float],
                   key: str | None = None) -> DataFrame:
    """Sums of (x_i - shift_i)(x_j - shift_j), one row per pair i <= j and key value."""
    label = F.lit(0) if key is None else F.col(key).cast("int")
    numbers = df.select(label.alias("k"), *[
        F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)
    ])
    width = len(columns)
    offsets = list(shift)

    def add_up(batches):
        import numpy as np
        import pandas as pd

        sums = {}
        for batch in batches:
            for k, part in batch.groupby("k"):
                x = part.iloc[:, 1:].to_numpy(dtype=float) - np.array(offsets)
                sums[k] = sums.get(k, 0) + x.T @ x
        i, j = np.triu_indices(width)
        for k, matrix in sums.items():
            yield pd.DataFrame({"k": k, "i": i, "j": j, "s": matrix[i, j]})

    partial = numbers.mapInPandas(add_up, "k int, i int, j int, s double")
    return partial.groupBy("k", "i", "j").agg(F.sum("s").alias("s"))


def _matrices(rows, width: int) -> dict[int, np.ndarray]:
    found: dict[int, np.ndarray] = {}
    for r in rows:
        matrix = found.setdefault(r["k"], np.zeros((width, width)))
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["s"]
    return found


def moments(df: DataFrame, columns: list[str]) -> Moments:
    """Moments over the rows that have all columns.  Centring keeps the sums accurate.

    The rows are read twice, so they are kept in the shared folder in between.
    """
    return _moments(cut_lineage(df.select(*columns).dropna()), columns)


def _moments(complete: DataFrame, columns: list[str]) -> Moments:
    first = complete.agg(F.count("*").alias("n"), *[
        F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns)
    ]).first()
    n = first["n"]
    if n == 0:
        width = len(columns)
        return Moments(columns, 0, np.zeros(width), np.zeros((width, width)))
    means = [float(first[f"m{i}"]) for i in range(len(columns))]
    rows = cross_products(complete, columns, means).collect()
    return Moments(columns, n, np.array(means), _matrices(rows, len(columns))[0])


@dataclass(frozen=True)
class Fit:
    names: list[str]
    beta: np.ndarray
    covariance: np.ndarray
    n: int

    def rows(self, only: list[str]) -> list[tuple]:
        out = []
        for name in only:
            i = self.names.index(name)
            b, se = float(self.beta[i]), float(np.sqrt(max(self.covariance[i, i], 0.0)))
            out.append((name, b, se, b - 1.96 * se, b + 1.96 * se, self.n))
        return out


    def joint(self, names: list[str]) -> tuple[float, int]:
        """Wald statistic that all named coefficients are zero, and its degrees of freedom."""
        at = [self.names.index(n) for n in names]
        block = self.covariance[np.ix_(at, at)]
        inverse = np.linalg.pinv(block, hermitian=True)
        return float(self.beta[at] @ inverse @ self.beta[at]), int(np.linalg.matrix_rank(block, hermitian=True))


FIT_SCHEMA = "term string, estimate double, std_error double, ci_low double, ci_high double, n long"


def fit_table(df: DataFrame, fit: Fit, only: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(fit.rows(only), FIT_SCHEMA)


def ols(m: Moments, y: str, x: list[str]) -> Fit:
    """Intercept is implied by the centring."""
    xx, xy = m.block(x, x), m.block(x, [y])[:, 0]
    inverse = np.linalg.pinv(xx, hermitian=True)
    beta = inverse @ xy
    residual = float(m.block([y], [y])[0, 0] - beta @ xy)
    freedom = max(m.n - len(x) - 1, 1)
    return Fit(x, beta, inverse * (residual / freedom), m.n)


def linear(names: list[str], beta, means=None) -> Column:
    """Sum of beta_i (x_i - mean_i) as a Spark expression."""
    total = F.lit(0.0)
    for i, name in enumerate(names):
        centre = 0.0 if means is None else float(means[i])
        total = total + F.lit(float(beta[i])) * (F.col(f"`{name}`") - F.lit(centre))
    return total


PERIODS = 53


def two_way_fit(panel: DataFrame, y: str, x: list[str], entity: str, period: Column) -> Fit:
    """Entity and week-of-year fixed effects, errors clustered by entity.

    Week-of-year effects are 52 indicator columns; entity effects are removed by
    subtracting entity means from everything, which is exact and needs no
    iteration.  The panel has one row per entity and week, so a window over an
    entity is as long as the calendar.
    """
    complete = panel.dropna(subset=[entity, y, *x])
    weeks = [f"_w{p}" for p in range(2, PERIODS + 1)]
    full = complete.select(
        entity, *[F.col(c).cast("double").alias(c) for c in [y, *x]],
        *[(period == p).cast("double").alias(f"_w{p}") for p in range(2, PERIODS + 1)],
    )
    own = Window.partitionBy(entity)
    columns = [y, *x, *weeks]
    within = full.select(entity, *[(F.col(c) - F.avg(c).over(own)).alias(c) for c in columns])
    within = cut_lineage(within)
    # Means are zero by now, and the column of ones counts the rows in the same pass.
    wide = [*columns, "_one"]
    summed = cross_products(within.withColumn("_one", F.lit(1.0)), wide, [0.0] * len(wide))
    products = _matrices(summed.collect(), len(wide)).get(0, np.zeros((len(wide), len(wide))))
    m = Moments(columns, int(products[-1, -1]), np.zeros(len(columns)), products[:-1, :-1])
    terms = [*x, *weeks]
    bread = np.linalg.pinv(m.block(terms, terms), hermitian=True)
    beta = bread @ m.block(terms, [y])[:, 0]
    error = F.col(y) - linear(terms, beta)
    scores = within.withColumn("_e", error).groupBy(entity).agg(
        *[F.sum(F.col(c) * F.col("_e")).alias(c) for c in terms]
    )
    # The extra column of ones counts the clusters in the same pass.
    counted = scores.withColumn("_one", F.lit(1.0))
    summed = cross_products(counted, [*terms, "_one"], [0.0] * (len(terms) + 1)).collect()
    width = len(terms) + 1
    whole = _matrices(summed, width).get(0, np.zeros((width, width)))
    meat, clusters = whole[:-1, :-1], whole[-1, -1]
    factor = clusters / max(clusters - 1, 1)
    return Fit(terms, beta, factor * bread @ meat @ bread, m.n)


def two_stage(m: Moments, y: str, d: str, instruments: list[str],
              controls: list[str]) -> dict[str, float]:
    """2SLS of y on d from the moments alone, with OLS, first-stage F and Sargan beside it."""
    z, x = [*instruments, *controls], [d, *controls]
    zz = np.linalg.pinv(m.block(z, z), hermitian=True)
    zx, zy, xx = m.block(z, x), m.block(z, [y])[:, 0], m.block(x, x)
    xy, yy = m.block(x, [y])[:, 0], float(m.block([y], [y])[0, 0])
    projected = zx.T @ zz @ zx
    inverse = np.linalg.pinv(projected, hermitian=True)
    beta = inverse @ (zx.T @ zz @ zy)
    residual = yy - 2 * beta @ xy + beta @ xx @ beta
    freedom = max(m.n - len(x) - 1, 1)
    se = float(np.sqrt(max(inverse[0, 0] * residual / freedom, 0.0)))

    def unexplained(target: str, given: list[str]) -> float:
        own = float(m.block([target], [target])[0, 0])
        if not given:
            return own
        a, b = m.block(given, given), m.block(given, [target])[:, 0]
        return own - float(b @ np.linalg.pinv(a, hermitian=True) @ b)

    wide, narrow = unexplained(d, z), unexplained(d, controls)
    q, rest = len(instruments), max(m.n - len(z) - 1, 1)
    first_stage_f = float((narrow - wide) / q / (wide / rest)) if wide > 0 else float("nan")
    ze = zy - zx @ beta
    sargan = float(ze @ zz @ ze / (residual / m.n)) if residual > 0 else float("nan")
    plain = ols(m, y, x)
    return {
        "iv": float(beta[0]), "iv_se": se, "ols": float(plain.beta[0]),
        "ols_se": float(np.sqrt(max(plain.covariance[0, 0], 0.0))),
        "first_stage_f": first_stage_f, "sargan": sargan, "sargan_df": float(q - 1),
        "n": float(m.n),
    }


def fold_fits(df: DataFrame, fold: str, folds: int, y: str, x: list[str]) -> dict[int, tuple]:
    """Per fold, the OLS of y on x over all other folds: (coefficients, intercept).

    One pass gathers the cross-products of every fold; leaving one out is a
    subtraction of small matrices.
    """
    columns = [y, *x, "_one"]
    complete = df.dropna(subset=[y, *x]).withColumn("_one", F.lit(1.0))
    centre = complete.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns[:-1])])
    first = centre.first()
    shift = [float(first[f"m{i}"] or 0.0) for i in range(len(columns) - 1)] + [0.0]
    rows = cross_products(complete, columns, shift, fold).collect()
    parts = _matrices(rows, len(columns))
    whole = sum(parts.values())
    fits = {}
    for k in range(folds):
        rest = whole - parts.get(k, 0)
        beta = np.linalg.pinv(rest[1:, 1:], hermitian=True) @ rest[1:, 0]
        slopes = beta[:-1]
        intercept = shift[0] + beta[-1] - float(slopes @ np.array(shift[1:-1]))
        fits[k] = (slopes, intercept)
    return fits
