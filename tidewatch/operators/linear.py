"""Linear forecasters with imputation, standardised columns and a transformed target, fitted along walk-forward folds; grid search over inner folds.

Each day's rows become one vector of sums of products over (1, values with 0 for null, missing flags, target). A window's sums are the sum
of its days' vectors, and since an imputed value is x + median * flag, the sums of the imputed, standardised columns follow from them and
the window's medians. So a row is read once, however many folds and settings are fitted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import windows as W

#: What a target is fitted as, and back.
TRANSFORMS = {"identity": (lambda c: c, lambda c: c), "asinh": (F.asinh, F.sinh)}
LASSO_ALPHAS, LASSO_EPS = 100, 1e-3


def daily_sums(rows: DataFrame, features: Sequence[str], target: str, transform: str = "identity", by: Sequence[str] = ()) -> DataFrame:
    """(by, at, g): the upper triangle of each day's sums of products; rows without a target are left out. `at` counts days."""
    if transform not in TRANSFORMS:
        raise ValueError(f"no target transform {transform!r}; there are {sorted(TRANSFORMS)}")
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    z = [F.col(c).isNull().cast("double") for c in features]
    cols = [F.lit(1.0), *x, *z, TRANSFORMS[transform][0](F.col(target).cast("double"))]
    sums = F.array(*[F.sum(a * b) for i, a in enumerate(cols) for b in cols[i:]])
    return rows.where(F.col(target).isNotNull()).groupBy(*by, F.unix_date("day").alias("at")).agg(sums.alias("g"))


class Standard(NamedTuple):
    """Sums of standardised columns: s between them, c with the target less its mean."""

    n: float
    mean: np.ndarray
    scale: np.ndarray
    s: np.ndarray
    c: np.ndarray
    y: float
    yy: float


def imputed(g: np.ndarray, med: np.ndarray) -> np.ndarray:
    """Sums of products over (1, imputed columns, target)."""
    k = len(med)
    full = np.zeros((2 * k + 2, 2 * k + 2))
    full[np.triu_indices(2 * k + 2)] = g
    full += np.triu(full, 1).T
    to = np.zeros((k + 2, 2 * k + 2))
    to[0, 0] = to[-1, -1] = 1
    to[1 : k + 1, 1 : k + 1] = np.eye(k)
    to[1 : k + 1, k + 1 : 2 * k + 1] = np.diag(med)
    return to @ full @ to.T


def standard(m: np.ndarray, scale: np.ndarray | None = None) -> Standard:
    """Columns are centred in their own window and divided by its deviations, or by `scale`; columns that don't vary have sums of 0."""
    n = m[0, 0]
    mean, y = m[0, 1:-1] / n, m[0, -1] / n
    s = m[1:-1, 1:-1] - n * np.outer(mean, mean)
    varies = np.diag(s) > 1e-12 * n * np.maximum(1, mean**2)
    scale = np.sqrt(np.where(varies, np.diag(s) / n, 1)) if scale is None else scale
    c = np.where(varies, (m[1:-1, -1] - n * mean * y) / scale, 0)
    return Standard(n, mean, scale, np.where(np.outer(varies, varies), s / np.outer(scale, scale), 0), c, y, m[-1, -1] - n * y * y)


def lasso(s: np.ndarray, c: np.ndarray, n: float, alpha: float, start: np.ndarray | None = None, *, most: int = 5000, tol: float = 1e-12) -> np.ndarray:
    """Least of |y - xb|^2 / 2n + alpha |b|_1 by coordinate descent on sums."""
    b = np.zeros(len(c)) if start is None else start.copy()
    d = np.diag(s)
    for _ in range(most):
        moved = 0.0
        for j in np.flatnonzero(d > 0):
            r = c[j] - s[j] @ b + d[j] * b[j]
            to = np.sign(r) * max(0.0, abs(r) - n * alpha) / d[j]
            moved = max(moved, abs(to - b[j]))
            b[j] = to
        if moved <= tol * max(1.0, np.abs(b).max(initial=0)):
            break
    return b


def lasso_alphas(c: np.ndarray, n: float) -> np.ndarray:
    """From the least penalty under which nothing is left down to a thousandth of it."""
    top = max(np.abs(c).max(initial=0) / n, np.finfo(float).tiny)
    return np.geomspace(top, top * LASSO_EPS, LASSO_ALPHAS)


def error(m: np.ndarray, intercept: float, beta: np.ndarray) -> float:
    """Sum of squared errors over the rows of m of raw coefficients."""
    v = np.array([-intercept, *(-beta), 1.0])
    return float(v @ m @ v)


def raw(fit: Standard, b: np.ndarray) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) of the columns as they are; the intercept is that of the window of fit."""
    beta = b / fit.scale
    return fit.y - float(beta @ fit.mean), beta


def splits(days: int, n: int) -> list[tuple[int, int]]:
    """(days to fit, days up to the test's end) of n splits in time, each test after its fit."""
    size = days // (n + 1)
    return [(days - (n - i) * size, days - (n - i - 1) * size) for i in range(n)] if size else []


def chosen(kind: str, daily: np.ndarray, med: np.ndarray, alphas: Sequence[float] | None, n_splits: int) -> tuple[float, float, np.ndarray]:
    """(alpha, intercept, beta) of one window from its days' sums. Ridge takes the alpha of the least generalised cross-validation, lasso that of the least error over splits in time."""
    m = imputed(daily.sum(axis=0), med)
    fit = standard(m)
    if kind == "ols":
        return 0.0, *raw(fit, np.linalg.lstsq(fit.s, fit.c, rcond=1e-10)[0])
    if kind == "ridge":
        d, u = np.linalg.eigh(fit.s)
        d, p = np.maximum(d, 0), u.T @ fit.c
        found = []
        for a in alphas or (0.01, 0.1, 1.0, 10.0, 100.0, 1000.0):
            w = p / (d + a)
            left = fit.yy - 2 * w @ p + w @ (d * w)
            found.append((fit.n * left / max(1e-12, fit.n - 1 - (d / (d + a)).sum()) ** 2, a, u @ w))
        _, a, b = min(found, key=lambda x: x[0])
        return a, *raw(fit, b)
    if kind != "lasso":
        raise ValueError(f"no kind {kind!r}")
    grid = np.array(sorted(alphas, reverse=True)) if alphas else lasso_alphas(fit.c, fit.n)
    parts = splits(len(daily), n_splits) if len(grid) > 1 else []
    if parts:
        total = np.zeros(len(grid))
        for a, b in parts:
            part, test = standard(imputed(daily[:a].sum(axis=0), med), fit.scale), imputed(daily[a:b].sum(axis=0), med)
            beta = None
            for i, alpha in enumerate(grid):
                beta = lasso(part.s, part.c, part.n, alpha, beta, tol=1e-9)
                total[i] += error(test, *raw(part, beta)) / test[0, 0]
        grid = grid[: int(np.argmin(total)) + 1]
    beta = None
    for alpha in grid:
        beta = lasso(fit.s, fit.c, fit.n, alpha, beta)
    return float(grid[-1]), *raw(fit, beta)


def _windows(folds: DataFrame) -> DataFrame:
    return folds.select(F.col("fold_day").alias("target"), *W.of_days(F.col("train_from"), F.col("train_to")))


def fitted(rows: DataFrame, folds: DataFrame, features: Sequence[str], target: str, most_days: int, models: Mapping[str, Sequence[float] | None], *, transform: str = "identity", refit_every: int = 1, n_splits: int = 5) -> DataFrame:
    """(fold_day, served_by, kind, n, alpha, med, beta): a fit every refit_every-th fold serves the folds up to the next.

    rows(day, features, target); windows are most_days long at most; models: kind (ols, ridge, lasso) -> penalties to choose from. Nulls of a feature are the window's median, columns are
    standardised in the window, beta (intercept first) is that of imputed columns in their own units and of the transformed target.
    """
    served = W.serving(folds.select(F.col("fold_day").alias("day")), refit_every)
    first = folds.join(served.select(F.col("target").alias("fold_day")).distinct(), "fold_day", "left_semi")
    given = rows.where(F.col(target).isNotNull())
    asked = _windows(first)
    med = W.medians(given.withColumn("at", F.unix_date("day")), asked, most_days, features)

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        g = np.stack(r["g"].to_list()) if len(r) else np.zeros((0, 1))
        out = []
        for target_, m, i, j in zip(w["target"], w["med"], a, b, strict=True):
            for kind, alphas in models.items() if i < j else ():
                alpha, intercept, beta = chosen(kind, g[i:j], np.asarray(m, float), alphas, n_splits)
                out.append((target_, kind, int(g[i:j, 0].sum()), alpha, m, [float(intercept), *map(float, beta)]))
        return pd.DataFrame(out, columns=["target", "kind", "n", "alpha", "med", "beta"])

    fits = W.windowed(daily_sums(given, features, target, transform), asked.join(med, "target"), most_days, run, "target date, kind string, n long, alpha double, med array<double>, beta array<double>")
    return served.join(fits, "target").select(F.col("day").alias("fold_day"), F.col("target").alias("served_by"), "kind", "n", "alpha", "med", "beta")


def linear(beta: Column, med: Column, features: Sequence[str]) -> Column:
    p = F.get(beta, F.lit(0))
    for i, c in enumerate(features):
        p = p + F.get(beta, F.lit(i + 1)) * F.coalesce(F.col(c).cast("double"), F.get(med, F.lit(i)))
    return p


def predicted(rows: DataFrame, fits: DataFrame, features: Sequence[str], transform: str = "identity") -> DataFrame:
    """rows with kind and p by the fits that serve their day; days without one are left out."""
    got = rows.join(fits.select(F.col("fold_day").alias("day"), "kind", "med", "beta"), "day")
    return got.withColumn("p", TRANSFORMS[transform][1](linear(F.col("beta"), F.col("med"), features))).drop("med", "beta")


class Setting(NamedTuple):
    """One point of the grid: step of a round, and the penalty on it as a share of the rows."""

    rate: float
    penalty: float = 0.0


def boosted(fit: Standard, setting: Setting, tail: np.ndarray, most: int, patience: int) -> tuple[int, float, np.ndarray]:
    """(rounds, intercept, beta): each round steps along the column that explains most; the round of the least error on the tail counts, looked for until `patience` rounds bring none lower."""
    b = np.zeros(len(fit.c))
    d = np.diag(fit.s) + setting.penalty * fit.n
    best = (error(tail, *raw(fit, b)), 0, b.copy())
    for k in range(1, most + 1):
        r = fit.c - fit.s @ b
        gain = np.where(np.diag(fit.s) > 0, r * r / d, 0.0)
        j = int(np.argmax(gain))
        if gain[j] <= 0:
            break
        b[j] += setting.rate * r[j] / d[j]
        now = error(tail, *raw(fit, b))
        if now < best[0]:
            best = (now, k, b.copy())
        elif k - best[1] >= patience:
            break
    return best[1], *raw(fit, best[2])


def tuned(rows: DataFrame, outer: DataFrame, features: Sequence[str], target: str, grid: Sequence[Setting], *, train_days: int, inner_days: int, tail_days: int, most_rounds: int = 200, patience: int = 20, level: float = 0.5) -> DataFrame:
    """(day, setting, loss, folds, rounds) for each day of outer(day): the place in grid of the setting with the least mean pinball loss over the inner folds, and the rounds it is frozen to.

    Inner folds are the inner_days days before an outer day; each is fitted on the train_days before it, the last tail_days of them held
    back for stopping. A day's fits are the same for all outer days that look back on it, so they are made once, for all settings; its
    rows are scored once, with one array of losses. The rounds are those of the fit on all days before the outer day.
    """
    # Every day that a fold may test, and the outer days themselves, for the rounds.
    every = rows.select("day").unionByName(outer.select("day")).distinct()
    first = rows.agg(F.min("day").alias("_a"))
    folds = every.join(F.broadcast(first), F.col("day") >= F.date_add("_a", train_days))
    asked = folds.select(F.col("day").alias("target"), *W.of_days(F.date_sub("day", train_days), F.date_sub("day", 1)))
    given = rows.where(F.col(target).isNotNull())
    inside = asked.withColumn("hi", F.col("hi") - tail_days)
    med = W.medians(given.withColumn("at", F.unix_date("day")), inside, train_days, features)

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        g, at = (np.stack(r["g"].to_list()), r["at"].to_numpy()) if len(r) else (np.zeros((0, 1)), np.zeros(0))
        out = []
        for target_, hi, m, i, j in zip(w["target"], w["hi"], w["med"], a, b, strict=True):
            cut = int(np.searchsorted(at, hi - tail_days))
            if not i < cut < j:
                continue
            m = np.asarray(m, float)
            fit, tail = standard(imputed(g[i:cut].sum(axis=0), m)), imputed(g[cut:j].sum(axis=0), m)
            fits = [boosted(fit, x, tail, most_rounds, patience) for x in grid]
            out.append((target_, m.tolist(), [[float(x[1]), *map(float, x[2])] for x in fits], [x[0] for x in fits]))
        return pd.DataFrame(out, columns=["target", "med", "betas", "rounds"])

    fits = W.windowed(daily_sums(given, features, target), asked.join(med, "target"), train_days, run, "target date, med array<double>, betas array<array<double>>, rounds array<int>")
    gap = lambda b: F.col(target) - linear(b, F.col("med"), features)
    loss = F.transform("betas", lambda b: F.greatest(level * gap(b), (level - 1) * gap(b)))
    scored = given.join(fits.select(F.col("target").alias("day"), "med", "betas"), "day").select("day", loss.alias("loss"))
    daily = scored.groupBy(F.unix_date("day").alias("at")).agg(F.array(*[F.avg(F.get("loss", F.lit(i))) for i in range(len(grid))]).alias("loss"))
    looked = outer.select(F.col("day").alias("target"), *W.of_days(F.date_sub("day", inner_days), F.date_sub("day", 1)))

    def mean(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        x = np.stack(r["loss"].to_list()) if len(r) else np.zeros((0, 1))
        out = [(t, int(j - i), x[i:j].mean(axis=0).tolist()) for t, i, j in zip(w["target"], a, b, strict=True) if i < j]
        return pd.DataFrame(out, columns=["target", "folds", "losses"])

    means = W.windowed(daily, looked, inner_days, mean, "target date, folds int, losses array<double>")
    each = means.select("target", "folds", F.posexplode("losses").alias("setting", "loss"))
    best = each.groupBy("target").agg(F.min(F.struct("loss", "setting")).alias("b"), F.first("folds").alias("folds"))
    got = best.join(fits.select("target", "rounds"), "target", "left")
    return got.select(F.col("target").alias("day"), "b.setting", "b.loss", "folds", F.get("rounds", F.col("b.setting")).alias("rounds"))
