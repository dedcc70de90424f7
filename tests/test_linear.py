"""Linear forecasters and their tuning against loops over the rows themselves; windows against slices."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import baselines, linear, models, windows

FIRST = dt.date(2024, 2, 20)
ROWS = "day date, y double, a double, b double, c double, flat double, gone double"


def made(days=70, seed=4):
    rng = random.Random(seed)
    out = []
    for d in range(days):
        for _ in range(rng.choice([0, 3, 5, 6])):
            a, b, c = rng.gauss(3, 2), rng.gauss(0, 1), rng.gauss(50, 5)
            y = 20 + 4 * a - 3 * b + 0.1 * c + rng.gauss(0, 2)
            out.append((FIRST + dt.timedelta(d), None if rng.random() < 0.05 else y, None if rng.random() < 0.2 else a, b, None if rng.random() < 0.1 else c, 2.5, None))
    return out


FEATURES = ["a", "b", "c", "flat", "gone"]


def prepared(rows):
    """Imputed and standardised columns of the rows, with medians, means and deviations."""
    x = np.array([[np.nan if v is None else v for v in r[2:]] for r in rows], float)
    med = np.array([np.median(v[~np.isnan(v)]) if (~np.isnan(v)).any() else 0.0 for v in x.T])
    x = np.where(np.isnan(x), med, x)
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd < 1e-9] = 1
    return (x - mean) / sd, med, mean, sd


def descent(x, y, alpha, rounds=4000):
    b = np.zeros(x.shape[1])
    r = y.copy()
    for _ in range(rounds):
        for j in range(x.shape[1]):
            d = x[:, j] @ x[:, j]
            if d > 1e-9:
                r += x[:, j] * b[j]
                g = x[:, j] @ r
                b[j] = math.copysign(max(0.0, abs(g) - len(y) * alpha), g) / d
                r -= x[:, j] * b[j]
    return b


def by_loop(kind, rows, alphas, transform):
    rows = [r for r in rows if r[1] is not None]
    x, med, mean, sd = prepared(rows)
    y = np.array([transform(r[1]) for r in rows])
    yc = y - y.mean()
    if kind == "ols":
        b = np.linalg.lstsq(x, yc, rcond=1e-10)[0]
    elif kind == "ridge":
        found = []
        for a in alphas:
            hat = x @ np.linalg.solve(x.T @ x + a * np.eye(x.shape[1]), x.T)
            left = yc - hat @ yc
            found.append((len(y) * (left @ left) / (len(y) - 1 - np.trace(hat)) ** 2, a))
        a = min(found)[1]
        b = np.linalg.solve(x.T @ x + a * np.eye(x.shape[1]), x.T @ yc)
    else:
        days = sorted({r[0] for r in rows})
        at = np.array([days.index(r[0]) for r in rows])
        total = []
        for a in sorted(alphas, reverse=True):
            errors = []
            for fit, to in linear.splits(len(days), 5):
                i, j = at < fit, (at >= fit) & (at < to)
                m, v = x[i].mean(axis=0), y[i].mean()
                w = descent(x[i] - m, y[i] - v, a, 300)
                errors.append(np.mean((y[j] - v - (x[j] - m) @ w) ** 2))
            total.append((np.mean(errors), -a))
        b = descent(x, yc, -min(total)[1])
    beta = b / sd
    return [y.mean() - beta @ mean, *beta], med


@pytest.mark.parametrize("name", ["identity", "asinh"])
def test_models_equal_loops(spark, name):
    """Nulls in columns and target, a column that doesn't vary, one without a value; penalties chosen."""
    rows, transform = made(), {"identity": float, "asinh": math.asinh}[name]
    df = spark.createDataFrame(rows, ROWS)
    folds = baselines.folds(df.select("day").distinct(), 30).where(F.dayofmonth("fold_day").isin(5, 14, 25))
    models = {"ols": None, "ridge": (0.1, 1.0, 10.0, 100.0), "lasso": (0.01, 0.05, 0.5, 2.0)}
    got = linear.fitted(df, folds, FEATURES, "y", 30, models, transform=name).collect()
    assert {r.kind for r in got} == set(models) and len(got) >= 6
    for r in got:
        inside = [x for x in rows if r.fold_day - dt.timedelta(30) <= x[0] < r.fold_day]
        beta, med = by_loop(r.kind, inside, models[r.kind], transform)
        assert r.n == sum(x[1] is not None for x in inside)
        assert np.allclose(r.med, med) and np.allclose(r.beta, beta, atol=1e-6)


def test_lasso_path_reaches_nothing_and_all():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4))
    y = x @ [3, 0, -2, 0] + rng.normal(size=200)
    s, c = x.T @ x, x.T @ y
    alphas = linear.lasso_alphas(c, 200)
    assert not linear.lasso(s, c, 200, alphas[0] * 1.0001).any()
    assert np.allclose(linear.lasso(s, c, 200, alphas[60]), descent(x, y, alphas[60], 500))


def test_refit_cadence_serves_following_folds(spark):
    df = spark.createDataFrame(made(), ROWS)
    folds = baselines.folds(df.select("day").distinct(), 20)
    got = sorted(linear.fitted(df, folds, ["a"], "y", 20, {"ols": None}, refit_every=4).select("fold_day", "served_by").collect())
    days = [r.fold_day for r in got]
    assert [r.served_by for r in got] == [days[i - i % 4] for i in range(len(days))]
    p = linear.predicted(df, linear.fitted(df, folds, ["a"], "y", 20, {"ols": None}, refit_every=4), ["a"])
    assert p.where("p IS NULL").isEmpty() and {r.day for r in p.select("day").collect()} == set(days)


def test_unknown_names_are_told(spark):
    df = spark.createDataFrame(made(5), ROWS)
    with pytest.raises(ValueError, match="asinh"):
        linear.daily_sums(df, ["a"], "y", "log")
    with pytest.raises(ValueError, match="tree"):
        linear.chosen("tree", np.ones((3, 10)), np.zeros(1), None, 2)


GRID = (linear.Setting(0.05), linear.Setting(0.3), linear.Setting(0.3, 1.0))


def boosted_by_loop(rows, tail, setting, rounds, patience):
    x, med, mean, sd = prepared(rows)
    y = np.array([r[1] for r in rows])
    t = (np.where([[v is None for v in r[2:]] for r in tail], med, [[0 if v is None else v for v in r[2:]] for r in tail]) - mean) / sd
    ty = np.array([r[1] for r in tail])
    b = np.zeros(x.shape[1])
    fit = lambda: float(((ty - y.mean() - t @ b) ** 2).sum())
    best = (fit(), 0, b.copy())
    for k in range(1, rounds + 1):
        r = x.T @ (y - y.mean() - x @ b)
        d = (x * x).sum(axis=0) + setting.penalty * len(y)
        j = int(np.argmax(np.where((x * x).sum(axis=0) > 1e-9, r * r / d, 0)))
        b[j] += setting.rate * r[j] / d[j]
        if fit() < best[0]:
            best = (fit(), k, b.copy())
        elif k - best[1] >= patience:
            break
    beta = best[2] / sd
    return best[1], y.mean() - beta @ mean, beta, med


def test_tuning_equals_a_loop_and_never_looks_ahead(spark):
    rows = made(90)
    whole = [r for r in rows if r[1] is not None]
    outer = [FIRST + dt.timedelta(d) for d in (60, 75)]
    kw = {"train_days": 30, "inner_days": 10, "tail_days": 8, "most_rounds": 40, "patience": 5}
    tuned = lambda rows: {r.day: r for r in linear.tuned(spark.createDataFrame(rows, ROWS), spark.createDataFrame([(d,) for d in outer], "day date"), FEATURES[:4], "y", GRID, **kw).collect()}
    got = tuned(rows)
    for o in outer:
        back = lambda d, n: d - dt.timedelta(n)
        losses = []
        for i, setting in enumerate(GRID):
            each = []
            for d in sorted({r[0] for r in whole if back(o, 10) <= r[0] < o}):
                pick = lambda lo, hi: [r[:6] for r in whole if lo <= r[0] < hi]
                _, b0, beta, med = boosted_by_loop(pick(back(d, 30), back(d, 8)), pick(back(d, 8), d), setting, 40, 5)
                test = pick(d, d + dt.timedelta(1))
                each.append(np.mean([abs(r[1] - b0 - sum(w * (m if v is None else v) for w, m, v in zip(beta, med, r[2:6], strict=True))) / 2 for r in test]))
            losses.append((np.mean(each), i, len(each)))
        loss, setting, folds = min(losses)
        frozen = boosted_by_loop(pick(back(o, 30), back(o, 8)), pick(back(o, 8), o), GRID[setting], 40, 5)[0]
        assert (got[o].setting, got[o].folds, got[o].rounds) == (setting, folds, frozen)
        assert abs(got[o].loss - loss) < 1e-6
    # Rows from an outer day on don't count for it.
    spoilt = [(r[0], 1e6 if r[0] >= outer[0] else r[1], *r[2:]) for r in whole]
    assert tuned(spoilt)[outer[0]] == got[outer[0]] or abs(tuned(spoilt)[outer[0]].loss - got[outer[0]].loss) < 1e-9


def test_windows_are_slices_and_rows_go_twice(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(k, rng.randrange(-500, 500), float(rng.randrange(100))) for k in (1, 2) for _ in range(300)], "k int, at long, v double")
    spans = [(k, i, lo, lo + rng.randrange(1, 61)) for k in (1, 2) for i, lo in enumerate(rng.sample(range(-520, 500), 40))]

    def run(w, r, a, b):
        v = r["v"].to_numpy()
        return w.assign(n=b - a, total=[float(v[i:j].sum()) for i, j in zip(a, b, strict=True)])

    got = windows.windowed(rows, spark.createDataFrame(spans, "k int, i int, lo long, hi long"), 60, run, "k int, i int, n long, total double", by=["k"])
    held = rows.collect()
    want = {(k, i): (sum(r.k == k and lo <= r.at < hi for r in held), sum(r.v for r in held if r.k == k and lo <= r.at < hi)) for k, i, lo, hi in spans}
    assert {(r.k, r.i): (r.n, r.total) for r in got.collect()} == want
    with pytest.raises(Exception, match="longer than 5"):
        windows.windowed(rows, spark.createDataFrame(spans, "k int, i int, lo long, hi long"), 5, run, "k int, i int, n long, total double", by=["k"]).collect()


def test_days_are_numbered_without_one_task(spark):
    days = [FIRST + dt.timedelta(d) for d in (0, 1, 5, 40, 41, 300, 700)]
    df = spark.createDataFrame([(d,) for d in days * 2], "day date")
    assert sorted((r.day, r.i) for r in windows.numbered(df).collect()) == [(d, i) for i, d in enumerate(days)]
    assert sorted((r.day, r.target) for r in windows.serving(df, 3).collect()) == [(d, days[i - i % 3]) for i, d in enumerate(days)]


def test_lines_from_daily_moments_equal_a_loop(spark):
    """Gaps, nulls on either side, far-off values, an x that never varies and a window without pairs."""
    rng, rows = random.Random(6), []
    for d in range(60):
        for _ in range(rng.choice([0, 1, 4, 7])):
            x = 0.1 if d < 14 else None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 2)
            y = None if 30 <= d < 38 or rng.random() < 0.1 else 5e5 - 3 * (x or 0) + rng.gauss(0, 1)
            rows.append((FIRST + dt.timedelta(d), y, x))
    df = spark.createDataFrame(rows, "day date, y double, x double")
    got = {r.fold_day: r for r in models.line_walkforward(df, baselines.folds(df.select("day").distinct(), 6), "x", "y", 6).collect()}
    want = {}
    for f in sorted({r[0] for r in rows}):
        w = [r for r in rows if 1 <= (f - r[0]).days <= 6]
        if w and (f - min(r[0] for r in rows)).days >= 6:
            p = [(x, y) for _, y, x in w if x is not None and y is not None]
            line = np.polyfit(np.array([x for x, _ in p]) - 1e6, [y for _, y in p], 1) if len({x for x, _ in p}) > 1 else None
            want[f] = (len(w), line)
    assert got.keys() == want.keys() and sum(line is None for _, line in want.values()) > 5
    for f, (n, line) in want.items():
        r = got[f]
        assert r.n == n and (line is None) == (r.slope is None) == (r.intercept is None), (f, r, line)
        if line is not None:
            assert r.slope == pytest.approx(line[0], rel=1e-7, abs=1e-7) and r.slope * 1e6 + r.intercept == pytest.approx(line[1], rel=1e-9)
