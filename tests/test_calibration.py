"""Pools, scales and lag products against loops over the rows."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import calibration as K
from tidewatch.operators import evaluation as E

START = dt.datetime(2024, 3, 20, 23)  # local midnight; the clock changes on 31 March


def made(spark, days=20, step=60, seed=1):
    rng = np.random.default_rng(seed)
    n = days * 24 * 60 // step
    ts = [START + dt.timedelta(minutes=step * i) for i in range(n)]
    r = [None if rng.random() < 0.1 else float(x) for x in rng.normal(0, 10, n)]
    level = rng.normal(50, 9, n).tolist()
    rows = [(t, a, b, None if a is None else a + b) for t, a, b in zip(ts, r, level, strict=True) if rng.random() > 0.05]
    return rows, spark.createDataFrame(rows, "ts timestamp_ntz, r double, level double, y double")


def edge_of(day, embargo=1):
    return dt.datetime(day.year, day.month, day.day) - dt.timedelta(hours=2 if day >= dt.date(2024, 4, 1) else 1) - dt.timedelta(hours=24 * embargo)


DAYS = [dt.date(2024, 3, 22) + dt.timedelta(d) for d in range(18)]


@pytest.mark.parametrize(("window", "embargo"), [(3, 1), (7, 0), (15, 2)])
def test_pools_are_elapsed_hours_before_an_edge(spark, window, embargo):
    rows, df = made(spark)
    days = spark.createDataFrame([(d,) for d in DAYS], "day date")
    got = {r.target: r for r in K.pool_quantiles(df, days, "r", (0.1, 0.5), 20, window, embargo).collect()}
    shifts = {r.target: r for r in K.shift(df, days, "r", 0.9, window, embargo).collect()}
    gaps = {(r.target, r.gap): r for r in K.pool_gaps(df, days, "r", 0.5, {"none": (0, 0), "mid": (40, 20)}, window, embargo).collect()}
    for d in DAYS:
        e = edge_of(d, embargo)
        inside = [r for r in rows if e - dt.timedelta(hours=24 * window) <= r[0] < e]
        x = np.array([r[1] for r in inside if r[1] is not None])
        assert (d in got) == (len(x) >= 20) and (d in shifts) == bool(len(x))
        if d in got:
            assert got[d].n == len(x) and np.allclose(got[d].q, np.quantile(x, (0.1, 0.5)))
        if len(x):
            assert shifts[d].shift == sorted(x)[min(max(int(np.ceil((len(x) + 1) * 0.9)), 1), len(x)) - 1]
        left = [r for r in inside if not e - dt.timedelta(hours=40) <= r[0] < e - dt.timedelta(hours=20)]
        if inside:
            assert gaps[d, "none"].n == len(inside)
        if left:
            assert gaps[d, "mid"].n == len(left) and np.isclose(gaps[d, "mid"].q, np.quantile([r[1] for r in left if r[1] is not None], 0.5))


@pytest.mark.parametrize(("step", "periods"), [(60, 24), (15, 96)])
def test_scale_needs_days_whatever_the_resolution(spark, step, periods):
    rows, df = made(spark, days=8, step=step)
    days = DAYS[:8]
    asked = [(d, dt.datetime(d.year, d.month, d.day, 5, step % 60), float(40 + 3 * i)) for i, d in enumerate(days)]
    got = {r.target: r.sigma for r in K.sigma(spark.createDataFrame(asked, "target date, ts timestamp_ntz, level double"), df, 4, k=30, least_days=2, periods=periods, floor_fraction=0.02).collect()}
    found = 0
    for d, _, q in asked:
        e = edge_of(d)
        pool = [r for r in rows if e - dt.timedelta(hours=96) <= r[0] < e and r[3] is not None]
        assert (d in got) == (len(pool) >= 2 * periods)
        if d in got:
            near = sorted(pool, key=lambda r: abs(r[2] - q))[:30]  # noqa: B023
            assert np.isclose(got[d], max(np.std([r[3] for r in near], ddof=1), 0.02 * np.std([r[3] for r in pool], ddof=1)))
            found += 1
    assert 3 <= found < len(days)


def test_scale_of_many_queries_is_that_of_each():
    rng = np.random.default_rng(8)
    level, y = rng.integers(0, 40, 300).astype(float), rng.normal(0, 5, 300)
    query = rng.uniform(-5, 45, 200)
    for k in (1, 7, 299, 300, 500):
        want = []
        for q in query:
            gap = np.sort(np.abs(level - q))
            near = np.abs(level - q) < gap[min(k, 300) - 1] if min(k, 300) < 300 else np.ones(300, bool)
            want.append((near, q))
        got = K.local_scale(query, level, y, k, 0.5)
        if k >= 300:
            assert np.allclose(got, max(0.5, y.std(ddof=1)))
        assert (got >= 0.5).all() and len(got) == len(query)
    distinct = rng.permutation(300).astype(float)
    for k in (2, 7, 50):
        want = [max(0.5, np.std(y[np.argsort(np.abs(distinct - q))[:k]], ddof=1)) for q in query]
        assert np.allclose(K.local_scale(query, distinct, y, k, 0.5), want)


@pytest.mark.parametrize(("lag", "block"), [(0, 50), (5, 50), (60, 50), (24, 16_384)])
def test_lag_products_by_block(spark, monkeypatch, lag, block):
    """Positions with gaps, over block borders, against a double loop."""
    monkeypatch.setattr(E, "LAG_BLOCK", block)
    rng = np.random.default_rng(lag)
    at = np.array([i for i in range(-70, 260) if rng.random() > 0.1])
    d = dict(zip(at.tolist(), (100 + rng.normal(0, 3, len(at))).tolist(), strict=True))
    got = E.long_run_variance(spark.createDataFrame(list(d.items()), "i long, d double"), "d", "i", lag).first()
    mean = np.mean(list(d.values()))
    gamma = [sum((x - mean) * (d[i + k] - mean) for i, x in d.items() if i + k in d) / len(d) for k in range(lag + 1)]
    want = sum((1 if k == 0 else 2 * (1 - k / (lag + 1))) * g for k, g in enumerate(gamma))
    assert got.n == len(d) and np.isclose(got["mean"], mean) and np.isclose(got.lrv, want)


def test_lag_products_copy_halos_only(spark):
    rows = spark.range(100_000).select(F.col("id").alias("i"), F.sin("id").alias("d"))
    plan = E.long_run_variance(rows, "d", "i", 192)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert E.long_run_variance(rows, "d", "i", 192).first().n == 100_000
    assert E.long_run_variance(rows.limit(0), "d", "i", 3).collect() == []
