"""The renewables backtest: fits by vintage against rows, days to come, vintages that a run had seen."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import renewables as R

FIRST = dt.date(2024, 6, 1)
DAYS = 16
VINTAGES = [FIRST + dt.timedelta(4), FIRST + dt.timedelta(11)]


def capacity(vintage, kind, day):
    return 100.0 + 10 * len(kind) + 2 * (day - FIRST).days + (7 if vintage == VINTAGES[1] else 0)


def made(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 5, 31, 22)
    rows = []
    for kind in ("wind", "solar"):
        for i in range(24 * DAYS):
            ts = start + dt.timedelta(hours=i)
            x = rng.gauss(5, 2)
            mw = 30 + 6 * x + rng.gauss(0, 3) if kind == "wind" else max(0.0, 60 * math.sin((i % 24) / 24 * math.pi) + rng.gauss(0, 2))
            rows.append((kind, ts, None if i >= 24 * (DAYS - 1) or rng.random() < 0.03 else mw, None if rng.random() < 0.1 else x, float(i % 24)))
    df = spark.createDataFrame(rows, "kind string, ts timestamp_ntz, mw double, x double, h double").withColumn("day", tg.local_day(F.col("ts")))
    df = df.withColumn("use", (F.col("kind") != "solar") | R.daylight(F.col("ts")))
    anchors = [(v, k, d, capacity(v, k, d)) for v in VINTAGES for k in ("wind", "solar") for d in (FIRST, FIRST + dt.timedelta(2), FIRST + dt.timedelta(4)) if d <= v]
    return df, spark.createDataFrame(anchors, "vintage date, kind string, day date, mw double")


@pytest.fixture(scope="module")
def data(spark):
    df, anchors = made(spark)
    return df, anchors, df.toPandas()


def test_fit_by_vintage_equals_rows(spark, data):
    df, anchors, pdf = data
    caps = R.capacities(anchors, df.select("day").distinct())
    days = [FIRST + dt.timedelta(d) for d in (7, 9, 15)]
    targets = spark.createDataFrame([(k, d, v) for k in ("wind", "solar") for d in days for v in VINTAGES], "kind string, day date, vintage date")
    got = R.fits(df, targets, caps, ["x", "h"], 7, model="ols").collect()
    assert len(got) == 12
    for r in got:
        own = pdf[(pdf.kind == r.kind) & (pdf.day >= r.day - dt.timedelta(7)) & (pdf.day < r.day) & pdf.use & pdf.mw.notna()]
        x = own[["x", "h"]].to_numpy(float)
        med = np.nanmedian(x, axis=0)
        x = np.where(np.isnan(x), med, x)
        y = [m / capacity(r.vintage, r.kind, d) for m, d in zip(own.mw, own.day, strict=True)]
        want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
        assert r.n == len(own) and np.allclose(r.med, med) and np.allclose(r.beta, want, atol=1e-8)


def test_day_to_come_is_predicted_and_never_scored(data):
    df, anchors, _ = data
    caps = R.capacities(anchors.where(F.col("vintage") == F.lit(VINTAGES[1])), df.select("day").distinct())
    targets = df.select("kind", "day").distinct().withColumn("vintage", F.lit(VINTAGES[1]))
    p = R.predictions(df, R.fits(df, targets, caps, ["x"], 7), caps, ["x"])
    last = FIRST + dt.timedelta(DAYS - 1)
    scored = R.evaluable(df, p, R.persistence(df, caps), least=0.8)
    free = R.evaluable(df, p, R.persistence(df, caps), least=0.8, exempt=df.agg(F.max("day").alias("day")))
    assert scored.where(F.col("day") == last).count() == 0
    to_come = free.where(F.col("day") == last)
    assert to_come.count() == 48 and to_come.where("p IS NULL OR factor IS NOT NULL").count() == 0
    both = [{r.kind: {k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in R.scores(x, F.array(F.lit("overall"))).collect()} for x in (scored, free)]
    assert both[0] == both[1] and both[0]["wind"]["verdict"] == "pass"
    assert p.where((F.col("kind") == "solar") & ~R.daylight(F.col("ts")) & (F.col("p_mw") != 0)).count() == 0


def test_refit_cadence_takes_the_last_fit(data):
    df, anchors, _ = data
    caps = R.capacities(anchors, df.select("day").distinct())
    targets = df.select("kind", "day").distinct().withColumn("vintage", F.lit(VINTAGES[1]))
    got = {r.day for r in R.fits(df, targets, caps, ["x"], 7, refit_every=3).select("day").collect()}
    assert got == {FIRST + dt.timedelta(d) for d in (9, 12, 15)}


def test_recompute_uses_what_each_run_saw(data):
    df, anchors, _ = data
    days = df.select("kind", "day").distinct()
    got = {r.day: r for r in R.vintage_parity(R.recomputed(df, days, anchors, ["x"], 3, model="ols")).collect()}
    assert set(got) == {FIRST + dt.timedelta(d) for d in range(3, DAYS)}
    for day, r in got.items():
        seen = [v for v in VINTAGES if v < day - dt.timedelta(1)]
        assert r.vintage == (max(seen) if seen else VINTAGES[0]) and r.before_first == (not seen)
        assert r.n == 48 and r.unmatched == 0 and r.over == (r.most > 0.5)
        assert (r.most == 0) == (r.vintage == VINTAGES[1])
