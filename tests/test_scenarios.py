"""Gaps, outages, reconstructions and second series on clock-change days and small tables."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import linear as L
from tidewatch.operators import scenarios as X

D = dt.date


def hours(spark, first, n, f):
    rows = [(first + dt.timedelta(hours=i), *f(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y double, a double, b double, c double")
    return df.withColumn("day", tg.local_day(F.col("ts")))


@pytest.mark.parametrize(("start", "n"), [(dt.datetime(2025, 3, 29, 23), 23), (dt.datetime(2025, 10, 25, 22), 25)])
def test_gap_is_the_end_of_the_day(spark, start, n):
    df = hours(spark, start, n, lambda i: (1.0, float(i), 10.0 + i, None if i == 5 else 3.0))
    got = X.blanked(df, [X.Gap("x", ("a", "c"), 4), X.Gap("all", ("b",), 25)], ["a", "b", "c"])
    x = sorted(got.where("scenario = 'x'").collect(), key=lambda r: r.ts)
    assert [r.a is None for r in x] == [i >= n - 4 for i in range(n)] and all(r.b is not None for r in x)
    assert got.where("scenario = 'all' AND b IS NOT NULL").isEmpty()
    filled = sorted(X.carried(got, ["a", "c"]).where("scenario = 'x'").collect(), key=lambda r: r.ts)
    assert [r.a for r in filled[-4:]] == [n - 5.0] * 4 and filled[5].c == 3.0


def test_arms_meet_where_nothing_is_missing(spark):
    rng = random.Random(3)
    df = hours(spark, dt.datetime(2024, 6, 1, 22), 24 * 10, lambda i: (rng.gauss(50, 5), rng.gauss(5, 1), rng.gauss(2, 1), 0.0))
    fits = L.fitted(df, B.folds(df.select("day").distinct(), 5), ["a", "b"], "y", 5, {"ols": None})
    q = df.select("ts", "y", F.explode(F.array(*map(F.lit, range(4)))).alias("k")).select((F.col("ts") + F.make_interval(mins=F.col("k") * 15)).cast("timestamp_ntz").alias("ts"), (F.col("y") + F.col("k")).alias("y"))
    base = q.select((F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("ts"), F.col("y").alias("base"))
    none = B.shape_profile(q.withColumnRenamed("y", "price"), "price").where("false")
    got = X.gap_arms(df, fits, ["a", "b"], [X.Gap("g", ("a",), 2)], q, base, none).collect()
    at = {(r.ts, r.arm): r for r in got}
    assert len(at) == len(got) and len({r.ts for r in got}) * 3 == len(got)
    for (ts, arm), r in at.items():
        late = (ts + dt.timedelta(hours=2)).hour >= 22
        if arm == "partial":
            assert r.p == (at[ts, "silence"].p if late else pytest.approx(at[ts, "fill"].p))


def test_outage_moves_the_ladder(spark):
    df = hours(spark, dt.datetime(2024, 6, 1, 22), 48, lambda i: (1.0, 1.0, 2.0, 3.0))
    policies = spark.createDataFrame([("full", "f", "a", "fill", 3), ("full", "g", "b", "strict", 0), ("less", "g", "b", "strict", 0)], "candidate string, group string, column string, policy string, limit int")
    ranks = spark.createDataFrame([("full", 1), ("less", 2)], "candidate string, rank int")
    gaps = [X.Gap("ok", (), 0), X.Gap("short", ("a",), 3), X.Gap("long", ("a",), 4), X.Gap("dead", ("b",), 1)]
    got = {(r.scenario, r.day): r for r in X.outages(df, gaps, policies, ranks, ["a", "b"]).collect()}
    assert {k[0]: r.candidate for k, r in got.items()} == {"ok": "full", "short": "full", "long": "less", "dead": None}
    assert len(got) == 8 and got["long", D(2024, 6, 2)].reasons == "full:f"


def test_reconstructions_follow_position_and_clock(spark):
    start = dt.datetime(2025, 10, 12, 22)  # local midnight of 13 October; 26 October has 25 hours
    df = hours(spark, start, 24 * 13 + 25 + 24 * 3, lambda i: (0.0, float(i), 1000.0 + i, 0.0))
    days = spark.createDataFrame([(D(2025, 10, 26),), (D(2025, 10, 28),)], "day date")
    got = {}
    for r in X.reconstructions(df.select("ts", F.col("a").alias("forecast"), F.col("b").alias("actual")), days).orderBy("ts").collect():
        got.setdefault((r.variant, r.day), []).append(r.value)
    sunday = [24.0 * 6 + i for i in range(24)]  # a week before, 24 hours: the last one is repeated
    assert got["A", D(2025, 10, 26)] == [*sunday, sunday[-1]] == got["C", D(2025, 10, 26)]
    assert got["D", D(2025, 10, 26)] == [1000 + x for x in [*sunday, sunday[-1]]]
    assert got["FINAL", D(2025, 10, 26)] == [*sunday[:3], sunday[2], *sunday[3:]]  # the doubled hour by the clock
    tuesday = D(2025, 10, 28)
    assert got["A", tuesday] == [24.0 * 13 + 25 + i for i in range(24)] and got["C", tuesday] == [24.0 * 8 + i for i in range(24)]
    moved = {(r.variant, r["column"]): r.moved for r in X.moved_columns(df, X.counterfactual(df, df.select(F.lit("same").alias("variant"), "ts", F.col("a").alias("value")), "a"), ["a", "b"]).collect()}
    assert moved == {("same", "a"): 0, ("same", "b"): 0}


def test_second_series_arms(spark):
    """A second series that is the first less ten: patched errs, shifted doesn't, and fitting on it is as good."""
    rng = random.Random(1)

    def f(i):
        a = rng.gauss(40, 6)
        return 3 + 2 * a, a, a - 10, 0.0

    df = hours(spark, dt.datetime(2024, 6, 1, 22), 24 * 12, f)
    got = X.second_series_arms(df, B.folds(df.select("day").distinct(), 6), "a", "b", [], "y", 6).groupBy("arm").agg(F.avg("mae").alias("mae")).collect()
    mae = {r.arm: r.mae for r in got}
    assert set(mae) == {"own", "second", "patched", "shifted", "gapped"}
    assert np.isclose(mae["patched"], 20) and all(mae[k] < 1e-6 for k in ("own", "second", "shifted", "gapped"))
