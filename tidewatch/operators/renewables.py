"""Walk-forward backtest of production types on capacity factors, each day by the capacity vintage that was there.

A factor is MW over the capacity of its day, which depends on the vintage. Sums of products are made once, in MW, for each type and day;
under a vintage they are the same sums divided by that day's capacity. So a fit by another vintage reads no row again, and a recompute of
all past days costs as much as one backtest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import solar
from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import capacity as A
from tidewatch.operators import evaluation as E
from tidewatch.operators import linear as L
from tidewatch.operators import windows as W

#: The point whose sun tells day from night for all of a country's panels.
LATITUDE, LONGITUDE = 51.0, 10.0


def daylight(ts: Column) -> Column:
    """Whether the sun is up at the beginning or the end of the hour."""
    up = [solar.position(t, F.lit(LATITUDE), F.lit(LONGITUDE))[0] > 0 for t in (ts, ts + tg.hours(1))]
    return up[0] | up[1]


def capacities(anchors: DataFrame, days: DataFrame, rule: str = "last", reach_days: int = 60) -> DataFrame:
    """(vintage, kind, day, capacity) of anchors(vintage, kind, day, mw) on each of days(day); no row where a vintage says nothing."""
    keyed = anchors.select(F.struct("vintage", "kind").alias("key"), "day", "mw")
    asked = days.select(F.col("day").alias("on")).distinct().join(keyed.select("key").distinct(), F.lit(True))
    got = A.at(keyed, asked, "key", rule, reach_days).where("mw > 0")
    return got.select("key.vintage", "key.kind", F.col("on").alias("day"), F.col("mw").alias("capacity"))


def labels(rows: DataFrame, caps: DataFrame) -> DataFrame:
    """rows(kind, day, mw, ..) with vintage, capacity and factor: one label table a vintage, without the hours for which it has no capacity."""
    return rows.join(caps, ["kind", "day"]).withColumn("factor", A.capacity_factor(F.col("mw"), F.col("capacity")))


def fits(rows: DataFrame, targets: DataFrame, caps: DataFrame, features: Sequence[str], train_days: int, *, model: str = "ridge", alphas: Sequence[float] | None = None, refit_every: int = 1) -> DataFrame:
    """(kind, day, vintage, n, alpha, med, beta) for each of targets(kind, day, vintage) with a whole window: a model of the factor on the train_days before.

    rows(kind, day, mw, features, use): only rows with `use` and a label train, so a day without labels yet can be predicted and never
    trains. With refit_every a day takes the fit of the last day whose turn it was, by its own vintage.
    """
    given = rows.where("use AND mw IS NOT NULL")
    first = rows.groupBy("kind").agg(F.min("day").alias("_a"))
    served = targets if refit_every == 1 else targets.join(W.serving(targets.select("day"), refit_every), "day").drop("day").withColumnRenamed("target", "day").distinct()
    asked = served.join(first, "kind").where(F.col("day") >= F.date_add("_a", train_days))
    asked = asked.select("kind", "vintage", F.col("day").alias("target"), *W.of_days(F.date_sub("day", train_days), F.date_sub("day", 1)))
    med = W.medians(given.withColumn("at", F.unix_date("day")), asked.select("kind", "target", "lo", "hi").distinct(), train_days, features, by=["kind"])
    sums = L.daily_sums(given, features, "mw", by=["kind"])
    by_vintage = caps.groupBy("kind", F.unix_date("day").alias("at")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("vintage").cast("string"), "capacity"))).alias("caps"))
    a, b = np.triu_indices(2 * len(features) + 2)
    times = (a == a.max()).astype(int) + (b == b.max())

    def run(w: pd.DataFrame, r: pd.DataFrame, lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
        g = np.stack(r["g"].to_list()) if len(r) else np.zeros((0, len(times)))
        caps_ = [dict(x) if x is not None else {} for x in r["caps"]] if len(r) else []
        out = []
        for kind, target, vintage, m, i, j in zip(w["kind"], w["target"], w["vintage"], w["med"], lo, hi, strict=True):
            cap = np.array([c.get(str(vintage), np.nan) for c in caps_[i:j]])
            ok = ~np.isnan(cap)
            if ok.any():
                daily = g[i:j][ok] / cap[ok, None] ** times
                alpha, intercept, beta = L.chosen(model, daily, np.asarray(m, float), alphas, 5)
                out.append((kind, target, vintage, int(daily[:, 0].sum()), alpha, m, [float(intercept), *map(float, beta)]))
        return pd.DataFrame(out, columns=["kind", "target", "vintage", "n", "alpha", "med", "beta"])

    got = W.windowed(sums.join(by_vintage, ["kind", "at"], "left"), asked.join(med, ["kind", "target"]), train_days, run, "kind string, target date, vintage date, n long, alpha double, med array<double>, beta array<double>", by=["kind"])
    return got.withColumnRenamed("target", "day")


def predictions(rows: DataFrame, fitted: DataFrame, caps: DataFrame, features: Sequence[str], dark: str = "solar") -> DataFrame:
    """(kind, ts, day, vintage, factor, p, capacity, mw, p_mw): prediction of each hour by its day's fit; nights of type `dark` are 0, MW never negative."""
    got = rows.join(fitted.select("kind", "day", "vintage", "med", "beta"), ["kind", "day"]).join(caps, ["vintage", "kind", "day"])
    night = (F.col("kind") == dark) & ~daylight(F.col("ts"))
    p = F.when(night, 0.0).otherwise(L.linear(F.col("beta"), F.col("med"), features))
    got = got.withColumns({"factor": A.capacity_factor(F.col("mw"), F.col("capacity")), "p": p})
    return got.select("kind", "ts", "day", "vintage", "factor", "p", "capacity", "mw", A.to_mw(F.col("p"), F.col("capacity")).alias("p_mw"))


def persistence(rows: DataFrame, caps: DataFrame) -> DataFrame:
    """(kind, vintage, ts, base): the factor at the same wall clock of the day before, undefined where a clock change doubles or drops the hour."""
    own = B.wall_clock_keys(labels(rows, caps)).groupBy("kind", "vintage", "day", "hour").agg(F.count("*").alias("n"), F.min("factor").alias("base"), F.min("ts").alias("ts"))
    before = own.select("kind", "vintage", F.date_add("day", 1).alias("day"), "hour", F.when(F.col("n") == 1, F.col("base")).alias("base"))
    return own.where("n = 1").select("kind", "vintage", "day", "hour", "ts").join(before, ["kind", "vintage", "day", "hour"]).where("base IS NOT NULL").select("kind", "vintage", "ts", "base")


def evaluable(rows: DataFrame, predicted: DataFrame, based: DataFrame, least: float = 1.0, exempt: DataFrame | None = None) -> DataFrame:
    """Predicted rows with base, of the (kind, day) that have a share `least` of the day's hours with label and baseline.

    exempt(day): days that may be without labels, as a day to come; their rows are kept whole, with null where nothing is known yet, so
    they are predicted and never scored.
    """
    got = predicted.join(based, ["kind", "vintage", "ts"], "left")
    hours = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 60)
    whole = got.groupBy("kind", "day").agg(F.count_if(F.col("factor").isNotNull() & F.col("base").isNotNull()).alias("_n")).where(F.col("_n") >= F.lit(least) * hours).select("kind", "day", F.lit(True).alias("_whole"))
    got = got.join(whole, ["kind", "day"], "left")
    if exempt is not None:
        got = got.join(exempt.select("day", F.lit(True).alias("_exempt")).distinct(), "day", "left")
    free = F.col("_exempt").isNotNull() if exempt is not None else F.lit(False)
    return got.where(free | F.col("_whole").isNotNull()).drop("_whole", "_exempt")


def scores(rows: DataFrame, labels_of: Column) -> DataFrame:
    """(kind, breakdown, n, .. , verdict): errors of model and persistence in factors and MW on the rows that have both, by the labels of each row; pass if the model's RMSE is lower."""
    y, p, base, cap = (F.col(c) for c in ("factor", "p", "base", "capacity"))
    got = rows.where("factor IS NOT NULL AND base IS NOT NULL").withColumn("breakdown", F.explode(labels_of))
    out = got.groupBy("kind", "breakdown").agg(
        F.count("*").alias("n"), F.count_distinct("day").alias("days"),
        E.rmse(y, p).alias("rmse_cf_model"), E.mae(y, p).alias("mae_cf_model"), E.rmse(y, base).alias("rmse_cf_baseline"), E.mae(y, base).alias("mae_cf_baseline"),
        E.rmse(y * cap, F.col("p_mw")).alias("rmse_mw_model"), E.rmse(y * cap, base * cap).alias("rmse_mw_baseline"),
    )
    return out.withColumn("verdict", F.when(F.col("rmse_cf_model") < F.col("rmse_cf_baseline"), "pass").otherwise("fail"))


def recomputed(rows: DataFrame, targets: DataFrame, anchors: DataFrame, features: Sequence[str], train_days: int, **model) -> DataFrame:
    """(kind, ts, day, vintage, before_first, then_mw, now_mw): each day of targets(kind, day) predicted by the vintage that its run saw and by the newest one.

    before_first: the day is older than any vintage could be for it, so the first one stands in.
    """
    days = rows.select("day").distinct()
    caps = capacities(anchors, days)
    vintages = anchors.select("vintage").distinct()
    ends = vintages.agg(F.min("vintage").alias("_first"), F.max("vintage").alias("_last"))
    seen = A.vintage_for(targets.select("day").distinct(), vintages).join(F.broadcast(ends), F.lit(True))
    seen = seen.withColumn("before_first", F.col("_first") >= F.date_sub("day", 1))
    out = {}
    for name, vintage in (("then", F.col("vintage")), ("now", F.col("_last"))):
        asked = targets.join(seen.select("day", vintage.alias("vintage")), "day").select("kind", "day", "vintage")
        out[name] = predictions(rows, fits(rows, asked, caps, features, train_days, **model), caps, features)
    then = out["then"].select("kind", "ts", "day", "vintage", F.col("p_mw").alias("then_mw")).join(seen.select("day", "before_first"), "day")
    return then.join(out["now"].select("kind", "ts", F.col("p_mw").alias("now_mw")), ["kind", "ts"], "full")


def vintage_parity(rows: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """(day, vintage, before_first, n, unmatched, mean_diff, most, over) of `recomputed` rows."""
    gap = F.abs(F.col("then_mw") - F.col("now_mw"))
    got = rows.groupBy("day", "vintage", "before_first").agg(F.count("*").alias("n"), F.count_if(gap.isNull()).alias("unmatched"), F.avg(gap).alias("mean_diff"), F.max(gap).alias("most"))
    return got.withColumn("over", F.coalesce(F.col("most") > tolerance, F.lit(False)))
