"""Calibration of quantiles from past residuals: windows with an embargo, local scales, shifts and pools.

Windows are elapsed hours before an edge. Pools stand in blocks of time (`windows.windowed`): a row is shuffled twice, however long the
window is, and no pool is written out as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import windows as W

DAY_S = 24 * 3600
#: (target, its pool in order of time) -> a row of the result without the target, or None.
Each = Callable[[pd.DataFrame], tuple | None]


def pool_windows(days: DataFrame, window_days: int, embargo_days: int = 1) -> DataFrame:
    """(target, lo, hi) for days(day): the seconds lo <= s < hi of the day's pool, which ends embargo_days * 24 elapsed hours before the day begins."""
    edge = tg.seconds(tg.day_start(F.col("day"))) - DAY_S * embargo_days
    return days.select(F.col("day").alias("target"), (edge - DAY_S * window_days).alias("lo"), edge.alias("hi"))


def pooled(rows: DataFrame, days: DataFrame, columns: Sequence[str], each: Each, schema: str, window_days: int, embargo_days: int = 1, ts: str = "ts") -> DataFrame:
    """(target, ..) for each day of days(day) what `each` says of its pool of rows(ts, columns)."""
    names = ["target", *(x.split()[0] for x in schema.split(", "))]

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        out = []
        for target, i, j in zip(w["target"], a, b, strict=True):
            if (got := each(r.iloc[i:j])) is not None:
                out.append((target, *got))
        return pd.DataFrame(out, columns=names)

    given = rows.select(tg.seconds(F.col(ts)).alias("at"), *columns)
    return W.windowed(given, pool_windows(days, window_days, embargo_days), DAY_S * window_days, run, f"target date, {schema}")


def pool_quantiles(rows: DataFrame, days: DataFrame, column: str, levels: Sequence[float], least: int, window_days: int, embargo_days: int = 1) -> DataFrame:
    """(target, n, q): quantiles by linear interpolation of pools with at least `least` values that aren't null."""

    def each(r: pd.DataFrame) -> tuple | None:
        x = r[column].to_numpy(float)
        x = x[~np.isnan(x)]
        return (len(x), np.quantile(x, levels).tolist()) if len(x) >= max(1, least) else None

    return pooled(rows, days, [column], each, "n long, q array<double>", window_days, embargo_days)


def pool_gaps(rows: DataFrame, days: DataFrame, column: str, level: float, gaps: dict[str, tuple[int, int]], window_days: int, embargo_days: int = 1) -> DataFrame:
    """(target, gap, n, q): a pool's quantile without the rows from `far` up to `near` hours before its edge, for each gap -> (far, near)."""

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        at, x = r["at"].to_numpy(), r[column].to_numpy(float)
        out = []
        for target, hi, i, j in zip(w["target"], w["hi"], a, b, strict=True):
            for gap, (far, near) in gaps.items():
                c, d = np.searchsorted(at[i:j], [hi - 3600 * far, hi - 3600 * near]) + i
                own = np.concatenate([x[i:c], x[d:j]])
                if len(own):
                    out.append((target, gap, len(own), float(np.quantile(own[~np.isnan(own)], level)) if (~np.isnan(own)).any() else None))
        return pd.DataFrame(out, columns=["target", "gap", "n", "q"])

    given = rows.select(tg.seconds(F.col("ts")).alias("at"), column)
    return W.windowed(given, pool_windows(days, window_days, embargo_days), DAY_S * window_days, run, "target date, gap string, n long, q double")


def rank_of(n: int, level: float) -> int:
    """ceil((n + 1) level), kept in 1 .. n."""
    return min(max(int(np.ceil((n + 1) * level)), 1), n)


def shift(rows: DataFrame, days: DataFrame, score: str, level: float, window_days: int, embargo_days: int = 1) -> DataFrame:
    """(target, n, shift): the ceil((n + 1) level)-th smallest score of each pool that has one."""

    def each(r: pd.DataFrame) -> tuple | None:
        x = r[score].to_numpy(float)
        x = np.sort(x[~np.isnan(x)])
        return (len(x), float(x[rank_of(len(x), level) - 1])) if len(x) else None

    return pooled(rows, days, [score], each, "n long, shift double", window_days, embargo_days)


def local_scale(query: np.ndarray, level: np.ndarray, y: np.ndarray, k: int, floor: float) -> np.ndarray:
    """Sample deviation of y over the k nearest levels of each query, at least floor.

    Nearest neighbours in one dimension are contiguous after a sort. The best window is the first whose far end is no nearer to the query
    than its next start; starts and far ends both rise, so one search finds the windows of all queries, and prefix sums their deviations.
    """
    order = np.argsort(level, kind="stable")
    level, y = level[order], y[order]
    k = min(k, len(level))
    s, ss = np.concatenate([[0], np.cumsum(y)]), np.concatenate([[0], np.cumsum(y * y)])
    a = np.searchsorted(level[:-k] + level[k:], 2 * query, side="left") if k < len(level) else np.zeros(len(query), np.int64)
    total = s[a + k] - s[a]
    return np.maximum(np.sqrt(np.maximum(0.0, (ss[a + k] - ss[a] - total * total / k) / max(1, k - 1))), floor)


def _usable(r: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    level, y = r["level"].to_numpy(float), r["y"].to_numpy(float)
    ok = ~(np.isnan(level) | np.isnan(y))
    return level[ok], y[ok]


def _floor(y: np.ndarray, floor: float, share: float | None) -> float:
    return floor if share is None else share * float(np.std(y, ddof=1))


def sigma(queries: DataFrame, rows: DataFrame, window_days: int, embargo_days: int = 1, *, k: int = 200, floor: float = 1.0, least: int = 48, least_days: int | None = None, periods: int = 24, floor_fraction: float | None = None) -> DataFrame:
    """(target, ts, sigma): local scale for each query row (target, ts, level) from the pool of rows(ts, level, y) of its target.

    Pools with fewer than `least` rows, or, where least_days is given, than that many days of `periods` rows, have none; so a
    quarter-hour pool (periods=96) needs as many days as an hourly one. With floor_fraction the floor is that share of the pool's deviation.
    """
    most = least if least_days is None else least_days * periods

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        out = []
        for i, j in sorted(set(zip(a.tolist(), b.tolist(), strict=True))):
            level, y = _usable(r.iloc[i:j])
            if len(y) < most:
                continue
            q = w[(a == i) & (b == j)]
            out.append(q[["target", "ts"]].assign(sigma=local_scale(q["level"].to_numpy(float), level, y, k, _floor(y, floor, floor_fraction))))
        return pd.concat(out) if out else pd.DataFrame(columns=["target", "ts", "sigma"], dtype=object)

    given = rows.select(tg.seconds(F.col("ts")).alias("at"), "level", "y")
    edge = tg.seconds(tg.day_start(F.col("target"))) - DAY_S * embargo_days
    asked = queries.where("level IS NOT NULL").select("target", "ts", "level", (edge - DAY_S * window_days).alias("lo"), edge.alias("hi"))
    return W.windowed(given, asked, DAY_S * window_days, run, "target date, ts timestamp_ntz, sigma double")


def scaled_conformal(rows: DataFrame, levels: dict[float, str], *, window_days: int = 7, embargo_days: int = 1, every: int = 1, k: int = 200, floor_fraction: float = 0.05, least: int = 72) -> DataFrame:
    """(ts, day, y, level, q, raw, shift, n, sigma, uncalibrated): quantiles shifted by one amount a level times the local scale of each row.

    rows(ts, day, y, and the columns of levels, among them 0.5, the key of the scale). Scores of the pool are residuals over the scale at
    the pool's own rows; days between recomputations use the last one's pool with their own scale. A day whose pool has fewer than
    `least` rows keeps its raw quantiles.
    """
    names = list(levels)
    raw = [F.col(c).cast("double").alias(f"q{i}") for i, c in enumerate(levels.values())]
    own = rows.select("ts", "day", "y", F.col(levels[0.5]).cast("double").alias("level"), *raw)
    edge = tg.seconds(tg.day_start(F.col("target"))) - DAY_S * embargo_days
    served = W.serving(rows.select("day"), every)
    asked = own.where("level IS NOT NULL").join(served, "day").withColumns({"lo": edge - DAY_S * window_days, "hi": edge})

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        out = []
        for i, j in sorted(set(zip(a.tolist(), b.tolist(), strict=True))):
            pool, q = r.iloc[i:j].dropna(subset=["level", "y"]), w[(a == i) & (b == j)]
            got = q[["ts", "day", "y"]].assign(raw=list(q[[f"q{m}" for m in range(len(names))]].to_numpy(float)), n=len(pool), shift=None, sigma=np.nan)
            if len(pool) >= least:
                level, y = _usable(pool)
                low = _floor(y, 0.0, floor_fraction)
                at_pool = local_scale(level, level, y, k, low)
                shifts = []
                for m, alpha in enumerate(names):
                    s = (y - pool[f"q{m}"].to_numpy(float)) / at_pool
                    s = np.sort(s[~np.isnan(s)])
                    shifts.append(float(s[rank_of(len(s), alpha) - 1]) if len(s) else None)
                got = got.assign(sigma=local_scale(q["level"].to_numpy(float), level, y, k, low), shift=[shifts] * len(q))
            out.append(got)
        return pd.concat(out) if out else pd.DataFrame(columns=["ts", "day", "y", "raw", "n", "shift", "sigma"], dtype=object)

    given = own.where("level IS NOT NULL AND y IS NOT NULL").select(tg.seconds(F.col("ts")).alias("at"), "y", "level", *[f"q{i}" for i in range(len(levels))])
    got = W.windowed(given, asked, DAY_S * window_days, run, "ts timestamp_ntz, day date, y double, raw array<double>, n long, shift array<double>, sigma double")
    part = [F.struct(F.lit(a).alias("level"), F.get("raw", F.lit(i)).alias("raw"), F.get("shift", F.lit(i)).alias("shift")) for i, a in enumerate(names)]
    out = got.select("ts", "day", "y", "n", "sigma", F.explode(F.array(*part)).alias("l")).select("ts", "day", "y", "n", F.when(~F.isnan("sigma"), F.col("sigma")).alias("sigma"), "l.*")
    moved = F.col("raw") + F.coalesce(F.col("shift") * F.col("sigma"), F.lit(0.0))
    return out.select("ts", "day", "y", "level", moved.alias("q"), "raw", "shift", "n", "sigma", F.col("shift").isNull().alias("uncalibrated"))


def conformal_days(calibrated: DataFrame) -> DataFrame:
    """(day, level, shift, n, sigma, uncalibrated, crossing_rate): diagnostics of `scaled_conformal` by day; quantiles that cross are told, never sorted."""
    across = calibrated.groupBy("day", "ts").agg(F.array_sort(F.collect_list(F.struct("level", "q")))["q"].alias("q"))
    crossed = across.select("day", (F.col("q") != F.array_sort("q")).cast("int").alias("c")).groupBy("day").agg(F.avg("c").alias("crossing_rate"))
    got = calibrated.groupBy("day", "level").agg(F.first("shift").alias("shift"), F.first("n").alias("n"), F.avg("sigma").alias("sigma"), F.first("uncalibrated").alias("uncalibrated"))
    return got.join(crossed, "day")


def with_today(history: DataFrame, today: DataFrame, keys: Sequence[str] = ("ts",)) -> DataFrame:
    """Stored rows with those of today; where both have a key, today's holds."""
    return today.unionByName(history.join(today.select(*keys), list(keys), "left_anti"))


def window_verdict(losses: DataFrame, short: int, long: int, tolerance: float = 0.02) -> DataFrame:
    """(window_days, days, loss, chosen) of losses(window_days, day, loss) over the days that both windows have: the longer window if the means differ by less than the tolerance, else the lower mean."""
    both = losses.where(F.col("window_days").isin(short, long)).groupBy("day").pivot("window_days", [short, long]).agg(F.first("loss"))
    means = both.dropna().agg(F.count("*").alias("days"), F.avg(str(short)).alias("a"), F.avg(str(long)).alias("b"))
    least = F.least("a", "b")
    apart = F.when(least > 0, F.abs(F.col("b") - F.col("a")) / least).otherwise(0.0)
    best = F.when((apart < tolerance) | (F.col("b") < F.col("a")), long).otherwise(short)
    one = F.explode(F.array(F.struct(F.lit(short).alias("window_days"), F.col("a").alias("loss")), F.struct(F.lit(long).alias("window_days"), F.col("b").alias("loss")))).alias("w")
    return means.select("days", best.alias("_best"), one).select("w.window_days", "days", "w.loss", (F.col("w.window_days") == F.col("_best")).alias("chosen"))
