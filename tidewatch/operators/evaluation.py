"""Scores of point and quantile forecasts. A metric skips its own null pairs; n is the size of the raw slice."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pair(y: Column, p: Column, x: Column) -> Column:
    return F.when(y.isNotNull() & p.isNotNull(), x)


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def wape(y: Column, p: Column) -> Column:
    """Null if the values add up to nothing."""
    return F.try_divide(F.sum(F.abs(y - p)), F.sum(_pair(y, p, F.abs(y))))


def pinball(y: Column, q: Column, level: Column | float) -> Column:
    """Loss of one row."""
    e = y - q
    return F.when(e.isNotNull(), F.greatest(level * e, (level - 1) * e))


def point_scores(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """(by, n, mae, rmse, wape)."""
    a, b = F.col(y), F.col(p)
    return df.groupBy(*by).agg(F.count("*").alias("n"), mae(a, b).alias("mae"), rmse(a, b).alias("rmse"), wape(a, b).alias("wape"))


def summary(df: DataFrame, day: str = "day", by: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """Overall scores, and mean, deviation and quantiles of the daily MAE."""
    a, b = F.col(y), F.col(p)
    e = a - b
    daily = df.groupBy(*by, day).agg(F.count("*").alias("n"), F.count(e).alias("m"), F.sum(F.abs(e)).alias("s"), F.sum(e * e).alias("ss"), F.sum(_pair(a, b, F.abs(a))).alias("sy"), mae(a, b).alias("day_mae"))
    q = F.percentile("day_mae", F.array(*map(F.lit, (0.05, 0.5, 0.95))))
    out = daily.groupBy(*by).agg(
        F.sum("n").alias("n"), F.try_divide(F.sum("s"), F.sum("m")).alias("mae"), F.sqrt(F.try_divide(F.sum("ss"), F.sum("m"))).alias("rmse"), F.try_divide(F.sum("s"), F.sum("sy")).alias("wape"),
        F.avg("day_mae").alias("daily_mean"), F.stddev_samp("day_mae").alias("daily_std"), q.alias("_q"),
    )
    return out.select(*by, "n", "mae", "rmse", "wape", "daily_mean", "daily_std", *[F.get("_q", F.lit(i)).alias(f"daily_{x}") for i, x in enumerate(("p05", "p50", "p95"))])


def quantile_scores(long: DataFrame, by: Sequence[str] = (), y: str = "y", q: str = "q", level: str = "level") -> DataFrame:
    """(by, level, n, pinball, coverage) of long rows (y, level, q)."""
    return long.groupBy(*by, level).agg(F.count("*").alias("n"), F.avg(pinball(F.col(y), F.col(q), F.col(level))).alias("pinball"), F.avg((F.col(y) <= F.col(q)).cast("int")).alias("coverage"))


def weighted_interval_score(long: DataFrame, by: Sequence[str] = (), y: str = "y", q: str = "q", level: str = "level") -> DataFrame:
    """(by, wis): the mean over levels of twice the pinball loss."""
    return quantile_scores(long, by, y, q, level).groupBy(*by).agg(F.avg(2 * F.col("pinball")).alias("wis"))


def band_scores(df: DataFrame, bands: Sequence[tuple[str, str, str]], by: Sequence[str] = (), y: str = "y") -> DataFrame:
    """(by, band, coverage, width) for (name, lower, upper)."""
    one = F.explode(F.array(*[F.struct(F.lit(n).alias("band"), F.col(a).alias("lo"), F.col(b).alias("hi")) for n, a, b in bands])).alias("b")
    rows = df.select(*by, F.col(y).alias("_y"), one).select(*by, "_y", "b.*")
    return rows.groupBy(*by, "band").agg(F.avg(F.col("_y").between(F.col("lo"), F.col("hi")).cast("int")).alias("coverage"), F.avg(F.when(F.col("_y").isNotNull(), F.col("hi") - F.col("lo"))).alias("width"))


def crossing_rates(df: DataFrame, low: str, mid: str, high: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, crossing, low_mid, mid_high): shares of rows whose quantiles cross."""
    a, b, c = F.col(low), F.col(mid), F.col(high)
    rate = lambda x: F.avg(F.when(a.isNotNull() & b.isNotNull() & c.isNotNull(), x.cast("int")))
    return df.groupBy(*by).agg(rate((a > b) | (b > c)).alias("crossing"), rate(a > b).alias("low_mid"), rate(b > c).alias("mid_high"))


def with_labels(df: DataFrame, flags: Sequence[str], macro: str | None = None) -> DataFrame:
    """df once for each label that holds of a row: overall, its macro regime, its flags."""
    names = [F.lit("overall")] + ([F.concat(F.lit("macro:"), F.col(macro))] if macro else []) + [F.when(F.col(f), F.lit(f)) for f in flags]
    return df.withColumn("label", F.explode(F.array_compact(F.array(*names))))


def rearrange(df: DataFrame, quantiles: Sequence[str]) -> DataFrame:
    """Values sorted across the levels of each row; rows with a null stay."""
    whole = F.lit(True)
    for c in quantiles:
        whole = whole & F.col(c).isNotNull()
    rows = df.withColumn("_q", F.array_sort(F.array(*quantiles)))
    return rows.withColumns({c: F.when(whole, F.get("_q", F.lit(i))).otherwise(F.col(c)) for i, c in enumerate(quantiles)}).drop("_q")


def daily_loss(df: DataFrame, loss: Column, day: str, expected: int = 24) -> DataFrame:
    """(day, loss, n, incomplete)."""
    return df.groupBy(day).agg(F.avg(loss).alias("loss"), F.count(loss).alias("n")).withColumn("incomplete", F.col("n") < expected)


#: Positions that one block of lag products holds.
LAG_BLOCK = 16_384


def long_run_variance(df: DataFrame, d: str, order: str, lag: int) -> DataFrame:
    """(n, mean, lrv): Newey-West variance with Bartlett weights.

    Positions are the whole numbers in `order`; a pair counts where both of its positions are there. They stand in blocks; the `lag`
    first positions of a block also go to the block before, as its halo. A block gives, for each lag, the sum of products and of values
    of its pairs and their number; the mean is taken out of these sums at the end, so nothing but short vectors is added up.
    """
    size = max(LAG_BLOCK, lag)
    i = F.col(order).cast("long")
    block = F.floor(i / size)
    halo = F.when(i - block * size < lag, F.array(block, block - 1)).otherwise(F.array(block))
    dealt = df.select(i.alias("i"), F.col(d).cast("double").alias("d"), F.explode(halo).alias("_block"))

    def products(part: pd.DataFrame) -> pd.DataFrame:
        first = int(part["_block"].iloc[0]) * size
        x, there = np.zeros(size + lag), np.zeros(size + lag)
        spot = part["i"].to_numpy() - first
        x[spot], there[spot] = part["d"].to_numpy(float), 1.0
        own, held = x[:size], there[:size]
        rows = [(k, float(own @ x[k : k + size]), float(own @ there[k : k + size] + held @ x[k : k + size]), int(held @ there[k : k + size])) for k in range(lag + 1)]
        return pd.DataFrame(rows, columns=["k", "p", "s", "m"])

    parts = dealt.groupBy("_block").applyInPandas(products, "k int, p double, s double, m long")
    sums = parts.groupBy("k").agg(F.sum("p").alias("p"), F.sum("s").alias("s"), F.sum("m").alias("m"))
    all_ = sums.groupBy().agg(F.sort_array(F.collect_list(F.struct("k", "p", "s", "m"))).alias("g"))
    zero = F.get("g", F.lit(0))  # the pairs of each position with itself
    told = all_.select("g", zero["m"].alias("n"), (zero["s"] / 2 / zero["m"]).alias("mean"))
    gamma = lambda x: (x["p"] - F.col("mean") * x["s"] + x["m"] * F.col("mean") * F.col("mean")) / F.col("n")
    weight = lambda x: F.when(x["k"] == 0, 1.0).otherwise(2 * (1 - x["k"] / F.lit(float(lag + 1))))
    return told.where("n > 0").select("n", "mean", F.aggregate("g", F.lit(0.0), lambda total, x: total + weight(x) * gamma(x)).alias("lrv"))


def diebold_mariano(df: DataFrame, d: str, order: str, lag: int, horizon: int) -> DataFrame:
    """(n, mean, lrv, dm): the statistic with the small-sample factor (J14). `two_sided_p` gives its p-value."""
    n, h = F.col("n"), F.lit(float(horizon))
    factor = F.sqrt((n + 1 - 2 * h + h * (h - 1) / n) / n)
    return long_run_variance(df, d, order, lag).withColumn("dm", F.try_divide(F.col("mean"), F.sqrt(F.col("lrv") / n)) * factor)


def two_sided_p(t: float, degrees: int) -> float:
    """Two-sided tail of Student's t, by the continued fraction of the incomplete beta function."""
    x, a, b = degrees / (degrees + t * t), degrees / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0

    def fraction(x: float, a: float, b: float) -> float:
        c, d, out = 1.0, 1 / max(1e-300, 1 - (a + b) * x / (a + 1)), 0.0
        out = d
        for m in range(1, 500):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + num * d), 1 + num / c
                out *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return out

    if x >= 1:
        return 1.0
    return front * fraction(x, a, b) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(1 - x, b, a) / b


def agreement(both: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, exact, median, p95, most, correlation) of two sources."""
    gap = F.abs(F.col(a) - F.col(b))
    return both.where(gap.isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg((gap < 1e-9).cast("int")).alias("exact"), F.percentile(gap, 0.5).alias("median"), F.percentile(gap, 0.95).alias("p95"), F.max(gap).alias("most"), F.corr(a, b).alias("correlation"))


def regimes(df: DataFrame, *, low_share: float = 0.2, high_wind: float = 0.5, spike: float = 0.95) -> DataFrame:
    """Flags of each hour: scarcity, high wind, negative price, spike over the macro regime's quantile, and none of them (J11). Nulls flag nothing.

    The quantile per regime is an aggregate joined back, so no regime is held by one task.
    """
    share = F.try_divide(F.col("wind_on") + F.col("wind_off") + F.col("solar"), F.col("load"))
    wind = F.try_divide(F.col("wind_on") + F.col("wind_off"), F.col("load"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    edge = df.groupBy("macro").agg(F.percentile("price", spike).alias("_edge"))
    out = df.join(edge, "macro").withColumns({"scarcity": yes(share < low_share), "high_wind": yes(wind > high_wind), "negative": yes(F.col("price") < 0), "spike": yes(F.col("price") > F.col("_edge"))}).drop("_edge")
    return out.withColumn("normal", ~(F.col("scarcity") | F.col("high_wind") | F.col("negative") | F.col("spike")))


def order_statistic_rank(n: Column, alpha: float) -> Column:
    """ceil((n + 1) alpha), kept in 1 .. n."""
    return F.least(F.greatest(F.ceil((n + 1) * alpha), F.lit(1)), n).cast("int")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number of each row from the last of its key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])))


def seasonal_verdict(by_season: DataFrame) -> DataFrame:
    """by_season(target, season, mae, higher, ..) with verdict: pass if the season `higher` has a larger error than the opposite one."""
    opposite = F.element_at(F.create_map(*[F.lit(x) for x in ("winter", "summer", "summer", "winter", "spring", "autumn", "autumn", "spring")]), F.col("higher"))
    at = by_season.groupBy("target").agg(F.max(F.when(F.col("season") == F.col("higher"), F.col("mae"))).alias("_a"), F.max(F.when(F.col("season") == opposite, F.col("mae"))).alias("_b"))
    return by_season.join(at, "target").withColumn("verdict", F.when(F.col("_a") > F.col("_b"), "pass").otherwise("fail")).drop("_a", "_b")
