"""Installed capacity from anchors: as-of lookups, interpolation, extrapolation and revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(anchors: DataFrame, by: str, day: str = "day", value: str = "mw") -> DataFrame:
    """(by, a, b, va, vb): each anchor with the next; b is null after the last. Anchors of one type are few."""
    w = Window.partitionBy(by).orderBy(day)
    return anchors.select(by, F.col(day).alias("a"), F.col(value).alias("va"), F.lead(day).over(w).alias("b"), F.lead(value).over(w).alias("vb"))


def extrapolation_rate(anchors: DataFrame, by: str, rule: str = "last", day: str = "day", value: str = "mw") -> DataFrame:
    """(by, rate): MW a day by the last increment, the mean of the last three, or the slope of the last three anchors (F2)."""
    w = Window.partitionBy(by).orderBy(F.desc(day))
    rows = anchors.select(by, F.col(day).alias("d"), F.col(value).alias("v"), F.row_number().over(w).alias("n"), F.lead(day).over(w).alias("d0"), F.lead(value).over(w).alias("v0"))
    if rule == "slope":
        return rows.where("n <= 3").groupBy(by).agg(F.regr_slope("v", F.unix_date("d").cast("double")).alias("rate"))
    step = F.try_divide(F.col("v") - F.col("v0"), F.date_diff("d", "d0"))
    return rows.where(F.col("n") <= (1 if rule == "last" else 3)).groupBy(by).agg(F.avg(step).alias("rate"))


def at(anchors: DataFrame, queries: DataFrame, by: str, rule: str = "last", reach_days: int = 60, day: str = "day", value: str = "mw") -> DataFrame:
    """queries(by, on) with mw: linear between anchors, extrapolated up to reach_days after the last; null outside (F1).

    Anchors become intervals, dealt to the months that they touch, so the as-of join is an equi-join on the month.
    """
    gap = intervals(anchors, by, day, value)
    open_ = F.date_add("a", reach_days)
    month = lambda c: F.trunc(c, "MM")
    dealt = gap.withColumn("_m", F.explode(F.sequence(month(F.col("a")), month(F.coalesce("b", open_)), F.expr("INTERVAL 1 MONTH")))).join(extrapolation_rate(anchors, by, rule, day, value), by)
    hit = (F.col("on") >= F.col("a")) & F.when(F.col("b").isNotNull(), F.col("on") < F.col("b")).otherwise(F.col("on") <= open_)
    q = queries.select(by, "on").distinct().withColumn("_m", month(F.col("on")))
    share = F.date_diff("on", "a") / F.date_diff("b", "a")
    mw = F.when(F.col("b").isNotNull(), F.col("va") + (F.col("vb") - F.col("va")) * share).otherwise(F.col("va") + F.col("rate") * F.date_diff("on", "a"))
    found = q.join(dealt, [by, "_m"]).where(hit).select(by, "on", mw.alias("mw"))
    return queries.join(found, [by, "on"], "left")


def trailing_discarded(anchors: DataFrame, by: str, drop: int = 2, day: str = "day") -> DataFrame:
    """Anchors without the last `drop` of a type whose median gap is a month."""
    w = Window.partitionBy(by).orderBy(day)
    gaps = anchors.withColumn("_g", F.date_diff(day, F.lag(day).over(w)))
    monthly = gaps.groupBy(by).agg(F.percentile("_g", 0.5).between(28, 31).alias("_monthly"))
    ranked = anchors.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(day))))
    return ranked.join(monthly, by).where(~F.coalesce(F.col("_monthly"), F.lit(False)) | (F.col("_n") > drop)).drop("_n", "_monthly")


def vintage_for(days: DataFrame, vintages: DataFrame) -> DataFrame:
    """(day, vintage): the latest vintage before the day before, else the first (F4). Vintages are a short list, of a size that a file listing has."""
    # Each vintage holds from two days after its date to that of the next: an interval join by day buckets.
    listed = F.broadcast(vintages.select("vintage").distinct().agg(F.array_sort(F.collect_list("vintage")).alias("_v")))
    before = F.filter("_v", lambda v: v < F.date_sub("day", 1))
    return days.join(listed, F.lit(True)).select("day", F.coalesce(F.try_element_at(before, F.lit(-1)), F.get("_v", F.lit(0))).alias("vintage"))


def cadence(anchors: DataFrame, by: str, day: str = "day", value: str = "mw") -> DataFrame:
    """(by, falls, gaps): decreases, and steps that aren't one month."""
    w = Window.partitionBy(by).orderBy(day)
    rows = anchors.select(by, (F.col(value) < F.lag(value).over(w)).alias("f"), (F.months_between(F.trunc(day, "MM"), F.trunc(F.lag(day).over(w), "MM")) != 1).alias("g"))
    return rows.groupBy(by).agg(F.count_if("f").alias("falls"), F.count_if("g").alias("gaps"))


def revisions(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "mw", tolerance: float = 0.5) -> DataFrame:
    """(state, n): keys that two vintages share, changed beyond the tolerance, added or removed."""
    a, b = old.select(*keys, F.col(value).alias("_a")), new.select(*keys, F.col(value).alias("_b"))
    state = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.abs(F.col("_a") - F.col("_b")) > tolerance, "changed").otherwise("same")
    return a.join(b, list(keys), "full").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def leave_one_out(anchors: DataFrame, by: str, horizons: Sequence[int], day: str = "day", value: str = "mw") -> DataFrame:
    """(by, horizon, n, mean_error, max_error): relative error of carrying the last increment on over h anchors (F8)."""
    w = Window.partitionBy(by).orderBy(day)
    parts = []
    for h in horizons:
        d0, d1 = F.lag(day, h).over(w), F.lag(day, h + 1).over(w)
        v0, v1 = F.lag(value, h).over(w), F.lag(value, h + 1).over(w)
        guess = v0 + (v0 - v1) / F.date_diff(d0, d1) * F.date_diff(F.col(day), d0)
        parts.append(F.struct(F.lit(h).alias("horizon"), F.abs(F.try_divide(guess - F.col(value), F.col(value))).alias("e")))
    rows = anchors.select(by, F.array(*parts).alias("p")).select(by, F.explode("p").alias("p")).select(by, "p.*").where("e IS NOT NULL")
    return rows.groupBy(by, "horizon").agg(F.count("*").alias("n"), F.avg("e").alias("mean_error"), F.max("e").alias("max_error"))


def capacity_factor(mw: Column, capacity: Column) -> Column:
    return F.try_divide(mw, capacity)


def to_mw(factor: Column, capacity: Column, daylight: Column | None = None) -> Column:
    """Back to MW: negative factors and, with daylight given, the night become 0; factors above 1 stay."""
    out = F.greatest(factor, F.lit(0.0)) * capacity
    return out if daylight is None else F.when(~daylight, F.lit(0.0)).otherwise(out)
