"""Baselines, quarter-hour shapes and walk-forward folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg


def similar_day(df: DataFrame, column: str, ts: str = "ts") -> DataFrame:
    """(ts, p): the value a day before from Tuesday to Friday, else a week before (G1). Each value moves forward to the instants it serves."""
    src = df.select(F.col(ts).alias("_s"), F.col(column).alias("p"), F.explode(F.array(F.lit(24), F.lit(168))).alias("_h"))
    at = src.withColumn("ts", (F.col("_s") + F.make_interval(hours=F.col("_h"))).cast("timestamp_ntz"))
    lag = F.when(F.weekday(tg.local(F.col("ts"))).between(1, 4), 24).otherwise(168)
    return at.where(F.col("_h") == lag).select("ts", "p")


def wall_clock_keys(df: DataFrame, ts: str = "ts") -> DataFrame:
    """df with day, hour and minute of the local clock."""
    t = tg.local(F.col(ts))
    return df.withColumns({"day": F.to_date(t), "hour": F.hour(t), "minute": F.minute(t)})


def persistence(df: DataFrame, column: str, targets: DataFrame, ts: str = "ts") -> DataFrame:
    """(ts, p) for each target slot: the value at the same wall clock of the day before.

    The first pass of a doubled hour serves both; a slot whose clock time the day before lacks has a null.
    """
    src = wall_clock_keys(df, ts).groupBy("day", "hour", "minute").agg(F.min_by(F.col(column), F.col(ts)).alias("p"))
    src = src.withColumn("day", F.date_add("day", 1))
    return wall_clock_keys(targets, ts).join(src, ["day", "hour", "minute"], "left").select(ts, "day", "p")


def complete_days(forecast: DataFrame, column: str = "p") -> DataFrame:
    """Rows of days without a null."""
    whole = forecast.groupBy("day").agg(F.bool_and(F.col(column).isNotNull()).alias("_w")).where("_w").select("day")
    return forecast.join(whole, "day", "left_semi")


def clock_persistence(df: DataFrame, column: str, ts: str = "ts") -> DataFrame:
    """(ts, p, clock): persistence by wall clock, undefined on hours that a clock change removes or doubles."""
    rows = wall_clock_keys(df, ts)
    n = rows.groupBy("day", "hour", "minute").agg(F.count("*").alias("n"), F.min(F.col(column)).alias("p"))
    src = n.select(F.date_add("day", 1).alias("day"), "hour", "minute", F.when(F.col("n") == 1, F.col("p")).alias("p"), (F.col("n") > 1).alias("src_doubled"))
    own = n.select("day", "hour", "minute", (F.col("n") > 1).alias("doubled"))
    got = rows.join(own, ["day", "hour", "minute"]).join(src, ["day", "hour", "minute"], "left")
    clock = F.when(F.col("doubled") | F.coalesce("src_doubled", F.lit(False)), "ambiguous").when(F.col("src_doubled").isNull(), "absent").otherwise("plain")
    return got.select(ts, F.when(~F.col("doubled"), F.col("p")).alias("p"), clock.alias("clock"))


def slot_quantiles(df: DataFrame, column: str, levels: Sequence[float], lookback: int = 10, ts: str = "ts") -> DataFrame:
    """(day, hour, minute, n, q): quantiles of the same slot over the days before (G5). Each value goes to the days that look back on it."""
    rows = wall_clock_keys(df, ts).select("day", "hour", "minute", F.col(column).alias("v"))
    dealt = rows.withColumn("day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", lookback))))
    return dealt.groupBy("day", "hour", "minute").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, levels))).alias("q"))


def shape_deviations(df: DataFrame, column: str, ts: str = "ts") -> DataFrame:
    """(day, hour, quarter, dev): a quarter's value less its hour's mean, for hours with all four."""
    hour = F.date_trunc("HOUR", ts).alias("h")
    rows = wall_clock_keys(df, ts).select("day", "hour", (F.col("minute") / 15).cast("int").alias("quarter"), F.col(column).alias("v"), hour)
    mean = rows.groupBy("h").agg(F.avg("v").alias("m"), F.count("v").alias("n")).where("n = 4")
    return rows.join(mean, "h").select("day", "hour", "quarter", (F.col("v") - F.col("m")).alias("dev"))


def shape_profile(df: DataFrame, column: str, days: int = 7, least: int = 3, ts: str = "ts") -> DataFrame:
    """(day, hour, quarter, delta, n): mean deviation over the days before each target day, made to add up to nothing in each hour; hours with too few are left out."""
    dev = shape_deviations(df, column, ts)
    dealt = dev.withColumn("day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", days))))
    cell = dealt.groupBy("day", "hour", "quarter").agg(F.avg("dev").alias("delta"), F.count("dev").alias("n"))
    level = cell.groupBy("day", "hour").agg(F.avg("delta").alias("_m"), F.min("n").alias("_n"), F.count("*").alias("_k")).where((F.col("_n") >= least) & (F.col("_k") == 4))
    return cell.join(level, ["day", "hour"]).select("day", "hour", "quarter", (F.col("delta") - F.col("_m")).alias("delta"), "n")


def expand(hourly: DataFrame, column: str, profile: DataFrame, ts: str = "ts") -> DataFrame:
    """Quarter hours (ts, p): the hour's value plus its shape, flat where there is none."""
    q = hourly.select(F.col(ts).alias("_h"), F.col(column).alias("p"), F.explode(F.array(*map(F.lit, range(4)))).alias("quarter"))
    q = q.withColumn("ts", (F.col("_h") + F.make_interval(mins=F.col("quarter") * 15)).cast("timestamp_ntz"))
    t = tg.local(F.col("_h"))
    got = q.withColumns({"day": F.to_date(t), "hour": F.hour(t)}).join(profile, ["day", "hour", "quarter"], "left")
    return got.select("ts", (F.col("p") + F.coalesce("delta", F.lit(0.0))).alias("p"))


def folds(days: DataFrame, train_days: int | None, first: Column | None = None) -> DataFrame:
    """(fold_day, train_from, train_to, gate): one fold a day; rolling over train_days or, with None, expanding from the first day (G10). Rolling folds that reach before the data are left out."""
    least = F.broadcast(days.agg(F.min("day").alias("_a")))
    d = days.select(F.col("day").alias("fold_day")).distinct().join(least, F.lit(True))
    start = F.date_sub("fold_day", train_days) if train_days else F.col("_a")
    out = d.withColumns({"train_from": start, "train_to": F.date_sub("fold_day", 1), "gate": tg.gate_closure(F.col("fold_day"))})
    out = out.where((F.col("train_from") >= F.col("_a")) & (F.col("train_to") >= F.col("train_from")))
    return (out.where(F.col("fold_day") >= first) if first is not None else out).drop("_a")


def train_rows(folds_: DataFrame, rows: DataFrame, most_days: int) -> DataFrame:
    """Rows of each rolling fold's window: a row goes to the folds of the next most_days days that hold it, an equi-join and no range join."""
    dealt = rows.withColumn("fold_day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", most_days))))
    return dealt.join(folds_, "fold_day").where(F.col("day").between(F.col("train_from"), F.col("train_to")))
