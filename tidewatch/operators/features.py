"""Point-in-time features: every value carries the instant at which it became known, and none may be known after its gate.

Features are long rows (feature, ts, value, known_at). Lags join on the timestamp, never on a row offset, so gaps stay gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg

#: Availability class of each raw column; prefixes end in "_".
AVAILABILITY = {
    "price": "auction",
    "load_forecast": "day_ahead",
    "wind_on_forecast": "day_ahead",
    "wind_off_forecast": "day_ahead",
    "solar_forecast": "day_ahead",
    "load": "hour_later",
    "wind_on": "hour_later",
    "wind_off": "hour_later",
    "solar": "hour_later",
    "scheduled_": "day_ahead",
    "physical_": "hour_later",
    "gas": "next_midnight",
    "co2": "next_midnight",
    "calendar_": "always",
    "nwp_": "run",
}


def availability_of(column: str) -> str:
    """Class of a raw column; an unknown one raises."""
    if column in AVAILABILITY:
        return AVAILABILITY[column]
    for prefix, kind in AVAILABILITY.items():
        if prefix.endswith("_") and column.startswith(prefix):
            return kind
    raise KeyError(f"no availability class for column {column!r}")


def known_at(kind: str, ts: Column) -> Column:
    """When the value of instant ts is known."""
    day = tg.local_day(ts)
    return {
        "always": F.lit("1970-01-01").cast("timestamp_ntz"),
        "auction": tg.gate_closure(day),
        "day_ahead": tg.gate_closure(day),
        "hour_later": ts + tg.hours(1),
        "next_midnight": F.date_add(F.to_date(ts), 1).cast("timestamp_ntz"),
        "run": tg.run_init(day),
    }[kind]


def lags(df: DataFrame, column: str, hours: Sequence[int], kind: str | None = None, ts: str = "ts") -> DataFrame:
    """Long rows of a column's lags: the value of ts - h, for every ts that has one and every h (D3). No join: each value moves forward by each h."""
    kind = kind or availability_of(column)
    shifts = F.explode(F.array(*[F.lit(h) for h in hours])).alias("h")
    rows = df.select(F.col(ts).alias("_src"), F.col(column).cast("double").alias("value"), shifts)
    at = (F.col("_src") + F.make_interval(hours=F.col("h"))).cast("timestamp_ntz")
    return rows.select(F.concat(F.lit(f"{column}_lag_"), F.col("h").cast("string")).alias("feature"), at.alias("ts"), "value", known_at(kind, F.col("_src")).alias("known_at"))


def rolling_mean(df: DataFrame, column: str, window: int, lag: int, kind: str | None = None, ts: str = "ts") -> DataFrame:
    """Long rows of the mean over `window` hours that end `lag` hours before ts; null unless all are there.

    Each value is dealt to the blocks of `window` hours whose frames may hold it, at most two, so no task holds the series.
    """
    kind = kind or availability_of(column)
    size, sec = window * 3600, tg.seconds(F.col(ts))
    rows = df.select(ts, F.col(column).cast("double").alias("value"), sec.alias("_s"))
    own = F.floor(F.col("_s") / size)
    dealt = rows.withColumn("_b", F.explode(F.array(own, own + 1))).withColumn("_own", F.col("_b") == own)
    w = Window.partitionBy("_b").orderBy("_s").rangeBetween(-size + 1, 0)
    mean = F.when(F.count("value").over(w) == window, F.avg("value").over(w))
    last = F.max(F.struct("_s", known_at(kind, F.col(ts)).alias("k"))).over(w)["k"]
    at = (F.col(ts) + tg.hours(lag)).cast("timestamp_ntz")
    out = dealt.withColumns({"mean": mean, "k": last}).where("_own")
    return out.select(F.lit(f"{column}_mean_{window}").alias("feature"), at.alias("ts"), F.col("mean").alias("value"), F.col("k").alias("known_at"))


def for_target(df: DataFrame, column: str, name: str | None = None, kind: str | None = None, ts: str = "ts") -> DataFrame:
    """Long rows of a forecast used for its own instant (D5); of a reconstruction with kind "run" (D6)."""
    kind = kind or availability_of(column)
    if kind not in ("always", "day_ahead", "run"):
        raise ValueError(f"{column!r} is not known ahead of its instant")
    return df.select(F.lit(name or column).alias("feature"), F.col(ts).alias("ts"), F.col(column).cast("double").alias("value"), known_at(kind, F.col(ts)).alias("known_at"))


def combine(name: str, parts: DataFrame, first: str, second: str, fn) -> DataFrame:
    """A function of two features of a long table, known when the later is."""
    pick = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c)))
    got = parts.where(F.col("feature").isin(first, second)).groupBy("ts").agg(pick(first, "value").alias("_x"), pick(second, "value").alias("_y"), F.max("known_at").alias("known_at"))
    return got.select(F.lit(name).alias("feature"), "ts", fn(F.col("_x"), F.col("_y")).alias("value"), "known_at")


def leaks(features: DataFrame) -> DataFrame:
    """(feature, n, first): values known after the gate of their local day (D8). Empty: none leaks."""
    late = F.col("known_at") > tg.gate_closure(tg.local_day(F.col("ts")))
    return features.where(late).groupBy("feature").agg(F.count("*").alias("n"), F.min("ts").alias("first"))


class LeakageError(ValueError):
    """Features that know their future."""


def build_matrix(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column for each named feature, after a check that none leaks."""
    if bad := leaks(features.where(F.col("feature").isin(*names))).limit(20).collect():
        raise LeakageError("; ".join(f"{r['feature']}: {r['n']} rows from {r['first']}" for r in bad))
    return features.where(F.col("feature").isin(*names)).groupBy("ts").pivot("feature", list(names)).agg(F.first("value", ignorenulls=True))


def total_by_prefix(columns: Sequence[str], prefix: str) -> Column:
    """Sum of the columns with a prefix; null if one is."""
    own = [c for c in columns if c.startswith(prefix)]
    out = F.col(own[0])
    for c in own[1:]:
        out = out + F.col(c)
    return out


def residual_load(load: Column, wind_on: Column, wind_off: Column, solar: Column) -> Column:
    return load - wind_on - wind_off - solar


def renewable_share(load: Column, wind_on: Column, wind_off: Column, solar: Column) -> Column:
    """Null for a load of zero."""
    return F.try_divide(wind_on + wind_off + solar, load)


def covered_days(df: DataFrame, columns: Sequence[str], step_minutes: int = 60, ts: str = "ts") -> DataFrame:
    """Local days that have every slot with every column."""
    day = tg.local_day(F.col(ts)).alias("day")
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    n = df.where(whole).groupBy(day).agg(F.count_distinct(ts).alias("_n"))
    return n.where(F.col("_n") == tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), step_minutes)).select("day")


def same_keys(one: DataFrame, two: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one of two feature sets has, with a flag of which (D20). Empty: the same."""
    a, b = one.select(*keys).distinct().withColumn("_a", F.lit(True)), two.select(*keys).distinct().withColumn("_b", F.lit(True))
    return a.join(b, list(keys), "full").where(F.col("_a").isNull() | F.col("_b").isNull()).select(*keys, F.col("_a").isNotNull().alias("in_first"))
