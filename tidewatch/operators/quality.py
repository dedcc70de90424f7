"""Validation, audits and stores: completeness, resolution, staleness, conflicts and idempotent merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg


def null_columns(df: DataFrame, required: Sequence[str], by: str = "day") -> DataFrame:
    """(by, missing): required columns that are null on a day."""
    return df.groupBy(by).agg(F.array_compact(F.array(*[F.when(F.count_if(F.col(c).isNull()) > 0, F.lit(c)) for c in sorted(required)])).alias("missing")).where(F.size("missing") > 0)


def complete_days(df: DataFrame, columns: Sequence[str], step_minutes: int = 60, ts: str = "ts") -> DataFrame:
    """(day, complete) for each local day with rows."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    n = F.count_distinct(F.when(whole, F.col(ts)))
    want = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), step_minutes)
    return df.groupBy(tg.local_day(F.col(ts)).alias("day")).agg(n.alias("_n")).select("day", (F.col("_n") == want).alias("complete"))


def training_window(targets: DataFrame, complete: DataFrame, window: int = 90, least: int = 83, edge: int = 7) -> DataFrame:
    """(day, complete_days, edge_age, ok): complete days in the window before each target and the age of the last (I2, I3). Days are sent to the targets that look back on them."""
    dealt = complete.where("complete").select(F.col("day").alias("_d"), F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", window))).alias("day"))
    got = targets.select("day").distinct().join(dealt, "day", "left").groupBy("day").agg(F.count("_d").alias("complete_days"), F.date_diff(F.date_sub("day", 1), F.max("_d")).alias("edge_age"))
    return got.withColumn("ok", F.coalesce((F.col("complete_days") >= least) & (F.col("edge_age") <= edge), F.lit(False)))


def bounds(df: DataFrame, column: str, low: float, high: float, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """(by, outside, first): values outside [low, high], and the first (I4)."""
    bad = ~F.col(column).between(low, high)
    return df.groupBy(*by).agg(F.count_if(bad).alias("outside"), F.min(F.when(bad, F.col(ts))).alias("first"))


def daily_sum_plausibility(df: DataFrame, column: str, margin: float = 0.1, day: str = "day") -> DataFrame:
    """(day, total, ok): each day's sum against the range of its calendar month's other days, widened by margin."""
    daily = df.groupBy(day).agg(F.sum(column).alias("total")).withColumn("_m", F.month(day))
    month = F.broadcast(daily.groupBy("_m").agg(F.sort_array(F.collect_list("total")).alias("_s")))  # at most 31 sums a year and month
    lo = F.when(F.get("_s", F.lit(0)) == F.col("total"), F.get("_s", F.lit(1))).otherwise(F.get("_s", F.lit(0)))
    n = F.size("_s")
    hi = F.when(F.get("_s", n - 1) == F.col("total"), F.get("_s", n - 2)).otherwise(F.get("_s", n - 1))
    ok = (F.col("total") >= lo * (1 - margin)) & (F.col("total") <= hi * (1 + margin))
    return daily.join(month, "_m").select(day, "total", ok.alias("ok"))


def payload_plausibility(df: DataFrame, column: str, low: Column, high: Column, margin: float = 200.0, day: str = "day") -> DataFrame:
    """(day, constant, outside): days with one value only, or with values beyond the range and its margin."""
    return df.groupBy(day).agg((F.count_distinct(F.round(column, 6)) == 1).alias("constant"), F.count_if((F.col(column) < low - margin) | (F.col(column) > high + margin)).alias("outside"))


def staleness(df: DataFrame, columns: Sequence[str], as_of: Column, warn_days: int = 4, ts: str = "ts") -> DataFrame:
    """(column, age_days, stale): days since a column last had a value."""
    last = df.agg(*[F.max(F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in columns]).unpivot([], list(columns), "column", "last")
    age = F.timestamp_diff("DAY", F.col("last"), as_of)
    return last.select("column", age.alias("age_days"), F.coalesce(age >= warn_days, F.lit(True)).alias("stale"))


def spacing(df: DataFrame, by: Sequence[str], ts: str = "ts") -> DataFrame:
    """(by, median_s, modal_s): steps between the timestamps of a series.

    Steps inside a day come from a window per day; those between days from each day's ends, so no task holds a long series.
    """
    rows = df.select(*by, tg.seconds(F.col(ts)).alias("_s")).distinct().withColumn("_d", F.floor(F.col("_s") / 86400))
    w = Window.partitionBy(*by, "_d").orderBy("_s")
    inner = rows.select(*by, (F.col("_s") - F.lag("_s").over(w)).alias("step")).where("step IS NOT NULL")
    ends = rows.groupBy(*by, "_d").agg(F.min("_s").alias("a"), F.max("_s").alias("b"))
    outer = ends.select(*by, (F.lead("a").over(Window.partitionBy(*by).orderBy("_d")) - F.col("b")).alias("step")).where("step IS NOT NULL")
    steps = inner.unionByName(outer)
    count = steps.groupBy(*by, "step").agg(F.count("*").alias("n"))
    modal = count.groupBy(*by).agg(F.max_by("step", F.struct("n", (-F.col("step")).alias("s"))).alias("modal_s"))
    return steps.groupBy(*by).agg(F.percentile("step", 0.5).alias("median_s")).join(modal, list(by))


def monthly_completeness(df: DataFrame, by: Sequence[str], step_minutes: int, exempt: DataFrame | None = None, share: float = 0.9, ts: str = "ts") -> DataFrame:
    """(by, month, n, expected, ok): rows of each UTC month against its slots; months in exempt(by, month) always pass."""
    month = F.trunc(F.to_date(ts), "MM")
    got = df.groupBy(*by, month.alias("month")).agg(F.count_distinct(ts).alias("n"))
    start = F.col("month").cast("timestamp_ntz")
    got = got.withColumn("expected", tg.expected_slots(start, F.add_months("month", 1).cast("timestamp_ntz"), step_minutes))
    enough = F.col("n") >= share * F.col("expected")
    if exempt is None:
        return got.withColumn("ok", enough)
    mark = exempt.select(*by, "month", F.lit(True).alias("_x")).distinct()
    return got.join(mark, [*by, "month"], "left").withColumn("ok", enough | F.coalesce("_x", F.lit(False))).drop("_x")


def availability(df: DataFrame, by: str, day: Column, step_minutes: int, as_of: Column, ts: str = "ts") -> DataFrame:
    """(by, day, present, expected, coverage, status, stale_hours) of each series and local day."""
    got = df.groupBy(by, day.alias("day")).agg(F.count_distinct(ts).alias("present"), F.max(ts).alias("_last"))
    want = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), step_minutes)
    cover = F.col("present") / want
    status = F.when(cover >= 1, "ok").when(cover > 0, "partial").otherwise("missing")
    return got.select(by, "day", "present", want.alias("expected"), cover.alias("coverage"), status.alias("status"), F.timestamp_diff("HOUR", F.col("_last"), as_of).alias("stale_hours"))


def heal(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], column: str, since: Column | None = None) -> DataFrame:
    """(keys, column, state): nulls filled from a fresh pull; kept values stay, and differ from fresh as `changed`."""
    a, b = existing.select(*keys, F.col(column).alias("_a"), F.lit(True).alias("_e")), fresh.select(*keys, F.col(column).alias("_b"))
    both = a.join(b, list(keys), "full")
    open_ = F.lit(True) if since is None else F.col(keys[0]) >= since
    state = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b")), "changed").when(F.col("_a").isNotNull(), "kept").when(F.col("_b").isNotNull() & open_, "filled").otherwise("missing")
    return both.withColumn("state", state).select(*keys, F.when(F.col("state") == "filled", F.col("_b")).otherwise(F.col("_a")).alias(column), "state")


def merge_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-6) -> tuple[DataFrame, DataFrame]:
    """Existing rows with the new keys added, and the new rows that contradict them (I16, T3). Merging twice changes nothing."""
    once = new.dropDuplicates(list(keys))
    fresh = once.join(existing.select(*keys), list(keys), "left_anti")
    old = existing.select(*keys, F.col(value).alias("_old"))
    conflicts = once.join(old, list(keys)).where(F.abs(F.col(value) - F.col("_old")) > tolerance)
    return existing.unionByName(fresh), conflicts


def missing_keys(existing: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of wanted that existing lacks."""
    return wanted.select(*keys).distinct().join(existing.select(*keys), list(keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def manifest(df: DataFrame, by: str, columns: Sequence[str], as_of: Column, ts: str = "ts") -> DataFrame:
    """(by, first, last, n, age_days, nulls_*): what a store holds of each source."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    return df.groupBy(by).agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"), *nulls).withColumn("age_days", F.timestamp_diff("DAY", F.col("last"), as_of))


def validate_source(df: DataFrame, by: str, columns: Sequence[str], step_minutes: int, most_null: float, ts: str = "ts") -> DataFrame:
    """(by, rows, duplicates, gaps, worst_null, blocking): the checks of a source in one pass over its rows and one over its timestamps."""
    per = df.groupBy(by, ts).agg(F.count("*").alias("_k"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in columns])
    sec = tg.seconds(F.col(ts))
    got = per.groupBy(by).agg(
        F.sum("_k").alias("rows"), F.sum(F.col("_k") - 1).alias("duplicates"), F.count("*").alias("_slots"), F.min(sec).alias("_a"), F.max(sec).alias("_b"),
        F.greatest(*[F.sum(f"_n_{c}") for c in columns], F.lit(0)).alias("_nulls"),
    )
    got = got.withColumn("gaps", ((F.col("_b") - F.col("_a")) / (60 * step_minutes) + 1 - F.col("_slots")).cast("long")).withColumn("worst_null", F.col("_nulls") / F.col("rows"))
    return got.select(by, "rows", "duplicates", "gaps", "worst_null", ((F.col("duplicates") > 0) | (F.col("worst_null") > most_null)).alias("blocking"))


def payload_checks(df: DataFrame, values: str, expected: Column) -> DataFrame:
    """df with `problem`: wrong count, values that aren't finite, or quantiles that don't ascend."""
    v = F.col(values)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.withColumn("problem", F.when(F.size(v) != expected, "count").when(~finite, "not finite"))


def ascending(values: Column) -> Column:
    return F.array_sort(values) == values


def resolution_of(n: Column) -> Column:
    """Minutes of the grid that a day of n values stands for, clock-change days included."""
    return F.when(n.isin(23, 24, 25), 60).when(n.isin(92, 96, 100), 15)


def canonical_hash(fields: Sequence[str]) -> Column:
    """A digest of the named fields that doesn't depend on their order."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("~"))) for c in sorted(fields)]), 256)
