"""Reference days, load patches, gap plans and the fallback ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators.baselines import wall_clock_keys

#: Weeks that the choice of a reference day may go back.
WEEKS = 5


def last_sunday_before(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day) + 1)


def reference_candidates(days: DataFrame) -> DataFrame:
    """(day, rank, candidate): the days that may stand for a day, best first (H1).

    Holidays take the Sunday before; Tuesday to Friday the day before, other days the week before; then week by week.
    """
    d = F.col("day")
    holiday = tg.is_nationwide_holiday(d)
    first = F.when(holiday, last_sunday_before(d)).when(F.weekday(d).between(1, 4), F.date_sub(d, 1)).otherwise(F.date_sub(d, 7))
    later = [F.when(holiday, F.date_sub(last_sunday_before(d), 7 * k)).otherwise(F.date_sub(d, 7 * k)) for k in range(1, WEEKS)]
    rows = days.select("day", F.posexplode(F.array(first, *later)).alias("rank", "candidate"))
    return rows.dropDuplicates(["day", "rank"])


def choose_reference_day(days: DataFrame, complete: DataFrame) -> DataFrame:
    """(day, reference, skipped): the first candidate that is complete and, unless the day is a holiday, none itself (H1)."""
    rows = reference_candidates(days).join(complete.select(F.col("day").alias("candidate"), F.lit(True).alias("_c")).distinct(), "candidate", "left")
    usable = F.col("_c").isNotNull() & (tg.is_nationwide_holiday(F.col("day")) | ~tg.is_nationwide_holiday(F.col("candidate")))
    best = rows.groupBy("day").agg(F.min(F.when(usable, F.struct("rank", "candidate"))).alias("best"))
    return best.select("day", F.col("best.candidate").alias("reference"), F.coalesce(F.col("best.rank"), F.lit(WEEKS)).alias("skipped"))


def patched(source: DataFrame, column: str, pairs: DataFrame, ts: str = "ts") -> DataFrame:
    """(ts, value) for each hour of each day of pairs(day, reference): the reference day's value at that hour of the clock (H2).

    A doubled hour repeats its first pass; an hour that the reference day lacks (two o'clock on a spring day) takes the one before.
    """
    src = wall_clock_keys(source, ts).groupBy("day", "hour").agg(F.min_by(F.col(column), F.col(ts)).alias("v"))
    src = src.withColumnRenamed("day", "reference")
    grid = wall_clock_keys(tg.spine(pairs, 60).withColumnRenamed("day", "target"), "ts").drop("day").withColumnRenamed("target", "day")
    before = src.select("reference", (F.col("hour") + 1).alias("hour"), F.col("v").alias("v1")).where("hour = 2")
    got = grid.join(src, ["reference", "hour"], "left").join(before, ["reference", "hour"], "left")
    short = tg.expected_slots(tg.day_start(F.col("reference")), tg.day_end(F.col("reference")), 60) == 23
    return got.select("ts", "day", F.when(short, F.coalesce("v", "v1")).otherwise(F.col("v")).alias("value"))


def positional(source: DataFrame, column: str, pairs: DataFrame, ts: str = "ts") -> DataFrame:
    """(ts, value) by the number of the hour in its day; hours beyond the reference day's take its last (H4, variants)."""
    start = tg.day_start(tg.local_day(F.col(ts)))
    src = source.select(tg.local_day(F.col(ts)).alias("reference"), F.timestamp_diff("HOUR", start, F.col(ts)).alias("k"), F.col(column).alias("v"))
    last = src.groupBy("reference").agg(F.max_by("v", "k").alias("last"))
    grid = tg.spine(pairs, 60).withColumn("k", F.timestamp_diff("HOUR", tg.day_start(F.col("day")), F.col("ts")))
    return grid.join(src, ["reference", "k"], "left").join(last, "reference", "left").select("ts", "day", F.coalesce("v", "last").alias("value"))


def gap_plan(features: DataFrame, policies: DataFrame) -> DataFrame:
    """(day, candidate, group, missing, plan): what to do about missing hours (H7).

    features: (day, hour, column, value) of target days; policies: (candidate, group, column, policy, limit). strict fails on any
    gap, fill and partial hold up to limit hours, beyond which a candidate fails; partial hours of a day win over fill.
    """
    gaps = features.join(policies, "column").groupBy("day", "candidate", "group", "policy", "limit").agg(F.count_distinct(F.when(F.col("value").isNull(), F.col("hour"))).alias("missing"))
    n = F.col("missing")
    plan = F.when(n == 0, "none").when((F.col("policy") == "strict") | (n > F.col("limit")), "fail").otherwise(F.col("policy"))
    return gaps.select("day", "candidate", "group", "missing", plan.alias("plan"))


def first_viable(plans: DataFrame, ranks: DataFrame) -> DataFrame:
    """(day, candidate, rank, reasons): the best candidate that no group fails, and what failed before it."""
    by = plans.groupBy("day", "candidate").agg(F.bool_and(F.col("plan") != "fail").alias("ok"), F.array_sort(F.collect_set(F.when(F.col("plan") == "fail", F.col("group")))).alias("why"))
    rows = by.join(ranks, "candidate")
    best = rows.groupBy("day").agg(F.min(F.when(F.col("ok"), F.struct("rank", "candidate"))).alias("best"), F.array_sort(F.collect_list(F.when(~F.col("ok"), F.struct("rank", "candidate", "why")))).alias("failed"))
    reasons = F.transform(F.filter("failed", lambda x: F.col("best").isNull() | (x["rank"] < F.col("best.rank"))), lambda x: F.concat(x["candidate"], F.lit(":"), F.array_join(x["why"], "+")))
    return best.select("day", F.col("best.candidate").alias("candidate"), F.col("best.rank").alias("rank"), F.array_join(reasons, ";").alias("reasons"))


def fill_planned(df: DataFrame, column: str, plans: DataFrame, persistence: DataFrame) -> DataFrame:
    """(ts, day, value): hours that a plan marks as partial take the persistence value (H9)."""
    part = plans.where("plan = 'partial'").select("day").distinct().withColumn("_p", F.lit(True))
    got = df.join(part, "day", "left").join(persistence.select("ts", F.col("p").alias("_v")), "ts", "left")
    return got.select("ts", "day", F.when(F.col("_p") & F.col(column).isNull(), F.col("_v")).otherwise(F.col(column)).alias("value"))


def best_accepted(runs: DataFrame) -> DataFrame:
    """(target, run_ts, rank, best_before, may_submit) of runs(target, run_ts, rank, accepted): a run may not be worse than the best accepted before."""
    # An earlier accepted run with a smaller rank exists iff the least rank before is smaller; runs of one target are few.
    from pyspark.sql import Window

    w = Window.partitionBy("target").orderBy("run_ts").rowsBetween(Window.unboundedPreceding, -1)
    best = F.min(F.when(F.col("accepted"), F.col("rank"))).over(w)
    return runs.withColumn("best_before", best).withColumn("may_submit", F.coalesce(F.col("rank") <= F.col("best_before"), F.lit(True)))
