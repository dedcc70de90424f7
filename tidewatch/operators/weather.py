"""Weather runs in long form (run, valid, point, variable, value): assignment, alignment and spatial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg

#: How a variable relates to the hour from H: the value at its end, or the mean of both ends.
AT_END = ("radiation",)


def align(rows: DataFrame) -> DataFrame:
    """(run, valid, point, variable, value) for hours: radiation of H + 1, others the mean of H and H + 1; directions are sine and cosine before they get here.

    Each value is sent to the hours that it serves, so one aggregation does without a self-join.
    """
    served = F.explode(F.array(F.lit(0), F.lit(1))).alias("_k")
    dealt = rows.select("run", "valid", "point", "variable", "value", served)
    at = (F.col("valid") - F.make_interval(hours=F.col("_k"))).cast("timestamp_ntz")
    got = dealt.withColumn("valid", at).groupBy("run", "valid", "point", "variable").agg(F.max(F.when(F.col("_k") == 0, F.col("value"))).alias("h0"), F.max(F.when(F.col("_k") == 1, F.col("value"))).alias("h1"))
    end = F.col("variable").isin(*AT_END)
    both = F.col("h1").isNotNull() & (end | F.col("h0").isNotNull())
    return got.where(both).select("run", "valid", "point", "variable", F.when(end, F.col("h1")).otherwise((F.col("h0") + F.col("h1")) / 2).alias("value"))


def spatial(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, mean, mean_cube, share_above): over points of wind speeds."""
    v = F.col("value")
    return rows.groupBy(*by).agg(F.avg(v).alias("mean"), F.avg(v * v * v).alias("mean_cube"), F.avg((v > 12).cast("int")).alias("share_above"))


def vector_mean(sine, cosine):
    """Direction in degrees of the mean vector."""
    return F.pmod(F.degrees(F.atan2(F.avg(sine), F.avg(cosine))), F.lit(360.0))


def assign_runs(days: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days with their run (day, run), and those without one that has all hours (day, reason)."""
    want = days.select("day", tg.run_init(F.col("day")).alias("run"), tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 60).alias("n"))
    inside = runs.select("run", "valid").distinct().withColumn("day", tg.local_day(F.col("valid"))).groupBy("run", "day").agg(F.count("*").alias("got"))
    both = want.join(runs.select("run").distinct().withColumn("_r", F.lit(True)), "run", "left").join(inside, ["run", "day"], "left")
    reason = F.when(F.col("_r").isNull(), "no run").when(F.coalesce("got", F.lit(0)) < F.col("n"), "hours missing")
    told = both.withColumn("reason", reason)
    return told.where("reason IS NULL").select("day", "run"), told.where("reason IS NOT NULL").select("day", "reason")


def missing_runs(days: DataFrame, runs: DataFrame, known: DataFrame) -> DataFrame:
    """(run, known): runs that the days need and the store lacks, and whether the defect list has them."""
    want = days.select(tg.run_init(F.col("day")).alias("run")).distinct()
    lack = want.join(runs.select("run").distinct(), "run", "left_anti")
    return lack.join(known.select("run", F.lit(True).alias("_k")).distinct(), "run", "left").select("run", F.coalesce("_k", F.lit(False)).alias("known"))
