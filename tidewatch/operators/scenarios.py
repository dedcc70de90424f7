"""Experiments that change the inputs of a day and keep the models: gaps, outages, reconstructed and second load series.

A scenario is a key over rows of the target days. Fits are made once for each set of columns, from rows as they were; scenarios only
change what a fit is fed, so their rows are never dealt to training windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import ladder as Lad
from tidewatch.operators import linear as L


class Gap(NamedTuple):
    """The last `hours` hours of the target day without these columns; 25 takes the whole of any day."""

    scenario: str
    columns: tuple[str, ...]
    hours: int


def hours_left(ts: Column, day: Column) -> Column:
    """Hours from an hour's beginning to the end of its day: 1 for the last hour, whatever the clock does."""
    return F.timestamp_diff("HOUR", ts, tg.day_end(day))


def blanked(rows: DataFrame, gaps: Sequence[Gap], columns: Sequence[str]) -> DataFrame:
    """rows(ts, day, ..) once for each gap, with scenario, hours, and `gone` where the gap is; its columns are null there."""
    part = F.explode(F.array(*[F.struct(F.lit(g.scenario).alias("scenario"), F.lit(g.hours).alias("hours"), F.array(*map(F.lit, g.columns)).cast("array<string>").alias("_columns")) for g in gaps])).alias("_g")
    got = rows.select("*", part).select("*", "_g.scenario", "_g.hours", "_g._columns").withColumn("gone", hours_left(F.col("ts"), F.col("day")) <= F.col("hours"))
    return got.withColumns({c: F.when(~(F.col("gone") & F.array_contains("_columns", c)), F.col(c)) for c in columns}).drop("_g", "_columns")


def carried(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("scenario", "hours", "day")) -> DataFrame:
    """rows with each column's last value of the same day where it is null. A group is one day."""
    w = Window.partitionBy(*keys).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def quarters(hourly: DataFrame, values: Sequence[str], profile: DataFrame) -> DataFrame:
    """hourly(ts, values, ..) as quarter hours: each value plus the shape of its hour and quarter, flat where there is none."""
    t = tg.local(F.col("ts"))
    q = hourly.withColumns({"_day": F.to_date(t), "_hour": F.hour(t)}).withColumn("quarter", F.explode(F.array(*map(F.lit, range(4)))))
    shape = profile.select(F.col("day").alias("_day"), F.col("hour").alias("_hour"), "quarter", F.col("delta").alias("_delta"))
    q = q.join(shape, ["_day", "_hour", "quarter"], "left").withColumns({c: F.col(c) + F.coalesce("_delta", F.lit(0.0)) for c in values})
    return q.withColumn("ts", (F.col("ts") + F.make_interval(mins=F.col("quarter") * 15)).cast("timestamp_ntz")).drop("_day", "_hour", "_delta", "quarter")


ARMS = ("fill", "partial", "silence")


def gap_arms(rows: DataFrame, fits: DataFrame, features: Sequence[str], gaps: Sequence[Gap], prices: DataFrame, base: DataFrame, profile: DataFrame) -> DataFrame:
    """(scenario, hours, ts, day, arm, y, p) by quarter hour for each gap: fill carries the last values on, partial puts persistence where the gap is, silence takes persistence throughout.

    prices(ts, y) and base(ts, base) by quarter hour; only quarter hours that have both are compared, so all arms stand on the same rows.
    """
    model = fits.select(F.col("fold_day").alias("day"), "med", "beta")
    cut = blanked(rows.select("ts", "day", *features), gaps, features)
    filled = carried(cut, features).join(model, "day").select("scenario", "hours", "ts", L.linear(F.col("beta"), F.col("med"), features).alias("_fill"))
    bare = cut.join(model, "day").select("scenario", "hours", "ts", "day", "gone", L.linear(F.col("beta"), F.col("med"), features).alias("_bare"))
    hourly = bare.join(filled, ["scenario", "hours", "ts"])
    q = quarters(hourly, ["_fill", "_bare"], profile).join(prices, "ts").join(base, "ts").where("y IS NOT NULL AND base IS NOT NULL")
    arm = {"fill": F.col("_fill"), "partial": F.when(F.col("gone"), F.col("base")).otherwise(F.col("_bare")), "silence": F.col("base")}
    said = F.explode(F.array(*[F.struct(F.lit(a).alias("arm"), p.alias("p")) for a, p in arm.items()])).alias("a")
    return q.select("scenario", "hours", "ts", "day", "y", said).select("scenario", "hours", "ts", "day", "a.arm", "y", "a.p")


def outages(rows: DataFrame, scenarios: Sequence[Gap], policies: DataFrame, ranks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(scenario, day, candidate, rank, reasons): the ladder's choice on each day under each outage."""
    cut = blanked(rows.select("ts", "day", *columns), scenarios, columns)
    keyed = cut.select(F.struct("scenario", "day").alias("day"), F.hour(tg.local(F.col("ts"))).alias("hour"), *columns)
    plans = Lad.gap_plan(keyed.unpivot(["day", "hour"], list(columns), "column", "value"), policies)
    got = Lad.first_viable(plans, ranks)
    return got.select("day.scenario", "day.day", "candidate", "rank", "reasons")


def outage_table(chosen: DataFrame, rows: DataFrame, fits: Mapping[str, tuple[DataFrame, Sequence[str]]], scenarios: Sequence[Gap], expected: Mapping[str, str], y: str = "y") -> DataFrame:
    """(scenario, expected, winner, days, as_expected, n, mae): what the ladder chooses most in each outage, on how many days that is what was expected, and how well the chosen models then do.

    fits: candidate -> (fits, features); a candidate's columns that the outage blanks stay blank, as its fill policy leaves them to the median.
    """
    every = sorted({c for _, f in fits.values() for c in f})
    cut = blanked(rows.select("ts", "day", y, *every), scenarios, every)
    told = None
    for name, (fit, features) in fits.items():
        model = fit.select(F.col("fold_day").alias("day"), "med", "beta")
        own = cut.join(chosen.where(F.col("candidate") == name).select("scenario", "day"), ["scenario", "day"]).join(model, "day")
        own = own.select("scenario", F.abs(F.col(y) - L.linear(F.col("beta"), F.col("med"), features)).alias("e"))
        told = own if told is None else told.unionByName(own)
    errors = told.groupBy("scenario").agg(F.count("e").alias("n"), F.avg("e").alias("mae"))
    want = F.element_at(F.create_map(*[F.lit(x) for kv in expected.items() for x in kv]), F.col("scenario"))
    name = F.coalesce("candidate", F.lit("none"))
    counts = chosen.groupBy("scenario", name.alias("winner")).agg(F.count("*").alias("k"))
    most = counts.groupBy("scenario").agg(F.min(F.struct((-F.col("k")).alias("k"), "winner"))["winner"].alias("winner"))
    days = chosen.groupBy("scenario").agg(F.count("*").alias("days"), F.count_if(name == want).alias("as_expected"))
    return days.join(most, "scenario").join(errors, "scenario", "left").select("scenario", want.alias("expected"), "winner", "days", "as_expected", F.coalesce("n", F.lit(0)).alias("n"), "mae")


#: Which column and which day stand in for a missing day-ahead load: yesterday's on Tuesday to Friday (A, B) or last week's (C, D); the forecast (A, C) or the actual (B, D).
VARIANTS = {"A": ("forecast", 1), "B": ("actual", 1), "C": ("forecast", 7), "D": ("actual", 7)}


def reconstructions(series: DataFrame, days: DataFrame) -> DataFrame:
    """(variant, ts, day, value) of series(ts, forecast, actual) for days(day): variants A to D over one table of reference days, and FINAL, the reference-day rule with the clock's own table (H4)."""
    d = F.col("day")
    back = lambda n: F.when(tg.is_nationwide_holiday(d), Lad.last_sunday_before(d)).when(F.weekday(d).between(1, 4), F.date_sub(d, n)).otherwise(F.date_sub(d, 7))
    kinds = F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(c).alias("column"), back(n).alias("reference")) for v, (c, n) in VARIANTS.items()])).alias("k")
    pairs = days.select("day").distinct().select("day", kinds).select("day", "k.*")
    start = tg.day_start(tg.local_day(F.col("ts")))
    long = series.unpivot(["ts"], ["forecast", "actual"], "column", "value").select("column", tg.local_day(F.col("ts")).alias("reference"), F.timestamp_diff("HOUR", start, F.col("ts")).alias("k"), "value")
    grid = tg.spine(days.select("day").distinct(), 60).withColumn("k", F.timestamp_diff("HOUR", tg.day_start(d), F.col("ts")))
    # By the number of the hour; hours beyond the reference day's take its last.
    ref = F.col("reference")
    slot = F.least("k", tg.expected_slots(tg.day_start(ref), tg.day_end(ref), 60) - 1)
    got = grid.join(pairs, "day").withColumn("k", slot).join(long, ["column", "reference", "k"], "left")
    by_position = got.select("variant", "ts", "day", "value")
    whole = series.groupBy(tg.local_day(F.col("ts")).alias("day")).agg(F.count("forecast").alias("_n")).where(F.col("_n") == tg.expected_slots(tg.day_start(d), tg.day_end(d), 60)).select("day")
    final = Lad.patched(series, "forecast", Lad.choose_reference_day(days, whole).where("reference IS NOT NULL").select("day", "reference"))
    return by_position.unionByName(final.select(F.lit("FINAL").alias("variant"), "ts", "day", "value"))


def counterfactual(rows: DataFrame, patches: DataFrame, column: str) -> DataFrame:
    """rows(ts, ..) once for each variant of patches(variant, ts, value) that has the hour, with the patch in `column` and nothing else changed (H3)."""
    return rows.join(patches.select("variant", "ts", F.col("value").alias("_v")), "ts").withColumn(column, F.col("_v")).drop("_v")


def moved_columns(rows: DataFrame, patched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variant, column, n, moved): in how many hours a patch changes each column; a sound patch moves its own column alone, and the real values fed through it move none."""
    a = rows.select("ts", *[F.col(c).alias(f"_{c}") for c in columns])
    part = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), (~F.col(c).eqNullSafe(F.col(f"_{c}"))).cast("int").alias("moved")) for c in columns])).alias("m")
    return patched.join(a, "ts").select("variant", part).groupBy("variant", "m.column").agg(F.count("*").alias("n"), F.sum("m.moved").alias("moved"))


def scored(rows: DataFrame, fits: DataFrame, features: Sequence[str], keys: Sequence[str], y: str = "y") -> DataFrame:
    """(keys, n, mae): error of the fits on rows of each variant; rows without the target are left out."""
    model = fits.select(F.col("fold_day").alias("day"), "med", "beta")
    e = F.abs(F.col(y) - L.linear(F.col("beta"), F.col("med"), features))
    return rows.join(model, "day").groupBy(*keys).agg(F.count(y).alias("n"), F.avg(e).alias("mae"))


def second_series_arms(rows: DataFrame, folds: DataFrame, first: str, second: str, others: Sequence[str], target: str, train_days: int, gap_days: int = 3, kind: str = "ols") -> DataFrame:
    """(arm, day, n, mae) of experiments with a second series for one column.

    own: fitted and fed on the first; second: fitted and fed on the second; patched: fitted on the first, fed the second; shifted: the
    same plus the median of first - second over the training window; gapped: as shifted, the last gap_days of training missing.
    """
    from tidewatch.operators import windows as W

    feats = [first, *others]
    swapped = rows.withColumn(first, F.col(second))
    fit = lambda df, f: L.fitted(df, f, feats, target, train_days, {kind: None})
    short = folds.withColumn("train_to", F.date_sub("train_to", gap_days))
    gap = rows.select(F.unix_date("day").alias("at"), (F.col(first) - F.col(second)).alias("gap"))
    shift = {}
    for name, f in (("shifted", folds), ("gapped", short)):
        asked = f.select(F.col("fold_day").alias("target"), *W.of_days(F.col("train_from"), F.col("train_to")))
        shift[name] = swapped.join(W.medians(gap, asked, train_days, ["gap"]).select(F.col("target").alias("day"), F.get("med", F.lit(0)).alias("_o")), "day").withColumn(first, F.col(first) + F.col("_o")).drop("_o")
    own, other, gapped = fit(rows, folds), fit(swapped, folds), fit(rows, short)
    arms = {"own": (own, rows), "second": (other, swapped), "patched": (own, swapped), "shifted": (own, shift["shifted"]), "gapped": (gapped, shift["gapped"])}
    out = None
    for name, (model, fed) in arms.items():
        one = scored(fed, model, feats, ["day"], target).select(F.lit(name).alias("arm"), "day", "n", "mae")
        out = one if out is None else out.unionByName(one)
    return out.where("n > 0")
