"""Windows over an axis of whole numbers (days, seconds) whose rows are shuffled twice, however long the window is.

The axis is cut into blocks as long as the longest window. A window ends in one block and begins in it or in the one before, so a row goes
to its own block and the next. A group is two blocks of one series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (windows, rows sorted along the axis, first row of each window, row after its last) -> rows of the result.
Run = Callable[[pd.DataFrame, pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame]


def windowed(rows: DataFrame, windows: DataFrame, span: int, run: Run, schema: str, *, at: str = "at", by: Sequence[str] = ()) -> DataFrame:
    """What `run` makes of the windows (by, lo, hi, ..) and of the rows (by, at, ..) with lo <= at < hi; no window is longer than span."""
    own = F.floor(F.col(at) / span)
    windows = windows.select(*[F.col(c).alias(c) for c in windows.columns])  # apart from rows, should both stem from one table
    dealt = rows.withColumn("_block", F.explode(F.array(own, own + 1)))
    asked = windows.withColumn("_block", F.floor((F.col("hi") - 1) / span))
    names = [x.split()[0] for x in schema.split(", ")]

    def group(w: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(w):
            return pd.DataFrame(columns=names, dtype=object)
        if (w["hi"] - w["lo"]).max() > span:
            raise ValueError(f"a window is longer than {span}")
        r = r.sort_values(at, kind="stable")
        t = r[at].to_numpy()
        return run(w, r, np.searchsorted(t, w["lo"].to_numpy()), np.searchsorted(t, w["hi"].to_numpy()))[names]

    keys = [*by, "_block"]
    return asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(group, schema)


def medians(rows: DataFrame, windows: DataFrame, span: int, columns: Sequence[str], *, at: str = "at", by: Sequence[str] = ()) -> DataFrame:
    """(by, target, med): the median of each column's values in each window, nulls left out; 0 for a column without a value there."""

    def run(w: pd.DataFrame, r: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        full = r[list(columns)].to_numpy(float)
        out = []
        for i, j in zip(a, b, strict=True):
            parts = (x[~np.isnan(x)] for x in full[i:j].T)
            out.append([float(np.median(x)) if len(x) else 0.0 for x in parts])
        return w[[*by, "target"]].assign(med=out)

    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in by)
    return windowed(rows.select(*by, at, *[F.col(c).cast("double").alias(c) for c in columns]), windows.select(*by, "target", "lo", "hi"), span, run, f"{kinds}target date, med array<double>", at=at, by=by)


def numbered(days: DataFrame) -> DataFrame:
    """(day, i): distinct days counted from 0. Days are counted in their months; one task adds up one row a month."""
    d = days.select("day").distinct().withColumn("_month", F.trunc("day", "month"))
    months = d.groupBy("_month").agg(F.count("*").alias("_n"))
    before = months.select("_month", (F.sum("_n").over(Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_month").orderBy("day")) - 1
    return d.withColumn("_i", place).join(before, "_month").select("day", (F.col("_i") + F.col("_before")).alias("i"))


def serving(days: DataFrame, every: int) -> DataFrame:
    """(day, target): each day with the day whose fit serves it, every so-many-th of the days in order."""
    n = numbered(days).withColumn("_block", F.floor(F.col("i") / every))
    return n.join(n.groupBy("_block").agg(F.min("day").alias("target")), "_block").select("day", "target")


def of_days(first: Column, last: Column) -> tuple[Column, Column]:
    """(lo, hi) of the days from first to last, both in."""
    return F.unix_date(first).alias("lo"), (F.unix_date(last) + 1).alias("hi")
