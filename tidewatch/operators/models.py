"""Linear and tree forecasters for walk-forward runs, constant residual bands and the choice of regressors."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grams(rows: DataFrame, features: Sequence[str], target: str, by: str = "day") -> DataFrame:
    """(by, n, g): sums of products of (1, features, target) for each day; rows with a null are left out. Small enough to be dealt to folds."""
    cols = ["_one", *features, target]
    own = rows.withColumn("_one", F.lit(1.0)).dropna(subset=[*features, target])
    sums = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(cols) for b in cols[i:]]
    return own.groupBy(by).agg(F.count("*").alias("n"), F.array(*sums).alias("g"))


def ridge_walkforward(rows: DataFrame, folds: DataFrame, features: Sequence[str], target: str, most_days: int, alpha: float = 1e-6) -> DataFrame:
    """(fold_day, n, beta): ridge coefficients of each fold (intercept first), from the daily sums in its window.

    Daily sums are sent to the folds of the next most_days days and added; each fold then solves one small system.
    """
    k = len(features) + 2
    dealt = grams(rows, features, target).withColumn("fold_day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", most_days))))
    inside = dealt.join(folds, "fold_day").where(F.col("day").between(F.col("train_from"), F.col("train_to")))
    total = inside.groupBy("fold_day").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("g", F.lit(i))) for i in range(k * (k + 1) // 2)]).alias("g"))

    @F.pandas_udf("array<double>")
    def solve(g: pd.Series) -> pd.Series:
        out, upper = [], np.triu_indices(k)
        for x in g:
            m = np.zeros((k, k))
            m[upper] = x
            m = m + np.triu(m, 1).T
            a, b = m[:-1, :-1], m[:-1, -1]
            out.append(np.linalg.lstsq(a + alpha * np.diag([0.0] + [1.0] * (k - 2)), b, rcond=None)[0].tolist())
        return pd.Series(out)

    return total.select("fold_day", "n", solve("g").alias("beta"))


def line_walkforward(rows: DataFrame, folds: DataFrame, x: str, y: str, most_days: int) -> DataFrame:
    """(fold_day, n, slope, intercept): the least-squares line of y on x in each fold's window of at most most_days days; n counts rows with a null too, which the line leaves out.

    A day's rows become a count, means and centred sums before anything moves; days lie in blocks as long as the longest window, so each
    goes to its own block and the next. Moments are merged as deviations, so an x that never varies has a variance of exactly 0 and no line.
    """
    given_x, given_y = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    mean = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))  # noqa: E731  exact for equal values
    moments = {"k": F.regr_count(y, x).cast("double"), "x": mean(given_x), "y": mean(given_y), "xx": F.regr_sxx(y, x), "xy": F.regr_sxy(y, x)}
    daily = rows.groupBy("day").agg(F.count("*").alias("n"), *[m.alias(f"_{c}") for c, m in moments.items()])
    own = F.floor(F.unix_date("day") / most_days)
    day = F.struct("day", "n", *[f"_{c}" for c in moments]).alias("d")
    held = daily.select(F.explode(F.array(own, own + 1)).alias("_block"), day).groupBy("_block").agg(F.array_sort(F.collect_list("d")).alias("_days"))
    asked = folds.select("fold_day", "train_from", "train_to", F.floor(F.unix_date("train_to") / most_days).alias("_block"))
    inside = asked.join(held, "_block").select("fold_day", F.filter("_days", lambda d: d["day"].between(F.col("train_from"), F.col("train_to"))).alias("_days"))

    def merged(a: Column, d: Column) -> Column:
        k = a["k"] + d["_k"]
        dx, dy, share = d["_x"] - a["x"], d["_y"] - a["y"], d["_k"] / k
        both = {"k": k, "x": a["x"] + dx * share, "y": a["y"] + dy * share, "xx": a["xx"] + d["_xx"] + dx * dx * a["k"] * share, "xy": a["xy"] + d["_xy"] + dx * dy * a["k"] * share}
        return F.struct(*[v.alias(c) for c, v in both.items()])

    none = F.struct(*[F.lit(0.0).alias(c) for c in moments])
    total = F.aggregate(F.filter("_days", lambda d: d["_k"] > 0), none, merged).alias("m")
    n = F.aggregate("_days", F.lit(0).cast("long"), lambda a, d: a + d["n"]).alias("n")
    slope = F.when(F.col("m.xx") > 0, F.col("m.xy") / F.col("m.xx")).alias("slope")
    fits = inside.where(F.size("_days") > 0).select("fold_day", n, total).select("fold_day", "n", slope, "m")
    return fits.select("fold_day", "n", "slope", (F.col("m.y") - F.col("slope") * F.col("m.x")).alias("intercept"))


def predict(rows: DataFrame, betas: DataFrame, features: Sequence[str], day: str = "day") -> DataFrame:
    """rows with p by the coefficients of their day."""
    p = F.get("beta", F.lit(0))
    for i, c in enumerate(features):
        p = p + F.get("beta", F.lit(i + 1)) * F.col(c)
    return rows.join(betas.select(F.col("fold_day").alias(day), "beta"), day).withColumn("p", p).drop("beta")


def residual_band(train: DataFrame, test: DataFrame, levels: Sequence[float], block: str) -> DataFrame:
    """test(block, p) with a column `band`: p plus the quantiles of its block's training residuals, frozen."""
    q = train.groupBy(block).agg(F.percentile(F.col("y") - F.col("p"), F.array(*map(F.lit, levels))).alias("_q"))
    return test.join(q, block).withColumn("band", F.transform("_q", lambda x: x + F.col("p"))).drop("_q")


def varying(rows: DataFrame, columns: Sequence[str], block: str) -> DataFrame:
    """(block, column): columns whose values vary in a block."""
    long = rows.unpivot([block], list(columns), "column", "value")
    return long.groupBy(block, "column").agg(F.stddev_pop("value").alias("s")).where("s > 0").select(block, "column")


def tree_forecast(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, *, loss: str = "absolute", trees: int = 20, seed: int = 7) -> DataFrame:
    """test with `p` by boosted trees on median-imputed features with missing flags (G9). Nulls of the target are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    flags = {f"_missing_{c}": F.col(c).isNull().cast("double") for c in features}
    filled = [f"_filled_{c}" for c in features]
    stages = [Imputer(strategy="median", inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=[*filled, *flags], outputCol="_x"), GBTRegressor(featuresCol="_x", labelCol=target, predictionCol="p", lossType=loss, maxIter=trees, maxDepth=4, seed=seed)]
    model = Pipeline(stages=stages).fit(train.where(F.col(target).isNotNull()).withColumns(flags))
    return model.transform(test.withColumns(flags)).select(*test.columns, "p")
