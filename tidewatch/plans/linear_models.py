"""Queries of linear forecasters and their tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import baselines as B
from tidewatch.operators import evaluation as E
from tidewatch.operators import linear as L
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, y, x1): a value an order and a column with nulls."""
    x1 = F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_custkey") % 97).cast("double"))
    return S.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1000).alias("y"), x1.alias("x1"))


_X = "x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice / 1000 AS y, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 97 AS DOUBLE) END AS x1 FROM orders), a AS (SELECT min(day) AS a FROM x)"


def _stats(rows: str, key: str, y: str = "y") -> str:
    """Median, then the moments of the imputed column, of rows(key, x1, y)."""
    return f"""SELECT {key}, any_value(med) AS med, count(*) AS n, avg(xi) AS mx, avg(t) AS mt, var_pop(xi) AS v, covar_pop(xi, t) AS c
        FROM (SELECT w.*, m.med, coalesce(x1, m.med) AS xi, {y} AS t FROM ({rows}) w JOIN (SELECT {key}, coalesce(median(x1), 0) AS med FROM ({rows}) GROUP BY 1) m USING ({key})) GROUP BY 1"""


_FITS = f"""f AS (SELECT day AS fold_day, (row_number() OVER (ORDER BY day) - 1) // 7 AS b FROM (SELECT DISTINCT day FROM x), a WHERE day - 60 >= a),
    sv AS (SELECT fold_day, min(fold_day) OVER (PARTITION BY b) AS served_by FROM f), sb AS (SELECT DISTINCT served_by FROM sv),
    st AS ({_stats("SELECT served_by, x1, y FROM sb JOIN x ON day >= served_by - 60 AND day < served_by", "served_by", "asinh(y)")}),
    be AS (SELECT served_by, med, n, mx, mt, kind, CASE WHEN v < 1e-12 THEN 0 WHEN kind = 'ols' THEN c / v WHEN kind = 'ridge' THEN n * c / (v * (n + 20)) ELSE sign(c) * greatest(0, abs(c) / sqrt(v) - 0.02) / sqrt(v) END AS s FROM st, (VALUES ('ols'), ('ridge'), ('lasso')) k(kind)),
    p AS (SELECT x.day, sv.served_by, kind, y, sinh(mt - s * mx + s * coalesce(x1, med)) AS p FROM x JOIN sv ON sv.fold_day = x.day JOIN be USING (served_by))"""


def linear_family(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fits, predictions) of three linear models with an asinh target, refitted every seventh day."""
    o = orders(spark, sf_dir)
    fits = L.fitted(o, B.folds(o.select("day").distinct(), 60), ["x1"], "y", 60, {"ols": None, "ridge": (20.0,), "lasso": (0.02,)}, transform="asinh", refit_every=7)
    return fits, L.predicted(o, fits, ["x1"], "asinh")


@query(f"WITH {_X}, {_FITS} SELECT kind, served_by, n, med, round(mt - s * mx, 6) AS intercept, round(s, 8) AS slope FROM be")
def g8_linear_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLS, ridge and lasso on a column with nulls, imputed by the window's median and standardised, for an asinh target."""
    fits, _ = linear_family(spark, sf_dir)
    one = fits.where("fold_day = served_by")
    return one.select("kind", "served_by", "n", F.get("med", F.lit(0)).alias("med"), F.round(F.get("beta", F.lit(0)), 6).alias("intercept"), F.round(F.get("beta", F.lit(1)), 8).alias("slope"))


@query(f"WITH {_X}, {_FITS} SELECT kind, year(day)::BIGINT AS year, count(*) AS n, round(avg(abs(y - p)), 5) AS mae, round(sqrt(avg((y - p) * (y - p))), 5) AS rmse FROM p GROUP BY 1, 2")
def g11_refit_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same models along all folds, a fit serving a week of them."""
    _, p = linear_family(spark, sf_dir)
    got = p.groupBy("kind", F.year("day").cast("long").alias("year")).agg(F.count("*").alias("n"), E.mae(F.col("y"), F.col("p")).alias("mae"), E.rmse(F.col("y"), F.col("p")).alias("rmse"))
    return got.select("kind", "year", "n", F.round("mae", 5).alias("mae"), F.round("rmse", 5).alias("rmse"))


GRID = (L.Setting(0.02), L.Setting(0.1), L.Setting(0.1, 1.0), L.Setting(0.4))
TRAIN, INNER, TAIL, ROUNDS = 60, 20, 14, 12


@query(f"""WITH {_X}, d AS (SELECT DISTINCT day AS fold_day FROM x, a WHERE day - {TRAIN} >= a), g(setting, rate) AS (VALUES {", ".join(f"({i}, {s.rate / (1 + s.penalty)})" for i, s in enumerate(GRID))}),
    st AS ({_stats(f"SELECT fold_day, x1, y FROM d JOIN x ON day >= fold_day - {TRAIN} AND day < fold_day - {TAIL}", "fold_day")}),
    tl AS (SELECT fold_day, sum((y - mt) * (y - mt)) AS aa, sum((y - mt) * (coalesce(x1, med) - mx)) AS ab, sum(pow(coalesce(x1, med) - mx, 2)) AS bb FROM st JOIN x ON day >= fold_day - {TAIL} AND day < fold_day GROUP BY 1),
    pa AS (SELECT fold_day, setting, k, CASE WHEN v < 1e-12 THEN 0 ELSE c / v * (1 - pow(1 - rate, k)) END AS s FROM st, g, range(0, {ROUNDS + 1}) r(k)),
    ch AS (SELECT fold_day, setting, arg_min(k, (aa - 2 * s * ab + s * s * bb, k)) AS rounds, arg_min(s, (aa - 2 * s * ab + s * s * bb, k)) AS s FROM pa JOIN tl USING (fold_day) GROUP BY 1, 2),
    lo AS (SELECT fold_day, setting, avg(abs(y - (mt + s * (coalesce(x1, med) - mx))) / 2) AS loss FROM ch JOIN st USING (fold_day) JOIN x ON day = fold_day GROUP BY 1, 2),
    o AS (SELECT DISTINCT day FROM x WHERE date_diff('day', DATE '1970-01-01', day) % 30 = 0),
    ou AS (SELECT o.day, setting, avg(loss) AS loss, count(*) AS folds FROM o JOIN lo ON fold_day >= o.day - {INNER} AND fold_day < o.day GROUP BY 1, 2),
    be AS (SELECT day, arg_min(setting, (round(loss, 9), setting)) AS setting, min(loss) AS loss, any_value(folds)::INTEGER AS folds FROM ou GROUP BY 1)
    SELECT be.day, be.setting, round(loss, 6) AS loss, folds, coalesce(rounds, -1)::INTEGER AS rounds FROM be LEFT JOIN ch ON ch.fold_day = be.day AND ch.setting = be.setting""")
def g12_tuned_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps and penalties of a boosted fit chosen over the inner folds of each outer day, stopped on a held tail, then frozen."""
    o = orders(spark, sf_dir)
    outer = o.select("day").distinct().where(F.unix_date("day") % 30 == 0)
    got = L.tuned(o, outer, ["x1"], "y", GRID, train_days=TRAIN, inner_days=INNER, tail_days=TAIL, most_rounds=ROUNDS, patience=ROUNDS)
    return got.select("day", "setting", F.round("loss", 6).alias("loss"), "folds", F.coalesce("rounds", F.lit(-1)).alias("rounds"))
