"""Queries of evaluation (J1-J16, J29-J33), over persistence forecasts of the hourly stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import evaluation as E
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

QUANTILES = ("q10", "q50", "q90")
_SHIFT = {"q10": "p - 10 - coalesce(solar, 0) * 0.1", "q50": "p + (coalesce(wind_on, 0) - 50) * 0.3", "q90": "p + 10"}


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, day, y, p, solar, wind_on, q10, q50, q90, macro): each hour with the same hour of the day before."""
    h = S.hourly(spark, sf_dir).select("ts", F.col("price").alias("y"), "solar", "wind_on", "wind_off", "load")
    before = h.select((F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("ts"), F.col("y").alias("p"))
    f = h.join(before, "ts", "left").withColumn("day", tg.local_day(F.col("ts")))
    f = f.withColumn("macro", F.when(F.col("day") < F.lit("2024-01-15").cast("date"), "early").otherwise("late"))
    return f.withColumns({c: F.expr(x) for c, x in _SHIFT.items()})


def long(f: DataFrame) -> DataFrame:
    """Rows (.., level, q)."""
    one = F.explode(F.array(*[F.struct(F.lit(int(c[1:]) / 100).alias("level"), F.col(c).alias("q")) for c in QUANTILES])).alias("l")
    return f.select("*", one).select("*", "l.*").drop("l")


_F = f"""{S.H}, f0 AS (SELECT h.ts, {S.day_of("h.ts")} AS day, h.price AS y, l.price AS p, h.solar, h.wind_on, h.wind_off, h.load FROM h LEFT JOIN h l ON l.ts = h.ts - INTERVAL 24 HOUR),
f AS (SELECT *, CASE WHEN day < DATE '2024-01-15' THEN 'early' ELSE 'late' END AS macro, {", ".join(f"{x} AS {c}" for c, x in _SHIFT.items())} FROM f0),
g AS ({" UNION ALL ".join(f"SELECT f.*, {int(c[1:]) / 100} AS level, {c} AS q FROM f" for c in QUANTILES)})"""
_SCORES = "count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(sum(abs(y - p)) / nullif(sum(abs(y)) FILTER (p IS NOT NULL), 0), 6) AS wape"
_LOSS = "avg(greatest(level * (y - q), (level - 1) * (y - q)))"


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Columns not in keep rounded."""
    return df.select(*[F.col(c) if c in keep else F.round(c, 6).alias(c) for c in df.columns])


@query(f"WITH {_F} SELECT day, {_SCORES} FROM f GROUP BY day")
def j1_g3_persistence_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to hourly prices, persistence, and its scores by local day."""
    return rounded(E.point_scores(forecasts(spark, sf_dir), ["day"]), "day", "n")


@query(f"""WITH {_F}, d AS (SELECT macro, day, avg(abs(y - p)) AS m FROM f GROUP BY 1, 2), t AS (SELECT macro, {_SCORES} FROM f GROUP BY 1)
    SELECT t.*, round(dm, 6) AS daily_mean, round(ds, 6) AS daily_std, round(a, 6) AS daily_p05, round(b, 6) AS daily_p50, round(c, 6) AS daily_p95 FROM t JOIN
    (SELECT macro, avg(m) AS dm, stddev_samp(m) AS ds, quantile_cont(m, 0.05) AS a, quantile_cont(m, 0.5) AS b, quantile_cont(m, 0.95) AS c FROM d GROUP BY 1) u USING (macro)""")
def j7_point_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and the distribution of daily errors."""
    return rounded(E.summary(forecasts(spark, sf_dir), by=["macro"]), "macro", "n")


@query(f"WITH {_F} SELECT macro, level, count(*) AS n, round({_LOSS}, 6) AS pinball, round(avg((y <= q)::INT), 6) AS coverage FROM g GROUP BY 1, 2")
def j2_j4_quantile_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pinball loss and one-sided coverage of each level."""
    return rounded(E.quantile_scores(long(forecasts(spark, sf_dir)), ["macro"]), "macro", "level", "n")


@query(f"WITH {_F} SELECT day, round(avg(2 * l), 6) AS wis FROM (SELECT day, level, {_LOSS} AS l FROM g GROUP BY 1, 2) GROUP BY 1")
def j3_weighted_interval_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of twice the pinball loss per level, by day."""
    return rounded(E.weighted_interval_score(long(forecasts(spark, sf_dir)), ["day"]), "day")


@query(f"""WITH {_F}, b AS (SELECT macro, y, 'wide' AS band, q10 AS lo, q90 AS hi FROM f UNION ALL SELECT macro, y, 'upper', q50, q90 FROM f)
    SELECT macro, band, round(avg((y BETWEEN lo AND hi)::INT), 6) AS coverage, round(avg(hi - lo), 6) AS width FROM b GROUP BY 1, 2""")
def j5_j13_band_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage and width of nested bands."""
    return rounded(E.band_scores(forecasts(spark, sf_dir), [("wide", "q10", "q90"), ("upper", "q50", "q90")], ["macro"]), "macro", "band")


@query(f"WITH {_F} SELECT macro, round(avg((q10 > q50 OR q50 > q90)::INT), 6) AS crossing, round(avg((q10 > q50)::INT), 6) AS low_mid, round(avg((q50 > q90)::INT), 6) AS mid_high FROM f GROUP BY 1")
def j6_crossing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often quantiles cross, and where."""
    return rounded(E.crossing_rates(forecasts(spark, sf_dir), *QUANTILES, by=["macro"]), "macro")


@query(f"""WITH {_F} SELECT macro, round(avg(greatest(0.5 * (y - q50), -0.5 * (y - q50))), 6) AS pinball50, round(avg((y <= q50)::INT), 6) AS below50,
    round(avg((y BETWEEN q10 AND q90)::INT), 6) AS inside, round(avg((q10 > q50 OR q50 > q90)::INT), 6) AS crossing FROM f GROUP BY 1""")
def j8_quantile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quantile scores of a slice in one aggregation."""
    y, mid = F.col("y"), F.col("q50")
    cross = F.when(F.col("p").isNotNull(), ((F.col("q10") > mid) | (mid > F.col("q90"))).cast("int"))
    return rounded(forecasts(spark, sf_dir).groupBy("macro").agg(F.avg(E.pinball(y, mid, 0.5)).alias("pinball50"), F.avg((y <= mid).cast("int")).alias("below50"), F.avg(y.between(F.col("q10"), F.col("q90")).cast("int")).alias("inside"), F.avg(cross).alias("crossing")), "macro")


_R = f"""{_F}, e AS (SELECT macro, quantile_cont(y, 0.95) AS edge FROM f GROUP BY 1), r0 AS (SELECT f.*, coalesce((wind_on + wind_off + solar) / nullif(load, 0) < 0.8, false) AS scarcity,
    coalesce((wind_on + wind_off) / nullif(load, 0) > 1.5, false) AS high_wind, coalesce(y < 0, false) AS negative, coalesce(y > edge, false) AS spike FROM f JOIN e USING (macro)),
    r AS (SELECT *, NOT (scarcity OR high_wind OR negative OR spike) AS normal FROM r0)"""


def _regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.regimes(forecasts(spark, sf_dir).withColumn("price", F.col("y")), low_share=0.8, high_wind=1.5)


@query(f"WITH {_R} SELECT {S.secs('ts')} AS ts_s, scarcity, high_wind, negative, spike, normal, macro FROM r")
def j11_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regime flags; the spike edge is a quantile per macro regime."""
    return _regimes(spark, sf_dir).select(tg.seconds(F.col("ts")).alias("ts_s"), "scarcity", "high_wind", "negative", "spike", "normal", "macro")


_LABEL = "SELECT *, 'overall' AS label FROM r UNION ALL SELECT *, 'macro:' || macro FROM r" + "".join(f" UNION ALL SELECT *, '{x}' FROM r WHERE {x}" for x in ("scarcity", "high_wind", "spike", "normal"))


@query(f"WITH {_R}, l AS ({_LABEL}) SELECT label, {_SCORES} FROM l GROUP BY 1")
def j9_regime_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores overall, by macro regime and by flags that overlap."""
    return rounded(E.point_scores(E.with_labels(_regimes(spark, sf_dir), ["scarcity", "high_wind", "spike", "normal"], "macro"), ["label"]), "label", "n")


@query(f"WITH {_R}, l AS ({_LABEL}), g2 AS ({' UNION ALL '.join(f'SELECT label, y, {int(c[1:]) / 100} AS level, {c} AS q FROM l' for c in QUANTILES)}) SELECT label, level, count(*) AS n, round({_LOSS}, 6) AS pinball, round(avg((y <= q)::INT), 6) AS coverage FROM g2 GROUP BY 1, 2")
def j10_quantile_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile scores by the same labels."""
    return rounded(E.quantile_scores(long(E.with_labels(_regimes(spark, sf_dir), ["scarcity", "high_wind", "spike", "normal"], "macro")), ["label"]), "label", "level", "n")


_BUCKET = "CASE WHEN p < 40 THEN 'low' WHEN p < 60 THEN 'mid' WHEN p IS NOT NULL THEN 'high' END"


@query(f"""WITH {_F}, b AS (SELECT *, {_BUCKET} AS bucket FROM g WHERE p IS NOT NULL)
    SELECT coalesce(bucket, 'overall') AS bucket, level, count(*) AS n, round(avg((y <= q)::INT), 6) AS coverage FROM b GROUP BY GROUPING SETS ((level), (bucket, level))""")
def j12_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reliability of levels, overall and by the forecast's height, from one grouping-sets aggregation."""
    rows = long(forecasts(spark, sf_dir)).where("p IS NOT NULL").withColumn("bucket", F.expr(_BUCKET))
    got = rows.groupingSets([["level"], ["bucket", "level"]], "bucket", "level").agg(F.count("*").alias("n"), F.avg((F.col("y") <= F.col("q")).cast("int")).alias("coverage"))
    return got.select(F.coalesce("bucket", F.lit("overall")).alias("bucket"), "level", "n", F.round("coverage", 6).alias("coverage"))


_DM = f"""{_F}, s AS (SELECT CAST((epoch(ts) - epoch(min(ts) OVER ())) / 3600 AS BIGINT) AS i, (y - p) * (y - p) - (y - 50) * (y - 50) AS d FROM f WHERE p IS NOT NULL), m AS (SELECT avg(d) AS mean, count(*) AS n FROM s), x AS (SELECT i, d - mean AS x FROM s, m),
    k AS (SELECT unnest(range(0, 25)) AS k), c AS (SELECT k, sum(a.x * b.x) AS g FROM x a, k, x b WHERE b.i = a.i + k GROUP BY k),
    v AS (SELECT sum(CASE WHEN k = 0 THEN 1 ELSE 2 * (1 - k / 25.0) END * g / n) AS lrv, any_value(n) AS n, any_value(mean) AS mean FROM c, m)"""


@query(f"WITH {_DM} SELECT n, round(mean, 4) AS mean, round(lrv, 2) AS lrv, round(mean / sqrt(lrv / n) * sqrt((n + 1 - 2 * 24 + 24 * 23.0 / n) / n), 6) AS dm FROM v")
def j14_diebold_mariano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence against a constant, with a HAC variance of 24 lags."""
    f = forecasts(spark, sf_dir).where("p IS NOT NULL")
    first = F.broadcast(f.agg(F.min("ts").alias("a")))
    y = F.col("y")
    rows = f.join(first, F.lit(True)).select(F.timestamp_diff("HOUR", F.col("a"), F.col("ts")).alias("i"), ((y - F.col("p")) ** 2 - (y - 50) ** 2).alias("d"))
    return E.diebold_mariano(rows, "d", "i", 24, 24).select("n", F.round("mean", 4).alias("mean"), F.round("lrv", 2).alias("lrv"), F.round("dm", 6).alias("dm"))


@query(f"WITH {_F} SELECT CAST(ts AS DATE) AS day, round(avg(abs(y - p)), 6) AS loss, count(y - p) AS n, count(y - p) < 24 AS incomplete FROM f GROUP BY 1")
def j15_daily_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean loss by UTC day, and which days are incomplete."""
    f = forecasts(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return rounded(E.daily_loss(f, F.abs(F.col("y") - F.col("p")), "day"), "day", "n", "incomplete")


@query(f"WITH {_F}, s AS (SELECT ts, list_sort([q10, q50, q90]) AS q FROM f WHERE p IS NOT NULL) SELECT {S.secs('ts')} AS ts_s, round(q[1], 6) AS q10, round(q[2], 6) AS q50, round(q[3], 6) AS q90 FROM s")
def j16_rearranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles sorted across their levels."""
    f = E.rearrange(forecasts(spark, sf_dir).where("p IS NOT NULL"), QUANTILES)
    return f.select(tg.seconds(F.col("ts")).alias("ts_s"), *[F.round(c, 6).alias(c) for c in QUANTILES])


_CAND = "c AS (SELECT 'persistence' AS candidate, day, macro, y, p FROM f UNION ALL SELECT 'constant', day, macro, y, 50.0 FROM f WHERE p IS NOT NULL UNION ALL SELECT 'median', day, macro, y, q50 FROM f)"


def _candidates(f: DataFrame) -> DataFrame:
    one = F.array(F.struct(F.lit("persistence").alias("candidate"), F.col("p").alias("v")), F.struct(F.lit("constant").alias("candidate"), F.when(F.col("p").isNotNull(), F.lit(50.0)).alias("v")), F.struct(F.lit("median").alias("candidate"), F.col("q50").alias("v")))
    rows = f.select("day", "macro", "y", F.col("p").alias("_p"), F.explode(one).alias("c")).select("day", "macro", "y", "_p", "c.candidate", F.col("c.v").alias("p"))
    return rows.where((F.col("candidate") != "constant") | F.col("_p").isNotNull()).drop("_p")


@query(f"WITH {_F}, {_CAND} SELECT candidate, coalesce(macro, 'full') AS period, {_SCORES} FROM c GROUP BY GROUPING SETS ((candidate), (candidate, macro))")
def j29_comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of candidates by period."""
    y, p = F.col("y"), F.col("p")
    got = _candidates(forecasts(spark, sf_dir)).groupingSets([["candidate"], ["candidate", "macro"]], "candidate", "macro").agg(F.count("*").alias("n"), E.mae(y, p).alias("mae"), E.rmse(y, p).alias("rmse"), E.wape(y, p).alias("wape"))
    return rounded(got.withColumn("period", F.coalesce("macro", F.lit("full"))).drop("macro"), "candidate", "period", "n")


@query(f"""WITH {_F}, {_CAND}, r AS (SELECT candidate, sqrt(avg((y - p) * (y - p))) AS rmse FROM c GROUP BY 1)
    SELECT a.candidate, round(a.rmse - b.rmse, 6) AS difference, a.rmse < b.rmse AS better FROM r a, r b WHERE b.candidate = 'persistence' AND a.candidate <> 'persistence'""")
def j30_j31_candidate_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which candidates beat persistence, and by how much."""
    r = _candidates(forecasts(spark, sf_dir)).groupBy("candidate").agg(E.rmse(F.col("y"), F.col("p")).alias("rmse"))
    base = F.broadcast(r.where("candidate = 'persistence'").select(F.col("rmse").alias("base")))
    return r.where("candidate <> 'persistence'").join(base, F.lit(True)).select("candidate", F.round(F.col("rmse") - F.col("base"), 6).alias("difference"), (F.col("rmse") < F.col("base")).alias("better"))


@query(f"""WITH {_F}, e AS (SELECT strftime({S.local("ts")}, '%Y-%m') AS month, CASE WHEN hour({S.local("ts")}) BETWEEN 6 AND 21 THEN 'day' ELSE 'night' END AS daytime, wind_on - solar AS e FROM f WHERE wind_on IS NOT NULL AND solar IS NOT NULL)
    SELECT coalesce(month, 'all') AS month, coalesce(daytime, 'all') AS daytime, count(*) AS n, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e), 6) AS bias FROM e GROUP BY GROUPING SETS ((), (month), (daytime))""")
def j32_error_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of one series against another, overall, by month and by daytime."""
    t = tg.local(F.col("ts"))
    rows = forecasts(spark, sf_dir).where("wind_on IS NOT NULL AND solar IS NOT NULL").select(F.date_format(t, "yyyy-MM").alias("month"), F.when(F.hour(t).between(6, 21), "day").otherwise("night").alias("daytime"), (F.col("wind_on") - F.col("solar")).alias("e"))
    e = F.col("e")
    got = rows.groupingSets([[], ["month"], ["daytime"]], "month", "daytime").agg(F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))
    return rounded(got.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("month", "daytime")}), "month", "daytime", "n")


@query(f"""WITH a AS (SELECT date_trunc('hour', ts) AS ts, max(value) AS a FROM events WHERE event_id % 3 <> 0 GROUP BY 1), b AS (SELECT date_trunc('hour', ts) AS ts, max(value) AS b FROM events WHERE event_id % 3 <> 1 GROUP BY 1)
    SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(avg((abs(a - b) < 1e-9)::INT), 6) AS exact, round(quantile_cont(abs(a - b), 0.5), 6) AS median, round(quantile_cont(abs(a - b), 0.95), 6) AS p95, round(max(abs(a - b)), 6) AS most, round(corr(a, b), 6) AS correlation FROM a JOIN b USING (ts) GROUP BY 1""")
def j33_source_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far two sources agree, by day."""
    e = S.table(spark, sf_dir, "events")
    one = lambda k, c: e.where(F.col("event_id") % 3 != k).groupBy(tg.truncate(F.col("ts"), 60).alias("ts")).agg(F.max("value").alias(c))
    both = one(0, "a").join(one(1, "b"), "ts").withColumn("day", F.to_date("ts"))
    return rounded(E.agreement(both, "a", "b", ["day"]), "day", "n")
