"""Queries of capacity (F), weather (W), validation and stores (I), and calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import calibration as K
from tidewatch.operators import capacity as A
from tidewatch.operators import weather as W
from tidewatch.plans import scores
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query



def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, day, mw): orders added up by month's end and priority."""
    from pyspark.sql import Window

    o = S.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kind"), F.last_day(F.to_date("o_orderdate")).alias("day")).agg(F.sum("o_totalprice").alias("v"))
    return o.select("kind", "day", F.sum("v").over(Window.partitionBy("kind").orderBy("day")).alias("mw"))


_A = "an AS (SELECT kind, day, sum(v) OVER (PARTITION BY kind ORDER BY day) AS mw FROM (SELECT o_orderpriority AS kind, last_day(CAST(o_orderdate AS DATE)) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2))"
_RATE = "rt AS (SELECT kind, (mw - l) / (day - ld) AS rate FROM (SELECT kind, day, mw, lag(mw) OVER w AS l, lag(day) OVER w AS ld, row_number() OVER (PARTITION BY kind ORDER BY day DESC) AS n FROM an WINDOW w AS (PARTITION BY kind ORDER BY day)) WHERE n = 1)"


@query(f"""WITH {_A}, {_RATE}, {S.D}, iv AS (SELECT kind, day AS a, mw AS va, lead(day) OVER w AS b, lead(mw) OVER w AS vb FROM an WINDOW w AS (PARTITION BY kind ORDER BY day)), k AS (SELECT DISTINCT kind FROM an), q AS (SELECT kind, day AS "on" FROM d, k)
    SELECT q.kind, q."on", round(CASE WHEN b IS NOT NULL THEN va + (vb - va) * (q."on" - a) / (b - a) ELSE va + rate * (q."on" - a) END + 0.00317, 1) AS mw FROM q LEFT JOIN iv ON iv.kind = q.kind AND q."on" >= a AND ((b IS NOT NULL AND q."on" < b) OR (b IS NULL AND q."on" <= a + 60)) LEFT JOIN rt ON rt.kind = q.kind""")
def f1_f2_capacity_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capacity on each day, between anchors and a little beyond."""
    a = anchors(spark, sf_dir)
    kinds = a.select("kind").distinct()
    q = S.days(spark, sf_dir).select(F.col("day").alias("on")).join(kinds, F.lit(True))
    return A.at(a, q, "kind").select("kind", "on", F.round(F.col("mw") + 0.00317, 1).alias("mw"))


@query(f"""WITH {_A}, g AS (SELECT *, day - lag(day) OVER (PARTITION BY kind ORDER BY day) AS g, row_number() OVER (PARTITION BY kind ORDER BY day DESC) AS n FROM an), m AS (SELECT kind, quantile_cont(g, 0.5) BETWEEN 28 AND 31 AS monthly FROM g GROUP BY 1)
    SELECT kind, max(day) AS valid_until, count(*) AS n FROM g JOIN m USING (kind) WHERE NOT monthly OR n > 2 GROUP BY 1""")
def f3_valid_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how far anchors hold without the last two."""
    return A.trailing_discarded(anchors(spark, sf_dir), "kind").groupBy("kind").agg(F.max("day").alias("valid_until"), F.count("*").alias("n"))


@query(f"""WITH {S.D}, v AS (SELECT DISTINCT last_day(day) AS vintage FROM d WHERE month(day) % 3 = 0) SELECT day, coalesce((SELECT max(vintage) FROM v WHERE vintage < day - 1), (SELECT min(vintage) FROM v)) AS vintage FROM d""")
def f4_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the vintage that was there the day before each day."""
    d = S.days(spark, sf_dir)
    return A.vintage_for(d, d.where(F.month("day") % 3 == 0).select(F.last_day("day").alias("vintage")))


@query(f"""WITH {_A}, c AS (SELECT * FROM an WHERE month(day) <> 7), s AS (SELECT kind, mw < lag(mw) OVER w AS f, (year(day) - year(lag(day) OVER w)) * 12 + month(day) - month(lag(day) OVER w) <> 1 AS g FROM c WINDOW w AS (PARTITION BY kind ORDER BY day))
    SELECT kind, count(*) FILTER (f) AS falls, count(*) FILTER (g) AS gaps FROM s GROUP BY 1""")
def f6_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """falls and gaps of anchors (here without each July)."""
    return A.cadence(anchors(spark, sf_dir).where(F.month("day") != 7), "kind")


@query(f"""WITH {_A}, o AS (SELECT * FROM an WHERE month(day) <> 3), n AS (SELECT kind, day, mw + CASE WHEN month(day) = 5 THEN 7 ELSE 0 END AS mw FROM an WHERE month(day) <> 4)
    SELECT CASE WHEN o.mw IS NULL THEN 'added' WHEN n.mw IS NULL THEN 'removed' WHEN abs(o.mw - n.mw) > 0.5 THEN 'changed' ELSE 'same' END AS state, count(*) AS n FROM o FULL JOIN n ON o.kind = n.kind AND o.day = n.day GROUP BY 1""")
def f7_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what changed between two vintages."""
    a = anchors(spark, sf_dir)
    m = F.month("day")
    new = a.where(m != 4).withColumn("mw", F.col("mw") + F.when(m == 5, 7).otherwise(0))
    return A.revisions(a.where(m != 3), new, ["kind", "day"])


def _loo(h: int) -> str:
    return f"SELECT kind, {h} AS horizon, abs((lag(mw, {h}) OVER w + (lag(mw, {h}) OVER w - lag(mw, {h + 1}) OVER w) / (lag(day, {h}) OVER w - lag(day, {h + 1}) OVER w) * (day - lag(day, {h}) OVER w) - mw) / mw) AS e FROM an WINDOW w AS (PARTITION BY kind ORDER BY day)"


@query(f"WITH {_A}, e AS ({' UNION ALL '.join(map(_loo, (1, 3, 6)))}) SELECT kind, horizon, count(*) AS n, round(avg(e), 6) AS mean_error, round(max(e), 6) AS max_error FROM e WHERE e IS NOT NULL GROUP BY 1, 2")
def f8_leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: how well increments carry on."""
    return scores.rounded(A.leave_one_out(anchors(spark, sf_dir), "kind", (1, 3, 6)), "kind", "horizon", "n")


@query(f"""WITH {S.H} SELECT {S.secs("ts")} AS ts_s, round(greatest((solar - 20) / 400, 0) * 400, 6) AS mw, coalesce(solar > 400, false) AS above FROM h""")
def f9_capacity_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """to a capacity factor and back, with negative values clipped."""
    cap = F.lit(400.0)
    return S.hourly(spark, sf_dir).select(S.ts_s(), F.round(A.to_mw(A.capacity_factor(F.col("solar") - 20, cap), cap), 6).alias("mw"), F.coalesce(F.col("solar") > 400, F.lit(False)).alias("above"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, valid, point, variable, value): events as readings of 25 points."""
    e = S.table(spark, sf_dir, "events").where("event_type IN ('click', 'view', 'error')")
    kind = F.when(F.col("event_type") == "error", "radiation").when(F.col("event_type") == "click", "wind").otherwise("temperature")
    t = tg.truncate(F.col("ts"), 60)
    return e.groupBy(F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("run"), t.alias("valid"), (F.col("user_id") % 25).alias("point"), kind.alias("variable")).agg(F.max("value").alias("value"))


_W = "w AS (SELECT date_trunc('day', ts) AS run, date_trunc('hour', ts) AS valid, user_id % 25 AS point, CASE event_type WHEN 'error' THEN 'radiation' WHEN 'click' THEN 'wind' ELSE 'temperature' END AS variable, max(value) AS value FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY ALL)"
_AL = """al AS (SELECT b.run, b.valid - INTERVAL 1 HOUR AS valid, b.point, b.variable, CASE WHEN b.variable = 'radiation' THEN b.value ELSE (a.value + b.value) / 2 END AS value
    FROM w b LEFT JOIN w a ON a.run = b.run AND a.point = b.point AND a.variable = b.variable AND a.valid = b.valid - INTERVAL 1 HOUR WHERE b.variable = 'radiation' OR a.value IS NOT NULL)"""


@query(f"WITH {_W}, {_AL} SELECT {S.secs('run')} AS run_s, {S.secs('valid')} AS valid_s, point, variable, round(value, 6) AS value FROM al")
def w2_time_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings aligned to hours by the convention of each variable."""
    return W.align(weather(spark, sf_dir)).select(tg.seconds(F.col("run")).alias("run_s"), tg.seconds(F.col("valid")).alias("valid_s"), "point", "variable", F.round("value", 6).alias("value"))


@query(f"WITH {_W} SELECT variable, {S.secs('valid')} AS valid_s, n_regionkey AS region, round(avg(value), 6) AS mean, round(avg(value * value * value), 4) AS mean_cube, round(avg((value > 12)::INT), 6) AS share_above FROM w JOIN nation ON n_nationkey = point GROUP BY 1, 2, 3")
def w3_spatial_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means, mean cubes and shares over the points of each region."""
    region = S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("point"), F.col("n_regionkey").alias("region"))
    got = W.spatial(weather(spark, sf_dir).join(region, "point"), ["variable", "valid", "region"])
    return got.select("variable", tg.seconds(F.col("valid")).alias("valid_s"), "region", F.round("mean", 6).alias("mean"), F.round("mean_cube", 4).alias("mean_cube"), F.round("share_above", 6).alias("share_above"))


@query(f"WITH {_W} SELECT CAST(valid AS DATE) AS day, round((degrees(atan2(avg(sin(radians(value * 7))), avg(cos(radians(value * 7))))) + 360) % 360, 4) AS direction FROM w GROUP BY 1")
def w3_vector_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean direction by vectors."""
    a = F.radians(F.col("value") * 7)
    return weather(spark, sf_dir).groupBy(F.to_date("valid").alias("day")).agg(F.round(W.vector_mean(F.sin(a), F.cos(a)), 4).alias("direction"))


@query(f"""WITH {S.H}, r AS (SELECT CAST(ts AS DATE) AS run, ts + to_hours(24) AS valid FROM h WHERE day(ts) % 6 <> 0 UNION SELECT CAST(ts AS DATE), ts + to_hours(48) FROM h WHERE day(ts) % 6 <> 0 AND hour(ts) <> 5 OR day(ts) % 4 = 1),
    t AS (SELECT DISTINCT {S.day_of("ts")} AS day FROM h), n AS (SELECT run, {S.day_of("valid")} AS day, count(*) AS got FROM r GROUP BY 1, 2)
    SELECT t.day, CASE WHEN t.day - 1 NOT IN (SELECT run FROM r) THEN 'no run' WHEN coalesce(got, 0) < (epoch({S.utc("t.day + 1")}) - epoch({S.utc("t.day")})) / 3600 THEN 'hours missing' ELSE 'ok' END AS state FROM t LEFT JOIN n ON n.day = t.day AND n.run = t.day - 1""")
def w1_run_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a whole run, and why others have none."""
    h, d = S.hourly(spark, sf_dir), F.dayofmonth("ts")
    run = F.to_date("ts").cast("timestamp_ntz").alias("run")
    one = h.where(d % 6 != 0).select(run, (F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("valid"))
    two = h.where(((d % 6 != 0) & (F.hour("ts") != 5)) | (d % 4 == 1)).select(run, (F.col("ts") + tg.hours(48)).cast("timestamp_ntz").alias("valid"))
    fit, unfit = W.assign_runs(h.select(tg.local_day(F.col("ts")).alias("day")).distinct(), one.unionByName(two))
    return fit.select("day", F.lit("ok").alias("state")).unionByName(unfit.select("day", F.col("reason").alias("state")))


_PAIRS = scores._F + ", rs AS (SELECT ts, day, p AS level, y, y - p AS r FROM f WHERE p IS NOT NULL)"


def _pool(frm: str, embargo: int, window: int) -> str:
    edge = f"({S.utc('t.day')} - INTERVAL {24 * embargo} HOUR)"
    return f"SELECT t.day AS target, r.* FROM (SELECT DISTINCT day FROM f) t JOIN {frm} r ON r.ts >= {edge} - INTERVAL {24 * window} HOUR AND r.ts < {edge}"


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = scores.forecasts(spark, sf_dir).where("p IS NOT NULL")
    return f.select("ts", "day", F.col("p").alias("level"), "y", (F.col("y") - F.col("p")).alias("r"))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.hourly(spark, sf_dir).select(tg.local_day(F.col("ts")).alias("day")).distinct()


@query(f"WITH {_PAIRS}, pl AS ({_pool('rs', 1, 7)}) SELECT target, count(r) AS n, round(quantile_cont(r, 0.05), 6) AS q05, round(quantile_cont(r, 0.5), 6) AS q50, round(quantile_cont(r, 0.95), 6) AS q95 FROM pl GROUP BY 1 HAVING count(r) >= 72")
def j17_j24_pool_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual quantiles of a week with an embargo of a day."""
    got = K.pool_quantiles(residuals(spark, sf_dir), _days(spark, sf_dir), "r", (0.05, 0.5, 0.95), 72, 7)
    return got.select("target", "n", *[F.round(F.get("q", F.lit(i)), 6).alias(c) for i, c in enumerate(("q05", "q50", "q95"))])


@query(f"WITH {_PAIRS}, pl AS ({_pool('rs', 1, 7)}), s AS (SELECT target, list(abs(r) ORDER BY abs(r)) AS s FROM pl GROUP BY 1) SELECT target, len(s) AS n, round(s[CAST(least(greatest(ceil((len(s) + 1) * 0.9), 1), len(s)) AS INTEGER)], 6) AS shift FROM s")
def j19_quantile_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order statistic that covers nine tenths."""
    r = residuals(spark, sf_dir).withColumn("s", F.abs("r"))
    return K.shift(r, _days(spark, sf_dir), "s", 0.9, 7).select("target", "n", F.round("shift", 6).alias("shift"))


_SIGMA = f"""{_PAIRS}, pl AS ({_pool('rs', 1, 7)}), qy AS (SELECT day AS target, ts, level FROM rs),
    nn AS (SELECT qy.target, qy.ts, pl.y, row_number() OVER (PARTITION BY qy.target, qy.ts ORDER BY abs(pl.level - qy.level), pl.level, CASE WHEN pl.level < qy.level THEN -epoch(pl.ts) ELSE epoch(pl.ts) END) AS k, count(*) OVER (PARTITION BY qy.target, qy.ts) AS n FROM qy JOIN pl ON pl.target = qy.target),
    sg AS (SELECT target, ts, greatest(stddev_samp(y), 1.0) AS sigma FROM nn WHERE k <= 50 AND n >= 48 GROUP BY 1, 2)"""


@query(f"WITH {_SIGMA} SELECT {S.secs('ts')} AS ts_s, round(sigma, 4) AS sigma FROM sg")
def j18_j20_local_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation of prices over the 50 nearest forecasts of the week before."""
    r = residuals(spark, sf_dir)
    got = K.sigma(r.select(F.col("day").alias("target"), "ts", "level"), r, 7, k=50, floor=1.0)
    return got.select(S.ts_s(), F.round("sigma", 4).alias("sigma"))


_QUARTERS = f"""qh AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS ts, avg(value) AS y FROM events GROUP BY 1), qr AS (SELECT a.ts, {S.day_of("a.ts")} AS day, a.y, 0.61 * b.y + 0.39 * c.y AS level FROM qh a JOIN qh b ON b.ts = a.ts - INTERVAL 24 HOUR JOIN qh c ON c.ts = a.ts - INTERVAL 48 HOUR),
    pl AS (SELECT t.day AS target, qr.* FROM (SELECT DISTINCT day FROM qr) t JOIN qr ON qr.ts >= {S.utc("t.day")} - INTERVAL {24 * 15} HOUR AND qr.ts < {S.utc("t.day")} - INTERVAL 24 HOUR), pn AS (SELECT target, stddev_samp(y) AS s FROM pl GROUP BY 1 HAVING count(*) >= 96),
    nn AS (SELECT q.day AS target, q.ts, pl.y, s, row_number() OVER (PARTITION BY q.ts ORDER BY abs(pl.level - q.level), pl.level, CASE WHEN pl.level < q.level THEN -epoch(pl.ts) ELSE epoch(pl.ts) END) AS k FROM qr q JOIN pn ON pn.target = q.day JOIN pl ON pl.target = q.day),
    sg AS (SELECT target, ts, greatest(stddev_samp(y), 0.05 * any_value(s)) AS sigma FROM nn WHERE k <= 50 GROUP BY 1, 2)"""


@query(f"WITH {_QUARTERS} SELECT {S.secs('ts')} AS ts_s, round(sigma, 4) AS sigma FROM sg")
def j20_quarter_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scale of quarter hours over two weeks; a pool needs a whole day of quarter hours, as an hourly one needs one of hours."""
    q = S.quarterly(spark, sf_dir)
    before = lambda n: q.select((F.col("ts") + tg.hours(24 * n)).cast("timestamp_ntz").alias("ts"), F.col("price").alias(f"_{n}"))
    rows = q.join(before(1), "ts").join(before(2), "ts").select("ts", (0.61 * F.col("_1") + 0.39 * F.col("_2")).alias("level"), F.col("price").alias("y"))
    got = K.sigma(rows.select(tg.local_day(F.col("ts")).alias("target"), "ts", "level"), rows, 14, k=50, least_days=1, periods=96, floor_fraction=0.05)
    return got.select(S.ts_s(), F.round("sigma", 4).alias("sigma"))


@query(f"""WITH {_SIGMA}, z AS (SELECT rs.ts, (y - level) / sigma AS z FROM rs JOIN sg USING (ts)), pz AS (SELECT t.day AS target, z.z FROM (SELECT DISTINCT day FROM f) t JOIN z ON z.ts >= {S.utc("t.day")} - INTERVAL 24 HOUR - INTERVAL 168 HOUR AND z.ts < {S.utc("t.day")} - INTERVAL 24 HOUR),
    qz AS (SELECT target, quantile_cont(z, 0.05) AS a, quantile_cont(z, 0.95) AS b FROM pz GROUP BY 1 HAVING count(z) >= 72)
    SELECT {S.secs("rs.ts")} AS ts_s, round(level + sigma * least(a, b), 3) AS q05, round(level + sigma * greatest(a, b), 3) AS q95 FROM rs JOIN sg USING (ts) JOIN qz ON qz.target = rs.day""")
def j22_j25_simulated_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast plus scale times the pool's standardised quantiles, in order."""
    r, days = residuals(spark, sf_dir), _days(spark, sf_dir)
    s = K.sigma(r.select(F.col("day").alias("target"), "ts", "level"), r, 7, k=50, floor=1.0).select("ts", "sigma")
    both = r.join(s, "ts").withColumn("z", F.col("r") / F.col("sigma"))
    q = K.pool_quantiles(both, days, "z", (0.05, 0.95), 72, 7)
    got = both.join(q.withColumnRenamed("target", "day"), "day")
    side = [F.col("level") + F.col("sigma") * f(F.get("q", F.lit(0)), F.get("q", F.lit(1))) for f in (F.least, F.greatest)]
    return got.select(S.ts_s(), F.round(side[0], 3).alias("q05"), F.round(side[1], 3).alias("q95"))


def _wis(w: int) -> str:
    return f"SELECT {w} AS window_days, rs.day, avg(abs(y - level - q)) AS loss FROM rs JOIN (SELECT target, quantile_cont(r, 0.5) AS q FROM ({_pool('rs', 1, w)}) GROUP BY 1 HAVING count(r) >= 72) x ON x.target = rs.day GROUP BY 2"


@query(f"WITH {_PAIRS}, l AS ({' UNION ALL '.join(map(_wis, (5, 7, 14)))}) SELECT window_days, count(*) AS days, round(avg(loss), 6) AS loss FROM l GROUP BY 1")
def j27_window_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean loss by the length of the pool's window."""
    r, days = residuals(spark, sf_dir), _days(spark, sf_dir)
    out = None
    for w in (5, 7, 14):
        q = K.pool_quantiles(r, days, "r", (0.5,), 72, w).select(F.col("target").alias("day"), F.get("q", F.lit(0)).alias("m"))
        one = r.join(q, "day").groupBy("day").agg(F.avg(F.abs(F.col("r") - F.col("m"))).alias("loss")).agg(F.lit(w).alias("window_days"), F.count("*").alias("days"), F.round(F.avg("loss"), 6).alias("loss"))
        out = one if out is None else out.unionByName(one)
    return out


_GAP = "(CASE WHEN g = 'edge' THEN r.ts >= e - INTERVAL 48 HOUR WHEN g = 'mid' THEN r.ts >= e - INTERVAL 108 HOUR AND r.ts < e - INTERVAL 60 HOUR ELSE false END)"


@query(f"""WITH {_PAIRS}, pl AS (SELECT t.day AS target, g, r.r FROM (SELECT day, {S.utc("day")} - INTERVAL 24 HOUR AS e FROM (SELECT DISTINCT day FROM f)) t, (VALUES ('none'), ('mid'), ('edge')) v(g) JOIN rs r ON r.ts >= e - INTERVAL 168 HOUR AND r.ts < e AND NOT {_GAP})
    SELECT target, g AS gap, count(*) AS n, round(quantile_cont(r, 0.9), 6) AS q90 FROM pl GROUP BY 1, 2""")
def j28_gap_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool quantiles with two days missing in the middle or at the edge."""
    gaps = {"none": (0, 0), "mid": (108, 60), "edge": (48, 0)}
    got = K.pool_gaps(residuals(spark, sf_dir), _days(spark, sf_dir), "r", 0.9, gaps, 7)
    return got.select("target", "gap", "n", F.round("q", 6).alias("q90"))


