"""Queries of calibrated backtests, feature-set comparisons, seasonal checks and column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch import shared
from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import calibration as K
from tidewatch.operators import cleaning as C
from tidewatch.operators import evaluation as E
from tidewatch.operators import models as M
from tidewatch.operators import scenarios as X
from tidewatch.plans import forecasting, scores, stores
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

_LEVELS = {0.1: "q10", 0.5: "p", 0.9: "q90"}
_EDGE = f"({S.utc('t.day')} - INTERVAL 24 HOUR)"
_SCALED = f"""{scores._F}, fp AS (SELECT ts, day, y, p, q10, q90 FROM f WHERE p IS NOT NULL), dn AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i FROM (SELECT DISTINCT day FROM f)),
    st AS (SELECT x.day, b.day AS target FROM dn x JOIN dn b ON b.i = x.i - x.i % 3), pl AS (SELECT t.day AS target, x.* FROM (SELECT DISTINCT target AS day FROM st) t JOIN fp x ON x.ts >= {_EDGE} - INTERVAL 168 HOUR AND x.ts < {_EDGE}),
    pa AS (SELECT target, count(*) AS n, stddev_samp(y) AS s FROM pl GROUP BY 1), pn AS (SELECT * FROM pa WHERE n >= 72), qy AS (SELECT 'cal' AS kind, target, ts, p AS level FROM pl UNION ALL SELECT 'test', target, ts, p FROM fp JOIN st USING (day)),
    nn AS (SELECT kind, qy.target, qy.ts, pl.y, s, row_number() OVER (PARTITION BY kind, qy.target, qy.ts ORDER BY abs(pl.p - qy.level), pl.p, CASE WHEN pl.p < qy.level THEN -epoch(pl.ts) ELSE epoch(pl.ts) END) AS k FROM qy JOIN pn ON pn.target = qy.target JOIN pl ON pl.target = qy.target),
    sg AS (SELECT kind, target, ts, greatest(stddev_samp(y), 0.05 * any_value(s)) AS sigma FROM nn WHERE k <= 50 GROUP BY 1, 2, 3),
    sc AS (SELECT target, level, (y - CASE level WHEN 0.1 THEN q10 WHEN 0.5 THEN p ELSE q90 END) / sigma AS s FROM pl JOIN sg USING (target, ts), (VALUES (0.1), (0.5), (0.9)) v(level) WHERE kind = 'cal'),
    so AS (SELECT target, level, list(s ORDER BY s) AS s FROM sc GROUP BY 1, 2), sh AS (SELECT target, level, s[CAST(least(greatest(ceil((len(s) + 1) * level), 1), len(s)) AS INTEGER)] AS shift FROM so),
    ca AS (SELECT fp.ts, fp.day, st.target, y, v.level, CASE v.level WHEN 0.1 THEN q10 WHEN 0.5 THEN p ELSE q90 END AS raw, shift, coalesce(pa.n, 0) AS n, sigma FROM fp JOIN st USING (day) CROSS JOIN (VALUES (0.1), (0.5), (0.9)) v(level)
        LEFT JOIN sh ON sh.target = st.target AND sh.level = v.level LEFT JOIN sg ON sg.kind = 'test' AND sg.target = st.target AND sg.ts = fp.ts LEFT JOIN pa ON pa.target = st.target),
    cq AS (SELECT *, raw + coalesce(shift * sigma, 0) AS q FROM ca)"""


def _calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.scaled_conformal(scores.forecasts(spark, sf_dir), _LEVELS, window_days=7, every=3, k=50)


@query(f"WITH {_SCALED} SELECT {S.secs('ts')} AS ts_s, level, round(q, 3) AS q, shift IS NULL AS uncalibrated FROM cq")
def j20_j21_scaled_conformal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles moved by one shift a level times a local scale, recomputed every third day; days without a pool stay raw."""
    return _calibrated(spark, sf_dir).select(S.ts_s(), "level", F.round("q", 3).alias("q"), "uncalibrated")


@query(f"""WITH {_SCALED}, cr AS (SELECT day, avg((a <> b)::INT) AS c FROM (SELECT day, ts, list(q ORDER BY level) AS a, list_sort(list(q)) AS b FROM cq GROUP BY 1, 2) GROUP BY 1)
    SELECT cq.day, level, round(any_value(shift), 5) AS shift, any_value(n) AS n, round(avg(sigma), 4) AS sigma, any_value(shift IS NULL) AS uncalibrated, round(any_value(c), 6) AS crossing_rate FROM cq JOIN cr ON cr.day = cq.day GROUP BY 1, 2""")
def j21_conformal_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift, pool, mean scale, flag and crossing rate of each day and level."""
    d = K.conformal_days(_calibrated(spark, sf_dir))
    return d.select("day", "level", F.round("shift", 5).alias("shift"), "n", F.round("sigma", 4).alias("sigma"), "uncalibrated", F.round("crossing_rate", 6).alias("crossing_rate"))


@query(f"""WITH {_SCALED}, a AS (SELECT y, level, 'raw' AS kind, raw AS q FROM cq UNION ALL SELECT y, level, 'calibrated', q FROM cq UNION ALL SELECT any_value(y), unnest([0.1, 0.5, 0.9]), 'sorted', unnest(list_sort(list(q))) FROM cq GROUP BY ts)
    SELECT kind, level, count(*) AS n, round(avg(greatest(level * (y - q), (level - 1) * (y - q))), 6) AS pinball, round(avg((y <= q)::INT), 6) AS coverage FROM a GROUP BY 1, 2""")
def j42_raw_calibrated_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of raw, calibrated and sorted calibrated quantiles side by side."""
    c = _calibrated(spark, sf_dir)
    arms = c.select("y", "level", F.lit("raw").alias("kind"), F.col("raw").alias("q")).unionByName(c.select("y", "level", F.lit("calibrated").alias("kind"), "q"))
    level = F.element_at(F.array(*map(F.lit, _LEVELS)), F.col("i") + 1)
    sorted_ = c.groupBy("ts").agg(F.first("y").alias("y"), F.array_sort(F.collect_list("q")).alias("s")).select("y", F.posexplode("s").alias("i", "q"))
    arms = arms.unionByName(sorted_.select("y", level.alias("level"), F.lit("sorted").alias("kind"), "q"))
    return scores.rounded(E.quantile_scores(arms, ["kind"]), "kind", "level", "n")


_TODAY = stores._SIGMA.replace("rs AS (SELECT ts, day, p AS level, y, y - p AS r FROM f WHERE p IS NOT NULL)", "ld AS (SELECT max(day) AS d FROM (SELECT day FROM f GROUP BY 1 HAVING count(p) >= 20)), rs AS (SELECT ts, day, p + (day = d)::INT AS level, CASE WHEN day < d THEN y END AS y, CASE WHEN day < d THEN y - p END AS r FROM f, ld WHERE p IS NOT NULL AND day <= d)")


@query(f"""WITH {_TODAY}, z AS (SELECT rs.ts, (y - level) / sigma AS z FROM rs JOIN sg USING (ts)), qz AS (SELECT quantile_cont(z, 0.05) AS a, quantile_cont(z, 0.5) AS m, quantile_cont(z, 0.95) AS b FROM z, ld WHERE z.ts >= {S.utc("d")} - INTERVAL 24 HOUR - INTERVAL 168 HOUR AND z.ts < {S.utc("d")} - INTERVAL 24 HOUR HAVING count(z) >= 72)
    SELECT {S.secs("rs.ts")} AS ts_s, round(level + sigma * a, 3) AS q05, round(level + sigma * m, 3) AS q50, round(level + sigma * b, 3) AS q95 FROM rs JOIN sg USING (ts), qz, ld WHERE rs.day = d""")
def j26_quantiles_of_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles around the values submitted for the last day with 20 hours, from the stored history before it; none if its pool is too small."""
    f = shared.written(scores.forecasts(spark, sf_dir).where("p IS NOT NULL").select("ts", "day", "p", "y"), "forecasts")
    last = f.groupBy("day").agg(F.count("*").alias("_n")).where("_n >= 20").agg(F.max("day").alias("_d"))
    told = f.join(F.broadcast(last), F.col("day") <= F.col("_d"))
    submitted = told.where("day = _d").select("ts", "day", (F.col("p") + 1).alias("level"), F.lit(None).cast("double").alias("y"))
    stored = told.select("ts", "day", F.col("p").alias("level"), "y")
    rows = shared.written(K.with_today(stored, submitted), "rows")
    submitted = rows.where("y IS NULL")
    s = K.sigma(rows.select(F.col("day").alias("target"), "ts", "level"), rows, 7, k=50, floor=1.0).select("ts", "sigma")
    both = rows.join(s, "ts").withColumn("z", (F.col("y") - F.col("level")) / F.col("sigma"))
    q = K.pool_quantiles(both, submitted.select("day").distinct(), "z", (0.05, 0.5, 0.95), 72, 7)
    got = both.join(q.withColumnRenamed("target", "day"), "day")
    return got.select(S.ts_s(), *[F.round(F.col("level") + F.col("sigma") * F.get("q", F.lit(i)), 3).alias(c) for i, c in enumerate(("q05", "q50", "q95"))])


@query(f"""WITH {stores._PAIRS}, l AS ({' UNION ALL '.join(map(stores._wis, (7, 14)))}), b AS (SELECT a.loss AS a, c.loss AS b FROM l a JOIN l c ON a.day = c.day AND a.window_days = 7 AND c.window_days = 14), m AS (SELECT count(*) AS days, avg(a) AS a, avg(b) AS b FROM b)
    SELECT w AS window_days, days, round(CASE w WHEN 7 THEN a ELSE b END, 6) AS loss, w = CASE WHEN abs(b - a) / nullif(least(a, b), 0) < 0.02 OR b < a THEN 14 ELSE 7 END AS chosen FROM m, (VALUES (7), (14)) v(w)""")
def j27_window_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool's window by mean loss on the days that both have, the longer one within 2 %."""
    r, days = stores.residuals(spark, sf_dir), stores._days(spark, sf_dir)
    out = None
    for w in (7, 14):
        q = K.pool_quantiles(r, days, "r", (0.5,), 72, w).select(F.col("target").alias("day"), F.get("q", F.lit(0)).alias("m"))
        one = r.join(q, "day").groupBy("day").agg(F.avg(F.abs(F.col("r") - F.col("m"))).alias("loss")).withColumn("window_days", F.lit(w))
        out = one if out is None else out.unionByName(one)
    return K.window_verdict(out, 7, 14).select("window_days", "days", F.round("loss", 6).alias("loss"), "chosen")


_SEASON = "CASE WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) <= 5 THEN 'spring' WHEN month({0}) <= 8 THEN 'summer' ELSE 'autumn' END"


@query(f"""WITH d AS (SELECT o_orderpriority AS target, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) / 1000 AS y FROM orders GROUP BY 1, 2), e AS (SELECT x.target, {_SEASON.format("x.day")} AS season, abs(x.y - b.y) AS e, x.y FROM d x JOIN d b ON b.target = x.target AND b.day = x.day - 1),
    m AS (SELECT target, season, count(*) AS n, avg(e) AS mae, avg(y) AS mean_actual FROM e GROUP BY 1, 2), h AS (SELECT target, max(mae) FILTER (season = hi) AS a, max(mae) FILTER (season = CASE hi WHEN 'winter' THEN 'summer' ELSE 'winter' END) AS b, any_value(hi) AS higher FROM (SELECT *, CASE WHEN target < '3' THEN 'summer' ELSE 'winter' END AS hi FROM m) GROUP BY 1)
    SELECT m.target, season, n, round(mae, 9) AS mae, round(mean_actual, 9) AS mean_actual, higher, CASE WHEN a > b THEN 'pass' ELSE 'fail' END AS verdict FROM m JOIN h USING (target)""")
def j34_seasonal_expectation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence error by season, and whether the season expected to be harder than its opposite is."""
    d = S.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("target"), F.to_date("o_orderdate").alias("day")).agg((F.avg("o_totalprice") / 1000).alias("y"))
    before = d.select("target", F.date_add("day", 1).alias("day"), F.col("y").alias("p"))
    rows = d.join(before, ["target", "day"]).withColumn("season", F.expr(_SEASON.format("day")))
    m = rows.groupBy("target", "season").agg(F.count("*").alias("n"), E.mae(F.col("y"), F.col("p")).alias("mae"), F.avg("y").alias("mean_actual"))
    return E.seasonal_verdict(m.withColumn("higher", F.when(F.col("target") < "3", "summer").otherwise("winter"))).select("target", "season", "n", F.round("mae", 9).alias("mae"), F.round("mean_actual", 9).alias("mean_actual"), "higher", "verdict")


@query(f"""WITH {S.H}, u AS (SELECT ts, unnest([{{'t': 'solar', 'y': solar, 'c': 1200.0}}, {{'t': 'wind_on', 'y': wind_on, 'c': 900.0}}]) AS u FROM h), r AS (SELECT ts, u.t AS target, u.y / u.c AS y, u.c AS c FROM u),
    e AS (SELECT r.ts, r.target, r.y, r.c, b.y AS base, (b.y + w.y) / 2 AS model FROM r JOIN r b ON b.target = r.target AND b.ts = r.ts - INTERVAL 24 HOUR JOIN r w ON w.target = r.target AND w.ts = r.ts - INTERVAL 48 HOUR WHERE r.y IS NOT NULL AND b.y IS NOT NULL AND w.y IS NOT NULL),
    l AS (SELECT *, 'overall' AS breakdown FROM e UNION ALL SELECT *, CASE WHEN hour({S.local("ts")}) BETWEEN 8 AND 16 THEN 'daylight' ELSE 'dark' END FROM e UNION ALL SELECT *, 'season_' || {_SEASON.format(S.local("ts"))} FROM e)
    SELECT target, breakdown, count(*) AS n, round(avg(abs(y - model)), 6) AS mae_cf_model, round(sqrt(avg((y - model) * (y - model))), 6) AS rmse_cf_model, round(avg(abs(y - base)), 6) AS mae_cf_baseline, round(sqrt(avg((y - base) * (y - base))), 6) AS rmse_cf_baseline, round(avg(abs(y - model) * c), 4) AS mae_mw_model, round(avg(abs(y - base) * c), 4) AS mae_mw_baseline FROM l GROUP BY 1, 2""")
def j35_renewables_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-day mean against persistence in capacity factors and MW, overall, by daylight and by season."""
    h = S.hourly(spark, sf_dir)
    rows = h.select("ts", F.explode(F.array(*[F.struct(F.lit(t).alias("target"), (F.col(t) / c).alias("y"), F.lit(c).alias("c")) for t, c in (("solar", 1200.0), ("wind_on", 900.0))])).alias("u")).select("ts", "u.*").where("y IS NOT NULL")
    lag = lambda n, name: rows.select("target", (F.col("ts") + tg.hours(n)).cast("timestamp_ntz").alias("ts"), F.col("y").alias(name))
    e = rows.join(lag(24, "base"), ["target", "ts"]).join(lag(48, "_w"), ["target", "ts"]).withColumn("model", (F.col("base") + F.col("_w")) / 2)
    t = tg.local(F.col("ts"))
    e = e.withColumn("day", F.to_date(t))
    labels = F.array(F.lit("overall"), F.when(F.hour(t).between(8, 16), "daylight").otherwise("dark"), F.concat(F.lit("season_"), F.expr(_SEASON.format("day"))))
    y, mw = F.col("y"), lambda p: F.avg(F.abs(F.col("y") - F.col(p)) * F.col("c"))
    got = e.withColumn("breakdown", F.explode(labels)).groupBy("target", "breakdown").agg(F.count("*").alias("n"), E.mae(y, F.col("model")).alias("mae_cf_model"), E.rmse(y, F.col("model")).alias("rmse_cf_model"), E.mae(y, F.col("base")).alias("mae_cf_baseline"), E.rmse(y, F.col("base")).alias("rmse_cf_baseline"), mw("model").alias("mae_mw_model"), mw("base").alias("mae_mw_baseline"))
    return got.select("target", "breakdown", "n", *[F.round(c, 4 if "_mw_" in c else 6).alias(c) for c in got.columns[3:]])


_LEN = f"CAST((epoch({S.utc('day + 1')}) - epoch({S.utc('day')})) / 3600 AS BIGINT)"
_FITS = """x AS (SELECT ts, {day} AS day, price AS y, load_forecast AS a, wind_on AS b FROM h), a0 AS (SELECT min(day) AS a0 FROM x), fd AS (SELECT DISTINCT day AS fold_day FROM x),
    bt AS (SELECT fold_day, regr_slope(y, a) AS sa, regr_intercept(y, a) AS ia, regr_slope(y, b) AS sb, regr_intercept(y, b) AS ib, count(*) FILTER (a IS NOT NULL) AS na FROM fd JOIN x ON x.day >= fold_day - 7 AND x.day < fold_day, a0 WHERE fold_day - 7 >= a0 GROUP BY 1),
    pr AS (SELECT x.ts, x.day, y, ia + sa * a AS pa, ib + sb * b AS pb, l.price AS base FROM x JOIN bt ON fold_day = x.day LEFT JOIN h l ON l.ts = x.ts - INTERVAL 24 HOUR)""".replace("{day}", S.day_of("ts"))
_BRIDGE = f"""{S.H}, {forecasting._SHAPE}, {_FITS}, hd AS (SELECT day FROM pr WHERE pa IS NOT NULL AND pb IS NOT NULL AND base IS NOT NULL GROUP BY 1 HAVING count(*) >= 0.7 * {_LEN}),
    qt AS (SELECT q.ts, {S.day_of("q.ts")} AS day, q.price AS y, l.price AS base FROM q LEFT JOIN q l ON l.ts = q.ts - INTERVAL 24 HOUR), qd AS (SELECT day FROM qt WHERE base IS NOT NULL GROUP BY 1 HAVING count(*) >= 0.7 * 4 * {_LEN}), ok AS (SELECT day FROM hd JOIN qd USING (day)), po AS (SELECT pr.* FROM pr JOIN ok USING (day) WHERE pa IS NOT NULL AND pb IS NOT NULL AND base IS NOT NULL),
    ex AS (SELECT pr.ts + to_minutes(15 * CAST(z.k AS INTEGER)) AS ts, pr.day, pa, pb, coalesce(delta, 0) AS delta FROM po pr, range(4) z(k) LEFT JOIN s ON s.day = pr.day AND s.hour = hour({S.local("pr.ts")}) AND s.quarter = z.k),
    qq AS (SELECT ex.day, qt.y, pa, pb, delta, base FROM ex JOIN qt ON qt.ts = ex.ts WHERE base IS NOT NULL),
    arms AS (SELECT day, 'hour' AS resolution, unnest([{{'a': 'load', 'p': pa}}, {{'a': 'wind', 'p': pb}}, {{'a': 'persistence', 'p': base}}]) AS u, y FROM po
        UNION ALL SELECT day, 'quarter', unnest([{{'a': 'load', 'p': pa + delta}}, {{'a': 'load flat', 'p': pa}}, {{'a': 'wind', 'p': pb + delta}}, {{'a': 'persistence', 'p': base}}]), y FROM qq)"""


def bridge(spark: SparkSession, sf_dir: str, least: float = 0.7) -> DataFrame:
    """(day, resolution, arm, y, p): two feature sets and persistence on the days that all of them can serve, by hour and, through the shape of the week before, by quarter hour.

    A day is evaluable if a share `least` of its hours and of its quarter hours has all arms and baselines (1 for series without gaps;
    the stand-in has some); all arms are compared on the same rows.
    """
    day = tg.local_day(F.col("ts")).alias("day")
    h = shared.written(S.hourly(spark, sf_dir).select("ts", day, F.col("price").alias("y"), F.col("load_forecast").alias("a"), F.col("wind_on").alias("b")), "hourly")
    q = shared.written(S.quarterly(spark, sf_dir).select("ts", day, F.col("price").alias("y")), "quarterly")
    folds = B.folds(h.select("day").distinct(), 7)
    pa, pb = (M.predict(h, M.ridge_walkforward(h, folds, [c], "y", 7, alpha=0.0), [c]).select("ts", F.col("p").alias(f"p{c}")) for c in "ab")
    before = lambda df: df.select((F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("ts"), F.col("y").alias("base"))
    pr = h.select("ts", "day", "y").join(pa, "ts").join(pb, "ts").join(before(h), "ts", "left").dropna(subset=["pa", "pb", "base"])
    qt = q.join(before(q), "ts", "left").dropna(subset=["base"])
    hours = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 60)
    whole = lambda df, n: df.groupBy("day").agg(F.count("*").alias("_n")).where(F.col("_n") >= F.lit(least) * n).select("day")
    pr = shared.written(pr.join(whole(pr, hours), "day").join(whole(qt, 4 * hours), "day"), "evaluable")
    # One row a quarter hour holds all arms; the flat one is the value before its shape is added.
    shaped = X.quarters(pr.select("ts", "pa", "pb", F.col("pa").alias("flat")), ["pa", "pb"], B.shape_profile(q, "y")).join(qt, "ts")
    arms = lambda res, **p: F.explode(F.array(*[F.struct(F.lit(res).alias("resolution"), F.lit(name.replace("_", " ")).alias("arm"), F.col(c).alias("p")) for name, c in p.items()])).alias("a")
    got = pr.select("day", "y", arms("hour", load="pa", wind="pb", persistence="base")).unionByName(shaped.select("day", "y", arms("quarter", load="pa", load_flat="flat", wind="pb", persistence="base")))
    return got.select("day", "a.resolution", "a.arm", "y", "a.p")


@query(f"WITH {_BRIDGE} SELECT resolution, u.a AS arm, count(*) AS n, count(DISTINCT day) AS days, round(avg(abs(y - u.p)), 5) AS mae, round(sqrt(avg((y - u.p) * (y - u.p))), 5) AS rmse FROM arms GROUP BY 1, 2")
def g13_g14_bridge_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward fits of two feature sets against persistence on identical days, by hour and bridged to quarter hours with and without a shape."""
    y, p = F.col("y"), F.col("p")
    got = bridge(spark, sf_dir).groupBy("resolution", "arm").agg(F.count("*").alias("n"), F.count_distinct("day").alias("days"), E.mae(y, p).alias("mae"), E.rmse(y, p).alias("rmse"))
    return got.select("resolution", "arm", "n", "days", F.round("mae", 5).alias("mae"), F.round("rmse", 5).alias("rmse"))


@query(f"""WITH {S.H}, {forecasting._SHAPE}, {_FITS}, t AS (SELECT max(day) AS d FROM pr WHERE pa IS NOT NULL), e AS (SELECT pr.ts + to_minutes(15 * CAST(z.k AS INTEGER)) AS ts, pr.day, pa + coalesce(delta, 0) AS p FROM pr JOIN t ON t.d = pr.day, range(4) z(k) LEFT JOIN s ON s.day = pr.day AND s.hour = hour({S.local("pr.ts")}) AND s.quarter = z.k)
    SELECT {S.secs("ts")} AS ts_s, round(p + 1e-7, 4) AS p, na AS train_rows FROM e JOIN bt ON bt.fold_day = e.day WHERE p IS NOT NULL""")
def g16_target_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, predict and expand for the last day, with the rows that it was trained on."""
    h = S.hourly(spark, sf_dir).select("ts", tg.local_day(F.col("ts")).alias("day"), F.col("price").alias("y"), F.col("load_forecast").alias("a"))
    betas = M.ridge_walkforward(h, B.folds(h.select("day").distinct(), 7), ["a"], "y", 7, alpha=0.0)
    p = M.predict(h, betas, ["a"]).where("p IS NOT NULL").select("ts", "day", "p")
    last = p.join(F.broadcast(p.agg(F.max("day").alias("_d"))), F.expr("day = _d")).drop("_d")
    quarters = B.expand(last.drop("day"), "p", B.shape_profile(S.quarterly(spark, sf_dir), "price"))
    n = betas.select(F.col("fold_day").alias("day"), F.col("n").alias("train_rows"))
    return quarters.withColumn("day", tg.local_day(F.col("ts"))).join(n, "day").select(S.ts_s(), F.round(F.col("p") + 1e-7, 4).alias("p"), "train_rows")


@query("""WITH x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice / 1000 AS y, CAST(o_custkey % 97 AS DOUBLE) AS x FROM orders), d AS (SELECT DISTINCT day FROM x), f AS (SELECT day AS fold_day FROM d WHERE day - 28 >= (SELECT min(day) FROM d)),
    t AS (SELECT fold_day, day, row_number() OVER (PARTITION BY fold_day ORDER BY day DESC) AS edge, row_number() OVER (PARTITION BY fold_day ORDER BY md5(day::VARCHAR)) AS random FROM f JOIN d ON day >= fold_day - 28 AND day < fold_day),
    a AS (SELECT fold_day, day, k, how FROM t, (VALUES (0), (7), (14)) v(k), (VALUES ('edge'), ('random')) w(how) WHERE CASE how WHEN 'edge' THEN edge ELSE random END > k),
    b AS (SELECT fold_day, k, how, regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM a JOIN x USING (day) GROUP BY 1, 2, 3)
    SELECT k, how, count(*) AS n, round(avg(abs(y - i - s * x)), 5) AS mae, round(sqrt(avg((y - i - s * x) ** 2)), 5) AS rmse FROM b JOIN x ON x.day = fold_day GROUP BY 1, 2""")
def j37_training_gap_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model refitted each day with none, seven or fourteen training days left out, at the edge or at random; days are sums of products, so no row is copied to folds."""
    o = S.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1000).alias("y"), (F.col("o_custkey") % 97).cast("double").alias("x"))
    x, y = F.col("x"), F.col("y")
    daily = o.groupBy("day").agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    t = B.train_rows(B.folds(daily.select("day"), 28), daily, 28)
    rank = lambda c: F.row_number().over(Window.partitionBy("fold_day").orderBy(c))  # noqa: E731  28 rows each
    t = t.withColumns({"edge": rank(F.desc("day")), "random": rank(F.md5(F.col("day").cast("string")))})
    arms = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(h).alias("how")) for k in (0, 7, 14) for h in ("edge", "random")])).alias("arm")
    rows = t.select("*", arms).select("*", "arm.*").where(F.when(F.col("how") == "edge", F.col("edge")).otherwise(F.col("random")) > F.col("k"))
    total = rows.groupBy("fold_day", "k", "how").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    fits = total.withColumn("s", slope).select(F.col("fold_day").alias("day"), "k", "how", "s", ((F.col("sy") - F.col("s") * F.col("sx")) / F.col("n")).alias("i"))
    p = o.join(fits, "day").withColumn("p", F.col("i") + F.col("s") * F.col("x"))
    return p.groupBy("k", "how").agg(F.count("*").alias("n"), F.round(E.mae(y, F.col("p")), 5).alias("mae"), F.round(E.rmse(y, F.col("p")), 5).alias("rmse"))


@query(f"WITH {S.D} SELECT day, {S.secs(S.utc('day - 14'))} AS start_s, {S.secs(S.utc('day + 1'))} AS end_s, CAST((epoch({S.utc('day + 1')}) - epoch({S.utc('day - 14')})) / 3600 AS BIGINT) AS n_hours FROM d")
def c2_local_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of fifteen local days, each end from the calendar, so that those over a clock change have an hour more or less."""
    a, b = tg.local_window(F.col("day"), 14, -1)
    return S.days(spark, sf_dir).select("day", tg.seconds(a).alias("start_s"), tg.seconds(b).alias("end_s"), tg.expected_slots(a, b, 60).alias("n_hours"))


@query("""SELECT CAST(floor(epoch(date_trunc('hour', ts))) AS BIGINT) AS ts_s, round(sum(value) FILTER (event_type = 'purchase'), 6) AS gen_wind, round(sum(value) FILTER (event_type = 'error'), 6) AS gen_solar, round(sum(value) FILTER (event_type IN ('click', 'view')), 6) AS gen_hydro,
    round(sum(value) FILTER (event_type NOT IN ('purchase', 'error', 'click', 'view')), 6) AS gen_other FROM events GROUP BY date_trunc('hour', ts)""")
def a13_generation_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source types as columns, hydro kinds and unknown kinds summed, null where none has a value."""
    e = S.table(spark, sf_dir, "events").select(tg.truncate(F.col("ts"), 60).alias("ts"), F.col("event_type").alias("type"), F.col("value").alias("mw"))
    got = C.generation_columns(e, {"purchase": "gen_wind", "error": "gen_solar"}, ["click", "view"])
    return got.select(S.ts_s(), *[F.round(c, 6).alias(c) for c in ("gen_wind", "gen_solar", "gen_hydro", "gen_other")])


#: Point variables and shared columns of each target model, in canonical order.
TARGET_COLUMNS = {"wind_onshore": (("wind100", "gust"), ("wind100_mean_all", "wind100_cube_mean"), 0), "wind_offshore": (("wind100", "dir_sin", "dir_cos"), ("wind100_cube_mean",), 1), "solar": (("ghi", "cloud", "temp"), ("ghi_mean_all", "cloud_cover_mean_all"), 2)}
_CALENDAR = ("hour_sin", "hour_cos", "year_sin", "year_cos")


def _column_rows() -> str:
    point = ", ".join(f"('{t}', {i}, '{v}', {kind})" for t, (vs, _, kind) in TARGET_COLUMNS.items() for i, v in enumerate(vs))
    shared = ", ".join(f"('{t}', {i}, '{c}')" for t, (_, cs, _) in TARGET_COLUMNS.items() for i, c in enumerate((*cs, *_CALENDAR)))
    return f"pv(target, i, v, kind) AS (VALUES {point}), sc(target, i, c) AS (VALUES {shared})"


@query(f"""WITH {_column_rows()}, u AS (SELECT target, 0 AS part, n_nationkey AS a, i AS b, 'p' || n_nationkey || '__' || v AS name FROM nation JOIN pv ON kind = n_regionkey % 3 UNION ALL SELECT target, 1, i, 0, c FROM sc)
    SELECT target, row_number() OVER (PARTITION BY target ORDER BY part, a, b) AS position, name AS \"column\" FROM u""")
def b12_target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of each target's model in canonical order: its variables at its points, its aggregates, the calendar."""
    points = S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("point"), (F.col("n_regionkey") % 3).alias("kind"))
    variables = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(kind).alias("k"), F.lit(i).alias("b"), F.lit(v).alias("v")) for t, (vs, _, kind) in TARGET_COLUMNS.items() for i, v in enumerate(vs)])
    own = points.select("*", F.explode(variables).alias("u")).where("u.k = kind").select("u.target", F.lit(0).alias("part"), F.col("point").cast("long").alias("a"), F.col("u.b").alias("b"), F.concat(F.lit("p"), "point", F.lit("__"), "u.v").alias("column"))
    rest = spark.createDataFrame([(t, 1, i, 0, c) for t, (_, cs, _) in TARGET_COLUMNS.items() for i, c in enumerate((*cs, *_CALENDAR))], "target string, part int, a long, b int, column string")
    position = F.row_number().over(Window.partitionBy("target").orderBy("part", "a", "b"))
    return own.unionByName(rest).select("target", position.cast("long").alias("position"), "column")
