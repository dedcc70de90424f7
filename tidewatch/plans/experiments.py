"""Queries of assembly, feature sets, model runs and experiments (A, B, D, G, H, W; J21, J36-J43)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import sources
from tidewatch.functions import solar
from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import calibration as K
from tidewatch.operators import cleaning as C
from tidewatch.operators import evaluation as E
from tidewatch.operators import features as P
from tidewatch.operators import ladder as L
from tidewatch.operators import models as M
from tidewatch.plans import calendar, scores, stores
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query



@query("""WITH p AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS price FROM events WHERE event_type NOT IN ('view', 'signup') GROUP BY 1), l AS (SELECT date_trunc('hour', ts) AS ts, sum(value) AS load FROM events WHERE event_type = 'view' GROUP BY 1),
    g AS (SELECT date_trunc('hour', ts) AS ts, max(value) AS gas FROM events WHERE event_type = 'signup' GROUP BY 1) SELECT CAST(floor(epoch(p.ts)) AS BIGINT) AS ts_s, round(price, 6) AS price, round(coalesce(load, -1), 6) AS load, coalesce(gas, -1) AS gas FROM p LEFT JOIN l USING (ts) LEFT JOIN g USING (ts)""")
def a1_a15_b1_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with disjoint columns on one row an hour; hours without a price go."""
    e, t = S.table(spark, sf_dir, "events"), tg.truncate(F.col("ts"), 60).alias("ts")
    price = e.where("event_type NOT IN ('view', 'signup')").groupBy(t).agg(F.avg("value").alias("price"))
    load = e.where("event_type = 'view'").groupBy(t).agg(F.sum("value").alias("load"))
    gas = e.where("event_type = 'signup'").groupBy(t).agg(F.max("value").alias("gas"))
    got = C.outer_assemble([price, load, gas], required="price")
    return got.select(S.ts_s(), F.round("price", 6).alias("price"), F.round(F.coalesce("load", F.lit(-1.0)), 6).alias("load"), F.coalesce("gas", F.lit(-1.0)).alias("gas"))


@query("""SELECT event_type AS source, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s, value FROM events WHERE user_id % 3 <> 0""")
def a11_landed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of paired arrays, made per source and user, flattened again; those of unequal length go."""
    e = S.table(spark, sf_dir, "events").select("event_type", "user_id", F.to_date("ts").alias("day"), F.struct(tg.seconds(F.col("ts")).alias("s"), F.col("value").alias("v")).alias("x"))
    g = e.groupBy(F.col("event_type").alias("source"), "user_id", "day").agg(F.collect_list("x").alias("x"))
    s = F.transform("x", lambda r: r["s"])
    s = F.when(F.col("user_id") % 3 == 0, F.concat(s, F.array(F.lit(0).cast("long")))).otherwise(s)
    docs = g.select("source", F.to_json(F.struct(s.alias("unix_seconds"), F.transform("x", lambda r: r["v"]).alias("values"))).alias("body"))
    return sources.flatten_series(docs)[0].select("source", S.ts_s(), "value")


@query("""WITH m AS (SELECT o_orderpriority AS production_type, date_trunc('month', o_orderdate)::DATE AS m, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
    SELECT last_day(m) AS anchor_date, production_type, round(round(v / 1e9, 3) * 1000) AS capacity_mw FROM m WHERE last_day(m) < DATE '2001-07-31'""")
def a12_capacity_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly arrays per type, melted, in MW, of months that are over."""
    o = S.table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.trunc("o_orderdate", "MM").alias("m")).agg(F.round(F.sum("o_totalprice") / 1e9, 3).alias("v"))
    g = o.groupBy("o_orderpriority").agg(F.array_sort(F.collect_list(F.struct("m", "v"))).alias("x"))
    docs = g.select(F.to_json(F.struct(F.transform("x", lambda r: F.date_format(r["m"], "MM.yyyy")).alias("time"), F.create_map("o_orderpriority", F.transform("x", lambda r: r["v"])).alias("types"))).alias("body"))
    return sources.melt_capacity(docs, F.lit("2001-07-31").cast("date"))


_DAYLEN = f"(epoch({S.utc('day + 1')}) - epoch({S.utc('day')})) / 3600"


@query(f"""WITH {S.H}, x AS (SELECT {S.day_of("h.ts")} AS day, h.ts, a.price AS p24, h.load_forecast AS lf, h.wind_on AS w FROM h LEFT JOIN h a ON a.ts = h.ts - INTERVAL 24 HOUR), n AS (SELECT day, count(*) FILTER (p24 IS NOT NULL) AS a, count(*) FILTER (lf IS NOT NULL) AS b, count(*) FILTER (w IS NOT NULL) AS c FROM x GROUP BY 1)
    SELECT v.name AS feature_set, count(*) FILTER (k = need) AS days, count(*) FILTER (k <> need) AS excluded FROM (SELECT name, {_DAYLEN} AS need, CASE name WHEN 'floor' THEN a WHEN 'core' THEN least(a, b) ELSE least(a, b, c) END AS k FROM n, (VALUES ('floor'), ('core'), ('live')) s(name)) v GROUP BY 1""")
def d18_d19_feature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that each feature set can serve, and those that it leaves out."""
    h = S.hourly(spark, sf_dir)
    f = P.lags(h, "price", (24,)).unionByName(P.for_target(h, "load_forecast")).unionByName(P.for_target(h, "wind_on", "wind", kind="day_ahead"))
    m = h.select("ts").join(P.build_matrix(f, ["price_lag_24", "load_forecast", "wind"]), "ts", "left")
    days = m.select(tg.local_day(F.col("ts")).alias("day")).distinct()
    out = None
    for name, cols in (("floor", ["price_lag_24"]), ("core", ["price_lag_24", "load_forecast"]), ("live", ["price_lag_24", "load_forecast", "wind"])):
        each = days
        for c in cols:
            each = each.join(P.covered_days(m, [c]).withColumn(f"_{c}", F.lit(1)), "day", "left")
        ok = F.lit(True)
        for c in cols:
            ok = ok & F.col(f"_{c}").isNotNull()
        one = each.agg(F.lit(name).alias("feature_set"), F.count_if(ok).alias("days"), F.count_if(~ok).alias("excluded"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {stores._W}, {stores._AL} SELECT {S.secs('al.run')} AS run_s, {S.secs('al.valid')} AS valid_s, round(avg(value) FILTER (variable = 'wind'), 4) AS wind, round(avg(value) FILTER (variable = 'radiation'), 4) AS radiation, count(*) AS n FROM al GROUP BY 1, 2 HAVING count(*) FILTER (variable = 'wind') > 0 AND count(*) FILTER (variable = 'radiation') > 0")
def w5_weather_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned readings as one row an hour."""
    from tidewatch.operators import weather as W

    a = W.align(stores.weather(spark, sf_dir))
    pick = lambda v: F.avg(F.when(F.col("variable") == v, F.col("value")))
    got = a.groupBy("run", "valid").agg(pick("wind").alias("wind"), pick("radiation").alias("radiation"), F.count("*").alias("n")).where("wind IS NOT NULL AND radiation IS NOT NULL")
    return got.select(tg.seconds(F.col("run")).alias("run_s"), tg.seconds(F.col("valid")).alias("valid_s"), F.round("wind", 4).alias("wind"), F.round("radiation", 4).alias("radiation"), "n")


@query("SELECT n_regionkey AS region, count(*) AS points, round(avg(47.5 + n_nationkey * 0.3), 6) AS lat, round(avg(6.0 + n_nationkey * 0.35), 6) AS lon, sha256(string_agg(n_nationkey::VARCHAR, ',' ORDER BY n_nationkey)) AS fingerprint FROM nation GROUP BY 1")
def w4_w6_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroids of regions, and a fingerprint of their points."""
    p = calendar.points(spark, sf_dir).join(S.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("point"), F.col("n_regionkey").alias("region")), "point")
    return p.groupBy("region").agg(F.count("*").alias("points"), F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("point")), lambda x: x.cast("string")), ","), 256).alias("fingerprint"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey", (F.col("o_totalprice") / 1000).alias("y"), (F.col("o_custkey") % 97).cast("double").alias("x1"), (F.col("o_orderkey") % 31).cast("double").alias("x2"))


_X = "x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice / 1000 AS y, CAST(o_custkey % 97 AS DOUBLE) AS x1 FROM orders), a AS (SELECT min(day) AS a FROM x), f AS (SELECT DISTINCT day AS fold_day FROM x)"
_FIT = "b AS (SELECT fold_day, count(*) AS n, regr_slope(y, x1) AS s, regr_intercept(y, x1) AS i FROM f JOIN x ON x.day >= fold_day - 30 AND x.day < fold_day, a WHERE fold_day - 30 >= a GROUP BY 1)"


@query(f"WITH {_X}, {_FIT} SELECT fold_day, n, round(i, 4) AS intercept, round(s, 6) AS slope FROM b")
def g8_g11_ridge_walkforward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fit a day from daily sums of products over a month."""
    o = _orders(spark, sf_dir)
    got = M.ridge_walkforward(o, B.folds(o.select("day").distinct(), 30), ["x1"], "y", 30, alpha=0.0)
    return got.select("fold_day", "n", F.round(F.get("beta", F.lit(0)), 4).alias("intercept"), F.round(F.get("beta", F.lit(1)), 6).alias("slope"))


@query(f"WITH {_X}, {_FIT}, p AS (SELECT x.day, y, i + s * x1 AS p FROM x JOIN b ON b.fold_day = x.day) SELECT year(day)::BIGINT AS year, count(*) AS n, round(avg(abs(y - p)), 5) AS mae, round(sqrt(avg((y - p) * (y - p))), 5) AS rmse FROM p GROUP BY 1")
def g13_walkforward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, predict and score along the folds."""
    o = _orders(spark, sf_dir)
    betas = M.ridge_walkforward(o, B.folds(o.select("day").distinct(), 30), ["x1"], "y", 30, alpha=0.0)
    p = M.predict(o, betas, ["x1"]).withColumn("year", F.year("day").cast("long"))
    return p.groupBy("year").agg(F.count("*").alias("n"), F.round(E.mae(F.col("y"), F.col("p")), 5).alias("mae"), F.round(E.rmse(F.col("y"), F.col("p")), 5).alias("rmse"))


def g9_tree_walkforward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees fitted on the first half of the month, against persistence on the second. No SQL says this; rows only."""
    f = scores.forecasts(spark, sf_dir).withColumnRenamed("p", "base").withColumn("hour", F.hour("ts").cast("double"))
    p = M.tree_forecast(f.where("macro = 'early'"), f.where("macro = 'late'"), ["hour", "solar", "wind_on", "load"], "y", trees=10)
    return p.groupBy("day").agg(F.count("*").alias("n"), E.rmse(F.col("y"), F.col("p")).alias("rmse"), E.rmse(F.col("y"), F.col("base")).alias("rmse_persistence"))


query()(g9_tree_walkforward)


@query(f"WITH {scores._F}, q AS (SELECT macro, quantile_cont(y - p, 0.1) AS a, quantile_cont(y - p, 0.9) AS b FROM f WHERE p IS NOT NULL GROUP BY 1) SELECT {S.secs('ts')} AS ts_s, round(p + a, 6) AS low, round(p + b, 6) AS high FROM f JOIN q USING (macro) WHERE p IS NOT NULL")
def g17_residual_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant band of residual quantiles around the forecast."""
    f = scores.forecasts(spark, sf_dir).where("p IS NOT NULL")
    got = M.residual_band(f.select("macro", "y", "p"), f.select("ts", "macro", "p"), (0.1, 0.9), "macro")
    return got.select(S.ts_s(), F.round(F.get("band", F.lit(0)), 6).alias("low"), F.round(F.get("band", F.lit(1)), 6).alias("high"))


@query(f"WITH {S.H}, x AS (SELECT CAST(ts AS DATE) AS block, unnest([{{'c': 'price', 'v': price}}, {{'c': 'solar', 'v': solar}}, {{'c': 'flag', 'v': CASE WHEN day(ts) % 2 = 0 THEN 1.0 ELSE (hour(ts) % 2)::DOUBLE END}}]) AS u FROM h) SELECT block, u.c AS \"column\" FROM x GROUP BY 1, 2 HAVING stddev_pop(u.v) > 0")
def g18_varying_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that vary in each block."""
    h = S.hourly(spark, sf_dir).select(F.to_date("ts").alias("block"), "price", "solar", F.when(F.dayofmonth("ts") % 2 == 0, 1.0).otherwise((F.hour("ts") % 2).cast("double")).alias("flag"))
    return M.varying(h, ["price", "solar", "flag"], "block")


@query(f"""WITH {S.H}, s AS (SELECT ts, load_forecast AS a, load AS l, wind_on AS w FROM h) SELECT {S.secs("x.ts")} AS ts_s, round(coalesce(x.a, y.l) - coalesce(x.w, 0), 6) AS residual, x.a IS NULL AND y.l IS NOT NULL AS patched FROM s x LEFT JOIN s y ON y.ts = x.ts - INTERVAL 168 HOUR WHERE coalesce(x.a, y.l) IS NOT NULL""")
def h3_patched_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: residual load where a missing forecast takes the load of the week before."""
    h = S.hourly(spark, sf_dir)
    patch = h.select((F.col("ts") + tg.hours(168)).cast("timestamp_ntz").alias("ts"), F.col("load").alias("_l"))
    got = h.join(patch, "ts", "left").where("coalesce(load_forecast, _l) IS NOT NULL")
    return got.select(S.ts_s(), F.round(F.coalesce("load_forecast", "_l") - F.coalesce("wind_on", F.lit(0.0)), 6).alias("residual"), (F.col("load_forecast").isNull() & F.col("_l").isNotNull()).alias("patched"))


@query(f"""WITH {S.H}, {scores._F.split('f AS (SELECT *')[0].removeprefix(S.H + ', ').rstrip().rstrip(',')}, g AS (SELECT day, count(*) FILTER (solar IS NULL) AS missing FROM f0 GROUP BY 1)
    SELECT {S.secs("ts")} AS ts_s, f0.day, coalesce(round(CASE WHEN missing BETWEEN 1 AND 4 AND solar IS NULL THEN p ELSE solar END, 6), -1) AS value FROM f0 JOIN g ON g.day = f0.day""")
def h8_h9_partial_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8, H9: on days with up to four missing hours these take the persistence value; other days stay."""
    f = scores.forecasts(spark, sf_dir)
    missing = f.groupBy("day").agg(F.count_if(F.col("solar").isNull()).alias("missing"))
    plans = missing.select("day", F.when(F.col("missing").between(1, 4), "partial").otherwise("none").alias("plan"))
    got = L.fill_planned(f.select("ts", "day", "solar"), "solar", plans, f.select("ts", "p"))
    return got.select(S.ts_s(), "day", F.coalesce(F.round("value", 6), F.lit(-1.0)).alias("value"))


@query(f"""WITH {stores._PAIRS}, pl AS ({stores._pool('rs', 1, 7)}), l AS (SELECT target, unnest([0.1, 0.9]) AS level, r FROM pl), s AS (SELECT target, level, list(r ORDER BY r) AS s FROM l GROUP BY 1, 2 HAVING count(*) >= 72),
    c AS (SELECT f.ts, f.day, f.y, level, p + s[CAST(least(greatest(ceil((len(s) + 1) * level), 1), len(s)) AS INTEGER)] AS q FROM f JOIN s ON s.target = f.day WHERE p IS NOT NULL)
    SELECT level, count(*) AS n, round(avg((y <= q)::INT), 6) AS coverage, round(avg(greatest(level * (y - q), (level - 1) * (y - q))), 6) AS pinball FROM c GROUP BY 1""")
def j21_j42_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts shifted, without a scale, by order statistics of past residuals, and how well they then cover."""
    f = scores.forecasts(spark, sf_dir).where("p IS NOT NULL")
    r, days = stores.residuals(spark, sf_dir), stores._days(spark, sf_dir)
    out = None
    for level in (0.1, 0.9):
        s = K.shift(r, days, "r", level, 7).where("n >= 72").select(F.col("target").alias("day"), "shift")
        one = f.join(s, "day").select("y", F.lit(level).alias("level"), (F.col("p") + F.col("shift")).alias("q"))
        out = one if out is None else out.unionByName(one)
    return scores.rounded(E.quantile_scores(out), "level", "n").select("level", "n", "coverage", "pinball")


@query(f"""WITH {scores._F}, b AS (SELECT ts, day, p + CASE WHEN day(day) % 9 = 0 AND hour(ts) = 4 THEN 1 ELSE 0 END AS p FROM f WHERE hour(ts) <> 3 OR day(day) % 7 <> 0)
    SELECT f.day, count(*) AS matched, count(*) FILTER ((f.p IS NULL) <> (b.p IS NULL)) AS null_mismatch, round(coalesce(max(abs(f.p - b.p)), 0), 6) AS most, coalesce(max(abs(f.p - b.p)), 0) > 0.001 AS over FROM f JOIN b ON b.ts = f.ts GROUP BY 1""")
def j36_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored forecast against one made again, by day."""
    f = scores.forecasts(spark, sf_dir).select("ts", "day", "p")
    d, h = F.dayofmonth("day"), F.hour("ts")
    again = f.where((h != 3) | (d % 7 != 0)).select("ts", (F.col("p") + F.when((d % 9 == 0) & (h == 4), 1).otherwise(0)).alias("q"))
    gap = F.coalesce(F.max(F.abs(F.col("p") - F.col("q"))), F.lit(0.0))
    return f.join(again, "ts").groupBy("day").agg(F.count("*").alias("matched"), F.count_if(F.col("p").isNull() != F.col("q").isNull()).alias("null_mismatch"), F.round(gap, 6).alias("most"), (gap > 0.001).alias("over"))


@query("""WITH x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice / 1000 AS y FROM orders), d AS (SELECT day, sum(y) AS s, count(*) AS n FROM x GROUP BY 1), a AS (SELECT min(day) AS a FROM d), f AS (SELECT day AS fold_day FROM d, a WHERE day - 28 >= a),
    t AS (SELECT fold_day, day, s, n, row_number() OVER (PARTITION BY fold_day ORDER BY day DESC) AS last, row_number() OVER (PARTITION BY fold_day ORDER BY md5(day::VARCHAR)) AS any_ FROM f JOIN d ON day >= fold_day - 28 AND day < fold_day)
    SELECT fold_day, k, how, round(sum(s) / sum(n) + 1e-8, 5) AS mean FROM t, (VALUES (0), (7)) v(k), (VALUES ('edge'), ('random')) w(how) WHERE CASE how WHEN 'edge' THEN last ELSE any_ END > k GROUP BY 1, 2, 3""")
def j37_training_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's mean with seven days left out, the last or any by a hash."""
    from pyspark.sql import Window

    o = _orders(spark, sf_dir).groupBy("day").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    t = B.train_rows(B.folds(o.select("day"), 28), o, 28)
    rank = lambda c: F.row_number().over(Window.partitionBy("fold_day").orderBy(c))  # noqa: E731  28 rows each
    t = t.withColumns({"edge": rank(F.desc("day")), "random": rank(F.md5(F.col("day").cast("string")))})
    arms = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(h).alias("how")) for k in (0, 7) for h in ("edge", "random")])).alias("arm")
    rows = t.select("*", arms).select("*", "arm.*").where(F.when(F.col("how") == "edge", F.col("edge")).otherwise(F.col("random")) > F.col("k"))
    return rows.groupBy("fold_day", "k", "how").agg(F.round(F.sum("s") / F.sum("n") + 1e-8, 5).alias("mean"))


@query(f"""WITH {scores._F}, s AS (SELECT unnest([0, 2, 6]) AS h), r AS (SELECT ts, day, y, p, row_number() OVER (PARTITION BY day ORDER BY ts DESC) AS last FROM f WHERE p IS NOT NULL)
    SELECT h, arm, count(*) AS n, round(avg(abs(y - CASE WHEN last > h THEN p WHEN arm = 'constant' THEN 50 ELSE p + 5 END)), 6) AS mae FROM r, s, (VALUES ('constant'), ('shifted'), ('silence')) a(arm) WHERE arm <> 'silence' OR last > h GROUP BY 1, 2""")
def j38_j41_target_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios that blank the last hours of a day, and what each arm makes of them."""
    from pyspark.sql import Window

    f = scores.forecasts(spark, sf_dir).where("p IS NOT NULL").withColumn("last", F.row_number().over(Window.partitionBy("day").orderBy(F.desc("ts"))))
    arms = F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(a).alias("arm")) for h in (0, 2, 6) for a in ("constant", "shifted", "silence")])).alias("s")
    rows = f.select("*", arms).select("*", "s.*").where((F.col("arm") != "silence") | (F.col("last") > F.col("h")))
    p = F.when(F.col("last") > F.col("h"), F.col("p")).when(F.col("arm") == "constant", F.lit(50.0)).otherwise(F.col("p") + 5)
    return rows.groupBy("h", "arm").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("y") - p)), 6).alias("mae"))


@query(f"""WITH {stores._W}, v AS (SELECT run, variable, count(*) AS n, count(DISTINCT valid) AS hours FROM w WHERE variable <> 'radiation' GROUP BY 1, 2) SELECT CAST(run AS DATE) AS run_day, variable, n, hours, hours < 24 AS thin FROM v""")
def i9_run_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings and hours of each run and variable, radiation apart."""
    w = stores.weather(spark, sf_dir).where("variable <> 'radiation'")
    got = w.groupBy(F.to_date("run").alias("run_day"), "variable").agg(F.count("*").alias("n"), F.count_distinct("valid").alias("hours"))
    return got.withColumn("thin", F.col("hours") < 24)


@query(f"WITH {S.H}, n AS (SELECT {S.day_of('ts')} AS day, count(*) FILTER (load IS NOT NULL) AS n, count(*) FILTER (wind_on IS NOT NULL) AS w FROM h GROUP BY 1) SELECT day, n = {_DAYLEN} AS load_complete, w > 0 AS run_there, year(day) BETWEEN 2020 AND 2030 AS holidays_known FROM n")
def i8_i23_day_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates of a day: its load whole, a run there, its holidays known."""
    want = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 60)
    n = S.hourly(spark, sf_dir).groupBy(tg.local_day(F.col("ts")).alias("day")).agg(F.count("load").alias("n"), F.count("wind_on").alias("w"))
    return n.select("day", (F.col("n") == want).alias("load_complete"), (F.col("w") > 0).alias("run_there"), F.year("day").between(2020, 2030).alias("holidays_known"))


def sun_over_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, region, elevation) at the centroid of each region."""
    at = w4_w6_regions(spark, sf_dir).select("region", "lat", "lon")
    rows = S.hourly(spark, sf_dir).select("ts").join(F.broadcast(at), F.lit(True))
    return rows.select("ts", "region", solar.position(F.col("ts"), F.col("lat"), F.col("lon"))[0].alias("elevation"))
