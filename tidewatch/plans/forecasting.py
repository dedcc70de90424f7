"""Queries of baselines, shapes, folds (G) and of the fallback ladder (H)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import ladder as L
from tidewatch.operators import models as M
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

_K = f"CAST({S.local('ts')} AS DATE) AS day, hour({S.local('ts')}) AS hour, minute(ts) AS minute"


@query(f"""WITH {S.H}, t AS (SELECT ts + to_hours(k) AS ts, k, price FROM h, (VALUES (24), (168)) v(k))
    SELECT {S.secs("ts")} AS ts_s, round(price, 6) AS p FROM t WHERE k = CASE WHEN isodow({S.local("ts")}) BETWEEN 2 AND 5 THEN 24 ELSE 168 END""")
def g1_similar_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: a day back within the week, else a week back."""
    return B.similar_day(S.hourly(spark, sf_dir), "price").select(S.ts_s(), F.round("p", 6).alias("p"))


@query(f"""WITH {S.Q}, k AS (SELECT ts, price, {_K} FROM q), s AS (SELECT day + 1 AS day, hour, minute, arg_min(price, ts) AS p FROM k GROUP BY ALL),
    f AS (SELECT k.ts, k.day, s.p FROM k LEFT JOIN s USING (day, hour, minute)), w AS (SELECT day FROM f GROUP BY day HAVING count(p) >= 80)
    SELECT {S.secs("ts")} AS ts_s, day, round(p, 6) AS p FROM f WHERE day IN (SELECT day FROM w)""")
def g2_quarter_hour_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter hour a day before by the clock, on days with at least 80 of them."""
    q = S.quarterly(spark, sf_dir)
    f = B.persistence(q, "price", q.select("ts"))
    full = f.groupBy("day").agg(F.count("p").alias("n")).where("n >= 80").select("day")
    return f.join(full, "day", "left_semi").select(S.ts_s(), "day", F.round("p", 6).alias("p"))


@query(f"""WITH {S.H}, k AS (SELECT ts, price, {_K} FROM h), n AS (SELECT day, hour, minute, count(*) AS n, min(price) AS p FROM k GROUP BY ALL)
    SELECT {S.secs("ts")} AS ts_s, CASE WHEN a.n = 1 AND b.n = 1 THEN round(b.p, 6) END AS p, CASE WHEN a.n > 1 OR coalesce(b.n, 1) > 1 THEN 'ambiguous' WHEN b.n IS NULL THEN 'absent' ELSE 'plain' END AS clock
    FROM k JOIN n a USING (day, hour, minute) LEFT JOIN n b ON b.day = k.day - 1 AND b.hour = k.hour AND b.minute = k.minute""")
def g4_clock_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence that is undefined where the clock changes."""
    return B.clock_persistence(S.hourly(spark, sf_dir), "price").select(S.ts_s(), F.round("p", 6).alias("p"), "clock")


@query(f"""WITH {S.Q}, k AS (SELECT price, {_K} FROM q), d AS (SELECT day + CAST(o AS INTEGER) AS day, hour, minute, price FROM k, range(1, 11) r(o))
    SELECT day, hour, minute, count(*) AS n, round(quantile_cont(price, 0.1), 6) AS q10, round(quantile_cont(price, 0.5), 6) AS q50, round(quantile_cont(price, 0.9), 6) AS q90 FROM d GROUP BY 1, 2, 3""")
def g5_slot_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a slot over ten days."""
    got = B.slot_quantiles(S.quarterly(spark, sf_dir), "price", (0.1, 0.5, 0.9))
    return got.select("day", "hour", "minute", "n", *[F.round(F.get("q", F.lit(i)), 6).alias(c) for i, c in enumerate(("q10", "q50", "q90"))])


_SHAPE = f"""{S.Q}, k AS (SELECT date_trunc('hour', ts) AS hr, price, {_K} FROM q), m AS (SELECT hr, avg(price) AS m FROM k GROUP BY 1 HAVING count(*) = 4),
    v AS (SELECT day + CAST(o AS INTEGER) AS day, hour, minute // 15 AS quarter, price - m AS dev FROM k JOIN m USING (hr), range(1, 8) r(o)),
    c AS (SELECT day, hour, quarter, avg(dev) AS delta, count(*) AS n FROM v GROUP BY 1, 2, 3), l AS (SELECT day, hour, avg(delta) AS mm FROM c GROUP BY 1, 2 HAVING min(n) >= 3 AND count(*) = 4),
    s AS (SELECT day, hour, quarter, delta - mm AS delta, n FROM c JOIN l USING (day, hour))"""


@query(f"WITH {_SHAPE} SELECT day, hour, quarter, round(delta + 1e-7, 4) AS delta, n FROM s")
def g6_shape_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean deviation of quarter hours over the week before."""
    got = B.shape_profile(S.quarterly(spark, sf_dir), "price")
    return got.select("day", "hour", "quarter", F.round(F.col("delta") + 1e-7, 4).alias("delta"), "n")


@query(f"""WITH {S.H}, {_SHAPE}, e AS (SELECT ts + to_minutes(15 * CAST(k AS INTEGER)) AS ts, price, {S.day_of("ts")} AS day, hour({S.local("ts")}) AS hour, k AS quarter FROM h, range(4) r(k))
    SELECT {S.secs("ts")} AS ts_s, round(price + coalesce(delta, 0) + 1e-7, 4) AS p FROM e LEFT JOIN s USING (day, hour, quarter)""")
def g7_expand_quarterhour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly values as quarter hours with the shape of the week before."""
    return B.expand(S.hourly(spark, sf_dir), "price", B.shape_profile(S.quarterly(spark, sf_dir), "price")).select(S.ts_s(), F.round(F.col("p") + 1e-7, 4).alias("p"))


def _folds(frm: str, more: str) -> str:
    return f"WITH {S.D}, a AS (SELECT min(day) AS a FROM d) SELECT day AS fold_day, {frm} AS train_from, day - 1 AS train_to, {S.secs(S.utc('day - 1') + ' + INTERVAL 12 HOUR')} AS gate_s FROM d, a WHERE {more}"


@query(_folds("day - 90", "day - 90 >= a"))
def g10_rolling_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fold a day over the 90 days before."""
    return B.folds(S.days(spark, sf_dir), 90).select("fold_day", "train_from", "train_to", tg.seconds(F.col("gate")).alias("gate_s"))


@query(_folds("a", "day > a"))
def g10_expanding_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fold a day over all days before."""
    return B.folds(S.days(spark, sf_dir), None).select("fold_day", "train_from", "train_to", tg.seconds(F.col("gate")).alias("gate_s"))


@query("""WITH x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x FROM orders), f AS (SELECT DISTINCT day AS fold_day FROM x), a AS (SELECT min(day) AS a FROM x)
    SELECT fold_day, count(*) AS n, round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 2) AS intercept FROM f JOIN x ON x.day >= fold_day - 14 AND x.day < fold_day, a WHERE fold_day - 14 >= a GROUP BY 1""")
def g11_linear_walkforward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear fit for each day on the fortnight before, from daily moments; no order is copied to folds."""
    o = S.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("y"), F.col("o_custkey").cast("double").alias("x"))
    got = M.line_walkforward(o, B.folds(o.select("day").distinct(), 14), "x", "y", 14)
    return got.select("fold_day", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


#: Days that lack some orders count as incomplete.
_COMPLETE = "c AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders GROUP BY 1 HAVING count(*) >= 5)"
_HOL = "strftime({0}, '%m-%d') IN ('01-01', '05-01', '10-03', '12-25', '12-26') OR ({0} - {1}) IN (-2, 1, 39, 50)"


def _reference_sql() -> str:
    from tidewatch.plans.calendar import _EASTER

    easter = _EASTER.replace("FROM d))", "FROM (SELECT day FROM d UNION ALL SELECT day - 60 FROM d)))")
    hol = _HOL.format("day", "easter")
    return f"""WITH {S.D}, {easter}, {_COMPLETE}, x AS (SELECT day, {hol} AS hol, day - CAST(isodow(day) AS INTEGER) AS sunday FROM d JOIN e ON e.y = year(day)),
    r AS (SELECT day, hol, CAST(k AS INTEGER) AS rank, CASE WHEN k = 0 THEN CASE WHEN hol THEN sunday WHEN isodow(day) BETWEEN 2 AND 5 THEN day - 1 ELSE day - 7 END WHEN hol THEN sunday - 7 * CAST(k AS INTEGER) ELSE day - 7 * CAST(k AS INTEGER) END AS cand FROM x, range(5) q(k)),
    u AS (SELECT r.day, rank, cand FROM r JOIN c ON c.day = cand JOIN e ON e.y = year(cand) WHERE r.hol OR NOT ({_HOL.format("cand", "easter")}))
    SELECT d.day, arg_min(cand, rank) AS reference, coalesce(min(rank), 5) AS skipped FROM d LEFT JOIN u ON u.day = d.day GROUP BY d.day"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return L.choose_reference_day(S.days(spark, sf_dir), o.where("n >= 5").select("day"))


@query(_reference_sql())
def h1_reference_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: the day whose load stands for a missing one, and how many candidates were skipped."""
    return _pairs(spark, sf_dir)


_PAIR = f"p AS (SELECT DISTINCT {S.day_of('ts')} AS day, {S.day_of('ts')} - 7 AS reference FROM h)"


@query(f"""WITH {S.H}, {_PAIR}, s AS (SELECT {S.day_of("ts")} AS reference, hour({S.local("ts")}) AS hour, arg_min(load, ts) AS v FROM h GROUP BY ALL),
    g AS (SELECT day, reference, unnest(generate_series({S.utc("day")}, {S.utc("day + 1")} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM p)
    SELECT {S.secs("g.ts")} AS ts_s, day, round(s.v, 6) AS value FROM g LEFT JOIN s ON s.reference = g.reference AND s.hour = hour({S.local("g.ts")})""")
def h2_load_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2, H4: each day's load from the week before by the clock."""
    h = S.hourly(spark, sf_dir)
    pairs = h.select(tg.local_day(F.col("ts")).alias("day")).distinct().withColumn("reference", F.date_sub("day", 7))
    return L.patched(h.where("load IS NOT NULL OR load IS NULL"), "load", pairs).select(S.ts_s(), "day", F.round("value", 6).alias("value"))


@query(f"""WITH {S.H}, x AS (SELECT {S.day_of("ts")} AS day, load - coalesce(load_forecast, 0) AS d FROM h WHERE load IS NOT NULL), t AS (SELECT DISTINCT day FROM x)
    SELECT t.day, count(*) AS n, round(quantile_cont(d, 0.5), 6) AS shift FROM t JOIN x ON x.day BETWEEN t.day - 14 AND t.day - 1 GROUP BY 1""")
def h5_rolling_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: median difference of two sources over the fortnight before."""
    x = S.hourly(spark, sf_dir).where("load IS NOT NULL").select(tg.local_day(F.col("ts")).alias("day"), (F.col("load") - F.coalesce("load_forecast", F.lit(0.0))).alias("d"))
    dealt = x.select(F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", 14))).alias("day"), "d")
    return dealt.join(x.select("day").distinct(), "day", "left_semi").groupBy("day").agg(F.count("*").alias("n"), F.round(F.percentile("d", 0.5), 6).alias("shift"))


#: candidate, rank, group, column, policy, hours.
POLICIES = [("full", 1, "load", "load_forecast", "fill", 2), ("full", 1, "sun", "solar", "strict", 0), ("core", 2, "load", "load_forecast", "partial", 4), ("core", 2, "wind", "wind_on", "fill", 3), ("floor", 3, "price", "price", "strict", 0)]
_POL = "pol AS (SELECT * FROM (VALUES " + ", ".join(map(str, POLICIES)) + ") v(candidate, rank, grp, col, policy, lim))"
_LONG = "x AS (" + " UNION ALL ".join(f"SELECT {S.day_of('ts')} AS day, hour({S.local('ts')}) AS hour, '{c}' AS col, {c} AS value FROM h" for c in ("load_forecast", "solar", "wind_on", "price")) + ")"
_PLAN = f"""{S.H}, {_POL}, {_LONG}, m AS (SELECT day, candidate, rank, grp, policy, lim, count(DISTINCT CASE WHEN value IS NULL THEN hour END) AS missing FROM x JOIN pol USING (col) GROUP BY ALL),
    g AS (SELECT day, candidate, rank, grp, missing, CASE WHEN missing = 0 THEN 'none' WHEN policy = 'strict' OR missing > lim THEN 'fail' ELSE policy END AS plan FROM m)"""


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = S.hourly(spark, sf_dir).withColumns({"day": tg.local_day(F.col("ts")), "hour": F.hour(tg.local(F.col("ts")))})
    rows = h.unpivot(["day", "hour"], ["load_forecast", "solar", "wind_on", "price"], "column", "value")
    pol = spark.createDataFrame([(c, g, x, p, n) for c, _, g, x, p, n in POLICIES], "candidate string, group string, column string, policy string, limit int")
    return L.gap_plan(rows, pol)


@query(f"WITH {_PLAN} SELECT day, candidate, grp AS \"group\", missing, plan FROM g")
def h6_h7_gap_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6, H7: what each candidate does about each group's missing hours."""
    return _plans(spark, sf_dir)


@query(f"""WITH {_PLAN}, c AS (SELECT day, candidate, rank, bool_and(plan <> 'fail') AS ok, string_agg(CASE WHEN plan = 'fail' THEN grp END, '+' ORDER BY grp) AS why FROM g GROUP BY 1, 2, 3),
    b AS (SELECT day, min(rank) FILTER (ok) AS rank, arg_min(candidate, rank) FILTER (ok) AS candidate FROM c GROUP BY 1)
    SELECT b.day, b.candidate, b.rank, coalesce(string_agg(c.candidate || ':' || c.why, ';' ORDER BY c.rank) FILTER (NOT c.ok AND (b.rank IS NULL OR c.rank < b.rank)), '') AS reasons FROM b JOIN c ON c.day = b.day GROUP BY 1, 2, 3""")
def h10_first_viable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate that can run on each day, and why those before it can't."""
    ranks = spark.createDataFrame(sorted({(c, r) for c, r, *_ in POLICIES}), "candidate string, rank int")
    return L.first_viable(_plans(spark, sf_dir), ranks)


_RUNS = "r AS (SELECT user_id AS target, ts, event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS rank, value > 20 AS accepted FROM events)"


@query(f"""WITH {_RUNS}, b AS (SELECT *, min(CASE WHEN accepted THEN rank END) OVER (PARTITION BY target ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM r)
    SELECT event_id, target, rank, coalesce(best_before, 0) AS best_before, coalesce(rank <= best_before, true) AS may_submit FROM b""")
def h11_best_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run may replace an accepted one only if it ranks no worse."""
    rank = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "purchase", 3).otherwise(4)
    e = S.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("target"), F.struct("ts", "event_id").alias("run_ts"), rank.alias("rank"), (F.col("value") > 20).alias("accepted"))
    return L.best_accepted(e).select("event_id", "target", "rank", F.coalesce("best_before", F.lit(0)).alias("best_before"), "may_submit")


@query(f"WITH {_RUNS} SELECT target, arg_max(rank, (ts, event_id)) FILTER (accepted) AS last_rank, count(*) FILTER (accepted) AS n FROM r GROUP BY 1")
def h12_last_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate accepted last for each target."""
    rank = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "purchase", 3).otherwise(4)
    e = S.table(spark, sf_dir, "events").where("value > 20").groupBy(F.col("user_id").alias("target")).agg(F.max_by(rank, F.struct("ts", "event_id")).alias("last_rank"), F.count("*").alias("n"))
    every = S.table(spark, sf_dir, "events").select(F.col("user_id").alias("target")).distinct()
    return every.join(e, "target", "left").select("target", "last_rank", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
