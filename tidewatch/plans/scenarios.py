"""Queries of gap, outage, reconstruction and second-series experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import linear as L
from tidewatch.operators import scenarios as X
from tidewatch.plans import forecasting
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

TRAIN = 7


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, day, y, a, b, c): price, a forecast and an actual load with nulls, and the price a day before."""
    h = S.hourly(spark, sf_dir)
    back = h.select((F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("ts"), F.col("price").alias("c"))
    return h.select("ts", tg.local_day(F.col("ts")).alias("day"), F.col("price").alias("y"), F.col("load_forecast").alias("a"), F.col("load").alias("b")).join(back, "ts", "left")


_X = f"""{S.H}, x AS (SELECT h.ts, {S.day_of("h.ts")} AS day, h.price AS y, h.load_forecast AS a, h.load AS b, l.price AS c FROM h LEFT JOIN h l ON l.ts = h.ts - INTERVAL 24 HOUR),
    fd AS (SELECT DISTINCT day AS fold_day FROM x WHERE day - {TRAIN} >= (SELECT min(day) FROM x))"""


def _fit(name: str, columns: str, source: str = "x", last: int = 1) -> str:
    """{name}(fold_day, m1, m2, i, s1, s2): medians and least squares on one or two imputed columns of the week before."""
    one, two = columns[0], columns[1] if len(columns) > 1 else None
    second = f"coalesce(median({two}), 0)" if two else "0"
    xb = f"coalesce({two}, m2)" if two else "0"
    w = f"(SELECT fold_day, x.* FROM fd JOIN {source} x ON x.day >= fold_day - {TRAIN} AND x.day <= fold_day - {last} AND y IS NOT NULL)"
    return f"""{name}_s AS (SELECT fold_day, any_value(m1) AS m1, any_value(m2) AS m2, avg(y) AS my, avg(p) AS mp, avg(q) AS mq, var_pop(p) AS vp, var_pop(q) AS vq, covar_pop(p, q) AS pq, covar_pop(p, y) AS py, covar_pop(q, y) AS qy
        FROM (SELECT w.*, m.m1, m.m2, coalesce({one}, m1) AS p, {xb}::DOUBLE AS q FROM {w} w JOIN (SELECT fold_day, coalesce(median({one}), 0) AS m1, {second} AS m2 FROM {w} GROUP BY 1) m USING (fold_day)) GROUP BY 1),
    {name}_b AS (SELECT *, {"(vq * py - pq * qy) / (vp * vq - pq * pq)" if two else "coalesce(py / nullif(vp, 0), 0)"} AS s1, {"(vp * qy - pq * py) / (vp * vq - pq * pq)" if two else "0"} AS s2 FROM {name}_s), {name} AS (SELECT fold_day, m1, m2, s1, s2, my - s1 * mp - s2 * mq AS i FROM {name}_b)"""


def _fits(spark: SparkSession, sf_dir: str, features: list[str]) -> DataFrame:
    x = rows(spark, sf_dir)
    return L.fitted(x, B.folds(x.select("day").distinct(), TRAIN), features, "y", TRAIN, {"ols": None})


GAPS = [X.Gap("forecast", ("a",), 3), X.Gap("forecast", ("a",), 6), X.Gap("both", ("a", "b"), 6)]
_LEFT = f"(epoch({S.utc('day + 1')}) - epoch(ts)) / 3600"
_GAPS = f"g(scenario, cols, hours) AS (VALUES {', '.join(f'''('{g.scenario}', {list(g.columns)}, {g.hours})''' for g in GAPS)})"


@query(f"""WITH {_X}, {forecasting._SHAPE}, {_fit("be", "ab")}, {_GAPS},
    cu AS (SELECT ts, day, scenario, hours, {_LEFT} <= hours AS gone, CASE WHEN NOT ({_LEFT} <= hours AND list_contains(cols, 'a')) THEN a END AS a, CASE WHEN NOT ({_LEFT} <= hours AND list_contains(cols, 'b')) THEN b END AS b FROM x, g),
    ca AS (SELECT *, last_value(a IGNORE NULLS) OVER w AS fa, last_value(b IGNORE NULLS) OVER w AS fb FROM cu WINDOW w AS (PARTITION BY scenario, hours, day ORDER BY ts ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT ca.*, i + s1 * coalesce(fa, m1) + s2 * coalesce(fb, m2) AS pf, i + s1 * coalesce(a, m1) + s2 * coalesce(b, m2) AS pb FROM ca JOIN be ON fold_day = day),
    qh AS (SELECT p.scenario, p.hours, p.day, p.ts + to_minutes(15 * CAST(z.k AS INTEGER)) AS ts, gone, pf + coalesce(delta, 0) AS pf, pb + coalesce(delta, 0) AS pb FROM p, range(4) z(k) LEFT JOIN s ON s.day = p.day AND s.hour = hour({S.local("p.ts")}) AND s.quarter = z.k),
    ar AS (SELECT scenario, hours, qh.day, q.price AS y, unnest([{{'a': 'fill', 'p': pf}}, {{'a': 'partial', 'p': CASE WHEN gone THEN l.price ELSE pb END}}, {{'a': 'silence', 'p': l.price}}]) AS u FROM qh JOIN q ON q.ts = qh.ts JOIN q l ON l.ts = qh.ts - INTERVAL 24 HOUR),
    sm AS (SELECT scenario, hours, u.a AS arm, count(*) AS n, count(DISTINCT day) AS days, avg(abs(y - u.p)) AS mae FROM ar GROUP BY 1, 2, 3)
    SELECT scenario, hours::INTEGER AS hours, arm, n, days, round(mae, 6) AS mae, mae = min(mae) OVER (PARTITION BY scenario, hours) AS best FROM sm""")
def j38_gap_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hours of a day without inputs, filled, partly replaced by persistence or left to persistence, by a model refitted each day and bridged to quarter hours."""
    q = S.quarterly(spark, sf_dir)
    base = q.select((F.col("ts") + tg.hours(24)).cast("timestamp_ntz").alias("ts"), F.col("price").alias("base"))
    got = X.gap_arms(rows(spark, sf_dir), _fits(spark, sf_dir, ["a", "b"]), ["a", "b"], GAPS, q.select("ts", F.col("price").alias("y")), base, B.shape_profile(q, "price"))
    m = got.groupBy("scenario", "hours", "arm").agg(F.count("*").alias("n"), F.count_distinct("day").alias("days"), F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"))
    best = F.min("mae").over(Window.partitionBy("scenario", "hours"))  # three arms each
    return m.select("scenario", "hours", "arm", "n", "days", F.round("mae", 6).alias("mae"), (F.col("mae") == best).alias("best"))


OUTAGES = [X.Gap("none", (), 0), X.Gap("forecast gone", ("a",), 25), X.Gap("loads gone", ("a", "b"), 25), X.Gap("forecast late", ("a",), 2), X.Gap("all gone", ("a", "b", "c"), 25)]
EXPECTED = {"none": "full", "forecast late": "full", "forecast gone": "actual", "loads gone": "price", "all gone": "none"}
#: Candidate, rank, group, column, policy, hours that it bears.
POLICIES = [("full", 1, "forecast", "a", "fill", 8), ("full", 1, "load", "b", "fill", 8), ("actual", 2, "load", "b", "fill", 8), ("price", 3, "price", "c", "strict", 0)]
_OUT = f"g(scenario, cols, hours, expected) AS (VALUES {', '.join(f'''('{g.scenario}', {list(g.columns)}::VARCHAR[], {g.hours}, '{EXPECTED[g.scenario]}')''' for g in OUTAGES)})"
_POL = f"po(candidate, rank, grp, col, policy, lim) AS (VALUES {', '.join(map(repr, POLICIES))})"


@query(f"""WITH {_X}, {_fit("bf", "ab")}, {_fit("ba", "b")}, {_fit("bp", "c")}, {_OUT}, {_POL},
    cu AS (SELECT ts, day, y, scenario, expected, CASE WHEN NOT ({_LEFT} <= hours AND list_contains(cols, 'a')) THEN a END AS a, CASE WHEN NOT ({_LEFT} <= hours AND list_contains(cols, 'b')) THEN b END AS b, CASE WHEN NOT ({_LEFT} <= hours AND list_contains(cols, 'c')) THEN c END AS c FROM x, g),
    ms AS (SELECT scenario, day, candidate, rank, policy, lim, count(DISTINCT hour({S.local("ts")})) FILTER (CASE col WHEN 'a' THEN a WHEN 'b' THEN b ELSE c END IS NULL) AS missing FROM cu, po GROUP BY scenario, day, candidate, rank, grp, policy, lim),
    ok AS (SELECT scenario, day, candidate, rank, bool_and(missing = 0 OR (policy <> 'strict' AND missing <= lim)) AS ok FROM ms GROUP BY 1, 2, 3, 4),
    ch AS (SELECT scenario, day, coalesce(arg_min(candidate, rank) FILTER (ok), 'none') AS candidate FROM ok GROUP BY 1, 2),
    e AS (SELECT cu.scenario, abs(y - CASE candidate WHEN 'full' THEN bf.i + bf.s1 * coalesce(a, bf.m1) + bf.s2 * coalesce(b, bf.m2) WHEN 'actual' THEN ba.i + ba.s1 * coalesce(b, ba.m1) WHEN 'price' THEN bp.i + bp.s1 * coalesce(c, bp.m1) END) AS e FROM cu JOIN ch USING (scenario, day) JOIN bf ON bf.fold_day = day JOIN ba ON ba.fold_day = day JOIN bp ON bp.fold_day = day),
    er AS (SELECT scenario, count(e) AS n, avg(e) AS mae FROM e GROUP BY 1), w AS (SELECT scenario, candidate, count(*) AS k FROM ch GROUP BY 1, 2)
    SELECT g.scenario, expected, (SELECT arg_min(candidate, (-k, candidate)) FROM w WHERE w.scenario = g.scenario) AS winner, (SELECT count(*) FROM ch WHERE ch.scenario = g.scenario) AS days, (SELECT count(*) FROM ch WHERE ch.scenario = g.scenario AND candidate = expected) AS as_expected, coalesce(n, 0) AS n, coalesce(round(mae, 6), -1) AS mae FROM g LEFT JOIN er ON er.scenario = g.scenario""")
def j41_outage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs blanked by scenario, the candidate that the ladder then chooses against the one expected, and its error with a fit of its own columns."""
    x = rows(spark, sf_dir)
    policies = spark.createDataFrame([(c, g, col, p, n) for c, _, g, col, p, n in POLICIES], "candidate string, group string, column string, policy string, limit int")
    ranks = spark.createDataFrame(sorted({(c, r) for c, r, *_ in POLICIES}), "candidate string, rank int")
    chosen = X.outages(x, OUTAGES, policies, ranks, ["a", "b", "c"])
    fits = {"full": (_fits(spark, sf_dir, ["a", "b"]), ["a", "b"]), "actual": (_fits(spark, sf_dir, ["b"]), ["b"]), "price": (_fits(spark, sf_dir, ["c"]), ["c"])}
    got = X.outage_table(chosen, x, fits, OUTAGES, EXPECTED)
    return got.select("scenario", "expected", "winner", "days", "as_expected", "n", F.coalesce(F.round("mae", 6), F.lit(-1.0)).alias("mae"))


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir).select("ts", F.col("a").alias("forecast"), F.col("b").alias("actual"))


_K = f"CAST((epoch(ts) - epoch({S.utc('day')})) / 3600 AS BIGINT)"
_VARIANTS = f"""ps AS (SELECT day, {_K} AS k, a, b FROM x), tx AS (SELECT *, {_K} AS k FROM x),
    v(variant, n, col) AS (VALUES ('A', 1, 'a'), ('B', 1, 'b'), ('C', 7, 'a'), ('D', 7, 'b')), rd AS (SELECT d.day, variant, col, CASE WHEN d.day = DATE '2024-01-01' THEN DATE '2023-12-31' WHEN isodow(d.day) BETWEEN 2 AND 5 THEN d.day - n ELSE d.day - 7 END AS ref FROM (SELECT DISTINCT day FROM x) d, v),
    rf AS (SELECT *, CAST((epoch({S.utc("ref + 1")}) - epoch({S.utc("ref")})) / 3600 AS BIGINT) AS slots FROM rd),
    re AS (SELECT rf.variant, tx.ts, tx.day, tx.y, tx.b AS b0, CASE WHEN col = 'a' THEN ps.a ELSE ps.b END AS a FROM tx JOIN rf ON rf.day = tx.day LEFT JOIN ps ON ps.day = rf.ref AND ps.k = least(tx.k, slots - 1))"""


@query(f"""WITH {_X}, {_fit("be", "ab")}, {_VARIANTS}, al AS (SELECT variant, y, i + s1 * coalesce(re.a, m1) + s2 * coalesce(b0, m2) AS p FROM re JOIN be ON fold_day = day UNION ALL SELECT 'real', y, i + s1 * coalesce(a, m1) + s2 * coalesce(b, m2) FROM x JOIN be ON fold_day = day)
    SELECT variant, count(*) AS n, round(avg(abs(y - p)), 6) AS mae FROM al GROUP BY 1""")
def h4_j40_reconstructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants A to D of a reconstructed load fed to the same fits, beside the real one."""
    x = rows(spark, sf_dir)
    patches = X.reconstructions(_series(spark, sf_dir), x.select("day").distinct()).where("variant <> 'FINAL'")
    fed = X.counterfactual(x, patches, "a").unionByName(x.withColumn("variant", F.lit("real")))
    return X.scored(fed, _fits(spark, sf_dir, ["a", "b"]), ["a", "b"], ["variant"]).select("variant", "n", F.round("mae", 6).alias("mae"))


@query(f"""WITH {_X}, {_VARIANTS}, al AS (SELECT variant, ts, a, b0 AS b FROM re UNION ALL SELECT 'real', ts, a, b FROM x), u AS (SELECT variant, unnest([{{'c': 'a', 'm': al.a IS DISTINCT FROM x.a}}, {{'c': 'b', 'm': al.b IS DISTINCT FROM x.b}}, {{'c': 'c', 'm': false}}]) AS u FROM al JOIN x ON x.ts = al.ts)
    SELECT variant, u.c AS "column", count(*) AS n, count(*) FILTER (u.m) AS moved FROM u GROUP BY 1, 2""")
def j40_mechanism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns each reconstruction moves; the real load fed through the same patch moves none."""
    x = rows(spark, sf_dir)
    patches = X.reconstructions(_series(spark, sf_dir), x.select("day").distinct()).where("variant <> 'FINAL'")
    real = x.select(F.lit("real").alias("variant"), "ts", "day", F.col("a").alias("value"))
    return X.moved_columns(x, X.counterfactual(x, patches.unionByName(real), "a"), ["a", "b", "c"])


@query(f"""WITH {_X}, sx AS (SELECT ts, day, y, b AS a FROM x), {_fit("bo", "a")}, {_fit("bs", "a", "sx")}, {_fit("bg", "a", last=3)},
    o AS (SELECT fold_day, coalesce(median(a - b) FILTER (day < fold_day), 0) AS o1, coalesce(median(a - b) FILTER (day < fold_day - 2), 0) AS o2 FROM fd JOIN x ON day >= fold_day - {TRAIN} AND day < fold_day GROUP BY 1),
    ar AS (SELECT day, y, unnest([{{'a': 'own', 'p': bo.i + bo.s1 * coalesce(x.a, bo.m1)}}, {{'a': 'second', 'p': bs.i + bs.s1 * coalesce(x.b, bs.m1)}}, {{'a': 'patched', 'p': bo.i + bo.s1 * coalesce(x.b, bo.m1)}}, {{'a': 'shifted', 'p': bo.i + bo.s1 * coalesce(x.b + o1, bo.m1)}}, {{'a': 'gapped', 'p': bg.i + bg.s1 * coalesce(x.b + o2, bg.m1)}}]) AS u
        FROM x JOIN bo ON bo.fold_day = day JOIN bs ON bs.fold_day = day JOIN bg ON bg.fold_day = day JOIN o ON o.fold_day = day)
    SELECT u.a AS arm, day, count(*) AS n, round(avg(abs(y - u.p)), 6) AS mae FROM ar GROUP BY 1, 2""")
def j39_second_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arms over a second load series: fitted and fed on either, patched, shifted by the window's median offset, and with the last two days of training missing."""
    x = rows(spark, sf_dir)
    got = X.second_series_arms(x, B.folds(x.select("day").distinct(), TRAIN), "a", "b", [], "y", TRAIN, gap_days=2)
    return got.select("arm", "day", "n", F.round("mae", 6).alias("mae"))
