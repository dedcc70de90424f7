"""Queries of the renewables backtest and its recompute by vintage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import capacity as A
from tidewatch.operators import renewables as R
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

TYPES = {"wind_onshore": "wind_on", "wind_offshore": "wind_off", "solar": "solar"}
TRAIN = 7


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, ts, day, mw, x, use): hourly production and a regressor with nulls; solar trains by daylight only."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    u = h.unpivot(["ts", "day", "load"], [F.col(c).alias(k) for k, c in TYPES.items()], "kind", "mw").withColumnRenamed("load", "x")
    return u.withColumn("use", (F.col("kind") != "solar") | R.daylight(F.col("ts")))


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vintage, kind, day, mw): capacity every third day, that grows with the events seen; a vintage every sixth day, with its newest anchors still 4 % too low."""
    days = S.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    steps = days.where(F.dayofmonth("day") % 3 == 0).select("day", (F.col("n") % 50).alias("n"))
    vintages = days.where(F.dayofmonth("day") % 6 == 0).select(F.col("day").alias("vintage"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(300.0 + 100 * i).alias("base")) for i, k in enumerate(TYPES)])).alias("k")
    rows = vintages.join(steps, F.col("day") <= F.col("vintage")).select("vintage", "day", "n", kinds)
    mw = F.col("k.base") + 8.0 * F.dayofmonth("day") + F.col("n")
    return rows.select("vintage", "k.kind", "day", (mw * F.when(F.date_diff("vintage", "day") < 4, 0.96).otherwise(1.0)).alias("mw"))


def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted and scorable rows of all types by the newest vintage, the last day predicted although it may have no labels."""
    rows, known = readings(spark, sf_dir), anchors(spark, sf_dir)
    last = known.agg(F.max("vintage").alias("vintage"))
    newest = known.join(F.broadcast(last), "vintage")
    caps = R.capacities(newest, rows.select("day").distinct())
    targets = rows.select("kind", "day").distinct().join(F.broadcast(last), F.lit(True))
    p = R.predictions(rows, R.fits(rows, targets, caps, ["x"], TRAIN, model="ols"), caps, ["x"])
    exempt = rows.agg(F.max("day").alias("day"))
    return R.evaluable(rows, p, R.persistence(rows, caps), least=0.2, exempt=exempt)


def _sun(at: str) -> str:
    g = f"(2 * pi() / 365 * (dayofyear({at}) - 1 + (hour({at}) - 12) / 24.0))"
    eq = f"(229.18 * (0.000075 + 0.001868 * cos{g} - 0.032077 * sin{g} - 0.014615 * cos(2 * {g}) - 0.040849 * sin(2 * {g})))"
    dec = f"(0.006918 - 0.399912 * cos{g} + 0.070257 * sin{g} - 0.006758 * cos(2 * {g}) + 0.000907 * sin(2 * {g}) - 0.002697 * cos(3 * {g}) + 0.00148 * sin(3 * {g}))"
    return f"(sin(radians({R.LATITUDE})) * sin{dec} + cos(radians({R.LATITUDE})) * cos{dec} * cos(radians((hour({at}) * 60.0 + {eq} + 4 * {R.LONGITUDE}) / 4 - 180)) > 0)"


_LIGHT = f"({_sun('ts')} OR {_sun('(ts + INTERVAL 1 HOUR)')})"
_KINDS = ", ".join(f"('{k}', {300 + 100 * i})" for i, k in enumerate(TYPES))
_ROWS = f"""{S.H}, hd AS (SELECT *, {S.day_of("ts")} AS day, {_LIGHT} AS light FROM h),
    r AS ({" UNION ALL ".join(f"SELECT '{k}' AS kind, ts, day, {c} AS mw, load AS x, {'light' if k == 'solar' else 'true'} AS \"use\", light FROM hd" for k, c in TYPES.items())}),
    ed AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), vn AS (SELECT day AS vintage FROM ed WHERE day(day) % 6 = 0),
    an AS (SELECT vintage, kind, ed.day, (base + 8 * day(ed.day) + n % 50) * CASE WHEN vintage - ed.day < 4 THEN 0.96 ELSE 1 END AS mw FROM vn JOIN ed ON ed.day <= vintage AND day(ed.day) % 3 = 0, (VALUES {_KINDS}) k(kind, base)),
    iv AS (SELECT vintage, kind, day AS a, mw AS va, lead(day) OVER w AS b, lead(mw) OVER w AS vb, (mw - lag(mw) OVER w) / (day - lag(day) OVER w) AS rate FROM an WINDOW w AS (PARTITION BY vintage, kind ORDER BY day)),
    cp AS (SELECT vintage, kind, d.day, CASE WHEN b IS NOT NULL THEN va + (vb - va) * (d.day - a) / (b - a) ELSE va + rate * (d.day - a) END AS capacity FROM (SELECT DISTINCT day FROM r) d JOIN iv ON d.day >= a AND CASE WHEN b IS NOT NULL THEN d.day < b ELSE d.day <= a + 60 END),
    cap AS (SELECT * FROM cp WHERE capacity > 0)"""


def _fit(targets: str) -> str:
    return f"""tr AS (SELECT t.kind, t.day, t.vintage, x, mw / capacity AS cf FROM ({targets}) t JOIN r ON r.kind = t.kind AND r.day >= t.day - {TRAIN} AND r.day < t.day JOIN cap c ON c.vintage = t.vintage AND c.kind = t.kind AND c.day = r.day WHERE "use" AND mw IS NOT NULL AND t.day - {TRAIN} >= (SELECT min(day) FROM r)),
    md AS (SELECT t.kind, t.day, coalesce(median(x), 0) AS med FROM (SELECT DISTINCT kind, day FROM ({targets})) t JOIN r ON r.kind = t.kind AND r.day >= t.day - {TRAIN} AND r.day < t.day WHERE "use" AND mw IS NOT NULL GROUP BY 1, 2),
    bs AS (SELECT kind, day, vintage, any_value(med) AS med, avg(cf) AS my, avg(coalesce(x, med)) AS mx, CASE WHEN coalesce(var_pop(coalesce(x, med)), 0) > 1e-12 THEN regr_slope(cf, coalesce(x, med)) ELSE 0 END AS s FROM tr JOIN md USING (kind, day) GROUP BY 1, 2, 3),
    be AS (SELECT kind, day, vintage, med, s, my - s * mx AS i FROM bs),
    pr AS (SELECT r.kind, r.ts, r.day, be.vintage, light, mw / capacity AS factor, CASE WHEN r.kind = 'solar' AND NOT light THEN 0 ELSE i + s * coalesce(x, med) END AS p, capacity FROM r JOIN be ON be.kind = r.kind AND be.day = r.day JOIN cap c ON c.vintage = be.vintage AND c.kind = r.kind AND c.day = r.day)"""


_BACK = f"""{_ROWS}, lv AS (SELECT max(vintage) AS v FROM vn), {_fit("SELECT DISTINCT kind, day, v AS vintage FROM r, lv")},
    ba AS (SELECT pr.*, o.mw / c.capacity AS base FROM pr LEFT JOIN r o ON o.kind = pr.kind AND {S.local("o.ts")} = {S.local("pr.ts")} - INTERVAL 1 DAY LEFT JOIN cap c ON c.vintage = pr.vintage AND c.kind = o.kind AND c.day = o.day),
    wh AS (SELECT kind, day FROM ba GROUP BY 1, 2 HAVING count(factor + base) >= 0.2 * ((epoch({S.utc("day + 1")}) - epoch({S.utc("day")})) / 3600)::BIGINT), ev AS (SELECT * FROM ba WHERE (kind, day) IN (SELECT (kind, day) FROM wh) OR day = (SELECT max(day) FROM r))"""


@query(f"""WITH {_BACK} SELECT kind, count(*) AS n, count(DISTINCT day) AS days, round(sqrt(avg(pow(factor - p, 2))), 6) AS rmse_cf_model, round(sqrt(avg(pow(factor - base, 2))), 6) AS rmse_cf_baseline, round(sqrt(avg(pow(factor * capacity - greatest(p, 0) * capacity, 2))), 4) AS rmse_mw_model,
    CASE WHEN avg(pow(factor - p, 2)) < avg(pow(factor - base, 2)) THEN 'pass' ELSE 'fail' END AS verdict FROM ev WHERE factor IS NOT NULL AND base IS NOT NULL GROUP BY 1""")
def g15_renewables_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model for each production type on capacity factors of the newest vintage, refitted each day, and the gate against persistence."""
    got = R.scores(backtest(spark, sf_dir), F.array(F.lit("overall")))
    return got.select("kind", "n", "days", F.round("rmse_cf_model", 6).alias("rmse_cf_model"), F.round("rmse_cf_baseline", 6).alias("rmse_cf_baseline"), F.round("rmse_mw_model", 4).alias("rmse_mw_model"), "verdict")


_SEASON = "CASE WHEN month(day) IN (12, 1, 2) THEN 'winter' WHEN month(day) <= 5 THEN 'spring' WHEN month(day) <= 8 THEN 'summer' ELSE 'autumn' END"


@query(f"""WITH {_BACK}, l AS (SELECT *, unnest(['overall', CASE WHEN light THEN 'daylight' ELSE 'dark' END, 'season_' || {_SEASON}]) AS breakdown FROM ev WHERE factor IS NOT NULL AND base IS NOT NULL)
    SELECT kind, breakdown, count(*) AS n, round(avg(abs(factor - p)), 6) AS mae_cf_model, round(avg(abs(factor - base)), 6) AS mae_cf_baseline, round(sqrt(avg(pow((factor - base) * capacity, 2))), 4) AS rmse_mw_baseline FROM l GROUP BY 1, 2""")
def j35_by_sun_and_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backtest's errors overall, by daylight as the sun has it, and by season."""
    sun = F.when(R.daylight(F.col("ts")), "daylight").otherwise("dark")
    got = R.scores(backtest(spark, sf_dir), F.array(F.lit("overall"), sun, F.concat(F.lit("season_"), F.expr(_SEASON))))
    return got.select("kind", "breakdown", "n", F.round("mae_cf_model", 6).alias("mae_cf_model"), F.round("mae_cf_baseline", 6).alias("mae_cf_baseline"), F.round("rmse_mw_baseline", 4).alias("rmse_mw_baseline"))


@query(f"""WITH {_ROWS}, lv AS (SELECT max(vintage) AS v, min(vintage) AS f FROM vn), sv AS (SELECT day, coalesce((SELECT max(vintage) FROM vn WHERE vintage < day - 1), f) AS seen, f >= day - 1 AS before_first, v FROM (SELECT DISTINCT day FROM r), lv),
    {_fit("SELECT DISTINCT kind, day, unnest(list_distinct([seen, v])) AS vintage FROM r JOIN sv USING (day)")}, mw AS (SELECT kind, ts, day, vintage, greatest(p, 0) * capacity AS mw FROM pr),
    tn AS (SELECT a.day, a.vintage, before_first, abs(a.mw - b.mw) AS gap FROM mw a JOIN sv ON sv.day = a.day AND sv.seen = a.vintage LEFT JOIN mw b ON b.kind = a.kind AND b.ts = a.ts AND b.vintage = sv.v)
    SELECT day, vintage, before_first, count(*) AS n, count(*) FILTER (gap IS NULL) AS unmatched, round(avg(gap), 6) AS mean_diff, round(max(gap), 6) AS most, coalesce(max(gap) > 0.5, false) AS over FROM tn GROUP BY 1, 2, 3""")
def j43_recomputed_by_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past days predicted again by the capacity vintage that each run had seen, against the newest one: vintage, rows and largest difference of each day; days before the first vintage are told."""
    rows = readings(spark, sf_dir)
    got = R.vintage_parity(R.recomputed(rows, rows.select("kind", "day").distinct(), anchors(spark, sf_dir), ["x"], TRAIN, model="ols"))
    return got.select("day", "vintage", "before_first", "n", "unmatched", F.round("mean_diff", 6).alias("mean_diff"), F.round("most", 6).alias("most"), "over")
