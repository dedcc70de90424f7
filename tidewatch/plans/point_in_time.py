"""Queries of point-in-time features (D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import features as P
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query


def _long() -> list[Column]:
    """Columns of long features, instants in seconds."""
    return [F.col("feature"), S.ts_s(), F.round("value", 6).alias("value"), tg.seconds(F.col("known_at")).alias("known_s")]


def _gate(ts: str) -> str:
    return f"({S.utc(S.day_of(ts) + ' - 1')} + INTERVAL 12 HOUR)"


def _lag(column: str, hours: tuple[int, ...], known: str) -> str:
    return f"SELECT '{column}_lag_' || k AS feature, ts + to_hours(k) AS ts, {column} AS value, {known} AS known_at FROM h, (VALUES {', '.join(f'({k})' for k in hours)}) v(k)"


_OUT = f"SELECT feature, {S.secs('ts')} AS ts_s, round(value, 6) AS value, {S.secs('known_at')} AS known_s FROM f"


@query(f"WITH {S.H}, f AS ({_lag('price', (24, 48, 168), _gate('ts'))}) {_OUT}")
def d3_d10_price_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price lags by timestamp, with the instant each was known."""
    return P.lags(S.hourly(spark, sf_dir), "price", (24, 48, 168)).select(*_long())


@query(f"WITH {S.H}, f AS ({_lag('load', (48, 168), 'ts + INTERVAL 1 HOUR')} UNION ALL {_lag('solar', (48, 168), 'ts + INTERVAL 1 HOUR')}) {_OUT}")
def d11_actual_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags of actual values, known an hour after their own."""
    h = S.hourly(spark, sf_dir)
    return P.lags(h, "load", (48, 168)).unionByName(P.lags(h, "solar", (48, 168))).select(*_long())


def _mean(n: int) -> str:
    frame = f"(ORDER BY ts RANGE BETWEEN INTERVAL {n - 1} HOUR PRECEDING AND CURRENT ROW)"
    return f"SELECT 'price_mean_{n}' AS feature, ts + INTERVAL 24 HOUR AS ts, CASE WHEN count(price) OVER {frame} = {n} THEN avg(price) OVER {frame} END AS value, {_gate('ts')} AS known_at FROM h"


@query(f"WITH {S.H}, f AS ({_mean(24)} UNION ALL {_mean(168)}) {_OUT}")
def d4_rolling_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing means over whole windows that end a day before."""
    h = S.hourly(spark, sf_dir)
    return P.rolling_mean(h, "price", 24, 24).unionByName(P.rolling_mean(h, "price", 168, 24)).select(*_long())


@query(f"""WITH {S.H}, f AS (SELECT 'load_error_lag_48' AS feature, ts + INTERVAL 48 HOUR AS ts, load - load_forecast AS value, greatest(ts + INTERVAL 1 HOUR, {_gate('ts')}) AS known_at FROM h) {_OUT}""")
def d12_forecast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lagged error of a forecast, known when both parts are."""
    h = S.hourly(spark, sf_dir)
    parts = P.lags(h, "load", (48,)).unionByName(P.lags(h, "load_forecast", (48,)))
    return P.combine("load_error_lag_48", parts, "load_lag_48", "load_forecast_lag_48", lambda x, y: x - y).select(*_long())


@query(f"""WITH {S.H}, f AS (SELECT ts + INTERVAL 48 HOUR AS ts, (wind_on + wind_off) - (load + solar) AS value FROM h) SELECT {S.secs("ts")} AS ts_s, round(value, 6) AS deviation FROM f""")
def d13_plan_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled less physical totals over borders, two days back; null if one border is."""
    h = S.hourly(spark, sf_dir).select("ts", F.col("wind_on").alias("scheduled_x"), F.col("wind_off").alias("scheduled_y"), F.col("load").alias("physical_x"), F.col("solar").alias("physical_y"))
    gap = P.total_by_prefix(h.columns, "scheduled_") - P.total_by_prefix(h.columns, "physical_")
    return h.select(tg.seconds(F.col("ts") + tg.hours(48)).alias("ts_s"), F.round(gap, 6).alias("deviation"))


@query(f"""WITH {S.H} SELECT {S.secs("ts")} AS ts_s, round(load_forecast - wind_on - wind_off - solar, 6) AS residual, round((wind_on + wind_off + solar) / nullif(load_forecast, 0), 6) AS share FROM h""")
def d14_residual_and_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual load and renewable share."""
    parts = [F.col(c) for c in ("load_forecast", "wind_on", "wind_off", "solar")]
    return S.hourly(spark, sf_dir).select(S.ts_s(), F.round(P.residual_load(*parts), 6).alias("residual"), F.round(P.renewable_share(*parts), 6).alias("share"))


_SLOTS = f"(epoch({S.utc('day + 1')}) - epoch({S.utc('day')})) / 3600"


@query(f"""WITH {S.H}, n AS (SELECT {S.day_of("ts")} AS day, count(*) AS n FROM h WHERE solar IS NOT NULL AND wind_on IS NOT NULL GROUP BY 1), c AS (SELECT day FROM n WHERE n = {_SLOTS})
    SELECT {S.secs("ts")} AS ts_s, round(load_forecast - wind_on - coalesce(wind_off, 0) - solar, 6) AS residual FROM h WHERE {S.day_of("ts")} IN (SELECT day FROM c)""")
def d15_reconstructed_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual load on days whose reconstruction is whole; other days go as a whole."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    whole = h.join(P.covered_days(h, ["solar", "wind_on"]), "day", "left_semi")
    return whole.select(S.ts_s(), F.round(P.residual_load(F.col("load_forecast"), F.col("wind_on"), F.coalesce("wind_off", F.lit(0.0)), F.col("solar")), 6).alias("residual"))


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS v FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) < 6 GROUP BY 1), t AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT t.day, round(d.v, 5) AS gas_lag_48, (d.v IS NULL)::BIGINT AS missing FROM t LEFT JOIN d ON d.day = t.day - 2""")
def d16_commodity_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commodity two days back, with a flag where it is missing."""
    o = S.table(spark, sf_dir, "orders")
    closes = o.where(F.weekday("o_orderdate") < 5).groupBy(F.to_date("o_orderdate").alias("src")).agg(F.avg("o_totalprice").alias("v"))
    got = S.days(spark, sf_dir).join(closes.select(F.date_add("src", 2).alias("day"), "v"), "day", "left")
    return got.select("day", F.round("v", 5).alias("gas_lag_48"), F.col("v").isNull().cast("long").alias("missing"))


@query(f"""WITH {S.H}, f AS ({_lag('price', (24, 6), _gate('ts'))} UNION ALL {_lag('load', (24, 48), 'ts + INTERVAL 1 HOUR')})
    SELECT feature, count(*) AS n, {S.secs("min(ts)")} AS first_s FROM f WHERE known_at > {_gate("ts")} GROUP BY feature""")
def d8_leakage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features whose values are known only after the gate."""
    h = S.hourly(spark, sf_dir)
    f = P.lags(h, "price", (24, 6)).unionByName(P.lags(h, "load", (24, 48)))
    return P.leaks(f).select("feature", "n", tg.seconds(F.col("first")).alias("first_s"))


@query(f"""WITH {S.H}, t AS (SELECT ts FROM h UNION SELECT ts + INTERVAL 24 HOUR FROM h UNION SELECT ts + INTERVAL 168 HOUR FROM h)
    SELECT {S.secs("t.ts")} AS ts_s, round(a.price, 6) AS price_lag_24, round(b.price, 6) AS price_lag_168, round(h.load_forecast, 6) AS load_forecast
    FROM t LEFT JOIN h ON h.ts = t.ts LEFT JOIN h a ON a.ts = t.ts - INTERVAL 24 HOUR LEFT JOIN h b ON b.ts = t.ts - INTERVAL 168 HOUR""")
def d9_d17_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide matrix of features that passed the leakage check."""
    h = S.hourly(spark, sf_dir)
    f = P.lags(h, "price", (24, 168)).unionByName(P.for_target(h, "load_forecast"))
    names = ["price_lag_24", "price_lag_168", "load_forecast"]
    return P.build_matrix(f, names).select(S.ts_s(), *[F.round(c, 6).alias(c) for c in names])


@query(f"""WITH {S.H}, a AS (SELECT DISTINCT {S.day_of("ts")} AS day FROM h WHERE solar IS NOT NULL), b AS (SELECT DISTINCT {S.day_of("ts")} AS day FROM h WHERE hour(ts) = 3 AND wind_off > 20)
    SELECT coalesce(a.day, b.day) AS day, a.day IS NOT NULL AS in_first FROM a FULL JOIN b ON a.day = b.day WHERE a.day IS NULL OR b.day IS NULL""")
def d20_index_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that only one of two feature sets has."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    return P.same_keys(h.where("solar IS NOT NULL"), h.where((F.hour("ts") == 3) & (F.col("wind_off") > 20)), ["day"])
