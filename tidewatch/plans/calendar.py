"""Date, time and calendar queries (C), with the grid report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import solar
from tidewatch.functions import timegrid as tg
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

_start, _next = S.utc("day"), S.utc("day + 1")


@query(f"""WITH {S.D} SELECT day, {S.secs(_start)} AS start_s, {S.secs(_next)} AS end_s, {S.secs(S.utc("day - 14"))} AS window_start_s,
    CAST((epoch({_next}) - epoch({_start})) / 3600 AS BIGINT) AS n_hours, CAST((epoch({_next}) - epoch({_start})) / 900 AS BIGINT) AS n_quarters FROM d""")
def c1_c3_local_day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of each local day, of the 14 days before it, and its slots."""
    d, a, b = F.col("day"), tg.day_start(F.col("day")), tg.day_end(F.col("day"))
    return S.days(spark, sf_dir).select("day", tg.seconds(a).alias("start_s"), tg.seconds(b).alias("end_s"), tg.seconds(tg.day_start(F.date_sub(d, 14))).alias("window_start_s"), tg.expected_slots(a, b, 60).alias("n_hours"), tg.expected_slots(a, b, 15).alias("n_quarters"))


@query(f"""WITH {S.D} SELECT day, {S.secs(S.utc("day - 1") + " + INTERVAL 12 HOUR")} AS gate_s, {S.secs(S.utc("CAST(day - 1 AS TIMESTAMP) + INTERVAL 12 HOUR"))} AS gate_wall_s,
    {S.secs("CAST(day - 1 AS TIMESTAMP)")} AS run_s, {S.secs("CAST(day - 1 AS TIMESTAMP) + INTERVAL 6 HOUR")} AS run6_s FROM d""")
def c5_c6_gate_and_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate closure by elapsed hours and by the clock, and the weather run allowed."""
    d = F.col("day")
    return S.days(spark, sf_dir).select("day", tg.seconds(tg.gate_closure(d)).alias("gate_s"), tg.seconds(tg.gate_closure(d, wall_clock=True)).alias("gate_wall_s"), tg.seconds(tg.run_init(d)).alias("run_s"), tg.seconds(tg.run_init(d, 6)).alias("run6_s"))


@query(f"SELECT event_id, {S.day_of('ts')} + 1 AS next_day FROM events")
def c4_next_delivery_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: the delivery day after each event."""
    return S.table(spark, sf_dir, "events").select("event_id", tg.next_delivery_day(F.col("ts")).alias("next_day"))


@query(f"""WITH {S.D} SELECT day, {S.secs("ts")} AS ts_s, CAST(hour({S.local("ts")}) AS BIGINT) AS local_hour, CAST(minute(ts) AS BIGINT) AS minute
    FROM (SELECT day, unnest(generate_series({_start}, {_next} - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS ts FROM d)""")
def c7_local_day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter hour of each local day."""
    return tg.spine(S.days(spark, sf_dir), 15).select("day", tg.seconds(F.col("ts")).alias("ts_s"), F.hour(tg.local(F.col("ts"))).cast("long").alias("local_hour"), F.minute("ts").cast("long").alias("minute"))


def _wave(position: str, period: str, name: str) -> str:
    return f"round(sin(2 * pi() * {position} / {period}), 6) AS {name}_sin, round(cos(2 * pi() * {position} / {period}), 6) AS {name}_cos"


@query(f"""WITH {S.H}, l AS (SELECT ts, {S.local("ts")} AS t FROM h) SELECT {S.secs("ts")} AS ts_s, {_wave("hour(t)", "24", "hour")}, {_wave("(isodow(t) - 1)", "7", "weekday")},
    {_wave("(month(t) - 1)", "12", "month")}, {_wave("(dayofyear(t) - 1)", "(CASE WHEN year(t) % 4 = 0 AND (year(t) % 100 <> 0 OR year(t) % 400 = 0) THEN 366 ELSE 365 END)", "year")} FROM l""")
def c8_c10_cyclical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour, weekday, month and day of year on circles, by the local clock."""
    t = tg.local(F.col("ts"))
    length = F.date_diff(F.make_date(F.year(t) + 1, F.lit(1), F.lit(1)), F.make_date(F.year(t), F.lit(1), F.lit(1)))
    waves = {"hour": (F.hour(t), 24), "weekday": (F.weekday(t), 7), "month": (F.month(t) - 1, 12), "year": (F.dayofyear(t) - 1, length)}
    out = [F.round(w, 6).alias(f"{n}_{k}") for n, (p, q) in waves.items() for k, w in zip(("sin", "cos"), tg.cyclical(p, q), strict=True)]
    return S.hourly(spark, sf_dir).select(tg.seconds(F.col("ts")).alias("ts_s"), *out)


#: Computus, Sunday of Easter of year y, in SQL by the classical steps.
_EASTER = """e AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS easter FROM (SELECT y, hh + l - 7 * ((a + 11 * hh + 22 * l) // 451) + 114 AS n FROM (
    SELECT y, a, hh, (32 + 2 * (b % 4) + 2 * (c // 4) - hh - c % 4) % 7 AS l FROM (SELECT y, a, b, c, (19 * a + b - b // 4 - (8 * b + 13) // 25 + 15) % 30 AS hh
    FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (SELECT DISTINCT year(day) AS y FROM d))))))"""


@query(f"""WITH {S.D}, {_EASTER} SELECT day, isodow(day) >= 6 AS weekend, strftime(day, '%m-%d') IN ('01-01', '05-01', '10-03', '12-25', '12-26') OR (day - easter) IN (-2, 1, 39, 50) AS holiday,
    (day - easter) = 60 AS corpus_christi, strftime(day, '%m-%d') = '11-01' AS all_saints, day >= DATE '1998-01-01' AND day < DATE '1999-07-01' AS crisis, day >= DATE '1999-07-01' AS post_crisis
    FROM d JOIN e ON e.y = year(day)""")
def c9_calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend, nationwide and regional holidays, and two regimes by date (here 1998-01-01 and 1999-07-01)."""
    d = F.col("day")
    edge = [F.lit(x).cast("date") for x in ("1998-01-01", "1999-07-01")]
    return S.days(spark, sf_dir).select("day", (F.weekday(d) >= 5).alias("weekend"), tg.is_nationwide_holiday(d).alias("holiday"), (F.date_diff(d, tg.easter(F.year(d))) == 60).alias("corpus_christi"), ((F.month(d) == 11) & (F.dayofmonth(d) == 1)).alias("all_saints"), ((d >= edge[0]) & (d < edge[1])).alias("crisis"), (d >= edge[1]).alias("post_crisis"))


_POS = f"(hour({S.local('ts')}) + 24 * (isodow({S.local('ts')}) - 1))"


@query(f"""WITH {S.H} SELECT {S.secs("ts")} AS ts_s, period, k, round(sin(2 * pi() * k * {_POS} / period), 6) AS s, round(cos(2 * pi() * k * {_POS} / period), 6) AS c
    FROM h, (VALUES (24, 1), (24, 2), (24, 3), (168, 1), (168, 2)) v(period, k)""")
def c11_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: daily and weekly Fourier terms by the local clock."""
    t = tg.local(F.col("ts"))
    at = F.hour(t) + 24 * F.weekday(t)
    terms = F.array(*[F.struct(F.lit(p).alias("period"), F.lit(k).alias("k")) for p, n in ((24, 3), (168, 2)) for k in range(1, n + 1)])
    rows = S.hourly(spark, sf_dir).select(tg.seconds(F.col("ts")).alias("ts_s"), at.alias("at"), F.explode(terms).alias("term")).select("ts_s", "at", "term.*")
    s, c = tg.cyclical(F.col("k") * F.col("at"), F.col("period"))
    return rows.select("ts_s", "period", "k", F.round(s, 6).alias("s"), F.round(c, 6).alias("c"))


@query(f"""WITH {S.H}, l AS (SELECT ts, {S.local("ts")} AS t FROM h) SELECT {S.secs("ts")} AS ts_s, CASE WHEN month(t) IN (12, 1, 2) THEN 'winter' WHEN month(t) <= 5 THEN 'spring' WHEN month(t) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
    CASE WHEN hour(t) >= 6 AND hour(t) < 22 THEN 'day' ELSE 'night' END AS daytime, strftime(t, '%Y-%m') AS month FROM l""")
def c14_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: season, day or night, and month of each hour by the local clock."""
    t = tg.local(F.col("ts"))
    m, h = F.month(t), F.hour(t)
    season = F.when(m.isin(12, 1, 2), "winter").when(m <= 5, "spring").when(m <= 8, "summer").otherwise("autumn")
    return S.hourly(spark, sf_dir).select(tg.seconds(F.col("ts")).alias("ts_s"), season.alias("season"), F.when((h >= 6) & (h < 22), "day").otherwise("night").alias("daytime"), F.date_format(t, "yyyy-MM").alias("month"))


@query("""WITH d AS (SELECT o_orderpriority AS item, max(CAST(o_orderdate AS DATE)) AS due FROM orders GROUP BY 1), a AS (SELECT max(due) - 1 AS as_of FROM d)
    SELECT item, due, CAST(due - as_of AS BIGINT) AS days_left, CASE WHEN due < as_of THEN 'overdue' ELSE 'due' END AS state FROM d, a WHERE due - as_of <= 30""")
def c15_deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates due within 30 days of the day before the last."""
    due = S.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("item")).agg(F.max(F.to_date("o_orderdate")).alias("due"))
    as_of = due.agg(F.date_sub(F.max("due"), 1).alias("as_of"))
    left = F.date_diff("due", "as_of").cast("long")
    return due.join(F.broadcast(as_of), F.lit(True)).where(left <= 30).select("item", "due", left.alias("days_left"), F.when(F.col("due") < F.col("as_of"), "overdue").otherwise("due").alias("state"))


#: Points derived from the nation table.
_POINTS = "p AS (SELECT n_nationkey AS point, 47.5 + n_nationkey * 0.3 AS lat, 6.0 + n_nationkey * 0.35 AS lon FROM nation)"


@query(f"""WITH {S.H}, {_POINTS}, t AS (SELECT ts, point, lat, lon, 2 * pi() / 365 * (dayofyear(ts) - 1 + (hour(ts) - 12) / 24.0) AS g, hour(ts) * 60.0 AS m FROM h, p),
    e AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq,
        0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS dec FROM t),
    a AS (SELECT *, radians((m + eq + 4 * lon) / 4 - 180) AS ha FROM e)
    SELECT {S.secs("ts")} AS ts_s, point, round(degrees(asin(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(ha))), 4) AS elevation,
        round(degrees(atan2(sin(ha), cos(ha) * sin(radians(lat)) - tan(dec) * cos(radians(lat)))) + 180, 4) AS azimuth FROM a""")
def c12_solar_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation and azimuth of the sun for each hour and point."""
    at = solar.position(F.col("ts"), F.col("lat"), F.col("lon"))
    both = S.hourly(spark, sf_dir).select("ts").join(F.broadcast(points(spark, sf_dir)), F.lit(True))
    return both.select(tg.seconds(F.col("ts")).alias("ts_s"), "point", F.round(at[0], 4).alias("elevation"), F.round(at[1], 4).alias("azimuth"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(point, lat, lon): the 25 nations as grid points."""
    k = F.col("n_nationkey")
    return S.table(spark, sf_dir, "nation").select(k.alias("point"), (47.5 + k * 0.3).alias("lat"), (6.0 + k * 0.35).alias("lon"))


@query(f"""WITH {S.H}, {_POINTS}, g AS (SELECT ts, ts + to_hours(k) AS spot, k FROM h, (VALUES (0), (1)) v(k)),
    t AS (SELECT ts, lat, lon, 2 * pi() / 365 * (dayofyear(spot) - 1 + (hour(spot) - 12) / 24.0) AS g, hour(spot) * 60.0 AS m FROM g, p),
    e AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq,
        0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS dec FROM t)
    SELECT {S.secs("ts")} AS ts_s, bool_or(asin(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(radians((m + eq + 4 * lon) / 4 - 180))) > 0) AS daylight FROM e GROUP BY ts""")
def c13_daylight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sun is up at the start or at the end of an hour at any point."""
    rows = S.hourly(spark, sf_dir).select("ts", F.explode(F.array(F.col("ts"), F.col("ts") + tg.hours(1))).alias("at")).join(F.broadcast(points(spark, sf_dir)), F.lit(True))
    up = solar.position(F.col("at"), F.col("lat"), F.col("lon"))[0] > 0
    return rows.groupBy("ts").agg(F.bool_or(up).alias("daylight")).select(tg.seconds(F.col("ts")).alias("ts_s"), "daylight")


@query(f"""WITH {S.Q}, g AS (SELECT {S.day_of("ts")} AS day, count(*) AS points, count(price) AS filled FROM q GROUP BY 1)
    SELECT day, points, filled, CAST((epoch({_next}) - epoch({_start})) / 900 AS BIGINT) AS expected, points - CAST((epoch({_next}) - epoch({_start})) / 900 AS BIGINT) AS deviation,
    epoch({_next}) - epoch({_start}) <> 86400 AS clock_change FROM g""")
def i19_b9_grid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of each local day against its calendar."""
    got = S.quarterly(spark, sf_dir).groupBy(tg.local_day(F.col("ts")).alias("day")).agg(F.count("*").alias("points"), F.count("price").alias("filled"))
    want = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 15)
    return got.select("day", "points", "filled", want.alias("expected"), (F.col("points") - want).alias("deviation"), (want != 96).alias("clock_change"))
