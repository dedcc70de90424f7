"""Queries of validation, audits, healing and stores (I)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import quality as V
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

_SLOTS = f"CAST((epoch({S.utc('day + 1')}) - epoch({S.utc('day')})) / 3600 AS BIGINT)"


@query(f"""WITH {S.H}, n AS (SELECT {S.day_of("ts")} AS day, count(*) FILTER (load IS NULL) AS a, count(*) FILTER (solar IS NULL) AS b, count(*) FILTER (wind_on IS NULL) AS c FROM h GROUP BY 1)
    SELECT day, concat_ws(',', CASE WHEN a > 0 THEN 'load' END, CASE WHEN b > 0 THEN 'solar' END, CASE WHEN c > 0 THEN 'wind_on' END) AS missing FROM n WHERE a + b + c > 0""")
def i1_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a day lacks."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    return V.null_columns(h, ["load", "solar", "wind_on"]).select("day", F.array_join("missing", ",").alias("missing"))


_COMPLETE = f"c AS (SELECT {S.day_of('ts')} AS day, count(*) FILTER (solar IS NOT NULL) AS n FROM h GROUP BY 1), k AS (SELECT day, n = {_SLOTS} AS complete FROM c)"


@query(f"""WITH {S.H}, {_COMPLETE}, g AS (SELECT t.day, count(k.day) AS complete_days, (t.day - 1) - max(k.day) AS edge_age FROM k t LEFT JOIN k ON k.complete AND k.day >= t.day - 14 AND k.day < t.day GROUP BY t.day)
    SELECT day, complete_days, coalesce(edge_age, -1) AS edge_age, coalesce(complete_days >= 3 AND edge_age <= 7, false) AS ok FROM g""")
def i2_i3_training_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the fortnight before a day has enough whole days, and recent ones."""
    k = V.complete_days(S.hourly(spark, sf_dir), ["solar"])
    return V.training_window(k, k, 14, 3, 7).withColumn("edge_age", F.coalesce("edge_age", F.lit(-1)))


@query(f"WITH {S.H} SELECT {S.day_of('ts')} AS day, count(*) FILTER (price / 100 NOT BETWEEN 0 AND 1) AS outside, coalesce({S.secs('min(ts) FILTER (price / 100 NOT BETWEEN 0 AND 1)')}, 0) AS first_s FROM h GROUP BY 1")
def i4_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: factors outside their range, by day."""
    h = S.hourly(spark, sf_dir).withColumns({"day": tg.local_day(F.col("ts")), "f": F.col("price") / 100})
    return V.bounds(h, "f", 0, 1, ["day"]).select("day", "outside", F.coalesce(tg.seconds(F.col("first")), F.lit(0)).cast("long").alias("first_s"))


@query(f"""WITH {S.H}, d AS (SELECT {S.day_of("ts")} AS day, sum(load) AS total FROM h GROUP BY 1), m AS (SELECT a.day, min(b.total) AS lo, max(b.total) AS hi FROM d a JOIN d b ON month(a.day) = month(b.day) AND a.day <> b.day GROUP BY 1)
    SELECT d.day, round(total, 6) AS total, coalesce(total >= lo * 0.9 AND total <= hi * 1.1, false) AS ok FROM d JOIN m USING (day)""")
def i5_daily_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums against the other days of their month."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    month = F.month("day")
    many = h.groupBy(month.alias("m")).agg(F.count_distinct("day").alias("n")).where("n > 1").select("m")
    got = V.daily_sum_plausibility(h.join(many, month == F.col("m"), "left_semi"), "load")
    return got.select("day", F.round("total", 6).alias("total"), F.coalesce("ok", F.lit(False)).alias("ok"))


@query(f"WITH {S.H} SELECT {S.day_of('ts')} AS day, count(DISTINCT round(price, 6)) = 1 AS constant, count(*) FILTER (price < 20 - 5 OR price > 80 + 5) AS outside FROM h GROUP BY 1")
def i6_payload_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant days, and values beyond a range and its margin."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    return V.payload_plausibility(h, "price", F.lit(20.0), F.lit(80.0), 5.0)


@query("""WITH m AS (SELECT max(ts) AS as_of FROM events), l AS (SELECT event_type AS "column", max(ts) FILTER (event_id % 3 <> 0 OR event_type <> 'error' OR ts < TIMESTAMP '2024-01-20') AS last FROM events GROUP BY 1)
    SELECT "column", CAST(floor((epoch(as_of) - epoch(last)) / 86400) AS BIGINT) AS age_days, floor((epoch(as_of) - epoch(last)) / 86400) >= 4 AS stale FROM l, m""")
def i7_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days since each series had a value."""
    e = S.table(spark, sf_dir, "events")
    types = [r[0] for r in e.select("event_type").distinct().collect()]
    as_of = F.broadcast(e.agg(F.max("ts").alias("as_of")))
    wide = e.select("ts", *[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in types])
    last = wide.agg(*[F.max(F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in types]).unpivot([], types, "column", "last").join(as_of, F.lit(True))
    age = F.timestamp_diff("DAY", F.col("last"), F.col("as_of"))
    return last.select("column", age.alias("age_days"), (age >= 4).alias("stale"))


@query(f"""WITH {S.Q}, s AS (SELECT epoch(ts) - lag(epoch(ts)) OVER (ORDER BY ts) AS step FROM q), n AS (SELECT step, count(*) AS n FROM s WHERE step IS NOT NULL GROUP BY 1)
    SELECT 'price' AS source, (SELECT quantile_cont(step, 0.5) FROM s) AS median_s, CAST((SELECT arg_max(step, (n, -step)) FROM n) AS BIGINT) AS modal_s""")
def i11_native_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of a series from its steps."""
    return V.spacing(S.quarterly(spark, sf_dir).withColumn("source", F.lit("price")), ["source"])


@query("""WITH g AS (SELECT o_orderpriority AS source, date_trunc('month', o_orderdate)::DATE AS month, count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders GROUP BY 1, 2)
    SELECT source, month, n, CAST(last_day(month) - month + 1 AS BIGINT) AS expected, n >= 0.9 * (last_day(month) - month + 1) OR (source = '5-LOW' AND month(month) = 2) AS ok FROM g""")
def i12_monthly_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that have nine tenths of their days; some windows are known to be thin."""
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"), F.to_date("o_orderdate").cast("timestamp_ntz").alias("ts"))
    thin = o.select(F.lit("5-LOW").alias("source"), F.trunc(F.to_date("ts"), "MM").alias("month")).where(F.month("month") == 2).distinct()
    return V.monthly_completeness(o, ["source"], 1440, thin)


@query(f"""WITH m AS (SELECT max(ts) AS as_of FROM events), g AS (SELECT event_type AS series, {S.day_of("ts")} AS day, count(DISTINCT date_trunc('hour', ts)) AS present, max(date_trunc('hour', ts)) AS last FROM events GROUP BY 1, 2)
    SELECT series, day, present, {_SLOTS} AS expected, round(present / {_SLOTS}, 6) AS coverage, CASE WHEN present >= {_SLOTS} THEN 'ok' ELSE 'partial' END AS status, CAST(floor((epoch(as_of) - epoch(last)) / 3600) AS BIGINT) AS stale_hours FROM g, m""")
def i13_availability_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence, coverage and age of each series by day."""
    e = S.table(spark, sf_dir, "events")
    as_of = e.agg(F.max("ts").alias("as_of")).first()["as_of"]
    rows = e.select(F.col("event_type").alias("series"), tg.truncate(F.col("ts"), 60).alias("ts"))
    return V.availability(rows, "series", tg.local_day(F.col("ts")), 60, F.lit(as_of).cast("timestamp_ntz")).withColumn("coverage", F.round("coverage", 6))


_HEAL = "a AS (SELECT date_trunc('hour', ts) AS ts, max(value) AS v FROM events WHERE event_id % 5 <> 0 GROUP BY 1), e AS (SELECT ts, CASE WHEN hour(ts) % 4 <> 1 THEN v END AS v FROM a), f AS (SELECT date_trunc('hour', ts) AS ts, max(value) AS v FROM events GROUP BY 1)"


@query(f"""WITH {_HEAL}, b AS (SELECT coalesce(e.ts, f.ts) AS ts, e.v AS a, f.v AS b FROM e FULL JOIN f ON e.ts = f.ts), s AS (SELECT *, CASE WHEN a IS NOT NULL AND b IS NOT NULL AND a <> b THEN 'changed' WHEN a IS NOT NULL THEN 'kept' WHEN b IS NOT NULL AND ts >= TIMESTAMP '2024-01-10' THEN 'filled' ELSE 'missing' END AS state FROM b)
    SELECT {S.secs("ts")} AS ts_s, coalesce(CASE WHEN state = 'filled' THEN b ELSE a END, -1) AS v, state FROM s""")
def i14_heal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent nulls filled from a fresh pull, other values kept."""
    e, t = S.table(spark, sf_dir, "events"), tg.truncate(F.col("ts"), 60).alias("ts")
    old = e.where("event_id % 5 <> 0").groupBy(t).agg(F.max("value").alias("v")).withColumn("v", F.when(F.hour("ts") % 4 != 1, F.col("v")))
    got = V.heal(old, e.groupBy(t).agg(F.max("value").alias("v")), ["ts"], "v", F.lit("2024-01-10").cast("timestamp_ntz"))
    return got.select(S.ts_s(), F.coalesce("v", F.lit(-1.0)).alias("v"), "state")


_STORE = "x AS (SELECT CAST(ts AS DATE) AS day, event_type AS row, sum(value) AS v FROM events GROUP BY 1, 2), o AS (SELECT * FROM x WHERE day(day) % 3 <> 0), n AS (SELECT day, row, v + CASE WHEN day(day) % 5 = 0 THEN 1 ELSE 0 END AS v FROM x WHERE day(day) % 2 = 0)"


@query(f"""WITH {_STORE} SELECT day, row, round(v, 4) AS v, 'store' AS part FROM o UNION ALL SELECT day, row, round(v, 4), 'store' FROM n WHERE (day, row) NOT IN (SELECT (day, row) FROM o)
    UNION ALL SELECT n.day, n.row, round(n.v, 4), 'conflict' FROM n JOIN o ON o.day = n.day AND o.row = n.row WHERE abs(n.v - o.v) > 1e-6""")
def i16_t3_store_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows join a store once, and those that contradict it are told."""
    e = S.table(spark, sf_dir, "events")
    x = e.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("row")).agg(F.sum("value").alias("v"))
    d = F.dayofmonth("day")
    new = x.where(d % 2 == 0).withColumn("v", F.col("v") + F.when(d % 5 == 0, 1).otherwise(0))
    store, conflicts = V.merge_rows(x.where(d % 3 != 0), new, ["day", "row"], "v")
    out = store.withColumn("part", F.lit("store")).unionByName(conflicts.select("day", "row", "v", F.lit("conflict").alias("part")))
    return out.withColumn("v", F.round("v", 4))


@query("WITH w AS (SELECT DISTINCT CAST(ts AS DATE) AS day, r.row FROM events, (VALUES ('click'), ('view'), ('error')) r(row)), x AS (SELECT CAST(ts AS DATE) AS day, event_type AS row FROM events WHERE value > 150) SELECT day, row FROM w WHERE (day, row) NOT IN (SELECT (day, row) FROM x)")
def i17_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and rows that a store still lacks."""
    e = S.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    want = e.select("day").distinct().select("day", F.explode(F.array(*map(F.lit, ("click", "view", "error")))).alias("row"))
    return V.missing_keys(e.where("value > 150").select("day", F.col("event_type").alias("row")), want, ["day", "row"])


@query("""WITH m AS (SELECT max(ts) AS as_of FROM events) SELECT event_type AS source, floor(epoch(min(ts)))::BIGINT AS first_s, floor(epoch(max(ts)))::BIGINT AS last_s, count(*) AS n, count(*) FILTER (props IS NULL) AS nulls_props,
    CAST(floor((epoch(any_value(as_of)) - epoch(max(ts))) / 86400) AS BIGINT) AS age_days FROM events, m GROUP BY 1""")
def i18_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the store holds of each source."""
    e = S.table(spark, sf_dir, "events").withColumnRenamed("event_type", "source")
    as_of = e.agg(F.max("ts").alias("as_of")).first()["as_of"]
    got = V.manifest(e, "source", ["props"], F.lit(as_of).cast("timestamp_ntz"))
    return got.select("source", tg.seconds(F.col("first")).alias("first_s"), tg.seconds(F.col("last")).alias("last_s"), "n", "nulls_props", "age_days")


@query(f"""WITH r AS (SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, CASE WHEN value > 20 THEN value END AS v FROM events), p AS (SELECT source, ts, count(*) AS k, count(*) FILTER (v IS NULL) AS z FROM r GROUP BY 1, 2)
    SELECT source, sum(k)::BIGINT AS rows, sum(k - 1)::BIGINT AS duplicates, CAST((epoch(max(ts)) - epoch(min(ts))) / 900 + 1 - count(*) AS BIGINT) AS gaps, round(sum(z) / sum(k), 6) AS worst_null, sum(k - 1) > 0 OR sum(z) / sum(k) > 0.3 AS blocking FROM p GROUP BY 1""")
def i10_source_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates, gaps and nulls of each source."""
    e = S.table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), tg.truncate(F.col("ts"), 15).alias("ts"), F.when(F.col("value") > 20, F.col("value")).alias("v"))
    return V.validate_source(e, "source", ["v"], 15, 0.3).withColumn("worst_null", F.round("worst_null", 6))


@query(f"""WITH {S.H}, v AS (SELECT {S.day_of("ts")} AS day, list(price ORDER BY ts) AS v FROM h GROUP BY 1) SELECT day, len(v) AS n, CASE WHEN len(v) <> {_SLOTS} THEN 'count' ELSE 'none' END AS problem, list_sort(v) = v AS ascending, CASE WHEN len(v) IN (23, 24, 25) THEN 60 WHEN len(v) IN (92, 96, 100) THEN 15 ELSE 0 END AS resolution FROM v""")
def i21_i22_payload_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure of each day's payload, and the grid that it stands for."""
    h = S.hourly(spark, sf_dir)
    v = h.groupBy(tg.local_day(F.col("ts")).alias("day")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "price"))), lambda x: x["price"]).alias("v"))
    want = tg.expected_slots(tg.day_start(F.col("day")), tg.day_end(F.col("day")), 60)
    n = F.size("v")
    return V.payload_checks(v, "v", want).select("day", n.cast("long").alias("n"), F.coalesce("problem", F.lit("none")).alias("problem"), V.ascending(F.col("v")).alias("ascending"), F.coalesce(V.resolution_of(n), F.lit(0)).alias("resolution"))


@query("""WITH k AS (SELECT event_type AS series, CAST(ts AS DATE) AS day, user_id AS target, count(DISTINCT hour(ts)) AS hours, min(ts) AS first FROM events GROUP BY 1, 2, 3)
    SELECT series, day, count(*) AS probes, round(avg(hours / 24), 6) AS coverage, CAST(floor((epoch(day + INTERVAL 1 DAY) - epoch(min(first))) / 60) AS BIGINT) AS minutes_left FROM k GROUP BY 1, 2""")
def i20_publication_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of probes, and minutes from the first to the day's end."""
    e = S.table(spark, sf_dir, "events")
    k = e.groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("day"), "user_id").agg(F.count_distinct(F.hour("ts")).alias("hours"), F.min("ts").alias("first"))
    left = F.timestamp_diff("MINUTE", F.min("first"), F.date_add("day", 1).cast("timestamp_ntz"))
    return k.groupBy("series", "day").agg(F.count("*").alias("probes"), F.round(F.avg(F.col("hours") / 24), 6).alias("coverage"), left.alias("minutes_left"))
