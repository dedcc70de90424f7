"""Further queries: documents, reconstructions, inner folds, positional patches, missing runs, late rows and types against a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import shared, sources, streaming
from tidewatch.functions import timegrid as tg
from tidewatch.operators import baselines as B
from tidewatch.operators import cleaning as C
from tidewatch.operators import evaluation as E
from tidewatch.operators import features as P
from tidewatch.operators import ladder as L
from tidewatch.operators import weather as W
from tidewatch.plans import scores, stores
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query


@query(f"WITH {stores._W} SELECT {S.secs('run')} AS run_s, {S.secs('valid')} AS valid_s, variable, count(*) AS n, round(sum(value), 2) AS total FROM w GROUP BY 1, 2, 3")
def a10_forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: a document for each run, with a list of points and arrays by variable, flattened to readings."""
    w = stores.weather(spark, sf_dir)
    one = w.groupBy("run", "point", "variable").agg(F.array_sort(F.collect_list(F.struct(F.date_format("valid", "yyyy-MM-dd'T'HH:mm").alias("t"), "value"))).alias("x"))
    place = one.select("run", F.struct(F.col("point").cast("double").alias("latitude"), F.lit(0.0).alias("longitude"), F.struct(F.transform("x", lambda r: r["t"]).alias("time"), F.create_map("variable", F.transform("x", lambda r: r["value"])).alias("values")).alias("hourly")).alias("loc"))
    docs = place.groupBy("run").agg(F.to_json(F.collect_list("loc")).alias("body"))
    rows = sources.flatten_forecast(docs)[0]
    got = rows.groupBy("run", "valid", "variable").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"))
    return got.select(tg.seconds(F.col("run")).alias("run_s"), tg.seconds(F.col("valid")).alias("valid_s"), "variable", "n", "total")


@query(f"WITH {S.H} SELECT {S.secs('ts')} AS ts_s, coalesce(round(wind_on, 6), -1) AS value, {S.secs('CAST(' + S.day_of('ts') + ' - 1 AS TIMESTAMP)')} AS known_s FROM h")
def d6_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reconstructed value, known when its run began."""
    f = P.for_target(S.hourly(spark, sf_dir), "wind_on", "nwp_wind", kind="run")
    return f.select(S.ts_s(), F.coalesce(F.round("value", 6), F.lit(-1.0)).alias("value"), tg.seconds(F.col("known_at")).alias("known_s"))


@query(f"WITH {S.D}, a AS (SELECT min(day) AS a, max(day) AS b FROM d) SELECT day AS fold_day, day - 60 AS train_from, day - 1 AS train_to FROM d, a WHERE day - 60 >= a AND day < b - 30 AND day >= b - 60")
def g12_inner_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds for tuning, all before the test period begins."""
    d = S.days(spark, sf_dir)
    end = F.broadcast(d.agg(F.max("day").alias("_b")))
    f = B.folds(d, 60).join(end, F.lit(True))
    return f.where((F.col("fold_day") < F.date_sub("_b", 30)) & (F.col("fold_day") >= F.date_sub("_b", 60))).select("fold_day", "train_from", "train_to")


@query(f"""WITH {S.H}, x AS (SELECT {S.day_of("ts")} AS day, CAST((epoch(ts) - epoch({S.utc(S.day_of("ts"))})) / 3600 AS BIGINT) AS k, load FROM h), l AS (SELECT day, arg_max(load, k) FILTER (load IS NOT NULL) AS last FROM x GROUP BY 1), p AS (SELECT DISTINCT day FROM x),
    g AS (SELECT day, unnest(generate_series({S.utc("day")}, {S.utc("day + 1")} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ts FROM p)
    SELECT {S.secs("g.ts")} AS ts_s, g.day, coalesce(round(coalesce(x.load, l.last), 6), -1) AS value FROM g LEFT JOIN x ON x.day = g.day - 7 AND x.k = (epoch(g.ts) - epoch({S.utc("g.day")})) / 3600 LEFT JOIN l ON l.day = g.day - 7""")
def h4_positional_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: the week before by the number of the hour, its last value beyond."""
    h = S.hourly(spark, sf_dir)
    pairs = h.select(tg.local_day(F.col("ts")).alias("day")).distinct().withColumn("reference", F.date_sub("day", 7))
    got = L.positional(h.where("load IS NOT NULL"), "load", pairs)
    return got.select(S.ts_s(), "day", F.coalesce(F.round("value", 6), F.lit(-1.0)).alias("value"))


@query(f"""WITH {S.D}, r AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run FROM orders WHERE o_orderkey % 3 = 0), k AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run FROM orders WHERE o_orderpriority = '5-LOW')
    SELECT DISTINCT {S.secs("CAST(day - 1 AS TIMESTAMP)")} AS run_s, day - 1 IN (SELECT run FROM k) AS known FROM d WHERE day - 1 NOT IN (SELECT run FROM r)""")
def a18_w7_missing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that the days need and the store lacks, and which of them a defect list has."""
    o = S.table(spark, sf_dir, "orders").withColumn("run", F.to_date("o_orderdate").cast("timestamp_ntz"))
    got = W.missing_runs(S.days(spark, sf_dir), o.where("o_orderkey % 3 = 0").select("run").distinct(), o.where("o_orderpriority = '5-LOW'").select("run").distinct())
    return got.select(tg.seconds(F.col("run")).alias("run_s"), "known")


@query("WITH m AS (SELECT max(ts) AS b FROM events) SELECT event_type, count(*) FILTER (ts >= b - INTERVAL 10 DAY) AS in_time, count(*) FILTER (ts < b - INTERVAL 10 DAY) AS late FROM events, m GROUP BY 1")
def t2_healing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inside the healing window, and those that go to the late table."""
    e = S.table(spark, sf_dir, "events")
    until = F.lit(e.agg(F.max("ts").alias("b")).first()["b"]).cast("timestamp_ntz")
    fresh, late = streaming.late_rows(e, until)
    both = fresh.select("event_type", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(late.select("event_type", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy("event_type").agg(F.sum("a").alias("in_time"), F.sum("b").alias("late"))


@query("SELECT CAST(floor(epoch(date_trunc('hour', ts) + INTERVAL 1 HOUR * k)) AS BIGINT) AS ts_s, round(avg(value) + 1e-8, 6) AS mean, count(*) AS n FROM events, range(1, 25) r(k) GROUP BY 1")
def t4_t5_sliding_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, T5: the sliding windows of the streaming form, on the whole table at once."""
    e = S.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = streaming.trailing_mean(e, 24)
    return got.select(F.unix_timestamp("ts").alias("ts_s"), F.round(F.col("mean") + 1e-8, 6).alias("mean"), "n")


_TYPES = ("wind_on", "wind_off", "solar")


@query(f"""WITH {S.H}, u AS ({" UNION ALL ".join(f"SELECT ts, '{c}' AS kind, {c} AS y FROM h" for c in _TYPES)}), p AS (SELECT a.kind, a.ts, a.y, b.y AS p, c.y AS q FROM u a LEFT JOIN u b ON b.kind = a.kind AND b.ts = a.ts - INTERVAL 24 HOUR LEFT JOIN u c ON c.kind = a.kind AND c.ts = a.ts - INTERVAL 48 HOUR)
    SELECT kind, count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(avg(abs(y - q)), 6) AS mae_older, avg(abs(y - p)) < avg(abs(y - q)) AS better FROM p WHERE y IS NOT NULL AND p IS NOT NULL AND q IS NOT NULL GROUP BY 1""")
def g15_types_against_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production types as a key: a day back against two days back on the same hours."""
    u = S.hourly(spark, sf_dir).unpivot(["ts"], list(_TYPES), "kind", "y")
    back = lambda h, c: u.select((F.col("ts") + tg.hours(h)).cast("timestamp_ntz").alias("ts"), "kind", F.col("y").alias(c))
    p = u.join(back(24, "p"), ["ts", "kind"]).join(back(48, "q"), ["ts", "kind"]).where("y IS NOT NULL AND p IS NOT NULL AND q IS NOT NULL")
    y = F.col("y")
    a, b = E.mae(y, F.col("p")), E.mae(y, F.col("q"))
    return p.groupBy("kind").agg(F.count("*").alias("n"), F.round(a, 6).alias("mae"), F.round(b, 6).alias("mae_older"), (a < b).alias("better"))


@query(f"WITH {scores._F}, gg AS (SELECT day, count(*) AS n, count(p) AS m FROM f GROUP BY 1) SELECT count(*) AS days, count(*) FILTER (m < n) AS excluded, round(avg((m < n)::INT), 6) AS share, avg((m < n)::INT) <= 0.1 AS ok FROM gg")
def i24_excluded_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that can't be evaluated, and whether they are few enough."""
    g = scores.forecasts(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n"), F.count("p").alias("m"))
    out = F.avg((F.col("m") < F.col("n")).cast("int"))
    return g.agg(F.count("*").alias("days"), F.count_if(F.col("m") < F.col("n")).alias("excluded"), F.round(out, 6).alias("share"), (out <= 0.1).alias("ok"))


_LATE = 2


@query(f"""WITH e AS (SELECT ts, value FROM events), m AS (SELECT max(ts) - INTERVAL {_LATE} DAY AS edge FROM e),
    t AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS z, avg(value) AS mean, count(*) AS n FROM e GROUP BY 1), s AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR * k AS z, avg(value) AS mean, count(*) AS n FROM e, range(1, 25) r(k) GROUP BY 1)
    SELECT 'hour' AS form, {S.secs("z - INTERVAL 1 HOUR")} AS ts_s, round(mean, 9) AS mean, -1::BIGINT AS n FROM t, m WHERE z <= edge UNION ALL SELECT 'trailing', {S.secs("z")}, round(mean, 9), n FROM s, m WHERE z <= edge""")
def t4_t5_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, T5: the table arrives in parts, some of its rows a day late, and each part is drained as a stream with the state that the last one left; hours and trailing means that the watermark has closed."""
    events = S.table(spark, sf_dir, "events").select("ts", "value", "event_id")
    arrival = F.when(F.col("event_id") % 17 == 0, F.col("ts") + tg.hours(24)).otherwise(F.col("ts")).cast("timestamp_ntz")
    parts = events.withColumn("_part", F.floor(F.dayofyear(arrival) / 10) % 37)
    root = shared.fresh_path(spark, "stream")
    forms = {"hour": lambda s: streaming.hourly(s, f"{_LATE} days"), "trailing": lambda s: streaming.trailing_mean(s, 24, f"{_LATE} days")}
    for k in sorted(r[0] for r in parts.select("_part").distinct().collect()):
        parts.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(f"{root}/in")
        for name, form in forms.items():
            streaming.run_available(form(streaming.source(spark, f"{root}/in", events.schema)), f"{root}/{name}", f"{root}/{name}.checkpoint")
    hour = spark.read.parquet(f"{root}/hour").select(F.lit("hour").alias("form"), "ts", F.col("price").alias("mean"), F.lit(-1).cast("long").alias("n"))
    got = hour.unionByName(spark.read.parquet(f"{root}/trailing").select(F.lit("trailing").alias("form"), "ts", "mean", "n"))
    return got.select("form", F.unix_timestamp("ts").alias("ts_s"), F.round("mean", 9).alias("mean"), "n")


@query(f"""WITH {S.H}, m AS (SELECT max({S.day_of("ts")}) AS d FROM h), p AS (SELECT ts, price FROM h, m WHERE {S.day_of("ts")} < d - 1), a AS (SELECT ts, price, CAST(NULL AS DOUBLE) AS load FROM p UNION ALL SELECT ts, NULL, load FROM h WHERE load IS NOT NULL
    UNION ALL SELECT unnest(generate_series({S.utc("d")}, {S.utc("d + 1")} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)), NULL, NULL FROM m)
    SELECT {S.secs("ts")} AS ts_s, coalesce(round(max(price), 6), -1) AS price, coalesce(round(max(load), 6), -1) AS load FROM a GROUP BY ts""")
def b7_live_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of a day to be predicted: hours without a price stay, and all hours of the day are there."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    last = h.agg(F.max("day").alias("day"))
    known = h.join(F.broadcast(last.select(F.col("day").alias("_d"))), F.col("day") < F.date_sub("_d", 1))
    got = C.live_assemble([known.select("ts", "price"), h.where("load IS NOT NULL").select("ts", "load")], last)
    return got.select(S.ts_s(), F.coalesce(F.round("price", 6), F.lit(-1.0)).alias("price"), F.coalesce(F.round("load", 6), F.lit(-1.0)).alias("load"))


@query(f"WITH {S.H} SELECT {S.secs('ts')} AS ts_s, CASE WHEN day(ts) % 2 = 0 THEN round(price, 6) WHEN hour(ts) < 20 THEN round(price + 0.0004, 6) END AS price FROM h WHERE day(ts) % 2 = 0 OR hour(ts) < 20")
def i15_existing_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table and a fresh one that agree within a thousandth: what is stored holds; any larger difference would fail the query."""
    h = S.hourly(spark, sf_dir).select("ts", "price")
    stored = h.where(F.dayofmonth("ts") % 2 == 0)
    fresh = h.where(F.hour("ts") < 20).withColumn("price", F.col("price") + 0.0004)
    return C.existing_wins(stored, fresh, ["ts"], "price", 0.001).select(S.ts_s(), F.round("price", 6).alias("price"))
