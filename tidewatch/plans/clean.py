"""Queries of assembly and cleaning (A, B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import cleaning as C
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

_COLS = ["price", *S.TYPES]
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _COLS)


@query(f"WITH {S.H} SELECT {S.secs('ts')} AS ts_s, {_ROUND} FROM h")
def b2_hourly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: hourly means and sums by type, null where a type has no event."""
    return S.hourly(spark, sf_dir).select(S.ts_s(), *[F.round(c, 6).alias(c) for c in _COLS])


@query("""SELECT CAST(l_shipdate AS DATE) AS day, round(CASE WHEN sum(w) = 0 OR count(*) FILTER (w IS NULL) > 0 THEN avg(p) ELSE sum(p * w) / sum(w) END + 1e-8, 6) AS price
    FROM (SELECT l_shipdate, l_extendedprice / l_quantity AS p, CASE WHEN l_discount < 0.09 THEN l_quantity WHEN l_tax < 0.08 THEN 1.0 END AS w FROM lineitem) GROUP BY 1""")
def b3_weighted_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price by volume per day; weights fall back to 1, and the plain mean holds where one is still missing."""
    price, weight = F.try_divide("l_extendedprice", "l_quantity"), F.when(F.col("l_discount") < 0.09, F.col("l_quantity"))
    spare = F.when(F.col("l_tax") < 0.08, F.lit(1.0))
    items = S.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), price.alias("p"), weight.alias("w"), spare.alias("f"))
    return items.groupBy("day").agg(F.round(C.weighted_mean(F.col("p"), F.col("w"), F.col("f")) + 1e-8, 6).alias("price"))


_SOLAR = f"{S.H}, r AS (SELECT min(ts) AS a, max(ts) AS b FROM h), g AS (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM r), s AS (SELECT ts, CASE WHEN hour(ts) % 5 < 2 THEN solar END AS v FROM g LEFT JOIN h USING (ts))"


@query(f"""WITH {_SOLAR}, f AS (SELECT ts, v, last_value(v IGNORE NULLS) OVER o AS lv, last_value(CASE WHEN v IS NOT NULL THEN ts END IGNORE NULLS) OVER o AS lt FROM s WINDOW o AS (ORDER BY ts ROWS UNBOUNDED PRECEDING))
    SELECT {S.secs("ts")} AS ts_s, round(CASE WHEN epoch(ts) - epoch(lt) <= 7200 THEN lv END, 6) AS filled FROM f""")
def b4_bounded_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value fills gaps for two hours, in blocks that no task outgrows."""
    h = S.hourly(spark, sf_dir).select("ts", F.when(F.hour("ts") % 5 < 2, F.col("solar")).alias("v"))
    ends = h.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    grid = ends.select(F.explode(F.sequence("a", "b", tg.hours(1))).alias("ts"))
    return C.bounded_ffill(grid.join(h, "ts", "left"), "v", 2, out="filled").select(S.ts_s(), F.round("filled", 6).alias("filled"))


def _source(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    """Two sources that have all events between them."""
    e = S.table(spark, sf_dir, "events").where((F.col("event_type") != "click") if second else (F.col("event_type") == "click"))
    return e.groupBy(tg.truncate(F.col("ts"), 60).alias("ts")).agg(F.avg("value").alias("price"))


_AB = "".join(f"{n} AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS price FROM events WHERE event_type {k} 'click' GROUP BY 1), " for n, k in (("a", "="), ("b", "<>")))


@query(f"""WITH {_AB} c AS (SELECT coalesce(a.ts, b.ts) AS ts, a.price AS p, b.price AS q FROM a FULL JOIN b ON a.ts = b.ts)
    SELECT {S.secs("ts")} AS ts_s, round(coalesce(p, q), 6) AS price, p IS NULL AND q IS NOT NULL AS from_second, coalesce(abs(p - q) > 5, false) AS conflict FROM c""")
def b5_coalesce_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price from two sources, with provenance and conflicts."""
    return C.coalesce_sources(_source(spark, sf_dir, False), _source(spark, sf_dir, True), "price", tolerance=5).select(S.ts_s(), F.round("price", 6).alias("price"), "from_second", "conflict")


@query(f"""WITH {_AB} c AS (SELECT coalesce(a.ts, b.ts) AS ts, a.price IS NULL AS s FROM a FULL JOIN b ON a.ts = b.ts), m AS (SELECT max(ts) AS as_of FROM c)
    SELECT k AS days, bool_or(s) AS any_second, count(*) FILTER (s) AS n_second, count(*) AS n FROM c, m, (VALUES (1), (7), (28)) v(k) WHERE ts >= as_of - to_days(k) GROUP BY k""")
def b6_provenance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each consumer's window takes from the second source."""
    both = C.coalesce_sources(_source(spark, sf_dir, False), _source(spark, sf_dir, True), "price")
    as_of = F.broadcast(both.agg(F.max("ts").alias("as_of")))
    windows = F.explode(F.array(*[F.lit(k) for k in (1, 7, 28)])).alias("days")
    rows = both.join(as_of, F.lit(True)).select("*", windows).where(F.col("ts") >= F.col("as_of") - F.make_interval(days=F.col("days")))
    return rows.groupBy("days").agg(F.bool_or("from_second").alias("any_second"), F.count_if("from_second").alias("n_second"), F.count("*").alias("n"))


@query("""SELECT user_id, floor(epoch(max(ts)))::BIGINT AS last_s, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY user_id""")
def b8_first_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key, and the time of its last."""
    e = S.table(spark, sf_dir, "events")
    first = C.keep_first(e.select("user_id", "ts", "event_id"), ["user_id"], [F.col("ts"), F.col("event_id")])
    last = e.groupBy("user_id").agg(tg.seconds(F.max("ts")).alias("last_s"))
    return first.join(last, "user_id").select("user_id", "last_s", F.col("event_id").alias("first_event"))


@query(f"WITH {S.H} SELECT {S.secs('ts')} AS ts_s, round(price, 6) AS price, CASE WHEN NOT (ts >= a + INTERVAL 240 HOUR AND ts < a + INTERVAL 252 HOUR) THEN round(load, 6) END AS load FROM h, (SELECT min(ts) AS a FROM h) WHERE ts >= a + INTERVAL 168 HOUR")
def b11_b13_trim_and_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a week of warm-up, and with a gap of twelve hours put into one column."""
    h = S.hourly(spark, sf_dir)
    start = h.agg(F.min("ts").alias("a"))
    rows = C.trim_warmup(h, 168).join(F.broadcast(start), F.lit(True))
    return C.blank(rows, ["load"], F.col("a") + tg.hours(240), F.col("a") + tg.hours(252)).select(S.ts_s(), F.round("price", 6).alias("price"), F.round("load", 6).alias("load"))


@query(f"""WITH {S.H} SELECT {S.day_of("ts")} AS day, count(*) AS n, list(round(price, 6) ORDER BY ts)[1] AS first_value, round(sum(round(price, 6)), 6) AS total, len(list(price)) AS size FROM h GROUP BY 1""")
def b14_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered, rounded values of each day, and their figures."""
    rows = S.hourly(spark, sf_dir).withColumn("v", F.round("price", 6))
    got = rows.groupBy(tg.local_day(F.col("ts")).alias("day")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "v"))), lambda x: x["v"]).alias("values"), F.round(F.sum("v"), 6).alias("total"), F.count("*").alias("n"))
    return got.select("day", "n", F.get("values", F.lit(0)).alias("first_value"), "total", F.size("values").cast("long").alias("size"))


@query("""SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DOUBLE) FROM orders WHERE o_orderpriority = '5-LOW' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def b15_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one resolution replace those of another with their key."""
    o = S.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("price"), "o_orderpriority")
    return C.upsert(o.where("o_orderpriority = '5-LOW'"), o.where("o_orderpriority = '1-URGENT'"), ["o_custkey"]).drop("o_orderpriority")


@query(r"""SELECT event_id, regexp_replace('GET /x?token=' || props || '&id=' || event_id, '(?i)((?:token|key|secret|password)[=:]\s*)[^&\s"'']+', '\1***', 'g') AS safe FROM events""")
def b16_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in request lines replaced."""
    line = F.concat(F.lit("GET /x?token="), F.col("props"), F.lit("&id="), F.col("event_id").cast("string"))
    return S.table(spark, sf_dir, "events").select("event_id", C.redact(line).alias("safe"))


@query(f"""WITH {S.H}, v AS (SELECT {S.day_of("ts")} AS day FROM h GROUP BY 1 HAVING bool_and(price IS NOT NULL) AND bool_and(solar IS NOT NULL) AND bool_and(wind_off IS NOT NULL))
    SELECT {S.secs("ts")} AS ts_s, round(price, 6) AS price FROM h WHERE {S.day_of("ts")} IN (SELECT day FROM v)""")
def b18_valid_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of days on which nothing is missing."""
    h = S.hourly(spark, sf_dir).withColumn("day", tg.local_day(F.col("ts")))
    return h.join(C.valid_days(h, ["price", "solar", "wind_off"]), "day", "left_semi").select(S.ts_s(), F.round("price", 6).alias("price"))


@query("SELECT event_type, floor(epoch(min(ts)))::BIGINT AS first_s, floor(epoch(max(ts)))::BIGINT AS last_s, count(*) AS n, concat_ws('_', floor(epoch(min(ts)))::BIGINT, floor(epoch(max(ts)))::BIGINT, count(*)) AS fingerprint FROM events GROUP BY 1")
def b19_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range and size of each source as one string."""
    e = S.table(spark, sf_dir, "events").groupBy("event_type").agg(tg.seconds(F.min("ts")).alias("first_s"), tg.seconds(F.max("ts")).alias("last_s"), F.count("*").alias("n"))
    return e.withColumn("fingerprint", F.concat_ws("_", "first_s", "last_s", "n"))


@query("""WITH f AS (SELECT date_trunc('day', ts)::DATE AS day, user_id % 5 AS a, (user_id // 5) % 5 AS b, sum(value) AS v FROM events WHERE user_id % 5 <> (user_id // 5) % 5 GROUP BY 1, 2, 3)
    SELECT x.day, x.a, x.b, round(x.v - y.v, 6) AS net FROM f x JOIN f y ON y.day = x.day AND y.a = x.b AND y.b = x.a""")
def a14_net_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow to a neighbour minus the flow from it."""
    a, b = F.col("user_id") % 5, F.floor(F.col("user_id") / 5) % 5
    f = S.table(spark, sf_dir, "events").where(a != b).groupBy(F.to_date("ts").alias("day"), a.alias("a"), b.alias("b")).agg(F.sum("value").alias("v"))
    back = f.select("day", F.col("a").alias("b"), F.col("b").alias("a"), F.col("v").alias("w"))
    return f.join(back, ["day", "a", "b"]).select("day", "a", "b", F.round(F.col("v") - F.col("w"), 6).alias("net"))


@query("""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS close FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) < 6 GROUP BY 1)
    SELECT year(day)::BIGINT AS year, count(*) AS n, count(*) < 0.5 * (max(day) - min(day) + 1) * 5 / 7 AS sparse, round(avg(close), 2) AS mean FROM d GROUP BY 1""")
def a16_daily_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes of trading days by year, and whether there are too few."""
    o = S.table(spark, sf_dir, "orders").where(F.weekday("o_orderdate") < 5)
    d = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("close"))
    span = (F.date_diff(F.max("day"), F.min("day")) + 1) * 5 / 7
    return d.groupBy(F.year("day").cast("long").alias("year")).agg(F.count("*").alias("n"), (F.count("*") < 0.5 * span).alias("sparse"), F.round(F.avg("close"), 2).alias("mean"))
