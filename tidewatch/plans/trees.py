"""Queries of boosted trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg
from tidewatch.operators import boosting as T
from tidewatch.plans import stand_ins as S
from tidewatch.registry import query

BINS, LEAST, RATE, ROUNDS, COLUMNS = 8, 20, 0.5, 3, ("load", "hour")


def _round(k: int) -> str:
    """One tree of one split: sums by (column, bin), all splits, the best, the leaves, the rows a step further."""
    return f"""h{k} AS (SELECT u.j AS j, u.b AS b, sum(y - f) AS s, count(*) AS n FROM (SELECT y, f, unnest([{{'j': 0, 'b': b0}}, {{'j': 1, 'b': b1}}]) AS u FROM s{k} WHERE train) GROUP BY 1, 2),
    t{k} AS (SELECT j, sum(s) AS ts, sum(n) AS tn, coalesce(sum(s) FILTER (b = -1), 0) AS zs, coalesce(sum(n) FILTER (b = -1), 0) AS zn FROM h{k} GROUP BY 1),
    a{k} AS (SELECT t.j, c, nl, ts, tn, coalesce((SELECT sum(s) FROM h{k} h WHERE h.j = t.j AND h.b BETWEEN 0 AND c), 0) + CASE WHEN nl THEN zs ELSE 0 END AS a, coalesce((SELECT sum(n) FROM h{k} h WHERE h.j = t.j AND h.b BETWEEN 0 AND c), 0) + CASE WHEN nl THEN zn ELSE 0 END AS k
        FROM t{k} t JOIN ct ON ct.j = t.j, unnest(range(0, len(cuts))) r(c), (VALUES (false), (true)) v(nl) WHERE NOT nl OR zn > 0),
    p{k} AS (SELECT arg_max({{'j': j, 'c': c, 'nl': nl}}, (round(a * a / k + (ts - a) * (ts - a) / (tn - k) - ts * ts / tn, {T.DIGITS}), -j, -c, NOT nl)) AS p FROM a{k} WHERE least(k, tn - k) >= {LEAST}),
    l{k} AS (SELECT s.*, CASE WHEN (CASE p.j WHEN 0 THEN b0 ELSE b1 END) = -1 THEN p.nl ELSE (CASE p.j WHEN 0 THEN b0 ELSE b1 END) <= p.c END AS lf FROM s{k} s, p{k}),
    s{k + 1} AS (SELECT ts, y, b0, b1, train, f + {RATE} * avg(y - f) FILTER (train) OVER (PARTITION BY lf) AS f FROM l{k})"""


@query(f"""WITH {S.H}, x AS (SELECT ts, price AS y, load AS x0, hour(ts)::DOUBLE AS x1, day(ts) <= 15 AS train FROM h),
    ct AS (SELECT 0 AS j, list_sort(list_distinct(quantile_cont(x0, [{", ".join(str(i / BINS) for i in range(1, BINS))}]))) AS cuts FROM x WHERE train UNION ALL SELECT 1, list_sort(list_distinct(quantile_cont(x1, [{", ".join(str(i / BINS) for i in range(1, BINS))}]))) FROM x WHERE train),
    s0 AS (SELECT ts, y, CASE WHEN x0 IS NULL THEN -1 ELSE len(list_filter((SELECT cuts FROM ct WHERE j = 0), lambda c: x0 > c)) END AS b0, len(list_filter((SELECT cuts FROM ct WHERE j = 1), lambda c: x1 > c)) AS b1, train, (SELECT avg(y) FROM x WHERE train) AS f FROM x),
    {", ".join(_round(k) for k in range(ROUNDS))}
    SELECT {S.secs("ts")} AS ts_s, train, round(f, 6) AS p FROM s{ROUNDS}""")
def g9_boosted_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of one split on a column with nulls and the hour, fitted on the first half of the month; each row's prediction."""
    h = S.hourly(spark, sf_dir).select("ts", F.col("price").alias("y"), "load", F.hour("ts").cast("double").alias("hour"), (F.dayofmonth("ts") <= 15).alias("train"))
    model = T.fit(h.where("train"), COLUMNS, "y", rate=RATE, most=ROUNDS, depth=1, bins=BINS, least=LEAST)
    return model.predicted(h).select(tg.seconds(F.col("ts")).alias("ts_s"), "train", F.round("p", 6).alias("p"))
