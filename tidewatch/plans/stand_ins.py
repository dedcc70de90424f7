"""Stand-ins for market series, derived from the given tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg

TYPES = {"load_forecast": "click", "load": "view", "wind_on": "purchase", "wind_off": "signup", "solar": "error"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, price, load_forecast, load, wind_on, wind_off, solar) for each hour with events."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    sums = [F.sum(F.when(F.col("event_type") == t, F.col("value"))).alias(c) for c, t in TYPES.items()]
    return events.groupBy(tg.truncate(F.col("ts"), 60).alias("ts")).agg(F.avg("value").alias("price"), *sums)


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, price) for each quarter hour with events."""
    return table(spark, sf_dir, "events").groupBy(tg.truncate(F.col("ts"), 15).alias("ts")).agg(F.avg("value").alias("price"))


def ts_s() -> Column:
    """The row's instant in seconds."""
    return tg.seconds(F.col("ts")).alias("ts_s")


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day): the days with orders."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


H = f"""h AS (SELECT date_trunc('hour', ts) AS ts, avg(value) AS price,
{", ".join(f"sum(value) FILTER (event_type = '{t}') AS {c}" for c, t in TYPES.items())} FROM events GROUP BY 1)"""
Q = "q AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS ts, avg(value) AS price FROM events GROUP BY 1)"
D = "d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"


def local(x: str) -> str:
    return f"(({x}) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin')"


def utc(x: str) -> str:
    return f"(CAST({x} AS TIMESTAMP) AT TIME ZONE 'Europe/Berlin' AT TIME ZONE 'UTC')"


def day_of(x: str) -> str:
    return f"CAST({local(x)} AS DATE)"


def secs(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"
